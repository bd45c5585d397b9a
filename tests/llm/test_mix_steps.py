"""Operator 7: words stay arrays, letters keep their words when they are lowered, a step of the coder chooses without masks."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from loam.llm import mixcoder, queries
from loam.llm.tokens import Encoder


@pytest.fixture(scope="module")
def enc():
    return Encoder(queries.WORD_BPE)


def same(enc, texts):
    ids, offsets = enc.encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == enc.lib.encode(text, add_special_tokens=False).ids, text


def test_letters_keep_their_words(enc):
    """Ɛ, Ⱥ and others become letters outside the range of the capitals."""
    same(enc, [f"a{chr(c)}b x{chr(c)}" for c in range(0x250)])


def test_contractions_are_cut_as_the_library_does(enc):
    rng = np.random.default_rng(8)
    signs = list("''''streveldmSLa1.\"\n\té ")
    same(enc, ["'", "''s", "x'LLama", "'s's", *("".join(rng.choice(signs, 14)) for _ in range(2000))])


def test_words_are_known_by_arrays(enc):
    texts = pa.array([f"word{chr(97 + k % 26)} seen'll\t{k}" for k in range(500)])
    first = enc.encode(texts)
    known, python = len(enc.known), len(enc.tokens)
    assert len(enc.known_ids) == known and "wordc" in enc.known.to_pylist() and not python
    again = enc.encode(texts)
    assert len(enc.known) == known and all(map(np.array_equal, first, again))


def test_known_words_have_a_bound():
    few = Encoder(queries.WORD_BPE, cache=20)
    same(few, [f"abc{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)] * 2)
    assert len(few.known) == len(few.known_ids) == 40


def blocks():
    at = np.arange(7 * 3000, dtype=np.uint64)
    at = (at * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(997)
    return (at * at % np.uint64(613)).astype(np.uint16).reshape(7, 3000)


def test_files_keep_their_bytes():
    words = mixcoder.encode_blocks(blocks())
    assert zlib.crc32(b"".join(w.astype("<u4").tobytes() for w in words)) == 0xD193D03E
    assert np.array_equal(mixcoder.decode_blocks(words, 3000), blocks())


def test_steps_choose_without_masks(monkeypatch):
    """Choices by a mask whose values are irregular took a fifth of a step."""
    calls = []
    for name in ("where", "copyto"):
        monkeypatch.setattr(mixcoder.np, name, lambda *a, _own=getattr(np, name), **k: calls.append(1) or _own(*a, **k))
    assert np.array_equal(mixcoder.decode_blocks(mixcoder.encode_blocks(blocks()), 3000), blocks())
    assert len(calls) < 100
