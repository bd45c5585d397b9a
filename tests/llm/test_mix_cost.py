"""Operator 7: unseen words go to the library together, and blocks begin with their counts."""

import numpy as np
import pyarrow as pa

from loam.llm import mixcoder, queries
from loam.llm.tokens import Encoder


def test_unseen_words_are_encoded_together(monkeypatch):
    enc = Encoder(queries.WORD_BPE)
    alone = []
    monkeypatch.setattr(enc, "_token", lambda word: alone.append(word) or b"")
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 9)) for _ in range(3000)]
    texts = [" ".join(words[k : k + 50]) + "'s Éa,\n12" for k in range(0, 3000, 50)]
    ids, offsets = enc.encode(pa.array(texts))
    assert not alone
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == enc.lib.encode(text, add_special_tokens=False).ids


def test_odd_texts_are_exact():
    enc = Encoder(queries.WORD_BPE)
    parts = ["a", "É", "İ", "Σ", "漢", "  ", "\n", "\0", "'S", "<|endoftext|>", "<|", "7", "_", "\x85", "Ĳ", "ß", "\r"]
    rng = np.random.default_rng(6)
    texts = [None, "", " ", "\0 \0", *("".join(parts[k] for k in rng.integers(0, len(parts), 12)) for _ in range(300))]
    ids, offsets = enc.encode(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == enc.lib.encode(text or "", add_special_tokens=False).ids


def test_block_tables_round_trip():
    rng = np.random.default_rng(7)
    blocks = np.minimum(rng.geometric(0.002, (300, 500)), 65535).astype(np.uint16)
    blocks[7], blocks[8], blocks[9] = 65535, np.arange(500) * 131, 0
    counts, numbers = mixcoder._Counts.of(blocks)
    words = counts.packed()
    back, taken = mixcoder._Counts.unpacked([np.append(w, np.uint32(9)) for w in words])
    assert [len(w) for w in words] == taken.tolist()
    for name in ("sizes", "ids", "counts"):
        assert np.array_equal(getattr(counts, name), getattr(back, name))
    assert np.array_equal(back.ids[back.starts[:, None] + numbers - 1], blocks)
    for k in (7, 8, 9):
        assert np.array_equal(counts.part(k, k + 1).packed()[0], words[k])
