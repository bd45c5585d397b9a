"""Whole-text tokenisation at word speed, exact for the public tokenizers.

A text is cut where no token can cross (in front of a space that follows a character
other than white space). Pieces are dictionary-encoded in Arrow, each distinct piece is
encoded once by the ``tokenizers`` library, and the ids are gathered back in Arrow. Texts
whose white space doesn't allow this are cut by a slower, equally exact pattern. Where the
tokenizer drops white space, the distinct pieces are cut into words together, by the kinds of
their bytes, and the library encodes all words it hasn't seen at once; the end of a word shows
in its last id. Known words and their ids are Arrow arrays: no word becomes a Python object.
"""

from __future__ import annotations

import re
from codecs import charmap_decode
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries of a worker's cache of pieces; bounds its memory, not what is encoded.
CACHE = 200_000
#: Text handled at once, in bytes.
CHUNK = 8 << 20
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_RUNS = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
#: A space inside or at the end of a run of white space (RE2 syntax).
_INNER = r"[\t-\r \x{85}\p{Z}] ([\t-\r \x{85}\p{Z}]|$)"
_LETTER = "A-Za-zÀ-ÖØ-öø-įĲ-ɏ"
_PLAIN = re.compile(f"[\\n\\t -~{_LETTER}]*\\Z")
#: What the pattern for single pieces would not take (RE2 syntax).
_ODD = f"[^\\n\\t -~{_LETTER}]|<\\|"
_CONTRACTION = "'s|'t|'re|'ve|'m|'ll|'d"
#: Kinds of bytes: letters (all of other alphabets that ``_ODD`` lets through), signs, then those that stand alone.
_SIGN, _ALONE, _END = 1, 2, 3
_KIND = bytes(_END if b == 0 else 0 if b >= 128 or chr(b).isalpha() else _ALONE if chr(b) in "\t\n 0123456789" else _SIGN for b in range(256))
#: What is neither word nor sign: the end of a piece and white space, which have no ids.
_BLANKS = ("\0", "\t", "\n", " ")
#: Words given to the library at once.
_TOGETHER = 8000
#: The tokenizers' own split patterns, narrowed to the characters of ``_PLAIN``.
_SPLITS = {
    True: re.compile(f"{_CONTRACTION}| ?[{_LETTER}]+| ?[0-9]+| ?[^\\s{_LETTER}0-9]+|\\s+(?!\\S)|\\s+"),
    False: re.compile(f"{_CONTRACTION}|[{_LETTER}]+|[0-9]|[^\\s{_LETTER}0-9]+"),
}


def _joined(array: pa.Array, end: str) -> str:
    """The strings of an array in one, each followed by ``end``."""
    large = pa.large_string()
    return pc.binary_join_element_wise(array.cast(large), pa.scalar("", large), pa.scalar(end, large)).buffers()[2].to_pybytes().decode()


def _cut(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of plain lower-case pieces begin, each of which ends in a null character; which of them are these ends."""
    kind, byte = np.frombuffer(raw.translate(_KIND), np.uint8), np.frombuffer(raw, np.uint8)
    begins = kind >= _ALONE
    begins[1:] |= kind[1:] != kind[:-1]
    begins[:1] = True
    quote = np.flatnonzero((byte == ord("'")) & begins)  # contractions: a quote alone and one or two letters
    one, two = byte[quote + 1], byte[np.minimum(quote + 2, len(byte) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = np.isin(one * np.uint16(256) + two, [int.from_bytes(x) for x in (b"re", b"ve", b"ll")])
    begins[quote[short | long] + 1] = False
    begins[quote[short] + 2] = True
    begins[quote[long] + 3] = True
    starts = np.flatnonzero(begins)
    return starts, kind[starts] == _END


def gathered(batches: Iterable[pa.RecordBatch], size: int = CHUNK) -> Iterator[pa.Table]:
    """Record batches put together to about ``size`` bytes."""
    held, held_bytes = [], 0
    for batch in batches:
        held.append(batch)
        held_bytes += batch.nbytes
        if held_bytes >= size:
            yield pa.Table.from_batches(held)
            held, held_bytes = [], 0
    if held:
        yield pa.Table.from_batches(held)


class Encoder:
    """Ids of whole texts; one per worker. ``add_special_tokens`` is off throughout."""

    def __init__(self, path: str, cache: int = CACHE) -> None:
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model
        pre = str(self.lib.pre_tokenizer)
        #: Byte-level BPE keeps the space as part of the token, word BPE drops it.
        self.spaced = self.lib.normalizer is None and pre.startswith("ByteLevel(") and "use_regex=True" in pre
        self.words = "behavior=Removed" in pre and "Lowercase" in str(self.lib.normalizer)
        self.split = _SPLITS[self.spaced]
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        shown = {}
        for c in range(1, 0x800):
            text = chr(c)
            shown |= dict(zip(text.encode().decode("latin-1"), level.pre_tokenize_str(text)[0][0], strict=True))
        self.shown = str.maketrans(shown)
        self.last = np.zeros(self.lib.get_vocab_size(), bool)  # ids that end a word
        if self.words:
            #: The same model for words that are already cut, lower-case and shown as bytes. Each comes once, so the library keeps none.
            own = json.loads(self.lib.to_str())["model"]
            merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in own.pop("merges")]
            self.bare = Tokenizer(BPE(merges=merges, cache_capacity=0, **{k: v for k, v in own.items() if k != "type" and v is not None}))
            self.bare.pre_tokenizer = CharDelimiterSplit(" ")
            self.shown_words = "".join(self.shown.get(b, chr(b)) if b != ord(" ") else " " for b in range(256))
            self.last[[i for t, i in self.lib.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]] = True
            self.known, self.known_ids = pa.array(_BLANKS, pa.large_string()), pa.array([b""] * len(_BLANKS), pa.large_binary())
        self.cap = cache
        self.pieces: dict[bytes, bytes] = {}
        self.tokens: dict[str, bytes] = {}

    def _token(self, token: str) -> bytes:
        found = self.tokens.get(token)
        if found is None:
            byte_chars = token.encode().decode("latin-1").translate(self.shown)
            found = np.array([t.id for t in self.model.tokenize(byte_chars)], "<u4").tobytes()
            if len(self.tokens) < self.cap:
                self.tokens[token] = found
        return found

    def _encode(self, piece: str) -> bytes:
        if "<|" not in piece and _PLAIN.match(piece):
            return b"".join(map(self._token, self.split.findall(piece if self.spaced else piece.lower())))
        return np.array(self.lib.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def _pieces(self, array: pa.Array) -> list[bytes]:
        """Ids of each piece of a large_string array, with the space that comes before it."""
        offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8).tolist()
        raw = (array.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        keys = [raw[i:j] for i, j in zip(offsets, offsets[1:])]  # noqa: B905 - one shorter by intent
        found = list(map(self.pieces.get, keys))
        lead = " " if self.spaced else ""
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = ids = self._encode(lead + keys[k].decode())
                if len(self.pieces) < self.cap and len(keys[k]) < 64:
                    self.pieces[keys[k]] = ids
        return found

    def _fresh(self, words: pa.Array) -> pa.Array:
        """Ids of each of the lower-case words, which the tokenizer doesn't cut; many are encoded together."""
        parts, sizes = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)]
        for at in range(0, len(words), _TOGETHER):
            some = words.slice(at, _TOGETHER)
            shown, _ = charmap_decode(_joined(some, " ")[:-1].encode(), "strict", self.shown_words)
            ids = np.array(self.bare.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(some):  # a word's last id doesn't show
                each = list(map(self._token, some.to_pylist()))
                ids, ends = np.frombuffer(b"".join(each), "<u4"), np.cumsum([len(e) // 4 for e in each])
            parts.append(ids)
            sizes.append(np.diff(ends, prepend=0))
        ends, ids = np.cumsum(np.concatenate(sizes)) * 4, np.concatenate(parts)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(ids)])

    def _word_pieces(self, array: pa.Array) -> pa.Array:
        """Ids of each piece of a large_string array, for tokenizers that drop white space."""
        if not len(array):
            return pa.array([], pa.large_binary())
        odd = pc.match_substring_regex(array, _ODD)
        slow = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        raw = _joined(pc.if_else(odd, "", array) if slow else array, "\0").lower().encode()
        starts, is_end = _cut(raw)
        coded = pc.dictionary_encode(pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(raw)))
        place = pc.index_in(coded.dictionary, value_set=self.known)
        missing = pc.is_null(place)
        place = pc.fill_null(place, 0).to_numpy().astype(np.int64)
        words, n = coded.dictionary.filter(missing), len(self.known)
        fresh = self._fresh(words)
        place[missing.to_numpy(zero_copy_only=False)] = np.arange(n, n + len(words))
        table = pa.concat_arrays([self.known_ids, fresh])
        room = 2 * self.cap - n  # there is no cache of pieces
        if room > 0 and len(words):
            self.known = pa.concat_arrays([self.known, words.slice(0, room)])
            self.known_ids = table.slice(0, len(self.known))
        taken = table.take(pa.array(place.take(coded.indices.to_numpy())))
        ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, taken.offset * 8)
        offsets = np.concatenate((ends[:1], ends[1:][is_end]))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(array), [None, pa.py_buffer(offsets), taken.buffers()[2]])
        if slow:
            rest = pa.array([self._encode(array[k].as_py()) for k in slow], pa.large_binary())
            pieces = pc.replace_with_mask(pieces, odd, rest)
        return pieces

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids as little-endian uint32, offsets of each text in them); null is empty."""
        texts = pc.fill_null(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, "")
        parts, ends, start, base = [], [np.zeros(1, np.int64)], 0, 0
        lengths = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        while start < len(texts):
            before = lengths[start - 1] if start else 0
            much = CHUNK if lengths[-1] - before > 3 * CHUNK // 2 else 2 * CHUNK  # no small rest
            stop = max(start + 1, int(np.searchsorted(lengths, before + much, "right")))
            ids, offsets = self._some(texts.slice(start, stop - start))
            parts.append(ids)
            ends.append(offsets[1:] + base)
            base, start = base + len(ids), stop
        return (np.concatenate(parts) if parts else np.zeros(0, "<u4")), np.concatenate(ends)

    def _some(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not (self.spaced or self.words):
            per = [np.array(e.ids, "<u4") for e in self.lib.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate([*per, np.zeros(0, "<u4")]), np.cumsum([0, *map(len, per)])
        odd = {}
        if self.spaced:
            flags = pc.match_substring_regex(texts, _INNER)
            for k in np.flatnonzero(flags.to_numpy(zero_copy_only=False)):
                odd[int(k)] = b"".join(map(self._encode, _RUNS.findall(texts[int(k)].as_py())))
            if odd:
                texts = pc.if_else(flags, "", texts)
        lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
        starts = lists.offsets.to_numpy()
        coded = pc.dictionary_encode(lists.flatten())
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        starts = starts - starts[0]
        if self.words:
            table = self._word_pieces(coded.dictionary)
        else:
            table = self._pieces(coded.dictionary)
            n = len(table)
            firsts = lists.flatten().take(pa.array(starts[:-1])).to_pylist()
            table += [odd[k] if k in odd else self._encode(p) for k, p in enumerate(firsts)]
            codes[starts[:-1]] = n + np.arange(len(firsts))
            table = pa.array(table, pa.large_binary())
        taken = table.take(pa.array(codes))
        ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, taken.offset * 8)
        ids = np.frombuffer(taken.buffers()[2], "<u4", int(ends[-1] - ends[0]) // 4, int(ends[0])) if len(taken) and ends[-1] > ends[0] else np.zeros(0, "<u4")
        return ids, (ends[starts] - ends[0]) // 4


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
