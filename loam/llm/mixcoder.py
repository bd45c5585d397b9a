"""Operator 7: token ids in a compressed binary format.

Ids are coded in blocks. Each block starts from a fresh model and holds nothing of any
other: it begins with its distinct ids, ascending, and their counts, in bits of bounded
length with unary rests. The numbers of these ids are the symbols, and three orders predict
the next one. Order 2 (a checked hash table by the last two numbers) and order 1 (a table
by the last one) each propose a candidate with an adaptive confidence; the probability that
a candidate comes next is a logistic mix, with weights learned online, of both confidences
and of the candidate's order-0 frequency. If neither comes, order 0 codes the number from
the occurrences that were still to come at the last refresh, so that no id needs an escape
and none that is used up takes room. All of it drives one 64-bit range coder with carries.
The arithmetic is integer arithmetic and exact float products, so that machines agree.

Blocks are coded side by side as lanes of NumPy arrays. Each is checksummed: a damaged block
is found and the others can still be read. A segment is: header, documents (id, flag,
count), directory of blocks, words of all blocks. A file (``*.lmix``) holds the segments of
one partition one after the other; the table of segments names file, offset and length, so
that files of lost attempts are never read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.shared import located, settings, shared_dir, stage, tidy
from loam.llm.tokens import encoder, gathered

MAGIC, VERSION = b"LMIX", 3
END_ID = 1
#: Ids of a block (16,383 at most), and blocks coded side by side (and so ids of a segment).
BLOCK, LANES = 4096, 4096
_HEAD = struct.Struct("<4sHHIIIQ")  # magic, version, flags, documents, blocks, block size, local start
_NUMBER = 0x3FFF  # a table entry: check (7 bits), confidence (10), candidate number (14; 0: none)
_CHECK = 0x7F000000
_SLOT_BITS = 11  # of the table of order 2; that of order 1 has a slot for each number
_REFRESH = 1024  # steps between two sets of order-0 intervals
_TOGETHER = 128  # blocks whose tables are packed at once
_STRIP = 32  # rows of a transpose written at once
_FRESH, _WEAK = 320, 160  # confidence of a new entry; below this it is replaced
_RATE = 13
_MOST = 1 << 17  # of a weight
U = np.uint64
_WORD, _HALF = U(32), U(16)
_FULL, _ONE = U(1 << 32), U(1)
_HASH_A, _HASH_B = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)
#: Sections of the ids in a block's table of counts, closer together where ids are more frequent.
_EDGES = np.array([0, 512, 1024, 2048, 4096, 8192, 16384, 65536])
_SECTION = np.repeat(np.arange(len(_EDGES) - 1), np.diff(_EDGES))


def _tables() -> tuple[np.ndarray, ...]:
    """Integer logit of a confidence, probability of a mix (12 bits), 256 ln n, and the next confidence after a miss or a hit."""
    conf = np.arange(1024)
    share = (conf + 0.5) / 1024
    logit = np.clip(np.rint(256 * np.log(share / (1 - share))), -2047, 2047).astype(np.int32)
    logit[0] = 0  # no entry
    squash = np.clip(np.rint(4096 / (1 + np.exp(-np.arange(-2048, 2048) / 256))), 24, 3840).astype(np.int32)
    missed = conf - (conf >> 1)
    after = np.concatenate((np.where(missed >= _WEAK, missed, 0), conf + ((1023 - conf) >> 2))).astype(np.int32)
    return logit, squash, np.rint(256 * np.log(np.maximum(np.arange(1 << 14), 0.5))).astype(np.int32), after << 14


_LOGIT, _SQUASH, _LOG, _AFTER = _tables()
_LOG_SHORT = _LOG.astype(np.int16)
#: Weights at the start (unit 2^14): confidence of order 2, of order 1 in the same candidate, order 0; and the bias, with the middle of ``_SQUASH``.
_START, _BIAS = (15000, 8000, 2500), 2048


def _runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. below each length, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def _turned(rows: np.ndarray) -> np.ndarray:
    """The transpose in memory order, written by strips that stay in the cache."""
    out = np.empty(rows.shape[::-1], rows.dtype)
    for k in range(0, len(rows), _STRIP):
        out[:, k : k + _STRIP] = rows[k : k + _STRIP].T
    return out


def _gap_bits(held: np.ndarray) -> np.ndarray:
    """Fixed bits of a gap between ids, by block and section, for the numbers of ids held there."""
    mean = (np.diff(_EDGES) * 9 >> 4) // np.maximum(held, 1)
    return np.frexp(mean.astype(np.float64))[1].astype(np.int64)


class _Counts:
    """The ids of each block, ascending, with their counts; ``numbers`` start from 1 in each block."""

    def __init__(self, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        self.sizes, self.ids, self.counts = sizes, ids, counts
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def of(cls, blocks: np.ndarray) -> tuple[_Counts, np.ndarray]:
        """The table of the blocks' ids, and the number of each id."""
        out, number = np.empty(blocks.shape, np.uint16), np.empty(1 << 16, np.uint16)
        up, sizes, ids, counts = np.arange(1, blocks.shape[1] + 1, dtype=np.uint16), [], [], []
        for k in range(0, len(blocks), _TOGETHER):
            some = blocks[k : k + _TOGETHER]
            ordered = np.sort(some, axis=1)
            first = np.ones(ordered.shape, bool)
            np.not_equal(ordered[:, 1:], ordered[:, :-1], out=first[:, 1:])
            at = first.ravel().nonzero()[0]
            own, start = ordered.ravel().take(at), 0
            sizes.append(np.add.reduce(first, axis=1, dtype=np.int64))
            ids.append(own.astype(np.int64))
            counts.append(np.diff(at, append=first.size))
            for row, block, n in zip(out[k : k + _TOGETHER], some, sizes[-1].tolist(), strict=True):
                number[own[start : start + n]] = up[:n]
                number.take(block, out=row, mode="clip")
                start += n
        return cls(*map(np.concatenate, (sizes, ids, counts))), out

    def part(self, a: int, b: int) -> _Counts:
        """The table of blocks a to b."""
        own = slice(self.starts[a], self.starts[b - 1] + self.sizes[b - 1])
        return _Counts(self.sizes[a:b], self.ids[own], self.counts[own])

    def packed(self) -> list[np.ndarray]:
        """Words of each block: their number, ids held by section with the bits of their counts, fixed bits, unary rests."""
        lanes, parts = len(self.sizes), len(_EDGES) - 1
        block = np.repeat(np.arange(lanes), self.sizes)
        section = _SECTION.take(self.ids)
        group = block * parts + section
        held = np.bincount(group, minlength=lanes * parts)
        total = np.bincount(group, self.counts - 1, minlength=lanes * parts).astype(np.int64)
        kg = _gap_bits(held.reshape(lanes, parts)).ravel()
        kc = np.minimum(np.frexp((total * 11 >> 4) // np.maximum(held, 1))[1], 3).astype(np.int64)
        opens = np.append(True, group[1:] != group[:-1])
        gap = self.ids - np.where(opens, _EDGES[section], np.append(0, self.ids[:-1] + 1))
        place = np.arange(len(block)) + self.starts[block]  # a block's gaps, then its counts
        value, fixed = np.empty((2, 2 * len(block)), np.int64)
        value[place], fixed[place] = gap, kg[group]
        place += self.sizes[block]
        value[place], fixed[place] = self.counts - 1, kc[group]
        block = np.repeat(np.arange(lanes), 2 * self.sizes)
        rest = (value >> fixed) + 1
        low, unary = np.add.reduceat(fixed, 2 * self.starts), np.add.reduceat(rest, 2 * self.starts)
        words = (16 * (parts + 1) + low + unary + 31) // 32
        base = 32 * (np.cumsum(words) - words)
        bits = np.zeros(32 * int(words.sum()), np.uint8)
        heads = np.concatenate((words[:, None], (held | kc << 14).reshape(lanes, parts)), axis=1).astype(">u2")
        bits[(base[:, None] + np.arange(16 * (parts + 1))).ravel()] = np.unpackbits(heads.view(np.uint8))
        base += 16 * (parts + 1)
        place = np.cumsum(fixed) - fixed + (base - np.cumsum(low) + low)[block]
        more = fixed > 0
        at, some, still = place[more], value[more], fixed[more]
        while len(at):
            bits[at] = some & 1
            still -= 1
            more = still > 0
            at, some, still = at[more] + 1, some[more] >> 1, still[more]
        bits[np.cumsum(rest) - 1 + (base + low - np.cumsum(unary) + unary)[block]] = 1
        found = np.packbits(bits).view(">u4").astype(np.uint32)
        return np.split(found, np.cumsum(words)[:-1])

    @classmethod
    def unpacked(cls, words: list[np.ndarray]) -> tuple[_Counts, np.ndarray]:
        """The table at the start of each block's words, and the words it takes."""
        lanes, parts = len(words), len(_EDGES) - 1
        taken = np.array([int(w[0]) >> 16 for w in words], np.int64)
        bits = np.unpackbits(np.concatenate([w[:n] for w, n in zip(words, taken.tolist(), strict=True)]).astype(">u4").view(np.uint8))
        base = 32 * (np.cumsum(taken) - taken)
        heads = np.packbits(bits[base[:, None] + np.arange(16, 16 * (parts + 1))], axis=1).view(">u2").astype(np.int64)
        held = heads & _NUMBER
        sizes = held.sum(1)
        per = np.concatenate((held, held), axis=1)
        fixed = np.repeat(np.concatenate((_gap_bits(held), heads >> 14), axis=1).ravel(), per.ravel())
        block = np.repeat(np.arange(lanes), 2 * sizes)
        low = np.add.reduceat(fixed, 2 * np.cumsum(sizes) - 2 * sizes)
        base += 16 * (parts + 1)
        place = np.cumsum(fixed) - fixed + (base - np.cumsum(low) + low)[block]
        value = np.zeros(len(block), np.int64)
        some = np.flatnonzero(fixed)
        j = 0
        while len(some):
            value[some] |= bits[place[some] + j].astype(np.int64) << j
            j += 1
            some = some[fixed[some] > j]
        opens, ends = base + low, 32 * np.cumsum(taken)
        marks = np.flatnonzero(np.concatenate([bits[a:b] for a, b in zip(opens.tolist(), ends.tolist(), strict=True)]))
        rest = np.diff(marks, prepend=-1)
        first = np.cumsum(2 * sizes) - 2 * sizes  # the zeros in front of it belong to the block before
        rest[first] = marks[first] - (np.cumsum(ends - opens) - (ends - opens)) + 1
        value += (rest - 1) << fixed
        gaps = _runs(2 * sizes) < sizes[block]
        gap, counts = value[gaps], value[~gaps] + 1
        lengths = held.ravel()
        opens = np.cumsum(lengths) - lengths
        sums = np.append(0, np.cumsum(gap + 1))
        ids = sums[1:] - 1 + np.repeat(np.tile(_EDGES[:-1], lanes) - sums[opens], lengths)
        return cls(sizes, ids, counts), taken


class _Model:
    """The adaptive state of all lanes; coder and decoder step it alike, lane by lane."""

    def __init__(self, counts: _Counts, size: int) -> None:
        lanes = len(counts.sizes)
        self.lanes, self.size, self.stride = lanes, size, int(counts.sizes.max()) + 1
        self.row = np.arange(lanes, dtype=np.int64) * self.stride
        self.left = np.zeros(lanes * self.stride, np.int32)  # occurrences still to come, by number
        self.left[np.repeat(self.row + 1, counts.sizes) + _runs(counts.sizes)] = counts.counts
        # Order 2, then by number its entry of order 1 and its interval of order 0, start and length: who codes a number needs its entry next.
        self.table = np.zeros((lanes << _SLOT_BITS) + 2 * len(self.left), np.int32)
        self.base2, self.base1 = (np.arange(lanes, dtype=np.int64) << _SLOT_BITS).view(U), 2 * self.row + (lanes << _SLOT_BITS)
        self.base0, self.spans = self.base1 + 1, self.table[(lanes << _SLOT_BITS) + 1 :: 2]
        self.logs = np.empty(len(self.left), np.int16)  # of the occurrences still to come, small enough to stay in the cache
        self.weights = np.repeat(np.array(_START, np.int32)[:, None], lanes, axis=1)
        self.bias = np.full(lanes, _BIAS, np.int32)
        self.a, self.hashed = np.zeros(lanes, np.int64), np.zeros(lanes, U)
        self.index, self.x, self.y = np.empty((2, lanes), np.int64), np.empty((3, lanes), np.int32), np.empty((3, lanes), np.int32)
        self.h = np.empty(lanes, U)

    def refresh(self, done: np.ndarray, step: int, inverse: bool) -> None:
        """Order-0 intervals from the occurrences still to come after the numbers ``done`` (by lane); weights back into their bounds."""
        np.clip(self.weights, -_MOST, _MOST, out=self.weights)
        np.clip(self.bias, -_MOST, _MOST, out=self.bias)
        self.total = self.size - step
        self.log_total = _LOG[self.total]
        if inverse:  # the number at each place of the intervals
            self.slots = np.empty(self.lanes * self.total, np.uint16)
            self.slot_row = np.arange(self.lanes, dtype=np.int64) * self.total
            numbers = np.tile(np.arange(self.stride, dtype=np.uint16), min(_STRIP, self.lanes))
        for k in range(0, self.lanes, _STRIP):
            own = slice(k * self.stride, min(k + _STRIP, self.lanes) * self.stride)
            left, some = self.left[own], done[k : k + _STRIP]
            if step:
                left -= np.bincount((some + self.row[: len(some), None]).ravel(), minlength=len(left)).astype(np.int32)
            ends = np.cumsum(left.reshape(-1, self.stride), axis=1, dtype=np.int32).ravel()
            ends -= left
            ends <<= 16
            np.bitwise_or(ends, left, out=self.spans[own])
            _LOG_SHORT.take(left, out=self.logs[own], mode="clip")
            if inverse:
                self.slots[k * self.total : (k + _STRIP) * self.total] = np.repeat(numbers[: len(left)], left)

    def span(self, numbers: np.ndarray) -> np.ndarray:
        """Start (16 bits) and length (16 bits) of the order-0 intervals of one number per lane."""
        where = numbers << 1
        where += self.base0
        return self.table.take(where, mode="clip")

    def predict(self) -> None:
        """A candidate per lane and its probability (12 bits; 16 bits in ``wide``, 0 without a candidate)."""
        h, index = self.h, self.index
        np.multiply(self.a.view(U), _HASH_A, out=h)
        h += self.hashed
        np.right_shift(h, U(64 - _SLOT_BITS), out=index[0].view(U))
        index[0].view(U)[:] += self.base2
        np.add(self.a, self.a, out=index[1])
        index[1] += self.base1
        h >>= U(20)
        self.check = h.astype(np.int32)
        self.check &= _CHECK
        entry = self.table.take(index, mode="clip")
        entry[0] ^= self.check
        entry[0] *= entry[0] <= 0xFFFFFF
        self.cands = cands = entry & _NUMBER
        entry >>= 14
        self.conf = entry
        # Products with truth values: a choice by a mask takes several times as long.
        self.cand = cand = cands[1] * (cands[0] == 0)
        cand += cands[0]
        self.cand64 = cand.astype(np.int64)
        log = self.logs.take(self.cand64 + self.row, mode="clip")
        x = self.x
        _LOGIT.take(entry, out=x[:2], mode="clip")
        x[1] *= cands[1] == cand
        np.subtract(log, self.log_total, out=x[2])
        y = np.multiply(self.weights, x, out=self.y)
        z = y[0] + y[1]
        z += y[2]
        z >>= 14
        z += self.bias
        self.p = _SQUASH.take(z, mode="clip")
        self.p *= log >= 0  # else none is to come
        self.wide = (self.p << 4).astype(U)

    def update(self, s: np.ndarray, s64: np.ndarray, hit: np.ndarray) -> None:
        """Take in the numbers ``s``."""
        err = hit.astype(np.int32)
        err <<= 12
        err -= self.p
        x = self.x
        x *= err
        x >>= _RATE
        self.weights += x
        err >>= 9
        self.bias += err
        state, other = self.conf, s - self.cands
        state += (other == 0) * np.int32(1024)
        entry = _AFTER.take(state, mode="clip")
        other += np.int32(_FRESH << 14)
        other *= entry == 0
        entry += self.cands
        entry += other
        entry[0] ^= self.check
        self.table[self.index] = entry
        np.multiply(self.a.view(U), _HASH_B, out=self.hashed)
        self.a = s64


class _Writer:
    """Range coders of all lanes."""

    def __init__(self, lanes: int, size: int) -> None:
        self.stride = size // 4 + _REFRESH + 200
        self.words = np.zeros(lanes * self.stride, np.uint32)
        self.start = np.arange(lanes, dtype=np.int64) * self.stride
        self.pos = self.start + 1  # a first word takes a carry out of the second
        self.low, self.width = np.zeros(lanes, U), np.full(lanes, (1 << 64) - 1, U)

    def room(self) -> None:
        """Room for the ids up to the next refresh, which take a word each at most, and for the last words."""
        if int((self.pos - self.start).max()) + _REFRESH + 100 > self.stride:
            lanes = len(self.pos)
            words = np.zeros((lanes, 2 * self.stride), np.uint32)
            words[:, : self.stride] = self.words.reshape(lanes, -1)
            start = np.arange(lanes, dtype=np.int64) * 2 * self.stride
            self.pos += start - self.start
            self.words, self.start, self.stride = words.ravel(), start, 2 * self.stride

    def _carry(self, at: np.ndarray) -> None:
        while len(at):
            self.words[at] += np.uint32(1)
            at = at[self.words[at] == 0] - 1

    def put(self, moved: np.ndarray, width: np.ndarray) -> None:
        """Narrow every lane to ``[low + moved, + width)``."""
        low = self.low
        low += moved
        over = (low < moved).nonzero()[0]
        if len(over):
            self._carry(self.pos[over] - 1)
        small = (width < _FULL).nonzero()[0]
        out, where = low[small], self.pos[small]
        self.words[where] = out >> _WORD
        self.pos[small] = where + 1
        low[small] = out << _WORD
        width[small] <<= _WORD
        self.width = width

    def done(self) -> list[np.ndarray]:
        for shift in (32, 0):
            self.words[self.pos] = (self.low >> U(shift)) & U(0xFFFFFFFF)
            self.pos += 1
        return [self.words[a:b] for a, b in zip(self.start.tolist(), self.pos.tolist(), strict=True)]


def encode_blocks(ids: np.ndarray) -> list[np.ndarray]:
    """Words (uint32) of each row of ``ids`` (blocks x block size, below 65536)."""
    lanes, size = ids.shape
    counts, numbers = _Counts.of(ids)
    model, out = _Model(counts, size), _Writer(lanes, size)
    columns = _turned(numbers)
    for t, column in enumerate(columns):
        if t % _REFRESH == 0:
            out.room()
            model.refresh(numbers[:, max(t - _REFRESH, 0) : t], t, False)
            total = U(model.total)
        s, s64 = column.astype(np.int32), column.astype(np.int64)
        model.predict()
        hit = s == model.cand
        missed = hit.astype(U)
        missed -= _ONE  # all bits, or none after a hit
        x = out.width >> _HALF
        x *= model.wide
        unit = out.width - x
        unit //= total
        span = model.span(s64)
        moved = (span >> 16).astype(U)
        moved *= unit
        moved += x
        moved &= missed
        span &= 0xFFFF
        unit *= span.astype(U)
        unit -= x
        unit &= missed
        x += unit
        out.put(moved, x)
        model.update(s, s64, hit)
    heads = [w for k in range(0, lanes, _TOGETHER) for w in counts.part(k, min(k + _TOGETHER, lanes)).packed()]
    return [np.concatenate(pair) for pair in zip(heads, out.done(), strict=True)]


def decode_blocks(words: list[np.ndarray], size: int) -> np.ndarray:
    """The rows that ``encode_blocks`` was given."""
    lanes = len(words)
    read = [_Counts.unpacked(words[k : k + _TOGETHER]) for k in range(0, lanes, _TOGETHER)]
    counts = _Counts(*(np.concatenate([getattr(c, of) for c, _ in read]) for of in ("sizes", "ids", "counts")))
    taken = np.concatenate([n for _, n in read])
    model = _Model(counts, size)
    longest = int(max(len(w) - n for w, n in zip(words, taken.tolist(), strict=True))) + 8
    held = np.zeros((lanes, longest), np.uint32)
    for k, (w, n) in enumerate(zip(words, taken.tolist(), strict=True)):
        held[k, : len(w) - n] = w[n:]
    flat, pos = held.ravel(), np.arange(lanes, dtype=np.int64) * longest + 3
    last = np.arange(1, lanes + 1, dtype=np.int64) * longest - 1  # damaged words can't lead out of their lane
    code = (flat[pos - 2].astype(U) << _WORD) | flat[pos - 1]
    width = np.full(lanes, (1 << 64) - 1, U)
    numbers, out = np.empty((lanes, size), np.uint16), np.empty((min(_REFRESH, size), lanes), np.uint16)
    for t in range(size):
        if t % _REFRESH == 0:
            done = numbers[:, max(t - _REFRESH, 0) : t]
            done[:] = _turned(out)[:, : done.shape[1]]
            model.refresh(done, t, True)
            total = U(model.total)
        model.predict()
        x = width >> _HALF
        x *= model.wide
        hit = code < x
        missed = hit.astype(U)
        missed -= _ONE
        width -= x
        width //= total
        value = code - x
        value //= width
        np.minimum(value, total - U(1), out=value)
        value = value.view(np.int64)
        value += model.slot_row
        s64 = model.slots.take(value, mode="clip").astype(np.int64)
        span = model.span(s64)
        moved = (span >> 16).astype(U)
        moved *= width
        moved += x
        moved &= missed
        code -= moved
        span &= 0xFFFF
        width *= span.astype(U)
        width -= x
        width &= missed
        width += x
        s64 -= model.cand64
        s64 &= missed.view(np.int64)
        s64 += model.cand64
        small = (width < _FULL).nonzero()[0]
        where = pos[small]
        code[small] = (code[small] << _WORD) | flat[where]
        pos[small] = np.minimum(where + 1, last[small])
        width[small] <<= _WORD
        model.update(s64.astype(np.int32), s64, hit)
        out[t % _REFRESH] = s64
    done = numbers[:, (size - 1) // _REFRESH * _REFRESH :]
    done[:] = _turned(out)[:, : done.shape[1]]
    rows = [counts.ids[a : a + n].astype(np.uint16).take(row - np.uint16(1), mode="clip") for a, n, row in zip(counts.starts.tolist(), counts.sizes.tolist(), numbers, strict=True)]
    return np.stack(rows)


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, local_start: int, block: int = BLOCK, lanes: int = LANES) -> bytes:
    """Bytes of one segment: whole documents, their ids in one stream."""
    if len(ids) and int(ids.max()) > 0xFFFF:
        raise ValueError("ids must be below 65536")
    count = -(-len(ids) // block)
    padded = np.zeros(count * block, np.uint16)
    padded[: len(ids)] = ids
    blocks = padded.reshape(count, block)
    words = [w for k in range(0, count, lanes) for w in encode_blocks(blocks[k : k + lanes])]
    known = np.array([d is not None for d in doc_ids], np.uint8)
    names = np.array([d or 0 for d in doc_ids], "<i8")
    directory = np.array(
        [(len(w), zlib.crc32(w.astype("<u4").tobytes()), zlib.crc32(ids[k * block : (k + 1) * block].astype("<u4").tobytes())) for k, w in enumerate(words)], "<u4"
    ).reshape(count, 3)
    body = b"".join((names.tobytes(), known.tobytes(), np.array(lengths, "<u8").tobytes(), directory.tobytes()))
    head = _HEAD.pack(MAGIC, VERSION, 0, len(doc_ids), count, block, local_start)
    return b"".join((head, struct.pack("<I", zlib.crc32(head + body)), body, *(w.astype("<u4").tobytes() for w in words)))


def read_segment(data: bytes, lanes: int = LANES) -> tuple[list[int | None], np.ndarray, np.ndarray, int]:
    """(doc ids, lengths, all ids, local start); raises ValueError on any damage, naming the block."""
    magic, version, _, docs, count, block, local_start = _HEAD.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a segment of this version")
    at, size = _HEAD.size + 4, docs * 17 + count * 12
    if struct.unpack_from("<I", data, _HEAD.size)[0] != zlib.crc32(data[: _HEAD.size] + data[at : at + size]):
        raise ValueError("damaged directory")
    names = np.frombuffer(data, "<i8", docs, at)
    known = np.frombuffer(data, np.uint8, docs, at + docs * 8)
    lengths = np.frombuffer(data, "<u8", docs, at + docs * 9).astype(np.int64)
    directory = np.frombuffer(data, "<u4", count * 3, at + docs * 17).reshape(count, 3)
    at, total, words = at + size, int(lengths.sum()), []
    for k, (n, check, _) in enumerate(directory.tolist()):
        words.append(np.frombuffer(data, "<u4", n, at))
        at += 4 * n
        if len(words[-1]) != n or zlib.crc32(words[-1].tobytes()) != check:
            raise ValueError(f"damaged block {k}")
    parts = [decode_blocks(words[k : k + lanes], block).ravel() for k in range(0, count, lanes)]
    ids = (np.concatenate(parts) if parts else np.zeros(0)).astype("<u4")[:total]
    for k, (_, _, check) in enumerate(directory.tolist()):
        if zlib.crc32(ids[k * block : (k + 1) * block].tobytes()) != check:
            raise ValueError(f"block {k} decodes to other ids")
    return [int(n) if ok else None for n, ok in zip(names, known, strict=True)], lengths, ids, local_start


SEGMENTS = "part int, seq int, n_ids long, path string, at long, bytes long"
#: Input bytes of one task: enough ids to fill the lanes, if there are so many.
TASK, LEAST_TASK = 20 << 20, 4 << 20


def _tasks(docs: DataFrame) -> int:
    """Tasks to write with, from the size Spark estimates; never more than shuffles have."""
    spark = docs.sparkSession
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = min(spark.sparkContext.defaultParallelism, size // LEAST_TASK)
    return max(1, min(max(size // TASK, cores), int(spark.conf.get("spark.sql.shuffle.partitions"))))


def write_ids(docs: DataFrame, path: str, end_id: int = END_ID, block: int = BLOCK, lanes: int = LANES, folder: str | None = None) -> DataFrame:
    """Files of all rows in ascending doc_id order below ``folder`` (default: in the shared folder); their table of segments.

    Ties go by the first 100 characters of the text, then by file and row, so that a doc_id
    that many rows share is spread over tasks; rows without doc_id come last. ``part`` and
    ``seq`` give the order; a segment holds about ``block * lanes`` ids, or one longer
    document. Null texts count as empty. An empty table gives no segments; other columns
    are ignored. ``folder`` must be in a store that pyarrow can write to.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/ids"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        enc, part = encoder(path), TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        name = f"{root}/part-{part:05d}-{uuid.uuid4().hex}.lmix"
        seq, start, names, counts, streams, held, at, file = 0, 0, [], [], [], 0, 0, None
        end = np.array([end_id], "<u2" if end_id <= 0xFFFF else "<u4")

        def flush() -> pa.RecordBatch:
            nonlocal seq, start, names, counts, streams, held, at, file
            ids, streams = np.concatenate(streams), []
            tidy()
            data = pack_segment(names, counts, ids, start, block, lanes)
            file = file or store.open_output_stream(name)
            file.write(data)
            row = {"part": part, "seq": seq, "n_ids": held, "path": name, "at": at, "bytes": len(data)}
            seq, start, names, counts, streams, held, at = seq + 1, start + held, [], [], [], 0, at + len(data)
            return pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_ids", pa.int64()), ("path", pa.string()), ("at", pa.int64()), ("bytes", pa.int64())]))

        for table in gathered(batches):
            ids, offsets = enc.encode(table["text"])
            if not len(ids) or int(ids.max()) <= 0xFFFF:  # larger ids are refused when they are packed
                ids = ids.astype("<u2")
            own, done = table["doc_id"].to_pylist(), 0
            for k, stop in enumerate(offsets[1:].tolist()):
                n = stop - done + 1
                names.append(own[k])
                counts.append(n)
                streams += (ids[done:stop], end)
                done, held = stop, held + n
                if held >= block * lanes:
                    yield flush()
        if names:
            yield flush()
        if file:
            file.close()

    keys = [F.col("doc_id").asc_nulls_last(), F.left("text", F.lit(100)).asc_nulls_first(), F.col("locator").asc()]
    order = located(docs, "doc_id", "text").repartitionByRange(_tasks(docs), *keys).sortWithinPartitions(*keys)
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="1000"):
        written = stage(order.select("doc_id", "text").mapInArrow(run, SEGMENTS), "segments")
    return written.withColumn("folder", F.lit(folder))


def read_ids(segments: DataFrame, lanes: int = LANES) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for row in batch.to_pylist():
                store, _ = fs.FileSystem.from_uri(row["folder"])
                with store.open_input_file(row["path"]) as file:
                    file.seek(row["at"])
                    names, lengths, ids, start = read_segment(file.read(row["bytes"]), lanes)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n : e].data) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(names), pa.int32()), pa.array(names, pa.int64()), pa.array(ends - lengths + start), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["part", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    spark = segments.sparkSession
    # One row per written partition reaches the driver.
    totals = sorted(tuple(r) for r in segments.groupBy("part").agg(F.sum("n_ids"), F.count(F.lit(1))).collect())
    before, base = [], 0
    for part, n, _ in totals:
        before.append((part, base))
        base += n
    # A row is a few numbers, its segment is read in its task: one segment at a time.
    spread = segments.repartitionByRange(max(1, min(sum(k for _, _, k in totals), 10_000)), "part", "seq")
    read = stage(spread.mapInArrow(run, "part int, doc_id long, local long, n_tokens long, ids_crc32 long"), "read")
    starts = F.broadcast(spark.createDataFrame(before, "part int, base long"))
    return read.join(starts, "part").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
