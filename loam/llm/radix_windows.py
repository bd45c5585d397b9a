"""Operator 12: repeated byte windows by most-significant-digit passes over sparse suffixes.

Of all suffixes only those at synchronising positions are looked at: for each window of
``DEPTH`` bytes the place of its least hashed 8-byte word, a function of the window's bytes
alone. Equal windows thus hold the same suffix at the same offset, and a window is read from
there, its left part last, and compared digit by digit, most significant first:

1. the first ``DIGIT`` bytes of the suffixes; groups of one leave. A bit table of bounded
   size tells the tasks which suffixes may be left (it may keep too many, never too few).
2. the stretch of text whose windows share the suffix: copies fall into one group, of which
   the first stays as a representative, and all windows of the others are repeats.
3. where several stretches share the first digit, the remaining digits of each window of
   their representatives, in words of 8 bytes; the order ends at ``DEPTH``, and the groups
   that are left are exactly the repeated windows. The stretches of one first digit meet in
   one task, up to ``GROUP`` of them. Beyond that the digit is hot: its windows are grouped by
   a digest of all their digits, and a group is reduced to its first before the shuffle.

Passes over tasks group by digests of 128 bits, so no range of values can be hot either.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.llm.shared import ROW, numbered, stage

DEPTH, DIGIT = 100, 24
#: Text handled at once by a task, in bytes (a longer document is handled alone).
CHUNK = 4 << 20
#: Bits of the table of suffixes that may repeat, at most; 16 per suffix below that.
TABLE_BITS = 1 << 28
#: Distinct stretches that share a first digit and are compared in one task, at most.
GROUP = 4096
#: Stretches that a task compares at once, beside those of its last digit.
SOME = 1 << 14
_WORD_BITS = 14  # words of 64 bits in a row of the table, as a power of two

_U = np.uint64
_C = [_U(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_HIGH, _LOW = _U(0xFFFFFFFF00000000), _U(0xFFFFFFFF)


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as a number; ``data`` has 8 spare bytes at its end."""
    return np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))


def _mixed(h: np.ndarray, word: np.ndarray, c: np.uint64) -> np.ndarray:
    h = (h ^ word) * c
    return (h ^ (h >> _U(29))) * _C[0]


def _digest(words: np.ndarray, at: np.ndarray, length: np.ndarray | int, seed: int, c: np.uint64) -> np.ndarray:
    """64 bits of ``length`` (8 or more) bytes from each of ``at`` on."""
    length = np.broadcast_to(np.asarray(length, np.int64), at.shape)
    h = length.astype(_U) * _C[1] + _U(seed)
    for k in range(int(length.max(initial=0)) // 8):
        full = 8 * k + 8 <= length
        if full.all():
            h = _mixed(h, words[at + 8 * k], c)
        else:
            h[full] = _mixed(h[full], words[at[full] + 8 * k], c)
    h = _mixed(h, words[at + length - 8], c)
    return h ^ (h >> _U(32))


def _suffixes(data: np.ndarray, offsets: np.ndarray, depth: int, digit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window) of the synchronising positions; each window has one, neighbours share it."""
    words, span = _words(data), depth - digit + 1
    if len(words) < span:
        return (np.zeros(0, np.int64),) * 3
    least = words * _C[0]
    least &= _HIGH
    least |= np.arange(len(words), dtype=_U)
    width = 1
    while 2 * width <= span:  # the least of ``width`` neighbours, doubled
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: -(span - width)], least[span - width :])
    # Windows that lie in one document.
    edge = np.zeros(len(data) + 1, np.int8)
    long = np.diff(offsets) >= depth
    np.add.at(edge, offsets[:-1][long], 1)
    np.add.at(edge, offsets[1:][long] - depth + 1, -1)
    x = np.flatnonzero(np.cumsum(edge, dtype=np.int8))
    if not len(x):
        return (np.zeros(0, np.int64),) * 3
    place = (least[x] & _LOW).astype(np.int64)
    new = np.flatnonzero(place[1:] != place[:-1]) + 1
    return place[np.concatenate([[0], new])], x[np.concatenate([[0], new])], x[np.concatenate([new - 1, [len(x) - 1]])]


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes with 8 to spare, offsets) of whole documents, about ``CHUNK`` bytes each."""
    texts = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        data = np.zeros(offsets[stop] - offsets[at] + 8, np.uint8)
        data[:-8] = raw[offsets[at] : offsets[stop]]
        yield at, data, offsets[at : stop + 1] - offsets[at]
        at = stop


def bit_table(keys: DataFrame, limit: int = TABLE_BITS) -> bytes:
    """A table of 2^n bits, at most ``limit``, with the low bits of each ``key`` set; the driver gets only the table."""
    n = keys.count()
    bits = min(limit, max(1 << (_WORD_BITS + 6), 1 << (16 * n).bit_length()))
    low = F.col("key").bitwiseAND(bits - 1)
    words = keys.select(F.shiftright(low, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), low.bitwiseAND(63).cast("int")).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))

    def fill(group: pa.Table) -> pa.Table:
        block = np.zeros(1 << _WORD_BITS, np.int64)
        block[group["word"].to_numpy() & ((1 << _WORD_BITS) - 1)] = group["bits"].to_numpy()
        return pa.table({"block": [int(group["word"][0].as_py()) >> _WORD_BITS], "content": pa.array([block.tobytes()], pa.binary())})

    blocks = words.groupBy(F.shiftright("word", _WORD_BITS)).applyInArrow(fill, "block long, content binary")
    table = bytearray(bits // 8)
    for row in blocks.toLocalIterator():
        start = row["block"] << (_WORD_BITS + 3)
        table[start : start + len(row["content"])] = row["content"]
    return bytes(table)


def _there(table: bytes, key: np.ndarray) -> np.ndarray:
    low = key & _U(len(table) * 8 - 1)
    return (np.frombuffer(table, "<u8")[(low >> _U(6)).astype(np.int64)] >> (low & _U(63))) & _U(1) == 1


def _place(start: str) -> Column:
    """Order of windows: doc_id (none last), row, start."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW, F.col(start).alias("start"))


def _place_key(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_placed(*(batch.column(c).to_numpy() for c in (*ROW, "start"))).view(np.int64))], ["key"])


def _placed(row_no: np.ndarray, row_file: np.ndarray, start: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(row_file.view(_U), row_no.view(_U), _C[2]), start.astype(np.int64).view(_U), _C[3])


class _Windows:
    """All windows of some stretches, in the order of the stretches."""

    def __init__(self, content: pa.Array, depth: int) -> None:
        self.words = _words(np.frombuffer(b"".join(content.to_pylist()) + bytes(8), np.uint8))
        length = pc.binary_length(content).to_numpy().astype(np.int64)
        n = length - depth + 1
        self.row = np.repeat(np.arange(len(n)), n)
        self.inner = np.arange(len(self.row)) - np.repeat(np.cumsum(n) - n, n)
        self.at = (np.cumsum(length) - length)[self.row] + self.inner


def radix_groups(words: np.ndarray, at: np.ndarray, offset: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows, group of each) that are equal to another one of their ``group``, by digits from ``offset`` on.

    Windows keep their order within a group. A pass sorts the groups whose digits differ, and
    groups of one leave after each pass.
    """
    places = np.minimum(np.arange(-(-depth // 8)) * 8, depth - 8)
    index = np.argsort(group, kind="stable")
    group = group[index]

    def parted(index: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins = np.flatnonzero(new)
        size = np.diff(np.append(begins, len(index)))
        keep = np.repeat(size > 1, size)
        return index[keep], np.repeat(np.arange((size > 1).sum()), size[size > 1])

    index, group = parted(index, np.append(True, group[1:] != group[:-1])[: len(index)])
    for k in range(len(places)):
        if not len(index):
            break
        digit = words[at[index] + places[(offset[index] // 8 + k) % len(places)]]
        new = group[1:] != group[:-1]
        split = ~new & (digit[1:] != digit[:-1])
        if not split.any():
            continue
        mixed = np.zeros(group[-1] + 1, bool)
        mixed[group[1:][split]] = True
        rows = np.flatnonzero(mixed[group])
        order = rows[np.lexsort((digit[rows], group[rows]))]
        index[rows], digit[rows] = index[order], digit[order]
        index, group = parted(index, np.append(True, new | (digit[1:] != digit[:-1])))
    return index, group


def _later(table: pa.Table, depth: int) -> pa.RecordBatch:
    """Runs of windows that occur in an earlier stretch of the same first digit; stretches are in order."""
    windows = _Windows(table["content"].combine_chunks(), depth)
    keys = table["key"].to_numpy()
    code = np.cumsum(np.append(False, keys[1:] != keys[:-1]))
    offset = table["offset"].to_numpy()[windows.row] - windows.inner
    index, group = radix_groups(windows.words, windows.at, offset, code[windows.row] * (depth + 1) + offset, depth)
    index = np.sort(index[np.append(False, group[1:] == group[:-1])[: len(index)]])
    row, inner = windows.row[index], windows.inner[index]
    new = np.append(True, (row[1:] != row[:-1]) | (inner[1:] != inner[:-1] + 1))[: len(index)]
    last = np.append(new[1:], True)[: len(index)]
    start = table["start"].to_numpy()
    rows = pa.array(row[new])
    return pa.RecordBatch.from_arrays(
        [*[table[c].combine_chunks().take(rows) for c in ROW], *[pa.array(a.astype(np.int32)) for a in (start[row[new]] + inner[new], start[row[last]] + inner[last] + depth)]], [*ROW, "start", "stop"]
    )


def repeats(base: DataFrame, depth: int = DEPTH, digit: int = DIGIT) -> DataFrame:
    """row_no, row_file, start, stop: stretches of windows of ``depth`` bytes that also start earlier.

    ``base`` has doc_id and text of numbered rows.
    """

    def first_digits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in _chunks(batch):
                place, _, _ = _suffixes(data, offsets, depth, digit)
                key, n = np.unique(_digest(_words(data), place, digit, 1, _C[2]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    counted = base.select("text").mapInArrow(first_digits, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    table = bit_table(stage(counted.where("n > 1").select("key"), "digits"))

    def stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in _chunks(batch):
                place, low, high = _suffixes(data, offsets, depth, digit)
                words = _words(data)
                key = _digest(words, place, digit, 1, _C[2])
                left = _there(table, key)
                key, place, low, high = key[left], place[left], low[left], high[left]
                length = high - low + depth
                c1, c2 = (_digest(words, low, length, s, c) ^ (place - low).astype(_U) * _C[1] for s, c in ((2, _C[2]), (3, _C[3])))
                doc = np.searchsorted(offsets, low, "right") - 1
                start = low - offsets[doc]
                columns = [batch.column(c).take(pa.array(doc + row)) for c in ("doc_id", *ROW)]
                numbers = [pa.array(a.view(np.int64)) for a in (key, c1, c2)] + [pa.array(a.astype(np.int32)) for a in (start, start + length)]
                yield pa.RecordBatch.from_arrays([*columns, *numbers], ["doc_id", *ROW, "key", "c1", "c2", "start", "stop"])

    held = stage(base.mapInArrow(stretches, "doc_id long, row_no long, row_file long, key long, c1 long, c2 long, start int, stop int"), "stretches")

    # Second pass: copies of a stretch meet in one group; its first member stands for it.
    firsts = stage(held.groupBy("key", "c1", "c2").agg(F.min(_place("start")).alias("first"), F.count(F.lit(1)).alias("n")), "firsts")
    copies = firsts.where("n > 1").select("c1", "c2", "first")
    whole = held.join(copies, ["c1", "c2"]).where(_place("start") > F.col("first")).select(*ROW, "start", "stop")

    # Third pass: the windows of stretches that share their first digit with others.
    ways = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("ways")).where("ways > 1")
    chosen = stage(firsts.join(ways, "key").select("key", (F.col("ways") > GROUP).alias("hot"), "first.doc_id", *[F.col(f"first.{c}").alias(c) for c in (*ROW, "start")]), "chosen")
    marked = bit_table(chosen.select(*ROW, "start").mapInArrow(_place_key, "key long"))

    def contents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in _chunks(batch):
                place, low, high = _suffixes(data, offsets, depth, digit)
                doc = np.searchsorted(offsets, low, "right") - 1
                start = low - offsets[doc]
                numbers = [batch.column(c).to_numpy()[doc + row] for c in ROW]
                left = _there(marked, _placed(*numbers, start))
                raw, a, b = data.tobytes(), low[left].tolist(), (high[left] + depth).tolist()
                content = pa.array([raw[i:j] for i, j in zip(a, b, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*[pa.array(c[left]) for c in numbers], pa.array(start[left].astype(np.int32)), pa.array((place - low)[left].astype(np.int32)), content], [*ROW, "start", "offset", "content"])

    texts = base.select(*ROW, "text").mapInArrow(contents, "row_no long, row_file long, start int, offset int, content binary")
    met = stage(chosen.join(texts, [*ROW, "start"]), "contents")
    order = ["key", F.col("doc_id").isNull(), "doc_id", *ROW, "start"]

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            keys = table["key"].to_numpy()
            done = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) >= SOME else 0
            at = 0
            while at < done:  # whole digits at a time
                stop = int(np.searchsorted(keys, keys[min(at + SOME, done) - 1], "right"))
                yield _later(table.slice(at, stop - at), depth)
                at = stop
            rest = table.slice(done)
        if rest is not None and len(rest):
            yield _later(rest, depth)

    cold = met.where("NOT hot").select("key", "doc_id", *ROW, "start", "offset", "content").repartition("key").sortWithinPartitions(*order)
    cold = cold.select("key", *ROW, "start", "offset", "content").mapInArrow(compared, "row_no long, row_file long, start int, stop int")

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), SOME):
                part = batch.slice(k, SOME)
                all_of = _Windows(part.column("content"), depth)
                w = [pa.array(_digest(all_of.words, all_of.at, depth, s, c).view(np.int64)) for s, c in ((4, _C[2]), (5, _C[3]))]
                start = part.column("start").to_numpy()[all_of.row] + all_of.inner
                yield pa.RecordBatch.from_arrays([*w, *[part.column(c).take(pa.array(all_of.row)) for c in ("doc_id", *ROW)], pa.array(start.astype(np.int32))], ["w1", "w2", "doc_id", *ROW, "start"])

    hot = stage(met.where("hot").select("doc_id", *ROW, "start", "content").mapInArrow(windows, "w1 long, w2 long, doc_id long, row_no long, row_file long, start int"), "hot")
    equal = hot.groupBy("w1", "w2").agg(F.min(_place("start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = hot.join(equal, ["w1", "w2"]).where(_place("start") > F.col("first")).select(*ROW, "start", (F.col("start") + depth).alias("stop"))
    return whole.unionByName(cold).unionByName(later)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, starts, stops = batch.column("text"), batch.column("starts").to_pylist(), batch.column("stops").to_pylist()
        kept, removed, spans = [], [], []
        for k in range(len(batch)):
            raw = (texts[k].as_py() or "").encode("utf-8", "surrogatepass")
            if not starts[k]:
                kept.append(raw), removed.append(0), spans.append([])
                continue
            order = np.argsort(starts[k], kind="stable")
            s, e = np.array(starts[k])[order], np.maximum.accumulate(np.array(stops[k])[order])
            new = np.concatenate([[True], s[1:] > e[:-1]])
            s, e = s[new].tolist(), e[np.concatenate([new[1:], [True]])].tolist()
            kept.append(b"".join(raw[a:b] for a, b in zip([0, *e], [*s, len(raw)], strict=True)))
            removed.append(sum(e) - sum(s))
            spans.append([{"start": a, "stop": b} for a, b in zip(s, e, strict=True)])
        n = pa.array([len(b) + r for b, r in zip(kept, removed, strict=True)], pa.int64())
        columns = [batch.column("doc_id"), *[batch.column(c) for c in ROW], n, pa.array(removed, pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(kept, pa.binary())], ["doc_id", *ROW, "n_bytes", "n_removed", "spans", "kept"])


def window_dedup(docs: DataFrame, depth: int = DEPTH, digit: int = DIGIT) -> DataFrame:
    """doc_id, row_no, row_file, n_bytes, n_removed, spans (start, stop), kept: one row per row of ``docs``.

    Each byte covered by a ``depth``-byte string that also starts earlier goes; strings are
    judged on the input and lie in one document. Documents are ordered by doc_id, those
    without one last, and rows that repeat, also with one doc_id or none, by their place in
    the table. Null and empty texts have no bytes. A very long text is one chunk of a task.
    ``kept`` is bytes, as a cut may fall inside a character. Empty tables give no rows; other
    columns are ignored.
    """
    base = numbered(docs, "doc_id", "text")
    found = stage(repeats(base, depth, digit), "repeats")
    # Stretches of one document: as many as it has, and runs of windows merged where cut.
    covered = found.groupBy(*ROW).agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    joined = base.join(covered, ROW, "left")
    return joined.select("doc_id", *ROW, "text", "starts", "stops").mapInArrow(
        _cut, "doc_id long, row_no long, row_file long, n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, kept binary"
    )
