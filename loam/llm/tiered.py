"""Operator 11: ranked lexical search over a tiered index of impacts.

The index holds blocks of documents. In a block each term's postings are ordered by impact
and cut in tiers; a tier ends with the largest impact left below it, the residual bound. A
search reads the first tier of every block, takes from the partial sums (which no score is
below) a bar for each item, then goes through the blocks again: where an item's largest
possible score in a block is under the bar the block is settled, else the item falls through
to the next tiers of that block, the last of which is exact. Files without any open block
aren't read below the first tier.

Blocks are made where the documents are read, so building shuffles nothing; searching
shuffles a few best rows per task and item.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loam.llm.shared import ROW, numbered, settings, shared_dir, stage

TOP = 10
#: A block of the index: at most so many documents and, but for a single longer text, bytes.
BLOCK_DOCS, BLOCK_BYTES = 4096, 2 << 20
#: Parts of a term's postings in a block that end the first and second tier, and their least lengths.
TIERS = ((16, 4), (4, 16))
#: Items go in blocks whose texts have at most so many bytes; a block is what tasks are sent.
ITEM_BYTES = 1 << 20
PARTS = 64
#: Rows that are handed to Python at once: documents, and blocks.
DOCS_AT_ONCE, BLOCKS_AT_ONCE = "1000", "8"
#: Blocks in a row group of a file; by its bytes alone a writer first looks after 100 of them.
GROUP_BLOCKS = 8

_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_FOLD_BYTES = _FOLD.tobytes()

_TIER_COLUMNS = [f"{c}_{k}" for k in (1, 2, 3) for c in ("start", "docs", "impact", "rest")]
INDEX = "part int, ids array<long>, row_no array<long>, row_file array<long>, terms binary, df binary, " + ", ".join(f"{c} binary" for c in _TIER_COLUMNS)
_FOUND = "item long, item_id long, doc_id long, row_no long, row_file long, score long"


@dataclass(frozen=True)
class Index:
    """The stored blocks, and the counts all impacts rest on."""

    path: str
    spark: SparkSession
    n_docs: int
    n_terms: int

    def blocks(self, *columns: str) -> DataFrame:
        return self.spark.read.schema(INDEX).parquet(self.path).select(*columns)


def terms_of(text: str | None) -> set[bytes]:
    """The distinct terms of a text."""
    return set((text or "").encode("utf-8", "surrogatepass").translate(_FOLD_BYTES).split())


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of an array of strings; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(folded bytes, starts of terms, ends); no term crosses a document."""
    folded = _FOLD[data]
    inside = folded != 32
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begins[firsts] = inside[firsts]
    ends = inside.copy()
    ends[:-1] &= begins[1:] | ~inside[1:]
    return folded, np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for batch in batches:
        data, offsets = _bytes_of(batch.column(0))
        at = 0
        while at < len(batch):  # whole documents, a block's bytes at a time
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
            some = offsets[at : stop + 1] - offsets[at]
            per = np.diff(np.searchsorted(_runs(data[offsets[at] : offsets[stop]], some)[1], some))
            docs, terms, at = docs + int((per > 0).sum()), terms + int(per.sum()), stop
    yield pa.RecordBatch.from_arrays([pa.array([docs], pa.int64()), pa.array([terms], pa.int64())], ["docs", "terms"])


def _block(table: pa.Table, n_docs: int, n_terms: int, part: int) -> dict | None:
    """One row of the index from some documents."""
    data, offsets = _bytes_of(table["text"].combine_chunks())
    folded, starts, ends = _runs(data, offsets)
    if not len(starts):
        return None
    per = np.diff(np.searchsorted(starts, offsets))
    held = np.flatnonzero(per)  # documents without a term are left out
    n = per[held].astype(np.int64)
    doc = np.repeat(np.arange(len(held)), n)
    ends_of_terms = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=ends_of_terms[1:])
    raw = folded[folded != 32].tobytes()
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends_of_terms), pa.py_buffer(raw)]).dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    keys, tf = np.unique(code * len(held) + doc, return_counts=True)
    code, doc = keys // len(held), keys % len(held)
    m = 10 + (90 * n * n_docs) // n_terms
    tf = tf.astype(np.int64)
    impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
    order = np.lexsort((doc, -impact, code))
    code, doc, impact = code[order], doc[order], impact[order]
    size = len(coded.dictionary)
    df = np.bincount(code, minlength=size)
    first = np.cumsum(df) - df
    rank = np.arange(len(code)) - first[code]
    cuts = [np.minimum(df, np.maximum(least, -(-df // share))) for share, least in TIERS] + [df]
    row = {
        "part": part,
        "terms": b" ".join(coded.dictionary.to_pylist()),
        "df": df.astype("<u4").tobytes(),
        **{c: table[c].take(pa.array(held)).to_pylist() for c in ROW},
        "ids": table["doc_id"].take(pa.array(held)).to_pylist(),
    }
    low = np.zeros(size, np.int64)
    for k, high in enumerate(cuts, 1):
        mine = (rank >= low[code]) & (rank < high[code])
        rest = np.zeros(size, "<u4")
        more = high < df
        rest[more] = impact[(first + high)[more]]
        row |= {f"start_{k}": np.concatenate([[0], np.cumsum(high - low)]).astype("<u4").tobytes(), f"docs_{k}": doc[mine].astype("<u2").tobytes(), f"impact_{k}": impact[mine].astype("<u4").tobytes(), f"rest_{k}": rest.tobytes()}
        low = high
    return row


def build(docs: DataFrame) -> Index:
    """Index every row of ``docs`` (doc_id, text) with at least one term.

    Null and empty texts have no term and are in no block; rows that repeat, also with one
    doc_id or none, are documents of their own. A text longer than a block makes one alone.
    """
    spark = docs.sparkSession
    base = numbered(docs, "doc_id", "text")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=DOCS_AT_ONCE):
        total = base.select("text").mapInArrow(_count, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0
    arrow = pa.schema([("part", pa.int32()), *[(c, pa.list_(pa.int64())) for c in ("ids", *ROW)], *[(c, pa.binary()) for c in ("terms", "df", *_TIER_COLUMNS)]])

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % PARTS
        held, rows, size = [], 0, 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            lengths = np.cumsum(pc.fill_null(pc.binary_length(table["text"]), 0).to_numpy().astype(np.int64))
            at = 0
            while at < len(table):
                before = lengths[at - 1] if at else 0
                fits = int(np.searchsorted(lengths, before + BLOCK_BYTES - size, "right"))
                stop = min(fits, at + BLOCK_DOCS - rows, len(table))
                if stop <= at and not rows:
                    stop = at + 1
                if stop > at:
                    held.append(table.slice(at, stop - at))
                    rows, size, at = rows + stop - at, size + int(lengths[stop - 1] - before), stop
                if at < len(table):
                    yield from emit(held, part)
                    held, rows, size = [], 0, 0
        if held:
            yield from emit(held, part)

    def emit(tables: list[pa.Table], part: int) -> Iterator[pa.RecordBatch]:
        row = _block(pa.concat_tables(tables), n_docs, n_terms, part)
        if row is not None:
            yield pa.RecordBatch.from_pylist([row], schema=arrow)

    path = f"{shared_dir(spark)}/tiers"
    # Small row groups: a reader holds one of them, not all blocks of a file.
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=DOCS_AT_ONCE):
        base.mapInArrow(blocks, INDEX).write.option("parquet.block.size", 16 << 20).option("parquet.block.row.count.limit", GROUP_BLOCKS).partitionBy("part").parquet(path)
    return Index(path, spark, n_docs, n_terms)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Blocks one at a time; a batch holds many."""
    for k in range(len(batch)):
        yield batch.slice(k, 1).to_pylist()[0]


class Tiers:
    """A block's postings of the terms that are asked for."""

    def __init__(self, row: dict, words: list[bytes], tiers: int) -> None:
        self.n = len(row["ids"])
        there = pc.index_in(pa.array(words, pa.binary()), value_set=pa.array(row["terms"].split(b" "), pa.binary()))
        self.code = there.fill_null(-1).to_numpy()
        self.tiers = [[np.frombuffer(row[f"{c}_{k}"], kind) for c, kind in (("start", "<u4"), ("docs", "<u2"), ("impact", "<u4"), ("rest", "<u4"))] for k in range(1, tiers + 1)]

    def settle(self, terms: np.ndarray, weights: np.ndarray, bar: int) -> tuple[int, np.ndarray]:
        """(tier, sums over the tiers read): stops at the tier that proves all scores under ``bar``, 0 if no term occurs."""
        code = self.code[terms]
        here = code >= 0
        code, weight = code[here].tolist(), weights[here].tolist()
        sums, below = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        if not code:
            return 0, sums
        for k, (start, docs, impact, rest) in enumerate(self.tiers, 1):
            # ``below`` sums, over the terms met in a document, the residuals that no longer
            # count for it; a term's residual shrinks from tier to tier.
            total = 0
            if k > 1:
                below[:] = 0
            for c, w in zip(code, weight, strict=True):
                left = w * int(rest[c])
                total += left
                if left:
                    for i in range(k):
                        s, d = self.tiers[i][0], self.tiers[i][1]
                        below[d[s[c] : s[c + 1]]] += left
                span = slice(start[c], start[c + 1])
                sums[docs[span]] += w * impact[span].astype(np.int64)
            if int((sums - below).max()) + total < bar:
                return k, sums
        return len(self.tiers) + 1, sums


def _items(items: DataFrame) -> Iterator[list[tuple[int, int | None, set[bytes]]]]:
    """Blocks of (number, item_id, terms), each of bounded size; the driver holds one at a time."""
    block, size = [], 0
    for k, row in enumerate(items.select("item_id", "text").toLocalIterator()):
        block.append((k, row["item_id"], terms_of(row["text"])))
        size += len(row["text"] or "") * 4
        if size >= ITEM_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _search_block(index: Index, items: list[tuple[int, int | None, set[bytes]]], top: int) -> DataFrame | None:
    spark = index.spark
    words = sorted(set().union(*(t for _, _, t in items)))
    if not words or not index.n_docs:
        return None
    place = {w: k for k, w in enumerate(words)}

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words), np.int64)
        for batch in batches:
            for row in _rows(batch):
                code = pc.index_in(pa.array(words, pa.binary()), value_set=pa.array(row["terms"].split(b" "), pa.binary()))
                code = code.fill_null(-1).to_numpy()
                total[code >= 0] += np.frombuffer(row["df"], "<u4")[code[code >= 0]]
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["word", "df"])

    counted = index.blocks("terms", "df").mapInArrow(frequencies, "word long, df long").groupBy("word").agg(F.sum("df").alias("df"))
    weight = {r["word"]: math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * r["df"] + 1))) for r in counted.collect()}
    asked = []
    for number, item_id, terms in items:
        codes = np.array(sorted(k for k in map(place.get, terms) if weight.get(k)), np.int64)
        if len(codes):
            asked.append((number, item_id, codes, np.array([weight[k] for k in codes.tolist()], np.int64)))

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: [] for number, *_ in asked}
        for batch in batches:
            for row in _rows(batch):
                tiers = Tiers(row, words, 1)
                for number, _, codes, weights in asked:
                    sums = tiers.settle(codes, weights, 0)[1]
                    if len(sums) > top:
                        sums = np.partition(sums, len(sums) - top)[-top:]
                    best[number] = heapq.nlargest(top, best[number] + [s for s in sums.tolist() if s > 0])
        flat = [(n, s) for n, found in best.items() for s in found]
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in flat], pa.int64()), pa.array([s for _, s in flat], pa.int64())], ["item", "low"])

    low = index.blocks("ids", "terms", "start_1", "docs_1", "impact_1", "rest_1").mapInArrow(first, "item long, low long")
    ordered = Window.partitionBy("item").orderBy(F.desc("low"))
    bars = {r["item"]: r["low"] for r in low.withColumn("nth", F.row_number().over(ordered)).where(F.col("nth") <= top).where(F.col("nth") == top).collect()}

    def open_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts of the index in which some item lacks proof after the first tier."""
        found = set()
        for batch in batches:
            for row in _rows(batch):
                if row["part"] not in found:
                    tiers = Tiers(row, words, 1)
                    if any(tiers.settle(codes, weights, max(1, bars.get(number, 0)))[0] > 1 for number, _, codes, weights in asked):
                        found.add(row["part"])
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], ["part"])

    left = index.blocks("part", "ids", "terms", "start_1", "docs_1", "impact_1", "rest_1").mapInArrow(open_parts, "part int").distinct()
    parts = [r["part"] for r in left.collect()]

    def deeper(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: [] for number, *_ in asked}
        for batch in batches:
            for row in _rows(batch):
                tiers, ids = Tiers(row, words, 3), row["ids"]
                for number, _, codes, weights in asked:
                    held = best[number]
                    bar = max(1, bars.get(number, 0), held[-1][0] if len(held) == top else 0)
                    level, sums = tiers.settle(codes, weights, bar)
                    if level <= 3:
                        continue
                    # Best first; equal scores by doc_id, those without one last, then by row.
                    found = [(int(sums[d]), ids[d] is None, ids[d] or 0, row["row_file"][d], row["row_no"][d]) for d in np.flatnonzero(sums >= bar).tolist()]
                    best[number] = heapq.nsmallest(top, held + found, key=lambda f: (-f[0], *f[1:]))
        flat = [(number, item_id, None if f[1] else f[2], f[4], f[3], f[0]) for number, item_id, *_ in asked for f in best[number]]
        columns = list(zip(*flat, strict=True)) if flat else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["item", "item_id", "doc_id", "row_no", "row_file", "score"])

    columns = ["ids", "row_no", "row_file", "terms", *_TIER_COLUMNS]
    return index.blocks("part", *columns).where(F.col("part").isin(parts)).select(*columns).mapInArrow(deeper, _FOUND)


def search(index: Index, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of each row of ``items`` (item_id, text).

    Equal scores come by ascending doc_id, rows without one last, then by their place in the
    table. Only scores above 0 count. Items that are null, empty or share no term with any
    document give no row; items that repeat are ranked each on its own. Other columns are
    ignored, empty tables give no rows.
    """
    with settings(index.spark, spark__sql__execution__arrow__maxRecordsPerBatch=BLOCKS_AT_ONCE):
        found = [stage(f, "found") for f in (_search_block(index, block, top) for block in _items(items)) if f is not None]
    if not found:
        return index.spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row_file", "row_no")
    ranked = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
