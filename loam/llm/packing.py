"""Operator 3: best-fit packing with swap-based local search.

Documents are tokenised once and cut into pieces. Pieces are dealt into groups of bounded
size; in each group a best-fit start is improved by exchanges between underfull bins:
a piece moves, one is swapped for one, or two for one, always out of an emptier bin and
into a fuller one, so the sum of squared fills rises until bins empty. The search ends when
no underfull bin has an improving exchange, or a lower bound on the bins is met. The
emptiest bins of a group, a bounded number of pieces, meet those of others level by level.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.shared import settings, stage
from loam.llm.tokens import encoder, gathered

CAPACITY = 2048
END_ID = 0
#: Pieces of one group on average, and groups whose residues meet in one group of the next level.
GROUP = 16_384
FAN = 64
#: Pieces that a group may always send on.
RESIDUE = 8
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_DEALT = PIECES + ", part int, row long"
_OUT = _DEALT + ", bucket long, sequence_id long, offset long, open boolean"


def cut(total: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones after a first that may be shorter."""
    first = total % capacity or capacity
    starts = [0, *range(first, total, capacity)]
    return [(s, (first if k == 0 else capacity)) for k, s in enumerate(starts)]


def tokenised(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``PIECES`` of every row: ids of the whole text, the end id, cut to ``capacity``; with task and number in it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, count = encoder(path), TaskContext.get().partitionId(), 0
        for part in gathered(batches):
            ids, offsets = enc.encode(part["text"])
            rows = []
            for doc_id, a, b in zip(part["doc_id"].to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                rows += [(doc_id, k, s, n, zlib.crc32(own[s : s + n].data)) for k, (s, n) in enumerate(cut(len(own), capacity))]
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            place = [pa.array([task] * len(rows), pa.int32()), pa.array(range(count, count + len(rows)), pa.int64())]
            count += len(rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)] + place, names=[c.split()[0] for c in _DEALT.split(", ")])

    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="1000"):
        return stage(docs.select("doc_id", "text").mapInArrow(run, _DEALT), "pieces")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best fit in order of decreasing size: each item into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_slack: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        n = sizes[i]
        fits = mask >> n
        if fits:
            slack = n + (fits & -fits).bit_length() - 1
            b = by_slack[slack].pop()
            if not by_slack[slack]:
                mask ^= 1 << slack
            bins[b].append(i)
        else:
            slack, b = capacity, len(bins)
            bins.append([i])
        left = slack - n
        if left:
            if not by_slack[left]:
                mask |= 1 << left
            by_slack[left].append(b)
    return bins


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: by total size, and by pieces too large to share (Martello and Toth)."""
    count = np.bincount(sizes, minlength=capacity + 1)
    many, total = np.cumsum(count), np.cumsum(count * np.arange(capacity + 1))
    half = capacity // 2
    k = np.arange(1, half + 1)
    large = len(sizes) - many[half]  # more than half a bin each: two never share
    # Pieces from k to half a bin fit only beside large ones of at most capacity - k.
    beside = many[capacity - k] - many[half]
    room = beside * capacity - (total[capacity - k] - total[half])
    rest = total[half] - total[k - 1] - room
    more = np.maximum(-(-rest // capacity), 0)
    return int(max(-(-int(sizes.sum()) // capacity), large + more.max(initial=0)))


class _Search:
    """Local search over the underfull bins of one group."""

    def __init__(self, sizes: np.ndarray, bins: list[list[int]], capacity: int) -> None:
        self.size, self.capacity = sizes, capacity
        self.bin_of = np.full(len(sizes), -1, np.int64)
        self.bins = [set(b) for b in bins]
        for b, items in enumerate(bins):
            self.bin_of[items] = b
        self.fill = np.array([sizes[b].sum() if b else 0 for b in bins], np.int64)
        self.items = np.array([i for b, items in enumerate(bins) if self.fill[b] < capacity for i in items], np.int64)

    def _move(self, item: int, to: int) -> None:
        old = self.bin_of[item]
        self.bins[old].discard(item)
        self.bins[to].add(item)
        self.bin_of[item] = to
        self.fill[old] -= self.size[item]
        self.fill[to] += self.size[item]

    def _exchange(self, source: int) -> bool:
        """The best move, one-for-one or two-for-one exchange out of ``source`` into a fuller bin, if there is one.

        What a bin gets back has size t (0: a plain move), and the bin can then hold up to
        t + slack instead. For each size g given, the least t with t + slack >= g gains most.
        """
        capacity = self.capacity
        fuller = (self.fill >= self.fill[source]) & (self.fill < capacity) & (self.fill > 0)
        fuller[source] = False
        targets = np.flatnonzero(fuller)
        if not len(targets):
            return False
        home = self.bin_of[self.items]
        theirs = self.items[fuller[home]]
        back = np.concatenate((np.zeros(len(targets), np.int64), self.size[theirs]))
        reach = np.concatenate((capacity - self.fill[targets], capacity - self.fill[self.bin_of[theirs]] + self.size[theirs]))
        least = np.full(capacity + 2, capacity + 1)
        np.minimum.at(least, reach, back)
        least = np.minimum.accumulate(least[::-1])[::-1]  # by the size given
        own = sorted(self.bins[source], key=lambda i: (-self.size[i], i))
        by_size: dict[int, list[int]] = {}
        for i in own:
            by_size.setdefault(int(self.size[i]), []).append(i)
        kinds = list(by_size)  # different sizes add up to a bin at most: there are few
        gives = [(n, (by_size[n][0],)) for n in kinds]
        for k, n in enumerate(kinds):
            if len(by_size[n]) > 1:
                gives.append((2 * n, tuple(by_size[n][:2])))
            gives += [(n + m, (by_size[n][0], by_size[m][0])) for m in kinds[k + 1 :]]
        given = np.array([n for n, _ in gives])
        gain = given - least[given]
        best = int(gain.argmax())
        if gain[best] <= 0:
            return False
        size, give = gives[best]
        fits = np.flatnonzero((back == least[size]) & (reach >= size))
        chosen = int(fits[np.argmin(reach[fits])])  # the tightest of them
        to = int(targets[chosen]) if chosen < len(targets) else int(self.bin_of[theirs[chosen - len(targets)]])
        for i in give:
            self._move(i, to)
        if chosen >= len(targets):
            self._move(int(theirs[chosen - len(targets)]), source)
        return True

    def run(self) -> list[list[int]]:
        """Rounds over the underfull bins, the emptiest first, until none has an exchange or no bin less could do.

        Every exchange raises the sum of squared fills, so the search ends.
        """
        least = lower_bound(self.size, self.capacity)
        used, improved = int((self.fill > 0).sum()), True
        while improved and used > least:
            improved = False
            tried = np.zeros(len(self.fill), bool)
            while used > least:
                able = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity) & ~tried)
                if not len(able):
                    break
                source = int(able[np.argmin(self.fill[able])])
                if self._exchange(source):
                    improved = True
                    used -= not self.fill[source]
                else:
                    tried[source] = True
        return [sorted(b) for b in self.bins if b]


def pack(sizes: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers: best fit, then local search."""
    return _Search(sizes, best_fit(sizes.tolist(), capacity), capacity).run()


def _level(depth: int, final: bool, capacity: int, residue: int) -> Callable:
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "part", "row"], kind="stable").reset_index(drop=True)
        sizes = pdf["length"].to_numpy(np.int64)
        bins = pack(sizes, capacity)
        seq, off, op = (np.zeros(len(sizes), np.int64) for _ in range(3))
        first = ((depth << 40) + int(key[0])) << 20
        for k, items in enumerate(bins):
            at = np.cumsum(sizes[items])
            seq[items], off[items] = first + k, at - sizes[items]
        left = 0 if final else residue
        for items in sorted(bins, key=lambda b: int(sizes[b].sum())):  # the emptiest, with a bounded number of pieces
            left -= len(items)
            if left < 0 or int(sizes[items].sum()) == capacity:
                break
            op[items] = 1
        return pdf.assign(bucket=pdf["bucket"] // FAN, sequence_id=seq, offset=off, open=op.astype(bool))[[c.split()[0] for c in _OUT.split(", ")]]

    return run


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """``PIECES`` plus sequence_id and offset, one row per piece of every row of ``docs``.

    Null texts count as empty and still hold the end id. Rows that repeat are packed each
    on its own; rows without doc_id too. An empty table gives no rows. Other columns are
    ignored. Sequence ids are unique, offsets gapless from 0. Pieces are dealt by their place
    in the table, so that no key is hot; a group of any level holds about ``group`` pieces.
    """
    pieces = tokenised(docs, path, capacity, end_id)
    groups = max(1, -(-pieces.count() // group))
    todo = pieces.withColumn("bucket", F.pmod(F.xxhash64("part", "row"), F.lit(groups)))
    depth, parts = 0, []
    while True:
        final = groups == 1
        level = stage(todo.groupBy("bucket").applyInPandas(_level(depth, final, capacity, max(group // FAN, RESIDUE)), _OUT), f"level{depth}")
        parts.append(level.where("NOT open").drop("bucket", "open", "part", "row"))
        if final:
            break
        todo = level.where("open").drop("sequence_id", "offset", "open")
        groups, depth = -(-groups // FAN), depth + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
