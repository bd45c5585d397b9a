"""Operator 9: SimHash near-duplicates by covering locality-sensitive hashing.

Random vectors m(i) in {0,1}^(r+1), one per bit position, define a mask for each non-zero
v: the positions where <m(i), v> is odd. Any r differing positions leave some v orthogonal
to all of their vectors, so two fingerprints within radius r agree under that mask: every
pair within the radius meets in one of the 2^(r+1) - 1 tables. Within a bucket the real
distances are measured and only a spanning set of links is kept. Buckets above ``BLOCK``
fingerprints are dealt in pairs of blocks, so none is skipped and no task holds one whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.components import components
from loam.llm.shared import grown, located, settings, stage

RADIUS = 4
SHINGLE = 4
SEED = 42
BLOCK = 2048
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_PART = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a whole text, repeats included; 0 if it has no words."""
    import xxhash

    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not words:
        return 0
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(first), _PART):
        hashes = np.array([digest(body[a:b], SEED) for a, b in zip(first[k : k + _PART], last[k : k + _PART], strict=True)], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int((1 << np.arange(64, dtype=object))[ones * 2 > len(first)].sum())


def masks(radius: int = RADIUS, bits: int = 64, seed: int = SEED) -> list[int]:
    """The covering family's masks: one per non-zero vector of ``radius + 1`` bits.

    Every position gets one of the 2^(r+1) - 1 non-zero vectors, each about equally often.
    """
    whole = (1 << (radius + 1)) - 1
    own = np.random.default_rng(seed).permutation(np.arange(bits) % whole) + 1
    return [sum(1 << i for i in range(bits) if bin(int(own[i]) & v).count("1") % 2) for v in range(1, whole + 1)]


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """locator, doc_id, fp (the 64 bits as a signed long) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["locator"], batch["doc_id"], pa.array(fps)], names=["locator", "doc_id", "fp"])

    base = located(docs, "doc_id", "text")
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="1000"):
        return stage(base.select("locator", "doc_id", "text").mapInArrow(run, "locator string, doc_id long, fp long"), "fingerprints")


def spanning(fps: np.ndarray, radius: int = RADIUS, step: int = 1024) -> list[tuple[int, int]]:
    """Links of a forest with the components that all pairs within ``radius`` give."""
    parent = list(range(len(fps)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for k in range(0, len(fps), step):
        near = np.bitwise_count(fps[k : k + step, None] ^ fps[None, k:]) <= radius
        rows, cols = np.nonzero(np.triu(near, 1))
        for i, j in zip((rows + k).tolist(), (cols + k).tolist(), strict=True):
            x, y = find(i), find(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((i, j))
    return out


def _links(radius: int) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(pdf["fp"].to_numpy(np.int64).view(np.uint64))
        pairs = np.array(spanning(fps, radius), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": fps[pairs[:, 0]].view(np.int64), "b": fps[pairs[:, 1]].view(np.int64)})

    return run


def near_links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(a, b): links between distinct fingerprints that give the components of all pairs within ``radius``."""
    keys = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >= 1 << 63 else m)).alias("key")) for k, m in enumerate(masks(radius, seed=seed))])
    tabled = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")
    # Most buckets hold one fingerprint; those end here.
    shared = tabled.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = tabled.join(grown(shared), ["t", "key"])
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("fp", "t"), F.col("blocks")).cast("int")
    dealt = (
        met.withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("fp", "t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    return dealt.groupBy("t", "key", "i", "j").applyInPandas(_links(radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """locator, doc_id, fp, root, component_id: one row per row of ``docs``; root names the component.

    component_id is the smallest doc_id that links of at most ``radius`` differing bits
    reach, the row's own included; rows without doc_id are linked like others and have a
    null component only if none of theirs has one. Null, empty and blank texts have
    fingerprint 0. Equal fingerprints are one node. Empty tables give no rows; other
    columns are ignored.
    """
    prints = fingerprints(docs, shingle)
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    links = stage(near_links(nodes.select("fp"), radius), "links")
    roots = components(links)
    rooted = stage(
        nodes.join(grown(roots), nodes["fp"] == roots["node"], "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root")), "rooted"
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(grown(least), "root").select("fp", "root", "component_id")
    return prints.join(grown(named), "fp")


def representatives(found: DataFrame) -> DataFrame:
    """One row of each component: the smallest doc_id; of rows that share it, and in components without any, the first locator.

    ``min`` over a struct is aggregated before the shuffle, so a huge component is no hot spot.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")).alias("first")
    return found.groupBy("root").agg(first).select("first.doc_id", "first.locator")


def hex_fingerprint(fp: str = "fp"):
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
