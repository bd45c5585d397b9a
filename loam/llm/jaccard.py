"""Operator 9 with an exact check: near duplicates by the Jaccard similarity of word shingles.

Covering SimHash tables (``covering``) give the candidates that its radius guarantees. Texts
that share 80 of 100 five-word shingles differ in up to 17 of 64 SimHash bits on the given
tables, and a covering family of that radius has 2^18 - 1 masks; for those beyond radius 4,
candidates also meet in bands of MinHash values: a pair at the threshold misses all ``BANDS``
bands with probability (1 - 0.8^7)^48, about 1 in 80,000, and more alike pairs more rarely.
Candidates are joined into groups, and within a group every pair is measured on its whole
shingle sets, so no link is below the threshold.

A large group is dealt into blocks, whose pairs a task measures. What is linked in a block
goes on as one leader with a radius, the greatest distance of a text it stands for; the
leaders meet in blocks again, level by level, as long as they become fewer. Jaccard distance
obeys the triangle inequality, so leaders further apart than their radii allow stand for no
similar pair; where they might, and no chain of links has joined both sides in the end, the texts
behind them are measured. Sets of a group of copies or pages of one template thus move
once, and once per level for the few leaders. Leaders that no longer become fewer are
compared in pairs of blocks, as are the texts of doubtful pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.components import components
from loam.llm.covering import _LOWER, _WORD, SEED, fingerprint, near_links
from loam.llm.shared import grown, located, settings, stage, tidy

SHINGLE = 5
#: Least similarity, as a fraction: shared shingles to all shingles of both texts.
SIMILAR = (4, 5)
BANDS, ROWS = 48, 7
BLOCK = 128
_PART = 2048


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a whole text; of all its words if it has fewer."""
    import xxhash

    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not words:
        return np.zeros(0, np.uint64)
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words))) + np.arange(len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(width, len(words))
    first, last, digest = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(body[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, len(first)))


def bands(hashes: np.ndarray, seed: int = SEED) -> np.ndarray:
    """One key per band of MinHash values."""
    import xxhash

    rng = np.random.default_rng(seed)
    flip, factor = rng.integers(0, 1 << 32, (2, BANDS * ROWS, 1), np.uint32)
    factor |= np.uint32(1)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(high), _PART):
        np.minimum(least, ((high[None, k : k + _PART] ^ flip) * factor).min(1), out=least)
    return np.array([xxhash.xxh64_intdigest(b.tobytes()) for b in least.reshape(BANDS, ROWS)], np.uint64).view(np.int64)


def signatures(base: DataFrame) -> DataFrame:
    """locator, doc_id, node (hash of the shingle set), fp (SimHash), bands of every row of ``base``: locator, doc_id, text."""
    import xxhash

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            sets = [shingles(t) for t in texts]
            fps = np.array([fingerprint(t, SHINGLE) for t in texts], np.uint64).view(np.int64)
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            keys = pa.array([bands(s) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["locator"], batch["doc_id"], pa.array(nodes), pa.array(fps), keys], names=["locator", "doc_id", "node", "fp", "bands"])
        tidy()

    with settings(base.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="1000"):
        return stage(base.select("locator", "doc_id", "text").mapInArrow(run, "locator string, doc_id long, node long, fp long, bands array<long>"), "signatures")


#: What a task says: links, leaders that go on, and leaders behind which there may be more links.
LINK, LEADER, MAYBE = 0, 1, 2
_SAID = "kind int, root long, a long, b long, radius double"
#: Distance up to which texts are similar; radii are compared with a little slack, links as whole numbers.
_NEAR, _SLACK = 1 - SIMILAR[0] / SIMILAR[1], 1e-9


def _measured(nodes: np.ndarray, sets: list[np.ndarray], radius: np.ndarray, side: np.ndarray | None) -> tuple[list, list, np.ndarray, np.ndarray]:
    """(links, doubtful pairs, component of each, distances to the component's first), of pairs across sides if there are two."""
    n = len(sets)
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1] if n else np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    ends = np.cumsum(sizes)
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links, doubtful, apart = [], [], np.zeros((n, n), np.float32)
    mark = np.zeros(int(flat.max()) + 1 if len(flat) else 0, bool)
    for i in range(n):
        own = flat[ends[i] - sizes[i] : ends[i]]
        mark[own] = True
        sums = np.concatenate(([0], np.cumsum(mark[flat])))
        mark[own] = False
        both = sums[ends] - sums[ends - sizes]
        union = sizes + sizes[i] - both
        alike = both * SIMILAR[1] >= union * SIMILAR[0]
        apart[i] = 1 - both / np.maximum(union, 1)
        wanted = np.arange(n) > i
        if side is not None:
            wanted &= side != side[i]
        for j in np.flatnonzero(alike & wanted).tolist():
            x, y = find(i), find(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((nodes[i], nodes[j]))
        if radius.any():
            reach = apart[i] - radius - radius[i] <= _NEAR + 1e-6
            doubtful += [(i, j) for j in np.flatnonzero(reach & ~alike & wanted & ((radius > 0) | (radius[i] > 0))).tolist()]
    comp = np.array([find(k) for k in range(n)], np.int64)
    doubtful = [(nodes[i], nodes[j]) for i, j in doubtful if comp[i] != comp[j]]
    return links, doubtful, comp, apart[comp, np.arange(n)].astype(np.float64) if n else np.zeros(0)


def _said(root: int, links: list, doubtful: list, leaders: list) -> pd.DataFrame:
    rows = [(LINK, root, a, b, 0.0) for a, b in links] + [(MAYBE, root, a, b, 0.0) for a, b in doubtful] + [(LEADER, root, a, a, r) for a, r in leaders]
    out = pd.DataFrame(rows, columns=["kind", "root", "a", "b", "radius"])
    return out.astype({"kind": np.int32, "root": np.int64, "a": np.int64, "b": np.int64, "radius": np.float64})


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links within a block, and a leader of each of its components."""
    pdf = pdf.sort_values("node")
    nodes, radius = pdf["node"].to_numpy(np.int64), pdf["radius"].to_numpy(np.float64)
    links, doubtful, comp, far = _measured(nodes, [np.frombuffer(s, np.uint64) for s in pdf["hashes"]], radius, None)
    leaders = []
    for c in np.unique(comp).tolist():
        mine = comp == c
        grown = float((far + radius)[mine].max())
        leaders.append((nodes[c], min(1.0, grown + (_SLACK if mine.sum() > 1 else 0.0))))
    return _said(int(pdf["root"].iloc[0]), links, doubtful, leaders)


def _across(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links within a block, or between two."""
    nodes, side = pdf["node"].to_numpy(np.int64), pdf["own"].to_numpy()
    links, doubtful, _, _ = _measured(nodes, [np.frombuffer(s, np.uint64) for s in pdf["hashes"]], pdf["radius"].to_numpy(np.float64), side if side.min() != side.max() else None)
    return _said(int(pdf["root"].iloc[0]), links, doubtful, [])


def _with_blocks(rows: DataFrame, sized: DataFrame) -> DataFrame:
    """``rows`` plus blocks; only roots of more than one block are joined, so that the sets aren't shuffled by their root."""
    return rows.join(sized.where("blocks > 1").select("root", "blocks"), "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))


def _pairs_of_blocks(rows: DataFrame, sized: DataFrame) -> DataFrame:
    """``rows`` (root, node, hashes, radius) once for each pair of blocks of their root; blocks by ``sized`` (root, blocks)."""
    return (
        _with_blocks(rows, sized).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("root", "node", "hashes", "radius", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .groupBy("root", "i", "j").applyInPandas(_across, _SAID)
    )


def _doubts(maybe: DataFrame, links: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Links between the texts of components that doubtful leaders belong to and no link has joined."""
    roots = stage(components(links), "joined")
    rooted = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
    sides = maybe.select("a", "b").join(grown(rooted("a")), "a", "left").join(grown(rooted("b")), "b", "left").select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
    sides = stage(sides.where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "doubts")
    of = sets.select("node", "hashes").join(grown(roots), "node", "left").select("node", "hashes", F.coalesce("root", "node").alias("comp"))
    return _doubt_rows(sides, of, block).groupBy("root", "i", "j").applyInPandas(_across, _SAID)


def _doubt_rows(sides: DataFrame, of: DataFrame, block: int) -> DataFrame:
    """Texts (``of``: node, hashes, comp) dealt into (root, i, j), so that those of each pair of components in ``sides`` (x, y) meet.

    The larger of the two is the root. All that is in doubt about a root meets it together, in blocks:
    its texts are sent once for each block of theirs, not for each pair.
    """
    sized = stage(of.groupBy("comp").agg(F.count(F.lit(1)).alias("n")), "sizes")
    widths = lambda c: sized.select(F.col("comp").alias(c), F.col("n").alias(f"n{c}"))
    both = sides.join(grown(widths("x")), "x").join(grown(widths("y")), "y")
    ahead = (F.col("nx") > F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y")))
    pick = lambda yes, no, name: F.when(ahead, F.col(yes)).otherwise(F.col(no)).alias(name)
    both = stage(both.select(pick("x", "y", "root"), pick("y", "x", "comp"), pick("nx", "ny", "most"), pick("ny", "nx", "n")), "sides")
    many = lambda c: F.ceil(c / F.lit(block)).cast("int")
    roots = stage(both.groupBy("root").agg(many(F.first("most")).alias("own_blocks"), many(F.sum("n")).alias("other_blocks")), "roots")
    met = both.select("root", "comp").join(grown(roots), "root")

    def dealt(rows: DataFrame, own: str, own_blocks: str, other: str, other_blocks: str, number: int) -> DataFrame:
        rows = rows.withColumn(own, F.pmod(F.xxhash64("node"), F.col(own_blocks)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1)))
        return rows.select("root", "i", "j", "node", "hashes", F.lit(0.0).alias("radius"), F.lit(number).alias("own"))

    whole = dealt(of.withColumnRenamed("comp", "root").join(grown(roots), "root"), "i", "own_blocks", "j", "other_blocks", 0)
    return whole.unionByName(dealt(of.join(grown(met), "comp"), "j", "other_blocks", "i", "own_blocks", 1))


def linked(sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links that give the components of all similar pairs of one root; ``sets``: root, node, hashes."""
    pick = lambda df, kind: df.where(F.col("kind") == kind).select("a", "b")
    now, said, before = sets.withColumn("radius", F.lit(0.0)), [], None
    while True:
        sized = stage(now.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n")), "sizes")
        many = sized.where("blocks > 1").agg(F.sum("n")).first()[0] or 0
        if before is not None and 2 * many > before:
            said.append(stage(_pairs_of_blocks(now, sized.select("root", "blocks")), "across"))
            break
        dealt = _with_blocks(now, sized).withColumn("own", F.pmod(F.xxhash64("node", F.lit(len(said))), F.col("blocks")).cast("int"))
        level = stage(dealt.groupBy("root", "own").applyInPandas(_block, _SAID), f"level{len(said)}")
        said.append(level)
        if not many:
            break
        left = level.where(F.col("kind") == LEADER).join(sized.where("blocks > 1").select("root"), "root", "left_semi")
        now, before = stage(left.select("root", F.col("a").alias("node"), "radius").join(grown(sets.select("node", "hashes")), "node").select("root", "node", "hashes", "radius"), "leaders"), many
    links, maybe = said[0], said[0]
    for s in said[1:]:
        links = maybe = links.unionByName(s)
    links, maybe = stage(pick(links, LINK), "linked"), pick(maybe, MAYBE)
    if maybe.isEmpty():
        return links
    return links.unionByName(pick(_doubts(maybe, links, sets, block), LINK)).distinct()


def similar_links(base: DataFrame, nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between nodes that give the components of all similar pairs among the candidates."""
    banded = nodes.select("node", F.posexplode("bands").alias("t", "key"))
    shared = banded.groupBy("t", "key").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # A node's least ones are linked through the least of them: near copies share those, so that a large group makes few links.
    own = banded.join(grown(shared), ["t", "key"]).groupBy("node").agg(F.collect_set("least").alias("leasts")).withColumn("a", F.array_min("leasts"))
    met = own.select("a", F.explode(F.array_append("leasts", F.col("node"))).alias("b")).where("a <> b").distinct()
    # Texts with one fingerprint, and those whose fingerprints operator 9 links.
    prints = stage(nodes.groupBy("fp").agg(F.min("node").alias("least")), "fps")
    alike = nodes.join(grown(prints), "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    named = [prints.select(F.col("fp").alias(k), F.col("least").alias(f"n{k}")) for k in ("a", "b")]
    close = near_links(prints.select("fp")).join(grown(named[0]), "a").join(grown(named[1]), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    groups = stage(components(stage(met.unionByName(alike).unionByName(close), "met")), "groups")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([shingles(t).tobytes() for t in batch["text"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["node"], batch["root"], sets], names=["node", "root", "hashes"])
        tidy()

    where = groups.join(grown(nodes.select("node", "locator")), "node").select("node", "root", "locator")
    with settings(base.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="500"):
        texts = base.select("locator", "text").join(grown(where), "locator").select("node", "root", "text")
        sets = stage(texts.mapInArrow(run, "node long, root long, hashes binary"), "sets")
    return linked(sets, block)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """locator, doc_id, root: one row per row of ``docs``; root names the component of similar texts.

    Texts with equal shingle sets are one node, those without words among them. Rows without
    doc_id are linked like others. Empty tables give no rows; other columns are ignored.
    """
    base = located(docs, "doc_id", "text")
    prints = signatures(base)
    nodes = stage(prints.groupBy("node").agg(F.min("locator").alias("locator"), F.min("fp").alias("fp"), F.first("bands").alias("bands")), "nodes")
    roots = components(stage(similar_links(base, nodes), "links"))
    return prints.select("locator", "doc_id", "node").join(grown(roots), "node", "left").select("locator", "doc_id", F.coalesce("root", "node").alias("root"))
