"""What the near-dedup stage deals behind doubtful leaders."""

import numpy as np
from pyspark.sql import functions as F

from loam.llm import jaccard


def test_a_large_component_is_not_sent_once_for_each_doubt(spark):
    """1,000 texts in doubt with 200 small components: each pair of them meets, in rows that follow the texts."""
    many, few, block = 1000, 200, 128
    of = spark.range(many + few).select(F.col("id").alias("node"), F.lit(b"").alias("hashes"), F.when(F.col("id") < many, 0).otherwise(F.col("id")).cast("long").alias("comp"))
    sides = spark.range(many, many + few).select(F.lit(0).cast("long").alias("x"), F.col("id").alias("y"))
    rows = jaccard._doubt_rows(sides, of, block).select("root", "i", "j", "node", "own").collect()
    assert len(rows) == many * 2 + few * 8
    groups = {}
    for r in rows:
        groups.setdefault((r.root, r.i, r.j), ([], []))[r.own].append(r.node)
    met = {(a, b) for x, y in groups.values() for a in x for b in y}
    assert met == {(a, b) for a in range(many) for b in range(many, many + few)}


def test_doubts_link_what_is_similar(spark):
    rng = np.random.default_rng(3)
    core = rng.integers(0, 1 << 60, 40).astype(np.uint64)
    sets = [np.sort(np.append(core[:36], rng.integers(0, 1 << 60, k % 5).astype(np.uint64))) for k in range(30)]
    sets += [np.sort(rng.integers(0, 1 << 60, 30).astype(np.uint64)) for _ in range(10)]
    df = spark.createDataFrame([(k, s.tobytes()) for k, s in enumerate(sets)], "node long, hashes binary")
    links = spark.createDataFrame([(0, k) for k in range(1, 20)], "a long, b long")
    maybe = spark.createDataFrame([(3, k) for k in range(20, 40)], "a long, b long")
    got = jaccard._doubts(maybe, links, df, 4).where(F.col("kind") == jaccard.LINK).select("a", "b").collect()
    alike = lambda a, b: len(np.intersect1d(sets[a], sets[b])) * jaccard.SIMILAR[1] >= len(np.union1d(sets[a], sets[b])) * jaccard.SIMILAR[0]
    assert all(alike(r.a, r.b) for r in got)
    assert {max(r.a, r.b) for r in got} == {b for b in range(20, 40) if any(alike(a, b) for a in range(20))}
