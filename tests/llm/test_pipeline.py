"""The pipeline's stages, each against a brute-force version on the smallest table."""

import math
import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from loam.llm import toxic_crf
from loam.llm.shared import stage
from tests.llm.test_jaccard import brute_kept
from tests.llm.test_operators_llm import squeezed

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def kept_exact(docs):
    first = {}
    for r in sorted(docs, key=lambda r: r.doc_id):
        first.setdefault(squeezed(r.text), r.doc_id)
    return sorted(first.values())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{SF}/labels.parquet")
    steps = dict(cp.STAGES)
    assert list(steps) == ["toxicity", "exact dedup", "simhash near-dedup", "mixing", "packing"]

    one = stage(steps["toxicity"](spark, docs, SF))
    scored = toxic_crf.score_documents(docs, toxic_crf.learn(docs, labels))
    assert sorted(r.doc_id for r in one.collect()) == sorted(r.doc_id for r in scored.where("predicted = 0").collect())

    two = stage(steps["exact dedup"](spark, one, SF))
    assert sorted(r.doc_id for r in two.collect()) == kept_exact(one.collect())

    three = stage(steps["simhash near-dedup"](spark, two, SF))
    data = two.collect()
    want = set(brute_kept([(r.doc_id, r.text) for r in data]))  # five words, similarity 0.8 or more
    assert sorted(r.doc_id for r in three.collect()) == sorted(want)

    four = stage(steps["mixing"](spark, three, SF))
    copies = Counter(r.doc_id for r in four.collect())
    assert max(copies.values()) <= 3 and set(copies) <= want
    assert all(d.columns == columns for d in (one, two, three, four))
    texts = {r.doc_id: tuple(r) for r in docs.collect()}
    assert all(tuple(r) == texts[r.doc_id] for r in four.collect())

    five = steps["packing"](spark, four, SF).collect()
    assert Counter(r.doc_id for r in five if r.piece == 0) == copies
    seqs = defaultdict(int)
    for r in five:
        seqs[r.sequence_id] += r.length
    assert max(seqs.values()) <= 2048 and len(seqs) <= math.ceil(sum(seqs.values()) / 2048) + 1


def test_stages_take_odd_rows(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema.add("locator", "string")
    data = [(1, None, None, None, None, "a"), (None, "x y", None, "s", 1, "b"), (None, "x y", None, "s", 1, "b"), (2, "", "en", "s", 0, None), (3, "word " * 30000, "en", None, 5, "c")]
    docs = stage(spark.createDataFrame(data, schema))
    for odd in (docs, docs.where(F.lit(False))):
        for name, step in cp.STAGES[:-1]:
            odd = stage(step(spark, odd, SF))
            assert odd.columns == schema.names, name
        cp.STAGES[-1][1](spark, odd, SF).collect()


def test_run(spark):
    assert cp.run(spark, SF).count() > 0
