"""The pipeline's near-dedup stage against brute-force Jaccard similarity."""

import itertools
import os
import re

import numpy as np
import pytest

import corpus_pipeline as cp
from loam.llm import jaccard
from loam.llm.components import components
from loam.llm.shared import located, stage
from tests.llm.test_operators_llm import edge, empty, frame, rows  # noqa: F401

SF = "/root/testdata/sf0.01"


def naive_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_kept(data):
    """Smallest doc_id of each component of pairs at 0.8 or more."""
    sets = [naive_set(t) for _, t in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(data)), 2):
        a, b = sets[i], sets[j]
        if min(len(a), len(b)) * 5 >= max(len(a), len(b)) * 4 and (a == b or len(a & b) * 5 >= len(a | b) * 4):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(data):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted(least.values())


def edited(words, places):
    return " ".join(f"{w}x" if k in places else w for k, w in enumerate(words))


def test_links_from_the_threshold_on(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in rng.integers(0, 5000, 304)]
    # 300 shingles; an edited word changes five: six edits leave 270 of 330 (0.82), seven 265 of 335 (0.79).
    texts = [" ".join(words), edited(words, range(10, 270, 45)), edited(words, range(10, 300, 42)), "other text"]
    got = dict(steps_kept(spark, list(enumerate(texts))))
    assert brute_kept(list(enumerate(texts))) == sorted(got) == [0, 2, 3]


def steps_kept(spark, data):
    docs = stage(frame(spark, rows([t for _, t in data], [i for i, _ in data])))
    return [(r.doc_id, r.text) for r in dict(cp.STAGES)["simhash near-dedup"](spark, docs, "").collect()]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stage_like_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(r.doc_id for r in dict(cp.STAGES)["simhash near-dedup"](spark, docs, SF).collect())
    assert got == brute_kept([(r.doc_id, r.text) for r in docs.collect()])


def test_blocks_lose_no_link(spark):
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in rng.integers(0, 5000, 200)]
    texts = [edited(words, set(rng.choice(200, int(rng.integers(1, 9)), replace=False).tolist())) for _ in range(60)]
    base = located(frame(spark, rows(texts)), "doc_id", "text")
    nodes = jaccard.signatures(base).select("node", "locator", "fp", "bands")
    found = [components(stage(jaccard.similar_links(base, nodes, block))).collect() for block in (7, 1000)]
    assert sorted(map(tuple, found[0])) == sorted(map(tuple, found[1])) and found[0]


def test_odd_rows(spark, edge, empty):  # noqa: F811
    assert jaccard.near_duplicates(empty).count() == 0
    assert jaccard.near_duplicates(edge).count() == edge.count()
