"""Operator 11 against exhaustive scoring; proofs and fall-through of the tiers."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from loam.llm import tiered

DOCS = "doc_id long, text string, ids string, item long, rank string, score string"
ITEMS = "item_id long, text string, doc_id string, words string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {k: k + 32 for k in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(_LOWER))


def brute(docs, items, top=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(k, i, c, sum(c.values())) for k, (i, c) in enumerate(counts) if c]
    total, words = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, _, c, _ in counts for t in c)
    out = []
    for item_id, text in items:
        found = []
        for k, i, c, n in counts:
            m = 10 + (90 * n * total) // words
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0, k))
        out += [(item_id, r, None if f[1] else f[2], -f[0]) for r, f in enumerate(sorted(found)[:top], 1)]
    return Counter(out)


def run(spark, docs, items, top=10):
    d = spark.createDataFrame([(i, t, "x", 7, "r", "s") for i, t in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(i, t, "x", "w") for i, t in items], ITEMS)
    return Counter(tuple(r) for r in tiered.search(tiered.build(d), q, top).collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    docs = []
    for k in range(900):
        some = [words[int(300 * rng.random() ** 3)] for _ in range(rng.choice([3, 30, 200]))]
        docs.append((k, " ".join(some)))
    return docs


@pytest.mark.parametrize("block", [40, 4096])
def test_equals_exhaustive_scores(spark, corpus, block, monkeypatch):
    monkeypatch.setattr(tiered, "BLOCK_DOCS", block)
    odd = [(None, None), (None, "w7 w7 W299"), (5, "w7 w7 W299"), (5, "w7 w7 W299"), (-2, ""), (-3, "É日本 w3-w4"), (9000, "w1 " * 30000), (9001, "...")]
    items = [(k, f"W{k} w{k + 1} w{k * 2}, w{k * 3} w{k} unseen") for k in range(0, 90, 6)] + [(500, None), (501, ""), (502, "nothing here"), (503, "É日本"), (503, "É日本"), (None, "w7 w299")]
    assert run(spark, corpus + odd, items) == brute(corpus + odd, items)


def test_ties_and_few_documents(spark):
    docs = [(k, "same words here") for k in range(30, 0, -1)] + [(None, "same words here")] * 3 + [(99, "other")]
    items = [(1, "same"), (2, "other same")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, 40) == brute(docs, items, 40)


def test_empty_tables(spark, corpus):
    assert not run(spark, [], [(1, "w1")])
    assert not run(spark, corpus[:5], [])
    assert not run(spark, [(1, None), (2, "")], [(1, "w1")])


def test_proof_by_tier():
    """An item is settled at the first tier whose bound is under the bar, and never above a true score."""
    import pyarrow as pa

    rng = random.Random(1)
    texts = [" ".join(rng.choices([f"t{k}" for k in range(12)], k=rng.choice([4, 60, 300]))) for _ in range(600)]
    counts = [Counter(t.split()) for t in texts]
    total = sum(sum(c.values()) for c in counts)
    table = pa.table({"doc_id": range(600), "text": texts, "row_no": range(600), "row_file": [0] * 600})
    row = tiered._block(table, 600, total, 0)
    words = [f"t{k}".encode() for k in range(12)]
    block = tiered.Tiers(row, words, 3)
    codes, weights = np.array([0, 3, 7]), np.array([900, 400, 70])
    level, exact = block.settle(codes, weights, 1)
    assert level == 4
    levels = set()
    for bar in np.linspace(exact.max() * 0.9, exact.max() * 1.4, 3000).astype(int).tolist():
        level, sums = block.settle(codes, weights, bar)
        assert (level == 4) == (exact.max() >= bar) and (sums <= exact).all()
        levels.add(level)
    assert levels >= {1, 2, 4}
