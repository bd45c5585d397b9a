"""Operator 12 against a brute-force version over all byte windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loam.llm import queries, radix_windows

SCHEMA = "doc_id long, text string, key string, c1 string, w1 string, start string"


def brute(docs, depth):
    """(n_bytes, n_removed, spans, kept) by row, in the order of doc_id and place."""
    raws = [(t or "").encode() for _, t in docs]
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0, k))
    seen, out = set(), [None] * len(docs)
    for k in order:
        raw, gone = raws[k], bytearray(len(raws[k]))
        for x in range(len(raw) - depth + 1):
            w = raw[x : x + depth]
            if w in seen:
                gone[x : x + depth] = b"\1" * depth
            seen.add(w)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[k] = (docs[k][0], len(raw), sum(gone), runs, bytes(b for b, g in zip(raw, gone, strict=True) if not g))
    return Counter(out)


def run(spark, docs, depth=100, digit=40):
    d = spark.createDataFrame([(i, t, "k", "c", "w", "s") for i, t in docs], SCHEMA).coalesce(1)
    out = radix_windows.window_dedup(d, depth, digit).select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.col("kept"))
    return Counter((*r[:4], bytes(r[4])) for r in out.collect())


def corpus(seed, n=120, alphabet="ab cdeé "):
    rng = random.Random(seed)
    prose = lambda k: "".join(rng.choices(alphabet, k=k))
    shared = [prose(rng.choice([99, 100, 101, 140, 400])) for _ in range(8)]
    docs = []
    for k in range(n):
        kind = rng.random()
        text = prose(rng.choice([0, 5, 60, 150, 300]))
        if kind < 0.5:
            text += rng.choice(shared) + prose(rng.choice([0, 1, 80]))
        if kind < 0.25:
            text += rng.choice(shared)[rng.randrange(40) :] + rng.choice(shared)
        if docs and kind > 0.8:
            old = docs[rng.randrange(len(docs))][1] or ""
            cut = rng.randrange(len(old) + 1)
            text = old[:cut] + rng.choice(["", "X", prose(7)]) + old[cut:]
        docs.append((rng.choice([k, k, k, -k, 7, None]), text))
    return docs


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    docs = corpus(seed)
    # Rows with one doc_id are told apart by their place, so they are sorted alike here.
    assert run(spark, docs) == brute(docs, 100)


@pytest.mark.parametrize("depth, digit", [(16, 8), (50, 20), (9, 9)])
def test_other_depths(spark, depth, digit):
    docs = [(k, t) for k, (_, t) in enumerate(corpus(9, 60))]
    assert run(spark, docs, depth, digit) == brute(docs, depth)


def test_odd_rows(spark):
    long = "a passage of words that repeats itself over and over again, " * 400
    docs = [(3, "a" * 500), (1, "a" * 150), (2, "a" * 99), (5, None), (6, ""), (8, long), (7, long), (9, "é" * 49 + "x"), (10, "é" * 50), (11, "q" + "é" * 50), (12, "\U0001f600" * 60), (None, "a" * 100)]
    assert run(spark, docs) == brute(docs, 100)
    assert not run(spark, [])
    assert run(spark, [(1, None), (2, "short")]) == brute([(1, None), (2, "short")], 100)


def test_chunks_and_small_tables(spark, monkeypatch):
    """Chunk borders and a saturated bit table change nothing."""
    docs = corpus(4)
    monkeypatch.setattr(radix_windows, "CHUNK", 1000)
    monkeypatch.setattr(radix_windows, "_there", lambda table, key: key == key)
    assert run(spark, docs) == brute(docs, 100)


@pytest.mark.parametrize("group", [1, 3])
def test_hot_digits(spark, monkeypatch, group):
    """Digits beyond the bound of a task's group go the distributed way, with the same result."""
    docs = corpus(5)
    monkeypatch.setattr(radix_windows, "GROUP", group)
    monkeypatch.setattr(radix_windows, "SOME", 5)
    assert run(spark, docs) == brute(docs, 100)


def test_radix_groups():
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 99, 4000, dtype=np.uint8)
    words, at = radix_windows._words(np.append(raw, np.zeros(8, np.uint8))), np.arange(3900)
    for depth in (9, 13, 16):
        group = at % 3
        index, found = radix_windows.radix_groups(words, at, at * 0 + 5, group, depth)
        seen = {}
        for k in at.tolist():
            seen.setdefault((k % 3, raw[k : k + depth].tobytes()), []).append(k)
        got = {}
        for k, g in zip(index.tolist(), found.tolist(), strict=True):
            got.setdefault(g, []).append(k)
        assert sorted(got.values()) == sorted(v for v in seen.values() if len(v) > 1)


def test_query_equals_brute_force_on_all_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = Counter((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(docs, 100).elements())
    got = queries.op12_radix_windows(spark, sf_dir)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()) == want
