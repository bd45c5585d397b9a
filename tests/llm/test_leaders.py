"""Near duplicates of large groups: leaders, radii and doubtful pairs against all pairs; linear work for one template."""

import itertools

import numpy as np
import pytest

from loam.llm import jaccard
from loam.llm.components import components
from loam.llm.shared import stage

SCHEMA = "root long, node long, hashes binary"


def table(spark, groups):
    return stage(spark.createDataFrame([(r, n, bytearray(np.unique(s).astype(np.uint64).tobytes())) for r, n, s in groups], SCHEMA).repartition(3))


def brute(groups):
    """Components of at least two nodes of one root, by all pairs."""
    root = {n: n for _, n, _ in groups}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {n: (r, set(s.tolist())) for r, n, s in groups}
    for a, b in itertools.combinations(sorted(sets), 2):
        (r, x), (q, y) = sets[a], sets[b]
        if r == q and 5 * len(x & y) >= 4 * len(x | y):
            i, j = find(a), find(b)
            root[max(i, j)] = min(i, j)
    found = {n: find(n) for n in root}
    return {(n, r) for n, r in found.items() if sum(v == r for v in found.values()) > 1}


def chains(seed, n=130):
    """Sets that drift away from each other in small steps, so that most links are near the threshold."""
    rng = np.random.default_rng(seed)
    groups, node = [], 1000
    for root in (1, 2):
        for _ in range(6):
            s = rng.integers(0, 1 << 40, 60)
            for _ in range(n // 12):
                s = s.copy()
                s[rng.choice(60, int(rng.integers(1, 14)), replace=False)] = rng.integers(0, 1 << 40)
                groups.append((root, node, s))
                node += 1
    rng.shuffle(groups := [*groups])
    return groups


@pytest.mark.parametrize("seed, block", [(1, 4), (2, 7), (3, 16), (4, 1000)])
def test_links_equal_all_pairs(spark, seed, block):
    groups = chains(seed)
    got = components(stage(jaccard.linked(table(spark, groups), block)))
    want = brute(groups)
    assert len(want) > 40 and {tuple(r) for r in got.collect()} == want


def test_doubtful_leaders_are_looked_behind(spark, monkeypatch):
    """A bridge of two texts between stars whose leaders are far apart."""
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 40, 100)
    new = lambda s, places, salt: np.array([x if k not in places else (1 << 41) + salt * 1000 + k for k, x in enumerate(s)])
    a, b, c = base, new(base, range(0, 10), 1), new(base, range(0, 20), 1)
    d = new(c, range(20, 30), 2)
    groups = [(1, k, s) for k, s in zip((1, 8, 5, 2), (a, b, c, d), strict=True)]
    called = []
    real = jaccard._doubts
    monkeypatch.setattr(jaccard, "_doubts", lambda *x: (called.append(1), real(*x))[1])
    for block in (1, 2, 3):
        assert {tuple(r) for r in components(stage(jaccard.linked(table(spark, groups), block))).collect()} == brute(groups) == {(k, 1) for k in (1, 2, 5, 8)}


def test_one_template_is_linear(spark, monkeypatch):
    """5,000 pages of one template: every set moves once, and few leaders again; no pairs of blocks."""
    rng = np.random.default_rng(3)
    template, groups = rng.integers(0, 1 << 40, 60), []
    for k in range(5000):
        s = template.copy()
        s[rng.choice(60, 2, replace=False)] = rng.integers(0, 1 << 40, 2)
        groups.append((1, k, s))
    monkeypatch.setattr(jaccard, "_pairs_of_blocks", lambda *a: 1 / 0)
    sent = []
    real = jaccard.stage
    monkeypatch.setattr(jaccard, "stage", lambda df, name: (lambda out: (sent.append((name, out.count())), out)[1])(real(df, name)))
    links = jaccard.linked(table(spark, groups))
    assert links.count() == 4999
    leaders = [n for name, n in sent if name == "leaders"]
    assert sum(leaders) <= 5000 // jaccard.BLOCK * 2 and {r.root for r in components(stage(links)).collect()} == {0}
