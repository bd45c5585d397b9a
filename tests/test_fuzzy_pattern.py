"""Fuzzy joins of names of one pattern: few of their pairs are weighed, and none is lost or found twice."""

import random

import pytest

from loam.operators import fuzzy, resolve
from tests.test_fuzzy_blocks import long_names, of_one_pattern, wanted


def weighed(spark, monkeypatch, keys, block):
    """How many pairs are weighed, all groups of blocks run here one by one."""
    e, many, scores = 1 - 89.5 / 100, [], fuzzy._scores

    def counted(*args):
        out = scores(*args)
        many.append(len(out))
        return out

    monkeypatch.setattr(fuzzy, "_scores", counted)
    rows = resolve._listed(resolve._token_keys(spark.createDataFrame([(k,) for k in keys], "key string"), "key"), (1 - e) / (1 + e), e)
    table, groups = resolve._dealt(resolve.stored(rows), block).toArrow(), {}
    for at, group in enumerate(zip(*(table[c].to_pylist() for c in ("deal", "i", "j")), strict=True)):
        groups.setdefault(group, []).append(at)
    for at in groups.values():
        list(fuzzy.pairs_of_block(table.take(at), 90, e, 0.6))
    return sum(many)


def test_few_pairs_of_one_pattern_are_weighed(spark, monkeypatch):
    rng = random.Random(4)
    keys = [f"Supplier#{k:09d} NATION_{k % 25}" for k in rng.sample(range(360000), 1000)]
    # One in a hundred scores; pairs of characters alone let a sixth through.
    assert weighed(spark, monkeypatch, keys, 32) < len(keys) * len(keys) / 2 / 10


def mixed(seed):
    rng = random.Random(seed)
    out = [*of_one_pattern(150), *long_names()]
    for k in range(120):
        digits = f"{rng.randrange(10**rng.choice([2, 4, 9]))}"
        out.append(rng.choice([f"Supplier#{digits} NATION_{k % 7}", f"NATION_{k % 12} A {digits}", f"É中 {digits} NATION_{k % 3}", f"NATION_{k % 3}! x", f"{digits}", f"Supplier#{digits[:3]} \t NATION_1  NATION_2"]))
    out += [f"{'PATTERN ' * 30}Supplier#{k:09d} {'X' * (200 + k % 60)}" for k in range(0, 300, 9)]
    out += [f"{'WXYZ' * 14} Supplier#{k:09d} NATION_{k % 3}" for k in range(0, 200, 9)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed, block, ratio", [(1, 5, 0.6), (2, 16, 0.9), (3, 64, 0.6)])
def test_mixed_names_equal_all_pairs(spark, monkeypatch, seed, block, ratio):
    # Always let the names meet that share something frequent.
    monkeypatch.setattr(resolve, "CHEAPER", 1e9, raising=False)
    keys = mixed(seed)
    names = spark.createDataFrame([(k,) for k in keys], "key string")
    got = [tuple(r) for r in resolve.fuzzy_pairs(names, ratio=ratio, block=block).collect()]
    want = wanted(keys, ratio=ratio)
    assert len(want) > 500 and len(got) == len(set(got)) and set(got) == want
