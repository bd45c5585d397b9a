"""Fuzzy joins by blocks: many names of one pattern, names beyond a word of bits, and no pair sent anywhere."""

import itertools
import random

import pytest

from loam.operators import resolve


def of_one_pattern(n):
    return [f"{'' if k % 2 else f'NATION_{k % 5} '}Supplier#{k * 7:09d}{f' NATION_{k % 5}' if k % 2 else ''}" for k in range(n)]


def long_names():
    rng = random.Random(3)
    out = []
    for size in (61, 62, 63, 64, 65, 130, 254, 255, 256, 300):
        name = "".join(rng.choice("ABCD  ") for _ in range(size)).strip().replace("  ", " x")
        out += [name, name[:-3] + "QQ", name.replace("A", "E", 2), "LOTTE " + name]
    return out


def wanted(keys, score=90, ratio=0.6):
    pairs = ((a, b) for a, b in itertools.combinations(sorted(set(keys)), 2) if min(len(a), len(b)) >= ratio * max(len(a), len(b)))
    return {(a, b, s) for a, b in pairs if (s := int(resolve.token_set_ratio(a, b) + 0.5)) >= score}


@pytest.mark.parametrize("block", [7, 1024])
def test_blocks_equal_all_pairs(spark, block):
    keys = [*of_one_pattern(120), *long_names()]
    got = [tuple(r) for r in resolve.fuzzy_pairs(spark.createDataFrame([(k,) for k in keys], "key string"), block=block).collect()]
    want = wanted(keys)
    assert len(want) > 500 and len(got) == len(set(got)) and set(got) == want


def test_no_pair_is_shuffled(spark):
    found = resolve.fuzzy_pairs(spark.createDataFrame([(k,) for k in of_one_pattern(40)], "key string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # What the blocks return is the result: nothing joins, sorts or drops pairs behind it.
    assert "FlatMapGroupsInArrow" in plan[0]
