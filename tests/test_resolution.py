"""Fuzzy and edit-distance joins against all pairs; rules by trie against their patterns; strict search."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loam.functions import rules
from loam.operators import relational, resolve, vectors


def names(seed, n=160):
    rng = random.Random(seed)
    words = ["LOTTE", "MART", "FPT", "TELECOM", "VIETTEL", "POST", "A", "B", "CO", "LTD", "BÁN", "LẺ", "C F", "\U0001f600X"]
    out = {"", " ", "\x1f", "A A A", "A", "B", "AB", "BA", "LOTTE  MART ", "MART LOTTE", "FPT", "FPT TELECOM", "FPT FPT TELECOM"}
    while len(out) < n:
        name = " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, 5])))
        for _ in range(rng.choice([0, 0, 1, 2])):
            k = rng.randrange(len(name) + 1)
            name = name[:k] + rng.choice("AX é") + name[k + rng.choice([0, 1]) :]
        out.add(name)
    return sorted(out)


@pytest.mark.parametrize("seed, score, ratio", [(1, 90, 0.6), (2, 90, 0.3), (3, 75, 0.6), (4, 97, 0.9)])
def test_fuzzy_pairs_equal_all_pairs(spark, seed, score, ratio):
    keys = names(seed)
    want = set()
    for a, b in itertools.combinations(keys, 2):
        if a and min(len(a), len(b)) >= ratio * max(len(a), len(b)):
            s = int(resolve.token_set_ratio(a, b) + 0.5)
            if s >= score:
                want.add((a, b, s))
    df = spark.createDataFrame([(k,) for k in [*keys, *keys[:5], None]], "key string")
    assert len(want) > 5 and {tuple(r) for r in resolve.fuzzy_pairs(df, score=score, ratio=ratio).collect()} == want


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("distance, ratio", [(1, 0.6), (2, 0.1), (3, 0.6)])
def test_edit_pairs_equal_all_pairs(spark, distance, ratio):
    keys = [k for k in names(5, 150) if k] + ["x", "xy", "yx", "xyz", "zyx", "q", "qqqqqq", "qqqqq", "qqqqqqqqq"]
    keys = sorted(set(keys))
    want = {(a, b, d) for a, b in itertools.combinations(keys, 2) if min(len(a), len(b)) >= ratio * max(len(a), len(b)) and (d := edits(a, b)) <= distance}
    got = resolve.edit_pairs(spark.createDataFrame([(k,) for k in keys], "key string"), distance, ratio)
    assert {tuple(r) for r in got.collect()} == want


RULES = [("ca mau|camau", "first"), ("mau", "second"), (r"\bdata\b", "third"), ("c++|a.b", "fourth"), ("a|ab|abc", "fifth"), ("x[yz]|q", "sixth"), ("mau", "second"), ("-|\\|]", "seventh")]


def test_trie_pattern():
    words = ["a", "ab", "abc", "b c", "b.d", "é", "+"]
    pattern = re.compile(rules.trie_pattern(words))
    assert all(pattern.fullmatch(w) for w in words) and not pattern.fullmatch("bxd")
    assert pattern.match("abcd")[0] == "abc" and rules.trie_pattern(["ab", "ac"]) == "a(?:b|c)"


@pytest.mark.parametrize("ruled", [RULES, [r for r in RULES if "\\" not in r[0]], [("x", "l")], []])
def test_rules_equal_their_patterns(spark, ruled):
    rng = random.Random(7)
    texts = ["".join(rng.choices(["ca mau", "camau", "a", "b", "c", "+", "data", " ", "é", "xy", "q", "-", "]", "A.B", "MAU"], k=rng.randrange(9))) for _ in range(200)] + ["", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    hit = lambda t, p: any(re.search(a if set(a) & set("[]\\") and a != "]" else re.escape(a), t, re.I) for a in p.split("|"))
    # ``c++`` and ``a.b`` are patterns by their characters; Python reads the former otherwise than Java.
    ruled = [(p, v) for p, v in ruled if "++" not in p and "\\|" not in p]
    for r in df.select("k", rules.first_match(F.col("t"), ruled).alias("one"), rules.any_match(F.col("t"), ruled).alias("all")).collect():
        t = texts[r.k]
        labels = [v for p, v in ruled if t is not None and hit(t, p)]
        assert (r.one, r.all) == (labels[0] if labels else None, sorted(set(labels)))


def test_strict_search(spark):
    rng = np.random.default_rng(1)
    data = [(k, [float(x) for x in rng.normal(size=4)], k % 5 == 0) for k in range(60)] + [(99, [0.0] * 4, True), (98, None, None)]
    df = spark.createDataFrame(data, "id int, vector array<double>, ok boolean").repartition(4)
    q = [1.0, 0.5, -0.2, 0.1]
    score = {k: -9 if v is None or not any(v) else float(np.dot(v, q) / np.linalg.norm(v) / np.linalg.norm(q)) for k, v, _ in data}
    by = lambda ids: sorted(ids, key=lambda k: (-score[k], k))
    everyone, strict = by(score), by([k for k, _, ok in data if ok])
    ids = lambda **kw: [r.id for r in vectors.search(df, q, 5, **kw).collect()]
    assert ids(strict=F.col("ok")) == strict[:5]
    assert ids(strict=F.col("ok") & (F.col("id") < 20), fallback=12) == everyone[:12]
    assert ids(strict=F.col("ok") & (F.col("id") < 20), fallback=12, enough=4) == [k for k in strict if k < 20][:5]
    assert ids(strict=F.lit(False), fallback=3, must=F.col("id") > 3) == [k for k in everyone if k > 3][:3]


def test_names_of_helper_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, 5, "a", 0), (1, 7, "b", 0), (2, 1, "c", 0)], "__rank int, __part int, __at string, __base int")
    assert sorted(map(tuple, relational.keep_first(df, ["__rank"], [F.desc("__part")]).collect())) == [(1, 7, "b", 0), (2, 1, "c", 0)]
    assert [r.job_id for r in relational.surrogate_ids(df, [F.col("__part")]).orderBy("__part").collect()] == [1, 2, 3]
    assert relational.without_older(df, "__rank", "__part").count() == 2 and relational.first_n(df, ["__rank"], [F.col("__part")], 1).count() == 2


def test_company_seed_rows(spark):
    seed = spark.createDataFrame([(" fpt ", "Tập đoàn FPT"), ("fpt", "Zed"), ("tập đoàn fpt", "Other"), (None, "Nul")], "variant_name string, canonical_name string")
    assert {tuple(r) for r in relational.company_seed_rows(seed).collect()} == {("FPT", "TẬP ĐOÀN FPT"), ("TẬP ĐOÀN FPT", "OTHER"), ("ZED", "ZED"), ("OTHER", "OTHER"), ("NUL", "NUL")}
