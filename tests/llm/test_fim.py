"""Operator 13 against a brute-force version over code points."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loam.llm import fim

SCHEMA = "doc_id long, text string, row_no string, unit string, n string, form string"
TEXTS = ["", None, " ", " \t\n ", "a", "a b", "  lead and trail  ", "é日本 \U0001f600 x y z", "has <P> inside", "<S>", "x <M", "<P", "a<", "one two three four\nfive\tsix", "w " * 3000]


def brute(doc_id, text, rate=50, spm_rate=80):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(units)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    if text == "" or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate, spm_rate", [(50, 80), (100, 50), (0, 80)])
def test_cuts_equal_brute_force(spark, rate, spm_rate):
    data = [(k * len(TEXTS) + j, t) for k in range(12) for j, t in enumerate(TEXTS)]
    data += [(None, "no id here at all"), (None, "no id here at all"), (5, "twice a b c"), (5, "twice a b c"), (-3, "minus one two")]
    docs = spark.createDataFrame([(i, t, "r", "u", "n", "f") for i, t in data], SCHEMA)
    out = fim.fill_in_middle(docs, rate=rate, spm_rate=spm_rate)
    got = out.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == Counter(brute(i, t, rate, spm_rate) for i, t in data)
    assert Counter((r.doc_id, r.back) for r in got) == Counter((i, t or "") for i, t in data)


def test_empty_table(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], SCHEMA)).collect() == []


def test_text_stays_out_of_the_units(spark):
    """Only lengths are exploded: no exchange below a window carries a text."""
    docs = spark.createDataFrame([(k, "a b c d", "r", "u", "n", "f") for k in range(50)], SCHEMA)
    plan = fim.fill_in_middle(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan  # offsets are a stored table by the time texts are cut
