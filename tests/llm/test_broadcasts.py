"""Sides of joins that grow with the input are never collected on the driver."""

import pytest

from loam.llm import components, covering, jaccard
from loam.llm.shared import stage
from loam.operators import resolve


@pytest.fixture
def plans(monkeypatch):
    """Physical plans of all that is written."""
    seen = []

    def recorded(df, name="stage"):
        seen.append(plan(df))
        return stage(df, name)

    for module in (components, covering, jaccard):
        monkeypatch.setattr(module, "stage", recorded)
    before = resolve.stored
    monkeypatch.setattr(resolve, "stored", lambda df: [seen.append(plan(df)), before(df)][1])
    return seen


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def docs(spark):
    words = " ".join(f"w{k}" for k in range(60))
    texts = [words, words, words + " more", "other text of its own", words.replace("w3 ", "v "), None]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_simhash_joins_are_shuffled(spark, plans):
    found = covering.near_duplicates(docs(spark))
    plans.append(plan(found))
    assert {r.doc_id: r.component_id for r in found.collect()}[1] == 0
    assert any("Join" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)


def test_cluster_joins_are_shuffled(spark, plans):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y")], "a string, b string")
    found = resolve.clusters(links)
    assert sorted((r.node, r.root) for r in found.collect()) == [("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")]
    assert any("Join" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)


def test_jaccard_joins_are_shuffled(spark, plans):
    found = jaccard.near_duplicates(docs(spark))
    plans.append(plan(found))
    root = {r.doc_id: r.root for r in found.collect()}
    assert root[0] == root[1] == root[2] != root[3]
    # Only the few roots of more than one block may be broadcast.
    assert any("Join" in p for p in plans) and not any("BroadcastHashJoin" in p and "blocks" not in p for p in plans)
