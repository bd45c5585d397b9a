"""Versioned tables: crashes at each step, untouched files, conflicts, old readers, migrations, day index."""

import pytest
from pyspark.sql import functions as F

from loam.sources import sinks, versions
from loam.sources.versions import Conflict, KeyedTable, Published
from loam.streaming import microbatch


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def table(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", "k", 8)
    t.upsert(spark.createDataFrame([(k, f"v{k}") for k in range(40)], "k long, v string"))
    return t


def test_a_batch_rewrites_only_its_buckets(spark, table, tmp_path):
    before = table.versions.newest()[1]["buckets"]
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "t/data").rglob("*.parquet")}
    table.upsert(spark.createDataFrame([(3, "new"), (100, "more"), (None, "no key")], "k long, v string"))
    after = table.versions.newest()[1]["buckets"]
    assert 1 <= sum(before[b] != p for b, p in after.items()) <= 2
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    assert rows(table.read()) == sorted([(k, "new" if k == 3 else f"v{k}") for k in range(40)] + [(100, "more")])
    assert rows(table.read(1)) == sorted((k, f"v{k}") for k in range(40))
    assert table.upsert(spark.createDataFrame([], "k long, v string")) == 2


def test_the_last_of_a_batch_counts_and_columns_grow(spark, table):
    batch = spark.createDataFrame([(1, 5, "x"), (1, 9, "y"), (1, 7, "z")], "k long, at int, v string")
    for _ in range(2):  # the same batch again changes nothing
        table.upsert(batch, [F.desc("at")])
        assert rows(table.read().where("k < 3").select("k", "v", F.coalesce("at", F.lit(0)))) == [(0, "v0", 0), (1, "y", 9), (2, "v2", 0)]


@pytest.mark.parametrize("step", ["write", "create", "rename"])
def test_a_crash_leaves_the_version_before(spark, table, monkeypatch, step):
    new = spark.createDataFrame([(1, "new")], "k long, v string")
    want = rows(table.read())
    with monkeypatch.context() as m:
        if step == "write":  # data half written, no manifest
            real = KeyedTable._write
            m.setattr(KeyedTable, "_write", lambda self, r, n: (real(self, r.limit(1), n), 1 / 0))
        elif step == "create":  # data whole, no manifest
            m.setattr(versions.Versions, "commit", lambda self, n, c: 1 / 0)
        else:  # manifest written aside, not moved
            real = versions.Versions._path
            m.setattr(versions.Versions, "_path", lambda self, n: real(self, n) if n < 2 else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.upsert(new)
        assert rows(table.read()) == want
    assert table.upsert(new) == 2
    assert rows(table.read().where("k = 1")) == [(1, "new")]
    table.vacuum(1)
    assert table.versions.numbers() == [2] and table.read().count() == 40


def test_two_writers_conflict(spark, table):
    number, manifest = table.versions.newest()
    table.versions.commit(number + 1, manifest)
    with pytest.raises(Conflict):
        table.versions.commit(number + 1, manifest)
    assert table.versions.numbers() == [1, 2]


def test_delete_and_vacuum(spark, table, tmp_path):
    kept = table.versions.newest()[1]["buckets"]
    table.delete(F.col("k") == 5)
    table.delete(F.col("v").isNull())
    assert table.versions.numbers() == [1, 2]
    assert sum(kept[b] != p for b, p in table.versions.newest()[1]["buckets"].items()) <= 1
    table.delete(F.lit(True))
    assert table.read().count() == 0 and table.read().columns == ["k", "v"]
    table.vacuum(1)
    assert not list((tmp_path / "t/data").rglob("*.parquet"))


def test_published_tables_switch_together(spark, tmp_path):
    home = Published(spark, f"file://{tmp_path}/p")
    a, b = spark.range(3), spark.range(5)
    assert home.publish([("a", a), ("b", b)]) == {"a": 3, "b": 5}
    old = home.read("a")
    broken = spark.range(2).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        home.publish([("a", b), ("b", broken)])
    assert (home.read("a").count(), home.read("b").count()) == (3, 5)
    assert home.publish([("a", b)]) == {"a": 5}
    assert (home.read("a").count(), home.read("b").count(), old.count()) == (5, 5, 3)
    home.vacuum(1)
    assert home.names() == ["a", "b"] and home.read("b").count() == 5


def test_full_refresh_keeps_views(spark, tmp_path):
    name = f"refresh_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION 'file://{tmp_path}/db'")
    try:
        spark.range(2).write.saveAsTable(f"{name}.t")  # a plain table of an earlier layout
        for n in (3, 4):
            assert sinks.full_refresh(spark, [("t", spark.range(n))], name) == {"t": n}
            assert spark.table(f"{name}.t").count() == n
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_migrations_run_once(spark, table, monkeypatch):
    calls = []

    def doubled(df):
        calls.append(1)
        return df.withColumn("v", F.concat("v", "v"))

    steps = [("wide", lambda d: sinks.widen(d, {"k": "string"})), ("doubled", doubled)]
    with monkeypatch.context() as m:
        real = versions.Versions.commit
        m.setattr(versions.Versions, "commit", lambda self, n, c: real(self, n, c) if "doubled" not in c.get("steps", []) else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.migrate(table, steps)
    assert sinks.migrate(table, steps) == ["doubled"] and sinks.migrate(table, steps) == [] and len(calls) == 2
    assert rows(table.read().where("k = 1")) == [("1", "v1v1")]
    table.upsert(spark.createDataFrame([("1", "again")], "k string, v string"))
    assert rows(table.read().where("k = 1")) == [("1", "again")] and table.read().count() == 40


def test_backfilled_keys(spark):
    df = spark.createDataFrame([("a", "u/a", 1), (None, "u/a", 2), (None, "u/b", 3), (None, "u/b", 4), (None, None, 5), ("c", None, 6), ("c", None, 7), (" ", "x", 8)], "key string, url string, n int")
    made = F.regexp_extract("url", "u/(.*)", 1)
    got = sinks.backfill_key(df, "key", made, [F.desc("n")])
    assert sorted((r.key, r.n) for r in got.collect()) == [("a", 1), ("b", 4), ("c", 7)]


def test_day_index_reads_only_its_days(spark, tmp_path):
    root, read = f"file://{tmp_path}", []
    schema = "id long, day string, keep boolean"

    def source(files):
        read.append(files)
        return spark.read.schema(schema).json(files)

    each = microbatch.rewrite_indexed_days(lambda d: d.where("keep"), source, f"{root}/out", ["day"], f"{root}/index")

    def land(name, data):
        spark.createDataFrame(data, schema).coalesce(1).write.json(f"{root}/landing/{name}")
        stream = microbatch.landing(spark, f"{root}/landing/*", spark.createDataFrame([], schema).schema)
        microbatch.run_now(microbatch.with_files(stream), each, f"{root}/check")

    land("one", [(1, "d1", True), (2, "d1", True)])
    land("two", [(3, "d2", True)])
    land("three", [(4, "d2", True), (5, "d3", False)])
    assert [len(f) for f in read] == [1, 1, 2]
    assert rows(spark.read.parquet(f"{root}/out").select("id", F.col("day").cast("string"))) == [(1, "d1"), (2, "d1"), (3, "d2"), (4, "d2")]


def test_an_emptied_day_goes(spark, tmp_path):
    root = f"file://{tmp_path}"
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id int, day string")
    microbatch.rewrite_days(lambda d: d, lambda: batch, f"{root}/out", ["day"])(batch, 0)
    microbatch.rewrite_days(lambda d: d.where("id > 1"), lambda: batch, f"{root}/out", ["day"])(batch, 1)
    assert rows(spark.read.parquet(f"{root}/out").select("id", F.col("day").cast("string"))) == [(2, "b")]
