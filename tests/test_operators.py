"""Relational, gold, resolution, vector, quality, source and stream operators on small frames."""

import datetime as dt
import itertools
import json
import math

import pytest
from pyspark.sql import functions as F

from loam.functions import fixed
from loam.operators import dashboards, gold, quality, relational, reports, resolve, sites, vectors
from loam.sources import adverts, scan, schemas, sinks
from loam.sources.versions import KeyedTable
from loam.streaming import microbatch


def test_latest_snapshot_per_key(spark):
    rows = [("k", "topcv", "2024", "01", "01", "f9"), ("k", "topcv", "2024", "01", "02", "f1"), ("k", "topcv", "2024", "01", "02", "f2"), (None, None, "2024", "01", "01", "f1"), (None, None, "2024", "01", "01", "f3")]
    df = spark.createDataFrame(rows, "job_url string, source_site string, year string, month string, day string, filename string").withColumn("f", F.col("filename"))
    got = [(r.job_id, r.job_url, r.day, r.f) for r in gold.staging(df).orderBy("job_id").collect()]
    assert got == [(1, "k", "02", "f2"), (2, None, "01", "f3")]
    assert [r.date_key for r in gold.facts(gold.staging(df), ["job_url"]).where("job_url = 'k'").collect()] == [20240102]


def test_bridges(spark):
    df = spark.createDataFrame([(1, ["a", None], []), (2, None, ["x"])], "job_id long, require_tools array<string>, require_frameworks array<string>")
    assert sorted(map(tuple, gold.requirements(df).collect()), key=repr) == [(1, "tool", "a"), (1, "tool", None), (2, "framework", "x")]
    assert gold.bridge(df, "require_tools", "tool").count() == 2
    assert [r[0] for r in spark.createDataFrame([("Việt Nam",), ("nước ngoài ",), ("Không xác định",)], "c string").select(gold.country_flag(F.col("c"))).collect()] == [True, False, None]


def test_keyed_operators(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert sorted(map(tuple, relational.upsert(old, old.where("k = 2").withColumn("v", F.lit("c")), "k").collect())) == [(1, "a"), (2, "c")]
    df = spark.createDataFrame([(k % 5, k) for k in range(100)], "k int, v int")
    assert relational.keep_first(df, ["k"], [F.desc("v")]).agg(F.sum("v")).first()[0] == 95 + 96 + 97 + 98 + 99
    ids = relational.surrogate_ids(df, [F.col("v")]).orderBy("v").collect()
    assert [r.job_id for r in ids] == list(range(1, 101))
    assert dict(relational.company_seed([("fpt", "Tập đoàn FPT")])) == {"FPT": "TẬP ĐOÀN FPT", "TẬP ĐOÀN FPT": "TẬP ĐOÀN FPT"}


def test_fuzzy_pairs_lose_nothing(spark):
    assert resolve.token_set_ratio("LOTTE MART", "MART LOTTE") == 100
    assert resolve.token_set_ratio("FPT", "FPT TELECOM") == 100
    assert resolve.token_set_ratio("", "A") == 0
    names = ["LOTTE MART", "MART LOTTE", "FPT", "FPT TELECOM", "VIETTEL POST", "VIETEL POST", "A B C", "A B D", "XYZ", "LOTTE MARTS HN"]
    got = {(r.a, r.b) for r in resolve.fuzzy_pairs(spark.createDataFrame([(n,) for n in names], "key string")).collect()}
    ok = lambda a, b: min(len(a), len(b)) >= 0.6 * max(len(a), len(b)) and int(resolve.token_set_ratio(a, b) + 0.5) >= fixed.FUZZY_SCORE
    assert got == {tuple(sorted(p)) for p in itertools.combinations(names, 2) if ok(*p)}
    found = resolve.clusters(spark.createDataFrame(list(got), "a string, b string"))
    named = spark.createDataFrame([(n, n) for n in names], "name string, key string")
    out = resolve.review(named, found, spark.createDataFrame([("LOTTE MART",)], "c string")).collect()
    assert [(r.cluster_id, r.has_in_company_mapping) for r in out if r.name == "LOTTE MART"] == [(1, 1)]


def test_quality(spark):
    rows = lambda n: spark.createDataFrame([(None if k < n else "t", "u") for k in range(100)], "job_title string, job_url string")
    wanted = quality.expectations("vietnamworks", ["job_title"], [])
    assert quality.gate(rows(4), wanted) and not quality.gate(rows(6), wanted)
    df = spark.createDataFrame([("x/brand/1", None), ("x", "10"), (None, "1")], "job_url string, company_size string")
    assert quality.gate(df, [e for e in quality.expectations("topcv", [], ["company_size"])])


def test_vectors(spark):
    v = lambda x: spark.range(1).select(vectors.normalised(F.array(*map(F.lit, x)))).first()[0]
    assert v([3.0, 4.0]) == [0.6, 0.8] and v([0.0, 0.0]) == [0.0, 0.0]
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], "id int, vector array<double>")
    assert [r.id for r in vectors.search(df, [1.0, 0.1], 2).collect()] == [1, 3]
    assert [r.id for r in vectors.search(df, [1.0, 0.1], 2, strict=F.col("id") == 2).collect()] == [1, 3, 2]
    m = lambda y, lo, hi: spark.range(1).select(vectors.experience_match(F.lit(y).cast("double"), F.lit(lo).cast("double"), F.lit(hi).cast("double"))).first()[0]
    assert (m(None, 1, 2), m(3, None, None), m(5, 1, 2), m(1, 4, None)) == (1.0, 0.8, 0.85, 0.0)
    jobs = spark.createDataFrame([("u", " T ", ["a", " "], None, "d")], "unique_url string, job_title string, require_tools array<string>, requirements_cleaned string, job_description_cleaned string")
    assert jobs.select(vectors.document_text(jobs)).first()[0] == "T\nrequire_tools: a\njob_description_cleaned: d"
    p = vectors.points(vectors.embed(jobs, "job_title", vectors.hashing_embedder(8))).first()
    assert math.isclose(sum(x * x for x in p.vector), 1) and "requirements_cleaned" not in json.loads(p.payload)


def test_expiry(spark):
    d = dt.date
    rows = [("topcv", d(2024, 1, 1), None), ("topcv", d(2024, 1, 20), None), ("vietnamworks", d(2024, 1, 20), None), ("vietnamworks", d(2024, 1, 29), None), ("topcv", None, None), ("topcv", d(2024, 1, 20), d(2023, 1, 1))]
    df = spark.createDataFrame(rows, "source_site string, silver_date date, indexed_at date")
    assert vectors.unexpired(df, F.to_date(F.lit("2024-01-31"))).count() == 4


@pytest.fixture
def raw(spark):
    base = {f.name: None for f in schemas.raw_schema("topcv")}
    one = base | {"job_title": "Senior Data Engineer", "company_name": "Công ty TNHH FPT", "location": "Hà Nội", "job_industry": "IT,Bán lẻ", "source_site": "topcv", "job_url": "https://x/1?a=b", "salary": "10 - 20 triệu", "requirements": "Python, SQL", "benefits": "bảo hiểm", "company_size": "50-100", "job_deadline": "5/1/2026"}
    two = base | {"job_title": None, "company_name": "x"}
    return spark.createDataFrame([tuple(r.values()) for r in (one, two)], schemas.raw_schema("topcv"))


def test_site_pipeline(spark, raw):
    seeds = sites.Seeds(spark.createDataFrame(relational.company_seed([("FPT", "TẬP ĐOÀN FPT")]), "variant_name string, canonical_name string"), [("ha noi", "Hà Nội")], [("it", "IT")], [("bao hiem", "Bảo hiểm")], {"require_programming_languages": [("python", "Python")], "require_tools": [("sql", "SQL")], "require_knowledge": None})
    for site in sites.SITES.values():
        out = sites.clean_site(raw.select([f.name for f in schemas.raw_schema(site.name)]).withColumn("source_site", F.lit(site.name)), site, seeds)
        r = out.first()
        assert out.count() == 1 and [c for c in out.columns if c in schemas.SILVER.names] == schemas.SILVER.names
        assert r.clean_company_name == "TẬP ĐOÀN FPT" and r.min_monthly_salary == 1e7 and r.require_programming_languages == ["Python"] and r.require_knowledge == [] and r.require_frameworks is None
        assert r.job_industry_clean == (["IT", "Others"] if site.name == "topcv" else ["IT"])


def test_layers_round_trip(spark, tmp_path, raw):
    root = f"file://{tmp_path}"
    day = raw.withColumns({"year": F.lit("2024"), "month": F.lit("05"), "day": F.lit("01")})
    sinks.to_bronze(day, f"{root}/bronze")
    (tmp_path / "bronze/year=2024/month=05/day=01/bad.json").write_text("{broken\n")
    got = scan.bronze(spark, f"{root}/bronze", "topcv", "2024-05-01", "2024-05-02")
    assert got.count() == 3 and relational.drop_incomplete(got, ["job_title", "company_name"]).count() == 1
    assert scan.bronze(spark, f"{root}/bronze", "topcv", "2023-05-01", "2023-05-02") is None
    assert scan.bronze(spark, f"{root}/nothing", "topcv", "2023-05-01", "2023-05-02") is None
    silver = day.withColumn("source_site", F.lit("topcv"))
    sinks.to_silver(silver, f"{root}/silver")
    sinks.to_silver(silver.limit(1).withColumn("extra", F.lit(1)), f"{root}/silver")
    assert scan.silver_all(spark, f"{root}/silver").count() == 3
    assert scan.silver_latest(spark, f"{root}/silver", silver.schema).count() == 1
    inv = scan.inventory(spark, f"{root}/silver")
    assert {(r.source_site, r.collection_date) for r in inv.collect()} == {("topcv", "2024-05-01")}
    sinks.upsert_table(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), f"{root}/t", "k")
    sinks.upsert_table(spark.createDataFrame([(2, "c")], "k int, v string"), f"{root}/t", "k")
    assert sorted(map(tuple, KeyedTable(spark, f"{root}/t", "k").read().collect())) == [(1, "a"), (2, "c")]
    assert "&lt;b&gt;" in dashboards.html_table(spark.createDataFrame([("<b>", ["x", "y"])], "a string, b array<string>"), "t")
    assert sinks.per_site(["a", "b"], lambda s: 1 / (s == "b")) == {"a": "ZeroDivisionError: division by zero"}


def test_seeds(tmp_path):
    (tmp_path / "s.csv").write_text("﻿a,b,\n1\n,\n2,3\n", encoding="utf-8")
    assert scan.seed(str(tmp_path / "s.csv")) == [{"a": "1", "b": ""}, {"a": "2", "b": "3"}]
    assert scan.seed(str(tmp_path / "none.csv"), str(tmp_path / "s.csv"))[1]["b"] == "3"


def test_stream_rewrites_days(spark, tmp_path, raw):
    root = f"file://{tmp_path}"
    day = raw.withColumns({"year": F.lit("2024"), "month": F.lit("05"), "day": F.lit("01")})
    landed = lambda: spark.read.schema(day.schema).json(f"{root}/landing")
    each = microbatch.rewrite_days(lambda d: d.dropna(subset=["job_title"]), landed, f"{root}/out", ["year", "month", "day"])
    for k in range(1, 4):
        sinks.append_lines(day, f"{root}/landing")
        microbatch.run_now(microbatch.landing(spark, f"{root}/landing", day.schema), each, f"{root}/ck")
        assert spark.read.parquet(f"{root}/out").count() == k  # rows of earlier batches stay
    each(landed(), 99)
    assert spark.read.parquet(f"{root}/out").count() == 3


def test_split_snapshots_stay_whole(spark, tmp_path):
    root = f"file://{tmp_path}/layer"
    rows = spark.range(4000).select("id", F.lit("s").alias("source_site"), F.lit("2024").alias("year"), F.lit("01").alias("month"), F.lit("02").alias("day"))
    rows.limit(10).repartition(3).write.mode("append").partitionBy(*schemas.PARTITIONS).parquet(root)
    rows.repartition(6).write.mode("append").partitionBy(*schemas.PARTITIONS).parquet(root)
    assert scan.silver_latest(spark, root, rows.schema).count() == 4000


def test_site_lists_and_ranges():
    assert reports.site_list(" a ,,b,a ") == ["a", "b", "a"] and reports.site_list(None) == []
    assert reports.ordered_union(["b", "a"], ["a", "c", "b"]) == ["b", "a", "c"]
    assert reports.day_range("2024-01-02", "2024-01-02") == ("2024-01-02", "2024-01-02")
    with pytest.raises(ValueError):
        reports.day_range("2024-01-03", "2024-01-02")


def test_advert_fields(spark):
    today = dt.date(2026, 1, 1)
    topcv = (
        '<h1 class="box-header-job__title">Dev &amp; Ops</h1><script>window.qgTracking = {"salary_range": "10 \\u2013 20 tri\\u1ec7u"}</script>'
        '<div class="box-job-information-detail-item__title"><h2>Yêu cầu ứng viên</h2></div><div class="box-job-information-detail-item__text">Python<br>SQL</div>'
        '<div class="box-job-information-general-info-list__item--content-title">Cấp bậc</div><div class="box-job-information-general-info-list__item--content-desc">Nhân viên</div>'
    )
    itviec = '<h2 class="x text-it-black text-hover-red">Dev</h2><small class="normal-text text-it-black col">Product</small><small class="normal-text text-it-black col">51-150</small><section class="job-experiences"><p>A</p><p>B</p></section>'
    works = '<h1 name="title">Dev</h1><span>Hết hạn trong 5 ngày</span><div><label>LĨNH VỰC</label><p>IT</p></div><div><label>SỐ NĂM KINH NGHIỆM TỐI THIỂU</label><p>2</p></div>'
    rows = lambda html, url="https://x/1": spark.createDataFrame([(url, html), ("u", None)], "url string, html string")
    a = adverts.parse_adverts(rows(topcv), "topcv", today).collect()
    assert (a[0].job_title, a[0].salary, a[0].requirements, a[0].job_position) == ("Dev & Ops", "10 – 20 triệu", "Python SQL", "Nhân viên")
    assert a[1].job_title is None and a[1].job_url == "u" and a[0].source_site == "topcv"
    b = adverts.parse_adverts(rows(itviec), "itviec", today).first()
    assert (b.job_title, b.company_size, b.requirements) == ("Dev", "51-150", "A B")
    c = adverts.parse_adverts(rows(works), "vietnamworks", today).first()
    assert (c.job_title, c.job_deadline, c.job_industry, c.experience_level) == ("Dev", "2026-01-06", "IT", "2 năm")
    d = adverts.parse_adverts(rows("<h2 class='job-title'>T</h2><p>Quy mô</p><b>50</b>", "https://x/brand/1"), "topcv", today).first()
    assert (d.job_title, d.company_size) == ("T", "50")
