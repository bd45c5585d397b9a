"""Sources, sinks, sites and serving over the driver's tables: written, read back, compared."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.functions import cleaning
from loam.operators import dashboards, relational, resolve, sites, vectors
from loam.plans.registry import query
from loam.plans.tables import t
from loam.session import work_dir
from loam.sources import scan, sheets, sinks
from loam.sources.adverts import parse_adverts
from loam.sources.schemas import raw_schema
from loam.sources.versions import KeyedTable, Published


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, min(event_type) AS first FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-04' AND DATE '2024-01-09' GROUP BY ALL""")
def q_bronze_days(spark: SparkSession, sf: str) -> DataFrame:
    """SC-01, SK-01, SK-02, PF-14: landing days written as gzipped lines, a range of them read back through the site's schema."""
    root = work_dir(spark)
    raw = t(spark, sf, "events").select(F.concat(F.lit("https://x.example/"), F.col("event_id").cast("string")).alias("job_url"), F.col("event_type").alias("job_title"), F.col("ts").alias("d"))
    # Staging lines first, as a crawler appends them, then the landing layer.
    sinks.append_lines(raw.select("job_url", "job_title", F.date_format("d", "yyyy-MM-dd").alias("scraped_at")), f"{root}/staging")
    staged = spark.read.schema(raw_schema("topcv")).json(f"{root}/staging")
    parts = {c: F.substring("scraped_at", at, n) for c, at, n in (("year", 1, 4), ("month", 6, 2), ("day", 9, 2))}
    sinks.to_bronze(staged.withColumns(parts).hint("rebalance", F.col("year"), F.col("month"), F.col("day")), f"{root}/bronze/topcv")
    found = scan.bronze(spark, f"{root}/bronze/topcv", "topcv", "2024-01-04", "2024-01-09")
    rows = found if found is not None else staged.withColumns(parts).where("false")
    return rows.groupBy(F.concat_ws("-", "year", "month", "day").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.min("job_title").alias("first"))


@query("""SELECT c_mktsegment AS segment, count(*) AS records FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY ALL""")
def q_line_counts(spark: SparkSession, sf: str) -> DataFrame:
    """SC-12: non-blank lines of landed objects; a blank line is written beside each row."""
    root = work_dir(spark)
    c = t(spark, sf, "customer").where("c_mktsegment IS NOT NULL")
    lines = c.select("c_mktsegment", F.explode(F.array(F.to_json(F.struct("c_custkey", "c_name")), F.lit("  "))).alias("value"))
    lines.write.option("compression", "gzip").partitionBy("c_mktsegment").text(root)
    counted = scan.line_counts(spark, [f"{root}/*"])
    segment = F.url_decode(F.regexp_extract("key", "c_mktsegment=([^/]+)/", 1))
    return counted.groupBy(segment.alias("segment")).agg(F.sum("records").alias("records"))


@query("""SELECT 'dim_nation_taxonomy' AS dim, CAST(n_nationkey AS VARCHAR) AS key, n_name AS label FROM nation
UNION ALL SELECT 'dim_region_taxonomy', CAST(r_regionkey AS VARCHAR), r_name FROM region""")
def q_taxonomy_tables(spark: SparkSession, sf: str) -> DataFrame:
    """SK-11, SK-10, SC-06: taxonomy sheets become dimension tables, others are ignored."""
    root = work_dir(spark)
    database = f"taxonomy_{root.rsplit('/', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    names = {"nation_taxonomy": ("nation", "n_nationkey", "n_name"), "region_taxonomy": ("region", "r_regionkey", "r_name"), "places": ("nation", "n_nationkey", "n_name")}
    for stem, (name, key, label) in names.items():
        sinks.replace_sheet(t(spark, sf, name).select(F.col(key).alias("key"), F.col(label).alias("label")), f"{root}/{stem}.csv")
    made = sinks.taxonomy_tables(spark, [f"{root}/{stem}.csv" for stem in names], database)
    return relational.union_all([spark.table(f"{database}.{d}").select(F.lit(d).alias("dim"), "key", "label") for d in made])


#: Keys that a made sheet spans, so that a sheet stays small however many parts there are.
SHEET_KEYS = 1 << 16


@query("""SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_brand END AS brand, CASE WHEN p_partkey % 5 = 0 THEN chr(65533) || 'x' ELSE 'a, "b"' || chr(10) || 'c' END AS note
FROM part WHERE p_partkey % 11 <> 0""")
def q_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """SC-05 to SC-07, SC-13: an edited sheet: byte-order mark, blank header cells, short and blank rows, quoted breaks, bytes that aren't UTF-8."""
    root = work_dir(spark)
    p = t(spark, sf, "part")
    note = F.when(F.col("p_partkey") % 5 == 0, F.unhex(F.lit("FF78"))).otherwise(F.encode(F.lit('"a, ""b""\nc"'), "UTF-8"))
    start = F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name", F.when(F.col("p_partkey") % 7 != 0, F.col("p_brand")).otherwise(""))
    row = F.when(F.col("p_partkey") % 11 == 0, F.encode(F.lit(" ,,"), "UTF-8")).otherwise(F.concat(F.encode(F.concat(start, F.lit(",")), "UTF-8"), note, F.encode(F.lit(",,"), "UTF-8")))
    # A sheet for each brand and range of keys, its header first; the text sink writes the bytes of a string as they are.
    sheet = [F.col("p_brand"), F.floor(F.col("p_partkey") / SHEET_KEYS).alias("keys")]
    head = p.select(*sheet).distinct().select("p_brand", "keys", F.lit(0).alias("place"), F.encode(F.lit("\ufeff id ,name, brand,note,,"), "UTF-8").alias("row"))
    body = p.select(*sheet, F.lit(1).alias("place"), F.concat(row, F.encode(F.lit("\r"), "UTF-8")).alias("row"))
    lines = head.unionByName(body).repartition("p_brand", "keys").sortWithinPartitions("p_brand", "keys", "place")
    lines.select("p_brand", "keys", F.col("row").cast("string").alias("value")).write.partitionBy("p_brand", "keys").option("lineSep", "\n").text(f"{root}/sheets")
    return sheets.sheet(spark, f"{root}/none", f"{root}/sheets").select("id", "name", "brand", "note")


@query("""WITH seed AS (SELECT DISTINCT upper(trim(n_name)) AS variant, upper(trim(r_name)) AS canonical FROM nation JOIN region ON n_regionkey = r_regionkey),
m AS (SELECT variant, min(canonical) AS canonical FROM (SELECT variant, canonical, 0 AS own FROM seed UNION ALL SELECT canonical, canonical, 1 FROM seed) AS b
      WHERE own = 0 OR canonical NOT IN (SELECT variant FROM seed) GROUP BY variant)
SELECT c_custkey, n_name AS company, m.canonical FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN m ON m.variant = upper(n_name)
UNION ALL SELECT -r_regionkey - 1, r_name, upper(r_name) FROM region UNION ALL SELECT -100, 'ZZZ', NULL""")
def q_company_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """C-04, J-01: variants to canonical names, canonical names to themselves, unknown ones to nothing."""
    n, r = t(spark, sf, "nation"), t(spark, sf, "region")
    seed = relational.company_seed_rows(n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.lower("n_name").alias("variant_name"), F.concat(F.lit(" "), "r_name").alias("canonical_name")))
    c = t(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("company"))
    c = c.unionByName(r.select((-F.col("r_regionkey") - 1).cast(c.schema["c_custkey"].dataType).alias("c_custkey"), F.col("r_name").alias("company")))
    c = c.unionByName(spark.range(1).select(F.lit(-100).cast(c.schema["c_custkey"].dataType).alias("c_custkey"), F.lit("ZZZ").alias("company")))
    return relational.mapped(c, seed, "company", "variant_name", "canonical_name").select("c_custkey", "company", F.col("canonical_name").alias("canonical"))


@query("""SELECT 'https://x.example/' || c_custkey AS job_url, CASE c_custkey % 3 WHEN 0 THEN 'topcv' WHEN 1 THEN 'itviec' ELSE 'vietnamworks' END AS source_site, upper(c_name) AS company,
CASE WHEN c_nationkey % 2 = 0 THEN 'Hà Nội' ELSE 'Không xác định' END AS place, CASE WHEN c_nationkey % 2 = 0 THEN 'Việt Nam' ELSE 'Nước ngoài' END AS country,
CASE WHEN c_custkey % 3 = 0 THEN ['IT', 'Others'] ELSE ['IT'] END AS industries, c_nationkey * 1e6 AS low, (c_nationkey + 5) * 1e6 AS high,
CASE WHEN c_custkey % 2 = 0 THEN ['Python', 'SQL'] ELSE ['SQL'] END AS tools, CASE WHEN c_custkey % 3 <> 1 THEN CAST(c_nationkey AS DOUBLE) END AS exp,
CASE WHEN c_custkey % 3 <> 2 THEN 50 END AS size FROM customer WHERE c_custkey % 10 <> 0""")
def q_site_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """C-20, PF-01, PF-03: raw adverts of three sites made of customers, each through its site's cleaning."""
    key, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    c = t(spark, sf, "customer").select(
        key, F.when(key % 10 == 0, F.lit(None).cast("string")).otherwise(F.lit("[Hot] Senior Dev")).alias("job_title"), F.concat(F.lit("Công ty TNHH "), F.translate("c_name", "#", "#")).alias("company_name"),
        F.when(F.col("c_nationkey") % 2 == 0, "Quận 1, Hà Nội").otherwise("Nước ngoài").alias("location"), F.when(key % 3 == 0, "it phần mềm, bán lẻ").otherwise("it phần mềm, bán lẻ").alias("job_industry"),
        F.concat(n, F.lit(" - "), (F.col("c_nationkey") + 5).cast("string"), F.lit(" triệu")).alias("salary"), F.when(key % 2 == 0, "Biết Python và SQL").otherwise("SQL").alias("requirements"),
        F.concat(n, F.lit(" năm")).alias("experience_level"), F.lit("50-100").alias("company_size"), F.concat(F.lit("https://x.example/"), key.cast("string"), F.lit("?ref=a")).alias("job_url"),
    )
    none = spark.createDataFrame([], "variant_name string, canonical_name string")
    seeds = sites.Seeds(none, [("ha noi", "Hà Nội")], [("it", "IT")], [], {"require_tools": [("python", "Python"), ("sql", "SQL")]})
    out = []
    for k, name in enumerate(("topcv", "itviec", "vietnamworks")):
        schema = raw_schema(name)
        rows = c.where(key % 3 == k)
        raw = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None).cast("string")).alias(f.name) for f in schema]).withColumn("source_site", F.lit(name))
        out.append(sites.clean_site(raw, sites.SITES[name], seeds))
    clean = relational.union_all(out)
    return clean.select(
        "job_url", "source_site", F.col("clean_company_name").alias("company"), F.col("clean_location").alias("place"), F.col("is_vietnam").alias("country"), F.col("job_industry_clean").alias("industries"),
        F.col("min_monthly_salary").alias("low"), F.col("max_monthly_salary").alias("high"), F.array_sort("require_tools").alias("tools"), F.col("min_exp_level").alias("exp"), F.col("min_company_size").cast("int").alias("size"),
    )


def _customer_pages(spark: SparkSession, sf: str, *parts: F.Column | str, url: str = "https://x.example/c/") -> DataFrame:
    html = F.concat(F.lit("<html><body>"), *[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("</body></html>"))
    return t(spark, sf, "customer").select(F.concat(F.lit(url), F.col("c_custkey").cast("string")).alias("url"), html.alias("html"))


@query("""SELECT 'https://x.example/brand/' || c_custkey AS job_url, c_name AS job_title, 'C ' || c_nationkey AS company_name, c_nationkey || ' triệu' AS salary, c_mktsegment AS location,
'IT / ' || c_mktsegment AS job_industry, (c_nationkey + 10) || ' nhân viên' AS company_size, CASE WHEN c_custkey % 2 = 0 THEN '01/02/2026' ELSE strftime(DATE '2026-01-01' + CAST(c_nationkey AS INTEGER), '%d/%m/%Y') END AS job_deadline FROM customer""")
def q_adverts_brand(spark: SparkSession, sf: str) -> DataFrame:
    """SC-15: brand pages of the first site: company, pay, place, industry, size and deadline, also a relative one."""
    n = F.col("c_nationkey").cast("string")
    label = lambda name, value: F.concat(F.lit(f"<div><span>{name}</span><b>"), value, F.lit("</b></div>"))
    pages = _customer_pages(
        spark, sf, '<h2 class="job-title">', F.col("c_name"), '</h2><p class="company-name">C ', n, '</p><script>window.qgTracking = {"job_category": "IT \\/ ', F.col("c_mktsegment"), '"}</script>',
        label("Mức lương", F.concat(n, F.lit(" triệu"))), label("Địa điểm", F.concat(F.lit("Địa điểm:\xa0"), "c_mktsegment")), label("Quy mô", F.concat((F.col("c_nationkey") + 10).cast("string"), F.lit(" nhân viên"))),
        F.when(F.col("c_custkey") % 2 == 0, label("Hạn nộp hồ sơ", F.lit("01/02/2026"))).otherwise(F.concat(F.lit('<span class="deadline">Còn '), n, F.lit(" ngày</span>"))), url="https://x.example/brand/",
    )
    return parse_adverts(pages, "topcv", date(2026, 1, 1)).select("job_url", "job_title", "company_name", "salary", "location", "job_industry", "company_size", "job_deadline")


@query("""SELECT 'https://x.example/c/' || c_custkey AS job_url, 'topcv' AS source_site, c_mktsegment AS location, 'A & ' || c_name AS company_name, c_nationkey || '-' || (c_nationkey + 9) || ' người' AS company_size,
'05/0' || (1 + c_nationkey % 9) || '/2026' AS job_deadline, 'Đại học' AS education_level, 'Ý ' || c_custkey || ' B' AS requirements FROM customer""")
def q_adverts_topcv(spark: SparkSession, sf: str) -> DataFrame:
    """SC-15: usual pages of the first site: fields in labelled boxes, entities, lists of a part."""
    n = F.col("c_nationkey").cast("string")
    box = lambda name, css, value: F.concat(F.lit(f'<div class="{css[0]}">{name}</div><div class="{css[1]}">'), value, F.lit("</div>"))
    pages = _customer_pages(
        spark, sf, '<a class="text-dark-blue">A &amp; ', F.col("c_name"), '</a><span class="hight-light city-name">', F.col("c_mktsegment"), "</span>",
        box("Quy mô", ("box-company-info-detail__list--item-title", "box-company-info-detail__list--item-desc"), F.concat(n, F.lit("-"), (F.col("c_nationkey") + 9).cast("string"), F.lit(" người"))),
        box("Hạn ứng tuyển", ("list-info__content__title", "list-info__content__desc"), F.concat(F.lit("05/0"), (1 + F.col("c_nationkey") % 9).cast("string"), F.lit("/2026"))),
        box("Học vấn", ("box-job-information-general-info-list__item--content-title", "box-job-information-general-info-list__item--content-desc"), F.lit("Đại học")),
        box("Yêu cầu ứng viên", ("box-job-information-detail-item__title", "box-job-information-detail-item__text"), F.concat(F.lit("<ul><li>Ý "), F.col("c_custkey").cast("string"), F.lit("</li><li>B</li></ul>"))),
    )
    return parse_adverts(pages, "topcv", date(2026, 1, 1)).select("job_url", "source_site", "location", "company_name", "company_size", "job_deadline", "education_level", "requirements")


@query("""SELECT 'https://x.example/c/' || c_custkey AS job_url, 'itviec' AS source_site, c_name AS job_title, c_mktsegment AS company_name, c_nationkey || ' USD' AS salary, 'Ha Noi' AS location,
CASE WHEN c_custkey % 2 = 0 THEN (c_nationkey || '-99') END AS company_size, 'A B' AS requirements, 'D ' || c_custkey AS job_description FROM customer""")
def q_adverts_itviec(spark: SparkSession, sf: str) -> DataFrame:
    """SC-16: panels of the second site; the size is the second of its small labels, if there is one."""
    small = '<small class="normal-text text-it-black col">'
    pages = _customer_pages(
        spark, sf, '<h2 class="x text-it-black text-hover-red">', F.col("c_name"), '</h2><a class="normal-text" href="/companies/x">', F.col("c_mktsegment"), '</a><span class="ips-2 fw-500">', F.col("c_nationkey").cast("string"),
        ' USD</span><div class="d-inline-block text-dark-grey">Ha Noi</div>' + small + "Product</small>", F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(small), F.col("c_nationkey").cast("string"), F.lit("-99</small>"))).otherwise(""),
        '<section class="job-description"><p>D</p><p>', F.col("c_custkey").cast("string"), '</p></section><section class="job-experiences"><p>A</p><p>B</p></section>',
    )
    return parse_adverts(pages, "itviec", date(2026, 1, 1)).select("job_url", "source_site", "job_title", "company_name", "salary", "location", "company_size", "requirements", "job_description")


@query("""SELECT 'https://x.example/c/' || c_custkey AS job_url, 'vietnamworks' AS source_site, c_name AS job_title, c_mktsegment AS job_industry, c_nationkey || ' năm' AS experience_level, 'Cử nhân' AS education_level,
strftime(DATE '2026-01-01' + CAST(CASE WHEN c_custkey % 2 = 0 THEN c_nationkey ELSE 30 * c_nationkey END AS INTEGER), '%Y-%m-%d') AS job_deadline, 'Y ' || c_custkey AS requirements FROM customer""")
def q_adverts_vietnamworks(spark: SparkSession, sf: str) -> DataFrame:
    """SC-17, D-06: details of the third site, with its relative deadline in days or months."""
    n = F.col("c_nationkey").cast("string")
    field = lambda name, value: F.concat(F.lit(f"<div><label>{name}</label><p>"), value, F.lit("</p></div>"))
    pages = _customer_pages(
        spark, sf, '<h1 name="title">', F.col("c_name"), "</h1><span>Hết hạn trong ", n, F.when(F.col("c_custkey") % 2 == 0, " ngày</span>").otherwise(" tháng</span>"), field("LĨNH VỰC", F.col("c_mktsegment")),
        field("SỐ NĂM KINH NGHIỆM TỐI THIỂU", n), field("TRÌNH ĐỘ HỌC VẤN TỐI THIỂU", F.lit("Cử nhân")), F.concat(F.lit("<div><h2>Yêu cầu</h2><div><p>Y</p><p>"), F.col("c_custkey").cast("string"), F.lit("</p></div></div>")),
    )
    return parse_adverts(pages, "vietnamworks", date(2026, 1, 1)).select("job_url", "source_site", "job_title", "job_industry", "experience_level", "education_level", "job_deadline", "requirements")


@query("""WITH e AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings), q AS (SELECT e AS q FROM e WHERE vec_id = 0),
s AS (SELECT vec_id, list_dot_product(e, q) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(q, q))) AS score FROM e, q),
r AS (SELECT *, row_number() OVER (ORDER BY score DESC, vec_id) AS k FROM s WHERE vec_id % 3 = 0), w AS (SELECT *, row_number() OVER (ORDER BY score DESC, vec_id) AS k FROM s WHERE vec_id <> 7)
SELECT 'strict' AS kind, vec_id, round(score, 6) AS score FROM r WHERE k <= 15 UNION ALL SELECT 'fallback', vec_id, round(score, 6) FROM w WHERE k <= 25""")
def q_strict_search(spark: SparkSession, sf: str) -> DataFrame:
    """VX-08: enough rows meet the strict condition; too few do, and all rows count but for the one that never may."""
    e = t(spark, sf, "embeddings")
    q = e.where("vec_id = 0").first()["embedding"]
    strict = vectors.search(e, q, 15, "embedding", "vec_id", strict=F.col("vec_id") % 3 == 0, fallback=25)
    few = vectors.search(e, q, 15, "embedding", "vec_id", strict=F.col("vec_id") < 5, fallback=25, must=F.col("vec_id") != 7)
    pick = lambda df, kind: df.select(F.lit(kind).alias("kind"), "vec_id", F.round("score", 6).alias("score"))
    return pick(strict, "strict").unionByName(pick(few, "fallback"))


@query("""SELECT user_id, arg_max(value, event_id) AS value, max(event_id) AS event_id, 4 AS versions, 1 AS rewritten FROM events WHERE event_id IS NOT NULL GROUP BY user_id""")
def q_keyed_versions(spark: SparkSession, sf: str) -> DataFrame:
    """SK-06, SK-08: a table by key grows by three batches; a batch of one key then rewrites one bucket and leaves the other files."""
    table = KeyedTable(spark, work_dir(spark), "user_id", 16)
    e = t(spark, sf, "events").select("user_id", "value", "event_id")
    for k in range(3):  # in the order of their ids, so that later rows replace earlier ones
        bounds = e.agg(F.min("event_id"), F.max("event_id")).first()
        low, high = (bounds[0] + (bounds[1] - bounds[0] + 1) * j // 3 for j in (k, k + 1))
        table.upsert(e.where(F.col("event_id").between(low, high - 1)), [F.desc("event_id")])
    before = table.versions.newest()[1]["buckets"]
    table.upsert(table.read().orderBy("user_id").limit(1))
    number, after = table.versions.newest()
    changed = sum(before.get(b) != p for b, p in after["buckets"].items())
    return table.read().select("user_id", "value", "event_id", F.lit(number).alias("versions"), F.lit(changed).alias("rewritten"))


@query("""SELECT 'jobs' AS name, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders UNION ALL SELECT 'sites', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer""")
def q_published(spark: SparkSession, sf: str) -> DataFrame:
    """SK-05: tables that appear together; a build that fails leaves each of them as it was."""
    home = Published(spark, work_dir(spark))
    o, c = t(spark, sf, "orders").select(F.col("o_orderkey").alias("key")), t(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    home.publish([("jobs", o.limit(1)), ("sites", c)])
    home.publish([("jobs", o)])
    broken = c.select(F.raise_error(F.lit("no")).cast(c.schema["key"].dataType).alias("key"))
    try:
        home.publish([("jobs", o.where("false")), ("sites", broken)])
    except Exception as e:  # noqa: BLE001 - whatever Spark wraps the failure in
        if "no" not in str(e):
            raise
    return relational.union_all([home.read(n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("rows"), F.sum("key").cast("long").alias("keys")) for n in home.names()])


@query("""WITH r AS (SELECT CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'https://x.example/j-' || (o_orderkey % 300) END AS unique_url, 'https://x.example/j-' || (o_orderkey % 300) AS made, o_orderkey AS k, o_orderdate FROM orders),
n AS (SELECT coalesce(unique_url, made) AS u, k, row_number() OVER (PARTITION BY coalesce(unique_url, made) ORDER BY (unique_url IS NOT NULL) DESC, k DESC) AS p FROM r)
SELECT u AS unique_url, CAST(k AS BIGINT) AS k, 3 AS steps FROM n WHERE p = 1""")
def q_migrations(spark: SparkSession, sf: str) -> DataFrame:
    """SK-07, W-03: a column added, one widened, keys filled in and made unique, each once though asked twice."""
    o = t(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("row"), F.concat(F.lit("https://x.example/j-"), (F.col("o_orderkey") % 300).cast("string"), F.lit("?q=1")).alias("job_url"),
        F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("https://x.example/j-"), (F.col("o_orderkey") % 300).cast("string"))).alias("unique_url"), F.col("o_orderkey").cast("string").alias("k"),
    )
    table = KeyedTable(spark, work_dir(spark), "row", 8)
    table.upsert(o)
    steps = [
        ("scraped_at", lambda d: sinks.add_columns(d, {"scraped_at": "date", "k": "string"})),
        ("k as a number", lambda d: sinks.widen(d, {"k": "bigint"})),
        ("unique_url", lambda d: sinks.backfill_key(d, "unique_url", cleaning.clean_url(F.col("job_url")), [F.desc("k")])),
    ]
    done = sinks.migrate(table, steps)
    again = sinks.migrate(table, steps)
    return table.read().where(F.col("scraped_at").isNull()).select("unique_url", "k", F.lit(len(done) - len(again)).alias("steps"))


@query("""WITH m AS (SELECT c_mktsegment AS segment, count(*) AS customers FROM customer GROUP BY ALL), d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY ALL),
t AS (SELECT *, row_number() OVER (ORDER BY orders DESC, day) AS k FROM d)
SELECT 'bar' AS mark, segment AS x, customers AS y FROM m UNION ALL SELECT 'line', CAST(day AS VARCHAR), orders FROM t WHERE k <= 500""")
def q_dashboard(spark: SparkSession, sf: str) -> DataFrame:
    """SK-12, F-28: a page with charts of two aggregates, read back from its text."""
    from html.parser import HTMLParser

    m = t(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("customers"))
    d = t(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    text = dashboards.page("Silver <jobs>", [dashboards.html_table(m, "Segments", order=["segment"]), ("Segments", dashboards.chart(m, "segment", "customers")), ("Days", dashboards.chart(d, "day", "orders", "line"))])
    specs = []

    class Reader(HTMLParser):
        inside = False

        def handle_starttag(self, tag: str, attrs: list) -> None:
            self.inside = tag == "script" and ("type", "application/json") in attrs

        def handle_data(self, data: str) -> None:
            if self.inside:
                specs.append(json.loads(data))
                self.inside = False

    Reader().feed(text)
    rows = [(s["mark"], v[s["encoding"]["x"]["field"]], v[s["encoding"]["y"]["field"]]) for s in specs for v in s["data"]["values"]]
    return spark.createDataFrame(rows, "mark string, x string, y long")


@query("""SELECT c_mktsegment AS segment, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys, 'int' AS kind FROM customer GROUP BY ALL""")
def q_inferred_csv(spark: SparkSession, sf: str) -> DataFrame:
    """SC-08, SC-04: a reference file with inferred types."""
    path = work_dir(spark)
    sheets.write_sheet(t(spark, sf, "customer").select("c_custkey", "c_mktsegment"), path)
    read = scan.inferred_csv(spark, path)
    if not {"c_custkey", "c_mktsegment"} <= scan.columns_of(read):
        raise ValueError("columns are missing")
    return read.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").cast("long").alias("keys"), F.lit(dict(read.dtypes)["c_custkey"]).alias("kind"))


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS job_url, n_name AS job_title FROM nation""")
def q_latest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """SC-09: the newest staging file by its name."""
    root = work_dir(spark)
    n = t(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("job_url"), F.col("n_name").alias("job_title"))
    names = [f"{root}/topcv_jobs_2026010{k}.jsonl" for k in (2, 1)]
    for path, rows in zip(names, (n, n.where("job_title < 'F'")), strict=True):
        sinks.append_lines(rows, path)
    return scan.latest_lines(spark, names, T.StructType([T.StructField("job_url", T.StringType()), T.StructField("job_title", T.StringType())]))


@query("""SELECT 'counted' AS kind, count(*) AS n FROM customer UNION ALL SELECT 'written', count(*) FROM customer""")
def q_dump(spark: SparkSession, sf: str) -> DataFrame:
    """SK-04: a dry run that counts, and a dump that is read back."""
    c, path = t(spark, sf, "customer"), work_dir(spark)
    counted, written = sinks.dump(c, None), sinks.dump(c, path)
    back = spark.read.parquet(path).agg(F.lit("written").alias("kind"), F.count(F.lit(1)).alias("n")).where(F.col("n") == written)
    return spark.range(1).select(F.lit("counted").alias("kind"), F.lit(counted).cast("long").alias("n")).unionByName(back)


@query("""SELECT r_name AS site, count(*) AS customers, 1 AS failed FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA' GROUP BY ALL""")
def q_per_site(spark: SparkSession, sf: str) -> DataFrame:
    """VX-07, SK-06: keyed rows of each site go to one table; a site that fails leaves the others whole and is named."""
    n, r = t(spark, sf, "nation"), t(spark, sf, "region")
    c = t(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", F.col("r_name").alias("site"))
    path = work_dir(spark)

    def step(site: str) -> None:
        rows = c.where(F.col("site") == site)
        if site == "ASIA":
            rows = rows.withColumn("c_custkey", F.raise_error(F.lit("no rows")).cast(c.schema["c_custkey"].dataType))
        sinks.upsert_table(rows, path, "c_custkey")

    failed = sinks.per_site(sorted(x["r_name"] for x in r.select("r_name").collect()), step)
    return KeyedTable(spark, path, "c_custkey").read().groupBy("site").agg(F.count(F.lit(1)).alias("customers"), F.lit(len(failed)).alias("failed"))


_LCS = """list_reduce(list_prepend({{'v': (1::HUGEINT << length({a})) - 1, 'm': 0::HUGEINT}}, [{{'v': 0::HUGEINT, 'm': coalesce(list_sum([CASE WHEN {a}[i] = ch THEN 1::HUGEINT << (i - 1) ELSE 0::HUGEINT END FOR i IN range(1, length({a}) + 1)]), 0)::HUGEINT}} FOR ch IN string_split({b}, '')]),
    lambda s, x: {{'v': ((s.v + (s.v & x.m)) | (s.v - (s.v & x.m))) & ((1::HUGEINT << length({a})) - 1), 'm': x.m}}).v"""


#: Token-set similarity of the names in ``k``, all pairs measured.
FUZZY_SQL = """s AS (SELECT k, length(k) AS n, list_sort(list_distinct(list_filter(string_split(k, ' '), lambda x: x <> ''))) AS t FROM k),
p AS (SELECT a.k AS a, b.k AS b, list_sort(list_intersect(a.t, b.t)) AS c, list_sort(list_filter(a.t, lambda x: NOT list_contains(b.t, x))) AS x, list_sort(list_filter(b.t, lambda x: NOT list_contains(a.t, x))) AS y
      FROM s AS a JOIN s AS b ON a.k < b.k WHERE least(a.n, b.n) >= 0.6 * greatest(a.n, b.n)),
j AS (SELECT a, b, array_to_string(c, ' ') AS c, len(c) AS nc, len(x) AS nx, len(y) AS ny, array_to_string(list_concat(c, x), ' ') AS l, array_to_string(list_concat(c, y), ' ') AS r FROM p),
m AS (SELECT *, length(l) - bit_count(""" + _LCS.format(a="l", b="r") + """) AS lcs FROM j WHERE NOT (nc > 0 AND (nx = 0 OR ny = 0))),
f AS (SELECT a, b, CAST(floor(greatest(200.0 * lcs / (length(l) + length(r)), CASE WHEN nc > 0 THEN 200.0 * length(c) / (length(c) + least(length(l), length(r))) ELSE 0 END) + 0.5) AS INTEGER) AS score FROM m
      UNION ALL SELECT a, b, 100 FROM j WHERE nc > 0 AND (nx = 0 OR ny = 0))
SELECT a, b, score FROM f WHERE score >= 90"""


@query("""WITH k AS (SELECT DISTINCT n_name || ' ' || s_name AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 2 = 0 UNION SELECT DISTINCT s_name || ' ' || n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 2 = 1),
""" + FUZZY_SQL)
def q_fuzzy_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """J-08, ER-04: names of suppliers with their nations, in either order, linked by their token sets."""
    s = t(spark, sf, "supplier").join(t(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.when(F.col("s_suppkey") % 2 == 0, F.concat_ws(" ", "n_name", "s_name")).otherwise(F.concat_ws(" ", "s_name", "n_name"))
    return resolve.fuzzy_pairs(s.select(key.alias("key")))
