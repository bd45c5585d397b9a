"""Gold layer, entity resolution, vectors, consumer queries and micro-batches over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.operators import gold, reports, resolve, vectors
from loam.plans.q_sources import FUZZY_SQL
from loam.plans.registry import query
from loam.plans.tables import t
from loam.session import work_dir
from loam.sources.scan import calendar, calendar_of, inventory, silver_latest
from loam.sources.versions import KeyedTable
from loam.streaming import microbatch


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as adverts: several snapshots of each key, spread over days and files."""
    day = F.col("o_orderdate")
    return t(spark, sf, "orders").select(
        F.concat(F.lit("https://x.example/j-"), (F.col("o_orderkey") % 500).cast("string"), F.lit("?s="), F.col("o_orderkey").cast("string")).alias("job_url"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("topcv")).otherwise(F.lit("itviec")).alias("source_site"),
        F.when(F.col("o_orderstatus") == "F", "Việt Nam").when(F.col("o_orderstatus") == "O", " nước ngoài ").otherwise("Không xác định").alias("is_vietnam"),
        F.col("o_orderkey").alias("k"), F.date_format(day, "yyyy").alias("year"), F.date_format(day, "MM").alias("month"), F.date_format(day, "dd").alias("day"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("filename"),
    )


@query("""WITH s AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'https://x.example/j-' || (o_orderkey % 500) ELSE 'https://x.example/j' END AS job_url, o_orderstatus, o_orderkey, o_orderdate FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS k FROM s)
SELECT row_number() OVER (ORDER BY job_url) AS job_id, job_url, o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS vietnam,
CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM r WHERE k = 1""")
def q_gold_fact(spark: SparkSession, sf: str) -> DataFrame:
    """W-01, W-02, C-05, PF-08, PF-09, PF-10, D-02, D-03: newest snapshot per key as the fact table."""
    staged = gold.staging(_silver(spark, sf))
    return gold.facts(staged.withColumn("vietnam", gold.country_flag(F.col("is_vietnam"))), ["job_url", "k", "vietnam"])


@query("""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, CAST(week(d) AS INTEGER) AS week_of_year, isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders)""")
def q_dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """SC-14, D-04: a row for each day from the first order to the last."""
    return gold.dim_date(calendar_of(t(spark, sf, "orders"), "o_orderdate"))


@query("""SELECT s_suppkey AS id, n_name AS province, r_name AS region, count(*) OVER (PARTITION BY r_name) AS in_region FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def q_bi_geo(spark: SparkSession, sf: str) -> DataFrame:
    """BI-05: facts by a geographic dimension."""
    geo = t(spark, sf, "nation").join(t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t(spark, sf, "supplier").join(geo, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), F.col("n_name").alias("province"), F.col("r_name").alias("region"))
    return rows.join(rows.groupBy("region").agg(F.count(F.lit(1)).alias("in_region")), "region").select("id", "province", "region", "in_region")


@query("""SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, o_orderpriority AS site, n_name AS place, count(*) AS postings
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def q_bi_volume(spark: SparkSession, sf: str) -> DataFrame:
    """BI-01: volume over time by site and place, through the date dimension."""
    days = gold.dim_date(calendar(spark, "1990-01-01", "2030-12-31")).select("date_key", "year", "month")
    o = t(spark, sf, "orders").withColumn("date_key", F.date_format("o_orderdate", "yyyyMMdd").cast("int"))
    o = o.join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return o.join(days, "date_key").groupBy("year", "month", F.col("o_orderpriority").alias("site"), F.col("n_name").alias("place")).agg(F.count(F.lit(1)).alias("postings"))


@query("""SELECT c_mktsegment AS segment, CAST(least(floor(p / 50000), 9) AS INTEGER) AS bucket, count(*) AS jobs, round(median(p), 4) AS middle, round(quantile_cont(p, 0.9), 4) AS p90
FROM (SELECT c_mktsegment, o_totalprice AS p FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY ALL""")
def q_bi_salary_dist(spark: SparkSession, sf: str) -> DataFrame:
    """BI-02, BI-04: distribution by group and bucket, exact percentiles."""
    p = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    bucket = F.least(F.floor(F.col("o_totalprice") / 50000), F.lit(9)).cast("int").alias("bucket")
    return p.groupBy(F.col("c_mktsegment").alias("segment"), bucket).agg(
        F.count(F.lit(1)).alias("jobs"), F.round(F.percentile("o_totalprice", 0.5), 4).alias("middle"), F.round(F.percentile("o_totalprice", 0.9), 4).alias("p90")
    )


@query("""WITH r AS (SELECT 'brand' AS requirement_type, p_brand AS value FROM part UNION ALL SELECT 'type', unnest(string_split(p_type, ' ')) FROM part),
c AS (SELECT requirement_type, value, count(*) AS demand FROM r GROUP BY ALL)
SELECT *, CAST(row_number() OVER (PARTITION BY requirement_type ORDER BY demand DESC, value) AS INTEGER) AS place FROM c""")
def q_bi_skill_rank(spark: SparkSession, sf: str) -> DataFrame:
    """BI-03."""
    lists = t(spark, sf, "part").select("p_partkey", F.array("p_brand").alias("b"), F.split("p_type", " ").alias("ty"))
    return reports.ranked(gold.requirements(lists, [("b", "brand"), ("ty", "type")], "p_partkey"), "requirement_type", "value")


@query("""WITH m AS (SELECT strftime(d, '%Y-%m') AS month, count(o_orderkey) AS postings FROM generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH) AS g(d)
LEFT JOIN orders ON date_trunc('month', o_orderdate) = d GROUP BY 1)
SELECT month, postings, round(avg(postings) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS rolling_mean,
round((postings - lag(postings, 12) OVER (ORDER BY month)) / nullif(CAST(lag(postings, 12) OVER (ORDER BY month) AS DOUBLE), 0), 4) AS yoy FROM m""")
def q_bi_rolling(spark: SparkSession, sf: str) -> DataFrame:
    """BI-06 over a contiguous calendar of months."""
    months = spark.range(1).select(F.explode(F.expr("sequence(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)")).alias("d")).select(F.date_format("d", "yyyy-MM").alias("month"))
    counts = t(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    series = months.join(counts, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("postings"))
    return reports.rolling(series, "month", "postings")


@query("""SELECT p_partkey, p_name AS job_title, p_retailprice FROM part WHERE contains(lower(p_name), 'ring') AND p_brand = 'Brand#2' ORDER BY p_retailprice DESC, p_partkey LIMIT 20""")
def q_search(spark: SparkSession, sf: str) -> DataFrame:
    """SV-01, SL-04."""
    p = t(spark, sf, "part").withColumnRenamed("p_name", "job_title")
    return reports.job_search(p, "RING", [F.col("p_brand") == "Brand#2"], [F.desc("p_retailprice"), F.asc("p_partkey")], 20).select("p_partkey", "job_title", "p_retailprice")


@query("""SELECT p_partkey, CASE WHEN list_contains(string_split(p_type, ' '), 'STEEL') THEN CAST([] AS VARCHAR[]) ELSE [p_type] END AS rest FROM part WHERE NOT list_contains(string_split(p_type, ' '), 'STEEL')""")
def q_unmapped_review(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-05: rows whose list of unmapped parts isn't empty."""
    steel = F.array_contains(F.split("p_type", " "), "STEEL")
    p = t(spark, sf, "part").select("p_partkey", F.when(steel, F.array().cast("array<string>")).otherwise(F.array("p_type")).alias("rest"))
    return reports.unmapped(p, "rest", 1 << 30)


@query("""WITH k AS (SELECT DISTINCT p_name AS k FROM part), p AS (SELECT a.k AS a, b.k AS b FROM k a JOIN k b ON a.k < b.k WHERE least(length(a.k), length(b.k)) >= 0.6 * greatest(length(a.k), length(b.k)))
SELECT a, b, levenshtein(a, b) AS distance FROM p WHERE levenshtein(a, b) <= 3""")
def q_edit_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """J-08 with edit distance: names that share one of their rarest pairs of characters, a built-in measure with a limit."""
    return resolve.edit_pairs(t(spark, sf, "part").select(F.col("p_name").alias("key")), 3, 0.6)


@query("""WITH k AS (SELECT DISTINCT p_name || ' ' || p_brand AS k FROM part),
""" + FUZZY_SQL)
def q_fuzzy_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """J-08, ER-04: token-set similarity; also tested against all pairs in Python."""
    return resolve.fuzzy_pairs(t(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_brand").alias("key")))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS a, o_custkey + 7 * (1 + o_custkey % 3) AS b FROM orders),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(node, root) USING KEY (node) AS (SELECT a, min(least(a, b)) FROM both_ways GROUP BY a
UNION (SELECT n.node, min(l.root) FROM recurring.r AS n JOIN both_ways ON b = n.node JOIN r AS l ON l.node = a WHERE l.root < n.root GROUP BY n.node))
SELECT node, root FROM r""")
def q_components(spark: SparkSession, sf: str) -> DataFrame:
    """ER-05, ER-06: components of all orders' links; also tested against union-find."""
    e = t(spark, sf, "orders").select(F.col("o_custkey").alias("a"), (F.col("o_custkey") + 7 * (1 + F.col("o_custkey") % 3)).alias("b")).distinct()
    return resolve.clusters(e)


@query("""SELECT s_suppkey, 'VIETTEL ' || CAST(s_suppkey AS VARCHAR) AS key FROM supplier""")
def q_matching_key(spark: SparkSession, sf: str) -> DataFrame:
    """ER-02, ER-03."""
    name = F.concat(F.lit("VIỄN THÔNG QUÂN ĐỘI ĐẦU TƯ PHÁT TRIỂN "), F.col("s_suppkey").cast("string"))
    return t(spark, sf, "supplier").select("s_suppkey", resolve.matching_key(name).alias("key"))


@query("""SELECT doc_id, substr(coalesce(nullif(concat_ws(chr(10), nullif(trim(source), ''), 'require_tools: ' || lang, 'requirements_cleaned: ' || nullif(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '')), ''), CAST(doc_id AS VARCHAR)), 1, 6000) AS body FROM documents""")
def q_doc_text(spark: SparkSession, sf: str) -> DataFrame:
    """VX-02, F-13, F-25, F-26."""
    d = t(spark, sf, "documents").select("doc_id", F.col("source").alias("job_title"), F.array("lang").alias("require_tools"), F.col("text").alias("requirements_cleaned"), F.col("doc_id").cast("string").alias("unique_url"))
    return d.select("doc_id", vectors.document_text(d).alias("body"))


@query("""WITH q AS (SELECT [CAST(x AS DOUBLE) for x in embedding] AS e FROM embeddings WHERE vec_id = 0),
s AS (SELECT vec_id, list_dot_product([CAST(x AS DOUBLE) for x in embedding], e) / (sqrt(list_dot_product([CAST(x AS DOUBLE) for x in embedding], [CAST(x AS DOUBLE) for x in embedding])) * sqrt(list_dot_product(e, e))) AS s FROM embeddings v, q)
SELECT vec_id, round(s, 6) AS score FROM s ORDER BY s DESC, vec_id LIMIT 50""")
def q_cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    """VX-04, VX-05, VX-08, SL-05: one query vector against all rows; a top-n, no full sort."""
    v = t(spark, sf, "embeddings")
    q = v.where("vec_id = 0").select("embedding").first()[0]
    return vectors.search(v, q, 50, "embedding", "vec_id").select("vec_id", F.round("score", 6).alias("score"))


@query("""WITH j AS (SELECT p_partkey, string_split(p_type, ' ') AS skills, CAST(p_size AS DOUBLE) AS low, p_size + 5.0 AS high, p_brand FROM part),
f AS (SELECT p_partkey, 0.5 * (p_partkey % 10) / 10.0 AS c, len(list_intersect(list_distinct(skills), ['STEEL', 'ECONOMY', 'PROMO'])) / greatest(len(skills), 1) AS s,
CASE WHEN 20 >= low THEN 1.0 ELSE greatest(0.0, 1 - (low - 20) / 3) END * CASE WHEN 20 > high + 2 THEN 0.85 ELSE 1.0 END AS e, CASE WHEN p_brand = 'Brand#2' THEN 1.0 ELSE 0.0 END AS l FROM j)
SELECT p_partkey, round(c + 0.3 * s + 0.12 * e + 0.08 * l, 6) AS final FROM f ORDER BY round(c + 0.3 * s + 0.12 * e + 0.08 * l, 6) DESC, p_partkey LIMIT 10""")
def q_rerank(spark: SparkSession, sf: str) -> DataFrame:
    """VX-09, SL-05: weighted re-ranking of candidates."""
    p = t(spark, sf, "part").select("p_partkey", "p_brand", F.split("p_type", " ").alias("require_tools"), F.col("p_size").cast("double").alias("low"), (F.col("p_size") + F.lit(5.0)).alias("high"), ((F.col("p_partkey") % 10) / F.lit(10.0)).alias("cosine"))
    skills = vectors.skill_overlap({"require_tools": F.array(F.lit("STEEL"), F.lit("ECONOMY"), F.lit("PROMO"))})
    final = vectors.final_score(F.col("cosine"), skills, vectors.experience_match(F.lit(20.0), F.col("low"), F.col("high")), vectors.location_match(F.lit("Brand#2"), F.col("p_brand"), F.lit(False)))
    return p.select("p_partkey", F.round(final, 6).alias("final")).orderBy(F.desc("final"), "p_partkey").limit(10)


@query("""SELECT event_id FROM events WHERE NOT (CAST(ts AS DATE) < DATE '2024-01-03' OR (event_type = 'error' AND CAST(ts AS DATE) < DATE '2024-01-04'))""")
def q_expire(spark: SparkSession, sf: str) -> DataFrame:
    """VX-06, SK-09, ST-06, D-08: retention with a stricter site."""
    e = t(spark, sf, "events").select("event_id", F.col("event_type").alias("source_site"), F.to_date("ts").alias("silver_date"), F.lit(None).cast("date").alias("indexed_at"))
    return vectors.unexpired(e, F.to_date(F.lit("2024-01-05")), 2, {"error": 2}).select("event_id")


@query("""SELECT user_id, max(event_id) AS event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC NULLS LAST, event_id DESC) AS k FROM events) WHERE k = 1 GROUP BY 1""")
def q_latest_points(spark: SparkSession, sf: str) -> DataFrame:
    """VX-01, PF-04."""
    e = t(spark, sf, "events").select(F.col("user_id").cast("string").alias("unique_url"), "user_id", "event_id", F.to_date("ts").alias("silver_date"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("job_deadline"))
    return vectors.latest_jobs(e).select("user_id", "event_id")


@query("""WITH b AS (SELECT 'https://x.example/b/' || item_id AS unique_url, text FROM benchmark), h AS (SELECT *, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(unique_url)) AS h FROM b)
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id,
64 AS dims, CAST(to_json({'unique_url': unique_url, 'text': text}) AS VARCHAR) AS payload, 1.0 AS length FROM h""")
def q_embed_points(spark: SparkSession, sf: str) -> DataFrame:
    """VX-03, VX-04, VX-05: batches through a pluggable model to unit vectors with ids and payloads."""
    b = t(spark, sf, "benchmark").select(F.concat(F.lit("https://x.example/b/"), F.col("item_id").cast("string")).alias("unique_url"), "text")
    made = vectors.points(vectors.embed(b, "text", vectors.hashing_embedder(64)))
    return made.select("id", F.size("vector").alias("dims"), "payload", F.round(vectors.norm(F.col("vector")), 9).alias("length"))


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream; the pattern matches a single file as well as a folder."""
    schema = t(spark, sf, "events").schema
    return microbatch.landing(spark, f"{sf}/event[s].parquet", schema, "parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@query("""SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL""")
def q_stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    """ST-01, ST-07: windowed counts of a file stream, as many as a batch query gives."""
    out = work_dir(spark)
    counts = microbatch.windowed_counts(_events_stream(spark, sf), "ts", "event_type", "1 hour", "1 day")
    latest: list[int] = []

    def each(batch: DataFrame, number: int) -> None:
        batch.select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "event_type", F.col("count").alias("n"), F.lit(number).alias("batch")).write.mode("overwrite").parquet(f"{out}/counts/{number}")
        latest.append(number)

    microbatch.run_now(counts, each, f"{out}/checkpoint", "update")
    rows = spark.read.parquet(*[f"{out}/counts/{k}" for k in sorted(set(latest))])
    return rows.groupBy("hour", "event_type").agg(F.max_by("n", "batch").alias("n"))


@query("""SELECT DISTINCT user_id, event_type FROM events""")
def q_session_seen(spark: SparkSession, sf: str) -> DataFrame:
    """ST-03: first sight of each key in a stream, with state bounded by the watermark."""
    out = work_dir(spark)
    keyed = _events_stream(spark, sf).withColumn("key", F.concat_ws("|", "user_id", "event_type"))
    seen = microbatch.seen_once(keyed, "key", "ts", "3650 days").select("user_id", "event_type")
    microbatch.run_now(seen, lambda b, k: b.write.mode("overwrite").parquet(f"{out}/seen/{k}"), f"{out}/checkpoint")
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/seen")


@query("""SELECT user_id, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY user_id""")
def q_stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """ST-05, SK-06, SK-08: keyed upsert of micro-batches."""
    out = work_dir(spark)
    microbatch.run_now(_events_stream(spark, sf).select("user_id", "value", "event_id"), microbatch.upserts(f"{out}/table", "user_id", "event_id"), f"{out}/checkpoint")
    return KeyedTable(spark, f"{out}/table", "user_id").read()


@query("""SELECT source AS source_site, '2024-01-' || lpad(CAST(1 + doc_id % 3 AS VARCHAR), 2, '0') AS collection_date, count(*) AS rows, sum(n_chars) AS chars FROM documents WHERE source IS NOT NULL GROUP BY ALL""")
def q_layer_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """SK-03, SC-02, SC-03, SC-10, SC-11: a layer written twice and read back by its newest snapshots, whose days are split over files."""
    from loam.sources.sinks import to_silver

    root = f"{work_dir(spark)}/jobs"
    d = t(spark, sf, "documents").where("source IS NOT NULL").select("doc_id", "n_chars", F.col("source").alias("source_site"), F.lit("2024").alias("year"), F.lit("01").alias("month"), F.lpad((1 + F.col("doc_id") % 3).cast("string"), 2, "0").alias("day"))
    to_silver(d.where("doc_id % 2 = 0").withColumn("n_chars", F.lit(-1).cast("long")), root)
    d.repartition(5).write.mode("append").partitionBy("source_site", "year", "month", "day").parquet(root)
    found = silver_latest(spark, root, d.schema)
    known = inventory(spark, root).select("source_site", "collection_date").distinct()
    day = F.concat_ws("-", "year", "month", "day").alias("collection_date")
    rows = found.groupBy("source_site", day).agg(F.count(F.lit(1)).alias("rows"), F.sum("n_chars").alias("chars"))
    return rows.join(known, ["source_site", "collection_date"], "left_semi")




@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, sum(event_id) AS ids FROM events GROUP BY ALL""")
def q_stream_days(spark: SparkSession, sf: str) -> DataFrame:
    """ST-02, ST-04: several micro-batches touch the same days; each rewrites its days from the landing files that an index names for them."""
    out = work_dir(spark)
    e = t(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    e.repartition(4, "event_id").write.parquet(f"{out}/landing")
    each = microbatch.rewrite_indexed_days(lambda d: d, lambda files: spark.read.schema(e.schema).parquet(*files), f"{out}/days", ["day"], f"{out}/index")
    landed = microbatch.with_files(microbatch.landing(spark, f"{out}/landing", e.schema, "parquet", files=1))
    microbatch.run_now(landed, each, f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/days").groupBy(F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("""WITH m AS (SELECT c_nationkey AS root, c_name, c_custkey FROM customer), g AS (SELECT root, count(*) AS cluster_size, min(c_name) AS first FROM m GROUP BY root HAVING count(*) >= 2),
n AS (SELECT root, cluster_size, row_number() OVER (ORDER BY cluster_size DESC, first) AS cluster_id FROM g)
SELECT cluster_id, cluster_size, c_name AS name, CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS has_in_company_mapping, c_custkey AS key FROM m JOIN n USING (root)""")
def q_review(spark: SparkSession, sf: str) -> DataFrame:
    """ER-06, SL-01, A-02: clusters of customers by nation, numbered by size, with a membership flag."""
    c = t(spark, sf, "customer")
    found = c.select(F.col("c_custkey").alias("node"), F.col("c_nationkey").alias("root"))
    names = c.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("key"))
    return resolve.review(names, found, c.where("c_custkey % 10 = 0").select("c_name"))


@query("""WITH d AS (SELECT event_type, max(CAST(ts AS DATE)) AS newest, count(DISTINCT CAST(ts AS DATE)) AS days, count(*) AS rows FROM events GROUP BY event_type)
SELECT event_type AS source_site, CAST(newest AS VARCHAR) AS newest, days, rows, date_diff('day', newest, (SELECT max(newest) FROM d)) AS days_behind,
CASE WHEN date_diff('day', newest, (SELECT max(newest) FROM d)) <= 1 THEN 'fresh' ELSE 'stale' END AS state FROM d""")
def q_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """MO-01: newest day, days with data, rows and freshness by source."""
    e = t(spark, sf, "events").select(F.col("event_type").alias("source_site"), F.to_date("ts").alias("day"))
    newest = e.agg(F.max("day")).first()[0]
    return reports.freshness(e, "source_site", "day", newest)


@query("""SELECT DISTINCT source AS source_site, count(*) AS rows FROM documents WHERE source IN (SELECT source FROM documents WHERE source IS NOT NULL GROUP BY source ORDER BY source LIMIT 2) GROUP BY source""")
def q_site_filter(spark: SparkSession, sf: str) -> DataFrame:
    """PF-16, SO-05: a comma-separated site list, made unique in order, selects rows."""
    d = t(spark, sf, "documents").where("source IS NOT NULL")
    first = [r[0] for r in d.select("source").distinct().orderBy("source").limit(2).collect()]
    sites = reports.ordered_union(reports.site_list(f" {first[0]} ,,{first[-1]}"), first)
    return d.where(F.col("source").isin(*sites)).groupBy(F.col("source").alias("source_site")).agg(F.count(F.lit(1)).alias("rows"))
