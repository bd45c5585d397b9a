"""Filters, joins, aggregates, windows and set operations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.operators import quality, relational, reports
from loam.plans.registry import query
from loam.plans.tables import t
from loam.sources.schemas import conform


@query("""SELECT doc_id, source, n_chars FROM documents WHERE text IS NOT NULL AND source IS NOT NULL""")
def q_filter_essential(spark: SparkSession, sf: str) -> DataFrame:
    """PF-01, PF-03: rows lacking essential columns go; columns that don't exist aren't asked for."""
    return relational.drop_incomplete(t(spark, sf, "documents"), ["text", "source", "absent"]).select("doc_id", "source", "n_chars")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS DOUBLE) AS rating, TRY_CAST(c_name AS BIGINT) AS c_name,
CAST(c_acctbal AS VARCHAR) IS NOT NULL AS has_balance, TRY_CAST(c_mktsegment AS DOUBLE) AS c_mktsegment FROM customer""")
def q_conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    """PF-02, F-15: lenient casts, missing columns null, extra ones dropped, fixed order."""
    schema = T.StructType([T.StructField("c_custkey", T.StringType()), T.StructField("rating", T.DoubleType()), T.StructField("c_name", T.LongType()), T.StructField("has_balance", T.BooleanType()), T.StructField("c_mktsegment", T.DoubleType())])
    return conform(t(spark, sf, "customer").withColumn("has_balance", F.col("c_acctbal").isNotNull()), schema)


@query("""SELECT doc_id, lang FROM documents WHERE regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> ''""")
def q_nonblank_key(spark: SparkSession, sf: str) -> DataFrame:
    """PF-04."""
    return relational.nonblank(t(spark, sf, "documents"), "text").select("doc_id", "lang")


@query("""SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment FROM customer""")
def q_rename_project(spark: SparkSession, sf: str) -> DataFrame:
    """PF-05, PF-13: project, rename, only what exists."""
    df = relational.existing(t(spark, sf, "customer"), ["c_custkey", "c_name", "absent", "c_mktsegment"])
    return df.withColumnsRenamed({"c_custkey": "customer_id", "c_name": "customer_name", "c_mktsegment": "segment"})


@query("""SELECT event_id, TRY_CAST(props->>'$.k' AS BIGINT) AS k, TRY_CAST(event_type AS DOUBLE) AS bad,
COALESCE(TRY_CAST(event_type AS VARCHAR), CAST(user_id AS VARCHAR)) AS label FROM events""")
def q_try_cast(spark: SparkSession, sf: str) -> DataFrame:
    """PF-06, PF-07, PF-08, JS-02: lenient casts, fallbacks over columns that exist, a JSON field."""
    ev = t(spark, sf, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"), F.col("event_type").try_cast("double").alias("bad"), relational.first_available(ev, ["absent", "event_type", "user_id"], "string").alias("label"))


@query("""SELECT o_orderkey, CASE WHEN lower(trim(o_orderstatus)) = 'f' THEN TRUE WHEN lower(trim(o_orderstatus)) = 'o' THEN FALSE END AS done,
o_orderpriority FROM orders""")
def q_case_bool(spark: SparkSession, sf: str) -> DataFrame:
    """PF-09, PF-10: text to a three-valued flag; all columns but some."""
    s = F.lower(F.trim("o_orderstatus"))
    return t(spark, sf, "orders").withColumn("done", F.when(s == "f", True).when(s == "o", False)).drop("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@query("""SELECT p_partkey FROM part WHERE p_name NOT IN ('', '[]', 'null') AND len(string_split(p_type, ' ')) > 0""")
def q_non_empty(spark: SparkSession, sf: str) -> DataFrame:
    """PF-11, PF-12, AR-06."""
    p = t(spark, sf, "part").withColumn("kinds", F.split("p_type", " "))
    return p.where(relational.non_empty(p, "p_name") & relational.non_empty(p, "kinds")).select("p_partkey")


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1997-07-01'""")
def q_date_range(spark: SparkSession, sf: str) -> DataFrame:
    """PF-14: an inclusive range of days, as a filter that reaches the scan."""
    return t(spark, sf, "orders").where((F.col("o_orderdate") >= "1997-01-01") & (F.col("o_orderdate") < "1997-07-01")).select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query("""SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN (SELECT n_nationkey, min(n_name) AS n_name FROM nation WHERE n_nationkey < 20 GROUP BY 1) n ON c_nationkey = n_nationkey""")
def q_left_map(spark: SparkSession, sf: str) -> DataFrame:
    """J-01, A-09: left join with a mapping of one row per variant."""
    seed = t(spark, sf, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("k"), "n_name")
    return relational.mapped(t(spark, sf, "customer").withColumn("key", F.col("c_nationkey")), seed, "key", "k", "n_name").select("c_custkey", "c_name", "n_name")


@query("""SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000) THEN 1 ELSE 0 END AS big FROM customer""")
def q_flag_join(spark: SparkSession, sf: str) -> DataFrame:
    """J-03: membership as 0 or 1."""
    big = t(spark, sf, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return relational.membership(t(spark, sf, "customer"), big, "c_custkey", "big").select("c_custkey", "big")


@query("""SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def q_inner_meta(spark: SparkSession, sf: str) -> DataFrame:
    """J-04, J-10."""
    n = t(spark, sf, "nation").join(t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return t(spark, sf, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name", "r_name")


@query("""SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def q_semi(spark: SparkSession, sf: str) -> DataFrame:
    """J-05."""
    o = t(spark, sf, "orders").where("o_orderstatus = 'F'")
    return t(spark, sf, "customer").join(o, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)""")
def q_anti(spark: SparkSession, sf: str) -> DataFrame:
    """J-07: rows that a delete would leave."""
    return t(spark, sf, "customer").join(t(spark, sf, "orders").where("o_totalprice > 250000"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("""SELECT year(o_orderdate) AS year, r_name, count(*) AS items, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def q_star(spark: SparkSession, sf: str) -> DataFrame:
    """J-12: fact with dimensions; the optimizer broadcasts what its statistics allow."""
    fact = t(spark, sf, "lineitem").join(t(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    fact = fact.join(t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return fact.groupBy(F.year("o_orderdate").alias("year"), "r_name").agg(F.count(F.lit(1)).alias("items"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("""SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey""")
def q_self_dedup_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    """J-06, W-03: of rows with one key the one with the largest ordinal stays."""
    return relational.without_older(t(spark, sf, "orders"), "o_custkey", "o_orderkey").select("o_custkey", "o_orderkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS status FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0""")
def q_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """J-11, SK-06: keyed merge of two versions of a table."""
    o = t(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    return relational.upsert(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0").withColumn("status", F.lit("new")), "o_orderkey")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def q_dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    """W-01, A-10, SL-02."""
    return relational.keep_first(t(spark, sf, "events"), ["user_id"], [F.to_date("ts").desc(), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@query("""SELECT row_number() OVER (ORDER BY c_name, c_custkey) AS job_id, c_custkey FROM customer""")
def q_surrogate_id(spark: SparkSession, sf: str) -> DataFrame:
    """W-02, W-05: consecutive ids in key order, without a single-task window."""
    return relational.surrogate_ids(t(spark, sf, "customer").select("c_custkey", "c_name"), [F.col("c_name"), F.col("c_custkey")]).select("job_id", "c_custkey")


@query("""SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS k FROM events) WHERE k <= 50""")
def q_first_n_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """W-04."""
    return relational.first_n(t(spark, sf, "events"), ["event_type"], [F.desc("ts"), F.asc("event_id")], 50).select("event_type", "event_id")


@query("""SELECT o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS k
FROM orders WHERE o_orderdate <= DATE '1998-06-30' AND o_orderdate >= DATE '1998-06-24') WHERE k <= 50""")
def q_recent_rows(spark: SparkSession, sf: str) -> DataFrame:
    """D-09, DQ-06: the last seven days from a given day, fifty rows per group."""
    return reports.recent(t(spark, sf, "orders"), "o_orderpriority", "o_orderdate", "1998-06-30", tie="o_orderkey").select("o_orderpriority", "o_orderkey")


@query("""SELECT source, round(sum(n_chars) / 1048576.0, 2) AS size_mb, count(*) AS objects FROM documents GROUP BY source""")
def q_storage_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """A-03, F-17."""
    return reports.storage(t(spark, sf, "documents"), ["source"], "n_chars")


@query("""SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS records, round(sum(value), 2) AS total FROM events GROUP BY ALL""")
def q_daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A-04, A-05, SL-03."""
    return t(spark, sf, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("records"), F.round(F.sum("value"), 2).alias("total")).orderBy("day", "event_type")


@query("""SELECT CAST(sum(n_chars) AS BIGINT) AS total, count(DISTINCT source) AS groups, count(*) AS rows FROM documents""")
def q_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A-06, A-07."""
    return reports.summary(t(spark, sf, "documents"), "n_chars", "source")


@query("""SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS top_order FROM orders GROUP BY o_custkey""")
def q_argmax(spark: SparkSession, sf: str) -> DataFrame:
    """A-11."""
    return t(spark, sf, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("top_order"))


@query("""SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL""")
def q_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """A-08, ER-01."""
    return t(spark, sf, "part").select("p_brand").dropna().distinct()


@query("""SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS users, CAST(ts AS DATE) = max(CAST(ts AS DATE)) OVER () AS latest FROM events GROUP BY CAST(ts AS DATE)""")
def q_dates_latest(spark: SparkSession, sf: str) -> DataFrame:
    """A-13: distinct dates, the latest marked by a scalar joined back (no global window)."""
    ev = t(spark, sf, "events").select(F.to_date("ts").alias("day"), "user_id")
    days = ev.groupBy("day").agg(F.count_distinct("user_id").alias("users"))
    last = ev.agg(F.max("day").alias("last"))
    return days.join(F.broadcast(last)).select("day", "users", (F.col("day") == F.col("last")).alias("latest"))


@query("""WITH r AS (SELECT avg(CASE WHEN text IS NOT NULL THEN 1.0 ELSE 0 END) AS a, avg(CASE WHEN source IS NOT NULL THEN 1.0 ELSE 0 END) AS b,
avg(CASE WHEN lang <> 'en' THEN CASE WHEN n_chars IS NOT NULL THEN 1.0 ELSE 0 END END) AS c FROM documents)
SELECT 'text' AS "column", CAST(0.95 AS DOUBLE) AS threshold, round(a, 6) AS ratio, a >= 0.95 AS success FROM r
UNION ALL SELECT 'source', 0.8, round(b, 6), b >= 0.8 FROM r UNION ALL SELECT 'n_chars', 1.0, round(c, 6), coalesce(c >= 1, TRUE) FROM r""")
def q_nullratio(spark: SparkSession, sf: str) -> DataFrame:
    """A-12, DQ-01 to DQ-04, PF-15: shares of non-null values against thresholds, one pass."""
    wanted = [quality.Expectation("text", 0.95), quality.Expectation("source", 0.8), quality.Expectation("n_chars", 1.0, F.col("lang") != "en")]
    return quality.report(t(spark, sf, "documents"), wanted).withColumn("ratio", F.round("ratio", 6))


@query("""SELECT p_partkey, 'brand' AS requirement_type, p_brand AS value FROM part UNION ALL
SELECT p_partkey, 'type', unnest(string_split(p_type, ' ')) FROM part UNION ALL SELECT p_partkey, 'name', unnest(string_split(p_name, ' ')) FROM part""")
def q_union_all_unnest(spark: SparkSession, sf: str) -> DataFrame:
    """SO-01, AR-05, AR-07: list columns to rows in one scan."""
    from loam.operators.gold import requirements

    lists = t(spark, sf, "part").select("p_partkey", F.array("p_brand").alias("b"), F.split("p_type", " ").alias("ty"), F.split("p_name", " ").alias("n"))
    return requirements(lists, [("b", "brand"), ("ty", "type"), ("n", "name")], "p_partkey")


@query("""SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier""")
def q_union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """SO-02."""
    return t(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).union(t(spark, sf, "supplier").select("s_nationkey")).distinct()


@query("""SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""")
def q_diagonal_concat(spark: SparkSession, sf: str) -> DataFrame:
    """SO-03, SO-04."""
    c = t(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return relational.union_all([c, t(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))])


@query("""SELECT c_custkey, c_acctbal, c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100""")
def q_sort_limit(spark: SparkSession, sf: str) -> DataFrame:
    """SL-01, SL-02, SL-04: mixed order with a top-n."""
    return t(spark, sf, "customer").orderBy(F.desc_nulls_last("c_acctbal"), "c_custkey").limit(100).select("c_custkey", "c_acctbal", "c_name")


@query("""SELECT p_partkey, list_sort(list_distinct(list_transform(string_split(p_type, ' '), lambda x: CASE WHEN x LIKE '%E%' THEN 'E-group' ELSE 'Others' END))) AS labels,
list_sort(list_distinct(list_filter(string_split(p_type, ' '), lambda x: x NOT LIKE '%E%'))) AS rest FROM part""")
def q_split_map_regroup(spark: SparkSession, sf: str) -> DataFrame:
    """C-09, A-01, J-02, AR-04: split, map, regroup inside the row."""
    from loam.functions.cleaning import industries

    labels, rest = industries(F.col("p_type"), [("e", "E-group")], " ")
    return t(spark, sf, "part").select("p_partkey", labels.alias("labels"), rest.alias("rest"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS payload FROM events""")
def q_json_payload(spark: SparkSession, sf: str) -> DataFrame:
    """JS-01, JS-02, JS-03: a field out of JSON text; a payload without nulls."""
    none = F.lit(None).cast("string").alias("absent")
    return t(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.to_json(F.struct("event_type", "user_id", none)).alias("payload"))


@query("""SELECT p_partkey, list_filter([CASE WHEN p_size > 25 THEN 'big' END, CASE WHEN p_retailprice > 1500 THEN 'dear' END, p_brand], lambda x: x IS NOT NULL) AS flags,
'type: ' || array_to_string(list_filter(string_split(p_type, ' '), lambda x: x <> ''), ', ') AS line FROM part""")
def q_array_labels(spark: SparkSession, sf: str) -> DataFrame:
    """AR-01, AR-02, AR-08, AR-09, MP-01."""
    from loam.functions.text import labelled_list

    flags = F.array_compact(F.array(F.when(F.col("p_size") > 25, "big"), F.when(F.col("p_retailprice") > 1500, "dear"), F.col("p_brand")))
    return t(spark, sf, "part").select("p_partkey", flags.alias("flags"), labelled_list("type", F.split("p_type", " ")).alias("line"))


