"""Text, parsing and rule operators. Inputs are built from numbers, so that both engines see the same text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.functions import cleaning, text
from loam.functions.rules import KeywordSet, any_match
from loam.functions.rules import first_match as first
from loam.plans.registry import query
from loam.plans.tables import t

#: Topic rules over the documents' words.
TOPICS = [("idiot|moron|clown", "insult"), ("schl|keit|lich", "german"), ("ción|mente", "spanish"), ("the|ing", "english"), ("eau|eux", "french")]
SKILLS = [("the|ing|\\band\\b", "common"), ("of the", "phrase"), ("idiot|moron", "insult"), ("c\\+\\+|le", "code"), ("e[nr]{2}s", "pattern")]


def _case(col: str, rules: list[tuple[str, str]], other: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({col}, '({p})', 'i') THEN '{v}'" for p, v in rules) + f" ELSE {other} END"


_PLAIN = "lower(strip_accents(replace(replace(coalesce(text, ''), 'đ', 'd'), 'Đ', 'D')))"


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '&[a-z]+;|&#\d+;', ' ', 'g'),
'[•·▪►●◦‣▶★\*]', ' ', 'g'), '[\s\x0B\x{85}\p{Z}]+', ' ', 'g')) AS cleaned FROM documents""")
def q_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    """C-01, C-02, F-01, F-08 over documents."""
    return t(spark, sf, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query(r"""SELECT page_id, length(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&[a-z]+;|&#\d+;', ' ', 'g'),
'[•·▪►●◦‣▶★\*]', ' ', 'g'), '[\s\x0B\x{85}\p{Z}]+', ' ', 'g'))) AS n FROM pages""")
def q_clean_html(spark: SparkSession, sf: str) -> DataFrame:
    """C-01 over pages."""
    return t(spark, sf, "pages").select("page_id", F.length(text.clean_text(F.col("html"))).alias("n"))


@query("""SELECT doc_id, strip_accents(replace(replace(text, 'đ', 'd'), 'Đ', 'D')) AS plain FROM documents""")
def q_strip_accents(spark: SparkSession, sf: str) -> DataFrame:
    """F-12."""
    return t(spark, sf, "documents").select("doc_id", text.strip_accents(F.col("text")).alias("plain"))


@query(r"""WITH c AS (SELECT doc_id, regexp_extract_all(lower(nfc_normalize(text)), '[\p{L}\p{N}\p{M}]+|[^\p{L}\p{N}\p{M}]+') AS parts FROM documents)
SELECT doc_id, array_to_string([replace(upper(p[1]), 'ẞ', 'Ss') || p[2:] FOR p IN parts], '') AS title FROM c""")
def q_titlecase(spark: SparkSession, sf: str) -> DataFrame:
    """F-09, F-10, F-11: titlecase of composed text."""
    return t(spark, sf, "documents").select("doc_id", text.titlecase(text.nfc(F.col("text"))).alias("title"))


@query(f"""WITH d AS (SELECT doc_id, source, lang, {_case(_PLAIN, [(text_p, v) for text_p, v in [("idiot|moron|clown", "insult"), ("schl|keit|lich", "german"), ("cion|mente", "spanish"), ("the|ing", "english"), ("eau|eux", "french")]], "'Others'")} AS topic FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY source, topic ORDER BY doc_id DESC) AS k FROM d)
SELECT source, topic, count(*) AS docs, max(CASE WHEN k = 1 THEN doc_id END) AS latest FROM k GROUP BY ALL""")
def q_first_match(spark: SparkSession, sf: str) -> DataFrame:
    """J-09, F-14: clean, accent-free text to the first matching topic; newest row and count per key."""
    rules = [(p.replace("ó", "o"), v) for p, v in TOPICS]
    topic = F.coalesce(first(text.plain_lower(F.coalesce("text", F.lit(""))), rules), F.lit("Others"))
    return t(spark, sf, "documents").select("doc_id", "source", topic.alias("topic")).groupBy("source", "topic").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("latest"))


@query("""WITH d AS (SELECT doc_id, """ + _PLAIN + """ AS x FROM documents) SELECT doc_id, list_sort(list_filter([CASE WHEN regexp_matches(x, '(idiot|moron|clown)') THEN 'insult' END,
CASE WHEN regexp_matches(x, '(schl|keit|lich)') THEN 'german' END, CASE WHEN regexp_matches(x, '(cion|mente)') THEN 'spanish' END,
CASE WHEN regexp_matches(x, '(the|ing)') THEN 'english' END, CASE WHEN regexp_matches(x, '(eau|eux)') THEN 'french' END], lambda v: v IS NOT NULL)) AS labels FROM d""")
def q_multi_label(spark: SparkSession, sf: str) -> DataFrame:
    """C-10, AR-02: every matching label."""
    rules = [(p.replace("ó", "o"), v) for p, v in TOPICS]
    return t(spark, sf, "documents").select("doc_id", any_match(text.plain_lower(F.coalesce("text", F.lit(""))), rules).alias("labels"))


@query(r"""WITH d AS (SELECT doc_id, """ + _PLAIN + r""" AS x FROM documents),
f AS (SELECT doc_id, list_concat(list_transform(regexp_extract_all(x, '\b(?:of the|the|ing|and|idiot|moron|le)\b|\bc\+\+\B'), lambda w: CASE WHEN w IN ('the', 'ing', 'and') THEN 'common' WHEN w = 'of the' THEN 'phrase' WHEN w IN ('idiot', 'moron') THEN 'insult' ELSE 'code' END),
CASE WHEN regexp_matches(x, 'e[nr]{2}s') THEN ['pattern'] ELSE [] END) AS l FROM d)
SELECT doc_id, list_filter(l, lambda v, i: list_position(l, v) = i) AS skills FROM f""")
def q_hybrid_keywords(spark: SparkSession, sf: str) -> DataFrame:
    """X-01, C-11, C-12: literals in text order, then patterns; also tested against a trie in Python."""
    return t(spark, sf, "documents").select("doc_id", KeywordSet.build(SKILLS).extract(text.plain_lower(F.col("text"))).alias("skills"))


@query(f"""WITH x AS (SELECT p_partkey, CAST(p_size AS VARCHAR) AS a, CAST(p_size + 5 AS VARCHAR) AS b FROM part),
s AS (SELECT p_partkey, p_partkey % 6 AS k, CAST(a AS DOUBLE) AS a, CAST(b AS DOUBLE) AS b FROM x)
SELECT p_partkey, CASE k WHEN 0 THEN a * 1.0 * 1e6 WHEN 1 THEN a * 26000.0 WHEN 2 THEN a * 1e6 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE a * 0.083 * 1e6 END AS low,
CASE k WHEN 0 THEN b * 1.0 * 1e6 WHEN 1 THEN b * 26000.0 WHEN 2 THEN NULL WHEN 3 THEN a * 1e6 WHEN 4 THEN NULL ELSE b * 0.083 * 1e6 END AS high FROM s""")
def q_salary(spark: SparkSession, sf: str) -> DataFrame:
    """C-13: ranges, dollars, open ends, negotiable, yearly."""
    a, b, k = F.col("p_size").cast("string"), (F.col("p_size") + 5).cast("string"), F.col("p_partkey") % 6
    shown = (
        F.when(k == 0, F.concat(a, F.lit(" - "), b, F.lit(" triệu"))).when(k == 1, F.concat(a, F.lit(" - "), b, F.lit(" USD")))
        .when(k == 2, F.concat(F.lit("Từ "), a)).when(k == 3, F.concat(F.lit("Tới "), a, F.lit(" triệu"))).when(k == 4, F.lit("Thoả thuận"))
        .otherwise(F.concat(a, F.lit(" - "), b, F.lit(" triệu/năm")))
    )
    low, high = cleaning.salary(shown)
    return t(spark, sf, "part").select("p_partkey", low.alias("low"), high.alias("high"))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 0.0 WHEN 1 THEN 0.0 WHEN 2 THEN CAST(p_size AS DOUBLE) WHEN 3 THEN p_size / 12.0 WHEN 4 THEN CAST(p_size AS DOUBLE) ELSE 0.0 END AS low,
CASE p_partkey % 6 WHEN 0 THEN 0.0 WHEN 1 THEN CAST(p_size AS DOUBLE) WHEN 2 THEN NULL WHEN 3 THEN p_size / 12.0 WHEN 4 THEN CAST(p_size + 2 AS DOUBLE) ELSE NULL END AS high FROM part""")
def q_experience(spark: SparkSession, sf: str) -> DataFrame:
    """C-14."""
    a, k = F.col("p_size").cast("string"), F.col("p_partkey") % 6
    shown = (
        F.when(k == 0, F.lit("Không yêu cầu")).when(k == 1, F.concat(F.lit("Dưới "), a, F.lit(" năm"))).when(k == 2, F.concat(F.lit("Trên "), a, F.lit(" năm")))
        .when(k == 3, F.concat(a, F.lit(" tháng"))).when(k == 4, F.concat(a, F.lit(" - "), (F.col("p_size") + 2).cast("string"), F.lit(" năm")))
    )
    low, high = cleaning.experience(shown)
    return t(spark, sf, "part").select("p_partkey", low.alias("low"), high.alias("high"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN CAST(p_size AS BIGINT) END AS low, CASE WHEN p_partkey % 3 = 1 THEN CAST(p_size * 2 AS BIGINT) END AS high FROM part""")
def q_company_size(spark: SparkSession, sf: str) -> DataFrame:
    """C-15, F-06, AR-03."""
    a, k = F.col("p_size").cast("string"), F.col("p_partkey") % 3
    shown = F.when(k == 0, F.concat(a, F.lit("+"))).when(k == 1, F.concat(a, F.lit(" - "), (F.col("p_size") * 2).cast("string"))).otherwise(a)
    low, high = cleaning.company_size(shown)
    return t(spark, sf, "part").select("p_partkey", low.alias("low"), high.alias("high"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS deadline FROM orders""")
def q_deadline(spark: SparkSession, sf: str) -> DataFrame:
    """D-01, C-19: both notations, and dates that don't exist."""
    k = F.col("o_orderkey") % 3
    shown = F.when(k == 0, F.concat(F.lit("Hạn: "), F.date_format("o_orderdate", "d/M/yyyy"))).when(k == 1, F.date_format("o_orderdate", "yyyy-M-d")).otherwise(F.lit("31/02/2026"))
    return t(spark, sf, "orders").select("o_orderkey", text.deadline(shown).alias("deadline"))


@query("""SELECT o_orderkey, CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) AS ts, CAST(o_orderdate AS DATE) - 29 AS cut FROM orders""")
def q_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """D-05, D-08."""
    shown = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return t(spark, sf, "orders").select("o_orderkey", text.epoch_seconds(shown).alias("ts"), F.date_sub(F.to_date("o_orderdate"), 29).alias("cut"))


@query("""SELECT p_partkey, strftime(DATE '2026-01-01' + CAST(CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE 30 * p_size END AS INTEGER), '%Y-%m-%d') AS deadline FROM part""")
def q_relative_deadline(spark: SparkSession, sf: str) -> DataFrame:
    """D-06, D-07."""
    shown = F.concat(F.lit("Hết hạn trong "), F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 2 == 0, F.lit(" ngày")).otherwise(F.lit(" tháng")))
    return t(spark, sf, "part").select("p_partkey", text.relative_deadline(shown, F.to_date(F.lit("2026-01-01"))).alias("deadline"))


@query(r"""WITH u AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS u FROM pages)
SELECT page_id, u AS job_url, CASE page_id % 3 WHEN 0 THEN regexp_replace(u || '-' || page_id, '-\d+/?$', '') WHEN 1 THEN u ELSE u || '-' || page_id END AS unique_url FROM u""")
def q_url_clean(spark: SparkSession, sf: str) -> DataFrame:
    """C-05, F-02, F-03: decoration off, listing numbers off by site."""
    k, url = F.col("page_id") % 3, cleaning.clean_url(F.col("url"))
    number = F.col("page_id").cast("string")
    full = F.when(k == 1, F.concat(url, F.lit("--"), number, F.lit("-jv"))).otherwise(F.concat(url, F.lit("-"), number))
    site = F.when(k == 0, F.lit(" ITviec ")).when(k == 1, F.lit("vietnamworks")).otherwise(F.lit("topcv"))
    return t(spark, sf, "pages").select("page_id", url.alias("job_url"), cleaning.unique_url(full, site).alias("unique_url"))


@query("""SELECT p_partkey, regexp_replace(lower(trim('  ' || p_name || ' ')), '\\s+', '-', 'g') AS slug,
CASE WHEN p_partkey % 2 = 0 THEN 'https://x.example/p/' || p_partkey ELSE 'https://y.example/' || p_partkey END AS url FROM part""".replace("\\\\", "\\"))
def q_slug(spark: SparkSession, sf: str) -> DataFrame:
    """F-22, F-23, F-24."""
    key = F.col("p_partkey").cast("string")
    link = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("/p/"), key)).otherwise(F.concat(F.lit("https://y.example/"), key))
    return t(spark, sf, "part").select("p_partkey", text.slug(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("slug"), text.absolute_url(link, "https://x.example/").alias("url"))


@query("""WITH h AS (SELECT page_id, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode(url)) AS h FROM pages)
SELECT page_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id FROM h""")
def q_uuid5(spark: SparkSession, sf: str) -> DataFrame:
    """F-27."""
    return t(spark, sf, "pages").select("page_id", text.uuid5_url(F.col("url")).alias("id"))


@query("""SELECT p_partkey, CASE WHEN p_type LIKE '%PROMO%' THEN 'Đại học' ELSE 'Không đề cập' END AS education, CASE p_partkey % 3 WHEN 0 THEN 'Trưởng nhóm' WHEN 1 THEN 'Trưởng phòng' ELSE 'Không đề cập' END AS position,
CASE p_partkey % 3 WHEN 0 THEN 'Toàn thời gian' WHEN 1 THEN 'Bán thời gian' ELSE 'Khác' END AS job_type FROM part""")
def q_categories(spark: SparkSession, sf: str) -> DataFrame:
    """C-16, C-17, C-18."""
    k = F.col("p_partkey") % 3
    edu = F.when(F.contains("p_type", F.lit("PROMO")), F.lit("Đại học trở lên"))
    pos = F.when(k == 0, F.lit("Quản lý / Giám sát")).when(k == 1, F.lit("Quản lý"))
    kind = F.when(k == 0, F.lit("Full-time")).when(k == 1, F.lit("Bán thời gian, Full"))
    return t(spark, sf, "part").select("p_partkey", cleaning.education(edu).alias("education"), cleaning.position(pos).alias("position"), cleaning.job_type(kind).alias("job_type"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Senior Data-Engineer' WHEN 1 THEN 'Data Analyst' ELSE 'Kế Toán' END AS title,
CASE p_partkey % 4 WHEN 0 THEN ['Senior', 'Data', 'Engineer'] WHEN 1 THEN ['Data', 'Analyst'] ELSE CAST([] AS VARCHAR[]) END AS keywords FROM part""")
def q_title(spark: SparkSession, sf: str) -> DataFrame:
    """C-06, C-07."""
    k = F.col("p_partkey") % 4
    raw = F.when(k == 0, F.lit("[Hot Job] Senior DATA-engineer (Hà Nội)")).when(k == 1, F.lit("data   analyst - Upto 30tr")).otherwise(F.lit("KẾ TOÁN - Phòng Tài chính"))
    return t(spark, sf, "part").select("p_partkey", cleaning.job_title(raw).alias("title"), cleaning.title_keywords(raw).alias("keywords"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Cà Mau' ELSE 'Không xác định' END AS place, CASE p_partkey % 4 WHEN 0 THEN 'Việt Nam' WHEN 1 THEN 'Việt Nam' WHEN 2 THEN 'Nước ngoài' ELSE 'Không xác định' END AS country FROM part""")
def q_location(spark: SparkSession, sf: str) -> DataFrame:
    """C-08."""
    k = F.col("p_partkey") % 4
    raw = F.when(k == 0, F.lit("TP. Cà Mau")).when(k == 1, F.lit("Vietnam")).when(k == 2, F.lit("Nước ngoài"))
    place, country = cleaning.location(raw, [("ca mau|camau", "Cà Mau"), ("ha noi|hanoi", "Hà Nội")])
    return t(spark, sf, "part").select("p_partkey", place.alias("place"), country.alias("country"))


@query("""SELECT s_suppkey, 'SUPPLIER ' || CAST(s_suppkey AS VARCHAR) || ' FPT' AS company FROM supplier""")
def q_company_name(spark: SparkSession, sf: str) -> DataFrame:
    """C-03, F-19, F-20."""
    raw = F.concat(F.lit("Công ty TNHH Supplier-"), F.col("s_suppkey").cast("string"), F.lit(" (SHB) FPT Co., Ltd. "))
    return t(spark, sf, "supplier").select("s_suppkey", cleaning.company_name(text.nfc(raw)).alias("company"))


@query(r"""SELECT page_id, list_filter(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda x: x LIKE '/%') AS links FROM pages""")
def q_links(spark: SparkSession, sf: str) -> DataFrame:
    """SC-18."""
    from loam.sources.scan import job_links

    return t(spark, sf, "pages").select("page_id", F.filter(job_links(F.col("html")), lambda x: x.startswith("/")).alias("links"))


@query("""SELECT 'https://x.example/c/' || c_custkey AS job_url, 'topcv' AS source_site, c_name AS job_title, c_mktsegment || ' VND' AS salary, c_nationkey || ' năm' AS experience_level,
c_mktsegment AS job_type, 'Cấp ' || c_nationkey AS job_position FROM customer""")
def q_html_fields(spark: SparkSession, sf: str) -> DataFrame:
    """SC-15 to SC-17: raw rows of advert pages, one made of each customer."""
    from datetime import date

    from loam.sources.adverts import parse_adverts

    item = "box-job-information-general-info-list__item--content"
    page = F.concat(
        F.lit('<html><body><h1 class="box-header-job__title">'), "c_name", F.lit('</h1><script>window.qgTracking = {"salary_range": "'), "c_mktsegment", F.lit(' VND", "experience": "'),
        F.col("c_nationkey").cast("string"), F.lit(f' năm"}}</script><div class="{item}-title">Loại hình làm việc</div><div class="{item}-desc">'), "c_mktsegment",
        F.lit(f'</div><div class="{item}-title">Cấp bậc</div><div class="{item}-desc">Cấp '), F.col("c_nationkey").cast("string"), F.lit("</div></body></html>"),
    )
    pages = t(spark, sf, "customer").select(F.concat(F.lit("https://x.example/c/"), F.col("c_custkey").cast("string")).alias("url"), page.alias("html"))
    return parse_adverts(pages, "topcv", date(2026, 1, 1)).select("job_url", "source_site", "job_title", "salary", "experience_level", "job_type", "job_position")


@query(r"""SELECT page_id, coalesce(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''), '') AS title, nullif(regexp_extract(html, 'track\((\d+)\)', 1), '') AS tracked FROM pages""")
def q_extract(spark: SparkSession, sf: str) -> DataFrame:
    """F-05, F-21: capture groups, null without a match."""
    h = F.col("html")
    return t(spark, sf, "pages").select("page_id", F.coalesce(text.extract(h, "<title>([^<]*)</title>"), F.lit("")).alias("title"), text.extract(h, "track\\((\\d+)\\)").alias("tracked"))
