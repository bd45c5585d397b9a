"""Gold layer: staging, date dimension, fact, bridges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions import cleaning, fixed
from loam.functions.text import trim_ws
from loam.operators.relational import keep_first, surrogate_ids


def country_flag(c: Column) -> Column:
    """PF-09: text to true, false or null."""
    text = F.lower(F.trim(c.cast("string")))
    return F.when(text == "việt nam", True).when(text == "nước ngoài", False)


def gold_url(df: DataFrame) -> Column:
    """The key: a non-blank ``unique_url`` if there is one, else derived from URL and site."""
    derived = cleaning.unique_url(cleaning.clean_url(F.col("job_url").cast("string")), F.col("source_site"))
    if "unique_url" not in df.columns:
        return derived
    return F.coalesce(F.nullif(trim_ws(F.col("unique_url").cast("string")), F.lit("")), derived)


def staging(silver: DataFrame) -> DataFrame:
    """W-01, W-02, PF-10: newest row per key with a surrogate id; rows without a key count as one key.

    ``silver`` has year, month, day and filename. ``job_url`` is replaced by the key.
    """
    keyed = silver.withColumn("__key", gold_url(silver))
    newest = [F.col(c).try_cast("int").desc() for c in ("year", "month", "day")] + [F.desc("filename")]
    kept = keep_first(keyed, ["__key"], newest)
    out = surrogate_ids(kept, [F.col("__key").asc_nulls_last()])
    return out.withColumn("job_url", F.col("__key")).drop("__key", "filename")


def date_key(year: Column, month: Column, day: Column) -> Column:
    """D-03."""
    return year.cast("int") * 10000 + month.cast("int") * 100 + day.cast("int")


def dim_date(days: DataFrame) -> DataFrame:
    """D-04 over a calendar of ``full_date``."""
    d = F.col("full_date")
    iso = F.expr("extract(DAYOFWEEK_ISO FROM full_date)").cast("int")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), d, F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.dayofmonth(d).alias("day"), iso.alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"), (iso >= 6).alias("is_weekend"),
    )


def facts(staged: DataFrame, columns: list[str]) -> DataFrame:
    return staged.select("job_id", *columns, date_key(F.col("year"), F.col("month"), F.col("day")).alias("date_key"))


def bridge(staged: DataFrame, lists: str, name: str, key: str = "job_id") -> DataFrame:
    """AR-05, PF-11: one row per list element; null and empty lists give none."""
    return staged.select(key, F.explode(lists).alias(name))


def requirements(staged: DataFrame, types: list[tuple[str, str]] = fixed.REQUIREMENT_TYPES, key: str = "job_id") -> DataFrame:
    """SO-01: (key, requirement_type, value) of all list columns in one scan instead of a union."""
    have = [(c, t) for c, t in types if c in staged.columns]
    pairs = F.array(*[F.struct(F.lit(t).alias("requirement_type"), F.col(c).alias("v")) for c, t in have])
    one = staged.select(key, F.explode(pairs).alias("p"))
    return one.select(key, "p.requirement_type", F.explode("p.v").alias("value"))
