"""Monitoring aggregates and consumer queries."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loam.operators.relational import first_n

MB = 1048576


def storage(df: DataFrame, keys: list[str], size: str = "size_bytes") -> DataFrame:
    """A-03, A-04: megabytes (two decimals) and objects by group."""
    return df.groupBy(*keys).agg(F.round(F.sum(size) / MB, 2).alias("size_mb"), F.count(F.lit(1)).alias("objects"))


def summary(df: DataFrame, size: str, group: str) -> DataFrame:
    """A-06: one row: total, distinct groups, rows."""
    return df.agg(F.sum(size).alias("total"), F.count_distinct(group).alias("groups"), F.count(F.lit(1)).alias("rows"))


def recent(df: DataFrame, group: str, date: str, last: str, days: int = 7, n: int = 50, tie: str | None = None) -> DataFrame:
    """D-09, DQ-06, W-04: per group the newest ``n`` rows of the last ``days`` days up to ``last``."""
    window = df.where((F.col(date) <= F.to_date(F.lit(last))) & (F.col(date) >= F.date_sub(F.to_date(F.lit(last)), days - 1)))
    return first_n(window, [group], [F.desc(date), *([F.asc(tie)] if tie else [])], n)


def unmapped(df: DataFrame, column: str = "job_industry_unmapped", n: int = 500) -> DataFrame:
    """DQ-05, SL-04."""
    return df.where(F.size(column) > 0).limit(n)


def ranked(df: DataFrame, group: str, value: str) -> DataFrame:
    """BI-03: values of each group by demand, ties by value."""
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("demand"))
    w = Window.partitionBy(group).orderBy(F.desc("demand"), value)
    return counts.withColumn("place", F.row_number().over(w))


def rolling(df: DataFrame, month: str, value: str, over: int = 3) -> DataFrame:
    """BI-06 over a contiguous monthly series: rolling mean and growth against the year before.

    The series has one row per month, so a single window partition is small by nature.
    """
    w = Window.orderBy(month)
    before = F.lag(value, 12).over(w)
    return df.select(
        month, value, F.round(F.avg(value).over(w.rowsBetween(1 - over, 0)), 4).alias("rolling_mean"),
        F.round((F.col(value) - before) / F.nullif(before, F.lit(0)), 4).alias("yoy"),
    )


def job_search(df: DataFrame, title: str | None, filters: list[Column], order: list[Column], n: int) -> DataFrame:
    """SV-01: a case-insensitive part of the title, filters, order, limit."""
    if title:
        df = df.where(F.contains(F.lower("job_title"), F.lit(title.lower())))
    for f in filters:
        df = df.where(f)
    return df.orderBy(*order).limit(n)


def freshness(df: DataFrame, site: str, day: str, today: date, late: int = 1) -> DataFrame:
    """MO-01: of each source its newest day, days with data, rows, days behind ``today`` and state."""
    per_day = df.groupBy(site, day).agg(F.count(F.lit(1)).alias("n"))  # counts of days are exact and narrow
    found = per_day.groupBy(site).agg(F.max(day).alias("newest"), F.count(F.lit(1)).alias("days"), F.sum("n").alias("rows"))
    behind = F.date_diff(F.lit(today), "newest").cast("long")
    return found.select(
        F.col(site).alias("source_site"), F.col("newest").cast("string").alias("newest"), "days", "rows", behind.alias("days_behind"),
        F.when(behind <= late, "fresh").otherwise("stale").alias("state"),
    )


def site_list(text: str | None) -> list[str]:
    """PF-16: names of a comma-separated list, trimmed, without empty ones."""
    return [name for part in (text or "").split(",") if (name := part.strip())]


def ordered_union(*lists: Iterable[str]) -> list[str]:
    """SO-05: all values once, in the order in which they first come."""
    return list(dict.fromkeys(v for values in lists for v in values))


def day_range(start: str, end: str) -> tuple[str, str]:
    """PF-16: an inclusive range of ISO days; raises ValueError if it is none."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    if first > last:
        raise ValueError(f"{start} is after {end}")
    return first.isoformat(), last.isoformat()
