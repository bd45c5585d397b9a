"""Operator 10: repeated passages as overlapping three-line windows.

Each run of three consecutive lines is hashed (128 bits). A window's first occurrence, by
doc_id, row and position, stays; the lines of later occurrences go, overlapping windows
being merged. Built-in functions only: windows that occur once end after one narrow
aggregate, the others meet by window, then by document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.shared import located, stage

WIDTH = 3


def windows(lined: DataFrame, width: int = WIDTH) -> DataFrame:
    """locator, doc_id, at, win: one row per window whose lines aren't all blank."""
    size = F.size("lines")
    joined = F.transform(
        F.sequence(F.lit(0), size - width),
        lambda i: F.array_join(F.slice("lines", i + 1, width), "\n"),
    )
    return (
        lined.where(size >= width)
        .select("locator", "doc_id", F.posexplode(joined).alias("at", "joined"))
        .where(F.col("joined").rlike(r"[^\x20\x09-\x0D]"))
        .select("locator", "doc_id", "at", F.unhex(F.md5(F.encode("joined", "UTF-8"))).alias("win"))
    )


def line_dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, locator, text, n_lines, n_removed: one row per row of ``docs``.

    Lines are split at ``\\n`` and compared as they are. A text of fewer lines than
    ``width`` stays whole; null counts as empty. Windows of blank lines only don't count.
    Occurrences are ordered by doc_id (rows without one come last), file and row, and
    position; of rows that repeat, also with one doc_id or none, the first keeps its lines.
    Empty tables give no rows; other columns are ignored.
    """
    base = located(docs, "doc_id", "text")
    lined = base.select("locator", "doc_id", F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    held = stage(windows(lined, width), "windows")
    # A count needs no order and is combined before the shuffle; only repeated windows go on.
    repeated = held.groupBy("win").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("win")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator", "at")
    met = stage(held.join(repeated, "win").select("win", "locator", "at", place.alias("place")), "repeated")
    first = met.groupBy("win").agg(F.min("place").alias("first"))
    later = met.join(first, "win").where(F.col("place") > F.col("first"))
    covered = later.groupBy("locator").agg(F.collect_set("at").alias("starts"))
    whole = lined.join(covered, "locator", "left")
    # Positions covered by any window; hash-based set functions, linear in the lines.
    gone = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (width - 1)))))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    rest = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    return (
        whole.withColumn("gone", gone)
        .select(
            "doc_id",
            "locator",
            F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(rest).alias("text"),
            F.size("lines").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"),
        )
    )
