"""Scans: landing files, partitioned layers, seeds, inventory, calendar, links."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.sources.schemas import raw_schema
from loam.sources.sheets import cells, sheet, tidy_sheet

#: Names of the files that one write job makes.
WRITE = r"^part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})"
KEY = r"source_site=([^/]+)/year=(\d{4})/month=(\d{2})/day=(\d{2})/"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    return bool(found)


def bronze(spark: SparkSession, root: str, site: str, start: str, end: str) -> DataFrame | None:
    """SC-01 with PF-14: landing rows of the inclusive date range, or None if no day has files.

    JSON lines (gzip by suffix) with an explicit schema; a malformed line becomes a row of
    nulls, which the essential-column filter drops.
    """
    if not _exists(spark, f"{root}/year=*/month=*/day=*"):
        return None
    schema = T.StructType([*raw_schema(site).fields, *[T.StructField(c, T.StringType()) for c in ("year", "month", "day")]])
    rows = spark.read.schema(schema).option("basePath", root).option("mode", "PERMISSIVE").json(f"{root}/year=*/month=*/day=*")
    day = F.concat_ws("-", "year", "month", "day")
    out = rows.where(day.between(start, end))
    return out if not out.isEmpty() else None


def silver_all(spark: SparkSession, root: str) -> DataFrame:
    """SC-03: every snapshot, columns united by name, with the file's name."""
    return spark.read.option("mergeSchema", "true").parquet(root).select("*", F.col("_metadata.file_path").alias("filename"))


def silver_latest(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """SC-02, A-11: of each partition only the newest snapshot (ties: greater name), with all of its files.

    Files that one write made share the identifier in their names; a file of another make is
    a snapshot of its own. The listing comes from file metadata; the driver gets a pattern per
    partition, not a path per file, and older snapshots are never read. Columns a snapshot
    lacks are null.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root).select("path", "modificationTime")
    part = F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    job = F.regexp_extract(name, WRITE, 1)
    files = files.select("modificationTime", part.alias("part"), F.when(job != "", F.concat(F.lit("part-*-"), job, F.lit("*"))).otherwise(name).alias("snapshot"))
    per = files.groupBy("part", "snapshot").agg(F.max("modificationTime").alias("at"))
    newest = per.groupBy("part").agg(F.max_by("snapshot", F.struct("at", "snapshot")).alias("snapshot"))
    paths = sorted(f"{r['part']}/{r['snapshot']}" for r in newest.collect())
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def columns_of(df: DataFrame) -> set[str]:
    """SC-04."""
    return set(df.columns)


@lru_cache(maxsize=64)
def _packaged(path: str) -> tuple[tuple[tuple[str, str], ...], ...]:
    """Rows of a seed that comes with this package, a file of the driver's own; read once per process."""
    with open(path, "rb") as f:
        header, body = tidy_sheet(cells(f.read()))
    return tuple(tuple(zip(header, r, strict=True)) for r in body)


_SHEETS: dict[tuple[str, str], list[dict[str, str]]] = {}


def seed(path: str, fallback: str | None = None, spark: SparkSession | None = None) -> list[dict[str, str]]:
    """SC-05, SC-07: rows of a small seed as dictionaries.

    With ``spark``, the sheet at ``path`` on any store, read once per application; if there is
    none, and without ``spark``, a file that comes with the package.
    """
    if spark is not None:
        key = (spark.sparkContext.applicationId, path)
        if key not in _SHEETS:
            try:
                _SHEETS[key] = [r.asDict() for r in sheet(spark, path).collect()]
            except FileNotFoundError:
                if fallback is None:
                    raise
                return [dict(r) for r in _packaged(fallback)]
        return [dict(r) for r in _SHEETS[key]]
    try:
        return [dict(r) for r in _packaged(path)]
    except OSError:
        if fallback is None:
            raise
        return [dict(r) for r in _packaged(fallback)]


def inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """SC-08: header and inferred types, for small reference files."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def latest_lines(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """SC-09: the newest staging file by name."""
    return spark.read.schema(schema).json(max(paths))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """SC-10, SC-11: key, source_site, collection_date, size_bytes of every object with a partitioned key."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    date = F.concat_ws("-", *[F.regexp_extract("path", KEY, k) for k in (2, 3, 4)])
    return files.where(F.col("path").rlike(KEY)).select(
        F.regexp_extract("path", KEY, 1).alias("source_site"), date.alias("collection_date"), F.col("length").alias("size_bytes"), F.col("path").alias("key")
    )


def line_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SC-12: non-blank lines of each object (gzip by suffix)."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("key"))
    return lines.groupBy("key").agg(F.count_if(F.trim("value") != "").alias("records"))


def review_table(spark: SparkSession, path: str, n: int = 500, fallback: str | None = None) -> DataFrame:
    """SC-13, SL-04: the first rows of a review sheet, else of ``fallback``; bytes that aren't UTF-8 are replaced."""
    return sheet(spark, path, fallback).limit(n)


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """SC-14: full_date, a row per day, both ends included."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("full_date"))


def calendar_of(df: DataFrame, column: str) -> DataFrame:
    """SC-14: full_date, a row per day from the least to the greatest date of a table; none for an empty one."""
    ends = df.agg(F.min(F.to_date(column)).alias("first"), F.max(F.to_date(column)).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last")).alias("full_date"))


def provinces(spark: SparkSession, path: str) -> DataFrame:
    """The geographic dimension."""
    rows = [(r["province_name"], float(r["latitude"]), float(r["longitude"])) for r in seed(path)]
    return spark.createDataFrame(rows, "province_name string, latitude double, longitude double")


def job_links(html):
    """SC-18: link targets of a page, in order."""
    return F.regexp_extract_all(html, F.lit('href="([^"]*)"'), F.lit(1))


def source_sites(inventory_df: DataFrame) -> DataFrame:
    """SC-11: the sites that have objects."""
    return inventory_df.select("source_site").distinct()


