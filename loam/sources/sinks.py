"""Sinks: landing and layer writes, full refresh, keyed upsert, migrations, sheets."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.functions.text import trim_ws
from loam.operators.relational import keep_first, unused
from loam.sources.schemas import PARTITIONS
from loam.sources.sheets import sheet, write_sheet
from loam.sources.versions import KeyedTable, Published


def append_lines(df: DataFrame, path: str) -> None:
    """SK-01: JSON lines, appended; characters beyond ASCII stay as they are."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def to_bronze(df: DataFrame, root: str) -> None:
    """SK-02: gzipped JSON lines by year, month and day, never overwritten."""
    df.write.mode("append").option("compression", "gzip").partitionBy("year", "month", "day").json(root)


def to_silver(df: DataFrame, root: str) -> None:
    """SK-03: one new file for each task and (site, day); earlier snapshots stay.

    Rows of a partition are brought together first, so a day isn't scattered over small files;
    large days are split again by the rebalance.
    """
    df.hint("rebalance", *[F.col(c) for c in PARTITIONS]).write.mode("append").partitionBy(*PARTITIONS).parquet(root)


def dump(df: DataFrame, path: str | None) -> int:
    """SK-04: debug dump; without a path a dry run that counts."""
    if path is None:
        return df.count()
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()


def published(spark: SparkSession, database: str = "gold") -> Published:
    """The versions of a database's tables."""
    return Published(spark, f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/versions")


def full_refresh(spark: SparkSession, tables: list[tuple[str, DataFrame]], database: str = "gold") -> dict[str, int]:
    """SK-05, A-07: build every table, then switch to all of them by one manifest; their row counts.

    If a build fails, nothing changes. The catalog has a view for each table, which follows
    the switch; who needs all tables from one version reads ``published``. The version before
    is kept for readers that have begun.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    home = published(spark, database)
    counts = home.publish(tables)
    there = {x.name: x.tableType for x in spark.catalog.listTables(database)}
    for name, _ in tables:
        if there.get(name.lower(), "VIEW") != "VIEW":
            spark.sql(f"DROP TABLE {database}.{name}")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM parquet.`{home.path(name)}`")
    home.vacuum(2)
    return counts


def upsert_table(new: DataFrame, path: str, key: str) -> int:
    """SK-06, SK-08: keyed upsert of a versioned table; rows of one key count once, whichever it is."""
    return KeyedTable(new.sparkSession, path, key).upsert(new.dropDuplicates([key]))


def upsert_external(df: DataFrame, send: Callable[[list[tuple]], None], batch: int = 100) -> None:
    """SK-06 to another store: each task sends its rows in batches; ``send`` must be idempotent."""

    def run(rows: Iterable) -> None:
        held = []
        for row in rows:
            held.append(tuple(row))
            if len(held) >= batch:
                send(held)
                held = []
        if held:
            send(held)

    df.foreachPartition(run)


def per_site(sites: list[str], step: Callable[[str], None]) -> dict[str, str]:
    """SK-06, VX-07: run each site; failures are collected by site and don't stop the others."""
    failed = {}
    for site in sites:
        try:
            step(site)
        except Exception as e:  # noqa: BLE001 - isolation is the purpose
            failed[site] = f"{type(e).__name__}: {e}"
    return failed


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """SK-07: idempotent migration; columns that exist stay."""
    for name, kind in columns.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def widen(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """SK-07: columns take another type; values that don't fit are null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in columns.items() if name in df.columns})


def backfill_key(df: DataFrame, key: str, made: Column, newest: list[Column]) -> DataFrame:
    """SK-07: a key for rows that lack one, then one row per key.

    A row that had its key wins over those that get it; among equals the first by ``newest``.
    Rows for which no key can be made go.
    """
    had = unused(df, "had")
    keyed = df.withColumn(had, F.col(key).isNotNull()).withColumn(key, F.coalesce(F.col(key), made))
    keyed = keyed.where(F.coalesce(trim_ws(F.col(key).cast("string")), F.lit("")) != "")
    return keep_first(keyed, [key], [F.desc(had), *newest]).drop(had)


def migrate(table: KeyedTable, steps: list[tuple[str, Callable[[DataFrame], DataFrame]]]) -> list[str]:
    """SK-07: apply the named steps that the table hasn't had yet, in order; the names applied.

    The names are part of the version that a step makes, so after a crash a step is either
    done and known, or neither.
    """
    return [name for name, step in steps if table.migrate(name, step)]


def replace_sheet(df: DataFrame, path: str) -> None:
    """SK-10, SK-13: one sheet with header, null as empty text."""
    write_sheet(df, path)


def taxonomy_tables(spark: SparkSession, paths: list[str], database: str = "gold") -> list[str]:
    """SK-11: ``dim_<stem>`` for each ``*_taxonomy.csv``; other files are ignored."""
    done = []
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for path in sorted(paths):
        stem = path.rsplit("/", 1)[-1].removesuffix(".csv")
        if stem.endswith("_taxonomy"):
            sheet(spark, path).write.mode("overwrite").saveAsTable(f"{database}.dim_{stem}")
            done.append(f"dim_{stem}")
    return done
