"""Incremental loads as Structured Streaming micro-batches (``availableNow``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.operators.relational import stored
from loam.sources.versions import KeyedTable, file_system


def landing(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", files: int = 1000, clean: bool = False, archive: str | None = None) -> DataFrame:
    """ST-01: new landing files as a stream; sources may be deleted or archived once processed."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    if clean:
        reader = reader.option("cleanSource", "archive" if archive else "delete")
        if archive:
            reader = reader.option("sourceArchiveDir", archive)
    return reader.format(fmt).load(path)


def run_now(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process all that is there now, exactly once per batch number, then stop."""
    query = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def rewrite_days(transform: Callable[[DataFrame], DataFrame], source: Callable[[], DataFrame], root: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """ST-02, ST-04: rewrite just the day partitions a batch touches, from all rows that ``source`` has for them.

    Rows of earlier batches stay, and reruns are idempotent. A day that loses all its rows in
    ``transform`` is removed. ``source`` is read whole; see ``rewrite_indexed_days``.
    """

    def each(batch: DataFrame, _: int) -> None:
        days = stored(batch.select(*keys).distinct())
        _write_days(transform(source().join(days, keys, "left_semi")), days, root, keys)

    return each


def _write_days(rows: DataFrame, days: DataFrame, root: str, keys: list[str]) -> None:
    """Replace the partitions of ``rows``, and remove those of ``days`` that have no row left."""
    spark = rows.sparkSession
    rows = stored(rows)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(root)
    for day in days.join(rows.select(*keys).distinct(), keys, "left_anti").collect():
        fs, at = file_system(spark, "/".join([root.rstrip("/"), *[f"{k}={day[k]}" for k in keys]]))
        fs.delete(at, True)


def with_files(stream: DataFrame, name: str = "landing_file") -> DataFrame:
    """The stream's rows with the file each came from."""
    return stream.select("*", F.col("_metadata.file_path").alias(name))


def rewrite_indexed_days(
    transform: Callable[[DataFrame], DataFrame], source: Callable[[list[str]], DataFrame], root: str, keys: list[str], index: str, file: str = "landing_file"
) -> Callable[[DataFrame, int], None]:
    """ST-02, ST-04 with a day index: a batch reads only the landing files that hold rows of its days.

    ``index``, a folder beside the stream's checkpoint, keeps (day, file) for each batch under
    the batch's number, so a batch that runs again replaces its own entries. ``source`` reads a
    list of files, as many as the touched days have. A day that loses all its rows is removed.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.select(*keys, file).distinct().write.mode("overwrite").parquet(f"{index}/batch={number}")
        days = stored(batch.select(*keys).distinct())
        known = spark.read.schema(batch.select(*keys, file).schema).parquet(f"{index}/batch=*")
        files = sorted(r[0] for r in known.join(days, keys, "left_semi").select(file).distinct().collect())
        if files:
            _write_days(transform(source(files).join(days, keys, "left_semi")), days, root, keys)

    return each


def seen_once(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """ST-03: the first row of each key within the watermark; state is bounded by the delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def upserts(path: str, key: str, order: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """ST-05: keyed upsert of each batch; of a batch's rows with the same key the last by ``order``.

    Only the buckets a batch touches are rewritten; the version before stays for its readers.
    """

    def each(batch: DataFrame, _: int) -> None:
        table = KeyedTable(batch.sparkSession, path, key, buckets)
        table.upsert(batch, [F.desc(order)])
        table.vacuum(2)

    return each


def windowed_counts(stream: DataFrame, time: str, key: str, width: str, delay: str) -> DataFrame:
    """Counts by event-time window and key; late rows beyond the watermark are dropped (ST-07)."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), key).count()
