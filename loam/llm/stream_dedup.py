"""Operator 4: exact deduplication with stateful streaming.

A narrow log (digest, identifier, content locator) is streamed through a keyed aggregation
whose state sits in RocksDB without expiry: for each digest it keeps the smallest identifier,
the locator of that row's content and the number of rows seen. Every hit is then compared
byte for byte with content that a locator names, also content of earlier calls on a kept
state, so two texts that only share a digest are told apart. Texts move only for the hits.

A kept state folder holds the log and the content of all calls, the stream's checkpoint, the
changes of its state, and the digests found to stand for different texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm.shared import SPACE, located, settings, shared_dir, stage

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Input files of one micro-batch.
FILES_PER_BATCH = 4096


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null counts as empty.

    A lone space already is one, so only other runs are rewritten.
    """
    runs = rf"\x20{SPACE}+|[\x09-\x0D]{SPACE}*"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


def sha256(text: Column) -> Column:
    """Digest of the normalised text in UTF-8, lower-case hex."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _rank(doc_id: Column, locator: Column) -> Column:
    """Order of retention: rows with an identifier first, by it, then by locator."""
    return F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"), locator.alias("locator"))


def update_state(spark: SparkSession, log_path: str, log: DataFrame, state_dir: str) -> DataFrame:
    """Run the log's new files through the keyed state; the latest state of each digest.

    ``state_dir`` may be kept: a later call on the same log folder with more files goes on from there.
    """
    out = f"{state_dir}/changes"

    def emit(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    conf = {
        "spark__sql__streaming__stateStore__providerClass": ROCKSDB,
        "spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage": "true",
        "spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB": "128",
        # A store takes memory for its writes by an eighth of this at once, and an executor has many stores.
        "spark__sql__streaming__stateStore__rocksdb__writeBufferSizeMB": "2",
        # A committed store is closed: its local files go, the checkpoint keeps the state.
        "spark__sql__streaming__stateStore__unloadOnCommit": "true",
    }
    with settings(spark, **conf):
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(log_path)
        state = stream.groupBy("digest").agg(
            F.min(_rank(F.col("doc_id"), F.col("locator"))).alias("keeper"), F.count(F.lit(1)).alias("group_size")
        )
        run = (
            state.writeStream.outputMode("update").foreachBatch(emit)
            .option("checkpointLocation", f"{state_dir}/checkpoint").trigger(availableNow=True).start()
        )
        run.awaitTermination()
    return latest(spark, state_dir, dict(log.dtypes)["digest"])


def latest(spark: SparkSession, state_dir: str, kind: str = "binary") -> DataFrame:
    """digest, keep_id, keep_locator, group_size: the newest state of every digest."""
    schema = f"digest {kind}, keeper struct<no_id: boolean, doc_id: bigint, locator: string>, group_size long, batch long"
    changes = _read(spark, f"{state_dir}/changes", schema)
    if changes.agg(F.countDistinct("batch")).first()[0] > 1:
        newest = F.max_by(F.struct("keeper", "group_size"), "batch").alias("s")
        changes = changes.groupBy("digest").agg(newest).select("digest", "s.keeper", "s.group_size")
    return changes.select("digest", F.col("keeper.doc_id").alias("keep_id"), F.col("keeper.locator").alias("keep_locator"), "group_size")


def _path(spark: SparkSession, path: str) -> tuple:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = _path(spark, path)
    return fs.exists(where)


def _move(spark: SparkSession, path: str, to: str) -> None:
    fs, target = _path(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(_path(spark, path)[1], target):
        raise OSError(f"cannot move {path} to {to}")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder, or no rows where there is none yet."""
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


#: A join with few rows on one side: a Bloom filter of their keys keeps the other side's texts from the shuffle.
_BLOOM = {
    "spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold": "1b",
    "spark__sql__optimizer__runtime__bloomFilter__creationSideThreshold": "1g",
}


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] | None = None, state_dir: str | None = None, call: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, locator, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after ``normalised``. Of equal texts the row with the
    smallest doc_id stays; among rows that share it, the first by file and row number.
    Rows without doc_id stay only if no equal text has one. Null texts count as empty.
    An empty table gives no rows. Other columns are ignored. ``digest`` may be weak: the
    full comparison then splits the rows that collide.

    With ``state_dir`` the state is kept: ``docs`` are then new rows, and keepers and group
    sizes count the rows of all calls so far. A new row with a smaller doc_id than an earlier
    keeper takes its place. The same ``digest`` must be used in all calls.

    ``call`` names a call on a kept state: one that died, wherever it was, is run again under
    its name and counts its rows once. Without a name each call is a new one. A call that has
    once been logged keeps the rows it had then.
    """
    spark = docs.sparkSession
    folder, call = state_dir or shared_dir(spark), call or uuid.uuid4().hex
    logged = _exists(spark, f"{folder}/log/call={call}")
    if state_dir:
        # Later calls compare with these texts, whatever becomes of the input. The log names
        # their files, so they are written anew only as long as the call isn't in the log.
        if not logged:
            docs.select("doc_id", "text").write.mode("overwrite").parquet(f"{folder}/content/call={call}")
        docs = spark.read.schema("doc_id long, text string").parquet(f"{folder}/content/call={call}")
        before = stage(latest(spark, folder).select("digest", F.col("keep_locator").alias("old_locator")), "before")
    base = located(docs, "doc_id", "text")
    text = normalised(F.col("text"))
    # With the default digest a second copy of it in the log would only cost bytes.
    key = digest(text).cast("binary") if digest else F.unhex(sha256(text))
    other = sha256(text) if digest else F.lit(None).cast("string")
    narrow = base.select("doc_id", key.alias("digest"), other.alias("text_sha256"), "locator")
    if not logged:
        # Written aside and moved as a whole: the stream sees all files of a call or none, and
        # each file once.
        narrow.write.mode("overwrite").parquet(f"{folder}/pending/call={call}")
        _move(spark, f"{folder}/pending/call={call}", f"{folder}/log/call={call}")
    log = spark.read.schema(narrow.withColumn("call", F.lit("")).schema).parquet(f"{folder}/log")
    state = update_state(spark, f"{folder}/log", log, folder)
    own = log.where(F.col("call") == call).drop("call") if state_dir else log.drop("call")
    seen = own.join(state, "digest")
    # Rows are compared with the keeper that stood before this call, if there was one.
    against = F.col("keep_locator")
    if state_dir:
        seen, against = seen.join(before, "digest", "left"), F.coalesce("old_locator", "keep_locator")
    seen = stage(seen.withColumn("against", against), "seen")

    hit = seen.where("group_size > 1").select("digest", "locator", "against")
    with settings(spark, **_BLOOM):
        full = stage(base.select("locator", text.alias("body")).join(hit, "locator"), "hits")
    kept = full.where("locator = against").select("against", F.col("body").alias("kept_body"))
    if state_dir:
        old = hit.join(before, "digest").select("against").distinct()
        kept = kept.unionByName(_bodies(spark, folder, old.withColumnRenamed("against", "locator")).select(F.col("locator").alias("against"), F.col("body").alias("kept_body")))
    odd = full.where("locator <> against").join(kept, "against").where("body <> kept_body").select("digest")
    if state_dir:
        odd = odd.unionByName(_read(spark, f"{folder}/collided", "digest binary"))
    odd = stage(odd.distinct(), "collisions")
    sha = F.coalesce("text_sha256", F.lower(F.hex("digest"))).alias("text_sha256")
    if odd.isEmpty():
        return seen.select("doc_id", "locator", "keep_id", "group_size", (F.col("locator") == F.col("keep_locator")).alias("kept"), sha)
    # Digests that stand for different texts: their rows of all calls are grouped by their bytes.
    rows = log.join(odd, "digest").select("digest", "doc_id", "locator")
    if state_dir:
        odd.write.mode("append").parquet(f"{folder}/collided")
        bodies = _bodies(spark, folder, rows.select("locator"))
    else:
        bodies = base.select("locator", text.alias("body")).join(rows.select("locator"), "locator")
    rows = stage(rows.join(bodies, "locator"), "collided")
    groups = rows.groupBy("digest", "body").agg(F.min(_rank(F.col("doc_id"), F.col("locator"))).alias("k"), F.count(F.lit(1)).alias("odd_size"))
    apart = rows.join(groups, ["digest", "body"]).select("locator", F.col("k.doc_id").alias("odd_id"), F.col("k.locator").alias("odd_locator"), "odd_size")
    whole = seen.join(apart, "locator", "left")
    is_odd = F.col("odd_size").isNotNull()
    return whole.select(
        "doc_id",
        "locator",
        F.when(is_odd, F.col("odd_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(is_odd, F.col("odd_size")).otherwise(F.col("group_size")).alias("group_size"),
        (F.col("locator") == F.when(is_odd, F.col("odd_locator")).otherwise(F.col("keep_locator"))).alias("kept"),
        sha,
    )


def _bodies(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """locator, body of the rows of any call that ``wanted`` names."""
    content = spark.read.schema("doc_id long, text string").parquet(f"{folder}/content")
    with settings(spark, **_BLOOM):
        return stage(located(content, "text").select("locator", normalised(F.col("text")).alias("body")).join(wanted, "locator"), "bodies")
