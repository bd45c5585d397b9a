"""What the training-data operators share: tables, the shared folder, row locators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.session import shared_root

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder that all executors and the driver share; it goes when Spark ends."""
    own = f"{shared_root(spark)}/loam-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{own}/{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, every copy is durable."""
    path = f"{shared_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def grown(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that grows with the input: it is shuffled and sorted, never sent through the driver.

    Spark judges a side by its bytes on disk or in a shuffle, compressed, and the driver holds it decoded several times over.
    """
    return df.hint("merge")


def tidy() -> None:
    """Give this worker's free memory back to the system: its process stays for the stages that follow."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings for the actions inside; ``__`` stands for a dot."""
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: A row of a table: its number in its file, and the file.
ROW = ["row_no", "row_file"]


def numbered(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` plus ``ROW``, two integers that are unique and stable.

    A frame that isn't a plain Parquet scan is written to the shared folder first.
    """
    def pick(df: DataFrame) -> DataFrame:
        meta = df.metadataColumn("_metadata")
        return df.select(*[df[c] for c in columns], meta["row_index"].alias(ROW[0]), F.xxhash64(meta["file_path"]).alias(ROW[1]))

    try:
        found = pick(docs)
        found.schema  # noqa: B018 - resolves the hidden column or raises
        return found
    except AnalysisException:
        return pick(stage(docs.select(*columns), "numbered"))


def located(docs: DataFrame, *columns: str, name: str = "locator") -> DataFrame:
    """``columns`` of ``docs`` plus a locator: file and row number, unique and stable.

    A frame that isn't a plain Parquet scan is written to the shared folder first.
    """
    def pick(df: DataFrame) -> DataFrame:
        meta = df.metadataColumn("_metadata")
        where = F.concat_ws("#", meta["file_path"], meta["row_index"].cast("string"))
        return df.select(*[df[c] for c in columns], where.alias(name))

    try:
        found = pick(docs)
        found.schema  # noqa: B018 - resolves the hidden column or raises
        return found
    except AnalysisException:
        return pick(stage(docs.select(*columns), "located"))
