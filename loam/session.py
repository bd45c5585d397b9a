"""Session builder with the settings every plan in this package assumes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "loam", **conf: str) -> SparkSession:
    """UTC, ANSI, AQE with skew joins; partition values stay strings so ``month=05`` is kept."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, the warehouse, or a private folder if all of Spark is this process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if sc.master == "local" or sc.master.startswith("local["):
        if sc.applicationId not in _LOCAL:
            _LOCAL[sc.applicationId] = tempfile.mkdtemp(prefix="loam-")
            atexit.register(shutil.rmtree, _LOCAL[sc.applicationId], ignore_errors=True)
        return f"file://{_LOCAL[sc.applicationId]}"
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def work_dir(spark: SparkSession) -> str:
    """A fresh folder that all executors and the driver share; it goes when Spark ends."""
    own = f"{shared_root(spark)}/loam-work-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{own}/{uuid.uuid4().hex}"
