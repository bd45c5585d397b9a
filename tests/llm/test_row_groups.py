"""Row groups of the tiered index hold a few blocks, however many a task makes."""

from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from loam.llm import tiered


def test_row_groups_hold_a_few_blocks(spark):
    docs = spark.range(0, 20, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("alpha beta "), 200_000).alias("text"))
    index = tiered.build(docs)
    files = [pq.ParquetFile(p).metadata for p in Path(index.path.removeprefix("file:")).rglob("*.parquet")]
    groups = [m.row_group(k).num_rows for m in files for k in range(m.num_row_groups)]
    assert sum(groups) == 20 and max(groups) <= 8
