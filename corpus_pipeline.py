"""A training-data pipeline over ``documents``: each stage applies one operator to all rows.

Stages: toxicity (toxic rows go), exact deduplication, near-deduplication (one row of each
component of texts with Jaccard similarity 0.8 or more stays), mixing (rows repeat as often as the mix takes them) and packing.
Every stage but the last returns the columns of its input; results are written as Parquet
to the shared folder and read again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm import covering, jaccard, mixing, packing, stream_dedup, toxic_crf
from loam.llm.queries import BYTE_BPE
from loam.llm.shared import grown, located, stage, table


def _only(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose locator is among ``chosen``."""
    columns = docs.columns
    name = _unused(columns)
    return located(docs, *columns, name=name).join(grown(chosen.withColumnRenamed("locator", name)), name, "left_semi").select(*columns)


def _unused(columns: list[str]) -> str:
    name = "locator"
    while name in columns:
        name += "_"
    return name


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that operator 2 predicts to be toxic go; all others stay as they are."""
    model = toxic_crf.learn(docs, table(spark, sf_dir, "labels"))
    return toxic_crf.without_toxic(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (operator 4) the one with the smallest doc_id stays."""
    return _only(docs, stream_dedup.exact_dedup(docs).where("kept").select("locator"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts with similarity 0.8 or more over five-word shingles the smallest doc_id stays.

    Candidates come from operator 9's covering tables and, beyond their radius, from MinHash bands; every
    link is checked exactly (``loam.llm.jaccard``).
    """
    return _only(docs, covering.representatives(jaccard.near_duplicates(docs)).select("locator"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as operator 5 takes it: not at all, or up to three times."""
    columns = docs.columns
    name = _unused(columns)
    copies = mixing.mix(docs).where("copies > 0").select(F.col("locator").alias(name), F.array_repeat(F.lit(0), F.col("copies")).alias(f"{name}copies"))
    rows = located(docs, *columns, name=name).join(grown(copies), name)
    return rows.select(*columns, F.explode(f"{name}copies").alias(f"{name}copy")).select(*columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences of at most 2048 ids (operator 3)."""
    return packing.pack_documents(docs, BYTE_BPE)


STAGES = [("toxicity", toxicity), ("exact dedup", exact), ("simhash near-dedup", near), ("mixing", mixed), ("packing", packed)]

#: SQL can't express the CRF, XXH64 or the tokenizer; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
