"""Data-quality gates: share of non-null values per column, all columns in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least shares, fixed values.
REQUIRED, OPTIONAL, EXCEPTIONAL = 0.95, 0.05, 0.80


@dataclass(frozen=True)
class Expectation:
    """``column`` is non-null in at least ``least`` of the rows that meet ``where``."""

    column: str
    least: float
    where: Column | None = None


def not_containing(name: str, part: str) -> Column:
    """PF-15: rows without ``part``; null counts as without."""
    return ~F.coalesce(F.contains(F.col(name), F.lit(part)), F.lit(False))


def expectations(site: str, base: list[str], extra: list[str]) -> list[Expectation]:
    """DQ-01 to DQ-03."""
    if site == "itviec":
        return [Expectation(c, EXCEPTIONAL if c == "job_industry" else REQUIRED) for c in base] + [Expectation(c, OPTIONAL) for c in extra]
    out = [Expectation(c, REQUIRED) for c in base + extra if not (site == "topcv" and c == "company_size")]
    if site == "topcv" and "company_size" in extra:
        out.append(Expectation("company_size", 1.0, not_containing("job_url", "brand/")))
    return out


def report(df: DataFrame, wanted: list[Expectation]) -> DataFrame:
    """DQ-04: (column, threshold, ratio, success); no rows to judge counts as success."""
    shares = []
    for k, e in enumerate(wanted):
        seen = F.col(e.column).isNotNull().cast("double")
        shares.append(F.avg(seen if e.where is None else F.when(e.where, seen)).alias(f"r{k}"))
    one = df.agg(*shares)
    rows = F.array(*[F.struct(F.lit(e.column).alias("column"), F.lit(e.least).alias("threshold"), F.col(f"r{k}").alias("ratio")) for k, e in enumerate(wanted)])
    out = one.select(F.explode(rows).alias("e")).select("e.*")
    return out.withColumn("success", F.coalesce(F.col("ratio") >= F.col("threshold"), F.lit(True)))


def gate(df: DataFrame, wanted: list[Expectation]) -> bool:
    """True if every expectation holds; a driver-side gate for the next layer."""
    return report(df, wanted).where("NOT success").isEmpty()
