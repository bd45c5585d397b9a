"""Keyed deduplication, merging, numbering and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loam.functions.text import nfc, trim_ws
from loam.session import work_dir


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    """PF-01: rows with a null in any of the columns that exist go."""
    return df.dropna(subset=[c for c in columns if c in df.columns])


def nonblank(df: DataFrame, key: str) -> DataFrame:
    """PF-04."""
    return df.where(trim_ws(F.col(key)) != "")


def existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """PF-13: those of the columns that exist, in the order asked for."""
    return df.select(*[c for c in columns if c in df.columns])


def first_available(df: DataFrame, names: list[str], dtype: str) -> Column:
    """PF-06, PF-07: the first non-null of the columns that exist, else a typed null."""
    have = [F.col(n).try_cast(dtype) for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast(dtype)


def non_empty(df: DataFrame, name: str) -> Column:
    """PF-12: lists with elements; text other than "", "[]" and "null"."""
    if dict(df.dtypes)[name].startswith("array"):
        return F.coalesce(F.size(name) > 0, F.lit(False)) & F.col(name).isNotNull()
    return F.col(name).isNotNull() & ~F.col(name).isin("", "[]", "null")


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    have = {c.lower() for c in df.columns}
    while f"__{name}" in have:
        name += "_"
    return f"__{name}"


def keep_first(df: DataFrame, keys: list[Column | str], order: list[Column]) -> DataFrame:
    """W-01, A-09, A-10: one row per key, the first in ``order``; null keys form one group.

    Every column of ``order`` is weighed; ties beyond it are arbitrary, so give a total order.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rank = unused(df, "rank")
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank)


def first_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """W-04: the first ``n`` rows of each group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rank = unused(df, "rank")
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n).drop(rank)


def surrogate_ids(df: DataFrame, order: list[Column], name: str = "job_id") -> DataFrame:
    """W-02: 1, 2, ... in the given total order, without bringing all rows to one task.

    Rows are range-sorted, numbered within each partition, and shifted by the sizes of the
    partitions before: one count per partition reaches the driver.
    """
    part, at, base = (unused(df, c) for c in ("part", "at", "base"))
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ordered.withColumn(part, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    # Counting and joining must see the same partitions, so the sorted rows are kept.
    numbered = stored(numbered)
    sizes = sorted(tuple(r) for r in numbered.groupBy(part).count().collect())
    before, total = [], 0
    for p, n in sizes:
        before.append((p, total))
        total += n
    starts = F.broadcast(df.sparkSession.createDataFrame(before, f"{part} int, {base} long"))
    return numbered.join(starts, part).select((F.col(base) + F.col(at) + 1).alias(name), *df.columns)


def stored(df: DataFrame) -> DataFrame:
    """Written to the folder that all executors share and read back: a durable cut of the lineage."""
    path = work_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def grown(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that grows with the input: shuffled, never sent through the driver."""
    return df.hint("merge")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """J-11, SK-06: rows of ``new`` replace those of ``old`` with the same key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def membership(df: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
    """J-03: 1 if the key occurs in ``other``, else 0."""
    flag = other.select(key).distinct().withColumn(name, F.lit(1))
    return df.join(flag, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def mapped(df: DataFrame, seed: DataFrame, source: str, variant: str, canonical: str) -> DataFrame:
    """J-01: left join with a mapping that has one row per variant, so rows never multiply."""
    one = keep_first(seed, [variant], [F.col(canonical)])
    return df.join(one.withColumnRenamed(variant, source), source, "left")


def company_seed(rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """C-04: explicit variants first, then each canonical name as its own variant; first per variant."""
    import unicodedata

    norm = lambda s: unicodedata.normalize("NFC", s).strip().upper()
    out: dict[str, str] = {}
    for variant, canonical in rows:
        out.setdefault(norm(variant), norm(canonical))
    for _, canonical in rows:
        out.setdefault(norm(canonical), norm(canonical))
    return list(out.items())


def company_seed_rows(seed: DataFrame, variant: str = "variant_name", canonical: str = "canonical_name") -> DataFrame:
    """C-04 as a frame, for seeds of any size: (variant, canonical), one row per variant.

    Names are composed, trimmed and upper-case. A variant's own rows come before its use as
    a canonical name, and of several canonical names the smallest counts.
    """
    norm = lambda c: F.upper(trim_ws(nfc(F.col(c))))
    rows = seed.select(norm(variant).alias(variant), norm(canonical).alias(canonical))
    own = unused(rows, "own")
    both = rows.withColumn(own, F.lit(0)).unionByName(rows.select(F.col(canonical).alias(variant), canonical, F.lit(1).alias(own)))
    return keep_first(both.where(F.col(variant).isNotNull()), [variant], [F.asc(own), F.asc(canonical)]).drop(own)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """SO-03, SO-04: rows of all frames; columns united, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def without_older(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """J-06, W-03: of rows with the same key the one with the largest ordinal stays; null keys all stay."""
    w = Window.partitionBy(key).orderBy(F.desc(ordinal))
    rank = unused(df, "rank")
    return df.withColumn(rank, F.row_number().over(w)).where((F.col(rank) == 1) | F.col(key).isNull()).drop(rank)
