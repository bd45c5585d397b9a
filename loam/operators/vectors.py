"""Vector points, similarity search and re-ranking for recommendations."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loam.functions import fixed
from loam.functions.text import clean_scalar, labelled_list, uuid5_url
from loam.operators.relational import keep_first, nonblank, unused

DOCUMENT_CHARS = 6000
_SKILLS = [c for c, _ in fixed.REQUIREMENT_TYPES if c.startswith("require_")]
_TEXTS = ["requirements_cleaned", "job_description_cleaned"]


def latest_jobs(df: DataFrame, key: str = "unique_url") -> DataFrame:
    """VX-01: newest row per non-blank key: by date, then deadline, both descending, nulls last."""
    return keep_first(nonblank(df, key), [key], [F.desc_nulls_last("silver_date"), F.desc_nulls_last("job_deadline")])


def document_text(df: DataFrame, title: str = "job_title", key: str = "unique_url") -> Column:
    """VX-02, F-26: title, skill lines and texts, one to a line; the key if all are blank."""
    parts = [clean_scalar(F.col(title), "string")]
    parts += [labelled_list(c, F.col(c)) for c in _SKILLS if c in df.columns]
    for c in _TEXTS:
        if c in df.columns:
            text = clean_scalar(F.col(c), "string")
            parts.append(F.when(text.isNotNull(), F.concat(F.lit(f"{c}: "), text)))
    text = F.nullif(F.concat_ws("\n", *parts), F.lit(""))
    return F.substring(F.coalesce(text, F.col(key)), 1, DOCUMENT_CHARS)


def hashing_embedder(dim: int = 768) -> Callable[[list[str]], np.ndarray]:
    """An offline stand-in for a remote model: signed hashed words, deterministic."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for k, t in enumerate(texts):
            for w in (t or "").lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                out[k, h % dim] += 1 if h >> 63 else -1
        return out

    return embed


def embed(df: DataFrame, text: str, model: Callable[[list[str]], np.ndarray], batch: int = 64, name: str = "vector") -> DataFrame:
    """VX-03: vectors from any model, in batches; a batch with another number of vectors is an error."""

    @F.pandas_udf("array<float>")
    def run(s: pd.Series) -> pd.Series:
        out = []
        for k in range(0, len(s), batch):
            part = s.iloc[k : k + batch].tolist()
            got = model(part)
            if len(got) != len(part):
                raise ValueError(f"{len(part)} texts gave {len(got)} vectors")
            out += [np.asarray(v, np.float32) for v in got]
        return pd.Series(out, index=s.index, dtype=object)

    return df.withColumn(name, run(text))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def normalised(v: Column) -> Column:
    """VX-04: unit length; a zero vector stays."""
    n = norm(v)
    return F.when(n == 0, F.transform(v, lambda x: x.cast("double"))).otherwise(F.transform(v, lambda x: x.cast("double") / n))


def points(df: DataFrame, key: str = "unique_url", vector: str = "vector") -> DataFrame:
    """VX-05, JS-03: (id, vector, payload): a name-based UUID, unit vector, JSON without nulls."""
    payload = [c for c in df.columns if c != vector]
    return df.select(uuid5_url(F.col(key)).alias("id"), normalised(F.col(vector)).alias("vector"), F.to_json(F.struct(*payload)).alias("payload"))


def expired(today: Column, days: int = 30, site_days: dict[str, int] | None = None) -> Column:
    """VX-06, D-08: whether a point is older than its cut-off, by either date; some sites have a stricter one.

    Missing dates never expire a point. A strict site of N days keeps today and N - 1 before it.
    """
    def old(cut: Column) -> Column:
        return F.coalesce(F.col("silver_date") < cut, F.lit(False)) | F.coalesce(F.col("indexed_at") < cut, F.lit(False))

    gone = old(F.date_sub(today, days))
    for site, n in (site_days or {"vietnamworks": 3}).items():
        gone = gone | (F.coalesce(F.col("source_site") == site, F.lit(False)) & old(F.date_sub(today, n - 1)))
    return gone


def unexpired(df: DataFrame, today: Column, days: int = 30, site_days: dict[str, int] | None = None) -> DataFrame:
    """VX-06: the points that haven't expired."""
    return df.where(~expired(today, days, site_days))


def search(
    df: DataFrame, query: list[float], n: int, vector: str = "vector", id_col: str = "id", strict: Column | None = None, enough: int = 10, fallback: int = 100, must: Column | None = None
) -> DataFrame:
    """VX-08, SL-05: the ``n`` most similar by cosine of the rows for which ``must`` holds.

    With ``strict``, its rows; where fewer than ``enough`` of them are found, ``fallback`` of all.
    One scan: each task keeps its best strict rows and its best rows of all, both bounded,
    and what is left is chosen from these few. The query is a literal.
    """
    q = F.array(*[F.lit(float(x)) for x in query])
    score, at, side, hits = (unused(df, c) for c in ("score", "at", "side", "hits"))
    rows = df if must is None else df.where(must)
    scored = rows.withColumn(score, dot(F.col(vector), q) / F.nullif(norm(F.col(vector)) * norm(q), F.lit(0.0)))
    order = [F.desc_nulls_last(score), F.asc(id_col)]
    if strict is None:
        return scored.orderBy(*order).limit(n).withColumnRenamed(score, "score")
    # A strict row stands on both sides; the limit of the window is applied in each task first.
    sides = F.when(F.coalesce(strict, F.lit(False)), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))
    ranked = scored.withColumn(side, F.explode(sides)).withColumn(at, F.row_number().over(Window.partitionBy(side).orderBy(*order)))
    few = ranked.where(F.col(at) <= max(n, fallback, enough)).withColumn(hits, F.sum(F.col(side).cast("int")).over(Window.partitionBy()))
    chosen = few.where(F.when(F.col(hits) >= enough, F.col(side) & (F.col(at) <= n)).otherwise(~F.col(side) & (F.col(at) <= fallback)))
    return chosen.orderBy(*order).drop(at, side, hits).withColumnRenamed(score, "score")


def skill_overlap(wanted: dict[str, Column]) -> Column:
    """VX-09: weighted share of a job's skills that the candidate has, over groups the job names."""
    top, weight = F.lit(0.0), F.lit(0.0)
    for c, w in fixed.SKILL_WEIGHTS.items():
        if c in wanted:
            n = F.coalesce(F.size(F.col(c)), F.lit(0))
            n = F.greatest(n, F.lit(0))
            share = F.size(F.array_intersect(F.col(c), wanted[c])) / F.greatest(n, F.lit(1))
            top = top + F.when(n > 0, F.lit(w) * share).otherwise(0.0)
            weight = weight + F.when(n > 0, F.lit(w)).otherwise(0.0)
    return F.coalesce(top / F.nullif(weight, F.lit(0.0)), F.lit(0.0))


def experience_match(years: Column, low: Column, high: Column) -> Column:
    base = F.when(years.isNull(), 1.0).when(low.isNull(), 0.8).when(years >= low, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - (low - years) / 3))
    return base * F.when(high.isNotNull() & (years > high + 2), 0.85).otherwise(1.0)


def location_match(wanted: Column, place: Column, remote: Column) -> Column:
    return F.when(wanted.isNull() | (place == wanted), 1.0).when(remote, 0.8).otherwise(0.0)


def final_score(cosine: Column, skills: Column, experience: Column, place: Column, weights: dict[str, float] | None = None) -> Column:
    w = weights or fixed.RANK_WEIGHTS
    return cosine * w["cosine"] + skills * w["skill_overlap"] + experience * w["experience_match"] + place * w["location_match"]
