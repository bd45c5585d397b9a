"""Operator 5: mixing sources to target weights by pivotal dependent rounding.

Each document of a source is to be taken target / source_size times on average. Whole
copies are certain; the fractions are rounded dependently: two fractional probabilities
meet, mass moves at random from one to the other until one is 0 or 1, the other goes on.
Documents meet in buckets of one class of sizes, from long to short; every bucket leaves at
most one fraction, and the fractions of a source and class are combined level by level in a
reduction tree, whose last one is drawn.

Classes are drawn from the longest documents down. What the draw of a class has taken too
much or too little, in words, is zero on average and moves onto the fractions of the shorter
documents of its source, each in proportion to its room (its distance from 0 or 1, whichever
is nearer). So each document keeps its probability, and a source misses its target by about
its shortest documents instead of its longest. Where shorter documents have no room for all
of it, the rest is carried on to the next class and may stay. A source of no more rows than a
bucket has goes through its classes in one task, a larger one class by class over all tasks.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.llm.shared import WORD, located, stage

SEED = 20
#: Documents of one bucket: bounds what one task holds.
BUCKET = 2_000
FAN = 64
#: Sizes of one class differ by up to this factor.
STEP = 2
CAP = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
_EPS = 1e-9
_ROW = "locator string, doc_id long, source string, size long, source_size long, target double, rank long, key long, cls int, due double, p double, bucket long, copies int"


def targets(sources: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``sources`` (source, source_size; one row each) plus rank and target, the words due to each.

    Sources by code point, null last, take the weights in turn and share all words by weight,
    none above ``cap`` times its size; what a capped source can't take is shared among the
    others until none is above its cap. All of it is distributed: ranks come from a range
    sort and one offset per partition, and each round of sharing is one aggregate.
    """
    spark = sources.sparkSession
    order = F.col("source").asc_nulls_last()
    placed = stage(sources.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id()), "ordered")
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    before, base = [], 0
    for k, n in sorted(map(tuple, placed.groupBy(part.alias("part")).count().collect())):  # a row per partition
        before.append((k, base))
        base += n
    offsets = F.broadcast(spark.createDataFrame(before, "part long, base long"))
    ranked = placed.withColumn("part", part).join(offsets, "part").withColumn("rank", F.col("base") + row)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = stage(ranked.select("source", "source_size", "rank", weight.alias("weight")), "ranked")
    total, whole = ranked.agg(F.sum("source_size").cast("double"), F.sum("weight")).first()
    level, held = (total / whole if whole else 0.0), -1
    most = F.col("source_size") * float(cap)
    while True:
        over = F.col("weight") * F.lit(level) > most
        full, open_, count = ranked.agg(F.sum(F.when(over, most)), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)).first()
        if count == held or not open_:
            break
        # The level only rises, so a full source stays full and the rounds end.
        level, held = max(level, (total - (full or 0.0)) / open_), count
    return ranked.withColumn("target", F.least(F.col("weight") * F.lit(level), most)).drop("weight")


def pivot(p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Pivotal rounding in the given order: all but at most one entry become 0 or 1."""
    out, held = p.copy(), -1
    draws = rng.random(2 * len(p) + 2).tolist()
    vals, k = out.tolist(), 0
    for i in range(len(vals)):
        b = vals[i]
        if b <= _EPS or b >= 1 - _EPS:
            vals[i] = float(round(b))
            continue
        if held < 0:
            held = i
            continue
        a, u = vals[held], draws[k]
        k += 1
        s = a + b
        if s < 1:
            first = u < a / s  # all mass to one of them
            vals[held], vals[i] = (s, 0.0) if first else (0.0, s)
        else:
            first = u < (1 - b) / (2 - s)  # one of them is filled up
            vals[held], vals[i] = (1.0, s - 1) if first else (s - 1, 1.0)
        held = next((j for j in (held, i) if _EPS < vals[j] < 1 - _EPS), -1)
    return np.asarray(vals)


def _draw(seed: int, cls: int, rank: int) -> float:
    """A uniform number for the last fraction of a source's class.

    Uniform for each source by itself, spread evenly over the sources, so that their misses
    cancel in the whole mix.
    """
    first = np.random.default_rng([seed, cls]).random()
    return (first + rank * math.sqrt(4 * cls + 2)) % 1.0  # never a whole root


def _level(final: bool, seed: int, depth: int):
    """Round one bucket; what stays fractional keeps ``copies`` null, or is drawn at the end."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # From long to short: what stays open is one of the shortest.
        pdf = pdf.sort_values(["size", "doc_id", "key", "locator"], ascending=[False, True, True, True], kind="stable", na_position="last").reset_index(drop=True)
        whole = np.floor(pdf["p"].to_numpy() + _EPS)
        rng = np.random.default_rng([seed, int(pdf["cls"].iloc[0]), depth, int(key[0]), int(key[1])])
        frac = pivot(np.clip(pdf["p"].to_numpy() - whole, 0, 1), rng)
        open_ = (frac > _EPS) & (frac < 1 - _EPS)
        if final:
            frac = np.where(open_, (_draw(seed, int(pdf["cls"].iloc[0]), int(key[0])) < frac).astype(float), frac)
            open_ = np.zeros(len(frac), bool)
        pdf["p"] = whole + frac
        pdf["copies"] = pd.Series(np.rint(whole + frac), dtype="Int32").mask(open_)
        pdf["bucket"] = pdf["bucket"] // FAN
        return pdf

    return run


def _whole_source(seed: int):
    """All classes of a source that fits into one bucket, one after the other."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        order = ["cls", "size", "doc_id", "key", "locator"]
        pdf = pdf.sort_values(order, ascending=[False, False, True, True, True], kind="stable", na_position="last").reset_index(drop=True)
        p, size, cls = pdf["p"].to_numpy().copy(), pdf["size"].to_numpy(), pdf["cls"].to_numpy()
        rng, missed = np.random.default_rng([seed, int(key[0])]), 0.0
        ends = [*np.flatnonzero(np.diff(cls)) + 1, len(cls)]
        for start, end in zip([0, *ends[:-1]], ends, strict=True):
            part = slice(start, end)
            whole = np.floor(p[part] + _EPS)
            frac = pivot(np.clip(p[part] - whole, 0, 1), rng)
            open_ = (frac > _EPS) & (frac < 1 - _EPS)
            copies = whole + np.rint(np.where(open_, _draw(seed, int(cls[start]), int(key[0])) < frac, frac))
            missed += float(((p[part] - copies) * size[part]).sum())
            p[part] = copies
            rest = np.maximum(p[end:] - np.floor(p[end:] + _EPS), 0)
            room = np.minimum(rest, 1 - rest)
            words = float((room * size[end:]).sum())
            if words > 0:
                move = min(1.0, max(-1.0, missed / words))
                p[end:] += move * room
                missed -= move * words
        pdf["copies"] = pd.Series(np.rint(p), dtype="Int32")
        return pdf

    return run


def _buckets(sized: DataFrame, bucket: int) -> DataFrame:
    """``sized`` plus cls, its class of sizes, and bucket: of one source and class, about ``bucket`` rows each.

    Which bucket a row falls in depends on its doc_id and text alone, so that the mix doesn't
    depend on files. Only rows repeated more than ``bucket`` times are dealt by their locator.
    """
    sized = sized.withColumn("cls", F.when(F.col("size") > 0, 1 + F.floor(F.log2("size") / math.log2(STEP) + 1e-9)).otherwise(0).cast("int"))
    per = sized.groupBy(F.col("source").alias("s"), F.col("cls").alias("c")).agg(F.ceil(F.count(F.lit(1)) / F.lit(bucket)).alias("of"))
    hot = sized.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket).select(F.col("key").alias("k"), F.lit(True).alias("hot"))
    where = F.when(F.col("hot"), F.xxhash64("key", "locator")).otherwise(F.col("key"))
    return (
        sized.join(per, F.col("source").eqNullSafe(F.col("s")) & (F.col("cls") == F.col("c")))
        .join(hot, F.col("key") == F.col("k"), "left")
        .withColumn("bucket", F.pmod(where, "of"))
        .drop("s", "c", "k", "hot", "of")
    )


def _room(p: Column) -> Column:
    """How far a probability is from the nearer whole number of copies."""
    frac = F.greatest(p - F.floor(p + _EPS), F.lit(0.0))
    return F.least(frac, 1 - frac)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """locator, doc_id, source, size, source_size, target, copies, taken: one row per row.

    Size is the number of words. Null texts and texts without words have size 0 and are
    taken 0 words, whatever their copies. Rows that repeat are separate rows. The result
    depends on the rows and the seed alone (rows repeated more than ``bucket`` times: on
    their files too). Empty tables give no rows; other columns are ignored.
    """
    base = located(docs, "doc_id", "source", "text")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.xxhash64("doc_id", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")), F.lit(seed))
    sized = stage(base.select("locator", "doc_id", "source", size.alias("size"), key.alias("key")), "sized")
    totals = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")), "totals")
    due = targets(totals.select("source", "source_size"), weights, cap).withColumnRenamed("source", "s")
    due = due.join(totals.select(F.col("source").alias("t"), "rows"), F.col("s").eqNullSafe(F.col("t"))).drop("t")
    p = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(0.0)
    due = stage(due.withColumn("p", p), "due")
    names = [c.split()[0] for c in _ROW.split(", ")]
    dealt = _buckets(sized, bucket).join(due, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    dealt = dealt.withColumn("due", F.lit(0.0)).withColumn("copies", F.lit(None).cast("int"))
    dealt = stage(dealt.select(*names, (F.col("rows") <= bucket).alias("fits")), "dealt")
    small, dealt = dealt.where("fits").select(*names), dealt.where("NOT fits").select(*names)
    # A class for each power of STEP: a handful of rows, whatever the number of sources.
    most = {r["cls"]: r["of"] for r in dealt.groupBy("cls").agg((F.max("bucket") + 1).alias("of")).collect()}
    words = stage(dealt.groupBy("rank", "cls").agg(F.sum("size").alias("words")), "words")
    parts = [stage(small.groupBy("rank").applyInPandas(_whole_source(seed), _ROW), "small")]
    # All documents of a source that are still to be drawn have one probability.
    state = due.where(F.col("rows") > bucket).select("rank", "p", F.lit(0.0).alias("rest"))
    for cls in sorted(most, reverse=True):
        todo = dealt.where(F.col("cls") == cls).drop("p").join(state.select("rank", "p"), "rank").withColumn("due", F.col("p") * F.col("size")).select(*names)
        depth, width, mine = 0, most[cls], []
        while True:
            level = stage(todo.groupBy("rank", "bucket").applyInPandas(_level(width <= 1, seed, depth), _ROW), f"class{cls}level{depth}")
            mine.append(level.where("copies IS NOT NULL"))
            if width <= 1:
                break
            todo, width, depth = level.where("copies IS NULL"), -(-width // FAN), depth + 1
        parts += mine
        if cls > min(most):  # what was missed moves to shorter documents
            missed = reduce(DataFrame.unionAll, mine).groupBy("rank").agg(F.sum(F.col("due") - F.col("copies") * F.col("size")).alias("missed"))
            shorter = words.where(F.col("cls") < cls).groupBy("rank").agg(F.sum("words").alias("words"))
            both = state.join(shorter, "rank", "left").join(missed, "rank", "left")
            room, lack = _room(F.col("p")) * F.coalesce("words", F.lit(0)), F.col("rest") + F.coalesce("missed", F.lit(0.0))
            both = both.select("rank", "p", room.alias("room"), lack.alias("lack"))
            move = F.when(F.col("room") > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("lack") / F.col("room")))).otherwise(0.0)
            both = both.withColumn("move", move)
            state = stage(both.select("rank", (F.col("p") + F.col("move") * _room(F.col("p"))).alias("p"), (F.col("lack") - F.col("move") * F.col("room")).alias("rest")), f"state{cls}")
    rounded = parts[0]
    for part in parts[1:]:
        rounded = rounded.unionByName(part)
    return rounded.select("locator", "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
