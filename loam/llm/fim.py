"""Operator 13: fill-in-the-middle over relational units.

Units (a word with the white space before it) are exploded with their ordinals, their
lengths summed by a window along each document, cut requests joined by unit ordinal and
the offsets aggregated per document; prefix, middle and suffix are substrings of the text.
Only lengths are exploded, only of documents that are cut, and only up to the last cut;
plain documents never leave their task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loam.llm.shared import ROW, numbered, stage

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Percent of documents that are cut, and of those the percent in the suffix-first form.
RATE, SPM_RATE = 50, 80


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of a document's id; a missing id counts as empty text."""
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(hexed, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def restored(output: Column, form: Column) -> Column:
    """The text rebuilt from an output and its form alone; a cut text holds no sentinel, so three stand in it."""
    at = lambda mark: F.position(F.lit(mark), output)
    between = lambda a, b: F.substring(output, a + 3, b - a - 3)
    tail = F.substring(output, at(MIDDLE) + 3, F.length(output))
    psm = F.concat(between(at(PREFIX), at(SUFFIX)), tail, between(at(SUFFIX), at(MIDDLE)))
    spm = F.concat(between(at(PREFIX), at(MIDDLE)), tail, between(at(SUFFIX), at(PREFIX)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, row_no, row_file, n, form, prefix_chars, middle_chars, output: one row per row of ``docs``.

    A null text counts as empty; empty texts and texts that hold a sentinel stay plain, with
    null lengths. Rows that repeat, also with one doc_id or none, are cut each on its own and
    alike. A very long text is exploded row by row and summed by a streaming window. Empty
    tables give no rows; other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    base = numbered(docs, "doc_id", "text").withColumn("text", text)
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    form = (
        F.when((F.col("text") == "") | marked | (h3 % 100 >= rate), "plain")
        .when(h4 % 100 < spm_rate, "spm")
        .otherwise("psm")
    )
    formed = base.withColumn("form", form)
    matches = F.regexp_extract_all("text", F.lit(UNIT), F.lit(0))
    cut = formed.where("form != 'plain'")

    # Cut requests: both ordinals of each document, from the number of its units.
    n = F.col("n")
    asked = cut.select(*ROW, F.size(matches).alias("n"), h1.alias("h1"), h2.alias("h2")).select(
        *ROW, F.least(F.col("h1") % (n + 1), F.col("h2") % (n + 1)).alias("low"), F.greatest(F.col("h1") % (n + 1), F.col("h2") % (n + 1)).alias("high"), "n"
    )
    asked = stage(asked, "cuts")
    requests = asked.select(*ROW, F.explode(F.array(F.struct(F.lit("low").alias("which"), F.col("low").alias("upto")), F.struct(F.lit("high").alias("which"), F.col("high").alias("upto")))).alias("r")).select(*ROW, "r.which", "r.upto").where("upto > 0")

    # Units as (document, ordinal, length); what lies beyond the last cut isn't needed.
    last = F.greatest(h1 % (F.size("lengths") + 1), h2 % (F.size("lengths") + 1)).cast("int")
    units = (
        cut.select(*ROW, "doc_id", F.transform(matches, lambda u: F.length(u)).alias("lengths"))
        .select(*ROW, F.posexplode(F.slice("lengths", 1, last)).alias("unit", "length"))
    )
    along = Window.partitionBy(*ROW).orderBy("unit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = units.select(*ROW, (F.col("unit") + 1).alias("done"), F.sum("length").over(along).alias("chars"))
    # Each document's few requests meet its units where they already are: the ordinals are
    # compared within the document, so the running sums aren't shuffled a second time.
    met = ends.join(requests, ROW).where(F.col("done") - F.col("upto") == 0)
    pick = lambda which: F.max(F.when(F.col("which") == which, F.col("chars")))
    offsets = met.groupBy(*ROW).agg(pick("low").alias("low"), pick("high").alias("high"))
    offsets = stage(asked.select(*ROW, "n").join(offsets, ROW, "left").select(*ROW, "n", F.coalesce("low", F.lit(0)).alias("low"), F.coalesce("high", F.lit(0)).alias("high")), "offsets")

    low, high = F.col("low").cast("int"), F.col("high").cast("int")
    p, m, s = F.substring("text", F.lit(1), low), F.substring("text", low + 1, high - low), F.substring("text", high + 1, F.length("text"))
    psm = F.concat(F.lit(PREFIX), p, F.lit(SUFFIX), s, F.lit(MIDDLE), m)
    spm = F.concat(F.lit(SUFFIX), s, F.lit(PREFIX), p, F.lit(MIDDLE), m)
    done = cut.join(offsets, ROW).select(
        "doc_id", *ROW, F.col("n").cast("long").alias("n"), "form", F.col("low").cast("long").alias("prefix_chars"), (F.col("high") - F.col("low")).cast("long").alias("middle_chars"),
        F.when(F.col("form") == "psm", psm).otherwise(spm).alias("output"),
    )
    none = F.lit(None).cast("long")
    plain = formed.where("form = 'plain'").select(
        "doc_id", *ROW, F.size(matches).cast("long").alias("n"), "form", none.alias("prefix_chars"), none.alias("middle_chars"), F.col("text").alias("output")
    )
    return plain.unionByName(done)
