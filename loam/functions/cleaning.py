"""Domain cleaners C-02 to C-19 as column expressions: one projection for a whole site."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loam.functions import fixed
from loam.functions.rules import KeywordSet, Rules, any_match, bound, first_match, ordered_flags
from loam.functions.text import clean_text, deadline, extract, plain_lower, squeeze, strip_accents, titlecase, trim_ws

_FIRST, _SECOND = "(\\d+\\.?\\d*)", "\\d+\\.?\\d*\\D+(\\d+\\.?\\d*)"


def _has(c: Column, pattern: str) -> Column:
    return c.rlike(f"(?U)({pattern})")


def company_name(c: Column) -> Column:
    """C-03 without the mapping: upper-case name without legal forms, noise and punctuation."""
    out = c.cast("string")
    for pattern, by in fixed.COMPANY_CUTS:
        out = F.regexp_replace(out, pattern, by)
        if pattern == "(?U)\\s+":
            out = trim_ws(out)
    return F.upper(trim_ws(squeeze(out)))


def clean_url(c: Column) -> Column:
    """C-05: the URL without query and fragment."""
    return F.regexp_replace(c, fixed.URL_DECORATION, "")


def unique_url(cleaned: Column, site: Column, normalize_site: bool = False) -> Column:
    """C-05: listing number cut by site. ``normalize_site`` also takes names like ``site.com``."""
    name = F.coalesce(trim_ws(F.lower(site)), F.lit(""))
    if normalize_site:
        name = F.regexp_replace(name, "\\.[a-z.]+\\z", "")
    out = cleaned
    for known, suffix in fixed.SITE_SUFFIX.items():
        out = F.when(name == known, F.regexp_replace(cleaned, suffix, "")).otherwise(out)
    return out


def job_title(c: Column) -> Column:
    """C-06."""
    out = c.cast("string")
    for pattern, by in fixed.TITLE_CUTS:
        out = F.regexp_replace(out, pattern, by)
    return titlecase(trim_ws(squeeze(out)))


def title_keywords(c: Column) -> Column:
    """C-07: level, then flags; empty for null."""
    return ordered_flags(plain_lower(c), fixed.TITLE_LEVELS, fixed.TITLE_FLAGS)


def location(c: Column, places: Rules) -> tuple[Column, Column]:
    """C-08: (place, country as text)."""
    plain = strip_accents(c.cast("string"))
    found = first_match(plain, places)
    country = (
        F.when(found.isNotNull() | F.coalesce(plain.rlike("(?i)vietnam"), F.lit(False)), fixed.VIETNAM)
        .when(plain.rlike("(?i)nuoc ngoai"), fixed.ABROAD)
        .otherwise(fixed.UNKNOWN)
    )
    return F.coalesce(found, F.lit(fixed.UNKNOWN)), country


def industries(c: Column, ruled: Rules, sep: str | None = None) -> tuple[Column, Column]:
    """C-09: (labels, parts without one), both sorted and distinct; no shuffle, no row numbers."""
    whole = F.coalesce(c.cast("string"), F.lit(""))
    parts = F.split(whole, f"\\Q{sep}\\E") if sep else F.array(whole)
    parts = F.filter(F.transform(parts, trim_ws), lambda x: x != "")
    pairs = F.transform(parts, lambda x: F.struct(x.alias("part"), first_match(plain_lower(x), ruled).alias("label")))
    labels = F.transform(pairs, lambda p: F.coalesce(p["label"], F.lit(fixed.OTHERS)))
    rest = F.transform(F.filter(pairs, lambda p: p["label"].isNull()), lambda p: p["part"])
    return F.array_sort(F.array_distinct(labels)), F.array_sort(F.array_distinct(rest))


def benefits(c: Column, ruled: Rules, noise: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """C-10: (clean text, categories by substring)."""
    text = clean_text(c, noise)
    return text, any_match(plain_lower(text), ruled)


def keyword_lists(c: Column, taxonomies: dict[str, Rules | None], noise: tuple[str, ...] = ()) -> dict[str, Column]:
    """C-11 and C-12: a list of labels for each taxonomy; a missing taxonomy gives empty lists."""
    text = plain_lower(clean_text(c, noise))
    return {name: KeywordSet.build(ruled or []).extract(text) for name, ruled in taxonomies.items()}


#: Factors of a salary: the first row all of whose words occur in the text counts.
_PERIODS = ((("day",), 30.0), (("week",), 4.0), (("year",), 0.083))
_UNITS = (
    (("usd", "usd_k"), 1000.0 * fixed.USD_TO_VND),
    (("usd",), fixed.USD_TO_VND),
    (("thousand",), 1e3),
    (("million",), 1e6),
    (("billion",), 1e9),
)


def _factor(words: Column, table: tuple) -> Column:
    out = F.lit(1.0)
    for needed, by in reversed(table):
        out = F.when(F.forall(F.array(*map(F.lit, needed)), lambda w: F.array_contains(words, w)), by).otherwise(out)
    return out


def salary(c: Column) -> tuple[Column, Column]:
    """C-13: (least, most) per month in VND.

    Bound in three steps, so that each pattern is tested once: the text, the words of the
    unit rules it has, then its numbers.
    """
    def words_of(text: Column) -> Column:
        return F.array_compact(F.array(*[F.when(_has(text, pattern), F.lit(name)) for name, pattern in fixed.SALARY.items()]))

    def values(x: Column) -> Column:
        text, words = x["text"], x["words"]
        has = lambda word: F.array_contains(words, word)
        shown = (
            F.when(has("decimal"), F.replace(text, F.lit(","), F.lit("."))).when(has("usd"), F.replace(text, F.lit(","), F.lit("")))
            .otherwise(F.regexp_replace(text, "[,.]", ""))
        )
        numbers = F.struct(extract(shown, _FIRST).try_cast("double").alias("one"), extract(shown, _SECOND).try_cast("double").alias("two"))
        return bound(F.struct(text.alias("text"), words.alias("words"), numbers.alias("numbers")), ends)

    def ends(x: Column) -> Column:
        text, words, one, two = x["text"], x["words"], x["numbers"]["one"], x["numbers"]["two"]
        has = lambda word: F.array_contains(words, word)
        dash, per = text.contains("-"), _factor(words, _PERIODS)
        scaled = lambda base, seen: F.when(text.rlike("\\d"), base * per * F.when(~has("unit") & (seen < 1000), 1e6).otherwise(_factor(words, _UNITS)))
        least = F.when(~(has("upto") & ~has("from")), one)
        most = F.when(has("from") & ~dash, F.lit(None).cast("double")).when(dash, two).otherwise(one)
        return F.struct(scaled(least, one).alias("least"), scaled(most, F.when(dash, two).otherwise(one)).alias("most"))

    both = bound(F.lower(c.cast("string")), lambda text: bound(F.struct(text.alias("text"), words_of(text).alias("words")), values))
    return both["least"], both["most"]


def experience(c: Column) -> tuple[Column, Column]:
    """C-14: (least, most) in years."""
    p = fixed.EXPERIENCE
    text = plain_lower(c)
    none, less, over, month, span = (_has(text, p[k]) for k in ("none", "less", "over", "month", "range"))
    shown = F.replace(text, F.lit(","), F.lit("."))
    one, two = extract(shown, _FIRST).try_cast("double"), extract(shown, _SECOND).try_cast("double")
    by = F.when(month, 12.0).otherwise(1.0)
    zero = c.isNull() | none | less | ~text.rlike("\\d")
    most = (
        F.when(c.isNull(), F.lit(None).cast("double")).when(none, 0.0).when(span & two.isNotNull(), two / by)
        .when(less | (month & ~over), one / by)
    )
    return F.when(zero, 0.0).otherwise(one / by), most


def company_size(c: Column) -> tuple[Column, Column]:
    """C-15: "50+" and "50-100"; a bare number gives nothing."""
    numbers = F.regexp_extract_all(c.cast("string"), F.lit("\\d+"), F.lit(0))
    plus, dash = c.contains("+"), c.contains("-")
    return F.when(plus | dash, F.get(numbers, 0)).try_cast("bigint"), F.when(dash, F.get(numbers, 1)).try_cast("bigint")


def _category(c: Column, ruled: Rules, other: str) -> Column:
    return F.coalesce(first_match(plain_lower(c), ruled), F.lit(other))


def education(c: Column) -> Column:
    """C-16."""
    return _category(c, fixed.EDUCATION, fixed.NOT_STATED)


def position(c: Column) -> Column:
    """C-17."""
    return _category(c, fixed.POSITION, fixed.NOT_STATED)


def job_type(c: Column) -> Column:
    """C-18."""
    return _category(c, fixed.JOB_TYPE, fixed.OTHER_TYPE)


__all__ = ["benefits", "clean_url", "company_name", "company_size", "deadline", "education", "experience", "industries", "job_title", "job_type", "keyword_lists", "location", "position", "salary", "title_keywords", "unique_url"]
