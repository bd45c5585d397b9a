"""Scalar text and date functions as column expressions; only NFC needs Python."""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loam.functions import fixed

WHITE = "(?U)\\s"


def trim_ws(c: Column) -> Column:
    """Strip every kind of white space at both ends (F-08; ``trim`` knows only U+0020)."""
    return F.regexp_replace(c, f"^{WHITE}+|{WHITE}+\\z", "")


def squeeze(c: Column) -> Column:
    """Each run of white space becomes one space."""
    return F.regexp_replace(c, f"{WHITE}+", " ")


def first_only(c: Column, anchored: str, by: str = "") -> Column:
    """Replace one match of a pattern that can match once only (F-02, F-03)."""
    return F.regexp_replace(c, anchored, by)


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """A capture group, null if nothing matches (F-05)."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def clean_text(c: Column, noise: tuple[str, ...] = ()) -> Column:
    """C-01: tags, entities, site noise and bullets become spaces, white space is squeezed and trimmed."""
    out = c.cast("string")
    for pattern in (fixed.HTML_TAG, fixed.HTML_ENTITY, *noise, fixed.BULLETS):
        out = F.regexp_replace(out, pattern, " ")
    return trim_ws(squeeze(out))


@cache
def _accents() -> tuple[str, str]:
    """Characters that decompose to one base letter and marks in U+0300-036F, and those letters."""
    pairs = {"đ": "d", "Đ": "D"}
    for code in range(0xC0, 0x1F00):
        plain = "".join(x for x in unicodedata.normalize("NFD", chr(code)) if not 0x300 <= ord(x) <= 0x36F)
        if plain != chr(code) and len(plain) == 1:
            pairs[chr(code)] = plain
    return "".join(pairs), "".join(pairs.values())


def strip_accents(c: Column) -> Column:
    """F-12: letters without diacritics (đ included), for composed and decomposed text."""
    source, target = _accents()
    return F.regexp_replace(F.translate(c, source, target), "[\\u0300-\\u036f]", "")


def plain_lower(c: Column) -> Column:
    """Accent-free lower-case text, the form that rules are matched on."""
    return F.lower(strip_accents(c.cast("string")))


def titlecase(c: Column) -> Column:
    """F-10: a capital after any character that is neither letter, digit nor mark."""
    parts = F.regexp_extract_all(F.lower(c), F.lit("[\\p{L}\\p{N}\\p{M}]+|[^\\p{L}\\p{N}\\p{M}]+"), F.lit(0))
    return F.array_join(F.transform(parts, F.initcap), "")


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def nfc(c: Column) -> Column:
    """F-11: canonical composition; text without combining marks never reaches Python."""
    return F.when(c.rlike("\\p{M}"), _nfc(F.when(c.rlike("\\p{M}"), c))).otherwise(c)


def slug(c: Column) -> Column:
    """F-23: trimmed lower-case words joined by hyphens."""
    return F.regexp_replace(F.lower(trim_ws(c)), f"{WHITE}+", "-")


def absolute_url(c: Column, base: str) -> Column:
    """F-24: paths get the site's base in front."""
    return F.when(c.startswith("http"), c).when(c.startswith("/"), F.concat(F.lit(base.rstrip("/")), c)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), c))


def uuid5_url(c: Column) -> Column:
    """F-27: name-based UUID (version 5) in the URL namespace."""
    space = F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8"))  # fixed value: the URL namespace
    h = F.sha1(F.concat(space, F.encode(c, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def replace_words(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """F-19: literal phrases between word borders, one after the other."""
    for old, new in pairs:
        c = F.regexp_replace(c, f"(?U)\\b\\Q{old}\\E\\b", new)
    return trim_ws(squeeze(c))


def drop_words(c: Column, words: list[str]) -> Column:
    """F-20: strip phrases between word borders; the source if nothing is left."""
    pattern = "(?U)\\b(" + "|".join(f"\\Q{w}\\E" for w in words) + ")\\b"
    kept = trim_ws(squeeze(F.regexp_replace(c, pattern, " ")))
    return F.coalesce(F.nullif(kept, F.lit("")), c)


def joined_parts(parts: Column) -> Column:
    """F-21: trimmed non-empty fragments joined by spaces, null if none."""
    clean = F.filter(F.transform(parts, trim_ws), lambda x: x != "")
    return F.nullif(F.array_join(clean, " "), F.lit(""))


def without_fragments(c: Column, fragments: list[str]) -> Column:
    """F-22: fixed fragments removed, then trimmed."""
    for f in fragments:
        c = F.replace(c, F.lit(f), F.lit(""))
    return trim_ws(c)


def clean_scalar(c: Column, dtype: str) -> Column:
    """F-25: NaN and blank text become null, dates ISO text."""
    if dtype in ("double", "float"):
        return F.when(~F.isnan(c), c)
    if dtype in ("date", "timestamp"):
        return F.date_format(c, "yyyy-MM-dd")
    if dtype == "string":
        return F.nullif(trim_ws(c), F.lit(""))
    return c


def clean_list(c: Column) -> Column:
    """AR-08: trimmed, blanks and nulls dropped."""
    return F.filter(F.transform(c, trim_ws), lambda x: x.isNotNull() & (x != ""))


def labelled_list(label: str, c: Column) -> Column:
    """AR-09: ``label: a, b``; null for an empty list."""
    clean = clean_list(c)
    return F.when(F.size(clean) > 0, F.concat(F.lit(f"{label}: "), F.array_join(clean, ", ")))


def deadline(c: Column) -> Column:
    """D-01: the first ISO date, else the first day/month/year date, as ``yyyy-MM-dd``; null if not a date."""
    iso = F.try_to_timestamp(extract(c, "(\\d{4}-\\d{1,2}-\\d{1,2})"), F.lit("yyyy-M-d"))
    dmy = F.try_to_timestamp(extract(c, "(\\d{1,2}/\\d{1,2}/\\d{4})"), F.lit("d/M/yyyy"))
    return F.coalesce(F.date_format(iso, "yyyy-MM-dd"), F.date_format(dmy, "yyyy-MM-dd"))


def epoch_seconds(c: Column) -> Column:
    """D-05: UTC midnight of ISO or day/month/year text (session time zone UTC)."""
    return F.unix_timestamp(F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")), F.try_to_timestamp(c, F.lit("dd/MM/yyyy"))))


def relative_deadline(c: Column, today: Column) -> Column:
    """D-06: "N ngày" is N days ahead, any other number that many months of 30 days."""
    n = F.coalesce(F.try_to_number(extract(c, "(\\d+)"), F.lit("999999")), F.lit(0)).cast("int")
    days = F.when(F.contains(c, F.lit("ngày")), n).otherwise(n * 30)
    return F.when(c.isNotNull(), F.date_format(F.date_add(today, days), "yyyy-MM-dd"))


def script_field(c: Column, field: str) -> Column:
    """JS-02: a quoted field of a script blob, JSON escapes decoded where they are valid."""
    raw = extract(c, f'"{field}"\\s*:\\s*"([^"]*)"')
    return F.coalesce(F.get_json_object(F.concat(F.lit('{"v":"'), raw, F.lit('"}')), "$.v"), raw)
