"""Queries that take whole texts, against plain Python."""

import unicodedata

from loam.plans import registry

registry.load()


def plain_title(s):
    """A capital after any character that is neither letter, digit nor mark, over composed text."""
    out, inside = [], False
    for c in unicodedata.normalize("NFC", s):
        out.append(c.lower() if inside else c.upper())
        inside = unicodedata.category(c)[0] in "LNM"
    return "".join(out)


def test_titlecase_takes_whole_texts(spark, tmp_path):
    texts = ["aB-cd e'f 3d " * 40, "kỸ SƯ phầN mềm; " * 30, "ạx BC " * 100, "short", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = dict(map(tuple, registry.QUERIES["q_titlecase"](spark, str(tmp_path)).collect()))
    assert got == {k: None if t is None else plain_title(t) for k, t in enumerate(texts)}
