"""Golden rows of the scalar functions and cleaners, and properties against plain Python."""

import unicodedata
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loam.functions import cleaning, text
from loam.functions.rules import KeywordSet, classify


def lit(v):
    return F.lit(v).cast("string")


@pytest.mark.parametrize(
    ("raw", "low", "high"),
    [
        ("10 - 20 triệu", 1e7, 2e7), ("1,5 triệu", 1.5e6, 1.5e6), ("1.000 - 2.000 USD", 26000.0, 52000.0), ("1,000 - 2,000 USD", 26e6, 52e6), ("5k usd", 130e6, 130e6),
        ("từ 15", 15e6, None), ("tới 20 triệu", None, 20e6), ("Thoả thuận", None, None), (None, None, None), ("Trên 1,000 USD", 26000.0, None), ("15", 15e6, 15e6), ("2 tỷ", 2e9, 2e9), ("12 triệu/năm", 12 * 0.083 * 1e6, 12 * 0.083 * 1e6),
    ],
)
def test_salary(one, raw, low, high):
    assert tuple(one(*[c.alias(n) for c, n in zip(cleaning.salary(lit(raw)), "ab", strict=True)])) == (low, high)


@pytest.mark.parametrize(
    ("raw", "low", "high"),
    [(None, 0.0, None), ("Không yêu cầu", 0.0, 0.0), ("Dưới 1 năm", 0.0, 1.0), ("Trên 5 năm", 5.0, None), ("6 tháng", 0.5, 0.5), ("2 - 3 năm", 2.0, 3.0), ("1,5 năm", 1.5, None)],
)
def test_experience(one, raw, low, high):
    assert tuple(one(*[c.alias(n) for c, n in zip(cleaning.experience(lit(raw)), "ab", strict=True)])) == (low, high)


@pytest.mark.parametrize(("raw", "want"), [("50+", (50, None)), ("50 - 100", (50, 100)), ("200", (None, None)), ("abc", (None, None)), (None, (None, None))])
def test_company_size(one, raw, want):
    assert tuple(one(*[c.alias(n) for c, n in zip(cleaning.company_size(lit(raw)), "ab", strict=True)])) == want


@pytest.mark.parametrize(("raw", "want"), [("Hạn: 5/1/2026", "2026-01-05"), ("2026-1-5", "2026-01-05"), ("31/02/2026", None), (None, None)])
def test_deadline(one, raw, want):
    assert one(text.deadline(lit(raw)))[0] == want


@pytest.mark.parametrize(
    ("url", "site", "want"),
    [("https://x/a-b-1234?c=1", "itviec", "https://x/a-b"), ("https://x/a--99-jv?s=1", "vietnamworks", "https://x/a"), ("https://x/a--99-jv?s=1", "vietnamworks.com", "https://x/a--99-jv"), ("https://x/a-1", None, "https://x/a-1")],
)
def test_urls(one, url, site, want):
    assert one(cleaning.unique_url(cleaning.clean_url(lit(url)), lit(site)))[0] == want
    assert one(cleaning.unique_url(lit("https://x/a--99-jv"), lit("vietnamworks.com"), normalize_site=True))[0] == "https://x/a"


def test_categories(one):
    assert one(cleaning.job_title(lit("[Hot Job] Senior DATA-engineer (Hà Nội)")))[0] == "Senior Data-Engineer"
    assert one(cleaning.title_keywords(lit("Senior Data Analyst")))[0] == ["Senior", "Data", "Analyst"]
    assert one(cleaning.title_keywords(lit(None)))[0] == []
    assert [one(cleaning.job_type(lit(x)))[0] for x in ("Full-time", "Bán thời gian", None)] == ["Toàn thời gian", "Bán thời gian", "Khác"]
    assert [one(cleaning.education(lit(x)))[0] for x in ("Đại học trở lên", None)] == ["Đại học", "Không đề cập"]
    assert one(cleaning.position(lit("Quản lý / Giám sát")))[0] == "Trưởng nhóm"
    places = [("ca mau|camau", "Cà Mau")]
    got = [tuple(one(*[c.alias(n) for c, n in zip(cleaning.location(lit(x), places), "ab", strict=True)])) for x in ("Cà Mau", "Vietnam", "Nước ngoài", None)]
    assert got == [("Cà Mau", "Việt Nam"), ("Không xác định", "Việt Nam"), ("Không xác định", "Nước ngoài"), ("Không xác định", "Không xác định")]
    assert one(cleaning.company_name(lit("CÔNG TY TNHH Lotte (VN) Co., Ltd - https://x.y")))[0] == "LOTTE"


def test_clean_text_and_industries(one):
    assert one(text.clean_text(lit("<b>A&nbsp;B</b> • end-to-end")))[0] == "A B end-to-end"
    a, b = cleaning.industries(lit("IT - Phần mềm, Bán lẻ,, digital"), [("phan mem|it", "IT")], ",")
    assert tuple(one(a.alias("a"), b.alias("b"))) == (["IT", "Others"], ["Bán lẻ"])
    a, b = cleaning.industries(lit(None), [("it", "IT")])
    assert tuple(one(a.alias("a"), b.alias("b"))) == ([], [])
    assert one(text.relative_deadline(lit("còn 5 ngày"), F.to_date(F.lit("2026-01-01"))))[0] == "2026-01-06"
    assert one(text.script_field(lit('window.x = {"salary": "a\\/b"}'), "salary"))[0] == "a/b"


def test_accents_nfc_uuid(one):
    for form in ("NFC", "NFD"):
        raw = unicodedata.normalize(form, "Đường Nguyễn")
        assert one(text.strip_accents(lit(raw)))[0] == "Duong Nguyen"
        assert one(text.nfc(lit(raw)))[0] == unicodedata.normalize("NFC", raw)
    assert one(text.uuid5_url(lit("https://x/ạ")))[0] == str(uuid.uuid5(uuid.NAMESPACE_URL, "https://x/ạ"))


def test_accents_like_python(spark):
    @settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.text(st.characters(max_codepoint=0x1EFF, exclude_categories=("Cs", "Cc")), max_size=20), min_size=1, max_size=200))
    def run(values):
        def plain(s):
            s = unicodedata.normalize("NFD", s.replace("đ", "d").replace("Đ", "D"))
            return "".join(c for c in s if not 0x300 <= ord(c) <= 0x36F)

        got = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string").select("k", text.strip_accents(F.col("v")).alias("p")).orderBy("k").collect()
        assert [unicodedata.normalize("NFD", r.p) for r in got] == [plain(v) for v in values]

    run()


def _trie(literals: dict, regexes: list, s: str) -> list:
    import re

    s, out, i = s.lower(), [], 0
    word = lambda c: c.isascii() and (c.isalnum() or c == "_")
    while i < len(s):
        hit = None
        if i == 0 or not word(s[i - 1]):
            for k in sorted(literals, key=len, reverse=True):
                if s.startswith(k, i) and (i + len(k) == len(s) or not word(s[i + len(k)])):
                    hit = k
                    break
        if hit:
            out.append(literals[hit])
            i += len(hit)
        else:
            i += 1
    out += [v for p, v in regexes if re.search(p, s)]
    return list(dict.fromkeys(out))


def test_hybrid_keywords(one):
    assert classify("\\bc\\+\\+\\b") == ("c++", None)
    assert classify("react(js)?") == (None, "react(js)?")
    assert classify("  ") == (None, None)
    keys = KeywordSet.build([("python|\\bpy\\b", "Python"), ("c\\+\\+|java", "C++"), ("java script|javascript", "JS"), ("react.?js", "React"), ("java", "Java")])
    for s in ("Python and java script, C++; py", "javascript reactjs JAVA", "", "xpython java_", "c++c++ c++"):
        assert one(keys.extract(lit(s)))[0] == _trie(keys.literals, keys.regexes, s), s
    assert one(keys.extract(lit(None)))[0] == []


def test_titlecase(one):
    assert one(text.titlecase(lit("aB-cd e'f ạx 3d")))[0] == "Ab-Cd E'F Ạx 3d"
