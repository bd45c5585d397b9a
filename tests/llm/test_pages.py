"""Operator 6 on shapes of pages where names or forms mislead, and equal to the articles of the given pages."""

import re

import numpy as np

from loam.llm import html_text, queries


def sentences(n, seed=0):
    rng = np.random.default_rng(seed)
    return [" ".join("word" + "x" * int(k) for k in rng.integers(0, 6, int(m))) + "." for m in rng.integers(18, 50, n)]


def test_names_and_forms_around_the_whole_page():
    a, b, c, d = sentences(4, 3)
    text = f"<h1>T</h1><p>{a}</p><p>{b}</p><p>{c}</p>"
    want = ["T", a, b, c]
    for page in (
        f"<body><form id=aspnetForm><div class=nav><a href=/>Home</a></div><div>{text}</div><div class=footer>{d[:30]}</div></form>",
        f"<body class='post right-sidebar'><div>{text}</div>",
        f"<body class=sidebar>{text}",
        f"<html class=modal><body><div id=page class='main comments'><nav>{d}</nav>{text}</div>",
        f"<body><form><article>{text}</article></form>",
        f"<body><p>Site</p><form><div class=content>{text}</div><div class='newsletter signup'>{d[:60]}</div></form>",
    ):
        got = html_text.extract(page)
        assert [x for x in got if x != "Site"] == want, page[:70]
    assert html_text.extract(f"<div>{text}</div><div class=comments><p>{d}</p><p>{d}</p><p>{d}</p><p>{d}</p></div>") == want
    assert html_text.extract(f"<nav>{text}</nav>") == [] and html_text.extract(f"<div>{text}</div><form><p>{d}</p></form>") == want


def test_nothing_between_is_dropped():
    a, b, c = (" ".join(f"{w}{k}" for k in range(30)) + "." for w in ("first", "second", "third"))
    assert html_text.extract(f"<div><p>{a}</p></div><div><p>Hi.</p></div><div><p>{b}</p></div>") == [a, "Hi.", b]
    assert html_text.extract(f"<article><p>{a}</p><dl><dt>k<dd>v<dt>l<dd>w</dl><p>{b}</p></article>") == [a, "k", "v", "l", "w", b]
    assert html_text.extract(f"<div><p>{a}</p><dl><dt>k<dd>v</dl><p>{b}</p></div>") == [a, "k", "v", b]
    assert html_text.extract(f"<div><p>{a}</p><details><summary>s</summary>in</details><p>{b}</p></div>") == [a, "s", "in", b]
    assert html_text.extract(f"<div><p>{a}</p></div><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul><div><p>{b}</p></div>") == [a, b]
    assert html_text.extract(f"<div><p>{a}</p></div><div class=ad><p>Buy.</p></div><div><p>{b}</p></div><p>{c}</p>") == [a, b, c]


def test_unmarked_reader_comments():
    a, b, c, d = sentences(4, 6)
    for head in ("12 responses", "Comments (3)", "3 Comments", "Leave a reply", "One comment on this", "Comments:"):
        assert html_text.extract(f"<article><p>{a}</p><p>{b}</p><div><h3>{head}</h3><p>Anna: {c}</p><ul><li>Ben: {d}</ul></div></article>") == [a, b], head
    assert html_text.extract(f"<article><div><p>{a}</p></div><div><h3>2 replies</h3><p>{c}</p></div><p>{b}</p></article>") == [a, b]
    kept = [a, "Comments of the court", b, "12 responses were given, and all of them agreed.", c]
    assert html_text.extract(f"<article><p>{a}</p><h2>{kept[1]}</h2><p>{b}</p><p>{kept[3]}</p><p>{c}</p></article>") == kept


def test_pages_equal_their_articles(spark):
    """Every given page has one article whose blocks are known; the query keeps exactly these."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = {r.page_id: r.text for r in queries.op6_html_text(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(pages) > 5
    for p in pages:
        inner = re.search(r"(?s)<article[^>]*>(.*?)</article>", p.html)
        words = re.sub(r"(?s)<(script|style|form|aside|nav|footer)[^>]*>.*?</\\1>|<[^>]+>", " ", inner[1])
        assert set(got[p.page_id].split()) <= set(__import__("html").unescape(words).split())
        assert got[p.page_id]
