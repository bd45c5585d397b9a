"""Sheets as people leave them, seeds with their fall-back, dashboards read back from their text."""

import datetime as dt
import json
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from loam.operators import dashboards
from loam.sources import scan, sheets


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)
    return f"file://{path}"


def test_tidy_rows():
    assert sheets.tidy_sheet([]) == ([], []) and sheets.tidy_sheet([["", " "], ["a"]]) == ([], [])
    assert sheets.tidy_sheet([["\ufeffa ", None, "c", " "], [None, "x"], ["", " "], list("wxyz")]) == (["a", "", "c"], [["", "x", ""], ["w", "x", "y"]])


def test_sheet(spark, tmp_path):
    one = put(tmp_path / "s/1.csv", "\ufeff id ,Name,name,,x,\n1,\"a, \"\"b\"\"\nc\",q,r,s,t\n,,,\n2\n".encode() + b"3,\xff\xfe,,,\n")
    got = sheets.sheet(spark, one)
    assert got.columns == ["id", "Name", "_3", "_4", "x"]
    assert [tuple(r) for r in got.collect()] == [("1", 'a, "b"\nc', "q", "r", "s"), ("2", "", "", "", ""), ("3", "\ufffd\ufffd", "", "", "")]
    put(tmp_path / "s/2.csv", b"x,id\n9,8\n")
    assert {(r.id, r.x) for r in sheets.sheet(spark, f"file://{tmp_path}/s/*.csv").collect()} == {("1", "s"), ("2", ""), ("3", ""), ("8", "9")}
    assert sheets.sheet(spark, put(tmp_path / "e/0.csv", b" ,\n1,2\n")).columns == []
    with pytest.raises(FileNotFoundError):
        sheets.sheet(spark, put(tmp_path / "z/0.csv", b""))
    assert sheets.sheet(spark, put(tmp_path / "h/0.csv", b"a,b\n")).count() == 0
    with pytest.raises(FileNotFoundError):
        sheets.sheet(spark, f"file://{tmp_path}/none")


def test_written_sheets_read_back(spark, tmp_path):
    data = [("a", 'q "x", \n y'), ("b", None), (None, "\\"), ("", " s ")]
    sheets.write_sheet(spark.createDataFrame(data, "k string, v string"), f"file://{tmp_path}/w")
    got = [tuple(r) for r in sheets.sheet(spark, f"file://{tmp_path}/w/*.csv").collect()]
    assert sorted(got) == sorted((k or "", v or "") for k, v in data)


def test_seeds_fall_back_and_are_kept(spark, tmp_path):
    local = tmp_path / "local.csv"
    local.write_text("a,b\n1,2\n")
    remote = f"file://{tmp_path}/remote.csv"
    assert scan.seed(remote, str(local), spark) == [{"a": "1", "b": "2"}]
    put(tmp_path / "remote.csv", b"a\n7\n")
    assert scan.seed(remote, str(local), spark) == [{"a": "7"}]
    put(tmp_path / "remote.csv", b"a\n8\n")
    assert scan.seed(remote, str(local), spark) == [{"a": "7"}]  # read once per application
    assert scan.review_table(spark, f"file://{tmp_path}/no.csv", 1, f"file://{local}").collect()[0].asDict() == {"a": "1", "b": "2"}


class Page(HTMLParser):
    def __init__(self, text):
        super().__init__()
        self.tags, self.texts, self.charts, self.inside = [], [], [], False
        self.feed(text)

    def handle_starttag(self, tag, attrs):
        self.tags.append(tag)
        self.inside = ("type", "application/json") in attrs

    def handle_data(self, data):
        if self.inside:
            self.charts.append(json.loads(data))
            self.inside = False
        else:
            self.texts.append(data)


def test_pages(spark):
    evil = "</script><b>&\u2028"
    df = spark.createDataFrame([(evil, 2, ["x", None, "<"]), ("b", 5, None), ("a", 5, [])], "k string, n int, list array<string>")
    chart = dashboards.chart(df, "k", "n")
    page = Page(dashboards.page("<T>", [dashboards.html_table(df, "<t>", 2, order=["k"], note="n<"), ("c&", chart), dashboards.html_table(df.where("n > 9"), "none", empty="no rows")]))
    assert page.charts == [chart] and [v["k"] for v in chart["data"]["values"]] == ["a", "b", evil]
    assert page.tags.count("b") == 0 and page.tags.count("script") == 1 and page.tags.count("tr") == 3
    assert {"<T>", "<t>", "n<", "c&", "no rows", "x, , <"} <= set(page.texts)


def test_charts(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(day + dt.timedelta(k), k % 3, "s") for k in range(6)], "day date, n int, site string")
    chart = dashboards.chart(df, "day", "n", "line", "site", top=4)
    values = chart["data"]["values"]
    assert chart["encoding"]["x"]["type"] == "temporal" and [v["day"] for v in values] == sorted(v["day"] for v in values)
    assert sorted(v["n"] for v in values) == [1, 1, 2, 2] and values[0] == {"day": "2024-01-02", "n": 1, "site": "s"}
    assert dashboards.chart(df.withColumn("n", F.lit(1.5).cast("decimal(4,2)")), "site", "n", top=1)["data"]["values"] == [{"site": "s", "n": 1.5}]
    with pytest.raises(ValueError):
        dashboards.chart(df, "day", "n", "pie")
