"""SK-12, F-28: dashboard pages from aggregates: tables, and charts as specifications."""

from __future__ import annotations

import datetime
import decimal
import html
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a table or chart shows, at most; a page is for reading.
ROWS = 500
#: The schema that chart readers expect, and the marks known here.
CHART_SCHEMA = "https://vega.github.io/schema/vega-lite/v5.json"
MARKS = {"bar", "line", "point", "area"}


def cell(value: object) -> str:
    """F-28: text of a cell: nothing for null, lists joined by ", "."""
    if value is None:
        return ""
    return ", ".join("" if v is None else str(v) for v in value) if isinstance(value, list) else str(value)


def html_table(df: DataFrame, title: str, n: int = ROWS, order: list | None = None, empty: str = "", note: str = "") -> str:
    """SK-12: at most ``n`` rows as an escaped table, in ``order`` if given; ``empty`` in its place without rows."""
    rows = (df.orderBy(*order) if order else df).limit(n).collect()
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{html.escape(cell(v))}</td>" for v in r) + "</tr>" for r in rows)
    table = f"<table><tr>{head}</tr>{body}</table>" if rows or not empty else f'<p class="empty">{html.escape(empty)}</p>'
    return f"<h2>{html.escape(title)}</h2>{table}" + (f'<p class="note">{html.escape(note)}</p>' if note else "")


def _plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value.isoformat() if isinstance(value, datetime.date | datetime.datetime) else value


def chart(df: DataFrame, x: str, y: str, mark: str = "bar", color: str | None = None, top: int = ROWS) -> dict:
    """A chart specification of an aggregate, with its values.

    The ``top`` greatest by ``y`` are shown, in order of ``x`` for a line or area and of ``y``
    otherwise; equal values by ``x`` and ``color``, so that a page is the same each time.
    """
    if mark not in MARKS:
        raise ValueError(f"no mark {mark}")
    names = [x, y] + ([color] if color else [])
    ties = [F.asc_nulls_last(c) for c in names if c != y]
    rows = [tuple(map(_plain, r)) for r in df.select(*names).orderBy(F.desc_nulls_last(y), *ties).limit(top).collect()]
    kinds = dict(df.dtypes)
    over_time = kinds[x] in ("date", "timestamp", "timestamp_ntz")
    if mark in ("line", "area"):
        rows.sort(key=lambda r: (r[0] is None, r[0], str(r[2:])))
    encoding = {"x": {"field": x, "type": "temporal" if over_time else "nominal", "sort": None}, "y": {"field": y, "type": "quantitative"}}
    if color:
        encoding["color"] = {"field": color, "type": "nominal"}
    return {"$schema": CHART_SCHEMA, "mark": mark, "data": {"values": [dict(zip(names, r, strict=True)) for r in rows]}, "encoding": encoding}


def page(title: str, parts: list[str | tuple[str, dict]]) -> str:
    """A whole page of tables and (heading, chart) pairs. Chart specifications stand as JSON in
    script elements that no browser runs; characters that could end such an element are escaped."""
    body = []
    for k, part in enumerate(parts):
        if isinstance(part, str):
            body.append(part)
            continue
        heading, spec = part
        data = re.sub("[<>&\u2028\u2029]", lambda m: f"\\u{ord(m[0]):04x}", json.dumps(spec, ensure_ascii=False))
        body.append(f'<h2>{html.escape(heading)}</h2><div id="chart-{k}"></div><script type="application/json" data-chart="chart-{k}">{data}</script>')
    return f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>{"".join(body)}</body></html>'
