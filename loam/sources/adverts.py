"""Advert pages to raw rows: declarative layouts over a light tree, in Arrow batches.

A layout lists, for each field, rules that are tried in turn: the text of the first element
with certain attributes, the siblings after a label, or a field of a script blob.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import date, timedelta
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.sources.schemas import raw_schema

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    parent: Node | None = None
    parts: list[Node | str] = field(default_factory=list)
    #: Of a whole page's root, all below it in page order.
    flat: list[Node] | None = None

    def walk(self) -> Iterator[Node]:
        """Descendants in page order, without recursion."""
        if self.flat is not None:
            yield from self.flat
            return
        stack = [p for p in reversed(self.parts) if isinstance(p, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [p for p in reversed(node.parts) if isinstance(p, Node)]

    def own(self) -> str:
        return "".join(p for p in self.parts if isinstance(p, str))

    def text(self) -> str | None:
        """All text below, fragments trimmed and joined by spaces; null if none (F-21)."""
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                if t := " ".join(node.split()):
                    out.append(t)
            else:
                stack += reversed(node.parts)
        return " ".join(out) or None

    def later(self, tag: str | None = None) -> list[Node]:
        """Following siblings, all or those of one tag."""
        sibs = [p for p in self.parent.parts if isinstance(p, Node)] if self.parent else []
        at = next((k for k, s in enumerate(sibs) if s is self), len(sibs))
        return [s for s in sibs[at + 1 :] if tag in (None, s.tag)]


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", flat=[])

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.parts.append(node)
        self.root.flat.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.parts.append(data)


def tree(html: str | None) -> Node:
    parser = _Tree()
    parser.feed(html or "")
    parser.close()
    return parser.root


@dataclass(frozen=True)
class Element:
    """Text of the ``nth`` element with this tag whose attributes contain (or equal) these values."""

    tag: str | None = None
    has: tuple[tuple[str, str], ...] = ()
    equal: tuple[tuple[str, str], ...] = ()
    nth: int = 0

    def fits(self, n: Node) -> bool:
        return self.tag in (None, n.tag) and all(v in n.attrs.get(k, "") for k, v in self.has) and all(n.attrs.get(k) == v for k, v in self.equal)

    def find(self, root: Node) -> str | None:
        found = [n for n in root.walk() if self.fits(n)][self.nth : self.nth + 1]
        return found[0].text() if found else None


@dataclass(frozen=True)
class After:
    """Text of up to ``count`` siblings after the first element whose own text holds ``label``."""

    label: str
    tag: str | None = None
    sibling: str | None = None
    count: int = 99
    css: str = ""

    def find(self, root: Node) -> str | None:
        for n in root.walk():
            if self.tag in (None, n.tag) and n.tag not in ("script", "style") and self.css in n.attrs.get("class", "") and self.label in n.own():
                if texts := [t for s in n.later(self.sibling)[: self.count] if (t := s.text())]:
                    return " ".join(texts)
        return None


@dataclass(frozen=True)
class Titled:
    """Text of the first sibling of class ``desc`` after a div of class ``title`` whose text is ``label``."""

    label: str
    title: str
    desc: str

    def find(self, root: Node) -> str | None:
        for n in root.walk():
            if n.tag == "div" and self.title in n.attrs.get("class", "") and n.text() == self.label:
                for s in n.later("div"):
                    if self.desc in s.attrs.get("class", ""):
                        return s.text()
        return None


@dataclass(frozen=True)
class Script:
    """A quoted field of the script that holds ``mark`` (JS-02); escapes decoded where valid."""

    name: str
    mark: str = "window.qgTracking"

    def find(self, root: Node) -> str | None:
        for n in root.walk():
            if n.tag == "script" and self.mark in n.own():
                m = re.search(rf'"{self.name}"\s*:\s*"([^"]*)"', n.own())
                if not m:
                    return None
                try:
                    return str(json.loads(f'"{m[1]}"')).strip() or None
                except ValueError:
                    return m[1].strip() or None
        return None


_ITEM = ("box-job-information-general-info-list__item--content-title", "box-job-information-general-info-list__item--content-desc")
_DETAIL = ("box-job-information-detail-item__title", "box-job-information-detail-item__text")


def _topcv_label(label: str) -> tuple:
    return (Titled(label, *_ITEM), After(label, count=2, css="box-general-group-info-title"))


def _brand_label(label: str) -> tuple:
    return (After(label, count=2),)


def _topcv_part(label: str) -> tuple:
    return (Titled(label, *_DETAIL), After(label, sibling="div", count=2))


_PARTS = {"job_description": _topcv_part("Mô tả công việc"), "requirements": _topcv_part("Yêu cầu ứng viên"), "benefits": _topcv_part("Quyền lợi ứng viên")}

# Where each site's pages hold a field.
LAYOUTS: dict[str, dict[str, tuple]] = {
    "topcv": {
        "job_title": (Script("job_title"), Element("h1", (("class", "box-header-job__title"),))),
        "company_name": (Script("recruiter_company"), Element("a", (("class", "text-dark-blue"),)), Element("a", (("href", "cong-ty"),), (("class", "name"),))),
        "salary": (Script("salary_range"), Element("h4", (("class", "box-header-job__salary"),))),
        "location": (Script("work_location"), Element("span", (("class", "hight-light"), ("class", "city-name")))),
        "job_industry": (Script("job_category"),),
        "company_size": (Titled("Quy mô", "box-company-info-detail__list--item-title", "box-company-info-detail__list--item-desc"), After("Quy mô", css="company-title")),
        "job_type": _topcv_label("Loại hình làm việc"),
        "experience_level": (Script("experience"),),
        "education_level": _topcv_label("Học vấn"),
        "job_position": _topcv_label("Cấp bậc"),
        "job_deadline": (Titled("Hạn ứng tuyển", "list-info__content__title", "list-info__content__desc"), Element("div", (), (("class", "job-detail__info--deadline-date"),))),
        **_PARTS,
    },
    "topcv_brand": {
        "job_title": (Element("h1", (("class", "box-header-job__title"),)), Element("h2", (("class", "job-title"),)), Element("h2", (("class", "premium-job-basic-information__content--title"),))),
        "company_name": (Element("p", (("class", "company-name"),)), Element("div", (), (("class", "footer-info-content footer-info-company-name"),)), Element("h1", (), (("class", "company-content__title--name"),))),
        "salary": (Element("span", (("class", "box-header-job__salary--title"),)), *_brand_label("Mức lương"), *_brand_label("Thu nhập")),
        "location": _brand_label("Địa điểm"),
        "job_industry": (Script("job_category"),),
        "company_size": _brand_label("Quy mô"),
        "job_type": _brand_label("Loại hình làm việc"),
        "experience_level": (Script("experience"), *_brand_label("Kinh nghiệm")),
        "education_level": _brand_label("Học vấn"),
        "job_position": _brand_label("Cấp bậc"),
        "job_deadline": _brand_label("Hạn nộp hồ sơ"),
        **_PARTS,
    },
    "itviec": {
        "job_title": (Element("h2", (("class", "text-it-black text-hover-red"),)),),
        "company_name": (Element("a", (("href", "/companies/"), ("class", "normal-text"))),),
        "salary": (Element("span", (("class", "ips-2"), ("class", "fw-500"))),),
        "location": (Element("div", (("class", "d-inline-block"), ("class", "text-dark-grey"))),),
        "job_industry": (Element("div", (), (("class", "d-inline-flex text-wrap"),)),),
        "job_description": (Element("section", (), (("class", "job-description"),)),),
        "requirements": (Element("section", (), (("class", "job-experiences"),)),),
        "benefits": (Element("section", (), (("class", "job-why-love-working"),)),),
        "company_size": (Element("small", (), (("class", "normal-text text-it-black col"),), 1),),
    },
    "vietnamworks": {
        "job_title": (Element("h1", (), (("name", "title"),)),),
        "company_name": (Element("a", (("href", "nha-tuyen-dung"),)),),
        "salary": (Element("span", (("class", "cVbwLK"),)),),
        "location": (Element("span", (("class", "gVpPKv"),)), Element("div", (("class", "gVpPKv"),))),
        "job_type": (After("LOẠI HÌNH LÀM VIỆC", "label", "p"),),
        "experience_level": (After("SỐ NĂM KINH NGHIỆM TỐI THIỂU", "label", "p"),),
        "education_level": (After("TRÌNH ĐỘ HỌC VẤN TỐI THIỂU", "label", "p"),),
        "job_industry": (After("LĨNH VỰC", "label", "p"),),
        "job_position": (After("CẤP BẬC", "label", "p"),),
        "job_description": (After("Mô tả công việc", "h2", "div"),),
        "requirements": (After("Yêu cầu", "h2", "div"),),
        "benefits": (After("phúc lợi dành cho bạn", "h2", "div"),),
    },
}


def fields_of(html: str | Node | None, layout: dict[str, tuple]) -> dict[str, str | None]:
    """Each field's text by the first rule that finds any, of a page or its tree."""
    root = html if isinstance(html, Node) else tree(html)
    return {name: next((t for rule in rules if (t := rule.find(root))), None) for name, rules in layout.items()}


def relative_day(text: str | None, today: date) -> str | None:
    """D-06: "N ngày" is N days ahead, any other number that many months of 30 days."""
    if not text:
        return None
    m = re.search(r"\d+", text)
    n = int(m[0]) if m else 0
    return (today + timedelta(days=n if "ngày" in text else 30 * n)).isoformat()


def parse_page(site: str, url: str | None, html: str | None, today: date) -> dict[str, str | None]:
    """SC-15 to SC-17: fields of one page, with each site's own additions."""
    brand = site == "topcv" and "brand" in (url or "")
    root = tree(html)
    out = fields_of(root, LAYOUTS["topcv_brand" if brand else site])
    if site == "vietnamworks":
        if out["experience_level"]:
            out["experience_level"] += " năm"
        held = next((n.own() for n in root.walk() if n.tag == "span" and "Hết hạn trong" in n.own()), None)
        out["job_deadline"] = relative_day(held, today)
    if brand and not out["job_deadline"]:
        left = next((m for n in root.walk() if n.tag == "span" and n.attrs.get("class") == "deadline" and (m := re.search(r"\d+", n.text() or ""))), None)
        out["job_deadline"] = (today + timedelta(days=int(left[0]))).strftime("%d/%m/%Y") if left else None
    if site == "topcv" and out["location"]:
        out["location"] = out["location"].replace("Địa điểm:", "").replace("\xa0", "").strip() or None
    return out


def parse_adverts(pages: DataFrame, site: str, today: date, url: str = "url", html: str = "html", keyword: str | None = None) -> DataFrame:
    """Raw rows of a site (its landing schema), one per page; unread fields are null.

    Pages are dealt over all cores first: parsing takes far longer than reading, and a file of
    many pages may be a single split.
    """
    schema = raw_schema(site)
    names = [f.name for f in schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for u, h in zip(pdf["u"], pdf["h"], strict=True):
                row = parse_page(site, u, h, today) | {"job_url": u, "source_site": site, "search_keyword": keyword, "scraped_at": today.isoformat()}
                found.append([row.get(n) for n in names])
            yield pd.DataFrame(found, columns=names, dtype=object)

    spark = pages.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return pages.select(F.col(url).alias("u"), F.col(html).alias("h")).repartition(tasks).mapInPandas(run, schema)
