"""C-20: the cleaning pipelines of the three sites, each a single projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.functions import cleaning
from loam.functions.rules import Rules
from loam.functions.text import clean_text, nfc
from loam.operators.relational import drop_incomplete, mapped
from loam.sources.schemas import SILVER, conform


@dataclass(frozen=True)
class Site:
    """What differs between sites. Noise patterns are fixed values."""

    name: str
    industry_sep: str | None = None
    description_noise: tuple[str, ...] = ()
    requirement_noise: tuple[str, ...] = ()
    benefit_noise: tuple[str, ...] = ()
    hybrid_benefits: bool = False
    columns: frozenset[str] = field(default_factory=frozenset)


SITES = {
    "topcv": Site(
        "topcv", ",", ("(?iuU)mô tả công việc",), ("(?iuU)yêu cầu ứng viên",),
        ("(?iuU)có hỗ trợ data xem chi tiết", "(?iuU)có hỗ trợ data", "(?iuU)xem chi tiết", "(?iuU)^\\s*quyền lợi\\b"),
        columns=frozenset(("company_size", "job_type", "experience_level", "education_level", "job_position", "job_deadline")),
    ),
    "itviec": Site("itviec", None, ("(?iuU)job description",), ("(?iuU)your skills and experience",), ("(?iuU)why you\\S?ll love working here",), True, frozenset(("company_size",))),
    "vietnamworks": Site(
        "vietnamworks", None, (), ("(?iuU)mức độ phù hợp và xếp hạng của bạn so với ứng viên khác như thế nào\\?*",), ("(?iuU)xem thêm", "(?iuU)see more|read more"),
        columns=frozenset(("job_type", "experience_level", "education_level", "job_position", "job_deadline")),
    ),
}


@dataclass
class Seeds:
    """Rule sets and the company mapping."""

    companies: DataFrame  # variant_name, canonical_name
    places: Rules
    industries: Rules
    benefits: Rules
    skills: dict[str, Rules | None]  # by output column


def clean_site(raw: DataFrame, site: Site, seeds: Seeds) -> DataFrame:
    """Silver rows of a site: PF-01, PF-03, the cleaners, PF-02. One projection and one join with the mapping."""
    have = drop_incomplete(raw, ["job_title", "company_name"]).drop("scraped_at")
    url = cleaning.clean_url(F.col("job_url"))
    place, country = cleaning.location(F.col("location"), seeds.places)
    labels, rest = cleaning.industries(F.col("job_industry"), seeds.industries, site.industry_sep)
    low, high = cleaning.salary(F.col("salary"))
    benefit_text, categories = cleaning.benefits(F.col("benefits"), seeds.benefits, site.benefit_noise)
    if site.hybrid_benefits:
        categories = cleaning.keyword_lists(F.col("benefits"), {"b": seeds.benefits}, site.benefit_noise)["b"]
    out = {
        "unique_url": cleaning.unique_url(url, F.col("source_site")),
        "__company": cleaning.company_name(nfc(F.col("company_name"))),
        "job_title_special_keywords": cleaning.title_keywords(F.col("job_title")),
        "clean_job_title": cleaning.job_title(F.col("job_title")),
        "clean_location": place,
        "is_vietnam": country,
        "job_industry_clean": labels,
        "job_industry_unmapped": rest,
        "job_description_cleaned": clean_text(F.col("job_description"), site.description_noise),
        "min_monthly_salary": low,
        "max_monthly_salary": high,
        "benefits_text_clean": benefit_text,
        "benefits_categories_vi": categories,
        "requirements_cleaned": clean_text(F.col("requirements"), site.requirement_noise),
        **cleaning.keyword_lists(F.col("requirements"), seeds.skills, site.requirement_noise),
    }
    if "company_size" in site.columns:
        out["min_company_size"], out["max_company_size"] = cleaning.company_size(F.col("company_size"))
    if "experience_level" in site.columns:
        out["min_exp_level"], out["max_exp_level"] = cleaning.experience(F.col("experience_level"))
    replaced = {"job_url": url}
    for name, fn in (("job_type", cleaning.job_type), ("education_level", cleaning.education), ("job_position", cleaning.position), ("job_deadline", cleaning.deadline)):
        if name in site.columns:
            replaced[name] = fn(F.col(name))
    keep = [c for c in have.columns if c not in replaced]
    cleaned = have.select(*keep, *[v.alias(k) for k, v in {**replaced, **out}.items()])
    joined = mapped(cleaned, seeds.companies, "__company", "variant_name", "canonical_name")
    named = joined.withColumn("clean_company_name", F.coalesce("canonical_name", "__company"))
    parts = [c for c in ("source_site", "year", "month", "day") if c in named.columns]
    silver = conform(named, SILVER)
    return silver if not parts else _with(named, parts)


def _with(named: DataFrame, parts: list[str]) -> DataFrame:
    from loam.sources.schemas import lenient_cast

    have = {f.name: f.dataType for f in named.schema}
    columns = [(lenient_cast(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in SILVER]
    return named.select(*columns, *parts)
