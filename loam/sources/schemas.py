"""Schemas of the layers and conformance to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BASE = "job_title company_name location job_industry job_description source_site job_url search_keyword scraped_at salary benefits requirements".split()
_EXTRA = {
    "topcv": "company_size job_type experience_level education_level job_position job_deadline".split(),
    "itviec": ["company_size"],
    "vietnamworks": "job_type experience_level education_level job_position job_deadline".split(),
}


def raw_schema(site: str) -> T.StructType:
    """All-string landing schema of a site."""
    return T.StructType([T.StructField(n, T.StringType()) for n in _BASE + _EXTRA.get(site, [])])


_LISTS = (
    "job_title_special_keywords job_industry_clean job_industry_unmapped benefits_categories_vi require_programming_languages require_frameworks require_tools "
    "require_cloud_skills require_knowledge require_domain_knowledge require_foreign_languages require_domain_university"
).split()
_NUMBERS = {"min_company_size": "bigint", "max_company_size": "bigint", "min_exp_level": "double", "max_exp_level": "double", "min_monthly_salary": "double", "max_monthly_salary": "double"}
#: The clean layer's columns in order.
_SILVER = (
    "job_url unique_url search_keyword job_deadline job_title clean_job_title job_title_special_keywords clean_company_name company_size min_company_size "
    "max_company_size location clean_location is_vietnam job_industry_clean job_industry_unmapped job_type job_position experience_level min_exp_level "
    "max_exp_level education_level salary min_monthly_salary max_monthly_salary benefits benefits_text_clean benefits_categories_vi job_description "
    "job_description_cleaned requirements requirements_cleaned require_programming_languages require_frameworks require_tools require_cloud_skills "
    "require_knowledge require_domain_knowledge require_foreign_languages require_domain_university"
).split()
SILVER = T.StructType(
    [
        T.StructField(n, T.ArrayType(T.StringType()) if n in _LISTS else {"bigint": T.LongType(), "double": T.DoubleType()}.get(_NUMBERS.get(n, ""), T.StringType()))
        for n in _SILVER
    ]
)
PARTITIONS = ["source_site", "year", "month", "day"]


def lenient_cast(c: Column, was: T.DataType, to: T.DataType) -> Column:
    """Null instead of an error; text becomes boolean through a number."""
    if was == to:
        return c
    if isinstance(was, T.StringType) and isinstance(to, T.BooleanType):
        return c.try_cast("bigint").cast("boolean")
    return c.try_cast(to)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """PF-02: cast leniently, add missing columns as null, drop others, put in order."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(*[(lenient_cast(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])
