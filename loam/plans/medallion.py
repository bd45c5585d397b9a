"""End-to-end steps over a lakehouse root, and their command line.

    python -m loam.plans.medallion silver --site topcv --from 2026-01-01 --to 2026-01-02 --root s3a://lake
"""

from __future__ import annotations

import argparse
import sys
from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.functions import cleaning, fixed
from loam.functions.rules import rules
from loam.functions.text import trim_ws
from loam.operators import gold, quality, vectors
from loam.operators.relational import company_seed, keep_first, nonblank
from loam.operators.sites import SITES, Seeds, clean_site
from loam.sources import scan, sinks
from loam.sources.schemas import PARTITIONS, SILVER, raw_schema
from loam.sources.versions import KeyedTable

SEEDS = Path(__file__).resolve().parent.parent / "seeds"
#: Taxonomy file of each list column; a file that is missing gives empty lists.
TAXONOMIES = {
    "require_programming_languages": "program_lang", "require_frameworks": "framework", "require_tools": "tools", "require_cloud_skills": "cloud_skill",
    "require_knowledge": "knowledge", "require_domain_knowledge": "domain", "require_foreign_languages": "language", "require_domain_university": "domain_university",
}
FACT = ["job_url", "clean_job_title", "clean_company_name", "clean_location", "vietnam", "job_type", "job_position", "education_level", "min_monthly_salary", "max_monthly_salary", "min_exp_level", "max_exp_level", "min_company_size", "max_company_size", "job_deadline", "source_site"]


def load_seeds(spark: SparkSession, folder: Path = SEEDS) -> Seeds:
    """Rule sets of a seed folder (headers as in ``loam/seeds``)."""
    def taxonomy(stem: str, label: str) -> list | None:
        path = folder / f"{stem}_taxonomy.csv"
        return rules(scan.seed(str(path)), label) if path.exists() else None

    pairs = company_seed([(r["variant_name"], r["canonical_name"]) for r in scan.seed(str(folder / "company_mapping.csv"))])
    return Seeds(
        spark.createDataFrame(pairs, "variant_name string, canonical_name string"), rules(scan.seed(str(folder / "location_mapping.csv")), "canonical_vi"),
        taxonomy("industry", "canonical_en") or [], taxonomy("benefit", "canonical_vi") or [], {c: taxonomy(stem, "canonical_en") for c, stem in TAXONOMIES.items()},
    )


def land(spark: SparkSession, staged: str, root: str, site: str, day: date) -> bool:
    """Staging lines through the quality gate into the landing layer; False if the gate fails."""
    df = spark.read.schema(raw_schema(site)).json(staged)
    base = [f.name for f in raw_schema("")]
    extra = [f.name for f in raw_schema(site) if f.name not in base]
    if not quality.gate(df, quality.expectations(site, base, extra)):
        return False
    parts = {"year": f"{day:%Y}", "month": f"{day:%m}", "day": f"{day:%d}"}
    sinks.to_bronze(df.withColumns({k: F.lit(v) for k, v in parts.items()}), f"{root}/bronze/{site}")
    return True


def silver(spark: SparkSession, root: str, site: str, start: str, end: str, seeds: Seeds | None = None, save: bool = True) -> int:
    """Landing days to a new clean snapshot; rows written (or, without ``save``, counted)."""
    raw = scan.bronze(spark, f"{root}/bronze/{site}", site, start, end)
    if raw is None:
        return 0
    out = clean_site(raw.withColumn("source_site", F.lit(site)), SITES[site], seeds or load_seeds(spark))
    if not save:
        return out.count()
    seen = Observation("silver rows")
    sinks.to_silver(out.observe(seen, F.count(F.lit(1)).alias("n")), f"{root}/silver/jobs")
    return seen.get["n"]


def build_gold(spark: SparkSession, root: str, database: str = "gold", today: date | None = None) -> dict[str, int]:
    """Star schema from all snapshots: fact, date dimension, bridges."""
    today = today or date.today()
    staged = gold.staging(scan.silver_all(spark, f"{root}/silver/jobs"))
    staged = staged.withColumn("vietnam", gold.country_flag(F.col("is_vietnam")))
    return sinks.full_refresh(
        spark,
        [
            ("dim_date", gold.dim_date(scan.calendar(spark, "2023-01-01", f"{today + timedelta(days=365)}"))),
            ("jobs", gold.facts(staged, FACT)),
            ("job_industries", gold.bridge(staged, "job_industry_clean", "industry")),
            ("job_benefits", gold.bridge(staged, "benefits_categories_vi", "benefit")),
            ("job_requirements", gold.requirements(staged)),
        ],
        database,
    )


def _snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Newest snapshots of all sites; listed once, however many sites follow."""
    schema = T.StructType([*SILVER.fields, *[T.StructField(c, T.StringType()) for c in PARTITIONS]])
    rows = scan.silver_latest(spark, f"{root}/silver/jobs", schema)
    return rows.withColumn("silver_date", F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")]))


def ready_jobs(latest: DataFrame) -> DataFrame:
    """Serving rows: newest per key, names as the serving table has them."""
    key = F.coalesce(F.nullif(trim_ws(F.col("unique_url")), F.lit("")), cleaning.unique_url(cleaning.clean_url(F.col("job_url")), F.col("source_site")))
    rows = nonblank(latest.withColumn("unique_url", key), "unique_url")
    rows = keep_first(rows, ["unique_url"], [F.desc_nulls_last("silver_date"), F.desc_nulls_last("job_deadline"), F.asc("job_url")])
    return rows.select(
        "job_url", "unique_url", F.col("clean_job_title").alias("job_title"), F.col("clean_company_name").alias("company_name"), F.col("clean_location").alias("location"),
        "job_deadline", "job_title_special_keywords", "source_site", F.col("silver_date").alias("scraped_at"),
    )


def serve(spark: SparkSession, root: str, sites: list[str]) -> dict[str, str]:
    """Keyed upsert of the serving table, site by site; failures by site."""
    latest = _snapshots(spark, root)
    return sinks.per_site(sites, lambda site: sinks.upsert_table(ready_jobs(latest.where(F.col("source_site") == site)), f"{root}/serving/ready_jobs", "unique_url"))


def index(spark: SparkSession, root: str, sites: list[str], model, today: date) -> dict[str, str]:
    """Vector points of the newest jobs, upserted by id; expired points go."""
    latest = _snapshots(spark, root)

    def one(site: str) -> None:
        jobs = vectors.latest_jobs(latest.where(F.col("source_site") == site))
        jobs = jobs.withColumn("job_title", F.coalesce("clean_job_title", "job_title"))
        skills = [c for c, _ in fixed.REQUIREMENT_TYPES]
        keep = jobs.select("unique_url", "job_title", "source_site", "silver_date", F.to_date(F.lit(f"{today}")).alias("indexed_at"), *skills, vectors.document_text(jobs).alias("body"))
        made = vectors.points(vectors.embed(keep, "body", model))
        dates = F.from_json("payload", "source_site string, silver_date date, indexed_at date")
        sinks.upsert_table(made.withColumn("p", dates).select("id", "vector", "payload", "p.source_site", "p.silver_date", "p.indexed_at"), f"{root}/vectors", "id")

    failed = sinks.per_site(sites, one)
    points = KeyedTable(spark, f"{root}/vectors", "id")
    points.delete(vectors.expired(F.to_date(F.lit(f"{today}"))))
    points.vacuum(2)
    return failed


def main(args: list[str]) -> int:
    """Command line; exit 1 if a gate or a site failed."""
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("step", choices=["land", "silver", "gold", "serve", "index"])
    p.add_argument("--root", required=True)
    p.add_argument("--site", action="append", choices=sorted(SITES))
    p.add_argument("--staged")
    p.add_argument("--from", dest="start", default=f"{date.today()}")
    p.add_argument("--to", dest="end", default=f"{date.today()}")
    p.add_argument("--no-save", action="store_true")
    a = p.parse_args(args)
    from loam.session import build_session

    spark, sites = build_session(), list(dict.fromkeys(a.site or sorted(SITES)))
    if a.step == "land":
        return int(not all([land(spark, a.staged, a.root, s, date.fromisoformat(a.start)) for s in sites]))
    if a.step == "silver":
        print({s: silver(spark, a.root, s, a.start, a.end, save=not a.no_save) for s in sites})
        return 0
    if a.step == "gold":
        print(build_gold(spark, a.root))
        return 0
    failed = serve(spark, a.root, sites) if a.step == "serve" else index(spark, a.root, sites, vectors.hashing_embedder(), date.today())
    print(failed)
    return int(bool(failed))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
