"""All steps of the lakehouse, from staged lines to serving rows, gold tables and vectors."""

import datetime as dt
import json

from pyspark.sql import functions as F

from loam.operators.vectors import hashing_embedder
from loam.plans import medallion
from loam.sources.schemas import raw_schema
from loam.sources.versions import KeyedTable


def test_end_to_end(spark, tmp_path):
    root, names = f"file://{tmp_path}/lake", [f.name for f in raw_schema("topcv")]
    row = dict.fromkeys(names, "x") | {
        "job_title": "[Hot] Senior Data Engineer", "company_name": "Công ty TNHH FPT Software", "location": "Hà Nội", "job_industry": "Phần mềm, Khác", "job_url": "https://x/1?a", "salary": "10 - 20 triệu",
        "requirements": "Python, SQL, Docker. IELTS", "benefits": "Lương tháng 13, du lịch", "company_size": "50-100", "job_deadline": "5/1/2026", "experience_level": "2 - 3 năm",
    }
    rows = [row, row | {"job_url": "https://x/2", "location": None}, row | {"job_title": None, "job_url": "https://x/3"}] + [row | {"job_url": f"https://x/{k}"} for k in range(10, 40)]
    staged = tmp_path / "topcv_jobs_20260101.jsonl"
    staged.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows))
    for day in (1, 2):
        assert medallion.land(spark, f"file://{staged}", root, "topcv", dt.date(2026, 1, day))
    bad = tmp_path / "bad.jsonl"
    bad.write_text(json.dumps({"job_title": "a"}))
    assert not medallion.land(spark, f"file://{bad}", root, "topcv", dt.date(2026, 1, 3))
    assert medallion.silver(spark, root, "topcv", "2026-01-01", "2026-01-02", save=False) == 64
    assert medallion.silver(spark, root, "topcv", "2026-01-01", "2026-01-02") == 64
    assert medallion.silver(spark, root, "itviec", "2026-01-01", "2026-01-02") == 0
    try:
        counts = medallion.build_gold(spark, root, "gold_test", dt.date(2026, 1, 2))
        assert counts["jobs"] == 32 and counts["job_benefits"] == 64 and counts["dim_date"] == 1463
        assert {r.date_key for r in spark.table("gold_test.jobs").select("date_key").distinct().collect()} == {20260102}
        one = spark.table("gold_test.jobs").where("job_url = 'https://x/1'").first()
        assert (one.clean_job_title, one.clean_company_name, one.vietnam, one.min_exp_level) == ("Senior Data Engineer", "TẬP ĐOÀN FPT", True, 2.0)
        types = {r.requirement_type for r in spark.table("gold_test.job_requirements").collect()}
        assert {"special_keyword", "programming_language", "tool", "foreign_language"} <= types and "knowledge" not in types
    finally:
        spark.sql("DROP DATABASE IF EXISTS gold_test CASCADE")
    assert medallion.serve(spark, root, ["topcv", "itviec"]) == {}
    assert medallion.serve(spark, root, ["topcv"]) == {}
    ready = KeyedTable(spark, f"{root}/serving/ready_jobs", "unique_url").read()
    assert ready.count() == 32 and ready.where(F.col("scraped_at") != F.to_date(F.lit("2026-01-02"))).isEmpty()
    assert medallion.index(spark, root, ["topcv"], hashing_embedder(16), dt.date(2026, 1, 3)) == {}
    assert KeyedTable(spark, f"{root}/vectors", "id").read().count() == 32
    assert medallion.index(spark, root, ["topcv"], hashing_embedder(16), dt.date(2026, 3, 3)) == {}
    assert KeyedTable(spark, f"{root}/vectors", "id").read().count() == 0
