"""Pages of one split are parsed by many tasks."""

from datetime import date

from pyspark.sql import functions as F

from loam.sources import adverts


def test_pages_of_one_split_go_to_many_tasks(spark):
    pages = spark.range(0, 400, 1, 1).select(F.concat(F.lit("https://x.example/"), "id").alias("url"), F.lit("<h1 name='title'>T</h1>").alias("html"))
    found = adverts.parse_adverts(pages, "vietnamworks", date(2026, 1, 1)).select("job_title", F.spark_partition_id().alias("task")).collect()
    assert len(found) == 400 and {r.job_title for r in found} == {"T"}
    assert len({r.task for r in found}) > 1


def test_a_page_is_parsed_once(monkeypatch):
    made, before = [], adverts.tree
    monkeypatch.setattr(adverts, "tree", lambda html: [made.append(1), before(html)][1])
    adverts.parse_page("vietnamworks", "u", "<span>Hết hạn trong 3 ngày</span>", date(2026, 1, 1))
    assert len(made) == 1
