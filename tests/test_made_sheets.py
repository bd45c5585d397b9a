"""Made sheets stay small and are written by the tasks."""

from loam.plans import q_sources, registry

registry.load()


def test_a_brand_has_a_sheet_for_each_range_of_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(q_sources, "SHEET_KEYS", 4)
    monkeypatch.setattr(q_sources, "work_dir", lambda s: f"{tmp_path}/work")
    spark.createDataFrame([(k, f"p{k}", "B#1") for k in range(1, 11)], "p_partkey long, p_name string, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    got = q_sources.q_sheet(spark, str(tmp_path)).collect()
    assert sorted((int(r.id), r.name, r.brand) for r in got) == [(k, f"p{k}", "" if k % 7 == 0 else "B#1") for k in range(1, 11)]
    assert {r.note for r in got if int(r.id) % 5} == {'a, "b"\nc'} and {r.note for r in got if int(r.id) % 5 == 0} == {"�x"}
    assert len(list((tmp_path / "work").rglob("part-*.txt"))) == 3
