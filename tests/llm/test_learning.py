"""Where operator 2 learns."""

from loam.llm import toxic_crf


def test_the_model_is_fitted_in_a_task(spark, monkeypatch):
    """The driver gets the model only: its own Python neither holds the sample's texts nor fits."""
    docs = spark.createDataFrame([(k, f"plain words number {'vile' if k % 3 == 0 else 'kind'} end") for k in range(240)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(240)], "doc_id long, toxic int")
    own = docs.join(labels, "doc_id").where(~toxic_crf.held_out(docs["doc_id"])).orderBy(toxic_crf.F.xxhash64("doc_id"), "doc_id").collect()
    want = toxic_crf.fitted([r.text for r in own], [r.toxic for r in own])

    def here(*args):
        raise AssertionError("fitted by the driver")

    monkeypatch.setattr(toxic_crf, "_fit_field", here)
    got = toxic_crf.learn(docs, labels)
    assert want.weights and got.weights == want.weights and got.link.tolist() == want.link.tolist()
    assert toxic_crf.learn(docs, labels.where("toxic = 0")) is None
