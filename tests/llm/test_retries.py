"""Operator 4 on a kept state: calls that die and are run again count their rows once."""

import pytest

from loam.llm import stream_dedup

SCHEMA = "doc_id long, text string"


def result(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect())


@pytest.mark.parametrize("where", ["content", "pending", "log", "stream", "nothing"])
def test_a_call_that_dies_is_run_again(spark, tmp_path, monkeypatch, where):
    state = f"file://{tmp_path}/state"
    first = spark.createDataFrame([(5, "a  b"), (6, "c"), (7, None)], SCHEMA)
    second = spark.createDataFrame([(1, "a b"), (2, "d"), (3, "d"), (8, "")], SCHEMA)
    stream_dedup.exact_dedup(first, state_dir=state, call="one")
    want = [(1, 1, 2, True), (2, 2, 2, True), (3, 2, 2, False), (8, 7, 2, False)]
    update, move = stream_dedup.update_state, stream_dedup._move
    with monkeypatch.context() as m:
        if where == "content":
            m.setattr(stream_dedup, "located", lambda *a: 1 / 0)
        elif where == "pending":
            m.setattr(stream_dedup, "_move", lambda *a: 1 / 0)
        elif where == "log":
            m.setattr(stream_dedup, "update_state", lambda *a: 1 / 0)
        elif where == "stream":
            m.setattr(stream_dedup, "update_state", lambda *a: (update(*a), 1 / 0))
        if where == "nothing":
            assert result(stream_dedup.exact_dedup(second, state_dir=state, call="two")) == want
        else:
            with pytest.raises(ZeroDivisionError):
                stream_dedup.exact_dedup(second, state_dir=state, call="two")
    assert move is stream_dedup._move
    for _ in range(2):
        assert result(stream_dedup.exact_dedup(second, state_dir=state, call="two")) == want
    third = spark.createDataFrame([(0, "d"), (9, "c")], SCHEMA)
    assert result(stream_dedup.exact_dedup(third, state_dir=state)) == [(0, 0, 3, True), (9, 6, 2, False)]
