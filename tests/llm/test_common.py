from opinio.llm.common import keep_rows, row_key


def test_keep_rows_leaves_one_row_of_a_key_before_the_shuffle(spark):
    rows = [(1, "a", 1)] * 50 + [(1, "b", 1), (2, "a", 2), (None, None, 3), (None, None, 3), (4, "gone", 4)]
    docs = spark.createDataFrame(rows, "id long, text string, more int").repartition(5)
    keys = docs.where("more < 4").select(row_key("id", "text").alias("key")).distinct()
    got = keep_rows(docs, keys, "id", "text")
    assert sorted(map(str, got.collect())) == sorted({str(r) for r in docs.where("more < 4").collect()})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_first" in plan


def test_a_worker_keeps_memos_of_the_module_at_work_only(monkeypatch):
    from opinio.llm import common

    monkeypatch.setattr(common, "_MEMOS", {})
    monkeypatch.setattr(common, "_LAST", [])
    one, two = common.worker_memo("one", {}), common.worker_memo("two", {})
    common.begin_task("one")
    one["a"] = 1
    common.begin_task("one")
    assert one == {"a": 1}
    common.begin_task("two")
    two["b"] = 2
    assert (one, two) == ({}, {"b": 2})


def test_memos_of_earlier_steps_are_registered():
    from opinio.llm import bpe, common, quality

    assert any(m is bpe._CODERS for m in common._MEMOS[bpe.__name__])
    assert any(m is quality._hashes for m in common._MEMOS[quality.__name__])
