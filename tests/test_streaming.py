import json

from pyspark.sql import functions as F

from opinio.schemas import ERROR, RAW
from opinio.streaming import ingest


def _good(i, **extra):
    m = {"review_id": f"r{i}", "reviewer_id": "u1", "restaurant_id": "p1", "timestamp": 1388620800 + i,
         "rating": 4, "review_content": "nice", "friend_count": 1, "review_count": 2,
         "useful_count": 0, "cool_count": 0, "funny_count": 0, "restaurant_rating": 4.5}
    m.update(extra)
    return json.dumps(m)


def messages():
    return [
        '{"review_id": "bad", "rating": ',                      # malformed
        _good(1, rating="five"),                                  # wrong type
        _good(2, error_message="upstream says no"),               # flagged
        _good(3, payload="x" * 2048),                             # oversize (limit 1 KiB here)
        _good(4),                                                 # good
    ]


def test_routes_complete_and_disjoint(spark):
    raw = spark.createDataFrame([(m,) for m in messages()], "value string")
    routed = ingest.route_messages(ingest.parse_messages(raw), max_bytes=1024)
    got = [r.route for r in routed.collect()]
    assert got == ["invalid", "invalid", "flagged", "oversize", "ok"]
    dl = ingest.dead_letters(routed).collect()
    assert len(dl) == 4 and len(ingest.table_rows(routed).collect()) == 1
    by_id = {r.review_id: r for r in dl}
    assert by_id["r2"].error_message == "upstream says no"
    assert "error_message" not in json.loads(by_id["r2"].review_snippet)
    assert by_id["r3"].error_message == ingest.OVERSIZE_MESSAGE
    assert "payload" not in json.loads(by_id["r3"].review_snippet)
    assert by_id["bad"].error_message == ingest.INVALID_MESSAGE


def test_stream_restart_adds_nothing(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.json").write_text("\n".join(messages()[:3]) + "\n")
    (src / "b.json").write_text("\n".join(messages()[3:] + [_good(5), _good(6)]) + "\n")
    table, errors, ck = str(tmp_path / "t"), str(tmp_path / "e"), str(tmp_path / "ck")
    ingest.create_sinks(spark, table, errors)
    for _ in range(2):  # second run restarts from the checkpoint with no new input
        q = ingest.start_ingest(spark, str(src), table, errors, ck, max_bytes=1024, max_files_per_trigger=1)
        q.awaitTermination()
    t = ingest.read_sink(spark, table, RAW)
    e = ingest.read_sink(spark, errors, ERROR, day=False)
    assert sorted(r.review_id for r in t.collect()) == ["r4", "r5", "r6"]
    assert e.count() == 4


def test_replayed_batch_is_idempotent(spark, tmp_path):
    raw = spark.createDataFrame([(m,) for m in messages()], "value string")
    table, errors = str(tmp_path / "t"), str(tmp_path / "e")
    ingest.write_batch(raw, 7, table, errors, max_bytes=1024)
    ingest.write_batch(raw, 7, table, errors, max_bytes=1024)  # replay of the same batch id
    assert ingest.read_sink(spark, table, RAW).count() == 1
    assert ingest.read_sink(spark, errors, ERROR, day=False).count() == 4


def test_crash_between_the_two_writes_then_replay(spark, tmp_path):
    import pytest
    raw = spark.createDataFrame([(m,) for m in messages()], "value string")
    table, errors = str(tmp_path / "t"), str(tmp_path / "e")
    blocker = tmp_path / "blocked"
    blocker.write_text("a file where the dead-letter folder should be")
    with pytest.raises(Exception):
        ingest.write_batch(raw, 3, table, str(blocker / "e"), max_bytes=1024)  # table written, errors fail
    assert ingest.read_sink(spark, table, RAW).count() == 1
    ingest.write_batch(raw, 3, table, errors, max_bytes=1024)                  # the replay after restart
    assert ingest.read_sink(spark, table, RAW).count() == 1
    assert ingest.read_sink(spark, errors, ERROR, day=False).count() == 4


def test_what_the_table_cannot_take_is_dead_lettered(spark, tmp_path):
    rows = [_good(1, timestamp=9223372036854775807), _good(2, timestamp=-(10**15)), _good(3, surprise=1),
            _good(4, surprise="x" * 5000), _good(5, timestamp=None), _good(6)]
    raw = spark.createDataFrame([(m,) for m in rows], "value string")
    routed = ingest.route_messages(ingest.parse_messages(raw), max_bytes=1024)
    assert [r.route for r in routed.collect()] == ["invalid", "invalid", "invalid", "oversize", "ok", "ok"]
    table, errors = str(tmp_path / "t"), str(tmp_path / "e")
    ingest.write_batch(raw, 1, table, errors, max_bytes=1024)
    assert {r.review_id for r in ingest.read_sink(spark, table, RAW).collect()} == {"r5", "r6"}
    got = {r.review_id: r.error_message for r in ingest.read_sink(spark, errors, ERROR, day=False).collect()}
    assert got == {"r1": ingest.RANGE_MESSAGE, "r2": ingest.RANGE_MESSAGE, "r3": ingest.UNKNOWN_MESSAGE,
                   "r4": ingest.OVERSIZE_MESSAGE}


def test_replay_past_midnight_replaces_dead_letters(spark, tmp_path):
    import datetime as dt
    raw = spark.createDataFrame([(m,) for m in messages()], "value string")
    table, errors = str(tmp_path / "t"), str(tmp_path / "e")
    for now in (dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2, 0, 1)):
        ingest.write_batch(raw, 4, table, errors, max_bytes=1024, now=F.lit(now))
    assert ingest.read_sink(spark, errors, ERROR, day=False).count() == 4


def test_sinks_must_exist_and_any_stream_will_do(spark, tmp_path):
    import pytest
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.json").write_text("\n".join(messages()) + "\n")
    table, errors, ck = str(tmp_path / "t"), str(tmp_path / "e"), str(tmp_path / "ck")
    stream = spark.readStream.format("text").load(str(src))
    with pytest.raises(ValueError):
        ingest.start_ingest(spark, stream, table, errors, ck)
    ingest.create_sinks(spark, table, errors)
    ingest.start_ingest(spark, stream, table, errors, ck, max_bytes=1024).awaitTermination()
    assert ingest.read_sink(spark, table, RAW).count() == 1
    ingest.compact_table(spark, table, str(tmp_path / "c"), RAW)
    assert [r.review_id for r in spark.read.parquet(str(tmp_path / "c")).collect()] == ["r4"]
