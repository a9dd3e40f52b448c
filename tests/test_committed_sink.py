import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from opinio.schemas import ERROR, RAW
from opinio.sinks import committed as cm
from opinio.streaming import ingest
from tests.test_streaming import _good, messages



def now():
    return F.lit(dt.datetime(2024, 6, 1, 12))


def planted(bad, calls):
    """An inserter (files) that rejects rows of planted ids and notes each call."""
    class Planted(cm.FileInserter):
        def insert(self, kind, rows, ids):
            with open(calls, "a") as f:
                f.write(json.dumps([kind, [r.review_id for r in rows], list(ids)]) + "\n")
            if any((kind, r.review_id) in bad for r in rows):
                raise ValueError("the store says no")
            return super().insert(kind, rows, ids)
    return Planted


def inserted(path, bad=(), calls=os.devnull):
    return planted(set(bad), str(calls))(path, {cm.TABLE: RAW, cm.LETTERS: ERROR})


def start(spark, tmp_path, path, ck="ck", **more):
    stream = spark.readStream.format("text").load(str(tmp_path / "src"))
    place = F.regexp_extract("value", '"review_id": *"([^"]*)"', 1)
    return ingest.start_committed(stream, path, str(tmp_path / ck), insert_id=place, max_bytes=1024, now=now(), **more)


def source(tmp_path, *texts):
    (tmp_path / "src").mkdir(exist_ok=True)
    for t in texts:
        (tmp_path / "src" / f"{uuid.uuid4().hex}.json").write_text("\n".join(t) + "\n")


def ids(spark, path, kind):
    schema = RAW if kind == cm.TABLE else ERROR
    return sorted(r.review_id or "" for r in cm.read_committed(spark, path, kind, schema).collect())


# --- bisection and retries -------------------------------------------------------

def test_bisection_isolates_the_rows_that_fail():
    written, tried = [], []

    def insert(part):
        tried.append(len(part))
        if any(x in (3, 500, 501, 999) for x in part):
            raise ValueError(f"no {len(part)}")
        written.extend(part)
        return [len(part)]

    receipts, failed = cm.insert_all(insert, list(range(1000)))
    assert [x for x, _ in failed] == [3, 500, 501, 999] and failed[0][1] == "ValueError: no 1"
    assert written == [x for x in range(1000) if x not in (3, 500, 501, 999)] and sum(receipts) == 996
    assert len(tried) < 100                       # some k log n inserts, not n
    assert cm.insert_all(insert, []) == ([], [])


def test_transient_errors_are_retried_with_a_bound(monkeypatch):
    waits, left = [], [2]
    monkeypatch.setattr(cm.time, "sleep", waits.append)

    def insert(part):
        if left[0]:
            left[0] -= 1
            raise cm.TransientError("busy")
        return [len(part)]

    assert cm.insert_all(insert, [1, 2, 3], retries=3, pause=0.5) == ([3], [])
    assert waits == [0.5, 1.0]
    left[0] = 10
    with pytest.raises(cm.TransientError):        # rows are not dead-lettered for it
        cm.insert_all(insert, [1, 2, 3], retries=3, pause=0.5)
    assert left[0] == 6


# --- the sink in a stream ----------------------------------------------------------

def test_rows_that_the_store_rejects_are_dead_lettered(spark, tmp_path):
    """Every row ends up once: in the table, as its own dead letter, or as that of its failed insert."""
    path, calls = str(tmp_path / "sink"), tmp_path / "calls"
    cm.create_sink(path)
    source(tmp_path, messages() + [_good(i) for i in range(100, 130)])
    start(spark, tmp_path, path, inserter=inserted(path, {("table", "r111"), ("table", "r4")}, calls)).awaitTermination()
    assert ids(spark, path, cm.TABLE) == sorted(f"r{i}" for i in range(100, 130) if i != 111)
    assert ids(spark, path, cm.LETTERS) == sorted(["bad", "r1", "r2", "r3", "r111", "r4"])
    seen = [json.loads(x) for x in calls.read_text().splitlines()]
    assert all(rid == i for kind, rids, own in seen if kind == "table" for rid, i in zip(rids, own))


def test_a_letter_that_fails_is_replaced(spark, tmp_path):
    path = str(tmp_path / "sink")
    cm.create_sink(path)

    class NoSnippets(cm.FileInserter):
        def insert(self, kind, rows, ids):
            if kind == cm.LETTERS and any(r.review_snippet and "upstream" not in r.error_message and r.review_id == "r3"
                                          for r in rows):
                raise ValueError("snippet too long")
            return super().insert(kind, rows, ids)

    source(tmp_path, messages())
    start(spark, tmp_path, path, inserter=NoSnippets(path, {cm.TABLE: RAW, cm.LETTERS: ERROR})).awaitTermination()
    letters = {r.review_id: r for r in cm.read_committed(spark, path, cm.LETTERS, ERROR).collect()}
    assert sorted(letters) == ["bad", "r1", "r2", "r3"]
    assert letters["r3"].review_snippet is None
    assert letters["r3"].error_message == "[letters] error while writing: ValueError: snippet too long"


def test_a_crash_before_the_manifest_shows_nothing_of_the_batch(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "sink")
    cm.create_sink(path)
    source(tmp_path, messages())
    os.chmod(f"{path}/manifests", 0o755)
    os.rename(f"{path}/manifests", f"{path}/moved")           # no manifest can be put in place
    q = start(spark, tmp_path, path)
    with pytest.raises(Exception):
        q.awaitTermination()
    os.rename(f"{path}/moved", f"{path}/manifests")
    assert ids(spark, path, cm.TABLE) == ids(spark, path, cm.LETTERS) == []
    start(spark, tmp_path, path).awaitTermination()           # the replay of the batch
    assert ids(spark, path, cm.TABLE) == ["r4"] and ids(spark, path, cm.LETTERS) == ["bad", "r1", "r2", "r3"]
    assert len(os.listdir(f"{path}/manifests")) == 1          # both tables in one
    leftover = len(os.listdir(f"{path}/data")) - len(cm.live_files(spark, path).collect())
    assert cm.remove_unnamed(spark, path, older_than=0) == leftover
    assert ids(spark, path, cm.TABLE) == ["r4"]


def test_a_replay_after_the_manifest_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "sink")
    cm.create_sink(path)
    source(tmp_path, messages())
    start(spark, tmp_path, path).awaitTermination()
    before = sorted(tuple(r) for r in cm.live_files(spark, path).collect())
    commits = tmp_path / "ck" / "commits"
    for f in os.listdir(commits):                              # as if the crash came before Spark's own commit
        os.remove(commits / f)
    start(spark, tmp_path, path).awaitTermination()
    assert sorted(tuple(r) for r in cm.live_files(spark, path).collect()) == before
    assert len(os.listdir(f"{path}/data")) == len(before)


def test_another_query_adds_to_the_same_sink(spark, tmp_path):
    path = str(tmp_path / "sink")
    cm.create_sink(path)
    source(tmp_path, [_good(1)])
    start(spark, tmp_path, path, ck="one").awaitTermination()
    start(spark, tmp_path, path, ck="two").awaitTermination()  # its batch 0 is another one
    assert ids(spark, path, cm.TABLE) == ["r1", "r1"]


def test_a_store_that_stays_away_fails_the_batch(spark, tmp_path):
    path = str(tmp_path / "sink")
    cm.create_sink(path)

    class Away(cm.FileInserter):
        def insert(self, kind, rows, ids):
            raise cm.TransientError("away")

    source(tmp_path, [_good(1)])
    with pytest.raises(Exception):
        start(spark, tmp_path, path, inserter=Away(path, {}), retries=1, pause=0.01).awaitTermination()
    assert ids(spark, path, cm.TABLE) == [] and ids(spark, path, cm.LETTERS) == []
    start(spark, tmp_path, path).awaitTermination()
    assert ids(spark, path, cm.TABLE) == ["r1"]


def test_values_come_back_as_they_went(spark, tmp_path):
    path = str(tmp_path / "sink")
    cm.create_sink(path)
    rows = [_good(1, timestamp=None), _good(2, review_content="é\n日本", rating=None), _good(3, timestamp=-62135596800 + 86400)]
    source(tmp_path, rows)
    start(spark, tmp_path, path).awaitTermination()
    raw = spark.createDataFrame([(m,) for m in rows], "value string")
    want = ingest.table_rows(ingest.route_messages(ingest.parse_messages(raw), 1024))
    got = cm.read_committed(spark, path, cm.TABLE, RAW)
    assert sorted(map(repr, got.withColumn("timestamp", F.unix_timestamp("timestamp")).collect())) == \
        sorted(map(repr, want.withColumn("timestamp", F.unix_timestamp("timestamp")).collect()))
    assert cm.read_committed(spark, path, cm.TABLE, RAW, day=dt.date(2014, 1, 2)).count() == 1


# --- compaction --------------------------------------------------------------------------

def test_packing_is_by_measured_bytes():
    files = [("a", 50), ("b", 40), ("c", 30), ("d", 30), ("e", 10), ("f", 95)]
    bins = cm.packed(files, 100)
    assert bins == [["a", "b", "e"], ["c", "d"]] and cm.packed([("a", 5)], 100) == []


def test_compaction_rewrites_small_files_only(spark, tmp_path):
    path = str(tmp_path / "sink")
    cm.create_sink(path)
    for day in (0, 1):
        for k in range(4):
            source(tmp_path, [_good(100 * day + k, timestamp=1388620800 + day * 86400 + k)])
    source(tmp_path, [_good(i, review_content="big " * 40, timestamp=1388620800) for i in range(1000, 3000)])
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(tmp_path / "src"))
    ingest.start_committed(stream, path, str(tmp_path / "ck"), now=now()).awaitTermination()
    files = cm.live_files(spark, path).where("kind = 'table'").collect()
    big = [f.file for f in files if f.rows > 100]
    before = sorted(map(repr, cm.read_committed(spark, path, cm.TABLE, RAW).collect()))
    small = max(f.bytes for f in files if f.rows < 100) + 1
    assert len(files) == 9 and len(big) == 1 and small < min(f.bytes for f in files if f.rows > 100)
    assert cm.compact(spark, path, small=small, target=1 << 20) == 2      # one file a day
    after = cm.live_files(spark, path).where("kind = 'table'").collect()
    assert len(after) == 3 and big[0] in {f.file for f in after}
    assert {f.day for f in after} == {"2014-01-02", "2014-01-03"}
    assert sorted(map(repr, cm.read_committed(spark, path, cm.TABLE, RAW).collect())) == before
    manifests = sorted(os.listdir(f"{path}/manifests"))
    assert cm.compact(spark, path, small=small, target=1 << 20) == 0      # nothing is left to do
    assert sorted(os.listdir(f"{path}/manifests")) == manifests
    assert cm.remove_unnamed(spark, path) == 0 and cm.remove_unnamed(spark, path, older_than=0) == 8
    assert sorted(map(repr, cm.read_committed(spark, path, cm.TABLE, RAW).collect())) == before


def test_a_batch_load_is_published_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "sink")
    cm.create_sink(path)
    raw = spark.createDataFrame([(m,) for m in messages()], "value string")
    rows = ingest.sink_rows(ingest.route_messages(ingest.parse_messages(raw), 1024), F.lit("x"), now())
    assert rows.schema.simpleString() == cm.sink_schema(RAW, ERROR).simpleString()
    source_ = cm.committed_sink(path, cm.FileInserter(path, {cm.TABLE: RAW, cm.LETTERS: ERROR}))
    spark.dataSource.register(source_)
    rows.write.format(source_.name()).mode("append").save()
    assert ids(spark, path, cm.TABLE) == ["r4"] and len(ids(spark, path, cm.LETTERS)) == 4


def test_letters_of_rows_keep_their_values():
    made = cm._letter(("id", Row(review_id="a", rating=None, timestamp=None)), cm.TABLE, "no")
    assert made[0] == "id#table" and json.loads(made[1].review_snippet) == {"review_id": "a", "rating": None, "timestamp": None}
