import datetime as dt
import json

from pyspark.sql import functions as F

from opinio.schemas import RAW, struct_from_json_schema, struct_to_json_schema
from opinio.sinks import tables as sinks


def _rows(spark, days, rating):
    return spark.createDataFrame(
        [(f"{d}-{i}", "u", "r", dt.datetime(2024, 1, d), rating, "t", 1, 1, 1, 1, 1, 3.0)
         for d in days for i in range(2)], RAW)


def test_schema_json_roundtrip():
    spec = struct_to_json_schema(RAW)
    assert struct_from_json_schema(json.dumps(spec)) == RAW


def test_overwrite_one_day_keeps_others(spark, tmp_path):
    sinks.create_table(spark, "t_days", RAW, str(tmp_path / "t_days"))
    sinks.overwrite_day(_rows(spark, [1, 2, 3], 1), "t_days")
    sinks.overwrite_day(_rows(spark, [2], 5), "t_days")
    got = {(r.dt.day, r.rating) for r in spark.table("t_days").collect()}
    assert got == {(1, 1), (2, 5), (3, 1)}
    assert spark.table("t_days").count() == 6


def test_overwrite_requires_table(spark):
    import pytest
    with pytest.raises(ValueError):
        sinks.overwrite_day(_rows(spark, [1], 1), "no_such_table")


def test_file_count_and_messages(spark, tmp_path):
    df = _rows(spark, [1, 2, 3, 4], 2)
    assert sinks.balanced(df, files=4).rdd.getNumPartitions() == 4
    msg = sinks.to_messages(df).first()
    body = json.loads(msg.value)
    assert body["timestamp"] == int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    assert msg.key == body["review_id"]


def test_overwrite_table_replaces_all(spark, tmp_path):
    path = str(tmp_path / "whole")
    sinks.overwrite_table(_rows(spark, [1, 2], 1), path, files=2)
    sinks.overwrite_table(_rows(spark, [3], 4), path)
    got = {(r.timestamp.day, r.rating) for r in spark.read.parquet(path).collect()}
    assert got == {(3, 4)}


def test_daily_job_rewrites_only_its_day(spark, tmp_path):
    from opinio.plans import daily
    from opinio.schemas import FINAL
    src = str(tmp_path / "raw")
    raw = _rows(spark, [1, 2, 3], 2)
    raw.withColumn("dt", F.to_date("timestamp")).write.partitionBy("dt").parquet(src)
    sinks.create_table(spark, "t_final", FINAL, str(tmp_path / "t_final"))
    for d in ("2024-01-01", "2024-01-02", "2024-01-03"):
        daily.run(spark, src, "t_final", d)
    before = {r.review_id: r.maximum_review_per_user for r in spark.table("t_final").collect()}
    out = daily.run(spark, src, "t_final", "2024-01-02").collect()
    assert {r.review_id for r in out} == {"2-0", "2-1"}
    after = {r.review_id: r.maximum_review_per_user for r in spark.table("t_final").collect()}
    assert after == before and len(after) == 6


def test_one_day_overwrite_also_by_nothing(spark, tmp_path):
    import pytest
    sinks.create_table(spark, "t_one", RAW, str(tmp_path / "t_one"))
    sinks.overwrite_day(_rows(spark, [1, 2], 1), "t_one")
    with pytest.raises(Exception):
        sinks.overwrite_day(_rows(spark, [1, 2], 5), "t_one", day="2024-01-02")
    sinks.overwrite_day(_rows(spark, [2], 5), "t_one", day="2024-01-02")
    assert {(r.dt.day, r.rating) for r in spark.table("t_one").collect()} == {(1, 1), (2, 5)}
    sinks.overwrite_day(_rows(spark, [2], 5).limit(0), "t_one", day="2024-01-02")
    assert {r.dt.day for r in spark.table("t_one").collect()} == {1}


def test_daily_job_of_an_emptied_day(spark, tmp_path):
    import glob

    from opinio.plans import daily
    from opinio.schemas import FINAL
    from opinio.session import checkpoint_root
    src, empty = str(tmp_path / "raw"), str(tmp_path / "empty")
    _rows(spark, [1, 2], 2).withColumn("dt", F.to_date("timestamp")).write.partitionBy("dt").parquet(src)
    _rows(spark, [1], 2).withColumn("dt", F.to_date("timestamp")).write.partitionBy("dt").parquet(empty)
    sinks.create_table(spark, "t_emptied", FINAL, str(tmp_path / "t_emptied"))
    folder = checkpoint_root(spark).removeprefix("file://") + "/opinio/*"
    before = set(glob.glob(folder))
    assert daily.run(spark, src, "t_emptied", "2024-01-02").count() == 2
    assert daily.run(spark, empty, "t_emptied", "2024-01-02").count() == 0
    assert set(glob.glob(folder)) == before  # no scratch is left


def test_load_dated_folders(spark, tmp_path):
    from opinio.sources.files import load_table_from_day
    root, table = str(tmp_path / "in"), str(tmp_path / "t")
    for d in (1, 2):
        _rows(spark, [d], d).write.option("header", True).csv(f"{root}/2024010{d}")
    for day, mode, n in (("2024-01-01", "append", 2), ("2024-01-02", "append", 4), ("2024-01-02", "replace", 2)):
        load_table_from_day(spark, root, day, table, RAW, mode)
        assert spark.read.parquet(table).count() == n


def test_scratch_needs_a_shared_folder(monkeypatch):
    import pytest

    from opinio import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Spark:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.checkpoint_root(Spark())
