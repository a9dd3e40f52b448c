import datetime as dt

from pyspark.sql import functions as F

from opinio.operators import features as feat
from opinio.schemas import FINAL_COLUMNS, RAW
from opinio.sources.tables import reviews, scan_day
from tests.conftest import SF_SMALL


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def row(rid, reviewer, ts, rating, text, rr=3.0):
    return (rid, reviewer, "r", ts, rating, text, 1, 1, 1, 1, 1, rr)


def test_rating_deviation_edges(spark):
    t = dt.datetime(2024, 1, 1)
    df = _raw(spark, [row("1", "u", t, None, "a"), row("2", "u", t, 5, "b", 1.0)])
    got = dict(df.select("review_id", feat.rating_deviation().alias("d")).collect())
    assert got == {"1": None, "2": 1.0}


def test_null_reviewer_dropped_and_ratio(spark):
    t = dt.datetime(2024, 1, 1)
    df = _raw(spark, [row("1", "u", t, 1, "aa bb"), row("2", "u", t, 2, "aa bb"),
                      row("3", "v", t, 3, "cc dd"), row("4", None, t, 4, "x")])
    out = {r.review_id: r for r in feat.review_features(df).collect()}
    assert set(out) == {"1", "2", "3"}
    assert out["1"].maximum_review_per_user == 1.0 and out["3"].maximum_review_per_user == 0.5
    assert abs(out["1"].cos_sim - 1.0) < 1e-9 and out["3"].cos_sim == 0.0
    assert list(feat.review_features(df).columns) == FINAL_COLUMNS


def test_day_grain(spark):
    df = _raw(spark, [row("1", "u", dt.datetime(2024, 1, 1, 10), 1, "a"),
                      row("2", "u", dt.datetime(2024, 1, 1, 11), 1, "b")])
    exact = feat.review_counts(df).collect()
    day = feat.review_counts(df, grain="day").collect()
    assert sorted(r["count"] for r in exact) == [1, 1] and [r["count"] for r in day] == [2]


def test_plan_has_no_python_udf(spark):
    plan = feat.review_features(reviews(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_day_scan_prunes_partitions(spark, tmp_path):
    r = reviews(spark, SF_SMALL, with_label=False)
    path = str(tmp_path / "raw")
    r.withColumn("dt", F.to_date("timestamp")).write.partitionBy("dt").parquet(path)
    q = scan_day(spark.read.parquet(path), "2024-01-03")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert q.count() == r.where(F.to_date("timestamp") == "2024-01-03").count()


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == FINAL_COLUMNS and df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_feature_plan_has_no_cross_join(spark):
    plan = feat.review_features(reviews(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
