"""The daily feature job: one day of raw reviews -> that day's partition of the final table.

    python -m opinio.plans.daily --source raw_reviews --target reviews_final [--date YYYY-MM-DD]

Plan: day scan (a partition filter when the source is partitioned by ``dt``)
-> cleaning, length, rating deviation, per-(reviewer, timestamp) ratio and
per-reviewer similarity, all computed within that day -> overwrite of that
day's partition only (the target table must exist). No collect, no RDD, no
Python worker.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from opinio.operators.features import review_features
from opinio.session import scratch_scope
from opinio.sinks.tables import overwrite_day
from opinio.sources.tables import batch_date, scan_day


def daily_features(raw: DataFrame, day, grain: str = "exact") -> DataFrame:
    """Features of one day's reviews (the day decides every group: counts,
    the maximum count and the similarity are all per day)."""
    return review_features(scan_day(raw, batch_date(day)), grain=grain)


def run(spark: SparkSession, source: str, target: str, day=None, files: int | None = None) -> DataFrame:
    """Compute one day and overwrite its partition in ``target``; returns the written rows."""
    d = batch_date(day)
    is_path = "/" in source or "://" in source
    raw = spark.read.parquet(source) if is_path else spark.table(source)
    with scratch_scope():  # the document vectors go when the day is written
        overwrite_day(daily_features(raw, d), target, files=files, day=d)
    return scan_day(spark.table(target), d)


def main(argv=None) -> None:
    from opinio.session import build_session
    p = argparse.ArgumentParser(description="daily review-feature job")
    p.add_argument("--source", required=True, help="raw table name or parquet path")
    p.add_argument("--target", required=True, help="existing day-partitioned final table")
    p.add_argument("--date", default=None, help="partition date (default: today, UTC)")
    p.add_argument("--files", type=int, default=None, help="fixed output file count per run")
    a = p.parse_args(argv)
    spark = build_session()
    run(spark, a.source, a.target, a.date, a.files)


if __name__ == "__main__":
    main()
