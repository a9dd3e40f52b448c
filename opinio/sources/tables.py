"""Table sources: parquet tables, the review-shaped view and day scans."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.schemas import RAW_COLUMNS

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


#: Tables of whole texts, and the session setting that deals their rows anew.
TEXT_TABLES = ("documents", "pages", "conversations")
SCAN_PARTITIONS = "opinio.scan.partitions"


def load_table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """Full scan of one parquet table (pruning/pushdown left to Catalyst).

    By default the scan's own splits are used, whatever the size of the table or
    the cluster. A caller whose text tables are a few large row groups may ask
    for their rows to be dealt over ``partitions`` tasks, here or for a whole
    session by the setting ``opinio.scan.partitions``.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if partitions is None and name in TEXT_TABLES:
        partitions = int(spark.conf.get(SCAN_PARTITIONS, "0"))
    return df.repartition(partitions) if partitions else df


def reviews(spark: SparkSession, sf_dir: str, with_label: bool = True) -> DataFrame:
    """The review-shaped view over ``documents`` (left-joined to ``labels``).

    Columns follow the raw table layout, plus ``flagged`` (null where the
    document carries no label). The label join shuffles on ``doc_id``;
    AQE turns it into a broadcast at runtime only when the label side is
    measured small.
    """
    d = load_table(spark, sf_dir, "documents").alias("d")
    doc = F.col("d.doc_id")
    cols = [
        doc.cast("string").alias("review_id"),
        F.concat(F.lit("u"), (F.col("d.n_chars") % 250).cast("string")).alias("reviewer_id"),
        F.col("d.source").alias("restaurant_id"),
        F.to_timestamp(F.date_add(F.lit(_dt.date(2024, 1, 1)), (doc % 7).cast("int"))).alias("timestamp"),
        (F.lit(1) + doc % 5).cast("long").alias("rating"),
        F.col("d.text").alias("review_content"),
        ((doc * 3) % 50).alias("friend_count"),
        ((doc * 7) % 50).alias("review_count"),
        ((doc * 11) % 50).alias("useful_count"),
        ((doc * 13) % 50).alias("cool_count"),
        ((doc * 17) % 50).alias("funny_count"),
        (F.lit(1.0) + ((doc * 7) % 9).cast("double") * F.lit(0.5)).alias("restaurant_rating"),
    ]
    if not with_label:
        return d.select(*cols)
    lab = load_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("l_doc_id"), F.col("quality").alias("l_quality"))
    return (d.join(lab, doc == F.col("l_doc_id"), "left")
            .select(*cols, (F.col("l_quality") == 0).alias("flagged")))


def day_of(ts: Column) -> Column:
    """``DATE(timestamp)`` under the session zone (UTC)."""
    return F.to_date(ts)


def scan_day(df: DataFrame, day, ts_col: str = "timestamp", dt_col: str = "dt") -> DataFrame:
    """Rows of one calendar day.

    On a table partitioned by ``dt`` the predicate is a partition filter
    (files of other days are never opened); otherwise it is a pushed
    range predicate on the timestamp column.
    """
    d = _as_date(day)
    if dt_col in df.columns:
        return df.where(F.col(dt_col) == F.lit(d))
    start = _dt.datetime(d.year, d.month, d.day)
    end = start + _dt.timedelta(days=1)
    return df.where((F.col(ts_col) >= F.lit(start)) & (F.col(ts_col) < F.lit(end)))


def batch_date(value=None) -> _dt.date:
    """The batch date job parameter; defaults to today (UTC)."""
    if value is None:
        return _dt.datetime.now(_dt.timezone.utc).date()
    return _as_date(value)


def _as_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 12 raw columns only (no label join)."""
    return reviews(spark, sf_dir, with_label=False).select(*RAW_COLUMNS)
