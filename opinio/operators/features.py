"""Per-review features of the final table.

``review_features`` is the daily feature job's plan as one declarative
DataFrame over cleaned reviews, written once: length, rating deviation, reviews-per-day ratio and
the reviewer's highest text similarity. The wide review rows are shuffled
once: the per-(reviewer, day) counts and the per-reviewer similarity are
joined together first (both are small, one row per key), then joined to the
reviews on (reviewer_id, timestamp).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.functions.text import clean_content, content_length
from opinio.operators.similarity import materialise, reviewer_similarity
from opinio.schemas import FINAL_COLUMNS


def rating_deviation(rating="rating", restaurant_rating="restaurant_rating") -> Column:
    """``|rating - restaurant_rating| / 4``; null when either is null."""
    r = F.col(rating) if isinstance(rating, str) else rating
    rr = F.col(restaurant_rating) if isinstance(restaurant_rating, str) else restaurant_rating
    return (F.abs(r.cast("double") - rr.cast("double")) / F.lit(4.0))


def count_key(ts_col: str = "timestamp", grain: str = "exact") -> Column:
    """The time part of the A1 key: the exact timestamp or its day."""
    if grain == "exact":
        return F.col(ts_col)
    if grain == "day":
        return F.to_date(F.col(ts_col))
    raise ValueError("grain must be 'exact' or 'day'")


def review_counts(df: DataFrame, reviewer: str = "reviewer_id", ts_col: str = "timestamp",
                  grain: str = "exact") -> DataFrame:
    """A1: ``(reviewer, key, count)`` per reviewer and timestamp (or day).

    Null keys are excluded (they never survive the inner join of J1).
    Partial aggregation runs before the shuffle, so a hot reviewer costs one
    row per map task.
    """
    key = count_key(ts_col, grain).alias("count_key")
    return (df.where(F.col(reviewer).isNotNull() & F.col(ts_col).isNotNull())
            .groupBy(F.col(reviewer), key)
            .agg(F.count(F.lit(1)).alias("count")))


def max_review_count(counts: DataFrame) -> DataFrame:
    """A2: one row, the global maximum of the counts (named)."""
    return counts.agg(F.max("count").alias("max_review_count"))


def normalised_counts(counts: DataFrame) -> DataFrame:
    """``count / max(count)`` with the maximum as a scalar subquery.

    The maximum is an aggregate over the (small) counts table that Spark
    evaluates once and inlines — no collect in user code, no single-partition
    window over all rows, no cross join.
    """
    gmax = counts.agg(F.max("count")).scalar()
    return counts.withColumn("maximum_review_per_user", F.col("count").cast("double") / gmax)


def join_review_count(df: DataFrame, reviewer: str = "reviewer_id", ts_col: str = "timestamp",
                      grain: str = "exact") -> DataFrame:
    """Reviews inner-joined to their (reviewer, key) count; null keys drop out."""
    counts = review_counts(df, reviewer, ts_col, grain)
    keyed = df.withColumn("count_key", count_key(ts_col, grain))
    return keyed.join(counts, [reviewer, "count_key"], "inner").drop("count_key")


def clean_reviews(df: DataFrame, text: str = "review_content",
                  stop_words: Iterable[str] | None = None) -> DataFrame:
    """T1+T2 applied in place to the review text."""
    return df.withColumn(text, clean_content(text, stop_words))


def review_features(df: DataFrame, stop_words: Iterable[str] | None = None,
                    grain: str = "exact", empty_is_zero: bool = False,
                    keep: Iterable[str] = ()) -> DataFrame:
    """The final-table features for every review with a reviewer and a timestamp.

    Output columns: the 16 final columns (``review_content`` cleaned) plus
    any columns named in ``keep`` (e.g. ``flagged``).
    """
    base = (df.where(F.col("reviewer_id").isNotNull() & F.col("timestamp").isNotNull())
            .withColumn("review_content", clean_content("review_content", stop_words)))
    base = materialise(base, "clean")  # cleaned once, read by the counts, the vectors and the output
    counts = normalised_counts(review_counts(base, grain=grain))
    sims = reviewer_similarity(base.select("reviewer_id", "review_id", "review_content"))
    per_key = counts.join(sims, "reviewer_id", "inner")
    out = (base.withColumn("count_key", count_key("timestamp", grain))
           .join(per_key, ["reviewer_id", "count_key"], "inner")
           .withColumn("review_length", content_length("review_content", empty_is_zero))
           .withColumn("rating_deviation", rating_deviation()))
    return out.select(*FINAL_COLUMNS, *keep)
