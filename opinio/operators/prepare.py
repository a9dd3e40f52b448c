"""Preparation operators: rename/drop/reorder, recodes, filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.functions.dates import parse_slash_date, strip_leading_newline
from opinio.functions.text import WHITESPACE_RUN
from opinio.schemas import LABELED_COLUMNS, RAW_COLUMNS

# Source-file column names -> table column names.
RAW_RENAMES = {
    "reviewID": "review_id",
    "reviewerID": "reviewer_id",
    "restaurantID": "restaurant_id",
    "date": "timestamp",
    "rating": "rating",
    "reviewContent": "review_content",
    "friendCount": "friend_count",
    "reviewCount": "review_count",
    "usefulCount": "useful_count",
    "coolCount": "cool_count",
    "funnyCount": "funny_count",
    "restaurantRating": "restaurant_rating",
}
LABELED_RENAMES = {
    "reviewID": "review_id",
    "reviewerID": "reviewer_id",
    "restaurantID": "restaurant_id",
    "date": "timestamp",
    "reviewContent": "review_content",
    "friendCount": "friend_count",
    "reviewCount": "review_count",
    "usefulCount": "useful_count",
    "coolCount": "cool_count",
    "funnyCount": "funny_count",
    "restaurantRating": "restaurant_rating",
    "mnr": "maximum_review_per_user",
    "rl": "review_length",
    "rd": "rating_deviation",
    "Maximum Content Similarity": "cos_sim",
}
RAW_DROPPED = ["reviewUsefulCount"]
LABELED_DROPPED = [
    "reviewUsefulCount", "name", "location", "yelpJoinDate",
    "firstCount", "complimentCount", "tipCount", "fanCount",
]


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns by map (names absent from ``df`` are ignored)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns and k != v})


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns."""
    return df.drop(*cols)


def reorder(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Select a fixed column layout."""
    return df.select(*cols)


def _redate(df: DataFrame, col: str = "timestamp") -> DataFrame:
    return df.withColumn(col, parse_slash_date(strip_leading_newline(col)))


def prepare_raw(df: DataFrame) -> DataFrame:
    """Raw source file -> raw table layout: rename, drop, date to timestamp."""
    out = drop_columns(rename(df, RAW_RENAMES), RAW_DROPPED)
    return reorder(_redate(out), RAW_COLUMNS)


def prepare_labeled(df: DataFrame) -> DataFrame:
    """Labeled source file -> 17-column labeled layout."""
    out = rename(drop_columns(df, LABELED_DROPPED), LABELED_RENAMES)
    return reorder(_redate(out), LABELED_COLUMNS)


def recode_label(c="flagged", positive: str = "Y", negative: str = "N") -> Column:
    """Boolean -> 'Y'/'N' (null stays null)."""
    b = F.col(c) if isinstance(c, str) else c
    return F.when(b, F.lit(positive)).when(~b, F.lit(negative))


def recode_text_label(c, positive: str = "Y") -> Column:
    """P5: label text -> 'true' when it equals ``positive``, else 'false'."""
    v = F.col(c) if isinstance(c, str) else c
    return F.when(v == F.lit(positive), F.lit("true")).otherwise(F.lit("false"))


def filter_value(df: DataFrame, col: str, value) -> DataFrame:
    """Rows whose column equals a value."""
    return df.where(F.col(col) == F.lit(value))


def filter_exact_ts(df: DataFrame, when, col: str = "timestamp") -> DataFrame:
    """Rows whose timestamp equals the batch instant exactly."""
    return df.where(F.col(col) == F.lit(when))


def filter_before(df: DataFrame, literal: str, col: str = "timestamp") -> DataFrame:
    """``col < timestamp 'literal'``."""
    return df.where(F.col(col) < F.to_timestamp(F.lit(literal)))


def drop_null_rows(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Drop rows with a null in any (or any listed) column."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def null_audit(df: DataFrame) -> DataFrame:
    """P10/A4: one row, ``<col>_nulls`` and ``<col>_non_null`` per column."""
    aggs = []
    for c in df.columns:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))
        aggs.append(F.count(F.col(c)).alias(f"{c}_non_null"))
    return df.agg(*aggs)


def valid_ids(df: DataFrame, col: str = "review_id") -> DataFrame:
    """Keep rows whose id is a non-blank string; the id is stripped of
    leading/trailing Unicode whitespace."""
    t = F.regexp_replace(F.col(col), f"^{WHITESPACE_RUN}|{WHITESPACE_RUN}$", "")
    return df.where(t != "").withColumn(col, t)


def page_frontier(df: DataFrame, url: str = "url", pages: int = 1, step: int = 20) -> DataFrame:
    """Every URL paired with its ``pages`` listing offsets (``?start=step*j``)."""
    j = F.explode(F.array(*[F.lit(n) for n in range(pages)]).cast("array<int>")).alias("page_no")
    return (df.select("*", j)
            .withColumn("page_no", F.col("page_no").cast("long"))
            .withColumn("offset", F.col("page_no") * F.lit(step).cast("long"))
            .withColumn("page_url", F.concat(F.col(url), F.lit("?start="), F.col("offset").cast("string"))))


def chunk_triples(arr, size: int = 3) -> Column:
    """Split an array into consecutive chunks of ``size``."""
    a = F.col(arr) if isinstance(arr, str) else arr
    n = F.ceil(F.size(a) / F.lit(float(size))).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                         lambda i: F.slice(a, i * F.lit(size) + 1, F.lit(size)))
    return F.filter(chunks, lambda c: F.size(c) > 0)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Row concatenation by column name, duplicates kept."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
