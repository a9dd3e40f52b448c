"""Exact, repeatable sampling: class under-sampling (M1) and the 75/25 split (M3).

Rows are ranked by a seeded hash of their id; rows that share a rank (equal or
null ids) are ordered by a row number. Taking "the k lowest rows" exactly,
without sorting a class in one task, is a selection problem: the range of the
rank is cut into buckets, one aggregation counts rows per bucket, and the
bucket that holds the k-th row is narrowed until it is a single rank; the row
numbers within that rank are narrowed the same way. Each round is a scan plus
an aggregation of at most ``buckets`` rows that the driver reads; the selected
rows are a plain filter and never pass through the driver or one task.

Ranked rows are written once to the shared folder, so row numbers are final.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.operators.similarity import materialise

_HEX_DIGITS = 15  # 60-bit rank, fits a signed long
RANK, ROW = "__rank", "__row"


def hash_rank(id_col: str, seed: int = 42) -> Column:
    """Seeded rank of a row: the first 60 bits of ``md5('<seed>:<id>')``; a null
    id has the rank of the empty text after the colon."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("long")


def ranked(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """``df`` with its rank and row number, written once."""
    return materialise(df.withColumn(RANK, hash_rank(id_col, seed))
                       .withColumn(ROW, F.monotonically_increasing_id()), "ranked")


def kth_value(df: DataFrame, column: str, k: int, buckets: int = 4096) -> tuple[int, int]:
    """The k-th smallest value of an integer column, and the number of rows below it."""
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    if lo is None or not 0 < k:
        raise ValueError("k exceeds the number of rows")
    below = 0
    while True:
        width = -(-(hi - lo + 1) // buckets)
        part = df.where(F.col(column).between(lo, hi))
        bucket = F.expr(f"(`{column}` - {lo}L) div {width}L").alias("b")
        for b, n in sorted(part.groupBy(bucket).count().collect()):
            if below + n >= k:
                break
            below += n
        else:
            raise ValueError("k exceeds the number of rows")
        lo, hi = lo + b * width, min(hi, lo + (b + 1) * width - 1)
        if width == 1:
            return lo, below


def lowest(rows: DataFrame, k: int, buckets: int = 4096) -> Column:
    """The condition that holds for exactly the ``k`` lowest of :func:`ranked` rows."""
    if k <= 0:
        return F.lit(False)
    rank, below = kth_value(rows, RANK, k, buckets)
    last, _ = kth_value(rows.where(F.col(RANK) == F.lit(rank)), ROW, k - below, buckets)
    return (F.col(RANK) < F.lit(rank)) | ((F.col(RANK) == F.lit(rank)) & (F.col(ROW) <= F.lit(last)))


def take_lowest(df: DataFrame, id_col: str, k: int, seed: int = 42, buckets: int = 4096) -> DataFrame:
    """Exactly ``k`` rows of ``df``: the lowest by hash rank."""
    rows = ranked(df, id_col, seed)
    return rows.where(lowest(rows, k, buckets)).drop(RANK, ROW)


def under_sample(df: DataFrame, label: str = "flagged", id_col: str = "review_id",
                 seed: int = 42) -> DataFrame:
    """M1: every class cut to the size of the smallest class (exact counts).

    Rows without a label belong to no class and are left out.
    """
    rows = ranked(df.where(F.col(label).isNotNull()), id_col, seed)
    counts = dict(rows.groupBy(label).count().collect())
    k = min(counts.values(), default=0)
    keep = F.lit(False)
    for value, n in sorted(counts.items()):
        own = F.col(label) == F.lit(value)
        keep = keep | (own if n == k else own & lowest(rows.where(own), k))
    return rows.where(keep).drop(RANK, ROW)


def train_test_split(df: DataFrame, id_col: str = "review_id", test_size: float = 0.25,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """M3: (train, test); test holds ``ceil(n * test_size)`` rows, lowest hash rank
    first. Every row is in exactly one of them, also those with null or equal ids."""
    rows = ranked(df, id_col, seed)
    in_test = lowest(rows, math.ceil(rows.count() * test_size))
    return rows.where(~in_test).drop(RANK, ROW), rows.where(in_test).drop(RANK, ROW)
