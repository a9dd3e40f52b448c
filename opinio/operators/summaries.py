"""Counts, summaries, histograms, top terms and limits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.functions.text import default_stop_words, word_runs
from opinio.operators.similarity import materialise


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    """A3: row count, overall (no columns) or per group (partial aggregation first)."""
    if not cols:
        return df.agg(F.count(F.lit(1)).alias("n"))
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A5: distinct values of one column."""
    return df.select(col).distinct()


def exact_quantiles(df: DataFrame, metric: str, by: tuple[str, ...], shares: dict[str, float]) -> DataFrame:
    """Exact quantiles (linear between neighbours) per group, one column per share.

    Values are counted, range-partitioned by (group, value) and numbered by a
    running sum within each partition plus the counts of the partitions before
    it, so no group is gathered in one buffer or task.
    """
    v = F.col(metric).cast("double")
    counts = df.where(v.isNotNull()).groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    placed = materialise(counts.repartitionByRange(*[F.col(c) for c in by], F.col("_v"))
                         .withColumn("_part", F.spark_partition_id()), "quantiles")
    parts = placed.groupBy("_part", *by).agg(F.sum("_n").alias("_size"))
    # One row per partition and group.
    own = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", *by, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"),
                         F.sum("_size").over(own).alias("_total"))
    names = ["_part", *by]
    parts = parts.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(names)], "_base", "_total")
    match = F.lit(True)
    for i, c in enumerate(names):
        match = match & F.col(c).eqNullSafe(F.col(f"_{i}"))
    run = Window.partitionBy(*names).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.join(parts, match)
    rows = rows.withColumn("_end", F.col("_base") + F.sum("_n").over(run)).withColumn("_start", F.col("_end") - F.col("_n"))

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("_start") <= position) & (position < F.col("_end")), F.col("_v")))

    found = []
    for name, share in shares.items():
        position = (F.col("_total") - 1) * F.lit(share)
        found += [at(F.floor(position)).alias(f"{name}_low"), at(F.ceil(position)).alias(f"{name}_high"),
                  F.max(position - F.floor(position)).alias(f"{name}_part")]
    agg = rows.groupBy(*by).agg(*found)
    return agg.select(*by, *[(F.col(f"{n}_low") + (F.col(f"{n}_high") - F.col(f"{n}_low")) * F.col(f"{n}_part")).alias(n)
                             for n in shares])


def describe(df: DataFrame, metric: str, *by: str) -> DataFrame:
    """Count, mean, sample std, min, linear quartiles, max (per group).

    The input is read twice; a costly one is best written first.
    """
    m = F.col(metric).cast("double")
    aggs = [F.count(m).alias("count"), F.avg(m).alias("mean"), F.stddev_samp(m).alias("std"),
            F.min(m).alias("min"), F.max(m).alias("max")]
    base = df.groupBy(*by).agg(*aggs)
    quartiles = exact_quantiles(df, metric, by, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    if not by:  # one row each
        base, quartiles, by = base.withColumn("_one", F.lit(1)), quartiles.withColumn("_one", F.lit(1)), ("_one",)
    quartiles = quartiles.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(by)], "p25", "p50", "p75")
    match = F.lit(True)
    for i, c in enumerate(by):
        match = match & F.col(c).eqNullSafe(F.col(f"_{i}"))
    return base.join(quartiles, match, "left").select(
        *[c for c in by if c != "_one"], "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def histogram(df: DataFrame, metric: str, width: float, *by: str) -> DataFrame:
    """Fixed-width bucket counts (bucket = lower edge)."""
    bucket = (F.floor(F.col(metric).cast("double") / F.lit(float(width))) * F.lit(float(width))).alias("bucket")
    return (df.where(F.col(metric).isNotNull())
            .groupBy(*by, bucket).agg(F.count(F.lit(1)).alias("n")))


def term_counts(df: DataFrame, text: str, by: Iterable[str] = (),
                stop_words: Iterable[str] | None = None) -> DataFrame:
    """Lower-cased word runs (two or more characters), stop words removed, counted."""
    stop = list(default_stop_words() if stop_words is None else stop_words)
    toks = F.filter(word_runs(F.lower(F.col(text)), min_len=2), lambda x: ~x.isin(stop))
    return (df.select(*by, F.explode(toks).alias("term"))
            .groupBy(*by, "term").agg(F.count(F.lit(1)).alias("n")))


def top_terms(df: DataFrame, text: str, class_col: str, classes: Iterable, k: int = 50,
              stop_words: Iterable[str] | None = None) -> DataFrame:
    """The ``k`` most frequent terms of each class (ties by term).

    One scan and one count for all classes; each task keeps at most ``k`` terms
    of a class before the shuffle (a rank limit on the window).
    """
    counts = term_counts(df.where(F.col(class_col).isin(list(classes))), text, [class_col], stop_words)
    order = Window.partitionBy(class_col).orderBy(F.col("n").desc(), F.col("term"))
    return counts.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k).drop("_place")


def first_n(df: DataFrame, n: int, order: str = "review_id") -> DataFrame:
    """L1: first ``n`` rows in a stated order (repeatable)."""
    return df.orderBy(F.col(order)).limit(n)


def last_n(df: DataFrame, n: int, order: str = "review_id") -> DataFrame:
    """L2: last ``n`` rows in a stated order."""
    return df.orderBy(F.col(order).desc()).limit(n)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """A10: counts per (label, prediction)."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           positive="Y") -> DataFrame:
    """Accuracy, precision, recall, F1 for ``positive``; 0 when a denominator is 0."""
    y, p = F.col(label) == F.lit(positive), F.col(prediction) == F.lit(positive)
    s = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == F.col(prediction)).alias("correct"),
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
    )

    def ratio(a, b):
        return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))

    prec = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return s.select(
        ratio(F.col("correct"), F.col("n")).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        "tp", "fp", "fn", "n")
