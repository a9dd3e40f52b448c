"""File sources: CSV (S3), text lines with positions (S4), dated bulk load (S6),
and the positional join of two line files (J4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.sources.quoted_csv import read_quoted_csv


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             multiline: bool = False, split_bytes: int | None = None) -> DataFrame:
    """S3: CSV with a header row and an explicit schema.

    ``multiline`` must be set by the caller where quoted fields span lines
    (review texts do): each file is then one task, unless ``split_bytes`` has
    it read in ranges of that size (which needs a schema, and a store that
    ``pyarrow.fs`` opens). Without ``multiline`` large files split as they are.
    """
    if multiline and split_bytes is not None:
        if schema is None:
            raise ValueError("split_bytes needs a schema")
        return read_quoted_csv(spark, path, schema, split_bytes)
    r = (spark.read.option("header", True).option("multiLine", multiline)
         .option("escape", '"').option("mode", "PERMISSIVE"))
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_lines(spark: SparkSession, path: str, position: str = "line_no") -> DataFrame:
    """One row per line, newline stripped, with the line's 0-based position.

    Positions follow file-name order, then byte offset inside each file. They
    come from the scan itself: each split's lines are counted by a group-by,
    the running total over splits gives each split's first position (one row
    per split, not per line), and the position inside a split comes from the
    row's id within the task. No partition order is assumed and no line is
    moved through one task.
    """
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    splits = (raw.groupBy("_file", "_block")
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")))
    order = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_base", F.coalesce(F.sum("_n").over(order), F.lit(0)))
    return (raw.join(splits.select("_file", "_block", "_base", "_first"), ["_file", "_block"])
            .select((F.col("_base") + F.col("_mid") - F.col("_first")).alias(position),
                    F.col("value")))


def positional_join(left: DataFrame, right: DataFrame, position: str = "line_no") -> DataFrame:
    """Row *i* of one line file beside row *i* of the other; missing side null."""
    return (left.join(right, position, "full_outer"))


def bulk_load_day(spark: SparkSession, root: str, day, schema: T.StructType | None = None,
                  template: str = "{root}/{day}/*.csv", multiline: bool = False,
                  split_bytes: int | None = None) -> DataFrame:
    """Read the CSV files of one dated folder (``root/yyyymmdd/*.csv``; header skipped)."""
    import datetime as _dt
    if isinstance(day, (_dt.date, _dt.datetime)):
        day = day.strftime("%Y%m%d")
    day = str(day).replace("-", "")
    return read_csv(spark, template.format(root=root.rstrip("/"), day=day), schema, multiline, split_bytes)


def load_table_from_day(spark: SparkSession, root: str, day, table_path: str, schema: T.StructType, mode: str = "append",
                        ts_col: str = "timestamp", **options) -> None:
    """Load one dated folder into a day-partitioned table.

    ``append`` adds the rows; ``replace`` makes them the whole table.
    """
    if mode not in ("append", "replace"):
        raise ValueError("mode must be 'append' or 'replace'")
    rows = bulk_load_day(spark, root, day, schema, **options)
    (rows.withColumn("dt", F.to_date(ts_col)).hint("rebalance", "dt").write
     .mode("append" if mode == "append" else "overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("dt").parquet(table_path))
