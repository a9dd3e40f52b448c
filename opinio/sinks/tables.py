"""Sinks: partitioned tables, day overwrite, CSV, JSON messages (K1-K5, K8, JS2)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.schemas import RAW_COLUMNS, struct_from_json_schema
from opinio.sources.tables import _as_date


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table(spark: SparkSession, name: str, schema, location: str,
                 partition_col: str = "dt") -> None:
    """K1: day-partitioned parquet table from a ``StructType`` or JSON schema spec."""
    if not isinstance(schema, T.StructType):
        schema = struct_from_json_schema(schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}, `{partition_col}` date) "
        f"USING parquet PARTITIONED BY (`{partition_col}`) LOCATION '{location}'")


def with_day(df: DataFrame, ts_col: str = "timestamp", partition_col: str = "dt") -> DataFrame:
    """Derive the day-partition column from the row timestamp (UTC)."""
    return df.withColumn(partition_col, F.to_date(F.col(ts_col)))


def balanced(df: DataFrame, *cols: str, files: int | None = None) -> DataFrame:
    """K4: small-file control before a write.

    ``files`` given: exactly that many output tasks (a fixed, small layout).
    Otherwise an AQE rebalance on the partition columns: skewed days are split
    and small ones merged by measured size, so no day lands in one task.
    """
    if files:
        return df.repartition(files)
    return df.hint("rebalance", *cols) if cols else df.hint("rebalance")


def overwrite_day(df: DataFrame, table: str, ts_col: str = "timestamp",
                  partition_col: str = "dt", files: int | None = None, day=None) -> None:
    """K2: replace day partitions of a table, which must exist.

    With ``day``: that day is replaced, also by nothing where ``df`` is empty,
    and a row of another day fails the write. Without: the days that ``df``
    holds are replaced.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist (create it first)")
    cols = [f.name for f in spark.table(table).schema.fields]
    out = with_day(df, ts_col, partition_col).select(*cols)
    if day is not None:
        d = _as_date(day)
        own = F.col(partition_col) == F.lit(d)
        other = F.raise_error(F.lit(f"a row is not of {d}")).cast("boolean")
        out = out.where(F.when(own, F.lit(True)).otherwise(other)).drop(partition_col)
        view = f"day_{uuid.uuid4().hex}"
        balanced(out, files=files).createOrReplaceTempView(view)
        try:
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`{partition_col}` = DATE '{d}') SELECT * FROM {view}")
        finally:
            spark.catalog.dropTempView(view)
        return
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, "static")
    spark.conf.set(key, "dynamic")
    try:
        balanced(out, partition_col, files=files).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, before)


def overwrite_table(df: DataFrame, path: str, files: int | None = None) -> None:
    """K3: replace the whole table at ``path``."""
    balanced(df, files=files).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: CSV with header, no index column."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def message_struct(df: DataFrame, cols=RAW_COLUMNS, ts_col: str = "timestamp") -> Column:
    """Record struct with the timestamp as epoch seconds (stream message layout)."""
    fields = [F.unix_timestamp(F.col(c)).alias(c) if c == ts_col else F.col(c) for c in cols]
    return F.struct(*fields)


def to_messages(df: DataFrame, key: str = "review_id", cols=RAW_COLUMNS) -> DataFrame:
    """K8/JS2: one JSON message per row (``key``, ``value``), ready for a message sink."""
    return df.select(F.col(key).alias("key"), F.to_json(message_struct(df, cols)).alias("value"))
