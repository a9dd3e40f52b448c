"""Stream ingest: JSON review messages -> day-partitioned table + dead-letter table.

One projection parses and routes every message (S5, JS1, JS3, JS4, ST1-ST5):

* ``invalid``  — not JSON, a value that does not fit the schema, a key that
  the schema does not have, or a timestamp outside the years 1 to 9999: what
  the sink could not take is dead-lettered before the write;
* ``oversize`` — message as received larger than ``max_bytes`` (1 MiB),
  message "row size exceeded 1MB", ``payload`` removed from the snippet;
* ``flagged``  — the record carries ``error_message``; it becomes the
  dead letter's message and is removed from the snippet;
* ``ok``       — written to the review table.

``foreachBatch`` writes both tables (K6, K7), which must exist. Every write
goes to partitions that follow from the batch alone (its id; for reviews also
the day of their own timestamp), never from the clock, with dynamic partition
overwrite. A replayed batch (after a crash between or during the writes, also
on another day) replaces exactly its own files, so each message ends up in one
of the tables once (ST6); only a dead letter's wall-clock time may change.
Small batches make small files: :func:`compact_table` rewrites a sink by day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.schemas import ERROR, MESSAGE, RAW, RAW_COLUMNS
from opinio.sinks.committed import LETTERS, PAUSE, RETRIES, TABLE, FileInserter, Inserter, committed_sink

MAX_ROW_BYTES = 1024 * 1024  # fixed value: the sink's 1 MiB row limit
OVERSIZE_MESSAGE = "row size exceeded 1MB"
INVALID_MESSAGE = "[invalid] malformed or mistyped record"
UNKNOWN_MESSAGE = "[invalid] field not in the table"
RANGE_MESSAGE = "[invalid] timestamp out of range"
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799  # years 1 to 9999

_CORRUPT = "_corrupt_record"
_PARSE_SCHEMA = T.StructType(MESSAGE.fields + [T.StructField(_CORRUPT, T.StringType())])


def parse_messages(raw: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JS1: ``value`` (JSON text) -> ``msg`` struct; bad records keep their text.
    ``keep`` names columns that stay beside them."""
    parsed = F.from_json(F.col(value), _PARSE_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return raw.select(F.col(value).alias("raw"), parsed.alias("msg"), *keep)


def _record(fields=None) -> Column:
    names = [f.name for f in MESSAGE.fields] if fields is None else fields
    return F.struct(*[F.col("msg").getField(n).alias(n) for n in names])


def route_messages(parsed: DataFrame, max_bytes: int = MAX_ROW_BYTES) -> DataFrame:
    """ST1/ST2/JS3/JS4: add ``route``, ``size_bytes`` and, where invalid, ``fault``."""
    m = F.col("msg")
    known = F.array(*[F.lit(f.name) for f in MESSAGE.fields])
    fault = (F.when(m.isNull() | m.getField(_CORRUPT).isNotNull(), F.lit(INVALID_MESSAGE))
             .when(F.size(F.array_except(F.json_object_keys("raw"), known)) > 0, F.lit(UNKNOWN_MESSAGE))
             .when(~F.coalesce(m.getField("timestamp").between(FIRST_SECOND, LAST_SECOND), F.lit(True)),
                   F.lit(RANGE_MESSAGE)))
    broken = F.col("fault") == F.lit(INVALID_MESSAGE)
    route = (F.when(broken, F.lit("invalid"))
             .when(F.col("size_bytes") > F.lit(max_bytes), F.lit("oversize"))
             .when(F.col("fault").isNotNull(), F.lit("invalid"))
             .when(m.getField("error_message").isNotNull(), F.lit("flagged"))
             .otherwise(F.lit("ok")))
    return (parsed.withColumn("size_bytes", F.octet_length("raw").cast("long")).withColumn("fault", fault)
            .withColumn("route", route))


def raw_review_id(raw: str = "raw") -> Column:
    """Best-effort id of a record that did not parse: the ``review_id`` string
    value found in the text, else null."""
    return F.nullif(F.regexp_extract(F.col(raw), r'"review_id"\s*:\s*"([^"]*)"', 1), F.lit(""))


def table_columns() -> list[Column]:
    """A message in the raw table layout (timestamp from epoch seconds)."""
    m = F.col("msg")
    return [F.timestamp_seconds(m.getField("timestamp")).alias("timestamp") if c == "timestamp"
            else m.getField(c).alias(c) for c in RAW_COLUMNS]


def table_rows(routed: DataFrame) -> DataFrame:
    """Rows of the ``ok`` route in the raw table layout."""
    return routed.where(F.col("route") == "ok").select(*table_columns())


def letter_columns(now: Column | None = None) -> list[Column]:
    """A message that is not ``ok`` as a dead letter."""
    names = [f.name for f in MESSAGE.fields]
    no_payload = [n for n in names if n != "payload"]
    no_error = [n for n in names if n != "error_message"]
    m = F.col("msg")
    snippet = (F.when(F.col("route") == "invalid", F.col("raw"))
               .when(F.col("route") == "oversize", F.to_json(_record(no_payload)))
               .otherwise(F.to_json(_record(no_error))))
    message = (F.when(F.col("route") == "invalid", F.col("fault"))
               .when(F.col("route") == "oversize", F.lit(OVERSIZE_MESSAGE))
               .otherwise(m.getField("error_message")))
    rid = F.when(F.col("route") == "invalid", raw_review_id()).otherwise(m.getField("review_id"))
    return [(now if now is not None else F.current_timestamp()).alias("timestamp"),
            rid.alias("review_id"), snippet.alias("review_snippet"), message.alias("error_message")]


def dead_letters(routed: DataFrame, now: Column | None = None) -> DataFrame:
    """ST3/ST4: dead-letter rows ``(timestamp, review_id, review_snippet, error_message)``."""
    return routed.where(F.col("route") != "ok").select(*letter_columns(now))


def write_batch(batch: DataFrame, batch_id: int, table_path: str, error_path: str,
                max_bytes: int = MAX_ROW_BYTES, now: Column | None = None) -> None:
    """K6/K7: write one micro-batch to both sinks, idempotent per ``batch_id``."""
    routed = route_messages(parse_messages(batch), max_bytes).persist()
    try:
        bid = F.lit(int(batch_id)).cast("long").alias("batch_id")
        ok = table_rows(routed)
        (ok.select("*", F.to_date("timestamp").alias("dt"), bid).hint("rebalance", "dt")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("dt", "batch_id").parquet(table_path))
        (dead_letters(routed, now).select("*", bid).hint("rebalance")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(error_path))
    finally:
        routed.unpersist()


def create_sinks(spark: SparkSession, *paths: str) -> None:
    """Make empty sink folders for :func:`start_ingest`."""
    for path in paths:
        spark.createDataFrame([], "batch_id long, dt date").write.mode("ignore").partitionBy("batch_id").parquet(path)


def _must_exist(spark: SparkSession, path: str) -> None:
    try:
        spark.read.schema("value string").text(path)
    except AnalysisException as e:
        raise ValueError(f"sink {path} does not exist (create it first)") from e


def start_ingest(spark: SparkSession, source: str | DataFrame, table_path: str, error_path: str,
                 checkpoint: str, max_bytes: int = MAX_ROW_BYTES, available_now: bool = True,
                 max_files_per_trigger: int | None = None, now: Column | None = None):
    """Ingest a folder of JSON lines, or any streaming DataFrame with a text
    column ``value`` (a message bus). Both sinks must exist. Returns the StreamingQuery."""
    for path in (table_path, error_path):
        _must_exist(spark, path)
    if isinstance(source, DataFrame):
        stream = source.select(F.col("value").cast("string").alias("value"))
    else:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        stream = reader.load(source)
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: write_batch(df, bid, table_path, error_path, max_bytes, now))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def sink_rows(routed: DataFrame, insert_id: Column, now: Column | None = None) -> DataFrame:
    """Routed messages as the rows of a committed sink (``kind``, ``insert_id``
    and a struct for the table or for the dead letters). No shuffle.

    ``insert_id`` is an expression over the columns beside ``raw`` and ``msg``."""
    ok = F.col("route") == "ok"
    return routed.select(F.when(ok, TABLE).otherwise(LETTERS).alias("kind"), insert_id.alias("insert_id"),
                         F.when(ok, F.struct(*table_columns())).alias(TABLE),
                         F.when(~ok, F.struct(*letter_columns(now))).alias(LETTERS))


def start_committed(stream: DataFrame, path: str, checkpoint: str, insert_id: Column | None = None,
                    inserter: Inserter | None = None, max_bytes: int = MAX_ROW_BYTES, now: Column | None = None,
                    available_now: bool = True, retries: int = RETRIES, pause: float = PAUSE):
    """S5, K6, K7, ST5, ST6: ingest a stream with a text column ``value`` into a
    committed sink (see ``opinio.sinks.committed``), which must exist.

    ``insert_id`` names a message in every replay alike (its place in the log,
    where the stream has it). Returns the StreamingQuery.
    """
    spark = stream.sparkSession
    place = F.concat_ws(":", "partition", "segment", "position") if "position" in stream.columns else F.lit(None)
    insert_id = place.cast("string") if insert_id is None else insert_id
    named = stream.select(F.col("value").cast("string").alias("value"), insert_id.alias("_id"))
    routed = route_messages(parse_messages(named, keep=("_id",)), max_bytes)
    source = committed_sink(path, inserter or FileInserter(path, {TABLE: RAW, LETTERS: ERROR}), checkpoint, retries, pause)
    spark.dataSource.register(source)
    writer = (sink_rows(routed, F.col("_id"), now).writeStream.format(source.name())
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="0 seconds")
    return writer.start()


def drain(query) -> None:
    """Wait until a started query has taken all that its source has, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def read_sink(spark: SparkSession, path: str, schema: T.StructType, day: bool = True) -> DataFrame:
    """Read a sink folder back without the bookkeeping ``batch_id`` column.

    ``day``: whether the sink is partitioned by day (reviews are, dead letters not).
    """
    more = [T.StructField("dt", T.DateType())] if day else []
    full = T.StructType([*schema.fields, *more, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(path).drop("batch_id")


def compact_table(spark: SparkSession, path: str, target: str, schema: T.StructType) -> None:
    """Rewrite a review sink as a table partitioned by day alone, with files of
    balanced size, in a folder of its own."""
    (read_sink(spark, path, schema).hint("rebalance", "dt").write.mode("overwrite")
     .partitionBy("dt").parquet(target))
