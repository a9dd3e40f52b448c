"""Shared helpers: table reads, shared-folder materialisation, Arrow maps."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opinio.session import scratch_path

#: Rows per Arrow batch. A row may be a very long document, so batches are
#: small; Spark's own byte bound per batch applies as well.
BATCH_ROWS = "512"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, by Spark's reader (any store Spark can open)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(name: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage so that a lost executor costs one stage, and makes
    values such as row numbers final.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_MEMOS: dict[str, list[dict]] = {}  # per Python worker: what each module has it remember
_LAST: list[str] = []  # per Python worker: the module of its last task


def worker_memo(module: str, memo: dict) -> dict:
    """``memo``, emptied when the worker goes on with tasks of another module."""
    _MEMOS.setdefault(module, []).append(memo)
    return memo


def free_memory() -> None:
    """Give memory that is no longer used back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def begin_task(module: str) -> None:
    """Drop what tasks of other modules left in this worker, which is used again
    for task after task, of all steps of a job."""
    if _LAST != [module]:
        for other, memos in _MEMOS.items():
            if other != module:
                for memo in memos:
                    memo.clear()
        _LAST[:] = [module]
    free_memory()


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with small batches, in workers that hold no other step's memos."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    module = fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(module)
        yield from fn(batches)

    return df.mapInArrow(run, schema)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def distinct_names(*names: str) -> list[str]:
    """The names, each with as many ``_`` as it takes to differ from those before it."""
    out: list[str] = []
    for name in names:
        while name.lower() in {n.lower() for n in out}:
            name += "_"
        out.append(name)
    return out


def row_key(id_col: str, text_col: str) -> Column:
    """A hash that names a row by its id and text (equal rows share it)."""
    return F.xxhash64(F.col(id_col), text_of(text_col))


def keep_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose key is in ``keys``
    (``key``); of rows that are equal, one. Each task leaves one row of a key
    before the shuffle, so a much repeated row is no large group after it."""
    key = unused(docs, "__key")
    keyed = docs.withColumn(key, row_key(id_col, text_col)).dropDuplicates([key])
    return keyed.join(keys.select(F.col("key").alias(key)), key, "left_semi").select(*docs.columns)
