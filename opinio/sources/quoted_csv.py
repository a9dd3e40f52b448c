"""S3: CSV with line breaks in quoted fields, read in byte ranges by many tasks.

Spark's ``multiLine`` reads a file in one task, as only a reading from its
beginning tells whether a line break is inside quotes. Here the files are cut
into byte ranges; each task counts the quotes of its range; a running sum over
a file's ranges (one row per range) says whether a range begins inside
quotes, as a quote inside a field is written twice and so changes no parity.
Then each task finds the first record that begins in its range, and reads
whole records to the end of the last one that begins there. The records are
parsed by Spark (``from_csv``) with the options of the plain reader.

No text is shuffled; the file is read twice, once for its quotes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.sources.folder_log import file_system

SPLIT_BYTES = 64 << 20
BLOCK = 1 << 20
#: Records and bytes that a task hands to Spark at a time.
BATCH_RECORDS, BATCH_BYTES = 2048, 4 << 20
QUOTE, LINE = ord('"'), ord("\n")
OPTIONS = {"escape": '"', "mode": "PERMISSIVE"}


def _files(path: str) -> list[tuple[str, int]]:
    """(name, size) of the files of a folder or of a pattern of its last parts
    (``*`` within a part), without hidden ones and empty ones."""
    system, root = file_system(path)
    if "*" in root:
        parts = root.split("/")
        cut = next(i for i, p in enumerate(parts) if "*" in p)
        wanted = re.compile("/".join(re.escape(p).replace(r"\*", "[^/]*") for p in parts))
        found = [f for f in system.get_file_info(pafs.FileSelector("/".join(parts[:cut]), recursive=True))
                 if wanted.fullmatch(f.path)]
    else:
        info = system.get_file_info(root)
        found = [info] if info.type == pafs.FileType.File else system.get_file_info(pafs.FileSelector(root))
    return sorted((f.path, f.size) for f in found
                  if f.type == pafs.FileType.File and f.size and f.base_name[0] not in "_.")


def byte_ranges(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``file``, ``start``, ``stop``, a row per byte range and task."""
    ranges = [(f, at, min(size, at + split_bytes)) for f, size in _files(path) for at in range(0, size, split_bytes)]
    return _spread(spark.createDataFrame(ranges, "file string, start bigint, stop bigint"), len(ranges))


def _spread(ranges: DataFrame, n: int) -> DataFrame:
    """As many tasks as there are ranges."""
    return ranges.repartition(max(1, n), "file", "start")


def count_quotes(ranges: DataFrame, path: str) -> DataFrame:
    """``ranges`` with ``odd``: whether each begins inside quotes. The window
    brings the rows (not the bytes) of a file's ranges together; they are to be spread again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(path)
        for batch in batches:
            counts = []
            for file, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                with system.open_input_file(file) as f:
                    f.seek(start)
                    n = 0
                    for at in range(start, stop, BLOCK):
                        n += f.read(min(BLOCK, stop - at)).count(b'"')
                counts.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())],
                                             ["file", "start", "stop", "quotes"])

    counted = ranges.mapInArrow(run, "file string, start bigint, stop bigint, quotes bigint")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return counted.select("file", "start", "stop", odd.alias("odd"))


def records(source, start: int, stop: int, odd: bool) -> Iterator[tuple[int, bytes]]:
    """Place and bytes (without the line end) of the records that begin in [start, stop)."""
    at = max(start - 1, 0)          # the byte before tells whether a record begins at ``start``
    source.seek(at)
    begin = start if start == 0 else -1
    held: list[bytes] = []          # of the record so far
    while True:
        block = source.read(BLOCK)
        if not block:
            break
        raw = np.frombuffer(block, np.uint8)
        quotes = np.cumsum(raw == QUOTE)
        if at < start:              # the first byte is not of the range
            quotes = quotes - int(raw[0] == QUOTE)
        ends = np.flatnonzero((raw == LINE) & ((quotes + odd) % 2 == 0)).tolist()
        low = 0
        for e in ends:
            if begin >= 0:
                held.append(block[low:e])
                yield begin, b"".join(held).removesuffix(b"\r")
                held.clear()
            low, begin = e + 1, at + e + 1
            if begin >= stop:
                return
        if begin >= 0:
            held.append(block[low:])
        odd = bool((int(quotes[-1]) + odd) % 2)
        at += len(block)
    if begin >= 0 and begin < stop and (rest := b"".join(held)):
        yield begin, rest.removesuffix(b"\r")


def read_records(ranges: DataFrame, path: str, header: bool = True) -> DataFrame:
    """``file``, ``position`` and ``record`` (text) of every record but the
    headers and empty lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(path)
        for batch in batches:
            for file, start, stop, odd in zip(*(c.to_pylist() for c in batch.columns)):
                places: list[int] = []
                texts: list[str] = []
                held = 0
                with system.open_input_file(file) as f:
                    for place, raw in records(f, start, stop, odd):
                        if (header and place == 0) or not raw:
                            continue
                        places.append(place)
                        texts.append(raw.decode("utf-8", "replace"))
                        held += len(raw)
                        if len(texts) >= BATCH_RECORDS or held >= BATCH_BYTES:
                            yield _batch(file, places, texts)
                            places, texts, held = [], [], 0
                if texts:
                    yield _batch(file, places, texts)

    def _batch(file: str, places: list[int], texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([file] * len(texts)), pa.array(places, pa.int64()),
                                           pa.array(texts, pa.string())], ["file", "position", "record"])

    return ranges.mapInArrow(run, "file string, position bigint, record string")


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, split_bytes: int = SPLIT_BYTES,
                    header: bool = True) -> DataFrame:
    """S3: the rows of CSV files whose quoted fields may hold line breaks.

    The same rows as the plain reader with ``multiLine``, in as many tasks as
    the files have ranges. ``path`` is a file, a folder or a pattern, on a store
    that ``pyarrow.fs`` opens. Quotes are escaped by doubling, as this
    package's writer does.
    """
    ranges = byte_ranges(spark, path, split_bytes)
    ranges = _spread(count_quotes(ranges, path), ranges.rdd.getNumPartitions())
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = read_records(ranges, path, header).select(F.from_csv("record", kind, OPTIONS).alias("r"))
    return parsed.select("r.*")
