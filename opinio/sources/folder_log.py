"""A message log in a folder as a streaming source with offsets.

The log is ``path/<partition>/<segment>``: each partition (a folder) is a
sequence of segments in the order of their names, of which only the last is
still appended to. A message is a line. An offset is, per partition, the
segment and the byte position up to which it was read, so it has the size of
the partitions, not of the log, and a query restarts in the middle of a
segment.

* A batch ends at line ends; a line that is still being written waits. The
  last line of a segment that is followed by another one needs no line end.
* ``maxBytesPerTrigger`` admits about that much per batch, shared by the
  partitions that have more (a longer line is admitted whole).
* A batch's byte ranges are cut into splits of ``splitBytes``; a split holds
  the lines that begin in it, so one partition's backlog is read by many tasks.

Spark tells a Python source its position only when it plans a batch. The
planned end is kept in ``progress`` (a small file; the batch is in Spark's own
offset log by then), and a restarted query goes on from there, so the limit
also holds after a restart. A query with a new checkpoint begins anew.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "value string, partition string, segment string, position bigint"
BLOCK = 1 << 16
SPLIT_BYTES = 32 << 20
#: Lines and bytes of a batch that a task hands to Spark.
BATCH_LINES, BATCH_BYTES = 4096, 1 << 20


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


@dataclass
class Split(InputPartition):
    """Lines that begin in bytes [start, stop) of a segment; ``first``: at a line's beginning."""

    partition: str
    segment: str
    start: int
    stop: int
    first: bool


class FolderLog:
    """The segments of a log and the line ends in them."""

    def __init__(self, path: str):
        self.system, self.root = file_system(path)

    def segments(self) -> dict[str, list[tuple[str, int]]]:
        """(segment, size) in order, per partition. Names that begin with "_" or "." are not read."""
        out: dict[str, list[tuple[str, int]]] = {}
        for f in self.system.get_file_info(pafs.FileSelector(self.root, recursive=True)):
            inner = posixpath.relpath(f.path, self.root).split("/")
            if f.type == pafs.FileType.File and len(inner) == 2 and not any(n[0] in "_." for n in inner):
                out.setdefault(inner[0], []).append((inner[1], f.size))
        return {p: sorted(s) for p, s in sorted(out.items())}

    def open(self, partition: str, segment: str):
        return self.system.open_input_file(f"{self.root}/{partition}/{segment}")

    def last_line_end(self, partition: str, segment: str, start: int, stop: int) -> int:
        """The last position in (start, stop] after a line end; ``start`` if there is none."""
        with self.open(partition, segment) as f:
            while stop > start:
                low = max(start, stop - BLOCK)
                f.seek(low)
                at = f.read(stop - low).rfind(b"\n")
                if at >= 0:
                    return low + at + 1
                stop = low
        return start

    def next_line_end(self, partition: str, segment: str, start: int, size: int) -> int:
        """The first position after a line end at or after ``start``; -1 if there is none before ``size``."""
        with self.open(partition, segment) as f:
            f.seek(start)
            while start < size:
                block = f.read(min(BLOCK, size - start))
                at = block.find(b"\n")
                if at >= 0:
                    return start + at + 1
                start += len(block)
        return -1

    def advance(self, partition: str, segments: list[tuple[str, int]], at: dict | None, budget: int | None) -> dict | None:
        """The position that a batch of about ``budget`` bytes from ``at`` on reaches."""
        for k, (segment, size) in enumerate(segments):
            sealed = k + 1 < len(segments)
            if at is not None and segment < at["segment"]:
                continue
            start = at["position"] if at is not None and segment == at["segment"] else 0
            stop = size if budget is None else min(size, start + budget)
            if not (sealed and stop == size):
                end = self.last_line_end(partition, segment, start, stop)
                if end == start and stop < size:  # one line longer than the budget
                    end = self.next_line_end(partition, segment, stop, size)
                    end = end if end >= 0 else size if sealed else start
                stop = end
            if stop > start or (at is not None and segment == at["segment"]):
                at = {"segment": segment, "position": stop}
            if budget is not None:
                budget -= stop - start
            if not sealed or stop < size or (budget is not None and budget <= 0):
                break
        return at

    def splits(self, start: dict, end: dict, split_bytes: int) -> list[Split]:
        """The splits between two offsets."""
        out = []
        for partition, segments in self.segments().items():
            to = end.get(partition)
            if to is None:
                continue
            since = start.get(partition) or {"segment": "", "position": 0}
            for segment, size in segments:
                if not since["segment"] <= segment <= to["segment"]:
                    continue
                low = since["position"] if segment == since["segment"] else 0
                high = to["position"] if segment == to["segment"] else size
                for at in range(low, high, split_bytes):
                    out.append(Split(partition, segment, at, min(high, at + split_bytes), at == low))
        return out

    def read(self, split: Split | None) -> Iterator[pa.RecordBatch]:
        if split is None:  # Spark's stand-in where a plan has no splits
            return
        values: list[str] = []
        places: list[int] = []
        held = 0

        def batch() -> pa.RecordBatch:
            n = len(values)
            return pa.RecordBatch.from_arrays(
                [pa.array(values, pa.string()), pa.array([split.partition] * n, pa.string()),
                 pa.array([split.segment] * n, pa.string()), pa.array(places, pa.int64())],
                ["value", "partition", "segment", "position"])

        for at, line in self._lines(split):
            places.append(at)
            values.append(line.removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", "replace"))
            held += len(line)
            if len(values) >= BATCH_LINES or held >= BATCH_BYTES:
                yield batch()
                values, places, held = [], [], 0
        if values:
            yield batch()

    def _lines(self, split: Split) -> Iterator[tuple[int, bytes]]:
        """Position and bytes of the lines that begin in a split."""
        with self.open(split.partition, split.segment) as f:
            at = split.start if split.first else split.start - 1
            f.seek(at)
            skip, rest = not split.first, b""
            while True:
                block = f.read(max(BLOCK, len(rest)))  # a long line is not copied block by block
                lines = (rest + block).split(b"\n")
                rest = lines.pop()
                for line in lines:
                    if skip:
                        skip = False  # the line that the split before this one has
                    elif at < split.stop:
                        yield at, line + b"\n"
                    at += len(line) + 1
                    if at >= split.stop:
                        return
                if not block:
                    break
            if rest and not skip and at < split.stop:
                yield at, rest


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.log = FolderLog(options["path"])
        self.limit = int(options["maxbytespertrigger"]) if "maxbytespertrigger" in options else None
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.progress = options.get("progress")
        if self.limit is not None and not self.progress:
            raise ValueError("maxBytesPerTrigger needs progress, a file for the position of this query")
        self.known: dict | None = None

    def _load(self) -> dict:
        if not self.progress:
            return {}
        system, path = file_system(self.progress)
        if system.get_file_info(path).type != pafs.FileType.File:
            return {}
        with system.open_input_stream(path) as f:
            return json.loads(f.read())

    def _save(self, offset: dict) -> None:
        self.known = offset
        if self.progress:
            system, path = file_system(self.progress)
            system.create_dir(posixpath.dirname(path), recursive=True)
            part = f"{path}.{uuid.uuid4().hex}"
            with system.open_output_stream(part) as f:
                f.write(json.dumps(offset, sort_keys=True).encode())
            system.move(part, path)

    def initialOffset(self) -> dict:
        self._save({})  # a new query
        return {}

    def latestOffset(self) -> dict:
        if self.known is None:
            self.known = self._load()
        segments = self.log.segments()
        end = {p: at for p, at in self.known.items()}
        behind = [p for p, s in segments.items() if end.get(p) != {"segment": s[-1][0], "position": s[-1][1]}]
        for k, p in enumerate(behind):
            left = None if self.limit is None else max(1, self.limit // len(behind))
            at = self.log.advance(p, segments[p], end.get(p), left)
            if at is not None:
                end[p] = at
        return {p: end[p] for p in sorted(end)}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        self._save(end)
        return self.log.splits(start, end, self.split)

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        return self.log.read(split)


class _BatchReader(DataSourceReader):
    """All whole lines that the log has when the query is planned."""

    def __init__(self, options: dict):
        self.log, self.split = FolderLog(options["path"]), int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[Split]:
        ends = {p: self.log.advance(p, s, None, None) for p, s in self.log.segments().items()}
        return self.log.splits({}, {p: e for p, e in ends.items() if e is not None}, self.split)

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        return self.log.read(split)


class FolderLogSource(DataSource):
    """Format ``folder_log``: options ``path``, ``maxBytesPerTrigger``, ``progress``, ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "folder_log"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> dict:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self._options())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self._options())


def read_log(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every whole message of a log, with its place: ``value``, ``partition``, ``segment``, ``position``."""
    spark.dataSource.register(FolderLogSource)
    return spark.read.format("folder_log").option("path", path).option("splitBytes", split_bytes).load()


def stream_log(spark: SparkSession, path: str, progress: str | None = None, max_bytes: int | None = None,
               split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The log as a stream, from its beginning or from where the query's checkpoint is.

    ``max_bytes`` a batch needs ``progress``, a file of the query's own.
    """
    spark.dataSource.register(FolderLogSource)
    reader = spark.readStream.format("folder_log").option("path", path).option("splitBytes", split_bytes)
    if progress:
        reader = reader.option("progress", progress)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load()
