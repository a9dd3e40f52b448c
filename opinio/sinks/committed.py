"""Sinks that publish a batch as a whole: table rows and dead letters together (K6, K7, ST5, ST6, K4).

Layout of a sink folder: ``data/`` holds Parquet files under names of their
own, ``manifests/`` one small JSON file per batch that names the files of both
tables. Tasks write files and report them; only the manifest, which is put in
place in one step after all tasks have ended, makes them visible. A reader
takes the files that manifests name, so it sees all of a batch or nothing of
it; what a failed attempt leaves behind is named nowhere. A batch that is
replayed after its manifest was published changes nothing.

Rows are inserted by an :class:`Inserter` (files by default, or a caller's
client of another store). A part of the rows that it rejects is halved and
each half inserted, until the rows that cannot be written are alone; those
become dead letters with the error as their message. A dead letter that cannot be written is replaced by one
with that message. Errors that are :class:`TransientError` are retried a
bounded number of times with growing pauses, then fail the task (and so the
batch, which is replayed), as good rows are not to be dead-lettered.

An inserter that is not the file one gets an ``insert id`` for each row (the
place of its message in the log, say), the same in every replay, by which the
store can drop what it already has.

:func:`compact` packs the small files of a day into larger ones by measured
bytes, in Spark tasks, and swaps them by one more manifest.
"""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from opinio.sources.folder_log import file_system

TABLE, LETTERS = "table", "letters"
#: Rows that a task inserts at a time.
CHUNK = 10_000
#: Retries of a transient error, and the first pause in seconds (each one doubles it).
RETRIES, PAUSE = 5, 0.2
#: A message that is not kept whole in a dead letter.
MESSAGE_CHARS = 500


class TransientError(Exception):
    """An error that has nothing to do with the rows: worth another try."""


@dataclass(frozen=True)
class Written:
    """A file of one table with the day of its rows."""

    kind: str
    file: str
    day: str | None
    rows: int
    bytes: int


class Inserter:
    """Inserts rows into one of the two tables. Subclasses raise
    :class:`TransientError`, or anything else for rows that cannot be written."""

    def insert(self, kind: str, rows: Sequence[Row], ids: Sequence[str]) -> list[Written]:
        raise NotImplementedError


class FileInserter(Inserter):
    """Parquet files, one per day of the rows' ``timestamp`` for the table."""

    def __init__(self, path: str, schemas: dict[str, T.StructType]):
        self.path = path
        self.schemas = {k: to_arrow_schema(s) for k, s in schemas.items()}

    def insert(self, kind: str, rows: Sequence[Row], ids: Sequence[str]) -> list[Written]:
        system, root = file_system(self.path)
        days: dict[str | None, list[Row]] = {}
        for r in rows:
            days.setdefault(_day(r["timestamp"]) if kind == TABLE else None, []).append(r)
        made = {day: pa.Table.from_pylist([_plain(r) for r in own], self.schemas[kind]) for day, own in days.items()}
        return [put_file(system, root, kind, day, table) for day, table in made.items()]


def _plain(row: Row) -> dict:
    """A row's values; timestamps are instants."""
    return {k: v.astimezone(dt.timezone.utc) if isinstance(v, dt.datetime) else v for k, v in row.asDict().items()}


def _day(ts: dt.datetime | None) -> str | None:
    return None if ts is None else ts.astimezone(dt.timezone.utc).date().isoformat()


def put_file(system: pafs.FileSystem, root: str, kind: str, day: str | None, table: pa.Table) -> Written:
    name = f"data/{kind}-{uuid.uuid4().hex}.parquet"
    with system.open_output_stream(f"{root}/{name}") as f:
        pq.write_table(table, f)
    return Written(kind, name, day, table.num_rows, system.get_file_info(f"{root}/{name}").size)


def insert_all(insert: Callable[[list], list[Written]], rows: list, retries: int = RETRIES,
               pause: float = PAUSE) -> tuple[list[Written], list[tuple]]:
    """What was written, and (row, message) of each row that cannot be.

    With k such rows in n, about k log n inserts.
    """
    written: list[Written] = []
    failed: list[tuple] = []
    parts = [rows] if rows else []
    while parts:
        part = parts.pop()
        try:
            written += _with_retries(lambda: insert(part), retries, pause)
        except TransientError:
            raise
        except Exception as e:  # noqa: BLE001 - whatever the store says about the rows
            if len(part) == 1:
                failed.append((part[0], f"{type(e).__name__}: {e}"[:MESSAGE_CHARS]))
            else:
                half = len(part) // 2
                parts += [part[half:], part[:half]]
    return written, failed


def _with_retries(step: Callable[[], list[Written]], retries: int, pause: float) -> list[Written]:
    for attempt in range(retries + 1):
        try:
            return step()
        except TransientError:
            if attempt == retries:
                raise
            time.sleep(pause * 2**attempt)
    return []


#: Columns of the rows that a sink takes: which table, its row, the row's insert id.
def sink_schema(table: T.StructType, letters: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("kind", T.StringType()), T.StructField("insert_id", T.StringType()),
                         T.StructField(TABLE, table), T.StructField(LETTERS, letters)])


@dataclass
class _Message(WriterCommitMessage):
    written: list[Written]


class _Writer:
    """The work of one task; also what the driver does in the end."""

    def __init__(self, path: str, inserter: Inserter, retries: int, pause: float):
        self.path, self.inserter, self.retries, self.pause = path, inserter, retries, pause

    def write(self, iterator: Iterator[Row]) -> _Message:
        written: list[Written] = []
        held: dict[str, list[tuple[str, Row]]] = {TABLE: [], LETTERS: []}
        for row in iterator:
            held[row.kind].append((row.insert_id, row[row.kind]))
            if len(held[row.kind]) >= CHUNK:
                written += self._flush(row.kind, held)
        return _Message(written + self._flush(TABLE, held) + self._flush(LETTERS, held))

    def _flush(self, kind: str, held: dict[str, list]) -> list[Written]:
        rows, held[kind] = held[kind], []
        written, failed = self._insert(kind, rows)
        if failed:  # what the table rejects is a dead letter, and what these reject a shorter one
            more, lost = self._insert(LETTERS, [_letter(r, kind, e) for r, e in failed])
            written += more
            if lost:
                last, none = self._insert(LETTERS, [_letter(r, LETTERS, e, snippet=False) for r, e in lost])
                written += last
                if none:
                    raise RuntimeError(f"the dead-letter table takes no rows: {none[0][1]}")
        return written

    def _insert(self, kind: str, rows: list) -> tuple[list[Written], list[tuple]]:
        return insert_all(lambda part: self.inserter.insert(kind, [r for _, r in part], [i for i, _ in part]), rows,
                          self.retries, self.pause)

    def finish(self, name: str, messages: list) -> None:
        publish(self.path, name, [w for m in messages if m is not None for w in m.written])

    def drop(self, messages: list) -> None:
        """Delete the files of a failed batch (no manifest names them)."""
        system, root = file_system(self.path)
        for w in (w for m in messages if m is not None for w in m.written):
            _delete(system, f"{root}/{w.file}")


def _letter(item: tuple[str, Row], kind: str, error: str, snippet: bool = True) -> tuple[str, Row]:
    """The dead letter of a row that could not be inserted."""
    insert_id, row = item
    was = row.asDict(recursive=True)
    text = json.dumps(was, default=str, sort_keys=False) if kind == TABLE else was.get("review_snippet")
    return f"{insert_id}#{kind}", Row(
        timestamp=dt.datetime.now(dt.timezone.utc), review_id=was.get("review_id"),
        review_snippet=text if snippet else None, error_message=f"[{kind}] error while writing: {error}")


def _delete(system: pafs.FileSystem, path: str) -> None:
    try:
        system.delete_file(path)
    except OSError:
        pass  # it is named nowhere


class _StreamWriter(_Writer, DataSourceStreamWriter):
    """A batch is named by the id in the query's checkpoint and its number there."""

    checkpoint: str

    def commit(self, messages, batchId):
        system, root = file_system(self.checkpoint)
        with system.open_input_stream(f"{root}/metadata") as f:
            query = json.loads(f.read())["id"]
        self.finish(f"batch-{query}-{batchId:015d}", messages)

    def abort(self, messages, batchId):
        self.drop(messages)


class _BatchWriter(_Writer, DataSourceWriter):
    def commit(self, messages):
        self.finish(f"load-{uuid.uuid4().hex}", messages)

    def abort(self, messages):
        self.drop(messages)


def committed_sink(path: str, inserter: Inserter, checkpoint: str | None = None, retries: int = RETRIES,
                   pause: float = PAUSE) -> type[DataSource]:
    """A data source (format ``committed_<hex>``) that writes to the sink folder;
    register it with Spark. A stream needs its ``checkpoint`` folder."""
    format_name = f"committed_{uuid.uuid4().hex}"

    class CommittedSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def schema(self):
            raise NotImplementedError("read the sink by read_committed")

        def writer(self, schema, overwrite):
            return _BatchWriter(path, inserter, retries, pause)

        def streamWriter(self, schema, overwrite):
            made = _StreamWriter(path, inserter, retries, pause)
            made.checkpoint = checkpoint
            return made

    return CommittedSink


# --- manifests ---------------------------------------------------------------

MANIFEST = ("adds array<struct<kind:string,file:string,day:string,rows:bigint,bytes:bigint>>, drops array<string>")


def create_sink(path: str) -> None:
    """Make an empty sink folder."""
    system, root = file_system(path)
    for d in ("data", "manifests"):
        system.create_dir(f"{root}/{d}", recursive=True)


def publish(path: str, name: str, adds: Sequence[Written], drops: Sequence[str] = ()) -> bool:
    """Put a manifest in place, in one step. If there is one of that name, it
    stays, and the new files are deleted (false)."""
    system, root = file_system(path)
    target = f"{root}/manifests/{name}.json"
    if system.get_file_info(target).type == pafs.FileType.File:
        for w in adds:
            _delete(system, f"{root}/{w.file}")
        return False
    part = f"{root}/manifests/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as f:
        f.write(json.dumps({"adds": [vars(w) for w in adds], "drops": list(drops)}).encode())
    system.move(part, target)
    return True


def live_files(spark: SparkSession, path: str) -> DataFrame:
    """``kind``, ``file``, ``day``, ``rows``, ``bytes`` of the files that are visible."""
    found = spark.read.schema(MANIFEST).json(f"{path}/manifests/*.json") if _published(path) else None
    if found is None:
        return spark.createDataFrame([], "kind string, file string, day string, rows bigint, bytes bigint")
    drops = found.select(F.explode("drops").alias("file"))
    return found.select(F.inline("adds")).join(drops, "file", "left_anti").select("kind", "file", "day", "rows", "bytes")


def _published(path: str) -> bool:
    system, root = file_system(path)
    return any(f.path.endswith(".json") for f in system.get_file_info(pafs.FileSelector(f"{root}/manifests")))


def read_committed(spark: SparkSession, path: str, kind: str, schema: T.StructType, day: dt.date | None = None) -> DataFrame:
    """The rows of one table of a sink as of now, of one day where it is given."""
    wanted = F.col("kind") == kind
    if day is not None:
        wanted &= F.col("day") == day.isoformat()
    files = [f"{path}/{r.file}" for r in live_files(spark, path).where(wanted).select("file").collect()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


# --- compaction ----------------------------------------------------------------

def packed(files: Sequence[tuple[str, int]], target: int) -> list[list[str]]:
    """Bins of at least two files and at most ``target`` bytes, first fit by falling size."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(files, key=lambda f: (-f[1], f[0])):
        for k, (held, names) in enumerate(bins):
            if held + size <= target:
                bins[k] = (held + size, [*names, name])
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins if len(names) > 1]


def compact(spark: SparkSession, path: str, kind: str = TABLE, small: int = 32 << 20, target: int = 128 << 20) -> int:
    """Rewrite the files under ``small`` bytes of each day as files of at most
    about ``target`` bytes; the number of files written (0: nothing to do).

    A bin is a task, which holds at most its ``target`` bytes. Readers see the old files
    until the manifest is in place, then the new ones; old ones are left for
    readers that have begun (:func:`remove_unnamed` deletes them).
    """
    rows = live_files(spark, path).where((F.col("kind") == kind) & (F.col("bytes") < small)).collect()  # one a file
    days: dict[str | None, list[tuple[str, int]]] = {}
    for r in rows:
        days.setdefault(r.day, []).append((r.file, r.bytes))
    bins = [(day, names) for day, files in sorted(days.items(), key=lambda d: d[0] or "") for names in packed(files, target)]
    if not bins:
        return 0

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(path)
        for batch in batches:
            for day, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                whole = pa.concat_tables([pq.read_table(f"{root}/{n}", filesystem=system) for n in names])
                w = put_file(system, root, kind, day, whole)
                yield pa.RecordBatch.from_pylist([vars(w)], pa.schema([
                    ("kind", pa.string()), ("file", pa.string()), ("day", pa.string()), ("rows", pa.int64()),
                    ("bytes", pa.int64())]))

    work = spark.createDataFrame(bins, "day string, names array<string>").repartition(len(bins))
    made = work.mapInArrow(rewrite, "kind string, file string, day string, rows bigint, bytes bigint").collect()
    publish(path, f"compact-{uuid.uuid4().hex}", [Written(**r.asDict()) for r in made],
            [n for _, names in bins for n in names])
    return len(made)


def remove_unnamed(spark: SparkSession, path: str, older_than: float = 7 * 86400.0) -> int:
    """Delete data files that are visible in no manifest and ``older_than``
    seconds old (of failed attempts and compactions); how many."""
    live = {r.file for r in live_files(spark, path).select("file").collect()}
    system, root = file_system(path)
    gone = 0
    for f in system.get_file_info(pafs.FileSelector(f"{root}/data")):
        name = f"data/{posixpath.basename(f.path)}"
        if name not in live and f.mtime is not None and time.time() - f.mtime.timestamp() >= older_than:
            _delete(system, f.path)
            gone += 1
    return gone
