"""WARC archives: a writer, and a Python data source that reads them.

Records are written one gzip member each, with the ``sl`` (skip lengths) extra
field, so that a reader that has parsed a record's headers can go to the next
record without inflating the payload. A task rolls its files at
``max_file_bytes`` and Spark commits a ``manifest`` of the files of the
attempts that succeeded; a lost attempt leaves at most files that the manifest
does not name.

The reader plans partitions from the manifest (or, for archives from
elsewhere, from the ``.warc`` and ``.warc.gz`` files of the folder): whole
files, small ones packed together. Predicates on ``record_type`` and on the
other header columns are pushed down; headers are parsed first and payloads of
unwanted records are skipped, not decoded. ``option("payload", "false")``
skips all payloads.

Archives are read and written through ``pyarrow.fs``, so their folder may be
any shared store that Arrow opens (a mounted folder, HDFS, S3, GCS).

Defined results: null html is the empty payload; records with a null url have
no target header; rows repeat as they come; null ids are greater than all
others when the record to refer to is chosen, and rows that share the smallest
id are all responses; an empty table gives an empty archive.
"""

from __future__ import annotations

import io
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull,
                                    StringStartsWith)

from opinio.llm.common import arrow_map, materialise, text_of

#: Column, header and Spark type of what the headers hold.
HEADER_COLUMNS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "content_type": "content-type",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
SCHEMA = ", ".join([*(f"{c} string" for c in HEADER_COLUMNS), "headers map<string,string>", "payload binary"])
_ARROW = pa.schema([*((c, pa.string()) for c in HEADER_COLUMNS), ("headers", pa.map_(pa.string(), pa.string())),
                    ("payload", pa.binary())])

#: Payloads under this many bytes are written as they are, never as revisits.
LEAST_REVISIT = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 8 << 20


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


# Writing

def record_bytes(headers: list[tuple[str, str | None]], payload: bytes) -> bytes:
    """One record; headers with a null value are left out."""
    lines = [f"{k}: {v}".translate({10: "%0A", 13: "%0D"}) for k, v in headers if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(payload)}", "", ""])
    return head.encode("utf-8", "replace") + payload + b"\r\n\r\n"


def gzip_member(raw: bytes, level: int = 3) -> bytes:
    """A gzip member whose extra field ``sl`` holds its own size and its content's."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(raw) + squeeze.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF)
    return b"".join([b"\x1f\x8b\x08\x04\0\0\0\0\0\xff", struct.pack("<H", len(extra)), extra, body,
                     struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)])


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> DataFrame:
    """The records of a table of pages: ``id``, ``target_uri``, ``payload``,
    ``payload_bytes``, ``digest``, ``refers_to`` (the id whose record holds an
    equal payload, or null).

    Digests are pre-aggregated per task; the groups with more than one record
    are written once, so the join back can split a digest with many pages.
    """
    rows = (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("target_uri"), text_of(payload_col).alias("p"))
            .select("id", "target_uri", F.encode("p", "utf-8").alias("payload"))
            .withColumn("payload_bytes", F.length("payload").cast("long"))
            .withColumn("digest", F.sha2("payload", 256)))
    groups = (rows.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy(F.col("digest").alias("_digest"))
              .agg(F.min("id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    groups = materialise(groups.select("_digest", "_first"), "payload_groups")
    later = ~F.col("id").eqNullSafe(F.col("_first")) & F.col("_first").isNotNull()
    return (rows.join(groups, F.col("digest") == F.col("_digest"), "left")
            .withColumn("refers_to", F.when(later, F.col("_first"))).drop("_digest", "_first"))


def write_warc(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", content_type: str = "text/html",
               max_file_bytes: int = 64 << 20) -> None:
    """Write ``records`` (columns as :func:`with_revisits` gives them) as archives."""
    system, folder = _file_system(path)
    system.create_dir(folder, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _file_system(path)
        part, sink, name, size, count, done = TaskContext.get().partitionId(), None, "", 0, 0, []
        for batch in batches:
            for id_, uri, payload, n, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                revisit = refers is not None
                raw = record_bytes([
                    ("WARC-Type", "revisit" if revisit else "response"),
                    ("WARC-Record-ID", f"<urn:page:{'' if id_ is None else id_}>"),
                    ("WARC-Date", date),
                    ("WARC-Target-URI", uri),
                    ("WARC-Payload-Digest", f"sha256:{digest}"),
                    ("WARC-Refers-To", f"<urn:page:{refers}>" if revisit else None),
                    ("WARC-Profile", REVISIT_PROFILE if revisit else None),
                    ("X-Payload-Length", str(n)),
                    ("Content-Type", content_type)], b"" if revisit else payload)
                if sink is None:
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    sink, size, count = system.open_output_stream(posixpath.join(folder, name), compression=None), 0, 0
                size += sink.write(gzip_member(raw))
                count += 1
                if size >= max_file_bytes:
                    sink.close()
                    done.append((name, size, count))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((name, size, count))
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in
                                          enumerate((pa.string(), pa.int64(), pa.int64()))], ["file", "bytes", "records"])

    rows = records.select("id", "target_uri", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
                          "payload_bytes", "digest", "refers_to")
    arrow_map(rows, run, "file string, bytes bigint, records bigint").write.parquet(f"{path}/manifest")


# Reading

class WarcFiles(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


def parse_headers(head: bytes) -> dict[str, str]:
    """Header names in lower case; folded lines are joined."""
    out: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _plain(f, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Records of an uncompressed archive."""
    while True:
        line = f.readline()
        if not line:
            return
        if not line.strip():
            continue
        head = [line]
        while (line := f.readline()) not in (b"\r\n", b"\n", b""):
            head.append(line)
        headers = parse_headers(b"".join(head))
        size = int(headers.get("content-length", 0))
        keep, want_payload = wanted(headers)
        if keep and want_payload:
            yield headers, f.read(size)
        else:
            f.seek(size, io.SEEK_CUR)
            if keep:
                yield headers, None


def _members(f, wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Records of an archive of gzip members."""
    at = 0
    while True:
        f.seek(at)
        fixed = f.read(12)
        if len(fixed) < 12:
            return
        length = None
        if fixed[3] & 4:
            extra = f.read(struct.unpack("<H", fixed[10:])[0])
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size == 8:
                    length = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size:]
        f.seek(at)
        inflate = zlib.decompressobj(31)
        got, used = b"", 0

        def more(most: int) -> bytes:
            nonlocal used
            raw = f.read(min(most, length - used) if length else most)
            used += len(raw)
            return inflate.decompress(raw)

        step = 1024
        while (end := got.find(b"\r\n\r\n")) < 0 and not inflate.eof:
            before = used
            got += more(step)
            if used == before:
                raise ValueError(f"the record at byte {at} has no end")
        headers = parse_headers(got[:end])
        size = int(headers.get("content-length", 0))
        keep, want_payload = wanted(headers)
        if keep and want_payload:
            parts, have = [got[end + 4:]], len(got) - end - 4
            while have < size:
                before = used
                parts.append(more(1 << 20))
                have += len(parts[-1])
                if used == before:
                    raise ValueError(f"the record at byte {at} is cut off")
            yield headers, b"".join(parts)[:size]
        elif keep:
            yield headers, None
        if length is None:  # an archive from elsewhere: the member's end shows when it is inflated
            while not inflate.eof:
                before = used
                more(1 << 20)
                if used == before:
                    break
            length = used - len(inflate.unused_data)
        at += length


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.pack = int(options.get("packBytes", 64 << 20))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            name = HEADER_COLUMNS.get(column or "")
            if name and isinstance(f, EqualTo):
                self.tests.append((name, "=", f.value))
            elif name and isinstance(f, In):
                self.tests.append((name, "in", tuple(f.value)))
            elif name and isinstance(f, StringStartsWith):
                self.tests.append((name, "starts", f.value))
            elif name and isinstance(f, IsNotNull):
                self.tests.append((name, "is", None))
            else:
                yield f

    def _wanted(self, headers: dict[str, str]) -> tuple[bool, bool]:
        for name, op, value in self.tests:
            own = headers.get(name)
            if own is None or (op == "=" and own != value or op == "in" and own not in value
                               or op == "starts" and not own.startswith(value)):
                return False, False
        return True, self.payload and headers.get("warc-type") != "revisit"

    def partitions(self) -> list[WarcFiles]:
        system, folder = _file_system(self.path)
        manifest = posixpath.join(folder, "manifest")
        if system.get_file_info(manifest).type == pafs.FileType.Directory:
            rows = pads.dataset(manifest, filesystem=system, format="parquet").to_table(["file", "bytes"]).to_pylist()
            files = sorted((posixpath.join(folder, r["file"]), r["bytes"]) for r in rows)
        else:
            found = system.get_file_info(pafs.FileSelector(folder, recursive=True))
            files = sorted((i.path, i.size) for i in found if i.path.endswith((".warc", ".warc.gz")))
        parts, held = [], 0
        for name, size in files:
            if not parts or held + size > self.pack:
                parts.append(WarcFiles([]))
                held = 0
            parts[-1].files.append(name)
            held += size
        return parts or [WarcFiles([])]

    def read(self, partition: WarcFiles) -> Iterator[pa.RecordBatch]:
        system, _ = _file_system(self.path)
        rows, held = [], 0
        for name in partition.files:
            with io.BufferedReader(system.open_input_file(name), 1 << 20) as f:
                for headers, payload in (_members if name.endswith(".gz") else _plain)(f, self._wanted):
                    rows.append((headers, payload))
                    held += 500 + len(payload or b"")
                    if held >= BATCH_BYTES:
                        yield self._batch(rows)
                        rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows) -> pa.RecordBatch:
        columns = [pa.array([h.get(name) for h, _ in rows], pa.string()) for name in HEADER_COLUMNS.values()]
        columns.append(pa.array([list(h.items()) for h, _ in rows], _ARROW.field("headers").type))
        columns.append(pa.array([p for _, p in rows], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records of a folder of archives; see :data:`SCHEMA`."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
