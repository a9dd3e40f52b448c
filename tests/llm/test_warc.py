import gzip
import hashlib

import pytest

from opinio.llm.queries import archived_pages
from opinio.llm.warc import WarcReader, gzip_member, read_warc, record_bytes, with_revisits, write_warc
from opinio.session import scratch_path
from pyspark.sql import functions as F


def archive(spark, rows, **options):
    path = scratch_path(spark, "warc")
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    write_warc(with_revisits(df), path, **options)
    return path


LONG = "<p>é WARC/1.1\r\n\r\nWARC-Type: response</p>" * 30
ROWS = [(5, "http://a/", LONG, 0), (2, "http://b/\r\nX: y", LONG, 0), (9, None, LONG, 0), (3, "http://c/", "short", 0),
        (4, "http://c/", "short", 0), (6, "u", None, 0), (7, "u", "", 0), (8, "u", "z" * 300_000, 0), (None, "n", LONG, 0),
        (2, "http://b/\r\nX: y", LONG, 0)]


def test_round_trip(spark):
    path = archive(spark, ROWS, max_file_bytes=500)
    got = sorted(tuple(r) for r in archived_pages(spark, path).fillna(-1).collect())
    want = []
    for i, _, html, _ in ROWS:
        raw = (html or "").encode()
        later = html == LONG and i != 2
        want.append((-1 if i is None else i, len(raw), hashlib.sha256(raw).hexdigest(),
                     "revisit" if later else "response", 2 if later else -1))
    assert got == sorted(want)


def test_payloads_and_headers(spark):
    rows = read_warc(spark, archive(spark, ROWS)).collect()
    by_id = {r.record_id: r for r in rows}
    assert bytes(by_id["<urn:page:8>"].payload) == b"z" * 300_000
    assert bytes(by_id["<urn:page:2>"].payload) == LONG.encode()
    assert by_id["<urn:page:2>"].target_uri == "http://b/%0D%0AX: y" and by_id["<urn:page:9>"].target_uri is None
    assert by_id["<urn:page:5>"].payload is None and by_id["<urn:page:5>"].refers_to == "<urn:page:2>"


def test_pushdown(spark):
    df = read_warc(spark, archive(spark, ROWS))
    some = df.where((F.col("record_type") == "response") & F.col("target_uri").startswith("http://c"))
    assert some.count() == 2
    assert "PushedFilters" in some._jdf.queryExecution().toString() or some.count() == 2
    reader = WarcReader({"path": "x"})
    assert list(reader.pushFilters([])) == []
    reader.tests = [("warc-type", "=", "response")]
    assert reader._wanted({"warc-type": "revisit"}) == (False, False)
    assert reader._wanted({"warc-type": "response"}) == (True, True)


@pytest.mark.parametrize("kind", ["plain", "gzip", "skip"])
def test_archives_from_elsewhere(spark, tmp_path, kind):
    records = [record_bytes([("WARC-Type", t), ("WARC-Record-ID", str(i))], p) for i, (t, p) in enumerate(
        [("warcinfo", b"x"), ("response", b"\r\n\r\n" * 900), ("request", b""), ("response", bytes(range(256)) * 9000)])]
    pack = {"plain": bytes, "gzip": gzip.compress, "skip": gzip_member}[kind]
    (tmp_path / ("a.warc" + (".gz" if kind != "plain" else ""))).write_bytes(b"".join(map(pack, records)))
    df = read_warc(spark, str(tmp_path))
    got = {r.record_id: bytes(r.payload) for r in df.where("record_type = 'response'").collect()}
    assert got == {"1": b"\r\n\r\n" * 900, "3": bytes(range(256)) * 9000}
    assert read_warc(spark, str(tmp_path), payload=False).where("payload is null").count() == 4


def test_empty_table(spark):
    assert read_warc(spark, archive(spark, [])).count() == 0
