import io
import random

import pytest

from opinio.schemas import RAW
from opinio.sinks.tables import write_csv
from opinio.sources import quoted_csv as qc
from opinio.sources.files import bulk_load_day, read_csv

KIND = "id string, text string, n bigint"


def plain(raw, start=0):
    """Records by reading from the beginning."""
    out, begin, inside = [], 0, False
    for i, c in enumerate(raw):
        if c == qc.QUOTE:
            inside = not inside
        elif c == qc.LINE and not inside:
            out.append((begin, raw[begin:i].removesuffix(b"\r")))
            begin = i + 1
    return out + ([(begin, raw[begin:].removesuffix(b"\r"))] if begin < len(raw) else [])


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_every_record_is_in_one_range(monkeypatch, block):
    monkeypatch.setattr(qc, "BLOCK", block)
    rnd = random.Random(block)
    parts = ['a,"x\ny",1\n', 'b,"say ""hi""\n",2\r\n', "c,plain,3\n", 'd,"","\n\n"\n', "\n", 'e,"' + "long\n" * 30 + '",5\n']
    raw = ("id,text,n\n" + "".join(rnd.choice(parts) for _ in range(40)) + 'z,"no end",9').encode()
    want = plain(raw)
    for size in (1, 2, 13, 100, len(raw)):
        got = []
        for start in range(0, len(raw), size):
            odd = raw[:start].count(b'"') % 2 == 1
            got += qc.records(io.BytesIO(raw), start, min(len(raw), start + size), odd)
        assert got == want


def nasty(rnd, i):
    words = ["plain", "a,b", 'say "hi"', "line\nbreak", "\n", "", "é 日本", "\t", "x" * 200, '"', "'"]
    return (f"r{i}", " ".join(rnd.choice(words) for _ in range(rnd.randrange(8))) or None, rnd.choice([None, i]))


@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
def test_one_large_file_equals_multiline_in_many_tasks(spark, tmp_path, split):
    rnd = random.Random(5)
    df = spark.createDataFrame([nasty(rnd, i) for i in range(400)], KIND)
    path = str(tmp_path / "one")
    write_csv(df.coalesce(1), path)
    schema = df.schema
    got = qc.read_quoted_csv(spark, path, schema, split_bytes=split)
    want = read_csv(spark, path, schema, multiline=True)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    ranges = qc.byte_ranges(spark, path, split)
    if split < 1 << 20:
        assert ranges.count() > 10 and ranges.rdd.getNumPartitions() == ranges.count() == got.rdd.getNumPartitions()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "record" not in plan.split("Exchange", 1)[-1]   # only range rows are exchanged, never texts


def test_many_files_patterns_and_days(spark, tmp_path):
    rnd = random.Random(6)
    df = spark.createDataFrame([nasty(rnd, i) for i in range(100)], KIND)
    write_csv(df.repartition(5), str(tmp_path / "day=20240103"))
    write_csv(df.repartition(3), str(tmp_path / "day=20240104"))
    for day, template in (("2024-01-03", "{root}/day={day}/*.csv"), ("20240104", "{root}/day={day}")):
        got = bulk_load_day(spark, str(tmp_path), day, df.schema, template, multiline=True, split_bytes=300)
        want = bulk_load_day(spark, str(tmp_path), day, df.schema, template, multiline=True)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 100
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path), multiline=True, split_bytes=5)


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("id,text,n\n")
    got = qc.read_quoted_csv(spark, str(tmp_path), spark.createDataFrame([], KIND).schema)
    assert got.count() == 0 and got.columns == ["id", "text", "n"]


def test_reviews_come_back(spark, tmp_path):
    from opinio.sources.tables import reviews

    df = reviews(spark, "/root/testdata/sf0.001", with_label=False).select(*RAW.names)
    write_csv(df.coalesce(2), str(tmp_path / "r"))
    got = qc.read_quoted_csv(spark, str(tmp_path / "r"), RAW, split_bytes=20_000)
    want = read_csv(spark, str(tmp_path / "r"), RAW, multiline=True)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
