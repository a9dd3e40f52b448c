import json
import random

import pytest

from opinio.sources.folder_log import FolderLog, Split, _StreamReader, read_log, stream_log


def put(root, partition, segment, text, mode="a"):
    folder = root / partition
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / segment, mode, newline="", encoding="utf-8") as f:
        f.write(text)


def test_splits_hold_each_line_once(tmp_path):
    rnd = random.Random(1)
    lines = ["x" * rnd.choice([0, 1, 5, 200, 70_000]) + str(i) for i in range(200)]
    put(tmp_path, "p0", "0", "\n".join(lines) + "\n")
    log = FolderLog(str(tmp_path))
    size = (tmp_path / "p0" / "0").stat().st_size
    for n in (1, 7, 100, 65_536, size):
        splits = log.splits({}, {"p0": {"segment": "0", "position": size}}, n) if n > 50 else \
            [Split("p0", "0", a, min(size, a + n), a == 0) for a in range(0, 3000, n)]
        got = [v for s in splits for b in log.read(s) for v in b.column("value").to_pylist()]
        assert got == (lines if n > 50 else lines[:len(got)])
    places = [p for s in log.splits({}, {"p0": {"segment": "0", "position": size}}, 1000) for b in log.read(s)
              for p in b.column("position").to_pylist()]
    raw = (tmp_path / "p0" / "0").read_bytes()
    assert places == [0, *(i + 1 for i, c in enumerate(raw[:-1]) if c == 10)]


def test_offsets_end_at_lines_and_stay_small(tmp_path):
    put(tmp_path, "p0", "a", "one\ntwo\n")
    put(tmp_path, "p0", "b", "three\nfou")            # the last line is being written
    put(tmp_path, "p1", "a", "no end")                 # sealed by the next segment
    put(tmp_path, "p1", "b", "")
    put(tmp_path, "_tmp", "a", "hidden\n")
    log = FolderLog(str(tmp_path))
    ends = {p: log.advance(p, s, None, None) for p, s in log.segments().items()}
    assert ends == {"p0": {"segment": "b", "position": 6}, "p1": {"segment": "a", "position": 6}}
    values = [v for s in log.splits({}, ends, 1000) for b in log.read(s) for v in b.column("value").to_pylist()]
    assert values == ["one", "two", "three", "no end"]


def test_admission_is_in_whole_lines(tmp_path):
    put(tmp_path, "p0", "a", "aaaa\nbbbb\ncc\n")
    put(tmp_path, "p0", "b", "z" * 100 + "\nq\n")
    log = FolderLog(str(tmp_path))
    at, seen = None, []
    segments = log.segments()["p0"]
    while True:
        new = log.advance("p0", segments, at, 7)
        if new == at:
            break
        start = {} if at is None else {"p0": at}
        seen.append([v for s in log.splits(start, {"p0": new}, 1000) for b in log.read(s)
                     for v in b.column("value").to_pylist()])
        at = new
    assert [v[:4] for batch in seen for v in batch] == ["aaaa", "bbbb", "cc", "zzzz", "q"]
    assert max(map(len, seen)) <= 2 and at == {"segment": "b", "position": 103}


def reader(tmp_path, **more):
    return _StreamReader({"path": str(tmp_path / "log"), "progress": str(tmp_path / "progress" / "p"), **more})


def test_a_restarted_reader_goes_on_from_the_planned_end(tmp_path):
    put(tmp_path / "log", "p0", "a", "".join(f"line {i}\n" for i in range(100)))
    one = reader(tmp_path, maxbytespertrigger="100")
    start = one.initialOffset()
    end = one.latestOffset()
    assert one.partitions(start, end) and end["p0"]["position"] <= 100
    two = reader(tmp_path, maxbytespertrigger="100")   # a new process of the same query
    later = two.latestOffset()
    assert end["p0"]["position"] < later["p0"]["position"] <= end["p0"]["position"] + 100
    assert two.initialOffset() == {} and reader(tmp_path, maxbytespertrigger="100").latestOffset() == end
    with pytest.raises(ValueError):
        _StreamReader({"path": str(tmp_path), "maxbytespertrigger": "5"})
    assert json.loads((tmp_path / "progress" / "p").read_text()) == {}


def run(spark, tmp_path, rows, **options):
    def keep(batch, n):
        rows.extend((n, r.value, r.partition, r.segment, r.position) for r in batch.collect())

    stream = stream_log(spark, str(tmp_path / "log"), str(tmp_path / "progress" / "p"), **options)
    q = (stream.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(processingTime="0 seconds").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_stream_equals_batch_and_a_restart_in_mid_file_adds_nothing(spark, tmp_path):
    for p in range(3):
        for s in range(2):
            put(tmp_path / "log", f"p{p}", f"seg{s}", "".join(f"m{p}-{s}-{i} é\n" for i in range(40)))
    rows: list = []
    run(spark, tmp_path, rows, max_bytes=600, split_bytes=50)
    assert len({n for n, *_ in rows}) > 3                          # several batches
    batch = sorted(tuple(r) for r in read_log(spark, str(tmp_path / "log"), split_bytes=100).collect())
    assert sorted(r[1:] for r in rows) == batch and len(batch) == 240
    run(spark, tmp_path, rows, max_bytes=600)                       # nothing new
    assert len(rows) == 240
    put(tmp_path / "log", "p1", "seg1", "late\nhalf")
    put(tmp_path / "log", "p9", "seg0", "new partition\n")
    run(spark, tmp_path, rows, max_bytes=600)
    assert sorted(r[1] for r in rows[240:]) == ["late", "new partition"]
    put(tmp_path / "log", "p1", "seg1", " a line\n")
    run(spark, tmp_path, rows, max_bytes=600)
    assert [r[1] for r in rows[242:]] == ["half a line"]
    assert sorted(r[1:] for r in rows) == sorted(tuple(r) for r in read_log(spark, str(tmp_path / "log")).collect())


def test_empty_log(spark, tmp_path):
    (tmp_path / "log").mkdir()
    assert read_log(spark, str(tmp_path / "log")).count() == 0
