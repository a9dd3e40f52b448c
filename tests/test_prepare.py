import datetime as dt

from pyspark.sql import functions as F

from opinio.operators import prepare as prep
from opinio.sources import files as srcf


def test_recode_labels(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("",), (None,)], "l string")
    got = [r.x for r in df.select(prep.recode_text_label("l", "Y").alias("x")).collect()]
    assert got == ["true", "false", "false", "false"]
    b = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert [r.x for r in b.select(prep.recode_label("f").alias("x")).collect()] == ["Y", "N", None]


def test_positional_join_uneven_files(spark, tmp_path):
    a, b = tmp_path / "a.txt", tmp_path / "b.txt"
    a.write_text("first review\nsecond review\nthird review\n")
    b.write_text("1/2/2014 r1 u1 p1 Y 0 0 0 5\n12/31/2013 r2 u2 p2 N 0 0 0 3\n")
    la = srcf.read_lines(spark, str(a)).withColumnRenamed("value", "review")
    lb = srcf.read_lines(spark, str(b)).withColumnRenamed("value", "meta")
    rows = sorted(srcf.positional_join(la, lb).collect())
    assert [r.line_no for r in rows] == [0, 1, 2]
    assert rows[2].review == "third review" and rows[2].meta is None
    assert rows[1].meta.startswith("12/31/2013")


def test_read_lines_many_files_keeps_order(spark, tmp_path):
    d = tmp_path / "many"
    d.mkdir()
    expect = []
    for f in range(5):
        lines = [f"f{f}-l{i}" for i in range(f * 3 + 1)]
        (d / f"part-{f:05d}.txt").write_text("\n".join(lines) + "\n")
        expect += lines
    got = [r.value for r in srcf.read_lines(spark, str(d)).orderBy("line_no").collect()]
    assert got == expect


def test_prepare_raw_dates(spark):
    df = spark.createDataFrame(
        [("r1", "u1", "p1", "\n1/2/2014", 5, "t", 1, 2, 3, 4, 5, 4.5, 9)],
        "reviewID string, reviewerID string, restaurantID string, date string, rating long, "
        "reviewContent string, friendCount long, reviewCount long, usefulCount long, coolCount long, "
        "funnyCount long, restaurantRating double, reviewUsefulCount long")
    out = prep.prepare_raw(df).first()
    assert out.timestamp == dt.datetime(2014, 1, 2) and "reviewUsefulCount" not in out.asDict()


def test_valid_ids_and_chunks(spark):
    df = spark.createDataFrame([(" a ",), ("   ",), (None,), ("\tb",)], "review_id string")
    assert sorted(r.review_id for r in prep.valid_ids(df).collect()) == ["a", "b"]
    arr = spark.createDataFrame([(list(range(7)),), ([],)], "a array<int>")
    got = [r.c for r in arr.select(prep.chunk_triples("a").alias("c")).collect()]
    assert got == [[[0, 1, 2], [3, 4, 5], [6]], []]


def test_page_frontier(spark):
    df = spark.createDataFrame([("http://x/biz/a",)], "url string")
    got = [r.page_url for r in prep.page_frontier(df, pages=2).orderBy("page_no").collect()]
    assert got == ["http://x/biz/a?start=0", "http://x/biz/a?start=20"]


def test_no_pages_bad_dates_and_defaults(spark):
    import datetime as dt

    from opinio.functions import dates
    from opinio.operators import summaries
    from opinio.sources.tables import batch_date
    df = spark.createDataFrame([("u", "1/2/2024"), ("v", "not a date"), ("w", None)], "url string, d string")
    assert prep.page_frontier(df, pages=0).count() == 0
    assert [r.page_url for r in prep.page_frontier(df.limit(1), pages=2).collect()] == ["u?start=0", "u?start=20"]
    assert [r.t for r in df.select(dates.parse_slash_date("d").alias("t")).collect()] == [dt.datetime(2024, 1, 2), None, None]
    assert batch_date() == dt.datetime.now(dt.timezone.utc).date()
    assert [r.url for r in summaries.first_n(df, 2, "url").collect()] == ["u", "v"]
    assert [r.url for r in summaries.last_n(df, 2, "url").collect()] == ["w", "v"]
