import regex
from pyspark.sql import functions as F

from opinio.functions import text as txt
from opinio.functions.stopwords import ENGLISH_STOP_WORDS
from tests.conftest import SF_SMALL


def py_clean(text, stop):
    """Independent reference: Python str.split() + Unicode \\w, from the rule text."""
    words = [] if text is None else [w for w in text.split() if w not in stop]
    joined = " ".join(words)
    return " ".join(regex.findall(r"\w+", joined)).lower()


def test_stop_list_matches_spark(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert ENGLISH_STOP_WORDS == list(StopWordsRemover.loadDefaultStopWords("english"))


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "The the, don't stop")], "id int, t string")
    out = df.select("id", txt.clean_content("t", ["the", "don't"]).alias("c")).orderBy("id").collect()
    assert [r.c for r in out] == ["", "", "the the stop"]
    lens = df.select(txt.content_length(txt.clean_content("t")).alias("n"),
                     txt.content_length(txt.clean_content("t"), empty_is_zero=True).alias("z")).collect()
    assert [(r.n, r.z) for r in lens][:2] == [(1, 0), (1, 0)]


def test_clean_matches_python_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = dict(docs.select("doc_id", txt.clean_content("text").alias("c")).collect())
    stop = set(ENGLISH_STOP_WORDS)
    for doc_id, text in docs.collect():
        assert got[doc_id] == py_clean(text, stop), doc_id


def test_unicode_whitespace_and_words(spark):
    s = "café naïve résumé　x_y 42"
    df = spark.createDataFrame([(s,)], "t string")
    assert df.select(txt.clean_content("t", []).alias("c")).first().c == py_clean(s, set())


def test_tfidf_tokens_min_length(spark):
    df = spark.createDataFrame([("a bb ccc d ee",)], "t string")
    assert df.select(txt.tfidf_tokens("t").alias("x")).first().x == ["bb", "ccc", "ee"]


def test_scraper_helpers(spark):
    df = spark.createDataFrame([("4.5 star rating", "a/b?userid=XYZ", "Useful 3"), ("5", "x", "Useful")],
                               "a string, h string, c string")
    rows = df.select(txt.split_first("a").alias("f"), txt.split_last("h", "=").alias("l"),
                     txt.count_or_zero("c").alias("n")).collect()
    assert [(r.f, r.l, r.n) for r in rows] == [("4.5", "XYZ", 3), ("5", "x", 0)]


def test_surrogate_key_deterministic(spark):
    df = spark.createDataFrame([("u1", "r1"), ("u1", "r1"), ("u2", "r1")], "a string, b string")
    keys = [r.k for r in df.select(txt.surrogate_key("a", "b").alias("k")).collect()]
    assert keys[0] == keys[1] != keys[2] and len(keys[0]) == 22 and keys[0].isalnum()
