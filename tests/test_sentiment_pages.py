import math

import pytest

from opinio.operators import pages as pg
from opinio.operators import sentiment as sent


def test_sentiment_rule(spark):
    df = spark.createDataFrame([("1", "good food, bad service!"), ("2", ""), ("3", "Great 42 great")],
                               "review_id string, review_content string")
    clean = sent.clean_for_sentiment(df)
    lex = sent.lexicon_frame(spark, {"good": 2.0, "bad": -1.0, "great": 3.0})
    got = {r.review_id: r for r in sent.sentiment_scores(clean, lex).collect()}
    # tokens good food bad service: pos 3, neg -2, neu 2 -> total 7; s = 1
    assert got["1"].pos == round(3 / 7, 3) and got["1"].neg == round(2 / 7, 3) and got["1"].neu == round(2 / 7, 3)
    assert got["1"].compound == round(1 / math.sqrt(16), 4)
    assert (got["2"].pos, got["2"].neg, got["2"].neu, got["2"].compound) == (0.0, 0.0, 0.0, 0.0)
    assert got["3"].compound == pytest.approx(round(6 / math.sqrt(51), 4))


def test_lemma_lookup_order(spark):
    df = spark.createDataFrame([("1", "Loved the dishes; loved it")], "review_id string, review_content string")
    lem = spark.createDataFrame([("loved", "love"), ("dishes", "dish")], "form string, lemma string")
    assert sent.clean_for_sentiment(df, lemmas=lem).first().review_clean == "love dish love"


def test_align_fields_pads_missing(spark):
    html = '<a href="/a">A</a><a href="/b">B</a><p>one'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = pg.align_fields(df, {"href": pg.LINK_HREF, "text": pg.LINK_TEXT, "p": r"<p>([^<]*)"}).orderBy("slot").collect()
    assert [(r.href, r.text, r.p) for r in rows] == [("/a", "A", "one"), ("/b", "B", None)]


def test_one_pass_matches_two_step(spark):
    df = spark.createDataFrame([("1", "Good food, BAD service! loved it"), ("2", None), ("3", "x 9 y")],
                               "review_id string, review_content string")
    lem = spark.createDataFrame([("loved", "love")], "form string, lemma string")
    lex = sent.lexicon_frame(spark, {"good": 2.0, "bad": -1.0, "love": 3.0})
    two = {r.review_id: tuple(r)[1:] for r in
           sent.sentiment_scores(sent.clean_for_sentiment(df, lemmas=lem), lex).collect()}
    one = {r.review_id: tuple(r)[1:] for r in sent.text_sentiment(df, lex, lemmas=lem).collect()}
    assert one == two


def test_pages_one_day_covers_every_page(spark, tmp_path):
    from opinio.plans.queries import q_pages_one_day

    html = ['<html lang="en">', '<html lang="it">', "<p>no language</p>", None, '<html lang="fr">']
    rows = [(2 + 7 * i, "u", h) for i, h in enumerate(html)] + [(3, "u", html[0])]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = [r.page_id for r in q_pages_one_day(spark, str(tmp_path)).collect()]
    assert sorted(got) == [2, 9, 16, 23, 30]
