"""Id columns and extra columns with the names that operators use."""

import pytest

from opinio.llm.common import distinct_names
from opinio.llm.decontaminate import find_contamination
from opinio.llm.html_extract import extract_text
from opinio.llm.secrets import scan_secrets
from opinio.llm.url_rules import judge_urls

ITEM = "which of these seven rivers runs longest through the old northern valley before it meets the sea"


def test_distinct_names():
    assert distinct_names("a", "b", "A", "a") == ["a", "b", "A_", "a__"]


@pytest.mark.parametrize("name", ["page_id", "text", "n_chars", "_html"])
def test_html(spark, name):
    df = spark.createDataFrame([(1, "u", "<p>x</p>", 5)], f"`{name}` long, url string, html string, n_chars_ long")
    got = extract_text(df, id_col=name)
    assert got.columns[0] == name and len({*got.columns}) == 4
    assert tuple(got.first()) == (1, "u", "x", 1)


@pytest.mark.parametrize("name", ["doc_id", "key", "kinds", "_key", "text_", "spans", "id", "trigram"])
def test_secrets(spark, name):
    df = spark.createDataFrame([(1, "password=abcdefgh"), (2, None)], f"`{name}` long, text string")
    got = scan_secrets(df, id_col=name)
    assert got.columns[0] == name
    assert sorted((r[0], len(r[1])) for r in got.collect()) == [(1, 1), (2, 0)]


@pytest.mark.parametrize("name", ["page_id", "host", "path", "rule", "verdict", "key", "kind", "part", "id"])
def test_urls(spark, name):
    df = spark.createDataFrame([(1, "http://a.com/x")], f"`{name}` long, url string")
    rules = spark.createDataFrame([("com", "/", "block")], "host string, path string, verdict string")
    got = judge_urls(df, rules, id_col=name)
    assert got.columns[0] == name and tuple(got.first()) == (1, "a.com", "/x", "com/", "block")


@pytest.mark.parametrize("names", [("id", "id"), ("doc_id", "similarity"), ("first_word", "item_id"), ("text_", "text_")])
def test_contamination(spark, names):
    docs = spark.createDataFrame([(1, f"some words before {ITEM} and after"), (2, "clean")], f"`{names[0]}` long, text string")
    items = spark.createDataFrame([(7, ITEM)], f"`{names[1]}` long, text string")
    got = find_contamination(docs, items, id_col=names[0], item_col=names[1])
    assert len({c.lower() for c in got.columns}) == 5
    assert [tuple(r)[:3] for r in got.collect()] == [(1, 7, 1.0)]
