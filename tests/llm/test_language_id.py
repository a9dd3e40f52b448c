import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinio.llm import language_id as li

SF = "/root/testdata/sf0.1"


def word(rnd, letters):
    return "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 8)))


def corpus(n=400):
    rnd = random.Random(6)
    sets = {"aa": "abcdefg", "bb": "efghijk", "ccc": "äöüßéab", "zh": "日本語文字中国"}
    rows = []
    for i in range(n):
        lang = rnd.choice(list(sets))
        letters = sets[lang]
        text = " ".join(word(rnd, letters if rnd.random() < 0.9 else "abcdefghijk") for _ in range(rnd.randint(3, 40)))
        rows.append((i, text.title() if i % 5 == 0 else text, lang))
    return rows


def brute_sets(rows):
    """Languages of each n-gram, by its rates."""
    counts = {}
    for _, text, lang in rows:
        if lang is not None:
            c = counts.setdefault(lang, Counter())
            for w in li.words_of(text or ""):
                c.update(li.grams_of(w))
    rates = {}
    for lang, c in counts.items():
        for g, n in c.items():
            if n / c.total() >= li.LEAST:
                rates.setdefault(g, {})[lang] = n / c.total()
    return {g: {x for x, v in r.items() if v >= li.SHARE * max(r.values())} for g, r in rates.items()}, sorted(counts)


def gram_hash(gram):
    """The hash of one n-gram, by plain integers."""
    h = 0
    for n, c in enumerate(gram, 1):
        h = (h * 0x100000001B3 + ord(c) + n) % (1 << 64)
    h = (h ^ h >> 32) * 0x9E3779B97F4A7C15 % (1 << 64)
    h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 % (1 << 64)
    h ^= h >> 32
    return h - (1 << 64) if h >= 1 << 63 else h


def test_hashes_match_plain_integers():
    words = ["a", "ab", "wort", "語", "straße", "x" * 64, "abcdefgh"]
    hashes, place = li.gram_hashes(words)
    for k, w in enumerate(words):
        assert sorted(hashes[place == k].tolist()) == sorted(map(gram_hash, li.grams_of(w)))
    assert li.gram_hashes(["z"])[0].tolist() == [gram_hash(g) for g in ["z", " z", "z ", " z "]]


def test_grams():
    assert li.grams_of("ab") == ["a", "b", " a", "ab", "b ", " ab", "ab ", " ab "]
    assert li.words_of("Ein-Wort 12 x1y É") == ["ein", "wort", "x", "y", "é"]
    assert [len(w) for w in li.words_of("語" * 150)] == [64, 64, 22]


def test_filter_holds_the_languages_of_each_gram(spark):
    rows = corpus() + [(900, None, "aa"), (901, "fremd", None), (902, "", "bb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    model = li.train(df)
    sets, langs = brute_sets(rows)
    assert model.langs == langs and langs[model.common] == Counter(r[2] for r in rows).most_common(1)[0][0]
    grams = sorted(sets)
    masks = model.masks(np.array([gram_hash(g) for g in grams], np.int64))[:, 0]
    extra = 0
    for g, m in zip(grams, masks.tolist()):
        found = {x for k, x in enumerate(langs) if m >> k & 1}
        assert sets[g] <= found
        extra += len(found - sets[g])
    assert extra <= 3 + 2 * model.false.sum() * len(grams)  # only as many false ones as the fill says
    filled = [len({r for g in grams if x in sets[g] for r in li.filter_rows(np.array([gram_hash(g)]))[:, 0].tolist()})
              for x in langs]
    assert np.allclose(model.false, (np.array(filled) / li.ROWS) ** li.HASHES)


def test_prediction_matches_exact_sets(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = li.train(df)
    sets, langs = brute_sets(rows)
    for _, text, lang in corpus(60):
        grams = [g for w in li.words_of(text) for g in li.grams_of(w)]
        share = [sum(x in sets.get(g, ()) for g in grams) / len(grams) for x in langs]
        [(got, score)] = model.predict([text])
        assert got == langs[int(np.argmax(share))] and math.isclose(score, max(share), abs_tol=0.02)
    # A filter that is nearly full is put right by the correction.
    full = li.LanguageFilter(["x", "y"], model.table.copy())
    full.table[np.random.default_rng(0).random(li.ROWS) < 0.9] |= np.uint64(1)
    full = li.LanguageFilter(["x", "y"], full.table)
    assert full.false[0] > 0.5 and full.predict(["qqq www zzz"])[0][1] < 0.35


def test_edge_texts(spark):
    rows = corpus(100)
    model = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = [(1, None, "k"), (2, "", "k"), (3, "123 !? ½", "k"), (4, "абв где", "k"), (5, "abc defg " * 200_000, "k"),
           (6, "語" * 300_000, "k"), (None, "abcd efg bcd", "k"), (6, "語" * 300_000, "k")]
    df = spark.createDataFrame(odd, "doc_id long, text string, score string")
    got = li.predict(df, model)
    assert got.columns == ["doc_id", "text", "score", "lang_pred", "score_"]
    by = {r.doc_id: (r.lang_pred, r.score_) for r in got.collect()}
    assert by[1] == by[2] == by[3] == (li.UNKNOWN, 0.0)
    assert by[4] == (model.langs[model.common], 0.0)
    assert by[5][0] == by[None][0] == "aa" and by[6][0] == "zh" and got.count() == len(odd)
    assert all(0 <= s <= 1 for _, s in by.values())


def test_a_full_memo_changes_nothing(spark, monkeypatch):
    rows = corpus()
    model = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    want = model.predict([t for _, t, _ in rows])
    monkeypatch.setattr(li, "HELD", 7)
    monkeypatch.setattr(li, "STEP", 3)
    model.memo.clear()
    model.known = model.known[:0]
    assert model.predict([t for _, t, _ in rows]) == want


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")
    model = li.train(docs)
    assert model.langs == [] and li.predict(docs, model).first().lang_pred == li.UNKNOWN
    assert li.predict(docs.limit(0), model).count() == 0
    assert li.train(docs.limit(0)).langs == []
    # A language without any word is learned but never the best.
    some = spark.createDataFrame([(1, "a b", "aa"), (2, "12", "bb"), (3, None, "cc")], "doc_id long, text string, lang string")
    assert li.train(some).predict(["a b"])[0][0] == "aa"


@pytest.mark.parametrize("n", [70, 130])
def test_many_languages(spark, n):
    rows = [(i, " ".join(f"{chr(0x4E00 + i)}{chr(0x5E00 + j)}" for j in range(30)), f"l{i:03}") for i in range(n)]
    model = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.table.shape[1] == -(-n // 64)
    assert [x for x, _ in model.predict([t for _, t, _ in rows])] == model.langs


def test_held_out_accuracy(spark):
    from opinio.llm.queries import op12_language_id

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = op12_language_id(spark, SF)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.lang is not None]
    assert len(held) > 1000 and sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)


def test_labels_of_held_out_rows_do_not_matter(spark, tmp_path):
    from opinio.llm.queries import op12_language_id

    rows = corpus(120)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    bent = F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, "xx").otherwise(F.col("lang"))
    df.write.parquet(f"{one}/documents.parquet")
    df.withColumn("lang", bent).write.parquet(f"{two}/documents.parquet")
    assert sorted(op12_language_id(spark, one).collect()) == sorted(op12_language_id(spark, two).collect())
