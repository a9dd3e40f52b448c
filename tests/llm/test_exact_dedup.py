import hashlib
import random
import re

from pyspark.sql import functions as F

from opinio.llm import exact_dedup as ed


def brute(rows):
    groups = {}
    for i, (doc, text) in enumerate(rows):
        norm = re.sub(r"[\x20\x09-\x0d]+", "", text or "")
        groups.setdefault(norm, []).append((-len(text or ""), doc is None, doc or 0, i))
    out = []
    for norm, members in groups.items():
        best = min(m[:3] for m in members)
        keep = None if best[1] else best[2]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        for n, _, _, i in members:
            out.append((rows[i][0], keep, len(members), sha))
    return out, len(groups)


def test_matches_brute_force(spark):
    rnd = random.Random(1)
    long = "".join(rnd.choice("abcdefghijklmnoprst éß\n") for _ in range(60_000))
    texts = ["", " ", "\t\n", None, "a b", "ab", " ab", "a\x0bb", "a b", "日本 語", "日本語", long, long + " ",
             long[:30_000] + "x" + long[30_000:], "😀" * 9000, "😀" * 9000 + "\r"]
    rows = [(i, t) for i, t in enumerate(texts * 3)] + [(2, "ab"), (2, "ab"), (None, "ab"), (None, "z"), (None, "z")]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, recipe string").repartition(7)
    got = ed.exact_dedup(df).collect()
    want, groups = brute(rows)
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got)
    assert sum(r.kept for r in got) == groups


def test_chunks_cover_the_text_and_survive_an_edit(spark):
    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdefghijklmnoprst") for _ in range(200_000))
    edited = text[:100] + "zz" + text[100:]
    df = spark.createDataFrame([(text,), (edited,)], "t string").select(ed.chunks(F.col("t")).alias("c"))
    a, b = (r.c for r in df.collect())
    assert "".join(a) == text and "".join(b) == edited
    assert all(ed.MIN < len(x) <= ed.MAX for x in a[:-1])
    assert len(set(a) & set(b)) > 0.9 * len(a)


def test_clashing_identifiers_are_told_apart(spark, monkeypatch):
    df = spark.createDataFrame([(1, "abc"), (2, "xyz"), (3, "abc"), (4, "other")], "doc_id long, text string")
    real = ed.recipes

    def clash(*args):
        return real(*args).withColumn("cids", F.transform("cids", lambda c: F.lit(5).cast("long")))

    monkeypatch.setattr(ed, "recipes", clash)
    assert {r.doc_id: r.keep_id for r in ed.exact_dedup(df).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}


def test_empty_table(spark):
    assert ed.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
