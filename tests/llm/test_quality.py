import random
import re
import zlib

import numpy as np

from opinio.llm import quality as ql

SF = "/root/testdata/sf0.1"


def brute_buckets(text):
    words = [zlib.crc32(w.encode()) for w in re.findall(r"\w+|[^\w\s]+", text.lower())]
    out = []
    for h in [*words, *(((a * 0x9E3779B97F4A7C15 ^ b) + 1) << 8 for a, b in zip(words, words[1:]))]:
        h %= 1 << 64
        out.append(((h ^ h >> 29) * 0xBF58476D1CE4E5B9) % (1 << 64) >> 50)
    return out


def test_buckets():
    for t in ["", "one", "One two, two!! é 日本", "a " * 500]:
        assert ql.ngram_buckets(t).tolist() == [h % ql.BUCKETS for h in brute_buckets(t)]


def test_weights_match_brute_force(spark):
    rnd = random.Random(2)
    rows = [(i if i % 50 else None, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 30))), "x")
            for i in range(300)] + [(7, "a b c", "x"), (8, None, "x")]
    labels = [(i, i % 3 == 0 and 1 or 0) for i in range(0, 300, 2)] + [(None, 1), (3, None), (9, 1), (9, 1), (999, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(5)
    labs = spark.createDataFrame(labels, "doc_id long, quality int")
    raw, target = np.zeros(ql.BUCKETS), np.zeros(ql.BUCKETS)
    good = {i for i, q in labels if q == 1 and i is not None}
    for i, t, _ in rows:
        for b in brute_buckets(t or ""):
            raw[b] += 1
            target[b] += i in good
    w = np.log((target + ql.PRIOR) / (raw * target.sum() / raw.sum() + ql.PRIOR))
    assert np.allclose(ql.fit_weights(docs, labs), w)
    got = ql.sample_by_importance(docs, labs)[2].collect()
    assert len(got) == len(rows)
    want = sorted(100 * w[b].mean() if (b := brute_buckets(t or "")) else 0.0 for _, t, _ in rows)
    assert np.allclose(sorted(r.log_weight for r in got), want)
    k = sum(x >= -ql.MARGIN * ql.GRAMS for x in want)
    keys = sorted((r.sample_key for r in got), reverse=True)
    assert all(r.kept == (r.sample_key >= keys[k - 1]) for r in got)
    kept = ql.keep_good(docs, labs).collect()
    assert len(kept) == sum(r.kept for r in got)


def test_kth_largest(spark):
    rnd = random.Random(4)
    values = [rnd.gauss(0, 1) for _ in range(500)] + [1e300, -1e300, 0.5, 0.5, 0.5] + [2.0] * 100
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 3, 50, 102, 103, 300, len(values)):
        assert ql.kth_largest(df, "v", k, bins=7) == sorted(values, reverse=True)[k - 1]
    assert ql.kth_largest(df.limit(0), "v", 1) is None


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    fit, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    got = ql.sample_by_importance(docs, fit)[2].join(held, "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.005 * n[1, True]
    assert n[0, False] >= 0.8 * (n[0, False] + n.get((0, True), 0))


def test_no_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert ql.keep_good(docs, labels).count() == 2
    assert ql.keep_good(docs.limit(0), labels).count() == 0
