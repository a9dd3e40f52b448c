import hashlib
import random

import pytest
import tiktoken

import corpus_pipeline
import public_tokenizers
from opinio.llm import bpe
from opinio.llm.common import materialise

PLAIN = ["the", "quick", "brown", "fox", "jumps", "over", "lazy", "dogs", "while", "seven", "cats", "sleep", "under",
         "old", "trees", "near", "calm", "rivers", "and", "hills"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rnd = random.Random(12)
    text = lambda n: [rnd.choice(PLAIN) + str(rnd.randrange(400)) for _ in range(n)]
    items = [" ".join(text(25)) for _ in range(6)]
    docs, clean = [], []
    for i in range(120):
        docs.append(" ".join(text(rnd.randint(20, 80))))
        clean.append(len(docs) - 1)
    groups = {}
    for i in range(0, 20):  # copies that differ in white space, the longest stays
        docs.append(docs[i].replace(" ", "\n ", 1))
        groups[i] = len(docs) - 1
    for i in range(20, 40):  # near copies: the smallest id stays
        docs.append(docs[i] + " tail")
    for i in range(6):
        w = items[i].split()
        w[rnd.randrange(len(w))] = "edited"
        docs.append(" ".join([*text(15), *w, *text(15)]))
    junk = len(docs)
    docs += ["%%% ### !!! " * rnd.randint(10, 30) + str(i) for i in range(30)]
    root = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(docs)]
    (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
     .write.parquet(f"{root}/documents.parquet"))
    spark.createDataFrame([(i, int(i < junk)) for i in range(len(docs)) if i % 2], "doc_id long, quality int"
                          ).write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    stay = {groups.get(i, i) for i in clean}
    return root, docs, stay, junk


def test_stages(spark, tables):
    root, docs, stay, junk = tables
    kept = spark.read.parquet(f"{root}/documents.parquet")
    columns = kept.columns
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialise(stage(spark, kept, root), name)
        assert kept.columns == columns
        left[name] = {r.doc_id for r in kept.select("doc_id").collect()}
    assert left["quality"] == set(range(junk))
    assert left["exact_dedup"] == left["quality"] - set(range(20))
    assert left["ngram_jaccard"] == left["exact_dedup"] - set(range(140, 160))
    assert left["decontaminate"] == left["ngram_jaccard"] - set(range(160, 166)) == stay
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, root).collect()}
    assert set(got) == stay
    for i, r in got.items():
        ids = enc.encode_ordinary(docs[i])
        assert r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(docs[i].encode()).hexdigest()


def test_odd_rows(spark, tmp_path):
    rows = [(None, None, "x"), (1, "", "x"), (1, "", "x"), (2, "one", "x"), (2, "one", "x"), (3, "one", "x"),
            (4, "w " * 50_000, "x"), (None, "one", "x")]
    root = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, __key string").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    kept = sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, root).collect())
    assert kept == ["1", "2", "4"]


def test_empty_tables(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    assert corpus_pipeline.run(spark, root).count() == 0
