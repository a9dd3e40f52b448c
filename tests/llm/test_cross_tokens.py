import json
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from opinio.llm import cross_tokens as ct

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute_tokens(text, libraries):
    """(id, bytes) of each token, or None where they do not spell the text."""
    a, b = libraries
    if not text:
        return None
    letters = ct.byte_letters()
    raw = (" " + text).encode()
    a_toks = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    b_toks = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        b_toks.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    if any(b"".join(x for _, x in t) != raw for t in (a_toks, b_toks)):
        return None
    return a_toks, b_toks


def spans(toks):
    at = 0
    for i, raw in toks:
        yield i, at, at + len(raw)
        at += len(raw)


def brute(rows, libraries):
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each row."""
    docs, counts = [], {}
    for doc_id, text in rows:
        toks = brute_tokens(text, libraries)
        links, groups = [], ""
        if toks:
            a, b = list(spans(toks[0])), list(spans(toks[1]))
            links = [(x, y) for x, s, e in a for y, u, v in b if s < v and u < e]
            cuts = sorted({e for *_, e in a} & {e for *_, e in b})
            groups = ";".join("|".join(",".join(str(i) for i, s, e in t if lo < e <= hi) for t in (a, b))
                              for lo, hi in zip([0, *cuts], cuts))
        docs.append((doc_id, toks, links, groups))
        for p in set(links):
            counts[p] = counts.get(p, 0) + 1
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    return sorted(((i, len(t[0]) if t else 0, len(t[1]) if t else 0, g.count(";") + 1 if g else 0, len(links),
                    sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), g)
                   for i, t, links, g in docs), key=repr)


TEXTS = ["", None, "hello world", "a", " ", "two  blanks", "tab\tline\nend", "▁ piece mark", "<|endoftext|> and <s> </s> <0x41>",
         "日本語のテキスト 😀😀", "naïve café déjà", "\x00\x01", "x" * 3000, "don't we'll it's", "hello world", "１２３ ﬁ Ⅳ",
         "é combining", " nbsp", "﻿bom", "tokenization misalignment " * 50]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_matches_brute_force(spark, libraries, monkeypatch):
    rnd = random.Random(3)
    words = ["the", "Straße", "unbelievable", "1234", "été", "antidisestablishment", ",", "-", "日本", "ab"]
    texts = TEXTS + [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 12))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "hello null"), (5, "hello world"), (5, "hello world")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, a string, groups string")
    got, index = ct.align(df.repartition(40), A, B)
    want = brute(rows, libraries)
    assert collected(got) == want
    assert sum(r[1] for r in want) and any(r[1] == 0 and t for r, (_, t) in zip(want, rows))
    # Several segments and slabs, and counts given in many parts, change nothing.
    monkeypatch.setattr(ct, "SEGMENT", 16)
    monkeypatch.setattr(ct, "FAN", 3)
    assert collected(ct.align(df.repartition(7), A, B)[0]) == want
    assert index.count() == 1


def test_small_bounds(libraries, monkeypatch, tmp_path):
    """Slabs that are dropped and read again give the same numbers."""
    rnd = np.random.default_rng(4)
    pairs = np.unique(rnd.integers(0, 1 << 40, 5000))
    segs, sizes = ct.segment_of(pairs, 5), []
    import pyarrow as pa
    import pyarrow.parquet as pq

    for s in range(32):
        levels, bits, ordered = ct.build_segment(pairs[segs == s])
        sizes.append(len(ordered))
        if s != 7:
            (tmp_path / f"segment={s}").mkdir()
            counts = (ordered % 1000).astype("<i8").tobytes()
            pq.write_table(pa.table({"n": [len(ordered)], "sizes": [levels], "bits": [bits], "counts": [counts],
                                     "pairs": [ordered.astype("<i8").tobytes()]}), tmp_path / f"segment={s}/p.parquet")
    monkeypatch.setattr(ct, "SLAB", 500)
    index = ct.Index(str(tmp_path), 5, sizes, counted=True)
    assert len(index.edges) > 5
    asked = np.concatenate([pairs, rnd.integers(0, 1 << 40, 1000)])
    want = np.where(np.isin(asked, pairs) & (ct.segment_of(asked, 5) != 7), asked % 1000, 0)
    assert (index.counts(asked) == want).all() and len(index.kept) <= ct.SLABS


def test_ranked_ids_are_the_library_s(libraries, monkeypatch):
    pair = ct.Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert pair.ranked is not None
    rnd = random.Random(6)
    texts = [" " + t for t in TEXTS if t] + ["".join(rnd.choice("ab eth'\n\t 1é日😀<|>") for _ in range(80)) for _ in range(3000)]
    got = list(pair._a_ids(texts))
    assert got == [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(ct, "byte_ranks", lambda config: None)   # the tokenizer itself
    pair = ct.Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert pair.ranked is None and list(pair._a_ids(texts)) == got


def test_other_vocabularies_are_not_ranked():
    assert ct.byte_ranks(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()) is None
    config = json.loads(open(A, encoding="utf-8").read())
    config["model"]["merges"] = config["model"]["merges"][::-1]
    assert ct.byte_ranks(json.dumps(config)) is None


def test_hash_is_minimal_and_perfect():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 1000, 70_000):
        pairs = np.unique(rnd.integers(0, 1 << 50, n))
        sizes, bits, ordered = ct.build_segment(pairs)
        slab = ct.Slab(0, [{"sizes": sizes, "bits": bits, "n": len(pairs), "pairs": ordered.astype("<i8").tobytes()}], False)
        got = slab.numbers(pairs, np.zeros(len(pairs), np.int64))
        assert sorted(got.tolist()) == list(range(len(pairs)))
        others = pairs + (1 << 50)
        assert (slab.numbers(others, np.zeros(len(pairs), np.int64)) == -1).all()


def test_query_on_documents(spark, libraries):
    from opinio.llm.queries import op11_cross_tokens

    sf = "/root/testdata/sf0.001"
    docs = [r for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    keep = sorted(docs, key=lambda r: len(r.text or ""))[:150]  # the brute force is quadratic in a text
    df = spark.createDataFrame(keep, "doc_id long, text string")
    assert collected(ct.align(df, A, B)[0]) == brute([tuple(r) for r in keep], libraries)
    got = op11_cross_tokens(spark, sf)
    assert got.count() == len(docs)
    assert dict(got.dtypes) == {"doc_id": "bigint", **{n: "bigint" for n in ct.NUMBERS}, "groups_sha256": "string"}


def test_empty_table_and_no_tokens(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ct.align(df, A, B)[0].count() == 0
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert collected(ct.align(none, A, B)[0]) == [(1, *[0] * 6, ""), (2, *[0] * 6, "")]


def test_id_named_like_an_output(spark):
    df = spark.createDataFrame([(1, "a b")], "n_a long, text string")
    assert ct.align(df, A, B, id_col="n_a")[0].columns[:2] == ["n_a", "n_a_"]
