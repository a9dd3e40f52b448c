import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from opinio.llm.bpe import MEMO_PIECE, BatchTrees, Coder, bpe, load_ranks, merge_piece

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", "a", " ", "  \n\t ", "hello world", "x" * 30_000, "é" * 500, "abc" * 3000, "don't we'll",
         "日本語 テキスト" * 20, "\x00\t\r\n a", "a　b", "<|endoftext|>", "12345 6789", "😀😀 😀"]


def brute(piece, ranks):
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks),
                   default=None)
        if best is None:
            return [ranks[p] for p in parts]
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_trees_match_brute_force(ranks):
    rnd = random.Random(5)
    pieces = [bytes(rnd.choice(b"abethn \xc3\xa9\xff") for _ in range(rnd.randint(2, 64))) for _ in range(400)]
    batch = BatchTrees(ranks).merge(pieces)
    for p, ids in zip(pieces, batch):
        want = brute(p, ranks)
        if p not in ranks:
            assert merge_piece(p, ranks) == want
        assert [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)] == want


def test_matches_the_library(spark, ranks, library):
    rnd = random.Random(7)
    texts = TEXTS + ["".join(rnd.choice("abeth \n1é'") for _ in range(rnd.randint(0, 90))) for _ in range(200)]
    rows = [(i, t, "extra") for i, t in enumerate(texts)] + [(None, None, "x"), (0, texts[4], "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe(df, PATH, public_tokenizers.PATTERN,
              outputs=("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id != 0}
    for i, t in enumerate(texts[1:], 1):
        ids = library.encode_ordinary(t)
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        assert bytes(by_id[i].ids) == raw and by_id[i].n_tokens == len(ids)
        assert bytes(by_id[i].decoded) == t.encode()
        assert by_id[i].ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert by_id[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert by_id[None].n_tokens == 0 and bytes(by_id[None].decoded) == b""


def test_memo_does_not_keep_long_pieces(ranks):
    coder = Coder(ranks, public_tokenizers.PATTERN)
    coder.encode_all(["x" * 5000])
    assert all(len(p) <= MEMO_PIECE for p in coder.memo)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe(df, PATH, public_tokenizers.PATTERN).count() == 0
