import json
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from opinio.llm.token_files import SequenceReader, WordEncoder, bare_config, read_index, read_tokens, write_tokens
from opinio.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_words_match_the_library(library):
    rnd = random.Random(3)
    texts = ["", " ", "\n\n", "Don't WE'LL", "a\tb c　d", "ΣΑΣ ΣΑΣ\nΣ", "é ́e", "İstanbul", "x" * 4000,
             "<|endoftext|> <|startoftext|>", "😀 日本語", "a\x1cb\x85c"]
    texts += ["".join(rnd.choice("abcé \n'S1.İ́") for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    with open(PATH, encoding="utf-8") as f:
        enc = WordEncoder(f.read(), 2)
    for t, ids in zip(texts, enc.encode_all(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(t, add_special_tokens=False).ids


def test_words_of_letters_match_the_library():
    library = Tokenizer.from_file(PATH)
    rnd = random.Random(9)
    with open(PATH, encoding="utf-8") as f:
        config = f.read()
    enc = WordEncoder(config, 2, plain=False)
    assert enc.bare is not None
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 14)))
             for letters in ("etaoinshrdlu", "aeéèêßñü", "abcABC", "ας σΣ", "жизнь", "a\u0301eı", "ſﬁªºǅŉ", "日本語ア") for _ in range(800)]
    words += [chr(c) * 2 for c in range(0x41, 0x530) if chr(c).isalpha()]
    for w, ids in zip(words, enc.encode_all(words)):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(w, add_special_tokens=False).ids, ascii(w)
    other = json.loads(config)
    other["normalizer"]["normalizers"].append({"type": "StripAccents"})
    assert bare_config(json.dumps(other)) is None


def test_round_trip(spark, library):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta,", "Gamma", "é", "12"]) for _ in range(rnd.randint(0, 40))), 1)
            for i in range(200)]
    rows += [(7, "repeated id", 2), (None, None, 3), (500, "word " * 9000, 4)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(5)
    path = scratch_path(spark, "t")
    write_tokens(df, path, PATH, end_id=1, seq_len=16, rows=4)
    got = {(r.doc_id, r.start): r for r in read_tokens(spark, path, outputs=("ids", "ids_crc32")).collect()}
    assert len(got) == len(rows)
    at = 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for i, text, _ in order:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        r = got[i, at]
        raw = np.array(ids, "<u4").tobytes()
        assert bytes(r.ids) == raw and r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(raw)
        at += len(ids)


def test_file_format(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, "four")], "doc_id long, text string").coalesce(1)
    path = scratch_path(spark, "t")
    write_tokens(df, path, PATH, end_id=1, seq_len=4, rows=2)
    row = read_index(spark, path).orderBy("start").collect()
    assert [r.start for r in row][0] == 0
    name = f"{path}/tokens/{row[0].file}".removeprefix("file://")
    reader = pa.ipc.open_file(pa.memory_map(name))
    assert reader.schema.field("ids").type == pa.list_(pa.uint16(), 4)
    total = sum(r.n_tokens for r in row if r.file == row[0].file)
    seqs = SequenceReader(name)
    n = -(-total // 4)
    mask = np.concatenate([seqs.sequence(s)[1] for s in range(n)])
    assert mask.sum() == total and mask[:total].all()
    assert (np.concatenate([seqs.sequence(s)[0] for s in range(n)])[:total] == seqs.tokens(0, total)).all()


def test_empty_table(spark):
    path = scratch_path(spark, "t")
    write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, PATH, end_id=1)
    assert read_tokens(spark, path).count() == 0


def test_added_tokens_as_the_unaltered_library_has_them(spark):
    unaltered = Tokenizer.from_file(PATH)
    rnd = random.Random(5)
    some = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "a", "Bé", " ", "\n", "!", "'S", "1"]
    texts = ["a <|endoftext|> b", "a<|endoftext|>,", "", "x<|startoftext|><|endoftext|>!!"]
    texts += ["".join(rnd.choice(some) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    path = scratch_path(spark, "t")
    write_tokens(df, path, PATH, end_id=1)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in read_tokens(spark, path).collect()}
    for i, t in enumerate(texts):
        assert got[i] == [*unaltered.encode(t, add_special_tokens=False).ids, 1], t
    assert len(got[0]) == 4
