"""Token ids in Arrow files of equal-length sequences.

Format: each part is one Arrow IPC file (stream batches plus a footer) whose
batches hold two fixed-size-list columns, ``ids`` (unsigned integers, 16 bits
where the vocabulary allows) and ``mask`` (true for a token, false for the
padding after the last one). Documents follow one another in ascending id
order, each closed by the end id, and are cut into sequences of ``seq_len``
ids; sequence s of a part is row ``s % rows`` of batch ``s // rows``, so any
sequence or token range is read by position, without copying on a memory map.
An ``index`` table (Parquet) has one row per document: part, file, offset in
the part, number of ids.

A task writes its file under a name of its own and the index rows that name
it are committed by Spark, so a lost or repeated task leaves at most a file
that no index row names.

Defined results: null text is the empty text (the end id only); null ids come
first; rows with one id are ordered by text and stay separate rows; an empty
table gives an empty index. Extra columns are not carried.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import uuid
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinio.llm.bpe import by_size
from opinio.llm.common import arrow_map, text_of

#: Entries that one worker's memo of words may hold, and the longest word kept.
MEMO_ENTRIES = 700_000
MEMO_WORD = 48

#: ASCII marks that the tokenizer separates from a letter before them.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


#: Normalisers that leave an NFC, lower-case word of letters as it is, and the split that keeps it whole.
KEEPS = frozenset({"NFC", "Replace", "Lowercase"})
LETTERS = r"[\p{L}]+"


def bare_config(config: str) -> str | None:
    """The configuration without what does nothing to lower-case words of
    letters in NFC; none where it is not known to do nothing."""
    c = json.loads(config)
    before, split = c.get("normalizer") or {}, c.get("pre_tokenizer") or {}
    steps = split.get("pretokenizers", [])
    known = (before.get("type") == "Sequence" and {n["type"] for n in before["normalizers"]} <= KEEPS
             and all(n["type"] != "Replace" or n["pattern"] == {"Regex": r"\s+"} for n in before["normalizers"])
             and [x["type"] for x in steps] == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
             and LETTERS in steps[0]["pattern"].get("Regex", "").split("|")
             and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"])
    return json.dumps({**c, "normalizer": None, "pre_tokenizer": steps[1], "added_tokens": []}) if known else None


def _is_plain(word: str) -> bool:
    """Letters alone (of scripts whose letters all Unicode versions agree on), lower-case, in NFC."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0530" and is_normalized("NFC", word)) and word == word.lower()


class WordEncoder:
    """A tokenizer of the ``tokenizers`` library with a memo of its words.

    The tokenizer drops white space and never joins what it separates, so the
    ids of a text are those of its parts between ASCII blanks and newlines.
    With ``plain``, the strings of added tokens in a text are ordinary text;
    without, they are their ids, as the library has it. They hold no blanks.
    """

    def __init__(self, config: str, id_bytes: int, plain: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(config)
        self.tokenizer.encode_special_tokens = plain
        bare = bare_config(config)
        #: The same merges without normaliser and split, for words that neither changes.
        self.bare = None if bare is None else Tokenizer.from_str(bare)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [] if plain else [t.content.lower() for t in added]
        self.kind = np.dtype(f"<u{id_bytes}")
        self.code = "H" if id_bytes == 2 else "I"
        self.memo: dict[str, bytes] = {}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        memo = self.memo
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        found = [t.replace("\n", " ").split(" ") for t in texts]
        new = set().union(*found).difference(memo)
        made = {word: self._parts(word) for word in new}
        parts = list({p for pair in made.values() for p in pair}.difference(memo))
        ids = {}
        plain = [p for p in parts if self.bare is not None and _is_plain(p)]
        rest = parts if not plain else list(set(parts).difference(plain))
        for tokenizer, own in ((self.bare, plain), (self.tokenizer, rest)):
            if own:
                ids.update((p, array(self.code, enc.ids).tobytes())
                           for p, enc in zip(own, tokenizer.encode_batch_fast(own, add_special_tokens=False)))
        for word, (stem, tail) in made.items():
            memo[word] = (ids.get(stem) or memo.get(stem, b"")) + (ids.get(tail) or memo.get(tail, b""))
        memo.update(ids)
        out = [b"".join(map(memo.__getitem__, words)) for words in found]
        for word in new.union(parts):
            if len(word) > MEMO_WORD:
                del memo[word]
        return out

    def _parts(self, word: str) -> tuple[str, str]:
        """Two parts whose ids follow one another as the word's ids do: the
        tokenizer separates a (Latin-1) letter from a mark after it, but for
        "'", and lowers ASCII letters."""
        if self.added and any(t in word.lower() for t in self.added):
            return word, ""
        stem = word.rstrip(MARKS)
        if len(stem) == len(word) or not stem or not stem[-1].isalpha() or stem[-1] > "\xff":
            return word.lower() if word.isascii() else word, ""
        return stem.lower() if stem.isascii() else stem, word[len(stem):]


_ENCODERS: dict[str, WordEncoder] = {}  # per Python worker


def _encoder(key: str, config, id_bytes: int) -> WordEncoder:
    if key not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task its one core
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(config.value, id_bytes, plain=False)
    return _ENCODERS[key]


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


class SequenceWriter:
    """Packs id bytes into sequences and writes full batches of them."""

    def __init__(self, sink, seq_len: int, rows: int, kind: np.dtype):
        self.seq_len, self.rows, self.kind = seq_len, rows, kind
        self.type = pa.uint16() if kind.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(self.type, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.held = bytearray()
        self.size = seq_len * rows * kind.itemsize

    def add(self, ids: bytes) -> None:
        self.held += ids
        while len(self.held) >= self.size:
            self._batch(bytes(self.held[:self.size]), self.seq_len * self.rows)
            del self.held[:self.size]

    def _batch(self, raw: bytes, tokens: int) -> None:
        ids = np.frombuffer(raw, self.kind)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(ids, self.type), self.seq_len),
                 pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(ids)) < tokens), self.seq_len)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.held:
            tokens = len(self.held) // self.kind.itemsize
            padded = -(-tokens // self.seq_len) * self.seq_len * self.kind.itemsize
            self._batch(bytes(self.held).ljust(padded, b"\0"), tokens)
        self.writer.close()


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", seq_len: int = 2048, rows: int = 128) -> None:
    """Encode every whole text and write the files and index under ``path``.

    One range shuffle by id orders the texts; parts are numbered in that
    order. The tokenizer file is read on the driver and broadcast.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        config = f.read()
    from tokenizers import Tokenizer

    id_bytes = 2 if max(Tokenizer.from_str(config).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    key = hashlib.sha256(config.encode()).hexdigest()
    shared = spark.sparkContext.broadcast(config)
    files = f"{path}/tokens"
    system, folder = _file_system(files)
    system.create_dir(folder, recursive=True)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, shared, id_bytes)
        end = np.array([end_id], encoder.kind).tobytes()
        part = TaskContext.get().partitionId()
        system, folder = _file_system(files)
        sink = writer = None
        name = f"part-{part:06d}-{uuid.uuid4().hex}.arrow"
        offset = 0
        for batch in batches:
            if writer is None and batch.num_rows:
                sink = system.open_output_stream(posixpath.join(folder, name), compression=None)
                writer = SequenceWriter(sink, seq_len, rows, encoder.kind)
            offsets, counts = [], []
            for texts in by_size(batch.column(1).to_pylist()):
                for ids in encoder.encode_all(texts):
                    writer.add(ids)
                    writer.add(end)
                    counts.append(len(ids) // id_bytes + 1)
                    offsets.append(offset)
                    offset += counts[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * batch.num_rows, pa.int32()), pa.array([name] * batch.num_rows, pa.string()),
                 pa.array(offsets, pa.int64()), pa.array(counts, pa.int64()), batch.column(0)],
                ["part", "file", "offset", "n_tokens", id_col])
        if writer is not None:
            writer.close()
            sink.close()

    ordered = (docs.select(id_col, text_of(text_col).alias("_text"))
               .repartitionByRange(F.col(id_col)).sortWithinPartitions(id_col, "_text"))
    arrow_map(ordered, run, f"part int, file string, offset bigint, n_tokens bigint, `{id_col}` {kind}"
              ).write.parquet(f"{path}/index")


class SequenceReader:
    """Token ranges of one file, by position."""

    def __init__(self, uri: str):
        system, name = _file_system(uri)
        local = isinstance(system, pafs.LocalFileSystem)
        self.source = pa.memory_map(name) if local else system.open_input_file(name)
        self.reader = pa.ipc.open_file(self.source)
        self.seq_len = self.reader.schema.field("ids").type.list_size
        self.batches: dict[int, np.ndarray] = {}
        first = self.reader.get_batch(0)
        self.per_batch = first.num_rows * self.seq_len  # all batches but the last are full

    def _values(self, k: int) -> np.ndarray:
        if k not in self.batches:
            if len(self.batches) > 3:
                self.batches.clear()
            batch = self.reader.get_batch(k)
            self.batches[k] = batch.column(0).values.to_numpy(zero_copy_only=True)
        return self.batches[k]

    def tokens(self, offset: int, count: int) -> np.ndarray:
        """Ids ``offset`` to ``offset + count`` of the file."""
        out = []
        while count:
            k, at = divmod(offset, self.per_batch)
            part = self._values(k)[at:at + count]
            if not len(part):
                raise ValueError("the file ends before the range")
            out.append(part)
            offset, count = offset + len(part), count - len(part)
        return out[0] if len(out) == 1 else np.concatenate(out or [np.empty(0, np.uint32)])

    def sequence(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequence ``s``: its ids and its mask."""
        k, row = divmod(s, self.per_batch // self.seq_len)
        mask = self.reader.get_batch(k).column(1)[row].values
        return self._values(k)[row * self.seq_len:(row + 1) * self.seq_len], mask.to_numpy(zero_copy_only=False)

    def close(self) -> None:
        self.batches.clear()
        self.source.close()


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index with ``start``, the ids of all documents before the row's.

    The running sum is over parts (one row each), not over documents.
    """
    index = spark.read.parquet(f"{path}/index")
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (index.join(bases, index["part"] == bases["_part"])
            .withColumn("start", F.col("_base") + F.col("offset")).drop("_part", "_base"))


READS = {"ids": ("binary", pa.binary()), "ids_crc32": ("bigint", pa.int64())}


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id",
                outputs: tuple[str, ...] = ("ids",)) -> DataFrame:
    """Every document read back from the files: index columns and ``outputs``.

    ``ids`` are little-endian unsigned 32-bit integers; ``ids_crc32`` is their
    checksum.
    """
    index = read_index(spark, path).select(id_col, "start", "n_tokens", "file", "offset")
    kind = index.schema[id_col].dataType.simpleString()
    files = f"{path}/tokens"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, reader = None, None
        for batch in batches:
            made: dict[str, list] = {x: [] for x in outputs}
            for file, offset, count in zip(*(batch.column(i).to_pylist() for i in (3, 4, 2))):
                if file != name:
                    if reader is not None:
                        reader.close()
                    name, reader = file, SequenceReader(posixpath.join(files, file))
                raw = reader.tokens(offset, count).astype("<u4").tobytes()
                for x in outputs:
                    made[x].append(raw if x == "ids" else zlib.crc32(raw))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), *(pa.array(made[x], READS[x][1]) for x in outputs)],
                [id_col, "start", "n_tokens", *outputs])
        if reader is not None:
            reader.close()

    schema = ", ".join([f"`{id_col}` {kind}", "start bigint", "n_tokens bigint",
                        *(f"{x} {READS[x][0]}" for x in outputs)])
    return arrow_map(index, run, schema)
