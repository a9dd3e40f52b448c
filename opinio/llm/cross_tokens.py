"""Cross-tokenizer alignment: which tokens of two tokenizers cover each other.

Every text (with a space put before it) is encoded by a byte-level BPE (A) and
a piece model with byte fallback (B). Byte offsets where tokens of both end
cut a document into groups; an occurrence of A and one of B are linked when
their byte ranges overlap; a pair of ids counts the documents that hold it
linked. The counts of all pairs are gathered as follows.

1. Texts are encoded once; the ids are written to the shared folder.
2. First pass: each task aligns its documents and gives the distinct linked
   pairs that it saw; Spark makes them distinct over all tasks.
3. A minimal perfect hash of the pairs: they fall into segments of about
   ``SEGMENT`` pairs by a 64-bit hash, and a task gives each segment a cascade
   of bit arrays, where a pair that is alone in its place of a level has the
   rank of that bit as its number (others go to the next, smaller level). The
   pairs are stored at their numbers, so a look-up verifies its key.
4. Dense count vectors, one per segment and task and indexed by the hash, are
   summed in a tree: ``FAN`` vectors of a segment at a time.
5. Second pass: the documents are aligned again and the links looked up.

Scale: documents are never shuffled or grouped, so a hot source or a much
repeated text is no hot key. What moves are distinct pairs per task and count
vectors, both of the size of the vocabularies' common pairs, not of the
corpus. The index is a table of the shared folder that workers read by
slabs of at most ``SLAB`` pairs, a few of which they keep, so no worker holds
more at any size. Only the highest count of each A id is sent to all (one
number per vocabulary entry, bounded by the tokenizer file).

Defined results: a null or empty text, and one whose tokens' joined bytes
differ from space and text in A or B, has no tokens: all numbers are zero and
the groups are the empty string; every input row gives one row and counts as
a document of its own, also repeated rows and null ids; extra columns are not
carried; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import arrow_map, distinct_names, materialise, text_of
from opinio.session import scratch_path

#: Pairs that a segment of the hash holds on average.
SEGMENT = 1 << 16
#: Pairs of the segments that are looked up at a time, and such slabs that a worker keeps.
SLAB = 1 << 22
SLABS = 2
#: Places a pair in a level of the hash.
GAMMA = 2.0
#: Distinct pairs, or counts, that a task holds before it gives them.
HELD = 1 << 22
#: Vectors that one node of the summing tree adds.
FAN = 16
#: Bytes of texts or packed ids that are worked on at a time (a longer text alone).
CHUNK_BYTES = 1 << 19


#: Fixed value: the split of byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# --- tokens -----------------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, and its byte:
    printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def id_kind(n_ids: int) -> str:
    """Little-endian unsigned integers that hold every id of a vocabulary."""
    return "<u2" if n_ids <= 1 << 16 else "<u4"


def byte_ranks(config: str) -> dict[bytes, int] | None:
    """The tokens of a byte-level BPE and their ids, if the ids are in the order
    of the merges and nothing but the usual split comes before them (None else)."""
    c = json.loads(config)
    model, split = c["model"], c.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and not c.get("normalizer") and split.get("type") == "ByteLevel"
             and split.get("use_regex", True) and not split.get("add_prefix_space") and not model.get("dropout")
             and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))
    if not plain:
        return None
    vocab, letters = model["vocab"], byte_letters()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab.get("".join(m), -1) for m in merges]
    if made != sorted(made) or len({*made}) != len(made) or not all(x in vocab for x in letters):
        return None
    if max(vocab[x] for x in letters) >= min(made, default=1 << 32):
        return None
    merged = set(made)
    return {bytes(letters[ch] for ch in t): i for t, i in vocab.items() if t in letters or i in merged}


class Pair:
    """Two tokenizers, from the contents of their files."""

    def __init__(self, a_config: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_config)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        letters = byte_letters()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        # The same ids from a library that needs a quarter of the time, where it can give them.
        self.ranked = None
        if (ranks := byte_ranks(a_config)) is not None:
            import tiktoken

            self.ranked = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
            self.a = None  # two copies of the vocabulary would only take memory
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]

        self.a_kind, self.b_kind = id_kind(len(self.a_bytes)), id_kind(len(self.b_bytes))

    def _a_ids(self, texts: list[str]) -> Iterator[list[int]]:
        if self.ranked is not None:
            return map(self.ranked.encode_ordinary, texts)
        return (e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False))

    def encode_all(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Packed ids of each text in A and B; empty where the bytes of either
        differ from the text."""
        kept = [t for t in texts if t]
        a_ids = self._a_ids([" " + t for t in kept])
        b_ids = iter(self.b.encode(kept, num_threads=1) if kept else [])
        for t in texts:
            if not t:
                yield b"", b""
                continue
            a, b, raw = next(a_ids), next(b_ids), b" " + t.encode()
            if b"".join([self.a_bytes[i] for i in a]) == raw == b"".join([self.b_bytes[i] for i in b]):
                yield np.array(a, self.a_kind).tobytes(), np.array(b, self.b_kind).tobytes()
            else:
                yield b"", b""


_PAIRS: dict[str, Pair] = {}  # per Python worker


def encode_both(docs: DataFrame, a_config: str, b_model: bytes, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``a`` and ``b`` ids of every text, written to the shared folder.

    The tokenizer files are broadcast; their format bounds them to some MB.
    """
    shared = docs.sparkSession.sparkContext.broadcast((a_config, b_model))
    key = hashlib.sha256(a_config.encode() + b_model).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task its one core
        if key not in _PAIRS:
            _PAIRS.clear()
            _PAIRS[key] = Pair(*shared.value)
        for batch in batches:
            for part in _parts(batch):
                ids = list(_PAIRS[key].encode_all(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([x[k] for x in ids], pa.binary())
                                                                    for k in (0, 1))], ["id", "a", "b"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return materialise(arrow_map(rows, run, f"id {kind}, a binary, b binary"), "cross_ids")


def _parts(batch: pa.RecordBatch, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes in column 1, or one longer row."""
    start = held = 0
    for i, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if batch.num_rows > start:
        yield batch.slice(start)


# --- alignment --------------------------------------------------------------

class Layout:
    """The tokens of several documents on one line of bytes.

    Both tokenizers cover each document's bytes without gaps, so document ends
    are cuts, and every stretch between neighbouring token ends belongs to one
    token of each: it is their link.
    """

    def __init__(self, a_lists: list[bytes], b_lists: list[bytes], a_len: np.ndarray, b_len: np.ndarray):
        a_kind, b_kind = (np.dtype(id_kind(len(x))) for x in (a_len, b_len))
        self.a = np.frombuffer(b"".join(a_lists), a_kind).astype(np.int64)
        self.b = np.frombuffer(b"".join(b_lists), b_kind).astype(np.int64)
        self.n_a = np.array([len(x) // a_kind.itemsize for x in a_lists], np.int64)
        self.n_b = np.array([len(x) // b_kind.itemsize for x in b_lists], np.int64)
        self.a_end, self.b_end = np.cumsum(a_len[self.a]), np.cumsum(b_len[self.b])
        ends = np.sort(np.concatenate([self.a_end, self.b_end]), kind="stable")  # two runs, merged
        self.ends = ends[np.append(ends[1:] != ends[:-1], True)[:len(ends)]]
        self.i = np.searchsorted(self.a_end, self.ends)   # of each link, its A token
        self.j = np.searchsorted(self.b_end, self.ends)   # and its B token
        self.cuts = (self.a_end[self.i] == self.ends) & (self.b_end[self.j] == self.ends)
        self.doc = np.repeat(np.arange(len(self.n_a)), self.n_a)[self.i]  # and its document

    def pairs(self) -> np.ndarray:
        """The id pair of each link: A id in the high 32 bits."""
        return self.a[self.i] << 32 | self.b[self.j]

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums of link values by document."""
        return np.bincount(self.doc, weights=values, minlength=len(self.n_a)).astype(np.int64)

    def doc_pairs(self) -> np.ndarray:
        """Each pair as often as documents hold it."""
        order = np.lexsort((pairs := self.pairs(), self.doc))
        pairs, doc = pairs[order], self.doc[order]
        return pairs[np.append(True, (pairs[1:] != pairs[:-1]) | (doc[1:] != doc[:-1]))[:len(pairs)]]

    def groups(self, words: list[str], b_from: int) -> Iterator[str]:
        """Each document's groups as ``a1,a2|b1;a3|b2,b3``.

        ``words`` holds each A id with "," and with "|", then, from ``b_from``
        on, each B id with "," and with ";".
        """
        cut_ends = self.ends[self.cuts]
        a_group, b_group = np.searchsorted(cut_ends, self.a_end), np.searchsorted(cut_ends, self.b_end)
        groups = np.arange(len(cut_ends) + 1)
        a_before, b_before = np.searchsorted(a_group, groups), np.searchsorted(b_group, groups)  # tokens before each
        a_word, b_word = 2 * self.a, 2 * self.b + b_from
        a_word[a_before[1:] - 1] += 1  # last of its group
        b_word[b_before[1:] - 1] += 1
        line = np.empty(len(self.a) + len(self.b), np.int64)
        line[np.arange(len(self.a)) + b_before[a_group]] = a_word
        line[np.arange(len(self.b)) + a_before[b_group + 1]] = b_word
        stops = np.cumsum(self.n_a + self.n_b).tolist()
        for start, stop in zip([0, *stops], stops):
            yield "".join([words[w] for w in line[start:stop].tolist()])[:-1]


def _layouts(batches: Iterator[pa.RecordBatch], a_len: np.ndarray,
             b_len: np.ndarray) -> Iterator[tuple[pa.RecordBatch, Layout]]:
    for batch in batches:
        for part in _parts(batch):
            yield part, Layout(part.column(1).to_pylist(), part.column(2).to_pylist(), a_len, b_len)


# --- minimal perfect hash ---------------------------------------------------

def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixing bijection."""
    x = x.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def segment_of(pairs: np.ndarray, bits: int) -> np.ndarray:
    """Of 2^bits segments, the one that each pair is in."""
    if not bits:
        return np.zeros(len(pairs), np.int64)
    return (_mix(pairs, 0) >> np.uint64(64 - bits)).astype(np.int64)


def _place(pairs: np.ndarray, level, size) -> np.ndarray:
    """Of ``size`` places, each pair's in a level."""
    high = _mix(pairs, level + 1) >> np.uint64(32)
    return (high * np.asarray(size).astype(np.uint64) >> np.uint64(32)).astype(np.int64)


def build_segment(pairs: np.ndarray) -> tuple[list[int], bytes, np.ndarray]:
    """Words of each level, all levels' bits, and the pairs in the order of
    their numbers. Levels have whole 64-bit words."""
    sizes, bits, ordered, level = [], [], [], 0
    while len(pairs):
        words = max(1, -(-int(GAMMA * len(pairs)) // 64))
        at = _place(pairs, level, 64 * words)
        alone = np.bincount(at, minlength=64 * words) == 1
        mine = alone[at]
        ordered.append(pairs[mine][np.argsort(at[mine])])
        sizes.append(words)
        bits.append(np.packbits(alone, bitorder="little").tobytes())
        pairs, level = pairs[~mine], level + 1
    return sizes, b"".join(bits), np.concatenate(ordered) if ordered else np.empty(0, np.int64)


class Slab:
    """Consecutive segments: numbers of pairs from 0 on, stored pairs, counts."""

    def __init__(self, first: int, segments: list[dict], counted: bool):
        self.first = first
        levels = max((len(s["sizes"]) for s in segments), default=0)
        self.words = np.zeros((len(segments), levels), np.int64)   # 64-bit words of each level
        self.base = np.zeros((len(segments), levels), np.int64)    # and where it begins
        at = 0
        for k, s in enumerate(segments):
            for level, words in enumerate(s["sizes"]):
                self.words[k, level], self.base[k, level] = words, at
                at += words
        self.bits = np.frombuffer(b"".join(s["bits"] for s in segments), "<u8")
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)])
        self.starts = np.cumsum([0, *(s["n"] for s in segments)])  # first number of each segment
        self.pairs = np.frombuffer(b"".join(s["pairs"] for s in segments), "<i8")
        self.counts = np.frombuffer(b"".join(s["counts"] for s in segments), "<i8") if counted else None

    def numbers(self, pairs: np.ndarray, segments: np.ndarray) -> np.ndarray:
        """The number of each pair; -1 for one that the hash was not made of."""
        out = np.full(len(pairs), -1, np.int64)
        todo = np.arange(len(pairs))
        row = segments - self.first
        for level in range(self.words.shape[1]):
            todo = todo[self.words[row[todo], level] > 0]
            if not len(todo):
                break
            key, own = pairs[todo], row[todo]
            at = _place(key, level, 64 * self.words[own, level])
            word = self.base[own, level] + (at >> 6)
            bit = (at & 63).astype(np.uint64)
            hit = self.bits[word] >> bit & np.uint64(1) > 0
            below = np.bitwise_count(self.bits[word] & (np.uint64(1) << bit) - np.uint64(1)).astype(np.int64)
            out[todo[hit]] = (self.rank[word] + below)[hit]
            todo = todo[~hit]
        found = out >= 0
        out[found] = np.where(self.pairs[out[found]] == pairs[found], out[found], -1)
        return out


class Index:
    """The hash in the shared folder, read by slabs; ``sizes[s]`` pairs in segment s."""

    def __init__(self, path: str, bits: int, sizes: list[int], counted: bool = False):
        self.path, self.bits, self.counted = path, bits, counted
        total = np.cumsum([0, *sizes])
        self.edges = [0]  # first segment of each slab
        for s in range(1, len(sizes)):
            if total[s + 1] - total[self.edges[-1]] > SLAB:
                self.edges.append(s)
        self.edges.append(len(sizes))
        self.kept: OrderedDict[int, Slab] = OrderedDict()

    def _slab(self, k: int) -> Slab:
        if k not in self.kept:
            while len(self.kept) >= SLABS:
                self.kept.popitem(last=False)
            system, folder = pafs.FileSystem.from_uri(self.path if "://" in self.path else f"file://{self.path}")
            empty = {"sizes": [], "bits": b"", "n": 0, "pairs": b"", "counts": b""}
            rows = []
            for s in range(self.edges[k], self.edges[k + 1]):
                files = system.get_file_info(pafs.FileSelector(f"{folder}/segment={s}", allow_not_found=True))
                tables = [pq.read_table(f.path, filesystem=system, partitioning=None).to_pylist()
                          for f in files if f.path.endswith(".parquet")]
                rows.append(next((t[0] for t in tables if t), empty))
            self.kept[k] = Slab(self.edges[k], rows, self.counted)
        self.kept.move_to_end(k)
        return self.kept[k]

    def find(self, pairs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, Slab]]:
        """By slab: places in ``pairs``, numbers in the slab, the slab."""
        segments = segment_of(pairs, self.bits)
        order = np.argsort(segments, kind="stable")
        stops = np.searchsorted(segments[order], self.edges[1:])
        for k, (start, stop) in enumerate(zip([0, *stops], stops)):
            if stop > start:
                at = order[start:stop]
                slab = self._slab(k)
                yield at, slab.numbers(pairs[at], segments[at]), slab

    def counts(self, pairs: np.ndarray) -> np.ndarray:
        """The count of each pair; 0 for one that is not in the index."""
        out = np.zeros(len(pairs), np.int64)
        for at, numbers, slab in self.find(pairs):
            out[at] = np.where(numbers >= 0, slab.counts[numbers], 0)
        return out


# --- the passes -------------------------------------------------------------

def distinct_pairs(ids: DataFrame, a_len: np.ndarray, b_len: np.ndarray) -> DataFrame:
    """Every linked ``pair`` once, written to the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, new, held = np.empty(0, np.int64), [], 0
        for _, layout in _layouts(batches, a_len, b_len):
            new.append(np.unique(layout.pairs()))
            held += len(new[-1])
            if held > HELD:
                seen, new, held = np.unique(np.concatenate([seen, *new])), [], 0
                if len(seen) > HELD:
                    yield from _rows(seen)
                    seen = np.empty(0, np.int64)
        yield from _rows(np.unique(np.concatenate([seen, *new])))

    def _rows(pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
        for s in range(0, len(pairs), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[s:s + (1 << 16)])], ["pair"])

    return materialise(arrow_map(ids, run, "pair bigint").distinct(), "cross_pairs")


HASH = "n bigint, sizes array<bigint>, bits binary, pairs binary, segment bigint"


def build_index(pairs: DataFrame, bits: int, path: str) -> list[int]:
    """Write the hash of distinct pairs under ``path``, a folder a segment;
    give the number of pairs in each."""
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = segment_of(batch.column(0).to_numpy(), bits)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own)], ["pair", "segment"])

    def build(table: pa.Table) -> pa.Table:
        sizes, raw, ordered = build_segment(table.column("pair").to_numpy())
        return pa.table({"segment": table.column("segment")[:1], "n": pa.array([len(ordered)], pa.int64()),
                         "sizes": pa.array([sizes], pa.list_(pa.int64())), "bits": pa.array([raw], pa.binary()),
                         "pairs": pa.array([ordered.astype("<i8").tobytes()], pa.binary())})

    rows = (arrow_map(pairs, segments, "pair bigint, segment bigint").groupBy("segment")
            .applyInArrow(build, "segment bigint, n bigint, sizes array<bigint>, bits binary, pairs binary"))
    rows.write.partitionBy("segment").parquet(path)
    sizes = [0] * (1 << bits)
    for r in pairs.sparkSession.read.schema(HASH).parquet(path).select("segment", "n").collect():  # one row a segment
        sizes[r.segment] = r.n
    return sizes


VECTOR = "segment bigint, branch bigint, counts binary"


def count_documents(ids: DataFrame, index: Index, a_len: np.ndarray, b_len: np.ndarray, sizes: list[int]) -> DataFrame:
    """Per segment, the dense vector of document counts, summed in a tree."""
    path, bits = index.path, index.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = Index(path, bits, sizes), TaskContext.get().partitionId()
        vectors: dict[int, np.ndarray] = {}
        held = 0
        for _, layout in _layouts(batches, a_len, b_len):
            for _, numbers, slab in own.find(layout.doc_pairs()):
                found, counts = np.unique(numbers, return_counts=True)
                where = np.searchsorted(slab.starts, found, "right") - 1
                stops = np.searchsorted(where, np.arange(len(slab.starts)))
                for k in np.unique(where).tolist():
                    if slab.first + k not in vectors:
                        size = int(slab.starts[k + 1] - slab.starts[k])
                        vectors[slab.first + k] = np.zeros(size, np.int64)
                        held += size
                    piece = slice(stops[k], stops[k + 1])
                    vectors[slab.first + k][found[piece] - slab.starts[k]] += counts[piece]
            if held > HELD:
                yield from _vectors(vectors, part)
                vectors, held = {}, 0
        yield from _vectors(vectors, part)

    def _vectors(vectors: dict[int, np.ndarray], part: int) -> Iterator[pa.RecordBatch]:
        for s, counts in vectors.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([part], pa.int64()),
                                              pa.array([counts.astype("<i8").tobytes()], pa.binary())],
                                             ["segment", "branch", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of neighbouring vectors of one segment and branch."""
        last, total = None, np.empty(0, np.int64)
        for batch in batches:
            for s, b, counts in zip(*(c.to_pylist() for c in batch.columns)):
                vector = np.frombuffer(counts, "<i8")
                if (s, b) == last:
                    total = total + vector
                    continue
                if last is not None:
                    yield from _vectors({last[0]: total}, last[1])
                last, total = (s, b), vector
        if last is not None:
            yield from _vectors({last[0]: total}, last[1])

    vectors = arrow_map(ids, run, VECTOR)
    tasks = max(1, ids.rdd.getNumPartitions())
    while tasks > 1:
        tasks = -(-tasks // FAN)
        vectors = vectors.withColumn("branch", F.floor(F.col("branch") / FAN))
        vectors = arrow_map(vectors.repartition("segment", "branch").sortWithinPartitions("segment", "branch"),
                            add, VECTOR)
    return vectors.select("segment", "counts")


def highest_counts(index: DataFrame, n_ids: int) -> np.ndarray:
    """The highest count of each A id (0 for one without links)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(n_ids, np.int64)
        for batch in batches:
            for pairs, counts in zip(*(c.to_pylist() for c in batch.columns)):
                np.maximum.at(best, np.frombuffer(pairs, "<i8") >> 32, np.frombuffer(counts, "<i8"))
        some = np.flatnonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(best[some])], ["a", "best"])

    out = np.zeros(n_ids, np.int64)
    rows = arrow_map(index.select("pairs", "counts"), run, "a bigint, best bigint").groupBy("a").agg(F.max("best"))
    for a, best in rows.collect():  # at most one row a vocabulary entry
        out[a] = best
    return out


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Per document: id, ``NUMBERS`` and ``groups``; and the index of pair
    counts (``segment``, ``pairs`` and ``counts`` as packed 64-bit integers).
    """
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as f:
        a_config = f.read()
    with open(b_path, "rb") as f:
        b_model = f.read()
    tokens = Pair(a_config, b_model)
    a_len, b_len = (np.array([len(x) for x in t], np.int64) for t in (tokens.a_bytes, tokens.b_bytes))
    ids = encode_both(docs, a_config, b_model, id_col, text_col)

    pairs = distinct_pairs(ids, a_len, b_len)
    bits = (max(1, -(-pairs.count() // SEGMENT)) - 1).bit_length()
    path = scratch_path(spark, "cross_hash")
    sizes = build_index(pairs, bits, path)
    counts = count_documents(ids, Index(path, bits, sizes), a_len, b_len, sizes)
    counted = scratch_path(spark, "cross_counts")
    spark.read.schema(HASH).parquet(path).join(counts, "segment").write.partitionBy("segment").parquet(counted)
    index = spark.read.schema(f"{HASH}, counts binary").parquet(counted)
    best = spark.sparkContext.broadcast(highest_counts(index, len(a_len)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(counted, bits, sizes, counted=True)
        words = [f"{i}{c}" for n, marks in ((len(a_len), ",|"), (len(b_len), ",;")) for i in range(n) for c in marks]
        for part, layout in _layouts(batches, a_len, b_len):
            unique, back = np.unique(layout.pairs(), return_inverse=True)
            found = own.counts(unique)[back]
            numbers = [layout.n_a, layout.n_b, layout.per_doc(layout.cuts), layout.per_doc(np.ones(len(found))),
                       layout.per_doc(found == best.value[layout.a[layout.i]])]
            # Exact sums: a float would round beyond 2^53.
            sums = np.zeros(len(layout.n_a), np.int64)
            np.add.at(sums, layout.doc, found)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *map(pa.array, [*numbers, sums]), pa.array(list(layout.groups(words, 2 * len(a_len))), pa.string())],
                ["id", *NUMBERS, "groups"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = arrow_map(ids, run, f"id {kind}, {', '.join(f'{n} bigint' for n in NUMBERS)}, groups string")
    names = distinct_names(id_col, *NUMBERS, "groups")
    return rows.toDF(*names), index
