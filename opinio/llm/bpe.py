"""Byte-level BPE encoding and decoding.

Each match of the split pattern is merged on its own. A segment tree over the
piece's byte positions stores, for each node, the leftmost minimum pair rank
of its range; a merge reads the root, joins two live tokens and performs
logarithmic point updates for the merged token and its live left neighbour.
A piece of n bytes costs O(n log n), also when a text is one long piece.

Merged pieces are remembered per Python worker in a bounded memo, so a word
that occurs a million times is merged once per worker; the memo changes no
result.

Defined results: null text is the empty text (no ids, empty bytes); rows
repeat as they come; extra columns are not carried; an empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from opinio.llm.common import arrow_map, text_of, worker_memo

#: Entries that one worker's memo may hold, and the longest piece kept there.
MEMO_ENTRIES = 400_000
MEMO_PIECE = 48

#: Characters whose pieces one worker holds at a time (a longer text is held alone).
CHUNK_CHARS = 1 << 20

OUTPUTS = {
    "n_tokens": pa.int64(),
    "ids": pa.binary(),              # little-endian unsigned 32-bit
    "decoded": pa.binary(),
    "ids_sha256": pa.string(),
    "decoded_sha256": pa.string(),
}
_SPARK = {"n_tokens": "bigint", "ids": "binary", "decoded": "binary",
          "ids_sha256": "string", "decoded_sha256": "string"}


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece, by lowest rank first and leftmost among equals."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    get = ranks.get
    none = 1 << 62
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    # Leaf i: (rank of the pair that starts at byte i) * 2^32 + i.
    tree = [none] * (2 * size)
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            tree[size + i] = r << 32 | i
    for p in range(size - 1, 0, -1):
        a, b = tree[2 * p], tree[2 * p + 1]
        tree[p] = a if a < b else b
    end = list(range(1, n + 1))      # end[i]: where the live token at i ends
    before = list(range(-1, n - 1))  # before[i]: start of its left neighbour

    def put(i: int, value: int) -> None:
        p = size + i
        if tree[p] == value:
            return
        tree[p] = value
        p >>= 1
        while p:
            a, b = tree[2 * p], tree[2 * p + 1]
            if b < a:
                a = b
            if tree[p] == a:
                return
            tree[p] = a
            p >>= 1

    while tree[1] < none:
        i = tree[1] & 0xFFFFFFFF
        j = end[i]
        stop = end[i] = end[j]
        if j < n - 1 or size > j:
            put(j, none) if j < size else None
        if stop < n:
            before[stop] = i
            r = get(piece[i:end[stop]])
            put(i, none if r is None else r << 32 | i)
        else:
            put(i, none)
        h = before[i]
        if h >= 0:
            r = get(piece[h:stop])
            put(h, none if r is None else r << 32 | h)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class BatchTrees:
    """The same merges for many short pieces at once.

    Row r of the arrays is one piece and holds its segment tree; one step
    merges the root pair of every row that still has one, so the point
    updates of a level are one vector operation.
    """

    SIZES = (8, 16, 32, 64)
    NONE = np.int32(2**31 - 1)
    ROWS = 2048  # pieces merged together, so that their trees stay in the cache

    def __init__(self, ranks: dict[bytes, int]):
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for s in range(1, len(token)):
                a, b = ranks.get(token[:s]), ranks.get(token[s:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        # Open addressing: a pair's slot is the first free one from its hash on.
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.made = np.zeros(1 << self.bits, np.int32)
        todo = np.array(sorted(pairs), np.int64)
        ranks_of = np.array([pairs[k] for k in todo.tolist()], np.int32)
        slot = self._slot(todo)
        while len(todo):
            free = self.keys[slot] < 0
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            first = first[free[first]]
            self.keys[slot[first]] = todo[first]
            self.made[slot[first]] = ranks_of[first]
            rest = np.ones(len(todo), bool)
            rest[first] = False
            todo, ranks_of, slot = todo[rest], ranks_of[rest], (slot[rest] + 1) & (len(self.keys) - 1)

    def _slot(self, key):
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def leaf(self, left, right, at):
        """Tree entries of token pairs: rank and position, or none."""
        key = left.astype(np.int64) << 32 | right
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.made[slot] << 6 | at, self.NONE)
        other = (found != key) & (found >= 0)
        while other.any():
            spots = np.nonzero(other)
            slot[spots] = (slot[spots] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[spots]]
            hit = found == key[spots]
            where = tuple(x[hit] for x in spots)
            at_of = np.broadcast_to(at, key.shape)[where]
            out[where] = self.made[slot[where]] << 6 | at_of
            other[spots] = ~hit & (found >= 0)
        return out

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece (2 to 64 bytes) as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        low = 0
        for size in self.SIZES:
            own = [i for i, p in enumerate(pieces) if low < len(p) <= size]
            low = size
            for at in range(0, len(own), self.ROWS):
                part = own[at:at + self.ROWS]
                for i, ids in zip(part, self._merge([pieces[i] for i in part], size)):
                    out[i] = ids
        return out

    def _merge(self, pieces: list[bytes], size: int) -> list[bytes]:
        m, none = len(pieces), self.NONE
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(m, size)
        n = np.array([len(p) for p in pieces], np.int32)
        spot = np.arange(size, dtype=np.int32)
        token = self.byte[raw]
        tree = np.full((m, 2 * size), none, np.int32)
        first = self.leaf(token[:, :-1], token[:, 1:], spot[:-1])
        tree[:, size:-1] = np.where(spot[None, 1:] < n[:, None], first, none)
        half = size
        while half > 1:
            half //= 2
            tree[:, half:2 * half] = np.minimum(tree[:, 2 * half:4 * half:2], tree[:, 2 * half + 1:4 * half:2])
        after = np.tile(spot + 1, (m, 1))   # start of the right neighbour
        before = np.tile(spot - 1, (m, 1))  # start of the left neighbour
        rows = np.flatnonzero(tree[:, 1] < none)
        while len(rows):
            root = tree[rows, 1]
            i = root & 63
            j = after[rows, i]
            k = after[rows, j]
            h = before[rows, i]
            token[rows, i] = root >> 6
            token[rows, j] = -1
            after[rows, i] = k
            tree[rows, size + j] = none
            right, left = k < n[rows], h >= 0
            r, at, to = rows[right], i[right], k[right]
            before[r, to] = at
            tree[rows, size + i] = none
            tree[r, size + at] = self.leaf(token[r, at], token[r, to], at)
            r, at, of = rows[left], i[left], h[left]
            tree[r, size + of] = self.leaf(token[r, of], token[r, at], of)
            spots = [size + i, size + j, size + np.where(left, h, i)]
            while spots[0][0] > 1:
                spots = [p >> 1 for p in spots]
                for p in spots:
                    tree[rows, p] = np.minimum(tree[rows, 2 * p], tree[rows, 2 * p + 1])
            rows = rows[tree[rows, 1] < none]
        live = (token >= 0) & (spot < n[:, None])
        ids = token[live].astype("<u4").tobytes()
        stops = (4 * np.cumsum(live.sum(1))).tolist()
        return [ids[a:b] for a, b in zip([0, *stops], stops)]


class Coder:
    """Encoder and decoder of one rank table, with the worker's memo."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.trees = BatchTrees(ranks)
        self.table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token
        self.memo: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        """Add the ids of pieces that the memo lacks."""
        short, names = [], []
        for p in pieces:
            raw = p.encode("utf-8", "replace")
            whole = self.ranks.get(raw)
            if whole is not None:
                self.memo[p] = struct.pack("<I", whole)
            elif len(raw) <= self.trees.SIZES[-1]:
                short.append(raw)
                names.append(p)
            else:
                ids = merge_piece(raw, self.ranks)
                self.memo[p] = struct.pack(f"<{len(ids)}I", *ids)
        self.memo.update(zip(names, self.trees.merge(short)))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        memo = self.memo
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        found = [self.find(t) for t in texts]
        new = set().union(*found).difference(memo)
        self._learn(new)
        out = [b"".join(map(memo.__getitem__, pieces)) for pieces in found]
        for p in new:
            if len(p) > MEMO_PIECE:
                del memo[p]
        return out

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the tokens, in order."""
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def by_size(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Runs of texts of about ``most`` characters, or one longer text."""
    run: list[str] = []
    held = 0
    for t in texts:
        if run and held + len(t) > most:
            yield run
            run, held = [], 0
        run.append(t)
        held += len(t)
    if run:
        yield run


_CODERS: dict[str, Coder] = worker_memo(__name__, {})  # per Python worker


def _coder(key: str, ranks, pattern: str) -> Coder:
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(ranks.value, pattern)
    return _CODERS[key]


def bpe(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
        text_col: str = "text", outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """Encode every whole text, then decode its ids: ``id_col`` and ``outputs``.

    The rank table (a vocabulary file, bounded by its format at some tens of
    thousands of entries) is read on the driver and broadcast.
    """
    spark = docs.sparkSession
    ranks = load_ranks(ranks_path)
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    shared = spark.sparkContext.broadcast(ranks)
    names = tuple(outputs)
    want_decoded = any(x.startswith("decoded") for x in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(key, shared, pattern)
        for batch in batches:
            made: dict[str, list] = {x: [] for x in names}
            texts = batch.column(1).to_pylist()
            for ids in (x for run in by_size(texts) for x in coder.encode_all(run)):
                row = {"n_tokens": len(ids) // 4, "ids": ids}
                if "ids_sha256" in made:
                    row["ids_sha256"] = hashlib.sha256(ids).hexdigest()
                if want_decoded:
                    row["decoded"] = raw = coder.decode(ids)
                    if "decoded_sha256" in made:
                        row["decoded_sha256"] = hashlib.sha256(raw).hexdigest()
                for x in names:
                    made[x].append(row[x])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(made[x], OUTPUTS[x]) for x in names)], [id_col, *names])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {kind}", *(f"`{x}` {_SPARK[x]}" for x in names)])
    return arrow_map(docs.select(id_col, text_of(text_col).alias("_text")), run, schema)
