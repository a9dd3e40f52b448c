"""N-gram Jaccard join by signature trees.

Documents link when their sets of five-word shingles have a Jaccard
similarity of at least 0.8; the result is each document's component. Nothing
is sampled: every link between different sets is found, except that links
inside what is already one component are not looked at.

1. Equal sets are one set, named by a digest. All shingles of all documents
   are counted in ``2^28`` hash buckets; one alone in its bucket is certain to
   be held by one set only. In the global order of shingles those come first,
   then the others by their bucket's count in three steps, so that sets meet by
   their rare shingles and common ones do not chain unlike sets to one block.
2. Two sets that link share one of the first ``n - ceil(0.8 n) + 1`` shingles
   of each in that order, and not one that is alone. Sets that share such a shingle and are near in size
   are put in one coarse block. Each task first combines its own rows of a
   shingle to one row for each run of sizes, so a shingle that a third of the
   sets hold costs a few rows a task.
3. Each block's sets are brought together once. A signature tree over them
   holds OR-combined shingle bitmaps and size ranges; a dual traversal from the
   root prunes node pairs whose largest possible overlap is too small, and node
   pairs that are one component already. What reaches the leaves is compared
   shingle by shingle.
4. In a corpus of far more shingles than buckets few are known to be alone, and
   unlike sets may be chained to a large block. Blocks of more than ``SETS`` sets (or ``TOKENS`` shingles) are formed
   anew with an exact count of their shingles. One that is still as large is
   cut into parts in order of size. Parts are joined within; then one set of each
   component and part stands for it in further rounds; at last pairs of parts
   that are not yet one component and overlap in size are joined in full, so
   the cuts lose no link.

Defined results: null text is the empty text; a text without words has no
shingles and links with nothing, also not with its equals; null ids are greater than
others in naming a component; rows repeat as they come and are in one
component; extra columns are not carried; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import arrow_map, keep_rows, materialise, row_key, text_of
from opinio.llm.components import connected_components
from opinio.llm.shingles import set_id, shingle_sets

#: Link when PART * intersection >= SHARE * union.
SHARE, PART = 80, 100
#: Buckets of the shingle counts: slices of 2^16, two bits for each on the driver (64 MB).
SLICES = 1 << 12
#: Shingles that a task holds (four bytes each) before it deals them to slices. Prefix
#: rows take many times the memory, so a task combines an eighth as many at a time.
COMBINE = 1 << 21
#: Bits for each member's key in the filter of texts, and the most of all (32 MB).
KEY_BITS, MOST_BITS = 16, 1 << 28
#: Sets and shingles of the largest block that one tree is built on.
SETS, TOKENS = 4096, 4_000_000
#: Children of a tree node.
FAN = 8
#: Node pairs of a tree that are followed down at a time.
PAIRS = 1 << 10


def _needed(n: int) -> int:
    """Least overlap of a set of n shingles with any set that it links with."""
    return -(-SHARE * n // PART)


def _near(small, large):
    """Whether sets of these sizes can link."""
    return PART * small >= SHARE * large


# Tables of all documents

def set_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per document (``slice`` null): id, row key, set id, size; and rows of
    the buckets that sets hold (``slice``, ``buckets``). Written once."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "key", "sid", "n", "slice", "buckets"]

    def held(found: list[np.ndarray], ids: pa.DataType) -> pa.RecordBatch:
        bucket = np.concatenate(found)
        found.clear()
        bucket.sort()
        cut = np.append(np.searchsorted(bucket, np.arange(SLICES, dtype=np.uint32) << np.uint32(16)), len(bucket))
        low = (bucket & np.uint32(0xFFFF)).astype("<u2")
        some = np.flatnonzero(np.diff(cut))
        none = pa.nulls(len(some), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(some), ids), none, none, none, pa.array(some, pa.int32()),
             pa.array([low[cut[k]:cut[k + 1]].tobytes() for k in some], pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, seen, ids = [], 0, set(), None
        for batch in batches:
            sids, sizes = [], []
            ids = batch.schema.field(0).type
            for found in shingle_sets(batch.column(2).to_pylist()):
                sids.append(set_id(found))
                sizes.append(len(found))
                if sids[-1] not in seen:  # of this run of rows
                    seen.add(sids[-1])
                    waiting.append(_bucket(found).astype(np.uint32))
                    size += len(found)
            n = len(sids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
            if size >= COMBINE:
                yield held(waiting, ids)
                waiting, size, seen = [], 0, set()
        if size:
            yield held(waiting, ids)

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("_text"))
    rows = rows.select("id", row_key("id", "_text").alias("key"), "_text")
    return materialise(arrow_map(rows, run, f"id {kind}, key bigint, sid bigint, n bigint, slice int, buckets binary"),
                       "sets")


def _bucket(found: np.ndarray) -> np.ndarray:
    return found >> np.uint64(64 - 16 - SLICES.bit_length() + 1)


def bucket_levels(table: DataFrame) -> np.ndarray:
    """Two bits for each bucket: 0 if at most one shingle occurrence is in it, else 1
    to 3 for few to many, measured against the mean of all buckets."""
    total = table.where("slice is not null").agg(F.sum(F.length("buckets"))).first()[0] or 0
    mean = total / 2 / (SLICES << 16)
    steps = np.array([2, 3 + mean, 5 + 2 * mean])

    def packed(counts: np.ndarray) -> bytes:
        level = np.digitize(counts, steps).astype(np.uint8).reshape(-1, 4)
        return (level << np.array([6, 4, 2, 0], np.uint8)).sum(1, dtype=np.uint8).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, np.zeros(1 << 16, np.int64)
        for batch in batches:
            done = []
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != now:
                    if now is not None:
                        done.append((now, packed(counts)))
                    now, counts = k, np.zeros(1 << 16, np.int64)
                counts += np.bincount(np.frombuffer(raw, "<u2"), minlength=1 << 16)
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int32()),
                                              pa.array([d[1] for d in done], pa.binary())], ["slice", "levels"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()),
                                              pa.array([packed(counts)], pa.binary())], ["slice", "levels"])

    rows = table.where("slice is not null").select("slice", "buckets")
    levels = arrow_map(rows.repartition("slice").sortWithinPartitions("slice"), run, "slice int, levels binary")
    out = np.zeros((SLICES, 1 << 14), np.uint8)
    for r in levels.collect():
        out[r["slice"]] = np.frombuffer(r["levels"], np.uint8)
    return out.ravel()


# Coarse blocks

def _prefix(found: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Those of the first shingles in the global order (by their bucket's level,
    then by hash) that other sets may hold."""
    bucket = _bucket(found)
    level = (levels[bucket >> np.uint64(2)] >> (np.uint64(6) - np.uint64(2) * (bucket & np.uint64(3))).astype(np.uint8)) & 3
    shared = level > 0
    other, level = found[shared], level[shared]
    alone = len(found) - len(other)
    return other[np.argsort(level, kind="stable")[:max(0, len(found) - _needed(len(found)) + 1 - alone)]]


def _runs_of(token: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where a new run begins in rows sorted by (token, low): another token, or
    a gap in size."""
    start = np.ones(len(token), bool)
    group = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]])).astype(np.int64)
    reach = np.maximum.accumulate(group << 32 | high) & 0xFFFFFFFF
    start[1:] = (token[1:] != token[:-1]) | ~_near(reach[:-1], low[1:])
    return start


#: A run of sizes (``low`` to ``high``) that sets of a shingle have, one of them
#: (``sid``) for all; or, with ``other``, two sets of a run that a task has seen.
PREFIX_SCHEMA = "token bigint, low int, high int, sid bigint, other bigint"


def prefix_rows(docs: DataFrame, levels: np.ndarray, text_col: str) -> DataFrame:
    """The runs of every shingle that is among a set's first, combined per task."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    schema = PREFIX_SCHEMA
    names = ["token", "low", "high", "sid", "other"]

    def combined(tokens: list, sizes: list, sids: list) -> pa.RecordBatch:
        token, size, sid = (np.concatenate(x) for x in (tokens, sizes, sids))
        for x in (tokens, sizes, sids):
            x.clear()
        order = np.lexsort((size, token))
        token, size, sid = token[order], size[order], sid[order]
        start = _runs_of(token, size, size)
        first = np.flatnonzero(start)
        head = np.repeat(first, np.diff(np.append(first, len(token))))
        last = np.append(first[1:], len(token)) - 1
        pairs = np.unique(np.stack([sid[head], sid])[:, sid[head] != sid], axis=1)
        k, e = len(first), pairs.shape[1]
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([token[first], pairs[1]])),
            pa.array(np.concatenate([size[first], np.zeros(e, np.int32)]).astype(np.int32)),
            pa.array(np.concatenate([size[last], np.zeros(e, np.int32)]).astype(np.int32)),
            pa.array(np.concatenate([sid[first], pairs[0]])),
            pa.array(np.concatenate([np.zeros(k, np.int64), pairs[1]]), mask=np.arange(k + e) < k)], names)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, sizes, sids, held, seen = [], [], [], 0, set()
        for batch in batches:
            for found in shingle_sets(batch.column(0).to_pylist()):
                if not len(found) or (sid := set_id(found)) in seen:
                    continue
                seen.add(sid)  # of this run of rows
                tokens.append(_prefix(found, shared.value).view(np.int64))
                sizes.append(np.full(len(tokens[-1]), len(found), np.int32))
                sids.append(np.full(len(tokens[-1]), sid, np.int64))
                held += len(tokens[-1])
            if held >= COMBINE // 8:
                yield combined(tokens, sizes, sids)
                tokens, sizes, sids, held, seen = [], [], [], 0, set()
        if held:
            yield combined(tokens, sizes, sids)

    return arrow_map(docs.select(text_of(text_col).alias("_text")), prefixes, schema)


def link_runs(rows: DataFrame) -> DataFrame:
    """Edges (``u``, ``v``) that connect the sets of each run of a shingle: rows of
    one shingle whose sizes follow one another without a gap."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = reach = head = None  # of the run that the last batch ended in
        for batch in batches:
            t, low, high, sid = (batch.column(i).to_numpy() for i in range(4))
            other = batch.column(4)
            edge = np.asarray(other.is_valid())
            ready = pa.RecordBatch.from_arrays([batch.column(3).filter(pa.array(edge)), other.filter(pa.array(edge))],
                                               ["u", "v"])
            if len(ready):
                yield ready
            t, low, high, sid = t[~edge], low[~edge].astype(np.int64), high[~edge].astype(np.int64), sid[~edge]
            if not len(t):
                continue
            if token is not None:
                t, sid = np.append(token, t), np.append(head, sid)
                low, high = np.append(min(reach, low[0]) if token == t[1] else reach, low), np.append(reach, high)
            start = _runs_of(t, low, high)
            first = np.flatnonzero(start)
            heads = sid[np.repeat(first, np.diff(np.append(first, len(t))))]
            token, head, reach = t[-1], heads[-1], high[first[-1]:].max()
            differ = heads != sid
            yield pa.RecordBatch.from_arrays([pa.array(heads[differ]), pa.array(sid[differ])], ["u", "v"])

    return arrow_map(rows.repartition("token").sortWithinPartitions("token", "low"), link, "u bigint, v bigint")


def refined(texts: DataFrame, members: DataFrame, text_col: str) -> DataFrame:
    """Finer blocks for the sets of large ones: ``members`` with a new ``coarse``.

    Among these sets shingles are counted exactly. Those that one set holds
    come first in the order and link nothing, so only sets of which at least
    four fifths are shared stay in a block; the others leave.
    """
    own = members.select("key", "sid").join(texts, F.col("key") == F.col("__key")).select("sid", text_of(text_col).alias("t"))

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids = batch.column(0).to_numpy()
            for at in range(0, len(sids), 64):
                sets = list(shingle_sets(batch.column(1).slice(at, 64).to_pylist()))
                some = sids[at:at + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(some, [len(x) for x in sets])), pa.array(np.concatenate(sets).view(np.int64))],
                    ["sid", "token"])

    rows = arrow_map(own.dropDuplicates(["sid"]), shingles, "sid bigint, token bigint")
    held = rows.groupBy(F.col("token").alias("_token")).agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = (rows.join(held, F.col("token") == F.col("_token")).select("sid", "token", "df")
              .join(members.select(F.col("sid").alias("_sid"), "n"), F.col("sid") == F.col("_sid")))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by set, rarest first; a set may go on in the next batch.
        held: list[np.ndarray] = []
        for batch in batches:
            sid, token, n = (batch.column(i).to_numpy() for i in range(3))
            cut = np.flatnonzero(np.diff(sid)) + 1
            parts = [np.stack(x) for x in zip(np.split(sid, cut), np.split(token, cut), np.split(n, cut))]
            if held and len(parts) and parts[0][0, 0] == held[0][0, 0]:
                held.append(parts.pop(0))
            if parts:
                yield first([np.concatenate(held, axis=1), *parts[:-1]] if held else parts[:-1])
                held = [parts[-1]]
        if held:
            yield first([np.concatenate(held, axis=1)])

    def first(sets: list[np.ndarray]) -> pa.RecordBatch:
        keep = []
        for rows in sets:
            n = int(rows[2, 0])
            alone = n - rows.shape[1]  # shingles of this set only; they are first
            keep.append(rows[:, :max(0, n - _needed(n) + 1 - alone)])
        sid, token, n = np.concatenate(keep, axis=1) if keep else np.empty((3, 0), np.int64)
        size = pa.array(n.astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(token), size, size, pa.array(sid), pa.nulls(len(sid), pa.int64())],
                                          ["token", "low", "high", "sid", "other"])

    ordered = (shared.select("sid", "token", "n", "df").repartition("sid").sortWithinPartitions("sid", "df", "token")
               .select("sid", "token", "n"))
    edges = link_runs(arrow_map(ordered, prefixes, PREFIX_SCHEMA))
    finer = connected_components(edges, "finer").select(F.col("node").alias("_sid"), F.col("component").alias("coarse"))
    return members.drop("coarse").join(finer, F.col("sid") == F.col("_sid")).select("coarse", "sid", "key", "n")


# Signature trees

class SignatureTree:
    """Sets as leaves; nodes hold OR-combined bitmaps and ranges of size."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: (sets[i][0], len(sets[i])))
        width = 1 << max(8, min(16, (2 * max(map(len, sets)) - 1).bit_length()))
        sizes = np.array([len(sets[i]) for i in self.order], np.int64)
        bits = np.zeros((len(sets), width // 64), np.uint64)
        for row, i in enumerate(self.order):
            spot = sets[i] & np.uint64(width - 1)
            np.bitwise_or.at(bits[row], (spot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (spot & np.uint64(63)))
        # Shingles of a set that share a bit with another of the set.
        shared = sizes - np.bitwise_count(bits).sum(1, dtype=np.int64)
        #: Per level from the leaves up: bitmaps, least and largest size, most shared bits.
        self.levels = [(bits, sizes, sizes, shared)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, shared = self.levels[-1]
            cut = np.arange(0, len(bits), FAN)
            self.levels.append((np.bitwise_or.reduceat(bits, cut), np.minimum.reduceat(low, cut),
                                np.maximum.reduceat(high, cut), np.maximum.reduceat(shared, cut)))

    def _may_link(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Node pairs whose largest possible overlap is large enough."""
        bits, low, high, shared = self.levels[level]
        need = SHARE * (low[a] + low[b])  # of (SHARE + PART) * overlap
        keep = (SHARE + PART) * np.minimum(high[a], high[b]) >= need
        at = np.flatnonzero(keep)
        step = max(1, (1 << 22) // bits.shape[1])
        for k in range(0, len(at), step):
            some = at[k:k + step]
            i, j = a[some], b[some]
            common = np.bitwise_count(bits[i] & bits[j]).sum(1, dtype=np.int64) + np.minimum(shared[i], shared[j])
            keep[some] = (SHARE + PART) * common >= need[some]
        return keep

    def candidates(self, one: list | np.ndarray, now: Callable[[], np.ndarray] | None = None) -> Iterator[tuple[int, int]]:
        """Pairs of sets that the dual traversal from the root does not prune.

        ``one`` gives each set's component so far; node pairs within a single
        one are pruned, and pairs of leaves by what ``now`` gives at that time.
        A few node pairs are followed down at a time, so memory is bounded.
        """
        own = np.asarray(one)[self.order]
        single = [own]
        marks = np.arange(len(own))
        for _ in self.levels[1:]:
            cut = np.arange(0, len(marks), FAN)
            lo, hi = np.minimum.reduceat(single[-1], cut), np.maximum.reduceat(single[-1], cut)
            single.append(np.where(lo == hi, lo, -1 - np.arange(len(cut))))
            marks = cut
        step = np.arange(FAN)
        todo = [(len(self.levels), np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            above, p, q = todo.pop()
            level = above - 1
            n = len(self.levels[level][0])
            left = np.repeat((p[:, None] * FAN + step), FAN, axis=1).ravel()
            right = np.tile((q[:, None] * FAN + step), (1, FAN)).ravel()
            fit = (left < n) & (right < n) & ((left <= right) | np.repeat(p != q, FAN * FAN))
            a, b = left[fit], right[fit]
            names = single[level] if level or now is None else np.asarray(now())[self.order]
            same = names[a] == names[b]
            if level:
                same &= (a != b) | (single[level][a] >= 0)
            else:
                same |= a == b
            a, b = a[~same], b[~same]
            keep = self._may_link(level, a, b) | (a == b)
            a, b = a[keep], b[keep]
            if not level:
                for i, j in zip(a.tolist(), b.tolist()):
                    yield self.order[i], self.order[j]
                continue
            todo += [(level, a[at:at + PAIRS], b[at:at + PAIRS]) for at in range(0, len(a), PAIRS)]


def links(sets: list[np.ndarray], classes: list[int]) -> list[tuple[int, int]]:
    """Links that join sets of different classes, as far as they join more.

    ``classes`` (from 0 on) are what is one component already.
    """
    root = list(range(len(sets)))
    heads: dict[int, int] = {}
    for i, c in enumerate(classes):
        root[i] = heads.setdefault(c, i)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    out = []
    if len(set(root)) > 1:
        for i, j in SignatureTree(sets).candidates(np.array(root), lambda: [find(i) for i in range(len(sets))]):
            p, q = find(i), find(j)
            if p == q:
                continue
            overlap = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if PART * overlap >= SHARE * (len(sets[i]) + len(sets[j]) - overlap):
                root[max(p, q)] = min(p, q)
                out.append((i, j))
    return out


def block_links(docs: DataFrame, members: DataFrame, text_col: str) -> DataFrame:
    """Links (``u``, ``v``) found within each block.

    ``docs``: texts and their row key (``__key``). ``members``: ``key`` (of the
    document that shows the set), ``sid``, ``block``, ``class``.
    """
    texts = docs.select(text_of(text_col).alias("_text"), F.col("__key").alias("_key"))
    rows = (members.join(texts, F.col("key") == F.col("_key")).select("block", "sid", "class", "_text")
            .repartition("block").sortWithinPartitions("block", "sid"))

    def solve(sids: list, classes: list, sets: list) -> list[tuple[int, int]]:
        return [(sids[i], sids[j]) for i, j in links(sets, classes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sids, classes, sets = None, [], [], []
        for batch in batches:
            found = []
            for b, sid, c, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                      batch.column(2).to_pylist(), shingle_sets(batch.column(3).to_pylist())):
                if b != block:
                    found += solve(sids, classes, sets)
                    block, sids, classes, sets = b, [], [], []
                if not sids or sids[-1] != sid:  # repeated rows of one document
                    sids.append(sid)
                    classes.append(c)
                    sets.append(own)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["u", "v"])
        found = solve(sids, classes, sets)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["u", "v"])

    return arrow_map(rows, run, "u bigint, v bigint")


def _parts(rows: DataFrame) -> DataFrame:
    """Cut large blocks, in order of size, into parts of bounded size.

    A range partitioning by (block, size) deals a block of any size over many
    tasks; each task numbers the parts of its own rows.
    """
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, block, held, tokens = TaskContext.get().partitionId(), 0, None, 0, 0
        for batch in batches:
            parts = []
            for b, n in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if b != block or held >= SETS or tokens + n > TOKENS:
                    number, block, held, tokens = number + 1, b, 0, 0
                held, tokens = held + 1, tokens + n
                parts.append(task << 32 | number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.int64())],
                                             [*batch.schema.names, "part"])

    ordered = (rows.select("coarse", "sid", "key", "n").repartitionByRange("coarse", "n", "sid")
               .sortWithinPartitions("coarse", "n", "sid"))
    return materialise(arrow_map(ordered, run, "coarse bigint, sid bigint, key bigint, n bigint, part bigint"), "parts")


def _classes(members: DataFrame, edges: DataFrame) -> DataFrame:
    """``members`` with ``class``: the component by the links so far."""
    found = connected_components(edges).withColumnRenamed("node", "_node")
    joined = members.join(found, F.col("sid") == F.col("_node"), "left")
    return joined.withColumn("class", F.coalesce("component", "sid")).drop("component", "_node")


def _large_block_links(docs: DataFrame, large: DataFrame, text_col: str) -> DataFrame:
    """Links of the sets of blocks that are too large for one tree."""
    parts = _parts(large)
    within = parts.select("key", "sid", F.col("part").alias("block"), F.col("sid").alias("class"))
    edges = materialise(block_links(docs, within, text_col), "links")
    # One set of each component and part stands for it, until that joins no more.
    stand = materialise(_classes(parts, edges), "classes")
    left = stand.count()
    while True:
        stand = (stand.groupBy("coarse", "part", "class").agg(F.min(F.struct("n", "sid", "key")).alias("s"))
                 .select("coarse", "s.sid", "s.key", "s.n"))
        stand = _parts(stand)
        now = stand.count()
        if now >= left:
            break
        left = now
        more = block_links(docs, stand.select("key", "sid", F.col("part").alias("block"), F.col("sid").alias("class")),
                           text_col)
        edges = materialise(edges.unionByName(more), "links")
        stand = materialise(_classes(stand, edges), "classes")
    # Pairs of parts that are near in size and not one component.
    classed = materialise(_classes(parts, edges), "classes")
    ranges = classed.groupBy("coarse", "part").agg(F.min("n").alias("low"), F.max("n").alias("high"),
                                                   F.min("class").alias("c"), F.max("class").alias("d"))
    other = ranges.select("coarse", *(F.col(c).alias(f"{c}2") for c in ("part", "low", "high", "c", "d")))
    pairs = (ranges.join(other, "coarse").where("part < part2")
             .where(_near(F.col("high"), F.col("low2")) & _near(F.col("high2"), F.col("low")))
             .where("not (c = d and c2 = d2 and c = c2)")
             .select(F.xxhash64("part", "part2").alias("block"), F.explode(F.array("part", "part2")).alias("_part")))
    both = classed.join(pairs, F.col("part") == F.col("_part")).select("key", "sid", "block", "class")
    return edges.unionByName(block_links(docs, both, text_col))


def _maybe_among(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``keyed`` whose ``__key`` may be in ``keys`` (``key``): all that are,
    and a few others. A bit for each key's last bits goes to all tasks, so that the
    texts of other rows need not be shuffled to find that out."""
    width = min(MOST_BITS, max(1 << 15, 1 << (KEY_BITS * keys.count()).bit_length()))
    spot = F.col("key").bitwiseAND(width - 1) + 1
    found = (keys.groupBy(F.bitmap_bucket_number(spot).alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits")))
    bits = np.zeros((width >> 15, 1 << 12), np.uint8)
    for r in found.collect():
        bits[r["part"] - 1] = np.frombuffer(r["bits"], np.uint8)
    shared = keyed.sparkSession.sparkContext.broadcast(bits.ravel())
    at = keyed.columns.index("__key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.column(at).to_numpy() & (width - 1)
            yield batch.filter(pa.array((shared.value[last >> 3] >> (last & 7).astype(np.uint8) & 1).astype(bool)))

    return arrow_map(keyed, run, keyed.schema)


def _sized(members: DataFrame) -> DataFrame:
    """``members`` with ``fits``: whether the block is small enough for one tree."""
    sizes = members.groupBy(F.col("coarse").alias("_coarse")).agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("tokens"))
    fits = (F.col("sets") <= SETS) & (F.col("tokens") <= TOKENS)
    return materialise(members.join(sizes, F.col("coarse") == F.col("_coarse")).withColumn("fits", fits)
                       .where("sets > 1"), "sized")


def _as_blocks(sized: DataFrame) -> DataFrame:
    return sized.where("fits").select("key", "sid", F.col("coarse").alias("block"), F.col("sid").alias("class"))


def judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: ``id``, ``key``, ``n``, and ``least``, the id and key
    of its component's first document (null where it has no words)."""
    keyed = docs.select(F.col(text_col), row_key(id_col, text_col).alias("__key"))
    table = set_table(docs, id_col, text_col)
    rows = table.where("slice is null").select("id", "key", "sid", "n")
    coarse = connected_components(link_runs(prefix_rows(docs, bucket_levels(table), text_col)), "coarse")
    shown = rows.groupBy("sid").agg(F.min("key").alias("key"), F.first("n").alias("n"))
    members = materialise(coarse.withColumnRenamed("component", "coarse").join(shown, F.col("node") == F.col("sid"))
                          .select("coarse", "sid", "key", "n"), "members")
    # Texts of others are not shuffled; what is read again and again is the members' alone.
    texts = materialise(_maybe_among(keyed, members.select("key")).join(members.select(F.col("key").alias("_key")), F.col("__key") == F.col("_key"),
                                   "left_semi"), "texts")
    sized = _sized(members)
    edges = block_links(texts, _as_blocks(sized), text_col)
    large = sized.where("not fits")
    if large.limit(1).count():
        sized = _sized(refined(texts, large.select("coarse", "sid", "key", "n"), text_col))
        edges = edges.unionByName(block_links(texts, _as_blocks(sized), text_col))
        large = sized.where("not fits")
        if large.limit(1).count():
            edges = edges.unionByName(_large_block_links(texts, large, text_col))
    classes = connected_components(edges, "links")
    named = rows.join(classes, F.col("sid") == F.col("node"), "left").withColumn("class", F.coalesce("component", "sid"))
    named = materialise(named.select("id", "key", "n", "class"), "classes")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    least = materialise(named.where("n > 0").groupBy(F.col("class").alias("_class")).agg(first.alias("least")), "names")
    return (named.join(least, (F.col("class") == F.col("_class")) & (F.col("n") > 0), "left")
            .select("id", "key", "n", "least"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (the least id
    reachable by links)."""
    return judged(docs, id_col, text_col).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least.id")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first document of each component, with all its columns."""
    stay = judged(docs, id_col, text_col).where((F.col("n") == 0) | (F.col("key") == F.col("least.key")))
    return keep_rows(docs, stay, id_col, text_col)
