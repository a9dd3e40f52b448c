"""M5 forest whose trees grow side by side, each in one task.

A task reads all training rows as bin numbers (a byte per feature) and grows
whole trees, so no statistics of nodes are shuffled and no pass over the data
waits for the driver. Bins, bootstrap, feature subsets, entropy gain and the
merging of leaves that predict alike are those of Spark ML's forest. The draws
follow from the seed, the tree, the row's values and the node's path: they do
not depend on partitions, and a row or node that stays in the next fit keeps its own.

Training sets of over ``FOREST_ROWS`` rows are fitted by Spark ML itself, whose
memory a task does not grow with the rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyarrow import fs as pafs
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.session import scratch_path

#: Training rows that a task holds (values as read, then a byte per feature).
FOREST_ROWS = 1 << 20

#: Gain, times rows, that is taken for a rounding error.
_NO_GAIN = 1e-8

_TREES = "tree long, feature binary, threshold binary, child binary, share binary"
_KINDS = {"feature": np.int32, "threshold": np.float64, "child": np.int32, "share": np.float64}

_held: dict[str, object] = {}  # per Python worker: the rows or trees of the last folder


def _folder(path: str) -> pa.Table:
    system, folder = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    return pads.dataset(folder, filesystem=system, format="parquet").to_table()


def _once(path: str, load):
    if path not in _held:
        _held.clear()
        _held[path] = load(_folder(path))
    return _held[path]


def split_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Where a feature's values are cut: between all of them if they are few,
    else into ``bins`` parts of rows as equal as its values allow."""
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2.0
    if len(middle) <= bins - 1:
        return middle
    stride = len(values) / bins
    upto, target, out = np.cumsum(counts), stride, []
    for k in range(1, len(found)):
        if abs(upto[k - 1] - target) < abs(upto[k] - target):
            out.append(middle[k - 1])
            target += stride
    return np.array(out)


#: Poisson(1) by its distribution: a row's weight in a bootstrap sample.
_POISSON = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(18)])
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of each 64-bit number (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Rows:
    """Training rows: ``codes`` (bin by row and feature), ``label``, ``cuts``, and
    ``key``, a hash of a row's values and its number among equal rows."""

    def __init__(self, table: pa.Table, bins: int):
        x = table["x"].combine_chunks()
        x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
        label = table["label"].to_numpy().astype(np.int64)
        order = np.lexsort((label, *x.T))
        x, self.label = x[order] + 0.0, label[order]
        fresh = np.ones(len(x), bool)
        fresh[1:] = (x[1:] != x[:-1]).any(axis=1) | (self.label[1:] != self.label[:-1])
        every = np.arange(len(x))
        self.key = (every - np.maximum.accumulate(np.where(fresh, every, 0))).astype(np.uint64)
        for c in (self.label.astype(np.uint64), *(np.ascontiguousarray(c).view(np.uint64) for c in x.T)):
            self.key = _mixed(self.key * _STEP + c)
        self.cuts = [split_points(c, bins) for c in x.T]
        self.bins = max(len(c) for c in self.cuts) + 1
        kind = np.uint8 if self.bins <= 256 else np.int32
        self.codes = np.stack([np.searchsorted(cut, c).astype(kind) for cut, c in zip(self.cuts, x.T)], axis=1)


def grow(rows: _Rows, seed: int, tree: int, depth: int, subset: int) -> dict[str, np.ndarray]:
    """One tree on a bootstrap sample of the rows, level by level.

    Nodes are numbered by level; ``child`` is the left child and the right one
    comes next to it. A leaf has feature -1; ``share`` is its part of class 1.
    """
    n, width = rows.codes.shape
    own_key = _mixed(_mixed(np.array([seed % (1 << 64)], np.uint64)) + np.array([tree], np.uint64) * _STEP)
    weight = np.searchsorted(_POISSON, (_mixed(rows.key ^ own_key) >> np.uint64(11)) * 2.0 ** -53, side="right")
    at = np.flatnonzero(weight)
    weight, label = weight[at].astype(np.float64), rows.label[at]
    codes, bins = rows.codes.ravel(), rows.bins
    c = np.arange(int(weight.sum()) + 1, dtype=np.float64)
    table = c * np.log2(np.maximum(c, 1.0))  # n times the entropy is a sum of these

    def impurity(a, b):
        return table[a + b] - table[a] - table[b]

    counts = [np.bincount(label, weight, 2).astype(np.int64)[None, :]]  # by level: (class 0, class 1) of its nodes
    levels = []  # by level: feature, cut and left child of its nodes
    node, begin = np.zeros(len(at), np.int64), 0  # of the level's nodes that may be split
    key, column = _mixed(own_key + _STEP), np.arange(1, width + 1, dtype=np.uint64) * _STEP
    for level in range(depth + 1):
        own = counts[level]
        feature, cut, child = (np.full(len(own), -1, np.int32) for _ in range(3))
        levels.append((feature, cut, child))
        can = np.flatnonzero((own > 0).all(axis=1)) if level < depth else np.zeros(0, np.int64)
        number = np.full(len(own), -1, np.int64)
        number[can] = np.arange(len(can))
        node = number[node]
        stay = node >= 0
        at, weight, label, node = at[stay], weight[stay], label[stay], node[stay]
        if not len(can):
            break
        drawn = np.argsort(_mixed(key[can][:, None] + column), axis=1)[:, :subset]
        whole = impurity(own[can, 0], own[can, 1])
        best, where = np.full(len(can), -np.inf), np.zeros((len(can), 2), np.int32)
        left_of = np.zeros((len(can), 2), np.int64)
        every = np.arange(len(can))
        for f in drawn.T:
            bin_of = codes[at * width + f[node]]
            held = np.bincount((node * bins + bin_of) * 2 + label, weight, len(can) * bins * 2)
            left = held.reshape(len(can), bins, 2).cumsum(axis=1).astype(np.int64)[:, :-1]
            right = own[can][:, None, :] - left
            gain = whole[:, None] - impurity(left[..., 0], left[..., 1]) - impurity(right[..., 0], right[..., 1])
            gain[(left.sum(axis=2) == 0) | (right.sum(axis=2) == 0)] = -np.inf
            if not gain.shape[1]:
                continue
            top = gain.argmax(axis=1)
            more = gain[every, top] > best
            best[more] = gain[every, top][more]
            where[more] = np.stack([f, top], axis=1)[more]
            left_of[more] = left[every, top][more]
        split = np.flatnonzero(best > _NO_GAIN)
        begin += len(own)
        feature[can[split]], cut[can[split]] = where[split].T
        child[can[split]] = begin + 2 * np.arange(len(split))
        if not len(split):
            break
        below = np.empty((2 * len(split), 2), np.int64)
        below[0::2] = left_of[split]
        below[1::2] = own[can[split]] - left_of[split]
        counts.append(below)
        key = _mixed(np.repeat(key[can[split]], 2) ^ np.tile(np.arange(1, 3, dtype=np.uint64), len(split)))
        number = np.full(len(can), -1, np.int64)
        number[split] = np.arange(len(split))
        stay = number[node] >= 0
        at, weight, label, node = at[stay], weight[stay], label[stay], node[stay]
        right = codes[at * width + where[node, 0]] > where[node, 1]
        node = 2 * number[node] + right
    return _merged(levels, counts, rows.cuts)


def _merged(levels: list, counts: list, cuts: list) -> dict[str, np.ndarray]:
    """The tree without leaves beside each other that predict the same class."""
    feature, cut, child = (np.concatenate(x) for x in zip(*levels))
    zero, one = np.concatenate(counts).T
    says, starts = one > zero, np.cumsum([0, *[len(c) for c in counts]])
    for k in range(len(counts) - 1, -1, -1):
        inner = starts[k] + np.flatnonzero(feature[starts[k]:starts[k + 1]] >= 0)
        a, b = child[inner], child[inner] + 1
        alike = inner[(feature[a] < 0) & (feature[b] < 0) & (says[a] == says[b])]
        feature[alike], child[alike] = -1, -1
    kept = np.zeros(len(feature), bool)
    kept[0] = True
    for k in range(len(counts)):
        inner = starts[k] + np.flatnonzero(kept[starts[k]:starts[k + 1]] & (feature[starts[k]:starts[k + 1]] >= 0))
        kept[child[inner]] = kept[child[inner] + 1] = True
    place = np.cumsum(kept) - 1
    threshold = np.array([cuts[f][c] if f >= 0 else 0.0 for f, c in zip(feature[kept], cut[kept])], np.float64)
    return {"feature": feature[kept], "threshold": threshold, "share": (one / np.maximum(zero + one, 1))[kept],
            "child": np.where(feature[kept] >= 0, place[child[kept]], -1).astype(np.int32)}


def shares(trees: list[dict[str, np.ndarray]], x: np.ndarray) -> np.ndarray:
    """By row, the mean of the trees' shares of class 1."""
    total, every = np.zeros(len(x)), np.arange(len(x))
    for t in trees:
        at, open_ = np.zeros(len(x), np.int64), every
        while len(open_ := open_[t["feature"][at[open_]] >= 0]):
            here = at[open_]
            at[open_] = t["child"][here] + (x[open_, t["feature"][here]] > t["threshold"][here])
        total += t["share"][at]
    return total / len(trees)


def _loaded(table: pa.Table) -> list[dict[str, np.ndarray]]:
    found = sorted(table.to_pylist(), key=lambda r: r["tree"])
    return [{k: np.frombuffer(r[k], kind) for k, kind in _KINDS.items()} for r in found]


class ForestModel:
    """Trees in a folder; a task that scores rows reads them all."""

    def __init__(self, path: str):
        self.path = path

    def transform(self, df: DataFrame) -> DataFrame:
        path = self.path

        def score(batches):
            for batch in batches:
                x = batch.column("features").flatten().to_numpy(zero_copy_only=False)
                p = np.empty(0)
                if batch.num_rows:
                    p = shares(_once(path, _loaded), x.reshape(batch.num_rows, -1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], [*batch.schema.names, "_share"])

        rows = df.withColumn("features", vector_to_array("features"))
        schema = T.StructType([*rows.schema.fields, T.StructField("_share", T.DoubleType())])
        return (rows.mapInArrow(score, schema)
                .withColumn("features", array_to_vector("features"))
                .withColumn("probability", array_to_vector(F.array(1.0 - F.col("_share"), F.col("_share"))))
                .withColumn("prediction", (F.col("_share") > 0.5).cast("double")).drop("_share"))


class Forest(RandomForestClassifier):
    """Spark ML's classifier of two classes, fitted tree by tree (see the module)."""

    def _fit(self, dataset: DataFrame):
        spark = dataset.sparkSession
        path = scratch_path(spark, "forest_rows")
        dataset.select(vector_to_array("features").alias("x"), "label").write.parquet(path)
        n, most = spark.read.parquet(path).agg(F.count(F.lit(1)), F.max("label")).first()
        if most != 1.0 or n > FOREST_ROWS:
            return super()._fit(dataset)
        bins, depth, seed, trees = min(self.getMaxBins(), n), self.getMaxDepth(), self.getSeed(), self.getNumTrees()

        def fitted(batches):
            for batch in batches:
                for tree in batch.column(0).to_pylist():
                    rows = _once(path, lambda table: _Rows(table, bins))
                    subset = int(np.ceil(np.sqrt(rows.codes.shape[1])))
                    made = grow(rows, seed, tree, depth, subset)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree], pa.int64()), *[pa.array([made[k].astype(kind).tobytes()], pa.binary()) for k, kind in _KINDS.items()]],
                        ["tree", *_KINDS])

        out = scratch_path(spark, "forest_trees")
        tasks = min(trees, 8 * spark.sparkContext.defaultParallelism)
        spark.range(0, trees, 1, tasks).mapInArrow(fitted, _TREES).write.parquet(out)
        return ForestModel(out)
