"""Quality selection by importance resampling.

Two generative models of hashed word n-grams (unigrams and bigrams of words
and marks, ``BUCKETS`` buckets) are counted: one of the raw text, over all
documents, and one of the target, over labelled good documents. A bucket's
weight is the log ratio of its target count to the count that the raw model
leads one to expect, both with ``PRIOR`` added, so that little evidence weighs
little. A document's log importance weight is the mean of its n-grams'
weights, for a text of ``GRAMS`` n-grams, so that long and short texts are
judged alike. Documents are drawn by Gumbel top-k: each one's key is its log
weight plus Gumbel noise from a hash of its row, and the k largest keys are
kept, k being the number of documents whose mean weight is above
``-MARGIN`` (those that the target model explains as well as the raw one, but
for that margin, which protects odd but clean texts). The rest are rejected.

Scale: counting yields at most ``BUCKETS`` rows a task, summed by Spark, and
``BUCKETS`` numbers reach the driver. The labelled rows that the target is
fitted on are at most ``fit_rows`` (those with the least id hash), so their ids
are small enough to broadcast and texts are never shuffled. The k-th key is
found by counting keys in ranges, not by a sort.

Defined results: null text is the empty text; a text without n-grams weighs 0
and counts as explained equally well; rows that share the k-th key (equal rows)
are all kept; labels that are null, repeated or of no document are ignored;
without good labels every weight is 0 and everything is kept; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from opinio.llm.common import arrow_map, materialise, row_key, text_of, unused, worker_memo

BUCKETS = 1 << 14
#: Labelled rows that the target model is fitted on, at most.
FIT_ROWS = 20_000
SEED = 17
#: Counts added to seen and expected target counts of a bucket.
PRIOR = 16.0
#: N-grams of the text that a weight is given for.
GRAMS = 100
#: Mean log weight an n-gram, below zero, that is still good enough.
MARGIN = 0.1
#: Words whose hash one worker keeps.
MEMO_WORDS = 500_000

_tokens = re.compile(r"\w+|[^\w\s]+").findall


class WordHashes(dict):
    """Hash of each word; a bounded memo."""

    def __missing__(self, word: str) -> int:
        h = zlib.crc32(word.encode("utf-8", "replace"))
        if len(self) < MEMO_WORDS:
            self[word] = h
        return h


_hashes = worker_memo(__name__, WordHashes())  # per Python worker


def ngram_buckets(text: str) -> np.ndarray:
    """Buckets of a text's unigrams and bigrams, lower-cased."""
    words = _tokens(text.lower())
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    both = np.concatenate([h, (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:]) + np.uint64(1) << np.uint64(8)])
    mixed = (both ^ both >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def count_ngrams(docs: DataFrame, target_ids: list, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bucket``, ``raw`` and ``target`` counts over all documents."""
    wanted = docs.sparkSession.sparkContext.broadcast(frozenset(target_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.bincount(ngram_buckets(text.as_py()), minlength=BUCKETS)
                raw += found
                if i in wanted.value:
                    target += found
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(raw[some]), pa.array(target[some])],
                                         ["bucket", "raw", "target"])

    rows = docs.select(id_col, text_of(text_col).alias("_text"))
    return (arrow_map(rows, run, "bucket int, raw bigint, target bigint")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))


def fit_weights(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                good: Column | None = None, fit_rows: int = FIT_ROWS) -> np.ndarray:
    """Log ratio of seen and expected target counts of each bucket."""
    good = F.col("quality") == 1 if good is None else good
    ids = (labels.where(good & F.col(id_col).isNotNull()).select(id_col).distinct()
           .orderBy(F.xxhash64(id_col, F.lit(SEED)), id_col).limit(fit_rows))
    target_ids = [r[0] for r in ids.collect()]
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, n, m in count_ngrams(docs, target_ids, id_col, text_col).collect():
        raw[bucket], target[bucket] = n, m
    if not target.sum():
        return np.zeros(BUCKETS)
    expected = raw * (target.sum() / raw.sum())
    return np.log((target + PRIOR) / (expected + PRIOR))


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          weight_name: str = "log_weight", key_name: str = "sample_key", seed: int = SEED) -> DataFrame:
    """``docs`` with each row's log importance weight and Gumbel key."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    # Noise follows the row, so a repeated task draws the same.
    rows = docs.withColumns({unused(docs, "__text"): text_of(text_col),
                             unused(docs, "__noise"): F.xxhash64(row_key(id_col, text_col), F.lit(seed))})
    schema = StructType([*docs.schema.fields, StructField(weight_name, DoubleType()), StructField(key_name, DoubleType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, texts, noise = batch.columns
            found = (shared.value[ngram_buckets(t.as_py())] for t in texts)
            weight = np.array([GRAMS * w.mean() if len(w) else 0.0 for w in found], np.float64)
            bits = noise.to_numpy().view(np.uint64) >> np.uint64(11)
            gumbel = -np.log(-np.log((bits + 0.5) / 2.0**53))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(weight), pa.array(weight + gumbel)], names)

    return arrow_map(rows, run, schema)


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 1024) -> float | None:
    """The k-th largest value of a column, by counting in ever narrower ranges.

    Each round brings at most ``bins`` counts to the driver.
    """
    value = F.col(column)
    low, high = rows.agg(F.min(value), F.max(value)).first()
    if low is None or k < 1:
        return None
    while low < high:
        at = F.least(F.floor((value - F.lit(low)) / F.lit((high - low) / bins)), F.lit(bins - 1))
        found = (rows.where(value.between(low, high)).groupBy(at.alias("at"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).collect())
        for r in sorted(found, key=lambda r: -r.at):
            if k <= r.n:
                break
            k -= r.n
        if (r.lo, r.hi) == (low, high):  # as narrow as the numbers allow
            return high if k == 1 else low
        low, high = r.lo, r.hi
    return low


def sample_by_importance(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         good: Column | None = None,
                         fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, float | None, DataFrame]:
    """Weights, the k-th largest key, and every document's scores (id,
    ``log_weight``, ``sample_key``, ``kept``), written once."""
    weights = fit_weights(docs, labels, id_col, text_col, good, fit_rows)
    scores = materialise(score(docs.select(id_col, text_col), weights, id_col, text_col).drop(text_col), "scores")
    k = scores.where(F.col("log_weight") >= -MARGIN * GRAMS).count()
    least = kth_largest(scores, "sample_key", k)
    kept = F.lit(False) if least is None else F.col("sample_key") >= F.lit(least)
    return weights, least, scores.withColumn("kept", kept)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              good: Column | None = None) -> DataFrame:
    """The documents that the sample keeps, with all their columns.

    Keys are drawn again from the same weights and hashes, which is less work
    than to shuffle the texts for a join.
    """
    weights, least, _ = sample_by_importance(docs, labels, id_col, text_col, good)
    if least is None:
        return docs.limit(0)
    weight, key = unused(docs, "__weight"), unused(docs, "__key")
    drawn = score(docs, weights, id_col, text_col, weight, key)
    return drawn.where(F.col(key) >= F.lit(least)).drop(weight, key)
