"""Language identification by bit-sliced Bloom filters of character n-grams.

Training: the words (runs of letters and marks, lower-cased, a blank at each
end) of documents with a language are cut into character n-grams of 1 to
``GRAM`` characters and counted per language. A language contains an n-gram
that makes up at least ``LEAST`` of its n-grams and at least ``SHARE`` of the
highest such rate among all languages, so strange words in a text of another
language, which any large corpus has, do not enter. The filter is one table of
language bitmasks: an n-gram sets its languages' bits in ``HASHES`` rows, and
the AND of those rows is the mask of all languages that contain it (and some
that only seem to).

Prediction: per language, the share of a text's n-grams that have its bit is
corrected for the false positives that the fill of its bit slice leads one to
expect. The highest corrected share decides (ties: the language that is first
in the alphabet); it is the score.

Scale: training counts whole words per task first and sums n-grams in Spark;
a task gives its counts whenever it holds ``HELD`` words. The rates bound a
language's n-grams by 1 / LEAST, so the filter has a fixed number of rows,
built by a ``bit_or`` per row, and at most that many reach the driver and the
workers (8 bytes for each 64 languages). Prediction needs no shuffle and no
column but the text; words are judged once per worker in a bounded memo.

Defined results: a null text, or one without letters, is ``UNKNOWN`` with
score 0; so is every text where no language was learned. A text none of
whose n-grams is known gets the most common language with score 0. Rows with
a null language teach nothing; repeated rows count as often as they occur;
extra columns are not carried (``predict`` keeps the columns it is given); an
empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from opinio.llm.bpe import by_size
from opinio.llm.common import arrow_map, materialise, text_of, unused

#: Longest n-gram.
GRAM = 5
#: Rate among a language's n-grams, and share of the highest rate, that an n-gram needs.
LEAST, SHARE = 2e-5, 0.15
#: Rows of the filter and how many of them an n-gram sets: with at most
#: 1 / LEAST n-grams a language, a slice is at most a quarter full.
ROWS, HASHES = 1 << 19, 3
#: Distinct words that a task counts, or a worker remembers, at a time.
HELD = 300_000
#: Words whose n-grams are laid out at a time.
STEP = 20_000
#: Longest word; a longer run of letters (scripts without spaces) is cut into several.
WORD = 64
UNKNOWN = "und"

_words = regex.compile(rf"\p{{L}}[\p{{L}}\p{{M}}]{{0,{WORD - 1}}}").findall


def words_of(text: str) -> list[str]:
    """Words of a text, lower-cased."""
    return _words(text.lower())


def grams_of(word: str) -> list[str]:
    """A word's n-grams, as often as they occur, with a blank at each end."""
    w = f" {word} "
    return [w[i:i + n] for n in range(1, min(GRAM, len(w)) + 1) for i in range(len(w) - n + 1) if w[i:i + n] != " "]


def gram_hashes(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes (signed, as Spark's long) of the n-grams of many words, and
    the place of the word that each is of, in its order.

    All words lie on one line of code points; the windows of each length are
    hashed side by side, by the hash of the window that is one shorter.
    """
    codes = np.frombuffer("".join([f" {w} " for w in words]).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # characters up to the word's last blank
    h = np.zeros(len(codes), np.uint64)
    out, places = [], []
    for n in range(1, GRAM + 1):
        h = h[:len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1:] + np.uint64(n)
        own = left[:len(h)] >= n
        if n == 1:
            own &= codes != 32
        x = h[own]
        x = (x ^ x >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(x ^ x >> np.uint64(32))
        places.append(word[:len(h)][own])
        if len(h) == 1:
            break
    place = np.concatenate(places)
    order = np.argsort(place, kind="stable")
    return np.concatenate(out)[order].view(np.int64), place[order]


def filter_rows(hashes: np.ndarray) -> np.ndarray:
    """The ``HASHES`` rows of each n-gram, from disjoint bits of its hash."""
    bits = ROWS.bit_length() - 1
    h = np.asarray(hashes, np.int64).view(np.uint64)
    return np.stack([(h >> np.uint64(bits * k)).astype(np.int64) & ROWS - 1 for k in range(HASHES)])


@dataclass
class LanguageFilter:
    """Languages in order and the table of their bits: ``ROWS`` rows of 64-bit words."""

    langs: list[str]
    table: np.ndarray
    common: int = 0  # the most common language

    def __post_init__(self):
        n = len(self.langs)
        filled = np.array([np.count_nonzero(self.table[:, k >> 6] >> np.uint64(k & 63) & np.uint64(1))
                           for k in range(n)], np.float64)
        #: Chance that a strange n-gram has a language's bit.
        self.false = (filled / ROWS) ** HASHES if n else np.zeros(0)
        self.memo: dict[str, int] = {}           # a word's row in ``known``
        self.known = np.zeros((0, n + 1), np.int32)

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """Bits of the languages that contain each n-gram."""
        return np.bitwise_and.reduce(self.table[filter_rows(hashes)], axis=0)

    def counts(self, words: Sequence[str]) -> np.ndarray:
        """Per word: its n-grams, then those of them in each language."""
        hashes, place = gram_hashes(words)
        masks = self.masks(hashes)
        bits = [np.bincount(place[(masks[:, k >> 6] >> np.uint64(k & 63) & np.uint64(1)).astype(bool)], minlength=len(words))
                for k in range(len(self.langs))]
        return np.stack([np.bincount(place, minlength=len(words)), *bits], axis=1).astype(np.int32)

    def _learn(self, new: Sequence[str]) -> None:
        """Remember words that the memo lacks."""
        if not len(new):
            return
        made = [self.counts(new[s:s + STEP]) for s in range(0, len(new), STEP)]
        self.memo.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.known = np.concatenate([self.known, *made])

    def predict(self, texts: Sequence[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        out: list[tuple[str, float]] = []
        for run in by_size([t or "" for t in texts]):
            words = [words_of(t) for t in run]
            if len(self.memo) > HELD:
                self.memo.clear()
                self.known = self.known[:0]
            self._learn(sorted(set().union(*words).difference(self.memo)))
            for own in words:
                rows = np.fromiter(map(self.memo.__getitem__, own), np.int64, len(own))
                total = np.zeros(1 + len(self.langs))
                for r in range(0, len(rows), STEP):
                    total += self.known[rows[r:r + STEP]].sum(axis=0)
                out.append(self._decide(total))
        return out

    def _decide(self, total: np.ndarray) -> tuple[str, float]:
        if not total[0]:
            return UNKNOWN, 0.0
        share = (total[1:] / total[0] - self.false) / np.maximum(1 - self.false, 1e-9)
        best = int(share.argmax())
        if share[best] <= 0:
            return self.langs[self.common], 0.0
        return self.langs[best], float(min(share[best], 1.0))


def count_grams(docs: DataFrame, langs: Sequence[str], text_col: str, lang_col: str) -> DataFrame:
    """``lang`` (its place in ``langs``), ``gram`` (hash) and ``n`` over all rows."""
    places = {x: k for k, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(places[lang], Counter()).update(words_of(text.as_py()))
                if sum(map(len, held.values())) > HELD:
                    yield from given(held)
                    held = {}
        yield from given(held)

    def given(held: dict[int, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counted in held.items():
            words, times = list(counted), np.fromiter(counted.values(), np.int64, len(counted))
            for s in range(0, len(words), STEP):
                hashes, place = gram_hashes(words[s:s + STEP])
                grams, back = np.unique(hashes, return_inverse=True)
                n = np.bincount(back, weights=times[s:s + STEP][place], minlength=len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), lang, np.int32)), pa.array(grams),
                                                  pa.array(n)], ["lang", "gram", "n"])

    known = docs.where(F.col(lang_col).isNotNull()).select(lang_col, text_of(text_col).alias("text"))
    return (arrow_map(known, run, "lang int, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageFilter:
    """Learn the languages of ``docs`` from all its rows."""
    sizes = docs.where(F.col(lang_col).isNotNull()).groupBy(lang_col).count().collect()  # one row a language
    langs = sorted(r[0] for r in sizes)
    if not langs:
        return LanguageFilter([], np.zeros((ROWS, 1), np.uint64))
    common = langs.index(min(sizes, key=lambda r: (-r["count"], r[0]))[0])
    counts = materialise(count_grams(docs, langs, text_col, lang_col), "gram_counts")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    # The rate of an n-gram: its count over its language's total, as a small table to look up.
    total = F.element_at(F.array(*[F.lit(float(totals.get(k, 0)) or 1.0) for k in range(len(langs))]), F.col("lang") + 1)
    rates = counts.withColumn("rate", F.col("n") / total).where(F.col("rate") >= LEAST)
    per_gram = rates.groupBy("gram").agg(F.collect_list(F.struct("lang", "rate")).alias("in"),  # at most one a language
                                         F.max("rate").alias("top"))
    kept = per_gram.select("gram", F.explode(F.filter("in", lambda x: x["rate"] >= SHARE * F.col("top"))).alias("x"))
    bits = ROWS.bit_length() - 1
    spots = F.array(*[F.shiftrightunsigned("gram", bits * k).bitwiseAND(ROWS - 1) for k in range(HASHES)])
    word = F.floor(F.col("x.lang") / 64).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("x.lang") % 64).cast("int"))
    masks = (kept.select(F.explode(spots).alias("row"), word.alias("word"), bit.alias("bit"))
             .groupBy("row", "word").agg(F.bit_or("bit").alias("mask")).toArrow())
    table = np.zeros((ROWS, (len(langs) + 63) // 64), np.uint64)
    table[masks["row"].to_numpy(), masks["word"].to_numpy()] = masks["mask"].to_numpy().view(np.uint64)
    return LanguageFilter(langs, table, common)


def predict(docs: DataFrame, languages: LanguageFilter, text_col: str = "text", lang_name: str = "lang_pred",
            score_name: str = "score") -> DataFrame:
    """``docs`` with the language that its text alone says, and the score."""
    shared = docs.sparkSession.sparkContext.broadcast((languages.langs, languages.table, languages.common))
    rows = docs.withColumn(unused(docs, "__text"), F.col(text_col))
    lang_name, score_name = unused(docs, lang_name), unused(docs, score_name)
    schema = StructType([*docs.schema.fields, StructField(lang_name, StringType()), StructField(score_name, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageFilter(*shared.value)
        for batch in batches:
            *columns, texts = batch.columns
            found = model.predict(texts.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                schema.names)

    return arrow_map(rows, run, schema)
