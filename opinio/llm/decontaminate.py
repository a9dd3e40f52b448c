"""Benchmark decontamination: seeds of word pairs, then Smith-Waterman alignment.

The similarity of a document and an item is the best local alignment score of
their words (match +1, mismatch and gap -1/2), divided by the item's words;
from ``LEAST`` on the document is contaminated. Items of fewer than ``SHORT``
words must be found whole.

1. Two matched words that follow each other in an alignment with at most one
   edit between them are at most ``REACH`` = 2 places apart in both texts: a
   pair. A wider gap holds two edits, which cost a whole match. So an alignment
   of score s has at least s - 1 pairs, each with another first place in the
   item: every one of at least ``LEAST`` is known by its number of pairs,
   whatever words are replaced, inserted or left out.
2. The pairs of all items are counted over all documents, by number of
   documents. Places of an item whose pairs are frequent are left out of the
   seeds, most frequent first, as long as two of the needed pairs are certain
   to remain; the number needed falls by one for each.
3. A document's seeds name the items and windows that hold as many as needed,
   wide enough for all insertions that can pay (an item's words again, at
   ``LEAST`` = 1/2); windows that overlap are one. A window that holds too few of the item's words is dropped; else item and
   window are aligned word by word.

Items are a query set, taken in blocks of bounded size against all documents,
so memory is bounded whatever the size of the benchmark. Both passes are plain
scans of the documents: no text is shuffled.

Words are runs of word characters, in lower case; punctuation, case and white
space make no difference. In scripts that set no spaces between words (Chinese,
Japanese, Thai, Lao, Khmer, Burmese, Tibetan) every character is a word.

Defined results: null texts, on either side, and items without words match
nothing; repeated items give a row each; repeated documents give a row each;
extra columns are not carried by the scan and all kept by the filter; empty
tables give no matches.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import arrow_map, distinct_names, text_of, unused

#: Most places between the two words of a pair.
REACH = 2
#: Largest share of documents that a rare place's pairs occur in.
RARE = 0.001
#: Least similarity of a contaminated document; items shorter than SHORT words must match whole.
LEAST = 0.5
SHORT = 8
MISMATCH = GAP = 0.5
#: Item words in a block.
BLOCK_WORDS = 500_000
#: Spreads keys over the table of possible ones.
SPREAD, MASK = np.int64(-7046029254386353131), np.int64((1 << 63) - 1)

#: Characters of scripts that set no spaces between words.
UNSPACED = ("\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
            "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")

_words = re.compile(r"\w+").findall
_unspaced = re.compile(f"[{UNSPACED}]").search
_words_and_characters = re.compile(rf"(?=\w)[{UNSPACED}]|[^\W{UNSPACED}]+").findall


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    return (_words if text.isascii() or not _unspaced(text) else _words_and_characters)(text)


def align(item: np.ndarray, window: np.ndarray) -> tuple[float, int]:
    """Best local alignment score of two word lists, and where it ends in the window."""
    spot = np.arange(len(window) + 1) * GAP
    row = np.zeros(len(window) + 1)
    best, end = 0.0, 0
    for word in item:
        now = np.zeros(len(row))
        now[1:] = np.maximum(row[:-1] + np.where(window == word, 1.0, -MISMATCH), row[1:] - GAP)
        np.maximum(now, 0.0, out=now)
        # A gap in the item: the best of all cells to the left, less their distance.
        row = np.maximum.accumulate(now + spot) - spot
        at = int(row.argmax())
        if row[at] > best:
            best, end = float(row[at]), at
    return best, end


class Block:
    """A block of items: vocabulary, word pairs and, once chosen, seeds."""

    def __init__(self, items: list[tuple[object, list[str]]]):
        self.names = [i for i, _ in items]
        self.vocabulary: dict[str, int] = {}
        self.items = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64)
                      for _, words in items]
        self.size = len(self.vocabulary) + 1  # the last number is any other word
        self.least = np.array([len(x) if len(x) < SHORT else LEAST * len(x) for x in self.items], float)
        #: Most words of a document that an alignment can span, by item: its own and insertions as long as they can pay.
        self.span = np.array([len(x) + int((len(x) - s) / GAP) for x, s in zip(self.items, self.least)], np.int64)
        #: Items of one word, by that word, which is their seed.
        self.single: dict[int, list[int]] = {}
        for number, ids in enumerate(self.items):
            if len(ids) == 1:
                self.single.setdefault(int(ids[0]), []).append(number)
        found = [k for ids in self.items for k in self._keys(ids)]
        self._look_for(np.unique(np.concatenate(found)) if found else np.empty(0, np.int64))

    def _keys(self, ids: np.ndarray) -> list[np.ndarray]:
        """Keys of the pairs of a word and the one or two places after it, by place of the first."""
        return [ids[:-d] * self.size + ids[d:] for d in range(1, REACH + 1)]

    def _look_for(self, keys: np.ndarray) -> None:
        """Set the sorted keys that ``_find`` finds, and a table that rules out most others."""
        self.keys = keys
        self.shift = 63 - max(10, int(len(keys) * 16).bit_length())
        self.maybe = np.zeros(1 << 63 - self.shift, bool)
        self.maybe[self._slots(keys)] = True

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * SPREAD & MASK) >> self.shift

    def numbers(self, text: str) -> np.ndarray:
        """A document's words as numbers of the vocabulary."""
        get, other = self.vocabulary.get, self.size - 1
        words = words_of(text)
        return np.fromiter((get(w, other) for w in words), np.int64, len(words))

    def _find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a document of the pairs looked for, and their indexes."""
        places, indexes = [], []
        at = np.flatnonzero(ids < self.size - 1)
        known = ids[at]
        # Words at most REACH places apart are at most REACH known words apart.
        for d in range(1, REACH + 1):
            near = np.flatnonzero(at[d:] - at[:-d] <= REACH)
            keys = known[near] * self.size + known[near + d]
            some = np.flatnonzero(self.maybe[self._slots(keys)])
            keys = keys[some]
            i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[i] == keys
            places.append(at[near[some[hit]]])
            indexes.append(i[hit])
        return np.concatenate(places), np.concatenate(indexes)

    def pairs_in(self, ids: np.ndarray) -> np.ndarray:
        """Indexes of the distinct pairs of items that a document holds."""
        return np.unique(self._find(ids)[1])

    def choose(self, counts: np.ndarray, documents: int) -> None:
        """Choose the seeds by the number of documents that hold each pair."""
        self.need = np.ones(len(self.items), np.int64)
        keys, numbers = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for number, ids in enumerate(self.items):
            if len(ids) < 2:
                continue
            own = self._keys(ids)
            df = np.zeros(len(ids) - 1, np.int64)
            for k in own:
                df[:len(k)] += counts[np.searchsorted(self.keys, k)]
            close = math.ceil(self.least[number]) - 1
            order = np.argsort(-df, kind="stable")[:max(0, close - 2)]
            out = order[df[order] > RARE * documents]
            stay = np.ones(len(df), bool)
            stay[out] = False
            self.need[number] = close - len(out)
            mine = np.unique(np.concatenate([k[stay[:len(k)]] for k in own]))
            keys.append(mine)
            numbers.append(np.full(len(mine), number, np.int64))
        key, number = np.concatenate(keys), np.concatenate(numbers)
        order = np.argsort(key, kind="stable")
        #: Items of each seed: those at start .. start + many of ``who``.
        seeds, self.start, self.many = np.unique(key[order], return_index=True, return_counts=True)
        self.who = number[order]
        self._look_for(seeds)

    def _candidates(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """Items and windows that hold as many seeds as an alignment has at least."""
        at, which = self._find(ids)
        if not len(at):
            return []
        many = self.many[which]
        ends = np.cumsum(many)
        who = self.who[np.repeat(self.start[which] - ends + many, many) + np.arange(ends[-1])]
        item, place = np.divmod(np.unique(who * len(ids) + np.repeat(at, many)), len(ids))
        last = np.arange(len(item)) + self.need[item] - 1
        first = np.flatnonzero(last < len(item))
        last = last[first]
        good = (item[last] == item[first]) & (place[last] - place[first] < self.span[item[first]])
        first, last = first[good], last[good]
        item, span = item[first], self.span[item[first]]
        low = np.maximum(place[last] - span + 1, 0).tolist()
        high = np.minimum(place[first] + span, len(ids)).tolist()
        out: list[tuple[int, int, int]] = []
        for number, start, end in zip(item.tolist(), low, high):
            if out and out[-1][0] == number and start <= out[-1][2]:
                start = min(out[-1][1], start)
                out[-1] = number, start, max(out[-1][2], end)
            else:
                out.append((number, start, end))
        return out

    def matches(self, text: str) -> list[tuple[object, float, int, int]]:
        """Contaminating items of a text: item, similarity, window (words)."""
        ids = self.numbers(text)
        best: dict[int, tuple[float, int, int]] = {}
        for word, numbers in self.single.items():
            places = np.flatnonzero(ids == word)
            for number in numbers if len(places) else ():
                best[number] = 1.0, int(places[0]), int(places[0]) + 1
        for number, low, high in self._candidates(ids):
            item, window, least = self.items[number], ids[low:high], self.least[number]
            words, counts = np.unique(item, return_counts=True)
            i = np.minimum(np.searchsorted(words, window), len(words) - 1)
            held = np.bincount(i[words[i] == window], minlength=len(words))
            if np.minimum(held, counts).sum() < least:
                continue
            score, end = align(item, window)
            if score >= least and (number not in best or score > best[number][0]):
                _, length = align(item[::-1], window[:end][::-1])
                best[number] = score, low + end - length, low + end
        return [(self.names[number], score / len(self.items[number]), start, end)
                for number, (score, start, end) in best.items()]


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, list[str]]]]:
    """Items with words, in blocks of about ``BLOCK_WORDS`` words."""
    block, held = [], 0
    for name, text in items.select(id_col, text_col).toLocalIterator():
        words = words_of(text)
        if not words:
            continue
        if block and held + len(words) > BLOCK_WORDS:
            yield block
            block, held = [], 0
        block.append((name, words))
        held += len(words)
    if block:
        yield block


def seeded(docs: DataFrame, items: list[tuple[object, list[str]]], text_col: str) -> Block:
    """A block with its seeds chosen by counts over all documents."""
    block = Block(items)
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        counts, documents = np.zeros(len(own.keys), np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                counts[own.pairs_in(own.numbers(text.as_py()))] += 1
            documents += batch.num_rows
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int64()),
                                          pa.array(np.append(counts[some], documents), pa.int64())], ["pair", "n"])

    rows = (arrow_map(docs.select(text_of(text_col).alias("_text")), run, "pair bigint, n bigint")
            .groupBy("pair").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(len(block.keys) + 1, np.int64)
    for pair, n in rows:
        counts[pair] = n
    block.choose(counts[:-1], int(counts[-1]))
    return block


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row for each contaminated document and item: both ids, ``similarity``,
    and the passage's window in words (``first_word``, ``end_word``). A name that
    repeats one before it gets a ``_``."""
    kinds = [t.schema[c].dataType.simpleString() for t, c in ((docs, id_col), (items, item_col))]
    names = distinct_names(id_col, item_col, "similarity", "first_word", "end_word")
    schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, (*kinds, "double", "bigint", "bigint")))
    out = docs.sparkSession.createDataFrame([], schema)
    for part in item_blocks(items, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(seeded(docs, part, text_col))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, found = [], []
                for row, text in enumerate(batch.column(1)):
                    for match in shared.value.matches(text.as_py()):
                        rows.append(row)
                        found.append(match)
                if found:
                    items, share, first, end = (pa.array(x) for x in zip(*found))
                    ids = batch.column(0).take(pa.array(rows, pa.int64()))
                    yield pa.RecordBatch.from_arrays([ids, items, share, first, end], names)

        out = out.unionByName(arrow_map(docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")), run, schema))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text") -> DataFrame:
    """The documents that no item contaminates, with all their columns."""
    out = docs
    for part in item_blocks(items, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(seeded(docs, part, text_col))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.num_columns - 1)
                clean = pa.array([not shared.value.matches(t.as_py()) for t in texts], pa.bool_())
                yield batch.filter(clean).select(batch.schema.names[:-1])

        out = arrow_map(out.withColumn(unused(out, "__text"), text_of(text_col)), run, docs.schema)
    return out
