"""Extraction from stored pages by structure (W1-W3): nodes, and fields of cards.

A page's elements become rows with an interval: ``start`` and ``end`` number
the tags in document order, so an element lies in another one when its
interval does. Only elements that a selector names are kept, with their
attributes and their text.

Fields are brought to the card (the repeated element of a review, a link, ..)
that holds them by a containment join that never pairs nodes: the opening and
closing tags of the cards of a page, summed up in document order, give the
number of cards open at a field; the innermost of them is the last card that
was opened at that number. Both steps are windows over one page, so the work
grows with the nodes. A card that lacks a field has null there, and no other
card is affected.

Site markup is data: selectors and fields are given by the caller.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose end tag may be left out: a new one of the kind ends them, up to these parents.
CLOSED_BY = {
    "li": {"li"}, "p": {"p", "div", "ul", "ol", "table", "section", "article", "h1", "h2", "h3", "h4", "h5", "h6", "li",
                        "td", "th", "tr", "dt", "dd"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    "option": {"option"},
}
LIMITS = {"li": {"ul", "ol"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dt": {"dl"}, "dd": {"dl"},
          "option": {"select"}, "p": {"div", "section", "article", "li", "td", "th", "dd", "body"}}
#: Elements whose contents are not text.
SILENT = frozenset({"script", "style"})


@dataclass(frozen=True)
class Selector:
    """Elements by tag, by class words that they must all have, and by patterns
    that the values of attributes must hold (somewhere)."""

    tag: str | None = None
    classes: Sequence[str] = ()
    attrs: Mapping[str, str] = field(default_factory=dict)

    def matches(self, tag: str, attrs: Mapping[str, str]) -> bool:
        if self.tag is not None and tag != self.tag:
            return False
        if self.classes and not set(self.classes) <= set(attrs.get("class", "").split()):
            return False
        return all(name in attrs and re.search(pattern, attrs[name]) for name, pattern in self.attrs.items())


@dataclass(frozen=True)
class Field:
    """A value of a card: of its ``nth`` element of a selector (from 0) the text,
    or an attribute, and of that the first group of a pattern (null where it
    does not match)."""

    selector: Selector
    attr: str | None = None
    nth: int = 0
    pattern: str | None = None

    def value(self) -> Column:
        raw = F.col("text") if self.attr is None else F.element_at("attrs", F.lit(self.attr))
        return raw if self.pattern is None else F.get(F.regexp_extract_all(raw, F.lit(self.pattern), F.lit(1)), 0)


class _Nodes(HTMLParser):
    """The matching elements of one page, in document order."""

    def __init__(self, selectors: Sequence[tuple[str, Selector]]):
        super().__init__(convert_charrefs=True)
        self.selectors = selectors
        self.at = 0                      # tags so far
        self.open: list[tuple] = []      # (tag, start, text pieces so far, names, attributes)
        self.texts: list[str] = []
        self.found: list[list] = []      # [name, start, end, depth, attributes, text]
        self.silent = 0

    def handle_starttag(self, tag, attrs):
        self._imply(tag)
        values: dict[str, str] = {}
        for name, value in attrs:
            values.setdefault(name, value or "")
        names = [n for n, s in self.selectors if s.matches(tag, values)]
        self.at += 1
        self.open.append((tag, self.at, len(self.texts), names, values))
        self.silent += tag in SILENT
        if tag in VOID:
            self._close(len(self.open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self._close(k)
                return

    def handle_data(self, data):
        if not self.silent:
            self.texts.append(data)

    def _imply(self, tag):
        """End the open elements that a new ``tag`` ends."""
        for k in range(len(self.open) - 1, -1, -1):
            own = self.open[k][0]
            if tag in CLOSED_BY.get(own, ()):
                self._close(k)
                return
            if own in LIMITS.get(tag, ()) or own in ("div", "body", "article", "section", "table"):
                return

    def _close(self, k):
        """End the k-th open element and all in it."""
        while len(self.open) > k:
            tag, start, texts, names, values = self.open.pop()
            self.at += 1
            self.silent -= tag in SILENT
            if names:
                text = " ".join("".join(self.texts[texts:]).split())
                self.found += [[n, start, self.at, len(self.open), values, text] for n in names]

    def nodes(self, html: str) -> list[list]:
        self.feed(html)
        self.close()
        self._close(0)
        return sorted(self.found, key=lambda x: x[1])


#: Name of the node that is the whole page.
PAGE = "_page"
_COLUMNS = ["row", "key", "name", "start", "end", "depth", "attrs", "text"]
_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.string()]


#: Nodes, and characters of their text, from which on a task hands on what it has (a page's nodes stay together).
PIECE_NODES, PIECE_TEXT = 1 << 12, 1 << 22


def page_nodes(pages: DataFrame, selectors: Mapping[str, Selector], html: str = "html",
               keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """The node table: ``row`` (a number for each page row), ``key`` (struct of the
    columns ``keep``), ``name`` (of the selector), ``start``, ``end``, ``depth``,
    ``attrs`` (lower-case names) and ``text`` (white space as one blank).

    An element that several selectors name is a row for each; every page row,
    also a null one, has a node named ``PAGE`` around all others.
    """
    wanted = list(selectors.items())

    def made(batch: pa.RecordBatch, seen: int, rows: list, source: list) -> pa.RecordBatch:
        values = list(zip(*rows))
        values[4] = [list(v.items()) for v in values[4]]
        return pa.RecordBatch.from_arrays(
            [pa.array([seen + i for i in source], pa.int64()), batch.column(0).take(pa.array(source, pa.int64())),
             *(pa.array(list(v), t) for v, t in zip(values, _KINDS))], _COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, source, held = [], [], 0
            for i, page in enumerate(batch.column(1)):
                found = _Nodes(wanted).nodes(page.as_py() or "")
                rows += [[PAGE, 0, found[-1][2] + 1 if found else 1, -1, {}, ""], *found]
                source += [i] * (1 + len(found))
                held += sum(len(x[5]) for x in found)
                if len(rows) >= PIECE_NODES or held >= PIECE_TEXT:
                    yield made(batch, seen, rows, source)
                    rows, source, held = [], [], 0
            if rows:
                yield made(batch, seen, rows, source)
            seen += batch.num_rows

    key = F.struct(*keep)
    kind = pages.select(key.alias("key")).schema["key"].dataType.simpleString()
    return pages.select(key.alias("key"), html).mapInArrow(
        run, f"row bigint, key {kind}, name string, start bigint, end bigint, depth bigint, "
             "attrs map<string,string>, text string")


def innermost(nodes: DataFrame, card: str) -> DataFrame:
    """``nodes`` with ``card``, the ``start`` of the innermost element named
    ``card`` that holds the row's element (a card holds itself; null outside).

    The containment join: see the module notes.
    """
    is_card = F.col("name") == card
    tags = nodes.withColumn("_step", F.explode(F.when(is_card, F.array(F.lit(1), F.lit(-1))).otherwise(F.array(F.lit(1)))))
    tags = tags.withColumn("_at", F.when(F.col("_step") == 1, F.col("start")).otherwise(F.col("end")))
    order = [F.col("_at"), ~is_card]  # a card comes before the other names of its element
    running = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    events = tags.withColumn(
        "_in", F.sum(F.when(is_card, F.col("_step")).otherwise(0)).over(running.partitionBy("row")))
    opened = F.when(is_card & (F.col("_step") == 1), F.col("start"))
    last = F.last(opened, ignorenulls=True).over(running.partitionBy("row", "_in"))
    return (events.withColumn("card", F.when(F.col("_in") > 0, last)).where(F.col("_step") == 1)
            .drop("_at", "_step", "_in"))


def _values(name: str, f: Field) -> Column:
    """The value of the n-th element that a field names."""
    mine = F.col("name") == f"f_{name}"
    if f.nth == 0:
        return F.min_by(F.when(mine, f.value()), F.when(mine, F.col("start")))
    # Bounded by the elements of one card.
    listed = F.sort_array(F.collect_list(F.when(mine, F.struct("start", f.value().alias("v")))))
    return F.get(listed, F.lit(f.nth)).getField("v")


def _grouped(nodes: DataFrame, by: Sequence[str], fields: Mapping[str, Field], slot: Sequence[Column]) -> DataFrame:
    made = [F.first("key").alias("key"), *(_values(n, f).alias(f"v_{n}") for n, f in fields.items())]
    return nodes.groupBy(*by).agg(*made).select("key.*", *slot, *(F.col(f"v_{n}").alias(n) for n in fields))


def card_fields(pages: DataFrame, card: Selector, fields: Mapping[str, Field], html: str = "html",
                keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """One row per card: ``keep``, ``slot`` (its number in the page, from 0)
    and the fields; a field that the card lacks is null.

    An element counts for its innermost card only, also where cards are nested.
    Repeated page rows give repeated cards; a page without cards gives none.
    """
    nodes = page_nodes(pages, {"_card": card, **{f"f_{n}": f.selector for n, f in fields.items()}}, html, keep)
    placed = innermost(nodes, "_card").where(F.col("card").isNotNull())
    slot = (F.row_number().over(Window.partitionBy("row").orderBy("card")) - 1).cast("long").alias("slot")
    return _grouped(placed, ["row", "card"], fields, [slot])


def page_fields(pages: DataFrame, fields: Mapping[str, Field], html: str = "html",
                keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """One row per page row with its fields; null where the page lacks one."""
    nodes = page_nodes(pages, {f"f_{n}": f.selector for n, f in fields.items()}, html, keep)
    return _grouped(nodes, ["row"], fields, [])


def page_elements(pages: DataFrame, selector: Selector, html: str = "html",
                  keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """One row per element of a selector: ``keep``, ``slot`` (from 0), ``attrs``, ``text``."""
    nodes = page_nodes(pages, {"e": selector}, html, keep).where(F.col("name") == "e")
    slot = (F.row_number().over(Window.partitionBy("row").orderBy("start")) - 1).cast("long")
    return nodes.withColumn("slot", slot).select("key.*", "slot", "attrs", "text")
