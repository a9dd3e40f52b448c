"""URL filters by a sort-merge range join.

A host is written with its labels reversed (``www.example.com`` becomes
``com.example.www.``), so a rule for a host and all its subdomains is the
interval of keys that begin with the rule's key, and such intervals nest or
are disjoint. Urls and rules are range-partitioned and sorted by key together;
a sweep over each partition keeps the stack of rules whose interval is open
and decides each url from it. The rules that are open where a partition
begins are those whose key is a prefix of its first key; they are joined to
the partition by its first key's label prefixes.

The order continues with path and id, so a host that holds a third of all
urls is dealt over many partitions, and its rules are carried into each.

A rule fits a url of its host or a subdomain if the url's path starts with
the rule's. The longest rule (host and path together) wins, then the one with
the longer host; of equal rules with different verdicts, ``block`` wins.

Defined results: a null url, or one without ``://``, has an empty host and
path and fits no rule; rows repeat as they come; rules with a null host are
ignored, a null path is empty; extra columns are not carried; an empty table
gives an empty result, no rules give the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import arrow_map, distinct_names, materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """The host with its labels reversed, each closed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _key_prefixes(key: Column) -> Column:
    """The keys of a host key's host and of all its parent domains."""
    labels = F.split(key, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels) - 1),
                       lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))


class OpenRules:
    """The stack of open rules: per key, its rules by path."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def move(self, key: str) -> None:
        """Close the intervals that end before ``key``."""
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def add(self, key: str, host: str, path: str, verdict: str) -> None:
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, []))
        _, rules, lengths = self.stack[-1]
        if path not in rules or verdict == "block":
            rules[path] = (host + path, verdict)
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def longest(self, path: str) -> tuple[str, str] | None:
        """The longest open rule that fits a path; of equals, the deeper host's."""
        best = None
        for _, rules, lengths in reversed(self.stack):
            for n in lengths:
                rule = rules.get(path[:n]) if n <= len(path) else None
                if rule is not None:
                    if best is None or len(rule[0]) > len(best[0]):
                        best = rule
                    break
        return best


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule`` (or null), ``verdict``
    (with a ``_`` where that is the id's name).

    ``rules`` has ``host``, ``path`` and ``verdict``.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    names = distinct_names(id_col, "host", "path", "rule", "verdict")
    urls = (pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
                         path_of(F.col(url_col)).alias("path"))
            .select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "host", "path",
                    F.lit(None).cast("string").alias("verdict"), "id"))
    marks = (rules.where("host is not null")
             .select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                     "verdict")
             .select(host_key(F.col("host")).alias("key"), F.lit(0).alias("kind"), "host", "path", "verdict",
                     F.lit(None).cast(kind).alias("id")))
    placed = (urls.unionByName(marks).repartitionByRange("key", "kind", "path", "id")
              .withColumn("part", F.spark_partition_id()))
    placed = materialise(placed, "url_order")  # part numbers are final once written
    first = placed.groupBy("part").agg(F.min("key").alias("_first"))
    carried = (first.select("part", F.explode(_key_prefixes(F.col("_first"))).alias("_key"))
               .join(marks, F.col("_key") == F.col("key")).drop("_key"))
    order = ["part", "key", "kind", "path", "id"]
    swept = placed.unionByName(carried).repartition("part").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rules, part = OpenRules(), None
        for batch in batches:
            keep, found = [], []
            parts, keys, kinds, hosts, paths, verdicts = (batch.column(i).to_pylist() for i in range(6))
            for i, key in enumerate(keys):
                if parts[i] != part:
                    open_rules, part = OpenRules(), parts[i]
                open_rules.move(key)
                if kinds[i] == 0:
                    open_rules.add(key, hosts[i], paths[i], verdicts[i])
                else:
                    keep.append(i)
                    found.append(open_rules.longest(paths[i]) or (None, default))
            rows = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column(6), rows.column(3), rows.column(4), pa.array([r for r, _ in found], pa.string()),
                 pa.array([v for _, v in found], pa.string())], names)

    return arrow_map(swept.select("part", "key", "kind", "host", "path", "verdict", "id"), run,
                     ", ".join(f"`{n}` {k}" for n, k in zip(names, (kind, *["string"] * 4))))
