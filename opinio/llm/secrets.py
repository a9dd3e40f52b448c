"""Secret scans by a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean trigram query is derived: an
AND of clauses, each an OR of conjunctions of trigrams that any match must
contain (in lower case). Postings of just these trigrams are built for all
texts, intersected per conjunction, and the resulting candidates are joined
back to the texts and verified by the expression itself. Rules that have no
mandatory trigram (a bare run of hexadecimal digits) scan every text.

Postings are keyed by a hash of id and text, so null and repeated ids need no
care and a collision costs one more verification, never a result.

Spans are found without user code: ``split`` gives the text between the
matches and ``regexp_extract_all`` the matches, and the running sum of their
lengths gives the positions (code points, end exclusive).

Defined results: null text is the empty text (no spans); every input row
gives one row; extra columns are not carried; an empty table gives an empty
result.
"""

from __future__ import annotations

import re._constants as sc
import re._parser as sre
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import distinct_names, text_of


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least
    ``least`` characters. ``base`` rules are counted on their own. ``same``
    gives the same spans with the length built in; it exists where a match
    that is too short holds no other start of a longer one."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False
    same: str | None = None


#: The rules, in the order in which kinds are listed.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=6, base=True),
    Rule("access", "AKIA[A-Z0-9]+", least=20, base=True, same="AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]+", least=24, base=True, same="[0-9a-f]{24,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", least=16),
    Rule("google", "AIza[0-9A-Za-z_-]+", least=39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=30),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^/\s:@?#]+:[^/\s:@?#]+@", least=8),
)

#: A query is an AND of clauses; a clause is an OR of sets of trigrams.
Query = list[frozenset[frozenset[str]]]

#: Most strings that an expression part may stand for before it is left out of the query.
STRINGS = 64


def trigram_query(pattern: str) -> Query:
    """The trigrams that every match of ``pattern`` contains, lower-cased."""
    return _query(sre.parse(pattern))


def _strings(op, arg) -> set[str] | None:
    """All strings that a part matches, in lower case, or None if too many."""
    if op is sc.LITERAL:
        return {chr(arg).lower()}
    if op is sc.IN and all(o is sc.LITERAL for o, _ in arg):
        return {chr(a).lower() for _, a in arg}
    if op is sc.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sc.BRANCH:
        found = [_sequence(x) for x in arg[1]]
        return None if None in found else set().union(*found)
    if op in (sc.MAX_REPEAT, sc.MIN_REPEAT) and arg[1] <= 8:
        once = _sequence(arg[2])
        if once is None:
            return None
        out, power = set(), {""}
        for n in range(arg[1] + 1):
            if n >= arg[0]:
                out |= power
            power = {a + b for a in power for b in once}
            if len(power) > STRINGS:
                return None
        return out
    return None


def _sequence(parts) -> set[str] | None:
    out = {""}
    for op, arg in parts:
        more = _strings(op, arg)
        if more is None or len(out) * len(more) > STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _query(parts) -> Query:
    """Clauses of a sequence: one for each run of parts with known strings."""
    clauses, run = [], {""}

    def close() -> None:
        sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in run}
        if frozenset() not in sets:
            clauses.append(frozenset(s for s in sets if not any(t < s for t in sets)))

    for op, arg in parts:
        more = _strings(op, arg)
        if more is not None and len(run) * len(more) <= STRINGS:
            run = {a + b for a in run for b in more}
            continue
        close()
        run = {""}
        if op is sc.SUBPATTERN:
            clauses += _query(arg[-1])
        elif op in (sc.MAX_REPEAT, sc.MIN_REPEAT) and arg[0] > 0:
            clauses += _query(arg[2])
    close()
    return clauses


def _indexed(rules: tuple[Rule, ...]) -> dict[str, Query]:
    return {r.kind: q for r in rules if (q := trigram_query(r.pattern))}


def postings(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index of the given trigrams: (``trigram``, ``key``)."""
    # Inside transform() the lowered text is bound once, not once a trigram.
    found = F.transform(F.array(F.lower("text")), lambda low: F.array_compact(
        F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams])))
    return keyed.select("key", F.explode(F.flatten(found)).alias("trigram"))


def candidates(keyed: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Keys of the texts that may match, with the kinds (``kinds``) to verify.

    One shuffle of postings by key; the intersections within are by counting.
    """
    plan = [(kind, i, j, t, len(conjunct), len(query))
            for kind, query in _indexed(rules).items()
            for i, clause in enumerate(query)
            for j, conjunct in enumerate(sorted(map(sorted, clause)))
            for t in conjunct]
    spark = keyed.sparkSession
    # A row for each trigram of the rules: some hundred, fixed by the rules.
    wanted = spark.createDataFrame(plan, "kind string, clause int, conjunct int, trigram string, need int, clauses int")
    index = postings(keyed, sorted({p[3] for p in plan})).repartition("key")
    held = index.join(F.broadcast(wanted), "trigram")
    both = (held.groupBy("key", "kind", "clauses", "clause", "conjunct", "need")
            .agg(F.countDistinct("trigram").alias("_n")).where("_n = need"))
    fit = both.groupBy("key", "kind", "clauses").agg(F.countDistinct("clause").alias("_c")).where("_c = clauses")
    return fit.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans of one rule, leftmost and non-overlapping, as an array of
    (start, kind's number, end, kind)."""
    pattern = rule.same or rule.pattern
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x))
    judged = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)), lambda x: F.length(x))
    none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")

    def step(acc: Column, m: Column) -> Column:
        begin = acc["at"] + m["0"]
        end = begin + m["1"]
        one = F.array(F.struct(begin.alias("start"), F.lit(number).alias("number"), end.alias("end"),
                               F.lit(rule.kind).alias("kind")))
        return F.struct(end.alias("at"),
                        F.when(m["2"] >= rule.least, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    # The last gap has no match after it: its sizes are null and add no span.
    found = F.aggregate(F.arrays_zip(gaps, sizes, judged), F.struct(F.lit(0).alias("at"), none.alias("out")),
                        step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def joined(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: id and ``spans`` (``spans_`` beside an id of that
    name), an array of (start, number, end, kind) ordered by start, then kind as listed."""
    keyed = (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
             .withColumn("key", F.xxhash64("id", "text")))
    indexed = _indexed(rules)
    hits = candidates(keyed, rules).withColumnRenamed("key", "_key")
    both = keyed.join(hits, F.col("key") == F.col("_key"), "left")
    found = []
    for number, rule in enumerate(rules):
        own = spans(F.col("text"), rule, number)
        if rule.kind in indexed:
            none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
            own = F.when(F.array_contains("kinds", rule.kind), own).otherwise(none)
        found.append(own)
    names = distinct_names(id_col, "spans")
    return both.select(F.col("id").alias(names[0]),
                       F.array_sort(reduce(lambda a, b: F.concat(a, b), found)).alias(names[1]))
