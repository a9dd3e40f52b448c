"""Lemmas by part of speech.

*Tags.* A first-order model gives each word of a review a tag: the best
sequence under the words' scores for each tag and the scores of a tag after
another (dynamic programming; the reviews of a batch advance side by side). The
scores are the caller's tables.

*Lemmas.* A form's lemma under a tag is looked for once per distinct (form,
tag), not per occurrence: its exceptions, else the form itself and what the
detachment rules of the tag make of it, then what they make of that. Of the
candidates of the first step that are in the vocabulary, the shortest is the
lemma (ties: the earlier rule); without any, the form stays. The vocabulary
and the exceptions meet the candidates in joins, of any size.

Defined results: null or empty texts have no words; a form that neither table
knows is its own lemma; a tag without rules has only the form and its
exceptions; repeated table rows count once.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The published detachment rules (ending, replacement) by tag.
RULES: dict[str, list[tuple[str, str]]] = {
    "n": [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
          ("men", "man"), ("ies", "y")],
    "v": [("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", "")],
    "a": [("er", ""), ("est", ""), ("er", "e"), ("est", "e")],
    "r": [],
}
#: Times that the rules are applied to what they made.
STEPS = 3


def _detached(forms: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """What the rules make of each form, in the order of the forms and rules."""
    def of(form: Column) -> Column:
        return F.filter(F.array(*[F.when(F.endswith(form, F.lit(end)), F.concat(
            F.substring(form, F.lit(1), F.length(form) - len(end)), F.lit(new))) for end, new in rules]),
            lambda x: x.isNotNull() & (x != ""))

    return F.flatten(F.transform(forms, of)) if rules else F.array().cast("array<string>")


def _at_step(listed: Column, step: int) -> Column:
    return F.transform(listed, lambda x, i: F.struct(F.lit(step).alias("step"), i.alias("place"), x.alias("candidate")))


def candidates(forms: DataFrame, rules: Mapping[str, Sequence[tuple[str, str]]] = RULES, steps: int = STEPS) -> DataFrame:
    """``form``, ``tag``, ``step``, ``place``, ``candidate`` of distinct (form, tag) rows.

    The form itself and its first detachments are of step 1.
    """
    reached, df = [], forms
    for step in range(1, steps + 1):
        name = f"_s{step}"
        before = F.array("form") if step == 1 else F.col(f"_s{step - 1}")
        made = F.array().cast("array<string>")
        for tag, own in rules.items():
            made = F.when(F.col("tag") == tag, _detached(before, own)).otherwise(made)
        df = df.withColumn(name, made)
        listed = F.concat(F.array("form"), F.col(name)) if step == 1 else F.col(name)
        reached.append(_at_step(listed, step))
    return df.select("form", "tag", F.explode(F.concat(*reached)).alias("c")).select("form", "tag", "c.*")


def lemma_table(forms: DataFrame, vocabulary: DataFrame, exceptions: DataFrame | None = None,
                rules: Mapping[str, Sequence[tuple[str, str]]] = RULES) -> DataFrame:
    """``form``, ``tag``, ``lemma`` for the distinct (form, tag) rows of ``forms``.

    ``vocabulary`` has (lemma, tag), ``exceptions`` (form, tag, lemma).
    """
    forms = forms.select("form", "tag").where(F.col("form").isNotNull() & F.col("tag").isNotNull()).distinct()
    made = candidates(forms, rules)
    if exceptions is not None:
        # An exception takes the place of what the rules would make; the form itself stays a candidate.
        known = exceptions.select("form", "tag", F.lit(1).alias("step"), F.lit(1).alias("place"),
                                  F.col("lemma").alias("candidate"))
        own = made.where((F.col("step") == 1) & (F.col("place") == 0))
        ruled = made.join(known.select("form", "tag").distinct(), ["form", "tag"], "left_anti")
        made = ruled.unionByName(own.join(known.select("form", "tag").distinct(), ["form", "tag"], "left_semi")
                                 ).unionByName(known.join(forms, ["form", "tag"], "left_semi"))
    words = vocabulary.select(F.col("lemma").alias("candidate"), "tag").distinct()
    found = made.join(words, ["candidate", "tag"], "left_semi")
    rank = F.struct("step", F.length("candidate").alias("length"), "place", "candidate")
    best = found.groupBy("form", "tag").agg(F.min(rank).getField("candidate").alias("lemma"))
    return forms.join(best, ["form", "tag"], "left").select("form", "tag", F.coalesce("lemma", "form").alias("lemma"))


def lemmatise(tokens: DataFrame, vocabulary: DataFrame, exceptions: DataFrame | None = None,
              rules: Mapping[str, Sequence[tuple[str, str]]] = RULES) -> DataFrame:
    """``tokens`` (with ``token`` and ``tag``) with the ``lemma`` of each."""
    table = lemma_table(tokens.select(F.col("token").alias("form"), "tag"), vocabulary, exceptions, rules)
    table = table.select(F.col("form").alias("token"), "tag", "lemma")
    return tokens.join(table, ["token", "tag"], "left").withColumn("lemma", F.coalesce("lemma", "token"))


def best_tags(scores: list[np.ndarray], start: np.ndarray, after: np.ndarray) -> list[np.ndarray]:
    """The best tag sequence of each matrix (word by tag); of equal ones, the
    tag that comes first, from the last word back.

    ``after[a, b]`` is the score of tag b after tag a. The longest come first,
    so that those that still have words are the first rows.
    """
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = [len(scores[i]) for i in order]
    paths: list[np.ndarray] = [np.empty(0, np.int64)] * len(scores)
    live = sum(n > 0 for n in lengths)
    if not live:
        return paths
    best = np.stack([start + scores[i][0] for i in order[:live]])
    back: list[np.ndarray] = []
    ends: dict[int, np.ndarray] = {}
    for at in range(1, lengths[0] + 1):
        still = sum(n > at for n in lengths[:live])
        for r in range(still, live):
            ends[r] = best[r]
        live = still
        if not live:
            break
        reach = best[:live, :, None] + after[None]
        back.append(reach.argmax(axis=1))
        best = reach.max(axis=1) + np.stack([scores[i][at] for i in order[:live]])
    for r, i in enumerate(order[:len(ends)]):
        tag = int(ends[r].argmax())
        path = [tag]
        for at in range(lengths[r] - 2, -1, -1):
            tag = int(back[at][r][tag])
            path.append(tag)
        paths[i] = np.array(path[::-1])
    return paths


def tag_words(tokens: DataFrame, scores: DataFrame, follow: Mapping[tuple[str, str], float], tags: Sequence[str],
              start: Mapping[str, float] | None = None, unknown: Mapping[str, float] | None = None,
              id_col: str = "review_id") -> DataFrame:
    """``id``, ``pos``, ``token``, ``tag`` for rows of ``id``, ``pos``, ``token``.

    ``scores`` has (token, tag, score); a word that it lacks has ``unknown``
    (0). ``follow`` and ``start`` are the scores of a tag after another and at
    the beginning (0 where not given). A review's words are one row (bounded by
    its text).
    """
    tags = list(tags)
    first = np.array([(start or {}).get(t, 0.0) for t in tags])
    after = np.array([[follow.get((a, b), 0.0) for b in tags] for a in tags])
    blank = [float((unknown or {}).get(t, 0.0)) for t in tags]
    wide = (scores.where(F.col("tag").isin(tags)).groupBy("token")
            .agg(*[F.max(F.when(F.col("tag") == t, F.col("score"))).alias(f"t{k}") for k, t in enumerate(tags)]))
    each = F.array(*[F.coalesce(F.col(f"t{k}").cast("double"), F.lit(b)) for k, b in enumerate(blank)])
    lines = (tokens.join(wide, "token", "left").groupBy(id_col)
             .agg(F.sort_array(F.collect_list(F.struct("pos", "token", each.alias("scores")))).alias("line"))
             .select(id_col, F.col("line.pos").alias("pos"), F.col("line.token").alias("token"),
                     F.flatten(F.col("line.scores")).alias("scores")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64).reshape(-1, len(tags))
                     for x in batch.column(3)]
            paths = [[tags[k] for k in p] for p in best_tags(found, first, after)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(paths, pa.list_(pa.string()))],
                                             ["id", "pos", "token", "tag"])

    kinds = {f.name: f.dataType.simpleString() for f in tokens.schema.fields}
    tagged = lines.mapInArrow(run, f"id {kinds[id_col]}, pos array<{kinds['pos']}>, token array<string>, tag array<string>")
    return (tagged.select(F.col("id").alias(id_col), F.explode(F.arrays_zip("pos", "token", "tag")).alias("x"))
            .select(id_col, "x.pos", "x.token", "x.tag"))
