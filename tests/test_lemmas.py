import itertools
import random

import numpy as np
import pytest

from opinio.operators import lemmas as lm

VOCAB = {("dish", "n"), ("knife", "n"), ("man", "n"), ("city", "n"), ("box", "n"), ("glass", "n"), ("love", "v"), ("wait", "v"),
         ("bake", "v"), ("try", "v"), ("go", "v"), ("cold", "a"), ("nice", "a"), ("good", "a"), ("wolf", "n"), ("as", "n"),
         ("a", "n"), ("build", "v"), ("building", "n"), ("quickly", "r"), ("hope", "v"), ("hop", "v"), ("sing", "v")}
EXC = {("went", "v"): ["go"], ("better", "a"): ["good"], ("knives", "n"): ["knife", "knive"], ("as", "v"): ["missing"]}


def brute(form, tag):
    """Exceptions or rules, step by step; the shortest known candidate of the first step that has one."""
    rules = lm.RULES.get(tag, [])

    def apply(forms):
        return [f[:len(f) - len(e)] + n for f in forms for e, n in rules if f.endswith(e) and f[:len(f) - len(e)] + n]

    if (form, tag) in EXC:
        steps = [[form, *EXC[form, tag]]]
    else:
        made = apply([form])
        steps = [[form, *made]]
        for _ in range(lm.STEPS - 1):
            made = apply(made)
            steps.append(made)
    for step in steps:
        known = [c for c in step if (c, tag) in VOCAB]
        if known:
            return min(known, key=len)
    return form


def tables(spark):
    return (spark.createDataFrame(sorted(VOCAB) + [("dish", "n")], "lemma string, tag string"),
            spark.createDataFrame([(f, t, x) for (f, t), xs in EXC.items() for x in xs], "form string, tag string, lemma string"))


def test_lemmas_match_plain_python(spark):
    rnd = random.Random(4)
    forms = ["dishes", "knives", "men", "cities", "boxes", "glasses", "loved", "waiting", "waits", "baking", "tries", "went",
             "colder", "nicest", "better", "wolves", "as", "buildings", "quickly", "hoping", "hopping", "sings", "xyz", "s",
             "singing", "hopes", "womens", "citieses"]
    forms += ["".join(rnd.choice(["s", "es", "ing", "ed", "er", "bak", "hop", "ies"]) for _ in range(3)) for _ in range(150)]
    rows = [(str(i), i, f, t) for i, (f, t) in enumerate(itertools.product(forms, ["n", "v", "a", "r", "?"]))]
    rows += [("x", 0, "dishes", "n"), ("y", 0, None, "n"), ("z", 0, "dishes", None)]
    df = spark.createDataFrame(rows, "review_id string, pos long, token string, tag string")
    got = {(r.review_id, r.pos): r.lemma for r in lm.lemmatise(df, *tables(spark)).collect()}
    assert len(got) == len(rows)
    assert got["y", 0] is None and got["z", 0] == "dishes"
    for i, p, f, t in rows:
        if f and t:
            assert got[i, p] == brute(f, t), (f, t)
    assert (brute("dishes", "n"), brute("loved", "v"), brute("went", "v"), brute("nicest", "a")) == ("dish", "love", "go", "nice")


def all_sequences(scores, start, after):
    """The best score over every sequence."""
    n, t = scores.shape
    return max(start[s[0]] + sum(scores[i, s[i]] for i in range(n)) + sum(after[a, b] for a, b in zip(s, s[1:]))
               for s in itertools.product(range(t), repeat=n))


def test_tags_are_the_best_sequence():
    rng = np.random.default_rng(5)
    start, after = rng.normal(size=3), rng.normal(size=(3, 3))
    mats = [rng.normal(size=(n, 3)) for n in (0, 1, 2, 7, 4, 4, 0, 6)]
    for m, path in zip(mats, lm.best_tags(mats, start, after)):
        assert len(path) == len(m)
        if len(m):
            score = start[path[0]] + m[range(len(m)), path].sum() + sum(after[a, b] for a, b in zip(path, path[1:]))
            assert score == pytest.approx(all_sequences(m, start, after))


def test_context_decides_a_tag(spark):
    scores = [("the", "d", 3.0), ("waits", "n", 1.0), ("waits", "v", 1.2), ("he", "p", 3.0)]
    follow = {("d", "n"): 1.0, ("p", "v"): 1.0}
    rows = [("1", 0, "the"), ("1", 1, "waits"), ("2", 0, "he"), ("2", 1, "waits"), ("3", 0, "unseen")] + \
        [("4", i, w) for i, w in enumerate(["he", "waits", "the"] * 700)]
    toks = spark.createDataFrame(rows, "review_id string, pos long, token string")
    tagged = lm.tag_words(toks, spark.createDataFrame(scores, "token string, tag string, score double"), follow,
                          ["n", "v", "d", "p"])
    got = {(r.review_id, r.pos): (r.token, r.tag) for r in tagged.collect()}
    assert len(got) == len(rows)
    assert got["1", 1] == ("waits", "n") and got["2", 1] == ("waits", "v") and got["3", 0] == ("unseen", "n")
    assert got["4", 1801] == ("waits", "v")
    out = lm.lemmatise(tagged.where("review_id < '3'"), *tables(spark))
    assert {(r.token, r.tag, r.lemma) for r in out.collect()} >= {("waits", "v", "wait"), ("waits", "n", "waits")}


def test_no_words(spark):
    toks = spark.createDataFrame([], "review_id string, pos long, token string")
    scores = spark.createDataFrame([], "token string, tag string, score double")
    tagged = lm.tag_words(toks, scores, {}, ["n"])
    assert tagged.count() == 0 and lm.lemmatise(tagged, *tables(spark)).count() == 0
