import math
import random
import re

import pytest

from opinio.operators import valence as val

LEX = {"good": 1.9, "bad": -2.5, "fine": 0.8, "hope": 1.9, "zero": 0.0}
BOOST = {"very": 0.293, "hardly": -0.293, "so": 0.293}
NEG = {"not", "never", "so"}


def brute(text):
    """Plain Python over the word list."""
    words = re.findall(val.WORD, text or "")
    up = [w.upper() == w and w.lower() != w for w in words]
    mixed = any(up) and not all(up)
    out = []
    for i, w in enumerate(words):
        v = LEX.get(w.lower(), 0.0)
        if v:
            sign = lambda x: (x > 0) - (x < 0)
            v += 0.733 * sign(v) * (up[i] and mixed)
            for back, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
                if i - back < 0 or LEX.get(words[i - back].lower(), 0.0):
                    continue
                p = words[i - back].lower()
                if p in BOOST:
                    v += (BOOST[p] + 0.733 * (up[i - back] and mixed)) * sign(v) * damp
                if p in NEG:
                    v *= -0.74
        out.append(v)
    ps, ns = sum(v + 1 for v in out if v > 0), sum(1 - v for v in out if v < 0)
    nu, s = sum(v == 0 for v in out), sum(out)
    total = ps + ns + nu
    return tuple(x / total if total else 0.0 for x in (ns, nu, ps)) + (s / math.sqrt(s * s + 15),)


def tables(spark):
    return (spark.createDataFrame(list(LEX.items()), "token string, valence double"),
            spark.createDataFrame([*BOOST.items(), ("very", 0.1)], "token string, shift double"),
            spark.createDataFrame([(x,) for x in NEG], "token string"))


def run(spark, texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "review_id string, review_content string")
    rows = {r.review_id: r for r in val.shifted_sentiment(df, *tables(spark)).collect()}
    return [tuple(rows[str(i)])[1:] for i in range(len(texts))]


CASES = ["good", "not good", "very good", "very bad", "hardly good", "not very good", "never so bad", "VERY good food",
         "GOOD food", "GOOD", "not a good", "not a b good", "not a b c good", "good good not", "not good bad",
         "bad not good", "zero good", "", None, "12 !", "Not, very; GOOD.", "so BAD so"]


def test_rules_one_by_one(spark):
    got = dict(zip(CASES, run(spark, CASES)))
    for t in CASES:
        assert got[t] == pytest.approx(brute(t), abs=1e-12), t
    comp = lambda t: got[t][3]
    assert comp("not good") < 0 < comp("good") < comp("very good") and comp("very bad") < comp("never so bad")
    assert comp("hardly good") < comp("good") == comp("GOOD") < comp("GOOD food") and comp("not a b c good") > 0


def test_random_texts_match_plain_python(spark):
    rnd = random.Random(2)
    pool = [*LEX, *BOOST, *NEG, "a", "table", "food"]
    texts = [" ".join((lambda w: w.upper() if rnd.random() < 0.2 else w)(rnd.choice(pool)) for _ in range(rnd.randrange(30)))
             for _ in range(300)] + ["not very good " * 3000]
    for t, got in zip(texts, run(spark, texts)):
        assert got == pytest.approx(brute(t), abs=1e-9), t[:80]


def test_class_lexicon(spark):
    rows = [("N", "good good meal"), ("N", "good table"), ("Y", "bad meal Bad"), ("Y", "table"), (None, "good"), ("X", "bad")]
    df = spark.createDataFrame(rows, "c string, review_content string")
    got = {r.token: r.valence for r in val.class_lexicon(df, "c", "N", "Y", least=2).collect()}
    n, y = 5, 4
    rate = lambda g, b: 4 * (g / n - b / y) / (g / n + b / y)
    assert got == pytest.approx({"good": 4.0, "bad": -4.0, "meal": rate(1, 1), "table": rate(1, 1)})


def test_no_rows(spark):
    df = spark.createDataFrame([], "review_id string, review_content string")
    assert val.shifted_sentiment(df, *tables(spark)).count() == 0


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString().lower()


def test_lexicon_reads_texts_once(spark):
    df = spark.createDataFrame([("N", "good food"), ("Y", "bad food")], "c string, review_content string")
    assert "regexp_extract_all" not in _plan(val.class_lexicon(df, "c", "N", "Y", least=1))


def test_shifts_do_not_repeat_the_valence(spark):
    df = spark.createDataFrame([("a", "not very good")], "review_id string, review_content string")
    assert _plan(val.shifted_sentiment(df, *tables(spark))).count("signum(") <= 1 + len(val.DAMPING)
