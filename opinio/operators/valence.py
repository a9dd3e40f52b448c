"""E1 with valence shifters: negation, boosters and capitals change a word's valence.

A word with a valence takes it from the lexicon; then

* capitals (in a text that also has other words) add ``CAPITALS`` in the
  direction of the valence;
* each of the three words before it that has no valence of its own shifts it:
  a booster by its shift (against the sign for a negative word; with capitals
  by ``CAPITALS`` more), by 95 % at the second and 90 % at the third place
  back, and a negation multiplies it by ``NEGATION``.

The shifted valences are scored like the plain ones. The tables are the
caller's. Words meet them in one join; then each review's words are one
sorted array (bounded by one text), and the three places before a word are
read from it by index, without windows.

Defined results: a null or empty text has no words and scores 0; an entry
that is in several tables keeps its valence, shift and negation alike;
repeated entries count once (largest shift and valence).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.operators.similarity import materialise

# The published weights of the rule.
CAPITALS = 0.733
NEGATION = -0.74
DAMPING = (1.0, 0.95, 0.9)
NORM = 15.0
WORD = "[A-Za-zÀ-ɏ]+"


def words(text: str) -> Column:
    """Words of a text, as written, in order."""
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def shifter_table(lexicon: DataFrame, boosters: DataFrame, negations: DataFrame) -> DataFrame:
    """``word``, ``valence``, ``shift``, ``negates`` from (token, valence), (token, shift) and (token)."""
    none, no = F.lit(None).cast("double"), F.lit(False)
    rows = (lexicon.select(F.lower("token").alias("word"), F.col("valence").cast("double").alias("valence"),
                           none.alias("shift"), no.alias("negates"))
            .unionByName(boosters.select(F.lower("token").alias("word"), none.alias("valence"),
                                         F.col("shift").cast("double").alias("shift"), no.alias("negates")))
            .unionByName(negations.select(F.lower("token").alias("word"), none.alias("valence"), none.alias("shift"),
                                          F.lit(True).alias("negates"))))
    return rows.groupBy("word").agg(F.max("valence").alias("valence"), F.max("shift").alias("shift"),
                                    F.max("negates").alias("negates"))


def _loud(x: Column) -> Column:
    # Capitals mean something only beside other words.
    return F.when(x.getField("loud") & F.col("mixed"), F.lit(CAPITALS)).otherwise(0.0)


def _neutral(x: Column) -> Column:
    return F.coalesce(x.getField("valence"), F.lit(0.0)) == 0


def _shifted(v: Column, p: Column, damping: float) -> Column:
    """The valence ``v`` of a word after the shift by an earlier word ``p``."""
    by = (p.getField("shift") + _loud(p)) * F.signum(v)
    v = v + F.coalesce(by, F.lit(0.0)) * damping
    return v * F.when(F.coalesce(p.getField("negates"), F.lit(False)), F.lit(NEGATION)).otherwise(1.0)


def _moved(back: int, damping: float) -> Callable[[Column, Column], Column]:
    """What the word ``back`` places before makes of the valence of word ``i`` of ``line``."""
    def moved(v: Column, i: Column) -> Column:
        p = F.get("line", i - back)
        idle = _neutral(F.get("line", i)) | p.isNull() | ~_neutral(p)
        return F.when(idle, v).otherwise(_shifted(v, p, damping))

    return moved


def shifted_valences(df: DataFrame, shifters: DataFrame, text: str = "review_content",
                     id_col: str = "review_id") -> DataFrame:
    """``(id, values)``: the shifted valence of each word of a review, in order; null without words."""
    found = df.select(id_col, F.posexplode_outer(words(text)).alias("pos", "token")).withColumn("word", F.lower("token"))
    loud = (F.upper("token") == F.col("token")) & (F.col("word") != F.col("token"))
    met = found.join(shifters, "word", "left").withColumn("loud", loud)
    lines = met.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct(
            "pos", "valence", "shift", "negates", "loud")))).alias("line"),
        (F.max("loud") & ~F.min("loud")).alias("mixed"))
    own = F.transform("line", lambda x: F.when(_neutral(x), F.lit(0.0)).otherwise(
        x.getField("valence") + _loud(x) * F.signum(x.getField("valence"))))
    lines = lines.select(id_col, "line", "mixed", own.alias("values"))
    # One array for each place back: a word's valence is a variable, not an ever longer expression.
    for back, damping in enumerate(DAMPING, 1):
        lines = lines.select(id_col, "line", "mixed", F.transform("values", _moved(back, damping)).alias("values"))
    return lines.select(id_col, "values")


def score_valences(valued: DataFrame, id_col: str = "review_id", values: str = "values") -> DataFrame:
    """``(id, neg, neu, pos, compound)`` of arrays of valences (zeros without words)."""
    v = F.col(values)

    def total(of) -> Column:
        return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + of(x))

    sums = valued.select(
        id_col, total(lambda x: F.when(x > 0, x + 1).otherwise(0.0)).alias("ps"),
        total(lambda x: F.when(x < 0, 1 - x).otherwise(0.0)).alias("ns"),
        total(lambda x: F.when(x == 0, F.lit(1.0)).otherwise(0.0)).alias("nu"), total(lambda x: x).alias("s"))
    whole = F.nullif(F.col("ps") + F.col("ns") + F.col("nu"), F.lit(0.0))
    zero = F.lit(0.0)
    return sums.select(
        id_col, F.coalesce(F.col("ns") / whole, zero).alias("neg"), F.coalesce(F.col("nu") / whole, zero).alias("neu"),
        F.coalesce(F.col("ps") / whole, zero).alias("pos"),
        F.coalesce(F.col("s") / F.sqrt(F.col("s") * F.col("s") + F.lit(NORM)), zero).alias("compound"))


def shifted_sentiment(df: DataFrame, lexicon: DataFrame, boosters: DataFrame, negations: DataFrame,
                      text: str = "review_content", id_col: str = "review_id") -> DataFrame:
    """``(id, neg, neu, pos, compound)`` per review by shifted valences."""
    return score_valences(shifted_valences(df, shifter_table(lexicon, boosters, negations), text, id_col), id_col)


def class_lexicon(df: DataFrame, label: str, good, bad, least: int = 20, text: str = "review_content") -> DataFrame:
    """``(token, valence)`` learned from two classes of texts: 4 (g - b) / (g + b)
    of a word's rates in the good and in the bad class, for words seen ``least``
    times in them (and not equally often)."""
    found = df.where(F.col(label).isin([good, bad])).select(
        (F.col(label) == F.lit(good)).alias("good"), F.explode(words(text)).alias("token"))
    counts = found.groupBy(F.lower("token").alias("token")).agg(
        F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
    counts = materialise(counts, "class_words")  # read three times; the texts once
    all_g, all_b = (counts.agg(F.greatest(F.sum(c), F.lit(1))).scalar() for c in ("g", "b"))
    rate_g, rate_b = F.col("g") / all_g, F.col("b") / all_b
    return (counts.where(F.col("g") + F.col("b") >= least)
            .select("token", (4.0 * ((rate_g - rate_b) / (rate_g + rate_b))).alias("valence")).where("valence <> 0"))
