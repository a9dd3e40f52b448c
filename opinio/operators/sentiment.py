"""Sentiment summaries (T5, T6, E1, E2) as joins against lookup tables.

The lemma table ``(form, lemma)`` and the valence lexicon ``(token,
valence)`` are caller-supplied DataFrames; Spark picks the join by their
measured size in bytes (``spark.sql.autoBroadcastJoinThreshold``, AQE).

Scores follow the lexicon-sum rule: per review, positive valences add
``v + 1``, negative add ``v - 1``, words without a valence count as neutral;
``pos/neg/neu`` are shares of the total (3 places) and ``compound`` is
``s / sqrt(s^2 + 15)`` of the plain valence sum ``s`` (4 places). Negation,
booster and capitalisation rules are not applied.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.text import sentiment_tokens

# A small English valence list (scale -4..4) used when no
# lexicon is supplied. Replace it with a full lexicon table in production.
DEFAULT_LEXICON = {
    "good": 1.9, "great": 3.1, "excellent": 2.7, "best": 3.2, "nice": 1.8,
    "love": 3.2, "happy": 2.7, "free": 1.6, "win": 2.8, "success": 2.7,
    "delicious": 2.7, "friendly": 2.2, "fresh": 1.3, "amazing": 2.8, "perfect": 2.7,
    "bad": -2.5, "worst": -3.1, "terrible": -2.1, "awful": -2.0, "poor": -2.1,
    "error": -1.7, "fail": -2.5, "hate": -2.7, "rude": -2.0, "dirty": -1.9,
    "slow": -0.9, "cold": -0.3, "secret": -0.2, "problem": -1.7, "sad": -2.1,
}


def lexicon_frame(spark: SparkSession, lexicon: dict | None = None) -> DataFrame:
    items = sorted((lexicon or DEFAULT_LEXICON).items())
    return spark.createDataFrame(items, "token string, valence double")


def clean_for_sentiment(df: DataFrame, text: str = "review_content", id_col: str = "review_id",
                        lemmas: DataFrame | None = None, stop_words: Iterable[str] | None = None) -> DataFrame:
    """T5 (+T6): ``(id, review_clean)``.

    Without a lemma table this is one projection. With one, tokens are
    exploded with their position, mapped through a left join (T6), and put
    back in order per review — a group bounded by one review's length.
    """
    toks = sentiment_tokens(text, stop_words)
    if lemmas is None:
        kept = F.filter(toks, lambda x: F.length(x) > 1)
        return df.select(id_col, F.array_join(kept, " ").alias("review_clean"))
    exploded = df.select(id_col, F.posexplode(toks).alias("pos", "form"))
    mapped = (exploded.join(lemmas.select("form", "lemma"), "form", "left")
              .select(id_col, "pos", F.coalesce("lemma", "form").alias("tok"))
              .where(F.length("tok") > 1))
    per = (mapped.groupBy(id_col)
           .agg(F.array_sort(F.collect_list(F.struct("pos", "tok"))).alias("s"))
           .select(id_col, F.array_join(F.col("s").getField("tok"), " ").alias("review_clean")))
    return (df.select(id_col).join(per, id_col, "left")
            .select(id_col, F.coalesce("review_clean", F.lit("")).alias("review_clean")))


def lemma_lookup(tokens: DataFrame, lemmas: DataFrame, token: str = "token") -> DataFrame:
    """Each token with its lemma (itself when the table has none)."""
    j = tokens.join(lemmas.select(F.col("form").alias(token), "lemma"), token, "left")
    return j.withColumn("lemma", F.coalesce("lemma", token))


def sentiment_scores(clean: DataFrame, lexicon: DataFrame, id_col: str = "review_id",
                     text: str = "review_clean") -> DataFrame:
    """``(id, neg, neu, pos, compound)`` per review (zeros for empty text)."""
    toks = F.filter(F.split(text, " "), lambda x: x != "")
    return _score(clean.select(id_col, F.explode_outer(toks).alias("token")), lexicon, id_col)


def _score(tokens: DataFrame, lexicon: DataFrame, id_col: str) -> DataFrame:
    """Scores of (id, token) rows; a review without tokens has one with a null token."""
    v = F.coalesce(F.col("valence"), F.lit(0.0))
    scored = tokens.join(lexicon.select("token", "valence"), "token", "left")
    agg = scored.groupBy(id_col).agg(
        F.sum(F.when(v > 0, v + 1).otherwise(0.0)).alias("ps"),
        F.sum(F.when(v < 0, v - 1).otherwise(0.0)).alias("ns"),
        F.count_if((v == 0) & F.col("token").isNotNull()).alias("nu"),
        F.sum(v).alias("s"))
    total = F.nullif(F.col("ps") + F.abs(F.col("ns")) + F.col("nu"), F.lit(0.0))
    zero = F.lit(0.0)
    return agg.select(
        id_col,
        F.coalesce(F.round(F.abs(F.col("ns")) / total, 3), zero).alias("neg"),
        F.coalesce(F.round(F.col("nu") / total, 3), zero).alias("neu"),
        F.coalesce(F.round(F.col("ps") / total, 3), zero).alias("pos"),
        F.round(F.col("s") / F.sqrt(F.col("s") * F.col("s") + F.lit(15.0)), 4).alias("compound"))


def text_sentiment(df: DataFrame, lexicon: DataFrame, text: str = "review_content",
                   id_col: str = "review_id", lemmas: DataFrame | None = None,
                   stop_words: Iterable[str] | None = None) -> DataFrame:
    """T5 + T6 + E1 in one pass over token rows.

    Same scores as ``sentiment_scores(clean_for_sentiment(...))``: the score
    does not depend on token order, so the cleaned string is never
    re-assembled. Reviews without tokens stay as one row with a null token, so
    the texts are read once and no join brings them back.
    """
    toks = df.select(id_col, F.explode_outer(sentiment_tokens(text, stop_words)).alias("form"))
    token = F.col("form")
    if lemmas is not None:
        toks = toks.join(lemmas.select("form", "lemma"), "form", "left")
        token = F.coalesce("lemma", "form")
    # Tokens of one character count for nothing, but keep their review's row.
    return _score(toks.select(id_col, F.when(F.length(token) > 1, token).alias("token")), lexicon, id_col)
