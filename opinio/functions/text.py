"""Text column builders (all JVM-side expressions, no Python UDFs).

Regex spelling: the cleaning rules are defined on Unicode word characters
(letters, numbers, underscore) and Unicode whitespace, so the patterns
spell those classes out instead of using Java's ASCII-only ``\\w``/``\\s``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinio.functions.stopwords import ENGLISH_STOP_WORDS

# Character classes that define "word" and "whitespace".
WORD_CLASS = r"[\p{L}\p{N}_]"
WHITESPACE_RUN = r"[\t\n\x0B\f\r\x1c-\x1f \x85\p{Z}]+"
# Fixed value: ASCII punctuation stripped from token edges for sentiment.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def default_stop_words() -> list[str]:
    """English stop list shipped with Spark ML (181 words)."""
    return list(ENGLISH_STOP_WORDS)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whitespace_tokens(c) -> Column:
    """Split on runs of Unicode whitespace; empty parts removed."""
    return F.filter(F.split(_col(c), WHITESPACE_RUN), lambda x: x != "")


def remove_stopwords(c, stop_words: Iterable[str] | None = None) -> Column:
    """Drop exact, case-sensitive stop-word tokens; null -> ''."""
    stop = list(default_stop_words() if stop_words is None else stop_words)
    toks = whitespace_tokens(c)
    if stop:
        toks = F.filter(toks, lambda x: ~x.isin(stop))
    return F.coalesce(F.array_join(toks, " "), F.lit(""))


def word_runs(c, min_len: int = 1) -> Column:
    """Maximal runs of Unicode word characters of at least ``min_len``."""
    pat = WORD_CLASS + ("+" if min_len <= 1 else "{%d,}" % min_len)
    return F.regexp_extract_all(_col(c), F.lit(f"({pat})"), 1)


def preprocess_content(c) -> Column:
    """Word runs joined by one space, then lower-cased; null -> ''."""
    return F.coalesce(F.lower(F.array_join(word_runs(c), " ")), F.lit(""))


def clean_content(c, stop_words: Iterable[str] | None = None) -> Column:
    """T1 then T2 — the review text stored in the final table."""
    return preprocess_content(remove_stopwords(c, stop_words))


def content_length(c, empty_is_zero: bool = False) -> Column:
    """Number of parts of ``split(' ')``; '' counts 1 unless ``empty_is_zero``."""
    n = F.size(F.split(F.coalesce(_col(c), F.lit("")), " ")).cast("long")
    if empty_is_zero:
        n = F.when(F.coalesce(_col(c), F.lit("")) == "", F.lit(0).cast("long")).otherwise(n)
    return n


def tfidf_tokens(c) -> Column:
    """T4: the TF-IDF tokeniser — word runs of two or more characters."""
    return word_runs(c, min_len=2)


def sentiment_tokens(c, stop_words: Iterable[str] | None = None) -> Column:
    """T5 minus lemmatisation: lower, split on ' ', strip edge punctuation,
    drop tokens with digits, stop words and empties (an array column)."""
    stop = list(default_stop_words() if stop_words is None else stop_words)
    punct = "[" + "".join("\\" + ch for ch in PUNCTUATION) + "]"
    text = F.lower(F.coalesce(_col(c), F.lit("None")))
    toks = F.transform(F.split(text, " "),
                       lambda x: F.regexp_replace(x, f"^{punct}+|{punct}+$", ""))
    toks = F.filter(toks, lambda x: ~x.rlike(r"\p{Nd}"))
    if stop:
        toks = F.filter(toks, lambda x: ~x.isin(stop))
    return F.filter(toks, lambda x: F.length(x) > 0)


def split_first(c, sep: str = " ") -> Column:
    """First part of a split."""
    return F.split_part(_col(c), F.lit(sep), F.lit(1))


def split_last(c, sep: str = " ") -> Column:
    """Last part of a split (``element_at(split, -1)``)."""
    return F.split_part(_col(c), F.lit(sep), F.lit(-1))


def count_or_zero(c, sep: str = " ") -> Column:
    """Last part as a number when the text has more than one part, else 0."""
    parts = F.split(_col(c), _regex_quote(sep))
    return F.when(F.size(parts) > 1, F.element_at(parts, -1).try_cast("long")).otherwise(F.lit(0).cast("long"))


def surrogate_key(*cols, length: int = 22) -> Column:
    """Deterministic alphanumeric key from content (replaces a random id)."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("\u0000")) for c in cols]
    return F.substring(F.sha2(F.concat_ws("~", *parts), 256), 1, length)


def _regex_quote(s: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in s)
