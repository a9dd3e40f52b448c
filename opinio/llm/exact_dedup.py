"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

1. Texts are normalised (ASCII white space deleted) and cut into chunks whose
   ends depend on content alone: after at least ``MIN`` characters, where a
   run of characters from given classes first occurs, or at ``MAX``
   characters. Equal texts give equal chunks, and most chunks outlive an edit
   elsewhere.
2. Each chunk gets a 64-bit identifier, verified over all chunks: where two
   chunks share an identifier but not their SHA-256, the digests take the
   identifier's place in the recipes that hold it. Only identifiers and
   digests move, pre-aggregated per task, never chunk texts.
3. A document's recipe is its ordered list of identifiers; documents are
   equal when their recipes are. Of equals, the row with the most code points
   stays, then the smallest id (null ids last), then the first row written.

The recipes are written once to the shared folder, so texts are read once and
do not take part in any shuffle. A hot group of copies is pre-aggregated per
task, and the join back splits skewed keys.

Defined results: null text is the empty text; all-blank texts are equal to
it; every input row gives one row, also repeated ones, and exactly one row of
a group is kept; extra columns are not carried; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import keep_rows, materialise, row_key, text_of

#: Chunk lengths in characters, and what may end a chunk between them.
MIN, MAX = 512, 8192
CUT = "[b-g][aeiou][n-t][a-h]."


def normalised(text: Column) -> Column:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def chunks(text: Column, least: int = MIN, most: int = MAX) -> Column:
    """Content-defined chunks of a text, in order (none for an empty one)."""
    pattern = f"(?s).{{{least},{most - 5}}}?{CUT}|.{{{most}}}|.+"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``row_id``, ``key``, id, code points, text digest, chunk
    identifiers ``cids`` and chunk digests ``shas``; written to the shared
    folder."""
    rows = (docs.select(F.col(id_col), text_of(text_col).alias("_text"))
            .select(F.col(id_col).alias("id"), row_key(id_col, "_text").alias("key"),
                    F.length("_text").cast("long").alias("n_chars"), normalised(F.col("_text")).alias("_norm"))
            .select("id", "key", "n_chars", F.sha2("_norm", 256).alias("text_sha256"),
                    chunks(F.col("_norm")).alias("_chunks"))
            .select(F.monotonically_increasing_id().alias("row_id"), "id", "key", "n_chars", "text_sha256",
                    F.transform("_chunks", lambda c: F.xxhash64(c)).alias("cids"),
                    F.transform("_chunks", lambda c: F.unhex(F.sha2(c, 256))).alias("shas")))
    return materialise(rows, "recipes")


def shared_identifiers(rows: DataFrame) -> DataFrame:
    """Identifiers that stand for more than one chunk digest (``cid``)."""
    each = rows.select(F.explode(F.arrays_zip("cids", "shas")).alias("c")).select("c.cids", "c.shas")
    return (each.groupBy(F.col("cids").alias("cid")).agg(F.min("shas").alias("_lo"), F.max("shas").alias("_hi"))
            .where("_lo <> _hi").select("cid"))


def verified(rows: DataFrame) -> DataFrame:
    """``rows`` with ``recipe``: identifiers, and digests where those clash.

    The clashing identifiers come to the driver: among n chunks there are
    about n^2 / 2^65 of them (none at a billion chunks, some hundred at 100 TB).
    """
    clashing = sorted(r.cid for r in shared_identifiers(rows).collect())
    named = F.array(*[F.lit(c).cast("long") for c in clashing]).cast("array<bigint>")
    exact = F.filter(F.arrays_zip("cids", "shas"), lambda c: F.array_contains(named, c["cids"]))
    fixes = F.transform(exact, lambda c: c["shas"]) if clashing else F.array().cast("array<binary>")
    return rows.withColumn("recipe", F.struct(F.col("cids").alias("ids"), fixes.alias("digests")))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``key``, ``keep_id``, ``group_size``,
    ``kept``, ``text_sha256``, ``n_chars``."""
    rows = verified(recipes(docs, id_col, text_col))
    best = F.struct((-F.col("n_chars")).alias("a"), F.col("id").isNull().alias("b"), F.col("id").alias("id"),
                    F.col("row_id").alias("row"))
    groups = rows.groupBy("recipe").agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("group_size"))
    # Written, so that the join reads it by a shuffle of its own and can split a hot recipe.
    groups = materialise(groups.select(F.col("recipe").alias("_recipe"), "best", "group_size"), "groups")
    return (rows.join(groups, F.col("recipe") == F.col("_recipe"))
            .select("id", "key", F.col("best.id").alias("keep_id"), "group_size",
                    (F.col("best.row") == F.col("row_id")).alias("kept"), "text_sha256", "n_chars"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``, ``n_chars``."""
    return judged(docs, id_col, text_col).select(F.col("id").alias(id_col), "keep_id", "group_size", "kept",
                                                 "text_sha256", "n_chars")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of each text that stays, with all its columns."""
    return keep_rows(docs, judged(docs, id_col, text_col).where("kept"), id_col, text_col)
