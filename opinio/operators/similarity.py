"""X1/X2/J6 — per-reviewer TF-IDF and the highest text similarity.

X1 fits TF-IDF separately inside every group (reviewer): raw term
frequency, smooth idf ``ln((1+n)/(1+df)) + 1`` with ``n`` the number of
the group's documents, L2-normalised rows. It is a long table
``(group, id, token, weight)`` built with group-bys and joins, never a
per-group matrix in memory.

X2 is the maximum cosine over pairs of distinct documents of a group
(0 for a single document or when no pair shares a token). Only tokens that
at least two documents of the group hold enter a dot product, so documents
fall into classes of equal shared sub-vectors (same shared tokens and
frequencies):

1. *Within a class* the dot product of any two members is the class's squared
   sub-vector norm S, so the maximum is S / (n1 n2) for the two smallest
   document norms: a rank limit and one aggregate, no pairs. Copies and
   template texts that differ in words of their own are one class.
2. *Between classes* only each class's smallest-norm document can win, so
   one representative per class goes on, and none in groups that have reached 1.
3. *In blocks.* Representatives of a group meet in keys of two blocks whose
   entries are bounded (:func:`in_blocks`); a group of n blocks sends each
   vector to n keys, so what is shuffled grows with vectors, never with pairs.
   In a key the cosines of all pairs are matrix products over the tokens that
   many documents hold, plus the postings that meet on the others.

The pairs of a group are quadratic in its representatives. They cost arithmetic
(4.5 million cosines a second and core, about), no rows, disk or shuffle.

The same maximum by an index at a threshold, in joins alone, is
:func:`postings` and :func:`candidate_pairs` with :func:`verify_pairs`: it shuffles
a row per pair that can reach the threshold, and both vectors to verify it.

Texts are cleaned and cut into tokens once: term frequencies are written per
document and read for the document frequencies and for the weights. Vectors
are kept one row per document. No large group, pair list or vector is collected
to the driver or to one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.functions.text import tfidf_tokens

_EPS = 1e-9


def materialise(df: DataFrame, name: str = "vectors", **options: str) -> DataFrame:
    """Write ``df`` as parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts lineage like ``checkpoint()``, survives executor loss, and later
    readers prune columns (most consumers need only ids and keys).
    """
    from opinio.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


def term_documents(docs: DataFrame, group: str, id_col: str, text: str) -> DataFrame:
    """(group, id, ``terms``: array of (token, tf)) for documents with a non-null
    group — without a shuffle, also for documents without tokens.

    A document's tokens are already in one row: they are sorted into a
    column, run starts are found by comparing neighbours, and each run's
    length is the distance to the next start. The sorted array is a
    materialised column, so the lambdas read it by index (O(1)) instead of
    re-evaluating the sort.
    """
    s = (docs.where(F.col(group).isNotNull())
         .select(group, id_col, F.array_sort(tfidf_tokens(text)).alias("_s")))
    starts = F.filter(
        F.transform("_s", lambda x, k: F.when((k == 0) | (x != F.get(F.col("_s"), k - 1)), k)
                    .otherwise(F.lit(-1))),
        lambda k: k >= 0)
    s = s.select(group, id_col, "_s", starts.alias("_st"))
    runs = F.transform("_st", lambda st, j: F.struct(
        F.get(F.col("_s"), st).alias("token"),
        (F.coalesce(F.get(F.col("_st"), j + 1), F.size("_s")) - st).cast("long").alias("tf")))
    return s.select(group, id_col, runs.alias("terms"))


def raw_weight(tf, df, n_docs) -> Column:
    """``tf * idf`` (not yet normalised) of a token that ``df`` of a group's ``n_docs`` documents hold."""
    return tf * (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + F.lit(1.0))


def raw_weights(docs: DataFrame, group: str, id_col: str, text: str) -> DataFrame:
    """(group, id, token, tf, df, n_docs, raw) with ``raw`` the :func:`raw_weight`."""
    terms = materialise(term_documents(docs, group, id_col, text), "terms")
    n_docs = terms.groupBy(group).agg(F.count(F.lit(1)).alias("n_docs"))
    tf = terms.select(group, id_col, F.explode("terms").alias("x")).select(group, id_col, "x.token", "x.tf")
    idf = (tf.groupBy(group, "token").agg(F.count(F.lit(1)).alias("df"))
           .join(n_docs, group))
    return (tf.join(idf, [group, "token"])
            .select(group, id_col, "token", "tf", "df", "n_docs",
                    raw_weight(F.col("tf"), F.col("df"), F.col("n_docs")).alias("raw")))


#: Words of one block of a group's documents, and of a bin of groups that are small enough for one task.
VECTOR_WORDS = 1 << 20
BIN_WORDS = 1 << 18


def doc_vectors(docs: DataFrame, group: str = "reviewer_id", id_col: str = "review_id",
                text: str = "review_content") -> DataFrame:
    """One row per document with at least one token.

    ``entries``: array of (df, token, w) of the shared tokens (``df >= 2``),
    sorted by (df, token) — the prefix order, ``w`` L2-normalised over all
    tokens; ``norm``: the norm of all raw weights; ``shared``: the squared norm
    of the shared ones; ``class``: hash of the shared term frequencies, equal
    for equal ones of a group; ``whole``: no token is the document's own.
    """
    return _of_groups(docs, group, id_col, text, _vectors, "entries array<struct<df:bigint,token:string,w:double>>, "
                      "norm double, shared double, class string, whole boolean")


def _of_groups(docs: DataFrame, group: str, id_col: str, text: str, build, columns: str) -> DataFrame:
    """What ``build`` (:func:`_vectors` or :func:`_weights`) makes of every group:
    the group, the id and ``columns``.

    A document's words are shuffled as one line, never a row per word. Groups
    of up to ``BIN_WORDS`` words meet in bins and larger ones alone, where their
    document frequencies are counted. A group of over ``VECTOR_WORDS`` words is
    cut into blocks of documents: each block counts its own tokens, the sums of
    those that two documents hold go back to its blocks.
    """
    words = (docs.where(F.col(group).isNotNull())
             .select(group, id_col, tfidf_tokens(text).alias("_w"))
             .select(group, id_col, F.array_join("_w", " ").alias("_line"), F.greatest(F.size("_w"), F.lit(0)).alias("_words")))
    lines = materialise(words, "lines", compression="zstd")
    sizes = materialise(lines.groupBy(group).agg(F.sum("_words").alias("_n"), F.count(F.lit(1)).alias("_docs")), "sizes")
    small, large = F.col("_n") <= BIN_WORDS, F.col("_n") > VECTOR_WORDS
    total, any_large = sizes.agg(F.sum(F.when(small, F.col("_n"))), F.max(large)).first()
    plan = sizes.select(group, "_docs", F.ceil(F.col("_n") / VECTOR_WORDS).cast("int").alias("_blocks"),
                        F.when(small, F.pmod(F.xxhash64(group), F.lit((total or 0) // BIN_WORDS + 1))).otherwise(-1).alias("_bin"),
                        F.when(~small, F.col(group)).alias("_own"))
    dealt = lines.where("_words > 0").drop("_words").join(plan, group)
    kinds = {f.name: f.dataType.simpleString() for f in lines.schema.fields}
    schema = f"`{group}` {kinds[group]}, `{id_col}` {kinds[id_col]}, {columns}"

    def whole(table: pa.Table) -> pa.Table:
        return build(table, group, id_col)

    out = (dealt.where("_blocks <= 1").select(group, id_col, "_line", "_docs", "_bin", "_own")
           .groupBy("_bin", "_own").applyInArrow(whole, schema))
    if not any_large:
        return out

    def count(table: pa.Table) -> pa.Table:
        rows, codes, _, tokens = _term_counts(table["_line"])
        held = np.bincount(codes, minlength=len(tokens))
        name = table[group].combine_chunks()[:1]
        return pa.table([name.take(pa.array(np.zeros(len(tokens), np.int64))), tokens, pa.array(held)],
                        names=[group, "token", "held"])

    def block(table: pa.Table, known: pa.Table) -> pa.Table:
        return build(table, group, id_col, known)

    rows = (dealt.where("_blocks > 1").withColumn("_block", F.pmod(F.xxhash64(id_col), F.col("_blocks")).cast("int"))
            .select(group, id_col, "_line", "_docs", "_block").repartition(group, "_block"))  # once, for both readers
    held = (rows.groupBy(group, "_block")
            .applyInArrow(count, f"`{group}` {kinds[group]}, token string, held bigint"))
    known = (held.groupBy(group, "token").agg(F.sum("held").alias("df")).where("df >= 2")
             .join(plan.select(group, "_blocks"), group)
             .select(group, "token", "df", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block")))
    blocks = (rows.groupBy(group, "_block").cogroup(known.groupBy(group, "_block"))
              .applyInArrow(block, schema))
    return out.unionByName(blocks)


def _term_counts(lines: pa.ChunkedArray):
    """``(rows, codes, tf, tokens)`` of lines of words: each distinct token of a row
    with its frequency, by row and token; ``tokens`` are in order."""
    words = pc.split_pattern(lines.combine_chunks(), " ")
    size = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    found = words.flatten().dictionary_encode()
    order = pc.sort_indices(found.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    many = max(len(order), 1)
    key, tf = np.unique(np.repeat(np.arange(len(size)), size) * many + rank[found.indices.to_numpy()], return_counts=True)
    return key // many, key % many, tf, found.dictionary.take(order)


def _weighed(table: pa.Table, group: str, id_col: str, known: pa.Table | None):
    """``(rows, codes, name, tf, df, tokens, raw, doc, first, norm)``: the terms of
    :func:`_term_counts` with their document frequency and raw weight, and the
    vector ``doc`` each is part of; by vector its ``first`` row and its norm."""
    rows, codes, tf, tokens = _term_counts(table["_line"])
    group_of = table[group].combine_chunks().dictionary_encode().indices.to_numpy()
    if known is None:
        held = group_of[rows].astype(np.int64) * len(tokens) + codes
        _, which, counts = np.unique(held, return_inverse=True, return_counts=True)
        df, name = counts[which], codes
    else:
        order = pc.sort_indices(known["token"])  # blocks of a group number the tokens alike
        at = pc.index_in(tokens, known["token"].take(order)).to_numpy(zero_copy_only=False)
        shared = ~np.isnan(at)
        at = np.where(shared, at, 0).astype(np.int64)
        counts = known["df"].take(order).to_numpy() if known.num_rows else np.ones(1, np.int64)
        df, name = np.where(shared, counts[at], 1)[codes], at[codes]
    n_docs = table["_docs"].to_numpy()[rows]
    raw = tf * (np.log((1.0 + n_docs) / (1.0 + df)) + 1.0)
    # Rows of one id (or without one) in a group are one vector.
    ids = table[id_col].combine_chunks().dictionary_encode(null_encoding="encode")
    own = group_of.astype(np.int64) * max(len(ids.dictionary), 1) + ids.indices.to_numpy()
    _, first, doc_of = np.unique(own, return_index=True, return_inverse=True)
    doc = doc_of[rows]
    return rows, codes, name, tf, df, tokens, raw, doc, first, np.sqrt(np.bincount(doc, raw * raw, len(first)))


def _weights(table: pa.Table, group: str, id_col: str, known: pa.Table | None = None) -> pa.Table:
    """The rows of :func:`tfidf_weights` of whole groups, or of a block of one group."""
    kinds = [table.schema.field(group).type, table.schema.field(id_col).type, pa.string(), pa.int64(), pa.int64(), pa.float64()]
    target = pa.schema(list(zip([group, id_col, "token", "tf", "df", "weight"], kinds)))
    if not table.num_rows:
        return target.empty_table()
    table = table.combine_chunks()
    rows, codes, _, tf, df, tokens, raw, doc, _, norm = _weighed(table, group, id_col, known)
    at = pa.array(rows)
    return pa.table([table[group].take(at), table[id_col].take(at), tokens.take(pa.array(codes)), pa.array(tf.astype(np.int64)),
                     pa.array(df.astype(np.int64)), pa.array(raw / norm[doc])], schema=target)


def _vectors(table: pa.Table, group: str, id_col: str, known: pa.Table | None = None) -> pa.Table:
    """The vectors of whole groups, or of a block of one group with its ``known``
    tokens (``token``, ``df``): those that two documents of the group hold."""
    names = [group, id_col, "entries", "norm", "shared", "class", "whole"]
    table = table.combine_chunks()
    kinds = [table.schema.field(group).type, table.schema.field(id_col).type]
    entry = pa.struct([("df", pa.int64()), ("token", pa.string()), ("w", pa.float64())])
    kinds += [pa.list_(entry), pa.float64(), pa.float64(), pa.string(), pa.bool_()]
    target = pa.schema(list(zip(names, kinds)))
    if not table.num_rows:
        return target.empty_table()
    _, codes, name, tf, df, tokens, raw, doc, first, norm = _weighed(table, group, id_col, known)
    square, twice = raw * raw, df >= 2
    part = np.bincount(doc, np.where(twice, square, 0.0), len(first))
    alone = np.bincount(doc, ~twice, len(first)) > 0
    kept = np.flatnonzero(twice)
    kept = kept[np.lexsort((tf[kept], codes[kept], df[kept], doc[kept]))]
    ends = np.concatenate([[0], np.cumsum(np.bincount(doc[kept], minlength=len(first)))])
    named = np.stack([name[kept], tf[kept]], axis=1).astype("<i8")
    classes = [hashlib.sha256(named[a:b].tobytes()).hexdigest() for a, b in zip(ends[:-1], ends[1:])]
    entries = pa.StructArray.from_arrays(
        [pa.array(df[kept].astype(np.int64)), tokens.take(pa.array(codes[kept])), pa.array((raw / norm[doc])[kept])], fields=list(entry))
    at = pa.array(first)
    return pa.table([table[group].take(at), table[id_col].take(at),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), entries),
                     pa.array(norm), pa.array(part), pa.array(classes, pa.string()), pa.array(~alone)], schema=target)


def weight_map(entries="entries") -> Column:
    """token -> weight map of a document's entries."""
    e = F.col(entries) if isinstance(entries, str) else entries
    return F.map_from_arrays(e.getField("token"), e.getField("w"))


def tfidf_weights(docs: DataFrame, group: str = "reviewer_id", id_col: str = "review_id",
                  text: str = "review_content") -> DataFrame:
    """``(group, id, token, tf, df, weight)``, weight L2-normalised per document.

    ``docs`` holds cleaned text; every document of a group counts in ``n``,
    also those without any token. Rows of one id (or without one) in a group
    have one norm. Words are shuffled as in :func:`doc_vectors`, a line per document.
    """
    return _of_groups(docs, group, id_col, text, _weights, "token string, tf bigint, df bigint, weight double")


def dot(va, vb) -> Column:
    """Sparse dot product of two token->weight maps (hash-joined keys, O(n+m))."""
    prod = F.map_zip_with(va, vb, lambda k, x, y: F.coalesce(x * y, F.lit(0.0)))
    return F.aggregate(F.map_values(prod), F.lit(0.0), lambda acc, v: acc + v)


def verify_pairs(pairs: DataFrame, vecs: DataFrame, group: str, id_col: str) -> DataFrame:
    """Exact cosine of candidate pairs ``(group, a, b)`` from document vectors."""
    da = vecs.select(group, F.col(id_col).alias("a"), weight_map().alias("va"))
    db = vecs.select(group, F.col(id_col).alias("b"), weight_map().alias("vb"))
    return (pairs.join(da, [group, "a"]).join(db, [group, "b"])
            .select(group, "a", "b", dot("va", "vb").alias("cosine")))


def class_heads(vecs: DataFrame, group: str, id_col: str) -> DataFrame:
    """The two smallest-norm documents of each class, numbered by ``place``.

    A rank limit: every task keeps two rows of a class before the shuffle.
    """
    order = Window.partitionBy(group, "class").orderBy("norm", id_col)
    return (vecs.withColumn("size", F.size("entries")).where("size > 0").withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= 2))


def within_classes(heads: DataFrame, group: str) -> DataFrame:
    """``(group, lb)``: the exact maximum over pairs of one class."""
    two = heads.groupBy(group, "class").agg(F.max("shared").alias("s"), F.min("norm").alias("n1"),
                                            F.max("norm").alias("n2"), F.count(F.lit(1)).alias("n"))
    return two.where("n = 2").groupBy(group).agg(F.max(F.col("s") / (F.col("n1") * F.col("n2"))).alias("lb"))


def bound_pairs(reps: DataFrame, group: str, id_col: str) -> DataFrame:
    """``(group, a, b)``: each representative and the strongest other one on its
    top token — one pair per representative at most."""
    tokens = reps.select(group, id_col, F.explode("entries").alias("x")).select(group, id_col, "x.token", "x.w")
    order = Window.partitionBy(group, "token").orderBy(F.col("w").desc(), id_col)
    strong = (tokens.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 2)
              .select(group, "token", F.col(id_col).alias("b"), "place"))
    top = F.array_max(F.transform("entries", lambda x: F.struct(
        x.getField("w").alias("w"), x.getField("token").alias("token")))).getField("token")
    own = reps.select(group, F.col(id_col).alias("a"), top.alias("token"))
    found = own.join(strong, [group, "token"]).where(F.col("a") != F.col("b"))
    return found.groupBy(group, "a").agg(F.min_by("b", "place").alias("b"))


#: Entries that one step of a running sum adds up.
_BLOCK = 64


def residuals(entries: str = "entries") -> Column:
    """``entries`` as array of (token, w, rest), ``rest`` being the norm of the
    entries after it.

    A running sum in one row: sums of blocks of entries, running sums of those,
    and within a block the sum of the few entries up to each. ``rest`` is rounded up
    a little, so that bounds made of it hold.
    """
    def squares(xs):
        return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x.getField("w") * x.getField("w"))

    e = F.col(entries)
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(e) - 1) / _BLOCK).cast("int")),
                        lambda k: F.slice(e, k * _BLOCK + 1, _BLOCK))
    # What is left before each block, from the sum of all squares downwards.
    left = F.aggregate(F.transform(parts, squares), F.array(squares(e)),
                       lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) - x)))
    return F.flatten(F.zip_with(parts, F.slice(left, 1, F.size(parts)), lambda part, before: F.transform(
        part, lambda x, k: F.struct(
            x.getField("token").alias("token"), x.getField("w").alias("w"),
            F.sqrt(F.greatest(before - squares(F.slice(part, 1, k + 1)), F.lit(0.0)) + F.lit(1e-12)).alias("rest")))))


def postings(vecs: DataFrame, bound: DataFrame, group: str, id_col: str) -> DataFrame:
    """The index of each group at its threshold ``t``: ``(group, id, t, token, w, rest)``
    for the tokens of each document's prefix.

    A token is in the prefix while the norm from it onward is at least ``t``;
    pairs that share none cannot reach ``t``.
    """
    kept = F.filter("r", lambda x: x.getField("w") * x.getField("w") + x.getField("rest") * x.getField("rest")
                    >= F.col("t") * F.col("t"))
    rows = vecs.where(F.size("entries") > 0).join(bound, group).select(group, id_col, "t", residuals().alias("r"))
    return (rows.select(group, id_col, "t", F.explode(kept).alias("x"))
            .select(group, id_col, "t", "x.token", "x.w", "x.rest"))


def candidate_pairs(posts: DataFrame, group: str, id_col: str) -> DataFrame:
    """``(group, a, b, part, most)``: pairs that can still reach their group's
    ``t``, the part of their cosine that is known, and the most that it can be.

    Along the common tokens of a pair, the product of the weights at one plus
    the product of both rests bounds all of the dot product from there on, and
    it only falls. So a posting pair under ``t`` is given up in the join, before
    anything is shuffled: if it is the first of the pair, the pair is under
    ``t``, and if it is a later one, what it adds is in the rests of the last one
    kept. The kept products and the last rests bound the cosine.
    """
    def side(name):
        return posts.select(group, "token", F.col("t").alias(f"t_{name}"), F.col(id_col).alias(name),
                            F.col("w").alias(f"w_{name}"), F.col("rest").alias(f"rest_{name}"))

    here = F.col("w_a") * F.col("w_b")
    met = side("a").join(side("b"), [group, "token"]).where(
        (F.col("a") < F.col("b")) & (here + F.col("rest_a") * F.col("rest_b") >= F.col("t_a")))
    part = F.sum(here)
    return (met.groupBy(group, "a", "b")
            .agg(part.alias("part"), (part + F.min("rest_a") * F.min("rest_b")).alias("most"), F.first("t_a").alias("t"))
            .where("most >= t").drop("t"))


#: Entries of one block of a group's vectors; a task holds two blocks at most.
BLOCK_ENTRIES = 1 << 21
#: Entries of a bin of groups that are small enough for one block.
BIN_ENTRIES = 1 << 18
#: A token that this share of a block's documents holds is multiplied as a dense column.
DENSE_SHARE = 1 / 8
#: Cells and products that are held at a time.
_CELLS = 1 << 21


def in_blocks(rows: DataFrame, group: str, id_col: str, measured: DataFrame | None = None) -> DataFrame:
    """``rows`` dealt so that every two rows of a group meet under one key
    ``(bin, own, i, j)``, whose size is bounded by entries. ``measured`` has
    ``group``, ``id_col`` and ``size`` (entries) of the rows, where the caller has them apart.

    Groups of up to ``BLOCK_ENTRIES`` are dealt whole into bins. A larger one is
    cut into n blocks of documents by the hash of their ids, and each block goes
    to the n keys that pair it with a block.
    """
    rows = rows.where(F.col(id_col).isNotNull() & (F.size("entries") > 0))
    if measured is None:
        measured = rows.select(group, id_col, F.size("entries").alias("size"))
    measured = measured.where(F.col(id_col).isNotNull() & (F.col("size") > 0))
    sizes = materialise(measured.groupBy(group).agg(F.sum("size").alias("_n"), F.count(F.lit(1)).alias("_docs"))
                        .where("_docs > 1").drop("_docs"), "sizes")
    total = sizes.where(F.col("_n") <= BLOCK_ENTRIES).agg(F.sum("_n")).first()[0] or 0
    n = F.ceil(F.col("_n") / BLOCK_ENTRIES).cast("int")
    large = F.col("_n") > BLOCK_ENTRIES
    plan = sizes.select(group, F.when(large, n).otherwise(1).alias("_blocks"), F.when(large, F.lit(-1)).otherwise(
        F.pmod(F.xxhash64(group), F.lit(total // BIN_ENTRIES + 1))).alias("bin"))
    own = rows.join(plan, group).withColumn("block", F.pmod(F.xxhash64(id_col), F.col("_blocks")).cast("int"))
    return (own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .select(group, id_col, "block", F.col("entries.token").alias("tokens"), F.col("entries.w").alias("ws"),
                    "bin", F.when(F.col("_blocks") > 1, F.col(group)).alias("own"),
                    F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j")))


def _block_cosines(starts, codes, ws, left, right):
    """Cosines of the rows ``left`` with the rows ``right``: (first, cosines of rows
    ``left[first:]`` with all of ``right``), a few rows at a time.

    Row k has the entries ``starts[k]:starts[k + 1]``. Tokens of many rows are
    dense columns of a matrix product; of others, the postings that meet are added up.
    """
    def entries(rows):
        size = starts[rows + 1] - starts[rows]
        at = np.repeat(starts[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.repeat(np.arange(len(rows)), size), codes[at], ws[at]

    row, code, w = entries(right)
    order = np.argsort(code, kind="stable")
    row, code, w = row[order], code[order], w[order]
    held = np.bincount(code, minlength=int(codes.max()) + 1)
    first = np.cumsum(held) - held
    dense = held >= max(DENSE_SHARE * len(right), 2)
    column = np.cumsum(dense) - 1
    many = dense[code]
    wide = np.zeros((len(right), int(dense.sum())))
    wide[row[many], column[code[many]]] = w[many]
    light = np.where(dense, 0, held)
    step = max(1, _CELLS // max(len(right), 1))
    for at in range(0, len(left), step):
        part = left[at:at + step]
        r, c, v = entries(part)
        many = dense[c]
        rows = np.zeros((len(part), wide.shape[1]))
        rows[r[many], column[c[many]]] = v[many]
        cos = rows @ wide.T
        flat = cos.reshape(-1)
        few = light[c] > 0
        r, c, v = r[few], c[few], v[few]
        ends = np.cumsum(light[c])
        lo = 0
        while lo < len(c):
            done = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + _CELLS, "right")))
            n = light[c[lo:hi]]
            pos = np.repeat(first[c[lo:hi]] - (ends[lo:hi] - n - done), n) + np.arange(n.sum())
            flat += np.bincount(np.repeat(r[lo:hi], n) * len(right) + row[pos], np.repeat(v[lo:hi], n) * w[pos], len(flat))
            lo = hi
        yield at, cos


def _groups_of(table: pa.Table, group: str, id_col: str):
    """Per group of a key's rows: its value, the ids, and the row numbers of both sides with their entries."""
    table = table.combine_chunks()
    tokens, ws = table["tokens"].combine_chunks(), table["ws"].combine_chunks()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(tokens).to_numpy(zero_copy_only=False))]).astype(np.int64)
    codes = tokens.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    ws = ws.flatten().to_numpy(zero_copy_only=False)
    ids, blocks = table[id_col], table["block"].to_numpy()
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    names = table[group].combine_chunks().dictionary_encode()
    which = names.indices.to_numpy()
    order = np.argsort(which, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(which[order])) + 1):
        name = names.dictionary[int(which[rows[0]])].as_py()
        # The group's own rows and numbers of tokens, so that small groups stay small.
        size = starts[rows + 1] - starts[rows]
        at = np.repeat(starts[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())
        own = np.unique(codes[at], return_inverse=True)[1]
        begin = np.concatenate([[0], np.cumsum(size)])
        twice = own[1:] == own[:-1]  # entries are sorted, so a token that a row has twice is beside itself
        twice[begin[1:-1] - 1] = False
        if twice.any():
            raise ValueError(f"two documents of group {name!r} have one id")
        left, right = np.flatnonzero(blocks[rows] == i), np.flatnonzero(blocks[rows] == j)
        if len(left) and len(right):
            yield name, ids.take(pa.array(rows)), begin, own, ws[at], left, right, i == j


def _found(table, group, id_col, keep):
    """``keep`` (row numbers, column numbers, cosines) of each piece of the cosines of distinct rows."""
    for name, ids, starts, codes, ws, left, right, same in _groups_of(table, group, id_col):
        # Within a block a piece of rows meets those from its first row on, so a pair is seen once.
        pieces = range(0, len(left), max(1, -(-len(left) // 8))) if same else (0,)
        for p in pieces:
            one = left[p:p + -(-len(left) // 8)] if same else left
            other = right[p:] if same else right
            for at, cos in _block_cosines(starts, codes, ws, one, other):
                if same:
                    cos[np.arange(len(cos))[:, None] + at >= np.arange(cos.shape[1])[None, :]] = -1.0
                yield name, ids, keep(cos), one[at:], other


def block_pairs(reps: DataFrame, threshold: float, group: str, id_col: str) -> DataFrame:
    """``(group, a, b, cosine)``: pairs ``a < b`` of one group with cosine ``>= threshold``, exactly."""
    types = {f.name: f.dataType for f in reps.schema.fields}
    schema = T.StructType([T.StructField(group, types[group]), T.StructField("a", types[id_col]),
                           T.StructField("b", types[id_col]), T.StructField("cosine", T.DoubleType())])

    def meet(table: pa.Table) -> pa.Table:
        out = {n: [] for n in (group, "a", "b", "cosine")}
        kinds = [table.schema.field(n).type for n in (group, id_col, id_col)] + [pa.float64()]
        target = pa.schema(list(zip(out, kinds)))

        def keep(cos):
            r, c = np.nonzero(cos >= max(threshold, 0.0))
            return r, c, cos[r, c]

        parts = []
        for name, ids, (r, c, found), one, other in _found(table, group, id_col, keep):
            if len(r):
                parts.append(pa.table([pa.array([name] * len(r), kinds[0]), ids.take(pa.array(one[r])).combine_chunks(),
                                       ids.take(pa.array(other[c])).combine_chunks(), pa.array(found)], schema=target))
        return pa.concat_tables(parts) if parts else target.empty_table()

    found = in_blocks(reps, group, id_col).groupBy("bin", "own", "i", "j").applyInArrow(meet, schema)
    return found.where(F.col("a") != F.col("b")).select(
        group, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cosine")


def block_maxima(reps: DataFrame, group: str, id_col: str, measured: DataFrame | None = None) -> DataFrame:
    """``(group, m2)``: the highest cosine of two distinct documents of each group."""
    kind = next(f.dataType for f in reps.schema.fields if f.name == group)
    schema = T.StructType([T.StructField(group, kind), T.StructField("m2", T.DoubleType())])

    def meet(table: pa.Table) -> pa.Table:
        best: dict = {}
        for name, _, top, _, _ in _found(table, group, id_col, lambda cos: float(cos.max(initial=-1.0))):
            best[name] = max(best.get(name, 0.0), top)
        return pa.table([pa.array(list(best), table.schema.field(group).type), pa.array(list(best.values()), pa.float64())],
                        names=[group, "m2"])

    found = in_blocks(reps, group, id_col, measured).groupBy("bin", "own", "i", "j").applyInArrow(meet, schema)
    return found.groupBy(group).agg(F.max("m2").alias("m2"))


def max_cosine(vecs: DataFrame, group: str = "reviewer_id", id_col: str = "review_id") -> DataFrame:
    """``(group, cos_sim)`` for every group present in ``vecs``.

    ``vecs`` are :func:`doc_vectors`. Exact maximum pairwise cosine (see
    module notes); capped at 1 like a clipped cosine distance.
    """
    groups = vecs.select(group).distinct()
    heads = materialise(class_heads(vecs, group, id_col).select(
        group, id_col, "class", "norm", "shared", "place", "size"), "heads")
    lower = materialise(within_classes(heads, group), "bounds")
    # Groups at 1 are final.
    final = lower.where(F.col("lb") >= F.lit(1.0 - _EPS)).select(group)
    shown = heads.where("place = 1").join(final, group, "left_anti").select(group, id_col, "size")
    between = block_maxima(vecs.join(shown, [group, id_col], "left_semi"), group, id_col, shown)
    return (groups.join(lower, group, "left").join(between, group, "left")
            .select(group, F.least(F.coalesce(F.greatest("lb", "m2"), F.lit(0.0)), F.lit(1.0)).alias("cos_sim")))


def copy_classes(vecs: DataFrame, group: str = "reviewer_id", id_col: str = "review_id") -> DataFrame:
    """Membership ``(group, id, class_id)``: documents of one group with equal term
    vectors share a class, named by its least id."""
    own = vecs.where(~F.col("whole")).select(group, id_col, F.col(id_col).alias("class_id"))
    same = vecs.where("whole")
    least = same.groupBy(group, "class").agg(F.min(id_col).alias("class_id"))
    return own.unionByName(same.join(least, [group, "class"]).select(group, id_col, "class_id"))


def similarity_pairs(vecs: DataFrame, threshold: float, group: str = "reviewer_id",
                     id_col: str = "review_id") -> DataFrame:
    """J6 as a similarity join: pairs of copy classes of one group with cosine
    ``>= threshold``, by their least ids.

    ``vecs`` are :func:`doc_vectors`; copies are not expanded into pairs
    (:func:`copy_classes` has the members). Representatives are compared in
    blocks (:func:`block_pairs`): only vectors are shuffled, never pairs.
    """
    shown = copy_classes(vecs, group, id_col).where(F.col(id_col) == F.col("class_id")).select(group, id_col)
    reps = materialise(vecs.join(shown, [group, id_col], "left_semi"), "pairs")
    found = block_pairs(reps, float(threshold) - _EPS, group, id_col)
    return found.select(group, F.col("a").alias(f"{id_col}_a"), F.col("b").alias(f"{id_col}_b"),
                        F.least("cosine", F.lit(1.0)).alias("cosine"))


def reviewer_similarity(clean: DataFrame, group: str = "reviewer_id", id_col: str = "review_id",
                        text: str = "review_content") -> DataFrame:
    """X1 + X2 over cleaned reviews: ``(group, cos_sim)`` for every non-null group.

    The document vectors feed several aggregations and joins, so they are
    materialised once in the shared checkpoint folder. Groups whose
    documents have no token at all still get a row (0). The maxima, a row per
    group, are written too, so that no caller who reads them twice compares twice.
    """
    base = clean.where(F.col(group).isNotNull())
    vecs = materialise(doc_vectors(base, group, id_col, text))
    sims = materialise(max_cosine(vecs, group, id_col), "sims")
    return (base.select(group).distinct()
            .join(sims, group, "left")
            .select(group, F.coalesce("cos_sim", F.lit(0.0)).alias("cos_sim")))
