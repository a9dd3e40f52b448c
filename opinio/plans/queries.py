"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (or files Spark derives from them)
in full. Output doubles are rounded to 6 places so the DuckDB oracles in
:mod:`opinio.plans.oracle_sql` compare value for value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.functions.text import clean_content, content_length
from opinio.operators import features as feat
from opinio.operators import similarity as sim
from opinio.sources.tables import reviews

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (comparison-friendly output)."""
    return df.select(*[
        F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _clean(spark, sf_dir) -> DataFrame:
    r = reviews(spark, sf_dir, with_label=False).where(F.col("reviewer_id").isNotNull())
    return r.select("review_id", "reviewer_id", "timestamp",
                    clean_content("review_content").alias("review_content"))


# --- step 1: reviews-per-day ratio -------------------------------------------------

@register("max_reviews_norm")
def q_max_reviews_norm(spark, sf_dir):
    counts = feat.normalised_counts(feat.review_counts(reviews(spark, sf_dir, with_label=False)))
    return round_doubles(counts.select("reviewer_id", F.col("count_key").alias("timestamp"),
                                       "count", "maximum_review_per_user"))


@register("review_count_per_day")
def q_review_count_per_day(spark, sf_dir):
    return feat.review_counts(reviews(spark, sf_dir, with_label=False), grain="day")


@register("max_review_count")
def q_max_review_count(spark, sf_dir):
    return feat.max_review_count(feat.review_counts(reviews(spark, sf_dir, with_label=False)))


@register("join_review_count")
def q_join_review_count(spark, sf_dir):
    r = reviews(spark, sf_dir, with_label=False).select("review_id", "reviewer_id", "timestamp")
    return feat.join_review_count(r)


@register("rating_deviation")
def q_rating_deviation(spark, sf_dir):
    r = reviews(spark, sf_dir, with_label=False)
    return round_doubles(r.select("review_id", "rating", "restaurant_rating",
                                  feat.rating_deviation().alias("rating_deviation")))


# --- step 2: text cleaning --------------------------------------------------------

@register("clean_content")
def q_clean_content(spark, sf_dir):
    r = reviews(spark, sf_dir, with_label=False)
    return r.select("review_id", clean_content("review_content").alias("review_content"))


@register("review_length")
def q_review_length(spark, sf_dir):
    c = _clean(spark, sf_dir)
    return c.select("review_id",
                    content_length("review_content").alias("review_length"),
                    content_length("review_content", empty_is_zero=True).alias("review_length_nonempty"))


# --- step 3: similarity -----------------------------------------------------------

@register("tfidf_weights")
def q_tfidf_weights(spark, sf_dir):
    vecs = sim.tfidf_weights(_clean(spark, sf_dir))
    return round_doubles(vecs.select("reviewer_id", "review_id", "token", "tf", "df", "weight"))


@register("max_cosine")
def q_max_cosine(spark, sf_dir):
    return round_doubles(sim.reviewer_similarity(_clean(spark, sf_dir)))


@register("pair_similarity")
def q_pair_similarity(spark, sf_dir):
    vecs = sim.materialise(sim.doc_vectors(_clean(spark, sf_dir)))
    return round_doubles(sim.similarity_pairs(vecs, 0.5))


@register("pair_similarity_members")
def q_pair_similarity_members(spark, sf_dir):
    """The members of the copy classes that ``pair_similarity`` pairs."""
    return sim.copy_classes(sim.materialise(sim.doc_vectors(_clean(spark, sf_dir))))


@register("review_features")
def q_review_features(spark, sf_dir):
    return round_doubles(feat.review_features(reviews(spark, sf_dir, with_label=False)))


# --- step 4: sources, preparation, filters, limits, set ops ------------------------

import datetime as _dt  # noqa: E402

from opinio.functions import dates as dts  # noqa: E402
from opinio.functions import text as txt  # noqa: E402
from opinio.operators import prepare as prep  # noqa: E402
from opinio.operators import summaries as summ  # noqa: E402
from opinio.schemas import LABELED_COLUMNS, RAW, RAW_COLUMNS  # noqa: E402
from opinio.session import scratch_path  # noqa: E402
from opinio.sinks import tables as sinks  # noqa: E402
from opinio.sources import files as srcf  # noqa: E402
from opinio.sources import quoted_csv  # noqa: E402
from opinio.sources.tables import load_table, scan_day  # noqa: E402

DAY = _dt.date(2024, 1, 3)


def _raw(spark, sf_dir) -> DataFrame:
    return reviews(spark, sf_dir, with_label=False).select(*RAW_COLUMNS)


def _yn(spark, sf_dir) -> DataFrame:
    return reviews(spark, sf_dir).withColumn("flagged", prep.recode_label("flagged"))


def raw_csv_frame(spark, sf_dir) -> DataFrame:
    """The raw review source file's layout, derived from the review view."""
    r = reviews(spark, sf_dir, with_label=False)
    back = {v: k for k, v in prep.RAW_RENAMES.items()}
    cols = [F.date_format("timestamp", dts.SLASH_DATE).alias("date") if c == "timestamp"
            else F.col(c).alias(back[c]) for c in RAW_COLUMNS]
    return r.select(*cols, (F.col("useful_count") + 1).alias("reviewUsefulCount"))


def labeled_csv_frame(spark, sf_dir) -> DataFrame:
    """The labeled source file's layout (25 columns), derived from the review view."""
    r = reviews(spark, sf_dir)
    back = {v: k for k, v in prep.LABELED_RENAMES.items()}
    rid = F.col("review_id").cast("long")
    derived = {
        "maximum_review_per_user": (rid % 4).cast("double") / 4.0,
        "review_length": F.length("review_content").cast("long"),
        "rating_deviation": feat.rating_deviation(),
        "cos_sim": (rid % 10).cast("double") / 10.0,
    }
    cols = []
    for c in LABELED_COLUMNS:
        name = back.get(c, c)
        if c == "timestamp":
            cols.append(F.date_format("timestamp", dts.SLASH_DATE).alias(name))
        elif c in derived:
            cols.append(derived[c].alias(name))
        else:
            cols.append(F.col(c).alias(name))
    extra = [F.concat(F.lit(f"{d}-"), F.col("review_id")).alias(d) for d in prep.LABELED_DROPPED]
    return r.select(*cols, *extra)


@register("scan_reviews")
def q_scan_reviews(spark, sf_dir):
    return reviews(spark, sf_dir)


@register("scan_day")
def q_scan_day(spark, sf_dir):
    return scan_day(_raw(spark, sf_dir), DAY)


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv_roundtrip")
    sinks.write_csv(_raw(spark, sf_dir), path)
    return srcf.read_csv(spark, path, RAW, multiline=True)


@register("quoted_csv_roundtrip")
def q_quoted_csv_roundtrip(spark, sf_dir):
    """S3: line breaks in quoted fields, each file read by many tasks."""
    path = scratch_path(spark, "csv_quoted")
    sinks.write_csv(_raw(spark, sf_dir), path)
    return quoted_csv.read_quoted_csv(spark, path, RAW)


@register("lines_source")
def q_lines_source(spark, sf_dir):
    path = scratch_path(spark, "lines")
    (load_table(spark, sf_dir, "documents").orderBy("doc_id").select("text")
     .write.text(path))
    return srcf.read_lines(spark, path)


@register("bulk_load_day")
def q_bulk_load_day(spark, sf_dir):
    root = scratch_path(spark, "bulk")
    (_raw(spark, sf_dir).withColumn("day", dts.partition_id("timestamp"))
     .write.partitionBy("day").option("header", True).option("escape", '"').csv(root))
    return srcf.bulk_load_day(spark, root, DAY, RAW, template="{root}/day={day}/*.csv", multiline=True)


@register("bulk_load_table")
def q_bulk_load_table(spark, sf_dir):
    """S6 write half: the first dated folder is loaded, then replaces the table; all others are appended.

    The folders' files are read in byte ranges."""
    root, table = scratch_path(spark, "bulk"), scratch_path(spark, "bulk_table")
    (_raw(spark, sf_dir).withColumn("day", dts.partition_id("timestamp"))
     .write.partitionBy("day").option("header", True).option("escape", '"').csv(root))
    days = [_dt.date(2024, 1, 1) + _dt.timedelta(days=n) for n in range(7)]
    for day, mode in zip([days[0], *days], ("append", "replace", *["append"] * 6)):
        srcf.load_table_from_day(spark, root, day, table, RAW, mode, template="{root}/day={day}/*.csv", multiline=True, split_bytes=quoted_csv.SPLIT_BYTES)
    return spark.read.parquet(table)


@register("overwrite_day")
def q_overwrite_day(spark, sf_dir):
    loc = scratch_path(spark, "table")
    name = "reviews_raw_" + loc.rsplit("-", 1)[-1][:12]
    sinks.create_table(spark, name, RAW, loc)
    raw = _raw(spark, sf_dir)
    sinks.overwrite_day(raw, name)
    redo = scan_day(raw, DAY).withColumn("rating", F.lit(0).cast("long"))
    sinks.overwrite_day(redo, name)
    return spark.table(name)


@register("to_messages")
def q_to_messages(spark, sf_dir):
    return sinks.to_messages(_raw(spark, sf_dir))


@register("messages_roundtrip")
def q_messages_roundtrip(spark, sf_dir):
    """K8/JS2 checked by parsing the messages back into the raw columns."""
    from opinio.schemas import MESSAGE
    m = sinks.to_messages(_raw(spark, sf_dir)).select("key", F.from_json("value", MESSAGE).alias("m"))
    return m.select("key", *[F.col("m").getField(c).alias(c) for c in RAW_COLUMNS])


@register("prepare_raw")
def q_prepare_raw(spark, sf_dir):
    return prep.prepare_raw(raw_csv_frame(spark, sf_dir))


@register("prepare_labeled")
def q_prepare_labeled(spark, sf_dir):
    return round_doubles(prep.prepare_labeled(labeled_csv_frame(spark, sf_dir)))


@register("recode_label")
def q_recode_label(spark, sf_dir):
    return _yn(spark, sf_dir).select("review_id", "flagged")


@register("recode_text_label")
def q_recode_text_label(spark, sf_dir):
    y = _yn(spark, sf_dir).select("review_id", F.coalesce("flagged", F.lit("")).alias("label_text"))
    return y.select("review_id", "label_text", prep.recode_text_label("label_text", "Y").alias("label"))


@register("filter_flagged")
def q_filter_flagged(spark, sf_dir):
    return prep.filter_value(_yn(spark, sf_dir), "flagged", "Y").select("review_id", "reviewer_id", "flagged")


@register("filter_exact_ts")
def q_filter_exact_ts(spark, sf_dir):
    return prep.filter_exact_ts(_raw(spark, sf_dir), _dt.datetime(2024, 1, 2)).select("review_id", "timestamp")


@register("filter_before")
def q_filter_before(spark, sf_dir):
    return prep.filter_before(_raw(spark, sf_dir), "2024-01-04").select("review_id", "timestamp")


@register("drop_null_rows")
def q_drop_null_rows(spark, sf_dir):
    return prep.drop_null_rows(reviews(spark, sf_dir)).select("review_id", "flagged")


@register("null_audit")
def q_null_audit(spark, sf_dir):
    return prep.null_audit(reviews(spark, sf_dir))


def _blank_ids(spark, sf_dir) -> DataFrame:
    r = reviews(spark, sf_dir, with_label=False)
    rid = F.col("review_id")
    k = rid.cast("long") % 10
    messy = (F.when(k == 0, F.lit("   ")).when(k == 1, F.lit(None).cast("string"))
             .when(k == 2, F.lit("")).otherwise(F.concat(F.lit(" "), rid, F.lit("\t"))))
    return r.select(messy.alias("review_id"), "reviewer_id")


@register("valid_ids")
def q_valid_ids(spark, sf_dir):
    return prep.valid_ids(_blank_ids(spark, sf_dir))


def _newline_dates(spark, sf_dir) -> DataFrame:
    r = reviews(spark, sf_dir, with_label=False)
    d = F.date_format("timestamp", dts.SLASH_DATE)
    return r.select("review_id", F.when(F.col("review_id").cast("long") % 3 == 0,
                                        F.concat(F.lit("\n"), d)).otherwise(d).alias("date"))


@register("strip_leading_newline")
def q_strip_leading_newline(spark, sf_dir):
    return _newline_dates(spark, sf_dir).select("review_id", dts.strip_leading_newline("date").alias("date"))


@register("positional_join")
def q_positional_join(spark, sf_dir):
    a_path, b_path = scratch_path(spark, "lines_a"), scratch_path(spark, "lines_b")
    docs = load_table(spark, sf_dir, "documents")
    (docs.orderBy("doc_id").select(F.regexp_replace("text", r"[\r\n]+", " ").alias("value"))
     .write.text(a_path))
    lab = load_table(spark, sf_dir, "labels")
    meta = F.concat_ws(
        " ",
        F.date_format(F.date_add(F.lit(_dt.date(2024, 1, 1)), (F.col("doc_id") % 7).cast("int")), dts.SLASH_DATE),
        F.col("doc_id").cast("string"),
        F.concat(F.lit("r"), (F.col("doc_id") % 250).cast("string")),
        F.concat(F.lit("p"), (F.col("doc_id") % 20).cast("string")),
        F.when(F.col("quality") == 0, "Y").otherwise("N"),
        F.col("toxic").cast("string"), F.lit("0"), F.lit("0"),
        (F.col("doc_id") % 5 + 1).cast("string"))
    lab.orderBy("doc_id").select(meta.alias("value")).write.text(b_path)
    a = srcf.read_lines(spark, a_path).withColumnRenamed("value", "review")
    b = srcf.read_lines(spark, b_path).select("line_no", *[
        F.get(F.split("value", " "), i).alias(n) for i, n in enumerate(
            ["date", "review_id", "reviewer_id", "product_id", "label", "a", "b", "c", "rating"])])
    return srcf.positional_join(b, a)


@register("page_frontier")
def q_page_frontier(spark, sf_dir):
    pages = load_table(spark, sf_dir, "pages").select("page_id", "url")
    return prep.page_frontier(pages, "url", pages=3).select("page_id", "page_no", "page_url")


@register("chunk_triples")
def q_chunk_triples(spark, sf_dir):
    from opinio.operators.pages import LINK_TEXT, extract_all
    pages = load_table(spark, sf_dir, "pages")
    links = pages.select("page_id", extract_all("html", LINK_TEXT).alias("links"))  # matched once, then cut
    chunks = links.select("page_id", F.posexplode(prep.chunk_triples("links")).alias("chunk_no", "c"))
    return chunks.select("page_id", F.col("chunk_no").cast("long").alias("chunk_no"),
                         *[F.get("c", i).alias(f"slot{i}") for i in range(3)])


@register("split_parts")
def q_split_parts(spark, sf_dir):
    from opinio.operators.pages import PAGE_RULES
    pages = load_table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", PAGE_RULES["title"], 1)
    return pages.select("page_id", txt.split_first(title, " ").alias("first_word"),
                        txt.split_last("url", "/").alias("last_path"),
                        txt.split_last("url", "=").alias("after_eq"))


@register("count_or_zero")
def q_count_or_zero(spark, sf_dir):
    ev = load_table(spark, sf_dir, "events")
    label = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(
        F.concat_ws(" ", "event_type", F.floor("value").cast("string")))
    return ev.select("event_id", label.alias("label")).select(
        "event_id", "label", txt.count_or_zero("label").alias("n"))


@register("surrogate_key")
def q_surrogate_key(spark, sf_dir):
    r = _raw(spark, sf_dir)
    return r.select("review_id", txt.surrogate_key("reviewer_id", "restaurant_id", "timestamp", "review_content")
                    .alias("key"))


@register("parse_dates")
def q_parse_dates(spark, sf_dir):
    d = _newline_dates(spark, sf_dir).select("review_id", dts.strip_leading_newline("date").alias("date"))
    ts = dts.parse_slash_date("date")
    return d.select("review_id", "date", ts.alias("parsed"),
                    dts.to_epoch_seconds(ts).alias("epoch"),
                    dts.epoch_to_midnight_text(dts.to_epoch_seconds(ts)).alias("midnight"))


@register("partition_id")
def q_partition_id(spark, sf_dir):
    return _raw(spark, sf_dir).select("review_id", dts.partition_id("timestamp").alias("partition_id"))


@register("count_by_label")
def q_count_by_label(spark, sf_dir):
    return summ.count_by(_yn(spark, sf_dir), "flagged")


@register("distinct_labels")
def q_distinct_labels(spark, sf_dir):
    return summ.distinct_values(_yn(spark, sf_dir), "flagged")


@register("first_n")
def q_first_n(spark, sf_dir):
    return summ.first_n(_raw(spark, sf_dir).select("review_id", "reviewer_id", "rating"), 5)


@register("last_n")
def q_last_n(spark, sf_dir):
    return summ.last_n(_raw(spark, sf_dir).select("review_id", "reviewer_id", "rating"), 5)


@register("union_classes")
def q_union_classes(spark, sf_dir):
    y = _yn(spark, sf_dir).select("review_id", "flagged")
    return prep.union_all(prep.filter_value(y, "flagged", "N"), prep.filter_value(y, "flagged", "Y"),
                          prep.filter_value(y, "flagged", "Y"))


# --- step 7: summaries, terms, sentiment --------------------------------------------

from pyspark.sql import Window  # noqa: E402

from opinio.operators import lemmas as lem  # noqa: E402
from opinio.operators import sentiment as sent  # noqa: E402
from opinio.operators import valence as val  # noqa: E402

# A small inflection table for the lemma lookup (form -> lemma).
DEFAULT_LEMMAS = {
    "reviews": "review", "restaurants": "restaurant", "dishes": "dish", "meals": "meal",
    "tables": "table", "loved": "love", "loves": "love", "tasted": "taste", "ordered": "order",
    "waited": "wait", "servers": "server", "better": "good", "best": "good", "worse": "bad",
    "worst": "bad", "ate": "eat", "eaten": "eat", "went": "go", "gone": "go", "errors": "error",
}


def lemma_frame(spark) -> DataFrame:
    return spark.createDataFrame(sorted(DEFAULT_LEMMAS.items()), "form string, lemma string")


def _metric_frame(spark, sf_dir) -> DataFrame:
    m = _yn(spark, sf_dir).select("review_id", "flagged", F.length("review_content").cast("long").alias("text_chars"))
    return sim.materialise(m, "metric")  # read by the summary and by its quantiles


@register("describe_metric")
def q_describe_metric(spark, sf_dir):
    return round_doubles(summ.describe(_metric_frame(spark, sf_dir), "text_chars", "flagged"))


@register("histogram_metric")
def q_histogram_metric(spark, sf_dir):
    return round_doubles(summ.histogram(_metric_frame(spark, sf_dir), "text_chars", 500.0, "flagged"))


@register("top_terms")
def q_top_terms(spark, sf_dir):
    y = _yn(spark, sf_dir)
    return summ.top_terms(y, "review_content", "flagged", ["Y", "N"], k=50)


@register("clean_for_sentiment")
def q_clean_for_sentiment(spark, sf_dir):
    return sent.clean_for_sentiment(reviews(spark, sf_dir, with_label=False))


@register("lemma_lookup")
def q_lemma_lookup(spark, sf_dir):
    out = sent.lemma_lookup(_review_tokens(spark, sf_dir), lemma_frame(spark))
    return out.select("review_id", F.col("pos").cast("long").alias("pos"), "token", "lemma")


def _review_tokens(spark, sf_dir) -> DataFrame:
    return reviews(spark, sf_dir, with_label=False).select(
        "review_id", F.posexplode(txt.sentiment_tokens("review_content")).alias("pos", "token"))


def _ends(*endings: str) -> Column:
    return F.col("token").rlike("(" + "|".join(endings) + ")$")


@register("lemma_by_tag")
def q_lemma_by_tag(spark, sf_dir):
    """The lemma of each word under the tag that its ending says; the
    vocabulary is the reviews' own: words seen three times or more."""
    toks = sim.materialise(_review_tokens(spark, sf_dir).withColumn(
        "tag", F.when(_ends("ed", "ing"), "v").when(_ends("er", "est"), "a").when(_ends("ly"), "r").otherwise("n")), "tokens")
    seen = toks.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
    vocabulary = seen.select(F.col("token").alias("lemma"), F.explode(F.array(*map(F.lit, lem.RULES))).alias("tag"))
    exceptions = lemma_frame(spark).withColumn("tag", F.lit("n"))
    out = lem.lemmatise(toks, vocabulary, exceptions)
    return out.select("review_id", F.col("pos").cast("long").alias("pos"), "token", "tag", "lemma")


#: Scores of a tag after another one.
TAG_FOLLOWS = {("a", "n"): 1.0, ("n", "v"): 0.5, ("v", "n"): 0.4, ("r", "v"): 0.8, ("v", "r"): 0.3, ("r", "a"): 0.6, ("n", "n"): 0.1}


@register("pos_tags")
def q_pos_tags(spark, sf_dir):
    """The best tag sequence of each review; a word's scores follow from its ending and its frequency."""
    toks = sim.materialise(_review_tokens(spark, sf_dir), "tokens")
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    by_tag = {"n": F.least(F.log10("n") / 4, F.lit(1.0)), "v": F.when(_ends("ed", "ing", "s"), 1.0).otherwise(0.2),
              "a": F.when(_ends("er", "est", "al", "ous"), 1.1).otherwise(0.1), "r": F.when(_ends("ly"), 2.0).otherwise(0.0)}
    rows = F.array(*[F.struct(F.lit(t).alias("tag"), s.cast("double").alias("score")) for t, s in by_tag.items()])
    scores = counts.select("token", F.explode(rows).alias("x")).select("token", "x.*")
    out = lem.tag_words(toks, scores, TAG_FOLLOWS, list(by_tag), start={"n": 0.2})
    return out.select("review_id", F.col("pos").cast("long").alias("pos"), "token", "tag")


def _sentiment(spark, sf_dir) -> DataFrame:
    return sent.text_sentiment(reviews(spark, sf_dir, with_label=False), sent.lexicon_frame(spark),
                               lemmas=lemma_frame(spark))


@register("sentiment_scores")
def q_sentiment_scores(spark, sf_dir):
    return round_doubles(_sentiment(spark, sf_dir))


@register("sentiment_columns")
def q_sentiment_columns(spark, sf_dir):
    """The four scores as columns beside the review's own."""
    own = _raw(spark, sf_dir).select("review_id", "reviewer_id", "rating")
    return round_doubles(own.join(_sentiment(spark, sf_dir), "review_id", "left"))


@register("sentiment_by_label")
def q_sentiment_by_label(spark, sf_dir):
    s = _sentiment(spark, sf_dir).join(_yn(spark, sf_dir).select("review_id", "flagged"), "review_id")
    return round_doubles(summ.describe(sim.materialise(s, "metric"), "compound", "flagged"))


def _modifiers(spark, sf_dir) -> DataFrame:
    """The 18 most frequent words of up to three letters, by rank: boosters, dampers, negations."""
    found = reviews(spark, sf_dir, with_label=False).select(F.explode(val.words("review_content")).alias("token"))
    counts = (found.where(F.length("token") <= 3).groupBy(F.lower("token").alias("token"))
              .agg(F.count(F.lit(1)).alias("n")))
    top = counts.orderBy(F.col("n").desc(), "token").limit(18)   # the report is the feature: a few marker words
    return sim.materialise(top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("n").desc(), "token"))),
                           "modifiers")


@register("learned_lexicon")
def q_learned_lexicon(spark, sf_dir):
    """Valences of words from the labelled reviews."""
    return round_doubles(val.class_lexicon(_labeled_yn(spark, sf_dir), "flagged", "N", "Y"))


@register("sentiment_shifted")
def q_sentiment_shifted(spark, sf_dir):
    """E1 with negation, boosters and capitals; all tables from the data's own words."""
    marks = _modifiers(spark, sf_dir)
    lexicon = val.class_lexicon(_labeled_yn(spark, sf_dir), "flagged", "N", "Y")
    lexicon = sim.materialise(lexicon.join(marks, "token", "left_anti"), "lexicon")
    shift = F.when(F.col("rank") <= 6, 0.293).otherwise(-0.293)
    return round_doubles(val.shifted_sentiment(
        reviews(spark, sf_dir, with_label=False), lexicon, marks.where("rank <= 12").select("token", shift.alias("shift")),
        marks.where("rank > 12").select("token")))


# --- step 8: model data work ----------------------------------------------------------

from opinio.operators import model as mdl  # noqa: E402
from opinio.operators import sampling as smp  # noqa: E402


def _labeled_yn(spark, sf_dir) -> DataFrame:
    return _yn(spark, sf_dir).where(F.col("flagged").isNotNull())


def _model_frame(spark, sf_dir) -> DataFrame:
    """Final-table features of labeled reviews, label as 'Y'/'N', without their texts."""
    f = feat.review_features(reviews(spark, sf_dir), keep=["flagged"]).drop("review_content")
    return f.where(F.col("flagged").isNotNull()).withColumn("flagged", prep.recode_label("flagged"))


@register("under_sample")
def q_under_sample(spark, sf_dir):
    return smp.under_sample(_labeled_yn(spark, sf_dir).select("review_id", "flagged"))


@register("train_test_split")
def q_train_test_split(spark, sf_dir):
    train, test = smp.train_test_split(_labeled_yn(spark, sf_dir).select("review_id"))
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test"))))


@register("gaussian_nb_stats")
def q_gaussian_nb_stats(spark, sf_dir):
    return round_doubles(mdl.gaussian_nb_stats(sim.materialise(
        _model_frame(spark, sf_dir).select("flagged", *mdl.FEATURES), "model")))


def _rule_predictions(spark, sf_dir) -> DataFrame:
    y = _labeled_yn(spark, sf_dir)
    return y.select("review_id", F.col("flagged").alias("label"),
                    F.when(F.col("rating") <= 2, "Y").otherwise("N").alias("prediction"))


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return summ.confusion_matrix(_rule_predictions(spark, sf_dir))


@register("classification_metrics")
def q_classification_metrics(spark, sf_dir):
    return round_doubles(summ.classification_metrics(_rule_predictions(spark, sf_dir)))


def _self_train(spark, sf_dir, estimator):
    """The loop to its end: until the pool is empty or a round moves no row."""
    data = smp.under_sample(sim.materialise(_model_frame(spark, sf_dir), "model"))
    return mdl.self_training(data, estimator, threshold=0.7, iterations=None)


@register("self_training")
def q_self_training(spark, sf_dir):
    res = _self_train(spark, sf_dir, mdl.gaussian_nb())
    m = summ.classification_metrics(res.scores)
    return m.select("*", F.lit(res.rounds).alias("rounds"), F.lit(res.promoted).alias("promoted"))


@register("random_forest_scores")
def q_random_forest_scores(spark, sf_dir):
    return _self_train(spark, sf_dir, mdl.random_forest()).scores


@register("gaussian_nb_scores")
def q_gaussian_nb_scores(spark, sf_dir):
    return _self_train(spark, sf_dir, mdl.gaussian_nb()).scores


@register("self_training_nb")
def q_self_training_nb(spark, sf_dir):
    """M4 with M6 by merged moments: the last model's scores of the test rows."""
    return mdl.self_training_nb(smp.under_sample(sim.materialise(_model_frame(spark, sf_dir), "model")), threshold=0.7).scores


def _nb_scores(spark, sf_dir) -> DataFrame:
    rows = sim.materialise(_model_frame(spark, sf_dir).withColumn("y", (F.col("flagged") == "Y").cast("double")), "model")
    scored = mdl.nb_scores(rows, mdl.class_moments(rows, "y"))
    return scored.select("review_id", F.col("flagged").alias("label"),
                         F.when(F.col("prediction") == 1.0, "Y").otherwise("N").alias("prediction"), "probability")


@register("nb_scores")
def q_nb_scores(spark, sf_dir):
    """M6: class and probability of every labelled review by the model of all of them."""
    return round_doubles(_nb_scores(spark, sf_dir))


@register("nb_metrics")
def q_nb_metrics(spark, sf_dir):
    """M7 on a model's output."""
    return round_doubles(summ.classification_metrics(_nb_scores(spark, sf_dir)))


# --- step 9: pages --------------------------------------------------------------------

from opinio.operators import nodes as nd  # noqa: E402
from opinio.operators import pages as pg  # noqa: E402

ALIGN_FIELDS = {"href": pg.LINK_HREF, "link_text": pg.LINK_TEXT, "paragraph": r"<p>([^<]*)"}


@register("extract_from_pages")
def q_extract_from_pages(spark, sf_dir):
    return pg.page_scalars(load_table(spark, sf_dir, "pages"))


@register("page_links")
def q_page_links(spark, sf_dir):
    out = pg.repeated_elements(load_table(spark, sf_dir, "pages"), pg.LINK_HREF, name="href")
    return out.withColumn("slot", F.col("slot").cast("long"))


@register("align_repeated_fields")
def q_align_repeated_fields(spark, sf_dir):
    out = pg.align_fields(load_table(spark, sf_dir, "pages"), ALIGN_FIELDS)
    return out.withColumn("slot", F.col("slot").cast("long"))


PARAGRAPH = nd.Selector("p")
PARAGRAPH_FIELDS = {
    "first_word": nd.Field(PARAGRAPH, pattern="^([^ &]+)"),
    "bold": nd.Field(nd.Selector("b"), pattern="^([^ &]+)"),   # most paragraphs have none
}
LINK_FIELDS = {"href": nd.Field(nd.Selector("a", attrs={"href": "^/"}), attr="href"),
               "link_text": nd.Field(nd.Selector("a"), pattern="^([^ &]+)")}


@register("card_fields")
def q_card_fields(spark, sf_dir):
    """W3 by structure: the fields of each paragraph, null where it has none."""
    return nd.card_fields(load_table(spark, sf_dir, "pages"), PARAGRAPH, PARAGRAPH_FIELDS)


@register("link_cards")
def q_link_cards(spark, sf_dir):
    """W2 by structure: the link of each list item."""
    return nd.card_fields(load_table(spark, sf_dir, "pages"), nd.Selector("li"), LINK_FIELDS)


@register("page_header_fields")
def q_page_header_fields(spark, sf_dir):
    """W1 by structure: fields of the whole page, of attributes and of the n-th element."""
    return nd.page_fields(load_table(spark, sf_dir, "pages"), {
        "lang": nd.Field(nd.Selector("html"), attr="lang"),
        "second_link": nd.Field(nd.Selector("a"), attr="href", nth=1),
        "ad_word": nd.Field(nd.Selector("div", classes=("ad",)), pattern="^([^ &]+)")})


@register("pages_one_day")
def q_pages_one_day(spark, sf_dir):
    """The rows of several page sets, unioned and cut to one exact day.

    The sets are the tables of the days on which the pages were stored.
    """
    pages = load_table(spark, sf_dir, "pages").withColumn("timestamp", F.to_timestamp(
        F.date_add(F.lit(_dt.date(2024, 1, 1)), (F.col("page_id") % 7).cast("int"))))
    root = scratch_path(spark, "page_sets")
    pg.page_scalars(pages, keep=("page_id", "timestamp")).withColumn(
        "part", F.dayofmonth("timestamp") % 3).write.partitionBy("part").parquet(root)
    names = "page_id bigint, timestamp timestamp, lang string, title string, track_id string, part int"
    stored = spark.read.schema(names).parquet(root)
    sets = [stored.where(F.col("part") == k).drop("part") for k in range(3)]
    return prep.filter_exact_ts(prep.union_all(*sets), _dt.datetime(2024, 1, 3))


# --- step 6: streaming ingest -----------------------------------------------------------

from opinio.schemas import ERROR  # noqa: E402
from opinio.sinks import committed  # noqa: E402
from opinio.sources import folder_log  # noqa: E402
from opinio.streaming import ingest  # noqa: E402


def event_messages(spark, sf_dir) -> DataFrame:
    """Review messages derived from ``events`` (one JSON text per event).

    Fixed rules: ``event_id % 97 == 0`` truncated JSON, ``% 83 == 0`` a rating
    of the wrong type, ``% 89 == 0`` carries an ``error_message``.
    """
    ev = load_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    rec = F.struct(
        eid.cast("string").alias("review_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("reviewer_id"),
        F.col("event_type").alias("restaurant_id"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("timestamp"),
        (eid % 6).alias("rating"),
        F.col("props").alias("review_content"),
        (F.col("user_id") % 50).alias("friend_count"),
        (eid % 50).alias("review_count"),
        (eid % 7).alias("useful_count"),
        (eid % 11).alias("cool_count"),
        (eid % 13).alias("funny_count"),
        F.col("value").alias("restaurant_rating"),
        F.when(eid % 89 == 0, F.concat_ws(" ", F.lit("flagged by source"), F.col("event_type")))
         .alias("error_message"))
    base = ev.select(eid, F.to_json(rec).alias("js"))
    js = F.col("js")
    js = F.when(eid % 83 == 0, F.regexp_replace(js, r'"rating":-?\d+', '"rating":"five"')).otherwise(js)
    js = F.when(eid % 97 == 0, F.expr("substring(js, 1, length(js) - 1)")).otherwise(js)
    return base.select(js.alias("value"))


def _routed_events(spark, sf_dir) -> DataFrame:
    return ingest.route_messages(ingest.parse_messages(event_messages(spark, sf_dir)))


@register("parse_messages")
def q_parse_messages(spark, sf_dir):
    r = _routed_events(spark, sf_dir)
    rid = F.when(F.col("route") == "invalid", ingest.raw_review_id()).otherwise(
        F.col("msg").getField("review_id"))
    return r.select(rid.alias("review_id"), "route")


OVERSIZE_LIMIT = 2048  # puts documents on both sides


@register("route_oversize")
def q_route_oversize(spark, sf_dir):
    d = load_table(spark, sf_dir, "documents")
    msgs = d.select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("review_id"),
                                       F.col("text").alias("review_content"))).alias("value"),
                    F.octet_length("text").cast("long").alias("text_bytes"))
    routed = ingest.route_messages(ingest.parse_messages(msgs.select("value")), max_bytes=OVERSIZE_LIMIT)
    ids = routed.select(F.col("msg").getField("review_id").alias("review_id"), "route")
    sizes = d.select(F.col("doc_id").cast("string").alias("review_id"),
                     F.octet_length("text").cast("long").alias("text_bytes"))
    return ids.join(sizes, "review_id")


STREAM_NOW = _dt.datetime(2024, 6, 1, 12)


def _run_stream(spark, sf_dir):
    src = scratch_path(spark, "stream_src")
    event_messages(spark, sf_dir).write.text(src)
    table, errors = scratch_path(spark, "stream_table"), scratch_path(spark, "stream_errors")
    ingest.create_sinks(spark, table, errors)
    q = ingest.start_ingest(spark, src, table, errors, scratch_path(spark, "stream_ckpt"),
                            max_files_per_trigger=4, now=F.lit(STREAM_NOW))
    q.awaitTermination()
    return table, errors


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    table, _ = _run_stream(spark, sf_dir)
    from opinio.schemas import RAW as _RAW
    return ingest.read_sink(spark, table, _RAW)


@register("stream_dead_letter")
def q_stream_dead_letter(spark, sf_dir):
    _, errors = _run_stream(spark, sf_dir)
    rows = ingest.read_sink(spark, errors, ERROR, day=False)
    field = F.regexp_extract("review_snippet", r'"rating":("?[a-z0-9]+"?)', 1)
    reviewer = F.regexp_extract("review_snippet", r'"reviewer_id":"([^"]*)"', 1)
    return rows.select("timestamp", "review_id", "error_message", field.alias("rating"), reviewer.alias("reviewer_id"),
                       F.contains("review_snippet", F.lit("error_message")).alias("repeats_message"))


def _run_log(spark, sf_dir) -> str:
    """The messages as a log of four partitions, streamed into a committed sink."""
    log, sink = scratch_path(spark, "log"), scratch_path(spark, "log_sink")
    messages = event_messages(spark, sf_dir)
    (messages.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(4))).hint("rebalance", "part")
     .write.partitionBy("part").text(log))
    committed.create_sink(sink)
    stream = folder_log.stream_log(spark, log, progress=f"{scratch_path(spark, 'log_progress')}/offset",
                                   max_bytes=LOG_BATCH_BYTES)
    ingest.drain(ingest.start_committed(stream, sink, scratch_path(spark, "log_ckpt"), now=F.lit(STREAM_NOW),
                                        available_now=False))
    return sink


#: Bytes that a batch of the log admits.
LOG_BATCH_BYTES = 64 << 20


@register("stream_from_log")
def q_stream_from_log(spark, sf_dir):
    """S5 by offsets, K6: the table of a committed sink, its small files packed by day."""
    from opinio.schemas import RAW as _RAW
    sink = _run_log(spark, sf_dir)
    committed.compact(spark, sink)
    return committed.read_committed(spark, sink, committed.TABLE, _RAW).withColumn("dt", F.to_date("timestamp"))


@register("stream_from_log_letters")
def q_stream_from_log_letters(spark, sf_dir):
    """K7: the dead letters that the same manifests name."""
    rows = committed.read_committed(spark, _run_log(spark, sf_dir), committed.LETTERS, ERROR)
    field = F.regexp_extract("review_snippet", r'"rating":("?[a-z0-9]+"?)', 1)
    reviewer = F.regexp_extract("review_snippet", r'"reviewer_id":"([^"]*)"', 1)
    return rows.select("timestamp", "review_id", "error_message", field.alias("rating"), reviewer.alias("reviewer_id"),
                       F.contains("review_snippet", F.lit("error_message")).alias("repeats_message"))


# --- the daily job end to end ------------------------------------------------------------

from opinio.plans import daily  # noqa: E402
from opinio.schemas import FINAL  # noqa: E402


@register("daily_features")
def q_daily_features(spark, sf_dir):
    """S2 -> features within one day -> K2 into a day-partitioned final table."""
    src = scratch_path(spark, "raw_table")
    _raw(spark, sf_dir).withColumn("dt", F.to_date("timestamp")).write.partitionBy("dt").parquet(src)
    loc = scratch_path(spark, "final_table")
    name = "reviews_final_" + loc.rsplit("-", 1)[-1][:12]
    sinks.create_table(spark, name, FINAL, loc)
    return round_doubles(daily.run(spark, src, name, DAY))


@register("join_left_similarity")
def q_join_left_similarity(spark, sf_dir):
    """Reviews left-joined to the reviewer similarity, then rows with any null dropped."""
    r = _raw(spark, sf_dir)
    clean = r.select("reviewer_id", "review_id", clean_content("review_content").alias("review_content"))
    sims = sim.reviewer_similarity(clean)
    out = r.join(sims, "reviewer_id", "left")
    return round_doubles(prep.drop_null_rows(out).select("review_id", "reviewer_id", "cos_sim"))
