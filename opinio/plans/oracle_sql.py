"""DuckDB oracle statements for the registered queries.

Each statement runs on the driver's pre-registered views (``documents``,
``labels``, ``pages``, ``events`` ...). The review-shaped view is the same
CTE in every statement. Floats are rounded to 6 places on both sides.
"""

from __future__ import annotations

from opinio.functions.stopwords import ENGLISH_STOP_WORDS

# RE2 spelling of the cleaning classes (see opinio.functions.text).
RE2_WS = r"[\t\n\x0B\f\r\x1c-\x1f \x85\pZ]+"
RE2_WORD = r"[\pL\pN_]"

REVIEWS_CTE = """reviews AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS review_id,
         'u' || CAST(d.n_chars % 250 AS VARCHAR) AS reviewer_id,
         d.source AS restaurant_id,
         CAST(DATE '2024-01-01' + CAST(d.doc_id % 7 AS INTEGER) AS TIMESTAMP) AS "timestamp",
         CAST(1 + d.doc_id % 5 AS BIGINT) AS rating,
         d.text AS review_content,
         CAST((d.doc_id * 3) % 50 AS BIGINT) AS friend_count,
         CAST((d.doc_id * 7) % 50 AS BIGINT) AS review_count,
         CAST((d.doc_id * 11) % 50 AS BIGINT) AS useful_count,
         CAST((d.doc_id * 13) % 50 AS BIGINT) AS cool_count,
         CAST((d.doc_id * 17) % 50 AS BIGINT) AS funny_count,
         CAST(1 AS DOUBLE) + CAST((d.doc_id * 7) % 9 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS restaurant_rating,
         l.quality = 0 AS flagged
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP_LIST = sql_list(ENGLISH_STOP_WORDS)


def clean_expr(c: str) -> str:
    """T1 then T2 in DuckDB SQL."""
    t1 = (f"coalesce(array_to_string(list_filter(regexp_split_to_array({c}, '{RE2_WS}'), "
          f"lambda x: x <> '' AND NOT list_contains({STOP_LIST}, x)), ' '), '')")
    return f"coalesce(lower(array_to_string(regexp_extract_all({t1}, '({RE2_WORD}+)', 1), ' ')), '')"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CLEAN_CTE = f"""clean AS (
  SELECT review_id, reviewer_id, "timestamp", {clean_expr('review_content')} AS review_content
  FROM reviews WHERE reviewer_id IS NOT NULL
)"""

TOKENS_CTE = f"""toks AS (
  SELECT reviewer_id, review_id, unnest(regexp_extract_all(review_content, '({RE2_WORD}{{2,}})', 1)) AS token
  FROM clean
),
ndocs AS (SELECT reviewer_id, count(*) AS n_docs FROM clean GROUP BY reviewer_id),
tf AS (SELECT reviewer_id, review_id, token, count(*) AS tf FROM toks GROUP BY ALL),
dfreq AS (SELECT reviewer_id, token, count(*) AS df FROM tf GROUP BY ALL),
rawv AS (
  SELECT tf.reviewer_id, tf.review_id, tf.token, tf.tf, dfreq.df,
         tf.tf * (ln((1.0 + n.n_docs) / (1.0 + dfreq.df)) + 1.0) AS raw
  FROM tf JOIN dfreq USING (reviewer_id, token) JOIN ndocs n USING (reviewer_id)
),
vecs AS (
  SELECT reviewer_id, review_id, token, tf, df,
         raw / sqrt(sum(raw * raw) OVER (PARTITION BY reviewer_id, review_id)) AS weight
  FROM rawv
),
pairs AS (
  SELECT a.reviewer_id, a.review_id AS a_id, b.review_id AS b_id, sum(a.weight * b.weight) AS cosine
  FROM vecs a JOIN vecs b ON a.reviewer_id = b.reviewer_id AND a.token = b.token AND a.review_id < b.review_id
  GROUP BY ALL
),
sims AS (
  SELECT r.reviewer_id, least(coalesce(max(p.cosine), 0.0), 1.0) AS cos_sim
  FROM (SELECT DISTINCT reviewer_id FROM clean) r LEFT JOIN pairs p USING (reviewer_id)
  GROUP BY r.reviewer_id
)"""

COUNTS_CTE = """counts AS (
  SELECT reviewer_id, "timestamp", count(*) AS "count"
  FROM reviews WHERE reviewer_id IS NOT NULL AND "timestamp" IS NOT NULL
  GROUP BY ALL
)"""


ORACLES: dict[str, str] = {}

ORACLES["max_reviews_norm"] = with_ctes(REVIEWS_CTE, COUNTS_CTE) + """
SELECT reviewer_id, "timestamp", "count",
       round(CAST("count" AS DOUBLE) / (SELECT max("count") FROM counts), 6) AS maximum_review_per_user
FROM counts"""

ORACLES["review_count_per_day"] = with_ctes(REVIEWS_CTE) + """
SELECT reviewer_id, CAST("timestamp" AS DATE) AS count_key, count(*) AS "count"
FROM reviews WHERE reviewer_id IS NOT NULL AND "timestamp" IS NOT NULL
GROUP BY ALL"""

ORACLES["max_review_count"] = with_ctes(REVIEWS_CTE, COUNTS_CTE) + """
SELECT max("count") AS max_review_count FROM counts"""

ORACLES["join_review_count"] = with_ctes(REVIEWS_CTE, COUNTS_CTE) + """
SELECT r.review_id, r.reviewer_id, r."timestamp", c."count"
FROM reviews r JOIN counts c ON r.reviewer_id = c.reviewer_id AND r."timestamp" = c."timestamp\""""

ORACLES["rating_deviation"] = with_ctes(REVIEWS_CTE) + """
SELECT review_id, rating, restaurant_rating,
       round(abs(CAST(rating AS DOUBLE) - restaurant_rating) / 4.0, 6) AS rating_deviation
FROM reviews"""

ORACLES["clean_content"] = with_ctes(REVIEWS_CTE) + f"""
SELECT review_id, {clean_expr('review_content')} AS review_content FROM reviews"""

ORACLES["review_length"] = with_ctes(REVIEWS_CTE, CLEAN_CTE) + """
SELECT review_id,
       CAST(len(string_split(review_content, ' ')) AS BIGINT) AS review_length,
       CAST(CASE WHEN review_content = '' THEN 0 ELSE len(string_split(review_content, ' ')) END AS BIGINT)
         AS review_length_nonempty
FROM clean"""

ORACLES["tfidf_weights"] = with_ctes(REVIEWS_CTE, CLEAN_CTE, TOKENS_CTE) + """
SELECT reviewer_id, review_id, token, tf, df, round(weight, 6) AS weight FROM vecs"""

ORACLES["max_cosine"] = with_ctes(REVIEWS_CTE, CLEAN_CTE, TOKENS_CTE) + """
SELECT reviewer_id, round(cos_sim, 6) AS cos_sim FROM sims"""

COPIES_CTE = """ texts AS (
  SELECT reviewer_id, review_id, string_agg(token || ':' || tf, ',' ORDER BY token) AS terms FROM tf GROUP BY ALL
),
copies AS (
  SELECT reviewer_id, review_id, min(review_id) OVER (PARTITION BY reviewer_id, terms) AS class_id FROM texts
)"""

ORACLES["pair_similarity"] = with_ctes(REVIEWS_CTE, CLEAN_CTE, TOKENS_CTE, COPIES_CTE) + """
SELECT p.reviewer_id, a_id AS review_id_a, b_id AS review_id_b, round(least(cosine, 1.0), 6) AS cosine
FROM pairs p
JOIN copies a ON a.reviewer_id = p.reviewer_id AND a.review_id = a_id AND a.class_id = a_id
JOIN copies b ON b.reviewer_id = p.reviewer_id AND b.review_id = b_id AND b.class_id = b_id
WHERE cosine >= 0.5 - 1e-9"""

ORACLES["pair_similarity_members"] = with_ctes(REVIEWS_CTE, CLEAN_CTE, TOKENS_CTE, COPIES_CTE) + """
SELECT reviewer_id, review_id, class_id FROM copies"""

ORACLES["review_features"] = with_ctes(REVIEWS_CTE, COUNTS_CTE, CLEAN_CTE, TOKENS_CTE) + """
SELECT r.review_id, r.reviewer_id, r.restaurant_id, r."timestamp", r.rating,
       c.review_content, r.friend_count, r.review_count, r.useful_count, r.cool_count,
       r.funny_count, r.restaurant_rating,
       CAST(len(string_split(c.review_content, ' ')) AS BIGINT) AS review_length,
       round(abs(CAST(r.rating AS DOUBLE) - r.restaurant_rating) / 4.0, 6) AS rating_deviation,
       round(CAST(n."count" AS DOUBLE) / (SELECT max("count") FROM counts), 6) AS maximum_review_per_user,
       round(s.cos_sim, 6) AS cos_sim
FROM reviews r
JOIN clean c USING (review_id)
JOIN counts n ON r.reviewer_id = n.reviewer_id AND r."timestamp" = n."timestamp"
JOIN sims s ON r.reviewer_id = s.reviewer_id"""


# --- step 4: sources, preparation, filters, limits, set ops ------------------------

RAW_SELECT = """review_id, reviewer_id, restaurant_id, "timestamp", rating, review_content, friend_count,
       review_count, useful_count, cool_count, funny_count, restaurant_rating"""
YN = "CASE WHEN flagged THEN 'Y' WHEN NOT flagged THEN 'N' END"
SLASH = "'%-m/%-d/%Y'"
DAY_SQL = "DATE '2024-01-03'"

ORACLES["scan_reviews"] = with_ctes(REVIEWS_CTE) + "SELECT * FROM reviews"

ORACLES["scan_day"] = with_ctes(REVIEWS_CTE) + f"""
SELECT {RAW_SELECT} FROM reviews WHERE CAST("timestamp" AS DATE) = {DAY_SQL}"""

ORACLES["csv_roundtrip"] = with_ctes(REVIEWS_CTE) + f"SELECT {RAW_SELECT} FROM reviews"

ORACLES["lines_source"] = """
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents),
lines AS (SELECT doc_id, unnest(p) AS value, generate_subscripts(p, 1) AS pos FROM parts)
SELECT CAST(row_number() OVER (ORDER BY doc_id, pos) - 1 AS BIGINT) AS line_no, value FROM lines"""

ORACLES["bulk_load_day"] = ORACLES["scan_day"]
ORACLES["quoted_csv_roundtrip"] = ORACLES["csv_roundtrip"]
ORACLES["bulk_load_table"] = with_ctes(REVIEWS_CTE) + f"""
SELECT {RAW_SELECT}, CAST("timestamp" AS DATE) AS dt FROM reviews"""
ORACLES["messages_roundtrip"] = with_ctes(REVIEWS_CTE) + f"""
SELECT review_id AS key, * REPLACE (CAST(epoch("timestamp") AS BIGINT) AS "timestamp")
FROM (SELECT {RAW_SELECT} FROM reviews)"""

ORACLES["overwrite_day"] = with_ctes(REVIEWS_CTE) + f"""
SELECT review_id, reviewer_id, restaurant_id, "timestamp",
       CAST(CASE WHEN CAST("timestamp" AS DATE) = {DAY_SQL} THEN 0 ELSE rating END AS BIGINT) AS rating,
       review_content, friend_count, review_count, useful_count, cool_count, funny_count,
       restaurant_rating, CAST("timestamp" AS DATE) AS dt
FROM reviews"""

ORACLES["prepare_raw"] = ORACLES["csv_roundtrip"]

ORACLES["prepare_labeled"] = with_ctes(REVIEWS_CTE) + f"""
SELECT {RAW_SELECT},
       CAST(length(review_content) AS BIGINT) AS review_length,
       round(abs(CAST(rating AS DOUBLE) - restaurant_rating) / 4.0, 6) AS rating_deviation,
       round(CAST(CAST(review_id AS BIGINT) % 4 AS DOUBLE) / 4.0, 6) AS maximum_review_per_user,
       round(CAST(CAST(review_id AS BIGINT) % 10 AS DOUBLE) / 10.0, 6) AS cos_sim,
       flagged
FROM reviews"""

ORACLES["recode_label"] = with_ctes(REVIEWS_CTE) + f"SELECT review_id, {YN} AS flagged FROM reviews"

ORACLES["recode_text_label"] = with_ctes(REVIEWS_CTE) + f"""
SELECT review_id, coalesce({YN}, '') AS label_text,
       CASE WHEN coalesce({YN}, '') = 'Y' THEN 'true' ELSE 'false' END AS label
FROM reviews"""

ORACLES["filter_flagged"] = with_ctes(REVIEWS_CTE) + """
SELECT review_id, reviewer_id, 'Y' AS flagged FROM reviews WHERE flagged"""

ORACLES["filter_exact_ts"] = with_ctes(REVIEWS_CTE) + """
SELECT review_id, "timestamp" FROM reviews WHERE "timestamp" = TIMESTAMP '2024-01-02 00:00:00'"""

ORACLES["filter_before"] = with_ctes(REVIEWS_CTE) + """
SELECT review_id, "timestamp" FROM reviews WHERE "timestamp" < TIMESTAMP '2024-01-04 00:00:00'"""

_ALL13 = ["review_id", "reviewer_id", "restaurant_id", "\"timestamp\"", "rating", "review_content",
          "friend_count", "review_count", "useful_count", "cool_count", "funny_count",
          "restaurant_rating", "flagged"]

ORACLES["drop_null_rows"] = with_ctes(REVIEWS_CTE) + "SELECT review_id, flagged FROM reviews WHERE " + \
    " AND ".join(f"{c} IS NOT NULL" for c in _ALL13)

ORACLES["null_audit"] = with_ctes(REVIEWS_CTE) + "SELECT " + ",\n  ".join(
    f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c.strip(chr(34))}_nulls, "
    f"CAST(count({c}) AS BIGINT) AS {c.strip(chr(34))}_non_null" for c in _ALL13) + " FROM reviews"

ORACLES["valid_ids"] = with_ctes(REVIEWS_CTE) + f"""
, messy AS (
  SELECT CASE CAST(review_id AS BIGINT) % 10 WHEN 0 THEN '   ' WHEN 1 THEN NULL WHEN 2 THEN ''
              ELSE ' ' || review_id || chr(9) END AS review_id, reviewer_id
  FROM reviews)
SELECT regexp_replace(review_id, '^{RE2_WS}|{RE2_WS}$', '', 'g') AS review_id, reviewer_id
FROM messy WHERE regexp_replace(review_id, '^{RE2_WS}|{RE2_WS}$', '', 'g') <> ''"""

ORACLES["strip_leading_newline"] = with_ctes(REVIEWS_CTE) + f"""
SELECT review_id, strftime("timestamp", {SLASH}) AS date FROM reviews"""

ORACLES["positional_join"] = f"""
WITH a AS (SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS line_no,
                  regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS review FROM documents),
b AS (SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS line_no,
             strftime(DATE '2024-01-01' + CAST(doc_id % 7 AS INTEGER), {SLASH}) AS date,
             CAST(doc_id AS VARCHAR) AS review_id, 'r' || CAST(doc_id % 250 AS VARCHAR) AS reviewer_id,
             'p' || CAST(doc_id % 20 AS VARCHAR) AS product_id,
             CASE WHEN quality = 0 THEN 'Y' ELSE 'N' END AS label, CAST(toxic AS VARCHAR) AS a,
             '0' AS b, '0' AS c, CAST(doc_id % 5 + 1 AS VARCHAR) AS rating FROM labels)
SELECT coalesce(b.line_no, a.line_no) AS line_no, b.date, b.review_id, b.reviewer_id, b.product_id,
       b.label, b.a, b.b, b.c, b.rating, a.review
FROM b FULL OUTER JOIN a ON a.line_no = b.line_no"""

ORACLES["page_frontier"] = """
SELECT page_id, CAST(j AS BIGINT) AS page_no, url || '?start=' || CAST(j * 20 AS VARCHAR) AS page_url
FROM pages, range(0, 3) t(j)"""

LINK_TEXT_RE = '<a href="[^"]*">([^<]*)</a>'

ORACLES["chunk_triples"] = f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '{LINK_TEXT_RE}', 1) AS t FROM pages)
SELECT page_id, CAST(c AS BIGINT) AS chunk_no, t[3 * c + 1] AS slot0, t[3 * c + 2] AS slot1, t[3 * c + 3] AS slot2
FROM l, range(0, CAST(ceil(len(t) / 3.0) AS BIGINT)) r(c)"""

ORACLES["split_parts"] = """
SELECT page_id, split_part(regexp_extract(html, '<title>([^<]*)</title>', 1), ' ', 1) AS first_word,
       split_part(url, '/', -1) AS last_path, split_part(url, '=', -1) AS after_eq
FROM pages"""

ORACLES["count_or_zero"] = """
WITH l AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type
                                 ELSE concat_ws(' ', event_type, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)) END AS label
           FROM events)
SELECT event_id, label,
       CAST(CASE WHEN len(string_split(label, ' ')) > 1 THEN TRY_CAST(string_split(label, ' ')[-1] AS BIGINT)
                 ELSE 0 END AS BIGINT) AS n
FROM l"""

ORACLES["surrogate_key"] = with_ctes(REVIEWS_CTE) + """
SELECT review_id, substr(sha256(concat_ws('~', reviewer_id, restaurant_id, CAST("timestamp" AS VARCHAR),
                                            review_content)), 1, 22) AS key
FROM reviews"""

ORACLES["parse_dates"] = with_ctes(REVIEWS_CTE) + f"""
SELECT review_id, strftime("timestamp", {SLASH}) AS date, "timestamp" AS parsed,
       CAST(epoch("timestamp") AS BIGINT) AS epoch, strftime("timestamp", '%Y-%m-%d 00:00:00') AS midnight
FROM reviews"""

ORACLES["partition_id"] = with_ctes(REVIEWS_CTE) + """
SELECT review_id, strftime("timestamp", '%Y%m%d') AS partition_id FROM reviews"""

ORACLES["count_by_label"] = with_ctes(REVIEWS_CTE) + f"""
SELECT {YN} AS flagged, count(*) AS n FROM reviews GROUP BY 1"""

ORACLES["distinct_labels"] = with_ctes(REVIEWS_CTE) + f"SELECT DISTINCT {YN} AS flagged FROM reviews"

ORACLES["first_n"] = with_ctes(REVIEWS_CTE) + """
SELECT review_id, reviewer_id, rating FROM reviews ORDER BY review_id LIMIT 5"""

ORACLES["last_n"] = with_ctes(REVIEWS_CTE) + """
SELECT review_id, reviewer_id, rating FROM reviews ORDER BY review_id DESC LIMIT 5"""

ORACLES["union_classes"] = with_ctes(REVIEWS_CTE) + f"""
SELECT review_id, 'N' AS flagged FROM reviews WHERE NOT flagged
UNION ALL SELECT review_id, 'Y' FROM reviews WHERE flagged
UNION ALL SELECT review_id, 'Y' FROM reviews WHERE flagged"""


# --- step 7: summaries, terms, sentiment --------------------------------------------

from opinio.functions.text import PUNCTUATION  # noqa: E402


def _describe(metric: str, src: str, by: str) -> str:
    return (f"SELECT {by} AS flagged, count({metric}) AS count, round(avg({metric}), 6) AS mean, "
            f"round(stddev_samp({metric}), 6) AS std, round(min({metric}), 6) AS min, "
            f"round(quantile_cont({metric}, 0.25), 6) AS p25, round(quantile_cont({metric}, 0.5), 6) AS p50, "
            f"round(quantile_cont({metric}, 0.75), 6) AS p75, round(max({metric}), 6) AS max "
            f"FROM {src} GROUP BY 1")


METRIC_CTE = f"""metric AS (
  SELECT review_id, {YN} AS yn, CAST(length(review_content) AS DOUBLE) AS m FROM reviews
)"""

ORACLES["describe_metric"] = with_ctes(REVIEWS_CTE, METRIC_CTE) + _describe("m", "metric", "yn")

ORACLES["histogram_metric"] = with_ctes(REVIEWS_CTE, METRIC_CTE) + """
SELECT yn AS flagged, round(floor(m / 500.0) * 500.0, 6) AS bucket, count(*) AS n
FROM metric WHERE m IS NOT NULL GROUP BY ALL"""

ORACLES["top_terms"] = with_ctes(REVIEWS_CTE) + f"""
, t AS (SELECT {YN} AS flagged,
               unnest(list_filter(regexp_extract_all(lower(review_content), '({RE2_WORD}{{2,}})', 1),
                                  lambda x: NOT list_contains({STOP_LIST}, x))) AS term
        FROM reviews),
c AS (SELECT flagged, term, count(*) AS n FROM t WHERE flagged IN ('Y', 'N') GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY flagged ORDER BY n DESC, term) AS rk FROM c)
SELECT flagged, term, n FROM r WHERE rk <= 50"""

_PUNCT_CLASS = "[" + "".join("\\" + ch for ch in PUNCTUATION) + "]"
_PUNCT_SQL = _PUNCT_CLASS.replace("'", "''")


def sentiment_tokens_expr(c: str) -> str:
    """T5 token list (before lemmas and the one-letter filter) in DuckDB SQL."""
    toks = (f"list_transform(string_split(lower(coalesce({c}, 'None')), ' '), "
            f"lambda x: regexp_replace(x, '^{_PUNCT_SQL}+|{_PUNCT_SQL}+$', '', 'g'))")
    toks = f"list_filter({toks}, lambda x: NOT regexp_matches(x, '\\p{{Nd}}'))"
    toks = f"list_filter({toks}, lambda x: NOT list_contains({STOP_LIST}, x))"
    return f"list_filter({toks}, lambda x: length(x) > 0)"


def values_table(name: str, cols: str, rows, num: bool = False) -> str:
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({v!r} AS DOUBLE)"
    body = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"{name} AS (SELECT * FROM (VALUES {body}) v({cols}))"


def _lemma_cte():
    from opinio.plans.queries import DEFAULT_LEMMAS
    return values_table("lm", "form, lemma", sorted(DEFAULT_LEMMAS.items()))


def _lexicon_cte():
    from opinio.operators.sentiment import DEFAULT_LEXICON
    return values_table("lx", "token, valence", sorted(DEFAULT_LEXICON.items()))


ORACLES["clean_for_sentiment"] = with_ctes(REVIEWS_CTE) + f"""
SELECT review_id, array_to_string(list_filter({sentiment_tokens_expr('review_content')},
                                              lambda x: length(x) > 1), ' ') AS review_clean
FROM reviews"""

SENT_TOKENS_CTE = f"""st AS (SELECT review_id, {sentiment_tokens_expr('review_content')} AS toks FROM reviews),
tk AS (SELECT review_id, unnest(toks) AS token, generate_subscripts(toks, 1) - 1 AS pos FROM st)"""


def _lemma_lookup_sql():
    return with_ctes(REVIEWS_CTE, SENT_TOKENS_CTE, _lemma_cte()) + """
SELECT tk.review_id, CAST(tk.pos AS BIGINT) AS pos, tk.token, coalesce(lm.lemma, tk.token) AS lemma
FROM tk LEFT JOIN lm ON lm.form = tk.token"""


def _scores_cte():
    return f"""lt AS (SELECT tk.review_id, coalesce(lm.lemma, tk.token) AS tok FROM tk LEFT JOIN lm ON lm.form = tk.token),
vv AS (SELECT lt.review_id, coalesce(lx.valence, 0.0) AS v FROM lt LEFT JOIN lx ON lx.token = lt.tok
       WHERE length(lt.tok) > 1),
ag AS (SELECT review_id, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS ps,
              sum(CASE WHEN v < 0 THEN v - 1 ELSE 0 END) AS ns,
              count(*) FILTER (WHERE v = 0) AS nu, sum(v) AS s
       FROM vv GROUP BY review_id),
scores AS (
  SELECT r.review_id,
         coalesce(round(abs(ns) / (ps + abs(ns) + nu), 3), 0.0) AS neg,
         coalesce(round(nu / (ps + abs(ns) + nu), 3), 0.0) AS neu,
         coalesce(round(ps / (ps + abs(ns) + nu), 3), 0.0) AS pos,
         coalesce(round(s / sqrt(s * s + 15.0), 4), 0.0) AS compound
  FROM reviews r LEFT JOIN ag USING (review_id))"""


def _sentiment_scores_sql():
    return with_ctes(REVIEWS_CTE, SENT_TOKENS_CTE, _lemma_cte(), _lexicon_cte(), _scores_cte()) + """
SELECT review_id, round(neg, 6) AS neg, round(neu, 6) AS neu, round(pos, 6) AS pos,
       round(compound, 6) AS compound FROM scores"""


def _sentiment_by_label_sql():
    return (with_ctes(REVIEWS_CTE, SENT_TOKENS_CTE, _lemma_cte(), _lexicon_cte(), _scores_cte())
            + f", sl AS (SELECT s.compound, {YN} AS yn FROM scores s JOIN reviews USING (review_id))\n"
            + _describe("compound", "sl", "yn"))


ORACLES["lemma_lookup"] = _lemma_lookup_sql()
ORACLES["sentiment_scores"] = _sentiment_scores_sql()
ORACLES["sentiment_columns"] = with_ctes(REVIEWS_CTE, f"scores AS ({_sentiment_scores_sql()})") + """
SELECT review_id, reviewer_id, rating, neg, neu, pos, compound FROM reviews JOIN scores USING (review_id)"""
ORACLES["sentiment_by_label"] = _sentiment_by_label_sql()


def _lemma_by_tag_sql() -> str:
    """Candidates of three steps by a table of the detachment rules."""
    from opinio.operators.lemmas import RULES

    rules = ", ".join(f"('{tag}', {i}, '{end}', '{new}')" for tag, own in RULES.items() for i, (end, new) in enumerate(own, 1))

    def applied(source: str, step: int) -> str:
        cand = "left(c.cand, length(c.cand) - length(r.ending)) || r.repl"
        return f"""SELECT c.form, c.tag, {step} AS step, c.place * 100 + r.ord AS place, {cand} AS cand
FROM {source} c JOIN rules r ON r.tag = c.tag AND c.cand LIKE '%' || r.ending WHERE {cand} <> ''"""

    return with_ctes(REVIEWS_CTE, SENT_TOKENS_CTE, _lemma_cte()) + f"""
, rules AS (SELECT * FROM (VALUES {rules}) v(tag, ord, ending, repl)),
tg AS (SELECT *, CASE WHEN regexp_matches(token, '(ed|ing)$') THEN 'v' WHEN regexp_matches(token, '(er|est)$') THEN 'a'
                      WHEN regexp_matches(token, 'ly$') THEN 'r' ELSE 'n' END AS tag FROM tk),
vocab AS (SELECT token FROM tk GROUP BY 1 HAVING count(*) >= 3),
f0 AS (SELECT DISTINCT token AS form, tag, 1 AS step, 0 AS place, token AS cand FROM tg),
ruled AS (SELECT * FROM f0 WHERE NOT (tag = 'n' AND form IN (SELECT form FROM lm))),
s1 AS ({applied('ruled', 1)}),
s2 AS ({applied('s1', 2)}),
s3 AS ({applied('s2', 3)}),
ex AS (SELECT f0.form, 'n', 1, 1, lm.lemma FROM f0 JOIN lm ON lm.form = f0.form WHERE f0.tag = 'n'),
every AS (SELECT * FROM f0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3
          UNION ALL SELECT * FROM ex),
best AS (SELECT form, tag, arg_min(cand, [step, length(cand), place]) AS lemma
         FROM every WHERE cand IN (SELECT token FROM vocab) GROUP BY 1, 2)
SELECT tg.review_id, CAST(tg.pos AS BIGINT) AS pos, tg.token, tg.tag, coalesce(best.lemma, tg.token) AS lemma
FROM tg LEFT JOIN best ON best.form = tg.token AND best.tag = tg.tag"""


ORACLES["lemma_by_tag"] = _lemma_by_tag_sql()

SHIFT_CTE = f"""wd AS (SELECT review_id, {YN} AS yn, regexp_extract_all(coalesce(review_content, ''), '([A-Za-zÀ-ɏ]+)', 1) AS ws
       FROM reviews),
wp AS (SELECT review_id, yn, unnest(ws) AS token, generate_subscripts(ws, 1) AS pos FROM wd),
wc AS (SELECT lower(token) AS token, count(*) FILTER (WHERE yn = 'N') AS g, count(*) FILTER (WHERE yn = 'Y') AS b
       FROM wp WHERE yn IN ('N', 'Y') GROUP BY 1),
wn AS (SELECT greatest(sum(g), 1) AS g, greatest(sum(b), 1) AS b FROM wc),
lex AS (SELECT token, 4.0::DOUBLE * ((wc.g / wn.g::DOUBLE - wc.b / wn.b::DOUBLE) / (wc.g / wn.g::DOUBLE + wc.b / wn.b::DOUBLE))
               AS valence
        FROM wc, wn WHERE wc.g + wc.b >= 20),
lexicon AS (SELECT * FROM lex WHERE valence <> 0)"""

ORACLES["learned_lexicon"] = with_ctes(REVIEWS_CTE, SHIFT_CTE) + """
SELECT token, round(valence, 6) AS valence FROM lexicon"""


def _shift_steps() -> str:
    """Three nested steps: word, place back, damping."""
    sql = "SELECT *, valence + CASE WHEN loud THEN 0.733::DOUBLE ELSE 0.0::DOUBLE END * sign(valence) AS v0 FROM ln"
    for k, damping in ((1, "1.0"), (2, "0.95"), (3, "0.9")):
        sql = f"""SELECT *, (v{k - 1} + CASE WHEN f{k} THEN
                coalesce((s{k} + CASE WHEN l{k} THEN 0.733::DOUBLE ELSE 0.0::DOUBLE END) * sign(v{k - 1}), 0.0::DOUBLE)
                ELSE 0.0::DOUBLE END * {damping}::DOUBLE)
            * CASE WHEN f{k} AND coalesce(n{k}, false) THEN (-0.74)::DOUBLE ELSE 1.0::DOUBLE END AS v{k} FROM ({sql})"""
    return sql


_LAGS = ", ".join(f"lag(shift, {k}) OVER w AS s{k}, lag(loud, {k}) OVER w AS l{k}, lag(negates, {k}) OVER w AS n{k}, "
                  f"coalesce(lag(valence, {k}) OVER w, 0) = 0 AS f{k}" for k in (1, 2, 3))

ORACLES["sentiment_shifted"] = with_ctes(REVIEWS_CTE, SHIFT_CTE) + f"""
, mk AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS rank FROM (
        SELECT lower(token) AS token, count(*) AS n FROM wp WHERE length(token) <= 3 GROUP BY 1)),
mods AS (SELECT * FROM mk WHERE rank <= 18),
tok AS (SELECT wp.review_id, wp.pos, x.valence, CASE WHEN rank <= 6 THEN 0.293::DOUBLE WHEN rank <= 12 THEN (-0.293)::DOUBLE END AS shift,
               coalesce(rank > 12, false) AS negates, upper(wp.token) = wp.token AND lower(wp.token) <> wp.token AS up
        FROM wp LEFT JOIN mods m ON m.token = lower(wp.token)
             LEFT JOIN lexicon x ON x.token = lower(wp.token) AND m.token IS NULL),
mx AS (SELECT *, up AND bool_or(up) OVER (PARTITION BY review_id) AND NOT bool_and(up) OVER (PARTITION BY review_id) AS loud
       FROM tok),
ln AS (SELECT *, {_LAGS} FROM mx WINDOW w AS (PARTITION BY review_id ORDER BY pos)),
vs AS (SELECT review_id, CASE WHEN coalesce(valence, 0) = 0 THEN 0.0::DOUBLE ELSE v3 END AS v FROM ({_shift_steps()})),
ag AS (SELECT review_id, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS ps, sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS ns,
              count(*) FILTER (WHERE v = 0) AS nu, sum(v) AS s FROM vs GROUP BY 1)
SELECT r.review_id, round(coalesce(ns / (ps + ns + nu), 0.0), 6) AS neg, round(coalesce(nu / (ps + ns + nu), 0.0), 6) AS neu,
       round(coalesce(ps / (ps + ns + nu), 0.0), 6) AS pos, round(coalesce(s / sqrt(s * s + 15.0), 0.0), 6) AS compound
FROM reviews r LEFT JOIN ag USING (review_id)"""


# --- step 8: model data work ----------------------------------------------------------

RANK = "substr(md5('42:' || review_id), 1, 15)"

ORACLES["under_sample"] = with_ctes(REVIEWS_CTE) + f"""
, lab AS (SELECT review_id, {YN} AS flagged FROM reviews WHERE flagged IS NOT NULL),
kk AS (SELECT min(c) AS k FROM (SELECT flagged, count(*) AS c FROM lab GROUP BY 1)),
r AS (SELECT *, row_number() OVER (PARTITION BY flagged ORDER BY {RANK}, review_id) AS rk FROM lab)
SELECT review_id, flagged FROM r WHERE rk <= (SELECT k FROM kk)"""

ORACLES["train_test_split"] = with_ctes(REVIEWS_CTE) + f"""
, lab AS (SELECT review_id FROM reviews WHERE flagged IS NOT NULL),
r AS (SELECT review_id, row_number() OVER (ORDER BY {RANK}, review_id) AS rk, count(*) OVER () AS n FROM lab)
SELECT review_id, CASE WHEN rk <= ceil(n * 0.25) THEN 'test' ELSE 'train' END AS split FROM r"""

FEATS_CTE = """feats AS (
  SELECT r.review_id, r.rating, r.friend_count, r.review_count, r.useful_count, r.cool_count, r.funny_count,
         CAST(len(string_split(c.review_content, ' ')) AS BIGINT) AS review_length,
         abs(CAST(r.rating AS DOUBLE) - r.restaurant_rating) / 4.0 AS rating_deviation,
         CAST(n."count" AS DOUBLE) / (SELECT max("count") FROM counts) AS maximum_review_per_user,
         s.cos_sim, r.flagged
  FROM reviews r
  JOIN clean c USING (review_id)
  JOIN counts n ON r.reviewer_id = n.reviewer_id AND r."timestamp" = n."timestamp"
  JOIN sims s ON r.reviewer_id = s.reviewer_id
)"""

_FEATURES = ["rating", "friend_count", "review_count", "useful_count", "cool_count",
             "funny_count", "review_length", "rating_deviation", "maximum_review_per_user", "cos_sim"]

ORACLES["gaussian_nb_stats"] = with_ctes(REVIEWS_CTE, COUNTS_CTE, CLEAN_CTE, TOKENS_CTE, FEATS_CTE) + \
    f"SELECT {YN} AS flagged, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM feats WHERE flagged IS NOT NULL), 6) AS prior, " + \
    ", ".join(f"round(avg(CAST({f} AS DOUBLE)), 6) AS {f}_mean, round(var_pop(CAST({f} AS DOUBLE)), 6) AS {f}_var"
              for f in _FEATURES) + \
    " FROM feats WHERE flagged IS NOT NULL GROUP BY 1"

PRED_CTE = f"""pred AS (
  SELECT review_id, {YN} AS label, CASE WHEN rating <= 2 THEN 'Y' ELSE 'N' END AS prediction
  FROM reviews WHERE flagged IS NOT NULL
)"""

ORACLES["confusion_matrix"] = with_ctes(REVIEWS_CTE, PRED_CTE) + """
SELECT label, prediction, count(*) AS n FROM pred GROUP BY ALL"""

ORACLES["classification_metrics"] = with_ctes(REVIEWS_CTE, PRED_CTE) + """
, s AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = prediction) AS correct,
              count(*) FILTER (WHERE label = 'Y' AND prediction = 'Y') AS tp,
              count(*) FILTER (WHERE label <> 'Y' AND prediction = 'Y') AS fp,
              count(*) FILTER (WHERE label = 'Y' AND prediction <> 'Y') AS fn FROM pred)
SELECT round(CASE WHEN n > 0 THEN correct / n ELSE 0.0 END, 6) AS accuracy,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1,
       tp, fp, fn, n
FROM s"""


def _nb_cte() -> str:
    """Gaussian naive Bayes of all labelled rows, scored on them."""
    k = range(len(_FEATURES))
    stats = ", ".join(f"avg(x{i}) AS m{i}, var_pop(x{i}) AS v{i}" for i in k)
    lift = "1e-9 * greatest(" + ", ".join(f"var_pop(x{i})" for i in k) + ")"
    joint = " ".join(f"- (x{i} - m{i}) * (x{i} - m{i}) / (2 * (v{i} + lift)) - 0.5 * ln(2 * pi() * (v{i} + lift))" for i in k)
    columns = ", ".join(f"CAST({f} AS DOUBLE) AS x{i}" for i, f in enumerate(_FEATURES))
    return f"""x AS (SELECT review_id, {YN} AS label, {columns} FROM feats WHERE flagged IS NOT NULL),
st AS (SELECT label AS c, count(*) / (SELECT count(*) FROM x)::DOUBLE AS prior, {stats} FROM x GROUP BY 1),
lf AS (SELECT {lift} AS lift FROM x),
jt AS (SELECT review_id, label, c, ln(prior) {joint} AS j FROM x, st, lf),
mj AS (SELECT *, max(j) OVER (PARTITION BY review_id) AS top FROM jt),
pred AS (SELECT review_id, label, min(CASE WHEN j = top THEN c END) AS prediction,
                1.0 / sum(exp(j - top)) AS probability FROM mj GROUP BY 1, 2)"""


ORACLES["nb_scores"] = with_ctes(REVIEWS_CTE, COUNTS_CTE, CLEAN_CTE, TOKENS_CTE, FEATS_CTE, _nb_cte()) + """
SELECT review_id, label, prediction, round(probability, 6) AS probability FROM pred"""

ORACLES["nb_metrics"] = with_ctes(REVIEWS_CTE, COUNTS_CTE, CLEAN_CTE, TOKENS_CTE, FEATS_CTE, _nb_cte()) + \
    ORACLES["classification_metrics"][ORACLES["classification_metrics"].index("\n, s AS ("):]


# --- step 9: pages --------------------------------------------------------------------

HREF_RE = '<a href="([^"]*)">'

ORACLES["extract_from_pages"] = """
SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
       regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
       regexp_extract(html, 'track\\((\\d+)\\)', 1) AS track_id
FROM pages"""

ORACLES["pages_one_day"] = """
SELECT page_id, TIMESTAMP '2024-01-03' AS "timestamp", regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
       regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
       regexp_extract(html, 'track\\((\\d+)\\)', 1) AS track_id
FROM pages WHERE page_id % 7 = 2"""

# Paragraphs run to the next one, their end tag or the end of the article.
ORACLES["card_fields"] = r"""
WITH s AS (SELECT page_id, string_split(html, '<p>') AS parts FROM pages),
p AS (SELECT page_id, unnest(range(len(parts) - 1)) AS slot, unnest(parts[2:]) AS part FROM s),
c AS (SELECT page_id, slot, regexp_extract(part, '^(.*?)(</p>|</article>|$)', 1, 's') AS body FROM p),
t AS (SELECT *, trim(regexp_replace(regexp_replace(body, '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS txt FROM c)
SELECT page_id, slot, nullif(regexp_extract(txt, '^([^ &]+)', 1), '') AS first_word,
       nullif(regexp_extract(body, '<b>\s*([^ &<]+)', 1), '') AS bold
FROM t"""

ORACLES["link_cards"] = r"""
WITH s AS (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS items FROM pages),
c AS (SELECT page_id, unnest(range(len(items))) AS slot, unnest(items) AS item FROM s)
SELECT page_id, slot, nullif(regexp_extract(item, '<a href="(/[^"]*)"', 1), '') AS href,
       nullif(regexp_extract(item, '<a [^>]*>\s*([^ &<]+)', 1), '') AS link_text
FROM c"""

ORACLES["page_header_fields"] = r"""
SELECT page_id, nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang,
       regexp_extract_all(html, '<a href="([^"]*)"', 1)[2] AS second_link,
       nullif(regexp_extract(html, '<div class="ad">\s*([^ &<]+)', 1), '') AS ad_word
FROM pages"""

ORACLES["page_links"] = f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '{HREF_RE}', 1) AS h FROM pages)
SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS BIGINT) AS slot, unnest(h) AS href FROM l"""

ORACLES["align_repeated_fields"] = f"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '{HREF_RE}', 1) AS h,
                  regexp_extract_all(html, '{LINK_TEXT_RE}', 1) AS t,
                  regexp_extract_all(html, '<p>([^<]*)', 1) AS p FROM pages)
SELECT page_id, CAST(i AS BIGINT) AS slot, h[i + 1] AS href, t[i + 1] AS link_text, p[i + 1] AS paragraph
FROM l, range(0, greatest(len(h), len(t), len(p))) r(i)"""


# --- step 6: streaming ingest -----------------------------------------------------------

BAD = "event_id % 97 = 0 OR event_id % 83 = 0"

ORACLES["parse_messages"] = f"""
SELECT CAST(event_id AS VARCHAR) AS review_id,
       CASE WHEN {BAD} THEN 'invalid' WHEN event_id % 89 = 0 THEN 'flagged' ELSE 'ok' END AS route
FROM events"""

ORACLES["route_oversize"] = """
SELECT CAST(doc_id AS VARCHAR) AS review_id,
       CASE WHEN strlen(CAST(to_json(struct_pack(review_id := CAST(doc_id AS VARCHAR), review_content := text))
                             AS VARCHAR)) > 2048 THEN 'oversize' ELSE 'ok' END AS route,
       CAST(strlen(text) AS BIGINT) AS text_bytes
FROM documents"""

ORACLES["stream_ingest"] = f"""
SELECT CAST(event_id AS VARCHAR) AS review_id, 'u' || CAST(user_id AS VARCHAR) AS reviewer_id,
       event_type AS restaurant_id, date_trunc('second', ts) AS "timestamp",
       CAST(event_id % 6 AS BIGINT) AS rating, props AS review_content,
       CAST(user_id % 50 AS BIGINT) AS friend_count, CAST(event_id % 50 AS BIGINT) AS review_count,
       CAST(event_id % 7 AS BIGINT) AS useful_count, CAST(event_id % 11 AS BIGINT) AS cool_count,
       CAST(event_id % 13 AS BIGINT) AS funny_count, value AS restaurant_rating, CAST(ts AS DATE) AS dt
FROM events WHERE NOT ({BAD}) AND event_id % 89 <> 0"""

ORACLES["stream_dead_letter"] = f"""
SELECT CAST(event_id AS VARCHAR) AS review_id,
       CASE WHEN {BAD} THEN '[invalid] malformed or mistyped record'
            ELSE concat_ws(' ', 'flagged by source', event_type) END AS error_message,
       TIMESTAMP '2024-06-01 12:00:00' AS "timestamp",
       CASE WHEN event_id % 83 = 0 AND event_id % 97 <> 0 THEN '"five"' ELSE CAST(event_id % 6 AS VARCHAR) END AS rating,
       'u' || CAST(user_id AS VARCHAR) AS reviewer_id,
       event_id % 89 = 0 AND ({BAD}) AS repeats_message
FROM events WHERE {BAD} OR event_id % 89 = 0"""


ORACLES["stream_from_log"] = ORACLES["stream_ingest"]
ORACLES["stream_from_log_letters"] = ORACLES["stream_dead_letter"]


# --- the daily job end to end ------------------------------------------------------------

_DAY_REVIEWS = REVIEWS_CTE.replace("reviews AS (", "reviews_all AS (", 1) + f""",
reviews AS (SELECT * FROM reviews_all WHERE CAST("timestamp" AS DATE) = {DAY_SQL})"""

ORACLES["daily_features"] = with_ctes(_DAY_REVIEWS, COUNTS_CTE, CLEAN_CTE, TOKENS_CTE) + f"""
SELECT r.review_id, r.reviewer_id, r.restaurant_id, r."timestamp", r.rating,
       c.review_content, r.friend_count, r.review_count, r.useful_count, r.cool_count,
       r.funny_count, r.restaurant_rating,
       CAST(len(string_split(c.review_content, ' ')) AS BIGINT) AS review_length,
       round(abs(CAST(r.rating AS DOUBLE) - r.restaurant_rating) / 4.0, 6) AS rating_deviation,
       round(CAST(n."count" AS DOUBLE) / (SELECT max("count") FROM counts), 6) AS maximum_review_per_user,
       round(s.cos_sim, 6) AS cos_sim, CAST(r."timestamp" AS DATE) AS dt
FROM reviews r
JOIN clean c USING (review_id)
JOIN counts n ON r.reviewer_id = n.reviewer_id AND r."timestamp" = n."timestamp"
JOIN sims s ON r.reviewer_id = s.reviewer_id"""

ORACLES["join_left_similarity"] = with_ctes(REVIEWS_CTE, CLEAN_CTE, TOKENS_CTE) + """
SELECT r.review_id, r.reviewer_id, round(s.cos_sim, 6) AS cos_sim
FROM reviews r LEFT JOIN sims s ON r.reviewer_id = s.reviewer_id
WHERE s.cos_sim IS NOT NULL AND r.review_id IS NOT NULL AND r.reviewer_id IS NOT NULL
  AND r.restaurant_id IS NOT NULL AND r."timestamp" IS NOT NULL AND r.rating IS NOT NULL
  AND r.review_content IS NOT NULL AND r.friend_count IS NOT NULL AND r.review_count IS NOT NULL
  AND r.useful_count IS NOT NULL AND r.cool_count IS NOT NULL AND r.funny_count IS NOT NULL
  AND r.restaurant_rating IS NOT NULL"""
