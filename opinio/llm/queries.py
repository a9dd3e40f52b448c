"""The registered queries of this subpackage and their DuckDB statements.

Each ``opN_*`` query applies its operator with production parameters to its
whole table and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.llm.bpe import bpe
from opinio.llm.common import read
from opinio.llm.cross_tokens import align
from opinio.llm.decontaminate import find_contamination
from opinio.llm.exact_dedup import exact_dedup
from opinio.llm.html_extract import extract_text
from opinio.llm.jaccard_tree import jaccard_components
from opinio.llm.language_id import predict, train
from opinio.llm.merkle import manifest
from opinio.llm.quality import sample_by_importance
from opinio.llm.secrets import RULES, joined, scan_secrets
from opinio.llm.token_files import read_tokens, write_tokens
from opinio.llm.url_rules import judge_urls
from opinio.llm.warc import read_warc, with_revisits, write_warc
from opinio.session import scratch_path


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text and its length."""
    return extract_text(read(spark, sf_dir, "pages"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and decoded bytes."""
    return bpe(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
               public_tokenizers.PATTERN, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: counts and digest of the base kinds, all spans."""
    found = scan_secrets(read(spark, sf_dir, "documents"))
    base = [r.kind for r in RULES if r.base]
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in base]
    counts = [(F.size("spans") - n).cast("long").alias(f"n_{k}") for k, n in zip(base, counts)]
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *counts, F.sha2(joined(own), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


#: (host, path, verdict); a rule holds for the host and all its subdomains.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host and path with the rule that decides its url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(read(spark, sf_dir, "pages"), rules)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item whose passage it holds, also edited."""
    return find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, from the files read back."""
    path = scratch_path(spark, "token_files")
    write_tokens(read(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_tokens(spark, path, outputs=("ids_crc32",))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count and near-duplicate component."""
    return jaccard_components(read(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text."""
    return exact_dedup(read(spark, sf_dir, "documents")).drop("n_chars")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance weight, sampling key, and whether it is kept."""
    return sample_by_importance(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))[2]


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive of pages, read back.

    Responses are judged by their payloads; of revisits only the headers are
    read (both predicates reach the data source).
    """
    page = F.regexp_extract("record_id", "^<urn:page:(-?[0-9]+)>$", 1)
    target = F.regexp_extract("refers_to", "^<urn:page:(-?[0-9]+)>$", 1)
    none = F.lit(None).cast("long")
    responses = read_warc(spark, path).where("record_type = 'response'").select(
        F.nullif(page, F.lit("")).cast("long").alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", none.alias("refers_to"))
    revisits = read_warc(spark, path, payload=False).where("record_type = 'revisit'").select(
        F.nullif(page, F.lit("")).cast("long").alias("page_id"),
        F.col("headers")["x-payload-length"].cast("long").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"), "record_type",
        F.nullif(target, F.lit("")).cast("long").alias("refers_to"))
    return responses.unionByName(revisits)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    path = scratch_path(spark, "warc")
    write_warc(with_revisits(read(spark, sf_dir, "pages")), path)
    return archived_pages(spark, path)


def op11_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, groups and links in two tokenizers, by corpus-wide counts."""
    rows, _ = align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                    public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return rows.withColumn("groups_sha256", digest).drop("groups")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by its text, learned from those not held out."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    languages = train(docs.where(~held_out))
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), languages).drop("text")


ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, subroot, root and proof; the root that its
    (for a fifth of them tampered) row leads to, and whether it is the root."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    text = F.when(tampered, F.translate("text", ASCII_UPPER, ASCII_LOWER)).otherwise(F.col("text"))
    rows = manifest(read(spark, sf_dir, "documents"), claims={"text": text},
                    outputs=("leaf", "subroot", "root", "proof_digest", "folded_root"))
    names = {"proof_digest": "proof_sha256"}
    return rows.select("doc_id", *(F.lower(F.hex(c)).alias(names.get(c, c)) for c in rows.columns[1:]),
                       (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_secrets": op3_secrets,
    "op4_url_rules": op4_url_rules,
    "op5_decontaminate": op5_decontaminate,
    "op6_token_files": op6_token_files,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality": op9_quality,
    "op10_warc": op10_warc,
    "op11_cross_tokens": op11_cross_tokens,
    "op12_language_id": op12_language_id,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {
    "op4_url_rules": r"""
        WITH u AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        k AS (
            SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        c AS (
            SELECT page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
            FROM k),
        j AS (
            SELECT page_id, host, path, CASE
                WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%'
                    THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
            FROM c)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
        FROM j""",
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
            FROM documents),
        k AS (
            SELECT doc_id, sha256(norm) AS text_sha256, count(*) OVER (PARTITION BY norm) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id
            FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k""",
    "op10_warc": r"""
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
        SELECT page_id, n AS payload_bytes, payload_digest,
               CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f""",
    "op13_merkle": r"""
        WITH RECURSIVE base AS (
            SELECT doc_id, source, text,
                   concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
                             coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                             coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
                   xor(list_reduce(
                       list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                                    lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                       lambda c, e: CASE WHEN xor(c, e) & 1 = 1 THEN xor(xor(c, e) >> 1, 3988292384)
                                         ELSE xor(c, e) >> 1 END), 4294967295) % 5 = 0 AS bent
            FROM documents),
        leaves AS (
            SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
                   sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(strlen(text) || ':' || CASE WHEN bent THEN
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-'))
                       AS claim
            FROM base),
        up AS (
            SELECT source, 0 AS lvl, pos AS idx, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM leaves
            UNION ALL
            SELECT source, lvl + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), max((n + 15) // 16)
            FROM up WHERE n > 1 GROUP BY source, lvl, idx // 16),
        subroots AS (
            SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM up WHERE n = 1),
        top AS (
            SELECT 100 AS lvl, pos AS idx, h, count(*) OVER () AS n FROM subroots
            UNION ALL
            SELECT lvl + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), max((n + 15) // 16)
            FROM top WHERE n > 1 GROUP BY lvl, idx // 16),
        runs AS (
            SELECT source, lvl, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM up WHERE n > 1 GROUP BY ALL),
        top_runs AS (SELECT lvl, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM top WHERE n > 1 GROUP BY ALL),
        steps AS (
            SELECT l.doc_id, r.lvl, (l.pos // (16 ** r.lvl)::BIGINT % 16) + 1 AS place, r.hs
            FROM leaves l JOIN runs r ON l.source IS NOT DISTINCT FROM r.source
                 AND l.pos // (16 ** (r.lvl + 1))::BIGINT = r.run
            UNION ALL
            SELECT l.doc_id, r.lvl, (s.pos // (16 ** (r.lvl - 100))::BIGINT % 16) + 1, r.hs
            FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
                 JOIN top_runs r ON s.pos // (16 ** (r.lvl - 99))::BIGINT = r.run),
        path AS (
            SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY lvl) AS step,
                   array_to_string(hs[1:place - 1], '') AS l, array_to_string(hs[place + 1:len(hs)], '') AS r
            FROM steps),
        proofs AS (SELECT doc_id, max(step) AS last, string_agg(l || r, '' ORDER BY step) AS p FROM path GROUP BY doc_id),
        folded AS (
            SELECT doc_id, 0 AS step, claim AS node FROM leaves
            UNION ALL
            SELECT f.doc_id, p.step, sha256(p.l || f.node || p.r)
            FROM folded f JOIN path p ON p.doc_id = f.doc_id AND p.step = f.step + 1)
        SELECT l.doc_id, l.leaf, s.h AS subroot, t.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256,
               f.node AS folded_root, f.node = t.h AS verified
        FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
             JOIN top t ON t.n = 1 LEFT JOIN proofs p USING (doc_id)
             JOIN folded f ON f.doc_id = l.doc_id AND f.step = coalesce(p.last, 0)""",
}
