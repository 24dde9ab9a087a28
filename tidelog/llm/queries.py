"""The registered queries of this subpackage and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.classifier import fit
from tidelog.llm.common import table
from tidelog.llm.fingerprints import fingerprint
from tidelog.llm.hard_negatives import hard_negatives
from tidelog.llm.jaccard import jaccard_components
from tidelog.llm.mixing import mix
from tidelog.llm.packing import pack
from tidelog.llm.quality_rules import LINE_MOST, judge
from tidelog.llm.sharding import shard
from tidelog.llm.substring_dedup import drop_repeats
from tidelog.llm.token_matrix import pack_matrix, read_matrix, write_matrix
from tidelog.llm.url_filters import RULES, filter_urls
from tidelog.llm.warc import archived
from tidelog.llm.whitening import whiten
from tidelog.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


# --- 2: URL filters ---------------------------------------------------------

_HOST_PATH = r"""
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages)"""


def _url_sql() -> str:
    def fits(text: str) -> str:
        host, _, path = text.partition("/")
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"

    ordered = sorted(RULES, key=lambda r: -len(r.text))
    rule = " ".join(f"WHEN {fits(r.text)} THEN '{r.text}'" for r in ordered)
    verdict = " ".join(f"WHEN {fits(r.text)} THEN '{r.verdict}'" for r in ordered)
    return (
        f"SELECT page_id, host, path, CASE {rule} ELSE NULL END AS rule,"
        f" CASE {verdict} ELSE 'allow' END AS verdict FROM ({_HOST_PATH})"
    )


@query("op2_url_filters", _url_sql())
def op2_url_filters(spark, sf_dir):
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


# --- 3: mixing --------------------------------------------------------------

_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, text,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('17:' || coalesce(CAST(doc_id AS VARCHAR), ':' || md5(coalesce(text, '')))) AS seeded
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source),
-- weight times the level of the free sources, found by trying every set of held sources in order of bound over weight
ranked AS (
  SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST) AS k FROM totals),
levels AS (
  SELECT a.k, any_value(2.0 * a.source_size) AS bound, any_value(a.w) AS w,
    (1.5 * (SELECT CAST(sum(source_size) AS DOUBLE) FROM totals)
      - coalesce(sum(2.0 * b.source_size) FILTER (b.k < a.k), 0))
    / (sum(b.w) FILTER (b.k >= a.k)) AS level
  FROM ranked a, ranked b GROUP BY a.k),
target AS (
  SELECT source, source_size,
    coalesce(least(2.0 * source_size, w * (SELECT max(level) FROM levels WHERE bound > w * level)),
             2.0 * source_size) AS target
  FROM ranked),
quota AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs
  FROM target),
placed AS (
  SELECT doc_id, size, source_size, target, epochs,
    CAST(round(target) AS BIGINT) - epochs * source_size
      - coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY seeded, doc_id, size
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
  FROM sized JOIN quota q ON sized.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, rest)) AS BIGINT) AS taken
FROM placed"""


@query("op3_mixing", _MIX)
def op3_mixing(spark, sf_dir):
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


# --- 6: quality rules -------------------------------------------------------

_RULES = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
grams AS (
  SELECT r, g.i AS i, words[g.i] || ' ' || words[g.i + 1] || ' ' || words[g.i + 2] AS gram
  FROM w, LATERAL (SELECT unnest(range(1, len(words) - 1)) AS i) g),
often AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM grams),
covered AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM often WHERE c > 1) GROUP BY r),
raw_lines AS (SELECT r, source, text, unnest(string_split(text, chr(10))) AS line FROM t),
lines AS (
  SELECT r, source, text, line, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS plain
  FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM t GROUP BY source),
freq AS (SELECT source, plain, count(DISTINCT text) AS docs FROM lines GROUP BY source, plain),
gone AS (
  SELECT f.source, f.plain FROM freq f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source
  WHERE (f.docs > 10 AND f.docs > 0.05::DOUBLE * h.docs) OR f.docs > 100),
lost AS (
  SELECT l.r, sum(len(string_split(l.plain, ' '))) AS n
  FROM lines l JOIN gone g ON l.source IS NOT DISTINCT FROM g.source AND l.plain = g.plain GROUP BY l.r),
base AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    len(words) - coalesce(lost.n, 0) AS left_words
  FROM w LEFT JOIN dup USING (r) LEFT JOIN covered USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND left_words >= 0.3::DOUBLE * n_words AS kept
FROM base"""


@query("op6_quality_rules", _RULES)
def op6_quality_rules(spark, sf_dir):
    judged = judge(table(spark, sf_dir, "documents"), line_most=LINE_MOST)
    return judged.select(
        "doc_id",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        *("base_failed", "kept"),
    )


# --- 4: sharding ------------------------------------------------------------


@query("op4_sharding")
def op4_sharding(spark, sf_dir):
    """Differencing has no SQL; tests compare it with a direct one, step by step."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the digest is taken first, so that no text follows its row
    placed = shard(docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")))))
    return placed.select(
        *("doc_id", "size", "text_crc32"),
        F.lit("bytes").alias("law"),
        *("shard", "slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


# --- 5: fingerprints --------------------------------------------------------


@query("op5_fingerprints")
def op5_fingerprints(spark, sf_dir):
    """The hash is not one of DuckDB's; tests compare it with a direct one."""
    return fingerprint(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


# --- 8: WARC ----------------------------------------------------------------

_WARC = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT payload_digest, min(page_id) AS least FROM p GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 100 OR page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes < 100 OR page_id = least THEN NULL ELSE least END AS refers_to
FROM p JOIN f USING (payload_digest)"""


@query("op8_warc", _WARC)
def op8_warc(spark, sf_dir):
    records = archived(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return records.select(
        F.expr("try_cast(split_part(record_id, ':', 1) AS BIGINT)").alias("page_id"),
        *("payload_bytes", "payload_digest", "record_type"),
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


# --- 1: packing -------------------------------------------------------------


@query("op1_packing")
def op1_packing(spark, sf_dir):
    """Tokenizer and retrieval have no SQL; tests compare with direct ones."""
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        *("doc_id", "start", "length"),
        F.crc32("ids").alias("ids_crc32"),
        *("doc_tokens", "sequence_id", "offset"),
    )


# --- 9: quality classifier --------------------------------------------------


@query("op9_quality_classifier")
def op9_quality_classifier(spark, sf_dir):
    """Counts and draws have no SQL; tests count and draw in plain Python."""
    fitted = fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return fitted.weights.withColumnRenamed("id", "doc_id")


# --- 10: n-gram Jaccard join ------------------------------------------------


@query("op10_ngram_jaccard")
def op10_ngram_jaccard(spark, sf_dir):
    """All pairs in SQL take too long on whole tables; tests try them all."""
    return jaccard_components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


# --- 7: token matrices ------------------------------------------------------


@query("op7_token_matrix")
def op7_token_matrix(spark, sf_dir):
    """Written to the shared folder and read back; tests compare every id."""
    path = scratch_folder(spark, "matrix")
    write_matrix(pack_matrix(table(spark, sf_dir, "documents")), path)
    return read_matrix(spark, path).select(
        *("sequence_id", "doc_ids", "starts", "lengths_before", "used"),
        F.crc32("ids").alias("ids_crc32"),
        F.crc32("positions").alias("positions_crc32"),
    )


# --- 11: hard negatives -----------------------------------------------------

_NEGATIVES = """
WITH e AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score
  FROM e a JOIN e r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""


@query("op11_hard_negatives", _NEGATIVES)
def op11_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


# --- 12: embedding whitening ------------------------------------------------


@query("op12_whitening")
def op12_whitening(spark, sf_dir):
    """Components have no SQL; tests compare them with the eigenvectors of the covariance."""
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).withColumnRenamed("id", "vec_id")


# --- 13: substring dedup ----------------------------------------------------

_REPEATS = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
w AS (
  SELECT r, doc_id, g.i AS i, md5(array_to_string(words[g.i : g.i + 12], ' ')) AS gram
  FROM t, LATERAL (SELECT unnest(range(1, len(words) - 11)) AS i) g),
least AS (SELECT gram, min(doc_id) AS least FROM w GROUP BY gram),
gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 13)) AS j FROM w JOIN least USING (gram) WHERE least < doc_id),
each AS (
  SELECT r, doc_id, j, words[j] AS word FROM t, LATERAL (SELECT unnest(range(1, len(words) + 1)) AS j) g),
kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept FROM each ANTI JOIN gone USING (r, j) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (r)"""


@query("op13_substring_dedup", _REPEATS)
def op13_substring_dedup(spark, sf_dir):
    kept = drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
