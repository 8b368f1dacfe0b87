"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import (
    compact_windows,
    exact_dedup,
    hard_negatives,
    licenses,
    mixing,
    near_dedup,
    pieces,
    quality,
    runs,
    spotsigs,
    token_files,
    topk,
    url_rules,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_spotsigs(spark, sf_dir):
    """Fingerprints of all texts and their edited texts."""
    return spotsigs.fingerprints(_table(spark, sf_dir, "documents"))


@_query
def op2_token_files(spark, sf_dir):
    """Ids of all documents in files, read back document by document."""
    files = token_files.write_tokens(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))
    return token_files.read_documents(files)


@_query
def op3_source_mix(spark, sf_dir):
    """All documents mixed to the sources' targets; null, repeated and empty rows as in ``mixing.mixed_words``."""
    return mixing.mixed_words(_table(spark, sf_dir, "documents"))


@_query
def op4_exact_dedup(spark, sf_dir):
    """Groups of texts equal without white space; nulls, ties and repeated rows as in ``exact_dedup.exact_groups``."""
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), digest_all=True)


@_query
def op5_repeated_passages(spark, sf_dir):
    """Passages that documents share, as in ``compact_windows.repeated_passages``."""
    return compact_windows.repeated_passages(_table(spark, sf_dir, "documents"))


@_query
def op6_sentencepiece(spark, sf_dir):
    """Piece ids of every whole text, as in ``pieces.encoded``."""
    return pieces.encoded(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


@_query
def op7_license_scan(spark, sf_dir):
    """Licence notices in all documents, as in ``licenses.found_licenses``."""
    return licenses.found_licenses(_table(spark, sf_dir, "documents"))


@_query
def op8_quality(spark, sf_dir):
    """Score and verdict of every document, as in ``quality.judged``."""
    return quality.judged(_table(spark, sf_dir, "documents"))


@_query
def op9_near_dedup(spark, sf_dir):
    """Classes of near-duplicates over all documents, as in ``near_dedup.near_groups``."""
    return near_dedup.near_groups(_table(spark, sf_dir, "documents")).drop("mark")


@_query
def op10_url_rules(spark, sf_dir):
    """Rule and verdict of every page; null URLs and repeated rows as in ``url_rules.judged``."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judged(pages).select("page_id", "host", "path", "rule", "verdict")


@_query
def op11_periodic_runs(spark, sf_dir):
    """Runs of all texts, every tenth of which repeats a part of itself."""
    return runs.run_digests(runs.find_runs(runs.looped(_table(spark, sf_dir, "documents"))))


@_query
def op12_exact_topk(spark, sf_dir):
    """The 20 best rows of every twentieth vector."""
    return topk.nearest_rows(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@_query
def op13_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector; every seventh has another label."""
    vectors = hard_negatives.relabelled(_table(spark, sf_dir, "embeddings"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


SQL["op4_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""

SQL["op10_url_rules"] = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages), q AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p), r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
    END AS rule
  FROM q)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN contains(url, '://') AND (regexp_matches(lower(url), '(^|[^a-z0-9])utm([^a-z0-9]|$)')
         AND regexp_matches(url, '[?&]utm_[a-z]+=')) THEN 'block'
    WHEN contains(url, '://') AND regexp_matches(url, '[?&]page=[0-9]+(&|#|$)') THEN 'block'
    WHEN contains(url, '://') AND regexp_matches(url, '://m\.') THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""

SQL["op3_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, md5(coalesce(text, '')) AS digest,
         row_number() OVER (PARTITION BY source, doc_id, md5(coalesce(text, ''))) - 1 AS number
  FROM documents), s AS (
  SELECT doc_id, source, digest, number,
         length(regexp_replace(regexp_replace(text, '[^\x20\x09-\x0D]+', 'x', 'g'), '[\x20\x09-\x0D]+', '', 'g')) AS size,
         -ln((('0x' || substr(md5(concat_ws(' ', coalesce(doc_id::VARCHAR, 'null'), digest, number)), 1, 12))::BIGINT::DOUBLE + 0.5)
             / 281474976710656.0)
           / ((length(translate(text, '#$%&*|!~^<>{}[]=+_@', '')) + 1)::DOUBLE / (length(text) + 1)) AS k
  FROM d), t AS (
  SELECT source, sum(size)::BIGINT AS total,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM s GROUP BY source), o AS (
  SELECT *, 2 * total AS cap, (2 * total)::DOUBLE / weight AS full_at,
         sum(total) OVER () AS everything, sum(weight) OVER () AS weights
  FROM t), l AS (
  SELECT *, (1.5 * everything::DOUBLE - coalesce(sum(cap) OVER w, 0)::DOUBLE)
            / (weights - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM o WINDOW w AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), g AS (
  SELECT *, first_value(level) OVER (ORDER BY CASE WHEN level < full_at THEN 0 ELSE 1 END, full_at, source NULLS LAST) AS lv,
         max(level < full_at) OVER () AS has_open
  FROM l), a AS (
  SELECT source, total, CASE WHEN has_open THEN least(cap::DOUBLE, weight * lv) ELSE cap::DOUBLE END AS target FROM g), e AS (
  SELECT *, CASE WHEN total > 0 THEN floor(target / total)::BIGINT ELSE 0 END AS epochs FROM a), x AS (
  SELECT s.doc_id, s.size, e.total, e.target, e.epochs, e.target - e.epochs * e.total AS rest,
         (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id NULLS FIRST, s.digest, s.number
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE - s.size / 2.0 AS middle
  FROM s JOIN e ON s.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, total AS source_size, target,
       (size * (epochs + CASE WHEN middle <= rest AND target > epochs * total THEN 1 ELSE 0 END))::BIGINT AS taken
FROM x
"""

#: Vectors that take part, as whole numbers; {scale} stands for the factor.
_VECTORS = """v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = len(embedding))"""

SQL["op12_exact_topk"] = f"""
WITH {_VECTORS.format(scale=64)}, p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score
FROM p
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST)
QUALIFY row_number() OVER w <= 20
"""

SQL["op13_hard_negatives"] = f"""
WITH {_VECTORS.format(scale=256)}, l AS (
  SELECT vec_id, e, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM v WHERE label IS NOT NULL), p AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM l a JOIN l c ON a.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM a.vec_id), t AS (
  SELECT * FROM p WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id NULLS LAST) <= 5), n AS (
  SELECT t.anchor_id, t.vec_id AS positive_id, p.vec_id AS negative_id, t.score AS positive_score, p.score AS negative_score,
         row_number() OVER (PARTITION BY t.anchor_id, t.vec_id ORDER BY p.score DESC, p.vec_id NULLS LAST) AS rank
  FROM t JOIN p ON t.anchor_id = p.anchor_id AND NOT p.alike
       AND 30 * t.score <= 100 * p.score AND 100 * p.score <= 90 * t.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
