"""The operators on the given tables, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm import (
    byte_bpe,
    embedding_dedup,
    hard_negatives,
    html_extract,
    language_id,
    mixing,
    quality,
    secrets_scan,
    sharding,
    simhash,
    suffix_dedup,
    token_alignment,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_suffix_dedup(spark, sf_dir):
    """Bytes of every document that repeat a string of 100 bytes from earlier on, removed."""
    found = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op2_embedding_rotations(spark, sf_dir):
    """Vectors linked at a cosine of 0.9 or more, and their components."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op3_repetition_rules(spark, sf_dir):
    """Quality measures and verdicts of every document."""
    return quality.rules(table(spark, sf_dir, "documents"))


@query
def op4_html_blocks(spark, sf_dir):
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


@query
def op5_secret_cnn(spark, sf_dir):
    """Secrets in every document: rules, and the network's additions."""
    docs = table(spark, sf_dir, "documents")
    found = secrets_scan.scan(docs, secrets_scan.train(docs))
    of = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("findings", lambda x: x["kind"] != "learned")
    return found.select(
        "doc_id",
        *[of(kind) for kind in secrets_scan.KINDS],
        F.sha2(secrets_scan.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets_scan.listed(F.col("findings")).alias("spans"),
    )


@query
def op6_source_mix(spark, sf_dir):
    """Mix all documents to source weights 1, 2, 3, repeating; three epochs at most."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "repetitions")


ORACLE["op6_source_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY source NULLS LAST) AS n,
             1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM s),
r AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0) AS rest_size,
             sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS rest_w, row_number() OVER (ORDER BY cap / w, n) AS k
      FROM w WINDOW o AS (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(rest_size, k) AS rest_size, arg_min(rest_w, k) AS rest_w, min(k) AS k
      FROM r WHERE rest_size * w <= cap * rest_w),
t AS (SELECT r.source, r.source_size,
             CASE WHEN l.k IS NULL OR r.k < l.k THEN r.cap::DOUBLE
                  ELSE (l.rest_size * r.w)::DOUBLE / l.rest_w::DOUBLE END AS target
      FROM r, l),
p AS (SELECT d.doc_id, d.size, t.*,
             CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
             coalesce(sum(d.size) OVER (PARTITION BY t.source ORDER BY digest, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, repetitions * size AS taken, source, repetitions
FROM (SELECT *, whole + CASE WHEN target - whole * source_size > 0
                              AND before + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END AS repetitions
      FROM p)
"""


@query
def op7_extendible_shards(spark, sf_dir):
    """Shards of at most 32 MiB of text over all documents."""
    return sharding.shard(table(spark, sf_dir, "documents"))


ORACLE["op7_extendible_shards"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
         substr(md5('5:' || coalesce(doc_id::VARCHAR, '')), 1, 6) AS h FROM documents),
b AS (SELECT doc_id, n_bytes, lpad(format('{:b}', ('0x' || h)::BIGINT), 24, '0') AS bits FROM d),
s AS (SELECT n, substr(bits, 1, n::BIGINT) AS prefix, sum(n_bytes) AS total FROM b, range(0, 25) AS g(n) GROUP BY ALL),
f AS (SELECT b.doc_id, b.n_bytes, b.bits, min(s.n) AS n FROM b JOIN s ON s.prefix = substr(b.bits, 1, s.n::BIGINT)
      WHERE s.total <= 33554432 GROUP BY ALL)
SELECT doc_id, n_bytes, substr(bits, 1, n::BIGINT) AS shard, n::INTEGER AS depth FROM f
"""


@query
def op10_simhash_anchors(spark, sf_dir):
    """SimHash fingerprints of all documents, linked at 3 differing bits or fewer."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "kept")


@query
def op8_language_id(spark, sf_dir):
    """Language of every document, learned from the labelled three quarters."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


@query
def op9_byte_bpe(spark, sf_dir):
    """Token ids of every document, and their decoding, as digests."""
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.encode(docs, path, public_tokenizers.PATTERN, decode=True)
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return coded.select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op11_str_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector's five positives, searched in all vectors."""
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    )
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


ORACLE["op11_str_negatives"] = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 10
"""

#: The five rules that fix the verdicts of op12; where none fits, the method's own globs decide.
URL_RULES = [
    url_filter.Rule("allow", "com"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


@query
def op12_url_automaton(spark, sf_dir):
    """Verdict of every page's URL by five rules and the default globs."""
    found = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "glob")


def _glob_pattern(glob: str) -> str:
    """A glob as a regular expression of the SQL."""
    return "".join({"**": "(?s:.*)", "*": "[^/]*"}.get(p) or re.escape(p) for p in re.split(r"(\*\*|\*)", glob)).replace("'", "''")


ORACLE["op12_url_automaton"] = rf"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(action, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                                 ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f AS (
  SELECT u.page_id, u.host, u.path, r.host || r.path AS rule, r.action FROM u LEFT JOIN r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) = 1),
g AS (
  SELECT *, CASE WHEN rule IS NOT NULL OR host = '' THEN NULL
    {' '.join(f"WHEN regexp_full_match(host || path, '{_glob_pattern(x.pattern)}') THEN '{x.pattern}'" for x in url_filter.DEFAULT_GLOBS)} END AS "glob"
  FROM f)
SELECT page_id, host, path, rule, "glob",
       CASE WHEN rule IS NOT NULL THEN action WHEN host = '' OR "glob" IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM g
"""


@query
def op13_token_alignment(spark, sf_dir):
    """Byte-level BPE and sentence-piece tokens of every document, cut into groups, with corpus counts of linked ids."""
    files = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = token_alignment.align(table(spark, sf_dir, "documents"), *files, public_tokenizers.PATTERN)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("").alias("groups_sha256")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)
