"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logsift.llm import (bpe, decontam, dedup, hard_negatives, langid, pii, secrets, simhash, spelling, token_counts, toxicity,
                         url_filter, warc)
from logsift.llm.common import table

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


def tokenizer_file(name: str) -> bytes:
    """Content of a public tokenizer's file (at most a few MB)."""
    import public_tokenizers
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256, n_chars
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)
"""


@query("op2_exact_dedup", OP2_SQL)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), words=3, max_bits=3)


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), limit=4096)


@query("op6_bpe_encode_decode")
def op6_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json").decode())


@query("op8_warc")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.training_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.score_texts(docs, model, threshold=0.3)


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(langid.training_sample(docs)))


@query("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_personal_data")
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.fit(pii.training_sample(docs)))


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), drop_every=199, min_chars=6, min_count=5, ratio=5)


OP12_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor, other, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other)::INTEGER AS rank,
       s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5
"""


@query("op12_hard_negatives", OP12_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, anchor_every=100, positives=5, negatives=5, num=80, den=100, scale=256)


# The rules of the contract (host, path, verdict).
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op13_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    edge = {"^": "(?:^|[^A-Za-z0-9]|$)", "*": ".*"}
    patterns = ", ".join(f"('{p}', '{v}', '(?s){''.join(edge.get(c, c) for c in p)}')" for v, p in url_filter.PATTERNS)
    return f"""
WITH u AS (SELECT row_number() OVER () AS rid, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
t AS (SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rule_host, rule_path, verdict) AS (VALUES {rules}),
patterns(pattern, verdict, regex) AS (VALUES {patterns}),
r AS (SELECT rid, rule_host || rule_path AS rule, verdict FROM t JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rule_host || rule_path) DESC) = 1),
p AS (SELECT rid, pattern, verdict FROM t JOIN patterns ON regexp_matches(host || path, regex)
      QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(pattern) DESC, verdict DESC, pattern DESC) = 1)
SELECT page_id, host, path, rule, coalesce(r.verdict, p.verdict, 'allow') AS verdict, CASE WHEN rule IS NULL THEN pattern END AS pattern
FROM t LEFT JOIN r USING (rid) LEFT JOIN p USING (rid)
"""


@query("op13_url_filter", op13_sql())
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    patterns = spark.createDataFrame(list(url_filter.PATTERNS), "verdict string, pattern string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules, patterns)
