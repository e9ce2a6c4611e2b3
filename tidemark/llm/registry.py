"""The operators' queries over the test tables, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, exact_dedup, importance, kd_shards, language_id, line_dedup, mixing, nn_descent, packing, pii, simhash,
               spelling, sql, url_filter)
from .common import table, tokenizer_path


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, sf_dir, "documents")))


def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shard(table(spark, sf_dir, "documents"))


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).select(
        "page_id", "host", "path", "rule", "verdict")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language_id.remainder("doc_id") == 1, F.lit(False))
    return language_id.predict(docs, language_id.learn(docs)).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.decide(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.by_position(mixing.schedule(table(spark, sf_dir, "documents"))).select(
        "doc_id", "size", "source_size", "target", "taken", "position")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_pii": op2_pii,
    "op3_kd_shards": op3_kd_shards,
    "op4_nn_descent": op4_nn_descent,
    "op5_line_dedup": op5_line_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_bpe": op8_bpe,
    "op9_language_id": op9_language_id,
    "op10_simhash": op10_simhash,
    "op11_spelling": op11_spelling,
    "op12_mixing": op12_mixing,
    "op13_importance": op13_importance,
}

_SHRINK = """
{name}_j AS (SELECT l.*, (a.alpha - l.bad) / (a.alpha + a.beta - l.n) AS m FROM {level} l JOIN {above}_p a ON l.{key} = a.{key}),
{name}_r AS (SELECT SUM(n * (bad / n - m) ** 2 - m * (1 - m)) / NULLIF(SUM((n - 1) * (m * (1 - m))), 0) AS rho FROM {name}_j),
{name}_s AS (SELECT CASE WHEN rho > 0 THEN LEAST({hi}, GREATEST({lo}, 1 / rho - 1)) ELSE {hi} END AS s FROM {name}_r),
{name}_p AS (SELECT {by}, m * s + bad AS alpha, (1 - m) * s + n - bad AS beta FROM {name}_j, {name}_s)"""


def _shrink_sql(name, level, above, key, by):
    return _SHRINK.format(name=name, level=level, above=above, key=key, by=by,
                          lo=url_filter.MIN_STRENGTH, hi=url_filter.MAX_STRENGTH)


def _rule_sql(result):
    whens = []
    for kind, h, p in sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2])):
        value = h + p if result == "rule" else kind
        whens.append(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value}'")
    return "CASE " + " ".join(whens) + " ELSE NULL END"


_OP6 = rf"""
WITH base AS (
  SELECT page_id,
    COALESCE(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    COALESCE(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
outcome AS (SELECT doc_id, MAX(CASE WHEN quality = 0 OR toxic = 1 THEN 1.0::DOUBLE ELSE 0 END) AS bad FROM labels
  WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
names AS (SELECT DISTINCT host, CASE WHEN regexp_matches(host, '\.(ac|co|com|edu|gov|net|org)\.[a-z]{{2}}$')
    THEN array_to_string(list_slice(string_split(host, '.'), -3, -1), '.')
    ELSE array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') END AS domain FROM base),
keys AS (SELECT host, domain, CASE WHEN contains(domain, '.') THEN regexp_replace(domain, '^[^.]*\.', '') ELSE domain END AS suffix,
  'all' AS world FROM names),
hosts AS (SELECT k.host, k.domain, k.suffix, k.world, COUNT(*)::DOUBLE AS n, SUM(bad) AS bad
  FROM base JOIN outcome ON page_id = doc_id JOIN keys k ON k.host = base.host GROUP BY ALL),
domains AS (SELECT domain, suffix, SUM(n) AS n, SUM(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, 'all' AS world, SUM(n) AS n, SUM(bad) AS bad FROM domains GROUP BY ALL),
w_p AS (SELECT 'all' AS world, {url_filter.PRIOR_OUTCOMES / 2} + COALESCE(SUM(bad), 0) AS alpha,
  {url_filter.PRIOR_OUTCOMES / 2} + COALESCE(SUM(n), 0) - COALESCE(SUM(bad), 0) AS beta FROM suffixes),
{_shrink_sql("s", "suffixes", "w", "world", "suffix")},
{_shrink_sql("d", "domains", "s", "suffix", "domain")},
{_shrink_sql("h", "hosts", "d", "domain", "host")},
best AS (SELECT k.host, COALESCE(h_p.alpha, d_p.alpha, s_p.alpha, w_p.alpha) AS alpha,
  COALESCE(h_p.beta, d_p.beta, s_p.beta, w_p.beta) AS beta
  FROM keys k LEFT JOIN h_p ON h_p.host = k.host LEFT JOIN d_p ON d_p.domain = k.domain
  LEFT JOIN s_p ON s_p.suffix = k.suffix LEFT JOIN w_p ON w_p.world = k.world),
bounds AS (SELECT host, alpha / (alpha + beta) - {url_filter.BOUND_SDS}
  * sqrt(alpha / (alpha + beta) * (1 - alpha / (alpha + beta)) / (alpha + beta + 1)) AS bound FROM best)
SELECT page_id, base.host, path, {_rule_sql("rule").replace("host", "base.host")} AS rule,
  COALESCE({_rule_sql("verdict").replace("host", "base.host")},
           CASE WHEN bound > {url_filter.MAX_BAD_RATE} THEN 'block' ELSE 'allow' END) AS verdict
FROM base JOIN bounds ON bounds.host = base.host
"""

ORACLE_SQL = {
    **sql.ORACLE_SQL,
    "op6_url_filter": _OP6,
    "op7_exact_dedup": """
SELECT doc_id, MAX(doc_id) OVER g AS keep_id, COUNT(*) OVER g AS group_size,
  doc_id = MAX(doc_id) OVER g AS kept, sha256(COALESCE(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY COALESCE(text, ''))""",
}
