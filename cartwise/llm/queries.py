"""The thin queries over the given tables, one per operator, and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cartwise.llm import (bpe, decontaminate, divergence, hpyp, kneser_ney, license_scan, multiset_hash, separators, simhash,
                          source_audit, spelling_variants, surrogates, url_filter)
from cartwise.llm.common import table
from cartwise.llm.settings import END_OF_TEXT, SURROGATE_KEY, tokenizer_path


def op1_hpyp(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return hpyp.score(docs, held_out=held_out)


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return kneser_ney.classify(docs, table(spark, sf_dir, "labels"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.digest(docs, bpe.Bpe.from_json(tokenizer_path()))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash.cluster(docs, width=4, max_distance=4)


def op5_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return divergence.judge(docs).drop("lang")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.report(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), size=10)


def op7_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return separators.document_tokens(docs, bpe.Bpe.from_json(tokenizer_path()), END_OF_TEXT)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return surrogates.pseudonymise(docs, SURROGATE_KEY, count="n_entities")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return url_filter.judge(pages, url_filter.CONTRACT_RULES).drop("url")


def op11_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.edits(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents", "text", "lang", "source"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hpyp": op1_hpyp,
    "op2_kneser_ney": op2_kneser_ney,
    "op3_bpe": op3_bpe,
    "op4_simhash": op4_simhash,
    "op5_divergence": op5_divergence,
    "op6_decontaminate": op6_decontaminate,
    "op7_separator_scan": op7_separator_scan,
    "op8_license_scan": op8_license_scan,
    "op9_surrogates": op9_surrogates,
    "op10_url_filter": op10_url_filter,
    "op11_multiset_hash": op11_multiset_hash,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_source_audit": op13_source_audit,
    "pipeline": pipeline,
}

_OP10 = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url FROM pages
), p AS (
  SELECT page_id, url,
    translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM u
), rules(h, pre, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
  SELECT page_id, url, arg_max(h || pre, length(h || pre)) AS rule, arg_max(verdict, length(h || pre)) AS verdict
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre)
  GROUP BY page_id, url
)
SELECT p.page_id, p.host, p.path, best.rule, coalesce(best.verdict, CASE WHEN regexp_matches(
    translate(p.url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '://([^/?#]*[.-])?(spam|pills|casino|(free|cheap)-?porn)([.-][^/?#]*)?([/?#]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best USING (page_id, url)
"""

_OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents
), terms AS (
  SELECT id, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM terms GROUP BY ALL HAVING count(DISTINCT id) >= 3
), held AS (
  SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT lang, sum(n) + count(*) AS size FROM kept GROUP BY ALL
), groups AS (
  SELECT g.lang, g.source, coalesce(n, 0) + coalesce(v, 0) AS size
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY ALL) USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM held GROUP BY ALL) USING (lang, source)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 1)) // g.size::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // l.size::HUGEINT AS whole
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - whole) * (p - whole) // whole)::BIGINT FROM p WHERE n > 0 AND p > whole
)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 200
"""

ORACLES: dict[str, str] = {"op10_url_filter": _OP10, "op13_source_audit": _OP13}
