"""The operators' queries over the testdata tables: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import conversation_repair, decontaminate, language_model, ngram_join, packing, piece_encoding, quality, sanitise, secret_scan, token_files, url_filter, vector_join, whitening
from tillroll.llm.common import read_table

#: File names in the folder of public tokenizers.
WORD_TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"


#: (verdict, host/path) of the url filter.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, dictionary = token_files.write_files(read_table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER), end_id=1)
    return token_files.read_files(files, dictionary).drop("ids")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), end_id=0).drop("ids")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op2_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.join(read_table(spark, sf_dir, "embeddings"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(read_table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read_table(spark, sf_dir, "documents"))


def op10_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.report(read_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encoding.report(read_table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(read_table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_vector_join": op2_vector_join,
    "op3_lm_scores": op3_lm_scores,
    "op4_quality": op4_quality,
    "op5_ngram_join": op5_ngram_join,
    "op6_token_files": op6_token_files,
    "op7_decontamination": op7_decontamination,
    "op8_secret_scan": op8_secret_scan,
    "op9_packing": op9_packing,
    "op10_sanitise": op10_sanitise,
    "op11_piece_encoding": op11_piece_encoding,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_whitening": op13_whitening,
}

#: The url filter as SQL: classes by recursion over links with absolute or root-relative targets.
SQL: dict[str, str] = {"op1_url_filter": r"""
WITH RECURSIVE urls AS (
    SELECT DISTINCT url FROM pages WHERE contains(url, '://')
), tags AS (
    SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\s[^>]*>')) AS tag FROM pages WHERE contains(url, '://')
), targets AS (
    SELECT url, CASE WHEN regexp_matches(tag, '(?i)^<link') THEN regexp_extract(tag, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
                     ELSE regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1) END AS target
    FROM tags WHERE regexp_matches(tag, '(?i)rel\s*=\s*["'']?canonical\b') OR regexp_matches(tag, '(?i)http-equiv\s*=\s*["'']?refresh\b')
), links AS (
    SELECT url, CASE WHEN contains(target, '://') THEN target
                     ELSE regexp_extract(url, '^[^:]*://[^/?#]*') || target END AS target FROM targets WHERE target <> ''
), parts AS (
    SELECT url, translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query
    FROM (SELECT url FROM urls UNION SELECT target FROM links)
), judged AS (
    SELECT url, host, path,
        regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') || chr(10)
        || regexp_replace(regexp_replace(path, '(/index)?\.html?$', ''), '/+$', '') || chr(10)
        || regexp_replace(regexp_replace(query, '(^|&)(utm_[a-z]*|ref|fbclid|gclid|sessionid)=[^&]*', '', 'g'), '^&+', '') AS node,
        CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
             WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
             WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
             WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
             WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
    FROM parts
), edges AS (
    SELECT a.node AS x, b.node AS y FROM links JOIN judged a ON a.url = links.url JOIN judged b ON b.url = links.target
), reach(x, y) AS (
    SELECT node, node FROM judged UNION
    SELECT r.x, e.y FROM reach r JOIN (SELECT x, y FROM edges UNION SELECT y, x FROM edges) e ON r.y = e.x
), classes AS (
    SELECT r.x AS node, bool_or(j.rule IN ('org/', 'com/fr/')) AS allowed, bool_or(j.rule NOT IN ('org/', 'com/fr/')) AS blocked
    FROM reach r JOIN judged j ON j.node = r.y GROUP BY r.x
)
SELECT p.page_id, coalesce(j.host, '') AS host, coalesce(j.path, '') AS path, j.rule,
    CASE WHEN j.rule IN ('org/', 'com/fr/') THEN 'allow' WHEN j.rule IS NOT NULL THEN 'block'
         WHEN c.blocked AND NOT coalesce(c.allowed, FALSE) THEN 'block' ELSE 'allow' END AS verdict
FROM pages p LEFT JOIN judged j ON j.url = p.url LEFT JOIN classes c ON c.node = j.node
"""}
