"""A query for each operator, with its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tempolane.llm import hashforest, licenses, linededup, mixing, ngramjoin, passages, phrases, quality, sentencepieces, tokenfiles, turnrepair, urlrules, warc
from tempolane.sources.shared import new_path, send_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return sentencepieces.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    manifest = warc.write_warc(_table(spark, sf_dir, "pages"), folder)
    found = warc.read_warc(spark, folder, manifest)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "tokens")
    manifest = tokenfiles.write_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return tokenfiles.read_tokens(spark, folder, manifest).withColumnRenamed("key", "doc_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.learn(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).drop("text")


def op6_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashforest.nearest(_table(spark, sf_dir, "embeddings"), "id % 100 = 0")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.link(_table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).drop("blocks")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urlrules.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op11_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = passages.learn(docs, _table(spark, sf_dir, "labels"))
    return passages.score(docs, model).drop("text")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turnrepair.digests(turnrepair.repair(turnrepair.damage(_table(spark, sf_dir, "conversations"))))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_warc, op3_token_files, op4_mixing, op5_quality, op6_hash_forest, op7_line_dedup,
        op8_ngram_join, op9_url_rules, op10_licenses, op11_quality_attention, op12_collocations, op13_turn_repair,
    )
}

_TEXT = "coalesce(text, '')"
_ROOT = """split_part(split_part(split_part(substr(url, strpos(url, '://') + 3), '/', 1), '?', 1), '#', 1)"""


def _patterns_sql(url: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({url}, '{p}') THEN '{v}'" for p, _, v in urlrules.PATTERN_RULES)
    return f"CASE {whens} ELSE 'allow' END"


def _rules_sql() -> str:
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urlrules.BASE_RULES)
    return f"(VALUES {rows}) AS r(h, p, v)"


_URL_SQL = f"""WITH parts AS (SELECT page_id, url,
  CASE WHEN strpos(url, '://') > 0 THEN lower({_ROOT}) ELSE '' END AS host,
  CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
hits AS (SELECT page_id, h || p AS rule, v,
  row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS nth
  FROM parts JOIN {_rules_sql()} ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT parts.page_id, host, path, rule, coalesce(v, {_patterns_sql("lower(coalesce(url, ''))")}) AS verdict
FROM parts LEFT JOIN hits ON parts.page_id = hits.page_id AND nth = 1"""

_WARC_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
  max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND last > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND last > page_id THEN last END AS refers_to FROM d"""

_NGRAM_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id,
  regexp_extract_all(translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
walk AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT walk.a, links.b FROM walk JOIN links ON walk.b = links.a)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, m.component_id FROM s
JOIN (SELECT a, min(b) AS component_id FROM walk GROUP BY a) m ON s.doc_id = m.a"""

_LOW = f"translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PHRASES_SQL = f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
  unnest(regexp_split_to_array({_LOW}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, g, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
    FROM w JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS k) ON len(w) >= k)
  GROUP BY lang, k, g HAVING count(*) >= 100),
cuts AS (SELECT c.lang, c.g, c.f AS a, l.f AS l, r.f AS r, s.n, x.cut,
    CAST(1000::HUGEINT * c.f * s.n // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM c JOIN (SELECT unnest([1, 2, 3, 4]) AS cut) x ON x.cut < c.k
  JOIN c l ON l.lang = c.lang AND l.g = c.g[1:x.cut] JOIN c r ON r.lang = c.lang AND r.g = c.g[x.cut + 1:]
  JOIN sizes s ON s.lang = c.lang),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
parts AS (SELECT lang, f, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: g[i:i + m - 1])))) AS g
  FROM c WHERE k > 2),
held AS (SELECT lang, g, max(f) AS f FROM parts GROUP BY lang, g)
SELECT worst.lang, row_number() OVER (PARTITION BY worst.lang ORDER BY score DESC, a DESC, array_to_string(worst.g, ' ')) AS rank,
  array_to_string(worst.g, ' ') AS phrase, a, l, r, n, score
FROM worst LEFT JOIN held ON held.lang = worst.lang AND held.g = worst.g WHERE held.f IS NULL OR 100 * held.f < 100 * a
QUALIFY rank <= 2000"""

ORACLES = {"op12_collocations": _PHRASES_SQL, "op2_warc": _WARC_SQL, "op8_ngram_join": _NGRAM_SQL, "op9_url_rules": _URL_SQL}
