"""The operators of this subpackage as registered queries, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from thalweg.llm.license import oracle_sql as license_sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    from thalweg.llm.urlcascade import Rule, verdicts

    return verdicts(table(spark, sf_dir, "pages"), [Rule(*r) for r in URL_RULES])


#: (host, path, verdict)
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def _op1_sql() -> str:
    fits = " UNION ALL ".join(
        f"SELECT page_id, {len(h + p)} AS size, '{h + p}' AS rule, '{v}' AS verdict FROM parts WHERE (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, v in URL_RULES
    )
    return f"""
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS ({fits}),
best AS (SELECT page_id, arg_max(rule, size) AS rule, arg_max(verdict, size) AS verdict FROM fits GROUP BY 1)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict FROM parts p LEFT JOIN best b USING (page_id)
"""


def op2_improbable_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from thalweg.llm.digest import fingerprint_neighbours

    return fingerprint_neighbours(table(spark, sf_dir, "documents"))


def op3_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    from thalweg.llm.warc import archive_pages

    return archive_pages(table(spark, sf_dir, "pages"))


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, min(page_id) OVER (PARTITION BY hex) AS first_id,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM d
"""


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from thalweg.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


#: A-Z to a-z and nothing else, in DuckDB.
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
sh AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared_n, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n GROUP BY 1, 2),
links AS MATERIALIZED (SELECT x, y FROM pairs WHERE 100 * shared_n >= 85 * (nx + ny - shared_n)),
both_ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT x, y FROM both_ways UNION SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON r.other = b.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(r.low, s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(r.low, s.doc_id)) AS kept
FROM sets s LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY 1) r ON s.doc_id = r.doc_id
"""

def op6_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    from thalweg.llm.telephony import text_media_features

    return text_media_features(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str) -> str:
    """A public vocabulary file; its folder can be set by THALWEG_TOKENIZERS."""
    import os

    folder = os.environ.get("THALWEG_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from thalweg.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op8_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    from thalweg.llm.quality import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_toxic_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from thalweg.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from thalweg.llm.license import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_piece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from thalweg.llm.pieces import encode_texts

    return encode_texts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_cascade": op1_url_cascade,
    "op2_improbable_digest": op2_improbable_digest,
    "op3_warc_members": op3_warc_members,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_license_scan": op5_license_scan,
    "op6_telephony": op6_telephony,
    "op7_piece_scan": op7_piece_scan,
    "op8_co_training": op8_co_training,
    "op9_mixture_packing": op9_mixture_packing,
    "op10_toxic_severity": op10_toxic_severity,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_cascade": _op1_sql(),
    "op3_warc_members": OP3_SQL,
    "op4_near_duplicates": OP4_SQL,
    "op5_license_scan": license_sql(),
}
