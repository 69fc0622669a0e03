"""The queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, decontaminate, embedding_dedup, language, license_scan, near_dedup, quality, span_dedup, toxicity, warc
from .common import table


#: Where the public vocabulary lies, unless a caller names another place.
VOCABULARY = "byte_bpe_50k.tiktoken"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.jaccard_components(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), any_case=True)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digest(table(spark, sf_dir, "pages"))


QUERIES = (
    op1_jaccard_join,
    op2_decontamination,
    op3_license_scan,
    op4_embedding_dedup,
    op5_quality,
    op6_byte_bpe,
    op7_language,
    op8_toxicity,
    op9_substring_dedup,
    op10_warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


# DuckDB: lower-case hex of SHA-1 to upper-case base32, five bits at a time.
_BASE32 = """
list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + 16 * (substr({b}, 1 + 5 * i, 1) = '1')::INT + 8 * (substr({b}, 2 + 5 * i, 1) = '1')::INT + 4 * (substr({b}, 3 + 5 * i, 1) = '1')::INT
    + 2 * (substr({b}, 4 + 5 * i, 1) = '1')::INT + (substr({b}, 5 + 5 * i, 1) = '1')::INT, 1)), 'string_agg', '')
"""

_OP10 = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, url, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS most FROM p),
b AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i:
  ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][strpos('0123456789abcdef', substr(hex, i, 1))]),
  'string_agg', '') AS bits FROM h)
SELECT page_id, payload_bytes, {_BASE32.format(b="bits")} AS payload_digest,
  CASE WHEN page_id = most THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = most THEN NULL ELSE most END AS refers_to, url AS target_uri
FROM b
"""


_OP4 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.id),
comp AS (SELECT id, min(c) AS component_id FROM reach GROUP BY id)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c ON c.id = e.vec_id
"""


_OP1 = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
m AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT m.a, m.b FROM m JOIN n x ON x.doc_id = m.a JOIN n y ON y.doc_id = m.b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(c) FROM reach r WHERE r.id = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_jaccard_join": _OP1, "op4_embedding_dedup": _OP4, "op10_warc": _OP10}
