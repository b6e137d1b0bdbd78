"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm._store import read_table
from corpusloom.llm.anisotropic_ann import nearest
from corpusloom.llm.attention_lm import scored_documents
from corpusloom.llm.exact_topk import top_k
from corpusloom.llm.language_id import identified_documents
from corpusloom.llm.mixing import mixed_documents
from corpusloom.llm.near_dedup import near_duplicates
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.pseudonyms import KEY_SETTING, pseudonymised_documents
from corpusloom.llm.sharding import shard_documents
from corpusloom.llm.url_rules import filter_pages

#: For the synthetic test tables only, where no key is set; the operator itself has none.
SYNTHETIC_KEY = "key of synthetic tables"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified_documents(read_table(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_pages(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised_documents(read_table(spark, sf_dir, "documents"), spark.conf.get(KEY_SETTING, SYNTHETIC_KEY))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"))


def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_documents(read_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_documents(read_table(spark, sf_dir, "documents"))


def op9_anisotropic_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_near_dedup": op2_near_dedup,
    "op3_url_rules": op3_url_rules,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_packing": op5_packing,
    "op6_exact_topk": op6_exact_topk,
    "op7_attention_lm": op7_attention_lm,
    "op8_mixing": op8_mixing,
    "op9_anisotropic_ann": op9_anisotropic_ann,
    "op10_sharding": op10_sharding,
}

#: Only what DuckDB can express.
ORACLES: dict[str, str] = {
    "op2_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
        ), e AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s
        ), p AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
        ), l AS (
            SELECT a, b FROM p UNION ALL SELECT b, a FROM p
        ), r AS (
            SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
        ), c AS (
            SELECT a, min(b) AS component_id FROM r GROUP BY a
        )
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c ON c.a = doc_id""",
    "op6_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}
