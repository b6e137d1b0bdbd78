"""A training-data pipeline over ``documents``: language, near copies, personal data, mixture, packing.

Each stage works on all that the stage before kept. All but the last return the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import language_id, mixing, near_dedup, packing, pseudonyms, queries
from corpusloom.llm._store import materialise, read_table


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those that identification rejects go. The
    model learns from the labelled documents of the table itself."""
    model, calibration = language_id.learn(docs)
    return language_id.identify(docs, model, calibration).filter(~F.col("rejected")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the least doc_id, and of rows that repeat it the
    first. Rows are told apart by their place in the written table, so a doc_id with two texts has each judged for
    itself; ids that are null come last. Rows without words are no copies and all stay."""
    rows = docs.withColumn("_place", F.monotonically_increasing_id())
    groups = near_dedup.groups(rows, row_col="_place")
    first = groups.filter("group is not null").groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("x"))
    stay = first.select(F.col("x.row").alias("_place")).unionByName(groups.filter("group is null").select(F.col("row").alias("_place")))
    return rows.join(stay, "_place", "left_semi").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in place of personal data and n_chars of the new text. The key is
    that of the session, or where none is set that of synthetic tables."""
    key = spark.conf.get(pseudonyms.KEY_SETTING, queries.SYNTHETIC_KEY)
    return pseudonyms.pseudonymised_documents(docs, key).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as the mixture of sources takes it. What is rounded is a digest of the rows; texts
    join their numbers of copies by their place in the written table."""
    rows = docs.withColumn("_place", F.monotonically_increasing_id())
    digest = rows.select("_place", "doc_id", "source", mixing.word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("salt"))
    taken = mixing.mix(materialise(digest, "mix_sizes")).filter("copies > 0").select("_place", F.col("copies").alias("_copies"))
    return rows.join(taken, "_place").withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", languages),
    ("near_dedup", near_copies),
    ("pseudonyms", personal_data),
    ("mixing", mixture),
    ("packing", packed),
]

#: Models, hashes and tokenizers are beyond SQL; the pipeline is tested against its parts instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
