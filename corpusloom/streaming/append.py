"""Cleaning as a stream: arriving descriptions are cleaned and appended once by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from corpusloom.functions.text import prepass_description
from corpusloom.sources.files import append_new, exists, read_cache


def append_cleaned(arriving: DataFrame, cache_path: str, checkpoint: str) -> DataStreamWriter:
    """A writer of the stream ``arriving`` (id, text); a batch that is run again adds nothing."""

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        there = read_cache(spark, cache_path) if exists(spark, cache_path) else spark.createDataFrame([], "id string")
        append_new(batch, there, cache_path)

    cleaned = arriving.select("id", prepass_description(F.col("text")).alias("text"))
    return cleaned.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
