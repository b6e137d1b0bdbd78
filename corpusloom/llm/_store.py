"""Places that every executor can read: lineage is cut by tables written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local one only where that is unset, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpusloom-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Bounds the bytes of text that Spark hands to a Python worker at once, where the session leaves
    that at its default: documents are long, and each task holds a batch on both sides."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting) == "10000":
        spark.conf.set(setting, "1000")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back, so that a lost
    executor costs a re-read and not a recomputation."""
    path = f"{shared_dir(df.sparkSession)}/corpusloom-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def drop(*tables: DataFrame) -> None:
    """Deletes tables of materialise() that nothing reads any more, so that the shared folder
    holds only what results still depend on."""
    for table in tables:
        spark, path = table.sparkSession, table.scratch_path.rpartition("/")[0]
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
