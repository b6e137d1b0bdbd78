"""JSON-lines sources and sinks, and small documents that the driver reads and writes."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS = "ticket_id string, instance string, title string, description string, notes string, issue_type string, sub_issue_type string, hours double, touches int"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of the fixed schema; blank lines are skipped, a broken line is an error."""
    return spark.read.schema(RECORDS).option("mode", "FAILFAST").json(path)


def write_records(records: DataFrame, path: str) -> None:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    records.select(*names).write.mode("overwrite").json(path)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """id, text, _row of the lines that are JSON objects with an id; others are skipped.
    Files are in the order in which they were written, those of one time by their paths; lines as they stand."""
    file = [F.col("_metadata.file_modification_time").alias("t"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b")]
    lines = spark.read.text(path).select("value", *file, F.monotonically_increasing_id().alias("i"))
    said = lines.select(F.from_json("value", "id string, text string").alias("j"), F.struct("t", "f", "b", "i").alias("_row"))
    return said.filter("j.id is not null").select("j.id", "j.text", "_row")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path``, in whatever store Spark's readers reach."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    from corpusloom.operators.features import CACHE_SCHEMA

    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def append_vectors(vectors: DataFrame, path: str) -> None:
    vectors.write.mode("append").parquet(path)


def append_new(rows: DataFrame, cache: DataFrame, path: str) -> None:
    """Appends rows (id, text) whose id the cache lacks; run again, it appends nothing."""
    new = rows.dropDuplicates(["id"]).join(cache.select("id"), "id", "left_anti")
    new.write.mode("append").json(path)


def read_map(path: str) -> dict[str, str]:
    """The synonyms of a JSON document under 'map'; none if there is no file."""
    return json.loads(Path(path).read_text(encoding="utf-8")).get("map", {}) if Path(path).exists() else {}


def load_env(path: str = ".env") -> dict[str, str]:
    """Settings of a file of NAME=value lines, without quotes around values; those that the
    environment has already stay as they are."""
    found = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines() if Path(path).exists() else []:
        name, equals, value = line.strip().removeprefix("export ").partition("=")
        if equals and not name.startswith("#"):
            value = value.strip()
            quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "\"'"
            found[name.strip()] = os.environ.setdefault(name.strip(), value[1:-1] if quoted else value)
    return found


def read_document(path: str) -> dict:
    if not Path(path).exists():
        raise FileNotFoundError(f"{path}: run the sweep first")
    return json.loads(Path(path).read_text(encoding="utf-8"))


def write_document(value: object, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


def signature(*paths: str, limit: int | None = None) -> dict:
    """What cached records depend on: the sources' paths and times, and the limit."""
    return {"paths": list(paths), "times": [Path(p).stat().st_mtime if Path(p).exists() else None for p in paths], "limit": limit}
