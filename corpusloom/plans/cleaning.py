"""Cleaned twins of both exports, with a language model's cleaning where there is some."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import clean_description, clean_note
from corpusloom.operators import requests
from corpusloom.operators.records import require
from corpusloom.settings import DESCRIPTION_CHARS, GROUP_SIZE, MOST_REQUESTS
from corpusloom.sources.files import append_new, exists, read_cache, write_document
from corpusloom.sources.workbook import read_workbook, write_workbook

TARGETS = {"tickets": {"description": clean_description}, "time_entries": {"summarynotes": clean_note, "internalnotes": clean_note}}


class BatchService(Protocol):
    """A queue of requests that is answered later."""

    def submit(self, requests: list[tuple[str, str]]) -> str: ...

    def results(self, batch_id: str) -> list[tuple[str, str]] | None: ...


def clean_table(df: DataFrame, targets: dict[str, Callable[[Column], Column]]) -> tuple[DataFrame, Observation]:
    """``df`` with its target columns cleaned and all else as it is. Once it has been written,
    the observation has rows and cells_cleaned. Targets that ``df`` lacks are skipped."""
    there = {c: fn for c, fn in targets.items() if c in df.columns}
    out = df.withColumns({f"_{c}": fn(F.col(c)) for c, fn in there.items()})
    changed = sum((F.coalesce(F.col(c).cast("string") != F.col(f"_{c}"), F.lit(False)).cast("long") for c in there), F.lit(0))
    seen = Observation()
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(changed), F.lit(0)).alias("cells_cleaned"))
    return out.select(*[F.col(f"_{c}").alias(c) if c in there else F.col(c) for c in df.columns]), seen


def clean_workbook(spark: SparkSession, source: str, target: str, kind: str, *, sheet: str = "Export", names: dict[str, str] | None = None, numbers: tuple[str, ...] = ()) -> dict:
    """A twin of the workbook ``source`` whose columns of that ``kind`` of table are cleaned; all other
    cells and the header are kept. ``names`` maps the header's names to those of TARGETS."""
    df = read_workbook(spark, source, sheet=sheet, names=names)
    out, _ = clean_table(df, TARGETS[kind])
    changed = sum((F.coalesce(df[c] != fn(df[c]), F.lit(False)).cast("long") for c, fn in TARGETS[kind].items() if c in df.columns), F.lit(0))
    counts = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(changed), F.lit(0)).alias("cells_cleaned")).first().asDict()
    back = {v: k for k, v in (names or {}).items()}
    write_workbook(out.withColumnsRenamed(back), target, sheet=sheet, numbers=numbers)
    return {"src": source, "dst": target, **counts}


def ticket_twin(tickets: DataFrame, cleaned: DataFrame) -> tuple[DataFrame, Observation]:
    """requests.twin() and what it counted: rows, llm, fallback."""
    require(tickets, ("instance", "ticketnumber", "description"))
    seen = Observation()
    rows = requests.twin(tickets, cleaned)
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("by_model"), 1)).alias("llm"), F.count(F.when(~F.col("by_model"), 1)).alias("fallback"))
    return rows.drop("by_model"), seen


def clean_with_service(spark: SparkSession, tickets: DataFrame, service: BatchService, cache_path: str, manifest_path: str, *, dry_run: bool = False, force_new: bool = False, sample: int | None = None, size: int = GROUP_SIZE, char_limit: int = DESCRIPTION_CHARS) -> dict:
    """Submits what the cache lacks, or collects what was submitted before.

    The driver sends requests, at most MOST_REQUESTS in a batch. A manifest of a batch in
    flight is collected first unless ``force_new``; a dry run sends nothing.
    """
    cache = read_cache(spark, cache_path) if exists(spark, cache_path) else spark.createDataFrame([], "id string, text string")
    items = requests.descriptions(tickets)
    items = items.orderBy("_row").limit(sample) if sample else items
    if dry_run:
        return requests.cost(requests.todo(items, cache), size).first().asDict()
    if force_new:
        Path(manifest_path).unlink(missing_ok=True)
    if Path(manifest_path).exists():
        return collect(spark, service, cache_path, manifest_path)
    grouped = requests.groups(requests.todo(items, cache), size).cache()
    sent = [(r["custom_id"], r["message"]) for r in requests.requests(grouped, char_limit).limit(MOST_REQUESTS + 1).collect()]
    if len(sent) > MOST_REQUESTS:
        raise ValueError(f"more than {MOST_REQUESTS} requests: take a sample")
    if not sent:
        return {"submitted": 0}
    batch = service.submit(sent)
    write_document({"batch_id": batch, "groups": {r["custom_id"]: r["ids"] for r in grouped.select("custom_id", "ids").collect()}}, manifest_path)
    return {"submitted": len(sent), "batch_id": batch}


def collect(spark: SparkSession, service: BatchService, cache_path: str, manifest_path: str) -> dict:
    """Appends the answers of the batch in flight to the cache; nothing twice."""
    manifest = json.loads(Path(manifest_path).read_text(encoding="utf-8"))
    results = service.results(manifest["batch_id"])
    if results is None:
        return {"waiting": manifest["batch_id"]}
    grouped = spark.createDataFrame(list(manifest["groups"].items()), "custom_id string, ids array<string>")
    rows = requests.answers(spark.createDataFrame(results, "custom_id string, answer string"), grouped).cache()
    cache = read_cache(spark, cache_path) if exists(spark, cache_path) else spark.createDataFrame([], "id string, text string")
    written = rows.join(cache.select("id"), "id", "left_anti").count()
    append_new(rows, cache, cache_path)
    Path(manifest_path).unlink()
    return {"written": written}
