"""python -m corpusloom.plans.cli --stage clean|records|sweep|stability|finalize|all

Embeddings and names come from services at --embed-url and --chat-url (keys: EMBED_KEY and CHAT_KEY of
the environment or .env), or from stubs with --dry-run. Descriptions are cleaned by rule, and by a
model through the files of --queue."""

from __future__ import annotations

import argparse
import os
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from corpusloom import settings as S
from corpusloom.operators import features, records, requests, tfidf
from corpusloom.plans import cleaning, taxonomy
from corpusloom.plans.providers import ChatNamer, FileTokenizer, FolderQueue, HttpEmbedder, StubNamer, http_chat
from corpusloom.sources import files, workbook


def load(spark: SparkSession, path: str) -> DataFrame:
    """A workbook, or a table of Parquet, CSV or JSON with a column ``_row``."""
    if path.endswith(".xlsx"):
        return workbook.read_workbook(spark, path)
    kind = Path(path).suffix.lstrip(".") or "parquet"
    return spark.read.format(kind).load(path, **({"header": "true"} if kind == "csv" else {}))


#: The exports that are read where no path is given.
SOURCES = {"tickets": "data/tickets.xlsx", "entries": "data/entries.xlsx"}


def twin_path(path: str, cleaned_dir: str) -> str:
    return f"{cleaned_dir}/{Path(path).stem}.cleaned.parquet"


def source(name: str, given: str | None, cleaned_dir: str, raw: bool) -> str:
    """The path that is given; without one the cleaned twin of the usual export, or the export itself
    if raw is asked for or there is no twin."""
    twin = twin_path(SOURCES[name], cleaned_dir)
    if given or raw:
        return given or SOURCES[name]
    if not Path(twin).exists():
        print(f"no {twin}: {SOURCES[name]} is read as it is")
        return SOURCES[name]
    return twin


def cached_records(spark: SparkSession, tickets: str, entries: str, limit: int | None, out: str, rebuild: bool = False) -> tuple[DataFrame, dict]:
    """Records and totals, built again only if a source or the limit changed, or if ``rebuild`` says so."""
    now, where = files.signature(tickets, entries, limit=limit), f"{out}/records.json"
    if rebuild or not (Path(f"{out}/records_source.json").exists() and files.read_document(f"{out}/records_source.json") == now):
        built = records.build_records(load(spark, tickets), load(spark, entries), limit=limit).cache()
        files.write_records(records.records_only(built), where)
        files.write_document(records.records_meta(built).first().asDict(), f"{out}/records_meta.json")
        files.write_document(now, f"{out}/records_source.json")
    return files.read_records(spark, where), files.read_document(f"{out}/records_meta.json")


def clean_stage(spark: SparkSession, a: argparse.Namespace) -> None:
    """Twins of both exports. With a queue, its model's descriptions are in that of the tickets once they are there."""
    paths = {name: getattr(a, name) or SOURCES[name] for name in SOURCES}
    tickets, cache, manifest = load(spark, paths["tickets"]), f"{a.cleaned}/descriptions", f"{a.cleaned}/batch.json"
    options = {"sample": a.sample, "size": a.batch_size, "char_limit": a.char_limit}
    if a.dry_run:
        print(cleaning.clean_with_service(spark, tickets, None, cache, manifest, dry_run=True, **options))
        return
    if a.queue:
        queue = FolderQueue(a.queue)
        if not a.collect:
            print(cleaning.clean_with_service(spark, tickets, queue, cache, manifest, force_new=a.force_new, **options))
        elif not Path(manifest).exists():
            raise SystemExit("no batch is in flight")
        if a.submit_only:
            return
        while Path(manifest).exists():
            said = cleaning.collect(spark, queue, cache, manifest)
            print(said)
            if "waiting" in said:
                time.sleep(a.poll_interval)
    cleaned = requests.latest(files.read_cache(spark, cache)) if files.exists(spark, cache) else None
    for name, kind in (("tickets", "tickets"), ("entries", "time_entries")):
        if cleaned is not None and name == "tickets":
            df, seen = cleaning.ticket_twin(tickets, cleaned)
        else:
            df, seen = cleaning.clean_table(load(spark, paths[name]), cleaning.TARGETS[kind])
        df.write.mode("overwrite").parquet(twin_path(paths[name], a.cleaned))
        print(kind, seen.get)


def services(a: argparse.Namespace):
    """What embeds and what names."""
    if a.dry_run:
        return features.StubEmbedder(), StubNamer()
    files.load_env()
    missing = [n for n, v in (("--embed-url", a.embed_url), ("--chat-url", a.chat_url), ("EMBED_KEY", os.environ.get("EMBED_KEY")), ("CHAT_KEY", os.environ.get("CHAT_KEY"))) if not v]
    if missing:
        raise SystemExit(f"{', '.join(missing)} needed, or --dry-run for stubs")
    return HttpEmbedder(a.embed_url, os.environ["EMBED_KEY"], a.embed_model), ChatNamer(http_chat(a.chat_url, os.environ["CHAT_KEY"], a.chat_model))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--stage", choices=("clean", "records", "sweep", "stability", "finalize", "all"), default="all")
    for name, path in SOURCES.items():
        p.add_argument(f"--{name}", help=f"read as it is; else the cleaned twin of {path}, or that")
    p.add_argument("--out", default="results")
    p.add_argument("--cleaned", default="data/cleaned")
    p.add_argument("--limit", type=int, help="most kept tickets")
    p.add_argument("--combo", choices=tuple(S.COMBOS), help="sweep this combination only")
    p.add_argument("--fixed-k", type=int)
    p.add_argument("--select", help="the combination to check or freeze")
    p.add_argument("--raw", action="store_true", help="use the exports as they are")
    p.add_argument("--dry-run", action="store_true", help="stubs instead of services; clean: only what it would cost")
    p.add_argument("--rebuild-records", action="store_true")
    p.add_argument("--skip-stability", action="store_true")
    p.add_argument("--starts", type=int, default=S.KMEANS_STARTS)
    p.add_argument("--synonyms", help="a JSON document with label synonyms under 'map'")
    p.add_argument("--tokenizer", help="a vocabulary file; embedding inputs are cut by its tokens")
    for name in ("embed", "chat"):
        p.add_argument(f"--{name}-url")
        p.add_argument(f"--{name}-model", default="default")
    p.add_argument("--queue", help="clean: the folder of requests and answers")
    p.add_argument("--sample", type=int, help="clean: descriptions of the first so many tickets")
    p.add_argument("--batch-size", type=int, default=S.GROUP_SIZE, help="clean: descriptions in a request")
    p.add_argument("--char-limit", type=int, default=S.DESCRIPTION_CHARS, help="clean: characters of a description that are sent")
    p.add_argument("--poll-interval", type=float, default=30, help="clean: seconds between looks for answers")
    p.add_argument("--collect", action="store_true", help="clean: take the answers of the batch in flight")
    p.add_argument("--submit-only", action="store_true", help="clean: send the batch and leave")
    p.add_argument("--force-new", action="store_true", help="clean: forget the batch in flight")
    return p


def main(argv: list[str] | None = None) -> None:
    p = parser()
    a = p.parse_args(argv)
    if a.stage in ("stability", "finalize") and not a.select:
        p.error("--select is needed: a person chooses the combination")
    spark = SparkSession.builder.getOrCreate()
    if a.stage == "clean":
        return clean_stage(spark, a)
    rows, meta = cached_records(spark, source("tickets", a.tickets, a.cleaned, a.raw), source("entries", a.entries, a.cleaned, a.raw), a.limit, a.out, a.rebuild_records)
    if a.stage == "records":
        print(meta)
        return
    artifact = files.read_document(f"{a.out}/combos/{a.select}.json") if a.stage in ("stability", "finalize") else None
    if artifact and a.stage == "finalize" and a.skip_stability:
        print(taxonomy.finalize(spark, artifact, meta, a.out))
        return
    (provider, namer), cache, tokenizer = services(a), f"{a.out}/vectors", FileTokenizer(a.tokenizer) if a.tokenizer else None
    known = files.read_vectors(spark, cache) if files.exists(spark, cache) else spark.createDataFrame([], features.CACHE_SCHEMA)
    for field in S.FIELDS:
        files.append_vectors(features.embed_missing(rows, known, field, provider, tokenizer), cache)
    labels = tfidf.label_block(rows, synonyms=files.read_map(a.synonyms) if a.synonyms else None)
    blocks = features.feature_blocks(rows, files.read_vectors(spark, cache), provider, *labels, tokenizer).cache()
    if a.stage in ("sweep", "all"):
        found, _ = taxonomy.run_sweep(blocks, rows, meta["total_hours"], namer, combos=[a.combo] if a.combo else None, out_dir=a.out, fixed_k=a.fixed_k, starts=a.starts)
        for line in taxonomy.summary(found):
            print(line)
    if not a.select or a.stage == "sweep":
        return
    artifact, stable = artifact or files.read_document(f"{a.out}/combos/{a.select}.json"), None
    if a.stage == "stability" or not a.skip_stability:
        stable = taxonomy.stability(blocks, artifact, spark.read.parquet(f"{a.out}/labels/{a.select}"), starts=a.starts)
        files.write_document(stable, f"{a.out}/stability.json")
        print(stable)
    if a.stage != "stability":
        print(taxonomy.finalize(spark, artifact, meta, a.out, stable=stable))


if __name__ == "__main__":
    main()
