"""Sweep over weight combinations, stability of a choice, and the frozen taxonomy.

The driver loops over combinations, numbers of clusters and clusters, all of which are few;
rows stay distributed.
"""

from __future__ import annotations

from itertools import combinations
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import settings as S
from corpusloom.functions import messages
from corpusloom.functions.privacy import blank_prose, gate
from corpusloom.operators import clustering
from corpusloom.operators.features import combine
from corpusloom.plans.providers import Namer
from corpusloom.sources.files import write_document

OTHER = ("Long-tail / Other", "Other", "Requests of clusters without enough text, too small to be a kind of work of their own, or made of several.")


def combined(blocks: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """ticket_id and x."""
    return blocks.select("ticket_id", combine(weights, {n: F.col(n) for n in S.WEIGHT_ORDER}).alias("x"))


def run_combo(name: str, blocks: DataFrame, records: DataFrame, total_hours: float, namer: Namer, *, fixed_k: int | None = None, candidates: list[int] | None = None, starts: int = S.KMEANS_STARTS, fits: dict[int, tuple] | None = None) -> tuple[dict, DataFrame]:
    """The artifact of one combination, and the labels (ticket_id, cluster_id) that it found. ``fits`` are those of
    ``fit_together``, if there are any."""
    rows = combined(blocks, S.COMBOS[name]).persist()
    try:
        if fits is None:
            ks = clustering.to_try(rows, fixed_k, candidates)
            fits = dict(zip(ks, clustering.fits(rows, [(k, S.KMEANS_SEED) for k in ks], starts=starts), strict=True))
        k, scores = clustering.choose_k(rows, found=fits)
        centres = fits[k][0]
        at = clustering.assigned(rows, centres)
        labels = at.select("ticket_id", "cluster_id").persist()
        found = at.sparkSession.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)], "cluster_id int, centre array<double>")
        members = clustering.sample_members(at, found).select("ticket_id", "cluster_id", "place")
        shown = F.struct("place", "title", "issue_type", "sub_issue_type", "notes")
        # a dozen of each cluster, so records aren't moved
        samples = records.join(F.broadcast(members), "ticket_id").groupBy("cluster_id").agg(F.array_sort(F.collect_list(shown)).alias("s"))
        example = lambda s: F.when(s["title"] != "", s["title"]).otherwise(F.substring(s["notes"], 1, 120))
        samples = samples.select("cluster_id", messages.name_message(F.col("s")).alias("message"), F.transform(F.slice("s", 1, 3), example).alias("examples"))
        weighed = labels.join(records.select("ticket_id", "hours"), "ticket_id")
        totals = clustering.cluster_totals(weighed, total_hours, k)
        listed = totals.join(samples, "cluster_id", "left").orderBy("cluster_id").collect()  # k rows
    finally:
        rows.unpersist()
    clusters = []
    for r in listed:
        named = namer.name_cluster(r["message"] or "", r["cluster_id"])
        clusters.append({"cluster_id": r["cluster_id"], **named, "n_tickets": r["n_tickets"], "hours": r["hours"], "hours_frac": r["hours_frac"], "big_enough": r["big_enough"], "qualifies": named["coherent"] and r["big_enough"], "examples": list(r["examples"] or [])})
    spark = records.sparkSession
    named = [{"id": c["cluster_id"], "title": c["title"], "description": c["description"]} for c in clusters]
    as_text = lambda items, schema, make: spark.createDataFrame([(items,)], f"x array<struct<{schema}>>").select(make(F.col("x"))).first()[0]
    categories = namer.assign_categories(named, as_text(named, "id: int, title: string, description: string", messages.category_message))
    for c in clusters:
        c["category"] = categories.get(c["cluster_id"], "Other")
    judged = [c for c in clusters if c["qualifies"]] or clusters
    shown = [{f: c[f] for f in ("title", "description", "examples")} for c in judged]
    score = namer.judge(as_text(shown, "title: string, description: string, examples: array<string>", messages.judge_message))
    covered = spark.createDataFrame([(c["hours"], c["qualifies"]) for c in clusters], "hours double, qualifies boolean")
    artifact = {"combo": name, "weights": dict(zip(S.WEIGHT_ORDER, S.COMBOS[name], strict=True)), "k": k, "silhouette_by_k": scores, "best_silhouette": scores[k], "coverage": clustering.coverage(covered, total_hours).first().asDict(), "llm_score": score, "clusters": clusters}
    return artifact, labels


def fit_together(blocks: DataFrame, names: list[str], ks: list[int], starts: int = S.KMEANS_STARTS) -> dict[str, dict[int, tuple]] | None:
    """Fits of each k of all combinations by shared passes over their blocks; None if those are too many for one."""
    first = blocks.agg(*[F.max(F.size(n)).alias(n) for n in S.WEIGHT_ORDER]).first()
    if None in first or len(names) * sum(ks) * starts * sum(first) > clustering.PASS_NUMBERS:
        return None
    wanted = [(k, S.KMEANS_SEED * 1000 + i) for k in ks for i in range(starts)]
    scales, begun = {n: np.repeat(S.COMBOS[n], tuple(first)) for n in names}, []
    for name in names:
        for seed in clustering.seeds(combined(blocks, S.COMBOS[name]), wanted):
            centres = np.zeros((len(seed), sum(first)))
            centres[:, scales[name] > 0] = seed
            begun.append(clustering.Start(centres, scales[name]))
    points = clustering.packed(blocks.select(F.concat(*S.WEIGHT_ORDER).alias("x")))
    try:
        runs = iter(clustering.lloyd(points, begun))
    finally:
        points.unpersist()
    out = {}
    for name in names:
        best = {k: clustering.cheapest([next(runs) for _ in range(starts)]) for k in ks}
        out[name] = {k: (centres[:, scales[name] > 0], cost) for k, (centres, cost) in best.items()}
    return out


def summary(artifacts: list[dict]) -> list[dict]:
    """A line for each combination: most coverage first, then the better grade."""
    lines = [{"combo": a["combo"], "weights": a["weights"], "k": a["k"], "coverage": a["coverage"]["coverage"], "n_named": a["coverage"]["n_named_clusters"], "coherence": a["llm_score"]["coherence"], "distinctness": a["llm_score"]["distinctness"], "llm_overall": a["llm_score"]["overall"], "best_silhouette": a["best_silhouette"]} for a in artifacts]
    return sorted(lines, key=lambda s: (-s["coverage"], -s["llm_overall"]))


def run_sweep(blocks: DataFrame, records: DataFrame, total_hours: float, namer: Namer, *, combos: list[str] | None = None, out_dir: str | None = None, fixed_k: int | None = None, candidates: list[int] | None = None, starts: int = S.KMEANS_STARTS) -> tuple[list[dict], dict[str, DataFrame]]:
    """Artifacts and labels of all combinations; with ``out_dir``, the files of each and a summary."""
    artifacts, labels, names = [], {}, list(combos or S.COMBOS)
    ks = clustering.to_try(blocks, fixed_k, candidates)
    fits = fit_together(blocks, names, ks, starts) or {}
    for name in names:
        artifact, labels[name] = run_combo(name, blocks, records, total_hours, namer, candidates=ks, starts=starts, fits=fits.get(name))
        artifacts.append(artifact)
        if out_dir:
            write_document(artifact, f"{out_dir}/combos/{name}.json")
            labels[name].write.mode("overwrite").parquet(f"{out_dir}/labels/{name}")
    if out_dir:
        write_document({"combos": summary(artifacts), "llm_usage": namer.usage}, f"{out_dir}/sweep_summary.json")
    return artifacts, labels


def stability(blocks: DataFrame, artifact: dict, labels: DataFrame, *, reseeds: int = S.RESEEDS, starts: int = S.KMEANS_STARTS) -> dict:
    """Agreement of the labels with those of other seeds, in pairs."""
    rows = combined(blocks, tuple(artifact["weights"][n] for n in S.WEIGHT_ORDER)).persist()
    try:
        found = clustering.fits(rows, [(artifact["k"], S.KMEANS_SEED + 1 + i) for i in range(reseeds)], starts=starts)
        # all runs' labels side by side, so rows are joined once
        at = rows.join(labels.select("ticket_id", F.col("cluster_id").alias("run0")), "ticket_id")
        for i, (centres, _) in enumerate(found, 1):
            at = clustering.assigned(at, centres).withColumnRenamed("cluster_id", f"run{i}")
        runs = [f"run{i}" for i in range(len(found) + 1)]
        table = at.select(*runs).persist()
        pairs = [table.select(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in combinations(runs, 2)]
        scores = [clustering.agreement(p).first()[0] for p in pairs]
        table.unpersist()
    finally:
        rows.unpersist()
    mean = sum(scores) / len(scores) if scores else 1.0
    return {"combo": artifact["combo"], "k": artifact["k"], "n_runs": len(runs), "pairwise_ari": [round(s, 4) for s in scores], "mean_ari": round(mean, 4), "threshold": S.STABLE_ARI, "stable": mean >= S.STABLE_ARI}


def rubric(clusters: DataFrame) -> DataFrame:
    """name, category, description of clusters that qualify, in order, and of what is left."""
    rows = clusters.filter("qualifies").select(F.col("title").alias("name"), "category", "description", F.col("cluster_id").alias("_order"))
    other = clusters.sparkSession.createDataFrame([(*OTHER, 1 << 30)], "name string, category string, description string, _order int")
    return rows.unionByName(other)


def finalize(spark, artifact: dict, records_meta: dict, out_dir: str, *, stable: dict | None = None, window: str = "", models: dict | None = None) -> dict:
    """Writes taxonomy.md, clusters.jsonl and metrics.json. The gate comes first: personal data
    in a name or category of what qualifies raises and nothing is written. Descriptions and examples of all clusters are redacted."""
    fields = "cluster_id int, title string, description string, category string, qualifies boolean"
    clusters = spark.createDataFrame([tuple(c[f.split()[0]] for f in fields.split(", ")) for c in artifact["clusters"]], fields)
    rows, redacted = gate(rubric(clusters))
    lines = [" | ".join(r[f] for f in ("name", "category", "description")) for r in rows.orderBy("_order").collect()]
    shown = spark.createDataFrame([(c["cluster_id"], c["description"], list(c["examples"])) for c in artifact["clusters"]], "cluster_id int, description string, examples array<string>")
    shown = shown.select("cluster_id", blank_prose(F.col("description"))[0].alias("description"), F.transform("examples", lambda e: blank_prose(e)[0]).alias("examples"))
    clean = {r["cluster_id"]: {"description": r["description"], "examples": r["examples"]} for r in shown.collect()}
    qualifying = sum(c["qualifies"] for c in artifact["clusters"])
    metrics = {k: artifact.get(k) for k in ("combo", "weights", "k", "best_silhouette", "coverage", "llm_score")} | {
        "n_workflows": len(lines), "n_qualifying_clusters": qualifying, "redactions": redacted, "stability": stable, "models": models or {}, "dataset_window": window, "records_meta": records_meta,
        "thresholds": {"min_cluster_tickets": S.MIN_ROWS, "min_cluster_mass_frac": S.MIN_MASS, "low_ari_threshold": S.STABLE_ARI, "k_range": [S.K_MIN, S.K_MAX]},
    }
    Path(out_dir).mkdir(parents=True, exist_ok=True)
    (Path(out_dir) / "taxonomy.md").write_text("\n".join(lines) + "\n", encoding="utf-8")
    import json

    (Path(out_dir) / "clusters.jsonl").write_text("".join(json.dumps(c | clean[c["cluster_id"]], ensure_ascii=False) + "\n" for c in artifact["clusters"]), encoding="utf-8")
    write_document(metrics, f"{out_dir}/metrics.json")
    return metrics
