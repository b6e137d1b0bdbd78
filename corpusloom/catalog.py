"""Registered queries over the engine's own operators, on stand-in tables.

Orders stand for tickets and line items for their time entries; documents for descriptions;
parts and orders give labels; embeddings, with their label as a cluster, the vectors.
Documents hold no export noise, so it is put in by the same rule here and in the SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import catalog_sql, settings
from corpusloom.functions import labels, messages, privacy, text
from corpusloom.operators import clustering, features, records, requests, tfidf
from corpusloom.plans import taxonomy
from corpusloom.plans.providers import StubNamer


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for work that costs far more a row than moving it: a table with fewer splits than
    cores, which is then a small one, is dealt over all of them."""
    df, cores = table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


# ---------------------------------------------------------------- records


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    rows = o.select(
        F.lit(" main ").alias("instance"),
        key.cast("string").alias("ticketnumber"),
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("title"),
        F.when(key % 3 == 0, "NaN").otherwise(F.col("o_orderstatus")).alias("description"),
        F.col("o_orderstatus").alias("issue_type"),
        F.col("o_orderpriority").alias("sub_issue_type"),
        F.when(key % 7 == 0, "n/a").when(key % 7 == 1, "0").otherwise(F.col("o_totalprice").cast("string")).alias("hours"),
        key.alias("_row"),
    )
    again = rows.filter(F.col("_row") % 11 == 0).withColumns({"title": F.lit("again"), "_row": F.col("_row") + 10**12})
    return rows.unionByName(again)


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.lit("main").alias("instance"),
        F.concat(F.lit(" "), F.col("l_orderkey").cast("string")).alias("ticketnumber"),
        F.when(F.col("l_linenumber") != 3, F.col("l_shipdate")).alias("startdatetime"),
        F.col("l_returnflag").alias("summarynotes"),
        F.when(F.col("l_quantity") < 5, "None").otherwise(F.col("l_linestatus")).alias("internalnotes"),
        F.col("l_quantity").alias("hours"),
        F.col("l_linenumber").cast("long").alias("_row"),
    )


def built(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return records.build_records(tickets(spark, sf_dir), entries(spark, sf_dir), **options)


def q_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.records_only(built(spark, sf_dir)).drop("_row")


def q_records_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.records_meta(built(spark, sf_dir))


def q_records_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.records_meta(built(spark, sf_dir, limit=500))


def q_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("text", "doc_id", F.col("doc_id").alias("_row"))
    return records.first_rows(rows, ("text",)).select("doc_id")


# ---------------------------------------------------------------- text


def noisy(c: Column, key: Column) -> Column:
    put = {0: "\nVan: iemand\nRE", 1: "\n  Kind regards\nJo", 2: " **  created via Incoming Email Processor **x", 3: "\n --------  \nold", 4: " see https://example.com/a?b=c <https://example.com/t>[CID:i@x] <b>x</b>????y"}
    tail = F.lit("")
    for k, v in put.items():
        tail = F.when(key % 7 == k, F.lit(v)).otherwise(tail)
    return F.concat(F.when(key % 2 == 0, F.lit("Hallo_x000D__x000a__x0009_ \x07")).otherwise(""), c, tail)


def _cleaned(fn):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        d = texts(spark, sf_dir)
        c = fn(noisy(F.col("text"), F.col("doc_id")))
        return d.select("doc_id", F.length(c).cast("long").alias("n"), F.md5(c).alias("hash"))

    return query


def q_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_label()
    return table(spark, sf_dir, "part").select("p_partkey", labels.canonicalize(raw).alias("canonical"), labels.normalize_label(raw).alias("label"))


def raw_label() -> Column:
    k = F.col("p_partkey") % 6
    return (
        F.when(k == 0, F.concat(F.lit("QNP - "), F.col("p_type")))
        .when(k == 1, " Back-Up ")
        .when(k == 2, F.concat(F.lit("E_mail/"), F.col("p_brand")))
        .when(k == 3, "Overig")
        .when(k == 4, "Wachtwoord  Reset!")
        .otherwise(F.upper("p_type"))
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("ticket_id"), F.col("o_orderstatus").alias("issue_type"), F.col("o_orderpriority").alias("sub_issue_type"), F.col("o_orderkey").alias("_row"))


def q_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.audit(labelled(spark, sf_dir))


def q_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.token_weights(labelled(spark, sf_dir)).select("ticket_id", "token", F.round("weight", 9).alias("weight"))


PLANTED = " a.b@example.com ftp://u:p@h.example/x NL02ABCD0123456789 10.0.0.1 +31 (20) 555-0199, 123456782 "


def q_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.concat(F.col("text"), F.when(F.col("doc_id") % 4 == 0, PLANTED).otherwise(""))
    found = privacy.find_personal(c)

    def count(kind: str) -> Column:
        return F.size(F.filter(found, lambda x: x["kind"] == kind)).alias(kind)

    return texts(spark, sf_dir).select("doc_id", *map(count, privacy.DETECTORS))


def q_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.concat(F.col("text"), F.when(F.col("doc_id") % 4 == 0, PLANTED).otherwise(""))
    out, n = privacy.blank_prose(c)
    return texts(spark, sf_dir).select("doc_id", F.md5(out).alias("hash"), n.cast("long").alias("n"))


# ---------------------------------------------------------------- requests


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = texts(spark, sf_dir)
    rows = d.select(F.lit("d").alias("instance"), F.col("doc_id").cast("string").alias("ticketnumber"), F.col("text").alias("description"), F.col("doc_id").alias("_row"))
    return requests.descriptions(rows)


def cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return requests.latest(c.select(F.concat(F.lit("d::"), F.col("conv_id").cast("string")).alias("id"), "text", F.struct("turn", "text").alias("_row")))


def q_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cache(spark, sf_dir).select("id", F.md5("text").alias("hash"))


def q_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.todo(items(spark, sf_dir), cache(spark, sf_dir)).select("ticket_id", F.md5("text").alias("hash"))


def q_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = requests.groups(requests.todo(items(spark, sf_dir), cache(spark, sf_dir)))
    return g.select("custom_id", F.array_join("ids", ",").alias("ids"), F.md5(messages.group_message(F.col("descriptions"))).alias("hash"))


def q_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.cost(items(spark, sf_dir))


def q_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = texts(spark, sf_dir)
    rows = d.select(F.lit("d").alias("instance"), F.col("doc_id").cast("string").alias("ticketnumber"), F.col("text").alias("description"), "doc_id")
    return requests.twin(rows, cache(spark, sf_dir)).select("doc_id", "by_model", F.md5("description").alias("hash"))


def q_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", "doc_id", text.prepared_input(F.col("text"))[1].alias("size"))
    one = d.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("doc_id", "size"))).alias("x"))
    n = features.batch_numbers(F.transform("x", lambda s: s["size"]), 5000, 8)
    return one.select("source", F.explode(F.arrays_zip(F.transform("x", lambda s: s["doc_id"]).alias("doc_id"), n.alias("batch"))).alias("y")).select("source", "y.doc_id", "y.batch")


# ---------------------------------------------------------------- clusters


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("ticket_id"), "vec_id", F.col("embedding").cast("array<double>").alias("x"), F.col("label").alias("cluster_id"))


def weighed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, float]:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), F.col("n_chars").cast("double").alias("hours"))
    return vectors(spark, sf_dir).join(d, "vec_id"), float(d.agg(F.sum("hours")).first()[0] or 0)


def q_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_totals(*weighed(spark, sf_dir))


def q_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, total = weighed(spark, sf_dir)
    clusters = clustering.cluster_totals(rows, total).withColumn("qualifies", F.col("big_enough") & (F.col("cluster_id") % 2 == 0))
    return clustering.coverage(clusters, total)


def q_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = vectors(spark, sf_dir).select(F.col("cluster_id").alias("a"), F.when(F.col("vec_id") % 3 == 0, F.col("vec_id") % 7).otherwise(F.col("cluster_id")).alias("b"))
    return clustering.agreement(pairs).select(F.round("ari", 9).alias("ari"))


def q_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(round(clustering.silhouette(vectors(spark, sf_dir)), 9),)], "silhouette double")


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = vectors(spark, sf_dir)
    parts = {"title": (1, 16), "description": (17, 16), "notes": (33, 16), "cat": (49, 16)}
    return e.select("ticket_id", "vec_id", *[features.unit(F.slice("x", a, n)).alias(k) for k, (a, n) in parts.items()])


def q_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = features.combine(settings.COMBOS["notes_weighted"], {n: F.col(n) for n in settings.WEIGHT_ORDER})
    rows = blocks(spark, sf_dir).select("vec_id", x.alias("x"))
    return rows.select("vec_id", F.size("x").cast("long").alias("width"), *[F.round(F.element_at("x", i), 9).alias(f"x{i}") for i in (1, 17, 33, 64)])


def q_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark, sf_dir)
    got = clustering.sample_members(rows, clustering.centroids(rows)).filter(F.col("place") <= settings.NEAREST)
    return got.select("cluster_id", "place", "vec_id", F.round("distance", 7).alias("distance"))


# As many clusters as the table has labels, from one start: the search over k with ten starts is some thousand small
# jobs. Tests run it on a fixture.
def swept(spark: SparkSession, sf_dir: str, combos: list[str] | None = None):
    rows = blocks(spark, sf_dir).cache()
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("ticket_id"), F.coalesce("text", F.lit("")).alias("title"), F.lit("").alias("notes"), F.col("lang").alias("issue_type"), F.col("source").alias("sub_issue_type"), F.col("n_chars").cast("double").alias("hours"))
    total = docs.agg(F.sum("hours")).first()[0]
    return rows, docs, taxonomy.run_sweep(rows, docs, total, StubNamer(), combos=combos, fixed_k=10, starts=1)


def q_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, (artifacts, _) = swept(spark, sf_dir)
    lines = [(s["combo"], s["k"], s["coverage"], s["n_named"], s["llm_overall"]) for s in taxonomy.summary(artifacts)]
    return spark.createDataFrame(lines, "combo string, k int, coverage double, n_named long, llm_overall double")


def q_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _, (artifacts, found) = swept(spark, sf_dir, ["all_equal"])
    got = taxonomy.stability(rows, artifacts[0], found[artifacts[0]["combo"]], starts=1)
    return spark.createDataFrame([(got["combo"], got["n_runs"], got["pairwise_ari"], got["mean_ari"], got["stable"])], "combo string, n_runs int, pairwise_ari array<double>, mean_ari double, stable boolean")


def q_rubric(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, about = F.concat(F.lit("Cluster "), F.col("cluster_id").cast("string")), F.concat(F.lit("mail a.b@example.com, "), F.col("n_tickets").cast("string"))
    clusters = clustering.cluster_totals(*weighed(spark, sf_dir)).select("cluster_id", name.alias("title"), about.alias("description"), F.lit("Uncategorized").alias("category"), F.col("big_enough").alias("qualifies"))
    return privacy.gate(taxonomy.rubric(clusters))[0].drop("_order")


def q_ranked_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary of artifacts made of sources, most coverage first, then the better grade."""
    d = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum("n_chars").alias("covered"), F.count(F.lit(1)).alias("n")).orderBy("source")
    artifacts = [{"combo": r["source"], "weights": {}, "k": r["n"], "best_silhouette": 0.0, "coverage": {"coverage": r["covered"] // 100_000, "n_named_clusters": r["n"]}, "llm_score": {"coherence": 0.0, "distinctness": 0.0, "overall": float(r["n"] % 3)}} for r in d.collect()]  # sources are few
    lines = [(i, s["combo"], s["k"], s["coverage"], s["llm_overall"], s["n_named"]) for i, s in enumerate(taxonomy.summary(artifacts), 1)]
    return spark.createDataFrame(lines, "place int, combo string, k long, coverage long, llm_overall double, n_named long")


QUERIES = {
    "records": q_records,
    "records_meta": q_records_meta,
    "records_limited": q_records_limited,
    "first_rows": q_first_rows,
    "clean_description": _cleaned(text.clean_description),
    "clean_note": _cleaned(text.clean_note),
    "prepass_description": _cleaned(text.prepass_description),
    "record_text": _cleaned(text.record_text),
    "labels": q_labels,
    "label_audit": q_audit,
    "tfidf": q_tfidf,
    "personal_data": q_personal,
    "redacted": q_redacted,
    "cache_latest": q_cache,
    "todo": q_todo,
    "request_groups": q_groups,
    "request_cost": q_cost,
    "ticket_twin": q_twin,
    "token_batches": q_batches,
    "cluster_totals": q_totals,
    "coverage": q_coverage,
    "agreement": q_agreement,
    "silhouette": q_silhouette,
    "combine": q_combine,
    "nearest_members": q_members,
    "ranked_groups": q_ranked_sources,
    "sweep": q_sweep,
    "stability": q_stability,
    "rubric": q_rubric,
}

ORACLES = catalog_sql.ORACLES
