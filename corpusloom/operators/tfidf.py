"""TF-IDF over namespaced label tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.labels import label_tokens


def label_block(records: DataFrame, *, min_df: int = 2, synonyms: dict[str, str] | None = None) -> tuple[DataFrame, list[str]]:
    """ticket_id and ``cat`` (map from token to weight, of unit length or empty) of every record,
    and the vocabulary in order. idf is ln((1 + n) / (1 + df)) + 1 where n counts all records;
    tokens of fewer than ``min_df`` records are left out. An empty vocabulary raises ValueError."""
    weights = token_weights(records, min_df=min_df, synonyms=synonyms)
    vocabulary = [r["token"] for r in weights.select("token").distinct().orderBy("token").collect()]
    if not vocabulary:
        raise ValueError("no label occurs often enough")
    maps = weights.groupBy("ticket_id").agg(F.map_from_entries(F.collect_list(F.struct("token", "weight"))).alias("cat"))
    empty = F.create_map().cast("map<string,double>")
    return records.select("ticket_id").join(maps, "ticket_id", "left").withColumn("cat", F.coalesce("cat", empty)), vocabulary


def token_weights(records: DataFrame, *, min_df: int = 2, synonyms: dict[str, str] | None = None) -> DataFrame:
    """ticket_id, token, weight of each record's tokens that are frequent enough."""
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("raw")) for f in ("issue_type", "sub_issue_type")])
    raw = records.select("ticket_id", F.explode(fields).alias("x")).select("ticket_id", "x.*").filter("raw is not null")
    # each distinct label is made canonical once; Spark broadcasts them if they turn out small
    own = lambda f: F.when(F.col("field") == f, F.col("raw"))
    known = raw.select("field", "raw").distinct().withColumn("token", F.get(label_tokens(own("issue_type"), own("sub_issue_type"), synonyms), F.lit(0)))
    rows = raw.join(known.filter("token is not null"), ["field", "raw"]).groupBy("ticket_id", "token").agg(F.count(F.lit(1)).alias("tf"))
    total = records.agg(F.count(F.lit(1)).alias("n"))
    idf = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df)
    idf = idf.crossJoin(F.broadcast(total)).select("token", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))  # one row
    raw = rows.join(idf, "token").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("ticket_id")))  # a ticket has few tokens
    return raw.select("ticket_id", "token", (F.col("w") / norm).alias("weight"))
