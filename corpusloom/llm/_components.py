"""Connected components by alternating large and small stars, on DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._store import drop, materialise


def _stars(edges: DataFrame, large: bool) -> tuple[DataFrame, DataFrame]:
    """One star step: neighbours are linked with the least of them. The second table is read by the first."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    # written, so that the join below deals both sides anew and Spark can split the rows of a hub
    least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
    out = both.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if large:
        return out.filter(F.col("u") > F.col("v")).distinct(), least
    return out.unionByName(least.select("u", F.col("m").alias("v"))).filter(F.col("u") > F.col("v")).distinct(), least


def _is_open(edges: DataFrame) -> bool:
    """Whether some node has two parents, or a parent that has one itself: no forest of stars yet."""
    both = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    both = both.unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = both.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return bool(nodes.agg(F.coalesce(F.max((F.col("up") + F.col("down") > 1) & (F.col("up") > 0)), F.lit(False))).first()[0])


def components(edges: DataFrame) -> DataFrame:
    """node and comp (the least node of its component) for the nodes of ``edges`` (u, v)."""
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(F.col("u") > F.col("v")).distinct()
    now = materialise(now, "edges")
    while _is_open(now):
        large, a = _stars(now, True)
        small, b = _stars(large, False)
        old, now = now, materialise(small, "edges")
        drop(old, a, b)
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots.select("node", F.col("node").alias("comp")))
