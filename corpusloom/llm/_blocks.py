"""Block-wise search: a stated set of queries against all rows.

Candidates are dealt into groups and queries into blocks by hash; each pair of a group and a block
meets in one task, so memory is bounded by the block sizes and no task holds a whole side.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a group of candidates, and of a block of queries.
GROUP_ROWS, QUERY_ROWS = 8192, 2048
#: Fewest groups, so that small tables use all cores too.
LEAST_GROUPS = 16


def finite(vector: Column) -> Column:
    """Not null, without null, NaN or infinite components. Empty vectors hold none."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(True))


def distinct_queries(rows: DataFrame, every: int) -> DataFrame:
    """Rows whose vec_id is divisible by ``every``; of rows that repeat a vec_id, one."""
    return rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def padded(vectors: pd.Series, width: int, kind: type) -> np.ndarray:
    """A matrix of ``vectors``; shorter ones end in zeros."""
    out = np.zeros((len(vectors), width), kind)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def group_count(candidates: DataFrame) -> int:
    return max(LEAST_GROUPS, -(-candidates.count() // GROUP_ROWS))


def search_blocks(candidates: DataFrame, queries: DataFrame, best: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], k: int, descending: bool, score_type: str) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best of what ``best(candidates, queries)``
    finds in each pair of a group (in the order of vec_id) and a block."""
    groups = group_count(candidates)
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    left = candidates.withColumn("_g", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("_b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    schema = f"query_id long, vec_id long, score {score_type}"

    def pair(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(q):
            return pd.DataFrame({"query_id": np.array([], np.int64), "vec_id": np.array([], np.int64), "score": np.array([], np.float64 if score_type == "double" else np.int64)})
        return best(c.sort_values("vec_id", kind="stable").reset_index(drop=True), q)

    found = left.groupBy("_g", "_b").cogroup(right.groupBy("_g", "_b")).applyInPandas(pair, schema)
    order = F.desc("score") if descending else F.asc("score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_by_key(key: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest of each row of ``key``, in no order."""
    if key.shape[1] <= k:
        return np.broadcast_to(np.arange(key.shape[1]), key.shape)
    return np.argpartition(key, key.shape[1] - k, axis=1)[:, -k:]
