"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same fractional number of copies. Its whole part is
kept; the fraction is rounded in pairs: two fractional documents pass word mass between them, in
a random direction with the probabilities that keep both expectations, until one of them is
integral. So the words taken from a source stay equal to its target but for one document at the
end. Blocks of documents are rounded side by side; the one fractional document that each block
and source leaves goes on into a reduction tree of blocks of blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm._store import materialise

#: Documents of a block, and blocks that one node of the reduction tree combines.
BLOCK_ROWS, FAN_IN = 1024, 64
WORD = r"[^\x20\x09-\x0D]+"
_EPS = 1e-9


def word_count(text: Column) -> Column:
    """Words of ``text``; none for null. Counted as starts of words, without making the words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> dict[str | None, float]:
    """Words wanted of each source: sources by code point, null last, get ``weights`` in turn of
    all words; none gets over ``most`` times its own, and the excess is shared again by weight."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, free, left = {}, list(order), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: float(most * sizes[s]) for s in over}
        left -= sum(out[s] for s in over)
        free = [s for s in free if s not in out]
    return out


def round_pivotal(size: np.ndarray, part: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounds fractions ``part`` of rows that weigh ``size`` > 0; ``draw`` are uniform numbers.
    Gives the rounded parts and the place of the one row that is still fractional, or -1."""
    out, held = part.copy(), -1
    for i in np.flatnonzero((part > _EPS) & (part < 1 - _EPS)):
        if held < 0:
            held = i
            continue
        # words that can go from i to the held row, and from the held row to i
        up = min((1 - out[held]) * size[held], out[i] * size[i])
        down = min(out[held] * size[held], (1 - out[i]) * size[i])
        move = up if draw[i] * (up + down) < down else -down
        out[held] += move / size[held]
        out[i] -= move / size[i]
        whole = [j for j in (held, i) if not _EPS < out[j] < 1 - _EPS]
        for j in whole:
            out[j] = round(out[j])
        held = -1 if len(whole) == 2 else i if whole == [held] else held
    return out, int(held)


def draws(order: np.ndarray) -> np.ndarray:
    """A uniform number for each row of a block, by its place and its hash ``order``. It doesn't follow the hash that
    sorts rows, nor agree for rows that are alike."""
    x = order.view(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.arange(1, len(order) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53


def _rounder(last: bool):
    def rounded(groups: pd.DataFrame) -> pd.DataFrame:
        # large rows first, so that the one left at the end is mostly a small one
        groups = groups.sort_values(["_rank", "_size", "_order"], ascending=[True, False, True], kind="stable").reset_index(drop=True)
        part, open_ = groups["_part"].to_numpy(copy=True), np.zeros(len(groups), bool)
        draw = draws(groups["_order"].to_numpy())
        for at in groups.groupby("_rank", sort=False).indices.values():
            got, held = round_pivotal(groups["_size"].to_numpy(np.float64)[at], part[at], draw[at])
            if held >= 0 and last:
                got[held] = float(got[held] >= 0.5)  # the nearer one: no more than half a document is missed
            elif held >= 0:
                open_[at[held]] = True
            part[at] = got
        return groups.assign(_part=part, _open=open_)

    return rounded


def mix(df: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size", seed: int = 17, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``df`` with ``source_size`` long, ``target`` double and ``copies`` int (times that the
    mix takes the row).

    ``size_col`` is the row's weight (long, not null). Rows without words take no part: 0 copies.
    A null source is a source of its own, last in order. The list of sources and their sizes is
    metadata and goes to the driver. Ties and repeated rows are rounded each for themselves. Blocks
    come from a hash of all columns, so rows with a null or repeated id spread over them if they differ in
    anything; rows that differ in nothing share a block and are interchangeable, so reruns agree
    whatever the partitioning. Long texts only have a size here. Empty tables give empty results; other columns pass through, those
    with added names are replaced.
    """
    spark = df.sparkSession
    df = df.drop("source_size", "target", "copies")
    sizes = {r["s"]: r["n"] for r in df.groupBy(F.col(source_col).alias("s")).agg(F.sum(size_col).alias("n")).collect()}
    wanted = targets(sizes, weights, most)
    names = T.StructType([T.StructField("_s", T.StringType()), T.StructField("_rank", T.IntegerType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())])
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    listed = spark.createDataFrame([(s, i, int(sizes[s]), float(wanted[s])) for i, s in enumerate(order)], names)
    rows = df.join(listed, F.col(source_col).eqNullSafe(F.col("_s"))).drop("_s")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    blocks = max(1, -(-df.count() // BLOCK_ROWS))
    key = F.xxhash64(F.col(id_col).cast("string"), *[c for c, kind in sorted(df.dtypes) if c != id_col and "map<" not in kind], F.lit(seed))
    rows = rows.withColumns(
        {
            "_order": F.xxhash64(key, F.lit("order")),
            "_block": F.pmod(key, F.lit(blocks)),
            "_whole": F.when(F.col(size_col) > 0, F.floor(share)).otherwise(0).cast("int"),
            "_part": F.when(F.col(size_col) > 0, share - F.floor(share)).otherwise(0.0),
            "_size": F.col(size_col).cast("long"),
            "_open": F.lit(False),
        }
    )
    last = blocks == 1
    rounded = rows.groupBy("_block").applyInPandas(_rounder(last), rows.schema)
    if not last:
        rounded = materialise(rounded, "mix_blocks")
        waiting = rounded.filter("_open").select("_rank", "_block", "_order", "_part", "_size", "_open", F.col("_block").alias("_node"))
        decided = None
        while True:
            blocks = -(-blocks // FAN_IN)
            step = waiting.withColumn("_node", F.floor(F.col("_node") / FAN_IN).cast("long"))
            step = step.groupBy("_rank", "_node").applyInPandas(_rounder(blocks == 1), step.schema)
            if blocks > 1:
                step = materialise(step, "mix_tree")
            closed = step.filter("not _open").select("_rank", "_block", F.col("_part").alias("_final"))
            decided = closed if decided is None else decided.unionByName(closed)
            if blocks == 1:
                break
            waiting = step.filter("_open")
        settled = rounded.filter("not _open").withColumn("_final", F.col("_part"))
        rounded = settled.unionByName(rounded.filter("_open").join(decided, ["_rank", "_block"]))
    else:
        rounded = rounded.withColumn("_final", F.col("_part"))
    out = rounded.withColumn("copies", F.col("_whole") + F.round("_final").cast("int"))
    return out.select(*df.columns, "source_size", "target", "copies")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The digest of ``docs``: doc_id, size, source_size, target, taken."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("salt"))
    got = mix(materialise(rows, "mix_sizes"))
    return got.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
