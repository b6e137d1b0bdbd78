"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

A component of a vector is a term. Each group of candidates is an inverted index, from a term to
the candidates in which it isn't zero and their weights. Each query's terms are taken one at a
time: their weighted postings are added into a dense array of scores, from which partition
selection takes the best; the groups' best are merged by a window over each query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._blocks import distinct_queries, finite, padded, search_blocks
from corpusloom.llm._store import materialise

#: Queries whose score arrays are held at once.
BATCH = 64


def accumulate(postings: list[tuple[np.ndarray | None, np.ndarray]], weights: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Adds to ``scores`` (queries x candidates) each term's postings by the queries' weights;
    the places of a term in every candidate are None."""
    for term, (at, held) in enumerate(postings):
        rows = np.flatnonzero(weights[:, term])
        if not len(rows) or not len(held):
            continue
        part = weights[rows, term][:, None] * held
        if at is None and len(rows) == len(weights):
            scores += part
        elif at is None:
            scores[rows] += part
        else:
            scores[np.ix_(rows, at)] += part
    return scores


def best_places(scores: np.ndarray, out: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of the ``k`` largest of each row of ``scores`` but for those that are ``out``, ties to the
    smaller place: partition selection of the k-th score, then of what reaches it by (score, place)."""
    rows, places = [], []
    for i, own in enumerate(scores):
        there = np.flatnonzero(~out[i])
        own = own[there]
        if len(own) > k:
            reach = np.flatnonzero(own >= np.partition(own, len(own) - k)[len(own) - k])
            there, own = there[reach], own[reach]
        order = np.lexsort((-there, own))[-k:]
        rows.append(np.full(len(order), i))
        places.append(there[order])
    return np.concatenate(rows), np.concatenate(places)


def invert(matrix: np.ndarray) -> list[tuple[np.ndarray | None, np.ndarray]]:
    out = []
    for column in matrix.T:
        at = np.flatnonzero(column)
        out.append((None, np.ascontiguousarray(column)) if len(at) * 2 > len(column) else (at, column[at]))
    return out


def top_k(df: DataFrame, *, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` largest integer inner
    products, ties to the smaller vec_id; all candidates, if fewer.

    Components become floor(``scale`` * x). Queries are the rows whose id is divisible by
    ``every``, against every row of another id. Rows with a null id or vector or with a null or
    non-finite component take no part; missing components of shorter vectors are zero. Rows that
    repeat an id are one query but each a candidate. A component whose integer, or a best score that, is beyond
    64 bits raises an error; sums on the way may be larger. An empty table gives an empty result. Other columns are ignored.
    """
    vector = F.col(vector_col)

    def whole(x):
        value = x.cast("double") * scale
        return F.when(F.abs(value) < 2.0**63, F.floor(value)).otherwise(F.raise_error(F.lit("a component is beyond 64 bits")).cast("long"))

    rows = df.filter(F.col(id_col).isNotNull() & finite(vector)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(vector, whole).alias("vector")
    )
    rows = materialise(rows, "topk_vectors")
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 1

    def best(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        ids = candidates["vec_id"].to_numpy()
        matrix, asked = padded(candidates["vector"], width, np.int64), padded(queries["vector"], width, np.int64)
        most = lambda x: max(abs(int(x.min(initial=0))), int(x.max(initial=0)))
        bound = most(matrix) * most(asked) * width
        if bound < 1 << 31:
            matrix, asked = matrix.astype(np.int32), asked.astype(np.int32)
        elif bound >= 1 << 63:  # sums may not fit: Python's integers do
            matrix, asked = matrix.astype(object), asked.astype(object)
        postings, n, found = invert(matrix), len(ids), []
        wanted = queries["vec_id"].to_numpy()
        for at in range(0, len(asked), BATCH):
            scores = accumulate(postings, asked[at : at + BATCH], np.zeros((len(asked[at : at + BATCH]), n), asked.dtype))
            row, col = best_places(scores, wanted[at : at + BATCH, None] == ids, k)
            top = scores[row, col]
            if len(top) and max(abs(int(x)) for x in (top.min(), top.max())) >= 1 << 63:
                raise OverflowError("a score is beyond 64 bits")
            found.append(pd.DataFrame({"query_id": wanted[at : at + BATCH][row], "vec_id": ids[col], "score": top.astype(np.int64)}))
        return pd.concat(found, ignore_index=True)

    return search_blocks(rows, distinct_queries(rows, every), best, k, True, "long")
