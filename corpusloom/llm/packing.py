"""Vector best-fit packing of token sequences.

A piece demands tokens, one document and attention cost (the square of its tokens); a bin has a
capacity of each. Pieces are taken in decreasing order and each goes to the open bin that fits
it in every dimension and scores best: least weighted norm of what would be left ('norm') or
largest weighted dot product of demand and what is left ('dot'). Blocks of pieces are packed
side by side; each hands its emptiest bins to a tree of blocks, where their pieces are packed
anew, so that the number of poorly filled bins doesn't grow with the number of blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._store import materialise, small_batches
from corpusloom.llm._tokens import BYTE_BPE, tokenizer

#: Pieces of a block, blocks that a node of the tree combines, and bins that it may reopen.
BLOCK_ROWS, FAN_IN, REOPENED = 16_384, 64, 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be shorter than ``most``."""
    first = n % most or min(n, most)
    return [(0, first)] + [(s, most) for s in range(first, n, most)]


def pieces(docs: DataFrame, capacity: int = 1024, end_id: int = 2, tokenizer_path: str = BYTE_BPE) -> DataFrame:
    """Token pieces of whole texts of ``docs`` (doc_id, text): null texts are as empty ones,
    whose only token is the end. Texts of any length are cut into as many pieces as they need. Repeated rows
    and null ids give pieces of their own each; an empty table gives none, and other columns are left out."""
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(tokenizer_path)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = tok.ids(text.as_py() or "") + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((doc, k, start, length, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])))
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(made, PIECES)


def best_fit(lengths: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, float, float], score: str = "norm") -> np.ndarray:
    """The bin of each piece; ``lengths`` are in decreasing order and fit an empty bin."""
    full = np.array(capacity, np.float64)
    weight = np.array(weights, np.float64)[:, None] / full[:, None]
    left = np.empty((3, max(64, len(lengths))))
    number = np.empty(left.shape[1], np.int64)
    least = lengths[-1] if len(lengths) else 0
    out, opened, bins = np.empty(len(lengths), np.int64), 0, 0
    for i, n in enumerate(lengths.tolist()):
        need = np.array([n, 1.0, float(n) * n])
        rest = left[:, :opened] - need[:, None]
        fits = np.flatnonzero((rest >= 0).all(axis=0))
        if len(fits):
            if score == "dot":
                at = fits[np.argmax((weight * (need / full)[:, None] * left[:, fits]).sum(axis=0))]
            else:
                at = fits[np.argmin(((weight * rest[:, fits]) ** 2).sum(axis=0))]
        else:
            at, opened = opened, opened + 1
            left[:, at], number[at], bins = full, bins, bins + 1
        left[:, at] -= need
        out[i] = number[at]
        if left[0, at] < least or left[1, at] < 1 or left[2, at] < least * least:  # nothing else fits
            opened -= 1
            left[:, at], number[at] = left[:, opened], number[opened]
    return out


def pack(rows: DataFrame, *, capacity: int = 1024, most_documents: int | None = None, most_attention: int | None = None, weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3), score: str = "norm", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` (with ``length``, 1 to ``capacity``) and their ``sequence_id`` and ``offset``.

    ``most_documents`` bounds the pieces of a sequence and ``most_attention`` the sum of their
    squared lengths; None lets the tokens alone decide. A piece that no empty bin could take
    raises an error. Other columns pass through; those with the added names are replaced.
    An empty table gives an empty result. Pieces of one length go in the order of the table, and of bins that
    fit as well the first found is taken; repeated rows are packed each. ``rows`` must not be recomputed differently: pass a
    table that has been written.
    """
    limits = (float(capacity), float(most_documents or capacity), float(most_attention or capacity * capacity))
    kept = rows.drop("sequence_id", "offset")
    blocks = max(1, -(-kept.count() // block_rows))
    kept = kept.withColumn("_uid", F.monotonically_increasing_id())
    kept = kept.withColumns({"_node": F.pmod(F.xxhash64("_uid"), F.lit(blocks)), "sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long"), "_open": F.lit(False)})

    def packer(level: int, last: bool):
        def packed(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(["length", "_uid"], ascending=[False, True], kind="stable").reset_index(drop=True)
            n = group["length"].to_numpy()
            if len(n) and (n[0] > limits[0] or n[0] * n[0] > limits[2]):
                raise ValueError(f"a piece of {n[0]} tokens fits no sequence")
            at = best_fit(n, limits, weights, score)
            order = np.argsort(at, kind="stable")
            before = np.cumsum(n[order]) - n[order]
            starts = np.r_[0, np.flatnonzero(np.diff(at[order])) + 1] if len(n) else np.zeros(0, int)
            offset = np.empty(len(n), np.int64)
            offset[order] = before - np.repeat(before[starts], np.diff(np.r_[starts, len(n)]))
            open_ = np.zeros(len(n), bool)
            if not last:
                fill = np.bincount(at, weights=n)
                emptiest = np.argsort(fill, kind="stable")[:REOPENED]
                open_ = np.isin(at, emptiest[fill[emptiest] < 0.99 * capacity])
            # level, node and bin, each in its own bits
            number = (level << 58) | (int(group["_node"].iloc[0]) << 24)
            return group.assign(sequence_id=number + at, offset=offset, _open=open_)

        return packed

    level, waiting, closed = 0, kept, []
    while True:
        last = blocks == 1
        got = materialise(waiting.groupBy("_node").applyInPandas(packer(level, last), waiting.schema), f"pack_{level}")
        closed.append(got.filter("not _open"))
        if last:
            break
        blocks, level = -(-blocks // FAN_IN), level + 1
        waiting = got.filter("_open").withColumn("_node", F.floor(F.col("_node") / FAN_IN).cast("long"))
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return out.drop("_uid", "_node", "_open")


def pack_documents(docs: DataFrame, capacity: int = 1024) -> DataFrame:
    """The pieces of ``docs`` and their places: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. What pieces() and pack() say of nulls, long texts, ties, repeated rows, empty
    tables and other columns holds here; a column of ``docs`` with an added name is not read."""
    return pack(materialise(pieces(docs, capacity), "pieces"), capacity=capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
