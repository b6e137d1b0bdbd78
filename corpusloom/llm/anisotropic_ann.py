"""Approximate nearest neighbours by score-aware (anisotropic) product quantisation.

A vector's error along its own direction changes the inner products of the queries that matter
most, so it is penalised ``ETA`` times as much as error across it. Codebooks of 16 centres for
each pair of components are fitted by alternating assignment and least squares under that loss.
Every row is stored as four-bit codes. A search reads inner products of the codes from tables,
turns them into distances with exact norms, and ranks the best of each group again by exact
distance on the original vectors. Then those rows are ranked again whose codes leave a chance that they are nearer
than the k-th: what is left of a row by its code changes the product with a query by a number that spreads
about as |query| |rest| / sqrt(width), and ``SPREADS`` of these are allowed for. So the number that is ranked again
follows from the data, also where very many rows have near codes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._blocks import distinct_queries, finite, group_count, padded, search_blocks, top_by_key
from corpusloom.llm._store import materialise

#: Components of a subspace, centres of a codebook (four bits), rows of the training sample.
SUB, CENTRES, SAMPLE = 2, 16, 10_000
#: Weight of parallel error; rows of all groups that are ranked again first for a query, dealt over the groups; queries scanned at once.
ETA, RERANK, BATCH = 4.0, 160, 64
#: Spreads of a code's error that are allowed for.
SPREADS = 3.0


def assign(x: np.ndarray, books: np.ndarray, eta: float = ETA, sweeps: int = 3) -> np.ndarray:
    """Codes (rows x subspaces) by coordinate descent of |r|^2 + (eta - 1) (r.x)^2 / |x|^2."""
    m = len(books)
    parts = x.reshape(len(x), m, SUB)
    pull = (eta - 1) / np.maximum((x * x).sum(axis=1), 1e-30)
    codes = np.stack([((parts[:, s, None] - books[s]) ** 2).sum(axis=2).argmin(axis=1) for s in range(m)], axis=1)
    along = np.stack([((parts[:, s] - books[s][codes[:, s]]) * parts[:, s]).sum(axis=1) for s in range(m)], axis=1)
    total = along.sum(axis=1)
    for _ in range(sweeps):
        for s in range(m):
            rest = parts[:, s, None] - books[s]
            own = (rest * parts[:, s, None]).sum(axis=2)
            loss = (rest**2).sum(axis=2) + pull[:, None] * ((total - along[:, s])[:, None] + own) ** 2
            codes[:, s] = loss.argmin(axis=1)
            new = np.take_along_axis(own, codes[:, s, None], axis=1)[:, 0]
            total += new - along[:, s]
            along[:, s] = new
    return codes.astype(np.uint8)


def fit(x: np.ndarray, eta: float = ETA, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Codebooks (subspaces x centres x components) for the rows of ``x``."""
    rng = np.random.default_rng(seed)
    m = x.shape[1] // SUB
    parts = x.reshape(len(x), m, SUB)
    books = np.stack([parts[rng.integers(0, len(x), CENTRES), s] for s in range(m)])
    pull = (eta - 1) / np.maximum((x * x).sum(axis=1), 1e-30)
    for _ in range(rounds):
        codes = assign(x, books, eta, 1)
        along = np.stack([((parts[:, s] - books[s][codes[:, s]]) * parts[:, s]).sum(axis=1) for s in range(m)], axis=1)
        total = along.sum(axis=1)
        for s in range(m):
            y, others = parts[:, s], total - along[:, s]
            left = np.eye(SUB) + pull[:, None, None] * y[:, :, None] * y[:, None, :]
            right = y + (pull * (others + (y * y).sum(axis=1)))[:, None] * y
            for c in np.unique(codes[:, s]):
                on = codes[:, s] == c
                books[s, c] = np.linalg.solve(left[on].sum(axis=0), right[on].sum(axis=0))
            new = ((y - books[s][codes[:, s]]) * y).sum(axis=1)
            total, along[:, s] = total + new - along[:, s], new
    return books


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows that take part."""
    vector = F.col(vector_col)
    ok = F.col(id_col).isNotNull() & finite(vector) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    return df.filter(ok).select(F.col(id_col).cast("long").alias("vec_id"), vector.cast("array<double>").alias("vector"))


def build_index(rows: DataFrame, sample: int = SAMPLE, eta: float = ETA) -> tuple[DataFrame, np.ndarray, int]:
    """Every row with its codes; the codebooks; the width. Codebooks are fitted on the
    ``sample`` rows with the least hash of vec_id."""
    width = rows.agg(F.max(F.size("vector"))).first()[0] or SUB
    width += -width % SUB
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("vector").limit(sample).toPandas()
    books = fit(padded(taken["vector"], width, np.float64), eta) if len(taken) else np.zeros((width // SUB, CENTRES, SUB))

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes = assign(padded(batch["vector"], width, np.float64), books, eta)
            codes = np.pad(codes, ((0, 0), (0, codes.shape[1] % 2)))
            yield batch.assign(codes=[c.tobytes() for c in codes[:, ::2] | codes[:, 1::2] << 4])

    return materialise(rows.mapInPandas(coded, "vec_id long, vector array<double>, codes binary"), "ann_index"), books, width


def _distances(x: np.ndarray, q: np.ndarray, unit: float) -> np.ndarray:
    """Euclidean distances in double precision; in units where squares would overflow."""
    with np.errstate(over="ignore"):
        far = np.sqrt(((x - q) ** 2).sum(axis=1))
    return far if np.isfinite(far).all() else np.sqrt(((x / unit - q / unit) ** 2).sum(axis=1)) * unit


def nearest(df: DataFrame, *, k: int = 10, every: int = 100, rerank: int = RERANK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` nearest found by Euclidean
    distance (score, in double precision on the original vectors), ties to the smaller vec_id;
    all candidates, if fewer.

    Queries are the rows whose id is divisible by ``every``, against every row of another id.
    Rows with a null id, with a null, empty or zero vector, or with a null or non-finite
    component take no part; missing components of shorter vectors are zero. Rows that repeat an
    id are one query but each a candidate. However many rows have equal or near codes, all that the
    bound leaves are ranked again. Components of any finite size are held; distances beyond double precision are infinite. An
    empty table gives an empty result. Other columns are ignored.
    """
    index, books, width = build_index(materialise(usable(df, id_col, vector_col), "ann_vectors"))

    groups = group_count(index)
    share = max(k, -(-rerank // groups))

    def best(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        ids, n = candidates["vec_id"].to_numpy(), len(candidates)
        x = padded(candidates["vector"], width, np.float64)
        packed = np.frombuffer(b"".join(candidates["codes"]), np.uint8).reshape(n, -1)
        codes = np.empty((2 * packed.shape[1], n), np.intp)
        codes[::2], codes[1::2] = (packed & 15).T, (packed >> 4).T
        wanted, asked = queries["vec_id"].to_numpy(), padded(queries["vector"], width, np.float64)
        unit = max(float(np.abs(x).max(initial=0)), float(np.abs(asked).max(initial=0)), 1e-300)  # else squares could overflow
        small, book = x / unit, books / unit
        half = ((small * small).sum(axis=1) / 2).astype(np.float32)
        rest = np.sqrt(((small - np.concatenate([book[s][codes[s]] for s in range(len(book))], axis=1)) ** 2).sum(axis=1))
        found = []
        for at in range(0, len(asked), BATCH):
            q, own = asked[at : at + BATCH], wanted[at : at + BATCH]
            table = np.einsum("qms,mcs->mqc", (q / unit).reshape(len(q), -1, SUB), book).astype(np.float32)
            score = np.repeat(-half[None], len(q), axis=0)
            for s in range(len(book)):
                score += table[s].take(codes[s], axis=1)
            out = own[:, None] == ids
            score[out] = -np.inf
            top = top_by_key(score, share)
            size = np.sqrt(((q / unit) ** 2).sum(axis=1))
            for i, there in enumerate(top):
                there = there[~out[i, there]]
                if len(there) < n - out[i].sum():
                    far = _distances(x[there], q[i], unit)
                    # half of the squared distance by the codes, and what it may miss
                    apart = size[i] ** 2 / 2 - score[i].astype(np.float64) - SPREADS * size[i] * rest / np.sqrt(width)
                    kth = np.partition(far, k - 1)[k - 1] / unit
                    there = np.union1d(there, np.flatnonzero((apart <= kth**2 / 2 * (1 + 1e-5) + 1e-6) & ~out[i]))
                far = _distances(x[there], q[i], unit)
                there, far = (a[np.lexsort((ids[there], far))[:k]] for a in (there, far))
                found.append((own[i], ids[there], far))
        return pd.DataFrame({"query_id": np.repeat([f[0] for f in found], [len(f[1]) for f in found]), "vec_id": np.concatenate([f[1] for f in found]), "score": np.concatenate([f[2] for f in found])})

    return search_blocks(index, distinct_queries(index, every), best, k, False, "double")
