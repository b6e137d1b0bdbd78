import math
import random

import numpy as np
import pytest

from corpusloom.llm import _blocks
from corpusloom.llm import anisotropic_ann as A
from corpusloom.llm import exact_topk as E

SCHEMA = "vec_id long, embedding array<float>, score string, vector string, codes string"


def table(spark, items):
    return spark.createDataFrame([(i, v, "clash", "clash", "clash") for i, v in items], SCHEMA)


def odd_rows(extra=()):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(230)]
    same = [0.5, -0.25] * 4
    rows += [(1000 + i, same) for i in range(60)]  # ties
    rows += [(300, None), (301, [1.0, None, 0.0]), (302, [float("nan")] * 8), (303, [math.inf, 0.0]), (None, same), (304, [0.0] * 8), (305, [1.0, 2.0]), (306, []), (7, [9.0] * 8), (400, [0.0, 3.0] + [0.0] * 6)]
    return [*rows, *extra]


def usable(rows, zero):
    ok = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v] + [0.0] * (8 - len(v))
        if zero or any(v):
            ok.append((i, v))
    return ok


def test_exact_top_k_against_brute_force(spark):
    rows = odd_rows()
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in usable(rows, True)]
    got = {}
    for r in E.top_k(table(spark, rows)).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    queries = {i: v for i, v in ok if i % 50 == 0}
    assert set(got) == set(queries)
    for q, v in queries.items():
        all_ = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ok if i != q))[:5]
        assert [got[q][k] for k in range(1, 6)] == [(i, -s) for s, i in all_]


def test_sparse_postings_and_whole_ones_agree():
    rng = np.random.default_rng(2)
    m = rng.integers(-9, 9, (50, 12)) * (rng.random((50, 12)) < 0.3)
    m[:, 0] = 1
    q = rng.integers(-9, 9, (7, 12)) * (rng.random((7, 12)) < 0.5)
    got = E.accumulate(E.invert(m), q, np.zeros((7, 50), np.int64))
    assert (got == q @ m.T).all()


def test_fewer_candidates_than_asked_for(spark):
    few = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (50, [0.0, 1.0])]
    assert sorted((r.query_id, r.rank, r.vec_id) for r in E.top_k(table(spark, few)).collect()) == [(0, 1, 1), (0, 2, 50), (50, 1, 0), (50, 2, 1)]
    assert A.nearest(table(spark, few)).count() == 2
    for fn in (E.top_k, A.nearest):
        assert fn(table(spark, [])).count() == 0
        assert fn(table(spark, [(0, [1.0])])).count() == 0
        assert fn(table(spark, [(1, [1.0]), (2, [2.0])])).count() == 0


def test_nearest_on_odd_rows_finds_all(spark):
    """Groups are smaller than what is ranked again, so the search is exact here."""
    rows = odd_rows([(2000, [0.5, -0.25] * 4)])
    ok = usable(rows, False)
    got = {}
    for r in A.nearest(table(spark, rows)).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    queries = {i: v for i, v in ok if i % 100 == 0}
    assert set(got) == set(queries)
    for q, v in queries.items():
        want = sorted((math.dist(v, w), i) for i, w in ok if i != q)[:10]
        assert [got[q][k][0] for k in range(1, 11)] == [i for _, i in want]
        assert np.allclose([got[q][k][1] for k in range(1, 11)], [d for d, _ in want], rtol=1e-12)


def test_recall_with_little_ranked_again(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 32)).astype(np.float32)
    df = table(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    hits = total = 0
    by = {}
    for r in A.nearest(df, rerank=40).collect():
        by.setdefault(r.query_id, set()).add(r.vec_id)
    for q, found in by.items():
        d = ((x.astype(float) - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(found & set(np.argsort(d, kind="stable")[:10].tolist()))
        total += 10
    assert len(by) == 30 and hits / total >= 0.9


def test_large_scores_and_components(spark):
    """Scores near 63 bits keep their order; beyond 64 bits is an error; sizes of components don't matter for distances."""
    rng = np.random.default_rng(8)
    x = rng.integers(-300_000, 300_000, (400, 16)).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    whole = [[256 * int(c) for c in v] for v in x]
    got = {}
    for r in E.top_k(table(spark, rows)).collect():
        got.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    for q in range(0, 400, 50):
        want = sorted((-sum(a * b for a, b in zip(whole[q], whole[i], strict=True)), i) for i in range(400) if i != q)[:5]
        assert [y[1:] for y in sorted(got[q])] == want
    big = [(0, [3e7] * 3), (1, [3e7] * 3), (2, [1.0, 1.0, 1.0])]
    assert [r.score for r in E.top_k(table(spark, big[::2])).collect()] == [3 * int(256 * 3e7) * 256]
    with pytest.raises(Exception, match="beyond 64 bits"):
        E.top_k(table(spark, [(0, [1e8] * 200), (1, [1e8] * 200)])).collect()
    with pytest.raises(Exception, match="beyond 64 bits"):
        E.top_k(table(spark, [(0, [1e30]), (1, [1.0])])).collect()
    near = {r.vec_id: r.score for r in A.nearest(table(spark, [(0, [1e20, 0.0]), (1, [2e20, 0.0]), (2, [-1e20, 1e20])])).collect()}
    assert near == pytest.approx({1: 1e20, 2: math.hypot(2e20, 1e20)}, rel=1e-6)


def test_codes_decide_what_is_ranked_again(spark, monkeypatch):
    """On rows without near copies most are never ranked exactly, and recall holds."""
    monkeypatch.setattr(_blocks, "LEAST_GROUPS", 1)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((6000, 64)).astype(np.float32)
    index, books, width = A.build_index(A.usable(table(spark, [(i, v.tolist()) for i, v in enumerate(x)])))
    q = x[0].astype(float)
    codes = np.stack([np.frombuffer(r.codes, np.uint8) for r in index.orderBy("vec_id").select("codes").collect()])
    each = np.empty((len(x), 2 * codes.shape[1]), int)
    each[:, ::2], each[:, 1::2] = codes & 15, codes >> 4
    centre = np.concatenate([books[s][each[:, s]] for s in range(len(books))], axis=1)
    d = ((x - q) ** 2).sum(axis=1)
    apart = (q @ q + (x.astype(float) ** 2).sum(axis=1)) / 2 - centre @ q - A.SPREADS * np.linalg.norm(q) * np.linalg.norm(x - centre, axis=1) / np.sqrt(width)
    again = apart <= np.sort(d)[10] / 2
    assert again.mean() < 0.25 and again[np.argsort(d)[1:11]].all()


def test_all_neighbours_are_found_among_near_copies(spark, monkeypatch):
    """A group of production size of which a third is near one vector."""
    monkeypatch.setattr(_blocks, "LEAST_GROUPS", 1)
    rng = np.random.default_rng(6)
    x = rng.standard_normal((_blocks.GROUP_ROWS, 32))
    x[rng.random(len(x)) < 1 / 3] = rng.standard_normal(32)
    x = (x + 0.001 * rng.standard_normal(x.shape)).astype(np.float32)
    by = {}
    for r in A.nearest(table(spark, [(i, v.tolist()) for i, v in enumerate(x)])).collect():
        by.setdefault(r.query_id, set()).add(r.vec_id)
    assert len(by) == 82
    for q, found in by.items():
        d = ((x.astype(float) - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        assert found == set(np.argsort(d, kind="stable")[:10].tolist())


def test_anisotropic_codes_keep_parallel_error_small():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((800, 16))

    def parallel(eta):
        books = A.fit(x, eta)
        codes = A.assign(x, books, eta)
        rest = x - np.concatenate([books[s][codes[:, s]] for s in range(len(books))], axis=1)
        return (((rest * x).sum(axis=1) ** 2) / (x * x).sum(axis=1)).mean(), (rest**2).sum(axis=1).mean()

    plain, aware = parallel(1.0), parallel(8.0)
    assert aware[0] < 0.7 * plain[0] and aware[1] < 2 * plain[1]
