import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import mixing as M


def test_targets():
    assert M.targets({"a": 10, "b": 10, None: 10}) == pytest.approx({"a": 5, "b": 10, None: 15})
    got = M.targets({"a": 100, "b": 100, "c": 10, "d": 100})
    assert got["c"] == 30 and sum(got.values()) == pytest.approx(310) and got["b"] == pytest.approx(2 * got["a"]) and got["d"] == pytest.approx(got["a"])
    assert M.targets({"a": 0}) == {"a": 0} and M.targets({}) == {}
    # by code point: capitals first, null last
    assert M.targets({"a": 60, "B": 60, None: 60})["B"] == pytest.approx(30)


def test_pivots_keep_mass_and_expectation():
    rng = np.random.default_rng(1)
    size, part = rng.integers(1, 50, 40).astype(float), rng.random(40)
    total = np.zeros(40)
    for _ in range(3000):
        got, held = M.round_pivotal(size, part, rng.random(40))
        whole = np.isclose(got, 0) | np.isclose(got, 1)
        assert whole.sum() >= 39 and (held < 0) == whole.all()
        assert (got * size).sum() == pytest.approx((part * size).sum())
        total += got
    assert np.abs(total / 3000 - part).max() < 0.05


def test_draws_keep_expectations():
    """Through what sorts and draws in a block: a large document is taken as often as small ones."""
    rng, taken = np.random.default_rng(4), {90: [], 50: [], 20: []}
    size = np.array([90] + [50] * 4 + [20] * 6)
    rounded = M._rounder(True)
    for _ in range(3000):
        block = pd.DataFrame({"_rank": 0, "_size": size, "_order": rng.integers(-(1 << 63), 1 << 63, len(size)), "_part": 0.37, "_open": False})
        got = rounded(block)
        for n in taken:
            taken[n] += got.loc[got["_size"] == n, "_part"].tolist()
    for n, x in taken.items():
        assert abs(np.mean(x) - 0.37) < (0.05 if n == 20 else 0.02), n  # a small one is left at the end, and goes to the nearer side
    same = M.draws(np.full(1000, 7))
    assert len(set(same)) == 1000 and abs(same.mean() - 0.5) < 0.05


def test_rows_alike_in_id_spread_over_blocks(spark):
    rows = [(None, "a", 10, str(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, other string")
    old, M.BLOCK_ROWS = M.BLOCK_ROWS, 100
    try:
        got = M.mix(df).collect()
    finally:
        M.BLOCK_ROWS = old
    assert sum(r.copies for r in got) == 2000


def mixed(spark, rows, blocks=40, **options):
    old, M.BLOCK_ROWS = M.BLOCK_ROWS, blocks
    try:
        df = spark.createDataFrame(rows, "doc_id long, source string, size long, copies string")
        return M.mix(df, **options).collect()
    finally:
        M.BLOCK_ROWS = old


def test_words_come_near_their_targets(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot"] * 6 + ["b", "c", None]), rng.choice([0, 1, 7, 100, 400]), "clash") for i in range(3000)]
    first = mixed(spark, rows)
    assert len(first) == 3000
    by = {}
    for r in first:
        assert 0 <= r.copies <= 3 and (r.size or r.copies == 0)
        by.setdefault(r.source, []).append(r)
    for own in by.values():
        assert own[0].source_size == sum(r.size for r in own)
        assert abs(sum(r.size * r.copies for r in own) - own[0].target) <= 400
    again = mixed(spark, rows[::-1])
    assert sorted((r.doc_id, r.copies) for r in first) == sorted((r.doc_id, r.copies) for r in again)


def test_a_tree_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(M, "FAN_IN", 3)
    rows = [(i, "a" if i % 3 else "b", 10 + i % 5, "x") for i in range(600)]
    got = mixed(spark, rows, blocks=20)
    for s in ("a", "b"):
        own = [r for r in got if r.source == s]
        assert abs(sum(r.size * r.copies for r in own) - own[0].target) <= 15


def test_edges(edges, nothing, spark):
    out = M.mixed_documents(edges).collect()
    assert len(out) == edges.count() and sum(r.size for r in out if r.doc_id == 2) == 14
    assert {r.size for r in out if r.doc_id in (3, 4, 5)} == {0}
    assert M.mixed_documents(nothing).count() == 0
    clash = M.mix(edges.withColumn("size", F.lit(5).cast("long")))
    assert clash.count() == edges.count() and clash.columns.count("target") == 1 and {r.shard for r in clash.collect()} == {"clash"}
    blank = M.mixed_documents(edges.filter("doc_id in (3, 4)"))
    assert {(r.taken, r.target) for r in blank.collect()} == {(0, 0.0)}


def test_word_count(spark):
    text = "a\x0bb\xa0c d \t\x1c e"
    df = spark.createDataFrame([(text,), (None,), ("",), ("  ",)], "t string")
    assert [r[0] for r in df.select(M.word_count(F.col("t"))).collect()] == [len(text.encode().split()), 0, 0, 0]
