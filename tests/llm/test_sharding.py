import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import sharding as S
from corpusloom.llm._store import materialise


def check(rows, n):
    by = {}
    for r in rows:
        assert 0 <= r.shard < n and r.law == "bytes" and r.grown_shard is None
        by.setdefault(r.shard, []).append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return {s: sum(r.size for r in own) for s, own in by.items()}


def test_edges(edges, nothing):
    out = S.shard_documents(edges).collect()
    check(out, 24)
    want = sorted((str(r.doc_id), len((r.text or "").encode()) + 8, None if r.text is None else zlib.crc32(r.text.encode())) for r in edges.collect())
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in out) == want
    assert S.shard_documents(nothing).count() == 0


def test_sizes_are_near_equal_and_small_groups_stay_whole(spark):
    rows = [(i, f"text {i // 3} " * (1 + i // 3 % 7)) for i in range(9000)] + [(10_000 + i, "hot text " * 5) for i in range(4500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = S.shard_documents(df, 8)
    sizes = check(out.collect(), 8)
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and max(abs(s - mean) for s in sizes.values()) <= 0.03 * mean
    split = out.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count()
    assert split <= 1  # the hot one
    again = sorted((r.doc_id, r.shard, r.slot) for r in S.shard_documents(df.repartition(3), 8).collect())
    assert again == sorted((r.doc_id, r.shard, r.slot) for r in out.collect())


@pytest.mark.parametrize("n", [1, 2, 5])
def test_splitters_against_a_sort(spark, n):
    df = spark.createDataFrame([(i, "t" * (i % 90)) for i in range(700)], "doc_id long, text string")
    rows = materialise(S.with_keys(df).select("doc_id", "size", "_h", "_r"), "t")
    order = sorted(((r._h, r._r), r.size) for r in rows.collect())
    total, share = sum(s for _, s in order), sum(s for _, s in order) / n
    for k, splitter in enumerate(S.find_splitters(rows, n, 0.0, 0.0), 1):
        below = sum(s for key, s in order if key < splitter)
        best, run = total, 0
        for _, s in order:
            best = min(best, abs(run - k * share))
            run += s
        assert abs(below - k * share) <= best + 1e-9


def test_clashing_columns_pass_or_are_replaced(edges):
    rows = materialise(S.with_keys(edges), "clash")
    out = S.shard_rows(rows, 3)
    assert out.columns.count("shard") == 1 and {r.copies for r in out.collect()} == {"clash"}
    check(out.collect(), 3)


def test_rows_that_repeat_are_parted(spark):
    """One row 300 times and 300 others: shards are near equal all the same."""
    rows = [(1, "the same text")] * 300 + [(i, f"text {i:8}") for i in range(2, 302)]
    out = S.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    size = Counter()
    for r in out:
        size[r.shard] += r.size
    assert len(size) == 24 and max(size.values()) - min(size.values()) <= 3 * 21
    for shard in size:
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
