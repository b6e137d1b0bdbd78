import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import near_dedup as N
from corpusloom.llm._components import components


def brute(docs):
    """(n_shingles, component) of each row by comparing all pairs."""
    sets = []
    for _, text in docs:
        w = [x for x in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if x]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(len(s), least.get(root(i)) if docs[i][0] is not None else None) for i, s in enumerate(sets)]


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(df).collect()), key=str)
    want = sorted(((d is None, d, n, c, d is None or d == c) for (d, _), (n, c) in zip(docs, brute(docs), strict=True)), key=str)
    assert got == want


def test_edges(spark, edges, nothing):
    check(spark, [(r.doc_id, r.text) for r in edges.collect()])
    assert N.near_duplicates(nothing).count() == 0
    assert N.near_duplicates(edges.filter("doc_id in (3, 4, 5)")).filter("kept and n_shingles = 0").count() == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_near_copies(spark, monkeypatch, seed):
    """A dense group of edited copies, chains, and documents that share a passage."""
    monkeypatch.setattr(N, "DENSE", 6)
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    base = [word() for _ in range(80)]
    docs = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(80)] = word()
        docs.append((1000 - i, " ".join(w)))
    chain = [word() for _ in range(100)]
    for i in range(12):
        docs.append((2000 + i, " ".join(chain[3 * i : 3 * i + 60])))
    passage = [word() for _ in range(40)]
    docs += [(3000 + i, " ".join([*passage, *[word() for _ in range(40)]])) for i in range(30)]
    docs += [(4000 + i, " ".join(word() for _ in range(30))) for i in range(30)]
    rng.shuffle(docs)
    check(spark, docs)


def test_planted_table(spark, documents):
    check(spark, [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])


def test_threshold_is_exact(spark):
    w = [f"x{i}" for i in range(304)]
    same = " ".join(w)  # 300 shingles
    at = " ".join(w[:229])  # 225 of 300: 75 %
    below = " ".join(w[:228])
    out = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame([(1, same), (2, at)], "doc_id long, text string")).collect()}
    assert out == {1: 1, 2: 1}
    out = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame([(1, same), (2, below)], "doc_id long, text string")).collect()}
    assert out == {1: 1, 2: 2}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    assert got == {i: root(i) for i in list(up) if any(i in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_result_has_one_row_for_each_document(documents):
    assert N.near_duplicates(documents).select(F.count("*"), F.countDistinct("doc_id")).first() == (documents.count(), documents.count())
