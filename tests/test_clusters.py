import math
import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from corpusloom.operators import clustering as C
from corpusloom.operators import features as X
from corpusloom.operators import tfidf
from corpusloom.plans import taxonomy


@pytest.mark.parametrize(("n", "ks"), [(2, [2]), (3, [2]), (4, [2, 3]), (20, list(range(10, 20))), (31, [30]), (500, [30]), (1000, list(range(30, 41))), (2250, list(range(30, 91, 5)))])
def test_candidates(n, ks):
    assert C.k_candidates(n) == ks


def blobs(spark, n=90):
    rng = random.Random(1)
    rows = [(f"t{i:03}", [rng.gauss(10 * (i % 3), 0.3), rng.gauss(0, 0.3)], i % 3, float(i % 4)) for i in range(n)]
    return spark.createDataFrame(rows, "ticket_id string, x array<double>, cluster_id int, hours double").cache(), rows


def test_silhouette_against_plain_python(spark):
    rng = random.Random(2)
    rows = [(f"t{i}", [rng.random(), rng.random()], min(i % 5, 3) if i else 9) for i in range(60)]
    df = spark.createDataFrame(rows, "ticket_id string, x array<double>, cluster_id int")
    total = 0.0
    for i, (_, x, c) in enumerate(rows):
        far = {}
        for j, (_, y, d) in enumerate(rows):
            if i != j:
                far.setdefault(d, []).append(math.dist(x, y))
        if c in far:
            a = sum(far[c]) / len(far[c])
            b = min(sum(v) / len(v) for k, v in far.items() if k != c)
            total += (b - a) / max(a, b)
    assert C.silhouette(df) == pytest.approx(total / len(rows))
    assert C.silhouette(df.withColumn("cluster_id", F.lit(1))) == -1
    assert -1 <= C.silhouette(df, sample=20) <= 1


def test_kmeans_and_choice_of_k(spark):
    df, rows = blobs(spark)
    k, scores = C.choose_k(df.drop("cluster_id"), candidates=[2, 3, 5], starts=2)
    assert k == 3 and set(scores) == {2, 3, 5}
    labels, centres, cost = C.kmeans(df, 3, starts=2)
    pairs = labels.withColumnRenamed("cluster_id", "a").join(df.select("ticket_id", F.col("cluster_id").alias("b")), "ticket_id")
    assert C.agreement(pairs).first()[0] == pytest.approx(1) and len(centres) == 3 and cost < 60
    assert C.choose_k(df.drop("cluster_id"), fixed_k=4, starts=1)[0] == 4


def test_agreement_against_plain_python(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(3), rng.randrange(4)) for _ in range(80)]
    same = lambda i: [p[i] for p in pairs]
    n, both, sa, sb = len(pairs), 0, 0, 0
    for i in range(n):
        for j in range(i):
            a, b = same(0)[i] == same(0)[j], same(1)[i] == same(1)[j]
            both, sa, sb = both + (a and b), sa + a, sb + b
    expected = sa * sb / (n * (n - 1) / 2)
    want = (both - expected) / ((sa + sb) / 2 - expected)
    assert C.agreement(spark.createDataFrame(pairs, "a int, b int")).first()[0] == pytest.approx(want)
    assert C.agreement(spark.createDataFrame([(1, 1)] * 4, "a int, b int")).first()[0] == 1


def test_members_totals_and_coverage(spark):
    df, rows = blobs(spark)
    centres = C.centroids(df)
    got = C.sample_members(df, centres, nearest=3, diverse=2).collect()
    centre = {r.cluster_id: r.centre for r in centres.collect()}
    for c in range(3):
        own = sorted((r for r in got if r.cluster_id == c), key=lambda r: r.place)
        want = sorted((math.dist(x, centre[c]), t) for t, x, k, _ in rows if k == c)
        assert [r.ticket_id for r in own[:3]] == [t for _, t in want[:3]] and [r.place for r in own] == [1, 2, 3, 4, 5]
        assert not {r.ticket_id for r in own[3:]} & {t for _, t in want[:3]}
    few = C.sample_members(df.limit(2), centres, nearest=3, diverse=2)
    assert few.count() == 2
    totals = {r.cluster_id: r for r in C.cluster_totals(df, 1000.0, 4).collect()}
    assert totals[3].n_tickets == 0 and not totals[3].big_enough and totals[0].n_tickets == 30 and totals[0].big_enough
    assert totals[0].hours_frac == round(totals[0].hours / 1000, 4)
    cover = C.coverage(spark.createDataFrame([(10.0, True), (5.0, False)], "hours double, qualifies boolean"), 40.0).first()
    assert tuple(cover) == (0.25, 10.0, 40.0, 1, 2)
    assert C.coverage(spark.createDataFrame([], "hours double, qualifies boolean"), 0.0).first()[0] == 0


def test_tfidf(spark):
    rows = [("1", "Storing", "VPN"), ("2", "Storing", "vpn"), ("3", "Vraag", "mail"), ("4", "Vraag", "rare"), ("5", None, "Overig"), ("6", "Storing", "mail")]
    df = spark.createDataFrame(rows, "ticket_id string, issue_type string, sub_issue_type string")
    block, vocabulary = tfidf.label_block(df)
    assert vocabulary == ["issue=incident", "issue=question", "sub=email", "sub=vpn"]
    idf = lambda n: math.log(7 / (1 + n)) + 1
    got = {r.ticket_id: r.cat for r in block.collect()}
    a, b = idf(3), idf(2)
    assert got["1"] == pytest.approx({"issue=incident": a / math.hypot(a, b), "sub=vpn": b / math.hypot(a, b)})
    assert got["4"] == pytest.approx({"issue=question": 1.0}) and got["5"] == {}
    with pytest.raises(ValueError, match="often enough"):
        tfidf.label_block(df.limit(1))


def test_combine(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0], [1.0]), ([0.0, 0.0], [0.0, 0.0], [0.0])], "title array<double>, description array<double>, notes array<double>")
    blocks = {n: X.unit(F.col(n)) for n in ("title", "description", "notes")}
    got = [r[0] for r in df.select(X.combine((0.3, 0.0, 1.0, 0.0), blocks)).collect()]
    n = math.hypot(0.3, 1)
    assert got[0] == pytest.approx([0.18 / n, 0.24 / n, 1 / n]) and got[1] == [0.0, 0.0, 0.0]
    with pytest.raises(ValueError, match="zero"):
        X.combine((0, 0, 0, 0), blocks)


def test_batches(spark):
    rng = random.Random(4)
    for sizes in ([6000] * 500, [300_000], [], [1] * 300, [rng.randrange(1, 90_000) for _ in range(200)]):
        got = list(X.batches(sizes))
        assert [i for a, b in got for i in range(a, b)] == list(range(len(sizes)))
        assert all(b - a <= 128 and (sum(sizes[a:b]) <= 250_000 or b - a == 1) for a, b in got)
        numbers = spark.createDataFrame([(sizes,)], "x array<int>").select(X.batch_numbers(F.col("x"))).first()[0]
        assert numbers == [i for i, (a, b) in enumerate(got) for _ in range(a, b)]
    assert len(list(X.batches([6000] * 500))) == 13


class Letters:
    def encode(self, text):
        return [ord(c) for c in text]

    def decode(self, ids):
        return "".join(map(chr, ids))


def test_inputs_are_cut_by_tokens(spark):
    df = spark.createDataFrame([("abc",), ("x" * 30_000,), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(X.prepare_with(Letters())(F.col("t"))).collect()]
    assert [(len(x.text), x.size) for x in got] == [(3, 3), (8000, 8000), (0, 0), (0, 0)]


class Picky(X.StubEmbedder):
    def embed(self, keys, texts):
        if len(keys) > 3:
            raise X.RequestTooLarge
        return super().embed(keys, texts)


def test_embeddings_are_cached_by_text_and_model(spark):
    rows = spark.createDataFrame([("1", "a"), ("2", " "), ("3", "c")], "ticket_id string, title string").cache()
    none = spark.createDataFrame([], X.CACHE_SCHEMA)
    provider = X.StubEmbedder(4)
    first = X.embed_missing(rows, none, "title", provider).cache()
    assert {r.ticket_id for r in first.collect()} == {"1", "3"}
    assert X.embed_missing(rows, first, "title", provider).count() == 0
    changed = rows.withColumn("title", F.when(F.col("ticket_id") == "3", "new").otherwise(F.col("title")))
    assert [r.ticket_id for r in X.embed_missing(changed, first, "title", provider).collect()] == ["3"]
    assert X.embed_missing(rows, first, "title", X.StubEmbedder(4, "other")).count() == 2
    got = {r.ticket_id: r.title for r in X.embedded(changed, first, "title", provider).collect()}
    assert got["2"] == got["3"] == [0.0] * 4 and np.linalg.norm(got["1"]) == pytest.approx(1)
    split = X.embed_with_split(Picky(4), [str(i) for i in range(10)], ["t"] * 10)
    assert np.allclose(split, X.StubEmbedder(4).embed([str(i) for i in range(10)], ["t"] * 10))
    with pytest.raises(X.RequestTooLarge):
        X.embed_with_split(type("Never", (Picky,), {"embed": lambda *a: (_ for _ in ()).throw(X.RequestTooLarge)})(4), ["1"], ["t"])


def scattered(spark, n=400, width=12):
    rng = np.random.default_rng(4)
    return spark.createDataFrame([(f"t{i:03}", rng.normal(size=width).tolist()) for i in range(n)], "ticket_id string, x array<double>").cache()


def test_kmeans_is_that_of_spark(spark):
    rows = scattered(spark)
    model = KMeans(k=5, seed=C.S.KMEANS_SEED * 1000, maxIter=300).fit(rows.select(array_to_vector("x").alias("features")))
    labels, centres, cost = C.kmeans(rows, 5, starts=1)
    np.testing.assert_allclose(centres, model.clusterCenters(), rtol=1e-9)
    assert cost == pytest.approx(model.summary.trainingCost)
    want = model.setPredictionCol("cluster_id").transform(rows.select("ticket_id", array_to_vector("x").alias("features"))).select("ticket_id", "cluster_id")
    assert sorted(map(tuple, labels.collect())) == sorted(map(tuple, want.collect()))


def test_starts_share_passes(spark, monkeypatch):
    rows, context = scattered(spark), spark.sparkContext
    begun = C.seeds(rows, [(5, i) for i in range(6)])

    def jobs(starts):
        monkeypatch.setattr(C, "seeds", lambda rows, wanted: [begun[seed % 1000] for _, seed in wanted])
        name = f"passes of {starts}"
        context.setJobGroup(name, "")
        try:
            C.kmeans(rows, 5, starts=starts)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        return len(context.statusTracker().getJobIdsForGroup(name))

    one, six = jobs(1), jobs(6)
    alone = [C.lloyd(p := C.packed(rows), [C.Start(c)]) for c in begun]
    assert p.unpersist() is p and 2 < one <= six < 4 * one
    for a, b in zip((a for (a,) in alone), C.lloyd(C.packed(rows), [C.Start(c) for c in begun]), strict=True):
        np.testing.assert_allclose(a[0], b[0], rtol=1e-9)


def test_combinations_share_passes(spark, monkeypatch):
    parts = {n: X.unit(F.slice("x", 1 + 3 * i, 3)).alias(n) for i, n in enumerate(C.S.WEIGHT_ORDER)}
    names = ["labels_only", "notes_weighted"]
    blocks = scattered(spark).select("ticket_id", *parts.values()).cache()
    together = taxonomy.fit_together(blocks, names, [4, 5], 1)
    for name in names:
        own = C.fits(taxonomy.combined(blocks, C.S.COMBOS[name]).cache(), [(k, C.S.KMEANS_SEED) for k in (4, 5)], starts=1)
        for k, (centres, cost) in zip((4, 5), own, strict=True):
            np.testing.assert_allclose(together[name][k][0], centres, rtol=1e-9, atol=1e-12)
            assert together[name][k][1] == pytest.approx(cost)
    monkeypatch.setattr(C, "PASS_NUMBERS", 100)
    assert taxonomy.fit_together(blocks, names, [4, 5], 1) is None


def test_reseeds_share_passes(spark, monkeypatch):
    parts = {n: X.unit(F.slice("x", 1 + 3 * i, 3)).alias(n) for i, n in enumerate(C.S.WEIGHT_ORDER)}
    blocks, ran, lloyd = scattered(spark).select("ticket_id", *parts.values()).cache(), [], C.lloyd
    monkeypatch.setattr(C, "lloyd", lambda *a: ran.append(len(a[1])) or lloyd(*a))
    labels = C.kmeans(taxonomy.combined(blocks, C.S.COMBOS["all_equal"]).cache(), 3, starts=1)[0].cache()
    artifact = {"combo": "all_equal", "weights": dict(zip(C.S.WEIGHT_ORDER, C.S.COMBOS["all_equal"], strict=True)), "k": 3}
    got = taxonomy.stability(blocks, artifact, labels, starts=2)
    assert got["n_runs"] == 4 and len(got["pairwise_ari"]) == 6 and ran == [1, 6]
