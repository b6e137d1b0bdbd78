import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import attention_lm as L


def plain_base(docs):
    train = [d is None or zlib.crc32(str(d).encode()) % 7 != 2 for d, _ in docs]
    words = [[w for w in re.split(rb"[\x20\x09-\x0d]+", (t or "").encode().lower()) if w] + ["end"] for _, t in docs]
    c = Counter(w for own, on in zip(words, train, strict=True) if on for w in own)
    n, v = sum(c.values()), len(c)
    return [(not on, len(own), sum(c[w] > 0 for w in own), n, sum(np.log10((c[w] + 1) / (n + v + 1)) for w in own)) for own, on in zip(words, train, strict=True)]


def check_base(spark, docs, model):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    blocks = L.encoded(df, 20_000)
    own = model._replace(tokens=int(L.pair_counts(blocks)[:, model.layout.begins].sum()))
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in L.score(blocks, own).collect())
    want = sorted((str(d), *x[:4], round(x[4], 6)) for (d, _), x in zip(docs, plain_base(docs), strict=True))
    assert got == want


@pytest.fixture(scope="module")
def blocks(documents):
    return L.encoded(documents, 50_000)


@pytest.fixture(scope="module")
def model(blocks):
    return L.learn(blocks, 5000, 200)


def codes(texts):
    ids = [L.subwords(t) for t in texts]
    return L.laid_out(np.concatenate(ids), np.array([len(i) for i in ids]))


def test_base_against_plain_counts(spark, edges, documents, model):
    check_base(spark, [(r.doc_id, r.text) for r in edges.collect()], model)
    check_base(spark, [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], model)
    held = [d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2][:3]
    check_base(spark, [(d, "only held out") for d in held], model)


def plain_score(model, texts, train, i):
    """The score of text ``i``: each window on its own, sums over the whole vocabulary, counts in dictionaries."""
    w, where = model.weights, model.layout
    words = [t.encode().lower().split() + ["end"] for t in texts]
    c, context, continued = Counter(), Counter(), Counter()
    for own, on in zip(words, train, strict=True):
        for j, word in enumerate(own if on else ()):
            before = tuple((["begin", "begin"] + own)[j : j + 2])
            c[word] += 1
            context[before] += 1
            continued[(*before, word)] += 1
    y = codes([texts[i]])[0].astype(int)
    x = np.r_[0, y[:-1]]
    probs = np.zeros((len(y), L.CODES))
    start = 0
    while True:
        xs = x[start : start + L.WINDOW]
        e = w["emb"][xs] + w["pos"][: len(xs)]
        q, k, v = np.split(e @ w["qkv"], 3, axis=1)
        a = np.exp(q @ k.T / 4) * np.tri(len(xs))
        h = np.tanh(e @ w["own"] + (a / a.sum(axis=1, keepdims=True)) @ v @ w["mix"] + w["bias"])
        top, low = np.exp(h @ w["top"] + w["top0"]), np.exp(np.einsum("nw,cws->ncs", h, w["low"]) + w["low0"])
        each = (top / top.sum(axis=1, keepdims=True))[..., None] * low / low.sum(axis=2, keepdims=True)
        gate = 1 / (1 + np.exp(-(h @ w["gate"] + w["gate0"])))[:, None]
        net = np.zeros((len(xs), L.CODES))
        net[:, 1:] = each[:, where.cls[1:], where.slot[1:]]
        skip = L.CONTEXT if start else 0
        probs[start + skip : start + len(xs)] = (gate * model.pairs[xs] + (1 - gate) * net)[skip:]
        if start + L.WINDOW >= len(y):
            break
        start += L.WINDOW - L.CONTEXT
    begin = probs[:, where.begins].sum(axis=1)
    unit = np.r_[np.flatnonzero(where.begins[y]), len(y)]
    total = 0.0
    for j, word in enumerate(words[i]):
        a, b = unit[j], unit[j + 1]
        network = np.prod(probs[np.arange(a, b), y[a:b]]) / begin[a] * (begin[b] if word != "end" else 1)
        before = tuple((["begin", "begin"] + words[i])[j : j + 2])
        m = 0.5 * (1 - 1 / context[before]) if context[before] else 0
        total += np.log10((1 - m) * (0.5 * network + 0.5 * c[word] / c.total()) + (m * continued[(*before, word)] / context[before] if m else 0))
    return total


def test_scores_against_a_plain_version(spark, model):
    texts = ["a short text of a few words", "one two three one two four one two three " * 8, "x" * 120 + " y", "", "One two three one two five", "a short text of another kind"]
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    ids = [d for d in range(100, 200) if zlib.crc32(str(d).encode()) % 7 != 2][:5] + [held]
    blocks = L.encoded(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string"), 100)
    own = model._replace(tokens=int(L.pair_counts(blocks)[:, model.layout.begins].sum()))
    got = {r.doc_id: r.score for r in L.score(blocks, own).collect()}
    for i, d in enumerate(ids):
        assert np.isclose(got[d], plain_score(own, texts, [x != held for x in ids], i), rtol=1e-4), texts[i]


def test_ids_of_words_met_together():
    """New words are encoded at once: the ids are those of each word alone, whatever white space or bytes they hold."""
    alone = lambda w: L.small_bpe().encode_ordinary(" " + w.decode("utf-8", "replace"))
    for text in ("plain new words it's we'll", "caf\u00e9 \u00e1\u00f1o, \u4f60\u597d", "a\u00a0 \u00a0b \u00a0 c\u3000d", "x\x1c \x1c\x1d y", "\ud800 a\udfff b", "Aa aA " * 30 + "z" * 50, ""):
        L._IDS.clear()
        want = [i for w in text.encode("utf-8", "surrogatepass").lower().split() for i in alone(w)]
        assert L.subwords(text).tolist() == want == L.subwords(text).tolist(), text


def test_vectors_from_tables_are_those_of_training(model):
    x = np.random.default_rng(5).integers(0, L.CODES, (7, L.WINDOW))
    want = L.forward(model.weights, x)[0]
    for skip in (0, L.CONTEXT):
        got = L.hidden(model.weights, L.tables(model.weights), x, skip)
        assert np.allclose(got.reshape(7, -1, L.WIDTH), want[:, skip:], atol=1e-5)


def test_probabilities_add_up_to_one(model):
    h = L.forward(model.weights, np.zeros((1, L.WINDOW), np.uint16))[0][0]
    y = np.arange(1, L.CODES)
    got, begin = L.chances(model.weights, model.layout, np.repeat(h[:1], len(y), axis=0), y, model.pairs[0, y], np.repeat(model.pair_begins[:1], len(y)))
    assert abs(got.sum() - 1) < 1e-3 and model.pairs[:, 0].max() == 0 and np.allclose(model.pairs.sum(axis=1), 1, atol=1e-4)
    assert np.allclose(begin, got[model.layout.begins[1:]].sum(), atol=1e-3)


def test_words_after_two_words_add_up_to_one():
    """Over all words, when what the network and the share leave adds up to one."""
    rest, continued = np.log([0.2, 0.3, 0.5]), np.array([3, 0, 1])
    got = 10 ** L.word_log10(rest, np.exp(rest), np.full(3, 4), continued)
    assert abs(got.sum() - 1) < 1e-9 and got[1] == pytest.approx((1 - 0.5 * 0.75) * 0.3)
    once = L.word_log10(rest, np.exp(rest), np.ones(3), np.array([1, 0, 0]))
    assert np.allclose(10**once, np.exp(rest))


def test_windows_score_each_token_once():
    edges = np.cumsum([1, 31, 32, 33, 100, 2])
    start, first, last = L.windows(edges)
    seen = Counter(p for s, f, e in zip(start, first, last, strict=True) for p in range(f, min(s + L.WINDOW, e)))
    assert seen == Counter(range(edges[-1]))
    assert all(f - s in (0, L.CONTEXT) for s, f in zip(start, first, strict=True))


def test_scores_do_not_depend_on_batches(model, monkeypatch):
    texts = ["", "a short text", "some words " * 200, "x" * 3000]
    whole = L.word_log_probs(model, *codes(texts))
    assert len(whole) == 1 + 4 + 401 + 2 and (whole < 0).all()
    monkeypatch.setattr(L, "AT_ONCE", 3)
    monkeypatch.setattr(L, "SLICE", 100)
    assert np.allclose(whole, L.word_log_probs(model, *codes(texts)), rtol=1e-4)
    assert np.allclose(whole, np.concatenate([L.word_log_probs(model, *codes([t])) for t in texts]), rtol=1e-4)


def test_attention_is_causal(model):
    x = np.arange(1, L.WINDOW + 1, dtype=np.uint16)[None]
    y = x.copy()
    y[0, 20:] = 7
    a, b = L.forward(model.weights, x)[0], L.forward(model.weights, y)[0]
    assert np.allclose(a[0, :20], b[0, :20], atol=1e-6) and not np.allclose(a[0, 20:], b[0, 20:])


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    where = L.layout()
    w = {k: v.astype(np.float64) for k, v in L.initial(rng, where, np.full(L.CODES, 1 / L.CODES)).items()}
    w["gate"] = rng.standard_normal(L.WIDTH)
    x, y = rng.integers(0, L.CODES, (2, L.WINDOW)), rng.integers(1, L.CODES, (2, L.WINDOW))
    y[1, 5:] = -1
    pair = rng.random(x.shape) * 0.01
    _, g = L.gradients(w, where, x, y, pair)
    step = 1e-4
    for k in w:
        at = np.unravel_index(np.argmax(np.abs(g[k])), w[k].shape)
        w[k][at] += step
        up, _ = L.gradients(w, where, x, y, pair)
        w[k][at] -= 2 * step
        down, _ = L.gradients(w, where, x, y, pair)
        w[k][at] += step
        slope = (up - down) / (2 * step)
        if k not in ("own", "mix", "bias", "emb", "pos", "qkv", "gate", "gate0"):
            assert abs(slope - g[k][at]) < 0.02 * abs(g[k][at]) + 1e-5, k
        else:
            assert abs(slope - g[k][at]) < 0.05 * abs(g[k][at]) + 1e-4, k


def test_training_beats_pairs_alone_on_held_out_text(documents, blocks):
    held = codes([r.text for r in documents.filter(L.remainder() == 2).select("text").collect()])
    both = [L.word_log_probs(L.learn(blocks, 20_000, steps), *held).sum() for steps in (400, 0)]
    assert both[0] > both[1]


def test_every_training_window_teaches_the_network(blocks, documents, monkeypatch):
    """Without a single drawn window the network learns, each training window is met once, and partitions don't matter."""
    held = codes([r.text for r in documents.filter(L.remainder() == 2).select("text").collect()])
    one, other, none = L.learn(blocks, 0, 200), L.learn(blocks.repartition(5), 0, 200), L.learn(blocks, 0, 0)
    assert L.word_log_probs(one, *held).sum() > L.word_log_probs(none, *held).sum()
    assert all((one.weights[k] == other.weights[k]).all() for k in one.weights)
    met = []
    monkeypatch.setattr(L, "descend", lambda w, where, batches, pairs: met.extend(tuple(b[b >= 0]) for _, y, _ in batches for b in y))
    y, edges = codes(["one two three " * 40, "held out " * 30, "", "four"])
    n = L.lesson(none, y, edges, np.array([False, True, False, False]), 1)[1]
    own = [y[a:b] for a, b in zip(np.r_[0, edges[:-1]], edges, strict=True)]
    assert n == len(met) and sorted(met) == sorted(tuple(own[d][i : i + L.WINDOW]) for d in (0, 2, 3) for i in range(0, len(own[d]), L.WINDOW))


def test_scores_know_all_training_documents(spark, model):
    """A document that occurs twice anywhere, in any block, is scored apart from one that occurs once."""
    rng = np.random.default_rng(2)
    words = lambda: " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(60))
    once, twice = [words() for _ in range(40)], [words() for _ in range(10)]
    rows = list(enumerate(once + twice + twice))
    blocks = L.encoded(spark.createDataFrame(rows, "doc_id long, text string"), 1000)
    assert blocks.count() > 10
    got = {r.doc_id: r.score / r.n_tokens for r in L.score(blocks, model).collect()}
    assert min(got[i] for i in range(40, 60) if zlib.crc32(str(i % 40 + 40 if i < 50 else i - 10).encode()) % 7 != 2 and zlib.crc32(str(i if i < 50 else i).encode()) % 7 != 2) > max(got[i] for i in range(40)) + 0.5


def test_keys_are_sorted_as_single_numbers(monkeypatch):
    """Like numpy's own distinct keys, without argsort unless keys differ only in bits that places take."""
    rng = np.random.default_rng(4)
    many = L.dealt(rng.integers(0, 1 << 63, 5000, dtype=np.uint64), 3000)[rng.integers(0, 5000, 40_000)]
    close = (np.uint64(2999) << np.uint64(40)) + rng.integers(0, 3000, 40_000).astype(np.uint64)
    for keys, plain in ((many, False), (many[:1], False), (many[:0], False), (close[:100] >> np.uint64(30), False), (close, True)):
        want = np.unique(keys, return_inverse=True)
        with monkeypatch.context() as patch:
            if not plain:
                patch.setattr(np, "argsort", None)
            known, place, order, first = L.distinct(keys)
        assert (known == want[0]).all() and (place == want[1]).all() and (keys[order][first] == known).all()
        assert L.summed(np.ones(len(keys), np.int64), order, first).tolist() == np.bincount(want[1], minlength=len(known)).tolist()


def test_long_texts_are_scored_in_small_pieces(model, monkeypatch):
    """What is computed for the classes of a piece stays near the processor: at most 2^14 tokens of 32 numbers."""
    sizes, chances = [], L.chances
    monkeypatch.setattr(L, "chances", lambda w, where, h, y, *pairs: sizes.append(len(y)) or chances(w, where, h, y, *pairs))
    y, edges = codes(["some words " * 20_000])
    assert len(L.word_log_probs(model, y, edges)) == 40_001
    assert sum(sizes) == len(y) > 1 << 15 and max(sizes) <= 1 << 14


def test_long_texts_and_keys(spark):
    """Keys of words are odd, the parts' bits don't overlap, and blocks hold whole texts."""
    y, edges = codes(["a b a", "", "a b c"])
    where = L.layout()
    word, context, three = L.units(y, edges, where.begins)
    assert len(word) == 4 + 1 + 4 and (word & np.uint64(1) == 1).all() and not (context & np.uint64(1)).any() and not (three & np.uint64(1)).any()
    assert word[0] == word[2] == word[5] and word[3] == word[4] == word[8] and context[0] == context[4] == context[5] and three[1] == three[6] != three[0]
    keys, n = L.block_keys(y, edges, np.array([False, False, True]), where.begins, 7)
    place = L.distinct(L.all_keys(y, edges, where.begins, 7))[1]
    assert (np.diff(keys.astype(object)) > 0).all() and n[place[0]] == 2 and len(place) == 27 and ((keys >> np.uint64(40)) < 7).all()
    df = spark.createDataFrame([(1, "w " * 50_000), (2, "v")], "doc_id long, text string").coalesce(1)
    assert L.encoded(df, 1000).select(F.sum(F.aggregate("sizes", F.lit(0), lambda a, x: a + x)), F.count("*")).first() == (50_000 + len(L.subwords("v")), 2)


def test_empty(nothing):
    assert L.scored_documents(nothing).count() == 0


def test_edges(edges):
    assert L.scored_documents(edges).count() == edges.count()
