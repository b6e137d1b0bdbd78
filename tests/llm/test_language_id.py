import zlib

import numpy as np

from corpusloom.llm import language_id as L


def test_kneser_ney_adds_up_to_one():
    texts = ["the cat sat on the mat", "a cat and a dog", "on a mat the dog sat"]
    letters = sorted({ord(c) for t in texts for c in t if c.isalpha()})
    codes = L.letter_codes(letters)
    got, sizes = L.normalise(texts, codes)
    keys = np.concatenate([L.gram_keys(got[e - n : e]) for e, n in zip(np.cumsum(sizes), sizes, strict=True)])
    for least in (1, 2):
        grams, contexts = L.kneser_ney([np.unique(keys, return_counts=True)], len(letters))
        model = L.Model(["x"], codes, grams, contexts)
        for head in (keys[3] >> np.uint64(12), keys[9] >> np.uint64(12), np.uint64(5 << 12)):
            every = (head << np.uint64(12)) | np.arange(len(letters) + 2, dtype=np.uint64)
            every &= L._mask(L.ORDER)
            assert abs(np.exp(L.log_probs(model, every)).sum() - 1) < 1e-5, least


def test_normalise_against_plain_python():
    texts = ["Ab  c!D", "", " é\n\nf ", "123", "İx"]
    codes = L.letter_codes([ord(c) for c in "abcdéfix"])
    got, sizes = L.normalise(texts, codes)
    at = 0
    for t, n in zip(texts, sizes, strict=True):
        plain = " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split())
        body = got[at + L.ORDER - 1 : at + n]
        assert (got[at : at + L.ORDER - 1] == 0).all()
        trailing = t and not t.lower()[-1].isalpha() and plain
        assert list(body) == [codes[ord(c)] if c != " " else 0 for c in plain + (" " if trailing else "")]
        at += n


def test_long_texts_are_scored_alike_in_any_window(monkeypatch):
    codes = L.letter_codes([ord(c) for c in "abcdefgh"])
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abcdefgh "), 500)), "", "abc " * 40]
    got, _ = L.normalise(texts[:1], codes)
    model = L.Model(["x"], codes, *L.kneser_ney([np.unique(L.gram_keys(got), return_counts=True)], 8))
    whole = L.cross_entropies(model, texts)[0]
    monkeypatch.setattr(L, "WINDOW", 37)
    assert np.allclose(whole, L.cross_entropies(model, texts)[0])


def test_edges(spark, edges, nothing):
    model, calibration = L.learn(edges)
    out = L.identify(edges, model, calibration).collect()
    assert len(out) == edges.count()
    for r in out:
        has = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not has) and 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.size == "clash"
        if not has:
            assert r.rejected and r.score == 0
    none = L.identify(nothing, *L.learn(nothing))
    assert none.count() == 0 and "lang_pred" in none.columns
    unlearned = L.identify(edges, *L.learn(nothing))
    assert {r.lang_pred for r in unlearned.collect()} == {"und"}


def test_held_out_accuracy(documents):
    model, calibration = L.learn(documents)
    out = L.identify(documents, model, calibration).filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.95
    assert sum(r.rejected for r in out) <= 1


def test_prediction_does_not_see_labels(spark, documents):
    model, calibration = L.learn(documents)
    other = documents.selectExpr("doc_id + 100000 as doc_id", "text", "'xx' as lang", "'yy' as source")
    a = {r.text: r.lang_pred for r in L.identify(documents, model, calibration).collect()}
    assert all(a[r.text] == r.lang_pred for r in L.identify(other, model, calibration).collect())
