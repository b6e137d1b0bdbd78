import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import _tokens, packing


def laid_out(rows, capacity):
    """Checks places; returns the number of sequences."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by)


def test_words_give_the_ids_of_whole_texts(documents):
    plain, fast = Tokenizer.from_file(_tokens.BYTE_BPE), _tokens.tokenizer()
    texts = [r.text for r in documents.select("text").collect()]
    texts += ["", " ", "a  b", "a\n\nb", " a", "a ", "don't stop 've x's", "x\r\ny z", "tab\tb c", "<|endoftext|> a b<|endoftext|>c", "é  b", "a\x1c b", "a\x85b c　d", "\n", "a \n b", "日本 語\nの", "𝒳 y"]
    for t in texts:
        assert fast.ids(t) == np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t[:50]


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)] and packing.cut(4, 4) == [(0, 4)] and packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_pieces_hold_every_token_once(spark, edges):
    plain = Tokenizer.from_file(_tokens.BYTE_BPE)
    rows = packing.pack_documents(edges).collect()
    laid_out(rows, 1024)
    want = {}
    for r in edges.collect():
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 2]
        for k, (s, n) in enumerate(packing.cut(len(ids), 1024)):
            key = (r.doc_id, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()))
            want[key] = want.get(key, 0) + 1
    got = {}
    for r in rows:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
    assert got == want


def test_empty(nothing):
    assert packing.pack_documents(nothing).count() == 0


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_capacities_hold_in_every_dimension(spark, score):
    rng = random.Random(4)
    lengths = [rng.choice([1, 2, 3, 50, 200, 511, 600, 1000]) for _ in range(3000)]
    df = spark.createDataFrame([(i, n, "clash") for i, n in enumerate(lengths)], "i long, length long, offset string").repartition(3)
    got = packing.pack(df, most_documents=6, most_attention=600_000 + 1_000_000 // 2, score=score, block_rows=500)
    rows = got.collect()
    assert sorted((r.i, r.length) for r in rows) == sorted(enumerate(lengths))
    laid_out(rows, 1024)
    for r in got.groupBy("sequence_id").agg(F.count("*").alias("n"), F.sum(F.col("length") * F.col("length")).alias("a")).collect():
        assert r.n <= 6 and r.a <= 1_100_000


def test_a_piece_that_fits_nowhere_is_an_error(spark):
    df = spark.createDataFrame([(1, 900)], "i long, length long")
    with pytest.raises(Exception, match="fits no sequence"):
        packing.pack(df, most_attention=100).count()


def test_few_sequences_and_blocks_cost_little(spark):
    rng = random.Random(5)
    lengths = [min(1024, max(1, int(rng.lognormvariate(5, 1)))) for _ in range(4000)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "i long, length long")
    bound = -(-sum(lengths) // 1024)
    one = laid_out(packing.pack(df).collect(), 1024)
    many = laid_out(packing.pack(df, block_rows=300).collect(), 1024)
    assert one <= bound * 1.01 + 1 and many <= bound * 1.03 + 2


def test_best_fit_against_plain_search():
    rng = random.Random(6)
    lengths = sorted((rng.randrange(1, 100) for _ in range(200)), reverse=True)
    got = packing.best_fit(np.array(lengths), (100.0, 100.0, 10_000.0), (1.0, 0.0, 0.0))
    bins, want = [], []
    for n in lengths:
        fits = [i for i, left in enumerate(bins) if left >= n]
        if fits:
            at = min(fits, key=lambda i: bins[i])
        else:
            at = len(bins)
            bins.append(100)
        bins[at] -= n
        want.append(at)
    fill = lambda at: sorted(np.bincount(at, weights=lengths).tolist())
    assert fill(got) == fill(want)
