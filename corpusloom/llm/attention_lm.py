"""Scores whole texts with a small causal self-attention model over subword ids, in numpy.

Subword ids of the lower-cased words come from a public byte-level BPE cut to its first ranks,
and each text has one end. One attention layer over a window predicts the next id: first its
class, then the id within the class. Classes hold either ids that begin a word or ids that don't, so
the chance that a word begins is known too, and a word's probability is that of its ids and of a
beginning after them. A gate mixes in the corpus's pairs of ids. Texts of any length are read in
windows that overlap, so that each token is scored once and, but for a text's first, with at least
``CONTEXT`` tokens before it.

Three things are counted over all training documents, exactly: pairs of ids, words, and each word
after the two words before it. The network learns from every window of all training documents, once
each: blocks go on from common weights, and the mean of what they make of them, by windows, is taken. Only
where these weights begin comes from a bounded draw, ``WINDOWS`` on average.
A word's probability is (1 - m) * (0.5 * network + 0.5 * share of all words) + m * share of this
word among those after the same two words; m rises with how often the two words were seen and is 0
if only once, so what a document says for the only time doesn't explain itself.

Texts are encoded once, into blocks bounded in bytes. Blocks send the distinct keys of their words,
contexts and continuations with their counts to parts by hash of the whole key, and get the corpus's
counts back in the same order. A key comes at most once from a block, so frequent words and
contexts load no part more than others, and no table of all words is ever in one place.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._store import drop, materialise, small_batches
from corpusloom.llm._tokens import small_bpe, spaced_ids
from corpusloom.llm.near_dedup import each_text, mixed, pieces_of, span_hashes

#: Ranks of the vocabulary, ids of a class, width of vectors, window, tokens before the first that is scored.
RANKS, CLASS, WIDTH, WINDOW, CONTEXT = 1024, 32, 16, 32, 8
#: Training, to begin with: windows (on average), steps, windows of a step, rate.
WINDOWS, STEPS, BATCH, RATE = 80_000, 2000, 64, 1e-2
#: Then, of all windows: windows of a step, rate; parts of a whole in which changes of weights are added up.
PASSED, PASS_RATE, UNIT = 256, 1e-2, 1 << 20
#: Codes: 0 stands before a text, ids follow from 1, then the end.
END, CODES = RANKS + 1, RANKS + 2
#: Share of the corpus's words in a word's probability, and the most of what followed the same two words.
COUNTED, REMEMBERED = 0.5, 0.5
#: Bytes of texts of a block (a longer text is a block of its own), windows that are computed at once, tokens that are scored at once.
BLOCK, AT_ONCE, SLICE = 1 << 22, 128, 1 << 14
ENCODED = "block long, doc_id array<long>, named array<boolean>, held array<boolean>, sizes array<int>, ids binary"

_U = np.uint64
_BEGUN, _ENDED = _U(0x45A1D3C2B5968778), _U(0x1B873593CC9E2D51)
_A, _B, _C = _U(0xD1B54A32D192ED03), _U(0x8CB92BA72F3D8DD7), _U(0xAAAAAAAAAAAAAAAB)
#: Bits of a key within its part.
_LOW = 40


class _Ids(dict):
    """Ids of words with a space before them."""

    def __missing__(self, word: bytes) -> bytes:
        return np.array(small_bpe().encode_ordinary(" " + word.decode("utf-8", "replace")), "<u2").tobytes()

    def of(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of ``words``."""
        if len(self) >= 150_000:
            self.clear()
        got = list(map(self.get, words))
        new = {w for w, ids in zip(words, got, strict=True) if ids is None}
        if new:
            self.meet([w for w in new if len(w) <= 40])
            got = [self[w] if ids is None else ids for w, ids in zip(words, got, strict=True)]
        return got

    def meet(self, new: list[bytes]) -> None:
        """Remembers words that are ``new``, encoded at once: the pattern joins nothing with a space after it, unless
        other white space stands there too."""
        text = b" ".join(new).decode("utf-8", "replace")
        ids = np.array(small_bpe().encode_ordinary(" " + text) if new else [], "<u2")
        first = np.flatnonzero(_spaced()[ids]) * 2
        if len(first) == len(new) and text.split() == text.split(" "):
            raw = ids.tobytes()
            self.update(zip(new, [raw[a:b] for a, b in zip(first, [*first[1:], len(raw)], strict=True)], strict=True))
        else:
            self.update([(w, self[w]) for w in new])


_IDS = _Ids()


@functools.cache
def _spaced() -> np.ndarray:
    return spaced_ids(RANKS)


def subwords(text: str | None) -> np.ndarray:
    """Ids of a whole text: of each word after one space, A-Z lower-cased."""
    out = []
    for piece in pieces_of((text or "").encode("utf-8", "surrogatepass")):
        out += _IDS.of(piece.lower().split())
    return np.frombuffer(b"".join(out), "<u2")


def pack(values: np.ndarray) -> bytes:
    """Numbers as bytes, those of equal weight together."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), "zstd", asbytes=True)


def unpack(packed: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(packed, n * size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(kind).ravel()


# ---------------------------------------------------------------- the network


class Layout(NamedTuple):
    """Where each code is: its class and place; how many classes hold ids that begin a word; which places are taken."""

    begins: np.ndarray
    cls: np.ndarray
    slot: np.ndarray
    n_begin: int
    taken: np.ndarray


def layout() -> Layout:
    begins = np.r_[False, spaced_ids(RANKS), True]
    first, rest = np.flatnonzero(begins), np.flatnonzero(~begins)[1:]
    n_begin = -(-len(first) // CLASS)
    cls, slot = np.zeros(CODES, np.uint8), np.zeros(CODES, np.uint8)
    for codes, base in ((first, 0), (rest, n_begin)):
        cls[codes], slot[codes] = base + np.arange(len(codes)) // CLASS, np.arange(len(codes)) % CLASS
    taken = np.zeros((n_begin - (-len(rest) // CLASS), CLASS), bool)
    taken[cls[1:], slot[1:]] = True
    return Layout(begins, cls, slot, n_begin, taken)


class Model(NamedTuple):
    layout: Layout
    weights: dict[str, np.ndarray]
    #: Probability of each code after each code, and of a beginning.
    pairs: np.ndarray
    pair_begins: np.ndarray
    #: Training tokens: words and ends.
    tokens: int


def windows(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of documents laid end to end (``edges``: where each ends): the first place of each
    window, the places before which it scores nothing, and where its document ends."""
    begins = np.r_[0, edges[:-1]]
    step = WINDOW - CONTEXT
    n = 1 + np.maximum(0, -(-(edges - begins - WINDOW) // step))
    doc = np.repeat(np.arange(len(edges)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = begins[doc] + nth * step
    return start, np.where(nth > 0, start + CONTEXT, start), edges[doc]


def initial(rng: np.random.Generator, where: Layout, share: np.ndarray) -> dict[str, np.ndarray]:
    """Weights that begin with the ``share`` of each code."""
    near = lambda *shape: (rng.standard_normal(shape) / np.sqrt(WIDTH)).astype(np.float32)
    low = np.full(where.taken.shape, -30, np.float32)
    low[where.cls[1:], where.slot[1:]] = np.log(share[1:])
    top = np.log(np.exp(low).sum(axis=1))
    n = len(where.taken)
    return {"emb": near(CODES, WIDTH), "pos": near(WINDOW, WIDTH) * 0.3, "qkv": near(WIDTH, 3 * WIDTH), "own": near(WIDTH, WIDTH), "mix": near(WIDTH, WIDTH), "bias": np.zeros(WIDTH, np.float32), "gate": np.zeros(WIDTH, np.float32), "gate0": np.zeros(1, np.float32), "top": near(WIDTH, n) * 0.3, "top0": top, "low": near(n, WIDTH, CLASS) * 0.3, "low0": low}


_SEEN = np.tril(np.ones((WINDOW, WINDOW), np.float32))


def forward(w: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hidden vectors of windows of codes ``x``, and what training needs."""
    e = w["emb"].take(x, axis=0)
    e += w["pos"]
    q, k, v = np.split((e.reshape(-1, WIDTH) @ w["qkv"]).reshape(*x.shape, 3 * WIDTH), 3, axis=2)
    q *= np.float32(1 / np.sqrt(WIDTH))
    a = q @ k.transpose(0, 2, 1)
    np.minimum(a, 60, out=a)
    np.exp(a, out=a)
    a *= _SEEN
    a /= a @ np.ones((WINDOW, 1), a.dtype)
    c = a @ v
    h = e.reshape(-1, WIDTH) @ w["own"]
    h += c.reshape(-1, WIDTH) @ w["mix"]
    h += w["bias"]
    return np.tanh(h, out=h).reshape(e.shape), e, q, k, v, a, c


def tables(w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """What each code and each place in a window add to the query, key, value, a one and the vector's own part."""

    def rows(z: np.ndarray, one: int, bias: np.ndarray | int) -> np.ndarray:
        q, k, v = np.split(z @ w["qkv"], 3, axis=1)
        return np.concatenate([q / np.sqrt(WIDTH), k, v, np.full((len(z), 1), one), z @ w["own"] + bias], axis=1).astype(np.float32)

    return rows(w["emb"], 0, 0), rows(w["pos"], 1, w["bias"])


def hidden(w: dict[str, np.ndarray], made: tuple[np.ndarray, np.ndarray], x: np.ndarray, skip: int) -> np.ndarray:
    """The hidden vectors of ``forward`` from ``tables``, but for the first ``skip`` of each window, which are only seen.
    Attention is divided by its sums last."""
    e = made[0].take(x, axis=0)
    e += made[1]
    a = e[:, skip:, :WIDTH] @ e[..., WIDTH : 2 * WIDTH].transpose(0, 2, 1)
    np.minimum(a, 60, out=a)
    np.exp(a, out=a)
    a *= _SEEN[skip:]
    c = a @ e[..., 2 * WIDTH : 3 * WIDTH + 1]
    c = c[..., :WIDTH] / c[..., WIDTH:]
    h = c.reshape(-1, WIDTH) @ w["mix"]
    h += e[:, skip:, 3 * WIDTH + 1 :].reshape(-1, WIDTH)
    return np.tanh(h, out=h)


def chances(w: dict[str, np.ndarray], where: Layout, h: np.ndarray, y: np.ndarray, pair: np.ndarray, pair_begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of hidden vectors, the probability of the codes ``y`` that follow and of a beginning; ``pair`` and ``pair_begin``
    are what the pairs of ids say."""
    top = h @ w["top"]
    top += w["top0"]
    np.exp(top, out=top)  # of moderate size: h is between -1 and 1
    sums = top @ np.stack([np.ones(top.shape[1]), np.arange(top.shape[1]) < where.n_begin], axis=1).astype(np.float32)
    total, ones = sums[:, 0], np.ones(CLASS, np.float32)
    cls = where.cls[y]
    order = np.argsort(cls, kind="stable")
    edges = np.searchsorted(cls[order], np.arange(len(where.taken) + 1))
    own, slot, inner = h.take(order, axis=0), where.slot[y[order]], np.empty(len(y), np.float32)
    for c, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        low = own[i:j] @ w["low"][c]
        low += w["low0"][c]
        np.exp(low, out=low)
        inner[i:j] = low[np.arange(j - i), slot[i:j]] / (low @ ones)
    net = top[np.arange(len(y)), cls] / total
    net[order] *= inner
    gate = 1 / (1 + np.exp(-(h @ w["gate"] + w["gate0"])))
    begin = sums[:, 1] / total
    return gate * pair + (1 - gate) * net, gate * pair_begin + (1 - gate) * begin


def gradients(w: dict[str, np.ndarray], where: Layout, x: np.ndarray, y: np.ndarray, pair: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over the codes ``y`` (negative: none), of which pairs of ids give ``pair``, and its gradients. The loss is that
    of the mixture and that of the network alone, which would else leave what is easy to the pairs and learn nothing."""
    out, e, q, k, v, a, c = forward(w, x)
    flat = lambda z: z.reshape(-1, z.shape[-1])
    at = np.flatnonzero(y.ravel() >= 0)
    at = at[np.argsort(where.cls[y.ravel()[at]], kind="stable")]
    t, n, rows = y.ravel()[at], max(1, len(at)), np.arange(len(at))
    cls, slot, h = where.cls[t], where.slot[t], flat(out).take(at, axis=0)
    edges = np.searchsorted(cls, np.arange(len(where.taken) + 1))
    each = [(i, slice(a, b)) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b]
    top, low = h @ w["top"], np.empty((len(t), CLASS), h.dtype)
    top += w["top0"]
    for i, own in each:
        np.matmul(h[own], w["low"][i], out=low[own])
        low[own] += w["low0"][i]
    np.exp(top, out=top)  # of moderate size, as in chances
    np.exp(low, out=low)
    tops, lows = top @ np.ones(top.shape[1], h.dtype), low @ np.ones(CLASS, h.dtype)
    net = top[rows, cls] / tops * (low[rows, slot] / lows)
    gate = 1 / (1 + np.exp(-(h @ w["gate"] + w["gate0"])))
    p = np.maximum(gate * pair.ravel()[at] + (1 - gate) * net, 1e-12)
    net = np.maximum(net, 1e-12)
    part = (1 - gate) * net / p  # how far the network answers for each
    dgate = ((gate - (1 - part)) / n).astype(h.dtype)
    part = ((1 + part) / n).astype(h.dtype)
    for z, sums, place in ((top, tops, cls), (low, lows, slot)):
        z *= (part / sums)[:, None]
        z[rows, place] -= part
    g = {"gate": h.T @ dgate, "gate0": dgate.sum(keepdims=True), "top": h.T @ top, "top0": np.ones(len(t), h.dtype) @ top, "low": np.zeros_like(w["low"]), "low0": np.zeros_like(w["low0"])}
    dh = top @ w["top"].T
    dh += dgate[:, None] * w["gate"]
    for i, own in each:
        g["low"][i], g["low0"][i] = h[own].T @ low[own], low[own].sum(axis=0)
        dh[own] += low[own] @ w["low"][i].T
    dh *= 1 - h * h
    dz = np.zeros((x.size, WIDTH), h.dtype)
    dz[at] = dh
    g |= {"own": flat(e).T @ dz, "mix": flat(c).T @ dz, "bias": dz.sum(axis=0)}
    dc = (dz @ w["mix"].T).reshape(c.shape)
    ds = dc @ v.transpose(0, 2, 1)
    ds -= (dc * c) @ np.ones((WIDTH, 1), h.dtype)
    ds *= a
    dqkv = np.empty((*x.shape, 3 * WIDTH), h.dtype)
    np.matmul(ds, k * np.float32(1 / np.sqrt(WIDTH)), out=dqkv[..., :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), q, out=dqkv[..., WIDTH : 2 * WIDTH])
    np.matmul(a.transpose(0, 2, 1), dc, out=dqkv[..., 2 * WIDTH :])
    g["qkv"] = flat(e).T @ flat(dqkv)
    de = dz @ w["own"].T
    de += flat(dqkv) @ w["qkv"].T
    g["pos"], g["emb"] = de.reshape(e.shape).sum(axis=0), np.zeros_like(w["emb"])
    order = np.argsort(x.ravel(), kind="stable")
    codes = x.ravel()[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    g["emb"][codes[first]] = np.add.reduceat(de.take(order, axis=0), first, axis=0)
    return float(-(np.log(p) + np.log(net)).sum() / n), g


def pair_chances(counts: np.ndarray) -> np.ndarray:
    """Kneser-Ney probability of each code (column) after each code, from counts of pairs."""
    n1, n2 = (counts == 1).sum(), (counts == 2).sum()
    d = n1 / (n1 + 2 * n2) if n1 else 0.5
    ends = (counts > 0).sum(axis=0) + 0.5
    ends[0] = 0  # never follows
    single = ends / ends.sum()
    total, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    some = np.maximum(total, 1)
    return (np.maximum(counts - d, 0) / some + np.where(total > 0, d * kinds / some, 1.0) * single).astype(np.float32)


def descend(w: dict[str, np.ndarray], where: Layout, batches: Iterator[tuple[np.ndarray, np.ndarray, float]], pairs: np.ndarray) -> None:
    """Changes weights by a step of Adam for each batch: codes, those that follow (negative: none), the rate."""
    m, s2 = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
    for step, (x, y, rate) in enumerate(batches, 1):
        _, g = gradients(w, where, x, y, pairs[x, np.maximum(y, 0)])
        for k in w:
            m[k] += 0.1 * (g[k] - m[k])
            s2[k] += 0.01 * (g[k] ** 2 - s2[k])
            w[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def train(sequences: list[np.ndarray], counts: np.ndarray, steps: int = STEPS, seed: int = 3) -> Model:
    """A model from windows of codes, each with the code before it, and the corpus's counts of pairs."""
    where, pairs = layout(), pair_chances(counts)
    x = np.zeros((len(sequences), WINDOW), np.uint16)
    y = np.full((len(sequences), WINDOW), -1, np.int16)
    for i, s in enumerate(sequences):
        x[i, : len(s) - 1], y[i, : len(s) - 1] = s[:-1], s[1:]
    share = counts.sum(axis=0) + 0.5
    rng = np.random.default_rng(seed)
    w = initial(rng, where, share / share.sum())

    def batches() -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        for step in range(1, steps + 1 if len(x) else 1):
            at = rng.integers(0, len(x), BATCH)
            yield x[at], y[at], RATE * min(1.0, step / 50) * (1 - 0.95 * step / steps)

    descend(w, where, batches(), pairs)
    return Model(where, w, pairs, pairs[:, where.begins].sum(axis=1), int(counts[:, where.begins].sum()))


def cut(edges: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of training documents, which don't overlap: where each begins and ends, and where its document begins."""
    begins = np.r_[0, edges[:-1]]
    n = np.where(held, 0, -(-(edges - begins) // WINDOW))
    doc = np.repeat(np.arange(len(edges)), n)
    start = begins[doc] + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
    return start, np.minimum(start + WINDOW, edges[doc]), begins[doc]


def lesson(model: Model, y: np.ndarray, edges: np.ndarray, held: np.ndarray, seed: int) -> tuple[dict[str, np.ndarray], int]:
    """The weights that a block's training documents make of the model's, each of their windows being learned from once,
    and the number of these windows."""
    start, end, _ = cut(edges, held)
    x = np.r_[np.uint16(0), y[:-1]]
    x[edges[:-1]] = 0
    w = {k: a.copy() for k, a in model.weights.items()}
    order = np.random.default_rng(seed).permutation(len(start))
    xs, ys = (np.lib.stride_tricks.sliding_window_view(np.r_[z, np.zeros(WINDOW, z.dtype)], WINDOW) for z in (x, y.astype(np.int16)))

    def batches() -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        for i in range(0, len(order), PASSED):
            at = order[i : i + PASSED]
            own, follow = xs[start[at]], ys[start[at]]
            outside = np.arange(WINDOW) >= (end - start)[at, None]
            own[outside], follow[outside] = 0, -1
            yield own, follow, PASS_RATE * min(1.0, (i + PASSED) / (20 * PASSED)) * (1 - 0.95 * i / len(order))

    descend(w, model.layout, batches(), model.pairs)
    return w, len(start)


def laid_out(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of texts, whose ids lie end to end, each with its end; where each text ends."""
    edges = np.cumsum(sizes + 1)
    y = np.full(int(edges[-1]) if len(edges) else 0, END, np.uint16)
    inner = np.ones(len(y), bool)
    inner[edges - 1] = False
    y[inner] = ids + np.uint16(1)
    return y, edges


def word_log_probs(model: Model, y: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Log probability, by the network, of each word of texts in codes and of each text's
    end, given that a word or the end begins there."""
    n = len(y)
    x = np.r_[np.uint16(0), y[:-1]]
    x[edges[:-1]] = 0
    got, begin = np.empty(n, np.float32), np.empty(n, np.float32)
    start, first, last = windows(edges)
    made = tables(model.weights)
    many = max(1, SLICE // (WINDOW - CONTEXT) // AT_ONCE) * AT_ONCE
    for skip in (0, CONTEXT):
        own = np.flatnonzero(first - start == skip)
        for i in range(0, len(own), many):
            vectors, places = [], []
            for at in (own[j : j + AT_ONCE] for j in range(i, min(i + many, len(own)), AT_ONCE)):
                place = start[at, None] + np.arange(WINDOW)
                scored = np.flatnonzero(place[:, skip:] < last[at, None])
                places.append(place[:, skip:].ravel()[scored])
                vectors.append(hidden(model.weights, made, x.take(place, mode="clip"), skip).take(scored, axis=0))
            at = np.concatenate(places)
            xs, ys = x[at], y[at]
            got[at], begin[at] = chances(model.weights, model.layout, np.concatenate(vectors), ys, model.pairs[xs, ys], model.pair_begins[xs])
    unit = np.flatnonzero(model.layout.begins[y])
    out = np.add.reduceat(np.log(got, dtype=np.float64), unit) if n else np.zeros(0)
    begin = np.log(begin[unit], dtype=np.float64)
    out -= begin
    words = np.flatnonzero(y[unit] != END)
    out[words] += begin[words + 1]
    return out


# ---------------------------------------------------------------- words and what follows


def units(y: np.ndarray, edges: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each word and end, of the two before it, and of all three. Those of words alone are odd, the others even."""
    start = np.flatnonzero(begins[y])
    h = span_hashes(y, start, np.r_[start[1:], len(y)])
    h[y[start] == END] = _ENDED
    first = np.r_[True, y[start[:-1]] == END][: len(h)]  # of a text
    one = np.r_[_BEGUN, h[:-1]][: len(h)]
    one[first] = _BEGUN
    two = np.r_[_BEGUN, one[:-1]][: len(h)]
    two[first] = _BEGUN
    context = mixed(two * _A + one * _B + _C)
    even = ~_U(1)
    return mixed(h * _C) | _U(1), context & even, mixed(context + h * _A) & even


def dealt(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each key, above its bits within the part."""
    return (keys >> _U(_LOW)) % _U(parts) << _U(_LOW) | keys & _U((1 << _LOW) - 1)


def in_order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of ``keys``, equal ones as they come, and the keys in it. The first bits of each and its place are sorted
    as one number, which takes less than half of an argsort; if keys that differ in later bits alone are then out of order, all are sorted again."""
    bits = len(keys).bit_length()
    left = max(0, int(keys.max(initial=0)).bit_length() + bits - 64)
    both = keys >> _U(left) << _U(bits) | np.arange(len(keys), dtype=np.uint64)
    both.sort()
    order = (both & _U((1 << bits) - 1)).astype(np.int64)
    ordered = keys[order]
    if left and (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    return order, ordered


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where each of ``keys`` is among them, the order of ``keys``, and where in it each distinct key begins."""
    order, ordered = in_order(keys)
    new = np.r_[True, ordered[1:] != ordered[:-1]][: len(keys)]
    first = np.flatnonzero(new)
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[first], place, order, first


def summed(n: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of ``n`` over each distinct key."""
    return np.add.reduceat(n[order], first) if len(n) else n


def all_keys(y: np.ndarray, edges: np.ndarray, begins: np.ndarray, parts: int) -> np.ndarray:
    """The dealt keys of a block's words, contexts and continuations."""
    return np.concatenate([dealt(k, parts) for k in units(y, edges, begins)])


def block_keys(y: np.ndarray, edges: np.ndarray, held: np.ndarray, begins: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of a block and how often training documents have each."""
    known, _, order, first = distinct(all_keys(y, edges, begins, parts))
    return known, summed(np.tile(~np.repeat(held, ends_per_text(y, edges, begins)), 3).astype(np.int32), order, first)


def ends_per_text(y: np.ndarray, edges: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Words of each text, and its end."""
    return np.diff(np.r_[0, np.cumsum(begins[y])[edges - 1]])


def word_log10(network: np.ndarray, share: np.ndarray, context: np.ndarray, continued: np.ndarray) -> np.ndarray:
    """log10 of words from the network's log probabilities, their share of all words, and the counts of
    the two words before them and of all three."""
    m = REMEMBERED * (1 - 1 / np.maximum(context, 1))
    with np.errstate(divide="ignore"):
        rest = np.logaddexp(network + np.log(1 - COUNTED), np.log(COUNTED * share)) + np.log1p(-m)
        return np.logaddexp(rest, np.log(m * continued / np.maximum(context, 1))) / np.log(10)


# ---------------------------------------------------------------- Spark


def remainder(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7, F.lit(0))


def encoded(docs: DataFrame, block_bytes: int = BLOCK) -> DataFrame:
    """Ids of all whole texts in blocks, written once."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder() == 2).alias("held"), "text")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n, size = TaskContext.get().partitionId() << 32, 0, 0
        block: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids, held, text = zip(*block, strict=True)
            packed = pa.Codec("zstd", compression_level=5).compress(b"".join(t.tobytes() for t in text), asbytes=True)
            named = [i is not None for i in ids]
            columns = [pa.array([base + n], pa.int64()), pa.array([[i or 0 for i in ids]], pa.list_(pa.int64())), pa.array([named], pa.list_(pa.bool_())), pa.array([held], pa.list_(pa.bool_())), pa.array([[len(t) for t in text]], pa.list_(pa.int32())), pa.array([packed], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["block", "doc_id", "named", "held", "sizes", "ids"])

        for batch in batches:
            for doc, held, text in zip(batch["doc_id"].to_pylist(), batch["held"].to_pylist(), each_text(batch["text"]), strict=True):
                if block and size + len(text or "") > block_bytes:
                    yield flush()
                    block, n, size = [], n + 1, 0
                block.append((doc, held, subwords(text)))
                size += len(text or "")
        if block:
            yield flush()

    return materialise(rows.mapInArrow(made, ENCODED), "lm_blocks")


def _codes(sizes: pa.Scalar | np.ndarray, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.asarray(sizes, np.int64)
    return laid_out(np.frombuffer(pa.decompress(ids, 2 * int(sizes.sum()), "zstd", asbytes=True) if sizes.sum() else b"", "<u2"), sizes)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Number, codes, edges and held documents of each block."""
    for batch in batches:
        for i in range(len(batch)):
            y, edges = _codes(batch["sizes"][i].as_py(), batch["ids"][i].as_py())
            yield batch["block"][i].as_py(), y, edges, np.array(batch["held"][i].as_py(), bool)


def pair_counts(blocks: DataFrame) -> np.ndarray:
    """How often each code follows each in training documents. At most CODES * CODES numbers leave a partition."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES * CODES, np.int64)
        for _, y, edges, held in _blocks(batches):
            x = np.r_[np.uint16(0), y[:-1]]
            x[edges[:-1]] = 0
            on = ~np.repeat(held, np.diff(np.r_[0, edges]))
            total += np.bincount(x[on].astype(np.int32) * CODES + y[on], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["pair", "n"])

    found = blocks.mapInArrow(counted, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CODES * CODES, np.int64)
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(CODES, CODES)


def taught(blocks: DataFrame, model: Model) -> Model:
    """The model after every window of all training documents. Each block goes on from the model's weights with its own
    windows, and the mean of what blocks make of them is taken, by windows. Changes are added up as whole numbers, so
    neither the order of blocks nor their partitions matter. One number a weight leaves a partition."""
    held = blocks.sparkSession.sparkContext.broadcast(model)
    flat = lambda w: np.concatenate([a.ravel() for a in w.values()])

    def lessons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = flat(held.value.weights).astype(np.float64)
        total = np.zeros(len(before) + 1, np.int64)
        for block, y, edges, heldout in _blocks(batches):
            w, n = lesson(held.value, y, edges, heldout, block)
            total[:-1] += np.rint((flat(w) - before) * n * UNIT).astype(np.int64)
            total[-1] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["weight", "n"])

    found = blocks.mapInArrow(lessons, "weight int, n long").groupBy("weight").agg(F.sum("n").alias("n")).toArrow()
    sizes = [a.size for a in model.weights.values()]
    total = np.zeros(sum(sizes) + 1, np.int64)
    total[found["weight"].to_numpy()] = found["n"].to_numpy()
    change = np.split(total[:-1] / (max(int(total[-1]), 1) * UNIT), np.cumsum(sizes)[:-1])
    return model._replace(weights={k: (a + c.reshape(a.shape)).astype(np.float32) for (k, a), c in zip(model.weights.items(), change, strict=True)})


def learn(blocks: DataFrame, most: int = WINDOWS, steps: int = STEPS) -> Model:
    """The model: pairs of ids and the network from all training documents. The network's weights begin with ``steps`` on
    windows that are drawn by the hash of what they hold, ``most`` on average; then each window of all training documents
    is learned from (without steps: none)."""
    counts = pair_counts(blocks)
    most_hash = _U(min((1 << 64) - 1, (most * WINDOW << 64) // max(int(counts.sum()), 1)))

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, y, edges, held in _blocks(batches):
            start, end, begins = cut(edges, held)
            picked = np.flatnonzero(span_hashes(y, start, end) <= most_hash) if len(start) else start
            before = lambda i: [0] if start[i] == begins[i] else [y[start[i] - 1]]
            out = [np.r_[before(i), y[start[i] : end[i]]].astype("<u2").tobytes() for i in picked]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["codes"])

    cuts = blocks.mapInArrow(drawn, "codes binary").toArrow()
    begun = train([np.frombuffer(c, "<u2") for c in sorted(cuts["codes"].to_pylist())], counts, steps)
    return taught(blocks, begun) if steps else begun


def _asked(begins: np.ndarray, parts: int):
    """Sends each block's distinct keys and counts to the parts they belong to."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, y, edges, held in _blocks(batches):
            keys, n = block_keys(y, edges, held, begins, parts)
            part = keys >> _U(_LOW)
            first = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(keys)]
            low = keys & _U((1 << _LOW) - 1)
            spans = [slice(a, b) for a, b in zip(first[:-1], first[1:], strict=True)]
            for i in range(0, len(spans), 4096):
                own = spans[i : i + 4096]
                columns = [pa.array([block] * len(own), pa.int64()), pa.array([int(part[s.start]) for s in own], pa.int64()), pa.array([s.stop - s.start for s in own], pa.int32())]
                columns += [pa.array([pack(np.diff(low[s], prepend=_U(0))) for s in own], pa.binary()), pa.array([pack(n[s].astype(np.int32)) for s in own], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "part", "size", "keys", "n"])

    return asked


def _answered(group: pd.DataFrame) -> pd.DataFrame:
    """The corpus's counts of the keys that blocks ask for, and how many words of training documents a part has."""
    keys = np.concatenate([np.cumsum(unpack(k, n, np.uint64)) for k, n in zip(group["keys"], group["size"], strict=True)])
    own = np.concatenate([unpack(k, n, np.int32) for k, n in zip(group["n"], group["size"], strict=True)])
    known, place, order, first = distinct(keys)
    total = summed(own.astype(np.int64), order, first)
    counts = np.split(total[place], np.cumsum(group["size"].to_numpy())[:-1])
    words = np.zeros(len(group), np.int64)
    words[0] = ((known & _U(1) == 1) & (total > 0)).sum()
    return pd.DataFrame({"block": group["block"], "part": group["part"], "size": group["size"], "n": [pack(c) for c in counts], "words": words})


def score(blocks: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document of encoded().

    Training documents are those whose id's checksum doesn't leave 2 by 7; a null id trains.
    Null texts are as empty ones: one token, the end. Texts are read whole, however long; rows that repeat an id or a text count
    and are scored each. Without training documents all counts are 0; an empty table gives an empty result. Ties
    can't occur. Other columns are ignored.
    """
    spark = blocks.sparkSession
    held, parts = spark.sparkContext.broadcast(model), max(16, blocks.count())
    asked = blocks.mapInArrow(_asked(model.layout.begins, parts), "block long, part long, size int, keys binary, n binary")
    answers = asked.groupBy("part").applyInPandas(_answered, "block long, part long, size int, n binary, words long")

    def scored(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        m, outs = held.value, []
        begins, total = m.layout.begins, max(m.tokens, 1)
        for own in docs.itertuples():
            y, edges = _codes(own.sizes, own.ids)
            heldout = np.array(own.held, bool)
            place = distinct(all_keys(y, edges, begins, parts))[1]
            answers = answers.sort_values("part")
            counts = np.concatenate([unpack(x, n, np.int64) for x, n in zip(answers["n"], answers["size"], strict=True)])[place]
            c, context, continued = np.split(counts, 3)
            sizes = ends_per_text(y, edges, begins)
            to = np.cumsum(sizes) - sizes
            both = word_log10(word_log_probs(m, y, edges), c / total, context, continued)
            add = lambda x: np.add.reduceat(x, to)
            out = pd.DataFrame({"doc_id": pd.Series(own.doc_id, dtype="Int64").where(np.array(own.named, bool)), "held_out": heldout, "n_tokens": sizes, "n_known": add((c > 0).astype(np.int64)), "raw": add(np.log10(c + 1.0)), "score": add(both)})
            words = np.zeros(len(out), np.int64)
            words[0] = answers["words"].sum()
            outs.append(out.assign(words=words))
        return pd.concat(outs)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, raw double, score double, words long"
    got = materialise(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(scored, schema), "lm_scores")
    n, v = model.tokens, got.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    base = F.col("raw") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))
    return got.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def scored_documents(docs: DataFrame) -> DataFrame:
    blocks = encoded(docs)
    out = score(blocks, learn(blocks))
    drop(blocks)
    return out
