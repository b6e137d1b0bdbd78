"""Language identification with interpolated Kneser-Ney character models.

For each language, 5-gram counts of letters (runs of other characters are one space) give
Kneser-Ney probabilities of each order. N-grams of all languages share one sorted array of
hashes for each order, whose rows hold every language's log probability, so a character costs
one lookup and shorter orders are read only where the longest is unknown. The language with the
least cross-entropy a character wins. How sure that is, and from which cross-entropy a text is
rejected, is calibrated on labelled documents that were not counted. Letters that are frequent
have a code of their own; every other one is spelled by two codes, so that none share one.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._store import drop, materialise, small_batches

ORDER, BITS = 5, 12
#: Letters with a code of their own; of the others, the page and the place in it have one. All fit into BITS.
OWN, PAGE, PAGES = 1900, 1024, 0x110000 // 1024
#: Labelled documents of a language that are used, on average; the sample is taken by hash of the id.
SAMPLE = 800
#: Share of good documents that calibration may reject, and the least distance in deviations.
REJECTED, LEAST_Z = 0.0005, 8.0
#: Characters that are scored at once.
WINDOW = 1 << 17
_MIX = np.uint64(0x9E3779B97F4A7C15)


class HashArray(NamedTuple):
    """Sorted hashes of keys, where each range of leading bits starts, and rows of values."""

    hashes: np.ndarray
    starts: np.ndarray
    shift: np.uint64
    rows: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key; -1 for those that aren't there."""
        want = keys * _MIX
        bucket = (want >> self.shift).astype(np.intp)
        at, end = self.starts[bucket], self.starts[bucket + 1]
        out = np.where(self.hashes[at] == want, at, -1)
        open_ = np.flatnonzero((out < 0) & (at + 1 < end))
        step = 1
        while len(open_):
            there = at[open_] + step
            hit = self.hashes[there] == want[open_]
            out[open_[hit]] = there[hit]
            step += 1
            open_ = open_[~hit & (there + 1 < end[open_])]
        return np.where(at < end, out, -1)


def hash_array(keys: np.ndarray, rows: np.ndarray) -> HashArray:
    hashes = keys.astype(np.uint64) * _MIX
    order = np.argsort(hashes)
    hashes = hashes[order]
    bits = max(1, int(2 * len(keys)).bit_length())
    edges = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    return HashArray(np.append(hashes, np.uint64(0)), np.append(edges, len(keys)).astype(np.int32), np.uint64(64 - bits), rows[order].astype(np.float32))


class Model(NamedTuple):
    langs: list[str]
    #: Code of each letter by code point; 0 for all that isn't a letter, 1 for letters that are spelled.
    codes: np.ndarray
    #: For orders 5 to 1, log probabilities; for orders 5 to 2, log weights of shorter orders by context.
    grams: list[HashArray]
    contexts: list[HashArray]


def letter_codes(letters: list[int]) -> np.ndarray:
    out = np.zeros(0x110000, np.uint16)
    out[[c for c in range(0x110000) if chr(c).isalpha()]] = 1
    out[letters] = np.arange(2, len(letters) + 2)
    return out


def normalise(texts: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, each after ORDER - 1 spaces and without its other runs of spaces; lengths with those spaces."""
    lower = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in lower])
    points = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    got = codes[points]
    spelled = got == 1
    if spelled.any():
        first = 2 + OWN
        got = np.repeat(got, 1 + spelled)
        at = np.flatnonzero(spelled) + np.arange(spelled.sum())
        got[at], got[at + 1] = first + points[spelled] // PAGE, first + PAGES + points[spelled] % PAGE
        ends = np.cumsum(sizes)
        sizes = sizes + np.diff(np.r_[0, np.cumsum(spelled)][np.r_[0, ends]])
    before = np.empty_like(got)
    before[:1], before[1:] = 0, got[:-1]
    starts = np.cumsum(sizes) - sizes
    before[starts[sizes > 0]] = 0
    keep = (got != 0) | (before != 0)
    doc = np.repeat(np.arange(len(texts)), sizes)[keep]
    kept = np.bincount(doc, minlength=len(texts))
    out = np.zeros(kept.sum() + (ORDER - 1) * len(texts), np.uint16)
    out[np.arange(len(doc)) + (ORDER - 1) * (doc + 1)] = got[keep]
    return out, kept + ORDER - 1


def gram_keys(codes: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Keys of the grams of ``order`` that end at each place from ``order`` - 1 on."""
    n = len(codes) - order + 1
    key = np.zeros(max(n, 0), np.uint64)
    for i in range(order):
        key = key << np.uint64(BITS) | codes[i : i + n].astype(np.uint64)
    return key


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << BITS * order) - 1)


def kneser_ney(counts: list[tuple[np.ndarray, np.ndarray]], letters: int, least: int = 1, longest: int = ORDER) -> tuple[list[HashArray], list[HashArray]]:
    """Tables from each language's sorted grams of order ``longest`` and their counts. Those counted fewer than
    ``least`` times are left to the shorter orders."""
    by_order: list[list[tuple[np.ndarray, np.ndarray]]] = [counts]
    for order in range(longest - 1, 0, -1):  # how many grams a shorter one ends
        by_order.append([tuple(np.unique(keys & _mask(order), return_counts=True)) for keys, _ in by_order[-1]])
    grams, contexts, lower, below = [], [], None, None
    for order in range(1, longest + 1):
        own = by_order[longest - order]
        kept = [n >= (least if order == longest else 1) for _, n in own]
        union = np.unique(np.concatenate([k[on] for (k, _), on in zip(own, kept, strict=True)]))
        heads = np.unique(np.concatenate([k >> np.uint64(BITS) for k, _ in own]))
        weight = np.ones((len(heads), len(own)))
        share = np.zeros((len(union), len(own)))
        for j, (keys, n) in enumerate(own):
            if not len(keys):
                continue
            n1, n2 = int((n == 1).sum()), int((n == 2).sum())
            d = n1 / (n1 + 2 * n2) if n1 else 0.5
            at = np.searchsorted(heads, keys >> np.uint64(BITS))
            total, kinds = np.bincount(at, n, len(heads)), np.bincount(at, minlength=len(heads))
            on = kept[j]
            share[np.searchsorted(union, keys[on]), j] = (n[on] - d) / total[at[on]]
            # what the grams that are kept leave: their discounts, and all of the others
            weight[kinds > 0, j] = (d * kinds[kinds > 0] + np.bincount(at[~on], n[~on] - d, len(heads))[kinds > 0]) / total[kinds > 0]
        base = 1 / (letters + 2) if order == 1 else below[np.searchsorted(lower, union & _mask(order - 1))]
        prob = share + weight[np.searchsorted(heads, union >> np.uint64(BITS))] * base
        grams.insert(0, hash_array(union, np.log(prob)))
        if order > 1:
            contexts.insert(0, hash_array(heads, np.log(weight)))
        else:
            unknown = np.log(weight[0] / (letters + 2))
        lower, below = union, prob
    # one more row at the end of single letters: what was never seen
    grams[-1] = grams[-1]._replace(rows=np.vstack([grams[-1].rows, unknown[None].astype(np.float32)]))
    return grams, contexts


def log_probs(model: Model, keys: np.ndarray) -> np.ndarray:
    """Each language's log probability of the last letter of each key (places x languages)."""
    at = model.grams[0].find(keys)
    out = model.grams[0].rows[at]
    todo = np.flatnonzero(at < 0)
    if len(todo):
        out[todo] = 0
    for i in range(1, len(model.grams)):
        if not len(todo):
            break
        order = len(model.grams) - i
        key = keys[todo]
        head = model.contexts[i - 1].find(key >> np.uint64(BITS) & _mask(order))
        known = head >= 0
        out[todo[known]] += model.contexts[i - 1].rows[head[known]]
        at = model.grams[i].find(key & _mask(order))
        hit = at >= 0 if order > 1 else np.ones(len(at), bool)
        out[todo[hit]] += model.grams[i].rows[at[hit]]  # -1 is the last row
        todo = todo[~hit]
    return out


def cross_entropies(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Nats a character for each text and language, and the characters."""
    codes, sizes = normalise(texts, model.codes)
    ends = np.cumsum(sizes)
    begins = ends - sizes + ORDER - 1
    total = np.zeros((len(texts), len(model.langs)))
    for a in range(ORDER - 1, len(codes), WINDOW):
        b = min(a + WINDOW, len(codes))
        got = log_probs(model, gram_keys(codes[a - ORDER + 1 : b]))
        first, last = np.searchsorted(ends, a, "right"), np.searchsorted(begins, b - 1, "right")
        for d in range(first, last):
            s, e = max(begins[d], a), min(ends[d], b)
            if s < e:
                total[d] += got[s - a : e - a].sum(axis=0, dtype=np.float64)
    n = sizes - ORDER + 1
    return -total / np.maximum(n, 1)[:, None], n


def _flushed(batch: pa.RecordBatch, most: int = 1 << 19) -> Iterator[list[int]]:
    """Places of texts, some at a time."""
    out, size = [], 0
    for i, n in enumerate(pa.compute.binary_length(batch["text"]).to_pylist()):
        out.append(i)
        size += n or 0
        if size > most:
            yield out
            out, size = [], 0
    if out:
        yield out


class Calibration(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray
    floor: np.ndarray
    z: float
    power: float
    beta: float

    def limit(self, best: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.mean[best] + self.z * np.sqrt(self.spread[best] ** 2 / np.maximum(n, 1) + self.floor[best] ** 2)

    def sure(self, h: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = -self.beta * (h - h.min(axis=1, keepdims=True)) * (np.maximum(n, 1) ** self.power)[:, None]
        return 1 / np.exp(x).sum(axis=1)


def calibrate(h: np.ndarray, n: np.ndarray, true: np.ndarray) -> Calibration:
    k = h.shape[1]
    own = h[np.arange(len(h)), true]
    mean, spread, floor = np.zeros(k), np.ones(k), np.full(k, 0.05)
    for j in range(k):
        on = true == j
        if on.sum() >= 10:
            mean[j] = np.average(own[on], weights=n[on])
            spread[j] = np.sqrt(np.mean((own[on] - mean[j]) ** 2 * n[on])) + 1e-6
            floor[j] = max(0.02, np.std(own[on & (n >= np.median(n[on]))]))
        elif len(own):
            mean[j], spread[j] = own.mean(), 10.0
    now = Calibration(mean, spread, floor, LEAST_Z, 0.5, 1.0)
    if not len(own):
        return now
    z = (own - mean[true]) / np.sqrt(spread[true] ** 2 / np.maximum(n, 1) + floor[true] ** 2)
    best = min(((p, b) for p in (0.0, 0.5, 1.0) for b in 2.0 ** np.arange(-4, 7)), key=lambda x: -np.log(_chance(now._replace(power=x[0], beta=x[1]), h, n, true)).sum())
    return now._replace(z=max(LEAST_Z, float(np.quantile(z, 1 - REJECTED)) * 1.5), power=best[0], beta=best[1])


def _chance(c: Calibration, h: np.ndarray, n: np.ndarray, true: np.ndarray) -> np.ndarray:
    x = -c.beta * (h - h.min(axis=1, keepdims=True)) * (np.maximum(n, 1) ** c.power)[:, None]
    p = np.exp(x)
    return np.maximum(p[np.arange(len(h)), true] / p.sum(axis=1), 1e-9)


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def learn(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id") -> tuple[Model, Calibration]:
    """The model from text and non-null lang of documents that aren't held out. Of those whose
    id's checksum leaves 1 the calibration is learned, from the others the counts. The list of
    languages is metadata and goes to the driver."""
    spark = docs.sparkSession
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.coalesce(remainder(id_col), F.lit(2)) != 0))
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], letter_codes([]), [], []), calibrate(np.zeros((0, 0)), np.zeros(0), np.zeros(0, int))
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, sample / sizes[lang]))])
    draw = F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), 11) / float(1 << 53)
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    picked = usable.filter(draw < share[F.col("lang")]).select("text", number[F.col("lang")].alias("j"), (F.coalesce(remainder(id_col), F.lit(2)) == 1).alias("held"))
    picked = materialise(picked, "language_sample")
    counted = picked.filter("not held") if len(picked.filter("not held").head(1)) else picked

    def letters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            c, n = np.unique(np.frombuffer("".join(t.lower() for t in batch["text"]).encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)
            yield pd.DataFrame({"c": c.astype(np.int64), "n": n}).loc[[chr(x).isalpha() for x in c]]

    seen = counted.mapInPandas(letters, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "c").limit(OWN).collect()
    codes = letter_codes([r["c"] for r in seen])

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for j, part in batch.groupby("j"):
                got, sizes = normalise(list(part["text"]), codes)
                ends = np.cumsum(sizes)
                ok = np.ones(len(got), bool)
                for b, e in zip(ends - sizes, ends, strict=True):
                    ok[b : min(b + ORDER - 1, e)] = False
                key, n = np.unique(gram_keys(got)[ok[ORDER - 1 :]], return_counts=True)
                yield pd.DataFrame({"j": np.full(len(key), j, np.int32), "key": key.astype(np.int64), "n": n})

    def built(table: pd.DataFrame) -> pd.DataFrame:
        counts = []
        for j in range(len(langs)):
            own = table.loc[table["j"] == j, ["key", "n"]].sort_values("key")
            counts.append((own["key"].to_numpy(np.uint64), own["n"].to_numpy()))
        tables = pickle.dumps(kneser_ney(counts, 2 + OWN + PAGES + PAGE))
        step = 1 << 23
        return pd.DataFrame({"at": range(0, len(tables), step), "part": [tables[i : i + step] for i in range(0, len(tables), step)]})

    # all languages' grams of the sample meet in one task, as tables hold a row for each gram and a value for
    # each language; the driver gets the finished tables
    table = counted.mapInPandas(grams, "j int, key long, n long").groupBy("j", "key").agg(F.sum("n").alias("n"))
    parts = table.withColumn("model", F.lit(0)).groupBy("model").applyInPandas(built, "at long, part binary").orderBy("at").collect()
    if parts:
        tables = pickle.loads(b"".join(r["part"] for r in parts))
    else:  # no letters at all
        tables = kneser_ney([(np.zeros(1, np.uint64), np.ones(1, np.int64)) for _ in langs], 2 + OWN + PAGES + PAGE)
    del parts
    model = Model(langs, codes, *tables)
    held = spark.sparkContext.broadcast(model)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            h, n = cross_entropies(held.value, list(batch["text"]))
            yield pd.DataFrame({"h": list(h), "n": n, "j": batch["j"]})

    told = picked.filter("held").mapInPandas(measured, "h array<double>, n long, j int").filter("n > 0").toPandas()
    held.destroy()
    drop(picked)
    h = np.stack(told["h"]) if len(told) else np.zeros((0, len(langs)))
    return model, calibrate(h, told["n"].to_numpy(np.float64), told["j"].to_numpy(np.int64))


def identify(docs: DataFrame, model: Model, calibration: Calibration, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred``, ``score`` (0 to 1), ``rejected`` and
    ``cross_entropy`` (bits a character).

    lang_pred is a learned language whenever the text has a letter; 'und', with score 0 and
    rejected, for null texts and texts without one, or if nothing was learned. rejected is true
    too where the cross-entropy is beyond what calibration allows for a text of that length.
    Ties go to the first language in order. A null id counts as not held out. Texts are read
    whole; repeated rows are judged each; other columns pass through, and those with the added
    names are replaced.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((model, calibration))
    added = ("held_out", "lang_pred", "score", "rejected", "cross_entropy")
    rows = docs.drop(*added).withColumn("held_out", F.coalesce(remainder(id_col) == 0, F.lit(False)))
    out = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, lang_pred string, score double, rejected boolean, cross_entropy double"

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, c = held.value
        for batch in batches:
            pred, score, away, bits = [], [], [], []
            for at in _flushed(batch):
                texts = [t or "" for t in batch["text"].take(pa.array(at)).to_pylist()]
                if not m.langs:
                    h, n, has = np.zeros((len(texts), 1)), np.zeros(len(texts)), np.zeros(len(texts), bool)
                    best = np.zeros(len(texts), int)
                else:
                    h, n = cross_entropies(m, texts)
                    has, best = n > 0, h.argmin(axis=1)
                sure = np.where(has, c.sure(h, n), 0.0)
                low = h[np.arange(len(h)), best]
                pred += [m.langs[b] if ok else "und" for b, ok in zip(best, has, strict=True)]
                score += sure.tolist()
                away += (~has | (low > c.limit(best, n) if m.langs else True)).tolist()
                bits += [x / np.log(2) if ok else None for x, ok in zip(low, has, strict=True)]
            more = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(away, pa.bool_()), pa.array(bits, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *added[1:]])

    return rows.mapInArrow(judged, out)


def identified_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, cross_entropy of every document."""
    model, calibration = learn(docs)
    return identify(docs.select("doc_id", "text"), model, calibration).drop("text")
