"""Near-duplicate detection by MinHash with tensored banding.

A document's set is its distinct shingles of five words. Two small collections of ``SIDE``
keys, each of two minhashes, are computed for a set; every pair of a key of one and a key of
the other names a table. So ``SIDE`` squared tables cost only 4 * ``SIDE`` minhashes. A table can hold
two sets together only if both of its halves do, so halves that are alone are dropped before
pairs are formed. Sets that differ are linked by their exact similarity on full sets.

Documents with equal sets are one class from the start. Within a table's bucket, members are
first compared with the bucket's most central class, whose buckets hold most: near copies link
to the text they were made from with one comparison each. What that links is contracted, and only
members of a bucket that are still in different components are compared further: pair by pair in
small buckets, block by block, without listing pairs, in large ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._components import components
from corpusloom.llm._store import drop, materialise, small_batches

WORDS, PERCENT = 5, 75
#: Keys of each collection. A pair at the threshold is found with probability
#: (1 - (1 - 0.75 ** 2) ** SIDE) ** 2 = 0.9999, nearer pairs with more.
SIDE = 12
#: Buckets' leaders that a class is compared with at first; the largest bucket whose open pairs are listed;
#: members of a block where larger buckets are compared.
PICKS, DENSE, BLOCK = 3, 24, 512
#: Bytes of text that are hashed at once.
CHUNK = 1 << 19

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += _U(32)
_RNG = np.random.default_rng(20240229)
_BASE = _U(0x5851F42D4C957F2D)
_STEP = _RNG.integers(1, 1 << 63, WORDS, np.uint64) * _U(2) + _U(1)
_A = _RNG.integers(1, 1 << 63, 4 * SIDE, np.uint64) * _U(2) + _U(1)
_B = _RNG.integers(0, 1 << 63, 4 * SIDE, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the base of the words' hashes and of its inverse."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            inverse = _U(pow(int(_BASE), -1, 1 << 64))
            self.up = np.cumprod(np.r_[_U(1), np.full(n - 1, _BASE)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[_U(1), np.full(n - 1, inverse)], dtype=np.uint64)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def pieces_of(text: bytes) -> Iterator[bytes]:
    """``text`` cut at white space, so that no more is hashed at once than CHUNK and a word."""
    at = 0
    while len(text) - at > CHUNK and (found := _BLANK.search(text, at + CHUNK)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the number of words of each."""
    words, counts = [], np.zeros(len(texts), np.int64)
    held: list[tuple[int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for piece in pieces_of(text):
            held.append((i, piece))
            size += len(piece)
            if size >= CHUNK:
                words.append(_hashed(held, counts))
                held, size = [], 0
    if held:
        words.append(_hashed(held, counts))
    return np.concatenate(words) if words else np.zeros(0, np.uint64), counts


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the runs of ``values`` from each of ``starts``, which rise, to each of ``ends``. Some runs at a time."""
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), 1 << 16):
        first, last = starts[i : i + (1 << 16)], ends[i : i + (1 << 16)]
        at = int(first[0])
        own = values[at : int(last[-1])].astype(np.uint64)
        up, down = _POWERS.to(len(own) + 1)
        own += _U(1)
        own *= up[:-1]
        total = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(own, out=total[1:])
        out[i : i + (1 << 16)] = (total[last - at] - total[first - at]) * down[first - at] + (last - first).astype(np.uint64) * _GOLD
    return mixed(out)


def _hashed(pieces: list[tuple[int, bytes]], counts: np.ndarray) -> np.ndarray:
    """Hashes of the words of pieces of texts; adds to the texts' ``counts``."""
    buf = np.frombuffer(b" ".join([*(p for _, p in pieces), b""]), np.uint8)
    space = _SPACE[buf]
    before = np.r_[True, space[:-1]]
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(space & ~before)  # the first space after each word
    edges = np.cumsum([len(p) + 1 for _, p in pieces])
    np.add.at(counts, [i for i, _ in pieces], np.diff(np.searchsorted(starts, np.r_[0, edges])))
    return span_hashes(_LOWER[buf], starts, ends)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text; all words as one if there are fewer."""
    words, counts = word_hashes(texts)
    n = max(0, len(words) - WORDS + 1)
    rolled = np.zeros(n, np.uint64)
    for j in range(WORDS):
        rolled += words[j : j + n] * _STEP[j]
    rolled = mixed(rolled)
    out, at = [], 0
    for k in counts.tolist():
        if k >= WORDS:
            out.append(np.unique(rolled[at : at + k - WORDS + 1]))
        elif k:
            out.append(mixed((words[at : at + k] * _STEP[:k]).sum(dtype=np.uint64, keepdims=True) + np.array([k], np.uint64) * _GOLD))
        else:
            out.append(np.zeros(0, np.uint64))
        at += k
    return out


def class_of(shingles: np.ndarray) -> int:
    """A number that equal sets share, as a signed long."""
    x = mixed(shingles * _GOLD).sum(dtype=np.uint64, keepdims=True) + _U(len(shingles))
    return int(mixed(x).view(np.int64)[0])


def half_keys(shingles: np.ndarray) -> np.ndarray:
    """2 * SIDE keys of two minhashes each, as signed longs."""
    least = np.full(len(_A), np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), 4096):
        np.minimum(least, (shingles[None, i : i + 4096] * _A[:, None] + _B[:, None]).min(axis=1), out=least)
    pair = mixed(least[::2]) * _GOLD + least[1::2]
    return mixed(pair + np.arange(len(pair), dtype=np.uint64)).view(np.int64)


def in_chunks(texts: Iterable[str | None], most: int = CHUNK) -> Iterator[list[bytes]]:
    out, size = [], 0
    for t in texts:
        out.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(out[-1])
        if size > most:
            yield out
            out, size = [], 0
    if out:
        yield out


def each_text(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column, of which few are held as Python strings at once."""
    for at in range(0, len(column), 64):
        yield from column.slice(at, 64).to_pylist()


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, cls, keys = [], [], []
        for texts in in_chunks(each_text(batch["text"])):
            for s in shingle_sets(texts):
                n.append(len(s))
                cls.append(class_of(s) if len(s) else None)
                keys.append(half_keys(s).tobytes() if len(s) else None)
        made = [pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(keys, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], *made], ["doc_id", "row", "n_shingles", "cls", "keys"])


def _half_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class and half."""
    for batch in batches:
        keys = np.frombuffer(b"".join(batch["keys"].to_pylist()), np.int64)
        k = 2 * SIDE
        half = np.tile(np.arange(k, dtype=np.int32), len(batch))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch["cls"].to_numpy(), k)), pa.array(half), pa.array(keys)], ["cls", "half", "key"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of classes u, v whose texts have PERCENT similar sets."""
    last: tuple[int | None, np.ndarray | None] = (None, None)
    for batch in batches:
        u, v = batch["u"].to_pylist(), batch["v"].to_pylist()
        own = [s for texts in in_chunks(each_text(batch["own"])) for s in shingle_sets(texts)]
        ok = np.zeros(len(batch), bool)
        for i, mine in enumerate(own):
            if last[0] != u[i]:
                last = (u[i], shingle_sets([batch["other"][i].as_py().encode("utf-8", "surrogatepass")])[0])
            both = len(np.intersect1d(mine, last[1], assume_unique=True))
            ok[i] = 100 * both >= PERCENT * (len(mine) + len(last[1]) - both)
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(ok)], ["u", "v", "ok"])


def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (u, v) and whether they are linked; ``texts`` has cls and text."""
    own = pairs.join(texts.select(F.col("cls").alias("v"), F.col("text").alias("own")), "v")
    rows = own.join(texts.select(F.col("cls").alias("u"), F.col("text").alias("other")), "u")
    return rows.select("u", "v", "own", "other").mapInArrow(_compared, "u long, v long, ok boolean")


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """doc_id, n_shingles, group and least of every row, and the row's ``row_col`` as ``row``. Rows of
    one ``group`` are linked, directly or not; ``least`` is its least id that isn't null. Both are null for empty sets."""
    small_batches(docs.sparkSession)
    row = F.col(row_col).cast("long") if row_col else F.lit(None).cast("long")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row.alias("row"))
    sketch = materialise(docs.mapInArrow(_sketched, "doc_id long, row long, n_shingles long, cls long, keys binary"), "sketch")
    classes = sketch.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("first"), F.min("n_shingles").alias("n"), F.first("keys").alias("keys"))
    classes = materialise(classes, "classes")
    merged = merge_classes(classes, docs)
    least = merged.join(classes.select("cls", "first"), "cls").groupBy("comp").agg(F.min("first").alias("least"))
    moved = merged.join(least, "comp").select("cls", "comp", "least")
    named = classes.select("cls", "first").join(moved, "cls", "left").select("cls", F.coalesce("comp", "cls").alias("group"), F.coalesce("least", "first").alias("least"))
    named = materialise(named, "named")  # so that Spark can split the rows of a class with very many copies
    return sketch.select("doc_id", "row", "n_shingles", "cls").join(named, "cls", "left").select("doc_id", "row", "n_shingles", "group", "least")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Words are runs of other than ASCII white space, A-Z lower-cased. Documents whose sets have
    100 * intersection >= 75 * union are linked, ties with 75 among them; component_id is the least doc_id that links
    reach. Without words or text a set is empty and linked with nothing. Repeated rows are
    equal sets. Rows with a null id keep a null component_id and are kept; they link others.
    Texts are hashed whole, however long, in 64 bits. An empty table gives an empty result. Other columns are ignored.
    """
    out = groups(docs, id_col=id_col, text_col=text_col)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def class_tables(classes: DataFrame) -> DataFrame:
    """cls and table for the pairs of those of a class's halves that another class has too."""
    halves = classes.select("cls", "keys").mapInArrow(_half_rows, "cls long, half int, key long")
    shared = halves.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("key")
    met = halves.join(shared, "key", "left_semi").groupBy("cls").agg(F.collect_list(F.struct("half", "key")).alias("h"))
    a = F.filter("h", lambda x: x["half"] < SIDE)
    b = F.filter("h", lambda x: x["half"] >= SIDE)
    tables = F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.xxhash64(x["key"], y["key"]))))
    return met.select("cls", F.explode(tables).alias("table"))


def table_buckets(rows: DataFrame) -> DataFrame:
    """table, cls and weight for all members of buckets of two classes or more. The weight of a
    class is the size of all its buckets: the text that near copies were made from has most."""
    sizes = rows.groupBy("table").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    # at most SIDE * SIDE tables of a class
    members = rows.join(sizes, "table").groupBy("cls").agg(F.sum("k").alias("weight"), F.collect_list("table").alias("t"))
    return members.select("cls", "weight", F.explode("t").alias("table"))


def _chosen(pairs: DataFrame, order: Column, most: int) -> DataFrame:
    """Of distinct ``pairs`` (u, v), at most ``most`` for each v: those of least ``order``."""
    best = F.slice(F.array_sort(F.collect_set(F.struct(order.alias("o"), "u"))), 1, most)
    return pairs.groupBy("v").agg(best.alias("x")).select(F.explode("x.u").alias("u"), "v")


def merge_classes(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """cls and comp for the classes that links to other classes reach."""
    tables = materialise(class_tables(classes), "tables")
    buckets = materialise(table_buckets(tables), "buckets")
    drop(tables)
    sizes = classes.select("cls", "n")
    met = buckets.select("cls").distinct().join(classes.select("cls", "first"), "cls")
    # a text of each class that shares a bucket; of rows that repeat an id, the one of the class
    texts = docs.join(met.withColumnRenamed("first", "doc_id"), "doc_id").mapInArrow(_own_class, "cls long, text string")
    texts = materialise(texts.dropDuplicates(["cls"]), "texts")

    def checked(pairs: DataFrame) -> DataFrame:
        n = pairs.join(sizes.select(F.col("cls").alias("u"), F.col("n").alias("nu")), "u").join(sizes.select(F.col("cls").alias("v"), F.col("n").alias("nv")), "v")
        near = n.filter(100 * F.least("nu", "nv") >= PERCENT * F.greatest("nu", "nv")).select("u", "v")
        return materialise(compare(near, texts), "links")

    leaders = buckets.groupBy("table").agg(F.max(F.struct("weight", "cls")).alias("top"))
    pairs = buckets.join(leaders, "table").filter("cls != top.cls").select(F.col("top.cls").alias("u"), F.col("cls").alias("v"), (-F.col("top.weight")).alias("w"))
    done = checked(_chosen(pairs, F.col("w"), PICKS))
    labels = components(done.filter("ok").select("u", "v")).select(F.col("node").alias("cls"), "comp")
    # buckets whose members are still in different components
    labelled = buckets.select("table", "cls").join(labels, "cls", "left").select("table", "cls", F.coalesce("comp", "cls").alias("comp"))
    apart = labelled.groupBy("table").agg(F.count(F.lit(1)).alias("k"), F.min("cls").alias("first"), F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a < b")
    open_ = materialise(labelled.join(apart.select("table", "k", "first"), "table"), "apart")
    sparse = open_.filter(F.col("k") <= DENSE).select("table", "cls", "comp")
    x, y = sparse.toDF("table", "u", "cu"), sparse.toDF("table", "v", "cv")
    pairs = x.join(y, "table").filter("u < v and cu != cv").select("u", "v").distinct()
    known = done.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    listed = checked(pairs.join(known, ["u", "v"], "left_anti"))
    more = listed.filter("ok").select("u", "v")
    dense = open_.filter(F.col("k") > DENSE)
    if dense.head(1):
        more = more.unionByName(materialise(compare_dense(dense, texts), "dense_links"))
    if more.head(1):
        labels = components(done.filter("ok").select("u", "v").unionByName(more)).select(F.col("node").alias("cls"), "comp")
    drop(buckets, texts, done, open_, listed)
    return labels


def compare_dense(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Links u, v between components within large buckets; ``rows`` have cls, comp and the
    bucket's first class. Large buckets that share members form a cluster; its largest component needs no
    comparison within itself, so blocks of all members meet blocks of those outside it, and a
    block of sets is an inverted index. Only links leave a task."""
    edges = rows.filter("cls != first").select(F.col("first").alias("u"), F.col("cls").alias("v")).distinct()
    clusters = components(edges).select(F.col("node").alias("cls"), F.col("comp").alias("cluster"))
    members = materialise(rows.select("cls", "comp").distinct().join(clusters, "cls"), "clusters")
    parts = members.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.groupBy("cluster").agg(F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("n"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    sizes = sizes.select("cluster", F.col("main.comp").alias("main"), blocks(F.col("n")).alias("nb"), blocks(F.col("n") - F.col("main.n")).alias("no"))
    full = members.join(sizes, "cluster").join(texts, "cls")
    place = lambda name, n: F.pmod(F.xxhash64("cls", F.lit(name)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = full.withColumn("b", place("b", "nb")).withColumn("o", every("no")).select("cluster", "b", "o", "cls", "comp", "text")
    right = full.filter("comp != main").withColumn("o", place("o", "no")).withColumn("b", every("nb")).select("cluster", "b", "o", "cls", "comp", "text")
    right = right.toDF(*right.columns)  # columns of its own, for the cogroup
    keys = ["cluster", "b", "o"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_block_links, "u long, v long")


def _block_links(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    out: list[tuple[int, int]] = []
    if len(left) and len(right):
        sets = [s for texts in in_chunks(list(left["text"])) for s in shingle_sets(texts)]
        sizes = np.array([len(s) for s in sets])
        values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        cls, comp = left["cls"].to_numpy(), left["comp"].to_numpy()
        others = [s for texts in in_chunks(list(right["text"])) for s in shingle_sets(texts)]
        for mine, own, part in zip(others, right["cls"], right["comp"], strict=True):
            lo, hi = np.searchsorted(values, mine, "left"), np.searchsorted(values, mine, "right")
            n = hi - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(sets))
            linked = np.flatnonzero((100 * both >= PERCENT * (sizes + len(mine) - both)) & (comp != part))
            out += [(int(cls[i]), int(own)) for i in linked[np.unique(comp[linked], return_index=True)[1]]]
    return pd.DataFrame(out, columns=["u", "v"], dtype=np.int64)


def _own_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s for texts in in_chunks(each_text(batch["text"])) for s in shingle_sets(texts)]
        own = [len(s) > 0 and class_of(s) == c for s, c in zip(sets, batch["cls"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch["cls"], batch["text"]], ["cls", "text"]).filter(pa.array(own, pa.bool_()))
