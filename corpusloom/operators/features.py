"""Feature vectors: unit blocks, weighted combination, cached embeddings behind a provider."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import prepared_input, strip
from corpusloom.settings import EMBED_WIDTH, FIELDS, INPUT_CHARS, INPUT_TOKENS, REQUEST_ITEMS, REQUEST_TOKENS, WEIGHT_ORDER

CACHE_SCHEMA = "field string, ticket_id string, text_hash long, model string, vec array<float>"


class Embedder(Protocol):
    """What turns texts into vectors; an implementation may call a remote service."""

    model: str
    width: int

    def embed(self, keys: list[str], texts: list[str]) -> list[np.ndarray]: ...


class Tokenizer(Protocol):
    """What counts and cuts tokens."""

    def encode(self, text: str) -> list[int]: ...

    def decode(self, ids: list[int]) -> str: ...


def prepare_with(tokenizer: Tokenizer):
    """A function of a text column: the text cut to the limits of characters and tokens, and the
    size it is counted as, the larger of its tokens and a quarter of its characters."""

    @F.pandas_udf("text string, size int")
    def prepared(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            text = (text or "")[:INPUT_CHARS]
            ids = tokenizer.encode(text)
            if len(ids) > INPUT_TOKENS:
                ids = ids[:INPUT_TOKENS]
                text = tokenizer.decode(ids)
            out.append((text, max(len(ids), -(-len(text) // 4))))
        return pd.DataFrame(out, columns=["text", "size"])

    return prepared


class RequestTooLarge(Exception):
    """A provider refused a request for its size."""


class StubEmbedder:
    """Offline vectors of unit length that depend on the key alone and are the same in every process."""

    def __init__(self, width: int = EMBED_WIDTH, model: str = "stub"):
        self.width, self.model = width, model

    def embed(self, keys: list[str], texts: list[str]) -> list[np.ndarray]:
        def one(key: str) -> np.ndarray:
            seed = int.from_bytes(hashlib.blake2b(key.encode(), digest_size=8).digest(), "little")
            v = np.random.default_rng(seed).standard_normal(self.width)
            return (v / np.linalg.norm(v)).astype(np.float32)

        return [one(k) for k in keys]


def unit(v: Column) -> Column:
    """Of unit length; zero vectors stay as they are. Arrays of one bind the vector and its norm, which else
    are computed anew for each component."""

    def divided(a: Column) -> Column:
        norm = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        by = lambda n: F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n)).otherwise(a.cast("array<double>"))
        return F.get(F.transform(F.array(norm), by), F.lit(0))

    return F.get(F.transform(F.array(v), divided), F.lit(0))


def dense(tokens: Column, vocabulary: list[str]) -> Column:
    """A map from token to weight as an array in the order of ``vocabulary``."""
    return F.transform(F.array(*[F.lit(t) for t in vocabulary]), lambda t: F.coalesce(F.element_at(tokens, t), F.lit(0.0)))


def combine(weights: tuple[float, ...], blocks: dict[str, Column]) -> Column:
    """Unit blocks scaled by their weights, side by side, at unit length. Blocks of weight 0
    are left out, so their columns are never read; all zero raises ValueError."""

    def scaled(block: Column, w: float) -> Column:
        return F.transform(block, lambda x: x * w)

    used = [scaled(blocks[n], w) for n, w in zip(WEIGHT_ORDER, weights, strict=True) if w > 0]
    if not used:
        raise ValueError("all weights are zero")
    return unit(F.concat(*used))


def batches(sizes: list[int], most_tokens: int = REQUEST_TOKENS, most_items: int = REQUEST_ITEMS) -> Iterator[tuple[int, int]]:
    """(start, end) of greedy batches in order; a first item is always let in."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and (total + n > most_tokens or i - start >= most_items):
            yield start, i
            start, total = i, 0
        total += n
    if sizes:
        yield start, len(sizes)


def batch_numbers(sizes: Column, most_tokens: int = REQUEST_TOKENS, most_items: int = REQUEST_ITEMS) -> Column:
    """The greedy batch, from 0, of each of an ordered array of sizes, as an expression."""
    start = F.struct(F.lit(0).alias("b"), F.lit(0).cast("long").alias("t"), F.lit(0).alias("k"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, n: Column) -> Column:
        flush = (s["k"] > 0) & ((s["t"] + n > most_tokens) | (s["k"] >= most_items))
        b = F.when(flush, s["b"] + 1).otherwise(s["b"])
        return F.struct(b.alias("b"), (F.when(flush, 0).otherwise(s["t"]) + n).cast("long").alias("t"), (F.when(flush, 0).otherwise(s["k"]) + 1).alias("k"), F.concat(s["out"], F.array(b)).alias("out"))

    return F.aggregate(sizes, start, step, lambda s: s["out"])


def embed_with_split(provider: Embedder, keys: list[str], texts: list[str]) -> list[np.ndarray]:
    """One request, or halves of it where the provider finds it too large."""
    try:
        return provider.embed(keys, texts)
    except RequestTooLarge:
        if len(keys) < 2:
            raise
        half = len(keys) // 2
        return embed_with_split(provider, keys[:half], texts[:half]) + embed_with_split(provider, keys[half:], texts[half:])


def inputs(records: DataFrame, field: str, tokenizer: Tokenizer | None = None) -> DataFrame:
    """ticket_id, and text and size of the embedding input of ``field``; cut by tokens too with a tokenizer."""
    text = strip(F.col(field))
    if tokenizer is None:
        cut, size = prepared_input(text)
        return records.select("ticket_id", cut.alias("text"), size.alias("size"))
    return records.select("ticket_id", prepare_with(tokenizer)(text).alias("_in")).select("ticket_id", "_in.*")


def embed_missing(records: DataFrame, cache: DataFrame, field: str, provider: Embedder, tokenizer: Tokenizer | None = None) -> DataFrame:
    """Vectors, in the cache's columns, of non-empty texts of ``field`` that the cache lacks. A
    text that changed or another model isn't in the cache."""
    todo = inputs(records, field, tokenizer).withColumn("field", F.lit(field)).filter("text != ''")
    todo = todo.withColumns({"text_hash": F.xxhash64("text"), "model": F.lit(provider.model)})
    todo = todo.join(cache.select("field", "ticket_id", "text_hash", "model"), ["field", "ticket_id", "text_hash", "model"], "left_anti")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            keys, texts = (part["field"] + "\x00" + part["ticket_id"]).tolist(), part["text"].tolist()
            for a, b in batches(part["size"].tolist()):
                vectors = embed_with_split(provider, keys[a:b], texts[a:b])
                yield part.iloc[a:b][["field", "ticket_id", "text_hash", "model"]].assign(vec=vectors)

    return todo.mapInPandas(run, CACHE_SCHEMA)


def embedded(records: DataFrame, cache: DataFrame, field: str, provider: Embedder, tokenizer: Tokenizer | None = None) -> DataFrame:
    """ticket_id and unit vector of every record; zeros where the text is empty."""
    own = inputs(records, field, tokenizer).select("ticket_id", F.xxhash64("text").alias("text_hash"))
    there = cache.filter((F.col("field") == field) & (F.col("model") == provider.model)).select("ticket_id", "text_hash", "vec")
    zero = F.array_repeat(F.lit(0.0).cast("float"), provider.width)
    return own.join(there, ["ticket_id", "text_hash"], "left").select("ticket_id", unit(F.coalesce("vec", zero)).alias(field))


def feature_blocks(records: DataFrame, cache: DataFrame, provider: Embedder, labels: DataFrame, vocabulary: list[str], tokenizer: Tokenizer | None = None) -> DataFrame:
    """ticket_id with a unit block for each of the fields and for the labels."""
    out = labels.select("ticket_id", dense(F.col("cat"), vocabulary).alias("cat"))
    for field in FIELDS:
        missing = embed_missing(records, cache, field, provider, tokenizer)
        out = out.join(embedded(records, cache.unionByName(missing), field, provider, tokenizer), "ticket_id")
    return out
