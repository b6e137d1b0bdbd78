"""Sharding by histogram sort: near-equal bytes, one exchange, JVM-side only.

The sort key of a row is (64-bit hash of its text, 64-bit hash of its id), so equal texts are
neighbours. Splitters are found by counting exact bytes below candidate key boundaries: each
round the interval that still holds a splitter is cut at evenly spaced probes and one aggregate
with map-side combine counts the bytes between them. What reaches the driver is bounded by
shards x probes, whatever the input. Rows are then exchanged once, for their slots.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm._store import materialise

#: Key bits that are settled after each round; the first 64 are the text's hash.
DEPTHS = (12, 24, 36, 48, 64, 76, 88, 100, 112, 128)
_SIGN = 1 << 63
#: Bits of the key by which rows that are alike in text and id differ.
PLACE_BITS = 24
#: Most slot buckets of a shard; bounds the broadcast offsets at shards x this.
MAX_BUCKETS = 4096


def with_keys(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Adds ``size`` (UTF-8 bytes, none for null, plus 8), ``text_crc32`` (null for null) and
    the key columns ``_h`` and ``_r`` and the row's ``_place``. Columns of those names are replaced."""
    text = F.col(text_col)
    return df.withColumns(
        {
            "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8,
            "text_crc32": F.crc32(text.cast("binary")),
            "_h": F.xxhash64(text),
            "_r": F.xxhash64(F.col(id_col).cast("string")).bitwiseAND(F.lit(-1 << PLACE_BITS)),
            "_place": F.monotonically_increasing_id(),
        }
    )


def told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with the last bits of ``_r`` by place where rows are alike in text and id; others keep theirs, so
    that they don't depend on how the table is split."""
    again = rows.groupBy("_h", "_r").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_h", "_r", F.lit(True).alias("_again"))
    if not again.head(1):
        return rows.drop("_place")
    place = F.shiftrightunsigned(F.xxhash64("_place"), 64 - PLACE_BITS)
    own = F.col("_r").bitwiseOR(F.when(F.col("_again"), place).otherwise(0))
    return materialise(rows.join(again, ["_h", "_r"], "left").withColumn("_r", own).drop("_place", "_again"), "shard_parted")


def _prefix(depth: int) -> list[Column]:
    """The key's first ``depth`` bits, in key order, as one or two long columns."""
    lift = lambda name: F.col(name).bitwiseXOR(F.lit(-_SIGN))
    if depth < 64:
        return [F.shiftrightunsigned(lift("_h"), 64 - depth), F.lit(0).cast("long")]
    if depth == 64:
        return [lift("_h"), F.lit(0).cast("long")]
    return [lift("_h"), F.shiftrightunsigned(lift("_r"), 128 - depth) if depth < 128 else lift("_r")]


def _joined(a: int, b: int, depth: int) -> int:
    return a % (1 << 64) if depth <= 64 else (a % (1 << 64)) << (depth - 64) | b % (1 << 64)


def _parts(prefix: int, depth: int) -> tuple[int, int]:
    """``prefix`` as the two signed longs that _prefix() gives."""
    signed = lambda x: x - (1 << 64) if x >= _SIGN else x
    if depth <= 64:
        return signed(prefix), 0
    return signed(prefix >> (depth - 64)), signed(prefix & ((1 << (depth - 64)) - 1))


def find_splitters(rows: DataFrame, n_shards: int, tolerance: float, group_slack: float) -> list[tuple[int, int]]:
    """The first (_h, _r) of each shard but the first. A splitter is taken as soon as the bytes
    below it miss their share by at most ``tolerance`` of a shard. It falls inside a group of
    equal texts only if both ends of the group miss by more than ``group_slack`` of a shard."""
    if n_shards == 1:
        return []
    found: dict[int, int] = {}
    open_at: dict[int, list[int]] = {0: list(range(1, n_shards))}
    base = {0: 0}
    total, last = None, 0
    for depth in DEPTHS:
        a, b = _prefix(depth)
        there = rows
        if last:
            pa, pb = _prefix(last)
            wanted = [_parts(p, last) for p in open_at]
            there = rows.filter(F.struct(pa.alias("a"), pb.alias("b")).isin([F.struct(F.lit(x).alias("a"), F.lit(y).alias("b")) for x, y in wanted]))
        counted = there.groupBy(a.alias("a"), b.alias("b")).agg(F.sum("size").alias("n")).collect()
        children: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for r in counted:
            key = _joined(r["a"], r["b"], depth)
            children[key >> (depth - last) if last else 0].append((key, r["n"]))
        if total is None:
            total = sum(n for _, n in children[0])
            if not total:
                return []
        share = total / n_shards
        slack = share * (group_slack if depth == 64 else tolerance)
        still: dict[int, list[int]] = defaultdict(list)
        bases: dict[int, int] = {}
        for parent, wanted_here in open_at.items():
            below, waiting = base[parent], list(wanted_here)
            for key, n in sorted(children[parent]):
                while waiting and waiting[0] * share < below + n:
                    k = waiting.pop(0)
                    under, over = k * share - below, below + n - k * share
                    if min(under, over) <= slack or depth == 128:
                        found[k] = (key if under <= over else key + 1) << (128 - depth)
                    else:
                        still[key].append(k)
                        bases[key] = below
                below += n
            for k in waiting:
                found[k] = 1 << 128
        open_at, base, last = still, bases, depth
        if not open_at:
            break
    signed = lambda x: (x & ((1 << 64) - 1)) - _SIGN
    return [(signed(s >> 64), signed(s)) for _, s in sorted(found.items()) if s < 1 << 128]


def shard_of(splitters: list[tuple[int, int]]) -> Column:
    """How many splitters the row's key has reached."""
    out = F.lit(0)
    for h, r in splitters:
        out = out + ((F.col("_h") > h) | ((F.col("_h") == h) & (F.col("_r") >= r))).cast("int")
    return out


def shard_rows(rows: DataFrame, n_shards: int = 24, tolerance: float = 0.001, group_slack: float = 0.02) -> DataFrame:
    """Puts every row of ``rows`` (of with_keys(), cut from its lineage) into a shard.

    Adds ``law`` ('bytes': sizes near equal), ``shard`` 0 to n_shards - 1, ``slot`` (gapless
    from 0 in each shard) and ``grown_shard`` (null under this law) and drops the keys.
    Null texts count as one group of equal texts of 8 bytes each. Rows that repeat text
    and id are parted by their place. Long texts are sizes like others, so a shard that holds one may be over its
    share. An empty table gives an empty result; shards may be
    empty if there are fewer rows than shards. Other columns pass through; columns with the
    added names are replaced. Equal texts stay together unless their group is itself larger
    than the slack. Slots follow no order, but are the same in each run, but for rows that repeat.
    """
    if "_place" in rows.columns:
        rows = told_apart(rows)
    splitters = find_splitters(rows, n_shards, tolerance, group_slack)
    buckets = max(16, min(MAX_BUCKETS, rows.count() // (n_shards * 20_000)))
    placed = rows.withColumn("shard", shard_of(splitters)).withColumn("_bucket", F.pmod(F.col("_r"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = Window.partitionBy("shard", "_bucket").orderBy("_h", "_r")
    return (
        placed.withColumn("_at", F.row_number().over(local) - 1)
        .join(F.broadcast(offsets), ["shard", "_bucket"])  # at most n_shards x MAX_BUCKETS rows
        .withColumns({"law": F.lit("bytes"), "slot": F.col("_before") + F.col("_at"), "grown_shard": F.lit(None).cast("int")})
        .drop("_h", "_r", "_bucket", "_at", "_before")
    )


def shard_documents(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """The digest of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = materialise(with_keys(docs).select("doc_id", "size", "text_crc32", "_h", "_r", "_place"), "shard_keys")
    return shard_rows(rows, n_shards).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
