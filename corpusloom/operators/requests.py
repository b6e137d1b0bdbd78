"""Descriptions to clean: what is left to do, groups, requests, answers, cost."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from corpusloom.functions.messages import group_message, parse_group
from corpusloom.functions.text import clean_description, prepass_description, without_controls
from corpusloom.operators.records import first_rows, key_text
from corpusloom.settings import DESCRIPTION_CHARS, GROUP_SIZE, MIN_CHARS

#: Items of a stretch, rounded down to whole groups: what a task orders and makes groups of.
STRETCH = 6144


def ticket_ids(tickets: DataFrame) -> DataFrame:
    """``tickets`` with ``ticket_id``, the same key that records have."""
    return tickets.withColumn("ticket_id", F.concat_ws("::", key_text(F.col("instance")), key_text(F.col("ticketnumber"))))


def descriptions(tickets: DataFrame) -> DataFrame:
    """ticket_id, text, _row of the first row of each ticket whose text is long enough."""
    first = first_rows(ticket_ids(tickets).select("ticket_id", "description", "_row"), ("ticket_id",))
    # always true, but not to the optimizer, which else cleans each text twice: for the filter and for the result
    text = F.when(F.monotonically_increasing_id() >= 0, prepass_description(F.col("description")))
    return first.select("ticket_id", text.alias("text"), "_row").filter(F.length("text") >= MIN_CHARS)


def latest(cache: DataFrame) -> DataFrame:
    """id and text of each id's last line (``_row``); a missing text is empty."""
    return cache.groupBy("id").agg(F.max_by(F.coalesce("text", F.lit("")), "_row").alias("text"))


def todo(items: DataFrame, cache: DataFrame) -> DataFrame:
    return items.join(cache.select(F.col("id").alias("ticket_id")), "ticket_id", "left_anti")


def groups(items: DataFrame, size: int = GROUP_SIZE, runs: int = 1) -> DataFrame:
    """custom_id, ids and descriptions of fixed chunks in the order of ``_row``.

    Chunks are numbered in one order over all items, as the reference of a batch needs; with
    ``runs`` over 1 items are dealt by hash into that many runs, each numbered on its own. Keys
    are ordered first, by ranges, and every STRETCH-th of them kept; texts then go to their
    stretch of the order, which holds whole chunks, so no task orders or reads them all.
    """
    run = F.pmod(F.xxhash64("ticket_id"), F.lit(runs)).cast("int").alias("run")
    key, stretch = F.struct(run, "_row", "ticket_id"), max(1, STRETCH // size) * size
    firsts, kind = _stretches(items.select(run, "_row", "ticket_id"), stretch)
    if not firsts:
        firsts = [((None, None, None), 0)]
    values = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(k, kind, strict=True)]) for k, _ in firsts]
    nth = F.array(*[F.lit(n) for _, n in firsts])
    rows = items.withColumn("run", run).withColumn("stretch", _last_not_after(F.array(*values), len(values), key))
    rows = rows.repartition(len(values), "stretch")
    place = F.row_number().over(Window.partitionBy("stretch").orderBy("_row", "ticket_id")) - 1
    rows = rows.withColumn("place", place).withColumn("chunk", F.floor(F.col("place") / size))
    item = F.struct("place", "ticket_id", "text")
    out = rows.groupBy("stretch", "run", "chunk").agg(F.array_sort(F.collect_list(item)).alias("g"))
    number = F.element_at(nth, F.col("stretch")) * (stretch // size) + F.col("chunk")
    name = F.format_string("g%06d", number)
    name = name if runs == 1 else F.concat(F.format_string("r%03d", F.col("run")), name)
    return out.select(name.alias("custom_id"), F.transform("g", lambda x: x["ticket_id"]).alias("ids"), F.transform("g", lambda x: x["text"]).alias("descriptions"))


def _stretches(keys: DataFrame, stretch: int) -> tuple[list[tuple[tuple, int]], StructType]:
    """The first key of every ``stretch`` keys of a run, in order, with its number in the run, and the type of keys."""
    # keys alone are held: what made them is costly, and dealing by ranges reads them twice
    keys = keys.persist(StorageLevel.MEMORY_AND_DISK)
    ranged = keys.repartitionByRange("run", "_row", "ticket_id").withColumn("part", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        before, seen = [], {}
        for part, of, n in sorted(map(tuple, ranged.groupBy("part", "run").count().collect())):
            before.append((part, of, seen.get(of, 0)))
            seen[of] = seen.get(of, 0) + n
        if not before:
            return [], keys.schema
        offsets = F.broadcast(keys.sparkSession.createDataFrame(before, "part int, run int, before long"))
        place = F.row_number().over(Window.partitionBy("part", "run").orderBy("_row", "ticket_id")) - 1
        placed = ranged.withColumn("place", place).join(offsets, ["part", "run"]).withColumn("place", F.col("place") + F.col("before"))
        found = placed.filter(F.col("place") % stretch == 0).orderBy("run", "place").select("run", "_row", "ticket_id", "place").collect()
    finally:
        ranged.unpersist()
        keys.unpersist()
    return [((r["run"], r["_row"], r["ticket_id"]), r["place"] // stretch) for r in found], keys.schema


def _last_not_after(firsts: Column, n: int, key: Column) -> Column:
    """The place, from 1, of the last of ``n`` ordered values that isn't after ``key``, by halving."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(firsts, at + s - 1) <= key, at + s).otherwise(at))


def requests(grouped: DataFrame, char_limit: int = DESCRIPTION_CHARS) -> DataFrame:
    return grouped.select("custom_id", group_message(F.col("descriptions"), char_limit).alias("message"))


def answers(results: DataFrame, grouped: DataFrame, keep_missing: bool = False) -> DataFrame:
    """id and text of what succeeded results (custom_id, answer) say of their groups.

    Unknown groups and answers that aren't JSON give nothing and stay to be done. So do items
    that an answer leaves out, unless ``keep_missing`` takes them as empty.
    """
    joined = results.join(grouped.select("custom_id", "ids"), "custom_id").withColumn("said", parse_group(F.col("answer"), F.size("ids")))
    rows = joined.filter("said is not null").select(F.posexplode("ids").alias("place", "id"), "said")
    rows = rows.select("id", F.element_at("said", F.col("place")).alias("text"))
    return rows.na.fill({"text": ""}) if keep_missing else rows.filter("text is not null")


def cost(items: DataFrame, size: int = GROUP_SIZE) -> DataFrame:
    """requests and input_tokens (a quarter of all characters) of a dry run."""
    return items.agg(F.ceil(F.count(F.lit(1)) / size).alias("requests"), F.floor(F.coalesce(F.sum(F.length("text")), F.lit(0)) / 4).alias("input_tokens"))


def twin(tickets: DataFrame, cleaned: DataFrame) -> DataFrame:
    """``tickets`` with descriptions from ``cleaned`` (id, text) where it has the ticket, even
    an empty one, else cleaned by rule; ``by_model`` says which."""
    there = cleaned.select(F.col("id").alias("ticket_id"), F.col("text").alias("_text"), F.lit(True).alias("by_model"))
    rows = ticket_ids(tickets).join(there, "ticket_id", "left")
    text = F.when(F.col("by_model"), without_controls(F.coalesce("_text", F.lit("")))).otherwise(clean_description(F.col("description")))
    return rows.withColumns({"description": text, "by_model": F.coalesce("by_model", F.lit(False))}).drop("_text", "ticket_id")
