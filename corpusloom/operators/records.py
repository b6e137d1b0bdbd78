"""One record per ticket from tickets and their time entries.

Row order is meaning here (the first duplicate wins, ties in time keep their order), so both inputs
need ``_row``, the ordinal in their source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.text import record_text, strip

KEY = ("instance", "ticketnumber")


def with_columns(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``df`` with a null string column for each of ``names`` that it lacks."""
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})


def require(df: DataFrame, names: tuple[str, ...]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def key_text(c: Column) -> Column:
    """A key as stripped text; a missing one is the text 'nan' and still matches itself."""
    return F.coalesce(strip(c.cast("string")), F.lit("nan"))


def number(c: Column) -> Column:
    """A double; 0 for what isn't a number."""
    return F.coalesce(F.nanvl(c.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def joined_notes(entries: Column) -> Column:
    """Notes of array<struct<undated, at, row, summary, internal>> in order of time, undated ones
    last, without empty ones and those that repeat the one before."""
    texts = F.flatten(F.transform(F.array_sort(entries), lambda e: F.array(e["summary"], e["internal"])))
    texts = F.filter(texts, lambda t: t != "")
    fresh = F.filter(F.zip_with(texts, F.concat(F.array(F.lit("")), texts), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda x: x["a"].isNotNull() & (x["a"] != x["b"]))
    return F.array_join(F.transform(fresh, lambda x: x["a"]), " — ")


def entry_totals(entries: DataFrame) -> DataFrame:
    """notes, touches and entry_hours of each key."""
    entries = with_columns(entries, ("startdatetime", "summarynotes", "internalnotes", "hours"))
    entry = F.struct(
        F.col("startdatetime").isNull().alias("undated"),
        F.col("startdatetime").alias("at"),
        F.col("_row").alias("row"),
        record_text(F.col("summarynotes")).alias("summary"),
        record_text(F.col("internalnotes")).alias("internal"),
    )
    keyed = entries.withColumns({k: key_text(F.col(k)) for k in KEY})
    out = keyed.groupBy(*KEY).agg(F.collect_list(entry).alias("e"), F.count(F.lit(1)).cast("int").alias("touches"), F.sum(number(F.col("hours"))).alias("entry_hours"))
    return out.withColumn("notes", joined_notes(F.col("e"))).drop("e")


def first_rows(df: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """The row of least ``_row`` of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_row"))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def build_records(tickets: DataFrame, entries: DataFrame, *, limit: int | None = None) -> DataFrame:
    """Records, with ``kept`` false for those without any text: they are no records, but their
    hours count. With ``limit``, nothing after the last record that it lets in is looked at."""
    require(tickets, (*KEY, "_row"))
    require(entries, (*KEY, "_row"))
    tickets = with_columns(tickets, ("title", "description", "issue_type", "sub_issue_type", "hours"))
    rows = first_rows(tickets.withColumns({k: key_text(F.col(k)) for k in KEY}))
    rows = rows.join(entry_totals(entries), list(KEY), "left")
    own = number(rows["hours"])
    out = rows.select(
        F.concat_ws("::", *KEY).alias("ticket_id"),
        "instance",
        *[record_text(F.col(c)).alias(c) for c in ("title", "description")],
        F.coalesce("notes", F.lit("")).alias("notes"),
        *[record_text(F.col(c)).alias(c) for c in ("issue_type", "sub_issue_type")],
        F.when(own != 0, own).otherwise(F.coalesce("entry_hours", F.lit(0.0))).alias("hours"),
        F.coalesce("touches", F.lit(1)).alias("touches"),
        "_row",
    ).withColumn("kept", (F.col("title") != "") | (F.col("description") != "") | (F.col("notes") != ""))
    if limit:
        cut = out.filter("kept").orderBy("_row").limit(limit).agg(F.max("_row").alias("last"), F.count(F.lit(1)).alias("n"))
        out = out.join(F.broadcast(cut), (F.col("n") < limit) | (F.col("_row") <= F.col("last"))).drop("last", "n")
    return out


def records_only(built: DataFrame) -> DataFrame:
    return built.filter("kept").drop("kept")


def records_meta(built: DataFrame) -> DataFrame:
    """kept, dropped, kept_hours, dropped_hours, total_hours, hours rounded to 3 places."""
    hours = lambda kept: F.coalesce(F.sum(F.when(F.col("kept") == kept, F.col("hours"))), F.lit(0.0))
    out = built.agg(F.count(F.when(F.col("kept"), 1)).alias("kept"), F.count(F.when(~F.col("kept"), 1)).alias("dropped"), hours(True).alias("a"), hours(False).alias("b"))
    return out.select("kept", "dropped", F.round("a", 3).alias("kept_hours"), F.round("b", 3).alias("dropped_hours"), F.round(F.col("a") + F.col("b"), 3).alias("total_hours"))
