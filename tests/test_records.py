import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import records as R
from corpusloom.operators import requests as Q

TICKETS = "_row long, instance string, ticketnumber string, title string, description string, issue_type string, hours string"
ENTRIES = "_row long, instance string, ticketnumber string, startdatetime timestamp, summarynotes string, internalnotes string, hours string"


def day(n):
    return dt.datetime(2024, 1, n)


@pytest.fixture(scope="module")
def built(spark):
    tickets = [
        (0, " a ", "1", "title", None, "x", "2.5"),
        (1, "a", "1", "second of the same", None, "x", "9"),
        (2, "a", "2", "nan", " None ", "y", "3"),
        (3, "a", "2", "kept? no: the first is", "", "y", "3"),
        (4, "a", "3", "", "  two \n words ", None, "0"),
        (5, "a", "4", "t", "", None, "many"),
        (6, None, "5", "t", "", None, "1"),
        (7, "a", "6", "", None, None, None),
    ]
    entries = [
        (0, "a", "3", day(2), "later", "same", "1"),
        (1, "a", "3", day(1), "first", None, "0.5"),
        (2, "a", "3", None, "undated", "undated", "x"),
        (3, "a", "3", day(2), "same", "later", None),
        (4, "a", "6", day(1), "note", "", "4"),
        (5, "a", "99", day(1), "orphan", "", "4"),
        (6, None, " 5 ", day(1), "n", "", "4"),
    ]
    return R.build_records(spark.createDataFrame(tickets, TICKETS), spark.createDataFrame(entries, ENTRIES)).cache()


def test_records(built):
    got = {r.ticket_id: (r.title, r.description, r.notes, r.issue_type, r.sub_issue_type, r.hours, r.touches) for r in R.records_only(built).collect()}
    assert got == {
        "a::1": ("title", "", "", "x", "", 2.5, 1),
        "a::3": ("", "two words", "first — later — same — later — undated", "", "", 1.5, 4),
        "a::4": ("t", "", "", "", "", 0.0, 1),
        "nan::5": ("t", "", "n", "", "", 1.0, 1),
        "a::6": ("", "", "note", "", "", 4.0, 1),
    }


def test_meta(built):
    assert tuple(R.records_meta(built).first()) == (5, 1, 9.0, 3.0, 12.0)


@pytest.mark.parametrize(("limit", "meta"), [(1, (1, 0)), (2, (2, 1)), (5, (5, 1)), (9, (5, 1)), (0, (5, 1)), (None, (5, 1))])
def test_limit_stops_after_the_last_record(spark, limit, meta):
    tickets = [(i, "a", str(i), t, "", "", "1") for i, t in enumerate(["x", "", "x", "x", "x", "x"])]
    df = spark.createDataFrame(tickets, TICKETS).repartition(3)
    built = R.build_records(df, spark.createDataFrame([], ENTRIES), limit=limit)
    assert tuple(R.records_meta(built).first())[:2] == meta


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="ticketnumber"):
        R.build_records(spark.createDataFrame([(1, "a")], "_row long, instance string"), spark.createDataFrame([], ENTRIES))
    few = spark.createDataFrame([(1, "a", "1")], "_row long, instance string, ticketnumber string")
    assert R.build_records(few, few).filter("kept").count() == 0


def test_groups_and_answers(spark):
    items = spark.createDataFrame([(f"t{i}", f"text {i}", i) for i in range(5)], "ticket_id string, text string, _row long")
    cache = spark.createDataFrame([("t1", "old", 1), ("t1", "new", 2), ("t4", None, 3)], "id string, text string, _row long")
    assert {tuple(r) for r in Q.latest(cache).collect()} == {("t1", "new"), ("t4", "")}
    grouped = Q.groups(Q.todo(items, cache), 2)
    assert sorted((r.custom_id, r.ids) for r in grouped.collect()) == [("g000000", ["t0", "t2"]), ("g000001", ["t3"])]
    spread = Q.groups(items, 2, runs=3).collect()
    assert sorted(i for r in spread for i in r.ids) == ["t0", "t1", "t2", "t3", "t4"] and all(len(r.ids) <= 2 for r in spread)
    results = spark.createDataFrame([("g000000", '[{"id": 1, "text": "two"}]'), ("g000001", "broken"), ("g9", "[]")], "custom_id string, answer string")
    assert [tuple(r) for r in Q.answers(results, grouped).collect()] == [("t2", "two")]
    assert sorted(tuple(r) for r in Q.answers(results, grouped, keep_missing=True).collect()) == [("t0", ""), ("t2", "two")]
    assert tuple(Q.cost(items, 2).first()) == (3, 7)


def test_twin(spark):
    tickets = spark.createDataFrame([("a", "1", "x\nmvg", 1), ("a", "2", "y\nmvg", 2), ("a", "3", None, 3)], "instance string, ticketnumber string, description string, other long")
    cleaned = spark.createDataFrame([("a::1", ""), ("a::9", "z")], "id string, text string")
    got = {r.other: (r.description, r.by_model) for r in Q.twin(tickets, cleaned).collect()}
    assert got == {1: ("", True), 2: ("y", False), 3: ("", False)}


def test_short_descriptions_are_left_out(spark):
    rows = [("a", "1", "x" * 40, 1), ("a", "1", "y" * 50, 2), ("a", "2", "x" * 39, 3), ("a", "3", None, 4)]
    got = Q.descriptions(spark.createDataFrame(rows, "instance string, ticketnumber string, description string, _row long")).collect()
    assert [(r.ticket_id, r.text) for r in got] == [("a::1", "x" * 40)]


@pytest.mark.parametrize("runs", [1, 2])
def test_no_task_reads_all_groups(spark, runs):
    n = 20_000
    items = spark.range(n).select(F.concat(F.lit("t"), F.col("id")).alias("ticket_id"), F.lit("x").alias("text"), (F.col("id") * 7919 % n).alias("_row"))
    got = Q.groups(items, 12, runs).withColumn("part", F.spark_partition_id()).collect()
    rows = {r: i for i, r in items.select("_row", "ticket_id").collect()}
    named = {r.custom_id: list(r.ids) for r in got}
    order = [i for name in sorted(named) for i in named[name]]
    assert len(named) == len(got) and sorted(order) == sorted(rows)
    if runs == 1:
        assert order == sorted(rows, key=rows.get) and all(len(named[f"g{i:06}"]) == 12 for i in range(n // 12))
    parts = {r.part for r in got}
    assert max(sum(len(r.ids) for r in got if r.part == p) for p in parts) < n * 0.8


def test_groups_of_no_items(spark):
    assert Q.groups(spark.createDataFrame([], "ticket_id string, text string, _row long")).collect() == []
