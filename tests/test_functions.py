import json
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import labels, messages, privacy


def apply(spark, column, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, t {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_labels(spark):
    raw = ["  Back-Up ", "QNP - Wachtwoord reset", "td Printer", "a_b/c--d (e)!", None, "", "Overig", "Café  Nr. 5", "E-mail"]
    assert apply(spark, labels.canonicalize(F.col("t")), raw) == ["back up", "wachtwoord reset", "printer", "a b c d e", "", "", "overig", "café nr. 5", "e mail"]
    assert apply(spark, labels.normalize_label(F.col("t")), raw) == ["backup", "password reset", "printer", "a b c d e", "", "", "", "café nr. 5", "e mail"]
    assert apply(spark, labels.normalize_label(F.col("t"), {}), ["Overig"]) == ["overig"]
    assert len(labels.SYNONYMS) == 66


def test_tokens_and_audit(spark):
    rows = spark.createDataFrame([(1, " Storing ", "Overig"), (2, "Storing", "nieuwe gebruiker"), (3, None, "Storing"), (4, "", "x")], "_row long, issue_type string, sub_issue_type string")
    got = rows.orderBy("_row").select(labels.label_tokens(F.col("issue_type"), F.col("sub_issue_type"))).collect()
    assert [r[0] for r in got] == [["issue=incident"], ["issue=incident", "sub=new_user"], ["sub=incident"], ["sub=x"]]
    table = [tuple(r) for r in labels.audit(rows).collect()]
    assert table == [("Storing", "incident", "issue_type", 3), ("Overig", "", "sub_issue_type", 1), ("nieuwe gebruiker", "new user", "sub_issue_type", 1), ("x", "x", "sub_issue_type", 1)]


PLAIN = {
    "email": r"\b[\w.+-]+@[\w-]+\.[\w.-]+\b",
    "ipv4": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "phone": r"(?<!\d)(?:\+?\d[\d\s().-]{7,}\d)(?!\d)",
    "iban": r"\b[A-Z]{2}\d{2}[A-Z0-9]{10,30}\b",
    "bsn": r"(?<!\d)\d{9}(?!\d)",
    "url_creds": r"\b\w+://[^\s:@]+:[^\s:@]+@\S+",
}
TEXTS = ["mail pat@example.com or 192.0.2.7, call +31 20 123 4567.", "NL91ABNA0417164300", "https://bob:secret@host.example/x", "on 2026-01-27 11:03", "id 123456789 end", "clean words only", "", "é@x.example 1.2.3.4.5"]


def test_finding_and_blanking_against_plain_python(spark):
    found = apply(spark, privacy.find_personal(F.col("t")), TEXTS)
    for t, got in zip(TEXTS, found, strict=True):
        assert [(x.kind, x.match) for x in got] == [(k, m) for k, p in PLAIN.items() for m in re.findall(p, t)]
    text, n = privacy.blank_prose(F.col("t"))
    for t, got in zip(TEXTS, apply(spark, F.struct(text.alias("t"), n.alias("n")), TEXTS), strict=True):
        count = 0
        for k, p in PLAIN.items():
            t, more = re.subn(p, privacy.DETECTORS[k][1], t)
            count += more
        assert (got.t, got.n) == (t, count)
    strict, _ = privacy.blank_prose(F.col("t"), strict=True)
    assert apply(spark, strict, TEXTS[1:3]) == ["[IBAN]", "[URL]"]


def test_gate(spark):
    rows = spark.createDataFrame([("Reset", "Access", "ask pat@example.com"), ("Print", "Devices", "none")], "name string, category string, description string")
    out, n = privacy.gate(rows)
    assert n == 1 and {r.description for r in out.collect()} == {"ask [EMAIL]", "none"}
    with pytest.raises(privacy.PrivacyError, match="email.*'name'"):
        privacy.gate(rows.withColumn("name", F.lit("of a@b.example")))


def test_group_messages(spark):
    got = apply(spark, messages.group_message(F.col("t")), [[" a ", None, "x" * 1501], []], "array<string>")
    assert got[0] == f"--- TICKET 0 ---\na\n\n--- TICKET 1 ---\n\n\n--- TICKET 2 ---\n{'x' * 1500} …[truncated]" and got[1] == ""


def test_answers(spark):
    said = ['[{"id": 0, "text": " a "}, {"id": 2, "text": null}, {"id": 9, "text": "z"}, {"id": 0, "text": "b"}]', '```json\n[{"id": 1, "text": "x"}]\n```', "no json", '{"id": 0}', "[]"]
    assert apply(spark, messages.parse_group(F.col("t"), 3), said) == [{0: "b", 2: ""}, {1: "x"}, None, None, {}]


def test_naming_messages(spark):
    samples = [[("T", "a", "", "n" * 700), ("", "", "", "")]]
    got = apply(spark, messages.name_message(F.col("t")), samples, "array<struct<title: string, issue_type: string, sub_issue_type: string, notes: string>>")[0]
    assert got.splitlines()[:5] == ["Tickets in this cluster:", "", "--- ticket 1 ---", "title: T", "labels: a"] and f"notes: {'n' * 600}\n" in got
    named = apply(spark, messages.category_message(F.col("t")), [[(1, "a", "b")]], "array<struct<id: int, title: string, description: string>>")[0]
    assert json.loads(named.split("\n", 1)[1]) == [{"id": 1, "title": "a", "description": "b"}]
    judged = apply(spark, messages.judge_message(F.col("t")), [[("a", "b", ["x" * 300, "y", "z", "w"])]], "array<struct<title: string, description: string, examples: array<string>>>")[0]
    assert judged.splitlines()[2:] == ["[1] a — b", f"      e.g. {'x' * 200}", "      e.g. y", "      e.g. z"]
