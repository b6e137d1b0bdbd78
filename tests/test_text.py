import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T

def apply(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


MODES = (T.clean_description, T.clean_note, T.prepass_description)


#: Text as exported, and what descriptions, notes and descriptions for a model make of it.
CASES = [
    ("wor\x07d\x00 and\x1fmore", *["word andmore"] * 3),
    ("a_x0009_b _x0041_ _xD83D_ _x0007_ _x00e9_", *["a b A é"] * 3),
    ("one\r\n \n two\u2028three", *["one\ntwo\u2028three"] * 3),
    ("[CID:image@part] text<https://a.example/x> end", *["text end"] * 3),
    ("ask<mailto:a@b.example> of <tel:1> me", *["ask of me"] * 3),
    ("see https://x.example/y?z now", "see now", "see https://x.example/y?z now", "see now"),
    ("a <b>c</b></DIV >d <unknown> e", *["a c d <unknown> e"] * 3),
    ("lost ???? here, kept ??", *["lost here, kept ??"] * 3),
    ("ask\nVan: x\nrest", "ask", "ask", "ask\nVan: x\nrest"),
    ("ask\n > Subject : y", "ask", "ask", "ask\n> Subject : y"),
    ("ask\nmvg\nname", "ask", "ask", "ask\nmvg\nname"),
    ("ask\nmvgx stays", *["ask\nmvgx stays"] * 3),
    ("ask\n________ \nold", "ask", "ask", "ask\n________\nold"),
    ("ask ----- kept", *["ask ----- kept"] * 3),
    ("ask ** created VIA incoming email processor ** tail", "ask", "ask", "ask ** created VIA incoming email processor ** tail"),
    ("mvg\nasked\nVan: x", "", "", "mvg\nasked\nVan: x"),
    ("_x000D_\tVan:\ty", "", "", "Van: y"),
    (" nan ", *[""] * 3),
    ("NULL", *[""] * 3),
    ("from: me", "", "", "from: me"),
    ("tell from: me", *["tell from: me"] * 3),
]


def test_each_rule(spark):
    texts = [c[0] for c in CASES]
    for n, fn in enumerate((T.clean_description, T.clean_note, T.prepass_description), 1):
        for case, got in zip(CASES, apply(spark, fn, texts), strict=True):
            assert got == case[n], (fn.__name__, case[0])


def test_record_text(spark):
    assert apply(spark, T.record_text, [" a\t\n b\x1c\u3000c ", "None", None, "nano"]) == ["a b c", "", "", "nano"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Printer is jammed.\n\nKind regards,\nPat Example", "Printer is jammed."),
        ("Please help\nVan: Sam Sample\nOnderwerp: RE", "Please help"),
        ("We asked from: nobody", "We asked from: nobody"),
        ("mail me at x@y.example<mailto:x@y.example> soon", "mail me at x@y.example soon"),
        ("a_x000D__x000A_b", "a\nb"),
        ("see <thing> now", "see <thing> now"),
        (None, ""),
        ("  None ", ""),
    ],
)
def test_descriptions(spark, text, want):
    assert apply(spark, T.clean_description, [text]) == [want]


def test_cleaning_again_changes_nothing(spark):
    texts = ["a  b\n\n c <b>x</b>", "x https://a.example y", "tail\nmvg\nz", "plain"]
    for fn in MODES:
        once = apply(spark, fn, texts)
        assert apply(spark, fn, once) == once


def test_sizes_of_inputs(spark):
    texts = ["", "abc", "x" * 30_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    text, size = T.prepared_input(F.col("t"))
    assert [(len(r[0]), r[1]) for r in df.select(text, size).collect()] == [(0, 0), (3, 1), (24_000, 6000)]
