import pytest

SF = "/root/testdata/sf0.001"

#: Columns of ``documents``, and others whose names operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, copies string, score string, shard string, cls string, keys string, law string, _part string, _block string, n_pii string, rejected string, target string"


def rows(items):
    return [(i, t, lang, src, len(t or ""), *["clash"] * 12) for i, t, lang, src in items]


LONG = " ".join(f"word{i % 977}x" for i in range(60_000))
EDGES = [
    (1, "one two three four five six seven", "en", "a"),
    (2, "one two three four five six seven", "en", "a"),
    (2, "one two three four five six seven", "en", "a"),
    (3, None, "en", "b"),
    (4, "", "en", None),
    (5, " \t\n ", None, None),
    (6, LONG, "fr", "c"),
    (7, LONG + " end", "fr", "c"),
    (None, "a row without an id", "en", "a"),
    (8, "short", None, "b"),
    (9, "12 34 -- !!", "en", "b"),
    (10, "Ünïcode \u00a0 d\u2028x <|endoftext|> y", "de", "b"),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(rows(EDGES), SCHEMA).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()
