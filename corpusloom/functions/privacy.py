"""Detection and redaction of personal data in rubrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Detectors and what takes the place of a match, in the order they are applied.
DETECTORS = {
    "email": (r"(?U)\b[\w.+-]+@[\w-]+\.[\w.-]+\b", "[EMAIL]"),
    "ipv4": (r"(?U)\b(?:\d{1,3}\.){3}\d{1,3}\b", "[IP]"),
    "phone": (r"(?U)(?<!\d)(?:\+?\d[\d\s\x1c-\x1f().-]{7,}\d)(?!\d)", "[PHONE]"),
    "iban": (r"(?U)\b[A-Z]{2}\d{2}[A-Z0-9]{10,30}\b", "[IBAN]"),
    "bsn": (r"(?U)(?<!\d)\d{9}(?!\d)", "[ID]"),
    "url_creds": (r"(?U)\b\w+://[^\s\x1c-\x1f:@]+:[^\s\x1c-\x1f:@]+@[^\s\x1c-\x1f]+", "[URL]"),
}
#: Most specific first, so that no detector eats a part of what a later one means.
STRICT = ("url_creds", "iban", "ipv4", "email", "bsn", "phone")


class PrivacyError(ValueError):
    """Personal data in a field that must have none."""


def find_personal(c: Column) -> Column:
    """array<struct<kind, match>>: all matches of every detector in the text as it is."""
    text = F.coalesce(c, F.lit(""))

    def matches(kind: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(DETECTORS[kind][0]), F.lit(0))
        return F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), m.alias("match")))

    return F.flatten(F.array(*map(matches, DETECTORS)))


def kinds(c: Column) -> Column:
    """The sorted distinct kinds found."""
    return F.array_sort(F.array_distinct(F.transform(find_personal(c), lambda x: x["kind"])))


def blank_prose(c: Column, *, strict: bool = False) -> tuple[Column, Column]:
    """The text with each detector's matches replaced in turn, and the number of replacements.
    The detectors' own order lets phone numbers eat identity numbers; ``strict`` doesn't."""
    count = F.lit(0)
    for kind in STRICT if strict else DETECTORS:
        pattern, put = DETECTORS[kind]
        count = count + F.coalesce(F.regexp_count(c, F.lit(pattern)), F.lit(0))
        c = F.regexp_replace(c, pattern, put)
    return c, count


def gate(rows: DataFrame, *, strict: bool = False) -> tuple[DataFrame, int]:
    """``rows`` (name, category, description) with descriptions redacted, and how often.
    Personal data in a name or category raises PrivacyError with the kinds and the field."""
    for field in ("name", "category"):
        bad = rows.select(kinds(F.col(field)).alias("k")).filter(F.size("k") > 0).select(F.explode("k").alias("k")).distinct()
        hits = sorted(r["k"] for r in bad.collect())  # at most one row for each detector
        if hits:
            raise PrivacyError(f"personal data ({', '.join(hits)}) in '{field}'")
    text, n = blank_prose(F.col("description"), strict=strict)
    total = rows.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    return rows.withColumn("description", text), int(total)
