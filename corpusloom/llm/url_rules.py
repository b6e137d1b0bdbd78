"""URL filter by association rules.

URL tokens that labelled pages share are mined with Spark's FP-growth; rules from token
combinations to a label are pruned by support, confidence and lift over the label's own rate, and a rule is
dropped, by a join over all rules, if a part of its tokens already gives the same label as surely. Pages are
matched through an inverted index from rarest token to rules: in the workers' memory up to a number of
rules, by a join with the same result beyond it. Explicit rules on hosts and paths come first.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._store import materialise

# The explicit rules, as verdict, host and path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Least pages of a rule, as share and number; least confidence and lift.
SUPPORT, LEAST_PAGES, CONFIDENCE, LIFT = 0.002, 20, 0.6, 1.2
#: Rules that workers hold at most; more are matched by a join.
HELD_RULES = 10_000
MINED = "tokens array<string>, verdict string, confidence double, pages long"


class Mined(NamedTuple):
    tokens: tuple[str, ...]
    verdict: str
    confidence: float
    pages: int

    def rank(self) -> tuple:
        """The surest first."""
        return -self.confidence, -self.pages, len(self.tokens), self.tokens, self.verdict


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and without '://'."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: parts of the host by place, segments of the path with digits as #,
    keys of the query, scheme and fragment."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    tag = lambda t, a: F.transform(F.filter(a, lambda x: x != ""), lambda x: F.concat(F.lit(t), x))
    tokens = F.concat(
        tag("host:", F.split(host, r"\.")),
        tag("path:", F.split(F.regexp_replace(path, "[0-9]+", "#"), r"[/.\-_]+")),
        tag("query:", F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^([^=]*)", 1))),
        tag("fragment:", F.array(F.regexp_extract(url, r"(?s)#(.*)$", 1))),
        tag("scheme:", F.array(F.regexp_extract(url, r"(?s)^(.*?)://", 1))),
    )
    return F.array_distinct(F.coalesce(tokens, F.array().cast("array<string>")))


def mine(pages: DataFrame, labels: DataFrame, *, page_id: str = "page_id", label_id: str = "doc_id", support: float = SUPPORT, least_pages: int = LEAST_PAGES, confidence: float = CONFIDENCE, lift: float = LIFT) -> tuple[DataFrame, str]:
    """The mined rules that are needed, as MINED, and the verdict of most labelled pages. A label
    blocks if it says toxic or of no quality; pages and labels that lack an id or a partner teach nothing."""
    blocks = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    said = labels.groupBy(F.col(label_id).alias("_id")).agg(F.max(blocks.cast("int")).alias("_block"))
    host, path = url_parts(F.col("url"))
    rows = pages.select(F.col(page_id).alias("_id"), url_tokens(F.col("url"), host, path).alias("_tokens")).join(said, "_id")
    verdict = F.when(F.col("_block") == 1, "block").otherwise("allow")
    rows = rows.select(F.array_append("_tokens", F.concat(F.lit("verdict:"), verdict)).alias("items"), "_block")
    counts = {r["_block"]: r["n"] for r in rows.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    usual = "block" if counts.get(1, 0) > counts.get(0, 0) else "allow"
    if not n:
        return pages.sparkSession.createDataFrame([], MINED), usual
    model = FPGrowth(itemsCol="items", minSupport=max(support, least_pages / n) if least_pages < n else 1.0, minConfidence=confidence).fit(rows.select("items"))
    label = F.element_at("consequent", 1)
    rate = F.when(label == "verdict:block", counts.get(1, 0) / n).otherwise(counts.get(0, 0) / n)
    rules = model.associationRules.filter(label.startswith("verdict:") & ~F.exists("antecedent", lambda x: x.startswith("verdict:")) & (F.col("confidence") >= lift * rate))
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), F.substring_index(label, ":", -1).alias("verdict"), "confidence", F.round(F.col("support") * n).cast("long").alias("pages"))
    return materialise(needed(materialise(rules, "mined")), "needed"), usual


def keyed(rules: DataFrame) -> DataFrame:
    """``rules`` with ``key``, the token of each that the fewest rules have."""
    often = rules.select(F.explode("tokens").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    held = rules.select("*", F.explode("tokens").alias("key")).join(often, "key")
    return held.groupBy(*rules.columns).agg(F.min_by("key", F.struct("_n", "key")).alias("key"))


def needed(rules: DataFrame) -> DataFrame:
    """MINED rules without those of which a proper part of the tokens gives the same verdict as surely.

    Being such a part is transitive, so it doesn't matter whether the part is itself needed: rules of one
    token go over all others first, since they alone clear most of what long urls share, and then what is left over itself.
    """
    parts = lambda rows: keyed(rows).select("key", "verdict", F.col("tokens").alias("_part"), F.col("confidence").alias("_as_sure"))

    def without(rows: DataFrame, by: DataFrame) -> DataFrame:
        pairs = rows.select("tokens", "verdict", "confidence", F.explode("tokens").alias("key")).join(by, ["key", "verdict"])
        pairs = pairs.filter((F.col("_as_sure") >= F.col("confidence")) & (F.size("_part") < F.size("tokens")) & (F.size(F.array_except("_part", "tokens")) == 0))
        return rows.join(pairs.select("tokens", "verdict").distinct(), ["tokens", "verdict"], "left_anti").select(*rows.columns)

    left = materialise(without(rules, parts(rules.filter(F.size("tokens") == 1))), "left")
    return without(left, parts(left))


class Matcher:
    """Mined rules by their rarest token."""

    def __init__(self, mined: list[Mined]):
        often = Counter(t for rule in mined for t in rule.tokens)
        self.by_token: dict[str, list[Mined]] = defaultdict(list)
        for rule in mined:
            self.by_token[min(rule.tokens, key=lambda t: (often[t], t))].append(rule)

    def best(self, tokens: list[str]) -> Mined | None:
        there = set(tokens)
        return min((x for t in tokens for x in self.by_token.get(t, ()) if there.issuperset(x.tokens)), key=Mined.rank, default=None)


def explicit_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null without one. Of rules equally long that with the longer host."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, at, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(at + start)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def held_best(rows: DataFrame, mined: list[Mined]) -> DataFrame:
    """``rows`` with mined_rule, mined_verdict and mined_confidence of the surest rule of its tokens; from memory."""
    matcher, kept = Matcher(mined), [c for c in rows.columns if c != "tokens"]

    def matched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [matcher.best(list(tokens)) for tokens in batch["tokens"]]
            out = [(" ".join(f.tokens), f.verdict, f.confidence) if f else (None, None, None) for f in found]
            yield pd.concat([batch[kept], pd.DataFrame(out, columns=["mined_rule", "mined_verdict", "mined_confidence"])], axis=1)

    had = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != "tokens")
    return rows.mapInPandas(matched, f"{had}, mined_rule string, mined_verdict string, mined_confidence double")


def joined_best(rows: DataFrame, mined: DataFrame) -> DataFrame:
    """The same by a join of each list of tokens, taken once, with the rules of its tokens."""
    rules = keyed(mined).withColumnRenamed("tokens", "_rule")
    pairs = rows.select("tokens").distinct().select("tokens", F.explode("tokens").alias("key")).join(rules, "key").filter(F.size(F.array_except("_rule", "tokens")) == 0)
    rank = F.struct(-F.col("confidence"), -F.col("pages"), F.size("_rule"), "_rule", "verdict")
    best = pairs.groupBy("tokens").agg(F.min_by(F.struct(F.array_join("_rule", " ").alias("mined_rule"), F.col("verdict").alias("mined_verdict"), F.col("confidence").alias("mined_confidence")), rank).alias("_best"))
    return rows.join(best, "tokens", "left").select(*[c for c in rows.columns if c != "tokens"], "_best.*")


def judge(pages: DataFrame, mined: DataFrame, usual: str, *, page_id: str = "page_id", explicit: tuple[tuple[str, str, str], ...] = RULES, held_rules: int = HELD_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule, mined_confidence of every page.

    ``rule`` and its verdict are the longest explicit rule that fits; else rule is null and the
    verdict is that of the surest mined rule whose tokens the url has, or ``usual`` without one. Rules as sure
    go by pages, then the fewest tokens, then the tokens' order.
    Null urls and urls without '://' have an empty host and path and are judged by what is left; urls are
    read whole, however long. Repeated pages are judged each, no pages give no rows. Other columns are ignored.
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), host.alias("host"), path.alias("path"), url_tokens(F.col("url"), host, path).alias("tokens"))
    some = mined.limit(held_rules + 1).collect()
    rows = joined_best(rows, mined) if len(some) > held_rules else held_best(rows, [Mined(tuple(r["tokens"]), r["verdict"], r["confidence"], r["pages"]) for r in some])
    rule, verdict = explicit_rule(F.col("host"), F.col("path"), explicit)
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, "mined_verdict", F.lit(usual)).alias("verdict"), "mined_rule", "mined_confidence")


def filter_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """judge() by the rules that ``labels`` teach; with no labels every page gets the usual verdict, allow."""
    mined, usual = mine(pages, labels)
    return judge(pages, mined, usual)
