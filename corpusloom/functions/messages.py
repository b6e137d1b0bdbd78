"""Messages to and answers from language models, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import strip
from corpusloom.settings import DESCRIPTION_CHARS

CLEAN_SYSTEM = """Each numbered item is the text of one support request. Return the part that states
what is asked or what is wrong, word for word, without greetings, signatures, quoted replies and footers;
an empty text if nothing is left. Answer with a JSON array of {"id": number, "text": string} only."""
NAME_SYSTEM = """You see requests of one group. Name the recurring piece of work they have in common.
Answer with JSON only: {"title": string, "description": string, "coherent": boolean, "coherence_note": string};
coherent is false if they are several kinds of work."""
CATEGORY_SYSTEM = """Give each of the listed kinds of work one category out of about six to twelve that you derive
from this list alone. Answer with a JSON array of {"id": number, "category": string} in the order given."""
JUDGE_SYSTEM = """Grade a list of groups from 0 to 10: coherence (each group is one kind of work), distinctness (no
two groups are the same) and overall. Answer with JSON only:
{"coherence": number, "distinctness": number, "overall": number, "notes": string}."""


def strip_fences(c: Column) -> Column:
    """Without a fence of three backticks around it."""
    c = F.regexp_replace(strip(c), r"(?U)\A```(?:json)?[\s\x1c-\x1f]*", "")
    return strip(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]*```\z", ""))


def group_message(descriptions: Column, char_limit: int = DESCRIPTION_CHARS) -> Column:
    """One message of numbered descriptions, each cut at ``char_limit``."""

    def part(d: Column, i: Column) -> Column:
        text = strip(F.coalesce(d, F.lit("")))
        text = F.when(F.length(text) > char_limit, F.concat(F.substring(text, 1, char_limit), F.lit(" …[truncated]"))).otherwise(text)
        return F.concat(F.lit("--- TICKET "), i.cast("string"), F.lit(" ---\n"), text)

    return F.array_join(F.transform(descriptions, part), "\n\n")


def parse_group(answer: Column, n: Column | int) -> Column:
    """map<int, string> from position to text; null if the answer is no JSON array. Ids that
    aren't numbers or lie outside the group are dropped, the last of equal ids counts and a
    null text is empty."""
    body = strip_fences(answer)
    items = F.when(body.startswith("["), F.from_json(body, "array<struct<id: int, text: string>>"))
    ok = F.filter(items, lambda x: (x["id"] >= 0) & (x["id"] < n))
    last = F.filter(ok, lambda x, i: ~F.exists(F.slice(ok, i + 2, F.size(ok)), lambda y: y["id"] == x["id"]))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["id"], strip(F.coalesce(x["text"], F.lit(""))))))


def name_message(samples: Column) -> Column:
    """Samples (title, issue_type, sub_issue_type, notes) of one cluster for naming."""

    def part(s: Column, i: Column) -> Column:
        some = lambda label, c: F.when(c != "", F.concat(F.lit(label), c))
        labels = F.concat_ws(" / ", *[F.when(s[f] != "", s[f]) for f in ("issue_type", "sub_issue_type")])
        head = F.concat(F.lit("--- ticket "), (i + 1).cast("string"), F.lit(" ---"))
        return F.concat(F.concat_ws("\n", head, some("title: ", s["title"]), some("labels: ", labels), some("notes: ", F.substring(s["notes"], 1, 600))), F.lit("\n"))

    return F.concat(F.lit("Tickets in this cluster:\n\n"), F.array_join(F.transform(samples, part), "\n"))


def category_message(named: Column) -> Column:
    """array<struct<id, title, description>> as JSON."""
    return F.concat(F.lit("Named workflows:\n"), F.to_json(named))


def judge_message(clusters: Column) -> Column:
    """array<struct<title, description, examples>>, numbered, with at most three short examples."""

    def part(c: Column, i: Column) -> Column:
        head = F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), c["title"], F.lit(" — "), c["description"])
        examples = F.transform(F.slice(c["examples"], 1, 3), lambda e: F.concat(F.lit("      e.g. "), F.substring(e, 1, 200)))
        return F.array_join(F.concat(F.array(head), examples), "\n")

    return F.concat(F.lit("Candidate taxonomy clusters:\n\n"), F.array_join(F.transform(clusters, part), "\n"))
