"""Canonical labels, synonyms and namespaced tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import SPACE, strip

PLACEHOLDER = "__placeholder__"

# Prefixes that are dropped, and the map from canonical labels to common ones.
PREFIX = rf"(?iU)^(?:qnp{SPACE}*-{SPACE}*|td{SPACE}+|ict{SPACE}*-{SPACE}*|klant{SPACE}*-{SPACE}*)"
SYNONYMS = {
    "wijziging": "change",
    "wijzigingen": "change",
    "aanvraag": "request",
    "verzoek": "request",
    "storing": "incident",
    "incident": "incident",
    "probleem": "problem",
    "vraag": "question",
    "melding": "report",
    "wachtwoord": "password",
    "wachtwoord reset": "password reset",
    "wachtwoord resetten": "password reset",
    "office 365": "microsoft 365",
    "o365": "microsoft 365",
    "m365": "microsoft 365",
    "microsoft365": "microsoft 365",
    "azure ad": "entra id",
    "azure active directory": "entra id",
    "aad": "entra id",
    "active directory": "active directory",
    "back up": "backup",
    "back-up": "backup",
    "gebruiker": "user",
    "nieuwe gebruiker": "new user",
    "nieuwe medewerker": "new user",
    "onboarding": "onboarding",
    "offboarding": "offboarding",
    "uit dienst": "offboarding",
    "in dienst": "onboarding",
    "printer": "printer",
    "afdrukken": "printing",
    "netwerk": "network",
    "internet": "network",
    "telefoon": "phone",
    "telefonie": "telephony",
    "mobiel": "mobile",
    "werkplek": "workplace",
    "werkplekbeheer": "workplace management",
    "beheer": "management",
    "server": "server",
    "e-mail": "email",
    "mail": "email",
    "postvak": "mailbox",
    "gedeeld postvak": "shared mailbox",
    "toegang": "access",
    "rechten": "permissions",
    "machtiging": "permissions",
    "machtigingen": "permissions",
    "licentie": "license",
    "beveiliging": "security",
    "back-up en restore": "backup and restore",
    "vpn": "vpn",
    "firewall": "firewall",
    "hardware": "hardware",
    "software": "software",
    "applicatie": "application",
    "toepassing": "application",
    "overig": PLACEHOLDER,
    "overige": PLACEHOLDER,
    "none": PLACEHOLDER,
    "not classified": PLACEHOLDER,
    "niet geclassificeerd": PLACEHOLDER,
    "onbekend": PLACEHOLDER,
    "n.v.t.": PLACEHOLDER,
    "nvt": PLACEHOLDER,
    "-": PLACEHOLDER,
}


def canonicalize(c: Column) -> Column:
    """Lower case, one prefix dropped, hyphens, slashes and punctuation as single spaces."""
    c = F.regexp_replace(F.lower(strip(c.cast("string"))), PREFIX, "")
    c = F.regexp_replace(F.translate(c, "_", " "), "[-/]+", " ")
    c = F.regexp_replace(c, r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f.]", " ")
    return F.coalesce(strip(F.regexp_replace(c, rf"(?U){SPACE}+", " ")), F.lit(""))


def normalize_label(c: Column, synonyms: dict[str, str] | None = None) -> Column:
    """The canonical label after one look-up of the whole of it; placeholders are empty."""
    given = SYNONYMS if synonyms is None else synonyms
    label = canonicalize(c)
    if given:
        label = F.coalesce(F.create_map(*[F.lit(x) for pair in given.items() for x in pair])[label], label)
    return F.when(label == PLACEHOLDER, "").otherwise(label)


def label_tokens(issue: Column, sub_issue: Column, synonyms: dict[str, str] | None = None) -> Column:
    """'issue=' and 'sub=' tokens of those labels that aren't empty."""

    def token(name: str, c: Column) -> Column:
        label = normalize_label(c, synonyms)
        return F.when(label != "", F.concat(F.lit(name), F.translate(label, " ", "_")))

    return F.array_compact(F.array(token("issue=", issue), token("sub=", sub_issue)))


def audit(records: DataFrame, synonyms: dict[str, str] | None = None, order: str = "_row") -> DataFrame:
    """raw, canonical, field (of the first row that has it) and n of each raw label, most first."""
    fields = F.array(*[F.struct(F.col(order).alias("o"), F.lit(i).alias("i"), F.lit(f).alias("field"), strip(F.col(f).cast("string")).alias("raw")) for i, f in enumerate(("issue_type", "sub_issue_type"))])
    rows = records.select(F.explode(fields).alias("x")).select("x.*").filter("raw != ''")
    first = F.min(F.struct("o", "i", "field"))
    out = rows.groupBy("raw").agg(first.alias("f"), F.count(F.lit(1)).alias("n"))
    out = out.select("raw", normalize_label(F.col("raw"), synonyms).alias("canonical"), "f.field", "n", "f.o", "f.i")
    return out.orderBy(F.desc("n"), "o", "i").drop("o", "i")
