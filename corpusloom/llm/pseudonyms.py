"""Format-preserving pseudonyms for personal data, with DataFrame functions only.

One pattern finds candidates; validation by kind (check digits, ranges, real calendar dates)
decides. Numbers and dates go through a keyed Feistel network on decimal digits and are walked
along its cycle until they are valid in their format again, so the mapping is one to one, equal
values get equal pseudonyms in every document, and separators stay. Addresses of electronic
mail and secrets have no numeric format: a keyed digest takes their place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Cycle walks end long before: the least likely format is valid for four values in ten. One that doesn't is an error.
WALKS = 96
KEY_SETTING = "spark.corpusloom.pii.key"
FIRST_DAY, DAYS = "1900-01-01", 73_049

# Candidate patterns by kind, in order of precedence.
PATTERNS = {
    "private_key": r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[\s\S]*?-----END [A-Z ]{0,30}PRIVATE KEY-----",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,})(?![A-Za-z0-9])",
    "assigned": r"(?i)(?<![A-Za-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}(?:\"[^\"\s]{6,}\"|'[^'\s]{6,}'|[^\s\"',;]{6,})(?-i)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+1[ .-]?[0-9]{3}[ .-]|(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[2-9][0-9]{2}[ .-]))[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "international": r"(?<![0-9A-Za-z])\+[1-9][0-9](?:[ ().-]{0,2}[0-9]){6,12}(?![0-9])",
    "ipv4": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/-])",
}
# Last, so that numbers of other kinds end a run: groups of digits, in which cards are looked for.
_OTHERS = "|".join(f"(?:{PATTERNS[k]})" for k in ("ssn", "phone", "date"))
PATTERNS["card"] = rf"(?<![0-9.])[0-9](?:[0-9 -](?<![ -](?![0-9]))(?<![ -](?={_OTHERS}))){{12,}}"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What is looked for inside an account number that fails its check; its groups of four leave no room for other kinds.
INNER = ("card",)
#: Groupings of cards.
GROUPED = r"\A(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})\z"


def _may_hold(text: Column) -> Column:
    """False only for texts that hold no candidate: each kind needs one of these, which are quick to find."""
    assigned = (text.contains("=") | text.contains(":")) & text.rlike("(?i)pass|pwd|secret|token|key")
    named = text.contains("AKIA") | text.contains("sk-") | (text.contains("_") & text.rlike("gh[pousr]_"))
    return text.rlike("[0-9][0-9.]") | text.contains("@") | text.contains("PRIVATE KEY-----") | named | assigned


def _pow10(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**i) for i in range(19)]), n + 1)


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _pad(value: Column, n: Column | int) -> Column:
    return F.lpad(value.cast("string"), n, "0")


def feistel(value: Column, digits: Column, kind: str | Column, key: str) -> Column:
    """A keyed permutation of the numbers of ``digits`` (2 to 18) decimal digits."""
    u = F.floor(digits / 2).cast("int")
    v = digits - u
    low = _pow10(v)

    def mixed(i: Column, b: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), kind if isinstance(kind, Column) else F.lit(kind), digits.cast("string"), i.cast("string"), b.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 14), 16, 10).cast("long")

    def turn(s: Column, i: Column) -> Column:
        size = F.when(i % 2 == 0, _pow10(u)).otherwise(low)
        return F.struct(s["b"].alias("a"), F.pmod(s["a"] + mixed(i, s["b"]), size).alias("b"))

    start = F.struct(F.floor(value / low).cast("long").alias("a"), F.pmod(value, low).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["a"] * low + s["b"])


def permute(value: Column, digits: Column, valid: Callable[[Column], Column], kind: str, key: str) -> Column:
    """The next number on the cycle of ``value`` that is valid."""

    def walked(x: Column) -> Column:
        y = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), x, lambda x, _: F.when(valid(x), x).otherwise(feistel(x, digits, kind, key)))
        # bound, so that it is computed once
        return _bound(y, lambda y: F.when(valid(y), y).otherwise(F.raise_error(F.lit("no valid number on the cycle")).cast("long")))

    return _bound(feistel(value, digits, kind, key), lambda x: F.when(valid(x), x).otherwise(walked(x)))


def _bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of ``value``, which is computed once however often it is used."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def _refill(match: Column, digits: Column) -> Column:
    """``match`` with its digits replaced by ``digits`` in order."""
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("s"))

    def step(state: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        return F.struct(
            F.when(digit, state["at"] + 1).otherwise(state["at"]).alias("at"),
            F.concat(state["s"], F.when(digit, F.substring(digits, state["at"], F.lit(1))).otherwise(c)).alias("s"),
        )

    return F.aggregate(_chars(match), start, step, lambda s: s["s"])


def _luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """Sum from the right; ``doubled_first``: the last digit is doubled."""

    def value(c: Column, i: Column) -> Column:
        x = c.cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return F.when(i % 2 == (0 if doubled_first else 1), twice).otherwise(x)

    return F.aggregate(F.transform(_chars(F.reverse(digits)), value), F.lit(0), lambda a, x: a + x)


def _mod97(text: Column) -> Column:
    """The remainder of letters and digits read as IBANs are, A as 10 to Z as 35."""
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(_chars(text), F.lit(0), lambda a, c: F.pmod(F.when(c.rlike("[0-9]"), a * 10).otherwise(a * 100) + value(c), F.lit(97)))


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    n = F.length(d)
    body = F.substring(d, F.lit(1), n - 1).cast("long")
    ok = F.pmod(_luhn_sum(d, False), F.lit(10)) == 0
    new = _pad(permute(body, n - 1, lambda x: F.lit(True), "card", key), n - 1)
    check = F.pmod(10 - F.pmod(_luhn_sum(new, True), F.lit(10)), F.lit(10))
    return F.when(ok, _refill(m, F.concat(new, check.cast("string"))))


def _cards(m: Column, key: str) -> Column:
    """A run of groups of digits with its cards replaced, and their number: at each group the first real
    grouping that is valid, or else the whole run if that is a card."""
    # lists of one bind what is computed once
    split = F.array(F.regexp_extract_all(m, F.lit("[0-9]+|[ -]"), F.lit(0)))
    run = F.transform(split, lambda t: F.struct(t.alias("t"), F.floor((F.size(t) + 1) / 2).cast("int").alias("groups"), F.length(F.array_join(F.filter(t, lambda c: c.rlike("[0-9]")), "")).between(13, 19).alias("number")))
    return F.get(F.filter(F.transform(run, lambda r: _run_cards(r["t"], r["groups"], r["number"], key)), lambda x: x["n"] > 0), F.lit(0))


def _run_cards(tokens: Column, groups: Column, number: Column, key: str) -> Column:
    def at_group(i: Column) -> Column:
        spans = F.transform(F.array(F.lit(1), F.lit(4), F.lit(5), F.lit(3), groups), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(tokens, 2 * i + 1, 2 * n - 1), "").alias("s")))
        ok = F.filter(spans, lambda x: (i + x["n"] <= groups) & (x["s"].rlike(GROUPED) | (number & (x["n"] == groups))) & (F.pmod(_luhn_sum(_digits(x["s"]), False), F.lit(10)) == 0))
        return F.transform(F.slice(ok, 1, 1), lambda x: F.struct(x["n"].alias("n"), _card(x["s"], key).alias("p")))

    def step(state: Column, x: Column) -> Column:
        card, free = F.get(x["found"], F.lit(0)), x["i"] >= state["next"]
        taken = free & card.isNotNull()
        before = F.when(x["i"] > 0, F.get(tokens, 2 * x["i"] - 1)).otherwise("")
        return F.struct(
            F.when(taken, x["i"] + card["n"]).otherwise(state["next"]).alias("next"),
            F.when(free, F.concat(state["p"], before, F.coalesce(card["p"], F.get(tokens, 2 * x["i"])))).otherwise(state["p"]).alias("p"),
            (state["n"] + taken.cast("int")).alias("n"),
        )

    found = F.transform(F.sequence(F.lit(0), groups - 1), lambda i: F.struct(i.alias("i"), at_group(i).alias("found")))
    start = F.struct(F.lit(0).alias("next"), F.lit("").alias("p"), F.lit(0).alias("n"))
    return F.aggregate(found, start, step, lambda x: F.struct(x["p"].alias("p"), x["n"].alias("n")))


def _ssn_ok(x: Column) -> Column:
    area, group, serial = F.floor(x / 1_000_000), F.pmod(F.floor(x / 10_000), F.lit(100)), F.pmod(x, F.lit(10_000))
    return (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)


def _ssn(m: Column, key: str) -> Column:
    x = _digits(m).cast("long")
    return F.when(_ssn_ok(x), _refill(m, _pad(permute(x, F.lit(9), _ssn_ok, "ssn", key), 9)))


def _phone(m: Column, key: str) -> Column:
    d = _digits(m)
    head, x = F.substring(d, F.lit(1), F.length(d) - 10), F.substring(d, -10, 10).cast("long")
    ok = lambda x: (x >= 2_000_000_000) & (F.pmod(F.floor(x / 10_000), F.lit(1000)) >= 200)
    # dialable numbers stay dialable, others stay others
    return _refill(m, F.concat(head, _pad(permute(x, F.lit(10), lambda y: ok(y) == ok(x), "phone", key), 10)))


def _international(m: Column, key: str) -> Column:
    d = _digits(m)
    n = F.length(d) - 2
    new = _pad(permute(F.substring(d, F.lit(3), n).cast("long"), n, lambda x: F.lit(True), "phone", key), n)
    return _refill(m, F.concat(F.substring(d, 1, 2), new))


def _ipv4(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: p.cast("int"))
    x = F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a * 256 + p)
    y = permute(x, F.lit(10), lambda x: x < 1 << 32, "ipv4", key)
    octets = [F.pmod(F.floor(y / (1 << s)), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]
    return F.when(~F.exists(parts, lambda p: p > 255), F.concat_ws(".", *octets))


def _iban(m: Column, key: str) -> Column:
    """All digits are permuted, long ones in two halves that depend on each other, and letters of the account are
    moved on in the alphabet by what the new digits say. The country and the form stay."""
    return _bound(F.replace(m, F.lit(" "), F.lit("")), lambda flat: _bound(_digits(F.substring(flat, F.lit(5), F.length(flat))), lambda d: _account(m, flat, d, key)))


def _account(m: Column, flat: Column, d: Column, key: str) -> Column:
    n, bban, country = F.length(d), F.substring(flat, F.lit(5), F.length(flat)), F.substring(flat, 1, 2)
    ok = (_mod97(F.concat(bban, F.substring(flat, 1, 4))) == 1) & (F.length(flat) >= 15) & (n >= 6)
    whole = _pad(feistel(d.cast("long"), n, "iban", key), n)
    half = F.floor(n / 2).cast("int")
    a, b = F.substring(d, F.lit(1), half), F.substring(d, half + 1, n - half)
    halves = _bound(_pad(feistel(a.cast("long"), half, F.concat(F.lit("iban a "), b), key), half), lambda a: F.concat(a, _pad(feistel(b.cast("long"), n - half, F.concat(F.lit("iban b "), a), key), n - half)))

    def made(new: Column) -> Column:
        return _bound(_moved(_refill(bban, new), new, key), finished)

    def finished(new: Column) -> Column:
        check = _pad(98 - _mod97(F.concat(new, country, F.lit("00"))), 2)
        return _spaced(m, F.concat(country, check, new))

    return F.when(ok, _bound(F.when(n <= 18, whole).otherwise(halves), made))


def _moved(account: Column, digits: Column, key: str) -> Column:
    """``account`` with its letters moved on in the alphabet, each by a keyed number of its place."""
    steps = F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), F.lit(f"iban letters {i}"), digits), 256) for i in (0, 1)])

    def moved(c: Column, i: Column) -> Column:
        step = F.conv(F.substring(steps, 2 * i + 1, F.lit(2)), 16, 10).cast("int")
        return F.when(c.rlike("[A-Z]"), F.char(65 + F.pmod(F.ascii(c) - 65 + step, F.lit(26)))).otherwise(c)

    return F.array_join(F.transform(_chars(account), moved), "")


def _spaced(match: Column, flat: Column) -> Column:
    """``flat`` with the spaces of ``match``."""
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("s"))

    def step(state: Column, c: Column) -> Column:
        space = c == " "
        return F.struct((state["at"] + F.when(space, 0).otherwise(1)).alias("at"), F.concat(state["s"], F.when(space, c).otherwise(F.substring(flat, state["at"], F.lit(1)))).alias("s"))

    return F.aggregate(_chars(match), start, step, lambda s: s["s"])


def _date(m: Column, key: str) -> Column:
    out = None
    for form in ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy"):
        fits = m.rlike("^" + form.translate(str.maketrans("yMd", "000")).replace("0", "[0-9]").replace(".", r"\.") + "$")
        day = F.datediff(F.try_to_date(F.when(fits, m), form), F.lit(FIRST_DAY).cast("date"))
        new = permute(day.cast("long"), F.lit(5), lambda x: x < DAYS, "date", key)
        new = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), new.cast("int")), form)
        new = F.when((day >= 0) & (day < DAYS), new)
        out = new if out is None else F.coalesce(out, new)
    return out


def _digest(m: Column, kind: str, key: str) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), m), 256), 1, 16)


def _replacement(m: Column, key: str, kinds: tuple[str, ...] = tuple(PATTERNS)) -> Column:
    """p, the pseudonym of a candidate, and n, how many values it replaces; null if none is valid."""
    whole = lambda kind: m.rlike(r"\A[0-9][0-9 -]{12,}\z" if kind == "card" else r"\A(?:" + PATTERNS[kind] + r")\z")
    assigned = r"(?s)^(.*?[=:][ \t]*[\"']?)(.*?)([\"']?)$"
    made = {
        "private_key": lambda: F.concat(F.lit("[KEY:"), _digest(m, "secret", key), F.lit("]")),
        "email": lambda: F.concat(F.lit("u"), _digest(F.lower(m), "email", key), F.lit("@example.invalid")),
        "secret": lambda: F.concat(F.lit("[SECRET:"), _digest(m, "secret", key), F.lit("]")),
        "assigned": lambda: F.concat(F.regexp_extract(m, assigned, 1), F.lit("[SECRET:"), _digest(F.regexp_extract(m, assigned, 2), "secret", key), F.lit("]"), F.regexp_extract(m, assigned, 3)),
        "iban": lambda: _iban(m, key),
        "ssn": lambda: _ssn(m, key),
        "phone": lambda: _phone(m, key),
        "international": lambda: _international(m, key),
        "ipv4": lambda: _ipv4(m, key),
        "date": lambda: _date(m, key),
    }
    one = lambda p: F.when(p.isNotNull(), F.struct(p.alias("p"), F.lit(1).alias("n")))
    out = F.lit(None).cast("struct<p:string,n:int>")
    for kind in reversed(kinds):
        new = _cards(m, key) if kind == "card" else one(made[kind]())
        if kind == "iban":
            new = F.coalesce(new, _inside(m, key))
        out = F.when(whole(kind), new).otherwise(out)
    return out


def _found(text: Column, pattern: str, key: str, kinds: tuple[str, ...]) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.struct(m.alias("m"), _replacement(m, key, kinds).alias("r")))


def _joined(text: Column, pattern: str, found: Column) -> Column:
    parts = F.split(text, pattern, -1)
    tail = F.zip_with(F.slice(parts, F.lit(2), F.size(found)), found, lambda s, x: F.concat(F.coalesce(x["r"]["p"], x["m"]), s))
    return F.concat(F.element_at(parts, 1), F.array_join(tail, ""))


def _number(found: Column) -> Column:
    return F.aggregate(found, F.lit(0), lambda a, x: a + F.coalesce(x["r"]["n"], F.lit(0)))


def _inside(m: Column, key: str) -> Column:
    """What later kinds make of a candidate that failed."""
    pattern = "|".join(f"(?:{PATTERNS[k]})" for k in INNER)
    # a list of one, so that what is found is computed once
    once = F.transform(F.array(_found(m, pattern, key, INNER)), lambda f: F.struct(_joined(m, pattern, f).alias("p"), _number(f).alias("n")))
    return F.get(F.filter(once, lambda x: x["n"] > 0), F.lit(0))


def pseudonymise(df: DataFrame, text_col: str = "text", key: str | None = None) -> DataFrame:
    """``df`` with pseudonyms in ``text_col`` and their number in ``n_pii`` (int).

    ``key`` comes from the setting spark.corpusloom.pii.key if it isn't given; without either, ValueError is raised,
    as anyone could undo what a published key does. Candidates that
    fail validation stay as they are, but for valid values inside runs of digits and failed account numbers. Null texts stay null with n_pii 0, empty texts empty. Texts
    and values are taken whole, however long; rows are independent, so repeated rows give repeated results. Of
    kinds that fit the same place the first in order counts. An empty table gives an empty one. Other columns pass through; one named n_pii is replaced.
    """
    key = key or df.sparkSession.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"no key: set {KEY_SETTING}")
    text = F.col(text_col)
    found = _found(text, ANY, key, tuple(PATTERNS))
    rows = df.drop("n_pii").withColumn("_found", F.when(_may_hold(text), found))
    rows = rows.withColumn("n_pii", F.coalesce(_number(F.col("_found")), F.lit(0)))
    new = _joined(text, ANY, F.col("_found"))
    return rows.withColumn(text_col, F.when(F.col("n_pii") > 0, new).otherwise(text)).drop("_found")


def pseudonymised_documents(docs: DataFrame, key: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms, n_chars brought up to date and n_pii."""
    return pseudonymise(docs, key=key).withColumn("n_chars", F.length("text").cast("long"))
