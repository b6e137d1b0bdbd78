"""Cleaning of exported free text, as Column expressions.

Python's notions are kept: white space is Unicode's plus the four separators 1C to 1F, lines end
at line feeds only, and case is folded beyond ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"
SOLID = r"[^\s\x1c-\x1f]"

# What is noise, and where useful content ends.
ILLEGAL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
ESCAPE = r"_x([0-9A-Fa-f]{4})_"
INLINE_IMAGE = r"(?iu)\[cid:[^\]]*\]"
WRAPPED_LINK = rf"(?U){SPACE}*<(?:mailto:|tel:|https?://)[^>]*>"
BARE_URL = rf"(?U)https?://{SOLID}+"
HTML_TAG = r"(?iU)</?(?:p|br|div|span|a|b|i|u|strong|em|ul|ol|li|table|tr|td|th|thead|tbody|img|font|h[1-6]|blockquote|hr|pre|code)\b[^>]*>"
LOST_CHARACTERS = r"\?{3,}"
FOOTER = rf"(?iU:\*\*{SPACE}*Created via Incoming Email Processor{SPACE}*\*\*)"
THREAD = rf"(?imdU:^[ \t>]*(?:van|verzonden|onderwerp|from|sent|subject){SPACE}*:{SPACE}*{SOLID})"
SIGN_OFF = r"(?imdU:^[ \t]*(?:met (?:vriendelijke|hartelijke) groet(?:en)?|vriendelijke groet(?:en)?|hartelijke groet(?:en)?|kind regards|best regards|mvg)\b)"
RULE = r"(?md:^[ \t]*[-_]{6,}[ \t]*$)"
NULLISH = ("nan", "none", "null", "")

#: The earliest of these and all that follows.
BOUNDARY = rf"(?:{FOOTER}|{THREAD}|{SIGN_OFF}|{RULE})[\s\S]*"
UNPRINTABLE = r"[\p{C}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def nullish(c: Column) -> Column:
    return c.isNull() | F.lower(strip(c)).isin(*NULLISH)


def without_controls(c: Column) -> Column:
    """Without the control characters that worksheets refuse."""
    return F.regexp_replace(c, ILLEGAL, "")


def decode_escapes(c: Column) -> Column:
    """Escapes of four hexadecimal digits become the character they stand for, in one pass:
    carriage returns and line feeds a line feed, what can't be printed a space."""

    def character(code: Column) -> Column:
        code = F.upper(code)
        surrogate = code.rlike("^D[89A-F]")
        read = F.regexp_replace(F.decode(F.unhex(F.when(surrogate, F.lit("0020")).otherwise(code)), "UTF-16BE"), UNPRINTABLE, " ")
        return F.when(code.isin("000A", "000D"), F.lit("\n")).otherwise(read)

    pieces = F.split(c, ESCAPE, -1)
    codes = F.regexp_extract_all(c, F.lit(ESCAPE), F.lit(1))
    rest = F.zip_with(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), F.transform(codes, character), lambda p, x: F.concat(x, p))
    return F.when(F.size(codes) > 0, F.concat(F.element_at(pieces, 1), F.array_join(rest, ""))).otherwise(c)


def until_boundary(c: Column) -> Column:
    """Up to the first footer, quoted header, sign-off or rule."""
    return F.regexp_replace(c, BOUNDARY, "")


def scrub(c: Column, *, drop_urls: bool, cut: bool) -> Column:
    c = decode_escapes(without_controls(c))
    c = until_boundary(c) if cut else c
    steps = [(INLINE_IMAGE, " "), (WRAPPED_LINK, "")]
    steps += [(BARE_URL, " ")] if drop_urls else []
    steps += [(HTML_TAG, " "), (LOST_CHARACTERS, " "), (r"[ \t\f\x0B]+", " "), (rf"(?U){SPACE}*\n{SPACE}*", "\n")]
    for pattern, put in steps:
        c = F.regexp_replace(c, pattern, put)
    return strip(c)


def _clean(c: Column, *, drop_urls: bool, cut: bool) -> Column:
    text = c.cast("string")
    return F.when(nullish(text), "").otherwise(scrub(text, drop_urls=drop_urls, cut=cut))


def clean_text(c: Column, *, drop_urls: bool) -> Column:
    """Scrubbed and cut; null and texts that say null are empty."""
    return _clean(c, drop_urls=drop_urls, cut=True)


def clean_description(c: Column) -> Column:
    return clean_text(c, drop_urls=True)


def clean_note(c: Column) -> Column:
    """As a description, but links are kept."""
    return clean_text(c, drop_urls=False)


def prepass_description(c: Column) -> Column:
    """Scrubbed but not cut, for a later reader to judge."""
    return _clean(c, drop_urls=True, cut=False)


def record_text(c: Column) -> Column:
    """On one line, single spaces; null and texts that say null are empty."""
    text = c.cast("string")
    return F.when(nullish(text), "").otherwise(strip(F.regexp_replace(text, rf"(?U){SPACE}+", " ")))


def prepared_input(c: Column) -> tuple[Column, Column]:
    """An embedding input, cut to its limit, and the size it is counted as without a tokenizer."""
    from corpusloom.settings import INPUT_CHARS

    text = F.substring(c, 1, INPUT_CHARS)
    return text, F.ceil(F.length(text) / 4).cast("int")
