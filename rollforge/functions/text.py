"""Exact text semantics as Column -> Column functions: stripping, line splitting, optional matches, and the roll's scalar operators.

Patterns below are written for Java but keep the meaning that they have where `\\s` and `\\d` are Unicode classes, `.` stops
at a line feed only, and a group that didn't match is null rather than empty.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in the wide sense, inside a character class.
BLANK = r"\s\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
S = f"[{BLANK}]"
D = r"\p{Nd}"
_BREAKS = "\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\u2028\u2029]"


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"\A{S}+|{S}+\z", "")


def split_lines(c: Column) -> Column:
    """Lines by every line boundary, without the empty one after a final break."""
    parts = F.split(c, _BREAKS)
    return let(parts, lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))


def clean_lines(lines: Column) -> Column:
    """Stripped lines without blank ones."""
    return F.filter(F.transform(lines, strip), lambda x: x != "")


def group(c: Column, pattern: str, n: int = 1) -> Column:
    """Group n of the first match, null if there is none. `(?d)`: only a line feed ends a line."""
    pattern = "(?d)" + pattern
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, n))


def found(c: Column, pattern: str) -> Column:
    return c.rlike("(?d)" + pattern)


def _digits() -> tuple[str, str]:
    wide = [(chr(i), unicodedata.decimal(chr(i), None)) for i in range(128, sys.maxunicode + 1)]
    wide = [(c, d) for c, d in wide if d is not None and ord(c) < 0x10000]
    return "".join(c for c, _ in wide), "".join(str(d) for _, d in wide)


WIDE_DIGITS = _digits()


def to_bigint(c: Column) -> Column:
    """A whole number in any script's decimal digits; null beyond 64 bits."""
    return F.translate(c, *WIDE_DIGITS).try_cast("bigint")


# --- scalar operators of the roll ---

#: OCR misreadings and their corrections, in the order in which they are applied.
CORRECTIONS = (
    ("Narne", "Name"),
    ("Narme", "Name"),
    ("Narnme", "Name"),
    ("Famale", "Female"),
    ("Gander", "Gender"),
)
#: Field labels that end a labelled value.
FIELDS = ("Name", "Father Name", "Mother Name", "Husband Name", "House Number", "Age", "Gender")


def detect_language(name: Column) -> Column:
    up = F.upper(name)
    return F.when(F.contains(up, F.lit("-TAM-")) | F.contains(up, F.lit("TAMIL")), "tam+eng").otherwise("eng")


def normalize_text(text: Column) -> Column:
    """Line feeds only, no zero-width characters, single spaces, stripped lines, no blank lines."""
    text = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    text = F.translate(text, "\u00a0\u200c\u200d\ufeff", " ")
    return F.array_join(clean_lines(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, "[ \t]+", " "))), "\n")


def replace_words(text: Column, corrections=CORRECTIONS) -> Column:
    """Literal replacements, one after the other."""
    for wrong, right in corrections:
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return text


def remove_words(text: Column, words) -> Column:
    return replace_words(text, [(w, "") for w in words])


def drop_lines_containing(text: Column, needles) -> Column:
    """Lines without any of the needles; lines aren't stripped."""
    bad = lambda x: _any(F.contains(x, F.lit(n)) for n in needles)
    return F.array_join(F.filter(split_lines(text), lambda x: ~bad(x)), "\n")


def _any(tests) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def drop_id_lines(text: Column) -> Column:
    """Stripped lines, without those that hold person ids only; blank lines stay."""
    return F.array_join(F.filter(F.transform(split_lines(text), strip), lambda x: ~x.rlike(rf"\A(?:[A-Z]{{3}}{D}{{7}}{S}*)+\z")), "\n")


def looks_like_id(line: Column) -> Column:
    return F.regexp_replace(line, "[^A-Za-z0-9]", "").rlike(r"(?i)\A[A-Z]{2,}[0-9]{5,}")


def normalize_id(token: Column) -> Column:
    """Upper case, a leading V read as Y, then each O as 0 and I as 1."""
    return let(F.upper(token), lambda u: F.translate(F.when(u.startswith("V"), F.concat(F.lit("Y"), F.substring(u, F.lit(2), F.length(u)))).otherwise(u), "OI", "01"))


def normalize_gender(value: Column, *, literal: bool = False) -> Column:
    """M, F or null. literal: look for the male words first, so that `female` gives M."""
    v = F.lower(strip(value))
    has = lambda *words: _any(F.contains(v, F.lit(w)) for w in words)
    male, female = has("male", "m", "ஆண்"), has("female", "f", "பெண்")
    if literal:
        return F.when(male, "M").when(female, "F")
    return F.when(female, "F").when(male, "M")


def labelled_values(line: Column, field: str) -> Column:
    """All values behind a label, each up to the next label or the end of the line."""
    ends = "|".join(f.replace(" ", r"\ ") for f in FIELDS)
    got = F.regexp_extract_all(line, F.lit(rf"(?diu){field}{S}*[:=+]{S}*(.*?)(?={S}+(?:{ends}){S}*[:=+]|$)"), F.lit(1))
    return F.transform(got, lambda x: F.btrim(x, F.lit(" -+=~")))


def column_spans(line: Column) -> Column:
    """array<struct<start, end>> of the columns that `Name :` begins; the last has no end."""
    parts = F.split(line, rf"(?=Name{S}*:)")
    starts = F.transform(parts, lambda _, i: F.aggregate(F.slice(parts, F.lit(1), i), F.lit(0), lambda acc, p: acc + F.length(p)))
    starts = F.filter(starts, lambda s: F.substring(line, s + 1, F.length(line)).rlike(rf"\AName{S}*:"))
    return let(starts, lambda at: F.transform(at, lambda s, i: F.struct(s.alias("start"), F.get(at, i + 1).alias("end"))))
