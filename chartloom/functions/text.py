"""Text expressions; all stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.config import SHORT_TEXT_CHARS


# Every character that counts as white space, Unicode ones included.
SPACES = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
# A word: runs of plain characters, matched by the quick class, and of any others.
WORD = rf"(?:[!-~]++|[^!-~{SPACES}]++)++"


def strip(col: Column) -> Column:
    """Drop white space (line breaks too) at both ends."""
    return F.btrim(col, F.lit(SPACES))


def filled(value: Column) -> Column:
    """The value, or null where it is empty; computes the value once."""
    return F.get(F.filter(F.array(value), lambda v: v != ""), F.lit(0))


def word_count(col: Column) -> Column:
    """Number of words separated by white space."""
    return F.regexp_count(col, F.lit(WORD))


def truncate(col: Column, chars: int | None) -> Column:
    """The first characters; all of them without a number."""
    return col if chars is None else F.substring(col, 1, chars)


def is_blank(col: Column) -> Column:
    """True for null and for white space only."""
    return strip(F.coalesce(col, F.lit(""))) == ""


def is_short(col: Column, minimum: int = SHORT_TEXT_CHARS) -> Column:
    """True for null, empty and too short texts."""
    return F.length(F.coalesce(col, F.lit(""))) < minimum


def join_notes(sections: Column, separator: str = "\n") -> Column:
    return F.array_join(sections, separator)


# The labels that encounter notes carry.
NOTE_LABELS = (
    "MRN", "PATIENT", "ENCOUNTER DATE", "CHIEF COMPLAINT:", "SUBJECTIVE:", "OBJECTIVE:",
    "ASSESSMENT:", "PLAN:", "IMPRESSION:", "REASON FOR REFERRAL:", "page_id",
)
PAGE_LABELS = ("MRN", "PATIENT", "ENCOUNTER DATE")

# Values of these labels stand on one line.
ONE_LINE = (*PAGE_LABELS, "page_id")

# Other headings that end a value in front of them.
NOTE_HEADINGS = (
    "DATE", "SYMPTOMS", "HISTORY OF PRESENT ILLNESS", "PAST MEDICAL HISTORY", "MEDICATIONS",
    "ALLERGIES", "VITAL SIGNS", "PHYSICAL EXAM", "SOCIAL HISTORY", "DIAGNOSES", "FOLLOW-UP",
)


def field_name(label: str) -> str:
    """Column name of a label: ``ENCOUNTER DATE`` -> ``ENCOUNTER_DATE``."""
    return re.sub(r"\W+", "_", label.strip().rstrip(":").strip())


def _label_pattern(label: str) -> str:
    words = label.strip().rstrip(":").split()
    return r"\s+".join(re.escape(w) for w in words)


def _stops(known: Sequence[str]) -> str:
    return "|".join(_label_pattern(o) for o in sorted(set(known), key=lambda o: (-len(o), o)))


def mentions(upper: Column, word: str) -> Column:
    """Whether a text, given in upper case, holds a word in any case: what a search for a pattern
    with that word in it needs, at a fraction of its cost."""
    return F.contains(upper, F.lit(word.upper()))


def labelled_value(
    text: Column, label: str, others: Sequence[str] = (), upper: Column | None = None
) -> Column:
    """Value written after ``label:``, up to the next known label, over line ends.

    A label that occurs again adds its value on a new line.  Values of identity labels end
    with their line, and the first one counts.  Null when the label is absent or without a value.
    ``upper`` is the text in upper case where that has been computed already; texts without the
    label's first word are not searched.
    """
    known = (label, *others, *NOTE_LABELS, *NOTE_HEADINGS)
    stops = _stops(known)
    begin = rf"(?i)\b{_label_pattern(label)}\s*[:#][ \t]*"
    if label in ONE_LINE:
        pattern = rf"{begin}([^\n]*?)[ \t]*(?:\b(?:{stops})\s*[:#]|\n|\z)"
        value = filled(F.regexp_extract(text, pattern, 1))
    else:
        # a run of characters of which none begins a known label; only the first letters of words
        # that may be one are looked at, the rest of a word is taken at once
        first = "".join(sorted({c for o in known for c in (o.strip()[:1].upper(), o.strip()[:1].lower())}))
        quick = first.isascii() and first.isalpha() and all(o.strip() for o in known)
        run = (rf"[^{first}]++|(?!\b(?:{stops})\s*[:#])[{first}][A-Za-z0-9_]*+" if quick
               else rf"(?!\b(?:{stops})\s*[:#])[\s\S]")
        pattern = rf"{begin}((?:{run})*+)"
        values = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), strip)
        value = filled(F.array_join(F.array_remove(values, ""), "\n"))
    words = label.strip().rstrip(":").split()
    if not words or not words[0].isascii():
        return value
    return F.when(mentions(F.upper(text) if upper is None else upper, words[0]), value)
