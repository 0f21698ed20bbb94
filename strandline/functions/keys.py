"""Document keys: cleaning, extraction, parents, years, pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions.text import fold_dashes

# Patterns of keys in running text, of words that follow them, of parts of a work.
KEY_IN_TEXT = r"\b(10\.[0-9]{4,9}/[-._;()/:a-zA-Z0-9]+)"
PAGE_WORDS = r"(received|accepted|published|available|downloaded|http).*$"
REVIEW_PART = r"^(10\.[0-9]{4,9}/\S+?)(?:\.v?[0-9]+)?\.sa[0-9]+$"
VIDEO_PART = r"^(10\.3791/[0-9]+)-v$"
# Beginnings of keys that stand for a journal, not a document.
BLOCKED = ("10.1016/j.brs.0000",)
# Fixed value: characters of the shortest key.
SHORTEST = 12


def clean_key(c: Column) -> Column:
    """A key as printed to its canonical form, or null.

    In order: trim and lower-case; dashes to hyphens; closing punctuation off; white space out;
    trailing words of the page off; one final stop off; blocked, malformed and short keys null.
    """
    d = fold_dashes(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")))
    d = F.regexp_replace(d, r"""[).,;:'"\]}>]+$""", "")
    d = F.regexp_replace(d, r"(?U)\s+", "")
    d = F.regexp_replace(d, PAGE_WORDS, "")
    d = F.regexp_replace(d, r"\.$", "")
    blocked = F.lit(False)
    for b in BLOCKED:
        blocked = blocked | F.startswith(d, F.lit(b))
    return F.when(~blocked & d.rlike(r"^10\.[0-9]{4,9}/\S+$") & (F.length(d) >= SHORTEST), d)


def bare_key(c: Column) -> Column:
    """A key without the address of its resolver, lower-cased; null unless it starts with 10."""
    d = F.regexp_replace(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), r"^(https?://(dx\.)?doi\.org/|doi:\s*)", "")
    return F.when(F.startswith(d, F.lit("10.")), d)


def find_keys(text: Column) -> Column:
    """All keys in a text, cleaned, distinct, in order of first occurrence."""
    raw = F.regexp_extract_all(fold_dashes(text), F.lit(KEY_IN_TEXT), 1)
    return F.array_distinct(F.array_compact(F.transform(raw, clean_key)))


def parent_key(c: Column) -> Column:
    """Key of the work of which a registered part is given; null if it is no part."""
    a, b = F.regexp_extract(c, REVIEW_PART, 1), F.regexp_extract(c, VIDEO_PART, 1)
    return F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))


def year_in_key(c: Column) -> Column:
    """The year from 1950 to 2049 that a key holds on its own."""
    return F.nullif(F.regexp_extract(c, r"(?<![0-9])(19[5-9][0-9]|20[0-4][0-9])(?![0-9])", 1), F.lit("")).cast("int")


def page_span(c: Column) -> Column:
    """Number of pages of "284-290" (at least 1), 1 for a single page, 0 if unstated."""
    a, b = F.regexp_extract(c, r"^\s*([0-9]+)\s*[-–]+\s*([0-9]+)", 1), F.regexp_extract(c, r"^\s*([0-9]+)\s*[-–]+\s*([0-9]+)", 2)
    return F.when(b != "", F.greatest(F.lit(1), b.cast("int") - a.cast("int") + 1)).when(c.rlike(r"^\s*[0-9]+\s*$"), 1).otherwise(0)


def is_preprint_key(c: Column, prefixes: tuple[str, ...] = ("10.1101/", "10.31234/", "10.48550/", "10.21203/")) -> Column:
    got = F.lit(False)
    for p in prefixes:
        got = got | F.coalesce(F.startswith(F.lower(c), F.lit(p)), F.lit(False))
    return got


def content_digest(c: Column) -> Column:
    """Sixteen hexadecimal digits of a text's SHA-1, the fallback key of files."""
    return F.substring(F.sha1(c), 1, 16)
