"""String expressions: folds, comparison keys, quotation tests. Column in, Column out.

All are native expressions, except ``similarity_ratio`` and ``unescape_html``, for which
Spark has no equal; those are Arrow functions. Null in gives null out, unless a docstring
says otherwise.
"""

from __future__ import annotations

import difflib
import functools
import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Dashes that stand for a hyphen.
DASHES = "‐‑‒–—―⁃−­﹘﹣－"
# Words that a compact title leaves out.
STOP_WORDS = (
    "a", "an", "and", "as", "at", "by", "for", "from", "in", "into", "of", "on",
    "or", "the", "to", "with", "is", "are", "its", "via", "using", "based",
)
# Patterns of tags, formula commands, ellipses, titles of replies, typesetting stamps.
WELL_FORMED_TAG = r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>\n]{0,120})?/?>"
FORMULA_COMMAND = r"\\(mathrm|mathbf|text|textit|mathit|operatorname|mu|pm|times|cdot|circ|sim|approx|le|ge|leq|geq|,|;|!| )"
ELLIPSIS = r"\[\s*(?:\.\.\.|…)\s*\]|\.\.\.|…"
REPLY = r"(?i)^\s*(?:(?:response|reply|comment(?:ary)?|correction|corrigendum|erratum|letter|author\s+response)\b[\s:,-]*(?:to|on|re|regarding|concerning)?\b|re(?=\s*[:.]))"
STAMP = r"(?i)^\s*(untitled|none|unknown|microsoft word.*|using [a-z]+ format|doi:.*|.*\.(pdf|indd|tex|dvi|qxd)|[a-z]{0,6}[._-]?\d{4,}.*|\d[\d\s.]*|.*\b\d+\.\.\d+)\s*$"
# The entities that are decoded natively, in this order; &amp; last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"))


@functools.cache
def _accents() -> tuple[str, str]:
    """Letters from U+00C0 to U+024F and U+1E00 to U+1EFF whose decomposition starts with a-z."""
    pairs = []
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(cp))[0]
        if base != chr(cp) and base.isascii() and base.isalpha():
            pairs.append((chr(cp), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once: inside a lambda an expression over a column
    would be evaluated for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold_dashes(c: Column) -> Column:
    return F.translate(c, DASHES, "-" * len(DASHES))


def strip_accents(c: Column) -> Column:
    """Accented Latin letters to their base letter; combining marks dropped."""
    return F.regexp_replace(F.translate(c, *_accents()), r"\p{M}+", "")


def squeeze(c: Column) -> Column:
    """Runs of any white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def title_key(c: Column) -> Column:
    """Comparison key of a title: lower-case a-z and 0-9 only; '' for null."""
    return F.coalesce(F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]", ""), F.lit(""))


def name_slug(c: Column) -> Column:
    """Family name as lower-case letters only; '' for null."""
    return F.coalesce(F.regexp_replace(F.lower(strip_accents(c)), "[^a-z]", ""), F.lit(""))


def compact_title(c: Column, words: int = 8) -> Column:
    """CamelCase of the first words that are no stop words (of all, if only those); short
    upper-case words stay, a title all in capitals is set in title case first."""
    plain = strip_accents(c)
    plain = F.when((F.upper(plain) == plain) & plain.rlike("[A-Z]"), F.initcap(F.regexp_replace(plain, "[^A-Za-z0-9]+", " "))).otherwise(plain)
    every = F.regexp_extract_all(plain, F.lit("([A-Za-z0-9]+)"), 1)
    kept = F.filter(every, lambda w: ~F.lower(w).isin(*STOP_WORDS))
    kept = F.when(F.size(kept) > 0, kept).otherwise(every)
    keep_as_is = lambda w: (F.upper(w) == w) & w.rlike("[A-Z]") & (F.length(w) <= 6)
    cased = F.transform(F.slice(kept, 1, words), lambda w: F.when(keep_as_is(w), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 100_000))))
    return F.array_join(cased, "")


def paper_stem(year: Column, family: Column, title: Column) -> Column:
    fam = name_slug(family)
    return F.concat_ws("_", F.coalesce(year.cast("string"), F.lit("nd")), F.when(fam == "", "Unknown").otherwise(F.initcap(fam)), compact_title(F.coalesce(F.nullif(title, F.lit("")), F.lit("Untitled"))))


def citekey_base(year: Column, family: Column) -> Column:
    return F.concat(F.coalesce(year.cast("string"), F.lit("nd")), F.coalesce(F.nullif(name_slug(family), F.lit("")), F.lit("anon")))


def strip_markup(c: Column) -> Column:
    """Tags to spaces, the common entities decoded, white space squeezed."""
    got = F.regexp_replace(c, r"<[^<>]*>", " ")
    for entity, char in ENTITIES:
        got = F.replace(got, F.lit(entity), F.lit(char))
    return squeeze(got)


@F.pandas_udf(StringType())
def unescape_html(s: pd.Series) -> pd.Series:
    """All HTML entities decoded."""
    return s.map(html.unescape, na_action="ignore")


def escape_html(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def clean_abstract(c: Column, limit: int | None = None) -> Column:
    """Section titles of the markup dropped, tags and entities resolved, a leading
    "Abstract" removed."""
    got = F.regexp_replace(c, r"(?is)<(?:jats:)?title[^>]*>.*?</(?:jats:)?title>", " ")
    got = F.trim(F.regexp_replace(strip_markup(got), r"(?i)^abstract\s*[:.]\s*", ""))
    return F.substring(got, 1, limit) if limit else got


def letters_only(c: Column) -> Column:
    """Lower-case a-z and 0-9 of a text without tags and formula commands: the form in which
    quotations are looked for."""
    got = F.regexp_replace(c, WELL_FORMED_TAG, " ")
    got = F.regexp_replace(got, FORMULA_COMMAND, " ")
    return F.regexp_replace(F.lower(got), "[^a-z0-9]", "")


def quote_found(quote: Column, text_key: Column, piece: int = 8, least: int = 12, third: int = 10) -> Column:
    """Is a quotation in a text that ``letters_only`` has folded?

    Pieces between ellipses must all occur (each of ``piece`` characters or more); a single
    piece of ``least`` or more must occur as a whole or in two of its three thirds. False for
    a null quotation, null for a null text.
    """
    parts = F.filter(F.transform(F.split(quote, ELLIPSIS), letters_only), lambda p: p != "")
    one = F.get(parts, F.lit(0))
    n = F.floor(F.length(one) / 3).cast("int")
    thirds = (F.substr(one, F.lit(1), n), F.substr(one, n + 1, n), F.substr(one, 2 * n + 1, F.length(one)))
    hits = sum((F.when((F.length(x) >= third) & F.contains(text_key, x), 1).otherwise(0) for x in thirds), F.lit(0))
    single = F.when(F.length(one) < least, False).otherwise(F.contains(text_key, one) | (hits >= 2))
    several = F.forall(parts, lambda p: (F.length(p) >= piece) & F.contains(text_key, p))
    return F.when(text_key.isNull(), None).otherwise(F.coalesce(F.when(F.size(parts) > 1, several).when(F.size(parts) == 1, single), F.lit(False)))


def is_all_caps(c: Column, letters: int = 25, share: float = 0.9) -> Column:
    """More than ``letters`` letters, more than ``share`` of them capitals."""
    n = F.regexp_count(c, F.lit(r"\p{L}"))
    return F.coalesce((n > letters) & (F.regexp_count(c, F.lit(r"\p{Lu}")) > share * n), F.lit(False))


def is_reply(c: Column) -> Column:
    """Titles that quote another work: "Response to: ...", "Re: ...", "Comment on ..."."""
    return F.coalesce(c.rlike(REPLY), F.lit(False))


@F.pandas_udf(DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two strings; order-dependent, like its source."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def title_agreement(a: Column, b: Column, ratio: Column | None = None) -> Column:
    """Agreement of two titles: -1 if either is empty, 0 if one alone is a reply, 1 if equal or
    nearly so by prefix, 0.97 for a long prefix, else ``ratio`` (null if not given)."""
    ka, kb = title_key(a), title_key(b)
    prefix = F.startswith(ka, kb) | F.startswith(kb, ka)
    short, long = F.least(F.length(ka), F.length(kb)), F.greatest(F.length(ka), F.length(kb))
    got = F.when((ka == "") | (kb == ""), -1.0).when(is_reply(a) != is_reply(b), 0.0).when(ka == kb, 1.0)
    got = got.when(prefix & (short >= 0.9 * long), 1.0).when(prefix & (short >= 40), 0.97)
    return got.otherwise(F.lit(None).cast("double") if ratio is None else ratio)


def usable_embedded_title(c: Column) -> Column:
    """The title, or null if it is a stamp of the typesetting."""
    t = F.trim(c)
    junk = t.rlike(STAMP)
    return F.when((F.length(t) >= 12) & ~junk & (F.regexp_count(t, F.lit("[A-Za-z]{2,}")) >= 3), t)


def article_title(c: Column) -> Column:
    """Title of the article behind a cover's title: issue tag dropped, short head before a
    colon dropped if a real title follows."""
    t = F.trim(F.regexp_replace(c, r"\s*\([^()]*\d+/\d{4}\)\s*$", ""))
    head, tail = F.substring_index(t, ":", 1), F.trim(F.regexp_extract(t, r"(?s)^[^:]*:(.*)$", 1))
    return F.when((F.length(tail) > 25) & (F.size(F.split(F.trim(head), r"\s+")) <= 6), tail).otherwise(t)


def title_words_found(title: Column, text: Column, share: float = 0.4, least: int = 200) -> Column:
    """At least ``share`` of the title's words of four letters or more occur in the text; true
    for a text of under ``least`` characters, which proves nothing."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(strip_accents(title)), F.lit("([a-z]{4,})"), 1))
    hits = let(F.lower(strip_accents(text)), lambda t: F.size(F.filter(words, lambda w: F.contains(t, w))))
    return F.when(F.coalesce(F.length(text), F.lit(0)) < least, True).otherwise(F.coalesce(F.try_divide(hits, F.size(words)) >= share, F.lit(True)))


def prefix_corroborated(title: Column, text: Column, n: int = 40) -> Column:
    """The first ``n`` characters of the title's key occur in the text's key."""
    return F.contains(title_key(text), F.substring(title_key(title), 1, n)) & (title_key(title) != "")


# Words that a bag of words leaves out.
BAG_STOP_WORDS = (
    "the", "a", "an", "of", "in", "on", "and", "for", "with", "to", "by", "from", "using", "via", "as", "at",
    "is", "are", "its", "into", "we", "our", "this", "that", "were", "was", "be",
)


def word_bag(c: Column, but: tuple[str, ...] = ()) -> Column:
    """Lower-case words of three letters or more, repeats kept, without those of ``but``."""
    words = F.regexp_extract_all(F.lower(c), F.lit("([a-z]{3,})"), 1)
    return F.filter(words, lambda w: ~w.isin(*but)) if but else words


def surname(c: Column) -> Column:
    """Family name of a display name: before a comma, else the last word."""
    return F.element_at(F.split(F.trim(F.substring_index(c, ",", 1)), r"\s+"), -1)


def sentence_around(text: Column, key: Column, side: int = 350) -> Column:
    """The sentence in which ``key`` first occurs, cut to ``side`` characters on either side;
    null if it does not occur."""
    at = F.call_function("instr", text, key if isinstance(key, Column) else F.lit(key))
    before = F.regexp_extract(F.substr(text, F.greatest(at - side, F.lit(1)), F.least(at - 1, F.lit(side))), r"(?s)((?:[^.!?\n]|[.!?](?!\s))*)$", 1)
    after = F.regexp_extract(F.substr(text, at, F.lit(side)), r"(?s)^((?:[^.!?\n]|[.!?](?!\s|$))*[.!?]?)", 1)
    return F.when(at > 0, F.trim(F.concat(before, after)))


def spaced_title(c: Column) -> Column:
    """CamelCase split into words."""
    return F.regexp_replace(c, r"(?<!^)(?=[A-Z])", " ")


def vocabulary_key(c: Column) -> Column:
    """Lower case, signs to spaces, squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9 ]", " "), " +", " "))


def journal_key(c: Column) -> Column:
    """Journals that differ in case, a leading article or an ampersand have one key."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "^the ", ""), "&", "and")


def reason_alone(c: Column, mark: str = " Parked under") -> Column:
    """A reason without the standing text that begins with ``mark``."""
    return F.substring_index(c, mark, 1)


# Spellings that are folded on reading.
SPELLINGS = {"anesthetised": "anaesthetised", "anesthetized": "anaesthetised", "anaesthetized": "anaesthetised"}


def spelled(c: Column) -> Column:
    """A vocabulary term in the vocabulary's own spelling."""
    got = c
    for other, own in SPELLINGS.items():
        got = F.when(c == other, own).otherwise(got)
    return got


# File stems in the present and in the former order of year and author.
PRESENT_NAME = r"^([0-9]{4}|nd)_[A-Za-z'-]+_.+$"
FORMER_NAME = r"^([A-Za-z][A-Za-z'-]*)_([0-9]{4}|nd)_(.+)$"


def name_scheme(stem: Column) -> Column:
    """"new" for year_author_title, "old" for author_year_title, else "other"."""
    return F.when(stem.rlike(PRESENT_NAME), "new").when(stem.rlike(FORMER_NAME), "old").otherwise("other")


def present_stem(stem: Column) -> Column:
    """A stem in the present order of its parts, null if it has no known order."""
    return F.when(stem.rlike(PRESENT_NAME), stem).when(stem.rlike(FORMER_NAME), F.regexp_replace(stem, FORMER_NAME, r"$2_$1_$3"))


def first_author(family: Column, file: Column) -> Column:
    """Slug of the first author's family name, else of the word that begins the file name, else
    "anon"."""
    from_file = F.regexp_extract(file, r"^(?:[0-9]{4} - )?([A-Za-z][A-Za-z'-]+)", 1)
    return F.coalesce(F.nullif(name_slug(family), F.lit("")), F.nullif(name_slug(from_file), F.lit("")), F.lit("anon"))


def safe_stem(first: Column, year: Column, title: Column, key: Column) -> Column:
    """Stem for a download: author, year and short title; without an author the end of the key."""
    tail = F.substring(F.regexp_replace(F.lower(F.element_at(F.split(key, "/"), -1)), "[^a-z0-9]", ""), 1, 12)
    who = F.coalesce(F.nullif(F.trim(first), F.lit("")), F.nullif(tail, F.lit("")), F.lit("paper"))
    return F.concat_ws("_", F.initcap(name_slug(who)), F.coalesce(year.cast("string"), F.lit("nd")), compact_title(F.coalesce(F.nullif(title, F.lit("")), F.lit("Untitled"))))


def same_name_parts(a: Column, b: Column) -> Column:
    """Two stems with the same parts in any order."""
    parts = lambda c: F.array_sort(F.array_distinct(F.split(F.lower(c), "_")))
    return parts(a) == parts(b)


def authors_all(authors: Column) -> Column:
    """All authors STRUCT<family, given>, "Family, Given" each, joined by semicolons."""
    return F.array_join(F.transform(authors, lambda a: F.concat_ws(", ", a.family, a.given)), "; ")


def authors_short(families: Column) -> Column:
    """One or two names, or the first with "et al."; null for none."""
    n = F.size(families)
    return F.when(n == 1, F.get(families, F.lit(0))).when(n == 2, F.concat_ws(" & ", families)).when(n > 2, F.concat(F.get(families, F.lit(0)), F.lit(" et al.")))


def restore_inverted(index: Column) -> Column:
    """Text of an inverted index MAP<word, positions>; the later word wins a position."""
    pairs = F.flatten(F.transform(F.map_entries(index), lambda e, i: F.transform(e.value, lambda p: F.struct(p.alias("p"), i.alias("i"), e.key.alias("w")))))
    last = let(F.array_sort(pairs), lambda o: F.filter(o, lambda x, i: F.coalesce(F.get(o, i + 1).p != x.p, F.lit(True))))
    return F.array_join(F.transform(last, lambda x: x.w), " ")
