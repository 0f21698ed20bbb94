"""One surviving record per group of duplicates, chosen bundle by bundle (problem 4).

A bundle is a set of fields that survive together, from one entry. Candidates of a
bundle are ordered by trust: lowest rank of (source, bundle), unlisted and null sources
last; then the latest update, null last; then the smallest id.

Functional dependencies (determinant bundle -> dependent bundle) limit what may be
combined: the entry that gives the dependent must not hold another usable value of the
determinant than the one that survives. Branch and bound looks for the admissible choice
of most trust, that is of the least sum of ranks (an unlisted source counts as the largest
integer); of equal sums the first in the order of the candidates, bundle by bundle:

* every group starts with its root: the best candidate of each bundle, a relaxed optimum
  and so a bound for every choice, from a map-side combined min-aggregate (a group may hold
  a third of all rows). Where it is admissible, the search ends there.
* open groups branch over their best ``width`` candidates of each bundle, distinct by value
  and determinant value. A solution is accepted if no choice with a later candidate can have
  as small a sum; else the width grows, up to ``most`` candidates of a bundle in one task.
* groups still open then are finished by elimination, in aggregates alone: the best dependent
  is found per determinant value, the best of these sums wins. It has no bound on candidates.

A determinant must not depend on another bundle, and a bundle depends on one at most. Where no
choice is admissible, the relaxed optimum is kept and ``consistent`` is false.
Rows with a null key are in no group; groups of one entry have nothing to choose and are
left out; a bundle without a usable value gives no row. Repeated entry ids are broken by
the order of their values.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.session import cut

# What stands in a title field without being a title.
PLACEHOLDERS = (
    "untitled", "untitled document", "no title", "title", "n/a", "na", "none", "null", "nan", "not_reported",
    "not reported", "not available", "unknown", "pending", "tbd", "-", "?", "using the journal template",
    "using jasa format",
)
HEADINGS = (
    "abstract", "introduction", "background", "methods", "materials and methods", "results", "discussion",
    "conclusion", "conclusions", "references", "acknowledgements", "contents", "table of contents", "summary",
    "original article", "original research", "research article", "research paper", "review", "review article",
    "article", "case report", "short communication", "brief report", "letter", "letter to the editor",
    "editorial", "commentary", "erratum", "corrigendum", "supplement", "supplementary", "supplementary material",
    "supplementary materials", "supplementary information", "supporting information", "appendix", "front matter",
)
LAST_RANK = 2147483647


def usable_doi(doi: Column) -> Column:
    """``10.``, four to nine digits, ``/`` and one more character that is no space."""
    return F.coalesce(doi.rlike(r"(?U)10\.[0-9]{4,9}/\s*\S"), F.lit(False))


def usable_year(year: Column) -> Column:
    return F.coalesce(year.between(1900, 2026), F.lit(False))


def usable_title(title: Column) -> Column:
    """Names a work in full: not blank, a placeholder, a file name, a page range, a number,
    a heading, or cut off."""
    t = F.lower(F.trim(F.regexp_replace(F.regexp_replace(title, r"<[^<>]*>", ""), r"(?U)[\s ​]+", " ")))
    bare = F.trim(F.regexp_replace(t, r"(?U)[\s\d.:*#()\[\]_-]+$", ""))
    junk = (
        (F.length(t) == 0)
        | t.isin(*PLACEHOLDERS)
        | bare.isin(*PLACEHOLDERS, *HEADINGS, "")
        | t.rlike(r"(\.\.\.|…)[\s\"'”’)\]*.]*$")
        | t.rlike(r"\.(pdf|docx?|rtf|odt|tex|txt|md|html?|xml|indd|pptx?|xlsx?|p65|qxd|eps|ps|dvi|jpe?g|png|tiff?)[\s*]*$")
        | t.rlike(r"^microsoft word\b")
        | ~t.contains(" ") & t.rlike(r"_|^\S*\d\S*$")
        | t.rlike(r"^(pp?\.?|pages?|s|e)?\s*[a-z]?\d+\s*(-|–|—|‐|‑|\.\.|to)\s*[a-z]?\d+$")
        | t.rlike(r"^\S+\s+\d+\s*\.\.\s*\d+$")
        | ~t.rlike(r"\p{L}")
    )
    return F.coalesce(~junk, F.lit(False))


def choose(
    df: DataFrame,
    bundles: dict[str, tuple[Column, Column]],
    trust: DataFrame,
    key: str = "text_key",
    entry: str = "entry_id",
    source: str = "record_source",
    updated: str = "updated_at",
    dependencies: list[tuple[str, str]] | None = None,
    trusted_as: dict[str, str] | None = None,
    width: int = 16,
    most: int = 64,
) -> DataFrame:
    """(key, field, entry, value as text, rank, consistent): one row per group and bundle.

    ``bundles`` maps a name to (usable, value); ``trust`` holds source, field, trust_rank, the field
    of a bundle being its name unless ``trusted_as`` names another.
    """
    det = {b: a for a, b in dependencies or []}
    if len(det) < len(dependencies or []) or set(det) & set(det.values()):
        raise ValueError("a bundle depends on one other at most, and that one on none")
    names = list(bundles)
    rows = df.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), F.col(entry).alias("_e"), F.col(source).alias("_s"), F.col(updated).cast("timestamp").alias("_u"),
        *[F.when(ok, v.cast("string")).alias(f"_v{i}") for i, (ok, v) in enumerate(bundles.values())],
    )
    none = F.lit(None).cast("string")
    struct = lambda field, value, given, at: F.struct(F.lit(field).alias("field"), value.alias("value"), given.alias("given"), F.lit(at).alias("trusted"))
    each = [struct(b, F.col(f"_v{i}"), F.col(f"_v{names.index(det[b])}") if b in det else none, (trusted_as or {}).get(b, b)) for i, b in enumerate(names)]
    # One entry, one row: the group's size is counted in the same aggregate as the candidates.
    cands = rows.select("_k", "_e", "_s", "_u", F.explode(F.array(*each, struct("", none, none, ""))).alias("c")).select("_k", "_e", "_s", "_u", "c.*")
    ranks = trust.groupBy(F.col("source").alias("_s"), F.col("field").alias("trusted")).agg(F.min("trust_rank").alias("rank"))
    cands = cands.where("value is not null or field = ''").join(ranks, ["_s", "trusted"], "left")
    order = F.struct(F.coalesce("rank", F.lit(LAST_RANK)).alias("rank"), F.col("_u").isNull().alias("undated"), (-F.unix_micros("_u")).alias("age"), F.col("_e").alias("entry"), F.col("value").alias("value"), F.col("given").alias("given"))
    best = cands.groupBy("_k", "field").agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("n"))
    lists = F.collect_list(F.when(F.col("field") != "", F.struct("field", F.array("o").alias("cands"), (F.col("n") > 1).alias("more"))))  # at most one per bundle
    whole = best.groupBy("_k").agg(F.max(F.when(F.col("field") == "", F.col("n"))).alias("size"), lists.alias("lists")).where("size >= 2").drop("size")

    kind = df.schema[entry].dataType.simpleString()
    schema = f"_k {df.schema[key].dataType.simpleString()}, field string, entry {kind}, value string, trust_rank int, consistent boolean, open boolean"
    out = [F.col("_k").alias(key), "field", F.col("entry").alias(entry), "value", "trust_rank", "consistent"]

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [(k, *r) for k, group in zip(f["_k"], f["lists"]) for r in branch_and_bound(group, names, det)]
            yield pd.DataFrame(got, columns=["_k", "field", "entry", "value", "trust_rank", "consistent", "open"])

    solved = whole.mapInPandas(search, schema)
    if not det:
        return solved.select(*out)
    solved = cut(solved)
    parts = [solved.where("not open").select(*out)]
    still = solved.where("open").select("_k").distinct()
    while width <= most and not still.isEmpty():
        every = cands.where("field <> ''").join(still, "_k", "left_semi").groupBy("_k", "field", "value", "given").agg(F.min(order).alias("o"))
        first = every.select("_k", "field", "o", F.row_number().over(Window.partitionBy("_k", "field").orderBy("o")).alias("at")).where(F.col("at") <= width + 1)  # limited before the exchange
        per = first.groupBy("_k", "field").agg(F.array_sort(F.collect_list("o")).alias("o"))
        per = per.select("_k", F.struct("field", F.slice("o", 1, width).alias("cands"), (F.size("o") > width).alias("more")).alias("l"))
        solved = cut(per.groupBy("_k").agg(F.collect_list("l").alias("lists")).mapInPandas(search, schema))
        parts.append(solved.where("not open").select(*out))
        still, width = solved.where("open").select("_k").distinct(), 4 * width
    if not still.isEmpty():
        parts.append(_eliminated(cands.where("field <> ''").join(still, "_k", "left_semi"), order, names, det).select(*out))
    return reduce(DataFrame.unionByName, parts)


def branch_and_bound(lists: list, names: list[str], det: dict[str, str]) -> list[tuple]:
    """Rows (field, entry, value, rank, consistent, open) of one group. ``lists`` has, per bundle, its
    candidates in order and whether there are ``more``; open if those might beat or tie with the best."""
    held = {x["field"]: list(x["cands"]) for x in lists}
    more = {x["field"] for x in lists if x["more"]}
    # Determinants first, so that a dependent is tested as soon as it is chosen.
    seq = sorted(held, key=lambda b: (b in det, names.index(b)))
    least = [0] * (len(seq) + 1)  # of what is not yet chosen
    for i in range(len(seq) - 1, -1, -1):
        least[i] = least[i + 1] + held[seq[i]][0]["rank"]
    best_cost, best = math.inf, None

    def go(i: int, cost: int, chosen: dict) -> None:
        nonlocal best_cost, best
        if i == len(seq):
            best_cost, best = cost, dict(chosen)
            return
        b = seq[i]
        fixed = chosen.get(det.get(b))
        for c in held[b]:
            if cost + c["rank"] + least[i + 1] >= best_cost:
                break  # ranks rise
            if fixed is None or c["given"] is None or c["given"] == fixed["value"]:
                chosen[b] = c
                go(i + 1, cost + c["rank"], chosen)
                del chosen[b]

    go(0, 0, {})
    ok = best is not None
    bound = min((least[0] - held[b][0]["rank"] + held[b][-1]["rank"] for b in more), default=math.inf)
    root = {b: held[b][0] for b in seq}
    still = best != root and bound <= best_cost and bool(more)
    return [(b, c["entry"], c["value"], c["rank"], ok, still) for b, c in (best or root).items()]


def _eliminated(cands: DataFrame, order: Column, names: list[str], det: dict[str, str]) -> DataFrame:
    """(_k, field, entry, value, trust_rank, consistent) of groups of any size: per determinant
    value the best dependents, then the best sum."""
    best = cut(cands.groupBy("_k", "field", F.when(F.col("field").isin(*det), F.col("given")).otherwise(F.col("value")).alias("v")).agg(F.min(order).alias("o")))
    top = best.groupBy("_k").pivot("field", names).agg(F.min("o"))
    free = [b for b in names if b not in det and b not in det.values()]
    got = top.select("_k", *[F.struct(F.col(b).alias("o")).alias(f"_{b}") for b in free], *[F.col(b).isNotNull().alias(f"has_{b}") for b in names])
    for a in sorted(set(det.values()), key=names.index):
        deps = [b for b in names if det.get(b) == a]
        vals = best.where(F.col("field") == a).select("_k", "v", F.col("o").alias("d"))
        one = vals
        for b in deps:
            mine = best.where(F.col("field") == b)
            loose = mine.where("v is null").select("_k", F.col("o").alias("_loose"))
            tied = mine.where("v is not null").select("_k", "v", F.col("o").alias("_tied"))
            one = one.join(tied, ["_k", "v"], "left").join(loose, "_k", "left").withColumn(b, F.least("_tied", "_loose")).drop("_tied", "_loose")
        one = one.join(top.select("_k", *[F.col(b).alias(f"top_{b}") for b in deps]), "_k")
        fits = reduce(lambda x, y: x & y, [F.col(b).isNotNull() | F.col(f"top_{b}").isNull() for b in deps])
        cost = reduce(lambda x, y: x + y, [F.coalesce(F.col(f"{c}.rank"), F.lit(0)).cast("long") for c in ("d", *deps)])
        pick = one.groupBy("_k").agg(F.min(F.when(fits, F.struct(cost.alias("cost"), "d", *deps))).alias(f"_best_{a}"))
        got = got.join(pick, "_k", "left")
    got = got.join(top, "_k")
    ok = F.lit(True)
    for a in set(det.values()):
        ok = ok & (F.col(f"_best_{a}").isNotNull() | ~F.col(f"has_{a}"))
    final = lambda b: F.col(b) if b in free else F.when(ok & F.col(f"has_{det.get(b, b)}"), F.col(f"_best_{det.get(b, b)}")[b if b in det else "d"]).otherwise(F.col(b))
    rows = F.array_compact(F.array(*[F.when(F.col(f"has_{b}"), F.struct(F.lit(b).alias("field"), final(b).alias("o"))) for b in names]))
    return got.select("_k", F.explode(rows).alias("p"), ok.alias("consistent")).select("_k", "p.field", F.col("p.o.entry").alias("entry"), F.col("p.o.value").alias("value"), F.col("p.o.rank").alias("trust_rank"), "consistent")


def manifest_bundles() -> dict[str, tuple[Column, Column]]:
    """doi, year and title, each a bundle of its own."""
    doi, year, title = F.col("doi"), F.col("year"), F.col("title")
    return {"doi": (usable_doi(doi), doi), "year": (usable_year(year), year), "title": (usable_title(title), title)}


def real_bundles() -> tuple[dict[str, tuple[Column, Column]], list[tuple[str, str]], dict[str, str]]:
    """Bundles of dependent fields, their dependencies and what they are trusted as: the doi; year
    and journal; title and authors. An entry of another doi gives neither of the two latter."""
    doi = F.lower(F.regexp_extract("doi", r"(?U)(10\.[0-9]{4,9}/\s*\S+)", 1))
    issue = usable_year(F.col("year")) & (F.length(F.trim("journal")) > 0)
    work = usable_title(F.col("title")) & (F.size("authors") > 0)
    got = {
        "doi": (usable_doi(F.col("doi")), doi),
        "issue": (F.coalesce(issue, F.lit(False)), F.concat_ws("|", F.col("year").cast("string"), "journal")),
        "work": (F.coalesce(work, F.lit(False)), F.concat_ws("|", "title", F.array_join(F.transform("authors", lambda a: F.coalesce(a.family, F.lit(""))), ";"))),
    }
    return got, [("doi", "issue"), ("doi", "work")], {"issue": "year", "work": "title"}
