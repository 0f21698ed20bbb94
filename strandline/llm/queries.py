"""Queries pN_ of the llm operators; ``__spark_entry__`` adds them if this can be imported."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, language, packing, similar, survivors
from strandline.session import cut, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of entries of one group of near-duplicates."""
    return similar.group_pairs(similar.grouped(similar.entry_links(table(spark, d, "manifest"), table(spark, d, "abstracts"))))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    """Entries that are like another, with their group and number of links."""
    return similar.groups(table(spark, d, "manifest"), table(spark, d, "abstracts"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Entry from which doi, year and title of each shared text_key survive."""
    got = survivors.choose(table(spark, d, "manifest"), survivors.manifest_bundles(), table(spark, d, "source_trust"))
    return got.select("text_key", "field", "entry_id")


def p4_survivors(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record per text_key, with the entry of origin of every field."""
    got = survivors.choose(table(spark, d, "manifest"), survivors.manifest_bundles(), table(spark, d, "source_trust"))
    pick = lambda f, c: F.max(F.when(F.col("field") == f, F.col(c)))
    return got.groupBy("text_key").agg(*[pick(f, c).alias(f"{f}{s}") for f in ("doi", "year", "title") for c, s in (("value", ""), ("entry_id", "_entry"))]).withColumn("year", F.col("year").cast("int"))


def p4_consistent(spark: SparkSession, d: str) -> DataFrame:
    """Survivors in bundles - doi; year and journal; title and authors - under the dependencies of the
    two latter on the doi: neither may come from an entry that holds another doi than the survivor's."""
    bundles, deps, trusted = survivors.real_bundles()
    got = survivors.choose(table(spark, d, "manifest"), bundles, table(spark, d, "source_trust"), dependencies=deps, trusted_as=trusted)
    return got.select("text_key", "field", "entry_id", "value", "consistent")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids of every document under byte_bpe_50k."""
    return table(spark, d, "documents").select("doc_id", bpe.token_ids(F.col("text")).alias("ids"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Container of every document, or of every piece of an oversized one, per budget."""
    sizes = table(spark, d, "documents").select("doc_id", bpe.token_count(F.col("text")).alias("tokens"))
    return packing.pack(cut(sizes), table(spark, d, "budgets"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Languages with a whole sentence in a text that its label does not name."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return language.unnamed(language.segments(docs), docs)


def p8_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every stretch of one language with its confidence."""
    return language.segments(table(spark, d, "documents").select("doc_id", "text", "lang"))


def p8_documents(spark: SparkSession, d: str) -> DataFrame:
    """One language per document, with its confidence and its share of the text."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return language.documents(language.segments(docs), docs)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p2_found, p2_groups, p4_found, p4_survivors, p4_consistent, p6_ids, p7_containers, p8_found, p8_segments, p8_documents)
}

# Titles are judged by the rule that the operator's docstring states.
_USABLE = """
with t as (
  select *, lower(trim(regexp_replace(regexp_replace(title, '<[^<>]*>', '', 'g'), '[\\s\\x{00a0}\\x{200b}]+', ' ', 'g'))) as lt from manifest
), u as (
  select *, trim(regexp_replace(lt, '[\\s\\d.:*#()\\[\\]_-]+$', '')) as bare from t
), g as (
  select * from u where text_key in (select text_key from manifest where text_key is not null group by text_key having count(*) >= 2)
), c as (
  select text_key, entry_id, record_source, updated_at, 'doi' as field, doi as value from g where regexp_matches(doi, '10\\.[0-9]{4,9}/[\\s\\x{00a0}]*[^\\s\\x{00a0}]')
  union all
  select text_key, entry_id, record_source, updated_at, 'year', cast(year as varchar) from g where year between 1900 and 2026
  union all
  select text_key, entry_id, record_source, updated_at, 'title', title from g
  where title is not null and length(lt) > 0 and lt not in (PLACES) and bare not in (PLACES, HEADS, '')
    and not regexp_matches(lt, '(\\.\\.\\.|\\x{2026})[\\s"''\\x{201d}\\x{2019})\\]*.]*$')
    and not regexp_matches(lt, '\\.(pdf|docx?|rtf|odt|tex|txt|md|html?|xml|indd|pptx?|xlsx?|p65|qxd|eps|ps|dvi|jpe?g|png|tiff?)[\\s*]*$')
    and not regexp_matches(lt, '^microsoft word\\b')
    and not (not contains(lt, ' ') and regexp_matches(lt, '_|^\\S*\\d\\S*$'))
    and not regexp_matches(lt, '^(pp?\\.?|pages?|s|e)?\\s*[a-z]?\\d+\\s*(-|\\x{2013}|\\x{2014}|\\x{2010}|\\x{2011}|\\.\\.|to)\\s*[a-z]?\\d+$')
    and not regexp_matches(lt, '^\\S+\\s+\\d+\\s*\\.\\.\\s*\\d+$')
    and regexp_matches(lt, '\\pL')
), r as (
  select c.*, row_number() over (partition by text_key, c.field order by coalesce(s.trust_rank, 2147483647), updated_at desc nulls last, entry_id) as n
  from c left join source_trust s on s.source = c.record_source and s.field = c.field
)
""".replace("PLACES", ", ".join(f"'{x}'" for x in survivors.PLACEHOLDERS)).replace("HEADS", ", ".join(f"'{x}'" for x in survivors.HEADINGS))

# All combinations of candidates, the admissible one of the least sum of ranks first.
_COMBINED = _USABLE.replace("select text_key, entry_id, record_source, updated_at, 'doi' as field, doi as value from g", "select text_key, entry_id, record_source, updated_at, 'doi' as field, doi as value, doi as raw_doi, year, journal, title, authors from g").split(", c as (")[0] + """, k as (
  select text_key, entry_id, record_source, updated_at,
    case when regexp_matches(doi, '10\\.[0-9]{4,9}/[\\s\\x{00a0}]*[^\\s\\x{00a0}]') then lower(regexp_extract(doi, '(10\\.[0-9]{4,9}/[\\s\\x{00a0}]*[^\\s\\x{00a0}]+)', 1)) end as d,
    case when year between 1900 and 2026 and length(trim(journal)) > 0 then cast(year as varchar) || '|' || journal end as i,
    case when len(authors) > 0 and (TITLE) then title || '|' || array_to_string(list_transform(authors, lambda a: coalesce(a.family, '')), ';') end as w
  from g
), c as (
  select text_key, entry_id, record_source, updated_at, 'doi' as field, 'doi' as trusted, d as value, null as given from k where d is not null
  union all select text_key, entry_id, record_source, updated_at, 'issue', 'year', i, d from k where i is not null
  union all select text_key, entry_id, record_source, updated_at, 'work', 'title', w, d from k where w is not null
), o as (
  select text_key, c.field, value, given, min({rank: coalesce(s.trust_rank, 2147483647), undated: updated_at is null, age: -epoch_us(updated_at), entry: entry_id}) as o
  from c left join source_trust s on s.source = c.record_source and s.field = c.trusted group by text_key, c.field, value, given
), x as (
  select *, row_number() over (partition by text_key, field order by o, value, given) as at from o
), p as (
  select n.text_key, d.o as od, d.value as vd, d.at as ad, i.o as oi, i.value as vi, i.at as ai, w.o as ow, w.value as vw, w.at as aw,
    (d.value is null or ((i.given is null or i.given = d.value) and (w.given is null or w.given = d.value))) as fits,
    coalesce(d.o.rank, 0)::bigint + coalesce(i.o.rank, 0)::bigint + coalesce(w.o.rank, 0)::bigint as cost
  from (select distinct text_key from x) n left join (select * from x where field = 'doi') d on d.text_key = n.text_key
    left join (select * from x where field = 'issue') i on i.text_key = n.text_key left join (select * from x where field = 'work') w on w.text_key = n.text_key
), f as (
  select * from (select *, row_number() over (partition by text_key order by not fits, case when fits then cost end, ad, ai, aw) as n from p) where n = 1
)
select text_key, 'doi' as field, od.entry as entry_id, vd as value, fits as consistent from f where vd is not null
union all select text_key, 'issue', oi.entry, vi, fits from f where vi is not null
union all select text_key, 'work', ow.entry, vw, fits from f where vw is not null
"""
_COMBINED = _COMBINED.replace("TITLE", _USABLE.split("'title', title from g\n  where ", 1)[1].split("\n), r as (")[0])

# Brute force over all pairs that share a shingle, or a piece and a name.
_ALIKE = """
with recursive a as (
  select citekey, min(text) as text from abstracts where citekey is not null and text is not null and len(regexp_extract_all(lower(text), '[\\pL\\pN]+')) >= 20 group by citekey
), w as (
  select citekey, regexp_extract_all(lower(text), '[\\pL\\pN]+') as ws from a
), g as (
  select distinct citekey, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as s from (select citekey, ws, unnest(range(1, len(ws) - 1)) as i from w)
), gn as (
  select citekey, count(*) as n from g group by 1
), tx as (
  select x.citekey as a, y.citekey as b from g x join g y on x.s = y.s and x.citekey < y.citekey join gn p on p.citekey = x.citekey join gn q on q.citekey = y.citekey
  group by x.citekey, y.citekey having count(*) >= 0.5 * (any_value(p.n) + any_value(q.n) - count(*)) - 1e-9
), m as (
  select entry_id, manifest.citekey, gn.n is not null as has, regexp_replace(lower(strip_accents(title)), '[^a-z0-9]', '', 'g') as t,
    list_sort(list_distinct(list_filter(list_transform(authors, lambda x: regexp_replace(lower(strip_accents(x.family)), '[^a-z0-9]', '', 'g')), lambda x: x <> ''))) as f
  from manifest left join gn using (citekey) where entry_id is not null
), ft as (
  select entry_id, unnest(f) as n from m where length(t) >= 3
), tp as (
  select entry_id, has, f, list_distinct(list_transform(range(1, length(t) - 1), lambda i: t[i:i + 2])) as p from m where length(t) >= 3 and len(f) > 0
), tt as (
  select x.entry_id as a, y.entry_id as b from (select distinct u.entry_id as a, v.entry_id as b from ft u join ft v on u.n = v.n and u.entry_id < v.entry_id) c join tp x on x.entry_id = c.a join tp y on y.entry_id = c.b
  where not (x.has and y.has) and len(list_intersect(x.f, y.f)) >= 0.5 * (len(x.f) + len(y.f) - len(list_intersect(x.f, y.f))) - 1e-9
    and len(list_intersect(x.p, y.p)) >= 0.7 * (len(x.p) + len(y.p) - len(list_intersect(x.p, y.p))) - 1e-9
), l as (
  select x.entry_id as a, y.entry_id as b from tx join m x on x.citekey = tx.a join m y on y.citekey = tx.b
  union select a, b from tt
), ways as (
  select a, b from l union select b, a from l
), reach as (
  select a as x, a as y from ways union select reach.x, ways.b from reach join ways on ways.a = reach.y
)
"""

ORACLES: dict[str, str] = {
    "p2_found": _ALIKE + "select distinct x as entry_a, y as entry_b from reach where x < y",
    "p4_consistent": _COMBINED,
    "p4_found": _USABLE + "select text_key, field, entry_id from r where n = 1",
    "p4_survivors": _USABLE
    + """select text_key, max(case when field = 'doi' then value end) as doi, max(case when field = 'doi' then entry_id end) as doi_entry,
      cast(max(case when field = 'year' then value end) as int) as year, max(case when field = 'year' then entry_id end) as year_entry,
      max(case when field = 'title' then value end) as title, max(case when field = 'title' then entry_id end) as title_entry
    from r where n = 1 group by text_key""",
}
