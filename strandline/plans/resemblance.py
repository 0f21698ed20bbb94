"""Queries that join entries by shared authors, wording, titles and mentions, and file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import keys, text
from strandline.operators import pairs
from strandline.plans.curation import _BARE
from strandline.plans.registry import Registry
from strandline.plans.texts import _COMPACT, _KEY
from strandline.session import cut, table

query = Registry()
_BAG_STOP = ", ".join(f"'{w}'" for w in text.BAG_STOP_WORDS)
_SURNAME = "regexp_replace(lower(regexp_extract(trim(split_part(a.family, ',', 1)), '([^\\s]+)$', 1)), '[^a-z]', '', 'g')"
_INFO = f"""
ab as (select citekey, min(text) as body from abstracts where citekey is not null group by citekey),
e as (select entry_id, {_BARE} as k, title, body, authors from manifest left join ab using (citekey)),
nm as (select distinct entry_id, n from (select entry_id, unnest(list_transform(authors, lambda a: {_SURNAME})) as n from e) where n <> ''),
nc as (select entry_id, count(*) as c from nm group by 1),
w as (select entry_id, w, count(*) as c from (select entry_id, unnest(regexp_extract_all(lower(concat_ws(' ', title, body)), '[a-z]{{3,}}')) as w from e) where w not in ({_BAG_STOP}) group by all),
sq as (select entry_id, sum(c * c) as s from w group by 1),
ov as (select x.entry_id as a, y.entry_id as b, count(*) / least(any_value(cx.c), any_value(cy.c)) as o from nm x join nm y on y.n = x.n and y.entry_id <> x.entry_id join nc cx on cx.entry_id = x.entry_id join nc cy on cy.entry_id = y.entry_id
  where x.entry_id in (select entry_id from manifest where preprint.doi is not null) group by x.entry_id, y.entry_id),
near as (select a, b, o from ov where o >= 0.5 - 1e-9),
co as (select a, b, o, coalesce((select sum(p.c * q.c) from w p join w q on q.w = p.w where p.entry_id = a and q.entry_id = b) / sqrt(p1.s * p2.s), 0) as c from near left join sq p1 on p1.entry_id = a left join sq p2 on p2.entry_id = b)
"""


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    ab = table(spark, d, "abstracts").where("citekey is not null").groupBy("citekey").agg(F.min("text").alias("body"))
    m = table(spark, d, "manifest").select("entry_id", "citekey", "title", F.col("preprint.doi").isNotNull().alias("pre"), "authors").join(ab, "citekey", "left")
    names = F.transform("authors", lambda a: F.regexp_replace(F.lower(text.surname(a.family)), "[^a-z]", ""))
    every = cut(m.select(F.col("entry_id").alias("id"), "pre", names.alias("names"), text.word_bag(F.concat_ws(" ", "title", "body"), text.BAG_STOP_WORDS).alias("words")))
    return every.where("pre"), every


@query(f"with {_INFO} select a, b, round(o, 6) as overlap, round(c, 6) as cosine from co where o >= 0.6 - 1e-9 and c >= 0.45 - 1e-9")
def q_similar_preprints(spark: SparkSession, d: str) -> DataFrame:
    """Entries with a preprint that resemble another entry by authors and wording."""
    left, right = _sides(spark, d)
    return pairs.resembling(left, right, 0.6, 0.45).select("a", "b", F.round("overlap", 6).alias("overlap"), F.round("cosine", 6).alias("cosine"))


@query(f"""
with {_INFO}, t as (select a, b, case when o >= 0.8 - 1e-9 and c >= 0.6 - 1e-9 then 0 when o >= 0.5 - 1e-9 and c >= 0.4 - 1e-9 then 1 end as t from co)
select a, case t when 0 then 'held' else 'check' end as tier, b from (select *, row_number() over (partition by a order by t, b) as n from t where t is not null) where n = 1
""")
def q_preprint_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Per preprint the first entry that is near-certainly the same, else the first to be looked at."""
    left, right = _sides(spark, d)
    return pairs.first_tier(pairs.resembling(left, right, 0.5, 0.4), [("held", 0.8, 0.6), ("check", 0.5, 0.4)])


@query(f"""
with e as (select entry_id, replace(regexp_replace(lower(trim(journal)), '^the ', ''), '&', 'and') as j, {_KEY.format(c="regexp_replace(title, '\\s*\\([^()]*[0-9]+/[0-9]{4}\\)\\s*$', '')")} as t, {_BARE} as i from manifest),
c as (select j, t, i, min(entry_id) as id from e where j is not null and i is not null and length(t) >= 30 group by all)
select distinct a.id as a, b.id as b from c a join c b on a.j = b.j and a.i <> b.i and starts_with(b.t, a.t) and (length(a.t) < length(b.t) or a.id < b.id)
""".replace("{{4}}", "{4}"))
def q_cover_articles(spark: SparkSession, d: str) -> DataFrame:
    """Entries of one journal under two keys, of which one title begins the other."""
    m = table(spark, d, "manifest")
    bare = F.regexp_replace("title", r"\s*\([^()]*[0-9]+/[0-9]{4}\)\s*$", "")
    return pairs.prefixed_titles(m, "entry_id", text.journal_key(F.col("journal")), bare, keys.bare_key(F.col("doi")))


@query("""
with p as (select distinct id, trim(regexp_replace(lower(g), '[^a-z0-9]+', ' ', 'g')) as g from (select id, label as g from targets union all select id, unnest(synonyms) from targets) where id is not null),
t as (select doc_id, ' ' || trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) || ' ' as t from documents where text is not null),
h as (select p.id, count(distinct doc_id) as n from p join t on length(p.g) > 1 and contains(t.t, ' ' || p.g || ' ') group by p.id)
select id, coalesce(n, 0) as n_texts from (select distinct id from targets where id is not null) left join h using (id)
""")
def q_mentions(spark: SparkSession, d: str) -> DataFrame:
    """In how many texts each term of the vocabulary, or a synonym of it, is mentioned."""
    t = table(spark, d, "targets").where("id is not null")
    names = F.explode(F.concat(F.array("label"), F.coalesce("synonyms", F.array().cast("array<string>"))))
    return pairs.mentions(table(spark, d, "documents"), "doc_id", "text", t.select("id", names.alias("phrase")))


@query("""
with f as (select entry_id, regexp_replace(files.pdf, '\\.[^.]*$', '') as s from manifest where files.pdf is not null)
select entry_id, case when regexp_matches(s, '^([0-9]{4}|nd)_[A-Za-z''-]+_.+$') then 'new' when regexp_matches(s, '^[A-Za-z][A-Za-z''-]*_([0-9]{4}|nd)_.+$') then 'old' else 'other' end as scheme,
  case when regexp_matches(s, '^([0-9]{4}|nd)_[A-Za-z''-]+_.+$') then s when regexp_matches(s, '^[A-Za-z][A-Za-z''-]*_([0-9]{4}|nd)_.+$') then regexp_replace(s, '^([A-Za-z][A-Za-z''-]*)_([0-9]{4}|nd)_(.+)$', '\\2_\\1_\\3') end as stem from f
""")
def q_file_names(spark: SparkSession, d: str) -> DataFrame:
    """Naming scheme of every file, and its stem in the present order of parts."""
    s = F.regexp_replace("files.pdf", r"\.[^.]*$", "")
    return table(spark, d, "manifest").where("files.pdf is not null").select("entry_id", text.name_scheme(s).alias("scheme"), text.present_stem(s).alias("stem"))


_FAMILY = "nullif(regexp_replace(lower(strip_accents(authors[1].family)), '[^a-z]', '', 'g'), '')"
_FILE_FAMILY = "nullif(regexp_replace(lower(regexp_extract(files.pdf, '^(?:[0-9]{4} - )?([A-Za-z][A-Za-z''-]+)', 1)), '[^a-z]', '', 'g'), '')"


@query(f"""
with w as (select entry_id, coalesce({_FAMILY}, {_FILE_FAMILY}, 'anon') as f, year, coalesce(nullif(title, ''), 'Untitled') as title from manifest),
k as (select entry_id, f, year, {_COMPACT} as c from w),
s as (select entry_id, coalesce(cast(year as varchar), 'nd') || '_' || upper(f[1]) || f[2:] || '_' || c || '.pdf' as name from k)
select entry_id, name, count(*) over (partition by name) > 1 as clash from s
""")
def q_target_names(spark: SparkSession, d: str) -> DataFrame:
    """The name each entry's file should have, and whether another claims it; the author comes from the
    entry, else from the file's name."""
    m = table(spark, d, "manifest")
    family = text.first_author(F.get("authors.family", F.lit(0)), F.col("files.pdf"))
    name = F.concat(F.concat_ws("_", F.coalesce(F.col("year").cast("string"), F.lit("nd")), F.initcap(family), text.compact_title(F.coalesce(F.nullif("title", F.lit("")), F.lit("Untitled")))), F.lit(".pdf"))
    rows = m.select("entry_id", name.alias("name"))
    many = rows.groupBy("name").agg((F.count(F.lit(1)) > 1).alias("clash"))
    return rows.join(many, "name").select("entry_id", "name", "clash")
