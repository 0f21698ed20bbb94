"""Queries over the identity of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import keys, text
from strandline.operators import identity
from strandline.plans.curation import _BARE
from strandline.plans.exposures import _LEAVES, _X
from strandline.plans.registry import Registry
from strandline.session import table

query = Registry()
_TITLE = "coalesce(regexp_replace(lower(strip_accents(title)), '[^a-z0-9]', '', 'g'), '')"
_SLUG = "coalesce(regexp_replace(lower(strip_accents(authors[1].family)), '[^a-z]', '', 'g'), '')"


@query(f"""
with m as (select entry_id, {_BARE} as k, {_BARE.replace('(doi,', '(preprint.doi,')} as pk, {_TITLE} as t, {_SLUG} as s from manifest),
a as (select entry_id, case when regexp_matches(k, '^10\\.[0-9]{{4,9}}/.+') then k end as k, case when regexp_matches(pk, '^10\\.[0-9]{{4,9}}/.+') then pk end as pk, t, s from m),
same as (select t, s, min(k) as k from a where k is not null and length(t) >= 20 and s <> '' group by t, s)
select entry_id, coalesce(a.k, pk, same.k) as key, case when a.k is not null then 'own' when pk is not null then 'preprint' when same.k is not null then 'title' else 'unresolved' end as resolver
from a left join same using (t, s)
""")
def q_identity(spark: SparkSession, d: str) -> DataFrame:
    """Key of every entry: its own, its preprint's, or that of an entry of the same title and
    first author."""
    ok = lambda c: F.when(c.rlike(r"^10\.[0-9]{4,9}/.+"), c)
    m = table(spark, d, "manifest").select(
        "entry_id", ok(keys.bare_key(F.col("doi"))).alias("k"), ok(keys.bare_key(F.col("preprint.doi"))).alias("pk"),
        text.title_key(F.col("title")).alias("t"), F.coalesce(text.name_slug(F.get("authors.family", F.lit(0))), F.lit("")).alias("s"),
    )
    same = m.where("k is not null and length(t) >= 20 and s <> ''").groupBy("t", "s").agg(F.min("k").alias("key"))
    found = [("own", m.select("entry_id", F.col("k").alias("key"))), ("preprint", m.select("entry_id", F.col("pk").alias("key"))), ("title", m.join(same, ["t", "s"]).select("entry_id", "key"))]
    return identity.by_priority(m, "entry_id", found)


@query(f"""
with h as (select distinct {_BARE} as k from manifest), e as (select distinct {_BARE} as src, lower(trim(preprint.doi)) as dst from manifest)
select status, count(*) as n from (select case when src = dst then 'self' when dst in (select k from h where k is not null) then 'merge' else 'missing' end as status from e where src is not null and dst is not null) group by status
""")
def q_version_links(spark: SparkSession, d: str) -> DataFrame:
    """Declared preprints: is the other half held?"""
    m = table(spark, d, "manifest").select(keys.bare_key(F.col("doi")).alias("key"), F.lower(F.trim(F.col("preprint.doi"))).alias("pre"))
    return identity.version_links(m, m.select(F.col("key").alias("src"), F.col("pre").alias("dst"))).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query()
def q_key_repair(spark: SparkSession, d: str) -> DataFrame:
    """Ledger keys that no entry has, repaired to the one entry key without a ledger row that
    nearly equals them."""
    wrong = table(spark, d, "ledger").select(F.lower(F.trim("doi")).alias("key")).where("key is not null")
    known = table(spark, d, "manifest").select(keys.bare_key(F.col("doi")).alias("key")).where("key is not null")
    return identity.repaired(wrong, known, "key")


@query("select coalesce(source, '-') as source, count(*) as n, count(*) filter (length(trim(text)) > 80) as n_text, round(count(*) filter (length(trim(text)) > 80) / count(*), 6) as share, count(*) filter (text is null and source_id is not null) as n_hollow from abstracts group by 1")
def q_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Texts found per source, and ids without a text."""
    got = table(spark, d, "abstracts").groupBy(F.coalesce("source", F.lit("-")).alias("source")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.length(F.trim("text")) > 80).alias("n_text"), F.count_if(F.col("text").isNull() & F.col("source_id").isNotNull()).alias("n_hollow"))
    return got.withColumn("share", F.round(F.col("n_text") / F.col("n"), 6))


@query(f"""
with {_X}, u as ({_LEAVES}), v as (select record_id, exposure_no, leaf, list_sort(coalesce(list_filter(m.vals, lambda v: v is not null and not isnan(v)), [])) as v from u),
s as (select distinct record_id, path from (select record_id, unnest(map_keys(provenance.source_quotes)) as path, unnest(map_values(provenance.source_quotes)) as quote from papers) where quote is not null),
c as (select v.*, s.path is not null as own from v left join s on s.record_id = v.record_id and s.path = 'exposures[' || exposure_no || '].' || leaf where len(v) > 0),
o as (select leaf, case when own then 'own' when bool_or(own) over (partition by record_id, leaf, v) then 'inherited' else 'none' end as origin from c)
select leaf, origin, count(*) as n from o group by all
""")
def q_quote_origin(spark: SparkSession, d: str) -> DataFrame:
    """Own, inherited and missing quotations per measure."""
    return identity.quote_origin(table(spark, d, "papers")).groupBy("leaf", "origin").agg(F.count(F.lit(1)).alias("n"))
