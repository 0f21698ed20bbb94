"""Queries over harvests, ledgers, versions, rankings and surrogate keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.functions import keys, text
from strandline.operators import packing_plan, relational as rel
from strandline.plans.registry import Registry
from strandline.session import cut, table
from strandline.sources import readers

query = Registry()

TABLES = ("abstracts", "budgets", "customer", "documents", "embeddings", "events", "ledger", "lineitem", "manifest", "nation", "orders", "papers", "part", "raw_papers", "region", "source_trust", "supplier", "targets")
#: Keys of the ledger come padded and in any case.
LEDGER_KEY = "lower(trim(doi))"
STATE = ("run", "verdict", "criterion")
_LEDGER = "l as (select *, lower(trim(doi)) as k from ledger where doi is not null)"


def ledger(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ledger").withColumn("k", F.expr(LEDGER_KEY))


@query(" union all ".join(f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in TABLES))
def q_load_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rows per table, from the footers' counts."""
    one = lambda t: table(spark, d, t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
    return reduce(DataFrame.unionByName, map(one, TABLES))


@query(f"with {_LEDGER} select k as doi, ledger_id, verdict, criterion, run from (select *, row_number() over (partition by k order by received_at desc nulls last, ledger_id desc) as n from l) where n = 1")
def q_ledger_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """The latest ledger row of every key."""
    rows = ledger(spark, d).select("k", "received_at", "ledger_id", "verdict", "criterion", "run")
    return rel.last_wins(rows, "k", ["received_at", "ledger_id"]).select(F.col("k").alias("doi"), "ledger_id", "verdict", "criterion", "run")


# Rows without a verdict are ignored; rows received at no known time come first.
_HISTORY = f"""
with {_LEDGER}, v as (select *, coalesce(received_at, timestamp '0001-01-01') as rcv from l where length(verdict) > 0), s as (
  select *, {{run: run, verdict: verdict, criterion: criterion}} as st, lag({{run: run, verdict: verdict, criterion: criterion}}) over w as prev, row_number() over w as n
  from v window w as (partition by k order by rcv, ledger_id)
), steps as (
  select *, lead(n) over (partition by k order by n) as nxt, row_number() over (partition by k order by n) as seq from s where prev is null or prev is distinct from st
), now as (
  select k, coalesce(parked_class, case when criterion = 'E9' then 'neural_regeneration' end) as parked_class from (select *, row_number() over (partition by k order by rcv desc, ledger_id desc) as z from v) where z = 1
), cur as (
  select steps.k, steps.run, steps.verdict, steps.criterion, now.parked_class, cast(seq - 1 as int) as n_replaced from steps join now on now.k = steps.k where nxt is null
)
"""
#: Fixed value: the class under which a reversible ruling is parked, by its code.
PARKED = {"E9": "neural_regeneration"}


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Ledger rows with a verdict; a null time of receipt is before all others."""
    at = F.coalesce("received_at", F.expr("timestamp'0001-01-01'").cast(table(spark, d, "ledger").schema["received_at"].dataType))
    return ledger(spark, d).where("length(verdict) > 0").select("k", at.alias("at"), "ledger_id", *STATE, "parked_class")


def recorded(spark: SparkSession, d: str) -> DataFrame:
    return rel.record_verdicts(verdicts(spark, d), "k", ["at", "ledger_id"], STATE, "verdict", PARKED)


@query(_HISTORY + "select k as doi, cast(seq as int) as seq, run, verdict, criterion from steps where nxt is not null")
def q_ledger_history(spark: SparkSession, d: str) -> DataFrame:
    """States that a different later state of the same key replaced."""
    return rel.superseded(verdicts(spark, d), "k", ["at", "ledger_id"], STATE).withColumnRenamed("k", "doi")


@query(_HISTORY + "select k as doi, run, verdict, criterion, parked_class, n_replaced from cur")
def q_ledger_current(spark: SparkSession, d: str) -> DataFrame:
    """The ledger: last state of every key, its parked class and number of replacements."""
    return recorded(spark, d).select(F.col("k").alias("doi"), *STATE, "parked_class", "n_replaced")


@query(_HISTORY + "select count(*) as added, coalesce(sum(n_replaced), 0)::bigint as replaced from cur")
def q_ledger_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Keys added and states replaced when all rows are recorded."""
    return rel.upsert_counts(recorded(spark, d))


@query("""
with a as (select * from abstracts where citekey is not null),
f as (select citekey, doi, row_number() over (partition by citekey order by coalesce(fetched, date '9999-12-31'), abstract_id) as n from a),
b as (select citekey, text, row_number() over (partition by citekey order by coalesce(fetched, date '9999-12-31'), abstract_id) as n from a where length(trim(text)) > 0),
s as (select citekey, string_agg(source, ',' order by o) as found_by from (
  select citekey, coalesce(source, '-') as source, min((coalesce(fetched, date '9999-12-31'), abstract_id)) as o from a group by all) group by citekey)
select f.citekey, f.doi, md5(b.text) as text_md5, s.found_by from f join s using (citekey) left join b on b.citekey = f.citekey and b.n = 1 where f.n = 1
""")
def q_harvest_merge(spark: SparkSession, d: str) -> DataFrame:
    """Fetched abstracts merged per key: first copy, first text, sources in order of find."""
    a = table(spark, d, "abstracts").select("citekey", "doi", "abstract_id", F.coalesce("source", F.lit("-")).alias("source"), "text", F.coalesce("fetched", F.lit("9999-12-31").cast("date")).alias("fetched"))
    got = rel.merge_sources(a, "citekey", ["fetched", "abstract_id"], "source", "text")
    return got.select("citekey", "doi", F.md5("text").alias("text_md5"), F.array_join("found_by", ",").alias("found_by"))


@query("select c_name as name, c_nationkey as nationkey from customer union select s_name, s_nationkey from supplier")
def q_source_union(spark: SparkSession, d: str) -> DataFrame:
    """Two sources projected to one shape, distinct."""
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    return c.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey")).unionByName(s.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))).distinct()


_BARE = "case when regexp_replace(lower(regexp_replace(doi, '^[\\s\\x{00a0}]+|[\\s\\x{00a0}]+$', '', 'g')), '^(https?://(dx\\.)?doi\\.org/|doi:\\s*)', '') like '10.%' then regexp_replace(lower(regexp_replace(doi, '^[\\s\\x{00a0}]+|[\\s\\x{00a0}]+$', '', 'g')), '^(https?://(dx\\.)?doi\\.org/|doi:\\s*)', '') end"


@query(f"select entry_id, {_BARE} as doi_key from manifest")
def q_url_norm(spark: SparkSession, d: str) -> DataFrame:
    """Keys without the resolver's address."""
    return table(spark, d, "manifest").select("entry_id", keys.bare_key(F.col("doi")).alias("doi_key"))


@query(f"with {_LEDGER}, m as (select entry_id, citekey, {_BARE} as k from manifest) select entry_id, citekey from m where k is null or k not in (select k from l)")
def q_anti_decided(spark: SparkSession, d: str) -> DataFrame:
    """Entries whose key has no ledger row."""
    m = table(spark, d, "manifest").select("entry_id", "citekey", keys.bare_key(F.col("doi")).alias("k"))
    return m.join(ledger(spark, d).select("k").distinct(), "k", "left_anti").select("entry_id", "citekey")


@query(f"with {_LEDGER}, m as (select entry_id, {_BARE} as k from manifest) select entry_id from m where k in (select k from l where lower(trim(verdict)) = 'relevant') and k not in (select k from l where parked_class is not null)")
def q_semi_decided(spark: SparkSession, d: str) -> DataFrame:
    """Entries with a positive row and no parked row in the ledger."""
    m = table(spark, d, "manifest").select("entry_id", keys.bare_key(F.col("doi")).alias("k"))
    rows = ledger(spark, d)
    yes = rows.where(F.lower(F.trim("verdict")) == "relevant").select("k").distinct()
    parked = rows.where("parked_class is not null").select("k").distinct()
    return m.join(yes, "k", "left_semi").join(parked, "k", "left_anti").select("entry_id")


@query(f"""
with {_LEDGER}, m as (select {_BARE} as k, min((entry_id, title, journal)) as r from manifest group by 1), p as (select {_BARE} as k, min((record_id, citekey)) as r from papers group by 1)
select x.k as doi, coalesce(m.r[2], case when m.k is null then p.r[2] end) as title, m.r[3] as journal, cast(case when m.k is not null then 0 when p.k is not null then 1 end as int) as found_in
from (select distinct k from l) x left join m on m.k = x.k left join p on p.k = x.k
""".replace("m.r[2]", "struct_extract_at(m.r, 2)").replace("m.r[3]", "struct_extract_at(m.r, 3)").replace("p.r[2]", "struct_extract_at(p.r, 2)"))
def q_lookup_coalesce(spark: SparkSession, d: str) -> DataFrame:
    """Every ledger key with the row of the first source that knows it, as a whole."""
    m = table(spark, d, "manifest").select(keys.bare_key(F.col("doi")).alias("k"), "entry_id", "title", "journal")
    p = table(spark, d, "papers").select(keys.bare_key(F.col("doi")).alias("k"), F.col("record_id").alias("entry_id"), F.col("citekey").alias("title"), F.lit(None).cast("string").alias("journal"))
    want = ledger(spark, d).where("k is not null").select("k").distinct()
    got = rel.first_lookup(want, "k", [m, p], ["entry_id", "title", "journal"])
    return got.select(F.col("k").alias("doi"), "title", "journal", "found_in")


@query("""
with o as (select o_orderkey, o_custkey, cast(year(o_orderdate) as int) as y from orders)
select a.o_orderkey, min(b.o_orderkey) as first_match from o a left join o b on b.o_custkey = a.o_custkey and abs(b.y - a.y) <= 1 group by a.o_orderkey
""")
def q_band_join(spark: SparkSession, d: str) -> DataFrame:
    """Per order the first order of the same customer within a year."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"))
    return rel.near_years(o, o, "o_custkey", "y", 1, "o_orderkey").select("o_orderkey", "first_match")


@query("select doc_id, m as first_seen from (select doc_id, min(doc_id) over (partition by text) as m from documents where text is not null) where doc_id <> m")
def q_first_seen_dup(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose text occurred before, with the first of them."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("s"))
    return rel.first_seen(docs, ["h", "s"], ["doc_id"], "doc_id").select("doc_id", "first_seen")


@query("select doc_id, n_sharing from (select doc_id, count(*) over (partition by substring(text, 1, 200)) as n_sharing from documents where length(text) > 0) where n_sharing > 1")
def q_prefix_dup(spark: SparkSession, d: str) -> DataFrame:
    """Documents that share their first 200 characters."""
    return rel.shared_prefix(table(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id", "n_sharing")


@query("select substring(sha1(text), 1, 16) as digest, count(*) as n, min(doc_id) as first_id from documents where text is not null group by 1 having count(*) > 1")
def q_content_hash_dup(spark: SparkSession, d: str) -> DataFrame:
    """Groups of equal content by digest."""
    return table(spark, d, "documents").where("text is not null").groupBy(keys.content_digest(F.col("text")).alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("""
with w as (select citekey, count(*) as w from manifest where citekey is not null group by 1), g as (select citekey, count(*) as g from papers where citekey is not null group by 1)
select status, count(*) as n from (select case when g is null then 'missing' when w is null then 'extra' when g > w then 'duplicate' else 'ok' end as status from w full join g using (citekey)) group by 1
""")
def q_reconcile_batch(spark: SparkSession, d: str) -> DataFrame:
    """Keys wanted (manifest) against keys delivered (papers), by outcome."""
    ok = "citekey is not null"
    return rel.reconcile(table(spark, d, "manifest").where(ok), table(spark, d, "papers").where(ok), "citekey").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


_VERSIONS = """
cutoff as (select quantile_disc(load_id, 0.5) as c from papers),
old as (select * from (select *, row_number() over (partition by citekey order by load_id desc, record_id desc) as n from papers, cutoff where load_id <= c) where n = 1 and citekey is not null),
new as (select * from (select *, row_number() over (partition by citekey order by load_id desc, record_id desc) as n from papers where load_id is not null) where n = 1 and citekey is not null)
"""


def versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The latest record per key, as of the middle load and as of now."""
    p = table(spark, d, "papers").select("citekey", "doi", "load_id", "record_id", "n_subjects", "species", "conditions").where("load_id is not null")
    mid = p.agg(F.percentile_disc(0.5).alias("c")) if hasattr(F, "percentile_disc") else p.agg(F.expr("percentile_disc(0.5) within group (order by load_id)").cast("int").alias("c"))
    old = p.join(F.broadcast(mid), F.col("load_id") <= F.col("c")).drop("c")  # one row
    return rel.last_wins(old, "citekey", ["load_id", "record_id"]), rel.last_wins(p, "citekey", ["load_id", "record_id"])


_ABSORBED = "ab as (select lower(trim(preprint.doi)) as identity, min(citekey) as citekey from manifest where preprint.doi is not null and citekey in (select citekey from new) group by 1)"


@query(f"""
with {_VERSIONS}, {_ABSORBED}, lives as (select lower(trim(doi)) as i, min(citekey) as k from new where doi is not null group by 1),
gone as (select o.citekey, lives.k as k1, ab.citekey as k2 from old o left join lives on lives.i = lower(trim(o.doi)) left join ab on ab.identity = lower(trim(o.doi)) where o.citekey not in (select citekey from new)),
g as (select citekey, case when k1 is not null then 'renamed' when k2 is not null then 'merged' else 'removed' end as change, coalesce(k1, k2) as now from gone),
kept as (select n.citekey, case when o.n_subjects is distinct from n.n_subjects or o.species is distinct from n.species or o.conditions is distinct from n.conditions then 'corrected' else 'same' end as change from old o join new n using (citekey))
select change, count(*) as n from (select change from g union all select change from kept
  union all select 'added' from new where citekey not in (select citekey from old) and citekey not in (select now from g where now is not null)) group by change
""")
def q_snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    """Two versions of the records, classified and counted; a rename or merge counts once."""
    old, new = (v.withColumn("doi", F.lower(F.trim("doi"))) for v in versions(spark, d))
    absorbed = table(spark, d, "manifest").select(F.lower(F.trim("preprint.doi")).alias("identity"), "citekey")
    return rel.snapshot_diff(old, new, "citekey", "doi", ["n_subjects", "species", "conditions"], absorbed).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {_VERSIONS} select citekey, record_id, 'new' as side from new union all select citekey, record_id, 'prior' from old where citekey not in (select citekey from new)")
def q_accumulate(spark: SparkSession, d: str) -> DataFrame:
    """Prior rows are kept unless the key is present now."""
    old, new = versions(spark, d)
    tag = lambda x, s: x.select("citekey", "record_id", F.lit(s).alias("side"))
    return rel.accumulate(tag(new, "new"), tag(old, "prior"), "citekey")


@query(f"with {_VERSIONS} select coalesce(n.citekey, o.citekey) as citekey, coalesce(n.record_id, o.record_id) as record_id from old o full join new n on o.citekey = n.citekey")
def q_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Append-only upsert of two versions; the current row wins."""
    old, new = versions(spark, d)
    return rel.upsert(new.select("citekey", "record_id"), old.select("citekey", "record_id"), "citekey")


@query(f"with {_LEDGER}, m as (select distinct {_BARE} as k from manifest) select count(*) as n_wanted, count(*) filter (k in (select k from l)) as n_found, round(count(*) filter (k in (select k from l)) / count(*), 6) as recall from m where k is not null")
def q_recall(spark: SparkSession, d: str) -> DataFrame:
    """Share of the manifest's keys that the ledger has."""
    m = table(spark, d, "manifest").select(keys.bare_key(F.col("doi")).alias("k")).where("k is not null").distinct()
    hit = m.join(ledger(spark, d).select("k", F.lit(1).alias("h")).distinct(), "k", "left")
    return hit.agg(F.count(F.lit(1)).alias("n_wanted"), F.count("h").alias("n_found")).withColumn("recall", F.round(F.try_divide("n_found", "n_wanted"), 6))


@query("""
with m as (select *, BARE as d from manifest),
p as (select d as doi, min(coalesce(cast(year as varchar), 'nd') || coalesce(nullif(regexp_replace(lower(strip_accents(authors[1].family)), '[^a-z]', '', 'g'), ''), 'anon')) as base from m where d is not null group by d),
released as (select d as doi, citekey as key from m where d is not null and record_class = 'primary_study'),
working as (select d as doi, citekey as key from m where d is not null and record_class is distinct from 'primary_study'),
rel as (select p.doi, base, key, 0 as cls from p join released using (doi) where key = base or (length(key) = length(base) + 1 and starts_with(key, base) and key[-1] between 'a' and 'z')),
wrk as (select p.doi, base, key, case when key = base then 1 else 2 end as cls from p join working using (doi)
  where key not in (select key from released) and (key = base or (length(key) = length(base) + 1 and starts_with(key, base) and key[-1] between 'a' and 'z' and key not in (select base from p)))),
won as (select * from (select *, row_number() over (partition by key order by cls, doi) as n from (select * from rel union all select * from wrk)) where n = 1),
kept as (select doi, base, key from (select *, row_number() over (partition by doi, base order by cls, key) as m from won) where m = 1),
taken as (select key from released union select key from kept),
fresh as (select p.doi, p.base, s.size from p join (select base, count(*) as size from p group by base) s using (base) where p.doi not in (select doi from kept)),
alone as (select doi, base, base as key from fresh where size = 1 and base not in (select key from taken)),
rest as (select doi, base, row_number() over (partition by base order by doi) as n from fresh where doi not in (select doi from alone)),
letters as (select base, key, row_number() over (partition by base order by key) as n from (select distinct base, base || chr(cast(i as int)) as key from rest, range(97, 123) r(i)) where key not in (select key from taken) and key not in (select base from p))
select doi, base, key, true as kept from kept union all select doi, base, key, false from alone union all select rest.doi, rest.base, letters.key, false from rest left join letters on letters.base = rest.base and letters.n = rest.n
""".replace("BARE", _BARE))
def q_citekeys(spark: SparkSession, d: str) -> DataFrame:
    """Stable keys for every document: released ones stay, newcomers get letters (a to z, then
    aa, ab and so on; the SQL ends with z)."""
    m = table(spark, d, "manifest").withColumn("k", keys.bare_key(F.col("doi"))).where("k is not null")
    base = text.citekey_base(F.col("year"), F.get("authors.family", F.lit(0)))
    papers = m.groupBy(F.col("k").alias("doi")).agg(F.min(base).alias("base"))
    prim = F.coalesce(F.col("record_class") == "primary_study", F.lit(False))
    held = m.select(F.col("k").alias("doi"), F.col("citekey").alias("key"), prim.alias("prim"))
    return rel.assign_keys(cut(papers), held.where("prim").drop("prim"), held.where("not prim").drop("prim"))


@query("""
with g as (select cast(year(o_orderdate) as int) as y, count(*) as n from orders where o_orderdate is not null group by 1),
q as (select y, n, 600 * n / sum(n) over () as q from g), f as (select *, floor(q) as base from q),
s as (select y, least(n, base + case when row_number() over (order by round(q - base, 9) desc, y desc) <= 600 - sum(base) over () then 1 else 0 end) as seats from f)
select y, o_orderkey, cast(rank as int) as rank from (select cast(year(o_orderdate) as int) as y, o_orderkey, row_number() over (partition by year(o_orderdate) order by o_totalprice desc, o_orderkey) as rank from orders) join s using (y) where rank <= seats
""")
def q_batches_stratified(spark: SparkSession, d: str) -> DataFrame:
    """600 seats shared out to the years by size, the dearest orders of each year."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    return rel.stratified(o, "y", [F.desc("o_totalprice"), F.col("o_orderkey")], 600).select("y", "o_orderkey", "rank")


@query("""
select o_orderkey, cast(pos as bigint) as pos, cast(ceil(pos / 100) as bigint) as batch from (
  select o_orderkey, row_number() over (order by round(coalesce(o_totalprice, 0) / greatest(1, 2030 - year(o_orderdate) + 1), 6) desc, o_orderkey) as pos from orders)
""")
def q_rank_per_age(spark: SparkSession, d: str) -> DataFrame:
    """Global rank by price per year of age, in batches of 100."""
    score = F.round(F.coalesce("o_totalprice", F.lit(0.0)) / F.greatest(F.lit(1), 2030 - F.year("o_orderdate") + 1), 6)
    o = table(spark, d, "orders").select("o_orderkey", score.alias("score"))
    return rel.numbered(o, [F.desc("score"), F.col("o_orderkey")]).select("o_orderkey", "pos", F.ceil(F.col("pos") / 100).alias("batch"))


@query("select p_brand, n from (select p_brand, count(*) as n, rank() over (order by count(*) desc) as r from part group by p_brand) where r <= 10")
def q_top_ties(spark: SparkSession, d: str) -> DataFrame:
    """The ten most frequent brands, with ties."""
    return rel.top_with_ties(table(spark, d, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")), 10, "n")


@query("""
with j as (select replace(regexp_replace(lower(trim(journal)), '^the ', ''), '&', 'and') as key, journal, count(*) as c, min(entry_id) as o from manifest where journal is not null group by all)
select key, journal, n from (select key, journal, sum(c) over (partition by key) as n, row_number() over (partition by key order by c desc, o) as r from j) where r = 1
""")
def q_journal_spelling(spark: SparkSession, d: str) -> DataFrame:
    """Per journal, whatever its spelling, the most frequent spelling."""
    m = table(spark, d, "manifest").select("entry_id", "journal")
    return rel.common_spelling(m, text.journal_key(F.col("journal")), "journal", "entry_id").select("key", "journal", "n")


@query("""
select l_orderkey, l_partkey, l_quantity from (select *, row_number() over (partition by l_orderkey order by round(l_extendedprice, 2) desc, l_returnflag = 'N' desc, l_quantity desc, l_partkey, l_suppkey) as r from lineitem) where r = 1
""")
def q_best_candidate(spark: SparkSession, d: str) -> DataFrame:
    """The best line of every order by a tuple of criteria: a max-aggregate, no window."""
    best = F.struct(F.round("l_extendedprice", 2).alias("a"), (F.col("l_returnflag") == "N").alias("b"), F.col("l_quantity").alias("c"), (-F.col("l_partkey")).alias("e"), (-F.col("l_suppkey")).alias("f"))
    got = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max(best).alias("m"))
    return got.select("l_orderkey", (-F.col("m.e")).alias("l_partkey"), F.col("m.c").alias("l_quantity"))


@query()
def q_bin_pack(spark: SparkSession, d: str) -> DataFrame:
    """Records in batches of 15 exposures, first fit decreasing."""
    p = table(spark, d, "papers").select("record_id", F.greatest(F.lit(1), F.coalesce(F.size("exposures"), F.lit(0))).alias("n"))
    return packing_plan.first_fit(p, "record_id", "n", 15)


@query()
def q_sample_seeded(spark: SparkSession, d: str) -> DataFrame:
    """A seeded sample of 100 entries: the smallest seeded hashes, a distributed top-k."""
    m = table(spark, d, "manifest").select("entry_id", "citekey")
    return m.orderBy(F.xxhash64("entry_id", F.lit(20261026)), "entry_id").limit(100)


@query("select c_mktsegment as unit, coalesce(round(sum(c_acctbal), 2), 0) as total, count(c_acctbal) as n from (select unnest(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY', 'NONE']) as c_mktsegment) u left join customer using (c_mktsegment) group by 1")
def q_units_sum(spark: SparkSession, d: str) -> DataFrame:
    """Sum per segment, with every known segment present."""
    known = spark.createDataFrame([(u,) for u in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "NONE")], "unit string")
    sums = table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("unit")).agg(F.round(F.sum("c_acctbal"), 2).alias("total"), F.count("c_acctbal").alias("n"))
    return known.join(sums, "unit", "left").select("unit", F.coalesce("total", F.lit(0.0)).alias("total"), F.coalesce("n", F.lit(0)).alias("n"))


@query("""
with t as (select trim(regexp_replace(regexp_replace(lower(p_type), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) as term, p_brand from part where p_type is not null)
select term, count(distinct p_brand) as n_brands, array_to_string(list_sort(list_distinct(list(p_brand)))[1:4], ',') as examples from t group by term having count(distinct p_brand) >= 3
""")
def q_vocab_tail(spark: SparkSession, d: str) -> DataFrame:
    """Free terms with at least three brands and their four smallest. Pairs are made distinct
    before grouping; the four smallest are kept by rank, not by collecting a group."""
    t = table(spark, d, "part").where("p_type is not null and p_brand is not null").select(text.vocabulary_key(F.col("p_type")).alias("term"), "p_brand").distinct()
    n = t.groupBy("term").agg(F.count(F.lit(1)).alias("n_brands")).where("n_brands >= 3")
    low = t.withColumn("r", F.row_number().over(Window.partitionBy("term").orderBy("p_brand"))).where("r <= 4")
    return n.join(low.groupBy("term").agg(F.array_join(F.array_sort(F.collect_list("p_brand")), ",").alias("examples")), "term")


@query(f"with {_LEDGER} select distinct {_BARE} as k from manifest where {_BARE} is not null and {_BARE} not in (select k from l)")
def q_recall_misses(spark: SparkSession, d: str) -> DataFrame:
    """The manifest's keys that the ledger lacks."""
    m = table(spark, d, "manifest").select(keys.bare_key(F.col("doi")).alias("k"))
    return rel.misses(m, ledger(spark, d).where("k is not null"), "k")


@query(f"""
with {_LEDGER}, dec as (select k from l union select {_BARE} from papers union select lower(trim(preprint.doi)) from manifest where preprint.doi is not null)
select entry_id from (select entry_id, {_BARE} as k from manifest) where k is null or k not in (select k from dec where k is not null)
""")
def q_undecided(spark: SparkSession, d: str) -> DataFrame:
    """Entries whose key is in none of three sets: judged, extracted, held as a preprint."""
    m = table(spark, d, "manifest")
    sets = [ledger(spark, d).select("k"), table(spark, d, "papers").select(keys.bare_key(F.col("doi")).alias("k")), m.select(F.lower(F.trim("preprint.doi")).alias("k"))]
    decided = reduce(DataFrame.unionByName, sets).where("k is not null").distinct()
    return m.select("entry_id", keys.bare_key(F.col("doi")).alias("k")).join(decided, "k", "left_anti").select("entry_id")


@query(f"""
with {_LEDGER}, v as (select k, arg_max(lower(trim(verdict)), (received_at is not null, received_at, ledger_id)) as v from l where length(trim(verdict)) > 0 group by k), m as (select entry_id, {_BARE} as k from manifest)
select part, count(*) as n from (select case when v.v is null then 'unjudged' when v.v = 'relevant' then 'included' when v.v = 'unspecified' then 'unresolved' else 'excluded' end as part from m left join v on v.k = m.k) group by part
""")
def q_verdict_partition(spark: SparkSession, d: str) -> DataFrame:
    """Entries by the last verdict on their key: included, unresolved, excluded, unjudged."""
    last = rel.last_wins(ledger(spark, d).where("length(trim(verdict)) > 0").select("k", "received_at", "ledger_id", F.lower(F.trim("verdict")).alias("v")), "k", ["received_at", "ledger_id"]).select("k", "v")
    got = table(spark, d, "manifest").select("entry_id", keys.bare_key(F.col("doi")).alias("k")).join(last, "k", "left")
    part = F.when(F.col("v").isNull(), "unjudged").when(F.col("v") == "relevant", "included").when(F.col("v") == "unspecified", "unresolved").otherwise("excluded")
    return got.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("""
with f as (select citekey as name, md5(text) as content, min(doc_id) as o from documents where citekey is not null and text is not null group by all),
r as (select *, row_number() over (partition by name order by o, content) as n from f) select name, content, case when n = 1 then name else name || '_' || n end as target from r
""")
def q_name_allocation(spark: SparkSession, d: str) -> DataFrame:
    """Different contents under one name get names of their own, equal ones share."""
    f = table(spark, d, "documents").select(F.col("citekey").alias("name"), F.md5("text").alias("content"), "doc_id")
    return rel.allocated_names(f, "name", "content", "doc_id")


@query("""
with o as (select user_id, max((ts, event_id)) filter (event_type <> 'error' or event_type is null) as s from events where user_id is not null group by 1)
select e.user_id, count(*) filter (event_type = 'error' and (s is null or (ts, event_id) > s)) > 0 as failing, count(*) filter (event_type = 'error' and (s is null or (ts, event_id) > s)) as n_failures from events e join o using (user_id) group by e.user_id
""")
def q_retry_memory(spark: SparkSession, d: str) -> DataFrame:
    """Failures remembered per user, cleared by the next success."""
    return rel.retry_memory(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")


@query("""
with a as (select coalesce(source, '-') as source, count(distinct citekey) filter (length(trim(text)) > 80) as n_found from abstracts group by 1), w as (select count(distinct citekey) as n_declared from manifest where citekey is not null)
select source, n_found, n_declared, n_declared - n_found as short from a, w
""")
def q_source_shortfall(spark: SparkSession, d: str) -> DataFrame:
    """Keys found per source against those declared, and the difference."""
    found = table(spark, d, "abstracts").groupBy(F.coalesce("source", F.lit("-")).alias("source")).agg(F.countDistinct(F.when(F.length(F.trim("text")) > 80, F.col("citekey"))).alias("n_found"))
    declared = table(spark, d, "manifest").agg(F.countDistinct("citekey").alias("n_declared"))
    return found.join(F.broadcast(declared)).withColumn("short", F.col("n_declared") - F.col("n_found"))  # one row


@query("""
with f as (select entry_id, citekey, files.pdf as pdf, unnest(coalesce(files.supplements, [])) as s from manifest), n as (
  select 'paper' as kind, entry_id, files.pdf as src, citekey || '.pdf' as dst from manifest where files.pdf is not null
  union all select 'supplement', entry_id, s, citekey || '_supp.pdf' from f where s is not null),
r as (select *, row_number() over (partition by dst order by kind, entry_id, src) as k from n)
select kind, entry_id, src, case when dst is null or k = 1 then dst else replace(dst, '.pdf', '_' || k || '.pdf') end as dst from r
""")
def q_move_plan(spark: SparkSession, d: str) -> DataFrame:
    """Where every file of an entry belongs; files that claim one name are numbered."""
    m = table(spark, d, "manifest")
    row = lambda df, kind, src, end: df.select(F.lit(kind).alias("kind"), "entry_id", F.col(src).alias("src"), F.concat("citekey", F.lit(end)).alias("dst"))
    every = row(m.where("files.pdf is not null"), "paper", "files.pdf", ".pdf").unionByName(row(m.select("entry_id", "citekey", F.explode("files.supplements").alias("s")).where("s is not null"), "supplement", "s", "_supp.pdf"))
    got = rel.ranked_within(every, "dst", ["kind", "entry_id", "src"], "k")
    got = got.withColumn("dst", F.when(F.col("k") == 1, F.col("dst")).otherwise(F.replace("dst", F.lit(".pdf"), F.concat(F.lit("_"), F.col("k").cast("string"), F.lit(".pdf"))))).drop("k")
    return got.unionByName(every.where("dst is null"))


@query(f"""
with m as (select citekey, min({_BARE}) as own from manifest where citekey is not null group by 1)
select abstract_id from (select abstract_id, citekey, text, {_BARE} as k from abstracts) a join m using (citekey) where k = own and length(trim(text)) > 0
""")
def q_rechecked(spark: SparkSession, d: str) -> DataFrame:
    """Abstracts that were fetched for the key that their entry bears."""
    m = table(spark, d, "manifest").where("citekey is not null").groupBy("citekey").agg(F.min(keys.bare_key(F.col("doi"))).alias("own"))
    a = table(spark, d, "abstracts").select("abstract_id", "citekey", "text", keys.bare_key(F.col("doi")).alias("k"))
    return readers.rechecked(a.join(m, "citekey"), "own", "k", "text").select("abstract_id")


@query("select count(*) filter (coalesce(length(trim(text)), 0) = 0) as n_missing, count(*) filter (coalesce(length(trim(text)), 0) = 0 and coalesce(regexp_matches(source_id, '^[0-9]+$'), false)) as n_fixable from abstracts")
def q_lookup_plan(spark: SparkSession, d: str) -> DataFrame:
    """Texts that are missing, and those that an id can bring."""
    return readers.lookup_plan(table(spark, d, "abstracts"), "text", "source_id")


_ACCESS = "case when files.pdf is not null then 'held' when preprint.doi is not null then 'preprint' when regexp_matches(doi, '10\\.[0-9]{4,9}/') then 'by_key' else 'unknown' end"


@query(f"select access, count(*) as n, row_number() over (order by count(*) desc, access) as pos from (select {_ACCESS} as access from manifest) group by access")
def q_access_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections of a want-list by how an entry can be had, the largest first."""
    access = F.when(F.col("files.pdf").isNotNull(), "held").when(F.col("preprint.doi").isNotNull(), "preprint").when(F.col("doi").rlike("10\\.[0-9]{4,9}/"), "by_key").otherwise("unknown")
    n = table(spark, d, "manifest").groupBy(access.alias("access")).agg(F.count(F.lit(1)).alias("n"))
    return rel.numbered(n, [F.desc("n"), F.col("access")])


@query(f"""
with {_LEDGER}, c as (select quantile_disc(screened_at, 0.5) as mid from ledger), f as (select k, min(screened_at) as s from l group by 1)
select count(*) filter (s <= mid) as n_before, count(*) as n_after, greatest(0, count(*) - count(*) filter (s <= mid)) as screened from f, c
""")
def q_screened(spark: SparkSession, d: str) -> DataFrame:
    """Keys in the ledger at its middle and at its end, and those screened between."""
    mid = table(spark, d, "ledger").agg(F.expr("percentile_disc(0.5) within group (order by unix_micros(cast(screened_at as timestamp)))").cast("long").alias("mid"))
    first = ledger(spark, d).where("k is not null").groupBy("k").agg(F.min(F.unix_micros(F.col("screened_at").cast("timestamp"))).alias("s"))
    got = first.join(F.broadcast(mid)).agg(F.count_if(F.col("s") <= F.col("mid")).alias("n_before"), F.count(F.lit(1)).alias("n_after"))  # one row
    return got.withColumn("screened", F.greatest(F.lit(0), F.col("n_after") - F.col("n_before")))


@query(f"""
with {_VERSIONS}, y as (select citekey, min(year) as year from manifest where citekey is not null group by 1)
select n.citekey, case when coalesce(y.year, 0) >= 2020 then 'new' else 'historical' end as age from new n left join y using (citekey) where n.citekey not in (select citekey from old)
""")
def q_added_by_age(spark: SparkSession, d: str) -> DataFrame:
    """Keys added between two versions, recent ones apart from those found late."""
    old, new = versions(spark, d)
    y = table(spark, d, "manifest").where("citekey is not null").groupBy("citekey").agg(F.min("year").alias("year"))
    got = new.select("citekey").join(old.select("citekey"), "citekey", "left_anti").join(y, "citekey", "left")
    return got.select("citekey", F.when(F.coalesce("year", F.lit(0)) >= 2020, "new").otherwise("historical").alias("age"))


@query("select entry_id, row_number() over (order by case when regexp_matches(lower(title), 'ultraso|stimulat') then 0 else 1 end, entry_id) as pos from manifest")
def q_title_first(spark: SparkSession, d: str) -> DataFrame:
    """Work order: entries whose title is on the subject first, then the others."""
    m = table(spark, d, "manifest").select("entry_id", F.when(F.lower("title").rlike("ultraso|stimulat"), 0).otherwise(1).alias("late"))
    return rel.numbered(m, [F.col("late"), F.col("entry_id")]).select("entry_id", "pos")
