"""Queries that validate and repair records, batches and verdict rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import text
from strandline.operators import facts, validation as val
from strandline.plans.exposures import _LEAVES, _RULES, _X, nums, st
from strandline.plans.registry import Registry
from strandline.plans.texts import _FOLD
from strandline.session import table

query = Registry()


def papers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "papers")


_IDENTITY = """
held as (select citekey, doi, authors from (select *, row_number() over (partition by citekey order by entry_id) as n from manifest where citekey is not null) where n = 1),
odd as (select record_id, case when h.citekey is null then 'not_held' when lower(coalesce(h.doi, '')) <> lower(coalesce(p.doi, '')) then 'doi_differs'
  when coalesce(len(h.authors), 0) = 0 or regexp_matches(p.citekey, '^([0-9]{4}|nd)anon[a-z]?$') then 'no_authors' end as problem from papers p left join held h on h.citekey = p.citekey)
"""


@query(f"with {_IDENTITY} select record_id, problem from odd where problem is not null")
def q_identity_check(spark: SparkSession, d: str) -> DataFrame:
    """Records that do not belong to the entry whose key they bear."""
    return val.identity_problems(papers(spark, d), table(spark, d, "manifest"))


def _leaf(path: str) -> str:
    return f"case when len({nums(path)}) > 0 then 'value' when {st(path)} = 'not_reported' then 'not_reported' else 'na' end"


_TEXT = "case when x.in_situ.{0} is null then 'na' when x.in_situ.{0} = 'not_reported' then 'not_reported' else 'value' end"
_LEAF5 = ("method", "reported_as", *val.IN_SITU_NUMBERS)


@query(f"""
with {_X}, a as (select record_id, exposure_no, {_TEXT.format('method')} as t1, {_TEXT.format('reported_as')} as t2, {', '.join(f"{_leaf(f'in_situ.{n}')} as m{i}" for i, n in enumerate(val.IN_SITU_NUMBERS))},
  {', '.join(f"{_leaf(f'unspecified_domain.{n}')} as u{i}" for i, n in enumerate(val.IN_SITU_NUMBERS))} from x),
b as (select *, [t1, t2, m0, m1, m2] as was, case when m0 = 'na' and m1 = 'na' and m2 = 'na' then ['na', 'na', m0, m1, m2] else [t1, t2, m0, m1, m2] end as mid from a),
c as (select *, len(list_filter(mid, lambda s: s = 'na')) as nulls, list_contains([m0, m1, m2], 'value') as number from b),
e as (select record_id, exposure_no, was, case when nulls between 1 and 4 then list_transform(mid, lambda s: case when not number then 'na' when s = 'na' then 'not_reported' else s end) else mid end as now, [u0, u1, u2] as us from c)
select record_id, exposure_no, [{', '.join(f"'in_situ.{n}'" for n in _LEAF5)}][i] as leaf, was[i] as old, now[i] as new from (select *, unnest(range(1, 6)) as i from e) where was[i] <> now[i]
union all select record_id, exposure_no, [{', '.join(f"'unspecified_domain.{n}'" for n in val.IN_SITU_NUMBERS)}][i], us[i], 'na' from (select *, unnest(range(1, 4)) as i from e) where us[i] = 'not_reported'
""")
def q_block_repair(spark: SparkSession, d: str) -> DataFrame:
    """Leaves that the all-or-nothing rules of the blocks change, with both states."""
    return val.block_repairs(papers(spark, d))


_QF = _FOLD.format(c="q")


@query(f"""
with {_X}, u as ({_LEAVES}), v as (select record_id, citekey, exposure_no, leaf, coalesce(list_filter(m.vals, lambda v: v is not null and not isnan(v)), []) as v from u),
s as (select record_id, path, min(quote) as quote from (select record_id, unnest(map_keys(provenance.source_quotes)) as path, unnest(map_values(provenance.source_quotes)) as quote from papers) where quote <> '' group by all),
c as (select v.*, s.quote from v left join s on s.record_id = v.record_id and s.path = 'exposures[' || exposure_no || '].' || leaf where len(v) > 0),
i as (select record_id, leaf, v, arg_min(quote, exposure_no) as first from c where quote is not null group by all),
t as (select citekey, {_FOLD.format(c='min(text)')} as k from abstracts where citekey is not null and text is not null group by citekey),
q as (select c.record_id, c.citekey, c.exposure_no, c.leaf, coalesce(c.quote, i.first) as q from c left join i on i.record_id = c.record_id and i.leaf = c.leaf and i.v = c.v),
p as (select record_id, exposure_no, leaf, q, k, list_filter(list_transform(regexp_split_to_array(q, '\\[\\s*(?:\\.\\.\\.|\\x{{2026}})\\s*\\]|\\.\\.\\.|\\x{{2026}}'), lambda s: {_FOLD.format(c='s')}), lambda s: s <> '') as parts from q left join t using (citekey)),
f as (select *, case when k is null then null when len(parts) > 1 then len(list_filter(parts, lambda s: length(s) < 8 or not contains(k, s))) = 0
  when len(parts) = 1 and length(parts[1]) >= 12 then contains(k, parts[1]) or
    (case when length(parts[1]) // 3 >= 10 and contains(k, substring(parts[1], 1, length(parts[1]) // 3)) then 1 else 0 end
   + case when length(parts[1]) // 3 >= 10 and contains(k, substring(parts[1], length(parts[1]) // 3 + 1, length(parts[1]) // 3)) then 1 else 0 end
   + case when length(parts[1]) - 2 * (length(parts[1]) // 3) >= 10 and contains(k, substring(parts[1], 2 * (length(parts[1]) // 3) + 1)) then 1 else 0 end) >= 2
  else false end as found from p)
select record_id, exposure_no, leaf, case when q is null then 'no source quote' else 'quote not found in text' end as reason from f where q is null or not found
""")
def q_quote_strip(spark: SparkSession, d: str) -> DataFrame:
    """Numbers without a quotation, own or inherited, that the abstract holds."""
    return val.unquoted(papers(spark, d), table(spark, d, "abstracts"))


@query(f"""
with {_X}, a as (select record_id, exposure_no, x, {', '.join(f"{_leaf(f'in_situ.{n}')} as m{i}" for i, n in enumerate(val.IN_SITU_NUMBERS))} from x),
b as (select *, m0 = 'na' and m1 = 'na' and m2 = 'na' as none, m0 <> 'na' and m1 <> 'na' and m2 <> 'na' as whole,
  len({nums('timing.pulse_repetition_frequency_hz')}) > 0 or len({nums('timing.pulse_duration_ms')}) > 0 or len(list_filter({nums('timing.duty_cycle_pct')}, lambda v: v <> 100)) > 0 as gated from a),
c as (select record_id, exposure_no, x, case when none then null when whole then coalesce(x.in_situ.method, 'not_reported') else x.in_situ.method end as method,
  case when none then null when whole then coalesce(x.in_situ.reported_as, 'not_reported') else x.in_situ.reported_as end as reported_as,
  case when x.timing.waveform = 'continuous' and gated then 'pulsed' else x.timing.waveform end as waveform from b)
select record_id, exposure_no, method, reported_as, waveform from c where method is distinct from x.in_situ.method or reported_as is distinct from x.in_situ.reported_as or waveform is distinct from x.timing.waveform
""")
def q_settle(spark: SparkSession, d: str) -> DataFrame:
    """Exposures that the consequences of a ruling change."""
    return val.settled(papers(spark, d))


@query(f"with {_X}, u as ({_LEAVES}) select record_id, exposure_no, leaf, case when len(coalesce(m.vals, [])) > 0 then 'blank' else m.state end as state from u where m is not null")
def q_skeleton(spark: SparkSession, d: str) -> DataFrame:
    """States of all measures of the blanked records; numbers are gone."""
    cells = facts.unpivot(val.skeleton(papers(spark, d).select("record_id", "exposures")), "record_id")
    return cells.where("m is not null").select("record_id", "exposure_no", "leaf", "m.state")


@query("""
with v as (select ledger_id, doi, lower(trim(verdict)) as v, criterion, reason from ledger)
select ledger_id, problem from (select ledger_id, unnest([case when coalesce(length(trim(doi)), 0) = 0 then 'no_key' end, case when coalesce(length(v), 0) = 0 then 'no_verdict' end,
  case when length(v) > 0 and v not in ('relevant', 'not_relevant', 'unspecified') then 'unknown_verdict' end, case when v = 'not_relevant' and not coalesce(regexp_matches(criterion, '^E[1-9]$'), false) then 'no_code' end,
  case when v in ('relevant', 'unspecified') and criterion is not null then 'code_without_exclusion' end, case when coalesce(length(trim(reason)), 0) = 0 then 'no_reason' end]) as problem from v) where problem is not null
""")
def q_verdict_check(spark: SparkSession, d: str) -> DataFrame:
    """Ledger rows that could not be recorded, by problem."""
    return val.verdict_problems(table(spark, d, "ledger"), ("relevant", "not_relevant", "unspecified"), "not_relevant")


@query(f"""
with {_X}, u as ({_LEAVES}), r as (select distinct record_id from (select record_id, exposure_no, unnest([case when m.state = 'value' and coalesce(len(m.vals), 0) = 0 then 'a' end, case when m.state in ('not_reported', 'na') and coalesce(len(m.vals), 0) > 0 then 'b' end,
    case when m.is_list <> (coalesce(len(m.vals), 0) > 1) then 'c' end, case when m.state not in ('value', 'not_reported', 'na') then 'd' end]) as rule from u where m is not null {_RULES}) where rule is not null),
{_IDENTITY}, s as (select citekey, max(case when odd.problem is not null then 2 when r.record_id is not null then 1 else 0 end) as s from papers p left join odd using (record_id) left join r using (record_id) where citekey is not null group by citekey),
w as (select distinct citekey from manifest where citekey is not null)
select status, count(*) as n from (select case when s is null then 'missing' when w.citekey is null then 'extra' when s = 2 then 'identity' when s = 1 then 'problems' else 'ok' end as status from w full join s on s.citekey = w.citekey) group by status
""")
def q_check_records(spark: SparkSession, d: str) -> DataFrame:
    """The manifest as a batch against the records that came, by status."""
    p, m = papers(spark, d), table(spark, d, "manifest")
    return val.batch_status(m, p, m, facts.block_discipline(p)).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("select case when anaesthesia in ('anesthetised', 'anesthetized', 'anaesthetized') then 'anaesthetised' else anaesthesia end as anaesthesia, count(*) as n from papers group by 1")
def q_spelling(spark: SparkSession, d: str) -> DataFrame:
    """Records by value after the other spellings are folded."""
    return papers(spark, d).groupBy(text.spelled(F.col("anaesthesia")).alias("anaesthesia")).agg(F.count(F.lit(1)).alias("n"))


@query("""
with s as (select entry_id, case when contains(lower(title), 'patients') then 'clinical' when contains(lower(title), 'rats') then 'animal' end as signal from manifest),
u as (select count(*) as n_flags, count(*) filter (entry_id not in (select entry_id from manifest where screening.reason is not null)) as n_unreviewed from s where signal is not null)
select n_flags, n_unreviewed, n_unreviewed = 0 as passed from u
""")
def q_scope_gate(spark: SparkSession, d: str) -> DataFrame:
    """The gate before a release: it passes only if every flag was reviewed."""
    m = table(spark, d, "manifest")
    t = F.lower("title")
    flag = F.when(F.contains(t, F.lit("patients")), "clinical").when(F.contains(t, F.lit("rats")), "animal")
    got = m.select(F.col("screening.reason").isNull().alias("open"), flag.alias("signal")).where("signal is not null").agg(F.count(F.lit(1)).alias("n_flags"), F.count_if("open").alias("n_unreviewed"))
    return got.withColumn("passed", F.col("n_unreviewed") == 0)
