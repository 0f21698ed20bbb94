"""Queries over the exposures of papers: facts, facets, statistics, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.functions import measures as ms
from strandline.operators import facts, hierarchy
from strandline.plans.registry import Registry
from strandline.session import cut, table

query = Registry()
_X = "x as (select record_id, citekey, cast(i as int) as exposure_no, exposures[i + 1] as x from (select record_id, citekey, exposures, unnest(range(len(exposures))) as i from papers) where exposures[i + 1] is not null)"
_ST = "coalesce(lower(trim({m}.state)), 'na')"
_NUMS = "coalesce(list_filter({m}.vals, lambda v: v is not null and not isnan(v)), [])"
_LEAVES = " union all ".join(f"select record_id, citekey, exposure_no, '{p}' as leaf, x.{p} as m from x" for p in facts.LEAVES)
_S, _N = _ST.format(m="m"), _NUMS.format(m="m")


def st(path: str) -> str:
    return _ST.format(m=f"x.{path}")


def nums(path: str) -> str:
    return _NUMS.format(m=f"x.{path}")


def scalar(path: str) -> str:
    return f"case when {st(path)} = 'value' and not coalesce(x.{path}.is_list, false) then {nums(path)}[1] end"


def papers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "papers")


@query(f"with {_X}, u as ({_LEAVES}) select leaf, count(*) filter ({_S} <> 'na') as applicable, count(*) filter ({_S} = 'not_reported') as not_reported, round(1 - count(*) filter ({_S} = 'not_reported') / nullif(count(*) filter ({_S} <> 'na'), 0), 3) as share from u where leaf not like 'unspecified_domain.%' group by leaf")
def q_reportability(spark: SparkSession, d: str) -> DataFrame:
    """Share of reported among applicable, per measure."""
    return facts.reporting(papers(spark, d))


@query(
    f"with {_X} "
    + " union all ".join(
        f"select '{m}' as measure, count(*) filter ({k}) as applicable, count(*) filter (({k}) and {' and '.join(f'len({nums(f'{b}.{m}')}) = 0' for b in facts.DOMAINS)}) as not_reported from x"
        for m in ("pressure_kpa", "isppa_w_cm2", "ispta_w_cm2")
        for k in [" or ".join(f"{st(f'{b}.{m}')} in ('value', 'not_reported')" for b in facts.DOMAINS)]
    )
)
def q_any_domain(spark: SparkSession, d: str) -> DataFrame:
    """Reporting of a measure in any of its domains."""
    return facts.any_domain(papers(spark, d))


_FACETS = ("model_system", "conditions", "sham_type", "auditory_control", "readouts")
# Facets with one value a record, and with one an exposure.
_SINGLE, _PER_EXPOSURE = ("direction_of_effect",), ("device.family", "timing.waveform")


@query(
    f"with {_X}, c as ("
    + " union all ".join(
        [f"select '{f}' as facet, unnest(list_distinct(coalesce({f}, []))) as value from papers" for f in _FACETS]
        + [f"select '{f}', {f} from papers" for f in _SINGLE]
        + [f"select '{f}', x.{f} from x" for f in _PER_EXPOSURE]
    )
    + ") select facet, value, count(*) as n, rank() over (partition by facet order by count(*) desc, value) as rank from c where value is not null group by facet, value"
)
def q_composition(spark: SparkSession, d: str) -> DataFrame:
    """Records, or exposures, per value of every facet, the most frequent first."""
    p = papers(spark, d)
    single = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).alias("value")) for f in _SINGLE])
    each = F.array(*[F.struct(F.lit(f).alias("facet"), facts.at(F.col("x"), f).alias("value")) for f in _PER_EXPOSURE])
    more = p.select(F.inline(single)).unionByName(facts.exposures(p).select(F.inline(each)))
    got = facts.composition(p, _FACETS).unionByName(more.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))).where("value is not null")
    return got.withColumn("rank", F.rank().over(Window.partitionBy("facet").orderBy(F.desc("n"), "value")))  # one row per value


@query(f"with {_X} select p.record_id, exposure_no, {scalar('timing.sonication_duration_s')} as duration from x join papers p using (record_id) where x.timing.waveform = 'pulsed' and list_contains(p.model_system, 'human_healthy')")
def q_waveform_population(spark: SparkSession, d: str) -> DataFrame:
    """Durations of one waveform in one population."""
    got = facts.exposures(papers(spark, d).where(F.array_contains("model_system", "human_healthy")), "record_id").where(F.col("x.timing.waveform") == "pulsed")
    return got.select("record_id", "exposure_no", ms.scalar(F.col("x.timing.sonication_duration_s")).alias("duration"))


@query(f"with {_X} select p.record_id, exposure_no, list_min({nums('free_field.pressure_kpa')}) as p_lo, list_max({nums('free_field.pressure_kpa')}) as p_hi from x join papers p using (record_id) where list_contains({nums('fundamental_frequency_khz')}, 500.0) and p.direction_of_effect = 'excitatory'")
def q_exact_frequency(spark: SparkSession, d: str) -> DataFrame:
    """Exposures at exactly one frequency, also as one of several, with an enumeration's value."""
    got = facts.exposures(papers(spark, d).where(F.col("direction_of_effect") == "excitatory"), "record_id").where(F.array_contains(ms.numbers(F.col("x.fundamental_frequency_khz")), 500.0))
    s = ms.summary(F.col("x.free_field.pressure_kpa"))
    return got.select("record_id", "exposure_no", s.lo.alias("p_lo"), s.hi.alias("p_hi"))


@query(f"with {_X} select record_id, exposure_no, len(list_filter({nums('fundamental_frequency_khz')}, lambda v: v between 480 and 520)) > 0 as any_value, list_min({nums('fundamental_frequency_khz')}) <= 520 and list_max({nums('fundamental_frequency_khz')}) >= 480 as overlap from x where len({nums('fundamental_frequency_khz')}) > 0")
def q_swept_filter(spark: SparkSession, d: str) -> DataFrame:
    """A range matched by any value of a list, against the looser overlap of its ends."""
    m = F.col("x.fundamental_frequency_khz")
    got = facts.exposures(papers(spark, d), "record_id").where(F.size(ms.numbers(m)) > 0)
    s = ms.summary(m)
    return got.select("record_id", "exposure_no", ms.any_between(m, 480, 520).alias("any_value"), ((s.lo <= 520) & (s.hi >= 480)).alias("overlap"))


@query(f"""
with {_X}, c as (select record_id, exposure_no, {scalar('timing.pulse_duration_ms')} as pd, {scalar('timing.pulse_repetition_frequency_hz')} as prf, {scalar('timing.duty_cycle_pct')} as dc, {st('timing.pulse_duration_ms')} as st, x from x)
select record_id, exposure_no, (floor(pd * prf / 10 * 1000.0 + 0.5) / 1000.0) as duty_computed, case when dc > 0 then abs((floor(pd * prf / 10 * 1000.0 + 0.5) / 1000.0) - dc) / dc > 0.05 end as duty_mismatch,
  case when st = 'not_reported' then floor(dc * 10 / nullif(prf, 0) * 10000.0 + 0.5) / 10000.0 end as duration_implied,
  array_to_string(list_filter([case when len(list_filter({nums('fundamental_frequency_khz')}, lambda v: v not between 20 and 20000)) > 0 then 'f0_out_of_range' end,
    case when pd > 1000 / nullif(prf, 0) * 1.0001 then 'pd_exceeds_period' end,
    {', '.join(f"case when {scalar(f'{b}.pressure_kpa')} > 0 and {scalar(f'{b}.isppa_w_cm2')} is not null and not coalesce(pow({scalar(f'{b}.pressure_kpa')} * 1e3, 2) / 3e6 / 1e4 / nullif({scalar(f'{b}.isppa_w_cm2')}, 0) between 0.5 and 2, false) then 'intensity_pressure_inconsistent_{b}' end" for b in facts.DOMAINS)}], lambda v: v is not null), ',') as flags
from c
""")
def q_derive_checks(spark: SparkSession, d: str) -> DataFrame:
    """Computed duty cycle, implied duration and the arithmetic flags of every exposure."""
    got = facts.checks(papers(spark, d))
    return got.select("record_id", "exposure_no", "duty_computed", "duty_mismatch", "duration_implied", F.array_join("flags", ",").alias("flags"))


_READS = """
r as (select * from (select *, row_number() over (partition by citekey order by load_id, record_id) as a, row_number() over (partition by citekey order by load_id desc, record_id desc) as z, count(*) over (partition by citekey) as k from papers where citekey is not null and load_id is not null)),
b as (select f.citekey, f.exposures as ea, s.exposures as eb from r f join r s using (citekey) where f.a = 1 and s.z = 1 and f.k > 1)
"""


def readings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """First and last delivery of every record that was delivered more than once."""
    p = papers(spark, d).where("citekey is not null and load_id is not null").select("citekey", "load_id", "record_id", "exposures")
    many = p.groupBy("citekey").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("citekey")
    p = p.join(many, "citekey", "left_semi")
    ends = p.groupBy("citekey").agg(F.min(F.struct("load_id", "record_id")).alias("a"), F.max(F.struct("load_id", "record_id")).alias("z"))
    pick = lambda c: p.join(ends.select("citekey", F.col(f"{c}.load_id").alias("load_id"), F.col(f"{c}.record_id").alias("record_id")), ["citekey", "load_id", "record_id"])
    return pick("a"), pick("z")


_AGREE = "\n union all ".join(
    f"select citekey, '{p}' as leaf, {_NUMS.format(m=f'a.{p}')} as u, {_NUMS.format(m=f'b.{p}')} as v, {_ST.format(m=f'a.{p}')} as su, {_ST.format(m=f'b.{p}')} as sv from z" for p in facts.LEAVES
)


@query(f"""
with {_READS}, z as (select citekey, ea[i + 1] as a, eb[i + 1] as b from (select *, unnest(range(len(ea))) as i from b where len(ea) = len(eb)) where ea[i + 1] is not null and eb[i + 1] is not null),
l as ({_AGREE}), d as (select *, list_sort(list_distinct(u)) as du, list_sort(list_distinct(v)) as dv from l)
select leaf, count(*) as n, count(*) filter (case when len(du) = 1 and len(dv) = 1 then abs(du[1] - dv[1]) <= 0.02 * greatest(abs(du[1]), abs(dv[1]), 1e-9) when len(du) = 0 and len(dv) = 0 then su = sv else du = dv end) as n_agree from d group by leaf
union all select 'exposures', count(*), 0 from b where coalesce(len(ea), 0) <> coalesce(len(eb), 0) having count(*) > 0
""")
def q_compare_reads(spark: SparkSession, d: str) -> DataFrame:
    """Agreement of first and last delivery, per measure, within 2 %."""
    a, b = readings(spark, d)
    return facts.compare(a, b).groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.count_if("agree").alias("n_agree"))


@query()
def q_apply_rulings(spark: SparkSession, d: str) -> DataFrame:
    """First deliveries with every disputed measure replaced by the last delivery's, which must
    then agree: numbers of disputes before and after."""
    a, b = readings(spark, d)
    a, b = cut(a), cut(b)
    before = cut(facts.compare(a, b).where("not agree and exposure_no is not null").select("citekey", "exposure_no", "leaf"))
    theirs = facts.unpivot(b, "citekey").select("citekey", "exposure_no", "leaf", "m")
    fixed = facts.set_at(a, before.join(theirs, ["citekey", "exposure_no", "leaf"]), "citekey")
    after = facts.compare(fixed, b).where("not agree and exposure_no is not null")
    return before.agg(F.count(F.lit(1)).alias("n_before")).crossJoin(after.agg(F.count(F.lit(1)).alias("n_after")))  # one row each


_RULES = " ".join(f"union all select record_id, exposure_no, 'partial_block_{b}' from x where (x.{b}.pressure_kpa is not null or x.{b}.isppa_w_cm2 is not null or x.{b}.ispta_w_cm2 is not null) and not (x.{b}.pressure_kpa is not null and x.{b}.isppa_w_cm2 is not null and x.{b}.ispta_w_cm2 is not null)" for b in facts.DOMAINS)


@query(f"""
with {_X}, u as ({_LEAVES}), r as (
  select distinct record_id, exposure_no, rule from (select record_id, exposure_no, unnest([case when m.state = 'value' and coalesce(len(m.vals), 0) = 0 then 'value_without_number' end,
    case when m.state in ('not_reported', 'na') and coalesce(len(m.vals), 0) > 0 then 'number_without_value' end,
    case when m.is_list <> (coalesce(len(m.vals), 0) > 1) then 'list_flag_wrong' end, case when m.state not in ('value', 'not_reported', 'na') then 'unknown_state' end]) as rule from u where m is not null) where rule is not null
  {_RULES})
select rule, count(*) as n, count(distinct record_id) as n_records from r group by rule
""")
def q_validate_rules(spark: SparkSession, d: str) -> DataFrame:
    """Broken structural rules, by rule."""
    return facts.block_discipline(papers(spark, d)).groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("record_id").alias("n_records"))


_CLOSURE = """
e as (select id, min(case when regexp_matches(parent, '\\S') then parent end) as parent from targets where id is not null group by id),
up as (select id, id as a, parent as nxt, 0 as n from e union all select up.id, e.id, e.parent, n + 1 from up join e on e.id = up.nxt where n < 400),
anc as (select distinct id, a from up)
"""


@query(f"""
with recursive {_CLOSURE}, {_X}, t as (select distinct record_id, exposure_no, coalesce(a, term) as t from (select record_id, exposure_no, unnest(x.target.terms) as term from x) s left join anc on anc.id = s.term where term is not null),
g as (select record_id, exposure_no, string_agg(t, ',' order by t) as target_all from t group by all), m as (select citekey, min((entry_id, year)) as b from manifest where citekey is not null group by citekey)
select x.record_id, x.exposure_no, struct_extract_at(m.b, 2) as year, coalesce(g.target_all, '') as target_all, list_min({nums('fundamental_frequency_khz')}) as f0_lo, list_max({nums('fundamental_frequency_khz')}) as f0_hi,
  array_to_string(list_filter([{', '.join(f"case when {st(p)} = 'value' and x.{p}.is_list and len({nums(p)}) > 1 then '{p}' end" for p in facts.LEAVES)}], lambda v: v is not null), ',') as swept
from x left join g using (record_id, exposure_no) left join m on m.citekey = x.citekey
""")
def q_exposure_flatten(spark: SparkSession, d: str) -> DataFrame:
    """The wide fact rows that the readers' queries use."""
    got = facts.flat(papers(spark, d), table(spark, d, "manifest"), closure(spark, d))
    f0 = F.col("fundamental_frequency_khz")
    return got.select("record_id", "exposure_no", "year", F.array_join("target_all", ",").alias("target_all"), f0.lo.alias("f0_lo"), f0.hi.alias("f0_hi"), F.array_join("swept", ",").alias("swept"))


def closure(spark: SparkSession, d: str) -> DataFrame:
    """(id, path): every term with itself and its ancestors; terms on or under a cycle have the
    nodes that a walk reaches."""
    got = hierarchy.resolve(table(spark, d, "targets"))
    ring = got.where("state = 'cycle'").groupBy("root_id").agg(F.collect_set("id").alias("ring"))  # a cycle's nodes
    return got.join(ring, "root_id", "left").select("id", F.array_union("path", F.coalesce("ring", F.array().cast("array<string>"))).alias("path"))


@query(f"""
with recursive {_CLOSURE}, {_X}, t as (select record_id, exposure_no, unnest(list_distinct(x.target.terms)) as term from x)
select a as term_id, count(distinct (record_id, exposure_no)) as n_exposures, count(distinct record_id) as n_records from t join anc on anc.id = t.term group by a
""")
def q_hier_search(spark: SparkSession, d: str) -> DataFrame:
    """Exposures and records under every term of the vocabulary, itself included."""
    x = facts.exposures(papers(spark, d), "record_id").select("record_id", "exposure_no", F.explode(F.array_distinct("x.target.terms")).alias("id")).where("id is not null")
    up = x.join(closure(spark, d), "id").select("record_id", "exposure_no", F.explode("path").alias("term_id")).distinct()
    per = up.groupBy("term_id", "record_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("term_id").agg(F.sum("n").alias("n_exposures"), F.count(F.lit(1)).alias("n_records"))


@query(f"""
with recursive {_CLOSURE}, {_X}, t as (select distinct record_id, exposure_no from (select record_id, exposure_no, unnest(x.target.terms) as term from x) s join anc on anc.id = s.term where anc.a = 'cavoral_nerve')
select record_id, exposure_no, p.direction_of_effect as direction, {scalar('fundamental_frequency_khz')} as f0 from t join x using (record_id, exposure_no) join papers p using (record_id) where list_has_any(p.model_system, ['rodent', 'large_animal'])
""")
def q_target_in_animals(spark: SparkSession, d: str) -> DataFrame:
    """Exposures of a term or anything below it in given model systems, with parameters and effect."""
    below = closure(spark, d).where(F.array_contains("path", "cavoral_nerve")).select("id")
    x = facts.exposures(papers(spark, d).where(F.arrays_overlap("model_system", F.array(F.lit("rodent"), F.lit("large_animal")))), "record_id", "direction_of_effect")
    rows = x.select("record_id", "exposure_no", F.col("direction_of_effect").alias("direction"), ms.scalar(F.col("x.fundamental_frequency_khz")).alias("f0"), "x.target.terms")
    hit = rows.select("record_id", "exposure_no", F.explode("terms").alias("id")).join(below, "id").select("record_id", "exposure_no").distinct()
    return rows.join(hit, ["record_id", "exposure_no"]).drop("terms")


@query("""
with recursive e as (select 'R' || r_regionkey as id, null as parent from region union all select 'N' || n_nationkey, 'R' || n_regionkey from nation union all select 'C' || c_custkey, 'N' || c_nationkey from customer),
up as (select id, id as a, parent as nxt, 0 as n from e union all select up.id, e.id, e.parent, n + 1 from up join e on e.id = up.nxt)
select a as ancestor, n as distance, count(*) as n_nodes from up where n > 0 group by all
""")
def q_hierarchy_closure(spark: SparkSession, d: str) -> DataFrame:
    """Closure of region, nation and customer: nodes per ancestor and distance."""
    tag = lambda t, p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    r = table(spark, d, "region").select(tag("r", "R", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"))
    n = table(spark, d, "nation").select(tag("n", "N", "n_nationkey").alias("id"), tag("n", "R", "n_regionkey").alias("parent"))
    c = table(spark, d, "customer").select(tag("c", "C", "c_custkey").alias("id"), tag("c", "N", "c_nationkey").alias("parent"))
    got = hierarchy.descendants(hierarchy.resolve(r.unionByName(n).unionByName(c)))
    return got.groupBy("ancestor", "distance").agg(F.count(F.lit(1)).alias("n_nodes"))


@query(f"with {_X} select x.in_situ.method as method, count(*) as n, round(min(v), 6) as lo, round(quantile_cont(v, 0.5), 6) as mid, round(max(v), 6) as hi from (select x, unnest({nums('in_situ.isppa_w_cm2')}) as v from x) where isfinite(v) group by 1")
def q_in_situ_by_method(spark: SparkSession, d: str) -> DataFrame:
    """Distribution of the in-situ intensity by the method of estimation."""
    got = facts.exposures(papers(spark, d)).select(F.col("x.in_situ.method").alias("method"), F.explode(ms.numbers(F.col("x.in_situ.isppa_w_cm2"))).alias("v")).where("v < double('inf') and v > double('-inf')")
    return got.groupBy("method").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("v"), 6).alias("lo"), F.round(F.percentile("v", 0.5), 6).alias("mid"), F.round(F.max("v"), 6).alias("hi"))


@query(f"with {_X}, s as (select record_id, exposure_no, {scalar('fundamental_frequency_khz')} as f0, {scalar('free_field.pressure_kpa')} as p from x) select record_id, exposure_no, f0, p from s where f0 is not null and p is not null")
def q_scatter(spark: SparkSession, d: str) -> DataFrame:
    """Exposures with single values of two measures; lists are left out of joint plots."""
    got = facts.exposures(papers(spark, d), "record_id").select("record_id", "exposure_no", ms.scalar(F.col("x.fundamental_frequency_khz")).alias("f0"), ms.scalar(F.col("x.free_field.pressure_kpa")).alias("p"))
    return got.where("f0 is not null and p is not null")


@query(f"with {_X} select record_id, exposure_no, x.timing.waveform as waveform from x where " + " or ".join(f"len(list_filter({nums(f'{b}.isppa_w_cm2')}, lambda v: v >= 20)) > 0" for b in facts.DOMAINS))
def q_intensity_any(spark: SparkSession, d: str) -> DataFrame:
    """Exposures with an intensity of at least 20 in any domain."""
    hit = F.lit(False)
    for b in facts.DOMAINS:
        hit = hit | ms.any_between(F.col(f"x.{b}.isppa_w_cm2"), 20, None)
    return facts.exposures(papers(spark, d), "record_id").where(hit).select("record_id", "exposure_no", F.col("x.timing.waveform").alias("waveform"))


@query("select record_id, citekey from papers where list_contains(model_system, 'human_healthy') and list_contains(readouts, 'fmri') and direction_of_effect = 'excitatory' and n_subjects >= 10")
def q_facet_filter(spark: SparkSession, d: str) -> DataFrame:
    """A conjunction over array facets, an enumeration and a threshold."""
    ok = F.array_contains("model_system", "human_healthy") & F.array_contains("readouts", "fmri") & (F.col("direction_of_effect") == "excitatory") & (F.col("n_subjects") >= 10)
    return papers(spark, d).where(ok).select("record_id", "citekey")


@query("""
select value, count(*) filter (e = 'excitatory') as excitatory, count(*) filter (e = 'inhibitory') as inhibitory, count(*) filter (e = 'no_effect') as no_effect
from (select unnest(list_distinct(readouts)) as value, direction_of_effect as e from papers) where value is not null group by value
""")
def q_pivot_crosstab(spark: SparkSession, d: str) -> DataFrame:
    """Readouts against the direction of effect."""
    got = papers(spark, d).select(F.explode(F.array_distinct("readouts")).alias("value"), F.col("direction_of_effect").alias("e")).where("value is not null")
    kinds = ["excitatory", "inhibitory", "no_effect"]
    return got.groupBy("value").pivot("e", kinds).agg(F.count(F.lit(1))).select("value", *[F.coalesce(k, F.lit(0)).alias(k) for k in kinds])


@query("select p.record_id from papers p left join (select citekey, min(title) as title from manifest group by citekey) m using (citekey) where contains(lower(concat_ws(' ', m.title, p.direction_notes, p.readout_other, p.safety_notes)), 'headache')")
def q_text_search(spark: SparkSession, d: str) -> DataFrame:
    """Case-insensitive containment over several text fields."""
    m = table(spark, d, "manifest").where("citekey is not null").groupBy("citekey").agg(F.min("title").alias("title"))
    p = papers(spark, d).join(m, "citekey", "left")
    return p.where(F.contains(F.lower(F.concat_ws(" ", "title", "direction_notes", "readout_other", "safety_notes")), F.lit("headache"))).select("record_id")


@query("select coalesce(lower(trim(species)), '') as species, count(*) as n, count(n_subjects) as n_reporting, coalesce(sum(n_subjects) filter (n_subjects > 0), 0) as subjects, count(*) filter (provenance.human_edited) as n_edited, coalesce(sum(len(provenance.flags)), 0) as n_flags from papers group by 1")
def q_subjects(spark: SparkSession, d: str) -> DataFrame:
    """Subjects, reporting records, edits and flags per species."""
    return papers(spark, d).groupBy(F.coalesce(F.lower(F.trim("species")), F.lit("")).alias("species")).agg(
        F.count(F.lit(1)).alias("n"), F.count("n_subjects").alias("n_reporting"), F.coalesce(F.sum(F.when(F.col("n_subjects") > 0, F.col("n_subjects"))), F.lit(0)).alias("subjects"),
        F.count_if("provenance.human_edited").alias("n_edited"), F.coalesce(F.sum(F.size("provenance.flags")), F.lit(0)).alias("n_flags"),
    )
