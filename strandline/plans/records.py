"""Queries p1_, p3_ and p5_: nested records, column profiles, hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import hierarchy, nested, profile
from strandline.session import table


def trees(spark: SparkSession, d: str) -> DataFrame:
    """The walks of all records, typed ones and payloads."""
    papers = table(spark, d, "papers").select("record_id", "exposures")
    raw = nested.json_trees(table(spark, d, "raw_papers").select("record_id", "payload"), papers.schema["exposures"].dataType)
    return nested.typed_trees(papers).unionByName(raw)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """One row per single number under the measures of an exposure."""
    return nested.single_values(trees(spark, d), labels=False)


def p1_values(spark: SparkSession, d: str) -> DataFrame:
    """The values table with the interval labels and the key of the parent node."""
    return nested.single_values(trees(spark, d))


def p1_exposures(spark: SparkSession, d: str) -> DataFrame:
    """The exposures table: record, number, label (intervals: see p1_values)."""
    return nested.exposures(trees(spark, d)).select("record_id", "exposure_no", "label")


def p1_terms(spark: SparkSession, d: str) -> DataFrame:
    """The target terms table: record, exposure, number, term."""
    return nested.target_terms(trees(spark, d)).select("record_id", "exposure_no", "term_no", "term")


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    """The records table: one row per record with the size of its tree."""
    return nested.records(trees(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Loads in which a field went wrong."""
    return profile.issues(table(spark, d, "papers").select("load_id", "exposures"))


def p3_profile(spark: SparkSession, d: str) -> DataFrame:
    """Profile of every field and load, with the distance to the load before."""
    got = profile.profile(table(spark, d, "papers").select("load_id", "exposures"))
    return got.withColumns({c: F.round(c, 9) for c in ("missing_share", "odd_state_share", "invalid_share", "q25", "median", "q75", "ks")})


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Root, depth and state of every term, and the strings that are no term."""
    return hierarchy.terms_found(table(spark, d, "targets"), table(spark, d, "papers").select("exposures"))


def p5_paths(spark: SparkSession, d: str) -> DataFrame:
    """Path from the root, joined by ' > ', and the number of descendants of every term."""
    got = hierarchy.resolve(table(spark, d, "targets"))
    below = hierarchy.descendants(got).groupBy(F.col("ancestor").alias("id")).agg(F.count(F.lit(1)).alias("n_descendants"))
    return got.join(below, "id", "left").select("id", "root_id", "depth", "state", F.array_join("path", " > ").alias("path"), F.coalesce("n_descendants", F.lit(0)).alias("n_descendants"))


def p5_descendants(spark: SparkSession, d: str) -> DataFrame:
    """One row per ancestor and descendant."""
    return hierarchy.descendants(hierarchy.resolve(table(spark, d, "targets")))


def q_top_level(spark: SparkSession, d: str) -> DataFrame:
    """Terms rolled up to the level below the roots."""
    got = hierarchy.resolve(table(spark, d, "targets")).where("state = 'ok'")
    return hierarchy.top_level(got.select("id", "path"), got.where("depth = 0").select("id"))


def q_tree_listing(spark: SparkSession, d: str) -> DataFrame:
    """The vocabulary's trees as indented lines."""
    targets = table(spark, d, "targets")
    return hierarchy.listing(hierarchy.resolve(targets).where("state = 'ok'"), targets)


QUERIES = {f.__name__: f for f in (q_top_level, q_tree_listing, p1_found, p1_values, p1_exposures, p1_terms, p1_records, p3_found, p3_profile, p5_found, p5_paths, p5_descendants)}

_CELLS = ", ".join(f"('{b}', '{m}')" for b, ms in nested.BLOCKS.items() for m in ms)
_TYPED = "\n    union all ".join(
    f"select record_id, exposure_no, '{b}' as block, '{m}' as field, x.{m if b == 'exposure' else f'{b}.{m}'}.vals as vals from x" for b, ms in nested.BLOCKS.items() for m in ms
)
_EXPOSURES = """
with recursive x as (
  select record_id, cast(i as int) as exposure_no, exposures[i + 1] as x from (select record_id, exposures, unnest(range(len(exposures))) as i from papers)
), j0 as (
  select record_id, case when json_valid(payload) then payload::json end as j from raw_papers
), j1 as (
  select record_id, case when json_type(j) = 'OBJECT' and json_type(j, '$.record') = 'OBJECT' then json_extract(j, '$.record') else j end as j from j0 where json_type(j) = 'OBJECT'
), j2 as (
  select record_id, case when json_type(j, '$.exposures') = 'VARCHAR' then case when json_valid(j ->> '$.exposures') then (j ->> '$.exposures')::json end else json_extract(j, '$.exposures') end as e from j1
), j3 as (
  select record_id, case when json_type(e) = 'OBJECT' then json_array(e) else e end as e from j2
), y as (
  select record_id, cast(i as int) as exposure_no, json_extract(e, '$[' || i || ']') as x
  from (select record_id, e, unnest(range(cast(json_array_length(e) as bigint))) as i from j3 where json_type(e) = 'ARRAY')
)
"""
_P1_FOUND = (
    _EXPOSURES
    + f""", typed as (
    {_TYPED}
), cells(block, field) as (values {_CELLS}), raw as (
  select record_id, exposure_no, block, field, cast([] as bigint[]) as steps, json_extract(x, case when block = 'exposure' then '$.' || field else '$.' || block || '.' || field end) as v
  from y cross join cells where json_type(x) = 'OBJECT' and (block = 'exposure' or json_type(x, '$.' || block) = 'OBJECT')
  union all
  select record_id, exposure_no, block, field, list_append(steps, i), json_extract(v, '$[' || i || ']')
  from (select *, unnest(range(cast(json_array_length(v) as bigint))) as i from raw where json_type(v) = 'ARRAY')
), nums as (
  select record_id, exposure_no, block, field, cast(row_number() over (partition by record_id, exposure_no, block, field order by steps) - 1 as int) as value_no
  from raw where json_type(v) in ('BIGINT', 'UBIGINT', 'DOUBLE')
    or json_type(v) = 'VARCHAR' and regexp_full_match(trim(v ->> '$', E' \\t\\n\\r\\f\\x0b'), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?')
)
select record_id, exposure_no, block, field, value_no from nums
union all
select record_id, exposure_no, block, field, cast(unnest(range(len(list_filter(vals, lambda v: v is not null)))) as int) as value_no from typed
"""
)
# The struct fields of an exposure in the order of its type.
_PARTS = ("target", "device", "fundamental_frequency_khz", "free_field", "in_situ", "unspecified_domain", "timing")
_ONE = [(i, b, "", 0) for i, b in enumerate(_PARTS) if b in nested.BLOCKS["exposure"]] + [(i, m, b, k) for i, b in enumerate(_PARTS) for k, m in enumerate(nested.BLOCKS.get(b, ()))]


def _measure_path(i: int, block: str, k: int) -> str:
    return f"[exposure_no, {i}, {k}]" if block else f"[exposure_no, {i}]"


_TREE = _P1_FOUND.rsplit("select record_id, exposure_no, block, field, value_no from nums", 1)[0].rstrip() + """, numbered as (
  select record_id, exposure_no, block, field, try_cast(trim(v ->> '$') as double) as num, cast(row_number() over (partition by record_id, exposure_no, block, field order by steps) - 1 as int) as value_no
  from raw where json_type(v) in ('BIGINT', 'UBIGINT', 'DOUBLE')
    or json_type(v) = 'VARCHAR' and regexp_full_match(trim(v ->> '$', E' \\t\\n\\r\\f\\x0b'), '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?')
), nodes as (
  select record_id, cast([] as bigint[]) as path, null as block, null as field, null as value_no, null as num from papers union all select record_id, [], null, null, null, null from raw_papers
  union all select record_id, [exposure_no], null, null, null, null from x union all select record_id, [exposure_no], null, null, null, null from y
""" + "".join(
    f"  union all select record_id, [exposure_no, {i}], null, null, null, null from x where x.{b} is not null union all select record_id, [exposure_no, {i}], null, null, null, null from y where json_type(x, '$.{b}') = 'OBJECT'\n"
    for i, b in enumerate(_PARTS) if b not in nested.BLOCKS["exposure"]
) + "".join(
    f"  union all select record_id, {_measure_path(i, b, k)}, null, null, null, null from x where x.{b + '.' if b else ''}{m} is not null union all select record_id, {_measure_path(i, b, k)}, null, null, null, null from y where json_type(x, '$.{b + '.' if b else ''}{m}') <> 'NULL'\n"
    f"  union all select record_id, list_append({_measure_path(i, b, k)}, n - 1), '{b or 'exposure'}', '{m}', n - 1, vs[n] from (select record_id, exposure_no, vs, unnest(range(1, len(vs) + 1)) as n from (select record_id, exposure_no, list_filter(x.{b + '.' if b else ''}{m}.vals, lambda v: v is not null) as vs from x))\n"
    f"  union all select record_id, list_append({_measure_path(i, b, k)}, value_no), block, field, value_no, num from numbered where block = '{b or 'exposure'}' and field = '{m}'\n"
    for i, m, b, k in _ONE
) + """  union all select record_id, [exposure_no, 0, n - 1], null, null, null, null from (select record_id, exposure_no, unnest(range(1, len(x.target.terms) + 1)) as n from x)
  union all select record_id, [exposure_no, 0, i], null, null, null, null from (select *, unnest(range(cast(json_array_length(x, '$.target.terms') as bigint))) as i from y where json_type(x, '$.target.terms') = 'ARRAY') where json_type(x, '$.target.terms[' || i || ']') = 'VARCHAR'
  union all select record_id, [exposure_no, 0, 0], null, null, null, null from y where json_type(x, '$.target.terms') = 'VARCHAR'
), sizes as (
  select record_id, up, count(*) as size from (select record_id, path[1:k] as up from (select record_id, path, unnest(range(0, len(path) + 1)) as k from nodes)) group by all
), walk as (
  select nodes.*, row_number() over (partition by record_id order by path) - 1 as pre, len(path) as depth from nodes
), tree as (
  select walk.*, pre - depth + size - 1 as post from walk join sizes on sizes.record_id = walk.record_id and sizes.up = walk.path
)
"""
_PROFILE_CELLS = "\n  union all ".join(f"select load_id, '{f}' as field, x.{f} as m from e" for f in profile.FIELDS)
_PROFILE = f"""
with e as (
  select load_id, x from (select load_id, unnest(exposures) as x from papers) where x is not null and load_id is not null
), c as (
  {_PROFILE_CELLS}
), cells as (
  select load_id, field, m is not null as present, m.state as state, list_filter(coalesce(m.vals, []), lambda v: v is not null) as vals from c
), rates as (
  select load_id, field, count(*) as n_cells, count(*) filter (len(vals) = 0) as n_missing, count(*) filter (present) as n_measures,
    count(*) filter (present and state not in ('value', 'not_reported', 'na')) as n_odd
  from cells group by all
), v as (
  select load_id, field, unnest(vals) as value from cells
), top as (
  select load_id, field, max(n) as n_most, count(*) as n_distinct from (select load_id, field, value, count(*) as n from v group by all) group by all
), vals as (
  select load_id, field, count(*) as n_values, min(value) as min_value, max(value) as max_value,
    quantile_cont(value, 0.25) as q25, quantile_cont(value, 0.5) as median, quantile_cont(value, 0.75) as q75,
    median(value) filter (isfinite(value) and value > 0) as mid, count(*) filter (not isfinite(value) or value <= 0) as n_invalid
  from v group by all
), g as (
  select *, case when n_values >= 10 then mid end as mid10 from rates left join vals using (load_id, field) left join top using (load_id, field)
)
"""
_WALK = """
with recursive e as (
  select id, min(case when regexp_matches(parent, '\\S') then parent end) as parent from targets where id is not null group by id
), up as (
  select id, id as cur, parent as next, 0 as n from e
  union all
  select up.id, e.id, e.parent, n + 1 from up join e on e.id = up.next where n <= (select count(*) from e where parent is not null) and n < 400
), open as (
  select id, cur as root_id, n as depth, case when next is null then 'ok' else 'broken' end as state from up where next is null or next not in (select id from e)
), lost as (
  select * from up where id not in (select id from open)
), ring as (
  select id, min(cur) as root_id from lost where id in (select id from lost where n > 0 and cur = id) group by id
), found as (
  select * from open
  union all select id, root_id, 0, 'cycle' from ring
  union all
  select id, root_id, n, 'under_cycle' from (
    select lost.id, ring.root_id, lost.n, row_number() over (partition by lost.id order by lost.n) as k from lost join ring on ring.id = lost.cur where lost.id not in (select id from ring)
  ) where k = 1
)
"""
ORACLES = {
    "p1_found": _P1_FOUND,
    "p1_values": _TREE + """select v.record_id, cast(v.path[1] as int) as exposure_no, v.block, v.field, cast(v.value_no as int) as value_no, v.num as value, v.pre, v.post, m.pre as parent_pre
    from tree v join tree m on m.record_id = v.record_id and m.path = v.path[1:len(v.path) - 1] where v.field is not null""",
    "p1_records": _TREE + "select record_id, 0 as pre, max(pre) as post, count(*) as n_nodes from tree group by record_id",
    "p1_exposures": _EXPOSURES + """select record_id, exposure_no, x.label as label from x
    union all select record_id, exposure_no, case when json_type(x, '$.label') = 'VARCHAR' then x ->> '$.label' end from y""",
    "p1_terms": _EXPOSURES + """select record_id, exposure_no, cast(i as int) as term_no, x.target.terms[i + 1] as term from (select *, unnest(range(len(x.target.terms))) as i from x)
    union all select record_id, exposure_no, cast(i as int), x ->> ('$.target.terms[' || i || ']') from (select *, unnest(range(cast(json_array_length(x, '$.target.terms') as bigint))) as i from y where json_type(x, '$.target.terms') = 'ARRAY')
    where json_type(x, '$.target.terms[' || i || ']') = 'VARCHAR'
    union all select record_id, exposure_no, 0, x ->> '$.target.terms' from y where json_type(x, '$.target.terms') = 'VARCHAR'""",
    "p3_profile": _PROFILE + """, o as (
      select load_id, lag(load_id) over (order by load_id) as prev from (select distinct load_id from cells)
    ), ev as (
      select field, o.load_id, value, 1 as cur, 0 as ref from v join o using (load_id)
      union all select field, o.load_id, value, 0, 1 from v join o on o.prev = v.load_id
    ), cum as (
      select field, load_id, sum(cur) over w as c, sum(ref) over w as r, sum(cur) over (partition by field, load_id) as ct, sum(ref) over (partition by field, load_id) as rt
      from ev window w as (partition by field, load_id order by value range between unbounded preceding and current row)
    ), ks as (
      select field, load_id, max(abs(c / ct - r / rt)) as ks from cum where ct > 0 and rt > 0 group by all
    )
    select load_id, field, n_cells, round(n_missing / n_cells, 9) as missing_share, round(n_odd / nullif(n_measures, 0), 9) as odd_state_share, coalesce(n_values, 0) as n_values,
      coalesce(n_distinct, 0) as n_distinct, min_value, max_value, round(q25, 9) as q25, round(median, 9) as median, round(q75, 9) as q75, round(n_invalid / nullif(n_values, 0), 9) as invalid_share, round(ks, 9) as ks
    from g left join ks using (load_id, field)""",
    "p5_descendants": _WALK + "select cur as ancestor, up.id as descendant, n as distance from up join found on found.id = up.id where n between 1 and depth",
    "p5_paths": _WALK + """, pairs as (select cur as ancestor, up.id as id, n from up join found on found.id = up.id where n between 0 and depth)
    select id, root_id, depth, state, (select string_agg(ancestor, ' > ' order by n desc) from pairs where pairs.id = found.id) as path, (select count(*) from pairs where pairs.ancestor = found.id and n > 0) as n_descendants from found""",
    "q_top_level": _WALK + "select up.id, cur as top from up join found on found.id = up.id where state = 'ok' and n = greatest(depth - 1, 0)",
    "q_tree_listing": _WALK + """, p as (select up.id, list(cur order by n desc) as path, any_value(depth) as depth from up join found on found.id = up.id where state = 'ok' and n <= depth group by up.id),
    s as (select id, min(synonyms) as s from targets where id is not null group by id)
    select row_number() over (order by path) as pos, repeat('  ', depth) || p.id || case when len(s.s) > 0 then '  (' || array_to_string(s.s[1:6], ', ') || ')' else '' end as line from p left join s using (id)""",
    "p3_found": _PROFILE
    + """select cast(load_id as int) as load_id, field, issue from (
      select load_id, field, unnest([
        case when n_missing / n_cells - median(n_missing / n_cells) over (partition by field) >= 0.3 then 'missing' end,
        case when n_odd / nullif(n_measures, 0) >= 0.1 then 'state' end,
        case when n_values >= 10 and n_most / n_values >= 0.3 then 'repeat' end,
        case when n_values >= 10 and n_invalid / n_values >= 0.1 then 'invalid' end,
        case when mid10 >= 5 * median(mid10) over (partition by field) or mid10 * 5 <= median(mid10) over (partition by field) then 'scale' end
      ]) as issue from g) where issue is not null""",
    "p5_found": _WALK
    + """select id as term_id, root_id, depth, state from found
    union all
    select distinct t, '', -1, 'unlisted' from (select unnest(x.target.terms) as t from (select unnest(exposures) as x from papers)) where t is not null and t not in (select id from e)""",
}
