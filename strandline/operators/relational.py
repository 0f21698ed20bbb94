"""Keyed merges, ledgers, set comparisons, ranking and batching of flat tables.

Every operator takes its order explicitly, since rows of a DataFrame have none: where the
first or last of equal rows wins, the caller names the ordering columns. Null keys form no
group unless a docstring says otherwise; empty input gives empty output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _struct(cols: Sequence[str | Column]) -> Column:
    return F.struct(*cols)


def last_wins(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``: a max-aggregate of structs, combined map-side, so a
    key with very many rows is no hot key. Ties beyond ``order`` go to the larger rest."""
    rest = [c for c in df.columns if c not in (key, *order)]
    got = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_w"))
    return got.select(key, "_w.*").select(*df.columns)


def first_wins(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row per key by ``order``."""
    rest = [c for c in df.columns if c not in (key, *order)]
    got = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("_w"))
    return got.select(key, "_w.*").select(*df.columns)


def merge_sources(df: DataFrame, key: str, order: Sequence[str], source: str, fill: str) -> DataFrame:
    """Keyed merge of several harvests: the first copy's fields, ``fill`` from the first copy
    that has it non-empty, and ``found_by``, the distinct sources in order of first find.

    Sources are pre-aggregated per (key, source), so the list of a key is as long as there are
    sources, not rows.
    """
    rows = df.where(F.col(key).isNotNull())
    rest = [c for c in df.columns if c not in (key, source, fill, *order)]
    per = rows.groupBy(key, source).agg(
        F.min(F.struct(*order, *rest)).alias("_f"),
        F.min(F.when(F.length(F.trim(F.col(fill).cast("string"))) > 0, F.struct(*order, F.col(fill).alias("_v")))).alias("_b"),
    )
    got = per.groupBy(key).agg(F.min("_f").alias("_f"), F.min("_b").alias("_b"), F.array_sort(F.collect_list(F.struct(F.struct(*[F.col(f"_f.{o}") for o in order]).alias("o"), F.col(source).alias("s")))).alias("_s"))
    return got.select(key, "_f.*", F.col("_b._v").alias(fill), F.transform("_s", lambda x: x.s).alias("found_by"))


def state_changes(df: DataFrame, key: str, order: Sequence[str], state: Sequence[str], partitions: int | None = None) -> DataFrame:
    """(key, seq, *order, *state, last): the rows whose state differs from that of the row before, in
    order of the key; ``last`` marks the current state. Null keys are left out.

    Rows are range-partitioned by (key, order), so a key of any size is split. Neighbours are
    compared inside a partition; the first row of a key in a partition is compared with the last
    of the partition before, which comes from one row per key and partition.
    """
    from strandline.session import cut, shuffle_partitions

    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.struct(*order).alias("_o"), F.struct(*state).alias("_s"))
    n = partitions or shuffle_partitions(df.sparkSession)
    rows = cut(rows.repartitionByRange(n, "_k", "_o").withColumn("_p", F.spark_partition_id()))
    here = Window.partitionBy("_p", "_k").orderBy("_o", "_s")
    ends = rows.groupBy("_p", "_k").agg(F.max(F.struct("_o", "_s")).alias("_z"))
    over = Window.partitionBy("_k").orderBy("_p")  # at most one row per partition
    carried = ends.select("_p", "_k", F.lag("_z").over(over)["_s"].alias("_c"))
    seen = rows.withColumns({"_b": F.lag("_s").over(here), "_r": F.row_number().over(here)}).join(carried, ["_p", "_k"])
    before = F.when(F.col("_r") == 1, F.col("_c")).otherwise(F.col("_b"))
    steps = cut(seen.where(before.isNull() | ~before.eqNullSafe(F.col("_s"))).select("_p", "_k", "_o", "_s"))
    sums = steps.groupBy("_p", "_k").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sums.select("_p", "_k", (F.sum("_n").over(over) - F.col("_n")).alias("_a"), F.sum("_n").over(Window.partitionBy("_k")).alias("_all"))
    got = steps.withColumn("_r", F.row_number().over(here)).join(offsets, ["_p", "_k"]).withColumn("seq", (F.col("_r") + F.col("_a")).cast("int"))
    return got.select(F.col("_k").alias(key), "seq", "_o.*", "_s.*", (F.col("seq") == F.col("_all")).alias("last"))


def superseded(df: DataFrame, key: str, order: Sequence[str], state: Sequence[str]) -> DataFrame:
    """Rows that a different later state of the same key replaced: (key, seq, *state).

    A repeat of the state just before is neither history nor a replacement.
    """
    return state_changes(df, key, order, state).where("not last").select(key, "seq", *state)


def current_with_history(df: DataFrame, key: str, order: Sequence[str], state: Sequence[str]) -> DataFrame:
    """Current state per key and number of replacements; the replaced states are ``superseded``, rows
    of their own, as one key may have any number."""
    return state_changes(df, key, order, state).where("last").select(key, *state, (F.col("seq") - 1).alias("n_replaced"))


def record_verdicts(rows: DataFrame, key: str, order: Sequence[str], state: Sequence[str], verdict: str, parked: dict[str, str], criterion: str = "criterion", parked_class: str = "parked_class") -> DataFrame:
    """(key, *state, parked_class, n_replaced): the ledger after ``rows`` in order.

    Rows without a key or a verdict are ignored. The later row replaces the earlier one; if run,
    verdict or criterion (``state``) differ, that counts as a replacement. A row without a parked
    class gets that of its criterion in ``parked``, if any.
    """
    held = rows.where(F.col(key).isNotNull() & (F.length(verdict) > 0))
    default = F.lit(None).cast("string")
    for c, name in parked.items():
        default = F.when(F.col(criterion) == c, F.lit(name)).otherwise(default)
    now = last_wins(held.select(key, *order, F.coalesce(F.col(parked_class), default).alias(parked_class)), key, order).select(key, parked_class)
    return current_with_history(held, key, order, state).join(now, key)


def upsert_counts(ledger: DataFrame) -> DataFrame:
    """(added, replaced) of a ledger made by ``record_verdicts`` from nothing."""
    return ledger.agg(F.count(F.lit(1)).alias("added"), F.coalesce(F.sum("n_replaced"), F.lit(0)).alias("replaced"))


def accumulate(new: DataFrame, prior: DataFrame, key: str) -> DataFrame:
    """New rows and those prior rows whose key is not among the new."""
    return new.unionByName(prior.join(new.select(key).distinct(), key, "left_anti"))


def upsert(current: DataFrame, prior: DataFrame, key: str) -> DataFrame:
    """Append-only upsert: full outer join, the current row wins as a whole."""
    names = [c for c in current.columns if c != key]
    a = current.select(key, F.struct(*names).alias("_a"))
    b = prior.select(key, F.struct(*names).alias("_b"))
    return a.join(b, key, "full_outer").select(key, F.coalesce("_a", "_b").alias("_r")).select(key, "_r.*")


def first_lookup(df: DataFrame, key: str, lookups: Sequence[DataFrame], fields: Sequence[str]) -> DataFrame:
    """The fields of the first lookup that has the key; whole rows, never mixed columns. Each
    lookup is reduced to one row per key; ``found_in`` is its number, null for none."""
    got, names = df, []
    for i, lk in enumerate(lookups):
        names.append(f"_l{i}")
        one = lk.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*fields, F.lit(i).alias("found_in"))).alias(names[-1]))
        got = got.join(one, key, "left")
    return got.withColumn("_l", F.coalesce(*names)).select(*df.columns, *[F.col(f"_l.{f}").alias(f) for f in (*fields, "found_in")])


def split_acknowledged(flags: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Flags with ``acknowledged``: is the key in the list of known ones?"""
    return flags.join(known.select(*keys).distinct().withColumn("_k", F.lit(True)), list(keys), "left").withColumn("acknowledged", F.coalesce("_k", F.lit(False))).drop("_k")


def reconcile(want: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """(key, status): missing, extra, duplicate or ok, by the counts on both sides."""
    w = want.groupBy(key).agg(F.count(F.lit(1)).alias("w"))
    g = got.groupBy(key).agg(F.count(F.lit(1)).alias("g"))
    both = w.join(g, key, "full_outer")
    return both.select(key, F.when(F.col("g").isNull(), "missing").when(F.col("w").isNull(), "extra").when(F.col("g") > F.col("w"), "duplicate").otherwise("ok").alias("status"))


def first_seen(df: DataFrame, key: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Rows that repeat an earlier row's key, with the earlier row's ``name`` as first_seen.

    The earliest per key is a min-aggregate, joined back; no window over the key.
    """
    ok = F.lit(True)
    for k in key:
        ok = ok & F.col(k).isNotNull()
    rows = df.where(ok)
    first = rows.groupBy(*key).agg(F.min(F.struct(*order, F.col(name).alias("_f"))).alias("_m"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    hit = rows.join(first, list(key))
    return hit.where(F.struct(*order) != F.struct(*[F.col(f"_m.{o}").alias(o) for o in order])).withColumn("first_seen", F.col("_m._f")).drop("_m", "_n")


def shared_prefix(df: DataFrame, text: str, n: int = 200) -> DataFrame:
    """Rows whose first ``n`` characters occur in another row, with the number of rows."""
    p = F.xxhash64(F.substring(text, 1, n)), F.substring(text, 1, n)
    rows = df.where(F.length(text) > 0).withColumn("_p", p[1])
    many = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("n_sharing")).where("n_sharing > 1")
    return rows.join(many, "_p").drop("_p")


def top_with_ties(df: DataFrame, k: int, count: str) -> DataFrame:
    """The k largest counts, and all that tie with the last of them.

    The k-th count is found by a distributed top-k; no single-partition window.
    """
    kth = df.orderBy(F.desc(count)).limit(k).agg(F.min(count).alias("_k"))
    return df.join(F.broadcast(kth), F.col(count) >= F.col("_k")).drop("_k")  # one row


def common_spelling(df: DataFrame, key: Column, spelling: str, order: str) -> DataFrame:
    """(key, spelling, n): per folded key the most frequent spelling, ties first seen."""
    per = df.where(key.isNotNull()).groupBy(key.alias("key"), spelling).agg(F.count(F.lit(1)).alias("c"), F.min(order).alias("o"))
    got = per.groupBy("key").agg(F.max(F.struct("c", (-F.col("o")).alias("o"), F.col(spelling).alias("s"))).alias("m"), F.sum("c").alias("n"))
    return got.select("key", F.col("m.s").alias(spelling), "n")


def seats(df: DataFrame, group: str, want: int) -> DataFrame:
    """(group, n, seats): largest-remainder apportionment of ``want`` seats to groups by size.

    Works on one row per group; equal remainders go to the larger group key.
    """
    g = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(1))  # one row per group
    g = g.withColumn("q", F.lit(want) * F.col("n") / F.sum("n").over(every)).withColumn("base", F.floor("q"))
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc(F.round(F.col("q") - F.col("base"), 9)), F.desc(group))
    extra = F.row_number().over(order) <= F.lit(want) - F.sum("base").over(every)
    return g.withColumn("seats", F.least(F.col("n"), F.col("base") + F.when(extra, 1).otherwise(0))).select(group, "n", "seats")


def stratified(df: DataFrame, group: str, order: Sequence[Column], want: int) -> DataFrame:
    """The best rows of every group, as many as it has seats; ``rank`` within the group."""
    best = df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    quota = seats(df, group, want)
    return best.join(quota.select(group, "seats"), group).where("rank <= seats").drop("seats")


def numbered(df: DataFrame, order: Sequence[str | Column], name: str = "pos", partitions: int | None = None) -> DataFrame:
    """Global positions from 1 in the given order, without a single-task sort: rows are range
    partitioned, numbered inside the partition and shifted by the rows before it."""
    from strandline.session import cut, shuffle_partitions

    n = partitions or shuffle_partitions(df.sparkSession)
    parts = cut(df.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id()))
    sizes = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offset = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))  # n rows
    return parts.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order))).join(offset, "_p").withColumn(name, F.col("_r") + F.col("_o")).drop("_p", "_r", "_o")


def cascade(rules: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """Ordered rules, first match wins: (test, outcome) pairs; null tests do not match."""
    got = F.when(F.coalesce(rules[0][0], F.lit(False)), rules[0][1])
    for test, outcome in rules[1:]:
        got = got.when(F.coalesce(test, F.lit(False)), outcome)
    return got.otherwise(otherwise)


def signals(df: DataFrame, rules: Sequence[tuple[str, Column]], keep: Sequence[str]) -> DataFrame:
    """One row per matching rule (multi-label), with its name as ``signal``."""
    hits = F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in rules]))
    return df.select(*keep, F.explode(hits).alias("signal"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, identity: str, compare: Sequence[str], absorbed: DataFrame | None = None) -> DataFrame:
    """(key, change, now) between two versions.

    A key that is gone is "renamed" if its identity lives on under another key, "merged" if
    ``absorbed(identity, key)`` names a held key that took it in, else "removed"; ``now`` is that other
    key. A key that is new is "added", unless something was renamed to or merged into it: that is
    told once, with the key that is gone. Of the others those are "corrected" of which a compared
    column differs (nulls are equal), the rest "same".
    """
    s = lambda d: d.select(key, F.col(identity).alias("_i"), F.struct(*compare).alias("_v"))
    a, b = s(old), s(new)
    both = a.select(key, F.col("_i").alias("_ia"), F.col("_v").alias("_va"), F.lit(True).alias("_a")).join(b.select(key, F.col("_v").alias("_vb"), F.lit(True).alias("_b")), key, "full_outer")
    lives = b.where("_i is not null").groupBy(F.col("_i").alias("_ia")).agg(F.min(key).alias("_k1"))
    gone = both.where("_b is null").join(lives, "_ia", "left")
    if absorbed is None:
        gone = gone.withColumn("_k2", F.lit(None).cast(old.schema[key].dataType))
    else:
        held = absorbed.where("identity is not null").join(new.select(key).distinct(), key).groupBy(F.col("identity").alias("_ia")).agg(F.min(key).alias("_k2"))
        gone = gone.join(held, "_ia", "left")
    gone = gone.select(key, F.when(F.col("_k1").isNotNull(), "renamed").when(F.col("_k2").isNotNull(), "merged").otherwise("removed").alias("change"), F.coalesce("_k1", "_k2").alias("now"))
    took = gone.where("now is not null").select(F.col("now").alias(key)).distinct()
    added = both.where("_a is null").join(took, key, "left_anti").select(key, F.lit("added").alias("change"), F.col(key).alias("now"))
    kept = both.where("_a and _b").select(key, F.when(F.col("_va").eqNullSafe(F.col("_vb")), "same").otherwise("corrected").alias("change"), F.col(key).alias("now"))
    return gone.unionByName(added).unionByName(kept)


def misses(wanted: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """The wanted keys that were not found, once each."""
    return wanted.where(F.col(key).isNotNull()).select(key).distinct().join(got.select(key), key, "left_anti")


def ranked_within(df: DataFrame, group: str, order: Sequence[str], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """Position from 1 of every row within its group. Rows are numbered over range partitions, so a
    group of any size is split; null groups are left out."""
    rows = numbered(df.where(F.col(group).isNotNull()), [F.col(group), *[F.col(o) for o in order]], "_pos", partitions)
    first = rows.groupBy(group).agg(F.min("_pos").alias("_first"))
    return rows.join(first, group).withColumn(name, F.col("_pos") - F.col("_first") + 1).drop("_pos", "_first")


def allocated_names(files: DataFrame, name: str, content: str, order: str) -> DataFrame:
    """(name, content, target): a name for every different content that claims one: the first has
    the name itself, the next ``_2``, ``_3`` and so on before the ending; equal content is one file."""
    one = files.where(F.col(name).isNotNull() & F.col(content).isNotNull()).groupBy(name, content).agg(F.min(order).alias("_first_seen"))
    got = ranked_within(one, name, ["_first_seen", content], "_n")
    stem, ending = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 2)
    return got.select(name, content, F.when(F.col("_n") == 1, F.col(name)).otherwise(F.concat(stem, F.lit("_"), F.col("_n").cast("string"), ending)).alias("target"))


def retry_memory(events: DataFrame, key: str, order: Sequence[str], failed: Column) -> DataFrame:
    """(key, failing, n_failures): is the last attempt a failure, and how many failures there are since
    the last success. Two map-side aggregates; no window over a key."""
    rows = events.where(F.col(key).isNotNull()).select(key, F.struct(*order).alias("_o"), F.coalesce(failed, F.lit(False)).alias("_f"))
    ok = rows.where(~F.col("_f")).groupBy(key).agg(F.max("_o").alias("_s"))
    got = rows.join(ok, key, "left").groupBy(key).agg(F.count_if(F.col("_f") & (F.col("_s").isNull() | (F.col("_o") > F.col("_s")))).alias("n_failures"))
    return got.select(key, (F.col("n_failures") > 0).alias("failing"), "n_failures")


def first_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[int]:
    """Batch number of every item: largest first, ties in the given order, first batch that has
    room; an item above the capacity has a batch of its own."""
    free: list[int] = []
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        for b, room in enumerate(free):
            if sizes[i] <= room:
                free[b] -= sizes[i]
                out[i] = b
                break
        else:
            out[i] = len(free)
            free.append(capacity - sizes[i])
    return out


# Fixed value: letters of the longest suffix, enough for eight billion keys of one base.
SUFFIX_LETTERS = 7


def suffix_of(i: str) -> Column:
    """The i-th of a to z, aa, ab, ...; null beyond ``SUFFIX_LETTERS`` letters."""
    step = "if(s.i > 0, struct((s.i - 1) div 26 as i, concat(char(97 + (s.i - 1) % 26), s.t) as t), s)"
    got = f"aggregate(sequence(1, {SUFFIX_LETTERS}), struct(cast({i} as bigint) as i, '' as t), (s, k) -> {step})"
    return F.expr(f"case when {got}.i = 0 then {got}.t end")


def suffix_gaps(words: Column) -> Column:
    """Numbers (lo, hi) of the suffixes that begin with one of the words, ascending, none twice."""
    outer = F.filter(words, lambda w: (F.length(w) <= SUFFIX_LETTERS) & ~F.exists(words, lambda v: (v != w) & F.startswith(w, v)))
    number = lambda w: F.aggregate(F.filter(F.split(w, ""), lambda c: c != ""), F.lit(0).cast("bigint"), lambda s, c: s * 26 + F.ascii(c) - 96)
    more = lambda w, c: F.transform(F.sequence(F.lit(0), SUFFIX_LETTERS - F.length(w)), lambda k: F.concat(w, F.repeat(F.lit(c), k)))
    gaps = F.transform(outer, lambda w: F.zip_with(more(w, "a"), more(w, "z"), lambda a, z: F.struct(number(a).alias("lo"), number(z).alias("hi"))))
    return F.array_sort(F.flatten(gaps))


def assign_keys(papers: DataFrame, released: DataFrame, working: DataFrame, doi: str = "doi") -> DataFrame:
    """(doi, base, key, kept): stable surrogate keys, set-based.

    Released keys never move and are never reissued; working keys are kept where they belong
    to the base; a newcomer takes the bare base if it is alone and the base is free, else the
    n-th free suffix of a to z, aa, ab and so on, n being its rank by doi in the group. A key that
    begins with a longer base belongs to that one, so groups do not meet; it is an error if
    longer bases take all suffixes. ``papers(doi, base)``, ``released(doi, key)``,
    ``working(doi, key)``.
    """
    from strandline.session import cut

    p = papers.select(F.col(doi).alias("doi"), "base").distinct()
    bases = p.select(F.col("base").alias("key")).distinct()
    suffixed = lambda k, b: F.expr(f"startswith({k}, {b}) and substring({k}, length({b}) + 1) rlike '^[a-z]+$'")
    rel = p.join(released.select(F.col(doi).alias("doi"), "key"), "doi").where((F.col("key") == F.col("base")) | suffixed("key", "base")).select("doi", "base", "key", F.lit(0).alias("cls"))
    wrk = p.join(working.select(F.col(doi).alias("doi"), "key"), "doi")
    bare = wrk.where("key = base").select("doi", "base", "key", F.lit(1).alias("cls"))
    tail = wrk.where(suffixed("key", "base")).select("doi", "base", "key")
    starts = tail.select("doi", F.col("key").alias("_k"), F.explode(F.expr("transform(sequence(length(base) + 1, length(key)), n -> substring(key, 1, n))")).alias("key"))
    foreign = starts.join(bases, "key", "left_semi").select("doi", F.col("_k").alias("key")).distinct()
    tail = tail.join(foreign, ["doi", "key"], "left_anti").withColumn("cls", F.lit(2))
    reserved = released.select("key").distinct()
    cands = rel.unionByName(bare.join(reserved, "key", "left_anti")).unionByName(tail.join(reserved, "key", "left_anti"))
    won = cands.groupBy("key").agg(F.min(F.struct("cls", "doi", "base")).alias("w")).select("key", "w.*")
    kept = cut(won.groupBy("doi", "base").agg(F.min(F.struct("cls", F.length("key").alias("len"), "key")).alias("w")).select("doi", "base", F.col("w.key").alias("key")))  # used five times
    taken = reserved.unionByName(kept.select("key")).distinct()
    sizes = p.groupBy("base").agg(F.count(F.lit(1)).alias("size"))
    fresh = cut(p.join(kept.select("doi"), "doi", "left_anti").join(sizes, "base"))
    free_base = fresh.where("size = 1").join(taken.select(F.col("key").alias("base")), "base", "left_anti").select("doi", "base", F.col("base").alias("key"))
    rest = fresh.join(free_base.select("doi"), "doi", "left_anti").withColumn("n", F.row_number().over(Window.partitionBy("base").orderBy("doi")))
    # Candidates: as many suffixes as newcomers and taken keys, past those that longer bases take.
    wanted = rest.groupBy("base").agg(F.count(F.lit(1)).alias("n"))
    starts = lambda df: df.select("key", F.explode(F.expr("transform(sequence(1, length(key) - 1), n -> substring(key, 1, n))")).alias("base")).where(suffixed("key", "base"))
    used = starts(taken).groupBy("base").agg(F.count(F.lit(1)).alias("used"))
    longer = starts(bases).select("base", F.substring("key", F.length("base") + 1, F.length("key")).alias("w")).groupBy("base").agg(F.collect_set("w").alias("w"))
    each = wanted.join(used, "base", "left").join(longer, "base", "left").withColumn("past", suffix_gaps(F.coalesce("w", F.array().cast("array<string>"))))
    each = each.withColumn("last", F.col("n") + F.coalesce("used", F.lit(0))).withColumn("from", F.explode(F.expr("sequence(1L, last, 1000L)")))
    each = each.select("base", "past", F.explode(F.expr("sequence(from, least(from + 999, last))")).alias("i"))
    each = each.withColumn("i", F.aggregate("past", F.col("i"), lambda i, g: F.when(g["lo"] <= i, i + g["hi"] - g["lo"] + 1).otherwise(i)))
    letters = each.select("base", "i", F.concat("base", suffix_of("i")).alias("key")).join(taken, "key", "left_anti")
    letters = letters.withColumn("n", F.row_number().over(Window.partitionBy("base").orderBy("i"))).drop("i")
    new = rest.join(letters, ["base", "n"], "left").select("doi", "base", F.coalesce("key", F.raise_error(F.concat(F.lit("no free suffix left for "), "base", F.lit(" "), "doi")).cast("string")).alias("key"))
    return kept.withColumn("kept", F.lit(True)).unionByName(free_base.unionByName(new).withColumn("kept", F.lit(False)))


def near_years(a: DataFrame, b: DataFrame, key: str, year: str, span: int, order: str) -> DataFrame:
    """Band join: per row of ``a`` the first row of ``b`` (by ``order``) with the same key and a
    year within ``span``.

    Each row of ``b`` is pre-aggregated per (key, year) and offered under the years it can
    serve, so the join is an equi-join, and a key with very many rows meets few.
    """
    best = b.where(F.col(key).isNotNull() & F.col(year).isNotNull()).groupBy(key, year).agg(F.min(order).alias("_o"))
    offer = best.select(key, F.explode(F.sequence(F.col(year) - span, F.col(year) + span)).alias(year), "_o").groupBy(key, year).agg(F.min("_o").alias("first_match"))
    return a.join(offer, [key, year], "left")
