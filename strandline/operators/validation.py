"""Rules over records with their repairs: identity, blocks, quotations, verdict files, batches.

A repair gives the changes as rows, apart from what applies them, so it can be looked at first
and checked again after. States of a leaf are "value", "not_reported" and "na" (does not apply).
Null exposures have no leaves; records without exposures give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.functions import measures as ms, text as tx
from strandline.operators import facts
from strandline.operators.nested import BLOCKS

# The leaves of the block that applies as a whole or not at all.
IN_SITU_TEXTS = ("method", "reported_as")
IN_SITU_NUMBERS = BLOCKS["in_situ"]
# Fixed value: keys that name no author.
ANONYMOUS = r"^([0-9]{4}|nd)anon[a-z]?$"


def identity_problems(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """(record_id, problem): records whose key is not held, whose doi differs from the held one (case
    apart), or whose entry names no author; the first that applies."""
    held = manifest.where("citekey is not null").groupBy("citekey").agg(F.min(F.struct("entry_id", F.lower(F.coalesce("doi", F.lit(""))).alias("doi"), F.coalesce(F.size("authors"), F.lit(0)).alias("n"))).alias("_m"))
    got = records.select("record_id", "citekey", F.lower(F.coalesce("doi", F.lit(""))).alias("_d")).join(held, "citekey", "left")
    problem = F.when(F.col("_m").isNull(), "not_held").when(F.col("_m.doi") != F.col("_d"), "doi_differs").when((F.col("_m.n") == 0) | F.col("citekey").rlike(ANONYMOUS), "no_authors")
    return got.select("record_id", problem.alias("problem")).where("problem is not null")


def leaf_state(m: Column) -> Column:
    """State of a measure by what it holds: numbers make it a value, whatever its label says."""
    return F.when(F.size(ms.numbers(m)) > 0, "value").when(ms.state(m) == "not_reported", "not_reported").otherwise("na")


def text_state(c: Column) -> Column:
    return F.when(c.isNull(), "na").when(c == "not_reported", "not_reported").otherwise("value")


def repaired_in_situ(states: Sequence[Column]) -> list[Column]:
    """States of (method, reported_as, three measures) after the repair of a block that is partly
    null: with a number its nulls are silences, without one nothing of it applies."""
    texts, nums = list(states[:2]), list(states[2:])
    silent = (nums[0] == "na") & (nums[1] == "na") & (nums[2] == "na")
    texts = [F.when(silent, "na").otherwise(s) for s in texts]
    every = [*texts, *nums]
    nulls = sum((F.when(s == "na", 1).otherwise(0) for s in every), F.lit(0))
    number = (nums[0] == "value") | (nums[1] == "value") | (nums[2] == "value")
    partly = (nulls > 0) & (nulls < len(every))
    return [F.when(partly & number & (s == "na"), "not_reported").when(partly & ~number, "na").otherwise(s) for s in every]


def block_repairs(papers: DataFrame) -> DataFrame:
    """(record_id, exposure_no, leaf, old, new): leaves that the rules of the blocks change. The
    unspecified domain holds only what was given without a domain, so it is never silent."""
    x = F.col("x")
    names = [f"in_situ.{n}" for n in (*IN_SITU_TEXTS, *IN_SITU_NUMBERS)]
    old = [text_state(facts.at(x, f"in_situ.{n}")) for n in IN_SITU_TEXTS] + [leaf_state(facts.at(x, f"in_situ.{n}")) for n in IN_SITU_NUMBERS]
    cells = [F.struct(F.lit(n).alias("leaf"), a.alias("old"), b.alias("new")) for n, a, b in zip(names, old, repaired_in_situ(old))]
    for n in BLOCKS["unspecified_domain"]:
        s = leaf_state(facts.at(x, f"unspecified_domain.{n}"))
        cells.append(F.struct(F.lit(f"unspecified_domain.{n}").alias("leaf"), s.alias("old"), F.when(s == "not_reported", "na").otherwise(s).alias("new")))
    return facts.exposures(papers, "record_id").select("record_id", "exposure_no", F.inline(F.filter(F.array(*cells), lambda c: c.old != c.new)))


def unquoted(papers: DataFrame, texts: DataFrame) -> DataFrame:
    """(record_id, exposure_no, leaf, reason): numbers to be taken out, for want of a quotation or
    because the text of the key does not hold it. A leaf without a quotation inherits that of the
    first other exposure with the same values; without a text a quotation is believed."""
    quotes = papers.select("record_id", F.explode("provenance.source_quotes").alias("path", "quote")).where("quote <> ''").groupBy("record_id", "path").agg(F.min("quote").alias("quote"))
    cells = facts.unpivot(papers, "record_id", "citekey").withColumn("v", ms.numbers(F.col("m"))).where("size(v) > 0").join(quotes, ["record_id", "path"], "left")
    same = Window.partitionBy("record_id", "leaf", "v")  # the exposures of one record
    first = F.min(F.when(F.col("quote").isNotNull(), F.struct("exposure_no", "quote"))).over(same)
    cells = cells.withColumn("q", F.coalesce("quote", first["quote"]))
    keys = texts.where("citekey is not null and text is not null").groupBy("citekey").agg(F.min("text").alias("_t")).select("citekey", tx.letters_only(F.col("_t")).alias("_k"))
    found = cells.join(keys, "citekey", "left").withColumn("ok", tx.quote_found(F.col("q"), F.col("_k")))
    reason = F.when(F.col("q").isNull(), "no source quote").when(~F.col("ok"), "quote not found in text")
    return found.select("record_id", "exposure_no", "leaf", reason.alias("reason")).where("reason is not null")


def flags_of(changes: DataFrame) -> DataFrame:
    """(record_id, flags): the flags that ``unquoted`` adds to a record, in order of field."""
    flag = F.struct(F.concat(F.lit("exposures["), F.col("exposure_no"), F.lit("]."), F.col("leaf")).alias("field"), F.concat(F.lit("value removed at validation: "), F.col("reason")).alias("reason"))
    return changes.groupBy("record_id").agg(F.array_sort(F.collect_list(flag)).alias("flags"))  # one record's leaves


def settled(papers: DataFrame) -> DataFrame:
    """(record_id, exposure_no, method, reported_as, waveform): exposures that a ruling's consequences
    change. A block without numbers has no method; one with all has no null texts; a continuous
    wave with a repetition, a pulse or a duty cycle other than 100 is pulsed."""
    x = F.col("x")
    s = [leaf_state(facts.at(x, f"in_situ.{n}")) for n in IN_SITU_NUMBERS]
    none, whole = (s[0] == "na") & (s[1] == "na") & (s[2] == "na"), (s[0] != "na") & (s[1] != "na") & (s[2] != "na")
    texts = [F.when(~none, F.when(whole, F.coalesce(x["in_situ"][n], F.lit("not_reported"))).otherwise(x["in_situ"][n])) for n in IN_SITU_TEXTS]
    num = lambda n: ms.numbers(facts.at(x, f"timing.{n}"))
    gated = (F.size(num("pulse_repetition_frequency_hz")) > 0) | (F.size(num("pulse_duration_ms")) > 0) | F.exists(num("duty_cycle_pct"), lambda v: v != 100)
    wave = F.when((x["timing"]["waveform"] == "continuous") & gated, "pulsed").otherwise(x["timing"]["waveform"])
    got = facts.exposures(papers, "record_id").select("record_id", "exposure_no", texts[0].alias("method"), texts[1].alias("reported_as"), wave.alias("waveform"), x["in_situ"]["method"].alias("_m"), x["in_situ"]["reported_as"].alias("_r"), x["timing"]["waveform"].alias("_w"))
    same = F.col("method").eqNullSafe(F.col("_m")) & F.col("reported_as").eqNullSafe(F.col("_r")) & F.col("waveform").eqNullSafe(F.col("_w"))
    return got.where(~same).drop("_m", "_r", "_w")


def skeleton(papers: DataFrame) -> DataFrame:
    """Records with every number of an exposure blanked and the structure kept: a measure with
    values becomes state "blank" without them, other states stay."""
    kind = papers.schema["exposures"].dataType.elementType

    def blank(m: Column) -> Column:
        full = F.coalesce(F.size(m.vals), F.lit(0)) > 0
        return F.when(full, F.struct(F.lit("blank").alias("state"), F.array().cast("array<double>").alias("vals"), F.lit(False).alias("is_list"))).otherwise(m)

    def clean(x: Column) -> Column:
        got = x  # fields are read from x, else every step would repeat those before it
        for b, names in BLOCKS.items():
            if b == "exposure":
                for n in names:
                    got = got.withField(n, blank(x[n]))
            else:
                inner = x[b]
                for n in names:
                    inner = inner.withField(n, blank(x[b][n]))
                got = got.withField(b, F.when(x[b].isNotNull(), inner))
        return F.when(x.isNotNull(), got).cast(kind)

    return papers.withColumn("exposures", F.transform("exposures", clean))


def verdict_problems(rows: DataFrame, legal: Sequence[str], coded: str, codes: str = "^E[1-9]$") -> DataFrame:
    """(ledger_id, problem): rows of verdict files that cannot be recorded: no key, no verdict, a
    verdict that is not legal, a ``coded`` verdict without a code or a code without it, no reason."""
    v = F.lower(F.trim("verdict"))
    code = F.coalesce(F.col("criterion").rlike(codes), F.lit(False))
    tests = [
        ("no_key", F.coalesce(F.length(F.trim("doi")), F.lit(0)) == 0),
        ("no_verdict", F.coalesce(F.length(v), F.lit(0)) == 0),
        ("unknown_verdict", (F.length(v) > 0) & ~v.isin(*legal)),
        ("no_code", (v == coded) & ~code),
        ("code_without_exclusion", v.isin(*[x for x in legal if x != coded]) & F.col("criterion").isNotNull()),
        ("no_reason", F.coalesce(F.length(F.trim("reason")), F.lit(0)) == 0),
    ]
    found = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in tests]))
    return rows.select("ledger_id", F.explode(found).alias("problem"))


def batch_status(wanted: DataFrame, records: DataFrame, manifest: DataFrame, broken: DataFrame) -> DataFrame:
    """(citekey, status): a batch of wanted keys against the records that came: missing, extra,
    identity, problems (a record in ``broken(record_id)``) or ok; the worst record of a key counts."""
    bad = broken.select("record_id", F.lit(True).alias("_b")).distinct()
    odd = identity_problems(records, manifest).select("record_id", F.lit(True).alias("_i"))
    got = records.where("citekey is not null").join(bad, "record_id", "left").join(odd, "record_id", "left")
    per = got.groupBy("citekey").agg(F.max(F.when(F.col("_i"), 2).when(F.col("_b"), 1).otherwise(0)).alias("_s"))
    both = wanted.where("citekey is not null").select("citekey", F.lit(True).alias("_w")).distinct().join(per, "citekey", "full_outer")
    status = F.when(F.col("_s").isNull(), "missing").when(F.col("_w").isNull(), "extra").when(F.col("_s") == 2, "identity").when(F.col("_s") == 1, "problems").otherwise("ok")
    return both.select("citekey", status.alias("status"))
