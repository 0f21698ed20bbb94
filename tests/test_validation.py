import random

import pytest
from pyspark.sql import functions as F

from strandline.functions import text
from strandline.operators import facts, hierarchy, pairs, relational as rel, validation as val
from tests.test_operators import PAPERS

KIND = PAPERS.replace("in_situ:struct<method:string,", "in_situ:struct<method:string,reported_as:string,").replace("extra string", "citekey string, doi string, provenance struct<source_quotes:map<string,string>>")
V, NR, NA = ("value", [1.0], False), ("not_reported", None, False), ("na", None, False)


def papers(spark, *exposures, quotes=None, key="k", doi="10.1/A"):
    rows = [("x", None, None, e.get("f0"), e.get("ff"), e.get("is"), e.get("un"), e.get("t")) if e is not None else None for e in exposures]
    return spark.createDataFrame([(1, 1, rows, key, doi, (quotes or {},))], KIND)


def test_identity_problems(spark):
    m = spark.createDataFrame([(1, "k", "10.1/a", [("F",)]), (2, "m", None, [("F",)]), (3, "2020anonb", "d", [("F",)]), (4, "e", "d", [])], "entry_id int, citekey string, doi string, authors array<struct<family:string>>")
    r = spark.createDataFrame([(1, "k", "10.1/A"), (2, "k", "10.1/b"), (3, "zz", None), (4, "2020anonb", "D"), (5, "e", "d"), (6, None, None), (7, "m", None)], "record_id int, citekey string, doi string")
    assert {x.record_id: x.problem for x in val.identity_problems(r, m).collect()} == {2: "doi_differs", 3: "not_held", 4: "no_authors", 5: "no_authors", 6: "not_held"}


def test_block_repair_leaves_nothing_to_repair(spark):
    cases = [
        (("m", "r", V, NR, NA), {"in_situ.ispta_w_cm2": "not_reported"}), ((None, "r", V, V, V), {"in_situ.method": "not_reported"}), (("m", "r", NA, NA, NA), {"in_situ.method": "na", "in_situ.reported_as": "na"}),
        (("m", None, NR, NR, NR), {f"in_situ.{n}": "na" for n in ("method", *val.IN_SITU_NUMBERS)}), (("m", "r", V, V, V), {}), ((None, None, None, None, None), {}),
    ]
    for block, want in cases:
        df = papers(spark, None, {"is": block, "un": (NR, V, None)})
        got = {r.leaf: r.new for r in val.block_repairs(df).collect()}
        assert got == {**want, "unspecified_domain.pressure_kpa": "na"}
    rnd = random.Random(1)
    states = [[rnd.choice(["value", "not_reported", "na"]) for _ in range(5)] for _ in range(80)]
    df = spark.createDataFrame([(s,) for s in states], "s array<string>")
    once = df.select(F.array(*val.repaired_in_situ([F.col("s")[i] for i in range(5)])).alias("s"))
    twice = once.select("s", F.array(*val.repaired_in_situ([F.col("s")[i] for i in range(5)])).alias("t"))
    assert all(r.s == r.t and r.s.count("na") in (0, 5) for r in twice.collect())


def test_unquoted_numbers(spark):
    quotes = {"exposures[0].fundamental_frequency_khz": "driven at 500 kHz ... in water baths", "exposures[2].free_field.pressure_kpa": "this is not in the text at all"}
    df = papers(spark, {"f0": ("value", [500.0], False)}, {"f0": ("value", [500.0], False)}, {"ff": (V, None, None)}, {"ff": (("value", [2.0], False), None, None)}, None, quotes=quotes)
    texts = spark.createDataFrame([("k", "The source was driven at 500 kHz and held in water baths."), (None, "x")], "citekey string, text string")
    got = val.unquoted(df, texts)
    assert {(r.exposure_no, r.reason) for r in got.collect()} == {(2, "quote not found in text"), (3, "no source quote")}
    assert [f.field for f in val.flags_of(got).first().flags] == ["exposures[2].free_field.pressure_kpa", "exposures[3].free_field.pressure_kpa"]
    assert {r.exposure_no for r in val.unquoted(df, texts.limit(0)).collect()} == {3}  # without a text a quotation is believed


def test_settled_and_skeleton(spark):
    df = papers(spark, {"is": ("m", "r", NA, NA, NA), "t": ("continuous", None, V, None, None)}, {"is": (None, "r", V, NR, V), "t": ("continuous", None, None, ("value", [100.0], False), None)}, None)
    assert [tuple(r)[1:] for r in val.settled(df).orderBy("exposure_no").collect()] == [(0, None, None, "pulsed"), (1, "not_reported", "r", "continuous")]
    bare = val.skeleton(df)
    assert bare.schema["exposures"].dataType == df.schema["exposures"].dataType and bare.count() == 1
    cells = facts.unpivot(bare, "record_id").where("m is not null")
    assert cells.where("size(m.vals) > 0").count() == 0 and cells.where("m.state = 'blank'").count() == 4


def test_batch_and_verdicts(spark):
    m = spark.createDataFrame([(i, k, "d", [("F",)]) for i, k in enumerate("abcd")], "entry_id int, citekey string, doi string, authors array<struct<family:string>>")
    r = spark.createDataFrame([(1, "a", "D"), (2, "b", "x"), (3, "c", "d"), (4, "c", "d"), (5, "z", "d")], "record_id int, citekey string, doi string")
    bad = spark.createDataFrame([(4,)], "record_id int")
    assert {x.citekey: x.status for x in val.batch_status(m, r, m, bad).collect()} == {"a": "ok", "b": "identity", "c": "problems", "d": "missing", "z": "extra"}
    v = spark.createDataFrame([(1, "10.1/x", "Relevant ", None, "r"), (2, None, None, None, None), (3, "k", "maybe", "E1", "r"), (4, "k", "not_relevant", "E0", "r"), (5, "k", "relevant", "E2", "r")], "ledger_id int, doi string, verdict string, criterion string, reason string")
    got = {(x.ledger_id, x.problem) for x in val.verdict_problems(v, ("relevant", "not_relevant", "unspecified"), "not_relevant").collect()}
    assert got == {(2, "no_key"), (2, "no_verdict"), (2, "no_reason"), (3, "unknown_verdict"), (4, "no_code"), (5, "code_without_exclusion")}


@pytest.mark.parametrize("share", [1, 500])
def test_resembling_and_tiers(spark, share):
    kind = "id int, names array<string>, words array<string>"
    every = spark.createDataFrame([(1, ["li", "wu", "li"], ["a", "b", "b"]), (2, ["li", "wu"], ["a", "b", "b"]), (3, ["li", "xu", "yu"], ["a"]), (4, ["li"], None), (5, None, ["a"]), (6, ["", "zz"], ["a"])], kind)
    got = pairs.resembling(every.where("id = 1"), every, 0.5, 0.4, share)
    assert {(r.b, round(r.overlap, 3), round(r.cosine, 3)) for r in got.collect()} == {(2, 1.0, 1.0), (3, 0.5, 0.447)}
    assert [tuple(r) for r in pairs.first_tier(got, [("held", 0.8, 0.6), ("check", 0.5, 0.4)]).collect()] == [(1, "held", 2)]
    assert [tuple(r) for r in pairs.first_tier(got.where("b = 3"), [("held", 0.8, 0.6), ("check", 0.5, 0.4)]).collect()] == [(1, "check", 3)]


def test_mentions(spark):
    t = spark.createDataFrame([(1, "The motor-cortex, and M1."), (2, "cortex of the motor"), (3, None), (4, ""), (5, "m1 m1 premotor cortex")], "k int, t string")
    p = spark.createDataFrame([("a", "Motor cortex"), ("a", "M1"), ("b", "premotor  cortex"), ("c", "x"), ("d", "absent word"), ("e", None)], "id string, phrase string")
    assert {r.id: r.n_texts for r in pairs.mentions(t, "k", "t", p).collect()} == {"a": 2, "b": 1, "c": 0, "d": 0, "e": 0}
    assert pairs.mentions(t.limit(0), "k", "t", p).where("n_texts > 0").count() == 0


def test_titles_that_begin_another(spark):
    long = "On the response of neurons to focused sound"
    df = spark.createDataFrame([(1, "J", long, "d1"), (2, "j", long + ": a study", "d2"), (3, "J", long, "d1"), (4, "K", long, "d3"), (5, "J", "Short", "d4"), (6, "J", None, "d5"), (7, "J", long, None)], "id int, j string, t string, d string")
    got = pairs.prefixed_titles(df, "id", F.lower("j"), F.col("t"), F.col("d"))
    assert [tuple(r) for r in got.collect()] == [(1, 2)]


def test_names(spark):
    df = spark.createDataFrame([("2014_Unknown_Title",), ("Smith_2014_A_Title",), ("odd",), (None,)], "s string")
    assert [tuple(r) for r in df.select(text.name_scheme(F.col("s")), text.present_stem(F.col("s"))).collect()] == [("new", "2014_Unknown_Title"), ("old", "2014_Smith_A_Title"), ("other", None), ("other", None)]
    one = spark.createDataFrame([("Ö'Neil", "x"), (None, "2014 - Bancel - Supp.pdf"), (None, None)], "f string, p string")
    assert [r[0] for r in one.select(text.first_author(F.col("f"), F.col("p"))).collect()] == ["oneil", "bancel", "anon"]
    stem = spark.createDataFrame([("", None, None, "10.1/AB-c"), ("Li Wu", 2020, "Sound of waves", "k")], "f string, y int, t string, k string")
    assert [r[0] for r in stem.select(text.safe_stem(F.col("f"), F.col("y"), F.col("t"), F.col("k"))).collect()] == ["Abc_nd_Untitled", "Liwu_2020_SoundWaves"]
    files = spark.createDataFrame([("a.pdf", "x", 1), ("a.pdf", "y", 2), ("a.pdf", "x", 3), ("b", "x", 1), (None, "x", 1), ("a.pdf", "z", 4)], "n string, c string, o int")
    assert {(r.n, r.c): r.target for r in rel.allocated_names(files, "n", "c", "o").collect()} == {("a.pdf", "x"): "a.pdf", ("a.pdf", "y"): "a_2.pdf", ("a.pdf", "z"): "a_3.pdf", ("b", "x"): "b"}


def test_merged_versions_and_retries(spark):
    old = spark.createDataFrame([("p", "d1", 1), ("q", "d2", 1), ("r", "d3", 1)], "k string, doi string, v int")
    new = spark.createDataFrame([("q2", "d2", 1), ("s", "d9", 1), ("t", "d8", 1)], "k string, doi string, v int")
    taken = spark.createDataFrame([("d1", "s"), ("d3", "gone")], "identity string, k string")
    assert {r.k: (r.change, r.now) for r in rel.snapshot_diff(old, new, "k", "doi", ["v"], taken).collect()} == {"p": ("merged", "s"), "q": ("renamed", "q2"), "r": ("removed", None), "t": ("added", "t")}
    e = spark.createDataFrame([("a", 1, "error"), ("a", 2, "ok"), ("a", 3, "error"), ("a", 4, "error"), ("b", 1, "error"), ("b", 2, None), (None, 1, "error")], "k string, t int, e string")
    assert {r.k: (r.failing, r.n_failures) for r in rel.retry_memory(e, "k", ["t"], F.col("e") == "error").collect()} == {"a": (True, 2), "b": (False, 0)}


def test_roll_up_and_listing(spark):
    t = spark.createDataFrame([("r", None, ["x"] * 8), ("a", "r", None), ("b", "a", ["s"]), ("c", "b", []), ("o", None, None)], "id string, parent string, synonyms array<string>")
    got = hierarchy.resolve(t)
    assert {r.id: r.top for r in hierarchy.top_level(got.select("id", "path"), spark.createDataFrame([("a",)], "id string")).collect()} == {"r": "r", "a": "r", "b": "b", "c": "b", "o": "o"}
    assert [r.line for r in hierarchy.listing(got, t).orderBy("pos").collect()] == ["o", "r  (x, x, x, x, x, x)", "  a", "    b  (s)", "      c"]
