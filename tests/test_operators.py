import json
import os
import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import facts, hierarchy, nested, packing_plan, profile, relational as rel, similarity

PAPERS = "record_id long, load_id int, exposures array<struct<label:string,target:struct<terms:array<string>,label:string>,device:struct<family:string>,fundamental_frequency_khz:M,free_field:struct<pressure_kpa:M,isppa_w_cm2:M,ispta_w_cm2:M>,in_situ:struct<method:string,pressure_kpa:M,isppa_w_cm2:M,ispta_w_cm2:M>,unspecified_domain:struct<pressure_kpa:M,isppa_w_cm2:M,ispta_w_cm2:M>,timing:struct<waveform:string,pulse_duration_ms:M,pulse_repetition_frequency_hz:M,duty_cycle_pct:M,sonication_duration_s:M>>>, extra string".replace("M", "struct<state:string,vals:array<double>,is_list:boolean>")


def exposure(f0=None, p=None, terms=None):
    m = lambda v: None if v is None else ("value", v, len(v) > 1)
    return ("x", (terms, None), None, m(f0), (m(p), None, None), None, None, None)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- problem 1 ---------------------------------------------------------------------------


def test_shred_typed(spark):
    data = [(1, 1, [None, exposure([5.0, None, float("nan")], [1.0], ["a", None])], "e"), (1, 1, [None, exposure([5.0, None, float("nan")], [1.0], ["a", None])], "e"), (2, 1, None, None), (3, 1, [], None), (None, 1, [exposure([7.0])], None)]
    nodes = nested.typed_trees(spark.createDataFrame(data, PAPERS))
    got = rows(nested.single_values(nodes).select("record_id", "exposure_no", "block", "field", "value_no"))
    f, p = "fundamental_frequency_khz", "pressure_kpa"
    want = [(None, 0, "exposure", f, 0)] + 2 * [(1, 1, "exposure", f, 0), (1, 1, "exposure", f, 1), (1, 1, "free_field", p, 0)]
    assert got == sorted(want, key=repr)
    assert nested.exposures(nodes).count() == 5
    assert nested.records(nodes).count() == 5
    assert [r.term for r in nested.target_terms(nodes).orderBy("term_no").collect()] == ["a", "a", None, None]
    assert nested.single_values(nested.typed_trees(spark.createDataFrame([], PAPERS))).count() == 0


def test_intervals_nest(spark):
    nodes = nested.node_rows(nested.typed_trees(spark.createDataFrame([(1, 1, [exposure([5.0, 6.0], [1.0], ["a"]), exposure()], None)], PAPERS))).collect()
    assert sorted(n.pre for n in nodes) == list(range(len(nodes))) == sorted(n.post for n in nodes)
    for a in nodes:
        for b in nodes:  # intervals of two nodes nest or are apart
            inside = a.pre < b.pre and b.post < a.post
            if inside:
                assert b.depth > a.depth


@pytest.mark.parametrize(
    "payload, want",
    [
        (None, []), ("", []), ("{'a': 1}", []), ("[]", []), ("<html>", []), ('{"exposures": NaN}', []), ('{"exposures": [{"fundamental_frequency_khz": 5}]} x', []),
        ({"exposures": {"fundamental_frequency_khz": " 5e2 "}}, [(0, "exposure", 0)]),
        ({"record": {"exposures": json.dumps([None, {"timing": {"duty_cycle_pct": [1, [True, "2", ["x", 3.5, None]]]}}])}}, [(1, "timing", 0), (1, "timing", 1), (1, "timing", 2)]),
        ({"exposures": [{"free_field": "text", "in_situ": {"pressure_kpa": "5 kPa", "isppa_w_cm2": "-3", "ispta_w_cm2": {"v": 1}}}]}, [(0, "in_situ", 0)]),
        ({"exposures": "no json"}, []),
    ],
)
def test_shred_payloads(spark, payload, want):
    df = spark.createDataFrame([(9, payload if payload is None or isinstance(payload, str) else json.dumps(payload))], "record_id long, payload string")
    trees = nested.json_trees(df, exposures_type(spark))
    assert rows(nested.single_values(trees).select("exposure_no", "block", "value_no")) == want
    assert nested.records(trees).count() == 1


def exposures_type(spark):
    return spark.createDataFrame([], PAPERS).schema["exposures"].dataType


@pytest.mark.parametrize("depth", [400, 100_000])
def test_deep_payload_lists(spark, depth):
    deep = "[" * depth + '1, "2", ' + "9" * 5000 + ', {"a": [null, true]}, []' + "]" * depth
    nodes = nested.payload_nodes('{"exposures": [{"fundamental_frequency_khz": %s}]}' % deep, exposures_type(spark))
    assert [n[5] for n in nodes if n[0] == "value"] == [1.0, 2.0, float("inf")]
    for bad in ("}", " 1", "", ",", ":1"):
        broken = '{"exposures": [{"fundamental_frequency_khz": %s}]}' % (deep[:-1] if not bad else deep) + bad
        assert len(nested.payload_nodes(broken, exposures_type(spark))) == 1


def test_typed_and_payload_walks_agree(spark):
    record = {"exposures": [None, {"label": "x", "timing": {"duty_cycle_pct": [1, 2], "waveform": "w"}, "target": {"terms": ["a", "b"]}, "device": {"family": "f"}, "fundamental_frequency_khz": 5.0}]}
    typed = [None, ("x", (["a", "b"], None), ("f",), ("value", [5.0], False), None, None, None, ("w", None, None, ("value", [1.0, 2.0], True), None))]
    a = nested.node_rows(nested.typed_trees(spark.createDataFrame([(1, 1, typed, None)], PAPERS)))
    b = nested.node_rows(nested.json_trees(spark.createDataFrame([(1, json.dumps(record))], "record_id long, payload string"), exposures_type(spark)))
    assert rows(a) == rows(b) and a.count() == 13


# ---- problem 3 ---------------------------------------------------------------------------


def test_quantiles_and_drift_are_exact(spark):
    import numpy as np

    rnd = random.Random(5)
    data = {(f, load): [rnd.choice([rnd.gauss(load, 1), 3.0, 3.0, float("inf")]) for _ in range(rnd.randint(1, 90))] for f in "ab" for load in range(4)}
    cells = spark.createDataFrame([(f, load, v) for (f, load), v in data.items()], "field string, load int, values array<double>")
    counts = profile.range_sorted(profile.counted(cells), 5)
    q = {(r.field, r.load): r for r in profile.quantiles(counts, {"m": 0.5, "q": 0.25}).collect()}
    ks = {(r.field, r.load): r.ks for r in profile.drift(counts, profile.load_order(cells)).collect()}
    for (f, load), v in data.items():
        finite = [x for x in v if x < 1e300]
        assert q[f, load].n_values == len(v) and q[f, load].n_distinct == len(set(v))
        if len(finite) == len(v):
            assert abs(q[f, load].m - np.quantile(v, 0.5)) < 1e-12 and abs(q[f, load].q - np.quantile(v, 0.25)) < 1e-12
        if load:
            a, b = data[f, load], data[f, load - 1]
            want = max(abs(sum(x <= t for x in a) / len(a) - sum(x <= t for x in b) / len(b)) for t in a + b)
            assert abs(ks[f, load] - want) < 1e-12


def test_issues_on_odd_input(spark):
    bad = spark.createDataFrame([(1, None, [exposure([1.0])], None), (2, 1, None, None), (3, 1, [None], None), (4, 2, [exposure(None, None)], None)], PAPERS)
    assert {r.issue for r in profile.issues(bad).collect()} <= {"missing"}
    assert profile.issues(spark.createDataFrame([], PAPERS)).count() == 0
    assert profile.profile(spark.createDataFrame([], PAPERS)).count() == 0
    many = [(i, i % 4, [exposure([float(i) if i % 4 < 3 else 5000.0 + i])], None) for i in range(1, 120)]
    got = {(r.load_id, r.field, r.issue) for r in profile.issues(spark.createDataFrame(many, PAPERS)).collect()}
    assert (3, "fundamental_frequency_khz", "scale") in got


# ---- problem 5 ---------------------------------------------------------------------------


def walk(edges):
    out = {}
    for k in edges:
        seen, x = [], k
        while x is not None and x in edges and x not in seen:
            seen.append(x)
            x = edges[x]
        if x is None:
            out[k] = (seen[-1], len(seen) - 1, "ok")
        elif x not in edges:
            out[k] = (seen[-1], len(seen) - 1, "broken")
        else:
            ring = seen[seen.index(x) :]
            out[k] = (min(ring), seen.index(x), "cycle" if k in ring else "under_cycle")
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_hierarchy(spark, seed, monkeypatch):
    monkeypatch.setattr(hierarchy, "REACH", 4 * seed)
    rnd = random.Random(seed)
    n = 60
    edges = {f"n{i}": rnd.choice([None, *[f"n{rnd.randint(0, n - 1)}"] * 6, f"n{max(0, i - 1)}", "gone"]) for i in range(n)}
    edges |= {f"deep{i}": f"deep{i - 1}" if i else None for i in range(20)} | {"self": "self"}
    data = [(k, p) for k, p in edges.items()] + [("n0", edges["n0"]), (None, "n1")]
    got = hierarchy.resolve(spark.createDataFrame(data, "id string, parent string"))
    assert {r.id: (r.root_id, r.depth, r.state) for r in got.collect()} == walk(edges)
    for r in got.where("state = 'ok'").collect():
        assert r.path[0] == r.root_id and r.path[-1] == r.id and len(r.path) == r.depth + 1
    pairs = {(r.ancestor, r.descendant): r.distance for r in hierarchy.descendants(got).collect()}
    assert pairs["deep0", "deep19"] == 19


def test_hierarchy_odd_input(spark):
    df = spark.createDataFrame([("a", " "), ("b", ""), ("c", "a"), ("c", None)], "id string, parent string")
    assert {r.id: (r.root_id, r.state) for r in hierarchy.resolve(df).collect()} == {"a": ("a", "ok"), "b": ("b", "ok"), "c": ("a", "ok")}
    assert hierarchy.resolve(spark.createDataFrame([], "id string, parent string")).count() == 0
    used = spark.createDataFrame([("a",), ("a ",), (None,), ("a ",)], "term string")
    assert [r.term for r in hierarchy.unlisted(used, df).collect()] == ["a "]


# ---- flat tables ----------------------------------------------------------------------------


LEDGER = "k string, o int, run string, verdict string, criterion string, parked_class string"


def test_ledger_history(spark):
    data = [("k", 1, "r1", "relevant", None, None), ("k", 2, "r1", "relevant", None, None), ("k", 3, "r2", None, "E1", None), ("k", 4, "r2", "not_relevant", "E9", None), (None, 1, "r", "x", None, None), ("m", 1, "r", "x", "E9", "own"), ("n", 1, "r", "", None, None)]
    df = spark.createDataFrame(data, LEDGER)
    state = ["run", "verdict", "criterion"]
    led = rel.record_verdicts(df, "k", ["o"], state, "verdict", {"E9": "parked"})
    assert {r.k: (r.run, r.verdict, r.criterion, r.parked_class, r.n_replaced) for r in led.collect()} == {"k": ("r2", "not_relevant", "E9", "parked", 1), "m": ("r", "x", "E9", "own", 0)}
    assert tuple(rel.upsert_counts(led).first()) == (2, 1)
    assert [tuple(r) for r in rel.superseded(df.where("verdict is not null"), "k", ["o"], state).collect()] == [("k", 1, "r1", "relevant", None)]
    assert rel.record_verdicts(df.limit(0), "k", ["o"], state, "verdict", {}).count() == 0


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_history_of_a_hot_key_is_split(spark, partitions):
    rnd = random.Random(8)
    data = [("hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 5)}", i, None, rnd.choice("abc"), None, None) for i in range(400)]
    got = {}
    for r in rel.state_changes(spark.createDataFrame(data, LEDGER), "k", ["o"], ["verdict"], partitions).collect():
        got.setdefault(r.k, []).append((r.seq, r.o, r.verdict, r.last))
    for k in {x[0] for x in data}:
        own = [(o, v) for q, o, _, v, _, _ in data if q == k]
        steps = [x for i, x in enumerate(own) if i == 0 or own[i - 1][1] != x[1]]
        assert sorted(got[k]) == [(i + 1, o, v, i == len(steps) - 1) for i, (o, v) in enumerate(steps)]


def test_merge_sources(spark):
    df = spark.createDataFrame([("k", 1, "s1", None, "A"), ("k", 2, "s2", "abc", "B"), ("k", 3, "s1", "xyz", "C"), (None, 4, "s1", "q", "D")], "k string, seq int, src string, abstract string, title string")
    got = rel.merge_sources(df, "k", ["seq"], "src", "abstract").collect()
    assert [(r.title, r.abstract, r.found_by) for r in got] == [("A", "abc", ["s1", "s2"])]


def test_seats(spark):
    df = spark.createDataFrame([(2024,)] * 5 + [(2025,)] * 3 + [(2026,)] * 2 + [(None,)], "y int")
    assert {r.y: r.seats for r in rel.seats(df, "y", 4).collect()} == {2024: 2, 2025: 1, 2026: 1}


def test_top_with_ties(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate((9, 8, 7, 6, 5, 4, 3, 3, 2, 2, 2, 1))], "g int, n int")
    assert rel.top_with_ties(df, 10, "n").count() == 11


@pytest.mark.parametrize(
    "papers, released, working, want",
    [
        ([(f"d{i:02}", "2024li") for i in range(1, 23)] + [("e1", "2024liu")], [], [], {"e1": "2024liu", "d22": "2024liw"}),
        ([("a", "2026chen"), ("b", "2026cheng")], [("a", "2026cheng")], [], {"a": "2026cheng", "b": "2026chenga"}),
        ([("a", "2026legon"), ("c", "2026legon"), ("n", "2026legon")], [("a", "2026legona"), ("b", "2026legonb"), ("c", "2026legonc")], [], {"a": "2026legona", "c": "2026legonc", "n": "2026legond"}),
        ([("n", "2025yang")], [("x", "2025yang")], [], {"n": "2025yanga"}),
        ([("a", "2020x"), ("b", "2020x")], [], [("a", "2020xc")], {"a": "2020xc", "b": "2020xa"}),
    ],
)
def test_assign_keys(spark, papers, released, working, want):
    frame = lambda rows, cols: spark.createDataFrame(rows, cols)
    got = {r.doi: r.key for r in rel.assign_keys(frame(papers, "doi string, base string"), frame(released, "doi string, key string"), frame(working, "doi string, key string")).collect()}
    assert want.items() <= got.items() and len(set(got.values())) == len(got)


def test_assign_keys_beyond_z(spark):
    frame = lambda rows, cols: spark.createDataFrame(rows, cols)
    # 2024li: a is taken, u and its suffixes belong to 2024liu; 27th and 28th letters follow z.
    papers = [(f"d{i:03}", "2024li") for i in range(60)] + [("e1", "2024liu"), ("e2", "2024liu"), ("f", "2024li"), ("g", "2024li")]
    run = lambda rel_, wrk: {r.doi: r.key for r in rel.assign_keys(frame(papers, "doi string, base string"), frame(rel_, "doi string, key string"), frame(wrk, "doi string, key string")).collect()}
    got = run([("x", "2024lia"), ("f", "2024liac")], [("g", "2024liua")])
    letters = [c for c in string.ascii_lowercase if c != "u"]
    free = [s for s in letters + [a + b for a in letters for b in string.ascii_lowercase] if s not in ("a", "ac")]
    assert [got[f"d{i:03}"] for i in range(60)] == ["2024li" + s for s in free[:60]]
    assert got["f"] == "2024liac" and got["g"] == "2024li" + free[60] and {got["e1"], got["e2"]} == {"2024liua", "2024liub"} and len(set(got.values())) == len(papers)
    assert run([("x", "2024lia"), ("f", "2024liac")], list(got.items())) == got
    with pytest.raises(Exception, match="no free suffix"):
        rel.assign_keys(frame([("x1", "b"), ("x2", "b")] + [(c, "b" + c) for c in string.ascii_lowercase], "doi string, base string"), frame([], "doi string, key string"), frame([], "doi string, key string")).collect()


def test_author_pairs(spark):
    rows = [(1, "x", "stimulationofthevagusnerveinrats", 2020), (2, "x", "stimulationofthevaggusnerveinrats", 2023), (3, "x", "stimulationofthevagusnerveinrats", 2020), (4, "x", "stimulationofthevagusnerveinrats", 2024)]
    rows += [(5, "y", "stimulationofthevagusnerveinrats", 2020), (6, "x", "anotherthingaltogether", 2020), (7, "x", None, 2020), (8, None, "stimulationofthevagusnerveinrats", 2020), (9, "y", "stimulationofthevagusnerveinmice", 2019), (10, "z", "onetitle", None), (11, "z", "onetitle", None)]
    df = spark.createDataFrame(rows, "i int, w string, t string, y int")
    for share in (1, 200):
        got = {(r.a, r.b): (r.rows_a, r.rows_b) for r in similarity.author_pairs(df, "i", "w", "t", "y", share=share).collect()}
        assert got == {(1, 1): (2, 2), (1, 2): (2, 1), (2, 4): (1, 1), (5, 9): (1, 1), (10, 10): (2, 2)}


def test_snapshot_diff(spark):
    old = spark.createDataFrame([("a", "d1", 1), ("b", "d2", 1), ("c", "d3", None), ("e", "d5", 1)], "k string, doi string, v int")
    new = spark.createDataFrame([("a2", "d1", 1), ("b", "d2", 2), ("c", "d3", None), ("f", "d6", 1)], "k string, doi string, v int")
    got = {r.k: r.change for r in rel.snapshot_diff(old, new, "k", "doi", ["v"]).collect()}
    assert got == {"a": "renamed", "b": "corrected", "c": "same", "e": "removed", "f": "added"}


def test_first_fit(spark):
    assert rel.first_fit_decreasing([9, 7, 6, 5, 3], 15) == [0, 1, 0, 1, 1]
    rnd = random.Random(3)
    for _ in range(200):
        cap = rnd.randint(3, 20)
        sizes = [rnd.randint(1, cap + 3) for _ in range(rnd.randint(1, 30))]
        want = rel.first_fit_decreasing(sizes, cap)
        place, rank = {}, {}
        for s, lo, hi, first, per in packing_plan.plan({s: sizes.count(s) for s in sizes}, cap):
            place.update({(s, r): first + (r - lo) // per for r in range(lo, hi)})
        got = []
        for s in sizes:
            got.append(place[s, rank.get(s, 0)])
            rank[s] = rank.get(s, 0) + 1
        assert got == want
    df = spark.createDataFrame([(i, s) for i, s in enumerate((9, 7, 6, 5, 3))], "i int, n int")
    assert [r.batch_no for r in packing_plan.first_fit(df, "i", "n", 15).orderBy("i").collect()] == [0, 1, 0, 1, 1]


def test_numbered_is_global(spark):
    df = spark.createDataFrame([(i * 7 % 50,) for i in range(50)], "v int")
    assert [(r.v, r.pos) for r in rel.numbered(df, ["v"]).orderBy("v").collect()] == [(i, i + 1) for i in range(50)]


def test_set_join_matches_brute_force(spark):
    rnd = random.Random(4)
    sets = {i: sorted({rnd.choice("abcdefghij") for _ in range(rnd.randint(0, 8))}) for i in range(80)}
    df = spark.createDataFrame([(i, s) for i, s in sets.items()] + [(99, None)], "i int, s array<string>")
    members, links = similarity.set_join(df, "i", F.col("s"), 0.6)
    cls = {r.i: r.class_id for r in members.collect()}
    assert set(cls) == {i for i, s in sets.items() if s}
    reps = sorted(set(cls.values()))
    jac = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    assert {(r.a, r.b) for r in links.collect()} == {(a, b) for a in reps for b in reps if a < b and jac(sets[a], sets[b]) >= 0.6}


def test_set_join_of_frequent_tokens_writes_few_pairs(spark):
    rnd = random.Random(6)
    words = [f"w{i:02d}" for i in range(60)]
    sets = [rnd.sample(words, 15) for _ in range(3000)]
    sets += [[*s[1:], "new"] for s in sets[:200]] + [s[1:] for s in sets[200:300]] + sets[:50]
    df = spark.createDataFrame(list(enumerate(sets)), "i int, s array<string>")
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = written()
    members, links = similarity.set_join(df, "i", F.col("s"), 0.85)
    got = {(r.a, r.b) for r in links.collect()}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert written() - before < 4_000_000
    m = np.zeros((len(sets) - 50, 61), int)
    for i, s in enumerate(sets[:-50]):
        m[i, [60 if w == "new" else int(w[1:]) for w in s]] = 1
    both, n = m @ m.T, m.sum(1)
    want = np.argwhere(np.triu(both >= 0.85 * (n[:, None] + n[None, :] - both) - 1e-9, 1))
    assert got == {tuple(x) for x in want.tolist()} and len(got) >= 300
    assert {r.i: r.class_id for r in members.collect()} == {i: i if i < len(sets) - 50 else i - len(sets) + 50 for i in range(len(sets))}


def test_part_signatures_miss_no_pair():
    rnd = np.random.default_rng(2)
    hashes = rnd.integers(0, 2**63, 400).astype(np.uint64)
    for t, n in ((0.85, 15), (0.6, 12), (0.5, 31), (0.3, 40)):
        sets = []
        for _ in range(60):
            s = rnd.permutation(400)[:n]
            sets += [s, np.concatenate((s[: n - int(rnd.integers(0, n // 2))], rnd.permutation(400)[: int(rnd.integers(0, n // 3))]))]
        sets = [np.unique(s) for s in sets]
        sig, who = similarity.part_signatures(hashes[np.concatenate(sets)], np.array([len(s) for s in sets]), t)
        runs = {}
        for v, w in zip(sig.tolist(), who.tolist()):
            runs.setdefault(v, set()).add(w)
        found = {(a, b) for r in runs.values() for a in r for b in r if a < b}
        jac = lambda a, b: len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        want = {(a, b) for a in range(120) for b in range(a + 1, 120) if t <= jac(sets[a], sets[b]) < 1}
        assert want and want <= found


def test_nearest(spark):
    rnd = random.Random(1)
    vecs = {i: [rnd.gauss(0, 1) for _ in range(5)] for i in range(40)} | {40: [0.0] * 5}
    df = spark.createDataFrame([*vecs.items(), (41, None)], "i long, v array<double>")
    got = {r.query: r.neighbour for r in similarity.nearest(df, "i", "v", F.col("k") % 5 == 0, block=3).collect()}
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
    for q in range(0, 40, 5):
        assert got[q] == max((j for j in range(40) if j != q), key=lambda j: cos(vecs[q], vecs[j]))


def test_rulings_and_reporting(spark):
    a = spark.createDataFrame([(1, 1, [exposure([100.0], [5.0]), None], None), (2, 1, [exposure([1.0])], None), (3, 1, None, None)], PAPERS)
    b = spark.createDataFrame([(1, 2, [exposure([101.0], [9.0]), None], None), (2, 2, [], None), (3, 2, None, None)], PAPERS)
    diff = facts.compare(a, b, "record_id").where("not agree")
    assert rows(diff.select("record_id", "leaf")) == [(1, "free_field.pressure_kpa"), (2, "exposures")]
    want = diff.where("exposure_no is not null").join(facts.unpivot(b, "record_id"), ["record_id", "exposure_no", "leaf"]).select("record_id", "exposure_no", "leaf", "m")
    fixed = facts.set_at(a, want)
    assert facts.compare(fixed, b, "record_id").where("not agree and exposure_no is not null").count() == 0
    assert fixed.count() == 3
    got = {r.leaf: (r.applicable, r.share) for r in facts.reporting(a).collect()}
    assert got["fundamental_frequency_khz"] == (2, 1.0) and got["timing.duty_cycle_pct"] == (0, None) and not any(k.startswith("unspecified") for k in got)
    four = [("value", [1.0], False), ("value", [2.0], False), ("not_reported", None, False), ("na", None, False)]
    c = spark.createDataFrame([(1, 1, [("x", None, None, m, None, None, None, None) for m in four], None)], PAPERS)
    assert [(r.applicable, r.not_reported, r.share) for r in facts.reporting(c).where("leaf = 'fundamental_frequency_khz'").collect()] == [(3, 1, 0.667)]
    assert facts.checks(a).count() == 2 and facts.block_discipline(a).count() > 0


def test_oversized_items_are_alone(spark):
    df = spark.createDataFrame([(1, 20), (2, 9), (3, 6), (4, 99), (5, None), (6, 20)], "i int, n int")
    assert {r.i: r.batch_no for r in packing_plan.first_fit(df, "i", "n", 15).collect()} == {4: 0, 1: 1, 6: 2, 2: 3, 3: 3, 5: 4}
    assert packing_plan.first_fit(df.limit(0), "i", "n", 15).count() == 0


def test_pages_without_a_cap(spark, tmp_path):
    from strandline.sources.paged import CursorPages

    os.makedirs(tmp_path / "q")
    for n in range(3):
        (tmp_path / "q" / f"{n}.json").write_text(json.dumps({"rows": [{"k": 10 * n + i} for i in range(10)], "total": 30}))
    spark.dataSource.register(CursorPages)
    read = lambda **o: spark.read.format("cursor_pages").options(queries=json.dumps([str(tmp_path / "q")]), fetch="strandline.sources.paged:landed", **o).load()
    assert read().count() == 30 and read().where("not complete").count() == 0
    cut = read(cap="15")
    assert cut.count() == 15 and [r.pos for r in cut.where("not complete").collect()] == [14]


def test_sources_and_sinks(spark, tmp_path):
    from pyspark.sql.types import StringType, StructField, StructType

    from strandline.sources import readers, sinks
    from strandline.sources.paged import CursorPages

    schema = StructType([StructField("k", StringType())])
    os.makedirs(tmp_path / "in")
    (tmp_path / "in/a.json").write_text('{"k":\n "x"}')
    (tmp_path / "in/b.json").write_text("{broken")
    good, bad = readers.json_records(spark, str(tmp_path / "in"), schema)
    assert [r.k for r in good.collect()] == ["x"] and bad.count() == 1
    assert readers.json_records(spark, str(tmp_path / "none"), schema)[0].count() == 0
    (tmp_path / "l.jsonl").write_text('{"doi": "A", "v": 1}\n\n{"doi": "a", "v": 2}\n')
    assert [(r.doi, r.v) for r in readers.ledger_lines(spark, str(tmp_path / "l.jsonl"), "doi string, v int", "doi").collect()] == [("a", 2)]
    md = spark.createDataFrame([("## 10.1/a\nT1\n\n## 10.1/b\nT2\n",)], "t string")
    assert [(r.key, r.block) for r in readers.heading_blocks(md, "t").collect()] == [("10.1/a", "T1"), ("10.1/b", "T2")]
    assert md.select(readers.heading_keys(F.col("t")).alias("x")).first()["x"] == ["10.1/a", "10.1/b"]
    (tmp_path / "w.json").write_text('{"note": "n", "papers": {"p1": {"v": 3}}}')
    assert [tuple(r) for r in readers.wrapped_map(spark, str(tmp_path / "w.json"), "papers", "struct<v:int>").collect()] == [("p1", 3)]

    for n, rows_ in ((0, [1, 2]), (1, [3]), (2, [])):
        os.makedirs(tmp_path / "q", exist_ok=True)
        (tmp_path / f"q/{n}.json").write_text(json.dumps({"rows": rows_, "total": 3}))
    spark.dataSource.register(CursorPages)
    pages = spark.read.format("cursor_pages").options(queries=json.dumps([str(tmp_path / "q")]), fetch="strandline.sources.paged:landed", cap="10").load()
    assert [(r.pos, r.payload, r.total) for r in pages.orderBy("pos").collect()] == [(0, "1", 3), (1, "2", 3), (2, "3", 3)]

    df = spark.createDataFrame([("b", 2), ("a", None)], "k string, v int")
    sinks.sorted_json(df, str(tmp_path / "o1"), "k")
    assert [r.value for r in spark.read.text(str(tmp_path / "o1")).collect()] == ['{"k":"a","v":null}', '{"k":"b","v":2}']
    sinks.fan_out(df, str(tmp_path / "o2"), "k")
    assert os.path.isdir(tmp_path / "o2/k=a")
    sinks.batches(df, str(tmp_path / "o3"), 1, "k")
    assert sorted(d for d in os.listdir(tmp_path / "o3") if d.startswith("batch")) == ["batch_no=0", "batch_no=1"]
    assert not sinks.all_or_nothing(df, F.col("v") > 0, str(tmp_path / "o4")) and not os.path.exists(tmp_path / "o4")
    sinks.version(df, str(tmp_path / "v"), "2026.9.0")
    sinks.version(df.limit(1), str(tmp_path / "v"), "2026.10.0")
    all_v = readers.versions(spark, str(tmp_path / "v"), "k string, v_ int")
    assert readers.latest(all_v) == "2026.10.0"
    assert sinks.safe_to_delete(100, 20) and not sinks.safe_to_delete(100, 21)
    assert sinks.next_version((2026, 10), "2026.10.0") == "2026.10.1" and sinks.next_version((2026, 11), "2026.10.3") == "2026.11.0"
    got = readers.first_usable([("p", df.select("k", F.lit("short").alias("t"))), ("q", df.select("k", F.lit("x" * 90).alias("t")))], "k", "t")
    assert {r.source for r in got.collect()} == {"q"}


def test_streams_equal_batch(spark, tmp_path):
    from strandline.streaming import ledgers

    os.makedirs(tmp_path / "events.parquet")
    rnd = random.Random(2)
    data = [(i, rnd.randint(0, 3), 1_700_000_000 + 60 * i, rnd.choice("abc")) for i in range(60)] + [(99, None, 1_700_000_000, "a")]
    df = spark.createDataFrame(data, "event_id long, user_id long, t long, event_type string").select("event_id", "user_id", F.timestamp_seconds("t").cast("timestamp_ntz").alias("ts"), "event_type")
    df.repartitionByRange(3, "event_id").write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
    out = ledgers.drain(ledgers.history(ledgers.source(spark, str(tmp_path), "events")), "update")
    got = rel.last_wins(out, "user_id", ["_batch"]).select("user_id", "event_type", "n_replaced")
    batch = rel.current_with_history(df, "user_id", ["ts", "event_id"], ["event_type"]).select("user_id", "event_type", "n_replaced")
    assert rows(got) == rows(batch)
    assert ledgers.drain(ledgers.first_seen(ledgers.source(spark, str(tmp_path), "events"), "user_id"), "append").count() == 5
