import datetime
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import bpe, language, packing, signatures as sg, similar, survivors

ODD = ["", " ", "a", "the  end", "don't STOP", "x" * 3000, "=-" * 500, " " * 700, "Straße – naïve ﬁsh", "超声刺激大鼠颞叶的研究仍然很少。", "Давление в воде", "🙂🧠‍ ạ́̈", "<|endoftext|>", "a\r\n\tb 　c", "12 345,67 %", "�\u0000‮"]


# ---- problem 6 -----------------------------------------------------------------------------


def test_ids_equal_both_libraries(spark):
    import tiktoken
    from tokenizers import Tokenizer

    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("ab c.1é\n'超s") for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    ranks = bpe.load_ranks(f"{bpe.VOCABULARIES}/byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=bpe.split_pattern(), mergeable_ranks=ranks, special_tokens={})
    hf = Tokenizer.from_file(f"{bpe.VOCABULARIES}/byte_bpe_50k.json")
    hf.encode_special_tokens = True
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    got = {r.i: (list(r.ids), r.n) for r in df.select("i", bpe.token_ids(F.col("t")).alias("ids"), bpe.token_count(F.col("t")).alias("n")).collect()}
    for i, t in enumerate(texts):
        assert got[i][0] == own.encode_ordinary(t) == hf.encode(t, add_special_tokens=False).ids
        assert got[i][1] == len(got[i][0])
        assert own.decode(got[i][0]) == t  # exact round trip
    assert got[len(texts)] == ([], 0)


def test_other_vocabulary():
    import tiktoken

    ranks = bpe.load_ranks(f"{bpe.VOCABULARIES}/byte_bpe_multi_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=bpe.split_pattern(), mergeable_ranks=ranks, special_tokens={})
    enc = bpe.Encoder("byte_bpe_multi_50k")
    assert all(enc.encode(t) == own.encode_ordinary(t) for t in ODD)


# ---- problem 7 -----------------------------------------------------------------------------


def fewest(items, cap):
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + items[i] <= cap and bins[b] not in bins[:b]:
                bins[b] += items[i]
                go(i + 1, bins)
                bins[b] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_fixed_contents_keep_the_optimum():
    rnd = random.Random(2)
    for _ in range(600):
        cap = rnd.randint(5, 40)
        items = [rnd.randint(1, cap) for _ in range(rnd.randint(1, 8))]
        left, fixed = {s: items.count(s) for s in items}, [0]
        packing._dominance(sorted(left), left, cap, lambda need, n: fixed.__setitem__(0, fixed[0] + n))
        rest = sorted((s for s, k in left.items() for _ in range(k)), reverse=True)
        assert fixed[0] + (fewest(rest, cap) if rest else 0) == fewest(sorted(items, reverse=True), cap)


def test_pack(spark):
    rnd = random.Random(3)
    data = [(i, rnd.choice([0, 3, 7, 10, 11, 25, rnd.randint(1, 40)])) for i in range(400)] + [(400, None), (7, 5)]
    items = spark.createDataFrame(data, "doc_id long, tokens int")
    budgets = spark.createDataFrame([(1, 10), (2, 32), (3, None), (4, 0)], "budget_id int, capacity_tokens int")
    got = packing.pack(items, budgets, salts=3).toPandas()
    assert set(got.budget_id) == {1, 2}
    for b, cap in ((1, 10), (2, 32)):
        g = got[got.budget_id == b]
        load = g.groupby("container_id").tokens.sum()
        assert load.max() <= cap and sorted(load.index) == list(range(len(load)))
        total = sum(n or 0 for _, n in data)
        assert g.tokens.sum() == total and len(load) <= 1.1 * total / cap + 2
        pieces = g[g.doc_id != 7].groupby("doc_id").tokens.agg(["sum", "count"])
        for i, n in data[:401]:
            if i != 7:
                n = n or 0
                assert pieces.loc[i, "sum"] == n and pieces.loc[i, "count"] == max(1, -(-n // cap))  # split only above the capacity
    assert packing.pack(items.limit(0), budgets).count() == 0
    assert packing.pack(items, budgets.limit(0)).count() == 0


# ---- problem 4 -----------------------------------------------------------------------------

MANIFEST = "entry_id long, doi string, year int, title string, record_source string, updated_at timestamp, text_key string, extra string"


def test_usable_titles(spark):
    bad = ["", "  ", " ", "Abstract", "Original article", "N/A", "untitled", "Untitled document 29", "proof_501.pdf", "Microsoft Word - ms_v27.docx", "Manuscript89_revised_CLEAN", "S234-17", "pp. 12-19", "jpf.86979 1..79", "1524429", "not_reported", "Using the journal template", "Safety of repeated im …", "Safety of repeated im...", "Supplementary material", None]
    good = ["Focused sound in mice", "Safety of repeated <i>pulses</i> over the retina: no loss in 8 cats.", "DOSE DEPENDENCE OF PULSES AT 270 KHZ", "Re: Safety of repeated pulses"]
    df = spark.createDataFrame([(t,) for t in bad + good], "t string").select("t", survivors.usable_title(F.col("t")).alias("ok"))
    assert {r.t: r.ok for r in df.collect()} == {**dict.fromkeys(bad, False), **dict.fromkeys(good, True)}


def test_usable_keys(spark):
    cases = {"10.99/": False, "10.9900/": False, "10.9900/x": True, "https://doi.org/10.9900/x": True, "10.9900/ ": False, "pending": False}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", survivors.usable_doi(F.col("t")).alias("ok"))
    assert {r.t: r.ok for r in df.collect()} == cases


def test_survivors(spark):
    d = datetime.datetime.fromisoformat
    rows = [
        (1, "10.9900/a", 2020, "First good title", "x", d("2020-01-01"), "k", None), (2, "10.9900/b", 99, "Second good title", "y", d("2021-01-01"), "k", None),
        (3, "10.9900/c", 2021, None, None, None, "k", None), (3, "10.9900/c", 2021, None, None, None, "k", None),
        (4, "n/a", None, "Abstract", "x", None, "none", None), (5, None, None, None, "x", None, "none", None),
        (6, "10.9900/z", 2020, "Alone", "x", None, "single", None), (7, "10.9900/z", 2020, "No key", "x", None, None, None), (8, "10.9900/z", 2020, "No key", "x", None, None, None),
    ]
    trust = spark.createDataFrame([("y", "doi", 1), ("x", "doi", 2), ("x", "year", 1), ("y", "title", 5)], "source string, field string, trust_rank int")
    got = survivors.choose(spark.createDataFrame(rows, MANIFEST), survivors.manifest_bundles(), trust)
    assert {(r.text_key, r.field, r.entry_id) for r in got.collect()} == {("k", "doi", 2), ("k", "year", 1), ("k", "title", 2)}
    assert survivors.choose(spark.createDataFrame([], MANIFEST), survivors.manifest_bundles(), trust).count() == 0


@pytest.mark.parametrize("width, most", [(1, 0), (1, 4), (2, 8), (16, 64)])
def test_dependencies_match_brute_force(spark, width, most):
    """Branch and bound at several widths, and elimination (most = 0), against all combinations."""
    import itertools

    rnd = random.Random(7)
    rank = {("x", "doi"): 1, ("y", "doi"): 2, ("x", "year"): 1, ("y", "year"): 3, ("y", "title"): 1}
    rows, want = [], {}
    n = 0
    for g in range(60):
        group = []
        for _ in range(rnd.randint(2, 7)):
            n += 1
            group.append((n, rnd.choice(["10.9900/a", "10.9900/b", "10.9900/c", None]), rnd.choice([2001, 2002, None]), rnd.choice(["First good title", "Another fine title", None]), rnd.choice("xyz"), None, f"k{g}", None))
        rows += group

        def candidates(field, at):
            seen = {}
            for e in sorted((e for e in group if e[at]), key=lambda e: (rank.get((e[4], field), survivors.LAST_RANK), e[0])):
                seen.setdefault((e[at], None if field == "doi" else e[1]), (rank.get((e[4], field), survivors.LAST_RANK), e[0], e[1]))
            return list(seen.values()) or [None]

        lists = [candidates("doi", 1), candidates("year", 2), candidates("title", 3)]
        best = min(
            (
                (not all(c is None or d is None or c[2] in (None, d[2]) for c in (y, t)), sum(c[0] for c in (d, y, t) if c), i, j, k, [c and c[1] for c in (d, y, t)])
                for (i, d), (j, y), (k, t) in itertools.product(*map(enumerate, lists))
            ),
            key=lambda r: (r[0], *(r[1:5] if not r[0] else r[2:5])),
        )
        for f, e in zip(("doi", "year", "title"), best[5]):
            if e:
                want[f"k{g}", f] = (e, not best[0])
    trust = spark.createDataFrame([(*k, v) for k, v in rank.items()], "source string, field string, trust_rank int")
    got = survivors.choose(spark.createDataFrame(rows, MANIFEST), survivors.manifest_bundles(), trust, dependencies=[("doi", "year"), ("doi", "title")], width=width, most=most).collect()
    assert {(r.text_key, r.field): (r.entry_id, r.consistent) for r in got} == want and len(got) == len(want)
    assert any(not ok for _, ok in want.values())
    with pytest.raises(ValueError):
        survivors.choose(spark.createDataFrame(rows, MANIFEST), survivors.manifest_bundles(), trust, dependencies=[("doi", "year"), ("year", "title")])


# ---- problem 2 -----------------------------------------------------------------------------


def corpus(seed, n):
    rnd = random.Random(seed)
    stock = [[f"{w}{rnd.randint(0, 9)}" for w in rnd.sample("alpha beta gamma delta eps zeta eta theta iota kappa".split(), 8)] for _ in range(12)]
    out = []
    for _ in range(n):
        words = [w for s in rnd.sample(stock, 5) for w in s]
        for _ in range(rnd.randint(0, 6)):
            words[rnd.randrange(len(words))] = f"new{rnd.randint(0, 99)}"
        out.append(" ".join(words))
    return out + out[: n // 10] + [f"a b {'c ' * k}" for k in (1, 17, 30, 60)] + ["a b c"]


@pytest.mark.parametrize("rare, chance, groups", [(2, 1, (3,)), (5, 4, (8,)), (300, 9, (20,)), (1, 2, (2, 1)), (1, 10, (1, 2, 1)), (64, 1000, (20, 2))])
def test_set_links_match_brute_force(spark, monkeypatch, rare, chance, groups):
    monkeypatch.setattr(sg, "MOST", 100)
    texts = corpus(11, 120)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts, None, ""])], "i long, text string, extra string")
    members, links = similar.similar_texts(df, "i", rare=rare, chance=chance, groups=groups)
    digest = {r.i: r.digest for r in members.collect()}
    sets = {}
    for i, t in enumerate(texts):
        w = sg.words(t)
        if len(w) >= 20:
            sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)}
    assert set(digest) == set(sets)
    jac = lambda a, b: len(a & b) / len(a | b)
    want = {tuple(sorted((digest[a], digest[b]))) for a in sets for b in sets if digest[a] != digest[b] and jac(sets[a], sets[b]) >= 0.5}
    assert {(r.a, r.b) for r in links.collect()} == want and want


def test_copies_in_other_batches_are_sent_once(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    body = [[rnd.choice(words) for _ in range(60)] for _ in range(40)]
    body += [[*w[:55], "x", "y"] for w in body[:10]]
    df = spark.createDataFrame([(f"k{j}.{i}", " ".join(w)) for j in range(100) for i, w in enumerate(body)], "i string, text string").repartition(4).cache()
    df.count()
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before, usual = written(), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        members, links = similar.similar_texts(df, "i")
        got = {(r.a, r.b) for r in links.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", usual)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert written() - before < 1_000_000
    digest = {r.i: r.digest for r in members.collect()}
    assert len(digest) == 5000 and len(set(digest.values())) == 50 and all(d == digest["k0." + i.split(".")[1]] for i, d in digest.items())
    sets = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} for w in body]
    alike = lambda a, b: len(a & b) >= 0.5 * len(a | b)
    assert got == {tuple(sorted((digest[f"k0.{a}"], digest[f"k0.{b}"]))) for a in range(50) for b in range(a) if alike(sets[a], sets[b])} and len(got) >= 10
    df.unpersist()


def test_words_and_hashes():
    texts = [*ODD, None, "ΟΔΟΣ ½ a_b ﬁ", "y" * 70_000 + " z"]
    h, n = sg.WordHash()(texts)
    flat = [w for t in texts for w in sg.words(t or "")]
    assert n.tolist() == [len(sg.words(t or "")) for t in texts] and len(h) == len(flat)
    seen = {}
    assert all(seen.setdefault(w, x) == x for w, x in zip(flat, h.tolist())) and len(set(seen.values())) == len(seen)


def test_blob_round_trip():
    rnd = np.random.default_rng(1)
    who = rnd.integers(0, 50, 300)
    sig, ind = rnd.integers(0, 2**32, 300).astype(np.uint32), rnd.integers(0, 2, 300).astype(bool)
    digest, size, maps = rnd.integers(0, 2**63, 60).astype(sg.U), rnd.integers(1, 99, 60), rnd.integers(0, 2**63, (60, sg.BITMAP)).astype(sg.U)
    s, w, i, d, n, m = sg.unpack_blob(sg.pack_blob(sig, who, ind, digest, size, maps))
    assert sorted(zip(s.tolist(), d[w].tolist(), i.tolist())) == sorted(zip(sig.tolist(), digest[who].tolist(), ind.tolist()))
    assert (m[w] == maps[np.searchsorted(np.unique(who), w) * 0 + np.unique(who)[w]]).all() and (n == size[np.unique(who)]).all()


def test_title_links_and_groups(spark, monkeypatch):
    monkeypatch.setattr(similar, "COMMON", 2)
    rnd = random.Random(5)
    titles = ["Pulsed sonication of the motor cortex in mice", "Pulsed sonication of the motor cortex in rats", "Safety of théta bursts", "Safety of theta bursts!", "ab", "", None]
    names = [[("Müller", None), ("Li", None)], [("Muller", None)], [("Li", None), ("Wu", None), ("Xu", None)], [], None, [(None, "A")]]
    m = [(i, f"c{i}" if i % 3 else None, rnd.choice(titles), rnd.choice(names), None) for i in range(60)]
    m += [(100 + i, f"d{i}", "Same", [("Li", None)], "x") for i in range(3)] + [m[0]]
    body = corpus(3, 20)
    a = [(i, f"c{i}", rnd.choice([*body, None, "n/a"]), "x") for i in range(40)] + [(50 + i, f"d{i}", body[0], None) for i in range(2)]
    man = spark.createDataFrame(m, "entry_id long, citekey string, title string, authors array<struct<family:string,given:string>>, extra string")
    abst = spark.createDataFrame(a, "abstract_id long, citekey string, text string, extra string")
    text = {c: t for _, c, t, _ in a}

    def fold(s):
        return re.sub("[^a-z0-9]", "", "".join(c for c in unicodedata.normalize("NFKD", s or "") if not unicodedata.combining(c)).lower())

    feats = {}
    for e, c, t, au, _ in m:
        w = sg.words(text.get(c) or "")
        f = fold(t)
        feats[e] = ({tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 20 else None, {f[k : k + 3] for k in range(len(f) - 2)}, {x for x in (fold(n) for n, _ in au or []) if x})

    def alike(x, y):
        jac = lambda p, q: len(p & q) / len(p | q) if p | q else 0
        if x[0] is not None and y[0] is not None:
            return jac(x[0], y[0]) >= 0.5
        return jac(x[1], y[1]) >= 0.7 and jac(x[2], y[2]) >= 0.5

    root = {e: e for e in feats}

    def find(e):
        while root[e] != e:
            e = root[e]
        return e

    for x in feats:
        for y in feats:
            if x < y and alike(feats[x], feats[y]):
                a_, b_ = sorted((find(x), find(y)))
                root[b_] = a_
    want = {(x, y) for x in feats for y in feats if x < y and find(x) == find(y)}
    got = {(r.entry_a, r.entry_b) for r in similar.group_pairs(similar.groups(man, abst)).collect()}
    assert got == want and want
    assert similar.groups(man.limit(0), abst.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in similar.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# ---- problem 8 -----------------------------------------------------------------------------

STOCK = {
    "en": ["the sessions lasted {} minutes and were separated by a day", "each of the animals received active exposure and sham in random order", "we recorded the response for {} seconds before and after each train"],
    "de": ["jede sitzung dauerte {} minuten und wurde nach einer pause wiederholt", "die sonde wurde mit gel an die haut gekoppelt und nicht bewegt", "es gab keinen unterschied zwischen den beiden gruppen der tiere"],
    "fr": ["chaque séance durait {} minutes et était suivie d'une pause", "la sonde était placée sur la peau avec du gel pour la mesure", "il n'y avait aucune différence entre les groupes avant le traitement"],
    "ru": ["каждый сеанс длился {} минут и повторялся после перерыва", "датчик помещали над корой и соединяли с кожей гелем", "между группами не было различий ни до ни после воздействия"],
    "zh": ["每次治疗持续{}分钟，间隔后重复进行", "探头放置在皮层上方，用凝胶与皮肤耦合", "治疗前后两组之间都没有差异"],
}


def sentence(rnd, lang):
    s = rnd.choice(STOCK[lang]).format(rnd.randint(2, 90))
    return s[0].upper() + s[1:] + ("。" if lang == "zh" else ".")


def test_languages(spark):
    rnd = random.Random(9)
    data, truth = [], {}
    for i in range(400):
        langs = rnd.choices(list(STOCK), k=rnd.choice([1, 1, 1, 2]))
        body = " ".join(" ".join(sentence(rnd, x) for _ in range(3)) for x in langs)
        label = langs[0] if rnd.random() > 0.1 else rnd.choice(list(STOCK))
        truth[i] = set(langs)
        data.append((i, body, rnd.choice([label, label.upper(), f"{label}-XA"]), "x"))
    data += [(900, None, None, None), (901, "", "en", None), (902, "300 | 5 | 20\n400 | 7 | 30", "xx", None), (903, "(duty cycle)", None, None), (904, "=" * 5000, "", None), (905, sentence(rnd, "de").upper(), "de_xb", None), (906, sentence(rnd, "de").replace("sitzung", "sit-\nzung"), "?", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, extra string")
    segs = language.segments(docs)
    got = {}
    for r in segs.collect():
        got.setdefault(r.doc_id, set()).add(r.lang)
        assert 0 <= r.confidence <= 1 and r.n_chars > 0
    assert sum(got.get(i) == t for i, t in truth.items()) >= 0.98 * len(truth)  # accuracy against the planted languages
    assert not set(got) & {900, 901, 902, 903, 904} and got[905] == got[906] == {"de"}
    odd = {(r.doc_id, r.lang) for r in language.unnamed(segs, docs).collect()}
    assert (906, "de") in odd and (905, "de") not in odd
    whole = {r.doc_id: r for r in language.documents(segs, docs).collect()}
    assert len(whole) == len(data) and whole[900].lang == "und" and whole[900].confidence == 0
    assert language.segments(docs.limit(0)).count() == 0
    assert language.segments(docs.withColumn("lang", F.lit("xx"))).count() == 0


def test_many_copies_of_one_text_change_nothing(spark):
    """A third of all rows are one text; an address is no sentence."""
    rnd = random.Random(4)
    data = [(i, " ".join(sentence(rnd, x) for _ in range(3)), x, "x") for i in range(300) for x in [rnd.choice(list(STOCK))]]
    hot = [(1000 + i, sentence(rnd, "de") if i == 0 else None, "de", None) for i in range(150)]
    hot = [(i, hot[0][1], lab, e) for i, _, lab, e in hot]
    data += [(2000, f"https://example.org/papers/item?id=42&lang=the-sessions-lasted\n{data[0][1]}", data[0][2], None), (2001, "see www.example.org/the/sessions/lasted/and/were/separated or mail the.sessions.lasted@example.org", None, None)]
    docs = spark.createDataFrame(data + hot, "doc_id long, text string, lang string, extra string")
    segs = language.segments(docs)
    assert language.unnamed(segs, docs).where("doc_id < 1000 or doc_id >= 2000").count() == 0
    assert {r.lang for r in segs.where("doc_id between 1000 and 1999").collect()} == {"de"}


def test_long_rows_train_too(spark):
    rnd = random.Random(6)
    data = [(i, " ".join(sentence(rnd, "fr") for _ in range(3)), "fr") for i in range(60)] + [(100 + i, " ".join(sentence(rnd, "ru") for _ in range(600)), "ru") for i in range(3)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    assert {r.lang for r in language.segments(docs).where("doc_id >= 100").collect()} == {"ru"}


def test_calibration_rejects_what_is_far_from_all():
    rnd = random.Random(7)
    words = {x: [w for s in STOCK[x] for w in s.replace("{}", "").split()] for x in ("en", "de", "fr", "ru")}
    mixed = lambda x: " ".join(rnd.choices(words[x], k=9)).capitalize() + "."
    m = language.fit([(mixed(x), language.LANGUAGES.index(x)) for x in words for _ in range(200)])
    told = m.decide([s for x in words for _, s in language.sentences(mixed(x))] + ["xkq vrtz plmw qqzr bnmt hjkl wrtp zzkw"])
    assert [language.LANGUAGES[y] if y >= 0 else None for y, _ in told] == [*words, None]
    assert all(0 < c <= 1 for _, c in told)


def test_labels(spark):
    cases = {"en": "en", "EN": "en", "de-XA": "de", "pt_br": "pt", "eng": None, "xx": None, "": None, " en": None, None: None, "en-": None}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", language.labelled(F.col("t")).alias("y"))
    assert {r.t: r.y for r in df.collect()} == cases


def test_model_probabilities_sum_to_one():
    m = language.Models([["the cat sat on the mat", "a dog"], ["le chat est la"]], order=3)
    # After every context the probabilities of the characters add up to one.
    one = np.exp(m.logp[0][:, 0].astype(float))
    assert abs(one.sum() + one.min() - 1) < 1e-5  # what is left is one unseen character's
    codes, _ = language._codes(["the cat sat on the mat", "a dog"])
    by_hash = {int(h): int(c) for h, c in zip(language._grams(codes, 1), codes)}
    pairs = {}
    for a in by_hash.values():
        for b in by_hash.values():
            pairs[int(language._grams(np.array([a, b], np.uint64), 2)[0])] = a
    total = {}
    for h, lp in zip(m.keys[1].tolist(), m.logp[1][:, 0]):
        if h in pairs:
            total[pairs[h]] = total.get(pairs[h], 0) + np.exp(lp)
    assert all(t < 1.02 for t in total.values())
    assert m.entropy(["the cat sat"])[0].argmin() == 0 and m.entropy(["le chat est"])[0].argmin() == 1
