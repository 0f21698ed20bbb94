import difflib
import random

from pyspark.sql import functions as F

from strandline.operators import documents, identity


def test_resolver_order(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (3,)], "e int")
    a = spark.createDataFrame([(1, "x"), (1, "w"), (2, None)], "e int, key string")
    b = spark.createDataFrame([(1, "z"), (2, "y")], "e int, key string")
    got = {r.e: (r.key, r.resolver) for r in identity.by_priority(df, "e", [("a", a), ("b", b)]).collect()}
    assert got == {1: ("w", "a"), 2: ("y", "b"), 3: (None, "unresolved")}


def test_candidates(spark):
    df = spark.createDataFrame([(1, 0, "a", False), (1, 1, "b", True), (1, 2, "c", True), (2, 0, "d", None)], "i int, pos int, k string, ok boolean")
    got = {r.i: (r.k, r.unverified) for r in identity.first_verified(df, "i", F.col("ok"), "pos").collect()}
    assert got == {1: ("b", False), 2: ("d", True)}
    for rows in ([(1, 1.0, 1930, 1929, 1), (1, 1.0, 1929, 1929, 7)], [(1, 1.0, 1929, 1929, 7), (1, 1.0, 1930, 1929, 1)]):
        c = spark.createDataFrame(rows, "i int, score double, year int, want int, pages int")
        assert identity.best_candidate(c, "i", "score", "year", "want", "pages").first().year == 1929


def test_key_repair(spark):
    wrong = spark.createDataFrame([("10.99/abcdefghijklmnoq-123456",), ("10.99/zzz-777777",), (None,)], "k string")
    known = spark.createDataFrame([("10.99/abcdefghijklmnop-123456",), ("10.99/zzy-777777",), ("10.99/zyz-777777",)], "k string")
    got = identity.repaired(wrong.where("k is not null"), known, "k", F.regexp_extract("k", r"([0-9]{5,})$", 1))
    assert [(r.k, r.repaired) for r in got.collect()] == [("10.99/abcdefghijklmnoq-123456", "10.99/abcdefghijklmnop-123456")]


def test_key_repair_compares_all(spark):
    # Edits in the final digits, a short digit run, a rival in the final digits, a judged key.
    wrong = ["10.1186/s13089-2016-0044-x", "10.99/abcdefghijklmnop-123457", "10.98/abcdefghijklmnop-123456", "10.97/abcdefghijklmnop-12345", "10.97/abcdefghijklmnop-123455", ""]
    known = ["10.1186/s13089-016-0044-x", "10.99/abcdefghijklmnop-123456", "10.98/abcdefghijklmnop-123455", "10.98/abcdefghijklmnoq-123456", "10.97/abcdefghijklmnop-123455", "10.97/abcdefghijklmnop-123345", "ab"]
    frame = lambda ks: spark.createDataFrame([(k,) for k in ks], "k string")
    got = {r.k: r.repaired for r in identity.repaired(frame(wrong), frame(known), "k").collect()}
    assert got == {"10.1186/s13089-2016-0044-x": "10.1186/s13089-016-0044-x", "10.99/abcdefghijklmnop-123457": "10.99/abcdefghijklmnop-123456", "10.97/abcdefghijklmnop-12345": "10.97/abcdefghijklmnop-123345"}


def test_key_repair_by_brute_force(spark):
    rng = random.Random(3)
    known = sorted({"".join(rng.choice("ab0") for _ in range(rng.choice((3, 9, 12, 20, 27, 33, 41, 60, 110)))) for _ in range(60)})
    wrong = []
    for k in known * 4:
        for _ in range(rng.randint(1, max(1, len(k) // 9))):
            at = rng.randrange(len(k) + 1)
            k = k[:at] + rng.choice(("", "x", "b")) + k[at + rng.randint(0, 1) :]
        wrong.append(k)
    near = lambda w: [k for k in set(known) - set(wrong) if difflib.SequenceMatcher(None, k, w).ratio() >= 0.95]
    want = {w: near(w)[0] for w in set(wrong) - set(known) if len(near(w)) == 1}
    frame = lambda ks: spark.createDataFrame([(k,) for k in ks], "k string")
    assert len(want) > 50 and {r.k: r.repaired for r in identity.repaired(frame(wrong), frame(known), "k").collect()} == want


def test_links_flags_and_seeds(spark):
    p = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "a"), (None, "b"), ("a", "b")], "src string, dst string")
    assert {(r.src, r.dst): r.status for r in identity.version_links(p, e).collect()} == {("a", "b"): "merge", ("a", "c"): "missing", ("a", "a"): "self"}
    f = spark.createDataFrame([(["x", "y"], ["y"], ["b", "x"]), (None, None, None)], "a array<string>, s array<string>, n array<string>")
    assert [r.x for r in f.select(identity.updated_flags(F.col("a"), F.col("s"), F.col("n")).alias("x")).collect()] == [["b", "x"], []]
    s = [spark.createDataFrame([("k", 5), ("m", 1)], "k string, o int"), spark.createDataFrame([("k", 0), ("n", 2), (None, 1)], "k string, o int")]
    assert {r.k: (r.source_no, r.pos) for r in identity.seeds(s, "k", "o").collect()} == {"k": (0, 5), "m": (0, 1), "n": (1, 2)}


def test_pages(spark):
    rows = [("a", 0, 1, "p0"), ("a", 2, 3, "z"), ("a", 2, 2, "p2\u00ad"), ("a", 5, 4, "far"), ("a", 2, 9, None), ("a", None, 0, "first"), (None, 1, 1, "x"), ("b", 7, 1, ""), ("c", -1, 1, "c")]
    df = spark.createDataFrame(rows, "k string, n int, o int, t string")
    whole = "first\n\np0\n\f\n\fp2\n\nz\n\f\n\f\n\ffar\n"
    for chunk in (1, 2, 3, 100):
        got = documents.assemble(df, "k", "n", "o", "t", chunk).orderBy("k", "chunk_no").collect()
        text = {k: "\f".join(r.text for r in got if r.k == k) for k in ("a", "c")}
        assert text == {"a": whole, "c": "c\n"} and {r.k for r in got} == {"a", "c"}
        assert sum(r.n_pages for r in got if r.k == "a") == 6
    two = spark.createDataFrame([("d", 0, 1, "x"), ("d", 2, 2, "y")], "k string, n int, o int, t string")
    assert documents.assemble(two, "k", "n", "o", "t").first().text == "x\n\f\n\fy\n"  # the middle page a bare line feed
    back = documents.pages_of(spark.createDataFrame([(1, "a\fb\fc"), (2, None)], "i int, t string"), "i", "t", 2).collect()
    assert [(r.page_no, r.text) for r in back] == [(0, "a"), (1, "b")]


def test_rendered_blocks(spark):
    names = "type text text_level list_items table_caption table_body table_footnote image_caption image_footnote content".split()
    kind = "type string, text string, text_level int, list_items array<string>, table_caption array<string>, table_body string, table_footnote array<string>, image_caption array<string>, image_footnote array<string>, content string"
    cases = [
        (dict(type="text", text=" One "), 0, "One"), (dict(type="text", text="Head", text_level=1), 3, "## Head"), (dict(type="text", text="Deep", text_level=9), 3, "###### Deep"), (dict(type="text"), 0, ""),
        (dict(type="list", list_items=[" a ", "", "b"]), 0, "a\nb"), (dict(type="list", text="t"), 0, "t"), (dict(type="table", table_caption=["T1", " "], table_body=" <t> ", table_footnote=["n"]), 0, "T1\n\n<t>\n\nn"),
        (dict(type="image", image_caption=["F1"], content="c"), 0, "F1\n\nc"), (dict(type="header", text="Journal"), 0, "Journal"), (dict(type="header", text="Journal"), 1, ""),
        (dict(type="footer", text="10.1234/x"), 4, "10.1234/x"), (dict(type="page_number", text="7"), 0, ""), (dict(type="page_footnote", text="n"), 2, "n"),
    ]
    df = spark.createDataFrame([(tuple(c.get(n) for n in names), p, w) for c, p, w in cases], f"b struct<{kind.replace(' string', ':string').replace(' int', ':int').replace(' array', ':array')}>, p int, w string")
    assert all(r.got == r.w for r in df.select("w", documents.rendered(F.col("b"), F.col("p")).alias("got")).collect())


def test_quality(spark):
    good = "# One\n" + "1.1 First part of it\n" + "word " * 200 + "\n1.2 Second part"
    df = spark.createDataFrame([(good,), (good.replace("1.2 S", "1.0 S"),), ("short",), (None,), ("word " * 200,)], "t string")
    assert [r.w for r in df.select(documents.quality(F.col("t")).alias("w")).collect()] == [[], ["section_order"], ["too_short"], ["too_short"], ["no_headings"]]


def test_inverted_index(spark):
    from strandline.functions import text

    df = spark.createDataFrame([(1, " b  a b\n"), (2, None), (3, "")], "i int, t string")
    got = {r.i: r.x for r in documents.inverted(df, "i", "t").select("i", text.restore_inverted(F.col("index")).alias("x")).collect()}
    assert got == {1: "b a b", 3: ""}
