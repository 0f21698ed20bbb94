import pytest
from pyspark.sql import functions as F

from strandline.functions import keys, measures as ms, text


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {t}" for k, t in zip(cols, ["string"] * len(cols)))) if cols else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("10.3969/j.issn.1672⁃6731.2022.04.006", "10.3969/j.issn.1672-6731.2022.04.006"),
        ("10.1016/j.brs–2024.04.013", "10.1016/j.brs-2024.04.013"),
        (" 10.1016/J.BRS.2024.04.013). ", "10.1016/j.brs.2024.04.013"),
        ("10.1016/j.brs.2024.04.013received 3 May", "10.1016/j.brs.2024.04.013"),
        ("10.1/x", None),
        ("", None),
        (None, None),
    ],
)
def test_clean_key(spark, raw, want):
    assert one(spark, keys.clean_key(F.col("a")), a=raw) == want


@pytest.mark.parametrize("raw, want", [("10.7554/elife.100827.3.sa2", "10.7554/elife.100827"), ("10.3791/58781-v", "10.3791/58781"), ("10.1016/j.brs.2024.04.013", None)])
def test_parent_key(spark, raw, want):
    assert one(spark, keys.parent_key(F.col("a")), a=raw) == want


def test_pages_years_and_bare_keys(spark):
    assert one(spark, keys.page_span(F.col("a")), a="284-290") == 7
    assert one(spark, keys.page_span(F.col("a")), a="388") == 1
    assert one(spark, keys.page_span(F.col("a")), a="e12") == 0
    assert one(spark, keys.year_in_key(F.col("a")), a="10.99/x.2014.5") == 2014
    assert one(spark, keys.year_in_key(F.col("a")), a="10.99/120145") is None
    assert one(spark, keys.bare_key(F.col("a")), a="https://doi.org/10.99/AbC") == "10.99/abc"
    assert one(spark, keys.find_keys(F.col("a")), a="see 10.99020/dss-1982.9, then 10.99020/DSS-1982.9.") == ["10.99020/dss-1982.9"]


def test_title_agreement(spark):
    t = "A long title about the modulation of cortical rhythms by focused sound"
    agree = text.title_agreement(F.col("a"), F.col("b"), text.similarity_ratio(text.title_key(F.col("a")), text.title_key(F.col("b"))))
    assert one(spark, agree, a=f"Response to: {t}", b=t) == 0
    assert one(spark, agree, a=f"Re: {t}", b=t) == 0
    assert one(spark, agree, a=t.upper(), b=t) == 1
    assert one(spark, agree, a=t[:48], b=t) == 0.97
    assert one(spark, agree, a="Ultrasound", b=t) < 0.5
    assert one(spark, agree, a="", b=t) == -1


def test_usable_embedded_title(spark):
    for junk in ("untitled", "pone.0086939 1..13", "PNAS202206828_proof.pdf", "Using JASA format", "100827", None):
        assert one(spark, text.usable_embedded_title(F.col("a")), a=junk) is None
    assert one(spark, text.usable_embedded_title(F.col("a")), a="Focused sound in the motor cortex")


def test_slugs_and_stems(spark):
    assert one(spark, text.name_slug(F.col("a")), a="Butts Pauly") == "buttspauly"
    assert one(spark, text.name_slug(F.col("a")), a="Jiménez-Gambín") == "jimenezgambin"
    assert one(spark, text.compact_title(F.col("a")), a="The effects of fMRI and EEG on the brain") == "EffectsFMRIEEGBrain"
    assert one(spark, text.compact_title(F.col("a")), a="of the") == "OfThe"
    assert one(spark, text.spaced_title(F.col("a")), a="FocusedSoundBrain") == "Focused Sound Brain"
    assert one(spark, text.surname(F.col("a")), a="Ada B. Lovelace") == "Lovelace"


def test_article_title(spark):
    assert one(spark, text.article_title(F.col("a")), a="Waves in Freely Behaving Rodents (Adv. Sci. 34/2022)").endswith("Rodents")
    assert one(spark, text.article_title(F.col("a")), a="Hippocampal Slices: On-Chip Sound Modulation of Neurons").startswith("On-Chip")


def test_quotes(spark):
    found = text.quote_found(F.col("a"), text.letters_only(F.col("b")))
    body = "Bursts of 500 kHz were given to the left motor cortex of twelve volunteers at rest."
    assert one(spark, text.letters_only(F.col("a")), a=r"$\mathrm{n}=10$") == "n10"
    assert one(spark, text.letters_only(F.col("a")), a="<td>10</td>") == "10"
    assert one(spark, text.letters_only(F.col("a")), a="p < 0.05") == "p005"
    assert one(spark, found, a="500 kHz", b=body) is False
    assert one(spark, found, a="given to the left motor cortex", b=body) is True
    assert one(spark, found, a="Bursts of 500 kHz ... motor cortex", b=body) is True
    assert one(spark, found, a="Bursts of 500 kHz ... rest", b=body) is False
    assert one(spark, found, a="Bursts of 500 kHz were given to the left motor cortXx of", b=body) is True
    assert one(spark, found, a=None, b=body) is False
    assert one(spark, found, a="x" * 30, b=None) is None


def test_sentence_and_markup(spark):
    got = one(spark, text.sentence_around(F.col("a"), "X-100"), a="First one here. We used the X-100 probe at 2.5 MHz. Last.")
    assert got == "We used the X-100 probe at 2.5 MHz."
    assert one(spark, text.sentence_around(F.col("a"), "Y"), a="none here.") is None
    assert one(spark, text.strip_markup(F.col("a")), a="<p>a &amp;lt; b</p>\n c") == "a &lt; b c"
    assert one(spark, text.unescape_html(F.col("a")), a="a &eacute; b") == "a é b"
    assert one(spark, text.clean_abstract(F.col("a")), a="<title>Aim</title> Abstract: We did.") == "We did."
    assert one(spark, text.restore_inverted(F.expr("map('b', array(1, 2), 'a', array(0), 'c', array(2))"))) == "a b c"


def test_measures(spark):
    m = lambda state, vals, is_list: F.expr(f"named_struct('state', {state!r}, 'vals', cast({vals} as array<double>), 'is_list', {is_list})")
    scalar = lambda *a: one(spark, ms.scalar(m(*a)))
    assert scalar("value", "array(5)", "false") == 5
    assert scalar("value", "array(5, 6)", "true") is None
    assert scalar("not_reported", "null", "false") is None
    assert one(spark, ms.any_between(m("value", "array(5, 50)", "true"), 20, 30)) is False
    same = lambda a, b: one(spark, ms.same_value(m("value", a, "true"), m("value", b, "true")))
    assert same("array(100)", "array(102)") and not same("array(100)", "array(103)")
    assert same("array(5, 5)", "array(5)") and same("array(5, 30)", "array(30, 5)") and not same("array(5, 30)", "array(5)")
    assert one(spark, ms.duty_cycle(F.lit(0.5), F.lit(1000.0))) == 50
    assert one(spark, ms.differs(F.lit(50.0), F.lit(50.0))) is False and one(spark, ms.differs(F.lit(50.0), F.lit(55.0))) is True
    assert one(spark, ms.implied_duration(F.lit(50.0), F.lit(1000.0))) == 0.5 and one(spark, ms.implied_duration(F.lit(50.0), F.lit(0.0))) is None
    assert one(spark, ms.intensity_odd(F.lit(300.0), F.lit(3.0))) is False and one(spark, ms.intensity_odd(F.lit(300.0), F.lit(10.0))) is True


def test_variants(spark):
    df = spark.createDataFrame([("5",), ("[5, 6.5]",), ('"not_reported"',), ("null",)], "j string").select(ms.from_variant(F.parse_json("j")).alias("m"))
    got = [(r.m.state, r.m.vals, r.m.is_list) for r in df.collect()]
    assert got == [("value", [5.0], False), ("value", [5.0, 6.5], True), ("not_reported", None, False), ("na", None, False)]
