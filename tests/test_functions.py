"""Scalar functions, look-alike folding, units and edit metrics."""

import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from strandline.functions import fuzzy, labtext, numbers, text
from strandline.functions.lookalike import fold, unify
from strandline.functions.units import parse_unit, to_common


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "want"), [("a  b\n c ", "a b c"), ("", ""), ("x　y", "x y")])
def test_squash_takes_no_break_spaces(spark, raw, want):
    assert one(spark, text.squash(F.col("a")), a=raw) == want


def test_slug_collapses_cuts_and_defaults(spark):
    assert one(spark, text.slug(F.col("a")), a="Patient #1 (II-3)") == "Patient_1_II_3"
    assert one(spark, text.slug(F.col("a")), a="***") == "individual"
    assert len(one(spark, text.slug(F.col("a")), a="x" * 90)) == 40


def test_spell_keeps_its_order_of_rules(spark):
    assert one(spark, text.spell(F.col("a")), a="Haemolytic anaemia type IV") == "hemolytic anemia type 4"
    assert one(spark, text.spell(F.col("a")), a="propionic acidaemia") == "propionic acidemia"
    assert one(spark, text.spell(F.col("a")), a="methylmalonic aciduria") == "methylmalonic acidemia"
    assert one(spark, text.spell(F.col("a")), a="deficiency of X oxidase") == "x oxidase deficiency"


def test_variant_keys_collide_where_signs_are_dropped(spark):
    k = text.variant_key(F.col("g"), F.col("v"))
    assert one(spark, k, g="pah", v="c.100+1G>A") == one(spark, k, g="PAH", v="c.1001G>A") == "PAH:c1001g>a"


def test_stereo_and_terms(spark):
    assert one(spark, text.strip_stereo(F.col("a")), a="(S)-3-hydroxy<sub>2</sub>") == "3-hydroxy2"
    assert one(spark, text.clean_term(F.col("a")), a="Some disease (type 1)") == "Some disease"
    assert one(spark, text.clean_term(F.col("a")), a="PKU1") is None


def test_ages_and_years(spark):
    assert one(spark, numbers.age_days(F.col("a")), a="P1Y2M3W4D") == pytest.approx(365.25 + 60.88 + 21 + 4)
    assert one(spark, numbers.age_days(F.col("a")), a="P") is None
    assert one(spark, numbers.age_days(F.col("a")), a="2 years") is None
    assert one(spark, numbers.birth_year(F.col("y").cast("int"), F.col("a")), y="2000", a="P10Y6M") == 1989
    assert one(spark, numbers.birth_year(F.col("y").cast("int"), F.col("a")), y="0", a="P10Y") is None
    assert one(spark, numbers.half_even(F.col("a").cast("double")), a="2.5") == 2


def test_publication_dates(spark):
    d = numbers.publication_date(F.col("y"), F.col("m"), F.col("d"), F.col("f"))
    assert one(spark, d, y="1999", m="Mar", d="7", f=None) == "1999-03-07"
    assert one(spark, d, y="1999", m=None, d=None, f=None) == "1999-01-01"
    assert one(spark, d, y=None, m=None, d=None, f="1998 Winter") == "1998"


@pytest.mark.parametrize(("raw", "want"), [
    ("ｔｙｐｅ", "type"), ("é", "é"), ("a​b", "ab"), ("a b", "a b"), ("a‑b", "a-b"), ("cаrn", "carn"), ("ﬁne", "fine"), ("Κ15", "K15"), ("Ⅳ", "IV"),
])
def test_fold_changes_lookalikes(raw, want):
    assert fold(raw) == want


@pytest.mark.parametrize("raw", ["mg L⁻¹", "10–20", "“x”", "слово", "α-form", "µmol/L", "μmol/L", "Ångström", "", "x" * 10])
def test_fold_leaves_other_signs(raw):
    assert fold(raw) == raw


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_fold_is_idempotent(s):
    assert fold(fold(s)) == fold(s)
    assert unify(unify(s)) == unify(s)


@pytest.mark.parametrize(("a", "b"), [("µmol/L", "umol/l"), ("mg%", "mg/dL"), ("mcg/mg Cr", "mg/g{creat}"), ("K/µL", "10*9/L"), ("nmol mL⁻¹", "uM"), ("U/mL", "kU/L"), ("Torr", "mm[Hg]"), ("per mm3", "/uL")])
def test_unit_spellings_agree(a, b):
    assert parse_unit(a) == pytest.approx(parse_unit(b)) if not isinstance(parse_unit(a), tuple) else (parse_unit(a)[0] == parse_unit(b)[0] and parse_unit(a)[1] == pytest.approx(parse_unit(b)[1]))


@pytest.mark.parametrize("raw", ["", "n/a", "units", "see text", "?", "g", "creatinine", "mg/day/x"])
def test_no_unit(raw):
    assert parse_unit(raw) is None


def test_conversions():
    assert to_common(1.0, parse_unit("mg/dL"), "umol/L", 100.0, 113.12) == pytest.approx(100.0)
    assert to_common(2.0, parse_unit("ukat/L"), "U/L", None, 113.12) == pytest.approx(120.0)
    assert to_common(1.0, parse_unit("mg/g creatinine"), "umol/L", 100.0, 113.12) == pytest.approx(1.1312)
    assert to_common(1.0, parse_unit("kPa"), "umol/L", 100.0, 113.12) is None


def slow_edit(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[len(b)]


def slow_lcs(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
    return d[-1][-1]


def test_bit_parallel_metrics_equal_plain_ones():
    r = random.Random(1)
    for _ in range(500):
        a, b = ("".join(r.choice("abcd") for _ in range(r.randint(0, 75))) for _ in range(2))
        assert fuzzy.levenshtein(a, b) == slow_edit(a, b)
        assert fuzzy.indel_ratio(a, b) == pytest.approx(200 * slow_lcs(a, b) / (len(a) + len(b)) if a + b else 100)


def test_damerau_is_a_metric_with_swaps():
    assert fuzzy.damerau("ca", "abc") == 2
    assert fuzzy.damerau("abcd", "abdc") == 1
    r = random.Random(2)
    words = ["".join(r.choice("ab") for _ in range(r.randint(0, 6))) for _ in range(40)]
    for a in words[:12]:
        for b in words[:12]:
            for c in words[:12]:
                assert fuzzy.damerau(a, c) <= fuzzy.damerau(a, b) + fuzzy.damerau(b, c)


def test_ratios_with_a_cutoff_lose_nothing_above_it():
    r = random.Random(3)
    for _ in range(400):
        a, b = (" ".join("".join(r.choice("abcde") for _ in range(r.randint(1, 7))) for _ in range(r.randint(1, 3))) for _ in range(2))
        whole, cut = fuzzy.weighted_ratio(a, b), fuzzy.weighted_ratio(a, b, 80.0)
        if whole >= 80:
            assert cut == pytest.approx(whole)
        else:
            assert cut < 80


def test_analyte_peeling():
    p = labtext.parse_analyte("plasma L-X-acid level (fasting) [µmol/L]")
    assert (p.core, p.unit, p.composite) == ("L-X-acid", "µmol/L", False)
    assert labtext.parse_analyte("A acid/B acid ratio").composite
    assert labtext.parse_analyte("A acid + B acid (sum)").composite
    assert labtext.parse_analyte("").core == ""
    assert labtext.parse_disease("Severe X type-2 (OMIM 123456), neonatal form") == ("X type 2", "123456")


def test_numbers_as_text_and_binary_rounding(spark):
    import random

    from strandline.functions import numbers

    r = random.Random(4)
    values = [0.0, -0.5, 2.675, 1.005, 0.0625, 0.1875, 2.5, 12.0, 1e-4, 9.9e-5, 1.5e-7, 1e7, 123456789.125, 1e15, 1e16, 3e22, -7.25e-9, *(r.uniform(-10, 10) for _ in range(300)), *(r.randint(0, 999) / r.randint(1, 999) for _ in range(300)), *(r.randint(-99999, 99999) / 2000 for _ in range(300))]
    from pyspark.sql import functions as F

    x = spark.createDataFrame([(v,) for v in values], "v double").select("v", numbers.shortest(F.col("v")).alias("s"), *[numbers.round_binary(F.col("v"), n).alias(f"r{n}") for n in (2, 3)]).collect()
    assert [(a.v, a.s) for a in x if a.s != repr(a.v)] == []
    assert [(a.v, a.r2, a.r3) for a in x if abs(a.v) < 1e12 and (a.r2, a.r3) != (round(a.v, 2), round(a.v, 3))] == []
