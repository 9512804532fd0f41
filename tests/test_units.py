from decimal import Decimal as D

import pytest

from catalith.operators import units
from tests.conftest import rows

RATES = [("USD", 2, D("1")), ("EUR", 2, D("1.0873")), ("GBP", 2, D("1.2641")), ("AUD", 2, D("0.6532")), ("JPY", 0, D("0.00664")), ("CZK", 2, D("0.0431")), ("SEK", 2, D("0.0947")), ("CHF", 2, D("1.1215"))]
UNITS = [("ug", "mass", None, "1"), ("mg", "mass", None, "1000"), ("g", "mass", None, "1000000"), ("oz", "mass", None, "28349523.125"), ("iu", "mass", "Vitamin D3", "0.025"), ("iu", "mass", "Vitamin A", "0.3"), ("iu", "mass", "Vitamin E", "670"), ("j", "energy", None, "1"), ("kj", "energy", None, "1000"), ("kcal", "energy", None, "4184"), ("cfu", "cells", None, "1"), ("million cfu", "cells", None, "1000000"), ("billion cfu", "cells", None, "1000000000")]
PRICES = [
    ("$31.06", "AUD", 2029), ("$12.78", None, 1278), ("$12.78", "", 1278), ("A$ 57.40 - you save A$8.20", None, 3749), ("28,30 €", " EUR ", 3077), ("EUR 1 057,25", "eur", 114955), ("1.434,27 Kč", None, 6182), ("statt 1.864,62 Kč nur 1.434,27 Kč", "", 6182),
    ("Regular price $62.45 Sale price $47.99", "USD", 4799), ("Now $34.13 (was $ 44.43)", "USD", 3413), ("antes 29,95€ ahora 22,99€", None, 2500), ("22,95€ au lieu de 30,00€", None, 2495), ("$9.90 ($1.41 / 100 g)", "USD", 990), ("¥4,052", None, 2691), ("JPY 8481", "JPY", 5631),
    ("2999 cents", "EUR", 3261), ("1495¢", "USD", 1495), ("1599p", "GBP", 2021), ("1'110.02\xa0Fr.", None, 124489), ("488\xa0kr", "SEK", 4621), ("27.14", "£", 3431), ("27.14", None, None), ("Sold out", "USD", None), ("", "USD", None), (None, "USD", None), ("-", None, None), ("5 XYZ", "ZZZ", None),
]


def test_prices(spark):
    rates = spark.createDataFrame(RATES, "currency_code string, minor_digits int, usd_per_unit decimal(12,6)")
    data = [(i, p, c, "x", 1) for i, (p, c, _) in enumerate(PRICES)]
    got = dict(rows(units.prices_in_cents(spark.createDataFrame(data, "output_id bigint, price string, currency string, code string, alias int"), rates)))
    assert got == {i: q for i, (_, _, q) in enumerate(PRICES) if q is not None}


def test_usual_currency_of_a_site(spark):
    rates = spark.createDataFrame(RATES, "currency_code string, minor_digits int, usd_per_unit decimal(12,6)")
    listings = spark.createDataFrame([(1, "10", None, "a"), (2, "10", None, "b")], "output_id bigint, price string, currency string, domain string")
    usual = spark.createDataFrame([("a", "GBP")], "site string, default_currency string")
    assert rows(units.prices_in_cents(listings, rates, source_default=usual)) == [(1, 1264)]


def test_usual_currencies_are_mined_from_all_rows(spark):
    data = [("WWW.a.example ", "£3", None), ("a.example", "4", "gbp"), ("a.example", "4", "EUR"), ("b.example", "5 EUR", ""), ("b.example", "$6", None), ("c.example", "7", None), (None, "$8", None), ("d.example", None, "EUR")]
    df = spark.createDataFrame(data, "domain string, price string, currency string")
    assert rows(units.usual_currencies(df)) == [("a.example", "GBP"), ("b.example", "EUR")]
    assert units.usual_currencies(df.limit(0)).collect() == []


def test_offsets(spark):
    ref = spark.createDataFrame([("mg", "mass", None, D(1000), D(5)), ("g", "mass", None, D(10**6), None)], "unit string, dimension string, substance string, base_per_unit decimal(20,6), base_offset decimal(20,6)")
    df = spark.createDataFrame([(1, "2 mg, 3 g")], "record_id bigint, facts string")
    assert rows(units.amounts_in_base_units(df, ref, "record_id", "facts")) == [(1, 1, 2005, "ug"), (1, 2, 3 * 10**6, "ug")]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Serving Size 1 pack (0.5 oz)\nEnergy: 24 kJ\nVitamin B12 1 milligrams 80%", [(14174762, "ug"), (24000, "joule"), (1000, "ug")]),
        ("Vitamin B6 10\xa0000 mcg | 795%\r\nIron 0,225mg\r\nZinc 2,000 mg", [(10000, "ug"), (225, "ug"), (2000000, "ug")]),
        ("Facts • Energy 58 kcal • Lactase ........ 200 MG • Papain (86%) 1.3g", [(242672, "joule"), (200000, "ug"), (1300000, "ug")]),
        ("Vitamin A (as Retinyl Palmitate) 3,000 I.U.; Vitamine E 400 UI; Vitamina D3 (como x)\t1000IU; Zinc 10 IU", [(900, "ug"), (268000, "ug"), (25, "ug")]),
        ("L 5 x 10^9 UFC; B 15×10⁹ CFU; S 5B CFU; M 2 Mrd. KBE; N 2000 millones de UFC; P 5 milliards d'UFC; Q 10000 million CFU", [(5 * 10**9, "cfu"), (15 * 10**9, "cfu"), (5 * 10**9, "cfu"), (2 * 10**9, "cfu"), (2 * 10**9, "cfu"), (5 * 10**9, "cfu"), (10**10, "cfu")]),
        ("Servings 30, 90 % and 5 tablets; μ 60 μg; m 75 µg", [(60, "ug"), (75, "ug")]),
        ("", []), ("no digits", []), ("Coenzyme Q10 200 mg B12 0.5 g", [(200000, "ug"), (500000, "ug")]),
    ],
)
def test_amounts(spark, text, expected):
    ref = spark.createDataFrame([(u, d, s, D(f)) for u, d, s, f in UNITS], "unit string, dimension string, substance string, base_per_unit decimal(20,6)")
    df = spark.createDataFrame([(7, text, "x"), (8, None, "y")], "record_id bigint, facts string, unit string")
    got = rows(units.amounts_in_base_units(df, ref, "record_id", "facts"))
    assert got == [(7, i + 1, q, u) for i, (q, u) in enumerate(expected)]


def test_very_long_text(spark):
    ref = spark.createDataFrame([(u, d, s, D(f)) for u, d, s, f in UNITS], "unit string, dimension string, substance string, base_per_unit decimal(20,6)")
    df = spark.createDataFrame([(1, "Zinc 5 mg\n" * 20000)], "record_id bigint, facts string")
    assert units.amounts_in_base_units(df, ref, "record_id", "facts").count() == 20000
