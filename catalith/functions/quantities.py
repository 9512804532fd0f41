"""Column expressions for amounts written as text: number notations, currencies, measuring units."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A number as written: groups of three parted by point, comma, apostrophe, no-break or narrow space, or a plain number with an optional fraction.
NUMBER = r"(?<![\p{L}\d])(?:\d{1,3}(?:[.,'’\x{00A0}\x{202F}]\d{3})+(?:[.,]\d{1,2})?(?!\d)|\d+(?:[.,]\d+)?)"

# How currencies are written next to an amount (code, minor unit or not).
CURRENCY_ALIASES = [
    ("$", "USD", False), ("us$", "USD", False), ("ca$", "CAD", False), ("c$", "CAD", False), ("a$", "AUD", False), ("au$", "AUD", False),
    ("€", "EUR", False), ("euro", "EUR", False), ("euros", "EUR", False), ("£", "GBP", False), ("¥", "JPY", False),
    ("kr", "SEK", False), ("kč", "CZK", False), ("zł", "PLN", False), ("fr", "CHF", False),
    ("usd", "USD", False), ("eur", "EUR", False), ("gbp", "GBP", False), ("cad", "CAD", False), ("aud", "AUD", False),
    ("chf", "CHF", False), ("sek", "SEK", False), ("czk", "CZK", False), ("pln", "PLN", False), ("jpy", "JPY", False),
    ("p", "GBP", True), ("cent", None, True), ("cents", None, True), ("ct", None, True), ("¢", "USD", True),
]

# Spellings of measuring units, without blanks, points and apostrophes (alias, unit of the reference table).
UNIT_ALIASES = [
    ("ug", "ug"), ("µg", "ug"), ("μg", "ug"), ("mcg", "ug"), ("microgram", "ug"), ("micrograms", "ug"), ("microgramme", "ug"), ("microgrammes", "ug"), ("microgramo", "ug"), ("microgramos", "ug"), ("mikrogramm", "ug"),
    ("mg", "mg"), ("milligram", "mg"), ("milligrams", "mg"), ("milligramme", "mg"), ("milligrammes", "mg"), ("miligramo", "mg"), ("miligramos", "mg"), ("milligramm", "mg"),
    ("g", "g"), ("gm", "g"), ("gr", "g"), ("gram", "g"), ("grams", "g"), ("gramme", "g"), ("grammes", "g"), ("gramo", "g"), ("gramos", "g"), ("gramm", "g"),
    ("kg", "kg"), ("kilogram", "kg"), ("kilograms", "kg"), ("oz", "oz"), ("ounce", "oz"), ("ounces", "oz"),
    ("iu", "iu"), ("ui", "iu"), ("ie", "iu"),
    ("kcal", "kcal"), ("kj", "kj"), ("j", "j"), ("joule", "j"), ("joules", "j"),
    ("cfu", "cfu"),
    ("million cfu", "million cfu"), ("millions cfu", "million cfu"), ("millionen cfu", "million cfu"), ("mio cfu", "million cfu"), ("millón cfu", "million cfu"), ("millones cfu", "million cfu"), ("m cfu", "million cfu"), ("x10^6 cfu", "million cfu"),
    ("billion cfu", "billion cfu"), ("billions cfu", "billion cfu"), ("b cfu", "billion cfu"), ("bn cfu", "billion cfu"), ("milliard cfu", "billion cfu"), ("milliards cfu", "billion cfu"), ("milliarden cfu", "billion cfu"), ("mrd cfu", "billion cfu"), ("milmillones cfu", "billion cfu"), ("x10^9 cfu", "billion cfu"),
]

_CELLS = r"(?:(?:[x×]\s*10\s*(?:\^\s*[69]|[⁶⁹])|mil\s+millones|billions?|bn|b|milliarden|milliards?|mrd\.?|millionen|millions?|mio\.?|millones|millón|m)\s*)?(?:de\s+|d['’]\s*)?(?:cfu|ufc|kbe)"
_PLAIN = r"microgrammes?|micrograms?|microgramos?|mikrogramm|milligrammes?|milligrams?|miligramos?|milligramm|kilograms?|grammes?|grams?|gramos?|gramm|[µμ]g|mcg|ug|mg|kg|gm|gr|g|ounces?|oz|kcal|kj|joules?|j|i\.?u\.?|u\.?i\.?|i\.?e\.?"
#: An amount with its unit, in lower-case text.
AMOUNT = f"{NUMBER}[\\s\\x{{00A0}}\\x{{202F}}]*(?:{_CELLS}|{_PLAIN})(?![\\p{{L}}\\d])"

_BEFORE = r"us\$|ca\$|au\$|a\$|c\$|[$€£¥]|usd|eur|gbp|cad|aud|chf|sek|czk|pln|jpy"
_AFTER = r"[$€£¥¢]|kr|kč|zł|fr|euros?|usd|eur|gbp|cad|aud|chf|sek|czk|pln|jpy|cents?|ct|p"
_BLANK = r"[\s\x{00A0}\x{202F}]*"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, with `value` computed once however often `body` uses it."""
    return F.transform(F.array(value), body)[0]


def number(text: Column) -> Column:
    """Decimal value of a number matched by NUMBER, or null. A single group of three digits after a leading digit other than 0 is a thousands group."""
    return bind(
        F.regexp_replace(text, r"[\s'’\x{00A0}\x{202F}]", ""),
        lambda t: (
            F.when(t.rlike(r"^\d*$"), t)
            .when(t.rlike(r"^\d{1,3}(\.\d{3})+,\d+$"), F.translate(t, ",.", "."))
            .when(t.rlike(r"^\d{1,3}(,\d{3})+\.\d+$"), F.translate(t, ",", ""))
            .when(t.rlike(r"^[1-9]\d{0,2}([.,]\d{3})+$"), F.translate(t, ".,", ""))
            .otherwise(F.translate(t, ",", "."))
        ),
    ).try_cast("decimal(26,6)")


def asked_price(text: Column) -> Column:
    """The part of a price text that starts at the price now asked, in lower case: after a word announcing it, else the whole text."""
    words = r"(?:sale price|\bnow\b|\bnur\b|\bjetzt\b|\bahora\b|\bmaintenant\b)"
    return bind(F.lower(text), lambda low: F.when(low.rlike(words), F.regexp_replace(low, rf"(?s)^.*?{words}(?=.*\d)", "")).otherwise(low))


def price_parts(text: Column) -> Column:
    """struct(amount decimal, unit string, minor boolean) of the price now asked; null where the text states no amount.

    The unit is the alias written before or after the amount ('' where there is none); minor is true for an amount in hundredths.
    """

    def parts(part: Column) -> Column:
        before = F.regexp_extract(part, f"^[^\\d]*?({_BEFORE}){_BLANK}(?=\\d)", 1)
        after = F.regexp_extract(part, f"^[^\\d]*{NUMBER}{_BLANK}({_AFTER})(?![\\p{{L}}\\d])", 1)
        amount = number(F.regexp_extract(part, NUMBER, 0))
        return bind(
            F.struct(before.alias("before"), after.alias("after"), amount.alias("amount")),
            lambda x: F.when(
                x["amount"].isNotNull(),
                F.struct(x["amount"].alias("amount"), F.when(x["before"] != "", x["before"]).otherwise(x["after"]).alias("unit"), ((x["before"] == "") & x["after"].isin("p", "cent", "cents", "ct", "¢")).alias("minor")),
            ),
        )

    return F.when(text.rlike(r"\d"), bind(asked_price(text), parts))


def price_amount(text: Column) -> Column:
    """Amount of a price text in major units, or null where it states none."""
    return bind(price_parts(text), lambda p: F.when(p["minor"], p["amount"] / F.lit(100).cast("decimal(3,0)")).otherwise(p["amount"])).cast("decimal(18,4)")


def unit_key(unit: Column) -> Column:
    """Spelling of a unit as UNIT_ALIASES has it."""
    t = F.regexp_replace(F.lower(unit), r"\b(?:de\s+|d['’]\s*)(?=cfu|ufc|kbe)", "")
    t = F.regexp_replace(t, r"[\s.'’\x{00A0}\x{202F}]", "")
    t = F.translate(t, "×⁶⁹", "x69")
    t = F.regexp_replace(t, r"^x10\^?([69])", "x10^$1")
    return F.trim(F.regexp_replace(t, r"(?:cfu|ufc|kbe)$", " cfu"))
