"""Quantities in different units: prices in US cents, masses, energies and cell counts in one base unit each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions import quantities as Q
from catalith.runtime import bounded_rows, literal_table

_SEGMENT_END = r"[\n\r;•]"


def _site(domain: str) -> Column:
    return F.regexp_replace(F.lower(F.trim(domain)), r"^www\.", "")


def _stated(listings: DataFrame, keep: list[Column | str]) -> DataFrame:
    """Listings with an amount: kept columns, `parts` of the price, and `code`, the currency of the field, else of the text, or null."""
    alias = F.broadcast(literal_table(listings.sparkSession, Q.CURRENCY_ALIASES, "alias string, code string, minor boolean"))
    field = F.regexp_replace(F.lower(F.trim(F.translate("currency", "\xa0", " "))), r"\.$", "")
    rows = listings.filter(F.col("price").isNotNull()).select(*keep, Q.price_parts(F.col("price")).alias("parts"), field.alias("__field")).filter(F.col("parts.amount").isNotNull())
    rows = rows.join(alias.select(F.col("alias").alias("__field"), F.col("code").alias("__field_code")), "__field", "left")
    rows = rows.join(alias.select(F.col("alias").alias("__unit"), F.col("code").alias("__unit_code")), F.col("parts.unit") == F.col("__unit"), "left")
    return rows.withColumn("code", F.coalesce("__field_code", "__unit_code")).drop("__field", "__field_code", "__unit", "__unit_code")


def usual_currencies(listings: DataFrame) -> DataFrame:
    """(site, default_currency): the currency most prices of each site state, of equals the first by name; counted over all rows, pre-aggregated per
    site and currency. The site is the domain in lower case without www.; sites that state none are left out."""
    counts = _stated(listings, [_site("domain").alias("site")]).filter(F.col("site").isNotNull() & F.col("code").isNotNull()).groupBy("site", "code").count()
    return counts.groupBy("site").agg(F.min(F.struct(-F.col("count"), F.col("code"))).alias("m")).select("site", F.col("m.code").alias("default_currency"))


def prices_in_cents(listings: DataFrame, currency_rate: DataFrame, id_col: str = "output_id", source_default: DataFrame | None = None) -> DataFrame:
    """(id, quantity bigint): price now asked of each listing in US cents, halves rounded up.

    The currency is the one of the field `currency` (any case, blanks or symbol), else the one written next to the amount, else, where
    `source_default(site, default_currency)` is given, the usual one of the site. A bare `$` without any currency is the US dollar.
    Rows without an amount, or whose currency no rate is known for, give no row. Null and empty fields count as not given.
    """
    rate = currency_rate.select(F.upper(F.trim("currency_code")).alias("rate_code"), "minor_digits", "usd_per_unit").dropDuplicates(["rate_code"])
    if source_default is None:
        rows = _stated(listings, [F.col(id_col)])
    else:
        usual = source_default.select(F.col("site").alias("__site"), "default_currency")
        rows = _stated(listings, [F.col(id_col), _site("domain").alias("__site")]).join(usual, "__site", "left").withColumn("code", F.coalesce("code", "default_currency"))
    rows = rows.join(rate, F.col("code") == F.col("rate_code"))
    cents = F.col("parts.amount") * F.col("usd_per_unit") * F.lit(100)
    cents = F.when(F.col("parts.minor"), cents / F.pow(F.lit(10), "minor_digits").cast("decimal(10,0)")).otherwise(cents)
    return rows.select(id_col, F.round(cents, 0).cast("bigint").alias("quantity"))


def _substance(segment: Column, names: list[str]) -> Column:
    """The last of `names` mentioned in a segment of lower-case text, or null."""
    found: Column = F.lit(None).cast("string")
    plain = F.regexp_replace(segment, r"vitamin[ae]\b", "vitamin")
    for name in sorted(names, key=len):
        found = F.when(plain.rlike(rf"(?<!\p{{L}}){_quoted(name.lower())}(?![\p{{L}}\d])"), F.lit(name)).otherwise(found)
    return found


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c == " " else "\\" + c for c in text).replace(" ", r"[\s\x{00A0}]*")


def amounts_in_base_units(texts: DataFrame, unit_reference: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, item_no int, quantity bigint, unit string): each amount of mass, energy or cell count written with its unit, in text order from 1.

    One pass: segments (lines) of the text, all amounts of each by one pattern, unit spelling joined to the alias table and to
    `unit_reference`; a unit whose factor depends on the substance takes the substance named in the same segment, and an amount in such a
    unit of a substance without a factor is no amount. Quantities are in ug, joule or cfu, halves rounded up. Where `unit_reference` has a column
    `base_offset`, it is added after the factor (null adds nothing). Null and empty texts give no rows.
    """
    spark = texts.sparkSession
    offset = F.coalesce("base_offset", F.lit(0)) if "base_offset" in unit_reference.columns else F.lit(0)
    reference = bounded_rows(unit_reference.select(F.lower("unit").alias("unit"), "dimension", F.coalesce("substance", F.lit("")).alias("substance"), F.col("base_per_unit").cast("decimal(20,6)").alias("factor"), offset.cast("decimal(20,6)").alias("offset")))
    factors = {(r["unit"], r["substance"]): r for r in sorted(reference, key=repr)}
    substances = sorted({s for _, s in factors if s})
    bound = [a for a, u in Q.UNIT_ALIASES if (u, "") not in factors]
    listed = [(a, r["dimension"], s, r["factor"], r["offset"]) for a, u in Q.UNIT_ALIASES for (unit, s), r in factors.items() if unit == u]
    schema = "alias string, dimension string, substance string, factor decimal(20_6), base_offset decimal(20_6)"
    known = F.broadcast(literal_table(spark, listed or [(None, None, None, None, None)], schema))

    def amounts(segment: Column) -> Column:
        name = _substance(segment, substances)

        def one(match: Column) -> Column:
            digits = F.regexp_extract(match, Q.NUMBER, 0)
            key = Q.unit_key(F.substring(match, F.length(digits) + 1, F.length(match)))
            dependent = key.isin(bound) if bound else F.lit(False)
            return F.struct(Q.number(digits).alias("amount"), key.alias("alias"), F.when(dependent, F.coalesce(name, F.lit("?"))).otherwise("").alias("substance"))

        return F.transform(F.regexp_extract_all(segment, F.lit(Q.AMOUNT), F.lit(0)), one)

    found = F.flatten(F.transform(F.split(F.lower(text_col), _SEGMENT_END), amounts))
    usable = F.filter(found, lambda a: a["substance"] != "?")
    rows = texts.filter(F.col(text_col).rlike(r"\d")).select(F.col(id_col), F.posexplode(usable).alias("pos", "a"))
    rows = rows.select(id_col, (F.col("pos") + 1).cast("int").alias("item_no"), "a.*").join(known, ["alias", "substance"])
    unit = F.create_map(*[F.lit(x) for pair in (("mass", "ug"), ("energy", "joule"), ("cells", "cfu")) for x in pair])
    return rows.select(id_col, "item_no", F.round(F.col("amount") * F.col("factor") + F.col("base_offset"), 0).cast("bigint").alias("quantity"), unit[F.col("dimension")].alias("unit"))
