"""Product records: identity, variants, order-aware merging with provenance and conflicts, merging of semantic values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions import images as I
from catalith.functions import text as T
from catalith.functions import urls as U
from catalith.functions.quantities import bind

#: Most options a variant state keeps.
MAX_OPTIONS = 24
#: Most sources and conflicts kept per field.
MAX_SOURCES = 12
# Periods units sold may be counted over.
SOLD_PERIODS = ["trailing_30d", "monthly", "lifetime", "unknown"]


def first_filled(*columns: Column) -> Column:
    """PRJ-01: the first column that is neither null nor blank."""
    return F.coalesce(*[F.when(T.squeeze(c).isNotNull(), c) for c in columns])


def first_given(*columns: Column) -> Column:
    """PRJ-01: the first column that isn't null; an empty text stops the search."""
    return F.coalesce(*columns)


def missing_fields(wanted: dict[str, Column]) -> Column:
    """PRJ-01: names of wanted fields without a value, in declared order."""
    return F.array_compact(F.array(*[F.when(T.squeeze(c.cast("string")).isNull(), F.lit(n)) for n, c in wanted.items()]))


def normalised_options(options: Column) -> Column:
    """PRJ-02: options as array of struct(name, value): blanks squeezed, options without name and value dropped, of equal lower-case name and value
    the first kept, in order, at most 24 (the feature's bound). `options` is an array of struct(name, value) or a map; null gives null."""
    squeezed = lambda c: F.coalesce(T.squeeze(c), F.lit(""))
    clean = F.filter(F.transform(options, lambda o: F.struct(squeezed(o["name"]).alias("name"), squeezed(o["value"]).alias("value"))), lambda o: (o["name"] != "") | (o["value"] != ""))
    key = lambda o: F.concat(F.lower(o["name"]), F.lit("="), F.lower(o["value"]))
    return bind(clean, lambda c: bind(F.transform(c, key), lambda k: F.slice(F.filter(c, lambda o, i: F.array_position(k, key(o)) == i + 1), 1, MAX_OPTIONS)))


def option_map(options: Column) -> Column:
    """PRJ-02: options given as a map of names to values, as the array normalised_options takes."""
    return F.transform(F.map_entries(options), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")))


def variant_identity(variant_id: Column, sku: Column, options: Column, url: Column) -> Column:
    """PRJ-03: id:, sku:, options: (in their order) or url: (only with a query), the first that is given, in lower case but for the address; '' for none."""
    pairs = F.transform(normalised_options(options), lambda o: F.concat(F.lower(o["name"]), F.lit("="), F.lower(o["value"])))
    v = U.variant_url(url)
    return F.coalesce(F.concat(F.lit("id:"), F.lower(T.squeeze(variant_id))), F.concat(F.lit("sku:"), F.lower(T.squeeze(sku))), F.when(F.size(pairs) > 0, F.concat(F.lit("options:"), F.array_join(pairs, "|"))), F.when(v.contains("?"), F.concat(F.lit("url:"), v)), F.lit(""))


def variant_label(options: Column, title: Column) -> Column:
    """PRJ-04: a variant's title unless it is the default one, else its option values joined by ' / '."""
    joined = F.array_join(F.transform(options, lambda o: o["value"]), " / ")
    return F.when((F.trim(title) != "") & (F.lower(F.trim(title)) != "default title"), F.trim(title)).otherwise(F.coalesce(joined, F.lit("")))


def qualified_name(title: Column, label: Column) -> Column:
    """PRJ-04: title and label joined by a dash, the title alone where it holds the label already; at most 360 characters."""
    return F.when((F.coalesce(label, F.lit("")) == "") | F.contains(F.lower(title), F.lower(label)), title).otherwise(F.substring(F.concat(title, F.lit(" — "), label), 1, 360))


def record_identity(url: Column, variant: Column) -> Column:
    """PRJ-05: normalised address, with '::' and the variant's identity where there is one."""
    return F.concat_ws("::", U.normalised(url), F.when(variant != "", variant))


def platform_variants(variants: Column, option_names: Column) -> Column:
    """PRJ-06: variants of a shop platform with their options by name; those without id, SKU and title are dropped.

    `variants` is array<struct<id, sku, title, price, available, option1, option2, option3>>.
    """
    def options(v: Column) -> Column:
        values = F.array(v["option1"], v["option2"], v["option3"])
        return F.filter(F.transform(values, lambda x, i: F.struct(F.coalesce(F.get(option_names, i), F.concat(F.lit("Option "), (i + 1).cast("string"))).alias("name"), x.alias("value"))), lambda o: F.coalesce(o["value"] != "", F.lit(False)))

    kept = F.filter(variants, lambda v: v["id"].isNotNull() | (F.coalesce(v["sku"], F.lit("")) != "") | (F.coalesce(v["title"], F.lit("")) != ""))
    return F.transform(kept, lambda v: F.struct(v["id"].alias("id"), v["sku"].alias("sku"), v["title"].alias("title"), v["price"].alias("price"), v["available"].alias("available"), options(v).alias("options")))


def default_variant(variants: Column) -> Column:
    """PRJ-07: the first variant not known to be unavailable, else the first one."""
    return F.coalesce(F.try_element_at(F.filter(variants, lambda v: ~v["available"].eqNullSafe(F.lit(False))), F.lit(1)), F.try_element_at(variants, F.lit(1)))


def expand_variants(records: DataFrame, variants: str = "variants", images: str = "images") -> DataFrame:
    """PRJ-09: one row per variant, one for a record without any; the variant's picture goes first. Adds `variant` and `variant_pos` (-1 for none)."""
    rows = records.select("*", F.posexplode_outer(variants).alias("variant_pos", "variant")).withColumn("variant_pos", F.coalesce("variant_pos", F.lit(-1)))
    if "image_url" in [f.name for f in records.schema[variants].dataType.elementType.fields]:
        own = F.col("variant.image_url")
        rows = rows.withColumn(images, F.when(own.isNotNull(), F.concat(F.array(own), F.array_remove(images, own))).otherwise(F.col(images)))
    return rows.drop(variants)


def title_case(text: Column) -> Column:
    """PRJ-10: upper-case letters after start, blank, slash and hyphen of an all lower-case text; other texts stay."""
    def upper(t: Column, sep: str) -> Column:
        return F.array_join(F.transform(F.split(t, sep), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.expr("''"), F.substr(w, F.lit(2)))), sep)

    return F.when(text == F.lower(text), upper(upper(upper(text, " "), "/"), "-")).otherwise(text)


def merge_records(records: DataFrame, key: Column, order: str, scalars: list[str], images: str | None = None, conflicts: list[str] | None = None, source: Column | None = None) -> DataFrame:
    """AGG-07, AGG-08: one record per key: of each scalar the first filled value by `order`, pictures united by identity in order.

    Adds n_records, `sources` (different ones, at most 12, smallest first) and for each field of `conflicts` an array of its different
    values where there are several (at most 12). Ties in `order` go to the smaller value. One aggregation, scalars with partial results
    before the shuffle; of a hot key each task first reduces its own rows, and pictures and conflicts are sets, not lists of rows.
    """
    conflicts = conflicts or []
    aggs = [F.count(F.lit(1)).alias("n_records")]
    for c in scalars:
        filled = F.when(T.squeeze(F.col(c).cast("string")).isNotNull(), F.struct(F.col(order), F.col(c)))
        aggs.append(F.min(filled)[c].alias(c))
    for c in conflicts:
        aggs.append(F.collect_set(T.squeeze(F.col(c))).alias(f"__c_{c}"))
    if source is not None:
        aggs.append(F.slice(F.array_sort(F.collect_set(source)), 1, MAX_SOURCES).alias("sources"))
    merged = records.withColumn("__key", key).filter(F.col("__key").isNotNull()).groupBy("__key").agg(*aggs)
    for c in conflicts:
        merged = merged.withColumn(f"{c}_conflicts", F.when(F.size(f"__c_{c}") > 1, F.slice(F.array_sort(f"__c_{c}"), 1, MAX_SOURCES)).otherwise(F.array().cast("array<string>"))).drop(f"__c_{c}")
    if images:
        each = records.select(key.alias("__key"), F.col(order).alias("__o"), F.posexplode(images).alias("__i", "u")).filter(F.coalesce(F.trim("u") != "", F.lit(False)))
        best = each.groupBy("__key", I.identity(F.col("u")).alias("k")).agg(F.min(F.struct("__o", "__i")).alias("at"), F.max_by("u", F.struct(I.preference(F.col("u")), I.width(F.col("u")), -F.col("__o"), -F.col("__i"))).alias("u"))
        united = best.groupBy("__key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "u"))), lambda x: x["u"]).alias(images))
        merged = merged.join(united, "__key", "left")
    return merged.withColumnRenamed("__key", "identity")


def provenance(fields: dict[str, Column], reference: Column) -> Column:
    """AGG-08: map of each field with a value to where it comes from."""
    entries = F.array_compact(F.array(*[F.when(c.isNotNull(), F.struct(F.lit(n).alias("key"), reference.alias("value"))) for n, c in fields.items()]))
    return F.map_from_entries(entries)


def merge_values(values: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """AGG-09: values united case-insensitively per key, the first spelling by `order` kept; arrays in that order."""
    first = values.filter(T.squeeze(F.col(value)).isNotNull()).groupBy(*key, F.lower(T.squeeze(F.col(value))).alias("__v")).agg(F.min(F.struct(order, value)).alias("f"))
    return first.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list("f")), lambda x: x[value]).alias("values"))


def merge_ingredients(items: DataFrame, key: list[str], order: str, newer_wins: bool) -> DataFrame:
    """AGG-09, AGG-10: per key and lower-case name the ingredient with most parts; of equals the newer (`newer_wins`, on merging) or the older (on export).

    `items` has name, substance, form, category. Form and category without a substance are dropped first.
    """
    has = F.col("substance").isNotNull()
    clean = items.withColumn("form", F.when(has, F.col("form"))).withColumn("category", F.when(has, F.col("category"))).filter(T.squeeze(F.col("name")).isNotNull())
    parts = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in ("substance", "form", "category")), F.lit(0))
    rank = F.struct(parts, F.col(order) if newer_wins else -F.col(order))
    best = clean.groupBy(*key, F.lower(T.squeeze(F.col("name"))).alias("ingredient_key")).agg(F.max_by(F.struct("name", "substance", "form", "category"), rank).alias("b"), F.min(order).alias("first_pos"))
    return best.select(*key, "ingredient_key", "first_pos", "b.*")


def export_projection(records: DataFrame) -> DataFrame:
    """PRJ-08: guards of the export: rating within 0 to 5, counts of 0 or more, a sales rank above 0, units sold and their period only together and with a
    known period; null is absent."""
    whole = lambda c: F.when(F.col(c) >= 0, F.col(c))
    period = F.trim("units_sold_period").isin(SOLD_PERIODS)
    return records.withColumns({
        "rating": F.when((F.col("rating") >= 0) & (F.col("rating") <= 5), F.col("rating")), "review_count": whole("review_count"), "sales_rank": F.when(F.col("sales_rank") > 0, F.col("sales_rank")),
        "units_sold": F.when(period, whole("units_sold")), "units_sold_period": F.when(period & (F.col("units_sold") >= 0), F.trim("units_sold_period")),
        "images": F.filter("images", lambda i: F.coalesce(i["url"].rlike("(?i)^(https?:)?//"), F.lit(False))),
    })
