"""Queries of the general data problems (history, units, nesting) and the SQL of those SQL can express."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions import quantities as Q
from catalith.operators import history, nesting, units
from catalith.runtime import dimension, new_path, table


def known_captures(snapshots: DataFrame) -> DataFrame:
    """enrich_history with what its captures say: amount of the price, stock state, rating; null where they say nothing."""
    rating = F.when((F.col("rating") >= 0) & (F.col("rating") <= 5), F.col("rating"))
    return snapshots.select("domain", "external_id", "captured_at", "ingested_at", "snapshot_id", Q.price_amount(F.col("price")).alias("amount"), "in_stock", rating.alias("rating"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of each listing with the period each was valid."""
    rows = known_captures(table(spark, sf_dir, "enrich_history"))
    versions = history.merge_history(None, rows, ["domain", "external_id"], "captured_at", ["amount", "in_stock", "rating"], ["ingested_at", "snapshot_id"])
    text = lambda c: F.substring(F.col(c).cast("timestamp_ntz").cast("string"), 1, 19)
    return versions.select("domain", "external_id", text("valid_from").alias("valid_from"), F.coalesce(text("valid_to"), F.lit("")).alias("valid_to"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices in US cents, and amounts of supplement facts in ug, joule or cfu."""
    listings = table(spark, sf_dir, "enrich_product_output")
    usual = dimension(units.usual_currencies(listings), "currencies")
    prices = units.prices_in_cents(listings, table(spark, sf_dir, "currency_rate"), source_default=usual)
    facts = table(spark, sf_dir, "crawl").select("record_id", F.col("fields.supplement_facts").alias("facts"))
    amounts = units.amounts_in_base_units(facts, table(spark, sf_dir, "unit_reference"), "record_id", "facts")
    prices = prices.select(F.lit("price").alias("row_kind"), F.col("output_id").alias("row_id"), F.lit(1).alias("item_no"), "quantity", F.lit("usd_cent").alias("unit"))
    return prices.unionByName(amounts.select(F.lit("facts").alias("row_kind"), F.col("record_id").alias("row_id"), "item_no", "quantity", "unit"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat child rows of the nested payloads, linked to their parents."""
    flat = nesting.flatten_records(table(spark, sf_dir, "raw_record"))
    path = new_path(spark, "children")
    nesting.write_partitioned(flat, path)
    tables = nesting.child_tables(spark.read.schema(flat.schema).parquet(path))
    return reduce(DataFrame.unionByName, [t.select("raw_id", "child", "parent_no", "item_no", "label") for t in tables.values()])


#: Amount of a price text, for DuckDB.
AMOUNT_SQL = r"""
CASE WHEN n = '' THEN NULL
     WHEN regexp_full_match(n, '[0-9]{1,3}([.][0-9]{3})+,[0-9]+') THEN CAST(replace(replace(n, '.', ''), ',', '.') AS DECIMAL(18,4))
     WHEN regexp_full_match(n, '[0-9]{1,3}(,[0-9]{3})+[.][0-9]+') THEN CAST(replace(n, ',', '') AS DECIMAL(18,4))
     WHEN regexp_full_match(n, '[1-9][0-9]{0,2}([.,][0-9]{3})+') THEN CAST(replace(replace(n, ',', ''), '.', '') AS DECIMAL(18,4))
     ELSE CAST(replace(n, ',', '.') AS DECIMAL(18,4)) END / CASE WHEN regexp_matches(lower(price), '[0-9] ?(cents?|p|¢)$') THEN 100 ELSE 1 END
"""

P1_SQL = rf"""
WITH read AS (
  SELECT *, regexp_replace(regexp_extract(coalesce(price, ''), '[0-9]+(?:[.,''’\x{{00A0}}\x{{202F}}][0-9]+)*', 0), '[''’\x{{00A0}}\x{{202F}}]', '', 'g') AS n FROM enrich_history
), said AS (
  SELECT domain, external_id, captured_at, {AMOUNT_SQL} AS amount, in_stock, CASE WHEN rating BETWEEN 0 AND 5 THEN rating END AS rating,
         row_number() OVER (PARTITION BY domain, external_id, captured_at ORDER BY ingested_at DESC, snapshot_id DESC) AS r
  FROM read WHERE captured_at IS NOT NULL
), known AS (
  SELECT domain, external_id, captured_at,
         last_value(amount IGNORE NULLS) OVER w AS amount, last_value(in_stock IGNORE NULLS) OVER w AS in_stock, last_value(rating IGNORE NULLS) OVER w AS rating
  FROM said WHERE r = 1 WINDOW w AS (PARTITION BY domain, external_id ORDER BY captured_at ROWS UNBOUNDED PRECEDING)
), seen AS (
  SELECT *, row_number() OVER w AS nth, lag(amount) OVER w AS a, lag(in_stock) OVER w AS s, lag(rating) OVER w AS g
  FROM known WINDOW w AS (PARTITION BY domain, external_id ORDER BY captured_at)
), starts AS (
  SELECT * FROM seen WHERE nth = 1 OR amount IS DISTINCT FROM a OR in_stock IS DISTINCT FROM s OR rating IS DISTINCT FROM g
)
SELECT domain, external_id, strftime(captured_at, '%Y-%m-%d %H:%M:%S') AS valid_from,
       coalesce(strftime(lead(captured_at) OVER (PARTITION BY domain, external_id ORDER BY captured_at), '%Y-%m-%d %H:%M:%S'), '') AS valid_to
FROM starts
"""

# Amounts and units as SQL: patterns of DuckDB, which looks neither ahead nor behind, so separators are doubled where both sides of a number matter.
_B = r"[\s\x{00A0}\x{202F}]*"
_G = r"[0-9]{1,3}(?:[.,''’\x{00A0}\x{202F}][0-9]{3})+(?:[.,][0-9]{1,2})?"
_P = r"[0-9]+(?:[.,][0-9]+)?"
_BEFORE = r"us\$|ca\$|au\$|a\$|c\$|[$€£¥]|usd|eur|gbp|cad|aud|chf|sek|czk|pln|jpy"
_AFTER = r"[$€£¥¢]|kr|kč|zł|fr|euros?|usd|eur|gbp|cad|aud|chf|sek|czk|pln|jpy|cents?|ct|p"
_WORDS = r"sale price|\bnow\b|\bnur\b|\bjetzt\b|\bahora\b|\bmaintenant\b"
_VALUE = r"""CASE WHEN regexp_full_match({n}, '[0-9]{{1,3}}([.][0-9]{{3}})+,[0-9]+') THEN CAST(replace(replace({n}, '.', ''), ',', '.') AS DECIMAL(20,6)) WHEN regexp_full_match({n}, '[0-9]{{1,3}}(,[0-9]{{3}})+[.][0-9]+') THEN CAST(replace({n}, ',', '') AS DECIMAL(20,6))
  WHEN regexp_full_match({n}, '[1-9][0-9]{{0,2}}([.,][0-9]{{3}})+') THEN CAST(replace(replace({n}, ',', ''), '.', '') AS DECIMAL(20,6)) ELSE CAST(replace({n}, ',', '.') AS DECIMAL(20,6)) END"""
# doubled separators let RE2 look at both sides of a number without taking what the next one needs
_GD = r"[0-9]{1,3}(?:(?:\.\.|,,|''''|’’|\x{00A0}\x{00A0}|\x{202F}\x{202F})[0-9]{3})+(?:(?:\.\.|,,)[0-9]{1,2})?"
_PD = r"[0-9]+(?:(?:\.\.|,,)[0-9]+)?"
_S = r"[\s\x{00A0}\x{202F}]"
_CELLS = rf"(?:(?:[x×]+{_S}*10{_S}*(?:\^*{_S}*[69]|⁶⁶?|⁹⁹?)|mil{_S}+millones|billions?|bn|b|milliarden|milliards?|mrd(?:\.\.)?|millionen|millions?|mio(?:\.\.)?|millones|millón|m){_S}*)?(?:de{_S}+|d(?:''''|’’){_S}*)?(?:cfu|ufc|kbe)"
_PLAIN = r"microgrammes?|micrograms?|microgramos?|mikrogramm|milligrammes?|milligrams?|miligramos?|milligramm|kilograms?|grammes?|grams?|gramos?|gramm|[µμ]g|mcg|ug|mg|kg|gm|gr|g|ounces?|oz|kcal|kj|joules?|j|i(?:\.\.)?u|u(?:\.\.)?i|i(?:\.\.)?e"
P5_SQL = rf"""
WITH ca(alias, code) AS (VALUES ('$', 'USD'), ('us$', 'USD'), ('ca$', 'CAD'), ('c$', 'CAD'), ('a$', 'AUD'), ('au$', 'AUD'), ('€', 'EUR'), ('euro', 'EUR'), ('euros', 'EUR'), ('£', 'GBP'), ('¥', 'JPY'), ('kr', 'SEK'), ('kč', 'CZK'), ('zł', 'PLN'), ('fr', 'CHF'),
  ('usd', 'USD'), ('eur', 'EUR'), ('gbp', 'GBP'), ('cad', 'CAD'), ('aud', 'AUD'), ('chf', 'CHF'), ('sek', 'SEK'), ('czk', 'CZK'), ('pln', 'PLN'), ('jpy', 'JPY'), ('p', 'GBP'), ('¢', 'USD')),
p0 AS (SELECT output_id, regexp_replace(regexp_replace(domain, '^\s+|\s+$', '', 'g'), '^(?i:www[.])', '') AS site, lower(price) AS low, regexp_replace(lower(trim(replace(currency, chr(160), ' '))), '[.]$', '') AS field FROM enrich_product_output WHERE regexp_matches(price, '[0-9]')),
p1 AS (SELECT *, regexp_replace(low, '(?s)^.*?(?:{_WORDS})', '') AS cut FROM p0),
p2 AS (SELECT *, CASE WHEN regexp_matches(low, '{_WORDS}') AND regexp_matches(cut, '[0-9]') THEN cut ELSE low END AS part FROM p1),
p3 AS (SELECT *, regexp_extract(part, '(?:^|[^\pL0-9])(?:({_G})(?:[^0-9]|$)|({_P}))', ['g', 'p']) AS m, regexp_extract(part, '^[^0-9]*?({_BEFORE}){_B}[0-9]', 1) AS bef, regexp_extract(part, '^(?:[^0-9]*[^\pL0-9])?(?:{_G}|{_P}){_B}({_AFTER})(?:[^\pL0-9]|$)', 1) AS aft FROM p2),
p4 AS (SELECT *, regexp_replace(CASE WHEN m.g <> '' THEN m.g ELSE m.p END, '[''’\s\x{{00A0}}\x{{202F}}]', '', 'g') AS n, bef = '' AND aft IN ('p', 'cent', 'cents', 'ct', '¢') AS minor, CASE WHEN bef <> '' THEN bef ELSE aft END AS unit FROM p3),
p5 AS (SELECT output_id, site, {_VALUE.format(n='n')} AS amount, minor, coalesce(f.code, u.code) AS code FROM p4 LEFT JOIN ca f ON f.alias = p4.field LEFT JOIN ca u ON u.alias = p4.unit WHERE n <> ''),
usual AS (SELECT site, arg_min(code, struct_pack(n := -n, c := code)) AS code FROM (SELECT lower(site) AS site, code, count(*) AS n FROM p5 WHERE site IS NOT NULL AND code IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
prices AS (SELECT output_id, CAST(round(CAST(amount AS DECIMAL(18,4)) * usd_per_unit * 100 / CASE WHEN minor THEN 10 ** minor_digits ELSE 1 END, 0) AS BIGINT) AS quantity FROM p5 LEFT JOIN usual ON usual.site = lower(p5.site) JOIN currency_rate ON upper(trim(currency_code)) = coalesce(p5.code, usual.code)),
ua(alias, unit) AS (VALUES ('ug', 'ug'), ('µg', 'ug'), ('μg', 'ug'), ('mcg', 'ug'), ('microgram', 'ug'), ('micrograms', 'ug'), ('microgramme', 'ug'), ('microgrammes', 'ug'), ('microgramo', 'ug'), ('microgramos', 'ug'), ('mikrogramm', 'ug'), ('mg', 'mg'), ('milligram', 'mg'), ('milligrams', 'mg'), ('milligramme', 'mg'), ('milligrammes', 'mg'), ('miligramo', 'mg'), ('miligramos', 'mg'), ('milligramm', 'mg'),
  ('g', 'g'), ('gm', 'g'), ('gr', 'g'), ('gram', 'g'), ('grams', 'g'), ('gramme', 'g'), ('grammes', 'g'), ('gramo', 'g'), ('gramos', 'g'), ('gramm', 'g'), ('kg', 'kg'), ('kilogram', 'kg'), ('kilograms', 'kg'), ('oz', 'oz'), ('ounce', 'oz'), ('ounces', 'oz'), ('iu', 'iu'), ('ui', 'iu'), ('ie', 'iu'), ('kcal', 'kcal'), ('kj', 'kj'), ('j', 'j'), ('joule', 'j'), ('joules', 'j'),
  (' cfu', 'cfu'), ('million cfu', 'million cfu'), ('millions cfu', 'million cfu'), ('millionen cfu', 'million cfu'), ('mio cfu', 'million cfu'), ('millón cfu', 'million cfu'), ('millones cfu', 'million cfu'), ('m cfu', 'million cfu'), ('x10^6 cfu', 'million cfu'), ('billion cfu', 'billion cfu'), ('billions cfu', 'billion cfu'), ('b cfu', 'billion cfu'), ('bn cfu', 'billion cfu'), ('milliard cfu', 'billion cfu'), ('milliards cfu', 'billion cfu'), ('milliarden cfu', 'billion cfu'), ('mrd cfu', 'billion cfu'), ('milmillones cfu', 'billion cfu'), ('x10^9 cfu', 'billion cfu')),
s0 AS (SELECT record_id, unnest(regexp_split_to_array(lower(fields.supplement_facts), '[\n\r;•]')) AS seg, generate_subscripts(regexp_split_to_array(lower(fields.supplement_facts), '[\n\r;•]'), 1) AS sno FROM crawl WHERE regexp_matches(fields.supplement_facts, '[0-9]')),
sub AS (SELECT DISTINCT substance FROM unit_reference WHERE substance IS NOT NULL),
s1 AS (SELECT record_id, sno, (SELECT arg_max(substance, len(substance)) FROM sub WHERE regexp_matches(regexp_replace(seg, 'vitamin[ae]\b', 'vitamin', 'g'), '(^|[^\pL])' || replace(lower(substance), ' ', '[\s\x{{00A0}}]*') || '([^\pL0-9]|$)')) AS substance,
  regexp_extract_all(regexp_replace(seg, '([^\pL0-9])', '\1\1', 'g'), '(?:^|[^\pL0-9])((?:{_GD}|{_PD}){_S}*(?:{_CELLS}|{_PLAIN}))(?:[^\pL0-9]|$)', 1) AS ms FROM s0),
s2 AS (SELECT record_id, sno, substance, unnest(ms) AS m, generate_subscripts(ms, 1) AS mno FROM s1),
s3 AS (SELECT *, regexp_extract(m, '^(?:{_GD}|{_PD})', 0) AS d FROM s2),
s4 AS (SELECT *, regexp_replace(replace(replace(d, '..', '.'), ',,', ','), '[''’\s\x{{00A0}}\x{{202F}}]', '', 'g') AS n, regexp_replace(regexp_replace(substr(m, len(d) + 1), '\b(de[\s\x{{00A0}}\x{{202F}}]+|d(?:''''|’’)[\s\x{{00A0}}\x{{202F}}]*)(cfu|ufc|kbe)', '\2'), '[\s.''’\x{{00A0}}\x{{202F}}]', '', 'g') AS u0 FROM s3),
s5 AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(u0, '^[x×]+10\^*([69])', 'x10^\1'), '^[x×]+10⁶+', 'x10^6'), '^[x×]+10⁹+', 'x10^9'), '(cfu|ufc|kbe)$', ' cfu') AS u FROM s4),
s6 AS (SELECT s5.*, ua.unit, (SELECT bool_and(r.substance IS NOT NULL) FROM unit_reference r WHERE lower(r.unit) = ua.unit) AS bound FROM s5 JOIN ua ON ua.alias = s5.u),
s7 AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY sno, mno) AS item_no FROM s6 WHERE NOT bound OR substance IS NOT NULL),
facts AS (SELECT record_id, item_no, CAST(round({_VALUE.format(n='n')} * base_per_unit, 0) AS BIGINT) AS quantity, CASE dimension WHEN 'mass' THEN 'ug' WHEN 'energy' THEN 'joule' ELSE 'cfu' END AS unit
  FROM s7 JOIN unit_reference r ON lower(r.unit) = s7.unit AND coalesce(r.substance, '') = CASE WHEN bound THEN s7.substance ELSE '' END)
SELECT 'price' AS row_kind, output_id AS row_id, CAST(1 AS INTEGER) AS item_no, quantity, 'usd_cent' AS unit FROM prices UNION ALL SELECT 'facts', record_id, CAST(item_no AS INTEGER), quantity, unit FROM facts
"""

P7_SQL = r"""
WITH RECURSIVE u(raw_id, j) AS (
  SELECT raw_id, regexp_replace(payload, '^[\x{FEFF}\s]+', '') FROM raw_record WHERE payload IS NOT NULL
  UNION ALL
  SELECT raw_id, CASE t WHEN 'VARCHAR' THEN regexp_replace(json_extract_string(j, '$'), '^[\x{FEFF}\s]+', '') ELSE CAST(json_extract(j, '$[0]') AS VARCHAR) END
  FROM (SELECT raw_id, j, CASE WHEN json_valid(j) THEN json_type(j) END AS t FROM u) x WHERE t = 'VARCHAR' OR (t = 'ARRAY' AND CASE WHEN json_valid(j) THEN json_array_length(j) END = 1)
), o AS (SELECT raw_id, CASE WHEN json_valid(j) THEN CAST(j AS JSON) END AS j FROM u),
r AS (SELECT raw_id, j FROM o WHERE json_type(j) = 'OBJECT' AND len(json_keys(j)) > 0),
h AS (SELECT raw_id, j AS holder FROM r UNION ALL SELECT raw_id, json_extract(j, '$.fields') FROM r WHERE json_type(j, '$.fields') = 'OBJECT'),
k(child, a, b) AS (VALUES ('main_ingredients', '$.main_ingredients', '$.mainIngredients'), ('images', '$.images', '$.images'), ('variants', '$.variants', '$.variants'), ('variant_options', '$.variant_options', '$.variantOptions')),
v AS (SELECT raw_id, child, CASE WHEN coalesce(json_type(holder, a), 'NULL') <> 'NULL' THEN json_extract(holder, a) WHEN coalesce(json_type(holder, b), 'NULL') <> 'NULL' THEN json_extract(holder, b) END AS val FROM h, k),
e AS (SELECT raw_id, child, unnest(es) AS entry, generate_subscripts(es, 1) - 1 AS item_no FROM (SELECT raw_id, child, CASE json_type(val) WHEN 'ARRAY' THEN json_extract(val, '$[*]')
  WHEN 'OBJECT' THEN CASE WHEN child = 'variant_options' AND NOT list_has_any(json_keys(val), ['name', 'label', 'value', 'selected', 'position']) THEN list_transform(json_keys(val), lambda x: json_object('name', x)) ELSE [val] END ELSE [val] END AS es FROM v WHERE val IS NOT NULL)),
w AS (SELECT raw_id, item_no AS parent_no, CASE WHEN coalesce(json_type(entry, '$.variant_options'), 'NULL') <> 'NULL' THEN json_extract(entry, '$.variant_options') WHEN coalesce(json_type(entry, '$.variantOptions'), 'NULL') <> 'NULL' THEN json_extract(entry, '$.variantOptions') END AS val FROM e WHERE child = 'variants' AND json_type(entry) = 'OBJECT'),
n AS (SELECT raw_id, parent_no, unnest(es) AS entry, generate_subscripts(es, 1) - 1 AS item_no FROM (SELECT raw_id, parent_no, CASE json_type(val) WHEN 'ARRAY' THEN json_extract(val, '$[*]')
  WHEN 'OBJECT' THEN CASE WHEN NOT list_has_any(json_keys(val), ['name', 'label', 'value', 'selected', 'position']) THEN list_transform(json_keys(val), lambda x: json_object('name', x)) ELSE [val] END ELSE [val] END AS es FROM w WHERE val IS NOT NULL)),
c AS (SELECT raw_id, child, -1 AS parent_no, item_no, entry FROM e UNION ALL SELECT raw_id, 'variant_options', parent_no, item_no, entry FROM n),
l AS (SELECT *, CASE WHEN json_type(entry) = 'OBJECT' THEN list_filter([json_extract(entry, p1), json_extract(entry, p2)], lambda x: x IS NOT NULL AND json_type(x) NOT IN ('NULL', 'BOOLEAN', 'ARRAY', 'OBJECT') AND regexp_matches(json_extract_string(x, '$'), '[^ \t\r\n\x{00A0}\x{202F}\x{200B}\x{FEFF}]'))[1]
  WHEN json_type(entry) NOT IN ('NULL', 'BOOLEAN', 'ARRAY') THEN entry END AS found
  FROM c JOIN (VALUES ('main_ingredients', '$.name', '$.value'), ('images', '$.url', '$.src'), ('variants', '$.id', '$.id'), ('variant_options', '$.name', '$.label')) q(child, p1, p2) USING (child))
SELECT raw_id, child, CAST(parent_no AS INTEGER) AS parent_no, CAST(item_no AS INTEGER) AS item_no, json_extract_string(found, '$') AS label FROM l WHERE found IS NOT NULL AND regexp_matches(json_extract_string(found, '$'), '[^ \t\r\n\x{00A0}\x{202F}\x{200B}\x{FEFF}]')
"""

QUERIES = {"p1_found": p1_found, "p5_found": p5_found, "p7_found": p7_found}
ORACLES: dict[str, str] = {"p1_found": P1_SQL, "p5_found": P5_SQL, "p7_found": P7_SQL}
