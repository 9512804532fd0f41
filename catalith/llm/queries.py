"""Queries of the problems on texts and duplicates, and the SQL of those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions import text as T
from catalith.functions import urls as U
from catalith.llm import boilerplate, canonical, encoding, leakage, listings, pii, survivorship
from catalith.runtime import materialise, table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary entry meant by each freely typed function, ingredient and category, '' where none is."""
    vocabulary = table(spark, sf_dir, "vocabulary")
    typed = materialise(canonical.typed_values(table(spark, sf_dir, "enrich_product_output"), table(spark, sf_dir, "inference")), "typed")
    rows = typed.filter("first").select("row_id", "kind", "raw_value")
    mapped = canonical.map_values(rows, vocabulary, table(spark, sf_dir, "vocabulary_alias"), canonical.typed_contexts(typed, vocabulary))
    return mapped.select("row_id", F.col("kind").alias("field_name"), "raw_value", F.coalesce("entry_id", F.lit("")).alias("vocab_id"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each page described by several crawl records, the record that gives each field of the surviving one."""
    groups = survivorship.crawl_survivors(table(spark, sf_dir, "crawl"), with_values=False).filter(F.col("n_records") > 1)
    return survivorship.long_form(groups, [*survivorship.TEXT_FIELDS, "images"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the long texts of crawl records that belong to the surroundings of the page."""
    fields = {f: f"fields.{f}" for f in ("description", "ingredients", "supplement_facts")}
    lines = boilerplate.classify_lines(table(spark, sf_dir, "crawl"), "record_id", fields)
    return lines.filter(~F.col("is_main")).select("record_id", "field_name", "line_no")


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "enrich_product_output")
    dictionary = listings.mine_dictionary(rows, table(spark, sf_dir, "vocabulary"), table(spark, sf_dir, "vocabulary_alias"), table(spark, sf_dir, "unit_reference"))
    return materialise(listings.product_keys(rows, table(spark, sf_dir, "crawl"), dictionary), "products")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of listings that offer the same product."""
    return listings.same_products(_products(spark, sf_dir))


def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product class of every listing, without pairs."""
    return listings.product_classes(_products(spark, sf_dir))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by the public vocabulary byte_bpe_50k."""
    return encoding.encode_corpus(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents holding 13 words in a row of an evaluation item."""
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item")).select("doc_id", "item_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal information of each document: kind and text as written, once per document."""
    known = pii.product_lexicon(table(spark, sf_dir, "vocabulary"), table(spark, sf_dir, "vocabulary_alias"))
    found = pii.find_and_redact(table(spark, sf_dir, "documents"), known=known, with_text=False)
    spans = found.select("doc_id", F.array_distinct(F.transform("found", lambda f: F.struct(f["kind"].alias("kind"), f["pii_text"].alias("pii_text")))).alias("spans"))
    return spans.select("doc_id", F.inline("spans")).select("doc_id", "kind", "pii_text")


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p6_found": p6_found, "p6_classes": p6_classes, "p8_ids": p8_ids, "p9_found": p9_found, "p10_found": p10_found}

def _p3_sql() -> str:
    """p3_found for DuckDB, written apart from the operator."""
    sizing = "|".join(U.PICTURE_KEYS)
    tracking = "|".join(U.TRACKING_PREFIXES)
    fillers = ", ".join("'" + f + "'" for f in T.FILLERS)

    def key(c: str, drop: str, size: str = "") -> str:
        host = rf"regexp_replace(rtrim(regexp_extract(lower(trim({c})), '^(?:https?:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1), '.'), '^www[0-9]?\.', '')"
        path = rf"regexp_replace(regexp_replace(regexp_extract(trim({c}), '(?i)^(?:(?:https?:)?//[^/?#]*)?([^?#]*)', 1), '/{{2,}}', '/', 'g'), '/$', '')"
        path = rf"regexp_replace({path}, '{size}', '\1')" if size else path
        kept = rf"array_to_string(list_sort(list_distinct(list_filter(string_split(regexp_extract({c}, '^[^?#]*[?]([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p), '{drop}')))), '&')"
        return f"{host} || {path} || CASE WHEN {kept} <> '' THEN '?' || {kept} ELSE '' END"

    def filled(f: str) -> str:
        t = rf"lower(trim(regexp_replace(fields.{f}, '[\s\x{{00A0}}\x{{FEFF}}]+', ' ', 'g')))"
        return rf"coalesce(regexp_matches({t}, '[\pL\pN]') AND {t} NOT IN ({fillers}) AND NOT regexp_matches({t}, '^(\{{\{{.*\}}\}}|\[object .*\]|<%.*%>|\$\{{.*\}}|%\w+%)$'), false)"

    picture = key("u", f"^({sizing})=|^utm_", r"[_-][0-9]{1,5}x[0-9]{0,5}(\.[A-Za-z]{3,4})$")
    pictures = f"coalesce(len(list_distinct(list_transform(list_filter(fields.images, lambda u: trim(u) <> ''), lambda u: {picture}))), 0)"
    each = " UNION ALL ".join(f"SELECT k, record_id, captured_at, '{f}' AS field_name, 0 AS p FROM r WHERE {filled(f)}" for f in survivorship.TEXT_FIELDS)
    return f"""
WITH r AS (SELECT *, {key("product_url", f"^({tracking})")} AS k FROM crawl WHERE product_url IS NOT NULL), g AS (SELECT k, min(record_id) AS group_id FROM r GROUP BY 1 HAVING count(*) > 1),
v AS ({each} UNION ALL SELECT k, record_id, captured_at, 'images', {pictures} FROM r WHERE {pictures} > 0),
b AS (SELECT *, row_number() OVER (PARTITION BY k, field_name ORDER BY p DESC, captured_at DESC NULLS LAST, record_id) AS n FROM v)
SELECT group_id, field_name, record_id FROM b JOIN g USING (k) WHERE n = 1
"""


P9_SQL = r"""
WITH inv AS (SELECT '[\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFF9}-\x{FFFB}\x{0000}-\x{0008}\x{000E}-\x{001F}\x{007F}]' AS p),
d AS (SELECT doc_id, regexp_extract_all(lower(nfc_normalize(regexp_replace(text, (SELECT p FROM inv), '', 'g'))), '[\pL\pN]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(lower(nfc_normalize(regexp_replace(text, (SELECT p FROM inv), '', 'g'))), '[\pL\pN]+') AS w FROM eval_item WHERE text IS NOT NULL),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k:k+12], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS k FROM i WHERE len(w) >= 13)),
dg AS (SELECT doc_id, array_to_string(w[k:k+12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 13))
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)
"""

ORACLES: dict[str, str] = {"p3_found": _p3_sql(), "p9_found": P9_SQL}
