"""Queries of the catalogue operators on the test tables, each with its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions import html as H
from catalith.functions import images as I
from catalith.functions import text as T
from catalith.functions import urls as U
from catalith.operators import lookups, records, sets, stats, timeline
from catalith.runtime import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a query under its function's name, with its SQL where SQL can express it."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# Lists of the SQL, kept apart from those of the library so that a slip in one shows against the other.
_SUFFIXES = """
'co.uk', 'org.uk', 'me.uk', 'ac.uk', 'gov.uk', 'ltd.uk', 'plc.uk', 'com.au', 'net.au', 'org.au', 'co.nz', 'net.nz', 'org.nz', 'co.za', 'org.za', 'web.za', 'co.jp', 'ne.jp', 'or.jp', 'gr.jp', 'co.kr', 'or.kr', 'ne.kr', 'com.br', 'net.br', 'org.br', 'com.mx', 'com.ar', 'com.co', 'com.pe', 'com.uy', 'com.ec',
'com.ve', 'com.tr', 'com.cn', 'com.hk', 'com.tw', 'com.sg', 'com.my', 'com.ph', 'com.vn', 'co.in', 'co.id', 'co.th', 'co.il', 'com.sa', 'com.eg', 'com.ng', 'co.ke', 'com.pl', 'com.ua', 'com.gr', 'com.pt', 'com.ro'
"""  # fmt: skip
_TRACK = "categorycode|utm_|fbclid|gclid|currency|lang"
_HOST = "rtrim(regexp_extract(lower(trim(product_url)), '^https?://(?:[^/?#@]*@)?([^/?#:]*)', 1), '.')"
_PARTS = "list_filter(string_split(regexp_extract(product_url, '^[^?#]*[?]([^#]*)', 1), '&'), lambda p: p <> '')"
_PATH = "regexp_replace(regexp_replace(regexp_extract(trim(product_url), '^(?:(?:[Hh][Tt][Tt][Pp][Ss]?:)?//[^/?#]*)?([^?#]*)', 1), '/{2,}', '/', 'g'), '/$', '')"
_BARE_HOST = rf"regexp_replace({_HOST}, '^www[0-9]?\.', '')"
_KEPT = f"list_sort(list_distinct(list_filter({_PARTS}, lambda p: NOT regexp_matches(lower(p), '^({_TRACK})'))))"
_PAGE = f"{_BARE_HOST} || {_PATH} || CASE WHEN len({_KEPT}) > 0 THEN '?' || array_to_string({_KEPT}, '&') ELSE '' END"
_FILLERS = "'n/a', 'n.a.', 'n.a', 'na', 'n. a.', 'k. a.', 'k.a.', 'keine angabe', 'none', 'none given', 'null', 'nil', 'nan', 'undefined', 'unknown', 'not available', 'not specified', 'not given', 'tbd', 'tba', 'tbc', 'lorem', 'lorem ipsum', 'loading...', 'loading…', 'loading', 'placeholder', 'todo'"


def _filled(c: str) -> str:
    t = rf"lower(trim(regexp_replace({c}, '[\s\x{{00A0}}\x{{FEFF}}]+', ' ', 'g')))"
    return rf"coalesce(regexp_matches({t}, '[\pL\pN]') AND {t} NOT IN ({_FILLERS}) AND NOT regexp_matches({t}, '^(\{{\{{.*\}}\}}|\[object .*\]|<%.*%>|\$\{{.*\}}|%\w+%)$'), false)"


@query(f"""
WITH h AS (SELECT list_filter(string_split({_HOST}, '.'), lambda x: x <> '') AS l FROM crawl)
SELECT CASE WHEN len(l) > 2 AND array_to_string(l[-2:], '.') IN ({_SUFFIXES}) THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain, count(*) AS n_pages
FROM h GROUP BY 1
""")
def url_domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-01: captured pages per registrable domain."""
    return table(spark, sf_dir, "crawl").groupBy(U.registrable_domain(F.col("product_url")).alias("domain")).agg(F.count(F.lit(1)).alias("n_pages"))


@query(rf"""
WITH p AS (
  SELECT record_id, product_url, lower(regexp_extract(trim(product_url), '^([A-Za-z]+)://', 1)) AS scheme, {_HOST} AS host,
         regexp_extract(lower(trim(product_url)), '^https?://[^/?#]*?:([0-9]+)', 1) AS port, regexp_extract(trim(product_url), '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS raw,
         list_filter({_PARTS}, lambda p: NOT regexp_matches(lower(p), '^({_TRACK})')) AS kept
  FROM crawl)
SELECT record_id, scheme || '://' || host || CASE WHEN port = '' OR (scheme = 'http' AND port = '80') OR (scheme = 'https' AND port = '443') THEN '' ELSE ':' || port END
  || CASE WHEN raw = '/' AND len(kept) = 0 THEN '' ELSE raw END || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url
FROM p
""")
def url_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-03: product addresses in normal form."""
    return table(spark, sf_dir, "crawl").select("record_id", U.normalised(F.col("product_url")).alias("url"))


@query(r"""
WITH u AS (SELECT lower(regexp_extract(trim(product_url), '^(?:[Hh][Tt][Tt][Pp][Ss]?:)?//[^/?#]*([^?#]*)', 1)) AS path, regexp_matches(trim(product_url), '(?i)^https?://[^/?#]') AS http FROM crawl),
n AS (SELECT http, path, regexp_replace(path, '/+$', '') AS bare FROM u),
r AS (SELECT *, NOT http OR bare = '' OR regexp_matches(path, '[.](jpg|jpeg|png|webp|gif|svg|css|js|xml|json|pdf|zip|woff|woff2)$') OR regexp_matches(path, '(^|/)blog(-[^/]*)?(/|$)') OR regexp_matches(path, '-blog[0-9]+[.]html$')
  OR bare IN ('/global', '/locale', '/language', '/languages', '/region', '/regions', '/country', '/countries')
  OR regexp_replace(bare, '[-/]', ' ', 'g') IN (' privacy cookies', ' privacy and cookies', ' cookies', ' cookie', ' cookie policy', ' cookies policy', ' privacy policy', ' terms', ' terms and conditions', ' about', ' about us', ' contact', ' contact us')
  OR regexp_matches(path, '/(cart|basket|checkout|account|login|register|wishlist|search|news|contact|about|privacy|terms|faq|client-|order|compare|producer|producers|brand|brands)(/|$)') AS rejected FROM n),
c AS (SELECT *, regexp_matches(path, '[^/]-(k|cat|category|collection|brand|producer|p)[0-9]+[.]html$') AS code, regexp_matches(path, '/(menu|category|categories|collection|collections|catalog|shop|store)(/|$)') AS listed FROM r),
p AS (SELECT *, NOT rejected AND NOT code AND CASE WHEN listed THEN regexp_matches(path, '/(product|products|produs|produit|producto)/')
  ELSE regexp_matches(path, '/(product|products|produs|produit|producto|produkt|item|p)/') OR regexp_matches(path, '[^/](-opis[0-9]+|-[0-9]{3,})[.]html$') OR regexp_matches(path, '(^|/)p[0-9]{3,}[-_][^/]+[.](php|html?)$') END AS product FROM c)
SELECT CASE WHEN rejected THEN 'rejected' WHEN product THEN 'product' WHEN code OR listed OR regexp_matches(path, '/(products|produkty|produits|productos|produkte)(/|$)') THEN 'category' ELSE 'other' END AS page_class, count(*) AS n
FROM p GROUP BY 1
""")
def url_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-04, URL-05, URL-06: addresses by class."""
    u = F.col("product_url")
    kind = F.when(U.is_rejected(u), "rejected").when(U.is_product(u), "product").when(U.is_category(u), "category").otherwise("other")
    return table(spark, sf_dir, "crawl").groupBy(kind.alias("page_class")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT {_PAGE} AS page, count(*) AS n, count(DISTINCT product_url) AS spellings FROM crawl GROUP BY 1")
def url_page_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-05: records and spellings per page and variant."""
    return table(spark, sf_dir, "crawl").groupBy(U.page_key(F.col("product_url")).alias("page")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("product_url").alias("spellings"))


@query("SELECT record_id, try_cast(nullif(regexp_extract(source_url, '[?&]page=([0-9]{1,4})(?:[&#]|$)', 1), '') AS INTEGER) AS page_no FROM crawl WHERE regexp_matches(source_url, '[?&]page=[0-9]')")
def url_page_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-10: page numbers of listing addresses."""
    return table(spark, sf_dir, "crawl").filter(F.col("source_url").rlike("[?&]page=[0-9]")).select("record_id", U.page_number(F.col("source_url")).alias("page_no"))


@query(r"""
WITH d AS (SELECT output_id, regexp_replace(price, '[^0-9.,]', '', 'g') AS d FROM enrich_product_output WHERE price IS NOT NULL)
SELECT output_id, CAST(coalesce(try_cast(regexp_replace(regexp_replace(d, '[.,][0-9]{1,2}$', ''), '[.,]', '', 'g') || '.' || CASE WHEN regexp_extract(d, '[.,]([0-9]{1,2})$', 1) <> '' THEN regexp_extract(d, '[.,]([0-9]{1,2})$', 1) ELSE '0' END AS DECIMAL(18,2)), 0) AS DOUBLE) AS amount
FROM d
""")
def price_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML-09: the plain price parser on all price texts."""
    return table(spark, sf_dir, "enrich_product_output").filter("price IS NOT NULL").select("output_id", H.price_number(F.col("price")).cast("double").alias("amount"))


_ENT = "replace(replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&apos;', chr(39)), '&amp;', '&')"


@query(rf"""
WITH a AS (SELECT doc_id, regexp_replace(text, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g') AS t FROM documents WHERE text IS NOT NULL),
b AS (SELECT doc_id, regexp_replace(t, '<[^>]*>', ' ', 'g') AS t FROM a)
SELECT doc_id, sha256(trim(regexp_replace({_ENT}, '[\s\x{{00A0}}\x{{FEFF}}]+', ' ', 'g'), ' ')) AS text_hash FROM b
""")
def text_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML-01, HTML-19: hash of each document's visible text."""
    return table(spark, sf_dir, "documents").filter("text IS NOT NULL").select("doc_id", F.sha2(H.to_text(F.col("text")), 256).alias("text_hash"))


@query(r"""
WITH i AS (SELECT record_id, unnest(fields.images) AS u, generate_subscripts(fields.images, 1) AS pos FROM crawl),
k AS (SELECT *, regexp_replace(regexp_replace(u, '#.*$', ''), '^(http:)?//', 'https://') AS id, CASE WHEN starts_with(u, 'https:') THEN 2 ELSE 0 END AS p, coalesce(try_cast(nullif(regexp_extract(u, '[?&](?:w|width)=([0-9]+)', 1), '') AS INTEGER), 0) AS w FROM i WHERE trim(u) <> ''),
f AS (SELECT record_id, id, min(pos) AS first_pos, arg_max(u, struct_pack(p := p, w := w, o := -pos)) AS u, count(*) AS c FROM k GROUP BY 1, 2)
SELECT record_id, CAST(sum(c) AS BIGINT) AS n_images, count(*) AS n_unique, string_agg(u, ' ' ORDER BY first_pos) AS chosen FROM f GROUP BY 1
""")
def image_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IMG-02, IMG-03, IMG-04: pictures of each record, how many are different, and the spelling chosen for each."""
    rows = table(spark, sf_dir, "crawl").select("record_id", F.filter("fields.images", lambda u: F.coalesce(F.trim(u) != "", F.lit(False))).alias("images"))
    return rows.filter(F.size("images") > 0).select("record_id", F.size("images").cast("bigint").alias("n_images"), I.unique(F.col("images")).alias("kept")).select("record_id", "n_images", F.size("kept").cast("bigint").alias("n_unique"), F.array_join("kept", " ").alias("chosen"))


@query("SELECT output_id, substr(sha1(product_url), 1, 16) || '.jpg' AS file_name FROM enrich_product_output")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11: file names of stored pictures."""
    return table(spark, sf_dir, "enrich_product_output").select("output_id", U.file_key(F.col("product_url"), F.lit("image/jpeg")).alias("file_name"))


@query("""
WITH v AS (SELECT l_suppkey, p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT l_suppkey, CAST(sum(n) AS BIGINT) AS with_vendor, count(*) AS vendors, max(n) AS top_vendor, sum(n) >= 8 AND count(*) >= 6 AND max(n) < 0.6 * sum(n) AS is_retailer FROM v GROUP BY 1
""")
def site_retailer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01, AGG-02: vendor diversity of each site and whether it is a multi-brand retailer."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return stats.vendor_diversity(items, ["l_suppkey"], "p_brand")


_COVER = ["title", "price", "currency", "description", "ingredients", "supplement_facts", "sku", "form"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({_filled('fields.' + c)}) AS filled, count(*) AS total, CAST(round(CAST(count(*) FILTER ({_filled('fields.' + c)}) AS DECIMAL(20,0)) / count(*), 2) AS DOUBLE) AS rate FROM crawl" for c in _COVER))
def field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-04: share of crawl records with each field filled."""
    return stats.coverage(table(spark, sf_dir, "crawl"), {c: T.is_filled(F.col(f"fields.{c}")) for c in _COVER})


@query(f"SELECT domain, count(*) AS n, count(*) FILTER ({_filled('fields.supplement_facts')}) AS n_facts, count(*) FILTER ({_filled('fields.ingredients')}) AS n_ingredients, count(*) FILTER ({_filled('fields.description')}) AS n_description FROM crawl GROUP BY 1")
def field_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-03: how often each site shows facts, ingredients and descriptions."""
    facts = {k: T.is_filled(F.col(f"fields.{c}")) for k, c in (("facts", "supplement_facts"), ("ingredients", "ingredients"), ("description", "description"))}
    return stats.presence(table(spark, sf_dir, "crawl"), ["domain"], facts)


@query("""
WITH s AS (SELECT user_id, CASE WHEN event_type IN ('purchase', 'error', 'click') THEN event_type ELSE 'click' END AS s FROM events)
SELECT user_id, count(*) AS total, count(*) FILTER (s = 'purchase') AS purchase, count(*) FILTER (s = 'error') AS error, count(*) FILTER (s = 'click') AS click FROM s GROUP BY 1
""")
def queue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-05, AGG-06, AGG-15: rows per status, unknown ones counted as the default."""
    return stats.status_counts(table(spark, sf_dir, "events"), ["user_id"], "event_type", ["purchase", "error", "click"], "click")


@query("WITH p AS (SELECT source, doc_kind, count(*) AS n FROM documents GROUP BY 1, 2) SELECT source, CAST(sum(n) AS BIGINT) AS total, max(n) AS top, sum(n) >= 5 AND max(n) * 10 >= sum(n) * 8 AS dominated FROM p GROUP BY 1")
def dominant_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-11: sites whose documents are nearly all of one kind."""
    return stats.dominant_share(table(spark, sf_dir, "documents"), ["source"], "doc_kind")


@query("SELECT c_nationkey, count(*) AS n, bool_and(coalesce(c_acctbal > 0, false)) AS complete FROM customer GROUP BY 1")
def rollup_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-12: groups all of whose members are resolved."""
    return stats.all_resolved(table(spark, sf_dir, "customer"), ["c_nationkey"], F.col("c_acctbal") > 0)


@query("SELECT s_suppkey, 'nation:' || s_nationkey AS group_key, count(*) OVER (PARTITION BY s_nationkey) AS group_size, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS INTEGER) AS place FROM supplier")
def lease_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-13: tasks grouped by the worker key they share."""
    return stats.task_groups(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), F.concat(F.lit("nation:"), F.col("s_nationkey").cast("string")), "s_suppkey").drop("s_nationkey")


@query("SELECT domain, count(*) FILTER (coalesce(rating >= 4, false)) AS valid_samples, count(*) FILTER (coalesce(rating >= 4, false)) >= 2 AS promoted FROM enrich_product_output GROUP BY 1")
def profile_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-14: profiles with enough valid samples."""
    return stats.promotable(table(spark, sf_dir, "enrich_product_output"), ["domain"], F.col("rating") >= 4)


@query(f"""
WITH r AS (SELECT {_PAGE} AS identity, ord, fields.title AS title, fields.price AS price, fields.currency AS currency, layer FROM crawl)
SELECT identity, count(*) AS n_records, arg_min(title, ord) FILTER (trim(title) <> '') AS title, arg_min(price, ord) FILTER (trim(price) <> '') AS price,
       array_to_string(list_sort(list_distinct(list(layer)))[1:12], ',') AS sources,
       CASE WHEN count(DISTINCT trim(currency)) FILTER (trim(currency) <> '') > 1 THEN array_to_string(list_sort(list_distinct(list(trim(currency)) FILTER (trim(currency) <> '')))[1:12], ',') ELSE '' END AS currency_conflicts
FROM r GROUP BY 1
""")
def merged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-07, AGG-08, SET-01: crawl records merged per page: first filled values by crawl order, sources, differing currencies."""
    rows = table(spark, sf_dir, "crawl").select("product_url", "ord", "layer", "fields.title", "fields.price", "fields.currency")
    merged = records.merge_records(rows, U.page_key(F.col("product_url")), "ord", ["title", "price"], conflicts=["currency"], source=F.col("layer"))
    return merged.select("identity", "n_records", "title", "price", F.array_join("sources", ",").alias("sources"), F.array_join("currency_conflicts", ",").alias("currency_conflicts"))


@query("""
WITH a AS (SELECT output_id, unnest(variant_attrs) AS v, generate_subscripts(variant_attrs, 1) - 1 AS pos FROM enrich_product_output WHERE len(variant_attrs) > 0)
SELECT output_id, CAST(pos AS INTEGER) AS variant_pos, v.name AS name, v.value AS value FROM a
UNION ALL SELECT output_id, -1, NULL, NULL FROM enrich_product_output WHERE coalesce(len(variant_attrs), 0) = 0
""")
def variant_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-06, PRJ-09: one row per variant attribute, one for listings without."""
    rows = records.expand_variants(table(spark, sf_dir, "enrich_product_output").select("output_id", "variant_attrs"), "variant_attrs")
    return rows.select("output_id", "variant_pos", "variant.name", "variant.value")


@query("""
SELECT record_id, CASE WHEN trim(fields.sku) <> '' THEN 'sku:' || lower(trim(fields.sku))
  WHEN len(fields.variant_options) > 0 THEN 'options:' || array_to_string(list_transform(fields.variant_options, lambda o: lower(coalesce(trim(regexp_replace(o.name, '[\\s\\x{00A0}\\x{202F}]+', ' ', 'g')), '')) || '=' || lower(coalesce(trim(regexp_replace(o.value, '[\\s\\x{00A0}\\x{202F}]+', ' ', 'g')), ''))), '|')
  WHEN regexp_matches(product_url, '[?&]variant=') THEN 'url:' || regexp_extract(trim(product_url), '^([^?#]*)', 1) || '?' || regexp_extract(product_url, '[?&](variant=[^&#]*)', 1) ELSE '' END AS variant
FROM crawl
""")
def variant_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-02, PRJ-03, URL-08: identity of each record's variant."""
    v = records.variant_identity(F.lit(None).cast("string"), F.col("fields.sku"), F.col("fields.variant_options"), F.col("product_url"))
    return table(spark, sf_dir, "crawl").select("record_id", v.alias("variant"))


@query("""
WITH g AS (SELECT *, units_sold >= 0 AND trim(units_sold_period) IN ('trailing_30d', 'monthly', 'lifetime', 'unknown') AS sold FROM enrich_product_output)
SELECT output_id, CASE WHEN rating >= 0 AND rating <= 5 THEN rating END AS rating, CASE WHEN review_count >= 0 THEN review_count END AS review_count, CASE WHEN sales_rank > 0 THEN sales_rank END AS sales_rank,
  CASE WHEN sold THEN units_sold END AS units_sold, CASE WHEN sold THEN trim(units_sold_period) END AS units_sold_period FROM g
""")
def export_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-08: numbers of the export that pass their guards."""
    return records.export_projection(table(spark, sf_dir, "enrich_product_output")).select("output_id", "rating", "review_count", "sales_rank", "units_sold", "units_sold_period")


_VKEY = "regexp_replace(trim(regexp_replace(regexp_replace(replace(lower({c}), '&', ' and '), '[''’]', '', 'g'), '[^a-z0-9]+', ' ', 'g'), ' '), 's$', '')"


@query(f"""
WITH n AS (SELECT {_VKEY.format(c="name")} AS k, max(id) AS id FROM vocabulary GROUP BY 1), a AS (SELECT {_VKEY.format(c="alias")} AS k, min(canonical) AS c FROM vocabulary_alias GROUP BY 1),
b AS (SELECT a.k, max(v.id) AS id FROM a JOIN vocabulary v ON v.name = a.c GROUP BY 1), h AS (SELECT DISTINCT unnest(health_functions) AS phrase FROM enrich_product_output)
SELECT phrase, coalesce(n.id, b.id) AS entry_id FROM h LEFT JOIN n ON n.k = {_VKEY.format(c="phrase")} LEFT JOIN b ON b.k = {_VKEY.format(c="phrase")} WHERE phrase IS NOT NULL
""")
def vocabulary_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-01: plain vocabulary lookup of all phrases."""
    phrases = table(spark, sf_dir, "enrich_product_output").select(F.explode("health_functions").alias("phrase")).filter("phrase IS NOT NULL").distinct()
    return lookups.match_vocabulary(phrases, "phrase", table(spark, sf_dir, "vocabulary"), table(spark, sf_dir, "vocabulary_alias")).select("phrase", "entry_id")


@query("""
WITH n AS (SELECT n_nationkey AS k, count(*) AS c FROM nation GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS c FROM supplier GROUP BY 1)
SELECT coalesce(n.k, s.k) AS k, unnest(list_filter([CASE WHEN s.c IS NULL THEN 'missing' END, CASE WHEN n.c IS NULL THEN 'orphan' END, CASE WHEN n.c > 1 THEN 'duplicate_left' END, CASE WHEN s.c > 1 THEN 'duplicate_right' END], lambda x: x IS NOT NULL)) AS problem
FROM n FULL OUTER JOIN s ON n.k = s.k
""")
def key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-05: keys missing, orphaned or doubled between two tables."""
    return lookups.key_audit(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")), "k")


@query("""
WITH o AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN coalesce(c, 0) >= o_orderkey % 9 THEN 'satisfied' WHEN coalesce(c, 0) >= 6 THEN 'capped' ELSE 'mismatch' END AS verdict FROM orders LEFT JOIN o ON o_orderkey = l_orderkey
""")
def count_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-06: expected against observed counts."""
    expected = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 9).alias("expected"))
    observed = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("observed"))
    return lookups.reconcile(expected, observed, ["o_orderkey"], 6).select("o_orderkey", "verdict")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def unresolved_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-07, SET-03, STR-03: what an earlier pass left open."""
    done = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return lookups.unresolved(table(spark, sf_dir, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query("""
WITH l AS (SELECT lower(product_url) AS u, arg_max(value, inference_id) AS value FROM inference WHERE field = 'form' AND value IS NOT NULL GROUP BY 1)
SELECT output_id, l.value AS form FROM enrich_product_output LEFT JOIN l ON lower(product_url) = u
""")
def latest_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-03: the last inferred form of each listing's page."""
    reviews = table(spark, sf_dir, "inference").filter("field = 'form' AND value IS NOT NULL").select(F.col("product_url"), "inference_id", "value")
    return lookups.latest_review(table(spark, sf_dir, "enrich_product_output").select("output_id", "product_url"), reviews, "product_url", "inference_id").select("output_id", F.col("review.value").alias("form"))


@query("""
WITH i AS (SELECT product_url, list(lower(value)) AS vs FROM inference WHERE field = 'main_ingredients' AND value IS NOT NULL GROUP BY 1)
SELECT output_id, CAST(len(list_filter(main_ingredients, lambda m: m.name IS NOT NULL AND NOT list_contains(coalesce(vs, []), lower(m.name)))) AS INTEGER) AS n_gaps
FROM enrich_product_output e LEFT JOIN i USING (product_url) WHERE main_ingredients IS NOT NULL
""")
def inference_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-08: ingredients of each listing that no inference backs."""
    items = table(spark, sf_dir, "enrich_product_output").filter("main_ingredients IS NOT NULL").select("output_id", "product_url", F.posexplode_outer(F.transform("main_ingredients", lambda m: m["name"])).alias("i", "name"))
    backed = table(spark, sf_dir, "inference").filter("field = 'main_ingredients' AND value IS NOT NULL").select("product_url", F.lower("value").alias("v")).distinct().withColumn("hit", F.lit(1))
    joined = items.withColumn("v", F.lower("name")).join(backed, ["product_url", "v"], "left")
    return joined.groupBy("output_id").agg(F.count_if(F.col("name").isNotNull() & F.col("hit").isNull()).cast("int").alias("n_gaps"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def best_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-01: the best row of each key under a total order."""
    return lookups.best_per_key(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("SELECT user_id, event_id, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 20")
def event_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-05, WIN-05: the last twenty events of each user."""
    return lookups.top_per_key(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 20).drop("ts")


@query("""
WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, CAST(session AS BIGINT) AS session, min(ts) AS started, max(ts) AS ended, count(*) AS n_events FROM s GROUP BY 1, 2
""")
def idle_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-01: sessions parted by an idle gap of twelve hours."""
    return timeline.sessions(table(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"], 12 * 3600)


@query("SELECT event_id, count(*) OVER w <= 5 AS within FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")
def budget_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-02: events within a budget of five operations."""
    return timeline.within_budget(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.lit(1), 5).select("event_id", "within")


@query("""
WITH i AS (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS isl FROM events)
SELECT event_id, count(*) FILTER (event_type <> 'purchase') OVER (PARTITION BY user_id, isl ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS streak FROM i
""")
def fruitless_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-06, WIN-07: events since the last success."""
    return timeline.streaks(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase").select("event_id", "streak")


@query("SELECT user_id, arg_max(event_type, struct_pack(ts := ts, id := event_id)) AS state, count(*) AS n_states FROM events GROUP BY 1")
def state_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-13: last state of each user."""
    return timeline.current_state(table(spark, sf_dir, "events"), ["user_id"], "event_type", ["ts", "event_id"])


@query("SELECT event_id, ts + INTERVAL 1 HOUR > (SELECT max(ts) FROM events) - INTERVAL 1 DAY AS fresh FROM events")
def ttl_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-07, STR-04: observations not yet expired at a given time."""
    events = table(spark, sf_dir, "events")
    now = events.agg((F.max("ts") - F.expr("INTERVAL 1 DAY")).alias("now"))
    return events.select("event_id", "ts").crossJoin(F.broadcast(now)).select("event_id", timeline.is_fresh(F.col("ts") + F.expr("INTERVAL 1 HOUR"), F.col("now")).alias("fresh"))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS src, l_partkey AS dst FROM lineitem), r(node) AS (SELECT CAST(1 AS BIGINT) UNION SELECT e.dst FROM r JOIN e ON r.node = e.src)
SELECT node FROM r
""")
def link_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-04: nodes reached from a seed over all links of the table, by rounds until nothing new comes."""
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst")).distinct()
    return sets.reachable(edges, spark.range(1, 2).select(F.col("id").alias("node"))).select("node")


@query(f"SELECT {_PAGE} AS page, min(ord) AS first_ord, arg_min(layer, ord) AS layer FROM crawl GROUP BY 1")
def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-02, WIN-03: pages in order of first sight."""
    rows = table(spark, sf_dir, "crawl").select(U.page_key(F.col("product_url")).alias("page"), F.col("ord").alias("first_ord"), "layer")
    return sets.ordered_distinct(rows, ["page"], "first_ord")


@query("""
WITH i AS (SELECT product_url, output_id * 1000 + generate_subscripts(main_ingredients, 1) AS o, unnest(main_ingredients) AS m FROM enrich_product_output),
c AS (SELECT product_url, o, m.name AS name, m.substance AS substance, CASE WHEN m.substance IS NOT NULL THEN m.form END AS form, CASE WHEN m.substance IS NOT NULL THEN m.category END AS category FROM i
  WHERE trim(regexp_replace(m.name, '[\\s\\x{00A0}]+', ' ', 'g')) <> '')
SELECT product_url, lower(trim(regexp_replace(name, '[\\s\\x{00A0}]+', ' ', 'g'))) AS ingredient_key, arg_max(substance, struct_pack(p := (substance IS NOT NULL)::INT + (form IS NOT NULL)::INT + (category IS NOT NULL)::INT, o := -o)) AS substance
FROM c GROUP BY 1, 2
""")
def merged_ingredients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-09, AGG-10: ingredients of each page united by name, the most complete one kept."""
    items = table(spark, sf_dir, "enrich_product_output").select("product_url", "output_id", F.posexplode("main_ingredients").alias("i", "m")).select("product_url", (F.col("output_id") * 1000 + F.col("i") + 1).alias("o"), "m.*")
    return records.merge_ingredients(items, ["product_url"], "o", newer_wins=False).select("product_url", "ingredient_key", "substance")
