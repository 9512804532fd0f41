"""Queries of the page, picture and record operators on the test tables, each with its SQL for DuckDB.

The tables hold no HTML: pages are set up from the fields of crawl records, and what the operators read from them must be the fields again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions import html as H
from catalith.functions import images as I
from catalith.functions import links as L
from catalith.functions import urls as U
from catalith.operators import gallery, lookups, pictures, records, sets
from catalith.runtime import table


def _escaped(c: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(sign), F.lit(entity))
    return F.coalesce(c, F.lit(""))


def shop_pages(crawl: DataFrame) -> DataFrame:
    """(record_id, product_url, html, ...): a shop page of each crawl record."""
    f = {n: _escaped(F.col(f"fields.{n}")) for n in ("title", "price", "currency", "description", "ingredients", "supplement_facts", "form")}
    pictures_ = F.array_join(F.transform(F.coalesce("fields.images", F.array().cast("array<string>")), lambda u: F.concat(F.lit('<img src="'), _escaped(u), F.lit('">'))), "")
    lit = F.lit
    html = F.concat(
        lit("<html><head><title>"), f["title"], lit(' | Shop</title><meta itemprop="price" content="'), f["price"], lit('"><meta content="'), f["currency"], lit('" itemprop="priceCurrency"></head><body><nav><a href="/cart">Cart</a> <a href="?page=2" rel="next">Next</a></nav>'),
        lit("<!-- note --><h1 class='t'>"), f["title"], lit('</h1><script>var x = "<h1>no</h1>";</script><div class="gallery">'), pictures_, lit('</div><div class="product-description"><p>'), f["description"], lit('</p></div><section class="tabs"><div class="tab-pane"><h3>Ingredients</h3><div class="panel">'), f["ingredients"],
        lit('</div></div></section><details><summary>Form</summary>'), f["form"], lit("</details><table><tr><th>Supplement Facts</th></tr><tr><td>"), f["supplement_facts"], lit('</td><td></td></tr></table><button data-url="/add/'), F.col("record_id").cast("string"), lit('">'), F.when(F.col("record_id") % 3 == 0, "Sold out").otherwise("Add to cart"), lit("</button></body></html>"),
    )
    # exploded from an array of one, so that the page is set up once and not again for each column read from it
    return crawl.select("record_id", "domain", "product_url", "layer", "captured_at", "fields", F.explode(F.array(html)).alias("html"))


def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML-06, HTML-07, HTML-08, HTML-10, HTML-11: title, hash of the description, price, currency and availability read from each page."""
    pages, none = shop_pages(table(spark, sf_dir, "crawl")), F.lit("")
    h = F.col("html")
    return pages.select("record_id", F.coalesce(H.title(h), none).alias("title"), F.sha2(F.coalesce(H.description(h), none), 256).alias("description_hash"), F.coalesce(H.price(h), none).alias("price"), H.currency(h).alias("currency"), H.availability(h).alias("availability"))


_TEXT = r"trim(regexp_replace(coalesce({c}, ''), '[\s\x{{00A0}}\x{{FEFF}}]+', ' ', 'g'))"
_PRICED = r"TRY_CAST(regexp_replace(regexp_replace(regexp_replace(coalesce(fields.price, ''), '[^0-9.,]', '', 'g'), '[.,][0-9]{1,2}$', ''), '[.,]', '', 'g') || '.' || coalesce(nullif(regexp_extract(regexp_replace(coalesce(fields.price, ''), '[^0-9.,]', '', 'g'), '[.,]([0-9]{1,2})$', 1), ''), '0') AS DECIMAL(18,2))"


def page_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML-03, HTML-04, HTML-05, HTML-12, HTML-13, HTML-14, HTML-16: links, controls, menus, traits, facts tables of each page, whether it tells of an error, and whether its template is that of the same page without texts."""
    h = F.col("html")
    pages = shop_pages(table(spark, sf_dir, "crawl"))
    bare = F.lit('<html><head><title> | Shop</title><meta itemprop="price" content=""><meta content="" itemprop="priceCurrency"></head><body><nav></nav></body></html>')
    return pages.select(
        "record_id", F.array_join(F.transform(H.links(h), lambda x: F.concat_ws("=", x["href"], x["text"])), ",").alias("links"), F.array_join(F.transform(F.filter(H.interactive(h), lambda x: x["tag"] == "button"), lambda x: x["target"]), ",").alias("buttons"),
        F.array_join(F.transform(H.menus(h), lambda m: m["surface"]), ",").alias("menus"), H.is_error_page(h).alias("error"), F.sha2(F.array_join(F.transform(H.traits(h), lambda t: F.concat_ws("=", t["label"], t["value"])), "|"), 256).alias("traits_hash"),
        F.sha2(F.array_join(H.facts_tables(h), "|"), 256).alias("facts_hash"), (H.template_fingerprint(h) == H.template_fingerprint(bare)).alias("bare"),
    )


def page_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML-15, HTML-17, HTML-18: fields of each page by ordered rules, and whether its traits are mere headings."""
    h = F.col("html")
    section = F.coalesce(H.by_rules(h, [("regex", r"(?s)<h9>(.*?)</h9>"), ("tag", "summary")]), F.lit(""))
    button = H.labelled_section(F.regexp_replace(H.to_text(F.regexp_extract(h, "(?s)<details>.*</details>", 0)), "^Form", "Form:"), "form", ["price"])
    return shop_pages(table(spark, sf_dir, "crawl")).select("record_id", section.alias("by_rule"), F.sha2(button, 256).alias("section_hash"), H.is_heading_only(F.array(F.lit("Ingredients"), F.coalesce(F.col("fields.form"), F.lit("")))).alias("headings"))


def image_originals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IMG-01: pictures of all records moved under the addresses of the platforms, with the original and platform found."""
    rows = table(spark, sf_dir, "crawl").select("record_id", F.posexplode("fields.images").alias("pos", "u"))
    name = F.regexp_extract("u", r"([^/?#]+)\.jpg", 1)
    pick = F.pmod(F.col("record_id") + F.col("pos"), F.lit(7))
    made = (
        F.when(pick == 0, F.concat(F.lit("https://a.test/media/catalog/product/cache/0123456789abcdef/"), name, F.lit(".jpg"))).when(pick == 1, F.concat(F.lit("https://a.test/wp-content/uploads/2024/"), name, F.lit("-300x200.jpg")))
        .when(pick == 2, F.concat(F.lit("https://cdn.shopify.com/s/files/1/2/"), name, F.lit("_small.jpg?v=3&width=200"))).when(pick == 3, F.concat(F.lit("https://a.test/images/stencil/100x100/products/"), name, F.lit(".jpg")))
        .when(pick == 4, F.concat(F.lit("https://res.cloudinary.com/acc/image/upload/w_100,c_fill/"), name, F.lit(".jpg"))).when(pick == 5, F.concat(F.lit("https://ik.imagekit.io/acc/tr:w-100/"), name, F.lit(".jpg"))).otherwise(F.concat(F.lit("https://a.test/plain/"), name, F.lit(".jpg")))
    )
    o = I.original(F.col("made"))
    return rows.select("record_id", "pos", made.alias("made")).select("record_id", "pos", o["original"].alias("original"), o["resolver"].alias("resolver"), o["validation_group"].alias("validation_group"))


_ORIGINALS = """
WITH p AS (SELECT record_id, unnest(fields.images) AS u, generate_subscripts(fields.images, 1) - 1 AS pos FROM crawl), n AS (SELECT record_id, CAST(pos AS INTEGER) AS pos, regexp_extract(u, '([^/?#]+)[.]jpg', 1) AS n, (record_id + pos) % 7 AS k FROM p)
SELECT record_id, pos, CASE k WHEN 0 THEN 'https://a.test/media/catalog/product/' || n || '.jpg' WHEN 1 THEN 'https://a.test/wp-content/uploads/2024/' || n || '.jpg' WHEN 2 THEN 'https://cdn.shopify.com/s/files/1/2/' || regexp_replace(n, '_[0-9]{2,5}x[0-9]{2,5}$', CASE WHEN false THEN '' ELSE '\\0' END) || '.jpg?v=3'
  WHEN 3 THEN 'https://a.test/images/stencil/original/products/' || n || '.jpg' WHEN 4 THEN 'https://res.cloudinary.com/acc/image/upload/' || n || '.jpg' WHEN 5 THEN 'https://ik.imagekit.io/acc/' || n || '.jpg' END AS original,
  CASE k WHEN 0 THEN 'magento_catalog_cache' WHEN 1 THEN 'wordpress_dimensions' WHEN 2 THEN 'shopify_transform' WHEN 3 THEN 'bigcommerce_stencil' WHEN 4 THEN 'cloudinary_transform' WHEN 5 THEN 'imagekit_transform' END AS resolver,
  CASE k WHEN 0 THEN 'magento_catalog_cache:https://a.test:0123456789abcdef' WHEN 1 THEN 'wordpress_dimensions:https://a.test' WHEN 2 THEN 'shopify_transform:https://cdn.shopify.com:s/files/1/2' WHEN 3 THEN 'bigcommerce_stencil:https://a.test' WHEN 4 THEN 'cloudinary_transform:https://res.cloudinary.com:acc' WHEN 5 THEN 'imagekit_transform:https://ik.imagekit.io:acc' END AS validation_group
FROM n
"""


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "crawl").select("record_id", "product_url", "layer", F.posexplode("fields.images").alias("idx", "url")).filter(F.trim("url") != "")
    source = F.when(F.col("layer") == "json_ld", "meta").when(F.col("layer") == "browser", "data_zoom_src").otherwise("img_src")
    labels = F.array_compact(F.array(F.when(F.col("idx") == 0, "gallery"), F.when(F.col("idx") % 5 == 4, "facts")))
    return rows.select(F.col("record_id").alias("page"), "idx", "url", labels.alias("labels"), source.alias("source"), (F.col("layer") == "browser").alias("in_gallery"), (F.lit(70) + I.width(F.col("url")) % 10).alias("base"))


def picture_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IMG-07: the best twelve pictures of each record."""
    return pictures.resolve_candidates(_candidates(spark, sf_dir)).select(F.col("page").alias("record_id"), "url", "score", "rank")


def picture_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IMG-10, IMG-11: first pictures of each record with the best candidate of the same picture or file name."""
    all_ = _candidates(spark, sf_dir).select("page", "idx", "url")
    tier = I.tier(F.when(F.col("url").contains("?"), "src").when(F.col("url").contains("#zoom"), "zoom").otherwise("thumb"))
    return pictures.bind_to_rendered(all_.filter("idx = 0"), all_.select("page", "url", tier.alias("tier"))).select(F.col("page").alias("record_id"), "url")


def picture_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IMG-08, IMG-13, IMG-14: of each listing's first picture how well its text fits the name, the kind of facts panel it may show and its rank, and whether pictures are few."""
    rows = table(spark, sf_dir, "enrich_product_output").select("output_id", F.get("images", 0)["url"].alias("url"), F.get("images", 0)["alt"].alias("alt"), "product_name", F.col("images.url").alias("urls"))
    kind = I.facts_kind(F.col("url"), F.col("alt"), F.lit(0))
    return rows.select("output_id", pictures.hint_score(F.col("alt"), F.col("product_name")).alias("hint"), kind.alias("kind"), I.facts_rank(kind).alias("rank"), I.few(F.col("urls")).alias("few"))


def record_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-04, PRJ-05, PRJ-10: identity of each record with its variant, its variant's label and full name."""
    v = records.variant_identity(F.lit(None).cast("string"), F.col("fields.sku"), F.lit(None).cast("array<struct<name: string, value: string>>"), F.lit(""))
    label = records.variant_label(records.normalised_options(F.col("fields.variant_options")), F.lit("Default Title"))
    rows = table(spark, sf_dir, "crawl")
    return rows.select("record_id", records.record_identity(F.col("product_url"), v).alias("identity"), label.alias("label"), records.qualified_name(F.col("fields.title"), label).alias("name"), records.title_case(F.col("fields.form")).alias("form"))


def platform_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-06, PRJ-07: crawl records as variants of a platform's product: default variant and number of those kept per page."""
    rows = table(spark, sf_dir, "crawl").select("record_id", "fields.sku", "fields.title", "fields.price", F.get("fields.variant_options", 0)["value"].alias("o"), (F.col("layer") != "http").alias("available"))
    variant = F.struct(F.lit(None).cast("bigint").alias("id"), "sku", "title", "price", "available", F.col("o").alias("option1"), F.lit(None).cast("string").alias("option2"), F.lit(None).cast("string").alias("option3"))
    none = F.struct(F.lit(None).cast("bigint").alias("id"), F.lit("").alias("sku"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("price"), F.lit(True).alias("available"), *[F.lit(None).cast("string").alias(f"option{i}") for i in (1, 2, 3)])
    kept = records.platform_variants(F.array(variant, none), F.array(F.lit("Size")))
    best = records.default_variant(F.col("kept"))
    return rows.select("record_id", kept.alias("kept")).select("record_id", F.size("kept").alias("n"), best["sku"].alias("sku"), F.array_join(F.transform(best["options"], lambda o: F.concat_ws("=", o["name"], o["value"])), ",").alias("options"))


def missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-01: wanted fields each record lacks, and its name by the first filled of several columns."""
    f = {c: F.col(f"fields.{c}") for c in ("title", "price", "sku", "form")}
    return table(spark, sf_dir, "crawl").select("record_id", F.array_join(records.missing_fields(f), ",").alias("missing"), records.first_filled(f["sku"], f["form"], f["title"]).alias("first_filled"), records.first_given(f["sku"], f["form"], f["title"]).alias("first_given"))


def safe_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL-02, URL-07, URL-12, URL-13, URL-11: whether a record's page may be followed from the address asked for, and its export domain; its picture folder resolved."""
    a, b = F.col("source_url"), F.col("product_url")
    return table(spark, sf_dir, "crawl").select("record_id", F.coalesce(U.same_site(a, b), F.lit(False)).alias("same_site"), U.is_safe_catalogue(a, b).alias("safe"), U.has_placeholder(b).alias("placeholder"), U.export_domain([b, F.col("domain")]).alias("export_domain"), U.resolved(F.lit("https://h.test/a/b/c.html"), F.concat(F.lit("../"), F.col("record_id").cast("string"), F.lit("/./x.png"))).alias("picture"))


def first_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-09, SET-01: records of two passes with the layer their site was first seen in."""
    crawl = table(spark, sf_dir, "crawl")
    passes = sets.union_passes([crawl.filter("layer = 'http'").select("record_id", "domain"), crawl.filter("layer <> 'http'").select("record_id", "domain", "layer")])
    return lookups.first_relation(passes, crawl.select("domain", "ord", F.col("layer").alias("first_layer")), "domain", "ord", "first_layer").select("record_id", "pass_no", "layer", "first_layer")


_WORDS = r"trim(regexp_replace({c}, '[^\pL\pN]+', ' ', 'g'))"
QUERIES = {f.__name__: f for f in (page_fields, page_structure, page_rules, image_originals, picture_ranking, picture_binding, picture_traits, record_identities, platform_variants, missing_fields, safe_links, first_layer)}
_HOST = "regexp_replace(rtrim(regexp_extract(lower(trim({c})), '^https?://(?:[^/?#@]*@)?([^/?#:]*)', 1), '.'), '^www[0-9]?[.]', '')"
_LAST2 = "array_to_string(string_split(" + _HOST + ", '.')[-2:], '.')"
ORACLES = {
    "page_fields": f"""SELECT record_id, CASE WHEN {_TEXT.format(c='fields.title')} = '' THEN '| Shop' ELSE trim(regexp_replace({_TEXT.format(c='fields.title')}, '(?s)\\s\\|.*$', '')) END AS title, sha256(substr({_TEXT.format(c='fields.description')}, 1, 2500)) AS description_hash,
  CASE WHEN coalesce({_PRICED}, 0) > 0 THEN {_TEXT.format(c='fields.price')} ELSE '' END AS price, CASE WHEN regexp_full_match(coalesce(trim(fields.currency), ''), '[A-Za-z]{{3}}') THEN upper(trim(fields.currency)) ELSE '' END AS currency, CASE WHEN record_id % 3 = 0 AND NOT regexp_matches(lower(concat_ws(' ', fields.title, fields.description, fields.ingredients, fields.supplement_facts, fields.form)), '(^|[^a-z0-9_])(in stock|available|dostępny|add to cart)([^a-z0-9_]|$)') THEN 'OutOfStock' ELSE 'InStock' END AS availability FROM crawl""",
    "page_structure": f"""WITH t AS (SELECT record_id, {_TEXT.format(c='fields.ingredients')} AS i, {_TEXT.format(c='fields.form')} AS f, {_TEXT.format(c='fields.supplement_facts')} AS s FROM crawl)
SELECT record_id, '/cart=Cart,?page=2=Next' AS links, '/add/' || record_id AS buttons, 'nav' AS menus, false AS error, sha256(array_to_string(list_filter([CASE WHEN i <> '' THEN 'Ingredients=' || i ELSE 'Ingredients=' END, CASE WHEN f <> '' THEN 'Form=' || f END], lambda x: x IS NOT NULL AND x <> 'Ingredients='), '|')) AS traits_hash,
  sha256('Supplement Facts' || CASE WHEN s <> '' THEN '; ' || s ELSE '' END) AS facts_hash, false AS bare FROM t""",
    "page_rules": f"""SELECT record_id, 'Form' AS by_rule, sha256({_TEXT.format(c='fields.form')}) AS section_hash, regexp_full_match(coalesce(fields.form, ''), '(?i)\\W*(description|details?|ingredients?|directions?|supplement facts|nutrition facts|warnings?|reviews?|overview)\\W*') AS headings FROM crawl""",
    "picture_ranking": """WITH i AS (SELECT record_id, layer, unnest(fields.images) AS u, generate_subscripts(fields.images, 1) - 1 AS idx FROM crawl), c AS (SELECT *, regexp_replace(regexp_replace(u, '#.*$', ''), '^(http:)?//', 'https://') AS k,
  70 + coalesce(try_cast(nullif(regexp_extract(u, '[?&](?:w|width)=([0-9]+)', 1), '') AS INTEGER), 0) % 10 + CASE layer WHEN 'browser' THEN 40 + 36 WHEN 'json_ld' THEN 4 ELSE 16 END + CASE WHEN idx = 0 THEN 30 ELSE 0 END AS score FROM i WHERE trim(u) <> '' AND idx % 5 <> 4),
  b AS (SELECT *, row_number() OVER (PARTITION BY record_id, k ORDER BY score DESC, idx) AS n FROM c), r AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY score DESC, idx) AS rank FROM b WHERE n = 1)
SELECT record_id, u AS url, CAST(score AS INTEGER) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 12""",
    "picture_binding": r"""WITH i AS (SELECT record_id, unnest(fields.images) AS u, generate_subscripts(fields.images, 1) - 1 AS idx FROM crawl), c AS (SELECT record_id, idx, u, regexp_replace(regexp_replace(u, '#.*$', ''), '^(http:)?//', 'https://') AS k,
  lower(regexp_replace(regexp_replace(regexp_extract(regexp_extract(u, '^([^?#]*)', 1), '([^/]*)$', 1), '[.][A-Za-z]{3,4}$', ''), '[-_]([0-9]{2,5}x[0-9]{0,5}|pico|icon|thumb|small|compact|medium|large|grande|master)$', '')) AS n, CASE WHEN contains(u, '?') THEN 2 WHEN contains(u, '#zoom') THEN 3 ELSE 1 END AS tier FROM i WHERE trim(u) <> ''),
  j AS (SELECT a.record_id, b.u, b.tier, CASE WHEN a.k = b.k THEN 1 ELSE 0 END AS direct FROM c a JOIN c b ON a.record_id = b.record_id AND (a.k = b.k OR a.n = b.n) WHERE a.idx = 0)
SELECT record_id, arg_max(u, struct_pack(t := tier, d := direct, u := u)) AS url FROM j GROUP BY 1""",
    "picture_traits": None,
    "record_identities": None,
    "platform_variants": """SELECT record_id, CASE WHEN coalesce(fields.sku, '') <> '' OR coalesce(fields.title, '') <> '' THEN 1 ELSE 0 END AS n, CASE WHEN coalesce(fields.sku, '') <> '' OR coalesce(fields.title, '') <> '' THEN fields.sku END AS sku,
  CASE WHEN coalesce(fields.sku, '') <> '' OR coalesce(fields.title, '') <> '' THEN CASE WHEN coalesce(fields.variant_options[1].value, '') <> '' THEN 'Size=' || fields.variant_options[1].value ELSE '' END END AS options FROM crawl""",
    "missing_fields": f"""WITH t AS (SELECT record_id, fields, {_TEXT.format(c='fields.title')} AS t, {_TEXT.format(c='fields.price')} AS p, {_TEXT.format(c='fields.sku')} AS s, {_TEXT.format(c='fields.form')} AS f FROM crawl)
SELECT record_id, array_to_string(list_filter([CASE WHEN t = '' THEN 'title' END, CASE WHEN p = '' THEN 'price' END, CASE WHEN s = '' THEN 'sku' END, CASE WHEN f = '' THEN 'form' END], lambda x: x IS NOT NULL), ',') AS missing,
  CASE WHEN s <> '' THEN fields.sku WHEN f <> '' THEN fields.form WHEN t <> '' THEN fields.title END AS first_filled, coalesce(fields.sku, fields.form, fields.title) AS first_given FROM t""",
    "safe_links": f"""WITH s AS (SELECT record_id, {_LAST2.format(c='source_url')} AS a, {_LAST2.format(c='product_url')} AS b, regexp_matches(trim(source_url), '(?i)^https?://[^/?#:]') AND regexp_matches(trim(product_url), '(?i)^https?://[^/?#:]') AS http, lower(regexp_extract(trim(product_url), '(?i)^https?://[^/?#]*([^?#]*)', 1)) AS p, contains(product_url, '{{{{') AS ph FROM crawl)
SELECT record_id, coalesce(http AND a = b, false) AS same_site, coalesce(http AND a = b AND NOT regexp_matches(p, '/(cart|basket|checkout|account|login|register|wishlist|search|blog|news|contact|about|privacy|terms|faq|compare|carrito|cuenta|buscar|contacto|acerca|privacidad|condiciones|preguntas-frecuentes)(/|$)') AND regexp_replace(p, '/', '', 'g') <> '', false) AS safe,
  coalesce(ph, false) AS placeholder, b AS export_domain, 'https://h.test/a/' || record_id || '/x.png' AS picture FROM s""",
    "first_layer": "WITH f AS (SELECT domain, arg_min(layer, ord) AS first_layer FROM crawl GROUP BY 1) SELECT record_id, CASE WHEN layer = 'http' THEN 0 ELSE 1 END AS pass_no, CASE WHEN layer <> 'http' THEN layer END AS layer, first_layer FROM crawl LEFT JOIN f USING (domain) WHERE layer IS NOT NULL",
    "image_originals": None,
}
_NAME_OF = "regexp_extract(u, '([^/?#]+)[.]jpg', 1)"
ORACLES["image_originals"] = _ORIGINALS.replace("""regexp_replace(n, '_[0-9]{2,5}x[0-9]{2,5}$', CASE WHEN false THEN '' ELSE '\\0' END)""", "n")
ORACLES["picture_traits"] = r"""
WITH t AS (SELECT output_id, len(images) AS n, images[1].url AS url, images[1].alt AS alt, lower(coalesce(images[1].url || ' ' || images[1].alt, images[1].url, images[1].alt, '')) AS x, product_name FROM enrich_product_output),
v AS (SELECT *, list_filter(string_split(trim(regexp_replace(translate(lower(product_name), 'àáâãäåçèéêëìíîïñòóôõöøùúûüýÿčďěňřšťůžąćęłńśźżőű', 'aaaaaaceeeeiiiinoooooouuuuyycdenrstuzacelnszzou'), '[^\pL\pN]+', ' ', 'g')), ' '), lambda v: len(v) >= 3 AND NOT regexp_full_match(v, '[0-9]+') AND v NOT IN ('the', 'and', 'with', 'for', 'from', 'product', 'products', 'complement', 'alimentaire')) AS hh,
  trim(regexp_replace(translate(lower(coalesce(alt, '')), 'àáâãäåçèéêëìíîïñòóôõöøùúûüýÿčďěňřšťůžąćęłńśźżőű', 'aaaaaaceeeeiiiinoooooouuuuyycdenrstuzacelnszzou'), '[^\pL\pN]+', ' ', 'g')) AS a FROM t),
w AS (SELECT *, list_filter(hh, lambda x, i: list_position(hh, x) = i) AS h FROM v),
k AS (SELECT *, len(list_filter(coalesce(h, []), lambda v: contains(a, v))) AS m, CASE WHEN regexp_matches(x, 'drug[-_ ]?facts') THEN 'drug_facts' WHEN regexp_matches(x, 'supplement[-_ ]?facts') THEN 'supplement_facts' WHEN regexp_matches(x, 'product[-_ ]?facts') THEN 'product_facts' WHEN regexp_matches(x, 'nutrition[-_ ]?(facts|information|label)') THEN 'nutrition_facts'
  WHEN regexp_matches(x, '(^|[^a-z])(facts|ingredients|label|back)([^a-z]|$)') THEN 'ambiguous' ELSE 'ignore' END AS kind FROM w)
SELECT output_id, CAST(CASE WHEN len(coalesce(h, [])) >= 2 AND contains(a, array_to_string(h, ' ')) THEN 3 WHEN m >= 2 THEN 2 ELSE m END AS INTEGER) AS hint, kind, CAST(CASE WHEN kind = 'ignore' THEN NULL WHEN kind = 'ambiguous' THEN 2 ELSE 1 END AS INTEGER) AS rank, coalesce(n, 0) < 2 AS few FROM k
"""
ORACLES["record_identities"] = r"""
WITH p AS (SELECT *, list_filter(string_split(regexp_extract(trim(product_url), '^[^?#]*[?]([^#]*)', 1), '&'), lambda q: q <> '' AND NOT regexp_matches(lower(q), '^(categorycode|utm_|fbclid|gclid|currency|lang)')) AS kept,
  regexp_extract(trim(product_url), '(?i)^https?://[^/?#]*([^?#]*)', 1) AS raw, lower(regexp_extract(trim(product_url), '^([A-Za-z]+)://', 1)) AS scheme, rtrim(regexp_extract(lower(trim(product_url)), '^https?://(?:[^/?#@]*@)?([^/?#:]*)', 1), '.') AS host, regexp_extract(lower(trim(product_url)), '^https?://[^/?#]*?:([0-9]+)', 1) AS port,
  array_to_string(list_filter(list_transform(fields.variant_options, lambda o: trim(regexp_replace(coalesce(o.value, ''), '[\s\x{00A0}\x{202F}]+', ' ', 'g'))), lambda v: v <> ''), ' / ') AS label FROM crawl),
u AS (SELECT *, CASE WHEN host <> '' THEN scheme || '://' || host || CASE WHEN port = '' OR (scheme = 'http' AND port = '80') OR (scheme = 'https' AND port = '443') THEN '' ELSE ':' || port END || CASE WHEN raw = '/' AND len(kept) = 0 THEN '' ELSE raw END || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS url, coalesce(label, '') AS l FROM p)
SELECT record_id, concat_ws('::', url, CASE WHEN coalesce(trim(fields.sku), '') <> '' THEN 'sku:' || lower(trim(fields.sku)) END) AS identity, l AS label, CASE WHEN l = '' OR contains(lower(fields.title), lower(l)) THEN fields.title ELSE substr(fields.title || ' — ' || l, 1, 360) END AS name,
  CASE WHEN fields.form = lower(fields.form) THEN array_to_string(list_transform(string_split(array_to_string(list_transform(string_split(array_to_string(list_transform(string_split(fields.form, ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' '), '/'), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '/'), '-'), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), '-') ELSE fields.form END AS form FROM u
"""


def link_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-02: role and score of each record's address as a category link and as a menu entry, its form taken for the link's text."""
    u, t, css = F.col("product_url"), F.coalesce("fields.form", F.lit("Shop All")), F.when(F.col("layer") == "http", "site-nav").otherwise("x")
    role, kind = L.category_role(t, u), L.menu_kind(t, u)
    return table(spark, sf_dir, "crawl").select("record_id", role.alias("role"), L.category_score(t, u, css, role).alias("score"), kind.alias("kind"), L.menu_score(t, u, css, kind).alias("menu_score"))


def next_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-04: next page of listings set up for each record: by rel, by text, by a control, by number, or none."""
    k = F.col("record_id") % 5
    base = F.concat(F.lit("https://"), F.lower("domain"), F.lit("/c/teas?page="), (F.col("record_id") % 7 + 1).cast("string"))
    links = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda n: F.concat(F.lit('<a href="?page='), n.cast("string"), F.lit('">'), n.cast("string"), F.lit("</a>"))), " ")
    html = F.when(k == 0, F.concat(links, F.lit('<link href="/c/teas/page/77/" rel="prefetch next">'))).when(k == 1, F.concat(F.lit("<a title='Siguiente' href='/c/teas?p=55'>+</a>"), links)).when(k == 2, F.concat(links, F.lit('<button data-url="/c/teas?page=33">Load more</button><button data-url="/c/teas?page=22">Show more</button>'))).when(k == 3, links).otherwise(F.lit('<a href="https://other.test/c?page=2">next</a><a href="/cart?page=9">next</a>'))
    rows = table(spark, sf_dir, "crawl").filter(F.col("domain").rlike(r"^[A-Za-z0-9.-]+$")).select("record_id", base.alias("base"), html.alias("html"))
    rows = rows.select("record_id", F.explode(F.array(F.struct("base", "html"))).alias("p"))
    return rows.select("record_id", L.next_page(F.col("p.html"), F.col("p.base")).alias("next"))


QUERIES |= {"link_roles": link_roles, "next_pages": next_pages}
ORACLES["next_pages"] = """
SELECT record_id, CASE record_id % 5 WHEN 0 THEN 'https://' || lower(domain) || '/c/teas/page/77/' WHEN 1 THEN 'https://' || lower(domain) || '/c/teas?p=55' WHEN 2 THEN 'https://' || lower(domain) || '/c/teas?page=22'
  WHEN 3 THEN 'https://' || lower(domain) || '/c/teas?page=' || (record_id % 7 + 2) END AS next FROM crawl WHERE regexp_matches(domain, '^[A-Za-z0-9.-]+$')
"""
ORACLES["link_roles"] = """
WITH u AS (SELECT record_id, coalesce(fields.form, 'Shop All') AS t, coalesce(layer = 'http', false) AS nav, lower(regexp_extract(trim(product_url), '^(?:[Hh][Tt][Tt][Pp][Ss]?:)?//[^/?#]*([^?#]*)', 1)) AS path, regexp_matches(trim(product_url), '(?i)^https?://[^/?#]') AS http FROM crawl),
n AS (SELECT *, regexp_replace(regexp_replace(path, '/{2,}', '/', 'g'), '/$', '') AS bare, regexp_matches(path, '/(menu|category|categories|collection|collections|catalog|shop|store)(/|$)') AS listed FROM u),
c AS (SELECT *, http AND bare <> '' AND CASE WHEN listed THEN regexp_matches(path, '/(product|products|produs|produit|producto)/') ELSE regexp_matches(path, '/(product|products|produs|produit|producto|produkt|item|p)/') END AS product,
  lower(trim(t)) = 'shop all' OR regexp_matches(bare, '(/collections/(all|shop-all)|/(all-products|shop-all|products|shop|store)|/menu/shop-[0-9]+[.]html)$') AS every FROM n),
r AS (SELECT *, NOT product AND http AND bare <> '' AND (listed OR regexp_matches(path, '/(products|produkty|produits|productos|produkte)(/|$)')) OR regexp_matches(lower(t), 'shop') AS part, len(list_filter(string_split(bare, '/'), lambda s: s <> '')) <= 3 AS short FROM c),
k AS (SELECT *, CASE WHEN product THEN NULL WHEN every THEN 'all' WHEN part THEN 'category' END AS role, CASE WHEN every THEN 'all' WHEN product THEN 'products' WHEN part THEN 'category' ELSE 'unknown' END AS kind FROM r)
SELECT record_id, role, CAST(CASE WHEN role IS NOT NULL THEN CASE WHEN role = 'all' THEN 100 ELSE 50 END + CASE WHEN role = 'all' AND lower(trim(t)) = 'shop all' THEN 25 ELSE 0 END + CASE WHEN short THEN 10 ELSE 0 END + CASE WHEN nav THEN 5 ELSE 0 END END AS INTEGER) AS score, kind,
  CAST(40 + CASE kind WHEN 'all' THEN 60 WHEN 'products' THEN 25 WHEN 'category' THEN 20 ELSE 0 END + CASE WHEN short THEN 10 ELSE 0 END + CASE WHEN nav THEN 5 ELSE 0 END + CASE WHEN lower(trim(t)) = 'shop all' THEN 10 ELSE 0 END AS INTEGER) AS menu_score FROM k
"""


def gallery_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IMG-06: picture candidates read from the page of each record."""
    pages = shop_pages(table(spark, sf_dir, "crawl")).select("record_id", "product_url", "html", "fields.title")
    found = gallery.picture_candidates(pages, "record_id", "product_url")
    return found.select(F.col("page").alias("record_id"), "url", "source", "base")


QUERIES |= {"gallery_candidates": gallery_candidates}
ORACLES["gallery_candidates"] = r"""
WITH i AS (SELECT DISTINCT record_id, CASE WHEN starts_with(trim(u), '//') THEN regexp_extract(product_url, '^([A-Za-z]+:)', 1) || trim(u) ELSE trim(u) END AS url FROM (SELECT record_id, product_url, unnest(fields.images) AS u FROM crawl))
SELECT record_id, url, 'img_src' AS source, CAST(75 + CASE WHEN regexp_matches(lower(url), '/(cdn/shop/files|wp-content/uploads|media/catalog/product|image/cache/catalog)/') THEN 25 ELSE 0 END + CASE WHEN regexp_matches(lower(url), 'product|packshot|gallery|hero|zoom|large|master|pdp|fiche|detail') THEN 15 ELSE 0 END
  + CASE WHEN regexp_matches(lower(url), '[?&](width|height|w|h)=([89][0-9]{2,}|[0-9]{4,})') THEN 10 ELSE 0 END + CASE WHEN regexp_matches(lower(url), '[.](png|jpe?g|webp)([?#]|$)') THEN 8 ELSE 0 END AS INTEGER) AS base
FROM i WHERE regexp_matches(url, '^https?://') AND regexp_matches(url, '(?i)[.](jpe?g|png|webp|gif)([?#]|$)')
"""
