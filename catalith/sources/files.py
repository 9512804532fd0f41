"""Readers of captured files: catalogue pages, sitemaps, site lists, profiles, state files, network logs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions import html as H
from catalith.functions import urls as U

#: Schema of one product of a shop platform's JSON catalogue.
PRODUCT = (
    "struct<handle:string,title:string,body_html:string,product_type:string,vendor:string,tags:array<string>,options:array<struct<name:string,position:int,values:array<string>>>,"
    "images:array<struct<src:string,width:int,height:int,position:int>>,variants:array<struct<id:bigint,title:string,option1:string,option2:string,option3:string,sku:string,price:string,available:boolean>>>"
)
PAGE_SIZE, MAX_PAGES = 250, 40


def catalogue_pages(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-01: (page, products, ok) of stored catalogue pages named page-N.json; pages that aren't JSON with products are not ok."""
    raw = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json").select(F.regexp_extract(F.input_file_name(), r"page-(\d+)\.json$", 1).cast("int").alias("page"), "value")
    parsed = raw.withColumn("products", F.from_json("value", f"struct<products:array<{PRODUCT}>>")["products"])
    return parsed.select("page", "products", F.col("products").isNotNull().alias("ok"))


def catalogue_products(pages: DataFrame, page_size: int = PAGE_SIZE, max_pages: int = MAX_PAGES) -> DataFrame:
    """SRC-01, SRC-03: products of the pages up to the first missing, empty or short one, with page and place; the ceiling bounds the scan."""
    ends = pages.filter(~F.col("ok") | (F.size("products") < page_size)).agg(F.min("page").alias("end"))
    shown = pages.filter(F.col("ok") & (F.col("page") <= max_pages)).join(F.broadcast(ends), F.col("page") <= F.coalesce(F.col("end"), F.lit(max_pages)), "inner")
    return shown.select("page", F.posexplode("products").alias("place", "product"))


def is_truncated(pages: DataFrame, page_size: int = PAGE_SIZE, max_pages: int = MAX_PAGES) -> DataFrame:
    """SRC-01: one row: whether the scan was cut at the ceiling by a full last page, and whether a page within it failed."""
    last = F.max_by(F.when(F.col("ok"), F.size("products")).otherwise(0), "page")
    return pages.filter(F.col("page") <= max_pages).agg(((F.max("page") == max_pages) & (last == page_size)).alias("truncated"), F.coalesce(F.bool_or(~F.col("ok")), F.lit(False)).alias("failed_page"))


def product_records(products: DataFrame, site: str) -> DataFrame:
    """SRC-04: one record per catalogue product: detail address, texts, pictures, category; products without a title are dropped."""
    p = F.col("product")
    category = F.array_join(F.array_compact(F.concat(F.array(p["product_type"]), F.coalesce(p["tags"], F.array().cast("array<string>")))), ", ")
    rows = products.filter(F.coalesce(F.trim(p["title"]) != "", F.lit(False)))
    return rows.select(
        F.concat(F.lit(site.rstrip("/") + "/products/"), p["handle"]).alias("source_url"), p["title"].alias("title"), H.to_text(p["body_html"]).alias("description"), category.alias("category"),
        p["vendor"].alias("vendor"), F.transform(p["images"], lambda i: i["src"]).alias("images"), p["options"].alias("options"), p["variants"].alias("variants"), F.lit("json_catalogue").alias("layer"),
    )


def product_data_url(url: str) -> str | None:
    """SRC-10: address of the JSON of one product page of the platform, None for other pages."""
    import re

    m = re.match(r"^(https?://[^/?#]+(?:/[^?#]*)?/products/[^/?#.]+)", url)
    return m.group(1) + ".json" if m else None


def sitemap_entries(spark: SparkSession, path: str, max_children: int = 5) -> DataFrame:
    """SRC-05: (kind, url, rank) of stored sitemap files: children of an index by priority (the first ones only), product and category addresses."""
    text = spark.read.text(path, wholetext=True).select(F.col("value").alias("xml"))
    locs = text.select(F.col("xml").rlike(r"(?i)<sitemapindex[\s>]").alias("is_index"), F.posexplode(F.regexp_extract_all("xml", F.lit(r"(?is)<loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</loc>"), F.lit(1))).alias("pos", "loc"))
    url = H.decode(F.col("loc"))
    priority = F.when(url.rlike("(?i)product"), 3).when(url.rlike("(?i)collection|categor"), 2).when(url.rlike("(?i)page"), 1).otherwise(0)
    kind = F.when(F.col("is_index"), "child").when(U.is_product(url), "product").when(U.is_category(url), "category").otherwise("other")
    rows = locs.select(kind.alias("kind"), url.alias("url"), priority.alias("priority"), "pos")
    from pyspark.sql import Window

    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("priority"), "pos")))
    return ranked.filter((F.col("kind") != "child") | (F.col("rank") <= max_children)).filter("kind != 'other'").select("kind", "url", "rank")


def site_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC-07: different registrable domains of a site list: first column of lines, header, comments, blanks and quotes skipped."""
    lines = spark.read.text(path).select(F.trim(F.regexp_replace(F.element_at(F.split("value", ","), 1), '"', "")).alias("site"))
    kept = lines.filter((F.col("site") != "") & ~F.col("site").startswith("#") & ~F.lower("site").isin("url", "domain", "site", "website"))
    url = F.when(F.col("site").rlike("(?i)^https?://"), F.col("site")).otherwise(F.concat(F.lit("https://"), F.col("site")))
    return kept.select(U.registrable_domain(url).alias("domain")).filter("domain != ''").distinct()


def captured_pages(pages: DataFrame) -> DataFrame:
    """SRC-06: pages(url, html) with body, whether it is markup, and status: raw text shown in a <pre> is unpacked, a blank body counts as 404."""
    shown = F.regexp_extract("html", r"(?is)<body[^>]*>\s*<pre[^>]*>(.*?)</pre>\s*</body>", 1)
    raw = H.decode(shown).rlike(r"^\s*[\[{<]")
    return pages.withColumn("is_markup", ~F.coalesce(raw, F.lit(False))).withColumn("body", F.when(raw, H.decode(shown)).otherwise(F.col("html"))).withColumn("status", F.when(F.coalesce(F.trim("body"), F.lit("")) == "", 404).otherwise(200))


def profile_file_name(url: str) -> str:
    """SRC-08: file of a site's profile: safe host and ten digits of the SHA-256 of its origin."""
    import hashlib
    import re
    from urllib.parse import urlsplit

    parts = urlsplit(url)
    site = f"{parts.scheme.lower()}://{(parts.hostname or '').lower()}"
    return f"{re.sub(r'[^a-z0-9.-]+', '-', (parts.hostname or '').lower())}-{hashlib.sha256(site.encode()).hexdigest()[:10]}.json"


def profiles(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """SRC-08: stored profiles with their file, unreadable ones with status read_failed."""
    raw = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json").select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("file"), F.from_json("value", schema).alias("profile"), F.try_parse_json("value").isNotNull().alias("readable"))
    return raw.select("file", F.when(F.col("readable"), F.col("profile")).alias("profile"), F.when(F.col("readable"), "ok").otherwise("read_failed").alias("status"))


def json_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """SRC-09: a JSON file as one row with `readable`, None where there is no such file."""
    local = path.removeprefix("file://")
    if not os.path.exists(local):
        return None
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.from_json("value", schema).alias("value"), F.try_parse_json("value").isNotNull().alias("readable"))


#: Bodies of responses above this many bytes are left out (the feature's bound).
MAX_BODY = 2_000_000


def matched_responses(events: DataFrame, rules: DataFrame, per_rule: int = 8) -> DataFrame:
    """SRC-12: network responses that match a rule(rule, resource_type, part[, pattern]): same type or none given, address holds the part and fits the
    pattern where given; the first per rule. Responses with a `body` above MAX_BODY bytes are left out.

    The rules are a bounded list read by the driver and tried on each response where it is read: no join, so no pairs of rows and rules.
    """
    from pyspark.sql import Window

    from catalith.runtime import bounded_rows

    columns = rules.columns
    tests = []
    for r in bounded_rows(rules):
        ok = F.col("url").isNotNull()
        for wanted, test in ((r["resource_type"], lambda v: F.col("resource_type") == v), (r["part"], lambda v: F.contains(F.col("url"), F.lit(v))), (r["pattern"] if "pattern" in columns else None, lambda v: F.col("url").rlike(v))):
            ok = ok & test(wanted) if wanted is not None else ok
        tests.append(F.when(ok, F.lit(r["rule"])))
    responses = events.filter(F.col("method") == "Network.responseReceived")
    if "body" in events.columns:
        responses = responses.filter(F.coalesce(F.octet_length("body"), F.lit(0)) <= MAX_BODY)
    found = F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")
    hit = responses.select("*", F.explode(found).alias("rule"))
    return hit.withColumn("nth", F.row_number().over(Window.partitionBy("rule").orderBy("seq"))).filter(F.col("nth") <= per_rule)
