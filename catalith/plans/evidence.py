"""Queries of the operators that validate evidence, on the test tables, each with its SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions import text as T
from catalith.operators import evidence as E
from catalith.operators import lookups, stats
from catalith.plans.catalogue import _filled
from catalith.runtime import table

_BASIS = "CASE basis WHEN 'image' THEN 'visual_image_read' WHEN 'title' THEN 'dom_recheck' ELSE basis END"
_SURFACE = "CASE confidence WHEN 'high' THEN 'live_site' WHEN 'medium' THEN 'dom_snapshot' ELSE confidence END"


def _trace() -> Column:
    return F.struct(F.col("value").alias("verdict"), F.expr(_BASIS).alias("method"), F.expr(_SURFACE).alias("surface"), F.transform("evidence", lambda e: e["excerpt"]).alias("evidence"), F.col("rationale").alias("verifier"))


def trace_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-01: errors of each inference read as a verification trace."""
    return table(spark, sf_dir, "inference").select("inference_id", F.array_join(E.trace_errors(_trace()), ",").alias("errors"))


_TRACE_SQL = f"""
SELECT inference_id, array_to_string(list_filter([CASE WHEN coalesce(trim(value), '') = '' THEN 'trace_verdict_missing' END,
  CASE WHEN coalesce(trim({_BASIS}), '') NOT IN ('visual_image_read', 'dom_recheck', 'live_site_reopen', 'artifact_audit', 'count_reconcile', 'coverage_audit') THEN 'trace_method_invalid:' || coalesce(nullif(trim({_BASIS}), ''), 'missing') END,
  CASE WHEN coalesce(trim({_SURFACE}), '') NOT IN ('local_file', 'dom_snapshot', 'live_site', 'artifacts') THEN 'trace_surface_invalid:' || coalesce(nullif(trim({_SURFACE}), ''), 'missing') END,
  CASE WHEN coalesce(len(list_filter(evidence, lambda e: coalesce(trim(e.excerpt), '') <> '')), 0) = 0 THEN 'trace_evidence_missing' END, CASE WHEN coalesce(trim(rationale), '') = '' THEN 'trace_verifier_missing' END], lambda x: x IS NOT NULL), ',') AS errors FROM inference
"""


def _package(rows: DataFrame) -> DataFrame:
    """Crawl records as evidence packages: pictures with https count as saved, filled texts as opened sections, the embedded layer as embedded data."""
    texts = ["description", "ingredients", "supplement_facts"]
    saved = F.concat(F.size(F.filter("fields.images", lambda u: u.startswith("https:"))).cast("string"), F.lit("/"), F.size("fields.images").cast("string"))
    sections = F.array_compact(F.array(*[F.when(T.is_filled(F.col(f"fields.{t}")), F.lit(t)) for t in texts]))
    gaps = E.coverage_gaps(saved, F.size("fields.images"), sections, F.col("layer") == "json_ld")
    flags = F.array_compact(F.array(F.when(F.col("fields.ingredients").rlike("(?i)^ingredients:?$"), "heading_only_ingredients"), F.when(F.col("captured_at").isNull(), "image_download_failed:all")))
    return rows.select("record_id", "domain", "product_url", "fields", gaps.alias("gaps"), flags.alias("flags"))


_IMG = "coalesce(len(fields.images), -1)"
_PACKAGE_SQL = f"""
WITH s AS (SELECT *, {_filled('fields.description')} AS d, {_filled('fields.ingredients')} AS i, {_filled('fields.supplement_facts')} AS f FROM crawl),
p AS (SELECT *, list_filter([CASE WHEN fields.images IS NULL THEN 'gallery_coverage_unrecorded' WHEN len(list_filter(fields.images, lambda u: starts_with(u, 'https:'))) < len(fields.images) THEN 'gallery_images_unsaved:' || (len(fields.images) - len(list_filter(fields.images, lambda u: starts_with(u, 'https:')))) END,
  CASE WHEN NOT (d OR i OR f) THEN 'dom_sections_not_expanded' END, CASE WHEN coalesce(layer, '') <> 'json_ld' THEN 'json_ld_not_captured' END], lambda x: x IS NOT NULL) AS gaps,
  list_filter([CASE WHEN regexp_matches(fields.ingredients, '(?i)^ingredients:?$') THEN 'heading_only_ingredients' END, CASE WHEN captured_at IS NULL THEN 'image_download_failed:all' END], lambda x: x IS NOT NULL) AS flags FROM s)
"""


def evidence_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-02, VAL-04: gaps of each record's evidence, and whether it may be read."""
    gaps = E.queue_gaps(F.col("gaps"), F.col("flags"))
    return _package(table(spark, sf_dir, "crawl")).select("record_id", F.array_join(gaps, ",").alias("gaps"), F.when(F.size(gaps) > 0, "needs_browser").otherwise("pending").alias("status"))


def evidence_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-11: errors of each record's evidence package; pictures with a file name of their own size count as saved."""
    gallery = F.transform("fields.images", lambda u: F.struct(u.alias("url"), F.when(~u.contains("?"), u).alias("local_path")))
    return _package(table(spark, sf_dir, "crawl")).select("record_id", F.array_join(E.evidence_errors(F.col("product_url"), F.col("fields.title"), gallery, F.col("flags")), " ").alias("errors"))


def not_found_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-03, VAL-05, AGG-03: for records without ingredients, what to do about it by the site's share of records that have them, and errors of the claim without a trace."""
    packages = _package(table(spark, sf_dir, "crawl")).withColumn("filled", T.is_filled(F.col("fields.ingredients")))
    rates = stats.presence(packages, ["domain"], {"ingredients": F.col("filled")}).select("domain", (F.col("n_ingredients") / F.col("n")).alias("rate"))
    rows = packages.filter(~F.col("filled")).join(rates, "domain")
    claim = E.not_present_errors(F.lit("ingredients"), F.col("gaps"), F.lit(None).cast("struct<verdict: string, method: string, surface: string, evidence: array<string>, verifier: string>"))
    return rows.select("record_id", E.not_found_action(F.col("gaps"), F.col("rate"), F.lit(False)).alias("action"), F.array_join(claim, ",").alias("claim_errors"))


def _evidence_gaps(listings: DataFrame, inferences: DataFrame) -> DataFrame:
    """JOIN-08: (output_id, gaps): what of each listing's form, functions and ingredients no backed inference of its page holds. Values meet inferences by equi-join."""
    key = lambda c: F.lower(F.coalesce(T.squeeze(c), F.lit("")))
    basis = F.when(F.col("basis").isin("title", "facts_panel"), "explicit").otherwise("inferred")
    good = inferences.filter(E.is_backed(F.col("value"), basis, F.col("confidence"), F.col("rationale"), F.col("evidence"))).select("product_url", "field", key(F.col("value")).alias("v")).distinct().withColumn("hit", F.lit(True))
    one = lambda field, values: F.transform(values, lambda v: F.struct(F.lit(field).alias("field"), key(v).alias("v")))
    empty = F.array().cast("array<struct<field: string, v: string>>")
    wanted = F.concat(one("form", F.array_compact(F.array(T.squeeze(F.col("product_form"))))), F.coalesce(one("health_functions", F.col("health_functions")), empty), F.coalesce(one("main_ingredients", F.col("main_ingredients.name")), empty))
    rows = listings.select("output_id", "product_url", F.explode(wanted).alias("w")).select("output_id", "product_url", "w.*").join(good, ["product_url", "field", "v"], "left")
    return rows.filter("hit IS NULL").groupBy("output_id").agg(F.sort_array(F.collect_set(F.replace(F.replace(F.concat("field", F.lit("_evidence")), F.lit("functions"), F.lit("function")), F.lit("ingredients"), F.lit("ingredient")))).alias("gaps"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = table(spark, sf_dir, "enrich_product_output")
    return listings.join(_evidence_gaps(listings, table(spark, sf_dir, "inference")), "output_id", "left").withColumn("gaps", F.coalesce("gaps", F.array().cast("array<string>")))


def semantic_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-07: what each listing's meaning still lacks; a gallery of up to two pictures counts as reviewed."""
    few = F.slice("images.url", 1, 2)
    missing = E.semantic_missing(F.col("product_form"), F.col("health_functions"), F.col("main_ingredients"), F.lit("visual_complete"), F.col("images.url"), few, F.col("gaps"))
    return _judged(spark, sf_dir).select("output_id", F.array_join(missing, ",").alias("missing"))


def export_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-10: fields each listing lacks for a strict export; listings of the channel 'site' stand for those of the HTTP channel."""
    names = {"productUrl": "product_url", "channel": "channel", "sourceUrl": "source_url", "capturedAt": "captured_at", "crawlScope": "crawl_scope", "source": "source", "price": "price", "productForm": "product_form", "healthFunctions": "health_functions", "mainIngredients": "main_ingredients"}
    row = {k: F.col(c) for k, c in names.items()} | {"images": F.col("images.url")}
    missing = E.export_missing(row, F.col("gaps"), F.when(F.col("channel") == "site", E.HTTP_SOURCE), F.lit("visual_complete"), F.slice("images.url", 1, 2))
    return _judged(spark, sf_dir).select("output_id", F.array_join(missing, ",").alias("missing"))


def record_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-11: why each crawl record is only partial."""
    fields = {f: T.is_filled(F.col(f"fields.{f}")) for f in ("title", "price", "description", "ingredients", "supplement_facts")} | {"images": F.size("fields.images") > 0}
    reasons = E.completion_reasons(fields, F.col("product_url"), F.col("fields.images"), F.when(F.col("layer") == "browser", "visual_complete"), F.col("fields.images"))
    return table(spark, sf_dir, "crawl").select("record_id", F.array_join(reasons, ",").alias("reasons"), F.when(F.size(reasons) == 0, "complete").otherwise("partial").alias("status"))


def aligned_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-01, JOIN-02: functions of each listing with those the vocabulary knows and the phrases it doesn't, in order."""
    rows = table(spark, sf_dir, "enrich_product_output").select("output_id", F.posexplode("health_functions").alias("pos", "phrase")).filter("phrase IS NOT NULL")
    matched = lookups.match_vocabulary(rows, "phrase", table(spark, sf_dir, "vocabulary").filter("kind = 'health_functions'"), table(spark, sf_dir, "vocabulary_alias"))
    out = lookups.align_lists(matched, ["output_id"], "phrase", "pos")
    return out.select("output_id", F.array_join("matched", "|").alias("matched"), F.array_join("unmatched", "|").alias("unmatched"))


def uncovered_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-04: pictures of each listing that its page's records do not show."""
    shown = table(spark, sf_dir, "crawl").select(F.col("product_url").alias("source_url"), F.explode("fields.images").alias("u")).groupBy("source_url").agg(F.collect_set("u").alias("shown"))
    rows = table(spark, sf_dir, "enrich_product_output").select("output_id", "source_url", F.col("images.url").alias("wanted")).join(shown, "source_url", "left")
    return rows.select("output_id", F.size(lookups.uncovered(F.col("wanted"), F.col("shown"))).alias("n_uncovered"))


_BACKED = """coalesce(trim(value), '') <> '' AND confidence IN ('high', 'medium') AND (coalesce(basis, '') IN ('title', 'facts_panel') OR coalesce(trim(rationale), '') <> '')
  AND len(evidence) > 0 AND len(list_filter(evidence, lambda e: coalesce(trim(e.source), '') = '' OR coalesce(trim(e.excerpt), '') = '')) = 0"""
_SQUEEZED = r"lower(trim(regexp_replace(coalesce({c}, ''), '[\s\x{{0085}}\x{{00A0}}\x{{1680}}\x{{2000}}-\x{{200B}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\x{{FEFF}}]+', ' ', 'g')))"
_GAPS_SQL = f"""
good AS (SELECT DISTINCT product_url, field, {_SQUEEZED.format(c='value')} AS v FROM inference WHERE {_BACKED}),
w AS (SELECT output_id, product_url, 'form' AS field, {_SQUEEZED.format(c='product_form')} AS v FROM enrich_product_output WHERE {_SQUEEZED.format(c='product_form')} <> ''
  UNION ALL SELECT output_id, product_url, 'health_functions', {_SQUEEZED.format(c='x')} FROM (SELECT output_id, product_url, unnest(health_functions) AS x FROM enrich_product_output)
  UNION ALL SELECT output_id, product_url, 'main_ingredients', {_SQUEEZED.format(c='x.name')} FROM (SELECT output_id, product_url, unnest(main_ingredients) AS x FROM enrich_product_output)),
g AS (SELECT output_id, list_sort(list_distinct(list(CASE field WHEN 'form' THEN 'form_evidence' WHEN 'health_functions' THEN 'health_function_evidence' ELSE 'main_ingredient_evidence' END))) AS gaps FROM w
  WHERE NOT EXISTS (SELECT 1 FROM good WHERE good.product_url = w.product_url AND good.field = w.field AND good.v = w.v) GROUP BY 1),
j AS (SELECT e.*, coalesce(g.gaps, []) AS gaps FROM enrich_product_output e LEFT JOIN g USING (output_id))
"""
_UNCLASSIFIED = "len(list_filter(main_ingredients, lambda m: coalesce(trim(m.name), '') = '' OR coalesce(trim(m.substance), '') = '' OR coalesce(trim(m.category), '') = '')) > 0"
_MANY = "coalesce(len(list_filter(list_transform(images, lambda i: i.url), lambda u: NOT list_contains(list_transform(images, lambda i: i.url)[1:2], u))), 0) > 0"
_BLANK = "CASE WHEN coalesce(trim(CAST({c} AS VARCHAR)), '') = '' THEN '{n}' END"

QUERIES = {f.__name__: f for f in (trace_audit, evidence_queue, evidence_packages, not_found_actions, semantic_completion, export_gate, record_completion, aligned_functions, uncovered_images)}
ORACLES = {
    "trace_audit": _TRACE_SQL,
    "evidence_queue": _PACKAGE_SQL + "SELECT record_id, array_to_string(list_concat(gaps, flags), ',') AS gaps, CASE WHEN len(gaps) + len(flags) > 0 THEN 'needs_browser' ELSE 'pending' END AS status FROM p",
    "evidence_packages": _PACKAGE_SQL + r""", e AS (SELECT record_id, list_filter([CASE WHEN NOT coalesce(regexp_matches(trim(product_url), '(?i)^https?://[^/?#:]'), false) THEN 'evidence_product_url_invalid' END, CASE WHEN coalesce(trim(fields.title), '') = '' THEN 'evidence_title_missing' END], lambda x: x IS NOT NULL) AS own,
  list_filter(flatten(list_transform(coalesce(fields.images, []), lambda u, i: [CASE WHEN NOT coalesce(regexp_matches(trim(u), '(?i)^https?://[^/?#:]'), false) THEN 'evidence_image_url_invalid:' || (i - 1) END, CASE WHEN (coalesce(trim(u), '') = '' OR contains(u, '?')) AND captured_at IS NOT NULL THEN 'evidence_image_not_saved:' || coalesce(trim(u), '') END])), lambda x: x IS NOT NULL) AS pics FROM p)
SELECT record_id, array_to_string(list_concat(own, pics), ' ') AS errors FROM e""",
    "not_found_actions": _PACKAGE_SQL + """, r AS (SELECT domain, avg(CASE WHEN i THEN 1.0 ELSE 0.0 END) AS rate FROM p GROUP BY 1)
SELECT record_id, CASE WHEN len(gaps) > 0 THEN 'fill_gaps' WHEN rate >= 0.5 THEN 'second_look' ELSE 'accept_not_present' END AS action, array_to_string(list_concat(list_transform(gaps, lambda x: 'not_present_coverage_gap:' || x), ['trace_not_object']), ',') AS claim_errors FROM p JOIN r USING (domain) WHERE NOT i""",
    "semantic_completion": f"""WITH {_GAPS_SQL} SELECT output_id, array_to_string(list_concat(list_filter([CASE WHEN coalesce(trim(product_form), '') = '' THEN 'form' END, CASE WHEN coalesce(len(health_functions), 0) = 0 THEN 'health_function' END,
  CASE WHEN coalesce(len(main_ingredients), 0) = 0 THEN 'main_ingredients' WHEN {_UNCLASSIFIED} THEN 'main_ingredient_taxonomy' END, CASE WHEN {_MANY} THEN 'gallery_review' END], lambda x: x IS NOT NULL), gaps), ',') AS missing FROM j""",
    "export_gate": f"""WITH {_GAPS_SQL}, h AS (SELECT *, coalesce(channel = 'site', false) AS http FROM j) SELECT output_id, array_to_string(list_filter([{", ".join(_BLANK.format(c=c, n=n) for c, n in (("product_url", "productUrl"), ("channel", "channel"), ("source_url", "sourceUrl"), ("captured_at", "capturedAt"), ("crawl_scope", "crawlScope"), ("source", "source"), ("price", "price")))},
  CASE WHEN coalesce(len(images), 0) = 0 THEN 'images' END, {_BLANK.format(c='product_form', n='productForm')}, CASE WHEN coalesce(len(health_functions), 0) = 0 THEN 'healthFunctions' END, CASE WHEN coalesce(len(main_ingredients), 0) = 0 AND NOT http THEN 'mainIngredients' END,
  CASE WHEN coalesce(len(main_ingredients), 0) > 0 AND {_UNCLASSIFIED} THEN 'mainIngredientTaxonomy' END, CASE WHEN list_contains(gaps, 'form_evidence') OR list_contains(gaps, 'health_function_evidence') OR (list_contains(gaps, 'main_ingredient_evidence') AND NOT http) THEN 'semanticEvidence' END,
  CASE WHEN NOT http AND {_MANY} THEN 'galleryReview' END], lambda x: x IS NOT NULL), ',') AS missing FROM h""",
    "record_completion": f"""WITH r AS (SELECT record_id, list_filter([{", ".join(f"CASE WHEN NOT {_filled('fields.' + f)} THEN 'field:{f}' END" for f in ("title", "price", "description", "ingredients", "supplement_facts"))}, CASE WHEN coalesce(len(fields.images), 0) = 0 THEN 'field:images' END,
  CASE WHEN NOT coalesce(regexp_matches(trim(product_url), '(?i)^https?://[^/?#:]'), false) OR regexp_matches(product_url, '(?i)#inline-product=') THEN 'product_url:not_real_detail_url' END, CASE WHEN coalesce(layer, '') <> 'browser' THEN 'gallery:visual_review_required' END], lambda x: x IS NOT NULL) AS x FROM crawl)
SELECT record_id, array_to_string(x, ',') AS reasons, CASE WHEN len(x) = 0 THEN 'complete' ELSE 'partial' END AS status FROM r""",
    "uncovered_images": """WITH s AS (SELECT product_url AS source_url, flatten(list(fields.images)) AS shown FROM crawl WHERE fields.images IS NOT NULL GROUP BY 1)
SELECT output_id, CAST(coalesce(len(list_distinct(list_filter(list_transform(images, lambda i: i.url), lambda u: NOT list_contains(coalesce(shown, []), u)))), 0) AS INTEGER) AS n_uncovered FROM enrich_product_output LEFT JOIN s USING (source_url)""",
}
_VKEY = "regexp_replace(trim(regexp_replace(regexp_replace(replace(lower({c}), '&', ' and '), '[''’]', '', 'g'), '[^a-z0-9]+', ' ', 'g'), ' '), 's$', '')"
ORACLES["aligned_functions"] = f"""
WITH n AS (SELECT {_VKEY.format(c="name")} AS k, arg_max(name, id) AS name FROM vocabulary WHERE kind = 'health_functions' GROUP BY 1), a AS (SELECT {_VKEY.format(c="alias")} AS k, min(canonical) AS c FROM vocabulary_alias GROUP BY 1),
b AS (SELECT a.k, v.name FROM a JOIN (SELECT DISTINCT name FROM vocabulary WHERE kind = 'health_functions') v ON v.name = a.c), h AS (SELECT output_id, unnest(health_functions) AS phrase, generate_subscripts(health_functions, 1) AS pos FROM enrich_product_output),
m AS (SELECT h.*, coalesce(n.name, b.name) AS name FROM h LEFT JOIN n ON n.k = {_VKEY.format(c="phrase")} LEFT JOIN b ON b.k = {_VKEY.format(c="phrase")} WHERE phrase IS NOT NULL),
f AS (SELECT output_id, coalesce(name, '?' || lower(phrase)) AS e, min(pos) AS p, arg_min(name, pos) AS name, arg_min(phrase, pos) AS phrase FROM m GROUP BY 1, 2)
SELECT output_id, coalesce(string_agg(name, '|' ORDER BY p) FILTER (name IS NOT NULL), '') AS matched, coalesce(string_agg(phrase, '|' ORDER BY p) FILTER (name IS NULL), '') AS unmatched FROM f GROUP BY 1
"""
