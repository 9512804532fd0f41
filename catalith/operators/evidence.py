"""Validation of what records claim: verification traces, coverage of evidence, inferences that back values, completeness of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions import urls as U

# How and on what a verdict may be reached, what an inference may rest on and how sure it may be.
METHODS = ["visual_image_read", "dom_recheck", "live_site_reopen", "artifact_audit", "count_reconcile", "coverage_audit"]
SURFACES = ["local_file", "dom_snapshot", "live_site", "artifacts"]
BASES, CONFIDENCES = ["explicit", "inferred"], ["high", "medium"]
#: From this share of a site's records on, a field that is missing counts as a surprise.
SURPRISE = 0.5
#: Source of evidence without detail pages: records from it need no ingredients, facts and gallery review.
HTTP_SOURCE = "http_catalogue"


def _text(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit(""))


def _list(*items: Column) -> Column:
    return F.array_compact(F.array(*items))


def trace_errors(trace: Column) -> Column:
    """VAL-01: what a verification trace, struct(verdict, method, surface, evidence, verifier), lacks, in a fixed order; empty for a valid one."""
    method, surface = _text(trace["method"]), _text(trace["surface"])
    named = lambda c: F.when(c == "", "missing").otherwise(c)
    evidence = F.filter(trace["evidence"], lambda e: _text(e) != "")
    found = _list(
        F.when(_text(trace["verdict"]) == "", F.lit("trace_verdict_missing")), F.when(~method.isin(METHODS), F.concat(F.lit("trace_method_invalid:"), named(method))), F.when(~surface.isin(SURFACES), F.concat(F.lit("trace_surface_invalid:"), named(surface))),
        F.when(F.coalesce(F.size(evidence), F.lit(0)) <= 0, F.lit("trace_evidence_missing")), F.when(_text(trace["verifier"]) == "", F.lit("trace_verifier_missing")),
    )
    return F.when(trace.isNull(), F.array(F.lit("trace_not_object"))).otherwise(found)


def coverage_gaps(gallery_saved: Column, gallery_size: Column, sections: Column, json_ld: Column) -> Column:
    """VAL-02: where a page was not looked at: pictures saved ('3/5') against pictures there, sections opened, embedded data read; empty for full coverage."""
    saved, total = (F.regexp_extract(_text(gallery_saved), r"^(\d+)/(\d+)$", i).try_cast("bigint") for i in (1, 2))
    size = F.coalesce(gallery_size, F.lit(0))
    return _list(
        F.when(total.isNull(), F.lit("gallery_coverage_unrecorded")).when(saved < total, F.concat(F.lit("gallery_images_unsaved:"), (total - saved).cast("string"))), F.when((size > 0) & (total != size), F.lit("gallery_coverage_count_mismatch")),
        F.when(F.coalesce(F.size(F.filter(sections, lambda s: _text(s) != "")), F.lit(0)) <= 0, F.lit("dom_sections_not_expanded")), F.when(~F.coalesce(json_ld, F.lit(False)), F.lit("json_ld_not_captured")),
    )


def not_present_errors(field: Column, gaps: Column, trace: Column) -> Column:
    """VAL-03: why a claim that a field is not on a page can't be taken: no field, gaps of coverage, errors of its trace."""
    return F.concat(_list(F.when(_text(field) == "", F.lit("not_present_field_missing"))), F.transform(gaps, lambda g: F.concat(F.lit("not_present_coverage_gap:"), g)), trace_errors(trace))


def queue_gaps(gaps: Column, flags: Column) -> Column:
    """VAL-04: what keeps a record from being read: gaps of coverage and flags of pictures not loaded or sections that are mere headings; a record without any is pending."""
    blocking = F.filter(F.coalesce(flags, F.array().cast("array<string>")), lambda f: f.startswith("image_download_failed") | (f == "heading_only_ingredients"))
    return F.concat(gaps, blocking)


def not_found_action(gaps: Column, presence_rate: Column, looked_twice: Column, surprise: float = SURPRISE) -> Column:
    """VAL-05: what to do where a field was not found: fill the gaps of coverage, look again where most records of the site show the field, or accept."""
    again = ~F.coalesce(looked_twice, F.lit(False)) & F.coalesce(presence_rate >= surprise, F.lit(False))
    return F.when(F.size(gaps) > 0, "fill_gaps").when(again, "second_look").otherwise("accept_not_present")


def evidence_errors(url: Column, title: Column, gallery: Column, flags: Column) -> Column:
    """PRJ-11: errors of an evidence package: address, title, and per picture of `gallery`, array of struct(url, local_path), its address and whether it was saved
    (not asked where a flag tells of failed downloads)."""
    failed = F.exists(F.coalesce(flags, F.array().cast("array<string>")), lambda f: f.startswith("image_download_failed"))
    http = lambda c: F.coalesce(U.is_http(_text(c)), F.lit(False))
    pictures = F.transform(
        F.coalesce(gallery, F.array().cast("array<struct<url: string, local_path: string>>")),
        lambda g, i: _list(F.when(~http(g["url"]), F.concat(F.lit("evidence_image_url_invalid:"), i.cast("string"))), F.when((_text(g["local_path"]) == "") & ~failed, F.concat(F.lit("evidence_image_not_saved:"), _text(g["url"])))),
    )
    return F.concat(_list(F.when(~http(url), F.lit("evidence_product_url_invalid")), F.when(_text(title) == "", F.lit("evidence_title_missing"))), F.flatten(pictures))


def is_backed(value: Column, basis: Column, confidence: Column, rationale: Column, evidence: Column) -> Column:
    """Whether an inference holds: a value, a known basis, enough confidence, a rationale where it was inferred, and evidence whose every item names source and excerpt."""
    whole = (F.size(evidence) > 0) & F.forall(evidence, lambda e: (_text(e["source"]) != "") & (_text(e["excerpt"]) != ""))
    reasoned = (basis != "inferred") | (_text(rationale) != "")
    return F.coalesce((_text(value) != "") & basis.isin(BASES) & confidence.isin(CONFIDENCES) & reasoned & whole, F.lit(False))


def _filled_list(c: Column) -> Column:
    return F.coalesce(F.size(c) > 0, F.lit(False))


def _unclassified(ingredients: Column) -> Column:
    return F.exists(ingredients, lambda m: (_text(m["name"]) == "") | (_text(m["substance"]) == "") | (_text(m["category"]) == ""))


def _reviewed(status: Column, images: Column, reviewed: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.coalesce(status == "visual_complete", F.lit(False)) & (F.size(F.array_except(F.coalesce(images, empty), F.coalesce(reviewed, empty))) == 0)


def semantic_missing(form: Column, functions: Column, ingredients: Column, review_status: Column, images: Column, reviewed: Column, gaps: Column) -> Column:
    """VAL-07: what a record's meaning still lacks, in a fixed order: form, functions, ingredients or their taxonomy, gallery review, then gaps of evidence; empty for complete."""
    has = _filled_list(ingredients)
    own = _list(
        F.when(_text(form) == "", F.lit("form")), F.when(~_filled_list(functions), F.lit("health_function")), F.when(~has, F.lit("main_ingredients")).when(_unclassified(ingredients), F.lit("main_ingredient_taxonomy")),
        F.when(~_reviewed(review_status, images, reviewed), F.lit("gallery_review")),
    )
    return F.concat(own, F.coalesce(gaps, F.array().cast("array<string>")))


def export_missing(row: dict[str, Column], gaps: Column, evidence_source: Column, review_status: Column, reviewed: Column, require_price: bool = True) -> Column:
    """VAL-10: fields a record lacks for a strict export, in a fixed order; empty lets it pass.

    `row` gives productUrl, channel, sourceUrl, capturedAt, crawlScope, source, price, images (addresses), productForm, healthFunctions and mainIngredients. Records of
    the HTTP channel have no detail page: they need no ingredients, facts reviews and gallery review, but what they have must be whole.
    """
    http = F.coalesce(evidence_source == HTTP_SOURCE, F.lit(False))
    absent = lambda name: F.when(_text(row[name].cast("string")) == "", F.lit(name))
    gap = lambda name: F.coalesce(F.array_contains(gaps, name), F.lit(False))
    has = _filled_list(row["mainIngredients"])
    unbacked = gap("form_evidence") | gap("health_function_evidence") | (gap("main_ingredient_evidence") & ~http)
    return _list(
        *[absent(n) for n in ("productUrl", "channel", "sourceUrl", "capturedAt", "crawlScope", "source")], *([absent("price")] if require_price else []),
        F.when(~_filled_list(row["images"]), F.lit("images")), absent("productForm"), F.when(~_filled_list(row["healthFunctions"]), F.lit("healthFunctions")),
        F.when(~has & ~http, F.lit("mainIngredients")), F.when(has & _unclassified(row["mainIngredients"]), F.lit("mainIngredientTaxonomy")), F.when(unbacked, F.lit("semanticEvidence")),
        F.when(gap("facts_source_review") & ~http, F.lit("factsSourceReview")), F.when(gap("facts_ingredient_review") & ~http, F.lit("factsIngredientReview")),
        F.when(~http & ~_reviewed(review_status, row["images"], reviewed), F.lit("galleryReview")),
    )


def completion_reasons(fields: dict[str, Column], url: Column, images: Column, review_status: Column, reviewed: Column) -> Column:
    """VAL-11: why a record is only partial: required fields without a value, an address that leads to no page of its own, a gallery not reviewed; empty for complete."""
    inline = F.coalesce(F.lower(F.regexp_extract(url, "#(.*)$", 1)).startswith("inline-product="), F.lit(False))
    missing = [F.when(~F.coalesce(filled, F.lit(False)), F.lit(f"field:{name}")) for name, filled in fields.items()]
    gallery = [F.when(~_reviewed(review_status, images, reviewed), F.lit("gallery:visual_review_required"))] if "images" in fields else []
    return _list(*missing, F.when(~U.is_http(url) | inline, F.lit("product_url:not_real_detail_url")), *gallery)
