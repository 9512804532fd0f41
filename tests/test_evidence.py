from pyspark.sql import functions as F

from catalith.operators import evidence as E
from catalith.sinks import files as sink
from catalith.sources import files as source
from tests.conftest import rows

TRACE = "t struct<verdict: string, method: string, surface: string, evidence: array<string>, verifier: string>"


def test_traces(spark):
    data = [(("v", "dom_recheck", "live_site", ["e"], "x"),), ((" ", "guess", None, [" ", None], ""),), (None,), (("v", None, "live_site", None, "x"),)]
    got = [r[0] for r in spark.createDataFrame(data, TRACE).select(E.trace_errors(F.col("t"))).collect()]
    assert got == [[], ["trace_verdict_missing", "trace_method_invalid:guess", "trace_surface_invalid:missing", "trace_evidence_missing", "trace_verifier_missing"], ["trace_not_object"], ["trace_method_invalid:missing", "trace_evidence_missing"]]


def test_gaps_and_what_follows(spark):
    data = [("3/3", 3, ["a"], True, 0.9, False), ("2/5", 4, [" "], None, 0.9, False), (None, None, None, None, None, None), ("3/3", 3, ["a"], True, 0.9, True), ("0/0", 0, ["a"], True, 0.4, False)]
    df = spark.createDataFrame(data, "saved string, n int, sections array<string>, ld boolean, rate double, twice boolean").withColumn("gaps", E.coverage_gaps(F.col("saved"), F.col("n"), F.col("sections"), F.col("ld")))
    got = [(r["gaps"], r["a"]) for r in df.select("gaps", E.not_found_action(F.col("gaps"), F.col("rate"), F.col("twice")).alias("a")).collect()]
    assert got[0] == ([], "second_look") and got[3] == ([], "accept_not_present") and got[4] == ([], "accept_not_present")
    assert got[1] == (["gallery_images_unsaved:3", "gallery_coverage_count_mismatch", "dom_sections_not_expanded", "json_ld_not_captured"], "fill_gaps")
    assert got[2] == (["gallery_coverage_unrecorded", "dom_sections_not_expanded", "json_ld_not_captured"], "fill_gaps")
    flags = spark.createDataFrame([(["image_download_failed:1", "other", "heading_only_ingredients"],), (None,)], "f array<string>")
    assert [r[0] for r in flags.select(E.queue_gaps(F.array().cast("array<string>"), F.col("f"))).collect()] == [["image_download_failed:1", "heading_only_ingredients"], []]


def test_packages(spark):
    schema = "u string, t string, g array<struct<url: string, local_path: string>>, f array<string>"
    data = [("https://a/x", "T", [("https://a/1.jpg", "1.jpg")], None), (" ", None, [("x", None), ("https://a/2.jpg", " ")], []), (None, "T", None, ["image_download_failed"]), ("https://a/x", "T", [("https://a/1.jpg", None)], ["image_download_failed:2"])]
    got = [r[0] for r in spark.createDataFrame(data, schema).select(E.evidence_errors(F.col("u"), F.col("t"), F.col("g"), F.col("f"))).collect()]
    assert got == [[], ["evidence_product_url_invalid", "evidence_title_missing", "evidence_image_url_invalid:0", "evidence_image_not_saved:x", "evidence_image_not_saved:https://a/2.jpg"], ["evidence_product_url_invalid"], []]


def test_backed_inferences(spark):
    schema = "v string, b string, c string, r string, e array<struct<source: string, excerpt: string>>"
    ev = [("s", "x")]
    data = [("v", "explicit", "high", None, ev), ("v", "inferred", "medium", "why", ev), ("v", "inferred", "medium", " ", ev), ("v", "explicit", "low", None, ev), ("v", "explicit", "high", None, []), ("v", "explicit", "high", None, [("s", " ")]), (None, "explicit", "high", None, ev), ("v", None, None, None, None)]
    assert [r[0] for r in spark.createDataFrame(data, schema).select(E.is_backed(*[F.col(x) for x in "vbcre"])).collect()] == [True, True, False, False, False, False, False, False]


def test_strict_export_waives_for_the_http_channel(spark):
    schema = "url string, at timestamp, images array<string>, fn array<string>, ing array<struct<name: string, substance: string, category: string>>, src string"
    df = spark.createDataFrame([("u", None, ["a"], ["f"], [], "http_catalogue"), ("u", None, ["a"], ["f"], [], None), ("u", None, None, None, [("n", None, "c")], None)], schema)
    row = {"productUrl": F.col("url"), "channel": F.lit("c"), "sourceUrl": F.col("url"), "capturedAt": F.col("at"), "crawlScope": F.lit("s"), "source": F.lit("s"), "price": F.lit("1"), "images": F.col("images"), "productForm": F.lit("caps"), "healthFunctions": F.col("fn"), "mainIngredients": F.col("ing")}
    got = [r[0] for r in df.select(E.export_missing(row, F.array(F.lit("main_ingredient_evidence"), F.lit("facts_source_review")), F.col("src"), F.lit(None).cast("string"), F.col("images"))).collect()]
    assert got == [["capturedAt"], ["capturedAt", "mainIngredients", "semanticEvidence", "factsSourceReview", "galleryReview"], ["capturedAt", "images", "healthFunctions", "mainIngredientTaxonomy", "semanticEvidence", "factsSourceReview", "galleryReview"]]


def test_closed_gate_leaves_no_formal_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "r int, name string")
    good, bad = sink.build_export(df.filter("r = 1"), ["r"], {"name": F.col("name").isNotNull()}), sink.build_export(df, ["r"], {"name": F.col("name").isNotNull()})
    assert sink.write_gated(good, True, str(tmp_path)) == "formal" and (tmp_path / "formal").exists()
    assert sink.write_gated(good, False, str(tmp_path)) == "candidates" and not (tmp_path / "formal").exists()
    assert sink.write_gated(bad, True, str(tmp_path)) == "candidates" and spark.read.json(str(tmp_path / "report")).first()["valid_rows"] == 1
    assert sink.write_gated(good, True, str(tmp_path)) == "formal" and sorted(p.name for p in tmp_path.iterdir()) == ["formal"]


def test_export_columns(spark, sf_dir, tmp_path):
    sink.write(spark.read.parquet(f"{sf_dir}/enrich_product_output.parquet"), str(tmp_path / "x"), "export")
    files = [p.read_text(encoding="utf-8") for p in (tmp_path / "x").glob("part-*.csv")]
    assert files and all(f.startswith("﻿domain,productName,productUrl,channel,externalId,") and f.split("\n")[0].count(",") == 25 for f in files)


def test_rules_of_responses(spark):
    log = spark.createDataFrame([(1, "Network.responseReceived", "Image", "https://a/x.jpg", "b"), (2, "Network.responseReceived", "XHR", "https://a/x?page=3", "x" * 2_000_001), (3, "Network.responseReceived", "XHR", "https://a/x?page=4", None), (4, "Network.responseReceived", None, None, None)], "seq int, method string, resource_type string, url string, body string")
    rules = spark.createDataFrame([("r", None, "a/x", r"page=\d"), ("s", "Image", None, None)], "rule string, resource_type string, part string, pattern string")
    assert rows(source.matched_responses(log, rules).select("rule", "seq", "nth")) == [("r", 3, 1), ("s", 1, 1)]
    assert source.matched_responses(log, rules.limit(0)).collect() == [] and source.matched_responses(log.limit(0), rules).collect() == []
