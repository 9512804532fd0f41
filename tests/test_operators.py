import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from catalith import runtime
from catalith.operators import lookups, records, sets, stats, timeline
from catalith.sinks import files as sink
from catalith.sources import files as source
from catalith.sources.paged import PagedCatalogue
from catalith.streaming import progress
from tests.conftest import rows


def test_runtime(spark, tmp_path):
    df = spark.range(5)
    assert rows(runtime.materialise(df, "t")) == [(i,) for i in range(5)]
    with pytest.raises(ValueError):
        runtime.bounded_rows(df, 4)
    assert rows(runtime.literal_table(spark, [("it's \\", None, True), ("b", 2, False)], "a string, b int, c boolean")) == sorted([("it's \\", None, True), ("b", 2, False)], key=repr)
    side = runtime.dimension(df)
    assert "hint" not in side._jdf.queryExecution().toString().lower() and rows(side) == [(i,) for i in range(5)]


def test_shared_folder_is_never_machine_local_on_a_cluster():
    class Session:
        def __init__(self, master, named=None):
            self.sparkContext = self
            self.master, self.named, self.conf = master, named, self

        def get(self, *_):
            return self.named

        def getConf(self):
            return self

        def set(self, *_):
            pass

    assert runtime.shared_dir(Session("yarn", "hdfs:///x/")) == "hdfs:///x"
    assert runtime.shared_dir(Session("local[4]")).startswith("file:///")
    for master in ("yarn", "local-cluster[3,2,1000]", "spark://h:7077"):
        with pytest.raises(ValueError):
            runtime.shared_dir(Session(master))


def test_variants(spark):
    schema = "v array<struct<id:bigint,sku:string,title:string,price:string,available:boolean,option1:string,option2:string,option3:string,image_url:string>>, images array<string>, title string"
    df = spark.createDataFrame([([(1, "s", "A", "1", False, "30", None, None, "b"), (2, None, "B", "2", None, "60", "Mint", None, None), (None, "", None, None, True, None, None, None, None)], ["a", "b"], "T A"), ([], ["a"], "x"), (None, None, None)], schema)
    v = df.select(records.platform_variants(F.col("v"), F.array(F.lit("Count"))).alias("v")).collect()
    assert [len(r["v"]) if r["v"] is not None else None for r in v] == [2, 0, None] and v[0]["v"][1]["options"][1]["name"] == "Option 2"
    assert [r[0]["id"] if r[0] else None for r in df.select(records.default_variant(F.col("v"))).collect()] == [2, None, None]
    out = rows(records.expand_variants(df, "v").select("variant_pos", "images"))
    assert (0, ["b", "a"]) in out and (-1, ["a"]) in out and len(out) == 5
    names = df.select(records.qualified_name(F.col("title"), F.lit("a"))).collect()
    assert [r[0] for r in names] == ["T A", "x — a", None]
    o = spark.createDataFrame([([(" Size ", "1"), ("size", "1"), ("x", None), ("", "y")],)], "o array<struct<name:string,value:string>>").select(records.normalised_options(F.col("o"))).first()[0]
    assert [tuple(x) for x in o] == [("Size", "1"), ("x", ""), ("", "y")]
    assert records.missing_fields({"a": F.lit("x"), "b": F.lit(" "), "c": F.lit(None)}) is not None


def test_merge_is_independent_of_partitions(spark):
    data = [("https://a/p/x", 3, "late", "EUR", ["https://i/1.jpg?w=9", "https://i/2.jpg"]), ("https://a/p/x?utm_source=1", 1, " ", "USD", ["http://i/1.jpg?w=9"]), ("https://a/p/x", 2, "early", None, []), (None, 4, "no", "x", None)]
    df = spark.createDataFrame(data, "url string, ord bigint, title string, currency string, images array<string>")
    from catalith.functions import urls as U

    results = {str(rows(records.merge_records(df.repartition(n), U.page_key(F.col("url")), "ord", ["title"], "images", ["currency"], F.col("title")))) for n in (1, 4, 30)}
    assert len(results) == 1
    r = records.merge_records(df, U.page_key(F.col("url")), "ord", ["title"], "images", ["currency"]).first()
    assert (r["title"], r["images"], r["currency_conflicts"], r["n_records"]) == ("early", ["https://i/1.jpg?w=9", "https://i/2.jpg"], ["EUR", "USD"], 3)
    assert records.merge_records(df.limit(0), F.col("url"), "ord", ["title"]).collect() == []
    p = spark.range(1).select(records.provenance({"a": F.lit(1), "b": F.lit(None)}, F.lit("s"))).first()[0]
    assert p == {"a": "s"}


def test_lookups(spark):
    vocabulary = spark.createDataFrame([("1", "Gut Health"), ("2", "Focus"), ("3", "Focuss")], "id string, name string")
    aliases = spark.createDataFrame([("Belly", "Gut Health"), ("Focus", "Gut Health")], "alias string, canonical string")
    values = spark.createDataFrame([(1, i, v) for i, v in enumerate(["gut-health", "BELLY", "focus", "nothing", None])], "k int, pos int, phrase string")
    matched = lookups.match_vocabulary(values, "phrase", vocabulary, aliases)
    assert {r["phrase"]: r["entry_id"] for r in matched.collect()} == {"gut-health": "1", "BELLY": "1", "focus": "2", "nothing": None, None: None}
    aligned = lookups.align_lists(matched.filter("phrase IS NOT NULL"), ["k"], "phrase", "pos").first()
    assert aligned["matched"][0] == "Gut Health" and aligned["unmatched"] == ["nothing"]
    audit = lookups.key_audit(spark.createDataFrame([(1,), (1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int"), "k")
    assert rows(audit) == sorted([(1, "missing"), (1, "duplicate_left"), (3, "orphan")], key=repr)
    assert spark.range(1).select(lookups.uncovered(F.array(F.lit("a"), F.lit("b")), F.lit(None).cast("array<string>"))).first()[0] == ["a", "b"]
    gaps = spark.createDataFrame([(["A", "b"], [("B",)])], "v array<string>, i array<struct<value:string>>").select(lookups.has_inference(F.col("v"), F.col("i"))).first()[0]
    assert gaps == ["A"]
    merged = records.merge_values(spark.createDataFrame([(1, "b", "Zinc "), (1, "a", "zinc"), (1, "c", "Iron"), (1, "d", " ")], "k int, o string, v string"), ["k"], "v", "o").first()["values"]
    assert merged == ["zinc", "Iron"]


def test_times(spark):
    at = dt.datetime(2025, 1, 1)
    data = [("a", i, at + dt.timedelta(minutes=m), k) for i, (m, k) in enumerate([(0, "x"), (5, "y"), (60, "x"), (61, "x"), (62, "y")])]
    df = spark.createDataFrame(data, "u string, id int, ts timestamp_ntz, k string")
    assert [r[2] for r in rows(timeline.sessions(df, ["u"], "ts", ["id"], 600).select("session", "started", "n_events"))] == [2, 3]
    assert [r["streak"] for r in timeline.streaks(df, ["u"], ["ts", "id"], F.col("k") == "y").orderBy("id").collect()] == [1, 0, 1, 2, 0]
    assert timeline.current_state(df, ["u"], "k", ["ts", "id"]).first()["state"] == "y"
    assert spark.range(1).select(timeline.is_fresh(F.lit(None).cast("timestamp"), F.current_timestamp())).first()[0] is True


def test_sets_and_stats(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 5)], "src int, dst int")
    assert rows(sets.reachable(edges, spark.createDataFrame([(1,)], "node int"))) == [(1, 0), (2, 1), (3, 2)]
    union = sets.union_passes([spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "b string")])
    assert rows(union.select("a", "b", "pass_no")) == sorted([(1, None, 0), (None, "x", 1)], key=repr)
    v = spark.createDataFrame([("s", "v%d" % (i % 6)) for i in range(12)] + [("s", " "), ("t", "a")], "site string, vendor string")
    assert rows(stats.vendor_diversity(v, ["site"], "vendor")) == [("s", 12, 6, 2, True), ("t", 1, 1, 1, False)]
    assert rows(stats.coverage(v.limit(0), {"a": F.lit(True)})) == [("a", 0, 0, 0.0)]


def test_closure_of_a_long_chain_equals_brute_force(spark):
    links = [(i, i + 1) for i in range(105)] + [(i, 1000 + i) for i in range(0, 105, 10)] + [(50, 3), (7, None), (60, None), (1050, 104), (3000, 3001)]
    reached, frontier, n = {0: 0}, {0}, 0
    while frontier:
        n += 1
        frontier = {b for a, b in links if a in frontier} - reached.keys()
        reached |= dict.fromkeys(frontier, n)
    assert max(reached.values()) > 100
    edges, seeds = spark.createDataFrame(links, "src int, dst int"), spark.createDataFrame([(0,)], "node int")
    assert rows(sets.reachable(edges, seeds)) == sorted(reached.items(), key=repr)
    with pytest.raises(ValueError):
        sets.reachable(edges, seeds, max_rounds=3)


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [1]), (1, None, []), (2, "b", None)], "r int, name string, xs array<int>")
    export = sink.build_export(df, ["r"], {"name": F.col("name").isNotNull()})
    assert rows(export.rows.select("r")) == [(2,)] and export.errors.first()["missing"] == ["name"] and tuple(export.summary.first()) == (3, 2)
    assert sink.write_gated(export, True, str(tmp_path / "a")) == "candidates"
    assert sink.write_gated(sink.build_export(df, ["r"], {"r": F.lit(True)}), True, str(tmp_path / "b"), "csv") == "formal"
    assert spark.read.option("header", True).csv(str(tmp_path / "b/formal")).count() == 3
    assert json.loads(sink.envelope(df.filter("r = 2")).first()[0]) == {"json": {"r": 2, "name": "b"}}
    sink.write_json_atomic({"a": 1}, str(tmp_path / "s.json"))
    assert json.loads((tmp_path / "s.json").read_text()) == {"a": 1}


def test_sources(spark, tmp_path):
    product = {"handle": "h", "title": "T", "body_html": "<p>x</p>", "product_type": "P", "tags": ["t"], "images": [{"src": "i"}], "variants": []}
    (tmp_path / "c").mkdir()
    for n, body in ((1, {"products": [product, product | {"title": " "}]}), (2, {"products": [product]}), (3, None)):
        (tmp_path / f"c/page-{n}.json").write_text(json.dumps(body) if body else "<html>")
    pages = source.catalogue_pages(spark, str(tmp_path / "c"))
    assert source.catalogue_products(pages, page_size=2).count() == 3
    assert tuple(source.is_truncated(pages, page_size=1, max_pages=2).first()) == (True, False)
    assert source.product_records(source.catalogue_products(pages, 2), "https://s.example/").first()["source_url"] == "https://s.example/products/h"
    spark.dataSource.register(PagedCatalogue)
    read = spark.read.format("paged_catalogue").option("template", f"file://{tmp_path}/c/page-{{page}}.json").option("pages", "4").load()
    assert [r["body"] is not None for r in read.orderBy("page").collect()] == [True, True, True, False]
    (tmp_path / "m.xml").write_text("<urlset><url><loc> https://s.example/products/a?x=1&amp;y=2 </loc></url><url><loc>https://s.example/collections/b</loc></url><url><loc>https://s.example/about</loc></url></urlset>")
    assert rows(source.sitemap_entries(spark, str(tmp_path / "m.xml")).select("kind", "url")) == [("category", "https://s.example/collections/b"), ("product", "https://s.example/products/a?x=1&y=2")]
    (tmp_path / "l.csv").write_text('url,name\n"https://www.a.example/x",1\n\n# c\nB.EXAMPLE,2\na.example\n')
    assert rows(source.site_list(spark, str(tmp_path / "l.csv"))) == [("a.example",), ("b.example",)]
    p = spark.createDataFrame([("u", '<html><body><pre>{"a": 1}</pre></body></html>'), ("v", " ")], "url string, html string")
    assert [(r["is_markup"], r["status"]) for r in source.captured_pages(p).collect()] == [(False, 200), (True, 404)]
    assert source.product_data_url("https://a.example/products/x?y=1") == "https://a.example/products/x.json" and source.product_data_url("https://a.example/x") is None
    assert source.json_or_none(spark, str(tmp_path / "none.json"), "a int") is None
    (tmp_path / "pr").mkdir()
    (tmp_path / "pr" / source.profile_file_name("https://A.example/x")).write_text('{"v": 4}')
    (tmp_path / "pr/bad.json").write_text("{")
    assert sorted(r["status"] for r in source.profiles(spark, str(tmp_path / "pr"), "v int").collect()) == ["ok", "read_failed"]
    log = spark.createDataFrame([(1, "Network.responseReceived", "Image", "https://a/x.jpg"), (2, "Network.responseReceived", "XHR", "https://a/x"), (3, "other", "Image", "https://a/x")], "seq int, method string, resource_type string, url string")
    rules = spark.createDataFrame([("r", "Image", "a/x"), ("s", None, "a/x")], "rule string, resource_type string, part string")
    assert rows(source.matched_responses(log, rules).select("rule", "seq")) == [("r", 1), ("s", 1), ("s", 2)]


def test_streams_equal_batches(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts", "event_type")
    events.repartition(3).write.parquet(str(tmp_path / "in"))

    def run(frame, name, mode="append"):
        frame.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination(120)
        return spark.table(name)

    read = lambda: spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    counts = run(progress.stream_counts(read(), ["event_type"], "ts", "1 day", "1 hour"), "counts", "complete")
    batch = events.groupBy("event_type", F.window(F.col("ts").cast("timestamp"), "1 day").alias("w")).count()
    assert rows(counts.select("event_type", "started", "n")) == rows(batch.select("event_type", "w.start", "count"))
    closed = run(progress.stream_sessions(read(), ["user_id"], "ts", "12 hours", "1 hour"), "sess")
    whole = timeline.sessions(events, ["user_id"], "ts", ["event_id"], 12 * 3600).select("user_id", F.col("started").cast("timestamp"), "n_events")
    assert 0 < closed.count() <= whole.count() and not set(rows(closed.select("user_id", "started", "n_events"))) - set(rows(whole))
    new = run(progress.stream_new_keys(read(), ["user_id"], "ts", "3650 days"), "fresh")
    assert new.count() == events.select("user_id").distinct().count()
    alarms = run(progress.stream_idle_alarms(read(), "user_id", "ts", 3600, "1 hour"), "alarms")
    assert 0 < alarms.count() <= whole.count() + events.count()
