import json

from catalith.operators import nesting
from catalith.plans import found
from tests.conftest import rows

RECORD = {
    "fields": {"title": "x", "mainIngredients": ["Zinc", "  ", {"name": "Iron"}, {}, {"value": "Copper", "taxonomy": None}, None], "images": ["//a/1.jpg", {"src": "b"}, {"alt": "logo"}, {"url": "c"}], "variant_options": {"Count": "30", "Flavour": "Mint"}},
    "variants": [{"id": 7, "variantOptions": [{"name": "Size", "value": "1"}, {"label": "Pack", "selected": "2"}, {"name": ""}]}, None, {"id": "8", "variant_options": {"name": "Size", "value": "3"}}, {"sku": "s"}],
}
EXPECTED = [
    ("main_ingredients", -1, 0, "Zinc"), ("main_ingredients", -1, 2, "Iron"), ("main_ingredients", -1, 4, "Copper"), ("images", -1, 0, "//a/1.jpg"), ("images", -1, 1, "b"), ("images", -1, 3, "c"),
    ("variants", -1, 0, "7"), ("variant_options", 0, 0, "Size"), ("variant_options", 0, 1, "Pack"), ("variants", -1, 2, "8"), ("variant_options", 2, 0, "Size"), ("variant_options", -1, 0, "Count"), ("variant_options", -1, 1, "Flavour"),
]


def flat(spark, payloads):
    df = spark.createDataFrame([(i, p, "c") for i, p in enumerate(payloads)], "raw_id bigint, payload string, child string")
    return rows(nesting.flatten_records(df).drop("payload"))


def test_shapes_and_packing(spark):
    text = json.dumps(RECORD)
    packed = [text, json.dumps(text), "﻿" + text, json.dumps(json.dumps([RECORD])), json.dumps(RECORD["fields"] | {"variants": RECORD["variants"]})]
    assert flat(spark, packed) == sorted(((i, *e) for i in range(len(packed)) for e in EXPECTED), key=repr)


def test_damaged_and_empty(spark):
    text = json.dumps(RECORD)
    assert flat(spark, [None, "", "null", "[]", "{}", "<html>502</html>", text[:-20], json.dumps(text)[:-9], "12", '"x"', "[" * 5000]) == []
    assert flat(spark, []) == []


def test_packing_has_no_depth_limit(spark):
    text = json.dumps({"images": "u"})
    for _ in range(12):
        text = json.dumps([text])
    assert flat(spark, [text]) == [(0, "images", -1, 0, "u")]


def test_lone_entries(spark):
    assert flat(spark, [json.dumps({"main_ingredients": "Zinc", "images": {"url": "u"}, "variants": {"id": 1.5}})]) == [(0, "images", -1, 0, "u"), (0, "main_ingredients", -1, 0, "Zinc"), (0, "variants", -1, 0, "1.5")]


def test_child_tables_and_partitioned_write(spark, tmp_path):
    df = nesting.flatten_records(spark.createDataFrame([(1, json.dumps(RECORD))], "raw_id bigint, payload string"))
    tables = nesting.child_tables(df)
    assert rows(tables["images"].select("item_no", "entry.url")) == sorted([(0, None), (1, None), (3, "c")], key=repr)
    nesting.write_partitioned(df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == df.count()


def test_query_writes_partitioned_and_reads_the_tables(spark, sf_dir):
    from pathlib import Path

    shared = Path(spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(shared.rglob("children-*"))
    got = found.p7_found(spark, sf_dir)
    (path,) = set(shared.rglob("children-*")) - before
    assert {p.name for p in path.glob("child=*")} == {f"child={t}" for t in ("main_ingredients", "images", "variants", "variant_options")}
    assert rows(got) == rows(nesting.flatten_records(spark.read.parquet(f"{sf_dir}/raw_record.parquet")).drop("payload"))
