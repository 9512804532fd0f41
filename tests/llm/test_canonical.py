from catalith.llm import canonical as C
from tests.conftest import rows

VOCAB = [("V1", "health_functions", "Joint Comfort"), ("V2", "health_functions", "Hair Strength"), ("V3", "health_functions", "Bone Density"), ("V4", "health_functions", "Skin Radiance"), ("V5", "health_functions", "Eye Comfort"), ("I1", "main_ingredients", "Vitamin K1"), ("I2", "main_ingredients", "Vitamin K2"), ("I3", "main_ingredients", "Ginseng"), ("I4", "main_ingredients", "Zinc")]
ALIAS = [("Supple Joints ", "Joint Comfort"), ("supple joints", "Joint Comfort"), ("Ginseng", "Zinc"), ("Kalium", "Nowhere"), ("zincum", "Zinc")]


def mapped(spark, values, contexts=None):
    vocabulary = spark.createDataFrame(VOCAB, "id string, kind string, name string")
    aliases = spark.createDataFrame(ALIAS, "alias string, canonical string")
    df = spark.createDataFrame([(i, k, v, "x") for i, (k, v) in enumerate(values)], "row_id bigint, kind string, raw_value string, key string")
    return {r["raw_value"]: r["entry_id"] for r in C.map_values(df, vocabulary, aliases, contexts).collect()}


def test_names_aliases_swaps_typos(spark):
    h, m = "health_functions", "main_ingredients"
    carriers = [(h, f"Supports {v[2]}") for v in VOCAB if v[1] == h]
    got = mapped(spark, [*carriers, (h, " JOINT  comfort!"), (h, "supple_joints"), (h, "Comfort, Joint"), (h, "joint cofort"), (h, "supports joint comfrot"), (h, "Kitchen Essentials"), (m, "Vitamin K1"), (m, "vitmain k2"), (m, "ginseng"), (m, "Joint Comfort"), (m, "Zincum"), (h, "?"), (h, "Thicker Mane"), (m, "Vitain K2"), (m, "gniseng"), (m, "ginsseng")])
    assert got[" JOINT  comfort!"] == got["supple_joints"] == got["Comfort, Joint"] == got["joint cofort"] == got["supports joint comfrot"] == "V1"
    assert all(got[f"Supports {v[2]}"] == v[0] for v in VOCAB if v[1] == h)
    assert (got["Vitamin K1"], got["vitmain k2"], got["ginseng"], got["Zincum"]) == ("I1", "I2", "I3", "I4")
    assert (got["Vitain K2"], got["gniseng"], got["ginsseng"]) == ("I2", "I3", "I3")
    assert got["Kitchen Essentials"] is None and got["?"] is None and got["Thicker Mane"] is None


def test_blank_values_repeats_and_empty_table(spark):
    got = mapped(spark, [("health_functions", v) for v in ("", " ", "\xa0 ", "\u2003\ufeff", None)])
    assert got == {}
    assert mapped(spark, []) == {}
    vocabulary = spark.createDataFrame(VOCAB, "id string, kind string, name string")
    df = spark.createDataFrame([(1, "health_functions", "x"), (1, "health_functions", "x"), (2, "health_functions", "x")], "row_id bigint, kind string, raw_value string")
    assert C.map_values(df, vocabulary, spark.createDataFrame(ALIAS, "alias string, canonical string")).count() == 3


def test_contexts_teach_other_names(spark):
    seen = [("main_ingredients", "naphthoquinone", "I1")] * 6 + [("main_ingredients", "mixed thing", "I1")] * 3 + [("main_ingredients", "mixed thing", "I2")] * 3
    contexts = spark.createDataFrame(seen, "kind string, key string, entry_id string")
    got = mapped(spark, [("main_ingredients", "Naphthoquinone"), ("main_ingredients", "mixed thing"), ("main_ingredients", "naphtoquinone")], contexts)
    assert got == {"Naphthoquinone": "I1", "mixed thing": None, "naphtoquinone": "I1"}


def test_project_queries_cover_every_typed_value(spark, sf_dir):
    from catalith.llm.queries import p2_found
    from catalith.runtime import table

    got = p2_found(spark, sf_dir)
    values = C.typed_values(table(spark, sf_dir, "enrich_product_output"), table(spark, sf_dir, "inference"))
    assert rows(values.filter("first").select("row_id", "kind", "raw_value")) == rows(values.select("row_id", "kind", "raw_value").distinct())
    want = {(r["row_id"], r["kind"], r["raw_value"]) for r in values.collect() if r["raw_value"] and r["raw_value"].strip(" \t\n\xa0\u200b\u202f\ufeff")}
    assert {(r[0], r[1], r[2]) for r in rows(got)} == want


def test_typed_values_of_odd_rows(spark):
    listing = "output_id bigint, health_functions array<string>, main_ingredients array<struct<name: string, substance: string, form: string, category: string>>, kind string"
    data = [(1, ["a", "a", None, "b"], None, "x"), (2, None, [("Z", "Zinc", None, "M"), ("Z", None, None, None), (None, None, None, None)], "x"), (3, [], [], None), (4, None, None, None)]
    inferred = spark.createDataFrame([(9, ("Zinc", "M")), (10, None)], "inference_id bigint, taxonomy struct<substance: string, category: string>")
    got = C.typed_values(spark.createDataFrame(data, listing), inferred)
    assert rows(got.filter("first").select("row_id", "kind", "raw_value").filter("raw_value IS NOT NULL")) == sorted([(1, "health_functions", "a"), (1, "health_functions", "b"), (2, "main_ingredients", "Z"), (9, "category", "M")], key=repr)
    assert got.filter("raw_value = 'Z'").count() == 2 and C.typed_values(spark.createDataFrame([], listing), inferred.limit(0)).collect() == []


def test_hot_values_and_many_learned_names(spark):
    # a third of all rows hold one value; more learned names than the driver ever held
    values = [("main_ingredients", "Zinc")] * 400 + [("main_ingredients", f"name {i}") for i in range(400)]
    contexts = spark.range(400 * 6).selectExpr("'main_ingredients' AS kind", "concat('name ', id % 400) AS key", "'I4' AS entry_id")
    got = mapped(spark, values, contexts)
    assert set(got.values()) == {"I4"} and len(got) == 401
