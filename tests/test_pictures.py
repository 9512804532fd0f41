from pyspark.sql import functions as F

from catalith.operators import pictures as P
from tests.conftest import rows


def test_hints(spark):
    df = spark.createDataFrame([("krill-oil-500.jpg", "Krill Oil 500"), ("oil krill", "Krill Oil 500"), ("x", "Krill Oil 500"), (None, "")], "t string, title string")
    assert [r[0] for r in df.select(P.hint_score(F.col("t"), F.col("title"))).collect()][:3] == [3, 2, 0]


def test_candidates(spark):
    data = [("p", 0, "https://a/x.jpg", None, "img_src", False, 70), ("p", 1, "http://a/x.jpg", ["gallery"], "meta", True, 70), ("p", 2, "https://a/y.jpg", ["decorative", "gallery"], "anchor_href", None, 95), ("p", 3, "https://a/z.jpg", ["facts"], "meta", True, 200), ("q", 0, "https://a/x.jpg", [], "elsewhere", False, 1)]
    df = spark.createDataFrame(data, "page string, idx int, url string, labels array<string>, source string, in_gallery boolean, base int")
    assert rows(P.resolve_candidates(df).select("page", "url", "score", "rank")) == [("p", "http://a/x.jpg", 144, 2), ("p", "https://a/y.jpg", 147, 1), ("q", "https://a/x.jpg", 1, 1)]
    assert P.resolve_candidates(df, n=1).count() == 2 and P.resolve_candidates(df.limit(0)).collect() == []


def test_binding(spark):
    rendered = spark.createDataFrame([("p", 0, "https://a/pic_small.jpg"), ("p", 1, "https://a/other.jpg")], "page string, idx int, url string")
    candidates = spark.createDataFrame([("p", "https://b/pic.jpg", 3), ("p", "https://a/pic_small.jpg", 1), ("q", "https://a/other.jpg", 3)], "page string, url string, tier int")
    assert rows(P.bind_to_rendered(rendered, candidates)) == [("p", 0, "https://b/pic.jpg"), ("p", 1, "https://a/other.jpg")]


def test_upgrades(spark):
    data = [("s", i, f"https://a/wp-content/uploads/{i}-300x200.png") for i in range(4)] + [("s", 9, "https://a/cdn/shop/x_large.jpg"), ("s", 10, "https://a/plain.jpg")]
    df = spark.createDataFrame(data, "site string, idx int, url string")
    assert P.groups_to_probe(df).count() == 3
    probes = spark.createDataFrame([("s", "wordpress_dimensions:https://a", True, 900), ("s", "wordpress_dimensions:https://a", True, 1000), ("s", "shopify_transform:https://a:storefront", True, 300)], "site string, grp string, is_image boolean, side int")
    got = {r["idx"]: r["url"] for r in P.upgrade(df, probes).collect()}
    assert got[0] == "https://a/wp-content/uploads/0.png" and got[9].endswith("x_large.jpg") and got[10] == "https://a/plain.jpg"
