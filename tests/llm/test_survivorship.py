import datetime as dt

from pyspark.sql import functions as F

from catalith.llm import survivorship as S
from tests.conftest import rows

FIELDS = "title string, price string, currency string, description string, ingredients string, supplement_facts string, sku string, form string, images array<string>"
SCHEMA = f"record_id bigint, product_url string, captured_at timestamp_ntz, fields struct<{FIELDS}>, group_id int, value string"


def record(i, url, day, images=None, **f):
    names = [x.split()[0] for x in FIELDS.split(", ")]
    return (i, url, None if day is None else dt.datetime(2025, 1, day), tuple(images if n == "images" else f.get(n) for n in names), 1, "clash")


def found(spark, data):
    groups = S.crawl_survivors(spark.createDataFrame(data, SCHEMA), with_values=False).filter(F.col("n_records") > 1)
    return rows(S.long_form(groups, [*S.TEXT_FIELDS, "images"]))


def test_latest_filled_value_of_each_field(spark):
    data = [
        record(5, "https://www.a.example/p/x/?utm_source=m", 3, title="n/a", price="9", images=["//i/1.jpg?w=2", "https://i/1.jpg"]),
        record(7, "http://a.example:80/p/x", 2, title="T", price=" ", images=["https://i/1.jpg", "https://i/2.jpg"]),
        record(9, "https://A.example/p/x#r", None, title="U", sku="s"), record(11, "https://a.example/p/x?variant=2", 4, title="V"), record(13, None, 1, title="W"), record(14, None, 1, title="W"),
    ]
    assert found(spark, data) == sorted([(5, "title", 7), (5, "price", 5), (5, "sku", 9), (5, "images", 7)], key=repr)


def test_ties_repeats_nulls_and_empty(spark):
    same = [record(i, "https://a.example/p/x", 1, title="T") for i in (4, 2, 3)]
    assert found(spark, same) == [(2, "title", 2)]
    assert found(spark, same + same) == [(2, "title", 2)]
    assert found(spark, [record(1, "https://a.example/p/x", None), record(2, "https://a.example/p/x", None)]) == []
    assert found(spark, []) == []


def test_values_come_along_and_long_texts_stay_whole(spark):
    long = "word " * 50_000
    data = [record(1, "https://a.example/p/x", 1, description=long), record(2, "https://a.example/p/x", 2, description="-")]
    row = S.crawl_survivors(spark.createDataFrame(data, SCHEMA)).first()
    assert row["description"]["value"] == long and row["description"]["record_id"] == 1 and row["title"] is None


def test_against_a_loop_on_the_test_tables(spark, sf_dir):
    from catalith.functions import text as T
    from catalith.functions import urls as U
    from catalith.llm.queries import p3_found
    from catalith.runtime import table

    crawl = table(spark, sf_dir, "crawl").select("record_id", "captured_at", U.page_key(F.col("product_url")).alias("k"), *[T.is_filled(F.col(f"fields.{f}")).alias(f) for f in S.TEXT_FIELDS], F.coalesce(F.size(F.array_distinct(F.transform("fields.images", lambda u: U.picture_key(u)))), F.lit(0)).alias("images")).collect()
    groups, want = {}, []
    for r in crawl:
        groups.setdefault(r["k"], []).append(r)
    for g in groups.values():
        if len(g) > 1:
            for f in [*S.TEXT_FIELDS, "images"]:
                ok = [r for r in g if r[f]]
                if ok:
                    best = max(ok, key=lambda r: (r[f] if f == "images" else 0, r["captured_at"] or dt.datetime.min, -r["record_id"]))
                    want.append((min(r["record_id"] for r in g), f, best["record_id"]))
    assert rows(p3_found(spark, sf_dir)) == sorted(want, key=repr)
