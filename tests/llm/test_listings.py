from decimal import Decimal as D

import pytest

from catalith.llm import listings as L
from tests.conftest import rows

FACTORS = {("mg", ""): D(1000), ("g", ""): D(10**6), ("ug", ""): D(1), ("iu", "Vitamin A"): D("0.3"), ("billion cfu", ""): D(10**9)}
D1 = L.Dictionary(frozenset({("navbasen", "Vitamin A"), ("aldtufyn", "MCT Oil")}), {"Vitamin A": "Vitamin A", "MCT Oil": "MCT Oil", "Huile MCT": "MCT Oil"}, FACTORS)


@pytest.mark.parametrize("name, ingredient, expected", [
    ("NAVBASEN - Vitamine A - sans gluten - 5000 UI - 240 capsules végétales", "Vitamin A", ("1500", "capsule", "240", None)), ("Navbasen Vitamin A 1500mcg 30ct Soft Gels", "Vitamin A", ("1500", "softgel", "30", None)),
    ("Aldtufyn - Huile MCT - 1\xa0000\xa0mg - 30ct pastilles à sucer - fruits des bois", "MCT Oil", ("1000000", "lozenge", "30", "berry")), ("gommes x 90 1\xa0000\xa0µg", None, ("1000", "gummy", "90", None)),
    ("Xangusen Fruchtgummis, 180 Stück 15 Mrd. KBE minze-Geschmack", None, ("15000000000c", "gummy", "180", "mint")), ("Menaquinone-7 Caps 75 µg", None, ("75", "capsule", None, None)), ("Tabs (30) 0,5 g", None, ("500000", "tablet", "30", None)), ("", None, (None,) * 4), (None, None, (None,) * 4),
])
def test_names(name, ingredient, expected):
    assert tuple(L.parse_name(D1, name, ingredient).values()) == expected


def test_descriptions_and_attributes():
    text = "Aldtufyn MCT Oil brings 1g of MCT Oil in every serving of this jar. Mixed Berry. Each jar holds 60 melt lozenges, enough for 3 weeks. Take 7 lozenges."
    assert tuple(L.parse_description(D1, text, "MCT Oil").values()) == ("1000000", "lozenge", "60", "berry")
    assert tuple(L.parse_attributes(D1, [{"name": "Pack", "value": "60 ct"}, {"name": "Dosage", "value": "1g"}, {"name": "sku", "value": "12"}, None], None).values()) == ("1000000", None, "60", None)
    assert set(L.parse_description(D1, None, None).values()) == {None}


def test_pairs_and_classes(spark):
    keys = spark.createDataFrame([(1, "a|1", "p"), (2, "a|1", "q"), (3, "b|1", "p"), (4, None, "p"), (5, "c|1", None), (6, "d|2", "r"), (7, "e|2", "")], "output_id bigint, listing string, product string")
    keys = keys.select("output_id", "listing", "product")
    assert rows(L.same_products(keys)) == [(1, 2), (1, 3), (1, 4), (3, 4)]
    classes = {r["output_id"]: r["class_id"] for r in L.product_classes(keys).collect()}
    assert classes[1] == classes[3] == classes[4] == 1 and classes[5] == 5
    assert rows(L.same_products(keys.limit(0))) == []


def test_flavours_of_every_form(spark):
    schema = "output_id bigint, domain string, external_id string, product_url string, source_url string, product_name string, product_form string, variant_attrs array<struct<name:string,value:string>>, main_ingredients array<struct<name:string>>"
    names = ["MCT Oil 1 g Lemon Softgels x 60", "MCT Oil 1 g Orange Softgels x 60", "MCT Oil 1 g Softgels x 60", "Winter Cherry MCT Oil 1 g Softgels x 60", "Winter Cherry MCT Oil 1 g Mint Softgels x 60"]
    data = [(i, f"{i}.example", str(i), f"https://a.example/p/aldtufyn-mct-oil-{i}", None, f"Aldtufyn {name}", None, None, [("Winter Cherry",)]) for i, name in enumerate(names)]
    listings = spark.createDataFrame(data, schema)
    crawl = spark.createDataFrame([], "record_id bigint, product_url string, captured_at timestamp_ntz, fields struct<title:string,form:string,description:string>")
    vocabulary = spark.createDataFrame([("V1", "main_ingredients", "MCT Oil")], "id string, kind string, name string")
    units = spark.createDataFrame([("g", "mass", None, D(10**6))], "unit string, dimension string, substance string, base_per_unit decimal(20,6)")
    mined = L.mine_dictionary(listings, vocabulary, spark.createDataFrame([], "alias string, canonical string"), units)
    assert mined.others == ("winter cherry",) and mined.pairs == {("aldtufyn", "MCT Oil")}
    keys = {r["output_id"]: r["product"].split("|")[-1] for r in L.product_keys(listings, crawl, mined).collect()}
    assert keys == {0: "lemon", 1: "orange", 2: "", 3: "", 4: "mint"}


def test_listings_of_one_product_meet(spark):
    schema = "output_id bigint, domain string, external_id string, product_url string, source_url string, product_name string, product_form string, variant_attrs array<struct<name:string,value:string>>, main_ingredients array<struct<name:string>>"
    data = [
        (1, "a.example", "1", "https://a.example/p/aldtufyn-mct-oil-7", "https://a.example/p/aldtufyn-mct-oil-7", "Aldtufyn MCT Oil 1g Lozenges x 60", None, None, None), (2, "www.A.example", "1", "https://a.example/p/aldtufyn-mct-oil-7", None, "Aldtufyn MCT Oil 1g Lozenges x 60", None, [], []),
        (3, "b.example", "2", "https://b.example/p/aldtufyn-mct-oil-9", "https://b.example/p/aldtufyn-mct-oil-9/?utm_x=1", "ALDTUFYN Huile MCT 1\xa0000 mg", "pastilles", [], []), (4, "c.example", "3", "https://c.example/p/aldtufyn-mct-oil-5", None, "Aldtufyn MCT Oil 1 g Lozenges x 90", None, [], []), (5, "d", None, None, None, None, None, None, None),
    ]
    listings = spark.createDataFrame(data, schema)
    crawl = spark.createDataFrame([(1, "https://b.example/p/aldtufyn-mct-oil-9", None, ("t", None, "Un flacon contient 60 pastilles, soit environ 3 semaines.")), (2, None, None, (None, None, None))], "record_id bigint, product_url string, captured_at timestamp_ntz, fields struct<title:string,form:string,description:string>")
    keys = L.product_keys(listings, crawl, D1)
    assert rows(L.same_products(keys)) == [(1, 2), (1, 3), (2, 3)]
    assert L.product_keys(listings.limit(0), crawl.limit(0), D1).collect() == []
    vocabulary = spark.createDataFrame([("V1", "main_ingredients", "MCT Oil")], "id string, kind string, name string")
    mined = L.mine_dictionary(listings, vocabulary, spark.createDataFrame([("Huile MCT", "MCT Oil")], "alias string, canonical string"), spark.createDataFrame([("g", "mass", None, D(10**6))], "unit string, dimension string, substance string, base_per_unit decimal(20,6)"))
    assert mined.pairs == {("aldtufyn", "MCT Oil")} and mined.models == {"MCT Oil": "MCT Oil", "Huile MCT": "MCT Oil"}


SCHEMA = "output_id bigint, domain string, external_id string, product_url string, source_url string, product_name string, product_form string, variant_attrs array<struct<name:string,value:string>>, main_ingredients array<struct<name:string>>"
CRAWL = "record_id bigint, product_url string, captured_at timestamp_ntz, fields struct<title:string,form:string,description:string>"


def mine(spark, listings):
    vocabulary = spark.createDataFrame([("V1", "main_ingredients", "Vitamin D3")], "id string, kind string, name string")
    units = spark.createDataFrame([("g", "mass", None, D(10**6))], "unit string, dimension string, substance string, base_per_unit decimal(20,6)")
    return L.mine_dictionary(listings, vocabulary, spark.createDataFrame([], "alias string, canonical string"), units)


def test_brand_model_phrases_forms_and_flavours_are_mined(spark):
    brands, models = ["root labs", "vero"], ["vitamin d3", "vitamin c", "zinc", "rose hip"]
    data, n = [], 0
    for b in brands:
        for m in models:
            for form, taste in (("Pellets", "caramel flavour"), ("Capsules", "Caramel")):
                n += 1
                data.append((n, "a.example", str(n), f"https://a.example/p/{b} {m} {n}".replace(" ", "-").replace("https:--", "https://"), None, f"{b} {m} 1 g 60 {form}, {taste}", form, None, None))
    mined = mine(spark, spark.createDataFrame(data, SCHEMA))
    assert mined.pairs == {(b, {"vitamin d3": "Vitamin D3"}.get(m, m)) for b in brands for m in models}
    assert mined.forms == ("pellets",) and mined.flavours == ("caramel",)
    keys = {r["output_id"]: r["product"] for r in L.product_keys(spark.createDataFrame(data, SCHEMA), spark.createDataFrame([], CRAWL), mined).collect()}
    assert keys[1] == "root labs|Vitamin D3|1000000|pellets|60|caramel" and keys[2] == "root labs|Vitamin D3|1000000|capsule|60|caramel" and None not in keys.values()


def test_longest_consistent_match():
    d = L.Dictionary(frozenset({("root", "Zinc"), ("root labs", "Iron")}), {"Zinc": "Zinc", "Iron": "Iron", "Zinc Picolinate": "Zinc Picolinate"}, {})
    assert d.product(L.plain_words("Iron by Root Labs")) == ("root labs", "Iron")
    assert d.product(L.plain_words("Vero zinc picolinate root")) == ("root", "Zinc Picolinate")
    assert d.product(L.plain_words("Zinc and Iron, Root Labs")) == ("root labs", "Iron")
    assert d.product(L.plain_words("Iron")) == (None, "Iron") and d.product(L.plain_words(None)) == (None, None)


def test_listings_without_id_are_not_one_listing(spark):
    data = [(i, "a.example", e, None, None, "x", None, None, None) for i, e in enumerate([None, None, "", " ", "1", "1"])]
    keys = L.product_keys(spark.createDataFrame(data, SCHEMA), spark.createDataFrame([], CRAWL), D1)
    assert rows(L.same_products(keys)) == [(4, 5)]
    assert sorted(r["class_size"] for r in L.product_classes(keys).collect()) == [1, 1, 1, 1, 2, 2]


def test_classes_equal_the_closure_of_pairs(spark):
    import random

    for seed in range(3):
        r = random.Random(seed)
        data = [(i, r.choice([None, *"abcdefgh"]), r.choice([None, "", *"pqrstuvw"])) for i in range(30)] + [(100 + i, f"l{i // 2}", f"p{(i + 1) // 2}") for i in range(30)]
        keys = spark.createDataFrame(data, "output_id bigint, listing string, product string")
        parent = {d[0]: d[0] for d in data}

        def top(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in rows(L.same_products(keys)):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
        want = {i: top(i) for i in parent}
        got = {x["output_id"]: (x["class_id"], x["class_size"]) for x in L.product_classes(keys).collect()}
        assert got == {i: (c, sum(v == c for v in want.values())) for i, c in want.items()}
    assert L.product_classes(keys.limit(0)).collect() == []
