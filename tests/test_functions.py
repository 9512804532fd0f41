import pytest
from pyspark.sql import functions as F

from catalith.functions import html as H
from catalith.functions import images as I
from catalith.functions import text as T
from catalith.functions import urls as U
from catalith.operators import records as R


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize("f, value, expected", [
    (U.registrable_domain, "https://www.shop.Example.co.uk./x", "example.co.uk"), (U.registrable_domain, "http://a.b.example.com:8080/", "example.com"), (U.registrable_domain, "nothing", ""), (U.registrable_domain, None, None),
    (U.page_key, "HTTP://www.A.example:80/p/x/?utm_source=1&variant=2#top", "a.example/p/x?variant=2"), (U.page_key, "https://a.example/p/x?variant=2&gclid=9", "a.example/p/x?variant=2"), (U.page_key, "https://a.example//p//x", "a.example/p/x"), (U.page_key, "", None),
    (U.picture_key, "//img.a.example/f/x-1_300x300.jpg?w=200#zoom", "img.a.example/f/x-1.jpg"), (U.picture_key, " ", None),
    (U.normalised, "HTTPS://A.example:443/?b=2&utm_x=1&a=1#f", "https://a.example/?b=2&a=1"), (U.normalised, "http://a.example/", "http://a.example"), (U.normalised, "ftp://a", None),
    (U.is_product, "https://a.example/products/x", True), (U.is_product, "https://a.example/shop/x", False), (U.is_product, "https://a.example/shop/products/x", True), (U.is_product, "https://a.example/cart/item/x", False), (U.is_category, "https://a.example/collections/all", True),
    (U.is_rejected, "https://a.example/", True), (U.is_rejected, "https://a.example/x.png", True), (U.is_rejected, "https://a.example/privacy-policy", True), (U.is_rejected, "https://a.example/%7B%7Burl%7D%7D/x", True), (U.is_rejected, None, True), (U.is_rejected, "https://a.example/p/x", False),
    (U.page_number, "https://a.example/c?counter=3", 4), (U.page_number, "https://a.example/c/page/12/", 12), (U.page_number, "https://a.example/c", None), (U.variant_url, "https://a.example/p?utm=1&variant=3&selected_size=2#x", "https://a.example/p?selected_size=2&variant=3"), (U.variant_url, "x", ""),
    (U.origin, "HTTPS://A.example/x", "https://a.example"), (U.is_http, None, False),
    (I.best_srcset, "a.jpg 300w, b.jpg 800w, c.jpg 2x", "c.jpg"), (I.best_srcset, "", ""), (I.identity, "http://cdn.shopify.com/s/f/x_300x.jpg?width=30#a", "https://cdn.shopify.com/s/f/x.jpg"), (I.identity, "https://a.example/_next/image?url=https%3A%2F%2Fb.example%2Fx.png&w=64", "https://b.example/x.png"),
    (I.basename_key, "https://a.example/b/Photo_large.JPG?x=1", "photo"), (I.width, "https://a/x?w=300", 300),
    (H.to_text, "<p>a &amp; b<script>x</script><br>c  d</p>", "a & b c d"), (H.title, "<title>T | Shop</title>", "T"), (H.title, "<h1> A <b>B</b></h1><title>T</title>", "A B"), (H.currency, "<b>12 €</b>", "EUR"), (H.currency, "pay 5 GBP", "GBP"), (H.currency, "", ""),
    (H.availability, "In stock", "InStock"), (H.availability, "sold out", "OutOfStock"), (H.availability, "x", ""), (H.is_error_page, "<title>404 Page not found</title>", True), (H.is_error_page, "<p>x</p>", False), (H.trait_key, "Suggested use", "recommended_daily_intake"),
    (H.title, '<b class="x product-title">A</b><title>T</title>', "A"), (H.title, '<meta content="O | S" property="og:title">', "O"), (H.description, '<p id="d">x</p><div class="a product-description">one</div><article class="projector_product__description">two</article>', "two"), (H.description, "<meta content='m' name='description'>", "m"),
    (H.price, '<div class="old amount">was 5</div><span class="price">0,00 €</span><span id="price">$ 1,234.50 now</span>', "$ 1,234.50"), (H.price, "<p>Only 12,90 PLN today</p>", "12,90 PLN"), (H.price, "<p>12 pieces</p>", None), (H.price, '<meta content="7.5" itemprop="price">', "7.5"),
    (H.currency, "pay 5 nok now", "NOK"), (H.currency, '<meta content="ron" itemprop="priceCurrency">', "RON"), (H.currency, "EUROPE", ""), (H.availability, "produkt dostępny", "InStock"),
    (H.price, '<meta itemprop="price" content="9.90">', "9.90"), (H.price, '<span class="x price">12,50 €</span>', "12,50 €"),
    (T.is_filled, " ", False), (T.is_filled, "n/a", False), (T.is_filled, "[object Object]", False), (T.is_filled, "{{value}}", False), (T.is_filled, "—", False), (T.is_filled, "x", True), (T.is_filled, None, False), (T.words, "  Áß-x_1 ", "aß x 1"), (T.squeeze, "   ", None),
    (R.title_case, "anti-inflammatory and a/b", "Anti-Inflammatory And A/B"), (R.title_case, "Already done", "Already done"), (U.has_placeholder, "https://a/${x}", True),
])
def test_scalars(spark, f, value, expected):
    assert one(spark, value, f) == expected


@pytest.mark.parametrize("url, original, resolver", [
    ("https://a/media/catalog/product/cache/0123456789abcdef/x/y.jpg", "https://a/media/catalog/product/x/y.jpg", "magento_catalog_cache"), ("https://a/wp-content/uploads/x-300x200.png", "https://a/wp-content/uploads/x.png", "wordpress_dimensions"),
    ("https://a/cdn/shop/x_large.jpg?v=1&width=3", "https://a/cdn/shop/x.jpg?v=1", "shopify_transform"), ("https://a/images/stencil/300x300/products/x.jpg", "https://a/images/stencil/original/products/x.jpg", "bigcommerce_stencil"),
    ("https://res.cloudinary.com/c/image/upload/w_30,h_20/x.jpg", "https://res.cloudinary.com/c/image/upload/x.jpg", "cloudinary_transform"), ("https://ik.imagekit.io/a/tr:w-30/x.jpg", "https://ik.imagekit.io/a/x.jpg", "imagekit_transform"),
])
def test_originals(spark, url, original, resolver):
    got = one(spark, url, I.original)
    assert (got["original"], got["resolver"]) == (original, resolver) and got["validation_group"].startswith(resolver + ":https://")
    assert one(spark, original, I.original) is None


def test_lists(spark):
    assert one(spark, ["http://a/x.jpg", "https://a/x.jpg", "", None, "https://a/y.jpg?w=3", "//a/x.jpg"], I.unique, "array<string>") == ["https://a/x.jpg", "https://a/y.jpg?w=3"]
    assert one(spark, '<a class=x HREF="b">1</a>', H.attributes) == {"class": "x", "href": "b"}
    assert one(spark, "<a href='/x?a=1&amp;b=2'>Next <b>1</b></a><a href='#t'>t</a><link rel=next href=y>", lambda c: F.transform(H.links(c), lambda x: F.concat_ws("|", x["tag"], x["href"], x["text"]))) == ["a|/x?a=1&b=2|Next 1", "link|y|"]
    assert one(spark, "<table><tr><th>Supplement Facts</th></tr><tr><td>Zinc</td><td>5 mg</td></tr></table><table><tr><td>x</td></tr></table>", H.facts_tables) == ["Supplement Facts; Zinc | 5 mg"]
    assert one(spark, "<details><summary>Storage</summary>Dry</details><details><summary>storage</summary>Wet</details>", lambda c: F.transform(H.traits(c), lambda t: t["value"])) == ["Dry"]
    accordion = '<section class="tabs"><div class="accordion a"><h3>Warnings</h3><div class="panel">Keep <b>dry</b></div></div><div class="tab-pane"><button>Use</button> Take one </div></section><details><summary>WARNINGS</summary>x</details>'
    assert one(spark, accordion, lambda c: F.transform(H.traits(c), lambda t: F.concat_ws("=", t["label"], t["value"]))) == ["Warnings=Keep dry", "Use=Take one"]
    assert one(spark, '<div class="mega-menu">a</div><ul class="x off-canvas">b</ul>', lambda c: F.transform(H.menus(c), lambda m: m["surface"])) == ["mobile", "mega_menu"]
    assert one(spark, "<nav>a</nav><header>b</header>", lambda c: F.transform(H.menus(c), lambda m: m["surface"])) == ["nav", "header"]
    assert one(spark, "x", lambda c: F.transform(H.menus(c), lambda m: m["surface"])) == ["page"]
    assert one(spark, '<button data-url="/p2">More</button>', lambda c: F.transform(H.interactive(c), lambda m: m["target"])) == ["/p2"]
    assert one(spark, ["Ingredients", "Details:"], H.is_heading_only, "array<string>") is True
    assert one(spark, "<p>Directions: Take one. Storage: dry</p>", lambda c: H.by_rules(c, [("regex", "<h9>(.*)</h9>"), ("label", "directions")])) == "Take one."
    assert one(spark, "<p>1 a</p><!-- x -->", H.template_fingerprint) == one(spark, "<p>22 bb</p>", H.template_fingerprint)


def test_groups_of_originals(spark):
    groups = {u: one(spark, u, I.original)["validation_group"] for u in ("https://a/media/catalog/product/cache/0123456789abcdef/x.jpg", "https://cdn.shopify.com/s/files/1/22/files/x_100x.jpg", "https://b/cdn/shop/files/x_small.png", "https://res.cloudinary.com/acc/image/upload/w_3/x.jpg")}
    assert list(groups.values()) == ["magento_catalog_cache:https://a:0123456789abcdef", "shopify_transform:https://cdn.shopify.com:s/files/1/22", "shopify_transform:https://b:storefront", "cloudinary_transform:https://res.cloudinary.com:acc"]


@pytest.mark.parametrize("url, expected", [
    ("https://a/thumb.php?w=3&img=https%3A%2F%2Fb%2Fc.jpg", "https://b/c.jpg"), ("https://a/x/Resize.php?image=http://b/c.png", "http://b/c.png"), ("https://a/thumb.php?img=c.jpg", None), ("https://a/thumb.php?img=https://b/c", None), ("https://a/other.php?img=https://b/c.jpg", None), (None, None),
])
def test_proxies(spark, url, expected):
    assert one(spark, url, I.proxy_target) == expected


@pytest.mark.parametrize("url, expected", [
    ("https://a.example/teas-cat12.html", "category"), ("https://a.example/krill-1234.html", "product"), ("https://a.example/x-opis7.html", "product"), ("https://a.example/p123-oil.php", "product"), ("https://a.example/shop/p123-oil.php", "category"), ("https://a.example/product/", "product"), ("https://a.example/product", "other"),
    ("https://a.example/x-blog12.html", "rejected"), ("https://a.example/client-/x", "rejected"), ("https://a.example/about-magnesium", "other"), ("https://a.example/about-us", "rejected"), ("https://a.example/privacy/and/cookies", "rejected"),
])
def test_page_classes(spark, url, expected):
    kind = lambda u: F.when(U.is_rejected(u), "rejected").when(U.is_product(u), "product").when(U.is_category(u), "category").otherwise("other")
    assert one(spark, url, kind) == expected


def test_variant_keys_and_options(spark):
    assert one(spark, "https://a.example/p?variant_id=3&utm_x=1&Selected-Size=2&attribute=b&attribute=a&sku=9", U.variant_url) == "https://a.example/p?Selected-Size=2&attribute=b&attribute=a&variant_id=3"
    options = [(" Size ", "1  kg"), ("size", "1 KG"), ("", ""), ("Pack", None), ("", "x"), None]
    got = one(spark, options, lambda c: F.transform(R.normalised_options(c), lambda o: F.concat_ws("=", o["name"], o["value"])), "array<struct<name: string, value: string>>")
    assert got == ["Size=1 kg", "Pack=", "=x"]
    many = [(f"n{i}", "v") for i in range(30)]
    assert one(spark, many, lambda c: F.size(R.normalised_options(c)), "array<struct<name: string, value: string>>") == 24
    assert one(spark, {"b": "2", "a": "1"}, lambda c: R.variant_identity(F.lit(None).cast("string"), F.lit(" "), R.option_map(c), F.lit("")), "map<string, string>") in ("options:b=2|a=1", "options:a=1|b=2")
    assert one(spark, " AbC ", lambda c: R.variant_identity(c, F.lit("x"), F.lit(None).cast("array<struct<name: string, value: string>>"), F.lit(""))) == "id:abc"


def test_safe_catalogue_and_domains(spark):
    base = F.lit("https://a.example/start")
    urls = ["https://shop.a.example/x", "https://a.example/", "https://b.example/x", "https://b.example/brand/x", "https://a.example/cart", "https://a.example/x.pdf", "ftp://a.example/x", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(U.is_safe_catalogue(base, F.col("u"))).collect()] == [True, False, False, False, False, False, False, False]
    assert [r[0] for r in df.select(U.is_safe_catalogue(base, F.col("u"), True, r"^c\.")).collect()] == [True, False, True, False, False, False, False, False]
    assert one(spark, "https://www.shop.a.co.uk/x", lambda c: U.export_domain([F.lit(None).cast("string"), F.lit(" "), c])) == "a.co.uk"
    assert one(spark, "WWW.B.example", lambda c: U.export_domain([F.lit("c.example")], mapped=c)) == "b.example"


def test_resolution_of_many_dots(spark):
    df = spark.createDataFrame([("https://a.com/b/c/d", "../../../../../../x.html?y=../z"), ("https://a.com/1/2/3/4/5/6/7/8", "../../../../../../x"), ("https://a.com/b/c/", "./.././"), ("https://a.com", ".."), ("https://a.com/b", "/x/../y")], "b string, h string")
    assert [r[0] for r in df.select(U.resolved(F.col("b"), F.col("h"))).collect()] == ["https://a.com/x.html?y=../z", "https://a.com/1/x", "https://a.com/b/", "https://a.com/", "https://a.com/y"]


def test_resolution(spark):
    df = spark.createDataFrame([("https://a.example/b/c/d?x", h) for h in ("e", "/e", "//z/e", "../e", "?p=2", "https://q/", "#x", "mailto:a@b", "./f")], "b string, h string")
    got = [r[0] for r in df.select(U.resolved(F.col("b"), F.col("h"))).collect()]
    assert got == ["https://a.example/b/c/e", "https://a.example/e", "https://z/e", "https://a.example/b/e", "https://a.example/b/c/d?p=2", "https://q/", None, None, "https://a.example/b/c/f"]
