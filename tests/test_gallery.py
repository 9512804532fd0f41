from catalith.operators import gallery as G
from catalith.operators import pictures as P
from tests.conftest import rows

PAGE = """<html><head><meta property="og:image" content="/files/krill-oil.jpg"><link rel="image_src" href="//img.test/logo.png"></head><body>
<div class="site-header"><img src="/img/krill-nav.png" alt="Shop"></div>
<div class="product-gallery"><a href="/big/krill-oil-1.jpg"><img src="/small/krill-oil-1.jpg" alt="Krill Oil"></a></div>
<div class="product-gallery"><img srcset="/a-300.jpg 300w, /a-900.jpg 900w" data-zoom-src="/zoom/a.jpg?w=1200" src="data:image/gif;base64,xx"></div>
<gallery-capture><div class="related"><img src="/g/one.webp"></div></gallery-capture>
<div class="plain"><img src="/x/y.jpg" alt="Krill Oil front &amp; back"><img src="/x/z.jpg"></div>
<div class="related"><img src="/r/other.jpg"></div><div class="slider"><img src="/f/supplement-facts.png" alt="Supplement Facts"><i style="background-image: url('/bg/hero.jpg')"></i></div></body></html>"""


def test_candidates_of_a_page():
    got = {url.removeprefix("https://a.test"): (source, score, inside, labels) for url, source, score, inside, labels in G.collect(PAGE, "https://a.test/products/krill-oil", "Krill Oil", "gallery-capture")}
    assert got["/files/krill-oil.jpg"] == ("meta", 108, False, [])
    assert got["/big/krill-oil-1.jpg"][:2] == ("anchor_href", 103) and "/small/krill-oil-1.jpg" not in got
    assert got["/zoom/a.jpg?w=1200"] == ("data_zoom_src", 143, False, ["gallery"]) and got["/a-900.jpg"][:2] == ("srcset", 98) and "/a-300.jpg" not in got
    assert got["/g/one.webp"] == ("img_src", 83, True, ["gallery"])
    assert got["/x/y.jpg"][0] == "img_src" and "/x/z.jpg" not in got
    assert "/r/other.jpg" not in got and "/img/krill-nav.png" not in got and not any("logo" in u for u in got)
    assert got["/f/supplement-facts.png"][3][0] == "facts" and got["/bg/hero.jpg"][3] == ["decorative", "gallery"]


def test_tables(spark):
    df = spark.createDataFrame([(1, "https://a.test/products/krill-oil", PAGE, "Krill Oil", "x"), (2, None, None, None, "x"), (3, "https://a.test/p", "", "T", "x"), (4, "::", "<img src='/x.jpg'>" * 2000, None, "x"), (1, "https://a.test/products/krill-oil", PAGE, "Krill Oil", "x")], "page int, url string, html string, title string, idx string")
    got = G.picture_candidates(df)
    assert {r["page"] for r in got.collect()} == {1} and got.filter("idx = 0").count() == 2
    assert rows(P.resolve_candidates(G.picture_candidates(df.limit(1)), n=2).select("rank"))[0] == (1,)
    assert G.picture_candidates(df.limit(0)).collect() == []
