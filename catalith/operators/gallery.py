"""Picture candidates of product pages: where pictures are named in the HTML, how likely each shows the product, and what else it may show."""

from __future__ import annotations

import html as entities
import re
import unicodedata
from collections.abc import Iterator
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.operators.pictures import STOP_WORDS
from catalith.runtime import ship_package

# Attributes of a picture that name an address, the place they stand for and its score; scores of other places.
ATTRIBUTES = [("data-zoom-src", "data_zoom_src", 110), ("data-large_image", "data_large_image", 105), ("data-large-image", "data_large_image", 105), ("data-original", "data_original", 100), ("data-master", "data_master", 100), ("data-src", "data_src", 82), ("src", "img_src", 75)]
PLACES = {"meta": 100, "anchor_href": 95, "srcset": 90, "css_background": 65}
META_NAMES = ["og:image", "og:image:secure_url", "twitter:image", "twitter:image:src", "image_src"]
# How far around a picture is looked, and the elements a look ends at.
BEFORE, AFTER, BLOCKS = 800, 500, ["section", "div", "main", "ul", "li", "figure"]
# Parts of addresses of shop pictures, and what they add to a score.
URL_SCORES = [(r"/(cdn/shop/files|wp-content/uploads|media/catalog/product|image/cache/catalog)/", 25), (r"product|packshot|gallery|hero|zoom|large|master|pdp|fiche|detail", 15), (r"[?&](width|height|w|h)=([89]\d{2,}|\d{4,})", 10), (r"\.(png|jpe?g|webp)([?#]|$)", 8)]
# Words of addresses no product picture has: alone between separators, and anywhere.
NO_PICTURES_ALONE = ["logo", "logos", "icon", "icons", "pixel"]
NO_PICTURES = ["favicon", "sprite", "placeholder", "payment", "visa", "mastercard", "paypal", "klarna", "afterpay", "social", "facebook", "instagram", "twitter", "pinterest", "avatar", "flag", "badge", "seal", "star", "rating", "loader", "spinner", "cart", "carrello", "search", "close", "menu", "chevron", "arrow", "swatch", "pastille", "bollini", "beacon"]
# Words around pictures of the product, of other things, of facts panels, and of the shop's moods.
PRODUCT_WORDS = r"photos__|product(__|-|\s+)(media|image|images|photo|photos|gallery|thumbnail|slider|carousel)|product-single__media|woocommerce-product-gallery|media-gallery|main-product|pdp[-_\s]?(media|gallery|image)|featured-image|main-image|packshot|photoswipe|zoom|swiper|splide|flickity|carousel|slider|gallery|lightbox|fancybox|galleria"
OTHER_WORDS = r"related|recommend|upsell|cross-?sell|collection|product-card|card-wrapper|grid__item|article|blog|instagram|newsletter|banner|footer|header|navbar|navigation|menu|payment|trust|review|testimonial|avatar|announcement|breadcrumb"
FACTS_WORDS = r"supplement\s*facts?|nutrition(al)?\s*(facts?|label|table|information)|facts\s*panel|valori\s*nutrizionali|ingr[ée]dients?|composition"
MOOD_WORDS = r"lifestyle|banner|hero|story|about|ugc|instagram|testimonial|review|ambassador|founder|benefit|icon"
_PRODUCT, _OTHER, _FACTS, _MOOD = (re.compile(p, re.I) for p in (PRODUCT_WORDS, OTHER_WORDS, FACTS_WORDS, MOOD_WORDS))
_NO = re.compile(rf"(?:^|[/_.-])(?:{'|'.join(NO_PICTURES_ALONE)})(?:[/_.-]|$)|{'|'.join(NO_PICTURES)}")
_PICTURE = re.compile(r"\.(?:jpe?g|png|webp|gif)(?:[?#]|$)", re.I)
_ATTRIBUTE = re.compile(r"""([A-Za-z_:][-\w:.]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+))""")
_OPEN, _CLOSE = re.compile(rf"<(?:{'|'.join(BLOCKS)})\b", re.I), re.compile(rf"</(?:{'|'.join(BLOCKS)})>", re.I)
_TAG = re.compile(r"<(meta|link|img|source|a)\b([^>]*)>", re.I)
_BACKGROUND = re.compile(r"""background-image\s*:\s*url\(\s*['"]?([^'")]+)""", re.I)


def _attributes(inside: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(inside)}


def _address(raw: str | None, base: str) -> str:
    """An address made absolute, '' for none, for embedded data and for what no product picture has."""
    raw = (raw or "").strip()
    if not raw or raw.startswith(("data:", "blob:")):
        return ""
    try:
        url = urljoin(base, raw)
    except ValueError:
        return ""
    return url if url.startswith(("http://", "https://")) and _PICTURE.search(url) and not _NO.search(url.lower()) else ""


def _widest(srcset: str) -> str:
    best, found = -1.0, ""
    for part in srcset.split(","):
        url, _, size = part.strip().partition(" ")
        m = re.fullmatch(r"(\d+(?:\.\d+)?)([wx])", size.strip())
        score = float(m[1]) * (1000 if m[2] == "x" else 1) if m else 0.0
        if url and score > best:
            best, found = score, url
    return found


def _plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))


def _hints(title: str | None, url: str) -> list[list[str]]:
    """Telling words of the product's name and of the last part of its address."""
    slug = [s for s in urlsplit(url).path.split("/") if s][-1:] or [""]
    return [[w for w in re.split(r"[^a-z0-9]+", _plain(t or "")) if len(w) > 2 and not w.isdigit() and w not in STOP_WORDS] for t in (title, slug[0])]


def _fit(text: str, hints: list[list[str]]) -> int:
    low = _plain(text)
    if any(len(h) > 1 and any(sep.join(h) in low for sep in " -_") for h in hints):
        return 3
    return min(2, sum(w in low for w in {w for h in hints for w in h}))


def collect(page: str, base: str, title: str | None, gallery_tag: str) -> list[tuple[str, str, int, bool, list[str]]]:
    """(url, source, base score, in an opened gallery, labels) of a page's picture candidates in the order of their places; of one address the one of greater score or in a gallery."""
    hints = _hints(title, base)
    galleries = [m.span() for m in re.finditer(rf"<{gallery_tag}\b.*?</{gallery_tag}>", page, re.I | re.S)]
    found: dict[str, tuple[str, str, int, bool, list[str]]] = {}

    def around(start: int, end: int) -> str:
        before = page[max(0, start - BEFORE) : start]
        opened = [m.start() for m in _OPEN.finditer(before)]
        after = page[start : end + AFTER]
        closed = _CLOSE.search(after)
        return (before[opened[-1] :] if opened else before) + (after[: closed.start()] if closed else after)

    def add(raw: str | None, source: str, score: int, at: int, attrs: dict[str, str] | None, context: str) -> None:
        url = _address(raw, base)
        if not url:
            return
        inside = any(a <= at < b for a, b in galleries)
        labels: list[str] = []
        if attrs is not None:
            own = " ".join([url, *(attrs.get(k, "") for k in ("alt", "title", "aria-label"))])
            local = " ".join([own, *(attrs.get(k, "") for k in ("class", "id", "itemprop"))])
            whole, fit = f"{local} {context}", _fit(local, hints)
            if not inside and ((_OTHER.search(whole) and fit < 3) or not (_PRODUCT.search(whole) or fit >= 2)):
                return
            labels = ["facts"] * bool(_FACTS.search(own)) + ["decorative"] * (not inside and bool(_MOOD.search(f"{own} {context}")))
            shown = inside or bool(_PRODUCT.search(f"{own} {context}"))
            labels += ["gallery"] if shown else ["ignore"] * bool(_OTHER.search(f"{own} {context}"))
        total = score + sum(n for p, n in URL_SCORES if re.search(p, url.lower()))
        old = found.get(url)
        if old is None or total > old[2] or (inside and not old[3]):
            found[url] = (url, source, total, inside, labels)

    tags = [(m.start(), m.end(), m[1].lower(), _attributes(m[2])) for m in _TAG.finditer(page)]
    for start, _, tag, attrs in tags:
        if tag in ("meta", "link") and (attrs.get("property") or attrs.get("name") or attrs.get("rel")) in META_NAMES:
            add(attrs.get("content") or attrs.get("href"), "meta", PLACES["meta"], start, None, "")
    for start, end, tag, attrs in tags:
        if tag in ("img", "source"):
            context = around(start, end)
            linked = {_address(_attributes(m[1]).get("href"), base) for m in re.finditer(r"<a\b([^>]*)>", context, re.I)} - {""}
            better = lambda raw: bool(linked - {_address(raw, base)}) and bool(_address(raw, base))
            wide = _widest(attrs.get("srcset") or attrs.get("data-srcset") or "")
            for raw, source, score in [(wide, "srcset", PLACES["srcset"]), *((attrs.get(k), s, n) for k, s, n in ATTRIBUTES)]:
                if raw and not better(raw):
                    add(raw, source, score, start, attrs, context)
    low = page.lower()
    for start, end, tag, attrs in tags:
        if tag == "a":
            close = low.find("</a>", end)
            inner = page[end : close if close >= 0 else end]
            if picture := re.search(r"<img\b([^>]*)>", inner, re.I):
                attrs = {**{k: v for k, v in _attributes(picture[1]).items() if k in ("alt", "title", "aria-label")}, **attrs}
            add(attrs.get("href"), "anchor_href", PLACES["anchor_href"], start, attrs, page[start : close + 4] if close >= 0 else around(start, end))
    for m in _BACKGROUND.finditer(page):
        add(m[1], "css_background", PLACES["css_background"], m.start(), {}, around(*m.span()))
    return list(found.values())


def picture_candidates(pages: DataFrame, page_col: str = "page", url_col: str = "url", html_col: str = "html", title_col: str = "title", gallery_tag: str = "gallery-capture") -> DataFrame:
    """IMG-06: (page, idx, url, source, base, in_gallery, labels): picture candidates of each page, as resolve_candidates takes them.

    Pictures are named in meta tags, attributes of pictures, anchors and styles. What stands around each (the block it is in, 800 signs before and 500 behind at
    most) and how well its words fit the product's name tell whether it shows the product. Places in a text need its positions, which no built-in gives, so
    pages are read in Arrow batches; nothing is shuffled. Null and empty pages have no candidates; repeated rows each give theirs.
    """
    ship_package(pages.sparkSession)
    key = pages.schema[page_col].dataType.simpleString()
    names = ["page", "idx", "url", "source", "base", "in_gallery", "labels"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for page, url, html, title in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for idx, (address, source, score, inside, labels) in enumerate(collect(html, url or "", title, gallery_tag) if html else ()):
                    for column, value in zip(out, (page, idx, address, source, score, inside, labels), strict=True):
                        column.append(value)
            types = [batch.schema.field(0).type, pa.int32(), pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    rows = pages.select(F.col(page_col), F.col(url_col).cast("string"), F.col(html_col).cast("string"), F.col(title_col).cast("string"))
    return rows.mapInArrow(scan, f"page {key}, idx int, url string, source string, base int, in_gallery boolean, labels array<string>")
