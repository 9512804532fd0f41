"""Column expressions on addresses of pages and pictures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query keys that track a visit or choose its language or currency, as prefixes.
TRACKING_PREFIXES = ["categorycode", "utm_", "fbclid", "gclid", "currency", "lang"]
# Query keys that size, crop or version a picture.
PICTURE_KEYS = ["w", "width", "h", "height", "v", "q", "quality", "fit", "crop", "format", "fm", "auto", "dpr", "size", "sw", "sh", "resize"]


def host(url: Column) -> Column:
    """Lower-case host without user, port, trailing point and leading www., of an http(s) or scheme-relative address; '' where there is none."""
    h = F.lower(F.regexp_extract(F.trim(url), r"(?i)^(?:https?:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(F.regexp_replace(h, r"\.$", ""), r"^www\d?\.", "")


def path(url: Column) -> Column:
    """Path of an address without trailing and doubled slashes; '' for the root."""
    p = F.regexp_extract(F.trim(url), r"(?i)^(?:(?:https?:)?//[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(p, r"/{2,}", "/"), r"/$", "")


def query_parts(url: Column) -> Column:
    """The key=value parts of an address's query, as written, empty ones left out."""
    q = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    return F.filter(F.split(q, "&"), lambda p: p != "")


def page_key(url: Column) -> Column:
    """Identity of the page and variant an address leads to: scheme, www., port, case of the host, fragment, trailing slash, tracking keys
    and the order of the rest don't matter. Null for null and for addresses without host and path."""
    tracking = "^(" + "|".join(TRACKING_PREFIXES) + ")"
    kept = F.array_sort(F.array_distinct(F.filter(query_parts(url), lambda p: ~F.lower(p).rlike(tracking))))
    h, p = host(url), path(url)
    return F.when((h != "") | (p != ""), F.concat(h, p, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def picture_key(url: Column) -> Column:
    """Identity of a picture: as page_key, but without size suffixes of the file name and without sizing and version keys; null for blanks."""
    sizing = "^(" + "|".join(PICTURE_KEYS) + ")="
    kept = F.array_sort(F.array_distinct(F.filter(query_parts(url), lambda p: ~F.lower(p).rlike(sizing) & ~F.lower(p).rlike("^utm_"))))
    plain = F.regexp_replace(path(url), r"[_-]\d{1,5}x\d{0,5}(?=\.[A-Za-z]{3,4}$)", "")
    return F.when(F.trim(url) != "", F.concat(host(url), plain, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))

# Public suffixes of two labels.
TWO_LABEL_SUFFIXES = [
    "co.uk", "org.uk", "me.uk", "ac.uk", "gov.uk", "ltd.uk", "plc.uk", "com.au", "net.au", "org.au", "co.nz", "net.nz", "org.nz", "co.za", "org.za", "web.za",
    "co.jp", "ne.jp", "or.jp", "gr.jp", "co.kr", "or.kr", "ne.kr", "com.br", "net.br", "org.br", "com.mx", "com.ar", "com.co", "com.pe", "com.uy", "com.ec", "com.ve", "com.tr",
    "com.cn", "com.hk", "com.tw", "com.sg", "com.my", "com.ph", "com.vn", "co.in", "co.id", "co.th", "co.il", "com.sa", "com.eg", "com.ng", "co.ke", "com.pl", "com.ua", "com.gr", "com.pt", "com.ro",
]

# Path segments and what they tell of a page.
PRODUCT_SEGMENTS = ["product", "products", "produs", "produit", "producto", "produkt", "item", "p"]
LISTING_SEGMENTS = ["collection", "collections", "category", "categories", "catalog", "shop", "store", "menu", "products", "produkty", "produits", "productos", "produkte"]
BLOCKING_SEGMENTS = ["menu", "category", "categories", "collection", "collections", "catalog", "shop", "store"]
SERVICE_SEGMENTS = ["cart", "basket", "checkout", "account", "login", "register", "wishlist", "search", "blog", "news", "contact", "about", "privacy", "terms", "faq", "order", "compare", "client-", "producer", "producers", "brand", "brands"]
LOCALE_PAGES = ["global", "locale", "language", "languages", "region", "regions", "country", "countries"]
STATIC_EXTENSIONS = ["jpg", "jpeg", "png", "webp", "gif", "svg", "css", "js", "xml", "json", "pdf", "zip", "woff", "woff2"]
POLICY_PAGES = ["privacy cookie", "privacy cookies", "privacy and cookie", "privacy and cookies", "privacycookies", "cookie", "cookies", "cookie policy", "cookies policy", "privacy policy", "terms", "terms and conditions", "about", "about us", "contact", "contact us"]
# Codes before a number that mark the page of a listing.
LISTING_CODES = ["k", "cat", "category", "collection", "brand", "producer", "p"]
# Query keys that select a variant, without their separators, and keys that never do.
VARIANT_KEYS = ["variant", "variantid", "selectedvariant", "option", "options", "optionid", "optionsid", "attribute", "attributes", "superattribute", "selectedsize", "selectedflavor", "selectedflavour", "selectedcolor", "selectedcolour", "selectedpack", "selectedpackage", "selectedpacksize", "selectedpackagesize"]
NO_VARIANT_KEYS = ["categorycode", "fbclid", "gclid", "currency", "lang", "locale"]

# Path segments that are no part of a catalogue, and those of another site's listings.
NO_CATALOGUE = ["cart", "basket", "checkout", "account", "login", "register", "wishlist", "search", "blog", "news", "contact", "about", "privacy", "terms", "faq", "compare", "carrito", "cuenta", "buscar", "contacto", "acerca", "privacidad", "condiciones", "preguntas-frecuentes"]
EXTERNAL_LISTINGS = ["brand", "brands", "category", "categories", "collection", "collections", "catalog", "shop", "store", "menu", "znacka", "marca", "marcas"]


def full_host(url: Column) -> Column:
    """Lower-case host of an http(s) address, its www. kept; '' where there is none."""
    h = F.lower(F.regexp_extract(F.trim(url), r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(h, r"\.$", "")


def registrable_domain(url: Column) -> Column:
    """URL-01: the last two labels of the host, three under a two-label public suffix."""
    labels = F.filter(F.split(full_host(url), r"\."), lambda x: x != "")
    last = lambda n: F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - n + 1), n), ".")
    return F.when(F.size(labels) <= 2, last(2)).when(last(2).isin(TWO_LABEL_SUFFIXES), last(3)).otherwise(last(2))


def is_http(url: Column) -> Column:
    """URL-09: whether an address is an http(s) one with a host; null counts as not."""
    return F.coalesce(full_host(url) != "", F.lit(False))


def origin(url: Column) -> Column:
    """URL-09: scheme, host in lower case and port (unless the usual one) of an http(s) address, null otherwise."""
    scheme = F.lower(F.regexp_extract(F.trim(url), r"(?i)^(https?)://", 1))
    port = F.regexp_extract(F.trim(url), r"(?i)^https?://[^/?#]*?:(\d+)(?=[/?#]|$)", 1)
    usual = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    return F.when(is_http(url), F.concat(scheme, F.lit("://"), full_host(url), F.when(usual, "").otherwise(F.concat(F.lit(":"), port))))


def same_site(a: Column, b: Column) -> Column:
    """URL-02: both http(s) and of the same registrable domain."""
    return is_http(a) & is_http(b) & (registrable_domain(a) == registrable_domain(b))


def normalised(url: Column) -> Column:
    """URL-03: without fragment, default port and tracking keys, scheme and host in lower case, the order of the other keys kept."""
    tracking = "^(" + "|".join(TRACKING_PREFIXES) + ")"
    kept = F.filter(query_parts(url), lambda p: ~F.lower(p).rlike(tracking))
    scheme = F.lower(F.regexp_extract(F.trim(url), r"^([A-Za-z]+)://", 1))
    port = F.regexp_extract(F.trim(url), r"(?i)^https?://[^/?#]*?:(\d+)(?=[/?#]|$)", 1)
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port == "")
    raw = F.regexp_extract(F.trim(url), r"(?i)^https?://[^/?#]*([^?#]*)", 1)
    trimmed = F.when((raw == "/") & (F.size(kept) == 0), "").otherwise(raw)
    return F.when(is_http(url), F.concat(scheme, F.lit("://"), full_host(url), F.when(default, "").otherwise(F.concat(F.lit(":"), port)), trimmed, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def _segments(url: Column) -> Column:
    return F.filter(F.split(F.lower(path(url)), "/"), lambda s: s != "")


def has_placeholder(url: Column) -> Column:
    """URL-07: a template placeholder, also when escaped once or twice."""
    once = F.coalesce(F.try_url_decode(F.regexp_replace(url, r"\+", "%2B")), url)
    twice = F.coalesce(F.try_url_decode(F.regexp_replace(once, r"\+", "%2B")), once)
    return F.coalesce(twice.rlike(r"\{\{|\}\}|<%|%>|\$\{") | F.lower(url).rlike("&#123;|&lcub;"), F.lit(False))


def is_rejected(url: Column) -> Column:
    """URL-06: no page of a product or listing: unparsable, placeholder, root, static file, blog, locale, policy or service page."""
    s = _segments(url)
    only = F.when(F.size(s) == 1, F.try_element_at(s, F.lit(1)))
    static = F.lower(path(url)).rlike(r"\.(" + "|".join(STATIC_EXTENSIONS) + ")$")
    policy = F.array_join(F.flatten(F.transform(s, lambda x: F.split(x, "-"))), " ").isin(POLICY_PAGES)
    blog = F.exists(s, lambda x: x.rlike(r"^blog(-.*)?$")) | F.coalesce(F.try_element_at(s, F.lit(-1)).rlike(r"-blog\d+\.html$"), F.lit(False))
    return F.coalesce(~is_http(url) | has_placeholder(url) | (F.size(s) == 0) | static | blog | F.coalesce(only.isin(LOCALE_PAGES), F.lit(False)) | F.coalesce(policy, F.lit(False)) | F.arrays_overlap(s, F.array(*[F.lit(x) for x in SERVICE_SEGMENTS])), F.lit(True))


def is_listing_code(url: Column) -> Column:
    """URL-05: a page name that ends in a listing's code and number, such as teas-cat12.html."""
    return F.coalesce(F.try_element_at(_segments(url), F.lit(-1)).rlike(r".-(" + "|".join(LISTING_CODES) + r")\d+\.html$"), F.lit(False))


def is_product(url: Column) -> Column:
    """URL-04: looks like the page of one product."""
    s = _segments(url)
    closed = F.regexp_extract(F.trim(url), r"^([^?#]*)", 1).endswith("/")
    before = F.slice(s, 1, F.greatest(F.size(s) - F.when(closed, 0).otherwise(1), F.lit(0)))
    has = lambda names: F.arrays_overlap(before, F.array(*[F.lit(x) for x in names]))
    listed = F.arrays_overlap(s, F.array(*[F.lit(x) for x in BLOCKING_SEGMENTS]))
    name = F.when(~closed, F.try_element_at(s, F.lit(-1)))
    numbered = F.coalesce(name.rlike(r".-opis\d+\.html$") | name.rlike(r".-\d{3,}\.html$") | name.rlike(r"^p\d{3,}[-_].+\.(php|html?)$"), F.lit(False))
    return ~is_rejected(url) & ~is_listing_code(url) & F.when(listed, has([p for p in PRODUCT_SEGMENTS if p not in ("item", "p", "produkt")])).otherwise(has(PRODUCT_SEGMENTS) | numbered)


def is_category(url: Column) -> Column:
    """URL-05: looks like a listing: neither rejected nor a product, with a listing segment or a listing's code."""
    return ~is_rejected(url) & ~is_product(url) & (F.arrays_overlap(_segments(url), F.array(*[F.lit(x) for x in LISTING_SEGMENTS])) | is_listing_code(url))


def page_number(url: Column, text: Column | None = None) -> Column:
    """URL-10: page number from the link's text, else from counter (+1), page, p or paged, else from /page/N; null where there is none.

    A page number has one to four digits by definition: a longer number in these places is an id and no page."""
    by_key = lambda k: F.regexp_extract(url, rf"(?i)[?&]{k}=(\d{{1,4}})(?:[&#]|$)", 1).try_cast("int")
    options = [F.when(F.trim(text).rlike(r"^\d{1,4}$"), F.trim(text).try_cast("int"))] if text is not None else []
    return F.coalesce(*options, by_key("counter") + 1, by_key("page"), by_key("p"), by_key("paged"), F.regexp_extract(path(url), r"(?i)/page/(\d{1,4})(?:/|$)", 1).try_cast("int"))


def variant_url(url: Column) -> Column:
    """URL-08: only the keys that select a variant, in binary order of the keys, equal keys as written; '' for no address."""
    key = lambda p: F.lower(F.element_at(F.split(p, "="), 1))
    selects = lambda p: F.regexp_replace(key(p), "(?<=[a-z])[_-](?=[a-z])", "").isin(VARIANT_KEYS) & ~key(p).isin(NO_VARIANT_KEYS) & ~key(p).startswith("utm_")
    kept = F.transform(F.array_sort(F.transform(F.filter(query_parts(url), selects), lambda p, i: F.struct(F.element_at(F.split(p, "="), 1).alias("k"), i.alias("i"), p.alias("p")))), lambda x: x["p"])
    base = F.regexp_extract(F.trim(url), r"^([^?#]*)", 1)
    return F.when(is_http(url), F.concat(base, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))).otherwise("")


def without_dots(path_and_query: Column) -> Column:
    """A path with its dot segments taken out, however many: '..' takes the segment before it, none above the root; query and fragment stay."""
    p, rest = F.regexp_extract(path_and_query, r"^([^?#]*)", 1), F.regexp_extract(path_and_query, r"(?s)^[^?#]*(.*)$", 1)
    segments = F.slice(F.split(p, "/"), 2, F.size(F.split(p, "/")))
    last = F.try_element_at(segments, F.lit(-1))
    step = lambda kept, s: F.when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).when(s == ".", kept).otherwise(F.array_append(kept, s))
    walked = F.aggregate(segments, F.array().cast("array<string>"), step)
    closed = F.when(last.isin(".", "..") & (F.size(walked) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(walked, "/"), closed, rest)


def resolved(base: Column, href: Column) -> Column:
    """URL-11: an href made absolute against its page, for absolute, scheme-relative, root-relative, query and relative forms, dots removed."""
    b = F.regexp_extract(F.trim(base), r"^([^?#]*)", 1)
    root = F.regexp_extract(b, r"(?i)^(https?://[^/]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(b, r"(?i)^https?://[^/]+", ""), r"[^/]*$", "")
    h = F.trim(href)
    joined = F.concat(F.when(folder == "", "/").otherwise(folder), h)
    return (
        F.when(h.rlike(r"(?i)^https?://"), h).when(h.startswith("//"), F.concat(F.regexp_extract(b, r"^([A-Za-z]+:)", 1), h)).when(h.startswith("/"), F.concat(root, without_dots(h)))
        .when(h.startswith("?"), F.concat(b, h)).when(h.rlike(r"(?i)^(javascript|mailto|tel|data):") | h.startswith("#") | (h == ""), F.lit(None).cast("string")).otherwise(F.concat(root, without_dots(joined)))
    )


def file_key(url: Column, mime: Column) -> Column:
    """SRC-11: name under which a fetched picture is stored: sixteen digits of the address's SHA-1 and an extension by type."""
    ext = F.when(mime.contains("png"), ".png").when(mime.contains("webp"), ".webp").when(mime.contains("gif"), ".gif").otherwise(".jpg")
    return F.concat(F.substring(F.sha1(url), 1, 16), ext)


def is_safe_catalogue(base: Column, url: Column, follow_external: bool = False, excluded_hosts: str | None = None) -> Column:
    """URL-12: whether a crawl that started at `base` may follow an address: http(s), of the same site (others only with `follow_external`, then
    no host matching `excluded_hosts` and no listing of theirs), not its own front page, no service page and no static file; null counts as not."""
    same = same_site(base, url)
    s = _segments(url)
    outside = F.arrays_overlap(s, F.array(*[F.lit(x) for x in EXTERNAL_LISTINGS]))
    if excluded_hosts:
        outside = outside | full_host(url).rlike(excluded_hosts)
    own_root = (origin(base) == origin(url)) & (F.size(s) == 0)
    static = F.lower(path(url)).rlike(r"\.(" + "|".join(STATIC_EXTENSIONS) + ")$")
    service = F.arrays_overlap(s, F.array(*[F.lit(x) for x in NO_CATALOGUE]))
    return F.coalesce(is_http(url) & is_http(base) & (same | (F.lit(follow_external) & ~outside)) & ~own_root & ~static & ~service, F.lit(False))


def site_of(value: Column) -> Column:
    """Host in lower case, without www., of an address or a bare domain; null for blanks and for what is neither."""
    bare = F.when(F.trim(value).rlike("(?i)^https?://"), F.trim(value)).otherwise(F.concat(F.lit("https://"), F.trim(value)))
    return F.when((F.trim(value) != "") & host(bare).contains("."), host(bare))


def export_domain(candidates: list[Column], explicit: Column | None = None, mapped: Column | None = None) -> Column:
    """URL-13: domain of a record: the explicit one, else the one its origin is mapped to, else the registrable domain of the first candidate that is an address or domain; null for none."""
    first = F.coalesce(*[site_of(c) for c in candidates])
    given = [site_of(c) for c in (explicit, mapped) if c is not None]
    return F.coalesce(*given, registrable_domain(F.concat(F.lit("https://"), first)))
