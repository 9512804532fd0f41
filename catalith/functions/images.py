"""Column expressions on picture addresses: originals, identities, choices."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions import urls as U
from catalith.functions.quantities import bind

# File endings of pictures and size words of shop picture names.
ENDINGS = ["jpg", "jpeg", "png", "webp", "gif"]
SIZE_WORDS = ["pico", "icon", "thumb", "small", "compact", "medium", "large", "grande", "master"]
# Letters that begin a part of a transform in an upload address.
TRANSFORM_KEYS = ["ar", "c", "dpr", "f", "fl", "g", "h", "q", "r", "t", "w", "x", "y", "z"]
# Words of an address or label and the kind of facts panel they show, first match wins.
FACTS_KINDS = [("drug[-_ ]?facts", "drug_facts"), ("supplement[-_ ]?facts", "supplement_facts"), ("product[-_ ]?facts", "product_facts"), ("nutrition[-_ ]?(facts|information|label)", "nutrition_facts")]
_SIZES = "|".join(SIZE_WORDS)


def _is_size(piece: Column, least: int = 0) -> Column:
    """Whether a piece of a name is WIDTHxHEIGHT: two to five digits on one side and at least `least` (else none) on the other."""
    sides = F.split(F.lower(piece), "x")
    a, b = F.length(F.get(sides, 0)), F.length(F.get(sides, 1))
    digits = F.forall(sides, lambda s: s.rlike(r"^\d{0,5}$"))
    return F.coalesce((F.size(sides) == 2) & digits & (F.greatest(a, b) >= 2) & (F.least(a, b) >= least), F.lit(False))


def _file(name: Column, bare_stem: Callable[[Column], Column]) -> Column:
    """A file name whose stem is replaced by `bare_stem` of it, where it ends like a picture."""
    cut = F.split(name, r"\.(?=[^.]*$)")
    stem, ending = F.get(cut, 0), F.get(cut, 1)
    return F.when(F.lower(ending).isin(ENDINGS), F.concat(bare_stem(stem), F.lit("."), ending)).otherwise(name)


def _without_dash_size(stem: Column) -> Column:
    pieces = F.split(stem, "-")
    return F.when((F.size(pieces) > 1) & _is_size(F.get(pieces, F.size(pieces) - 1), 2), F.array_join(F.slice(pieces, 1, F.size(pieces) - 1), "-")).otherwise(stem)


def _without_size_word(stem: Column) -> Column:
    pieces, n = F.split(stem, "_"), F.size(F.split(stem, "_"))
    cropped = (n > 3) & (F.lower(F.get(pieces, n - 2)) == "crop") & F.get(pieces, n - 1).rlike("(?i)^[a-z]+$")
    m = F.when(F.coalesce(cropped, F.lit(False)), n - 2).otherwise(n)
    last = F.get(pieces, m - 1)
    return F.when((m > 1) & (F.lower(last).isin(SIZE_WORDS) | _is_size(last)), F.array_join(F.slice(pieces, 1, m - 1), "_")).otherwise(stem)


@dataclass(frozen=True)
class Platform:
    """How one platform writes transformed pictures: where it applies (host, path segments), what each segment becomes (null drops it),
    query keys that transform, and what of an address its pictures are approved by together."""

    name: str
    applies: Callable[[Column, Column], Column]
    segment: Callable[[Column, Column, Column], Column]
    keys: tuple[str, ...] = ()
    group: Callable[[Column], Column] | None = None


def _after(segments: Column, i: Column, *names: str) -> Column:
    """Whether the segments before place i are these names."""
    ok = i >= len(names)
    for back, name in enumerate(reversed(names), 1):
        ok = ok & (F.lower(F.get(segments, i - back)) == name)
    return F.coalesce(ok, F.lit(False))


def _holds(segments: Column, *names: str) -> Column:
    return F.contains(F.concat(F.lit("/"), F.array_join(segments, "/"), F.lit("/")), F.lit("/" + "/".join(names) + "/"))


def _last(segments: Column, i: Column) -> Column:
    return i == F.size(segments) - 1


def _cache_part(x: Column, i: Column, s: Column) -> Column:
    key = lambda c: F.coalesce(c.rlike("(?i)^[a-f0-9]{16,64}$"), F.lit(False))
    return (_after(s, i, "media", "catalog", "product") & (F.lower(x) == "cache") & key(F.get(s, i + 1)) & (i + 2 < F.size(s))) | (_after(s, i, "media", "catalog", "product", "cache") & key(x) & (i + 1 < F.size(s)))


def _transforms(x: Column) -> Column:
    parts = F.split(x, ",")
    return F.forall(parts, lambda p: F.lower(F.element_at(F.split(p, "_"), 1)).isin(TRANSFORM_KEYS) & p.rlike("^[^_]+_."))


#: The platforms in the order they are tried.
PLATFORMS = [
    Platform("magento_catalog_cache", lambda h, s: _holds(s, "cache"), lambda x, i, s: F.when(~_cache_part(x, i, s), x), group=lambda s: F.get(s, F.array_position(s, "cache").cast("int"))),
    Platform("wordpress_dimensions", lambda h, s: _holds(s, "wp-content", "uploads"), lambda x, i, s: F.when(_last(s, i), _file(x, _without_dash_size)).otherwise(x)),
    Platform(
        "shopify_transform", lambda h, s: (h == "cdn.shopify.com") | _holds(s, "cdn", "shop"), lambda x, i, s: F.when(_last(s, i), _file(x, _without_size_word)).otherwise(x), ("width", "height"),
        lambda s: F.when(_holds(s, "cdn", "shop"), F.lit("storefront")).otherwise(F.array_join(F.slice(F.filter(s, lambda x: x != ""), 1, 4), "/")),
    ),
    Platform("bigcommerce_stencil", lambda h, s: _holds(s, "images", "stencil"), lambda x, i, s: F.when(_after(s, i, "images", "stencil") & _is_size(x, 2) & F.coalesce(F.lower(F.get(s, i + 1)) == "products", F.lit(False)), F.lit("original")).otherwise(x)),
    Platform("cloudinary_transform", lambda h, s: h == "res.cloudinary.com", lambda x, i, s: F.when(~(_after(s, i, "image", "upload") & _transforms(x) & ~_last(s, i)), x), group=lambda s: F.get(s, 1)),
    Platform("imagekit_transform", lambda h, s: h == "ik.imagekit.io", lambda x, i, s: F.when(~(F.startswith(F.lower(x), F.lit("tr:")) & ~_last(s, i)), x), ("tr",), lambda s: F.get(s, 1)),
]


#: A part of an address of every platform: other addresses are left alone without a closer look.
_MARKS = r"(?i)/cache/|/wp-content/uploads/|//cdn\.shopify\.com[/:]|/cdn/shop/|/images/stencil/|//res\.cloudinary\.com[/:]|//ik\.imagekit\.io[/:]"


def original(url: Column) -> Column:
    """IMG-01: struct(original, resolver, validation_group) of the untransformed picture behind a known transform of an http(s) address, null
    for other addresses; the first platform that changes the address counts. An address is rewritten segment by segment of its path."""
    root = F.regexp_extract(url, r"(?i)^((?:https?:)?//[^/?#]+)", 1)
    path = F.regexp_extract(url, r"(?i)^(?:https?:)?//[^/?#]+([^?#]*)", 1)
    tail = F.regexp_extract(url, r"(#.*)$", 1)
    host = F.lower(F.regexp_extract(root, "//(?:[^@]*@)?([^:]*)", 1))
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)

    def of(p: Platform) -> Callable[[Column], Column]:
        def build(s: Column) -> Column:
            rewritten = F.array_join(F.filter(F.transform(s, lambda x, i: p.segment(x, i, s)), lambda x: x.isNotNull()), "/")
            kept = query
            if p.keys:
                parts = F.filter(F.split(F.substr(query, F.lit(2)), "&"), lambda q: (q != "") & ~F.element_at(F.split(q, "="), 1).isin(*p.keys))
                kept = F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise("")
            new = F.concat(root, rewritten, kept, tail)
            group = F.concat_ws(":", F.lit(p.name), F.lower(root), *([p.group(s)] if p.group else []))
            return F.when((root != "") & p.applies(host, s) & (new != url), F.struct(new.alias("original"), F.lit(p.name).alias("resolver"), group.alias("validation_group")))

        return build

    return F.when(url.rlike(_MARKS), F.coalesce(*[bind(F.split(path, "/"), of(p)) for p in PLATFORMS]))


def proxy_target(url: Column) -> Column:
    """IMG-02: the picture behind a resizing proxy, null for others: an http(s) picture address given as img= or image= to a thumb.php,
    image.php, resize.php or proxy.php, or as url= to an image handler of a site generator."""
    script = F.regexp_extract(url, r"(?i)(?:thumb|image|resize|proxy)\.php\?(?:[^#]*&)?(?:img|image)=([^&#]+)", 1)
    script = F.try_url_decode(F.nullif(script, F.lit("")))
    script = F.when(script.rlike(r"(?i)^https?://") & F.lower(F.regexp_extract(script, r"\.(\w+)(?:[?#]|$)", 1)).isin(ENDINGS), script)
    handler = F.regexp_extract(url, r"(?i)/(?:_next/image|_vercel/image|image-proxy)[^?]*\?(?:[^#]*&)?url=([^&#]+)", 1)
    return F.coalesce(script, F.try_url_decode(F.nullif(handler, F.lit(""))))


def identity(url: Column) -> Column:
    """IMG-02: identity of a picture: proxy target, else original, else the address itself; https, without fragment."""
    return _identity(url, original(url))


def _identity(url: Column, known_original: Column) -> Column:
    known = F.coalesce(F.when(url.contains("?"), proxy_target(url)), known_original["original"], url)
    return F.regexp_replace(F.regexp_replace(known, r"#.*$", ""), r"^(?:http:)?//", "https://")


def preference(url: Column) -> Column:
    """IMG-03: 4 for a picture that is no transform, 2 more for https."""
    return _preference(url, original(url))


def _preference(url: Column, known_original: Column) -> Column:
    return F.when(known_original.isNull(), 4).otherwise(0) + F.when(url.startswith("https:"), 2).otherwise(0)


def width(url: Column) -> Column:
    """IMG-04: width named in an address's query, 0 for none."""
    return F.coalesce(F.regexp_extract(url, r"[?&](?:w|width)=(\d+)", 1).try_cast("int"), F.lit(0))


def unique(urls: Column, rank: Column | None = None) -> Column:
    """IMG-03, IMG-04: pictures without doubles by identity, each at the place of its first, in the spelling of greatest preference (then width)."""
    items = F.transform(F.filter(urls, lambda u: F.coalesce(F.trim(u) != "", F.lit(False))), lambda u, i: bind(original(u), lambda o: F.struct(_identity(u, o).alias("k"), i.alias("i"), u.alias("u"), _preference(u, o).alias("p"), width(u).alias("w"))))

    def choose(known: Column) -> Column:
        firsts = F.filter(known, lambda x, i: ~F.exists(F.slice(known, 1, i), lambda y: y["k"] == x["k"]))
        best = lambda x: F.array_max(F.transform(F.filter(known, lambda y: y["k"] == x["k"]), lambda y: F.struct(y["p"].alias("p"), y["w"].alias("w"), (-y["i"]).alias("i"), y["u"].alias("u"))))
        return F.transform(firsts, lambda x: best(x)["u"])

    return bind(items, choose)


def best_srcset(srcset: Column) -> Column:
    """IMG-05: the candidate of greatest width or density (times 1000), the first of equals; '' for none."""
    parts = F.filter(F.transform(F.split(srcset, ","), lambda p: F.trim(p)), lambda p: p != "")
    score = lambda p: F.coalesce(F.regexp_extract(p, r"\s(\d+)w$", 1).try_cast("double"), F.regexp_extract(p, r"\s(\d+(?:\.\d+)?)x$", 1).try_cast("double") * 1000, F.lit(0.0))
    ranked = F.transform(parts, lambda p, i: F.struct(score(p).alias("s"), (-i).alias("i"), F.regexp_extract(p, r"^(\S+)", 1).alias("u")))
    return F.coalesce(F.array_max(ranked)["u"], F.lit(""))


def basename_key(url: Column) -> Column:
    """IMG-11: file name of a picture without size suffix and ending, in lower case."""
    name = F.regexp_extract(F.regexp_extract(url, r"^([^?#]*)", 1), r"([^/]*)$", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"\.[A-Za-z]{3,4}$", ""), r"[-_](?:\d{2,5}x\d{0,5}|" + _SIZES + ")$", ""))


def tier(field: Column) -> Column:
    """IMG-10: 3 for a key that names a full-size picture, 2 for a plain one, else 1."""
    low = F.lower(field)
    return F.when(low.isin("full", "large", "zoom", "original", "master"), 3).when(low.isin("img", "image", "src"), 2).otherwise(1)


def facts_rank(kind: Column) -> Column:
    """IMG-13: 1 for a picture that names its facts panel, 2 for one that may show it, null for the rest."""
    return F.when(kind.isin([k for _, k in FACTS_KINDS]), 1).when(kind != "ignore", 2)


def facts_kind(url: Column, alt: Column, pos: Column) -> Column:
    """IMG-13: kind of facts panel a picture may show by address and label; ambiguous for a bare 'facts', unlabelled_secondary for a later picture without label, else ignore."""
    text = F.lower(F.concat_ws(" ", url, alt))
    out = F.when(text.rlike(r"(^|[^a-z])(facts|ingredients|label|back)([^a-z]|$)"), "ambiguous").when((pos > 0) & (F.coalesce(F.trim(alt), F.lit("")) == ""), "unlabelled_secondary").otherwise("ignore")
    for words, kind in reversed(FACTS_KINDS):
        out = F.when(text.rlike(words), kind).otherwise(out)
    return out


def few(urls: Column, least: int = 2) -> Column:
    """IMG-14: whether a record has fewer pictures than wanted; null counts as none."""
    return F.coalesce(F.size(urls), F.lit(0)) < least
