"""Column expressions on HTML: text, attributes, links, titles, prices, traits, tables, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions import quantities as Q

_SPACE = r"[\s\x{00A0}\x{FEFF}]+"
# Entities decoded in texts, in this order.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")]
# Words of a label and the field it names, first match wins.
TRAIT_KEYS = [("ingredient", "ingredients"), ("recommended daily intake|direction|suggested use|usage", "recommended_daily_intake"), ("note|warning|caution", "notes"), ("storage", "storage"), ("serving size", "serving_size")]
FACTS_WORDS = "active ingredient|supplement fact|nutrition fact|nutrition information|amount per serving|daily value|nutrient|nrv|vitamin|magnesium|protein|serving|nährwert|valeurs nutritionnelles|información nutricional"
# Parts of class names of titles, descriptions (best first), prices, traits and menus.
TITLE_CLASSES = ["product_name__name", "product-title", "product__title", "product_title", "entry-title"]
DESCRIPTION_CLASSES = [["product_name__block--description", "projector_product__description", "product_shortdescription"], ["shortdescription", "product-description", "product__description", "longdescription", "description"]]
DESCRIPTION_IDS = ["shortdescription", "description", "longdescription"]
PRICE_CLASSES = ["price", "prices", "amount", "money"]
TRAIT_CLASSES = ["traits__item", "accordion", "tab-pane", "collapse", "product__accordion"]
TRAIT_LABELS, TRAIT_VALUES = ["traits__label", "label", "title", "heading"], ["traits__values", "panel", "content", "body", "value"]
MENU_CLASSES = [("mobile", ["mobile-menu", "off-canvas", "drawer", "hamburger-menu"]), ("mega_menu", ["mega-menu", "dropdown-menu", "submenu", "sub-menu", "menu-panel"])]
# Currency codes and signs prices are told by.
CURRENCY_CODES = ["EUR", "USD", "GBP", "CZK", "PLN", "RON", "CHF", "SEK", "NOK", "DKK", "HUF", "AUD", "CAD", "NZD", "JPY", "CNY", "RMB", "KRW"]
CURRENCY_SIGNS = ["€", "$", "£", "¥", "₹", "₽", "₩", "Kč", "zł", "lei", "Ft"]


def _with(attr: str, words: list[str], inner: str = ".*?", closing: str = r"\w+") -> str:
    """Pattern of an element one of whose attributes `attr` (a pattern) holds one of some words; its content is the first group."""
    return rf"""(?is)<\w+\s[^>]*(?:{attr})=["'][^"']*(?:{"|".join(words)})[^"']*["'][^>]*>({inner})</(?:{closing})>"""


def _meta(key: str, name: str, value: str = "content", tags: str = "meta") -> list[str]:
    """Patterns of the value of a meta tag, its two attributes in either order."""
    return [rf"""(?is)<(?:{tags})\s[^>]*(?:{key})=["'](?:{name})["'][^>]*(?:{value})=["']([^"']+)["']""", rf"""(?is)<(?:{tags})\s[^>]*(?:{value})=["']([^"']+)["'][^>]*(?:{key})=["'](?:{name})["']"""]


def decode(text: Column) -> Column:
    """A few entities decoded."""
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def to_text(html: Column) -> Column:
    """HTML-01: visible text: scripts, styles, comments and tags dropped, entities decoded, blanks collapsed."""
    bare = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(decode(F.regexp_replace(bare, r"<[^>]*>", " ")), _SPACE, " "))


def attributes(tag: Column) -> Column:
    """HTML-02: map of a tag's attributes, names in lower case, the last of a repeated name."""
    pairs = F.regexp_extract_all(tag, F.lit(r"""(?i)[a-z][\w:-]*\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""), F.lit(0))
    name = lambda p: F.lower(F.regexp_extract(p, r"^([\w:-]+)", 1))
    value = lambda p: decode(F.regexp_replace(F.regexp_replace(p, r"^[\w:-]+\s*=\s*", ""), r"""^["']|["']$""", ""))
    entries = F.transform(pairs, lambda p: F.struct(name(p).alias("key"), value(p).alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0))), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(last)


def links(html: Column) -> Column:
    """HTML-03: array of struct(tag, href, text) of all anchors, then all link tags, in order."""
    anchors = F.regexp_extract_all(html, F.lit(r"(?is)<a\s[^>]*>.*?</a>"), F.lit(0))
    others = F.regexp_extract_all(html, F.lit(r"(?is)<link\s[^>]*>"), F.lit(0))
    href = lambda t: F.coalesce(*[F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in (r"""(?is)^<\w+\s[^>]*?href\s*=\s*"([^"]*)\"""", r"(?is)^<\w+\s[^>]*?href\s*=\s*'([^']*)'", r"""(?is)^<\w+\s[^>]*?href\s*=\s*([^\s"'>]+)""")])
    one = lambda tag: lambda t: F.struct(F.lit(tag).alias("tag"), decode(href(t)).alias("href"), to_text(t).alias("text"))
    return F.filter(F.concat(F.transform(anchors, one("a")), F.transform(others, one("link"))), lambda x: x["href"].isNotNull() & ~F.lower(x["href"]).rlike("^(#|javascript:|mailto:|tel:)"))


def menus(html: Column) -> Column:
    """HTML-05: array of struct(surface, html): nav, header, mobile and mega menu blocks, the whole page where there is none. A block found by class ends at its first closing tag."""
    block = lambda surface, pattern: F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(0)), lambda m: F.struct(F.lit(surface).alias("surface"), m.alias("html")))
    found = F.concat(*[block(tag, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}>") for tag in ("nav", "header")], *[block(surface, _with("class", words)) for surface, words in MENU_CLASSES])
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.struct(F.lit("page").alias("surface"), html.alias("html"))))


def interactive(html: Column) -> Column:
    """HTML-04: array of struct(tag, text, target) of buttons, anchors, divs and spans that name where they lead."""
    def of(tag: str) -> Column:
        found = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\s[^>]*>.*?</{tag}>"), F.lit(0))
        target = lambda t: F.regexp_extract(t, r"""(?is)^<\w+\s[^>]*?(?:href|data-url|data-href|data-next|onclick)\s*=\s*["']([^"']+)""", 1)
        return F.transform(found, lambda t: F.struct(F.lit(tag).alias("tag"), to_text(t).alias("text"), target(t).alias("target")))

    return F.filter(F.concat(*[of(t) for t in ("a", "button", "div", "span")]), lambda x: x["target"] != "")


def _first(html: Column, patterns: list[str]) -> Column:
    return F.coalesce(*[F.nullif(to_text(F.regexp_extract(html, p, 1)), F.lit("")) for p in patterns])


def title(html: Column) -> Column:
    """HTML-06: heading, element of a title's class, og:title or title, cut at the first bar after a blank."""
    found = _first(html, [r"(?is)<h1[^>]*>(.*?)</h1>", _with("class", TITLE_CLASSES), *_meta("property|name", "og:title"), r"(?is)<title[^>]*>(.*?)</title>"])
    return F.nullif(F.trim(F.regexp_replace(found, r"(?s)\s\|.*$", "")), F.lit(""))


def description(html: Column) -> Column:
    """HTML-07: the element whose class, then id names a description, else the meta description, at most 2500 characters (the feature's bound)."""
    closing = "section|div|article"
    return F.substring(_first(html, [*[_with("class", words, closing=closing) for words in DESCRIPTION_CLASSES], _with("id", DESCRIPTION_IDS, closing=closing), *_meta("name", "description")]), 1, 2500)


def priced(text: Column) -> Column:
    """The first amount above zero in a text with a currency sign or code before or behind it; null for none."""
    signs = "|".join("\\" + x if x == "$" else x for x in CURRENCY_SIGNS)
    codes = "|".join(CURRENCY_CODES)
    amount = r"\d{1,6}(?:[ .,'’]\d{3})*(?:[.,]\d{1,2})?(?!\d)"
    found = F.regexp_extract_all(text, F.lit(rf"(?i)(?:(?:{signs})\s*{amount})|(?<![\d.,]){amount}\s*(?:{signs}|{codes})(?![A-Za-z])"), F.lit(0))
    return F.get(F.filter(found, lambda p: price_number(p) > 0), 0)


def price(html: Column) -> Column:
    """HTML-08: price text: of itemprop price, else the first amount with a currency in an element of a price's class or id, else in the whole text."""
    prop = _first(html, _meta("itemprop", "price", tags=r"\w+"))
    marked = F.regexp_extract_all(html, F.lit(_with("class|id", PRICE_CLASSES, closing="strong|span|div|p|money")), F.lit(1))
    return F.coalesce(F.when(price_number(prop) > 0, prop), F.get(F.filter(F.transform(marked, lambda m: priced(to_text(m))), lambda p: p.isNotNull()), 0), priced(to_text(html)))


def currency(html: Column) -> Column:
    """HTML-10: itemprop currency, else the first symbol of a fixed order, else an ISO code in the text; '' for none."""
    prop = F.upper(_first(html, _meta("itemprop", "priceCurrency")))
    text = to_text(html)
    code = F.upper(F.regexp_extract(text, r"(?i)(?<![A-Za-z\d_])(" + "|".join(CURRENCY_CODES) + r")(?![A-Za-z\d_])", 1))
    symbol = F.lit("")
    for sign, iso in reversed([("€", "EUR"), ("$", "USD"), ("£", "GBP"), ("Kč", "CZK"), ("zł", "PLN")]):
        symbol = F.when(text.contains(sign), iso).otherwise(symbol)
    return F.when(prop.rlike("^[A-Z]{3}$"), prop).when(symbol != "", symbol).otherwise(code)


def availability(html: Column) -> Column:
    """HTML-11: InStock where the text says so (tested first), OutOfStock where it says the opposite, else ''."""
    text = F.lower(to_text(html))
    return F.when(text.rlike(r"(^|\W)(in stock|available|dostępny|add to cart)(\W|$)"), "InStock").when(text.rlike(r"(^|\W)(out of stock|sold out|unavailable)(\W|$)"), "OutOfStock").otherwise("")


def is_error_page(html: Column) -> Column:
    """HTML-12: the title names an HTTP error, or the text does and no sign of a product is there."""
    error = r"(?i)(page not found|access denied|service unavailable|bad gateway|gateway timeout|internal server error|verify you are human|just a moment)"
    return F.coalesce(_first(html, [r"(?is)<title[^>]*>(.*?)</title>"]).rlike(error) | (to_text(html).rlike(error) & ~html.rlike(r"(?i)itemprop=.price|add[-_ ]?to[-_ ]?cart|data-product")), F.lit(False))


def trait_key(label: Column) -> Column:
    """HTML-13: canonical field of a label, '' for none."""
    out = F.lit("")
    for words, key in reversed(TRAIT_KEYS):
        out = F.when(F.lower(label).rlike(words), key).otherwise(out)
    return out


def traits(html: Column) -> Column:
    """HTML-13: array of struct(label, value) of accordion and tab blocks, then details blocks; the first of each label kept, compared without case.

    A block of a trait's class reaches to the next such block or the end of its section. Its label is the element of a label's class, else a button, summary or
    heading; its value the element of a value's class, else its text without the label.
    """
    opening = rf"""<div\s[^>]*class=["'][^"']*(?:{"|".join(TRAIT_CLASSES)})[^"']*["'][^>]*>"""
    starts = F.regexp_extract_all(html, F.lit(rf"(?is){opening}(.*?)(?={opening}|</section>|\z)"), F.lit(1))

    def of_block(b: Column) -> Column:
        label = F.coalesce(_first(b, [_with("class", TRAIT_LABELS), r"(?is)<(?:button|summary|h2|h3|h4)[^>]*>(.*?)</(?:button|summary|h2|h3|h4)>"]), F.lit(""))
        rest = F.trim(F.replace(to_text(b), label, F.lit("")))
        return F.struct(label.alias("label"), F.coalesce(_first(b, [_with("class", TRAIT_VALUES)]), rest).alias("value"))

    def of_details(b: Column) -> Column:
        return F.struct(to_text(F.regexp_extract(b, r"(?is)<summary[^>]*>(.*?)</summary>", 1)).alias("label"), to_text(F.regexp_replace(b, r"(?is)^<details[^>]*>|<summary[^>]*>.*?</summary>", " ")).alias("value"))

    details = F.regexp_extract_all(html, F.lit(r"(?is)<details[^>]*>.*?</details>"), F.lit(0))
    found = F.filter(F.concat(F.transform(starts, of_block), F.transform(details, of_details)), lambda t: (t["label"] != "") & (t["value"] != ""))
    return Q.bind(found, lambda f: Q.bind(F.transform(f, lambda t: F.lower(t["label"])), lambda k: F.filter(f, lambda t, i: F.array_position(k, F.lower(t["label"])) == i + 1)))


def facts_tables(html: Column) -> Column:
    """HTML-14: array of the texts of tables that speak of facts, cells that hold text joined by ' | ', rows by '; '."""
    tables = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<table[^>]*>.*?</table>"), F.lit(0)), lambda t: F.lower(to_text(t)).rlike(FACTS_WORDS))
    cells = lambda r: F.array_join(F.filter(F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), to_text), lambda c: c != ""), " | ")
    rows = lambda t: F.filter(F.transform(F.regexp_extract_all(t, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1)), cells), lambda r: r != "")
    return F.filter(F.transform(tables, lambda t: F.array_join(rows(t), "; ")), lambda t: t != "")


def labelled_section(text: Column, label: str, stops: list[str]) -> Column:
    """HTML-15: what follows a label up to the next of the stop labels or the end; '' where the label is missing."""
    end = "|".join(stops)
    return F.trim(F.regexp_extract(text, rf"(?is)(?:^|\W){label}\s*:?\s*(.*?)(?:(?:^|\W)(?:{end})\s*:|$)", 1))


def template_fingerprint(html: Column) -> Column:
    """HTML-16: twenty digits of the SHA-256 of a page's structure: comments, scripts, styles, texts, values and numbers taken out."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", "")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, r">[^<]+<", ">#<"), r"""=\s*("[^"]*"|'[^']*')""", "="), r"\d+", "#")
    return F.substring(F.sha2(F.lower(F.regexp_replace(shape, r"\s+", " ")), 256), 1, 20)


def is_heading_only(values: Column) -> Column:
    """HTML-17: all items merely repeat a section heading; false for no items."""
    heading = r"(?i)^\W*(description|details?|ingredients?|directions?|supplement facts|nutrition facts|warnings?|reviews?|overview)\W*$"
    return F.coalesce((F.size(values) > 0) & F.forall(values, lambda v: v.rlike(heading)), F.lit(False))


def by_rules(html: Column, rules: list[tuple[str, str]], fallback: Column | None = None) -> Column:
    """HTML-18: value of a field by ordered rules, the first that gives one: ('regex', pattern), ('label', label) or ('tag', name)."""
    options = []
    for kind, arg in rules:
        if kind == "regex":
            options.append(F.nullif(to_text(F.regexp_extract(html, arg, 1)), F.lit("")))
        elif kind == "label":
            options.append(F.nullif(labelled_section(to_text(html), arg, ["description", "ingredients", "directions", "storage", "warnings"]), F.lit("")))
        elif kind == "tag":
            options.append(_first(html, [rf"(?is)<{arg}(?:\s[^>]*)?>(.*?)</{arg}>"]))
    return F.coalesce(*options, *([fallback] if fallback is not None else []), F.lit(None).cast("string"))


def price_number(text: Column) -> Column:
    """HTML-09: amount of a price text as DECIMAL(18,2); the last point or comma with at most two digits behind it is the decimal one, unparsable is 0."""
    digits = F.regexp_replace(text, r"[^\d.,]", "")
    whole = F.regexp_replace(F.regexp_replace(digits, r"[.,]\d{1,2}$", ""), r"[.,]", "")
    cents = F.regexp_extract(digits, r"[.,](\d{1,2})$", 1)
    return F.coalesce(F.concat(whole, F.lit("."), F.when(cents != "", cents).otherwise("0")).try_cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))


stated_price = Q.price_amount
