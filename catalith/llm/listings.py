"""Product listings that describe the same item: brand-model phrases mined from trusted listings, Aho-Corasick matches, comparison of the variant."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.functions import quantities as Q
from catalith.functions import text as T
from catalith.functions import urls as U
from catalith.runtime import bounded_rows, materialise, ship_package

# Dosage forms and how shops of four languages write them. Forms not listed are mined from the listings.
FORMS = {
    "capsule": ["capsule", "capsules", "caps", "vcaps", "vegetable capsules", "kapseln", "kapsel", "kaps", "capsulas", "caps", "gelules", "gelule", "capsules vegetales"],
    "softgel": ["softgels", "softgel", "soft gels", "liquid softgels", "weichkapseln", "perlas", "capsulas blandas", "capsules molles"],
    "tablet": ["tablets", "tablet", "tabs", "coated tablets", "tabletten", "tablette", "tabl", "comprimidos", "comprimes", "comp", "cp"],
    "gummy": ["gummies", "gummy", "gummy bites", "chewable gummies", "gummis", "fruchtgummis", "gominolas", "gomitas", "gommes"],
    "lozenge": ["lozenges", "lozenge", "melt lozenges", "lutschtabletten", "pastillas", "pastillas para chupar", "pastilles", "pastilles a sucer"],
    "powder": ["powder", "pulver", "polvo", "poudre"],
    "liquid": ["liquid", "drops", "tropfen", "gotas", "gouttes", "sirup", "syrup", "jarabe", "sirop"],
    "spray": ["spray", "mundspray", "aerosol"],
    "sachet": ["sachets", "sachet", "sticks", "beutel", "sobres", "ampoules", "ampullen", "ampollas"],
    "bar": ["bar", "bars", "riegel", "barritas", "barres"],
    "tea": ["tea bags", "teebeutel", "bolsitas de te", "infusettes"],
}
# Flavours in four languages. Flavours not listed are mined from names that say "... flavour".
FLAVOURS = {
    "orange": ["orange", "naranja"],
    "lemon": ["lemon", "zitrone", "limon", "citron"],
    "cherry": ["cherry", "kirsche", "cereza", "cerise"],
    "mint": ["mint", "minze", "menta", "menthe"],
    "berry": ["mixed berry", "beerenmix", "frutos del bosque", "fruits des bois"],
    "vanilla": ["vanilla", "vanille", "vainilla"],
    "chocolate": ["chocolate", "schokolade", "chocolat"],
    "strawberry": ["strawberry", "erdbeere", "fresa", "fraise"],
    "apple": ["apple", "apfel", "manzana", "pomme"],
}
# Words for flavour, before or after its name.
_FLAVOUR_AFTER, _FLAVOUR_BEFORE = "flavou?r(?:ed)?|geschmack", "sabor|saveur|gout"
#: A word is a flavour if at least this share of the names that hold it call it one.
FLAVOUR_SHARE = 0.3
#: Most phrases of a kind one dictionary may hold; beyond it raises, so that none is dropped unseen.
MAX_PHRASES = 500_000

_NUMBER = r"\d{1,3}(?:[.,'’\xa0\u202f]\d{3})+(?:[.,]\d{1,2})?(?!\d)|\d+(?:[.,]\d+)?"
_CELLS = r"(?:(?:[x×]\s*10\s*(?:\^\s*[69]|[⁶⁹])|mil\s+millones|billions?|bn|b|milliarden|milliards?|mrd\.?|millionen|millions?|mio\.?|millones|millón|m)\s*)?(?:de\s+|d['’]\s*)?(?:cfu|ufc|kbe)"
_UNIT = rf"{_CELLS}|micrograms?|milligrams?|grams?|[µμ]g|mcg|ug|mg|kg|gm|g|oz|i\.?u\.?|u\.?i\.?|i\.?e\.?"
_AMOUNT = re.compile(rf"(?<![\w.,])({_NUMBER})\s*({_UNIT})(?!\w)", re.I)
_COUNT = re.compile(r"(?<![\d.,])(\d{1,4})\s?(?:ct\b|count\b|pcs\b|pieces\b|stück\b|stk\b|unidades\b|unités\b|unites\b)|\bx\s?(\d{1,4})(?![\d.,]*\s?(?:mg|g|mcg|µg)\b)(?!\w)|\((\d{1,4})\)", re.I)
_UNITS = dict(Q.UNIT_ALIASES)
_MARKS, _PLAIN = re.compile(r"[\u0300-\u036f]+"), re.compile(r"[a-z0-9]+")


def plain_words(text: str | None) -> str:
    """Words of a text in lower case without marks, parted and enclosed by single spaces."""
    low = (text or "").lower().replace("'", " ")
    if not low.isascii():
        low = _MARKS.sub("", unicodedata.normalize("NFKD", low))
    return " " + " ".join(_PLAIN.findall(low)) + " "


def number(text: str) -> Decimal | None:
    """Value of a number as written, by the rules of functions.quantities.number."""
    t = re.sub(r"[\s'’]", "", text)
    if re.fullmatch(r"\d{1,3}(\.\d{3})+,\d+", t):
        t = t.replace(".", "").replace(",", ".")
    elif re.fullmatch(r"\d{1,3}(,\d{3})+\.\d+", t) or re.fullmatch(r"[1-9]\d{0,2}([.,]\d{3})+", t):
        t = t.replace(",", "") if "." in t and "," in t else re.sub(r"[.,]", "", t)
    try:
        return Decimal(t.replace(",", "."))
    except InvalidOperation:
        return None


def _unit(text: str) -> str | None:
    t = re.sub(r"\b(?:de\s+|d['’]\s*)(?=cfu|ufc|kbe)", "", text.lower())
    t = re.sub(r"[\s.'’]", "", t).replace("×", "x").replace("⁶", "6").replace("⁹", "9")
    t = re.sub(r"^x10\^?([69])", r"x10^\1", t)
    t = re.sub(r"(?:cfu|ufc|kbe)$", " cfu", t).strip()
    return _UNITS.get(t)


Span = tuple[int, int, str]


@dataclass
class Dictionary:
    """Phrases of brands, models (what a brand sells, mostly an ingredient), forms and flavours in one Aho-Corasick automaton, and the factors of units.

    `pairs` are the brand-model phrases of trusted listings. `models` maps phrases to one name each. `others` are phrases that name none of
    these but hold a flavour word; they keep the word from being a flavour. `forms` and `flavours` are mined ones beside the fixed values.
    """

    pairs: frozenset[tuple[str, str]]
    models: dict[str, str]
    factors: dict[tuple[str, str], Decimal]
    others: tuple[str, ...] = ()
    forms: tuple[str, ...] = ()
    flavours: tuple[str, ...] = ()
    matcher: ahocorasick.Automaton = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.matcher = ahocorasick.Automaton()
        entries: dict[str, dict[str, str]] = {}
        for brand in sorted({b for b, _ in self.pairs}):
            entries.setdefault(plain_words(brand), {})["brand"] = brand
        for phrase, name in self.models.items():
            if phrase.strip():
                entries.setdefault(plain_words(phrase), {}).setdefault("model", name)
        for phrase in self.others:
            entries.setdefault(plain_words(phrase), {})["other"] = phrase
        for kind, table, mined in (("form", FORMS, self.forms), ("flavour", FLAVOURS, self.flavours)):
            for name, phrases in table.items():
                for phrase in phrases:
                    entries.setdefault(plain_words(phrase), {}).setdefault(kind, name)
            for phrase in mined:
                entries.setdefault(plain_words(phrase), {}).setdefault(kind, phrase)
        for phrase, what in entries.items():
            self.matcher.add_word(phrase, (phrase, what))
        if entries:
            self.matcher.make_automaton()
        self.form_phrases = sorted((p for p, what in entries.items() if "form" in what), key=len, reverse=True)
        self.counted = re.compile(r" (\d{1,4})(?=(?:" + "|".join(map(re.escape, self.form_phrases)) + "))") if self.form_phrases else None

    def __reduce__(self) -> tuple:
        return Dictionary, (self.pairs, self.models, self.factors, self.others, self.forms, self.flavours)

    def spans(self, text: str) -> dict[str, list[Span]]:
        """(start, end, name) of each kind found in plain words, by longest match: shorter matches inside longer ones of the kind drop out.

        A flavour word inside a longer phrase of a model or a brand (cherry in a plant's name) is part of that phrase, no flavour.
        """
        spans: dict[str, list[Span]] = {}
        if len(self.matcher):
            for end, (phrase, what) in self.matcher.iter(text):
                for kind, name in what.items():
                    spans.setdefault(kind, []).append((end - len(phrase) + 1, end, name))
        if "flavour" in spans:
            phrases = [s for kind in ("model", "brand", "other") for s in spans.get(kind, [])]
            spans["flavour"] = [f for f in spans["flavour"] if not any(s[0] <= f[0] and f[1] <= s[1] and f[1] - f[0] < s[1] - s[0] for s in phrases)]
        out: dict[str, list[Span]] = {}
        for kind, found in spans.items():
            taken: list[Span] = []
            for s in sorted(found, key=lambda s: (s[0] - s[1], s[0])):
                if all(s[1] <= t[0] or s[0] >= t[1] for t in taken):
                    taken.append(s)
            out[kind] = sorted(taken)
        return out

    def find(self, text: str) -> dict[str, list[str]]:
        """Names of each kind found in plain words, in order."""
        return {kind: [name for _, _, name in found] for kind, found in self.spans(text).items()}

    def product(self, text: str) -> tuple[str | None, str | None]:
        """(brand, model) of plain words: the longest two phrases known as a pair of trusted listings, then the longest two, then the first."""
        found = self.spans(text)
        brands, models = found.get("brand", []), found.get("model", [])
        if not brands or not models:
            return (brands[0][2] if brands else None), (models[0][2] if models else None)
        size = lambda s: s[1] - s[0]
        brand, model = max(((b, m) for b in brands for m in models), key=lambda p: ((p[0][2], p[1][2]) in self.pairs, size(p[0]) + size(p[1]), -p[0][0], -p[1][0]))
        return brand[2], model[2]

    def strength(self, amount: str, unit: str, ingredient: str | None) -> str | None:
        """An amount in the base unit of its dimension, as text."""
        value, ref = number(amount), _unit(unit)
        if value is None or ref is None:
            return None
        factor = self.factors.get((ref, ingredient or ""), self.factors.get((ref, "")))
        if factor is None:
            return None
        return f"{(value * factor).quantize(Decimal(1), ROUND_HALF_UP)}{'c' if 'cfu' in ref else ''}"


def parse_name(d: Dictionary, name: str | None, ingredient: str | None) -> dict[str, str | None]:
    """Strength, form, count and flavour written in a listing's name."""
    name = name or ""
    found = d.find(plain_words(name))
    amounts = list(_AMOUNT.finditer(name))
    rest = re.sub(r"(?<=\w)-\d+\b", " ", _AMOUNT.sub(" ; ", name))
    forms = found.get("form", [])
    count = next((g for m in _COUNT.finditer(rest) for g in m.groups() if g), None)
    if count is None and forms and d.counted:
        m = d.counted.search(plain_words(rest))
        count = m.group(1) if m else None
    strength = next((s for m in amounts if (s := d.strength(m.group(1), m.group(2), ingredient))), None)
    return {"strength": strength, "form": forms[0] if forms else None, "count": str(int(count)) if count else None, "flavour": (found.get("flavour") or [None])[0]}


def parse_attributes(d: Dictionary, attributes: list[dict] | None, ingredient: str | None) -> dict[str, str | None]:
    """Strength, form, count and flavour among variant attributes, told by what their values look like."""
    out: dict[str, str | None] = dict.fromkeys(("strength", "form", "count", "flavour"))
    for a in attributes or []:
        value = (a or {}).get("value")
        if not value or (a.get("name") or "").lower() == "sku":
            continue
        found = d.find(plain_words(value))
        if m := _AMOUNT.search(value):
            out["strength"] = out["strength"] or d.strength(m.group(1), m.group(2), ingredient)
        elif m := re.match(r"\s*(\d{1,4})\b", value):
            out["count"] = out["count"] or str(int(m.group(1)))
        out["form"] = out["form"] or (found.get("form") or [None])[0]
        out["flavour"] = out["flavour"] or (found.get("flavour") or [None])[0]
    return out


def parse_description(d: Dictionary, text: str | None, model: str | None) -> dict[str, str | None]:
    """Strength, form, count and flavour told in a page's description.

    Strength is the first amount in a sentence that names the model; count and form are those of the greatest number that stands before a dosage
    form (packs hold more than servings do); a flavour stands as a sentence of three words or fewer.
    """
    out: dict[str, str | None] = dict.fromkeys(("strength", "form", "count", "flavour"))
    if not text:
        return out
    for sentence in re.split(r"(?<!\d)[.!](?=\s|$)|[!\n\r]+|(?<=\d)\.(?=\s+\D)", text):
        if out["strength"] is None and (amounts := list(_AMOUNT.finditer(sentence))) and model in d.find(plain_words(sentence)).get("model", ()):
            out["strength"] = next((s for a in amounts if (s := d.strength(a.group(1), a.group(2), model))), None)
        if out["flavour"] is None and len(sentence) < 30 and len(sentence.split()) <= 3:
            out["flavour"] = (d.find(plain_words(sentence)).get("flavour") or [None])[0]
    if d.counted:
        words = plain_words(_AMOUNT.sub(" ; ", text))
        packs = [(int(m.group(1)), -m.start(), m.end()) for m in d.counted.finditer(words)]
        if packs:
            count, _, end = max(packs)
            out["count"] = str(count)
            phrase = next(p for p in d.form_phrases if words.startswith(p, end))
            out["form"] = d.find(phrase)["form"][0]
    return out


def brand_models(listings: DataFrame, phrases: DataFrame, support: int = 2) -> DataFrame:
    """(brand, model, n): brand-model phrases of trusted listings, those whose name holds both phrases of their page address, seen `support` times or more.

    An address ends in brand, model and a number. Where the brand ends is learned from all addresses: of all cuts of one the best is that whose
    first part stands before most different second parts and whose second part behind most different first parts (product of both counts); a cut whose
    second part is one of the `phrases`(model) known of models goes before all others. Addresses are counted before they are cut, so hot sites and products meet as one row each.
    """
    slug = F.regexp_extract(F.lower("product_url"), r"/([^/?#]+)-\d+/?(?:[?#].*)?$", 1)
    rows = listings.select(F.regexp_replace(slug, "-+", " ").alias("slug"), F.concat(F.lit(" "), T.words(F.col("product_name")), F.lit(" ")).alias("name")).filter(F.col("slug").contains(" "))
    words = F.split("slug", " ")
    cut = rows.select("slug").distinct().select("slug", words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("c"))
    cuts = materialise(cut.select("slug", F.array_join(F.slice("w", F.lit(1), F.col("c")), " ").alias("brand"), F.array_join(F.slice("w", F.col("c") + 1, F.size("w")), " ").alias("model")), "cuts")
    behind = cuts.select("brand", "model").distinct().groupBy("brand").agg(F.count(F.lit(1)).alias("n_models"))
    before = cuts.select("brand", "model").distinct().groupBy("model").agg(F.count(F.lit(1)).alias("n_brands"))
    scored = cuts.join(behind, "brand").join(before, "model").join(phrases.select("model", F.lit(1).alias("known")).distinct(), "model", "left")
    best = scored.groupBy("slug").agg(F.max_by(F.struct("brand", "model"), F.struct(F.coalesce("known", F.lit(0)), F.col("n_models") * F.col("n_brands"), "n_brands", "brand")).alias("b")).select("slug", "b.*")
    seen = rows.groupBy("slug", "name").count().join(best, "slug")
    held = lambda c: F.contains(F.col("name"), F.concat(F.lit(" "), F.col(c), F.lit(" ")))
    return seen.filter(held("brand") & held("model")).groupBy("brand", "model").agg(F.sum("count").alias("n")).filter(F.col("n") >= support)


def _called_flavours(listings: DataFrame) -> DataFrame:
    """(t) once per name: words names call a flavour ("vanilla flavour", "sabor a fresa"), of those for which that is so in FLAVOUR_SHARE of the names that hold them."""
    name = T.fold(F.col("product_name"))
    called = F.concat(F.regexp_extract_all(name, F.lit(rf"(\p{{L}}+)[ -](?:{_FLAVOUR_AFTER})(?!\p{{L}})"), F.lit(1)), F.regexp_extract_all(name, F.lit(rf"(?<!\p{{L}})(?:{_FLAVOUR_BEFORE}) (?:a |de |d['’])?(\p{{L}}+)"), F.lit(1)))
    said = listings.select(F.explode(F.array_distinct(called)).alias("t"))
    held = listings.select(F.explode(F.array_distinct(F.split(T.words(F.col("product_name")), " "))).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n_held"))
    sure = said.groupBy("t").agg(F.count(F.lit(1)).alias("n_said")).join(held, "t").filter(F.col("n_said") >= FLAVOUR_SHARE * F.col("n_held")).select("t")
    return said.join(sure, "t", "left_semi")


def mine_dictionary(listings: DataFrame, vocabulary: DataFrame, aliases: DataFrame, unit_reference: DataFrame, support: int = 2) -> Dictionary:
    """The dictionary: brand-model phrases of trusted listings, names and aliases of the vocabulary as further phrases of models, forms and flavours.

    A model whose phrase is a name or alias of the vocabulary goes by that name. Forms are the values of `product_form` seen `support` times or more
    that hold no known form; flavours are the words names call so, seen as often. Ingredients typed as several words, one of them a flavour, are kept as
    phrases that are no flavour. Everything is counted over all listings; what the driver reads is bounded by MAX_PHRASES, checked.
    """
    names = sorted(r["name"] for r in bounded_rows(vocabulary.filter("kind = 'main_ingredients'").select("name").distinct()) if r["name"])
    known = {plain_words(n): n for n in names}
    models = {n: n for n in names}
    for r in sorted(bounded_rows(aliases.select("alias", "canonical").filter("alias IS NOT NULL AND canonical IS NOT NULL"))):
        if r["canonical"] in models and plain_words(r["alias"]) not in known:
            models.setdefault(r["alias"], r["canonical"])
    by_phrase = {plain_words(p): n for p, n in reversed(models.items())}
    pairs = set()
    phrases = vocabulary.filter("kind = 'main_ingredients'").select(T.words(F.col("name")).alias("model"))
    phrases = phrases.unionByName(aliases.join(vocabulary.filter("kind = 'main_ingredients'").select("name"), F.col("canonical") == F.col("name")).select(T.words(F.col("alias")).alias("model")))
    for r in sorted(bounded_rows(brand_models(listings, phrases, support).select("brand", "model"), MAX_PHRASES)):
        name = by_phrase.get(plain_words(r["model"]), r["model"])
        models.setdefault(r["model"], name) if plain_words(r["model"]) not in by_phrase else None
        pairs.add((r["brand"], name))
    factors = {(r["unit"].lower(), r["substance"] or ""): r["base_per_unit"] for r in bounded_rows(unit_reference)}
    fixed = Dictionary(frozenset(), {}, {})
    often = lambda rows: [r[0] for r in sorted(bounded_rows(rows.groupBy("t").count().filter((F.col("count") >= support) & (F.col("t") != "")).select("t"), MAX_PHRASES))]
    forms = [t for t in often(listings.select(T.words(F.col("product_form")).alias("t"))) if not fixed.find(plain_words(t)).get("form") and len(t.split()) <= 3]
    listed = [p for table in (*FLAVOURS.values(), *FORMS.values()) for p in table]
    flavours = [t for t in often(_called_flavours(listings)) if not any(f" {t} " in plain_words(p) for p in listed)]
    flavoured = [plain_words(p) for table in FLAVOURS.values() for p in table] + [plain_words(f) for f in flavours]
    typed = listings.select(F.explode("main_ingredients").alias("m")).select(T.words(F.col("m.name")).alias("t"))
    holding = typed.filter(F.col("t").rlike("|".join(p.strip() for p in flavoured)))
    others = sorted(t for t in often(holding) if any(f in plain_words(t) and f != plain_words(t) for f in flavoured))
    return Dictionary(frozenset(pairs), models, factors, tuple(others), tuple(forms), tuple(flavours))


PARTS = ["strength", "form", "count", "flavour"]


def read_listings(listings: DataFrame, dictionary: Dictionary) -> DataFrame:
    """(output_id, page, listing, brand, model, strength, form, count, flavour): what address, name, form and attributes of a listing say."""
    ship_package(listings.sparkSession)
    shared = listings.sparkSession.sparkContext.broadcast(dictionary)
    columns = ["brand", "model", *PARTS]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = shared.value
        for batch in batches:
            out: list[list] = [[] for _ in columns]
            for url, name, form, attrs, first in zip(*(batch.column(i).to_pylist() for i in range(3, 8)), strict=True):
                place = d.product(plain_words(re.sub(r"^[a-z]+://[^/]*", "", (url or "").split("?")[0].split("#")[0])))
                words = d.product(plain_words(name))
                brand, model = place[0] or words[0], place[1] or words[1] or d.product(plain_words(first))[1]
                named, varied = parse_name(d, name, model), parse_attributes(d, attrs, model)
                stated = (d.find(plain_words(form)).get("form") or [None])[0]
                values = [brand, model, named["strength"] or varied["strength"], stated or named["form"] or varied["form"], named["count"] or varied["count"], named["flavour"] or varied["flavour"]]
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *(pa.array(c, pa.string()) for c in out)], names=["output_id", "page", "listing", *columns])

    rows = listings.select(
        F.col("output_id").cast("bigint").alias("output_id"), U.page_key(F.coalesce("source_url", "product_url")).alias("page"),
        F.concat(F.regexp_replace(F.lower(F.trim("domain")), r"^www\.", ""), F.lit("\x01"), F.nullif(F.trim("external_id"), F.lit(""))).alias("listing"),
        "product_url", "product_name", "product_form", "variant_attrs", F.get("main_ingredients", 0)["name"].alias("first"),
    )
    return rows.mapInArrow(scan, "output_id bigint, page string, listing string, " + ", ".join(f"{c} string" for c in columns))


def read_pages(crawl: DataFrame, dictionary: Dictionary) -> DataFrame:
    """(page, p_strength, p_form, p_count, p_flavour): what the descriptions, then the titles, of a page's records say, latest first."""
    ship_package(crawl.sparkSession)
    shared = crawl.sparkSession.sparkContext.broadcast(dictionary)
    names = [f"{source}_{p}" for source in ("d", "t") for p in PARTS]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = shared.value
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for page, title, form, text in zip(batch.column(0).to_pylist(), *(batch.column(i).to_pylist() for i in range(2, 5)), strict=True):
                model = d.product(plain_words(page))[1] or d.product(plain_words(title))[1]
                told, named = parse_description(d, text, model), parse_name(d, title, model)
                named["form"] = (d.find(plain_words(form)).get("form") or [None])[0] or named["form"]
                for column, value in zip(out, [*(told[p] for p in PARTS), *(named[p] for p in PARTS)], strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.string()) for c in out)], names=["page", "rank", *names])

    rank = F.concat(F.coalesce(F.date_format("captured_at", "yyyyMMddHHmmssSSS"), F.lit("0")), F.lpad(F.col("record_id").cast("string"), 20, "0"))
    rows = crawl.select(U.page_key(F.col("product_url")).alias("page"), rank.alias("rank"), "fields.title", "fields.form", "fields.description").filter(F.col("page").isNotNull())
    parsed = rows.mapInArrow(scan, "page string, rank string, " + ", ".join(f"{n} string" for n in names))
    latest = parsed.groupBy("page").agg(*[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("rank"))).alias(n) for n in names])
    return latest.select("page", *[F.coalesce(f"d_{p}", f"t_{p}").alias(f"p_{p}") for p in PARTS])


def product_keys(listings: DataFrame, crawl: DataFrame, dictionary: Dictionary) -> DataFrame:
    """(output_id, listing, product): each listing with the key of its product, null where brand, model, strength, form or count stay unknown.

    What a listing's name leaves out comes from its attributes, then from the description of its page. A flavour told nowhere is none.
    """
    own, pages = read_listings(listings, dictionary), read_pages(crawl, dictionary)
    whole = own.join(pages, "page", "left")
    part = {p: F.coalesce(p, f"p_{p}") for p in PARTS}
    flavour = F.coalesce(part["flavour"], F.lit(""))
    parts = [F.col("brand"), F.col("model"), part["strength"], part["form"], part["count"]]
    complete = F.lit(True)
    for p in parts:
        complete = complete & p.isNotNull()
    return whole.select("output_id", "listing", F.when(complete, F.concat_ws("|", *parts, flavour)).alias("product"))


def same_products(keys: DataFrame) -> DataFrame:
    """(output_id_a, output_id_b): all pairs, a < b, of rows with the same product key, and of rows that export the same listing twice.

    The pairs are what is asked for: their number is quadratic in the rows of a product. Pairs of a listing that its product gives already are left
    out before they are made, so nothing has to be made distinct. `product_classes` tells the same without pairs.
    """
    side = keys.select("output_id", "listing", F.nullif(F.col("product"), F.lit("")).alias("product"))
    a, b = (side.select(F.col("output_id").alias(f"output_id_{x}"), F.col("product").alias(f"p_{x}"), F.col("listing").alias(f"l_{x}")) for x in "ab")
    ordered = F.col("output_id_a") < F.col("output_id_b")
    by_product = a.join(b, (F.col("p_a") == F.col("p_b")) & ordered)
    by_listing = a.join(b, (F.col("l_a") == F.col("l_b")) & ordered & ~F.coalesce(F.col("p_a") == F.col("p_b"), F.lit(False)))
    return by_product.select("output_id_a", "output_id_b").unionByName(by_listing.select("output_id_a", "output_id_b"))


def product_classes(keys: DataFrame) -> DataFrame:
    """(output_id, class_id, class_size): the class of every row without expanding pairs; class_id is its smallest output_id.

    Rows of one product are one class, and so are rows of one listing, also where these have several products. Rows are grouped by product first;
    only listings with rows of several groups link groups, and only these few links are followed, in rounds written to the shared folder, until no group
    changes. Rows without product and listing are classes of their own.
    """
    group = F.coalesce(F.concat(F.lit("p:"), F.nullif(F.col("product"), F.lit(""))), F.concat(F.lit("l:"), F.col("listing")), F.concat(F.lit("r:"), F.col("output_id").cast("string")))
    rows = materialise(keys.select("output_id", "listing", group.alias("g")), "grouped")
    spread = rows.filter(F.col("listing").isNotNull()).groupBy("listing").agg(F.min("g").alias("first"), F.max("g").alias("last")).filter("first < last").select("listing", "first")
    links = rows.select("listing", "g").distinct().join(spread, "listing").select(F.col("first").alias("x"), F.col("g").alias("y")).filter("x < y").distinct()
    edges = materialise(links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))), "links")
    label = materialise(edges.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("c")), "labels")
    while True:
        near = edges.join(label.select(F.col("x").alias("y"), F.col("c").alias("n")), "y").groupBy("x").agg(F.min("n").alias("n"))
        after = materialise(label.join(near, "x").select("x", F.least("c", "n").alias("c"), (F.col("n") < F.col("c")).alias("moved")), "labels")
        label = after.select("x", "c")
        if after.filter("moved").isEmpty():
            break
    named = rows.join(label.select(F.col("x").alias("g"), "c"), "g", "left").select("output_id", F.coalesce("c", "g").alias("k"))
    sizes = named.groupBy("k").agg(F.min("output_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return named.join(sizes, "k").select("output_id", "class_id", "class_size")
