"""Column expressions on the links of listing pages: what they lead to, how good they are, and the next page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalith.functions import html as H
from catalith.functions import urls as U
from catalith.functions.quantities import bind

# Texts of links to all products of a shop, and words of links to a part of it.
ALL_TEXTS = [
    "all", "all products", "shop", "shop all", "view all", "browse all", "new products", "all items", "products", "our products", "toate produsele", "vezi toate", "tous les produits", "voir tout", "boutique", "alle produkte", "alle ansehen", "todos los productos", "ver todos", "tienda",
    "tutti i prodotti", "vedi tutto", "negozio", "todos os produtos", "loja", "wszystkie produkty", "sklep", "všechny produkty", "obchod", "eshop", "e-shop", "webshop", "alle producten", "winkel", "alla produkter", "alle produkter", "kaikki tuotteet", "tüm ürünler", "mağaza", "все товары", "все продукты", "магазин",
    "全部商品", "所有商品", "所有产品", "全部产品", "商城", "すべての商品", "全商品", "商品一覧", "전체상품", "전체 상품", "모든 제품",
]
CATEGORY_WORDS = [
    "category", "categories", "collection", "collections", "shop", "store", "menu", "supplements", "nutrition", "vitamins", "proteins", "new products", "catalog", "catalogo", "catálogo", "katalog", "prodotti", "categorie", "integratori", "productos", "categorías", "categorias", "suplementos", "vitaminas", "produtos", "produits", "catégories", "compléments",
    "produkte", "kategorien", "nahrungsergänzung", "sortiment", "producten", "categorieën", "assortiment", "produkty", "kategorie", "suplementy", "doplňky", "produse", "categorii", "suplimente", "ürünler", "kategoriler", "товары", "продукты", "каталог", "категории", "витамины", "产品", "商品", "分类", "品类", "제품", "상품", "카테고리", "製品", "カテゴリ",
]
SHOP_TEXTS = {"category": ["shop", "all", "all products", "shop all", "view all", "browse all", "new products"], "menu": ["all", "all products", "shop all", "view all", "browse all", "products", "shop"]}
# Texts of links to the next page or to more of the same.
NEXT_WORDS = [
    "next page", "older", "następna", "dalej", "suivant", "page suivante", "weiter", "nächste", "siguiente", "página siguiente", "successiva", "avanti", "seguinte", "próxima", "volgende", "nästa", "næste", "neste", "seuraava", "další", "následující", "sonraki", "далее", "следующая", "次へ", "次のページ", "다음", "下一页", "下一頁",
    "load more", "show more", "view more", "see more", "more products", "mehr laden", "mehr anzeigen", "weitere produkte", "mostra altri", "carica altri", "mostra di più", "voir plus", "afficher plus", "charger plus", "cargar más", "ver más", "mostrar más", "más productos", "mais produtos", "carregar mais", "ver mais", "toon meer", "meer laden",
    "pokaż więcej", "załaduj więcej", "zobrazit více", "načíst další", "visa fler", "vis flere", "vis mere", "näytä lisää", "daha fazla", "показать ещё", "показать еще", "загрузить ещё", "загрузить еще", "加载更多", "查看更多", "显示更多", "更多商品", "もっと見る", "さらに表示", "더보기", "더 보기", ">", "»", "›",
]
ALL_PATHS = r"(/collections/(all|shop-all)|/(all-products|shop-all|products|shop|store)|/menu/shop-\d+\.html)$"


def _is_all(text: Column, url: Column) -> Column:
    return F.lower(text).isin(ALL_TEXTS) | F.lower(U.path(url)).rlike(ALL_PATHS)


def _is_part(text: Column, url: Column) -> Column:
    return U.is_category(url) | F.lower(text).rlike("|".join(CATEGORY_WORDS))


def _short(url: Column) -> Column:
    return F.size(F.filter(F.split(U.path(url), "/"), lambda s: s != "")) <= 3


def category_role(text: Column, url: Column) -> Column:
    """WIN-02: 'all' for a link to all products, 'category' for one to a part of them, null for products and others; null texts count as empty."""
    t = F.coalesce(F.trim(text), F.lit(""))
    return F.when(U.is_product(url), F.lit(None).cast("string")).when(_is_all(t, url), "all").when(_is_part(t, url), "category")


def category_score(text: Column, url: Column, css: Column, role: Column) -> Column:
    """WIN-02: score of a link of a role: 100 for all and 50 for a part, more for a plain text, a short path and a place in a header or menu; null without a role."""
    plain = (role == "all") & F.lower(F.trim(text)).isin(SHOP_TEXTS["category"])
    extra = F.when(plain, 25).otherwise(0) + F.when(_short(url), 10).otherwise(0) + F.when(F.lower(css).rlike("header|nav|menu"), 5).otherwise(0)
    return F.when(role.isNotNull(), F.when(role == "all", 100).otherwise(50) + extra)


def menu_kind(text: Column, url: Column) -> Column:
    """WIN-02: what a menu entry leads to: all, products, category or unknown."""
    t = F.coalesce(F.trim(text), F.lit(""))
    return F.when(_is_all(t, url), "all").when(U.is_product(url), "products").when(_is_part(t, url), "category").otherwise("unknown")


def menu_score(text: Column, url: Column, css: Column, kind: Column) -> Column:
    """WIN-02: score of a menu entry by kind, path, place and plain text."""
    base = F.lit(40) + F.when(kind == "all", 60).when(kind == "products", 25).when(kind == "category", 20).otherwise(0)
    return base + F.when(_short(url), 10).otherwise(0) + F.when(F.lower(css).rlike("menu|nav|header"), 5).otherwise(0) + F.when(F.lower(F.trim(text)).isin(SHOP_TEXTS["menu"]), 10).otherwise(0)


def _says_next(text: Column) -> Column:
    t = F.lower(F.coalesce(text, F.lit("")))
    return t.rlike(r"(^|\W)next(\W|$)") | t.rlike("|".join(NEXT_WORDS))


def next_page(html: Column, base: Column) -> Column:
    """WIN-04: address of the next page of a listing, null for none: of links within the site that are not rejected, the first with rel=next, else the first whose text
    says so; else a control that says so and names a page's address, smallest first; else the link to the smallest page above the present one."""
    anchors = F.regexp_extract_all(html, F.lit(r"(?is)<(?:a\s[^>]*>.*?</a>|link\s[^>]*>)"), F.lit(0))
    opening = lambda a: F.regexp_extract(a, r"(?is)^(<\w+\s[^>]*>)", 1)

    def link(a: Column) -> Column:
        said = lambda at: F.concat_ws(" ", H.to_text(a), at["aria-label"], at["title"], at["class"])
        href = lambda at: bind(at["href"], lambda h: U.resolved(base, h))
        return bind(H.attributes(opening(a)), lambda at: F.struct(href(at).alias("href"), F.coalesce(at["rel"], F.lit("")).alias("rel"), said(at).alias("said"), H.to_text(a).alias("text")))

    def usable(url: Column) -> Column:
        return F.coalesce(U.same_site(base, url) & ~U.is_rejected(url), F.lit(False))

    def choose(links: Column) -> Column:
        ranked = F.transform(links, lambda x, i: F.struct(F.when(F.array_contains(F.split(F.lower(x["rel"]), r"\s+"), "next"), 100).when(_says_next(x["said"]), 90).otherwise(0).alias("score"), (-i).alias("i"), x["href"].alias("href")))
        named = F.array_max(F.filter(ranked, lambda x: x["score"] > 0))["href"]
        numbered = F.transform(links, lambda x, i: F.struct(U.page_number(x["href"], x["text"]).alias("page"), i.alias("i"), x["href"].alias("href")))
        later = F.array_min(F.filter(numbered, lambda x: x["page"] > F.coalesce(U.page_number(base), F.lit(1))))["href"]
        controls = F.transform(F.filter(H.interactive(html), lambda x: (x["tag"] != "a") & _says_next(x["text"])), lambda x: U.resolved(base, F.coalesce(F.nullif(F.regexp_extract(x["target"], r"""["'`]((?:/|https?://)[^"'`]+)""", 1), F.lit("")), x["target"])))
        inline = F.array_min(F.filter(controls, lambda u: usable(u) & U.page_number(u).isNotNull()))
        return bind(F.coalesce(named, inline, later), U.normalised)

    return bind(F.filter(F.transform(anchors, link), lambda x: usable(x["href"])), choose)
