"""Picture candidates of pages: scoring, binding to rendered pictures, upgrades proven on samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.functions import images as I
from catalith.functions import text as T
from catalith.functions.quantities import bind

# Label bonuses of candidates and labels that exclude one.
LABEL_SCORES = {"gallery": 30, "decorative": -18, "excluded": -100}
REJECTED_LABELS = ["ignore", "facts", "ingredients", "excluded"]
# Places of a page pictures are named in, best first, the bonus per place and that of pictures in an opened gallery.
SOURCE_ORDER = ["anchor_href", "data_zoom_src", "data_large_image", "data_original", "data_master", "srcset", "img_src", "data_src", "css_background", "meta"]
SOURCE_STEP, GALLERY_BONUS = 4, 40
# Words of a product name that tell nothing.
STOP_WORDS = ["the", "and", "with", "for", "from", "product", "products", "complement", "alimentaire"]
#: Samples probed per group, groups probed, and the least side of an approved original.
SAMPLES, GROUPS, LEAST_SIDE = 2, 12, 800


def hints(title: Column) -> Column:
    """IMG-08: different words of a product's name, of three signs or more, not mere numbers and no stop words."""
    return F.array_distinct(F.filter(F.split(T.words(title), " "), lambda w: (F.length(w) >= 3) & ~w.rlike(r"^\d+$") & ~w.isin(STOP_WORDS)))


def hint_score(text: Column, title: Column) -> Column:
    """IMG-08: 3 if a text holds the telling words of a name (two or more) in a row, 2 for two of them anywhere, else the number it holds; null texts hold none."""
    t = F.coalesce(T.words(text), F.lit(""))

    def score(words: Column) -> Column:
        n = F.size(F.filter(words, lambda w: F.contains(t, w)))
        return F.when((F.size(words) >= 2) & F.contains(t, F.array_join(words, " ")), 3).when(n >= 2, 2).otherwise(n)

    return bind(F.coalesce(hints(title), F.array().cast("array<string>")), score)


def resolve_candidates(candidates: DataFrame, page: str = "page", n: int = 12) -> DataFrame:
    """IMG-07: the n best candidates(page, idx, url, labels, source, in_gallery, base) of each page, one per identity: base score, bonus of an opened
    gallery, of the place the picture is named in and of its labels, then order on the page; pictures labelled as facts, ingredients, ignored or excluded are out."""
    labels = F.coalesce("labels", F.array().cast("array<string>"))
    place = F.array_position(F.array(*[F.lit(s) for s in SOURCE_ORDER]), F.col("source"))
    score = F.col("base") + F.when(F.col("in_gallery"), GALLERY_BONUS).otherwise(0) + F.when(place > 0, (len(SOURCE_ORDER) + 1 - place) * SOURCE_STEP).otherwise(0).cast("int")
    for label, bonus in LABEL_SCORES.items():
        score = score + F.when(F.array_contains(labels, label), bonus).otherwise(0)
    scored = candidates.filter(~F.arrays_overlap(labels, F.array(*[F.lit(x) for x in REJECTED_LABELS]))).withColumn("score", score).withColumn("k", I.identity(F.col("url")))
    best = scored.groupBy(page, "k").agg(F.max_by(F.struct("url", "score", "idx"), F.struct("score", -F.col("idx"))).alias("b")).select(page, "b.*")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy(page).orderBy(F.desc("score"), "idx")))
    return ranked.filter(F.col("rank") <= n)


def bind_to_rendered(rendered: DataFrame, candidates: DataFrame) -> DataFrame:
    """IMG-10, IMG-11: rendered pictures(page, idx, url) with the best candidate(page, url, tier) of the same identity or file name.

    The highest tier wins, the same identity goes before the same name; pictures without a candidate keep their own address. Two equi-joins
    instead of a join on an alternative.
    """
    keyed = candidates.select("page", F.col("url").alias("c_url"), "tier", I.identity(F.col("url")).alias("c_id"), I.basename_key(F.col("url")).alias("c_name"))
    anchors = rendered.withColumn("r_id", I.identity(F.col("url"))).withColumn("r_name", I.basename_key(F.col("url")))
    same = anchors.join(keyed.select("page", "c_url", "tier", F.col("c_id").alias("r_id")), ["page", "r_id"]).select("page", "idx", "c_url", "tier", F.lit(1).alias("direct"))
    named = anchors.join(keyed.select("page", "c_url", "tier", F.col("c_name").alias("r_name")), ["page", "r_name"]).select("page", "idx", "c_url", "tier", F.lit(0).alias("direct"))
    best = same.unionByName(named).groupBy("page", "idx").agg(F.max(F.struct("tier", "direct", "c_url")).alias("b"))
    return rendered.join(best, ["page", "idx"], "left").select("page", "idx", F.coalesce("b.c_url", "url").alias("url"))


def groups_to_probe(pictures: DataFrame, site: str = "site") -> DataFrame:
    """IMG-12: the samples to probe: of each site's first groups of transformed pictures (by platform, origin and cache key or account), two each."""
    o = I.original(F.col("url"))
    rows = pictures.select(site, "url", "idx", o["original"].alias("original"), o["validation_group"].alias("grp")).filter(F.col("original").isNotNull()).dropDuplicates([site, "url"])
    first = rows.groupBy(site, "grp").agg(F.min("idx").alias("at"))
    kept = first.withColumn("g", F.row_number().over(Window.partitionBy(site).orderBy("at", "grp"))).filter(F.col("g") <= GROUPS).select(site, "grp")
    sampled = rows.join(kept, [site, "grp"]).withColumn("s", F.row_number().over(Window.partitionBy(site, "grp").orderBy("idx", "url")))
    return sampled.filter(F.col("s") <= SAMPLES).select(site, "grp", "url", "original")


def upgrade(pictures: DataFrame, probes: DataFrame, site: str = "site") -> DataFrame:
    """IMG-12: pictures with their original address where every probe(site, grp, is_image, side) of their group proved it, else as they were."""
    proven = probes.groupBy(site, "grp").agg(F.bool_and(F.coalesce(F.col("is_image") & (F.col("side") >= LEAST_SIDE), F.lit(False))).alias("ok"))
    o = I.original(F.col("url"))
    rows = pictures.withColumn("__original", o["original"]).withColumn("grp", o["validation_group"]).join(proven, [site, "grp"], "left")
    return rows.withColumn("url", F.when(F.col("ok"), F.col("__original")).otherwise(F.col("url"))).drop("__original", "ok", "grp")
