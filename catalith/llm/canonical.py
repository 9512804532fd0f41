"""Mapping freely typed values to a canonical list: exact keys, mined carriers and contexts, then weighted n-gram cosine."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalith.functions import text as T
from catalith.runtime import bounded_rows, dimension, materialise, ship_package

#: A candidate is accepted from this weighted cosine on, and if it leads the best one of another entry by the margin.
THRESHOLD, MARGIN = 0.53, 0.06
#: Below, down to this cosine, a candidate is accepted if the words of value and term pair up, each with at least this share of equal letter pairs.
PAIRED_THRESHOLD, PAIRED_SHARE = 0.42, 0.5
#: A word or phrase around exact names of at least so many entries of a kind is a carrier ("supports ...", "... powder").
CARRIER_ENTRIES = 4
CARRIER_WORDS = 3
#: Weight, in grams, of a word's signature (first letter and set of letters), which doubled and swapped letters leave alone.
SIGNATURE_COUNT = 2
#: Weight, in grams, of a word with a digit (a code such as k2), which is either right or another one.
CODE_COUNT = 3
#: A value seen so often beside the context of one entry, at least this share of the times, and so many times as often as beside that of any other, means the entry.
CONTEXT_COUNT, CONTEXT_SHARE, CONTEXT_LEAD = 5, 0.4, 3


def value_key(value: Column) -> Column:
    """Normal form under which spellings of one value meet: folded words."""
    return T.words(value)


def sorted_key(key: Column) -> Column:
    """A key with its words in order, for values whose words are swapped."""
    return F.array_join(F.array_sort(F.split(key, " ")), " ")


def signature(key: Column) -> Column:
    """A key with each longer word of letters as its first letter and its set of letters, words in order: the same for slips that double or swap
    letters, other words as they stand."""
    one = lambda w: F.when((F.length(w) > 3) & ~w.rlike(r"\d"), F.concat(F.substring(w, 1, 1), F.lit("~"), F.array_join(F.array_sort(F.array_distinct(F.split(w, ""))), ""))).otherwise(w)
    return F.array_join(F.array_sort(F.transform(F.split(key, " "), one)), " ")


def term_list(vocabulary: DataFrame, aliases: DataFrame) -> DataFrame:
    """(kind, key, entry_id): names and aliases by key. A name goes before an alias; of aliases of one key the most frequent, then the smallest entry."""
    names = vocabulary.filter(F.trim("name") != "").select("kind", value_key(F.col("name")).alias("key"), F.col("id").alias("entry_id"), F.lit(0).alias("tier"), F.lit(1).alias("n"))
    canonical = vocabulary.select("kind", F.col("id").alias("entry_id"), value_key(F.col("name")).alias("canonical_key"))
    keyed = aliases.select(value_key(F.col("alias")).alias("key"), value_key(F.col("canonical")).alias("canonical_key"))
    other = keyed.join(canonical, "canonical_key").groupBy("kind", "key", "entry_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    terms = names.unionByName(other.select("kind", "key", "entry_id", F.lit(1).alias("tier"), "n")).filter(F.col("key") != "")
    best = F.row_number().over(Window.partitionBy("kind", "key").orderBy("tier", F.desc("n"), "entry_id"))
    return terms.withColumn("r", best).filter("r = 1").select("kind", "key", "entry_id")


def mine_carriers(keys: DataFrame, terms: DataFrame) -> DataFrame:
    """(kind, side, phrase): phrases before or after which exact names of at least CARRIER_ENTRIES entries of the kind stand in other values."""
    words = F.split("key", " ")
    n = F.size(words)
    cut = keys.filter(n > 1).select("kind", words.alias("w"), F.explode(F.sequence(F.lit(1), F.least(F.lit(CARRIER_WORDS), n - 1))).alias("c"))
    size = F.size("w")
    before = cut.select("kind", F.lit("before").alias("side"), F.array_join(F.slice("w", F.lit(1), F.col("c")), " ").alias("phrase"), F.array_join(F.slice("w", F.col("c") + 1, size - F.col("c")), " ").alias("key"))
    after = cut.select("kind", F.lit("after").alias("side"), F.array_join(F.slice("w", size - F.col("c") + 1, F.col("c")), " ").alias("phrase"), F.array_join(F.slice("w", F.lit(1), size - F.col("c")), " ").alias("key"))
    held = before.unionByName(after).join(terms, ["kind", "key"])
    return held.groupBy("kind", "side", "phrase").agg(F.count_distinct("entry_id").alias("entries")).filter(F.col("entries") >= CARRIER_ENTRIES).select("kind", "side", "phrase")


def mine_contexts(keys: DataFrame, contexts: DataFrame) -> DataFrame:
    """(kind, key, entry_id): keys that stand beside the context of one entry far more often than beside any other's. `contexts` is (kind, key, entry_id) per occurrence."""
    counts = contexts.filter(F.col("key") != "").groupBy("kind", "key", "entry_id").count()
    by = Window.partitionBy("kind", "key")
    ranked = by.orderBy(F.desc("count"), "entry_id")
    shares = counts.withColumn("total", F.sum("count").over(by)).withColumn("r", F.row_number().over(ranked)).withColumn("second", F.coalesce(F.lead("count").over(ranked), F.lit(0)))
    sure = shares.filter((F.col("r") == 1) & (F.col("count") >= CONTEXT_COUNT) & (F.col("count") >= CONTEXT_SHARE * F.col("total")) & (F.col("count") >= CONTEXT_LEAD * F.col("second")))
    return sure.join(keys.select("kind", "key").distinct(), ["kind", "key"], "left_semi").select("kind", "key", "entry_id")


class GramIndex:
    """Inverted index of character n-grams and word signatures over the terms of one kind. Only terms that share a gram with a key are scored."""

    def __init__(self, terms: list[tuple[str, str]]) -> None:
        self.entries, self.keys = [e for _, e in terms], [k for k, _ in terms]
        grams = [self._grams(k) for k, _ in terms]
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, counts in enumerate(grams):
            for g, n in counts.items():
                found[g].append((i, n))
        self.rare = math.log(1 + len(terms))
        self.weight = {g: math.log(1 + len(terms) / len(posts)) for g, posts in found.items()}
        norms = [math.sqrt(sum((n * self.weight[g]) ** 2 for g, n in c.items())) or 1.0 for c in grams]
        self.posts = {g: [(i, n * self.weight[g] / norms[i]) for i, n in posts] for g, posts in found.items()}

    @staticmethod
    def _grams(key: str) -> dict[str, int]:
        counts: dict[str, int] = defaultdict(int)
        text = f" {key} "
        for n in (2, 3):
            for i in range(len(text) - n + 1):
                counts[text[i : i + n]] += 1
        for word in key.split():
            if any(c.isdigit() for c in word):
                counts["=" + word] += CODE_COUNT
            elif len(word) > 3:
                counts["#" + word[0] + "".join(sorted(set(word)))] += SIGNATURE_COUNT
        return counts

    def best(self, key: str) -> tuple[str | None, float, float, str]:
        """(entry, cosine, cosine of the best other entry, best term) for a key; of equal terms the smaller entry, then term."""
        scores: dict[int, float] = defaultdict(float)
        norm = 0.0
        for g, n in self._grams(key).items():
            w = n * self.weight.get(g, self.rare)
            norm += w * w
            for i, part in self.posts.get(g, ()):
                scores[i] += w * part
        if not scores:
            return None, 0.0, 0.0, ""
        first = min(scores, key=lambda i: (-scores[i], self.entries[i], self.keys[i]))
        other = max((s for i, s in scores.items() if self.entries[i] != self.entries[first]), default=0.0)
        return self.entries[first], scores[first] / math.sqrt(norm), other / math.sqrt(norm), self.keys[first]


def words_pair_up(a: str, b: str) -> bool:
    """Whether each word of either key has a word in the other with at least PAIRED_SHARE of equal letter pairs (Dice)."""

    def pairs(word: str) -> set[str]:
        return {f" {word} "[i : i + 2] for i in range(len(word) + 1)}

    x, y = [pairs(w) for w in a.split()], [pairs(w) for w in b.split()]
    close = lambda p, q: 2 * len(p & q) >= 2 * PAIRED_SHARE * (len(p) + len(q)) / 2
    return bool(x and y) and all(any(close(p, q) for q in y) for p in x) and all(any(close(p, q) for p in x) for q in y)


def bare_forms(key: str, before: frozenset[str], after: frozenset[str]) -> list[str]:
    """A key, and what is left of it when carriers are taken off its ends, those with least taken off first."""
    forms, todo, seen = [], [key.split()], set()
    while todo:
        w = todo.pop(0)
        if tuple(w) in seen:
            continue
        seen.add(tuple(w))
        forms.append(" ".join(w))
        for c in range(min(CARRIER_WORDS, len(w) - 1), 0, -1):
            if " ".join(w[:c]) in before:
                todo.append(w[c:])
            if " ".join(w[-c:]) in after:
                todo.append(w[:-c])
    return forms


def own_carriers(keys: DataFrame, carriers: DataFrame) -> DataFrame:
    """(kind, key, before, after): keys of several words with the carriers that occur in them, so that no list of all carriers is needed anywhere."""
    words = F.split("key", " ")
    n = F.size(words)
    runs = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(CARRIER_WORDS), n - i)), lambda c: F.array_join(F.slice(words, i + 1, c), " "))))
    held = keys.filter(n > 1).select("kind", "key", F.explode(F.array_distinct(runs)).alias("phrase")).join(carriers, ["kind", "phrase"])
    side = lambda name: F.collect_set(F.when(F.col("side") == name, F.col("phrase")))
    return held.groupBy("kind", "key").agg(side("before").alias("before"), side("after").alias("after"))


def match_values(values: DataFrame, vocabulary: DataFrame, aliases: DataFrame, contexts: DataFrame | None = None, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """(kind, raw_value, entry_id or null, method, score) of each different value of `values`(kind, raw_value).

    Values are deduplicated and normalised; a key that is a name or alias of its kind, as it stands or with its words swapped, is that
    entry, and so is one with the signature of its names only. Carriers, mined from all values, are taken off before, and keys that stand beside the context of one entry far more often than beside
    any other's are taken for it. What is left is scored against the n-gram index of the names and aliases by weighted cosine and accepted
    above the threshold and margin; else entry_id is null. Null and blank values have no key and are unmatched. Everything mined from the
    values stays in tables and meets the keys by joins; only the vocabulary, a bounded reference list, is read by the driver.
    """
    spark = values.sparkSession
    ship_package(spark)
    distinct = materialise(values.select("kind", "raw_value").distinct().withColumn("key", value_key(F.col("raw_value"))), "values")
    keys = distinct.select("kind", "key").distinct().filter(F.col("key") != "")
    terms = dimension(term_list(vocabulary, aliases), "terms")
    exact = terms.select("kind", F.col("key").alias("form"), "entry_id", F.lit("name").alias("method"), F.lit(0).alias("prio"))
    if contexts is not None:
        learned = mine_contexts(keys, contexts).join(terms.select("kind", "key"), ["kind", "key"], "left_anti")
        exact = materialise(exact.unionByName(learned.select("kind", F.col("key").alias("form"), "entry_id", F.lit("context").alias("method"), F.lit(1).alias("prio"))), "exact")
    swapped = exact.groupBy("kind", sorted_key(F.col("form")).alias("form")).agg(F.min_by("entry_id", F.struct("prio", "form")).alias("entry_id")).select("*", F.lit("swapped").alias("method"), F.lit(2).alias("prio"))

    # Spellings with one signature that all mean one entry; of several entries none is taken.
    spelled = exact.groupBy("kind", signature(F.col("form")).alias("form")).agg(F.min("entry_id").alias("entry_id"), F.max("entry_id").alias("__last")).filter("entry_id = __last AND form LIKE '%~%'")
    spelled = spelled.select("kind", "form", "entry_id", F.lit("signature").alias("method"), F.lit(3).alias("prio"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [bare_forms(k, frozenset(b or ()), frozenset(a or ())) for k, b, a in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.string()))], names=["kind", "key", "forms"])

    carried = keys.join(own_carriers(keys, mine_carriers(keys, terms)), ["kind", "key"], "left")
    forms = materialise(carried.mapInArrow(strip, "kind string, key string, forms array<string>"), "forms")
    each = forms.select("kind", "key", F.posexplode("forms").alias("pos", "form"))
    hits = each.join(exact, ["kind", "form"])
    for look_up, key_of in ((swapped, sorted_key), (spelled, signature)):
        hits = hits.unionByName(each.withColumn("form", key_of(F.col("form"))).join(look_up, ["kind", "form"]))
    known = materialise(hits.groupBy("kind", "key").agg(F.min_by(F.struct("entry_id", "method"), F.struct(F.when(F.col("prio") < 3, 0).otherwise(1), "pos", "prio", "entry_id")).alias("h")).select("kind", "key", "h.*"), "known")
    listed: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for r in sorted(bounded_rows(terms)):
        listed[r["kind"]].append((r["key"], r["entry_id"]))
    shared = spark.sparkContext.broadcast({kind: GramIndex(entries) for kind, entries in listed.items()})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value

        def decide(kind: str, forms: list[str]) -> tuple[str | None, str, float]:
            if kind not in index:
                return None, "unmatched", 0.0
            results = [(*index[kind].best(x), x) for f in forms for x in dict.fromkeys((f, " ".join(reversed(f.split()))))]
            entry, top, _, term, form = max(results, key=lambda r: r[1])
            other = max((t if e != entry else o) for e, t, o, _, _ in results)
            if entry is not None and top - other >= margin and (top >= threshold or (top >= PAIRED_THRESHOLD and words_pair_up(form, term))):
                return entry, "ngram", top
            return None, "unmatched", top

        for batch in batches:
            out = [decide(k, f) for k, f in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            arrays = [batch.column(0), batch.column(1), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["kind", "key", "entry_id", "method", "score"])

    rest = forms.join(known.select("kind", "key"), ["kind", "key"], "left_anti")
    scored = rest.mapInArrow(score, "kind string, key string, entry_id string, method string, score double")
    decided = known.withColumn("score", F.lit(1.0)).unionByName(scored)
    return distinct.join(decided, ["kind", "key"], "left").select("kind", "raw_value", "entry_id", F.coalesce("method", F.lit("unmatched")).alias("method"), "score")


def map_values(rows: DataFrame, vocabulary: DataFrame, aliases: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """`rows`(row_id, kind, raw_value) with entry_id, method and score, blank values left out. Values are matched once each and joined back; repeated rows each keep theirs."""
    filled = rows.filter(T.squeeze(F.col("raw_value")).isNotNull())
    matched = dimension(match_values(filled, vocabulary, aliases, contexts), "matched")
    return filled.join(matched, ["kind", "raw_value"])


def typed_values(listings: DataFrame, inferences: DataFrame) -> DataFrame:
    """(row_id, kind, raw_value, first, substance, category) of the three freely typed fields, each table read once: the value as typed, whether it is
    the first such of its row and kind, and the substance and category written beside it."""
    text = lambda c: c.cast("string")
    item = lambda kind, value, substance, category: F.struct(F.lit(kind).alias("kind"), value.alias("raw_value"), text(substance).alias("substance"), text(category).alias("category"))
    none = F.lit(None)
    empty = F.array().cast("array<struct<kind: string, raw_value: string, substance: string, category: string>>")

    def marked(items: Column, values: Column) -> Column:
        return F.transform(items, lambda x, i: x.withField("first", F.array_position(values, x["raw_value"]) == i + 1))

    functions = F.transform("health_functions", lambda v: item("health_functions", v, none, none))
    names = F.transform("main_ingredients", lambda m: item("main_ingredients", m["name"], m["substance"], m["category"]))
    both = F.concat(F.coalesce(marked(functions, F.col("health_functions")), marked(empty, F.array().cast("array<string>"))), F.coalesce(marked(names, F.col("main_ingredients.name")), marked(empty, F.array().cast("array<string>"))))
    typed = listings.select(F.col("output_id").alias("row_id"), F.explode(both).alias("t")).select("row_id", "t.*")
    inferred = inferences.select(F.col("inference_id").alias("row_id"), F.lit("category").alias("kind"), F.col("taxonomy.category").alias("raw_value"), F.col("taxonomy.substance").alias("substance"), F.lit(None).cast("string").alias("category"), F.lit(True).alias("first"))
    return typed.unionByName(inferred)


def typed_contexts(typed: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(kind, key, entry_id) per occurrence: names beside a listed substance, and categories beside a substance whose listings mostly have one listed category."""
    entry = lambda kind: vocabulary.filter(F.col("kind") == kind).select(F.col("name").alias("__name"), F.col("id").alias("entry_id"))
    items = typed.filter("kind = 'main_ingredients' AND substance IS NOT NULL")
    names = items.join(entry("main_ingredients"), F.col("substance") == F.col("__name")).select("kind", value_key(F.col("raw_value")).alias("key"), "entry_id")
    beside = items.filter("category IS NOT NULL").groupBy("substance", "category").count()
    usual = beside.groupBy("substance").agg(F.max_by("category", F.struct("count", "category")).alias("usual"))
    sorts = typed.filter("kind = 'category' AND substance IS NOT NULL").select("kind", "substance", value_key(F.col("raw_value")).alias("key")).join(usual, "substance").join(entry("category"), F.col("usual") == F.col("__name")).select("kind", "key", "entry_id")
    return names.unionByName(sorts).filter(F.col("key").isNotNull())
