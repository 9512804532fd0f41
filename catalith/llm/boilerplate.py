"""Main content of web page texts: maximum-scoring regions of one sequence of words and tags, weights trained on labelled pages."""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm.labelled_lines import MAIN_TEXT, SURROUNDINGS
from catalith.runtime import ship_package

#: Cost of opening a further region of main text, in the unit of the weights (nats); chosen on held-out pages by `region_costs`.
REGION_COST = 0.1
#: Score a line starts with, on its first word: lines without any known word count as main text.
PRIOR = 0.5
# Words taken as one feature each: measuring units, and words of dosage forms.
_UNITS = frozenset("mg mcg ug µg μg g gm gram grams milligram milligrams microgram micrograms iu ui ie cfu ufc kbe billion million millones milliards milliarden mrd kcal kj oz".split())
_FORMS = frozenset(
    "capsule capsules caps vcaps kapseln kaps cápsulas cáps gélules softgels gels weichkapseln perlas tablets tabs tabletten tabl comprimidos comprimés comp cp gummies gummy gummis fruchtgummis gominolas gomitas gommes lozenges lutschtabletten pastillas pastilles".split()
)
_TOKEN = re.compile(r"<name>|<site>|<n>|[^\W\d_]+(?:'[^\W\d_]+)?|\d+(?:[.,:]\d+)*|[|>/©:•%*?]|\(c\)|  +| - ")


def sequence(line: str, site: str = "") -> list[tuple[str, list[str]]]:
    """The words and tags of a line, each with its features: the word, its stem, the pair with the one before, the line's start. The last
    element is the tag that ends the line; its features are the line's shapes (no full stop, length, capitals)."""
    low = re.sub(r"\b([iu])\.([iue])\.", r"\1\2", line.strip().lower())
    if site and site in low:
        low = low.replace(site, "<site>")
    out: list[tuple[str, list[str]]] = []
    seen: set[str] = set()
    last = "^"
    for t in _TOKEN.findall(low):
        if t[0].isdigit():
            t = "<n>"
        elif t.isspace():
            t = "<gap>"
        elif t in _UNITS:
            t = "<unit>"
        elif t in _FORMS:
            t = "<form>"
        features = [t, f"{last} {t}"] + ([f"{t[:5]}~"] if len(t) > 5 and t[0].isalpha() else [])
        out.append((t, [f for f in features if f not in seen]))
        seen.update(features)
        last = t
    if out:
        words = re.findall(r"[^\W\d_]{2,}", line)
        shape = ["<no stop>"] * (not low.endswith((".", "!"))) + [f"<length {min(len(words) // 4, 4)}>"] + ["<capitals>"] * (len(words) > 1 and sum(w[0].isupper() for w in words) * 2 > len(words))
        out.append(("<line>", shape))
    return out


def _row(line: str, words: int) -> list[str]:
    """Features of a labelled line whose names are filled by so many stand-in words; those of the stand-ins themselves are left out."""
    return sorted({f for _, features in sequence(line.replace("<name>", " ".join(["Qqzz"] * words))) for f in features if "qqzz" not in f})


def train(main: list[str], surroundings: list[str], rounds: int = 400, rate: float = 0.5, ridge: float = 0.002) -> dict[str, float]:
    """Weights of words and tags by logistic regression on labelled lines, positive for main text."""
    rows = [(_row(x, n), 1.0) for x in main for n in (1, 2, 3)] + [(_row(x, n), 0.0) for x in surroundings for n in (1, 2, 3)]
    names = sorted({t for r, _ in rows for t in r})
    place = {t: i for i, t in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for i, (row, _) in enumerate(rows):
        x[i, [place[t] for t in row]] = 1.0
    y = np.array([label for _, label in rows])
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w = np.zeros(len(names))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w + PRIOR, -30, 30)))
        w -= rate * len(y) ** 0.5 * (x.T @ (share * (p - y)) + ridge / len(y) * w)
    return dict(zip(names, w.tolist(), strict=True))


@functools.cache
def default_weights() -> dict[str, float]:
    """Weights of the library's labelled lines."""
    return train(MAIN_TEXT, SURROUNDINGS)


def line_score(line: str, weights: dict[str, float], site: str = "") -> float:
    """Sum of the scores of a line's words and tags, and the prior: what a region gains by reaching from its one end to the other."""
    return PRIOR + sum(weights.get(f, 0.0) for _, features in sequence(line, site) for f in features)


def best_region(values: list[float]) -> tuple[int, int]:
    """(first, end) of the contiguous region of greatest total, by one linear scan; the earliest, then shortest of equals; (0, 0) where none is above zero."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, v in enumerate(values):
        if total <= 0:
            total, start = 0.0, i
        total += v
        if total > best:
            best, found = total, (start, i + 1)
    return found


def best_regions(values: list[float], cost: float = REGION_COST) -> list[bool]:
    """Which elements lie in the set of contiguous regions of greatest total, each region after the first costing `cost`; one linear scan.

    With a cost of 0 these are the positive elements; with an infinite one the single maximum-scoring subsequence of `best_region`.
    """
    low = float("-inf")
    best = (0.0, low, low, low)  # before the first region, in it, between regions, in a later one
    came: list[tuple[int, int, int]] = []
    for v in values:
        before, first, between, later = best
        to_first = 0 if before >= first else 1
        to_between = max((2, 1, 3), key=lambda s: best[s])
        to_later = 2 if between - cost > later else 3
        came.append((to_first, to_between, to_later))
        best = (before, v + max(before, first), best[to_between], v + max(between - cost, later))
    state = max((0, 2, 1, 3), key=lambda s: best[s])
    kept = [False] * len(values)
    for i in range(len(values) - 1, -1, -1):
        kept[i] = state in (1, 3)
        state = came[i][state - 1] if state else 0
    return kept


class Classifier:
    """Finds the main lines of texts; scores of repeated lines are remembered up to a bound."""

    def __init__(self, weights: dict[str, float], cost: float = REGION_COST, memory: int = 100_000) -> None:
        self.weights, self.cost, self.bound = weights, cost, memory
        self.memory: dict[tuple[str, str], float] = {}

    def _score(self, line: str, site: str) -> float:
        key = (line, site if site and site in line.lower() else "")
        if (found := self.memory.get(key)) is None:
            if len(self.memory) >= self.bound:
                self.memory.clear()
            found = self.memory[key] = line_score(line, self.weights, key[1])
        return found

    def lines(self, text: str, site: str) -> list[tuple[int, str, bool]]:
        """(number from 1, line, is main text) of each line that isn't blank: all words and tags are one sequence, in which regions begin and end at line breaks."""
        found = [(n, line) for n, raw in enumerate(text.split("\n"), 1) if (line := raw.removesuffix("\r")).strip(" \t\r\f\v \u200b\ufeff\xa0\u202f")]
        kept = best_regions([self._score(line, site) for _, line in found], self.cost)
        return [(n, line, k) for (n, line), k in zip(found, kept, strict=True)]


def pages(main: list[str], surroundings: list[str], n: int, seed: int) -> list[list[tuple[str, bool]]]:
    """Labelled pages made of labelled lines: surroundings at the top and bottom, and between the main lines where a coin says so."""
    r = random.Random(seed)
    words = ["Qqzz", "Qqzz Qqxx", "Qqzz Qqxx Qqyy"]

    def line(of: list[str], label: bool) -> tuple[str, bool]:
        return re.sub("<name>", lambda _: r.choice(words), re.sub("<n>", lambda _: str(r.randrange(1, 500)), r.choice(of))), label

    out = []
    for _ in range(n):
        page = [line(surroundings, False) for _ in range(r.randrange(3))]
        for _ in range(r.randrange(1, 7)):
            page.append(line(main, True))
            if r.random() < 0.25:
                page.append(line(surroundings, False))
        out.append(page + [line(surroundings, False) for _ in range(r.randrange(3))])
    return out


def region_costs(costs: list[float], folds: int = 5, seed: int = 5) -> dict[float, float]:
    """Share of lines told wrong on held-out pages for each cost of a further region: lines are parted into folds, pages of a fold are made of its
    lines only and told with weights trained on the other lines."""
    r = random.Random(seed)
    lines = [(x, True) for x in MAIN_TEXT] + [(x, False) for x in SURROUNDINGS]
    r.shuffle(lines)
    wrong, total = dict.fromkeys(costs, 0), 0
    for fold in range(folds):
        mine, rest = lines[fold::folds], [x for i, x in enumerate(lines) if i % folds != fold]
        w = train([x for x, m in rest if m], [x for x, m in rest if not m])
        for page in pages([x for x, m in mine if m], [x for x, m in mine if not m], 200, seed + fold):
            text = "\n".join(x for x, _ in page)
            total += len(page)
            for c in costs:
                wrong[c] += sum(m != label for (_, _, m), (_, label) in zip(Classifier(w, c).lines(text, "<site>"), page, strict=True))
    return {c: n / total for c, n in wrong.items()}


def _site(domain: str | None) -> str:
    name = (domain or "").lower().removeprefix("www.").split(".")[0]
    return name if len(name) > 3 else ""


def classify_lines(pages: DataFrame, id_col: str, fields: dict[str, str], domain_col: str = "domain", weights: dict[str, float] | None = None) -> DataFrame:
    """(id, field_name, line_no, is_main): each non-blank line of the text columns `fields` (name -> column), told main text or surroundings.

    Each text is one sequence of words and tags with trained scores; one linear scan finds its maximum-scoring region and further ones worth
    their cost, which begin and end at line breaks. Pages are read once in Arrow batches and never shuffled; whole texts count, however long. Null and blank texts have no lines, repeated rows each
    their own.
    """
    ship_package(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(weights or default_weights())
    names = list(fields)
    id_type = pages.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            sites = [_site(d) for d in batch.column(1).to_pylist()]
            ids = batch.column(0).to_pylist()
            for f, name in enumerate(names):
                for key, site, text in zip(ids, sites, batch.column(2 + f).to_pylist(), strict=True):
                    for no, _, main in classifier.lines(text, site) if text else ():
                        for column, value in zip(out, (key, name, no, main), strict=True):
                            column.append(value)
            types = [batch.schema.field(0).type, pa.string(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=[id_col, "field_name", "line_no", "is_main"])

    columns = [F.col(id_col), F.col(domain_col).cast("string").alias("domain"), *[F.col(c).cast("string").alias(f"__text{i}") for i, c in enumerate(fields.values())]]
    return pages.select(*columns).mapInArrow(scan, f"{id_col} {id_type}, field_name string, line_no int, is_main boolean")


def main_texts(pages: DataFrame, id_col: str, fields: dict[str, str], domain_col: str = "domain", weights: dict[str, float] | None = None) -> DataFrame:
    """(id, one text per field): the main lines of each text, joined by line ends; null stays null, '' where nothing is left."""
    ship_package(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(weights or default_weights())
    id_type = pages.schema[id_col].dataType.simpleString()
    names = list(fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(shared.value)
        for batch in batches:
            sites = [_site(d) for d in batch.column(1).to_pylist()]
            arrays = [batch.column(0)]
            for f in range(len(names)):
                texts = batch.column(2 + f).to_pylist()
                arrays.append(pa.array([None if t is None else "\n".join(line for _, line, main in classifier.lines(t, s) if main) for t, s in zip(texts, sites, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=[id_col, *names])

    columns = [F.col(id_col), F.col(domain_col).cast("string").alias("domain"), *[F.col(c).cast("string").alias(f"__text{i}") for i, c in enumerate(fields.values())]]
    return pages.select(*columns).mapInArrow(scan, ", ".join([f"{id_col} {id_type}", *[f"{n} string" for n in names]]))
