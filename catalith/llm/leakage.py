"""Evaluation texts leaking into training text: a generalised suffix automaton of the items, streamed over the corpus."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.runtime import ship_package

#: Characters of items one automaton is built from; more items are split into several, each streamed over the corpus.
BLOCK_CHARS = 1_000_000
#: Least words in a row that count towards the coverage of an item, where a coverage limit is given.
COVERAGE_RUN = 5

_DROP = re.compile(r"[\xad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff\ufff9-\ufffb\x00-\x08\x0e-\x1f\x7f]")
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters and digits, compatibility forms unified, case folded, marks kept with their letters, invisible characters dropped."""
    plain = text if text.isascii() else unicodedata.normalize("NFKC", _DROP.sub("", text))
    return _WORD.findall((_DROP.sub("", plain) if plain.isascii() else plain).casefold())


@dataclass
class Leak:
    """What a text shares with one item: its longest run of words, and the stretches of the text's words (first, last) that lie in such runs."""

    run: int
    spans: list[tuple[int, int]]

    @property
    def covered(self) -> int:
        return sum(last - first + 1 for first, last in self.spans)


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences; each state of at least `length` words knows the items its words occur in."""

    def __init__(self, items: list[tuple[int, list[str]]], length: int) -> None:
        self.length = length
        self.next: list[dict[str, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[set[int]] = [set()]
        for item, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word, ends)
                ends[last].add(item)
        for state in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            if self.link[state] > 0:
                ends[self.link[state]] |= ends[state]
        self.items = [tuple(sorted(e)) if n >= length else () for e, n in zip(ends, self.len, strict=True)]
        self.sizes = {item: len(words) for item, words in items}
        self.known = frozenset(w for _, ws in items for w in ws)

    def _state(self, length: int, ends: list[set[int]]) -> int:
        self.next.append({})
        self.link.append(0)
        self.len.append(length)
        ends.append(set())
        return len(self.len) - 1

    def _extend(self, last: int, word: str, ends: list[set[int]]) -> int:
        at = self.next[last].get(word)
        if at is not None and self.len[at] == self.len[last] + 1:
            return at
        if at is not None:
            return self._split(last, at, word, ends)
        new = self._state(self.len[last] + 1, ends)
        p = last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][word]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, word, ends)
        return new

    def _split(self, p: int, q: int, word: str, ends: list[set[int]]) -> int:
        clone = self._state(self.len[p] + 1, ends)
        self.next[clone] = dict(self.next[q])
        self.link[clone] = self.link[q]
        ends[clone] = set()
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def leaked(self, words: list[str]) -> dict[int, Leak]:
        """Items of which at least `length` words in a row occur in a text, each with its own longest run and the words it covers.

        Up to each word the longest match in any item is known; the items of its state share all of it, those of the states its suffix links lead to share as many words as these have."""
        found: dict[int, Leak] = {}
        state = matched = 0
        for i, word in enumerate(words):
            if word not in self.known:
                state = matched = 0
                continue
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.len[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            else:
                state = matched = 0
            at, run = state, matched
            while run >= self.length:
                for item in self.items[at]:
                    leak = found.get(item)
                    if leak is None:
                        found[item] = Leak(run, [(i - run + 1, i)])
                    elif leak.spans[-1][1] < i:
                        leak.run = max(leak.run, run)
                        first = i - run + 1
                        while leak.spans and leak.spans[-1][1] >= first - 1:
                            first = min(first, leak.spans.pop()[0])
                        leak.spans.append((first, i))
                at = self.link[at]
                run = self.len[at]
        return found

    def leaks(self, words: list[str], length: int, coverage: float | None) -> dict[int, Leak]:
        """Those of `leaked` with a run of at least `length` words, or, where a coverage limit is given, whose runs cover that share of the item's words."""
        found = self.leaked(words)
        return {i: leak for i, leak in found.items() if leak.run >= length or (coverage is not None and leak.covered >= coverage * self.sizes[i])}


def automata(items: DataFrame, item_col: str, text_col: str, length: int, block_chars: int = BLOCK_CHARS) -> Iterator[SuffixAutomaton]:
    """Automata that together hold all items: one for a set of up to `block_chars` characters, else one per block of items by the hash of their id.
    The driver holds one block at a time; null texts hold nothing."""
    rows = items.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).filter(F.col("t").isNotNull())
    chars = rows.agg(F.sum(F.length("t").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    for n in range(blocks):
        block = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == n)
        yield SuffixAutomaton(sorted((r["i"], words_of(r["t"])) for r in block.toLocalIterator()), length)


def leaks(documents: DataFrame, items: DataFrame, length: int = 13, coverage: float | None = None, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, run, coverage): each document holding at least `length` words in a row of an item, with the longest run it shares with that
    item and the share of the item's words its runs cover (above 1 where passages are repeated).

    With a `coverage` limit runs of COVERAGE_RUN words or more count too, and an item also leaks into a document where they cover that share of
    it. The automaton of all items is built on the driver and broadcast (of large sets one per block, so any number of items is handled);
    documents are streamed through it in Arrow batches and never shuffled. Null and empty texts, and items of fewer words, leak nothing;
    repeated rows each give their rows.
    """
    spark = documents.sparkSession
    ship_package(spark)
    id_type, item_type = documents.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    texts = documents.select(F.col(id_col), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())

    def stream(automaton: SuffixAutomaton) -> DataFrame:
        shared = spark.sparkContext.broadcast(automaton)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = shared.value
            for batch in batches:
                ids, found, runs, shares = [], [], [], []
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    for item, leak in automaton.leaks(words_of(text), length, coverage).items():
                        ids.append(key)
                        found.append(item)
                        runs.append(leak.run)
                        shares.append(leak.covered / automaton.sizes[item])
                first = batch.schema.field(0).type
                items_ = pa.array(found) if ids else pa.array([], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ids, first), items_, pa.array(runs, pa.int32()), pa.array(shares, pa.float64())], names=[id_col, item_col, "run", "coverage"])

        return texts.mapInArrow(scan, f"{id_col} {id_type}, {item_col} {item_type}, run int, coverage double")

    least = length if coverage is None else min(length, COVERAGE_RUN)
    return reduce(DataFrame.unionByName, [stream(a) for a in automata(items, item_col, item_text_col, least, block_chars)])


def remove_leaks(documents: DataFrame, items: DataFrame, length: int = 13, coverage: float | None = None, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, clean_text, removed_words, words): texts without the spans of leaked words (see `leaks`) and what stands between them; null texts stay null.

    Of large sets of items the automata are run one after another over each text, whose words are marked by all before it is cut."""
    spark = documents.sparkSession
    ship_package(spark)
    least = length if coverage is None else min(length, COVERAGE_RUN)
    shared = [spark.sparkContext.broadcast(a) for a in automata(items, item_col, item_text_col, least, block_chars)]
    id_type = documents.schema[id_col].dataType.simpleString()

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            pieces = [[(m.start(), m.end(), w) for m in re.finditer(r"\S+", t) for w in words_of(m.group())] if t is not None else [] for t in texts]
            gone = [[False] * len(p) for p in pieces]
            for automaton in shared:
                for p, g in zip(pieces, gone, strict=True):
                    for leak in automaton.value.leaks([w for _, _, w in p], length, coverage).values():
                        for first, last in leak.spans:
                            g[first : last + 1] = [True] * (last - first + 1)
            out: list[list] = [[], [], [], []]
            for key, text, p, g in zip(keys, texts, pieces, gone, strict=True):
                row: tuple = (key, None, 0, 0)
                if text is not None:
                    clean, at, open_ = [], 0, False
                    for (start, stop, _), lost in zip(p, g, strict=True):
                        if lost and not open_:
                            clean.append(text[at : max(at, start)])
                        if lost:
                            at = stop
                        open_ = lost
                    row = (key, "".join(clean) + text[at:], sum(g), len(p))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = [batch.schema.field(0).type, pa.string(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=[id_col, "clean_text", "removed_words", "words"])

    return documents.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(strip, f"{id_col} {id_type}, clean_text string, removed_words int, words int")
