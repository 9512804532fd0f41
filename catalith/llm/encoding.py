"""Encoding of a corpus with a public byte-level BPE vocabulary through a minimal acyclic transducer of frequent words."""

from __future__ import annotations

import base64
import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.runtime import share_bytes, ship_package

#: The public vocabulary, as a file of base64 tokens and ranks.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the public vocabulary's texts are cut into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same without the blanks, for counting words in the JVM.
_COUNTED = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
#: Words kept by a worker between batches; beyond, its memory is emptied and filled anew.
MEMORY_WORDS = 200_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ids of a vocabulary file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one word: the adjacent pair of least rank merges first, leftmost of equals, until none is left. O(n log n)."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or (j := after[i]) >= n or end[j] != stop:
            continue
        alive[j] = False
        end[i], after[i] = end[j], after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


class Transducer:
    """Minimal acyclic automaton of words over bytes whose paths add up to the number of the word, and the token ids of each number.

    One int64 array holds everything, so workers map it from the file without reading it in:
    [n_arcs, n_states, n_words, n_ids, arc keys (state * 256 + byte, sorted), arc targets, arc outputs, final flags, id starts, ids].
    """

    def __init__(self, data: np.ndarray) -> None:
        arcs, states, words, ids = (int(x) for x in data[:4])
        cuts = np.cumsum([4, arcs, arcs, arcs, states, words + 1, ids])
        self.keys, self.targets, self.outputs, self.final, self.starts, self.ids = (data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))

    @staticmethod
    def build(lexicon: dict[bytes, list[int]]) -> np.ndarray:
        """Compile words by sorted insertion: states left behind are shared with an equal one (same finality, arcs and targets)."""
        arcs: list[dict[int, int]] = [{}]
        final = [False]
        register: dict[tuple, int] = {}
        path: list[tuple[int, int, int]] = []

        def settle(depth: int) -> None:
            while len(path) > depth:
                parent, byte, child = path.pop()
                mark = (final[child], tuple(arcs[child].items()))
                known = register.setdefault(mark, child)
                if known != child:
                    arcs[parent][byte] = known

        words, last = sorted(lexicon), b""
        for word in words:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            settle(common)
            at = path[-1][2] if path else 0
            for byte in word[common:]:
                arcs.append({})
                final.append(False)
                arcs[at][byte] = len(arcs) - 1
                path.append((at, byte, len(arcs) - 1))
                at = len(arcs) - 1
            final[at], last = True, word
        settle(0)
        order, seen, stack = [], {0}, [(0, iter(arcs[0].values()))]
        while stack:
            state, rest = stack[-1]
            child = next((c for c in rest if c not in seen), None)
            if child is None:
                order.append(state)
                stack.pop()
            else:
                seen.add(child)
                stack.append((child, iter(arcs[child].values())))
        number, count = {s: i for i, s in enumerate(reversed(order))}, {}
        rows: list[tuple[int, int, int]] = []
        for state in order:
            total = int(final[state])
            for byte in sorted(arcs[state]):
                child = arcs[state][byte]
                rows.append((number[state] * 256 + byte, number[child], total))
                total += count[child]
            count[state] = total
        rows.sort()
        flags = np.zeros(len(order), np.int64)
        for state in order:
            flags[number[state]] = final[state]
        lengths = np.array([len(lexicon[w]) for w in words], np.int64)
        ids = np.array([i for w in words for i in lexicon[w]], np.int64)
        table = np.array(rows, np.int64).reshape(-1, 3)
        head = np.array([len(rows), len(order), len(words), len(ids)], np.int64)
        return np.concatenate([head, table[:, 0], table[:, 1], table[:, 2], flags, [0], np.cumsum(lengths), ids]).astype(np.int64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 for words not in the lexicon; all words walk the automaton together, one byte a step."""
        out = np.full(len(words), -1, np.int64)
        if not words or not len(self.keys):
            return out
        lengths = np.fromiter((len(w) for w in words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        alive = np.nonzero(lengths > 0)[0]
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        step = 0
        while len(alive):
            keys = state[alive] * 256 + flat[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            alive, at = alive[hit], at[hit]
            state[alive] = self.targets[at]
            total[alive] += self.outputs[at]
            step += 1
            done = lengths[alive] == step
            ended = alive[done]
            accepted = ended[self.final[state[ended]] == 1]
            out[accepted] = total[accepted]
            alive = alive[~done]
        return out


class Encoder:
    """Encodes texts word by word: words of the lexicon by the transducer, all others by exact merges."""

    def __init__(self, transducer: Transducer, ranks: dict[bytes, int]) -> None:
        self.transducer, self.ranks = transducer, ranks
        self.memory: dict[str, list[int]] = {}
        self.split = regex.compile(WORDS).findall

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        t = self.transducer
        for word, data, n in zip(words, raw, t.numbers(raw).tolist(), strict=True):
            self.memory[word] = t.ids[t.starts[n] : t.starts[n + 1]].tolist() if n >= 0 else merge_bytes(data, self.ranks)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Token ids of each text, without special tokens; none for null and empty texts."""
        cut = [self.split(t) if t else [] for t in texts]
        known = self.memory
        unseen = list({w for words in cut for w in words if w not in known})
        if len(known) > MEMORY_WORDS and unseen:
            known.clear()
            unseen = list({w for words in cut for w in words})
        self._learn(unseen)
        return [[i for w in words for i in known[w]] for words in cut]


def frequent_words(documents: DataFrame, text_col: str, limit: int) -> list[str]:
    """The `limit` most frequent words of the whole corpus, counted in the JVM with partial counts before the shuffle."""
    words = documents.select(F.explode(F.regexp_extract_all(text_col, F.lit(_COUNTED), F.lit(0))).alias("word"))
    top = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(limit)
    return [r["word"] for r in top.collect()]


def encode_corpus(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, lexicon_words: int = 20_000) -> DataFrame:
    """(id, ids array<int>): token ids of every document by the public vocabulary file, text taken as it is.

    Word counts of all documents give the lexicon, whose size `lexicon_words` bounds only the speed-up: words outside are merged exactly.
    The lexicon with its ids is compiled to a transducer, written once to the shared folder and memory-mapped by the workers. Documents are
    then read once in Arrow batches, without a shuffle. Null and empty texts give an empty list, repeated rows each their row.
    """
    spark = documents.sparkSession
    ship_package(spark)
    with open(vocabulary, "rb") as file:
        data = file.read()
    ranks = read_ranks(data)
    lexicon = {w.encode(): merge_bytes(w.encode(), ranks) for w in frequent_words(documents, text_col, lexicon_words)}
    buffer = io.BytesIO()
    np.save(buffer, Transducer.build(lexicon))
    name, shared = share_bytes(spark, buffer.getvalue(), "lexicon"), spark.sparkContext.broadcast(data)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Transducer(np.load(SparkFiles.get(name), mmap_mode="r")), read_ranks(shared.value))
        for batch in batches:
            ids = encoder.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    id_type = documents.schema[id_col].dataType.simpleString()
    return documents.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(encode, f"{id_col} {id_type}, ids array<int>")
