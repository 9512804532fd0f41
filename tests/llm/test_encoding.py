import random

import pytest
import tiktoken

from catalith.llm import encoding as E


@pytest.fixture(scope="module")
def ranks():
    with open(E.VOCABULARY, "rb") as file:
        return E.read_ranks(file.read())


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("reference", pat_str=E.WORDS, mergeable_ranks=ranks, special_tokens={})


def test_merges_equal_the_library(ranks, reference):
    r = random.Random(5)
    alphabet = "abcdehilnorstuz ABCéñß中文😀\u200d\n\t'’12345.,;-_#@\xa0"
    for n in [1, 2, 3, 5, 8, 13, 40, 300]:
        for _ in range(40):
            word = "".join(r.choice(alphabet) for _ in range(n))
            whole = tiktoken.Encoding("whole", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
            assert E.merge_bytes(word.encode(), ranks) == whole.encode_ordinary(word)
    assert E.merge_bytes(b"a" * 20_000, ranks) == tiktoken.Encoding("whole", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary("a" * 20_000)


def test_transducer_holds_exactly_its_words(ranks):
    r = random.Random(2)
    words = {"".join(r.choice("abc é") for _ in range(r.randrange(1, 7))).encode() for _ in range(500)}
    t = E.Transducer(E.Transducer.build({w: E.merge_bytes(w, ranks) for w in words}))
    ordered = sorted(words)
    assert t.numbers(ordered).tolist() == list(range(len(ordered)))
    others = [w + b"x" for w in ordered] + [b"", b"q", ordered[0][:-1] + b"\xff"]
    assert set(t.numbers(others).tolist()) == {-1}
    assert len(t.final) < sum(map(len, words))
    for w in ordered:
        n = t.numbers([w])[0]
        assert t.ids[t.starts[n] : t.starts[n + 1]].tolist() == E.merge_bytes(w, ranks)
    empty = E.Transducer(E.Transducer.build({}))
    assert empty.numbers([b"a"]).tolist() == [-1]


def test_corpus(spark, sf_dir, reference):
    odd = [None, "", " ", "<|endoftext|> is text", "x" * 100_000, "naïve 中文 😀\u200b\x00", "a\r\n\n  b", "don't they're"]
    data = [(i, t, "x") for i, t in enumerate(odd)] + [(0, None, "x"), (1, "", "x")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, ids string")
    for size in (0, 3, 1000):
        got = sorted((r["doc_id"], list(r["ids"])) for r in E.encode_corpus(df, lexicon_words=size).collect())
        assert got == sorted((i, reference.encode_ordinary(t) if t else []) for i, t, _ in data)
    assert E.encode_corpus(df.limit(0)).collect() == []
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for r in E.encode_corpus(documents).join(documents, "doc_id").collect():
        assert list(r["ids"]) == (reference.encode_ordinary(r["text"]) if r["text"] else [])
