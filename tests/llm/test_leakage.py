import random

from catalith.llm import leakage as L
from tests.conftest import rows


def brute(words, items, n):
    grams = {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}
    return {k for k, ws in items if any(" ".join(ws[i : i + n]) in grams for i in range(len(ws) - n + 1))}


def test_automaton_equals_brute_force():
    r = random.Random(4)
    for _ in range(200):
        n = r.choice([1, 2, 3])
        items = [(k, [r.choice("abc") for _ in range(r.randrange(0, 9))]) for k in range(4)]
        a = L.SuffixAutomaton(items, n)
        for _ in range(5):
            words = [r.choice("abcd") for _ in range(r.randrange(0, 20))]
            found = a.leaked(words)
            assert set(found) == brute(words, items, n)
            for k, leak in found.items():
                ws = items[k][1]
                runs = [(i, m) for i in range(len(words)) for m in range(n, len(words) - i + 1) if any(ws[j : j + m] == words[i : i + m] for j in range(len(ws)))]
                assert leak.run == max(m for _, m in runs)
                assert leak.covered == len({x for i, m in runs for x in range(i, i + m)})


def test_normalisation():
    assert L.words_of("Don’t STOP—now:\n> 5.5\u00adx\u200by ＡＢ") == ["don", "t", "stop", "now", "5", "5xy", "ab"]


def test_documents(spark, sf_dir):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    w = item.split()
    texts = [item, "x " + " ".join(w[:13]).upper().replace(" ", ",\n> ") + " y", " ".join(w[:12]), None, "", " ".join(w[:7]) + " gap " + " ".join(w[7:]), "z " * 100_000 + item, "o\u200bne " + " ".join(w[1:13])]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(0, item, 1)], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(7, item), (8, "too short"), (9, None), (10, item + " more")], "item_id bigint, text string")
    want = [(d, i) for d in (0, 0, 1, 6, 7) for i in (7, 10)]
    assert rows(L.leaks(docs, items).select("doc_id", "item_id")) == sorted(want, key=repr)
    assert rows(L.leaks(docs, items.limit(0))) == [] and rows(L.leaks(docs.limit(0), items)) == []
    clean = {r["doc_id"]: r["clean_text"] for r in L.remove_leaks(docs, items).collect()}
    assert clean[1].split() == ["x", "y"] and clean[3] is None and clean[2] == texts[2]


def test_test_tables_against_grams(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/eval_item.parquet")
    listed = [(r["item_id"], L.words_of(r["text"])) for r in items.collect()]
    want = [(r["doc_id"], i) for r in docs.collect() for i in brute(L.words_of(r["text"] or ""), listed, 13)]
    assert want and rows(L.leaks(docs, items).select("doc_id", "item_id")) == sorted(want, key=repr)


def test_run_is_that_of_each_item(spark):
    w = [f"w{i}" for i in range(30)]
    items = spark.createDataFrame([(1, " ".join(w[:18])), (2, " ".join(["a", *w[:13], "b"]))], "item_id bigint, text string")
    docs = spark.createDataFrame([(0, " ".join(w))], "doc_id bigint, text string")
    assert rows(L.leaks(docs, items).select("item_id", "run", "coverage")) == [(1, 18, 1.0), (2, 13, 13 / 15)]


def test_coverage_limit(spark):
    w = [f"w{i}" for i in range(20)]
    items = spark.createDataFrame([(1, " ".join(w))], "item_id bigint, text string")
    docs = spark.createDataFrame([(0, " ".join([*w[:8], "x", *w[8:16]])), (1, " ".join(w[:8])), (2, " ".join(x for i in range(0, 16, 4) for x in [*w[i : i + 4], "x"]))], "doc_id bigint, text string")
    assert rows(L.leaks(docs, items)) == []
    assert rows(L.leaks(docs, items, coverage=0.8)) == [(0, 1, 8, 0.8)]
    clean = {r["doc_id"]: r["clean_text"] for r in L.remove_leaks(docs, items, coverage=0.8).collect()}
    assert clean[0].strip() == "x" and clean[1] == " ".join(w[:8])


def test_any_number_of_items_in_blocks(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/eval_item.parquet")
    assert len(list(L.automata(items, "item_id", "text", 13, 10_000))) > 3
    whole, parts = L.leaks(docs, items), L.leaks(docs, items, block_chars=10_000)
    assert rows(whole) == rows(parts)
    assert rows(L.remove_leaks(docs, items)) == rows(L.remove_leaks(docs, items, block_chars=10_000))
