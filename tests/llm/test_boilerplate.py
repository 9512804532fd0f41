import random

from catalith.llm import boilerplate as B
from catalith.llm.labelled_lines import MAIN_TEXT, SURROUNDINGS
from tests.conftest import rows


def fill(line, r):
    words = ["Krill Oil", "Zinc", "Halvucel", "Ginkgo", "Verteuma"]
    while "<name>" in line:
        line = line.replace("<name>", r.choice(words), 1)
    while "<n>" in line:
        line = line.replace("<n>", str(r.randrange(1, 500)), 1)
    return line.replace("<site>", "greenstore")


def test_held_out_accuracy():
    lines = [(x, True) for x in MAIN_TEXT] + [(x, False) for x in SURROUNDINGS]
    r = random.Random(3)
    r.shuffle(lines)
    right = 0
    for fold in range(5):
        kept = [x for i, x in enumerate(lines) if i % 5 != fold]
        w = B.train([x for x, m in kept if m], [x for x, m in kept if not m])
        right += sum((B.line_score(fill(x, r), w, "greenstore") > 0) == m for i, (x, m) in enumerate(lines) if i % 5 == fold)
    assert right / len(lines) > 0.85


def test_scan_equals_brute_force():
    r = random.Random(1)
    for _ in range(300):
        scores, cost = [r.uniform(-3, 3) for _ in range(r.randrange(1, 9))], r.choice([0, 0.3, 2, 100])
        def value(mask):
            regions = sum(b and not a for a, b in zip([False, *mask], mask, strict=False))
            return sum(s for s, m in zip(scores, mask, strict=True) if m) - cost * max(regions - 1, 0)
        best = max(value([bool(n >> i & 1) for i in range(len(scores))]) for n in range(2 ** len(scores)))
        assert abs(value(B.best_regions(scores, cost)) - best) < 1e-9
        first, end = B.best_region(scores)
        totals = {(i, j): sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)}
        assert abs(sum(scores[first:end]) - max(totals.values())) < 1e-9
        single = B.best_regions(scores, float("inf"))
        assert abs(sum(s for s, m in zip(scores, single, strict=True) if m) - max(totals.values())) < 1e-9
        assert sum(b and not a for a, b in zip([False, *single], single, strict=False)) <= 1
    assert B.best_regions([]) == [] and B.best_region([]) == (0, 0) and B.best_regions([1, 2, -1, 5], float("inf")) == [True] * 4


def test_cost_of_regions_is_the_one_held_out_pages_choose():
    wrong = B.region_costs([0.0, B.REGION_COST, 1.0, float("inf")])
    assert min(wrong, key=wrong.get) == B.REGION_COST and wrong[B.REGION_COST] < 0.1 < wrong[float("inf")]


TEXT = "Home > Brands > Gifts\r\n\r\nVertoma Zinc brings 5 mg of Zinc in every serving of this jar.\nLoad more\nSearch for Zinc in our field notes and you will find a small valley.\nStore the box dry and below 20 degrees, away from sunlight.\n(c) 2020 greenstore. All rights reserved. Imprint - Terms - Privacy\n"


def test_lines_of_pages(spark):
    data = [(1, "www.greenstore.test", TEXT, "x"), (2, None, None, "x"), (3, "a.b", "", "x"), (4, "a.b", " \n\r\n", "x"), (5, "a.b", "n/a", "x"), (6, "a.b", "Load more", "x"), (7, "a.b", "Load more\n" * 30_000 + "Zinc 5 mg", "x")]
    df = spark.createDataFrame(data, "record_id bigint, domain string, body string, line_no string")
    got = [(a, b, c) for a, b, c, m in rows(B.classify_lines(df, "record_id", {"body": "body"})) if not m]
    assert [x for x in got if x[0] < 7] == [(1, "body", 1), (1, "body", 4), (1, "body", 7), (6, "body", 1)]
    assert len([x for x in got if x[0] == 7]) == 30_000
    texts = {r["record_id"]: r["body"] for r in B.main_texts(df, "record_id", {"body": "body"}).collect()}
    assert texts[1].count("\n") == 2 and texts[2] is None and texts[3] == "" and texts[7] == "Zinc 5 mg"
    assert rows(B.classify_lines(df.limit(0), "record_id", {"body": "body"})) == []
