import datetime as dt
import random

import pytest

from catalith.operators import history
from catalith.plans import found
from tests.conftest import rows

KEYS, ATTRS = ["site", "item"], ["price", "stock"]
SCHEMA = "site string, item string, at timestamp_ntz, seen timestamp_ntz, n bigint, price int, stock boolean, at_ string"


def brute(data):
    """Versions by a plain loop over each key's captures."""
    last = {}
    for site, item, at, seen, n, price, stock, _ in data:
        if at is not None:
            k = (site, item, at)
            if k not in last or (seen is not None, seen or dt.datetime.min, n) > last[k][0]:
                last[k] = ((seen is not None, seen or dt.datetime.min, n), (price, stock))
    out, lines = [], {}
    for (site, item, at), (_, values) in last.items():
        lines.setdefault((site, item), []).append((at, values))
    for key, line in lines.items():
        known, starts = None, []
        for at, values in sorted(line):
            now = tuple(v if v is not None else (known[i] if known else None) for i, v in enumerate(values))
            if known is None or now != known:
                starts.append((at, now))
            known = now
        for i, (at, now) in enumerate(starts):
            out.append((*key, at, starts[i + 1][0] if i + 1 < len(starts) else None, *now))
    return sorted(out, key=repr)


def make(seed, n, hot=0.4):
    r = random.Random(seed)
    day = dt.datetime(2024, 12, 20)
    data = []
    for i in range(n):
        key = ("hot", "x") if r.random() < hot else (r.choice(["a", "b", None]), r.choice(["1", "2", None]))
        at = None if r.random() < 0.05 else day + dt.timedelta(days=r.randrange(80), hours=r.choice([0, 5]))
        data.append((*key, at, None if r.random() < 0.05 else day + dt.timedelta(hours=i), i, r.choice([None, 1, 2]), r.choice([None, True, False]), "x"))
    return data + data[: n // 10]


def test_history_equals_a_loop(spark):
    for seed, n in ((1, 400), (2, 40)):
        data = make(seed, n)
        for hot_rows in (history.HOT_ROWS, 100, 0):
            got = history.build_history(spark.createDataFrame(data, SCHEMA), KEYS, "at", ATTRS, ["seen", "n"], hot_rows=hot_rows).drop("attr_hash")
            assert rows(got) == brute(data)


def test_empty_table_and_only_nulls(spark):
    assert rows(history.build_history(spark.createDataFrame([], SCHEMA), KEYS, "at", ATTRS, ["n"])) == []
    one = [("a", "1", dt.datetime(2024, 1, 1), None, 1, None, None, "")]
    assert rows(history.build_history(spark.createDataFrame(one, SCHEMA), KEYS, "at", ATTRS, ["n"]).drop("attr_hash")) == [("a", "1", dt.datetime(2024, 1, 1), None, None, None)]


def test_merge_of_later_batches_equals_rebuilding(spark):
    data = [d for d in make(3, 300) if d[2] is not None]
    data.sort(key=lambda d: d[2])
    cut = data[len(data) // 2][2]
    old, new = [d for d in data if d[2] < cut], [d for d in data if d[2] >= cut]
    built = history.build_history(spark.createDataFrame(old, SCHEMA), KEYS, "at", ATTRS, ["seen", "n"])
    merged = history.merge_history(built, spark.createDataFrame(new, SCHEMA), KEYS, "at", ATTRS, ["seen", "n"])
    assert rows(merged.drop("attr_hash")) == brute(data)


def test_merge_of_late_rows_and_corrections_equals_rebuilding(spark):
    day = lambda n: dt.datetime(2025, 1, n)
    old = [("a", "1", day(1), day(1), 1, 5, None, ""), ("a", "1", day(3), day(3), 2, 5, None, "")]
    old += [("b", "1", day(2), day(2), 3, 7, None, ""), ("b", "1", day(3), day(3), 4, 7, None, "")]
    old += [("c", "1", day(1), day(1), 5, 5, True, ""), ("c", "1", day(3), day(3), 6, None, False, ""), ("d", None, day(1), day(1), 7, 1, None, "")]
    new = [("a", "1", day(2), day(4), 8, 7, None, ""), ("b", "1", day(2), day(4), 9, 5, None, ""), ("c", "1", day(2), day(4), 10, 7, None, ""), ("e", None, day(9), day(9), 11, 1, None, "")]
    mixed = [d for d in make(7, 300) if d[2] is not None]
    random.Random(8).shuffle(mixed)
    for first, second in ((old, new), (mixed[:200], mixed[200:])):
        a, b = spark.createDataFrame(first, SCHEMA), spark.createDataFrame(second, SCHEMA)
        built = history.build_history(a, KEYS, "at", ATTRS, ["seen", "n"])
        merged = history.merge_history(built, b, KEYS, "at", ATTRS, ["seen", "n"], earlier=a)
        assert rows(merged.drop("attr_hash")) == brute(first + second)
    built = history.build_history(spark.createDataFrame(old, SCHEMA), KEYS, "at", ATTRS, ["seen", "n"])
    late = spark.createDataFrame(new[1:2], SCHEMA)
    for earlier in (None, spark.createDataFrame(old[:2], SCHEMA)):
        with pytest.raises(ValueError):
            history.merge_history(built, late, KEYS, "at", ATTRS, ["seen", "n"], earlier=earlier)


def test_merge_leaves_other_keys_alone(spark):
    built = history.build_history(spark.createDataFrame(make(5, 50), SCHEMA), KEYS, "at", ATTRS, ["n"])
    assert rows(history.merge_history(built, spark.createDataFrame([], SCHEMA), KEYS, "at", ATTRS, ["n"])) == rows(built)


def test_captures_of_one_month_are_spread(spark):
    data = [("hot", "x", dt.datetime(2025, 2, 1) + dt.timedelta(minutes=20 * i), None, i, i // 5, None, "") for i in range(300)]
    df = spark.createDataFrame(data, SCHEMA)
    pieces = history.latest_per_time(df, KEYS, "at", ATTRS, ["n"], "hour").groupBy("key", "piece").count()
    assert pieces.count() == 100 and pieces.agg({"count": "max"}).first()[0] == 3
    assert len(history.hot_keys(df, KEYS, 299)) == 1 and history.hot_keys(df, KEYS, 300) == []
    assert rows(history.build_history(df, KEYS, "at", ATTRS, ["n"], hot_rows=100).drop("attr_hash")) == brute(data)


def test_rows_are_read_and_shuffled_once(spark):
    df = spark.createDataFrame(make(5, 50), SCHEMA)
    plan = history.build_history(df, KEYS, "at", ATTRS, ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("- Scan") == 1


def test_what_captures_say(spark):
    data = [("d", "e", None, None, 1, p, None, r) for p, r in (("$1,234.50", 4.0), ("1.234,50 €", 5.1), ("Sold out", -1.0), ("", 0.0), (None, float("nan")), ("2999 cents", 5.0))]
    df = spark.createDataFrame(data, "domain string, external_id string, captured_at timestamp_ntz, ingested_at timestamp_ntz, snapshot_id bigint, price string, in_stock boolean, rating double")
    got = [(None if r.amount is None else float(r.amount), r.rating) for r in found.known_captures(df).collect()]
    assert got == [(1234.5, 4.0), (1234.5, None), (None, None), (None, 0.0), (None, None), (29.99, 5.0)]
