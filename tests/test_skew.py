from __future__ import annotations

import random

from conftest import rows

from earshot.operators.skew import Agg, heavy_keys, keys_above, salted_aggregate

AGGS = [Agg("n", "count"), Agg("total", "sum", "v"), Agg("low", "min", "v"), Agg("high", "max", "v"), Agg("mean", "avg", "v"), Agg("kinds", "distinct", "c"), Agg("best", "top", "v", 3)]


def brute(data):
    out = []
    for k in {d[1] for d in data}:
        part = [d for d in data if d[1] == k]
        v = [d[2] for d in part if d[2] is not None]
        out.append((k, len(part), sum(v) if v else None, min(v, default=None), max(v, default=None), sum(v) / len(v) if v else None, len({d[3] for d in part if d[3] is not None}), sorted(v, reverse=True)[:3]))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_salted_aggregate_is_plain_aggregation(spark):
    r = random.Random(1)
    data = [(i, r.choice(["hot"] * 20 + ["a", "b", None]), r.choice([None, 1, 2, 2, 9, r.randint(0, 99)]), r.choice([None, "x", "y", "z", str(r.randint(0, 50))])) for i in range(3000)]
    data += [data[0]] * 3 + [(5000 + i, "void", None, None) for i in range(4)]
    df = spark.createDataFrame(data, "id bigint, k string, v bigint, c string")
    for heavy in (None, [], ["hot", None]):
        assert rows(salted_aggregate(df, "k", AGGS, salt_by=["id"], heavy=heavy)) == brute(data)


def test_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "a", 2, 3, 4)], "id bigint, k string, _salt int, _n int, n int")
    assert rows(salted_aggregate(df, "k", [Agg("n", "count"), Agg("m", "sum", "n")], salt_by=["id"])) == [("a", 1, 4)]
    assert salted_aggregate(df.limit(0), "k", AGGS[:1], salt_by=["id"]).count() == 0
    assert heavy_keys(df.limit(0), "k", 0.1) == [] and keys_above(df.limit(0), "k", 50, salt_by=["id"]).count() == 0


def test_keys_above_counts_null_rows(spark):
    df = spark.createDataFrame([(i, "a" if i < 2 else "b" if i < 3 else None) for i in range(100)], "id bigint, k string")
    assert rows(keys_above(df, "k", 50, salt_by=["id"])) == [("a", 2)]


def test_heavy_rows_are_spread(spark):
    df = spark.range(10_000).selectExpr("id", "'hot' as k")
    plan = salted_aggregate(df, "k", [Agg("n", "count")], salt_by=["id"])
    assert plan.first().n == 10_000 and heavy_keys(df, "k", 0.01) == ["hot"]


def test_no_heavy_key_is_missed(spark):
    r = random.Random(2)
    data = [(i, None if i % 10 == 0 else "hot" if i % 3 == 0 else f"k{r.randint(0, 90)}" if i % 2 else f"rare{i}") for i in range(40_000)]
    df = spark.createDataFrame(data, "id bigint, k string").repartition(7)
    counts = {k: sum(d[1] == k for d in data) for k in {d[1] for d in data if not (d[1] or "").startswith("rare")}}
    for share in (0.3, 0.05, 0.002):
        found = heavy_keys(df, "k", share)
        assert {k for k, n in counts.items() if n >= 40_000 * share} <= set(found) and all(counts.get(k, 1) >= 40_000 * share * 0.8 for k in found)
