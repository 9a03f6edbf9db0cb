from __future__ import annotations

import random

import pytest
from conftest import rows
from hypothesis import given, settings, strategies as hs
from pyspark.sql import functions as F

from earshot.llm.grouping import allocate, assign_splits, crossing_groups, difference, resolved_speaker, with_component


@settings(max_examples=50, deadline=None)
@given(hs.lists(hs.integers(1, 50), min_size=1, max_size=60), hs.integers(2, 8))
def test_differencing_keeps_all_and_balances(weights, n):
    parts = [[(w, [i])] + [(0, [])] * (n - 1) for i, w in enumerate(weights)]
    bins = difference(parts)
    assert sorted(i for _, m in bins for i in m) == list(range(len(weights))) and all(w == sum(weights[i] for i in m) for w, m in bins)
    assert max(w for w, _ in bins) - min(w for w, _ in bins) <= max(weights)


def test_differencing_of_nothing():
    assert difference([]) == [] and allocate([], {"a": 1.0}) == {}


def data(spark, n=4000):
    r = random.Random(1)
    ids = ["big"] * 400 + [f"s{int(r.paretovariate(0.8)) % 300}" for _ in range(n - 700)] + [None] * 300
    return spark.createDataFrame(list(enumerate(ids)), "row_id bigint, g string")


def test_shares_and_groups(spark):
    targets = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1), (None, 0.5)], "split string, share double")
    out = assign_splits(data(spark), targets, group="g", row_id="row_id", bins=50, per_block=80)
    assert out.count() == 4000 and out.where("assigned is null").count() == 0
    assert out.where("g is not null").groupBy("g").agg(F.count_distinct("assigned").alias("n")).where("n > 1").count() == 0
    share = {r.assigned: r.n / 4000 for r in out.groupBy("assigned").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert share == {"train": pytest.approx(0.8, abs=0.02), "validation": pytest.approx(0.1, abs=0.02), "test": pytest.approx(0.1, abs=0.02)}
    again = assign_splits(data(spark), targets, group="g", row_id="row_id", bins=50, per_block=80)
    assert rows(out) == rows(again)


def test_a_million_groups_in_two_thousand_blocks(spark):
    targets = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split string, share double")
    # One group of a third of the rows, some of about a bin, and small ones.
    g = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 30 == 1, F.col("id") % 7 + 1).otherwise(F.col("id") + 10)
    data = spark.range(1_700_000).select(F.col("id").alias("row_id"), g.cast("string").alias("g"))
    out = assign_splits(data, targets, group="g", row_id="row_id", bins=400, per_block=550)
    share = {r.assigned: r.n / 1_700_000 for r in out.groupBy("assigned").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert share == {"train": pytest.approx(0.8, abs=0.001), "validation": pytest.approx(0.1, abs=0.001), "test": pytest.approx(0.1, abs=0.001)}
    assert out.groupBy("g").agg(F.min("assigned").alias("a"), F.max("assigned").alias("b")).where("a <> b").count() == 0


def test_bad_targets_empty_and_clashing(spark):
    t = spark.createDataFrame([("train", 1.0)], "split string, share double")
    assert assign_splits(data(spark).limit(0), t, group="g", row_id="row_id").count() == 0
    extra = data(spark, 800).withColumn("w", F.lit(1)).withColumn("block", F.lit(2)).withColumn("bin", F.lit(3)).withColumn("_group", F.lit("x"))
    out = assign_splits(extra, t, group="g", row_id="row_id", bins=10, per_block=20)
    assert out.count() == 800 and set(out.columns) == {"row_id", "g", "w", "block", "bin", "_group", "assigned"}
    for bad in ([("a", -1.0)], [("a", 0.0)], []):
        with pytest.raises(ValueError):
            assign_splits(data(spark), spark.createDataFrame(bad, "split string, share double"), group="g", row_id="row_id")


def test_components_and_crossing(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "c"), (None, "a")], "a string, b string")
    d = spark.createDataFrame([(1, "a", "train"), (2, "c", "test"), (3, "d", "train"), (4, "d", None), (5, None, "test")], "i int, s string, split string")
    g = with_component(d, "s", links, "a", "b")
    assert rows(g.select("i", "group")) == [(1, "a"), (2, "a"), (3, "d"), (4, "d"), (5, None)]
    assert rows(crossing_groups(g, "group", "split")) == [("a",)]


def test_resolution_order(spark):
    d = spark.createDataFrame([(1, "k", "f", "p1"), (2, None, "f", "p1"), (3, None, None, "p1"), (4, None, None, "p2"), (5, None, None, None)], "i int, known string, fold string, file string")
    m = spark.createDataFrame([("p1", "m2"), ("p1", "m1"), (None, "x"), ("p2", None)], "p string, s string")
    out = resolved_speaker(d, F.col("known"), F.col("fold"), F.col("file"), m, F.col("p"), F.col("s"))
    assert rows(out.select("i", "speaker")) == [(1, "k"), (2, "f"), (3, "m1"), (4, None), (5, None)]
