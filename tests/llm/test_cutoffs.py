from __future__ import annotations

import random

import pytest
from conftest import rows

from earshot.llm import cutoffs as co


def brute(data, targets):
    out = []
    for s, pct in targets.items():
        v = sorted((x[2] for x in data if x[1] == s and not x[3] and x[2] is not None and x[2] == x[2] and 0 <= x[2] <= 1), reverse=True)
        for c in sorted(set(v), reverse=True):
            kept = sum(x >= c for x in v)
            if kept * 100 >= pct * len(v):
                out.append((s, pct, len(v), c, kept))
                break
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def frame(spark, data):
    return spark.createDataFrame(data, "i bigint, s string, v double, d boolean")


ARGS = {"source": "s", "value": "v", "keep": ["i"], "dropped": "d"}


@pytest.mark.parametrize("accuracy", [2000, 20])
def test_against_sorting(spark, accuracy):
    r = random.Random(accuracy)
    targets = {"alpha": 90, "beta": 50, "gamma": 0, "delta": 100, "ties": 60, "nobody": 10}
    value = {"ties": lambda: r.choice([0.2, 0.5, 0.5, 0.8])}
    data = [(i, s, value.get(s, r.random)(), r.choice([False, None, True, False])) for i, s in enumerate(r.choices(["alpha", "beta", "gamma", "delta", "ties"], k=3000))]
    data += [(9000 + i, "alpha", v, False) for i, v in enumerate([None, float("nan"), -1.0, 1.01, 0.0, 1.0])] + [(9100, None, 0.5, False), (9101, "", 0.5, False)]
    t = spark.createDataFrame([*targets.items(), (None, 5), ("alpha", 95)], "n string, p int")
    found = co.source_cutoffs(frame(spark, data), t, accuracy=accuracy, **ARGS)
    want = brute(data, targets)
    assert rows(found.table) == want
    cut = {w[0]: w[3] for w in want}
    below = sorted(x[0] for x in data if x[1] in cut and not x[3] and x[2] is not None and x[2] == x[2] and 0 <= x[2] < cut[x[1]] and x[2] <= 1)
    assert sorted(r.i for r in co.below_cutoff(found).collect()) == below


def test_a_missed_bracket_is_widened(spark, monkeypatch):
    data = [(i, "alpha", i / 1000, False) for i in range(1000)]
    real = co._brackets
    tried = []

    def wrong(left, wanted, around, accuracy):
        tried.append(around)
        return {s: (n, 0.0, 0.0001) for s, (n, _, _) in real(left, wanted, around, accuracy).items()} if len(tried) == 1 else real(left, wanted, around, accuracy)

    monkeypatch.setattr(co, "_brackets", wrong)
    t = spark.createDataFrame([("alpha", 30)], "n string, p int")
    assert rows(co.source_cutoffs(frame(spark, data), t, **ARGS).table) == brute(data, {"alpha": 30}) and len(tried) == 2


def test_empty_and_bad(spark):
    t = spark.createDataFrame([("alpha", 30)], "n string, p int")
    found = co.source_cutoffs(frame(spark, []), t, **ARGS)
    assert found.table.count() == 0 and co.below_cutoff(found).count() == 0
    found = co.source_cutoffs(frame(spark, [(1, "alpha", 0.5, False)]), t.limit(0), **ARGS)
    assert found.table.count() == 0 and co.below_cutoff(found).count() == 0
    with pytest.raises(ValueError):
        co.source_cutoffs(frame(spark, []), spark.createDataFrame([("a", 101)], "n string, p int"), **ARGS)
    with pytest.raises(ValueError):
        co.source_cutoffs(frame(spark, []), spark.createDataFrame([("a", 1), ("b", 1)], "n string, p int"), most_targets=1, **ARGS)


def test_brackets_are_parted_until_few_values_are_left(spark):
    r = random.Random(6)
    data = [("kitchen_far" if r.random() < 0.7 else "car", r.random() if r.random() < 0.8 else round(r.random(), 1)) for _ in range(6000)]
    scores = spark.createDataFrame(data, "s string, v double")
    for pct in (1, 37, 50, 99, 100):
        targets = spark.createDataFrame([("kitchen_far", pct), ("car", 100 - pct)], "n string, p int")
        whole = co.source_cutoffs(scores, targets, source="s", value="v", keep=[]).table
        parted = co.source_cutoffs(scores, targets, source="s", value="v", keep=[], accuracy=20, most_sorted=3).table
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parted.collect())) and whole.count() == 2
