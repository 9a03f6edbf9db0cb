from __future__ import annotations

import random

import numpy as np
import pytest

from earshot.operators.quantiles import exact_percentiles

SHARES = {"p00": 0.0, "p05": 0.05, "p50": 0.5, "p99": 0.99, "p100": 1.0}


@pytest.mark.parametrize("accuracy", [1000, 10])
def test_against_numpy(spark, accuracy):
    r = random.Random(accuracy)
    data = [(r.choice(["a", "b", None]), r.random()) for _ in range(2000)] + [("one", 5.0), ("two", 1.0), ("two", 2.0), ("none", None), ("nan", float("nan"))]
    data += [("ties", r.choice([1.0, 1.0, 1.0, 2.0, 7.0])) for _ in range(301)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {x.g: x for x in exact_percentiles(df, ["g"], "v", SHARES, accuracy).collect()}
    groups = {g for g, v in data if v is not None and v == v}
    assert set(got) == groups
    for g in groups:
        v = [x for k, x in data if k == g and x is not None and x == x]
        for name, p in SHARES.items():
            assert got[g][name] == pytest.approx(np.percentile(v, p * 100)), (g, name)


def test_no_groups_and_empty(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    assert exact_percentiles(df, [], "v", {"m": 0.5}).first().m == 50.0
    assert exact_percentiles(df.limit(0).selectExpr("v", "'x' as g"), ["g"], "v", {"m": 0.5}).count() == 0
