from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import rows

from earshot.operators import scores as sc


def scored(spark, y, s, w=None):
    data = [(i, a, float(b) if b is not None else None, float((w or [1] * len(y))[i])) for i, (a, b) in enumerate(zip(y, s))]
    return spark.createDataFrame(data, "row_id bigint, y int, score double, w double")


def one(df):
    return df.first()


def test_confusion_and_weighted(spark):
    d = scored(spark, [1, 1, 0], [0.9, 0.2, 0.9], [1, 10, 1])
    m = one(sc.binary_metrics(sc.confusion(d, 0.5, weight="w")))
    assert m.accuracy == pytest.approx(1 / 12) and m.recall == pytest.approx(1 / 11)
    d = scored(spark, [1, 1, 0, 0], [0.9, 0.1, 0.9, 0.1], [1, 3, 2, 1])
    m = one(sc.binary_metrics(sc.confusion(d, 0.5, weight="w")))
    assert (m.precision, m.recall) == (pytest.approx(1 / 3), pytest.approx(1 / 4))
    d = scored(spark, [1, 0, 1, 0, 1], [1, 1, 1, 0, 0])
    m = one(sc.binary_metrics(sc.confusion(d, 0.5)))
    assert (m.precision, m.recall, m.f1) == (pytest.approx(2 / 3),) * 3


def test_empty_and_zero_denominators(spark):
    empty = scored(spark, [], [])
    assert tuple(one(sc.confusion(empty, 0.5))) == (0, 0, 0, 0)
    m = one(sc.binary_metrics(sc.confusion(empty, 0.5)))
    assert m.accuracy == 0.0 and m.mcc == 0.0
    assert math.isnan(one(sc.binary_metrics(sc.confusion(empty, 0.5), zero=math.nan)).precision)
    assert one(sc.roc_auc(empty)).roc_auc == 0.5
    assert one(sc.average_precision(empty)).average_precision is None
    assert one(sc.average_viable_recall(sc.sweep(empty, sc.linspace(5)), 1.0, 2.0)).average_viable_recall == 0.0


def test_mcc(spark):
    counts = spark.createDataFrame([(10, 0, 10, 0), (5, 5, 5, 5)], "tp bigint, fp bigint, tn bigint, fn bigint")
    assert [r.mcc for r in sc.binary_metrics(counts).collect()] == [1.0, 0.0]


def test_multi_threshold(spark):
    d = scored(spark, [1, 1, 0, 0, 1, 0], [0.9, 0.7, 0.4, 0.2, 0.6, 0.8])
    assert tuple(one(sc.sweep(d, [0.5], strict=False)))[2:] == (3, 1, 2, 0)
    a, b = scored(spark, [1, 0, 1], [0.8, 0.3, 0.9]), scored(spark, [0, 1, 0], [0.6, 0.4, 0.2])
    assert tuple(one(sc.sweep(a.union(b), [0.5], strict=False)))[2:] == (2, 1, 2, 1)
    d = scored(spark, [1, 0, 1, 0], [0.9, 1.0, 0.5, 1.0])
    low, high = sc.sweep(d, [0.0, 1.0], strict=False).orderBy("k").collect()
    assert tuple(low)[2:] == (2, 2, 0, 0) and tuple(high)[2:] == (0, 2, 0, 2)


def test_sweep_is_the_plain_loop(spark):
    r = random.Random(3)
    y = [r.randint(0, 1) for _ in range(300)]
    s = [r.choice([0.0, 0.1, 0.25, 0.5, 0.999, 1.0, r.random()]) for _ in y]
    grid = sc.linspace(21)
    for strict in (True, False):
        got = [tuple(x)[2:] for x in sc.sweep(scored(spark, y, s), grid, strict=strict).orderBy("k").collect()]
        for t, g in zip(grid, got):
            hit = [(v > t) if strict else (v >= t) for v in s]
            assert g == (sum(h and a for h, a in zip(hit, y)), sum(h and not a for h, a in zip(hit, y)), sum(not h and not a for h, a in zip(hit, y)), sum(not h and a for h, a in zip(hit, y)))


def test_nulls_in_scores_and_labels(spark):
    d = scored(spark, [1, None, 0, 1], [None, 0.9, 0.9, float("nan")])
    assert tuple(one(sc.sweep(d, [0.5])))[2:] == (0, 1, 0, 2)


def test_operating_points(spark):
    d = scored(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])
    best = one(sc.recall_at_no_false_alarm(sc.sweep(d, [0.1, 0.2, 0.8, 0.9])))
    assert (best.threshold, best.recall) == (0.2, 1.0)
    d = scored(spark, [1, 1, 1, 0, 0, 0], [0.9, 0.8, 0.7, 0.6, 0.4, 0.2])
    best = one(sc.recall_at_target_fah(sc.sweep(d, sc.linspace(6)), 1.0, 1.0))
    assert best.recall == 1.0 and best.threshold == pytest.approx(0.6) and best.fah == 0
    best = one(sc.fah_at_target_recall(sc.sweep(d, sc.linspace(6)), 1.0, 0.66))
    assert best.threshold == pytest.approx(0.6) and best.fah <= 1 and best.recall >= 0.66
    d = scored(spark, [1, 1, 0, 0], [0.95, 0.55, 0.85, 0.65])
    best = one(sc.recall_at_target_fah(sc.sweep(d, sc.linspace(11)), 1.0, 1.0))
    assert (best.recall, best.fah) == (0.5, 0.0) and best.threshold == pytest.approx(0.9)
    none = one(sc.recall_at_target_fah(sc.sweep(d, [0.1, 0.2]), 1.0, 0.5))
    assert (none.threshold, none.recall, none.fah) == (0.2, 0.0, math.inf)
    none = one(sc.fah_at_target_recall(sc.sweep(d, [0.9, 0.97]), 1.0, 0.9))
    assert (none.threshold, none.recall, none.fah) == (0.97, 0.0, math.inf)


def test_false_alarms_per_hour(spark):
    d = scored(spark, [0, 0, 0, 0, 1, 1], [0.9, 0.8, 0.3, 0.2, 0.9, 0.8])
    assert one(sc.rates(sc.sweep(d, [0.5], strict=False), 1.0)).fah == 2.0
    assert one(sc.rates(sc.sweep(d, [0.5]), 0.0)).fah == math.inf
    with pytest.raises(ValueError):
        sc.rates(sc.sweep(d, [0.5]), -1.0)


def test_auc_against_all_pairs(spark):
    r = random.Random(5)
    y = [r.randint(0, 1) for _ in range(200)]
    s = [round(r.random(), 1) for _ in y]
    pos, neg = [v for v, a in zip(s, y) if a], [v for v, a in zip(s, y) if not a]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert one(sc.roc_auc(scored(spark, y, s))).roc_auc == pytest.approx(want)
    assert one(sc.roc_auc(scored(spark, [1, 1], [0.1, 0.2]))).roc_auc == 0.5


def test_running_totals_against_cumsum(spark):
    r = np.random.default_rng(1)
    v = r.permutation(500) / 7.0
    n = r.integers(0, 9, 500)
    d = spark.createDataFrame(list(zip(v.tolist(), n.tolist())), "x double, n bigint")
    got = {a.x: a.n_before for a in sc.running_totals(d, "x", ["n"], buckets=16).collect()}
    order = np.argsort(v)
    before = np.cumsum(n[order]) - n[order]
    assert all(got[v[i]] == b for i, b in zip(order, before))


def test_calibration(spark):
    d = scored(spark, [1, 0, 1, 0], [0.5] * 4)
    c = one(sc.calibration_curve(d, 1))
    assert (c["count"], c.observed) == (4, 0.5)
    edge = sc.calibration_curve(scored(spark, [1, 1, 0], [0.1, 0.0, 1.0]), 10).orderBy("bin").collect()
    assert edge[0]["count"] == 2 and edge[9]["count"] == 1 and edge[5].mean_score == 0.0
    for y, s in (([2], [0.5]), ([1], [1.5])):
        with pytest.raises(ValueError):
            sc.calibration_curve(scored(spark, y, s))
    assert [one(sc.brier(scored(spark, [1, 0], s))).brier for s in ([1, 0], [0, 1], [0.5, 0.5])] == [0, 1, 0.25]
    assert one(sc.expected_calibration_error(scored(spark, [], []))).ece == 0.0


def test_decimate_and_grid(spark):
    d = spark.range(1000).selectExpr("cast(id as double) t")
    got = sorted(r.t for r in sc.decimate(d, "t", 10).collect())
    assert got == [float(int(i * 999 / 9)) for i in range(10)]
    g = [r.threshold for r in sc.adaptive_grid(scored(spark, [1], [0.5])).orderBy("k").collect()]
    assert g[0] == 0.0 and g[-1] == 1.0 and 0.5 in g and len(g) == 5


def test_bootstrap_covers_the_point(spark):
    r = random.Random(2)
    y = [r.randint(0, 1) for _ in range(400)]
    s = [0.3 * a + 0.7 * r.random() for a in y]
    point = one(sc.binary_metrics(sc.confusion(scored(spark, y, s), 0.5))).recall
    b = {x.metric: x for x in sc.bootstrap(scored(spark, y, s), 60, 0.5).collect()}
    assert b["recall"].low <= point <= b["recall"].high and rows(sc.bootstrap(scored(spark, y, s), 60, 0.5)) == rows(sc.bootstrap(scored(spark, y, s), 60, 0.5))


def test_temperature_of_saturated_scores(spark):
    """The fit of the reference on all rows, most of which are within 2.4e-4 of 0 or 1."""
    from earshot.plans.stream_queries import fit_temperature

    r = np.random.default_rng(3)
    z = r.choice([-1, 1], 600) * r.uniform(4, 18, 600)
    p = 1 / (1 + np.exp(-z))
    y = (r.random(600) < 1 / (1 + np.exp(-z / 3.3))).astype(int)
    logit = lambda q: np.log(np.clip(q, 1e-7, 1 - 1e-7) / (1 - np.clip(q, 1e-7, 1 - 1e-7)))
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def nll(t):
        s = np.clip(sigmoid(logit(p) / t), 1e-7, 1 - 1e-7)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    def ece(q):
        edges = np.linspace(0, 1, 16)
        bins = [(q >= edges[i]) & ((q < edges[i + 1]) | (i == 14)) for i in range(15)]
        return sum(abs(q[b].sum() - y[b].sum()) for b in bins) / len(q)

    lo, hi = 0.1, 10.0
    for _ in range(8):
        grid = np.linspace(lo, hi, 201)
        at = int(np.argmin([nll(t) for t in grid]))
        lo, hi = grid[max(0, at - 1)], grid[min(200, at + 1)]
    best = grid[at]
    df = spark.createDataFrame([*zip(p.tolist(), y.tolist()), (None, 1)], "score double, y int")
    (got,) = fit_temperature(df).collect()
    assert got.temperature == pytest.approx(best, rel=1e-5) and got.nll == pytest.approx(nll(best), rel=1e-9)
    assert got.accepted == (ece(sigmoid(logit(p) / best)) < ece(p))
    (none,) = fit_temperature(df.limit(0)).collect()
    assert none.nll == 0 and not none.accepted
