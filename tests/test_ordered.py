from __future__ import annotations

import random

import numpy as np
from conftest import rows
from pyspark.sql import Window, functions as F

from earshot.operators import ordered as od
from earshot.streaming import folds as st


def streams(spark, n=120, seed=1):
    r = random.Random(seed)
    data = [(k, i, r.random(), r.choice("ab")) for k in ("x", "y") for i in range(n)]
    return spark.createDataFrame(data, "k string, i int, score double, clip string"), data


def test_sliding_detection_with_and_without_reset(spark):
    df, data = streams(spark)
    for clip in (None, "clip"):
        got = {(r.k, r.i): r.detected for r in od.sliding_detection(df, ["k"], ["i"], threshold=0.5, window=4, clip=clip).collect()}
        for key in "xy":
            held, last = [], None
            for _, i, s, c in [d for d in data if d[0] == key]:
                if clip and c != last:
                    held = []
                last = c
                held = (held + [s])[-4:]
                assert got[key, i] == int(sum(held) > 0.5 * len(held))
    assert od.sliding_detection(df, ["k"], ["i"], threshold=0.5, window=1).where("detected != cast(score > 0.5 as int)").count() == 0


def cooldown(scores, cutoffs, ignore):
    hits = [0] * len(cutoffs)
    wait = [ignore] * len(cutoffs)
    for p in scores:
        for j, c in enumerate(cutoffs):
            wait[j] = max(0, wait[j] - 1)
            if wait[j] == 0 and p > c:
                hits[j] += 1
                wait[j] = ignore
    return hits


def test_cooldown_counts(spark):
    df, data = streams(spark)
    got = [r.accepts for r in od.cooldown_counts(df, ["k"], ["i"], cutoffs=[0.1, 0.5, 0.9], ignore=5).orderBy("k").collect()]
    want = np.sum([cooldown([d[2] for d in data if d[0] == k], [0.1, 0.5, 0.9], 5) for k in "xy"], axis=0)
    assert got == want.tolist()


def test_folds_on_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, i int, score double")
    m = od.EmaAlert(2)
    assert od.fold(df, ["k"], ["i"], m.start, m.step, "i bigint, v double, base double, alert boolean").count() == 0
    assert od.cooldown_counts(df, ["k"], ["i"], cutoffs=[0.5], ignore=2).count() == 0


def test_ema_uses_the_old_baseline(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([100.0, 100.0, 250.0, 100.0])], "k string, i int, v double")
    m = od.EmaAlert(2)
    got = sorted(tuple(r)[1:] for r in od.fold(df, ["k"], ["i"], m.start, m.step, "at bigint, v double, base double, alert boolean").collect())
    assert [g[3] for g in got] == [False, False, True, False] and got[3][2] == 115.0


def test_alert_cooldown_and_plateau(spark):
    df = spark.createDataFrame([("a", t, m) for t, m in [(0, "x"), (10, "x"), (20, "y"), (320, "y"), (321, "y")]], "k string, t bigint, m string")
    m = od.AlertCooldown(2, 1, 300)
    assert [(r.t2, r.m2) for r in od.fold(df, ["k"], ["t"], m.start, m.step, "t2 bigint, m2 string").orderBy("t2").collect()] == [(0, "x"), (20, "y"), (320, "y")]
    p = od.Plateau(1, 2, 1, 0.5)
    state, out = p.start(), []
    for flat in [1, 1, 0, 1, 1, 1]:
        state, made = p.step(state, (0, bool(flat)))
        out += [x[2] for x in made]
    assert out == ["none", "reduce", "none", "none", "stop", "none"]


def test_moving_average_and_frames(spark):
    df, data = streams(spark, 12)
    got = {(r.k, r.i): r.average for r in od.moving_average(df, ["k"], ["i"], window=3, skip=2).collect()}
    assert len(got) == 2 * 8 and abs(got["x", 4] - sum(d[2] for d in data[2:5]) / 3) < 1e-12
    a = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0],), ([1.0],), ([],)], "a array<float>")
    f = [r.f for r in a.select(od.frames(F.col("a"), 3, 2).alias("f")).collect()]
    assert f[0] == [[1, 2, 3], [3, 4, 5]] and f[1] == [[1, 0, 0]] and f[2] == [[0, 0, 0]]
    c = [r.c for r in a.select(od.chunks(F.col("a"), 2, keep_rest=True).alias("c")).collect()]
    assert c == [[[1, 2], [3, 4], [5]], [[1]], []]


def test_stream_is_batch(spark, tmp_path):
    df, _ = streams(spark, 40)
    for part in range(3):
        df.where(f"i % 3 = {part}" if part == 9 else f"i >= {part * 14} and i < {part * 14 + 14}").coalesce(1).write.parquet(f"{tmp_path}/in/{part}")
    read = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    m = st.RingBuffer(4, 2, 1)
    got = st.run_to_table(st.fold_stream(read, ["k"], ["i"], m, "at int, b array<double>"), f"{tmp_path}/out")
    batch = df.select("k", F.col("i").alias("at"), st.ring_buffer(F.col("score"), 4, Window.partitionBy("k").orderBy("i")).alias("b"))
    assert rows(got) == rows(batch)


def test_windowed_counts_close_by_watermark(spark, tmp_path):
    spark.range(100).selectExpr("timestamp_seconds(id * 60) as at", "id % 2 as k").write.parquet(f"{tmp_path}/in")
    read = spark.readStream.schema("at timestamp, k bigint").parquet(f"{tmp_path}/in")
    got = st.run_to_table(st.windowed_counts(read, "at", "k", width="10 minutes", late="5 minutes"), f"{tmp_path}/out")
    assert got.where("n != 5").count() == 0
