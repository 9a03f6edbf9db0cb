"""Queries of the ordered operators: each user's events are a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from earshot.operators import ordered as od
from earshot.plans.registry import Registry
from earshot.plans.score_queries import S, r6, stream
from earshot.sources.tables import table

REGISTRY = Registry()

_ORDER = ["ts", "row_id"]
_O = "PARTITION BY clip ORDER BY ts, row_id"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return stream(spark, folder).select("row_id", "clip", "ts", "y", "raw", "score", "w")


def _numbered(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).withColumn("i", F.row_number().over(Window.partitionBy("clip").orderBy(*_ORDER)) - 1)


_N = f"n AS (SELECT *, row_number() OVER ({_O}) - 1 AS i FROM s)"


@REGISTRY.add("WN1_sliding_detection", f"WITH {S} SELECT row_id, CASE WHEN sum(score) OVER ({_O} ROWS 4 PRECEDING) > 0.5 * count(*) OVER ({_O} ROWS 4 PRECEDING) THEN 1 ELSE 0 END AS detected FROM s")
def sliding(spark, folder):
    return od.sliding_detection(_events(spark, folder), ["clip"], _ORDER, threshold=0.5, window=5).select("row_id", "detected")


_ISLANDS = f"i1 AS (SELECT *, CASE WHEN lag(raw) OVER ({_O}) IS DISTINCT FROM raw AND row_number() OVER ({_O}) > 1 THEN 1 ELSE 0 END AS ch FROM s), i2 AS (SELECT *, sum(ch) OVER ({_O} ROWS UNBOUNDED PRECEDING) AS island FROM i1)"


@REGISTRY.add("WN2_sliding_detection_clip_reset", f"WITH {S}, {_ISLANDS} SELECT row_id, CASE WHEN sum(score) OVER (PARTITION BY clip, island ORDER BY ts, row_id ROWS 4 PRECEDING) > 0.5 * count(*) OVER (PARTITION BY clip, island ORDER BY ts, row_id ROWS 4 PRECEDING) THEN 1 ELSE 0 END AS detected FROM i2")
def sliding_reset(spark, folder):
    return od.sliding_detection(_events(spark, folder), ["clip"], _ORDER, threshold=0.5, window=5, clip="raw").select("row_id", "detected")


@REGISTRY.add("WN3_full_moving_average", f"WITH {S}, a AS (SELECT row_id, avg(score) OVER ({_O} ROWS 4 PRECEDING) AS average, count(*) OVER ({_O} ROWS 4 PRECEDING) AS c FROM s) SELECT row_id, round(average, 6) AS average FROM a WHERE c = 5")
def full_average(spark, folder):
    return r6(od.moving_average(_events(spark, folder), ["clip"], _ORDER, window=5).select("row_id", "average"))


@REGISTRY.add("WN4_max_moving_average", f"WITH {S}, {_N}, a AS (SELECT clip, avg(score) OVER ({_O} ROWS 4 PRECEDING) AS average, count(*) OVER ({_O} ROWS 4 PRECEDING) AS c FROM n WHERE i >= 10) SELECT clip, round(max(average), 6) AS max_average FROM a WHERE c = 5 GROUP BY clip")
def max_average(spark, folder):
    return r6(od.max_moving_average(_events(spark, folder), ["clip"], _ORDER, window=5, skip=10))


@REGISTRY.add("WN5_refractory_counter", f"""WITH RECURSIVE {S}, {_N}, c AS (SELECT k::INT AS k, 0.1::DOUBLE + k * 0.2::DOUBLE AS cutoff FROM range(5) r(k)),
f AS (SELECT clip, k, cutoff, 0 AS nxt, 10 AS wait, 0 AS hit FROM (SELECT DISTINCT clip FROM s) CROSS JOIN c
  UNION ALL SELECT f.clip, f.k, f.cutoff, f.nxt + 1, CASE WHEN greatest(f.wait - 1, 0) = 0 AND n.score > f.cutoff THEN 10 ELSE greatest(f.wait - 1, 0) END, CASE WHEN greatest(f.wait - 1, 0) = 0 AND n.score > f.cutoff THEN 1 ELSE 0 END
  FROM f JOIN n ON n.clip = f.clip AND n.i = f.nxt)
SELECT k, cutoff, sum(hit)::BIGINT AS accepts, (SELECT count(*) FROM s) AS n_rows, sum(hit) / ((SELECT count(*) FROM s) * 0.01::DOUBLE) AS per_hour FROM f GROUP BY k, cutoff""")
def refractory(spark, folder):
    step = 0.2
    return od.cooldown_counts(_events(spark, folder), ["clip"], _ORDER, cutoffs=[0.1 + k * step for k in range(5)], ignore=10, hours_per_row=0.01)


@REGISTRY.add("WN6_rising_edges", f"""WITH RECURSIVE {S}, {_N}, e AS (SELECT clip, i, score, coalesce(lag(score) OVER ({_O}), 0) AS p FROM n), g AS (SELECT clip, i FROM e WHERE p <= 0.5 AND score > 0.5),
f AS (SELECT clip, min(i) AS i FROM g GROUP BY clip UNION ALL SELECT f.clip, (SELECT min(g.i) FROM g WHERE g.clip = f.clip AND g.i - f.i > 5) FROM f WHERE f.i IS NOT NULL) SELECT clip, i::BIGINT AS i FROM f WHERE i IS NOT NULL""")
def rising(spark, folder):
    rows = _events(spark, folder)
    m = od.RisingEdge(0.5, 5, rows.columns.index("score"))
    return od.fold(rows, ["clip"], _ORDER, m.start, m.step, "i bigint")


@REGISTRY.add("WN7_overlapping_frames", "SELECT vec_id, f::INT AS frame, round(list_sum(x), 4) AS total, len(x)::INT AS size FROM (SELECT vec_id, f, list_transform(range(f * 10 + 1, f * 10 + 26), lambda i: coalesce(list_extract(embedding, i), 0)) AS x FROM embeddings, range(5) r(f))")
def frame_slices(spark, folder):
    e = table(spark, folder, "embeddings").select("vec_id", F.posexplode(od.frames(F.col("embedding"), 25, 10)).alias("frame", "x"))
    return e.select("vec_id", "frame", F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 4).alias("total"), F.size("x").alias("size"))


@REGISTRY.add("WN8_tumbling_chunks", "SELECT vec_id, c::INT AS chunk, round(list_sum(list_slice(embedding, c * 10 + 1, c * 10 + 10)), 4) AS total FROM embeddings, range(6) r(c)")
def tumbling(spark, folder):
    e = table(spark, folder, "embeddings").select("vec_id", F.posexplode(od.chunks(F.col("embedding"), 10)).alias("chunk", "x"))
    return e.select("vec_id", "chunk", F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 4).alias("total"))


@REGISTRY.add("WN9_warm_up_slides", "SELECT vec_id, v::INT AS view, round(list_sum(list_slice(embedding, v + 1, v + 61)), 4) AS total FROM embeddings, range(4) r(v)")
def slides(spark, folder):
    """Four overlapping views of length n - 3."""
    e = table(spark, folder, "embeddings")
    views = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice("embedding", i + 1, F.size("embedding") - 3))
    return e.select("vec_id", F.posexplode(views).alias("view", "x")).select("vec_id", "view", F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 4).alias("total"))


@REGISTRY.add("WN10_fixed_duration_chunks", "SELECT vec_id, c::INT AS chunk, least(15, 64 - c * 15)::INT AS size FROM embeddings, range(5) r(c) WHERE 64 - c * 15 >= 3")
def fixed_chunks(spark, folder):
    e = table(spark, folder, "embeddings").select("vec_id", F.posexplode(od.chunks(F.col("embedding"), 15, keep_rest=True, least=3)).alias("chunk", "x"))
    return e.select("vec_id", "chunk", F.size("x").alias("size"))


@REGISTRY.add("WN11_speech_bounds", f"WITH {S}, {_N} SELECT clip, CASE WHEN bool_or(score > 0.9) THEN greatest(min(i) FILTER (score > 0.9) - 3, min(i)) END AS first, CASE WHEN bool_or(score > 0.9) THEN least(max(i) FILTER (score > 0.9) + 3, max(i)) END AS last FROM n GROUP BY clip")
def bounds(spark, folder):
    n = _numbered(spark, folder).withColumn("speech", F.col("score") > 0.9).withColumn("i", F.col("i").cast("bigint"))
    return od.speech_bounds(n, ["clip"], "i", "speech", 3)


@REGISTRY.add("WN12_ema_alerts", f"""WITH RECURSIVE {S}, {_N}, f AS (SELECT clip, i, score, score AS base, score AS next FROM n WHERE i = 0
  UNION ALL SELECT n.clip, n.i, n.score, f.next, 0.1::DOUBLE * n.score + (1 - 0.1::DOUBLE) * f.next FROM f JOIN n ON n.clip = f.clip AND n.i = f.i + 1)
SELECT clip, i::BIGINT AS i, score AS value, round(base, 6) AS baseline, i > 0 AND base > 0 AND score / base > 2.0 AS alert FROM f""")
def ema(spark, folder):
    rows = _events(spark, folder)
    m = od.EmaAlert(rows.columns.index("score"))
    return r6(od.fold(rows, ["clip"], _ORDER, m.start, m.step, "i bigint, value double, baseline double, alert boolean"))


@REGISTRY.add("WN13_trend_alerts", f"WITH {S}, t AS (SELECT row_id, avg(w * score) OVER ({_O} ROWS 9 PRECEDING) AS recent, avg(w * score) OVER ({_O} ROWS BETWEEN 19 PRECEDING AND 10 PRECEDING) AS older, count(*) OVER ({_O} ROWS 19 PRECEDING) AS c FROM s) SELECT row_id, round(recent, 6) AS recent, round(older, 6) AS older FROM t WHERE c = 20 AND recent > 1.2 * older")
def trend(spark, folder):
    w = Window.partitionBy("clip").orderBy(*_ORDER)
    v = F.col("w") * F.col("score")
    t = _events(spark, folder).select("row_id", F.avg(v).over(w.rowsBetween(-9, 0)).alias("recent"), F.avg(v).over(w.rowsBetween(-19, -10)).alias("older"), F.count(F.lit(1)).over(w.rowsBetween(-19, 0)).alias("c"))
    return r6(t.where((F.col("c") == 20) & (F.col("recent") > 1.2 * F.col("older"))).select("row_id", "recent", "older"))


@REGISTRY.add("WN14_alert_cooldown", f"""WITH RECURSIVE {S}, a AS (SELECT clip, floor(epoch(ts))::BIGINT AS t0, CASE WHEN score > 0.8 THEN 'high' ELSE 'raised' END AS message, row_number() OVER ({_O}) AS i FROM s WHERE score > 0.6),
f AS (SELECT clip, t0, message, i, t0 AS last_at, message AS last, true AS sent FROM a WHERE i = 1
  UNION ALL SELECT a.clip, a.t0, a.message, a.i, CASE WHEN a.message <> f.last OR a.t0 - f.last_at >= 86400 THEN a.t0 ELSE f.last_at END, CASE WHEN a.message <> f.last OR a.t0 - f.last_at >= 86400 THEN a.message ELSE f.last END,
    a.message <> f.last OR a.t0 - f.last_at >= 86400 FROM f JOIN a ON a.clip = f.clip AND a.i = f.i + 1) SELECT clip, t0 AS "at", message FROM f WHERE sent""")
def alert_cooldown(spark, folder):
    rows = _events(spark, folder).where("score > 0.6").select("clip", "ts", "row_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"), F.when(F.col("score") > 0.8, "high").otherwise("raised").alias("message"))
    m = od.AlertCooldown(rows.columns.index("message"), rows.columns.index("at"), 86400)
    return od.fold(rows, ["clip"], _ORDER, m.start, m.step, "at bigint, message string")


@REGISTRY.add("WN15_rolling_history", f"WITH {S}, h AS (SELECT row_id, clip, row_number() OVER (PARTITION BY clip ORDER BY ts DESC, row_id DESC) AS r FROM s) SELECT row_id, clip FROM h WHERE r <= 10")
def history(spark, folder):
    w = Window.partitionBy("clip").orderBy(F.desc("ts"), F.desc("row_id"))
    return _events(spark, folder).withColumn("r", F.row_number().over(w)).where("r <= 10").select("row_id", "clip")


@REGISTRY.add("WN16_phase_lookup", f"""WITH {S}, p(phase, steps, lr) AS (VALUES (0, 20, 0.001), (1, 30, 0.0001), (2, 1000000, 0.00001)), c AS (SELECT phase, lr, sum(steps) OVER (ORDER BY phase) - steps AS lo, sum(steps) OVER (ORDER BY phase) AS hi FROM p), {_N}
SELECT row_id, phase, lr::DOUBLE AS lr, round((i - lo) / (hi - lo)::DOUBLE, 6) AS progress FROM n JOIN c ON i >= lo AND i < hi""")
def phases(spark, folder):
    steps = [(0, 20, 0.001), (1, 30, 0.0001), (2, 1_000_000, 0.00001)]
    bounds, lo = [], 0
    for phase, n, lr in steps:
        bounds.append((phase, lr, lo, lo + n))
        lo += n
    c = spark.createDataFrame(bounds, "phase int, lr double, lo bigint, hi bigint")
    return r6(_numbered(spark, folder).join(F.broadcast(c), (F.col("i") >= F.col("lo")) & (F.col("i") < F.col("hi"))).select("row_id", "phase", "lr", ((F.col("i") - F.col("lo")) / (F.col("hi") - F.col("lo"))).alias("progress")), 6).withColumn("lr", F.when(F.col("phase") == 2, F.lit(0.00001)).otherwise(F.col("lr")))


@REGISTRY.add("WN17_plateau_machine", f"""WITH RECURSIVE {S}, {_N}, f AS (SELECT clip, -1::BIGINT AS i, 0 AS run, 0 AS reduced, 'none' AS action, false AS stopped FROM n WHERE i = 0
  UNION ALL SELECT clip, i, CASE WHEN NOT stopped AND next >= 3 AND reduced < 2 THEN 0 ELSE next END, CASE WHEN NOT stopped AND next >= 3 AND reduced < 2 THEN reduced + 1 ELSE reduced END,
    CASE WHEN stopped OR next < 3 THEN 'none' WHEN reduced < 2 THEN 'reduce' ELSE 'stop' END, stopped OR (next >= 3 AND reduced = 2)
    FROM (SELECT n.clip, n.i, CASE WHEN f.stopped THEN f.run WHEN n.score < 0.5 THEN f.run + 1 ELSE 0 END AS next, f.reduced, f.stopped FROM f JOIN n ON n.clip = f.clip AND n.i = f.i + 1))
SELECT clip, i, run, action, pow(0.5, reduced) AS factor FROM f WHERE i >= 0""")
def plateau(spark, folder):
    rows = _events(spark, folder).withColumn("flat", F.col("score") < 0.5)
    m = od.Plateau(rows.columns.index("flat"), 3, 2, 0.5)
    return od.fold(rows, ["clip"], _ORDER, m.start, m.step, "i bigint, run int, action string, factor double")


_BESTS = f"""b AS (SELECT *, max(CASE WHEN w * 10 <= 11.0 THEN 1 ELSE 0 END) OVER ({_O} ROWS UNBOUNDED PRECEDING) AS open FROM n),
v AS (SELECT *, CASE WHEN open = 0 THEN score WHEN w * 10 <= 11.0 THEN 1 + score END AS key FROM b), k AS (SELECT *, max(key) OVER ({_O} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM v)"""


@REGISTRY.add("WN18_running_best_two_stage", f"WITH {S}, {_N}, {_BESTS} SELECT row_id FROM k WHERE key IS NOT NULL AND (prev IS NULL OR key > prev)")
def running_best(spark, folder):
    """Until a row meets the bound the best score counts, afterwards the best among rows that meet it."""
    w = Window.partitionBy("clip").orderBy(*_ORDER)
    ok = F.col("w") * 10 <= 11.0
    b = _events(spark, folder).withColumn("open", F.max(ok.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    k = b.withColumn("key", F.when(F.col("open") == 0, F.col("score")).when(ok, 1 + F.col("score"))).withColumn("prev", F.max("key").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return k.where(F.col("key").isNotNull() & (F.col("prev").isNull() | (F.col("key") > F.col("prev")))).select("row_id")


@REGISTRY.add("WN19_fixed_batches", f"WITH {S}, {_N} SELECT clip, (i // 16)::BIGINT AS batch, count(*) AS n, bool_or(raw = 2) AS has_hard FROM n GROUP BY 1, 2")
def batches(spark, folder):
    return _numbered(spark, folder).groupBy("clip", F.floor(F.col("i") / 16).alias("batch")).agg(F.count(F.lit(1)).alias("n"), F.max(F.col("raw") == 2).alias("has_hard"))


@REGISTRY.add("WN20_silence_compaction", """WITH f AS (SELECT vec_id, c, list_slice(embedding, 8 + c * 8 + 1, 8 + c * 8 + 8) AS x FROM embeddings, range(7) r(c)), k AS (SELECT vec_id, c, x FROM f WHERE list_sum(list_transform(x, lambda v: abs(v))) > 0.8)
SELECT e.vec_id, (8 + 8 * coalesce(n, 0))::INT AS size FROM embeddings e LEFT JOIN (SELECT vec_id, count(*) AS n FROM k GROUP BY vec_id) q USING (vec_id)""")
def compaction(spark, folder):
    """The first 8 values and then only the frames of 8 that are loud enough; a shorter tail is dropped."""
    loud = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + F.abs(v)) > 0.8
    e = table(spark, folder, "embeddings")
    kept = F.concat(F.slice("embedding", 1, 8), F.flatten(F.filter(od.chunks(F.slice(F.col("embedding"), F.lit(9), F.size("embedding")), 8), loud)))
    return e.select("vec_id", F.size(kept).alias("size"))


@REGISTRY.add("WN21_best_so_far_patience", f"""WITH {S}, {_N}, m AS (SELECT *, max(score) OVER ({_O} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM n), b AS (SELECT *, max(CASE WHEN prev IS NULL OR score > prev THEN i END) OVER ({_O} ROWS UNBOUNDED PRECEDING) AS t0 FROM m)
SELECT clip, min(i) FILTER (i - t0 >= 10) AS stop, max(score) FILTER (i <= coalesce(st, i)) AS best FROM (SELECT *, min(CASE WHEN i - t0 >= 10 THEN i END) OVER (PARTITION BY clip) AS st FROM b) GROUP BY clip""")
def patience(spark, folder):
    w = Window.partitionBy("clip").orderBy("i")
    m = _numbered(spark, folder).withColumn("i", F.col("i").cast("bigint")).withColumn("prev", F.max("score").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    b = m.withColumn("at", F.max(F.when(F.col("prev").isNull() | (F.col("score") > F.col("prev")), F.col("i"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    st = b.withColumn("st", F.min(F.when(F.col("i") - F.col("at") >= 10, F.col("i"))).over(Window.partitionBy("clip")))
    return st.groupBy("clip").agg(F.min("st").alias("stop"), F.max(F.when(F.col("i") <= F.coalesce("st", "i"), F.col("score"))).alias("best"))


@REGISTRY.add("WN22_clip_ids", f"WITH {S}, {_ISLANDS} SELECT row_id, clip, island::BIGINT AS clip_id FROM i2")
def clip_ids(spark, folder):
    return od.islands(_events(spark, folder), ["clip"], _ORDER, "raw", name="clip_id").select("row_id", "clip", "clip_id")
