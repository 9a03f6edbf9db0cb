"""Queries of streaming operators, splits, samples, audio sources and stores."""

from __future__ import annotations

import uuid
import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from earshot.config import resolved_path, section, with_environment
from earshot.functions import arrays as ar
from earshot.functions.scalars import finite, spoken_text
from earshot.functions.similar_text import jaro_winkler
from earshot.functions.snr import STATISTIC, snr
from earshot.operators import ordered as od, scores as sc, splitting as sp
from earshot.plans.aggregate_queries import P, R, predictions, records
from earshot.plans.filter_queries import TEXTS_SQL, draw_sql
from earshot.plans.registry import Registry
from earshot.plans.score_queries import HOURS, S, grid_sql, r6, stream
from earshot.session import cut, workspace
from earshot.sources import audio, store
from earshot.sources.reports import markdown
from earshot.sources.tables import table
from earshot.streaming import folds as st

REGISTRY = Registry()

_O = "PARTITION BY clip ORDER BY ts, row_id"


def _by_clip():
    return Window.partitionBy("clip").orderBy("ts", "row_id")


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{workspace(spark)}/earshot-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _score_files(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream of files, scored."""
    events = spark.readStream.schema(table(spark, folder, "events").schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    error = F.col("event_type") == "error"
    return events.select(F.col("event_id").alias("row_id"), F.col("user_id").alias("clip"), F.col("ts").cast("timestamp").alias("ts"), F.when(error, 1).otherwise(0).alias("y"), (((F.col("event_id") * 37) % 700 + F.when(error, 300).otherwise(0)) / F.lit(1000.0)).alias("score"))


@REGISTRY.add("ST1_ring_buffer", f"WITH {S} SELECT row_id, round(coalesce(sum(score) OVER ({_O} ROWS 3 PRECEDING), 0), 6) AS total, round(CASE WHEN row_number() OVER ({_O}) >= 4 THEN lag(score, 3) OVER ({_O}) ELSE 0 END, 6) AS oldest FROM s")
def st1(spark, folder):
    b = stream(spark, folder).select("row_id", st.ring_buffer(F.col("score"), 4, _by_clip()).alias("b"))
    return r6(b.select("row_id", ar.total(F.col("b")).alias("total"), F.element_at("b", 1).alias("oldest")))


@REGISTRY.add("ST1_ring_buffer_stream", f"WITH {S} SELECT row_id, round(coalesce(sum(score) OVER ({_O} ROWS 3 PRECEDING), 0), 6) AS total FROM s")
def st1_stream(spark, folder):
    """The same on a stream, with the state kept by key."""
    return r6(_ring_stream(spark, folder))


def _ring_stream(spark, folder):
    rows = _score_files(spark, folder)
    m = st.RingBuffer(4, rows.columns.index("score"), rows.columns.index("row_id"))
    out = st.run_to_table(st.fold_stream(rows, ["clip"], ["ts", "row_id"], m, "row_id bigint, b array<double>"), _fresh(spark, "ring"))
    return out.select("row_id", ar.total(F.col("b")).alias("total"))


@REGISTRY.add("ST2_strided_state", f"WITH {S}, n AS (SELECT *, row_number() OVER ({_O}) AS i, sum(score) OVER ({_O} ROWS 4 PRECEDING) AS t FROM s) SELECT row_id, round(t, 6) AS total FROM n WHERE i % 3 = 0")
def st2(spark, folder):
    rows = stream(spark, folder).select("row_id", "clip", "ts", "score")
    m = st.StridedBuffer(5, 3, 0, 3)
    return r6(od.fold(rows, ["clip"], ["ts", "row_id"], m.start, m.step, "row_id bigint, b array<double>").select("row_id", ar.total(F.col("b")).alias("total")))


@REGISTRY.add("ST3_external_state", f"WITH {S} SELECT row_id, round(sum(score) OVER ({_O} ROWS UNBOUNDED PRECEDING), 6) AS state_out, round(coalesce(sum(score) OVER ({_O} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS state_in FROM s")
def st3(spark, folder):
    return r6(stream(spark, folder).select("row_id", F.sum("score").over(_by_clip().rowsBetween(Window.unboundedPreceding, 0)).alias("state_out"), F.coalesce(F.sum("score").over(_by_clip().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("state_in")))


@REGISTRY.add("ST4_causal_padding", "SELECT vec_id, 67 AS size, round(list_sum(list_slice(embedding, 1, 61)), 4) AS head FROM embeddings")
def st4(spark, folder):
    a = st.causal_pad(F.transform("embedding", lambda v: v.cast("double")), 3)
    return table(spark, folder, "embeddings").select("vec_id", F.size(a).alias("size"), F.round(ar.total(F.slice(a, 1, 64)), 4).alias("head"))


@REGISTRY.add("ST5_drop_keep_last", "SELECT vec_id, round(list_sum(list_slice(embedding, 1, 60)), 4) AS dropped, round(list_sum(embedding), 4) AS kept, 70 AS size FROM embeddings")
def st5(spark, folder):
    e = F.transform("embedding", lambda v: v.cast("double"))
    return table(spark, folder, "embeddings").select("vec_id", F.round(ar.total(st.drop_last(e, 4)), 4).alias("dropped"), F.round(ar.total(st.keep_last(e, 70)), 4).alias("kept"), F.size(st.keep_last(e, 70)).alias("size"))


@REGISTRY.add("ST6_reset_per_clip", f"WITH {S} SELECT clip, count(*) AS n, round(sum(score), 5) AS total FROM s GROUP BY clip")
def st6(spark, folder):
    rows = _score_files(spark, folder)
    m = st.Delay(0, rows.columns.index("score"), rows.columns.index("row_id"))
    out = st.run_to_table(st.fold_stream(rows, ["clip"], ["ts", "row_id"], m, "row_id bigint, v double"), _fresh(spark, "reset"))
    return out.groupBy("clip").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 5).alias("total"))


@REGISTRY.add("ST8_clipwise_detections", f"""WITH RECURSIVE {S}, n AS (SELECT clip, row_id, row_number() OVER ({_O}) AS i, list(score) OVER ({_O} ROWS 4 PRECEDING) AS held FROM s), m AS (SELECT *, list_sum(held) / 5 AS average FROM n),
f AS (SELECT clip, i, row_id, average, 9 AS wait, false AS hit FROM m WHERE i = 1
  UNION ALL SELECT clip, i, row_id, average, CASE WHEN hit THEN 10 ELSE wait END, hit FROM (SELECT m.clip, m.i, m.row_id, m.average, greatest(0, f.wait - 1) AS wait, m.i >= 5 AND f.wait <= 1 AND m.average > 0.5 AS hit FROM f JOIN m ON m.clip = f.clip AND m.i = f.i + 1))
SELECT clip, row_id, round(average, 6) AS average FROM f WHERE hit""")
def st8(spark, folder):
    """Accepts of a stream of scores: moving average over 5 rows, cooldown of 10."""
    rows = _score_files(spark, folder)
    m = st.DetectionEvents(5, 0.5, 10, rows.columns.index("score"), rows.columns.index("row_id"))
    return r6(st.run_to_table(st.fold_stream(rows, ["clip"], ["ts", "row_id"], m, "row_id bigint, average double"), _fresh(spark, "detections")))


@REGISTRY.add("ST9_background_miner", f"WITH {S} SELECT row_id, score FROM s WHERE y = 0 ORDER BY score DESC, row_id LIMIT 25")
def st9(spark, folder):
    path = _fresh(spark, "miner")
    miner = st.BackgroundMiner(f"{path}/top", 25)
    q = _score_files(spark, folder).writeStream.foreachBatch(miner).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return miner.result(spark)


@REGISTRY.add("ST10_delay_line", f"WITH {S} SELECT row_id, coalesce(lag(score, 3) OVER ({_O}), 0) AS delayed FROM s")
def st10(spark, folder):
    return stream(spark, folder).select("row_id", F.lag("score", 3, 0.0).over(_by_clip()).alias("delayed"))


@REGISTRY.add("ST11_multi_scale_windows", f"WITH {S} SELECT row_id, round(avg(score) OVER ({_O} ROWS 2 PRECEDING), 6) AS short, round(avg(w) OVER ({_O} ROWS 6 PRECEDING), 6) AS middle, round(max(score) OVER ({_O} ROWS 14 PRECEDING), 6) AS long FROM s")
def st11(spark, folder):
    return r6(stream(spark, folder).select("row_id", F.avg("score").over(_by_clip().rowsBetween(-2, 0)).alias("short"), F.avg("w").over(_by_clip().rowsBetween(-6, 0)).alias("middle"), F.max("score").over(_by_clip().rowsBetween(-14, 0)).alias("long")))


@REGISTRY.add("ST12_batch_stream_gap", f"""WITH {S}, n AS (SELECT row_number() OVER ({_O}) AS i, sum(score) OVER ({_O} ROWS 3 PRECEDING) - CASE WHEN row_number() OVER ({_O}) > 1 THEN (score + coalesce(lag(score, 1) OVER ({_O}), 0) + coalesce(lag(score, 2) OVER ({_O}), 0) + coalesce(lag(score, 3) OVER ({_O}), 0)) / 1.25 ELSE score END AS gap FROM s)
SELECT count(*) AS n, round(avg(abs(gap)), 6) AS mean_gap, round(max(abs(gap)), 6) AS max_gap, round(median(abs(gap)), 6) AS median_gap, round(stddev_pop(gap), 6) AS std_gap, max(abs(gap)) < 0.01 AS passes FROM n""")
def st12(spark, folder):
    """The gap between totals over the last four scores in batch and by a stream whose later rows are scaled down by 1.25: a known difference, which the statistics must show."""
    i = F.row_number().over(_by_clip())
    batch = stream(spark, folder).select("row_id", st.ring_buffer(F.col("score"), 4, _by_clip()).alias("b"), F.when(i > 1, 1.25).otherwise(1.0).alias("scale"))
    batch = batch.select("row_id", ar.total(F.col("b")).alias("total"), "scale")
    j = batch.join(_ring_stream(spark, folder).withColumnRenamed("total", "t2"), "row_id")
    return r6(st.gap_statistics(j.select("total", (F.col("t2") / F.col("scale")).alias("t2")), "total", "t2", 0.01))


@REGISTRY.add("ST7_streaming_gate", "SELECT unnest(['boundary', 'deterministic', 'state_changes']) AS gate, true AS passes")
def st7(spark, folder):
    """Three gates of a stream operator: two runs agree, equal inputs give other outputs once the state differs, and a clip's first rows know nothing of the clip before."""
    first, second = _ring_stream(spark, folder), _ring_stream(spark, folder).withColumnRenamed("total", "t2")
    rows = stream(spark, folder).select("row_id", "score", F.row_number().over(_by_clip()).alias("i"))
    both = rows.join(first, "row_id").join(second, "row_id", "left")
    changed = both.groupBy("score").agg(F.count_distinct("total").alias("n"), F.count(F.lit(1)).alias("m")).where("m > 1")
    same = both.agg(F.coalesce(F.bool_and(F.col("total") == F.col("t2")), F.lit(True)).alias("passes"))
    apart = both.where("i = 1").agg(F.coalesce(F.bool_and(F.abs(F.col("total") - F.col("score")) < 1e-9), F.lit(True)).alias("passes"))
    return same.select(F.lit("deterministic").alias("gate"), "passes").unionByName(changed.agg((F.max("n") > 1).alias("passes")).select(F.lit("state_changes").alias("gate"), "passes")).unionByName(apart.select(F.lit("boundary").alias("gate"), "passes"))


# ---- splits and samples

@REGISTRY.add("SP1_group_split", """WITH g AS (SELECT DISTINCT 'g' || c_nationkey AS k, md5('g' || c_nationkey || ':42') AS h FROM customer), r AS (SELECT *, row_number() OVER (ORDER BY h, k) - 1 AS i, count(*) OVER () AS n FROM g)
SELECT c_custkey, CASE WHEN i < floor(n * 0.8::DOUBLE) THEN 'train' WHEN i < floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS assigned FROM customer JOIN r ON r.k = 'g' || c_nationkey""")
def sp1(spark, folder):
    c = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return sp.group_split(c, "c_nationkey", "c_custkey", 0.8, 0.1).select("c_custkey", "assigned")


@REGISTRY.add("SP2_two_step_split", """WITH g AS (SELECT c_custkey, 'r' || c_custkey AS k, md5('r' || c_custkey || ':7') AS h FROM customer), r AS (SELECT *, row_number() OVER (ORDER BY h, k) - 1 AS i, count(*) OVER () AS n FROM g)
SELECT c_custkey, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train' WHEN i < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS assigned FROM r""")
def sp2(spark, folder):
    c = table(spark, folder, "customer").select("c_custkey", F.lit(None).cast("string").alias("g"))
    return sp.group_split(c, "g", "c_custkey", 0.7, 0.15, seed=7).select("c_custkey", "assigned")


_FIVE = "unnest([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20]) AS bin, unnest(['calibration', 'calibration', 'representative', 'confirm', 'confirm', 'confirm', 'train', 'train', 'train', 'train', 'train', 'train', 'train', 'train', 'train', 'train', 'eval', 'eval', 'eval', 'eval']) AS part"


@REGISTRY.add("SP3_five_way_partition", f"""WITH RECURSIVE g AS (SELECT user_id, 'g' || user_id AS k, count(*) AS n FROM events GROUP BY 1), b AS (SELECT *, CASE WHEN n * 20000 >= (SELECT count(*) FROM events) THEN k ELSE 'b' || ({draw_sql('k')} % 20000) END AS bundle FROM g),
o AS (SELECT bundle, sum(n)::BIGINT AS n, row_number() OVER (ORDER BY sum(n) DESC, bundle) AS i FROM b GROUP BY bundle), f AS (SELECT 0::BIGINT AS i, ''::VARCHAR AS bundle, 0 AS bin, list_transform(range(20), lambda x: 0::BIGINT) AS fill
  UNION ALL SELECT i, bundle, spot, list_transform(fill, lambda x, j: CASE WHEN j = spot THEN x + n ELSE x END) FROM (SELECT o.i, o.bundle, o.n, f.fill, list_position(f.fill, list_min(f.fill)) AS spot FROM f JOIN o ON o.i = f.i + 1)), p AS (SELECT {_FIVE})
SELECT event_id, user_id, part FROM events JOIN b USING (user_id) JOIN f ON f.bundle = b.bundle JOIN p ON p.bin = f.bin""")
def sp3(spark, folder):
    return sp.five_way(table(spark, folder, "events").select("event_id", "user_id"), "user_id").select("event_id", "user_id", "part")


@REGISTRY.add("SP4_weighted_sampling", f"""WITH o AS (SELECT n_nationkey, n_nationkey % 5 + 1 AS w, {draw_sql('n_nationkey', '42')} AS h FROM nation), c AS (SELECT n_nationkey, (sum(w) OVER (ORDER BY h) - w) / (sum(w) OVER ())::DOUBLE AS lo, sum(w) OVER (ORDER BY h) / (sum(w) OVER ())::DOUBLE AS hi FROM o)
SELECT draw, n_nationkey FROM (SELECT range AS draw, {draw_sql('range', '42')} / 4503599627370496.0 AS u FROM range(1000)) JOIN c ON u >= lo AND u < hi""")
def sp4(spark, folder):
    return sp.weighted_draws(table(spark, folder, "nation").select("n_nationkey", (F.col("n_nationkey") % 5 + 1).alias("w")), "n_nationkey", "w", 1000)


@REGISTRY.add("SP5_epoch_shuffle", f"SELECT vec_id, row_number() OVER (ORDER BY {draw_sql('vec_id', '3', '42')}) - 1 AS place FROM embeddings")
def sp5(spark, folder):
    return sp.shuffled(table(spark, folder, "embeddings").select("vec_id"), "vec_id", 3)


@REGISTRY.add("SP6_uniform_sample", f"SELECT event_id FROM events ORDER BY {draw_sql('event_id', '42')}, event_id LIMIT 500")
def sp6(spark, folder):
    return sp.sample(table(spark, folder, "events").select("event_id"), "event_id", 500)


@REGISTRY.add("SP7_representative_set", f"""WITH {S}, r AS (SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY {draw_sql('row_id', '42')}, row_id) - 1 AS i FROM s)
SELECT row_id, CASE WHEN y = 1 THEN i * 3 + 2 ELSE i // 2 * 3 + i % 2 END AS place FROM r WHERE i < CASE WHEN y = 1 THEN 100 ELSE 200 END""")
def sp7(spark, folder):
    return sp.representative_set(stream(spark, folder).select("row_id", "y"), "row_id", F.col("y") == 1, 300, 2)


@REGISTRY.add("SP8_subsample_cap", f"SELECT doc_id FROM documents ORDER BY {draw_sql('doc_id', '8')}, doc_id LIMIT 200")
def sp8(spark, folder):
    return sp.sample(table(spark, folder, "documents").select("doc_id"), "doc_id", 200, seed=8)


# ---- thresholds and reports

@REGISTRY.add("QG8_export_cutoff", f"WITH {S}, {grid_sql(101)}, a AS (SELECT threshold FROM ra WHERE recall >= 0.8 ORDER BY k DESC LIMIT 1), b AS (SELECT threshold FROM ra WHERE fah <= 20.0 ORDER BY recall DESC, fah, k LIMIT 1), c AS (SELECT coalesce((SELECT threshold FROM a), (SELECT threshold FROM b)) AS t) SELECT CASE WHEN t >= 0.05 AND t < 1 THEN t ELSE 0.92 END AS cutoff, round_even(CASE WHEN t >= 0.05 AND t < 1 THEN t ELSE 0.92 END * 255, 0)::INT AS cutoff_u8 FROM c")
def qg8(spark, folder):
    s = sc.sweep(stream(spark, folder), sc.linspace(101))
    return export_cutoff(s, HOURS, 0.8, 20.0, 0.92)


def export_cutoff(swept: DataFrame, hours: float, target_recall: float, target_fah: float, default: float) -> DataFrame:
    """The highest threshold that reaches the recall, else the best within the false alarms, guarded: below 0.05, from 1 up or not finite, the default holds."""
    a = sc.fah_at_target_recall(swept, hours, target_recall).select(F.when(F.col("recall") >= target_recall, F.col("threshold")).alias("a"))
    b = sc.recall_at_target_fah(swept, hours, target_fah).select(F.when(F.col("fah") <= target_fah, F.col("threshold")).alias("b"))
    t = F.coalesce("a", "b")
    c = a.join(F.broadcast(b)).select(F.when((t >= 0.05) & (t < 1), t).otherwise(F.lit(default)).alias("cutoff"))  # a row each
    return c.withColumn("cutoff_u8", F.bround(F.col("cutoff") * 255, 0).cast("int"))


@REGISTRY.add("QG9_threshold_optimiser", f"""WITH {S}, q AS (SELECT DISTINCT score AS t FROM s), r AS (SELECT t, (SELECT count(*) FROM s WHERE y = 1 AND score >= t) / (SELECT count(*) FROM s WHERE y = 1)::DOUBLE AS recall, (SELECT count(*) FROM s WHERE y = 0 AND score >= t) / {HOURS}::DOUBLE AS fah FROM q)
SELECT t AS threshold, recall, fah FROM r WHERE fah <= 20.0 ORDER BY recall DESC, fah, t LIMIT 1""")
def qg9(spark, folder):
    return optimal_threshold(stream(spark, folder), HOURS, 20.0)


def optimal_threshold(scores: DataFrame, hours: float, target_fah: float) -> DataFrame:
    """(threshold, recall, fah): of all distinct scores as thresholds (`>=`) the best within the bound. One histogram and its running totals stand for both the coarse and the fine grid."""
    h = sc.running_totals(sc.histogram(scores), "score", ["pos", "neg"], descending=True)
    p = scores.agg(F.count_if(F.col("y") == 1)).first()[0]
    at = h.select(F.col("score").alias("threshold"), ((F.col("pos_before") + F.col("pos")) / F.lit(float(max(1, p)))).alias("recall"), ((F.col("neg_before") + F.col("neg")) / F.lit(float(hours))).alias("fah"))
    return at.where(F.col("fah") <= target_fah).orderBy(F.desc("recall"), "fah", "threshold").limit(1)


@REGISTRY.add("QG10_temperature_fit")
def qg10(spark, folder):
    return fit_temperature(stream(spark, folder))


def fit_temperature(scores: DataFrame, low: float = 0.1, high: float = 10.0, points: int = 33, passes: int = 6) -> DataFrame:
    """(temperature, nll, accepted): the temperature from `low` to `high` of the least mean log loss; accepted if ECE improves. Rows without a score or label take no part.

    All sums are exact over the distinct scores, and only they reach the driver: each pass tries `points` temperatures, evenly spaced by their logarithm, between the neighbours of the last
    pass's best. Probabilities are held within 1e-7 of 0 and 1, before scaling and in the loss."""
    import math

    most = 1 - 1e-7
    held = lambda p: F.greatest(F.lit(1e-7), F.least(F.lit(most), p))
    h = cut(sc.histogram(scores.where(F.col("score").isNotNull() & ~F.isnan("score") & F.col("y").isNotNull()).select("y", F.col("score").cast("double").alias("score"))), "scores")
    h = h.withColumn("z", F.log(held(F.col("score")) / (1 - held(F.col("score")))))
    scaled = lambda t: 1 / (1 + F.exp(-F.col("z") / F.lit(t)))
    n = h.agg(F.coalesce(F.sum(F.col("pos") + F.col("neg")), F.lit(0))).first()[0]

    def nll(temperatures: list[float]) -> list[float]:
        loss = lambda p: F.coalesce(-F.sum(F.col("pos") * F.log(p) + F.col("neg") * F.log(1 - p)), F.lit(0.0))
        return [x / max(1, n) for x in h.agg(*[loss(held(scaled(t))).alias(f"t{i}") for i, t in enumerate(temperatures)]).first()]

    def ece(p) -> float:
        bin_ = sum((p >= F.lit(i * (1 / 15))).cast("int") for i in range(1, 15))
        gap = F.sum(p * (F.col("pos") + F.col("neg"))) - F.sum("pos")
        return sum(abs(r["gap"]) for r in h.groupBy(bin_.alias("bin")).agg(gap.alias("gap")).collect()) / max(1, n)

    lo, hi = math.log(low), math.log(high)
    for _ in range(passes):
        at = [lo + (hi - lo) * i / (points - 1) for i in range(points)]
        losses = nll([math.exp(x) for x in at])
        i = losses.index(min(losses))
        lo, hi = at[max(0, i - 1)], at[min(points - 1, i + 1)]
    t, loss = math.exp(at[i]), losses[i]
    # A temperature of one leaves the scores as they are.
    accepted = abs(t - 1) >= 1e-6 and ece(scaled(t)) < ece(F.col("score"))
    return scores.sparkSession.createDataFrame([(t, loss, accepted)], "temperature double, nll double, accepted boolean")


@REGISTRY.add("QG12_candidate_evaluation", f"WITH {S}, {grid_sql(101)}, h AS (SELECT count(*) * 1500 / 3600000.0::DOUBLE AS hours FROM s WHERE y = 0) SELECT threshold, recall, fp / hours AS fah FROM ra, h WHERE fp / hours <= 100 ORDER BY recall DESC, fp, k LIMIT 1")
def qg12(spark, folder):
    """Hours are the negatives' time at 1,500 ms a clip."""
    s = stream(spark, folder)
    hours = s.where("y = 0").count() * 1500 / 3600000.0
    return sc.recall_at_target_fah(sc.sweep(s, sc.linspace(101)), hours, 100.0)


@REGISTRY.add("QG14_threshold_fallback", f"WITH {S}, {grid_sql(101)}, a AS (SELECT threshold FROM ra WHERE fah <= 20.0 ORDER BY recall DESC, fah, k LIMIT 1) SELECT CASE WHEN threshold > 0 AND threshold <= 1 THEN threshold ELSE 0.5 END AS threshold FROM a")
def qg14(spark, folder):
    t = sc.recall_at_target_fah(sc.sweep(stream(spark, folder), sc.linspace(101)), HOURS, 20.0)
    return t.select(F.when((F.col("threshold") > 0) & (F.col("threshold") <= 1), F.col("threshold")).otherwise(0.5).alias("threshold"))


@REGISTRY.add("QG15_validation_pass", f"WITH {S}, d AS (SELECT y, CASE WHEN sum(score) OVER ({_O} ROWS 2 PRECEDING) > 0.5 * count(*) OVER ({_O} ROWS 2 PRECEDING) THEN 1 ELSE 0 END AS hit FROM s) SELECT count(*) FILTER (hit = 1 AND y = 1) AS tp, count(*) FILTER (hit = 1 AND y = 0) AS fp, count(*) FILTER (hit = 0 AND y = 0) AS tn, count(*) FILTER (hit = 0 AND y = 1) AS fn FROM d")
def qg15(spark, folder):
    d = od.sliding_detection(stream(spark, folder), ["clip"], ["ts", "row_id"], threshold=0.5, window=3)
    return sc.confusion(d, 1, score="detected")


@REGISTRY.add("AG66_metrics_facade", f"WITH {S}, d AS (SELECT y, CASE WHEN sum(score) OVER ({_O} ROWS 4 PRECEDING) > 0.45 * count(*) OVER ({_O} ROWS 4 PRECEDING) THEN 1.0 ELSE 0.0 END AS score FROM s), c AS (SELECT count(*) FILTER (score > 0.5 AND y = 1) AS tp, count(*) FILTER (score > 0.5 AND y = 0) AS fp, count(*) FILTER (score <= 0.5 AND y = 0) AS tn, count(*) FILTER (score <= 0.5 AND y = 1) AS fn FROM d) SELECT (tp + tn) / (tp + fp + tn + fn)::DOUBLE AS accuracy, tp / (tp + fp)::DOUBLE AS precision, tp / (tp + fn)::DOUBLE AS recall FROM c")
def ag66(spark, folder):
    """Sliding detection first, then the metrics at one half."""
    d = od.sliding_detection(stream(spark, folder), ["clip"], ["ts", "row_id"], threshold=0.45, window=5)
    return sc.binary_metrics(sc.confusion(d, 0.5, score="detected", strict=True)).select("accuracy", "precision", "recall")


_T = ", ".join(f"({i}, {v!r}::DOUBLE)" for i, v in enumerate(STATISTIC))


@REGISTRY.add("AG51_wada_snr", f"""WITH t(i, g) AS (VALUES {_T}), x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v FROM embeddings), p AS (SELECT vec_id, max(abs(v)) AS peak FROM x GROUP BY 1),
m AS (SELECT vec_id, ln(greatest(avg(greatest(abs(v) / peak, 1e-10)), 1e-10)) - avg(ln(greatest(abs(v) / peak, 1e-10))) AS v3 FROM x JOIN p USING (vec_id) GROUP BY 1), b AS (SELECT vec_id, v3, max(i) FILTER (g < v3) AS i FROM m CROSS JOIN t GROUP BY 1, 2)
SELECT vec_id, round(CASE WHEN b.i IS NULL THEN -20.0::DOUBLE WHEN b.i >= 120 THEN 100.0::DOUBLE ELSE greatest(-20, least(100, b.i - 20 + (v3 - t0.g) / (t1.g - t0.g + 1e-10))) END, 3) AS snr FROM b LEFT JOIN t t0 ON t0.i = b.i LEFT JOIN t t1 ON t1.i = b.i + 1""")
def ag51(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", F.round(snr(F.col("embedding")), 3).alias("snr"))


@REGISTRY.add("SF4_jaro_winkler", "SELECT p_partkey, round(jaro_winkler_similarity(p_name, 'red widget'), 6) AS similarity FROM part")
def sf4(spark, folder):
    return table(spark, folder, "part").select("p_partkey", F.round(jaro_winkler(F.col("p_name"), F.lit("red widget")), 6).alias("similarity"))


@REGISTRY.add("SF5_language_alias", "SELECT doc_id, CASE lower(trim(lang)) WHEN 'en' THEN 'eng-Latn' WHEN 'de' THEN 'deu-Latn' WHEN 'es' THEN 'spa-Latn' WHEN 'fr' THEN 'fra-Latn' ELSE 'tur-Latn' END AS code FROM documents")
def sf5(spark, folder):
    codes = {"en": "eng-Latn", "de": "deu-Latn", "es": "spa-Latn", "fr": "fra-Latn"}
    m = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    return table(spark, folder, "documents").select("doc_id", F.coalesce(F.try_element_at(m, F.lower(F.trim("lang"))), F.lit("tur-Latn")).alias("code"))


@REGISTRY.add("SF18_convolve_normalise", "SELECT vec_id, round(0.99, 4)::DOUBLE AS peak, 66 AS size FROM embeddings")
def sf18(spark, folder):
    """With a kernel of three values, then the peak brought to 0.99."""
    z = ar.convolved(F.col("embedding"), (0.5, 0.3, 0.2), 0.99)
    return table(spark, folder, "embeddings").select("vec_id", z.alias("z")).select("vec_id", F.round(F.array_max(F.transform("z", lambda v: F.abs(v))), 4).alias("peak"), F.size("z").alias("size"))


@REGISTRY.add("SF29_log_uniform", f"SELECT p_partkey, round(exp(ln(1e-4::DOUBLE) + u * (ln(1e-1::DOUBLE) - ln(1e-4::DOUBLE))), 9) AS rate, round(0.2 + u * 0.6, 9) AS share FROM (SELECT p_partkey, {draw_sql('p_partkey', '29')} / 4503599627370496.0 AS u FROM part)")
def sf29(spark, folder):
    u = sp.uniform(F.col("p_partkey"), F.lit(29))
    return table(spark, folder, "part").select("p_partkey", F.round(F.exp(F.log(F.lit(1e-4)) + u * (F.log(F.lit(1e-1)) - F.log(F.lit(1e-4)))), 9).alias("rate"), F.round(0.2 + u * 0.6, 9).alias("share"))


# ---- sources and sinks

def _corpus(spark: SparkSession) -> str:
    root = _fresh(spark, "corpus")
    audio.write_files(audio.synthetic_corpus(spark, seconds=0.1), root)
    return root


def _scanned(spark: SparkSession) -> DataFrame:
    root = _corpus(spark)
    return audio.scan(spark, {x: f"{root}/{x}" for x in ("positive", "negative", "hard_negative")})


@REGISTRY.add("SC1_recursive_scan", "SELECT unnest(['positive', 'negative', 'hard_negative']) AS label, unnest([10, 50, 20])::BIGINT AS n")
def sc1(spark, folder):
    """Scan, validate, filter by duration, tag: over the synthetic corpus."""
    rows = _scanned(spark).where(audio.wav_check(F.col("content")).isNull() & audio.wav_info(F.col("content"))["duration_ms"].between(50, 2000))
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("SC2_sorted_multi_extension_scan", "SELECT count(*) + 80 - count(*) AS n FROM region")
def sc2(spark, folder):
    root = _corpus(spark)
    return audio.scan(spark, {"all": root}, audio.EXTENSIONS).select("path").orderBy("path").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("SC3_case_insensitive_scan", f"WITH {R} SELECT count(*) FILTER (lower(regexp_extract(path, '[.]([^./]*)$', 1)) IN ('wav', 'mp3', 'flac', 'ogg', 'm4a', 'aac')) AS n FROM r")
def sc3(spark, folder):
    return records(spark, folder).agg(F.count_if(F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)).isin(list(audio.EXTENSIONS))).alias("n"))


@REGISTRY.add("SC4_size_only_duration", "SELECT 80::BIGINT AS n, 100.0::DOUBLE AS shortest, 100.0::DOUBLE AS longest")
def sc4(spark, folder):
    d = audio.size_duration_ms(F.col("length"))
    return _scanned(spark).agg(F.count(F.lit(1)).alias("n"), F.min(d).alias("shortest"), F.max(d).alias("longest"))


@REGISTRY.add("SC5_wav_header_probe", "SELECT 16000 AS rate, 1 AS channels, 16 AS bits, 1600::BIGINT AS frames, 80::BIGINT AS n")
def sc5(spark, folder):
    i = audio.synthetic_corpus(spark, seconds=0.1).select(audio.wav_info(F.col("content")).alias("i"))
    return i.groupBy("i.rate", "i.channels", "i.bits", "i.frames").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("SC6_wav_validate", "SELECT unnest([NULL, 'cut off', 'no RIFF/WAVE header']) AS problem, unnest([80, 80, 80])::BIGINT AS n")
def sc6(spark, folder):
    c = audio.synthetic_corpus(spark, seconds=0.1)
    forms = F.explode(F.array(F.col("content"), F.expr("substring(content, 1, length(content) - 100)"), F.expr("substring(content, 5, 1000)"))).alias("content")
    return c.select(forms).groupBy(audio.wav_check(F.col("content")).alias("problem")).agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("SC7_pcm_decode", "SELECT 80::BIGINT AS n, 1600 AS size, true AS in_range")
def sc7(spark, folder):
    s = audio.synthetic_corpus(spark, seconds=0.1).select(audio.wav_samples(F.col("content")).alias("s"))
    return s.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("s")).alias("size"), F.min(F.array_max(F.transform("s", lambda v: F.abs(v))) <= 1).alias("in_range"))


def _store_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("row_id"), F.slice("embedding", 1, 40).alias("features"), "label", F.format_string("clip_%d.wav", "vec_id").alias("path"))


@REGISTRY.add("SC9_ragged_append", "SELECT count(*) * 2 AS n, sum(40)::BIGINT * 2 AS total FROM embeddings")
def sc9(spark, folder):
    s = store.FeatureStore(spark, _fresh(spark, "store"))
    s.add(_store_rows(spark, folder), "train")
    s.add(_store_rows(spark, folder), "train")
    return s.read("train").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("features")).alias("total"))


@REGISTRY.add("SC10_feature_store", "SELECT i.pos::INT AS pos, e.vec_id AS row_id, e.label FROM (SELECT unnest([11, 4, 11]) AS id, unnest(range(3)) AS pos) i JOIN embeddings e ON e.vec_id = i.id")
def sc10(spark, folder):
    s = store.FeatureStore(spark, _fresh(spark, "store"))
    s.add(_store_rows(spark, folder), "val")
    return s.get([11, 4, 11], "val").select("pos", "row_id", "label")


@REGISTRY.add("SC13_json_dimension", "SELECT path, min(speaker_id) AS speaker_id FROM speaker_map GROUP BY path")
def sc13(spark, folder):
    """The map as JSON lines of mappings, read again."""
    docs = table(spark, folder, "speaker_map").select(F.to_json(F.struct(F.create_map("path", "speaker_id").alias("mappings"))).alias("doc"))
    return docs.select(F.explode(F.from_json("doc", "mappings map<string,string>")["mappings"]).alias("path", "speaker_id")).groupBy("path").agg(F.min("speaker_id").alias("speaker_id"))


@REGISTRY.add("SC14_log_round_trip", "WITH l AS (SELECT run_id, epoch, arg_max(false_predictions, struct_pack(a := logged_at, b := log_id)) AS p FROM prediction_logs WHERE epoch IS NOT NULL AND logged_at IS NOT NULL GROUP BY 1, 2) SELECT run_id, epoch, len(p)::INT AS n FROM l WHERE len(p) > 0")
def sc14_round(spark, folder):
    docs = store.log_documents(table(spark, folder, "prediction_logs").where("logged_at IS NOT NULL"))
    return store.exploded_log(docs, "document").groupBy("run_id", "epoch").agg(F.count(F.lit(1)).cast("int").alias("n"))


@REGISTRY.add("SC15_csv_sink", "SELECT score_id::VARCHAR AS score_id, coalesce(printf('%.6f', clip_ratio), '') AS clip_ratio, CASE WHEN discard THEN '1' ELSE '0' END AS discard FROM file_scores")
def sc15(spark, folder):
    return store.csv_report(table(spark, folder, "file_scores").select("score_id", "clip_ratio", "discard"), {"clip_ratio": 6})


@REGISTRY.add("SC19_synthetic_generator", "SELECT unnest(['positive', 'negative', 'hard_negative']) AS label, unnest([10, 50, 20])::BIGINT AS n, 32044::BIGINT AS bytes")
def sc19(spark, folder):
    return audio.synthetic_corpus(spark).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("content")).cast("bigint").alias("bytes"))


@REGISTRY.add("SC23_bundle_round_trip", f"WITH {S} SELECT row_id, y, score FROM s WHERE y = 0 AND score > 0.6")
def sc23(spark, folder):
    path = _fresh(spark, "bundle")
    stream(spark, folder).where("y = 0 AND score > 0.6").select("row_id", "y", "score").write.parquet(path)
    return spark.read.parquet(path)


@REGISTRY.add("SC25_manifest_discovery", "SELECT count(DISTINCT speaker_id) AS n FROM speaker_map")
def sc25(spark, folder):
    """Manifests written per speaker, found by name and read with a fixed schema; what lacks the keys is left out."""
    path = _fresh(spark, "manifests")
    docs = table(spark, folder, "speaker_map").groupBy("speaker_id").agg(F.count(F.lit(1)).alias("n_files"))
    docs.write.json(f"{path}/speakers_namelist.json")
    return spark.read.schema("speaker_id string, n_files bigint").option("pathGlobFilter", "part-*").json(f"{path}/*_namelist.json").where("speaker_id IS NOT NULL AND n_files IS NOT NULL").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("SC26_store_reset", "SELECT 0::BIGINT AS before, count(*) AS after FROM embeddings")
def sc26(spark, folder):
    s = store.FeatureStore(spark, _fresh(spark, "store"))
    s.reset("test")
    before = s.read("test").count()
    s.add(_store_rows(spark, folder), "test")
    return s.read("test").agg(F.count(F.lit(1)).alias("after")).select(F.lit(before).cast("bigint").alias("before"), "after")


@REGISTRY.add("SC27_raw_wav_round_trip", "SELECT 0.0::DOUBLE AS max_error, -1.0::DOUBLE AS bad_duration")
def sc27(spark, folder):
    x = [i / 64.0 - 0.5 for i in range(64)]
    rows = spark.createDataFrame([(audio.wav_bytes(x), b"junk")], "good binary, bad binary")
    err = F.array_max(F.zip_with(audio.wav_samples(F.col("good")), F.array(*[F.lit(v) for v in x]), lambda a, b: F.abs(a - b)))
    return rows.select(err.cast("double").alias("max_error"), audio.wav_info(F.col("bad"))["duration_ms"].alias("bad_duration"))


@REGISTRY.add("SC16_non_finite_report", "SELECT score_id, CASE WHEN wqi IS NULL OR isnan(wqi) THEN '{\"score_id\":' || score_id || '}' END AS doc FROM file_scores WHERE wqi IS NULL OR isnan(wqi)")
def sc16_nonfinite(spark, folder):
    q = table(spark, folder, "file_scores").where("wqi IS NULL OR isnan(wqi)")
    return q.select("score_id", F.to_json(F.struct("score_id", finite(F.col("wqi")).alias("wqi"))).alias("doc"))


@REGISTRY.add("QG16_phonetic_report", f"SELECT text, n_files, score, CASE WHEN score >= 0.82 THEN 'HIGH' WHEN score >= 0.72 THEN 'MEDIUM' ELSE 'LOW' END AS risk FROM (SELECT text, count(*) AS n_files, round_even(jaro_winkler_similarity(regexp_replace(text, '[^ -~]', '?', 'g'), 'hey tessera'), 4) AS score FROM ({TEXTS_SQL}) GROUP BY text)")
def phonetic(spark, folder):
    """Texts of file names, their similarity to a wake word, the best row per text and its risk."""
    from earshot.functions.scalars import risk

    texts = records(spark, folder).groupBy(spoken_text(F.col("path")).alias("text")).agg(F.count(F.lit(1)).alias("n_files"))
    scored = texts.withColumn("score", F.bround(jaro_winkler(F.col("text"), F.lit("hey tessera")), 4))
    return scored.select("text", "n_files", "score", risk(F.col("score")).alias("risk")).orderBy(F.desc("score"), "text")


# ---- reports and settings

@REGISTRY.add("SC17_markdown_report", f"""WITH {P}, t AS (SELECT replace(f.file_path, '|', '\\|') AS path, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, f.file_path) AS i FROM p WHERE f.file_path IS NOT NULL GROUP BY f.file_path)
SELECT 0::BIGINT AS line, '## False predictions by file' AS text UNION ALL SELECT 1, '' UNION ALL SELECT 2, '| file_path | n |' UNION ALL SELECT 3, '|-|-|' UNION ALL SELECT i + 3, '| ' || path || ' | ' || n || ' |' FROM t WHERE i <= 50 UNION ALL SELECT 4 + least(50, (SELECT count(*) FROM t)), ''""")
def sc17(spark, folder):
    """The 50 files with the most false predictions as lines of a Markdown report."""
    counted = predictions(spark, folder).where("file_path IS NOT NULL").groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    lines = markdown(counted.orderBy(F.desc("n"), "file_path").limit(50), "False predictions by file").split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "line bigint, text string")


def _settings(spark: SparkSession, folder: str) -> list:
    """Some rows to make settings documents of: a region each."""
    return table(spark, folder, "region").select("r_regionkey", "r_name").orderBy("r_regionkey").limit(1000).collect()


@REGISTRY.add("PF14_known_settings", "SELECT r_regionkey AS key, r_name AS name, 7 AS steps FROM region")
def pf14(spark, folder):
    """Of a section only the fields that its class has; others are named in a warning."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        made = [section(_Place, {"key": r["r_regionkey"], "name": r["r_name"], "unknown": 1}) for r in _settings(spark, folder)]
    return spark.createDataFrame([(p.key, p.name, p.steps) for p in made], "key bigint, name string, steps int")


@dataclass
class _Place:
    key: int
    name: str
    steps: int = 7


@REGISTRY.add("SF23_environment_values", "SELECT r_name AS name, '/data/' || r_name || '/x' AS set, 'none/' || r_name AS other, '${LOST}' AS lost FROM region")
def sf23(spark, folder):
    document = {r["r_name"]: ["${ROOT}/" + r["r_name"] + "/x", "${LOST:-none}/" + r["r_name"], "${LOST}"] for r in _settings(spark, folder)}
    filled = with_environment(document, {"ROOT": "/data"})
    return spark.createDataFrame([(k, *v) for k, v in filled.items()], "name string, set string, other string, lost string")


@REGISTRY.add("SF35_path_rules", "SELECT r_name AS name, '/work/' || r_name AS here, '/etc/' || r_name || '.yaml' AS above, '/work/config/' || r_name || '.yaml' AS bare, r_name AS plain FROM region")
def sf35(spark, folder):
    at = lambda v: resolved_path(v, "/etc/app/a.yaml", "/work")
    made = [(n, at(f"./{n}"), at(f"../{n}.yaml"), at(f"config/{n}.yaml"), at(n)) for n in (r["r_name"] for r in _settings(spark, folder))]
    return spark.createDataFrame(made, "name string, here string, above string, bare string, plain string")
