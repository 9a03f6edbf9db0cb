"""Queries of the score-stream metrics: events as a stream of scores, `error` events as positives."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from earshot.operators import scores as sc
from earshot.operators.quantiles import exact_percentiles
from earshot.plans.registry import Registry
from earshot.sources.tables import table

REGISTRY = Registry()
HOURS = 10.0

#: The same stream in DuckDB. Scores lie on a grid of thousandths, computed alike in both engines.
S = """s AS (SELECT event_id AS row_id, user_id AS clip, ts, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y, CASE WHEN event_type = 'error' THEN 1 WHEN event_type = 'click' THEN 2 ELSE 0 END AS raw,
  ((event_id * 37) % 700 + CASE WHEN event_type = 'error' THEN 300 ELSE 0 END) / 1000::DOUBLE AS score, (1 + user_id % 3)::DOUBLE AS w FROM events)"""


def stream(spark: SparkSession, folder: str) -> DataFrame:
    error, click = F.col("event_type") == "error", F.col("event_type") == "click"
    return table(spark, folder, "events").select(
        F.col("event_id").alias("row_id"), F.col("user_id").alias("clip"), "ts", F.when(error, 1).otherwise(0).alias("y"), F.when(error, 1).when(click, 2).otherwise(0).alias("raw"),
        (((F.col("event_id") * 37) % 700 + F.when(error, 300).otherwise(0)) / F.lit(1000.0)).alias("score"), (1 + F.col("user_id") % 3).cast("double").alias("w"),
    )


def grid_sql(n: int, low: float = 0.0, high: float = 1.0, strict: bool = True, weight: str | None = None) -> str:
    """thresholds x scores in full, the plain way."""
    step = repr((high - low) / (n - 1))
    op = ">" if strict else ">="
    c = (lambda cond: f"coalesce(sum({weight}) FILTER ({cond}), 0)") if weight else (lambda cond: f"count(*) FILTER ({cond})")
    return f"""g AS (SELECT k::INT AS k, {low!r}::DOUBLE + k * {step}::DOUBLE AS threshold FROM range({n}) r(k)),
sw AS (SELECT k, threshold, {c(f'y = 1 AND score {op} threshold')} AS tp, {c(f'y = 0 AND score {op} threshold')} AS fp, {c(f'y = 0 AND NOT score {op} threshold')} AS tn,
  {c(f'y = 1 AND NOT score {op} threshold')} AS fn FROM g CROSS JOIN s GROUP BY k, threshold),
ra AS (SELECT *, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::DOUBLE END AS recall, CASE WHEN fp + tn = 0 THEN 0 ELSE fp / (fp + tn)::DOUBLE END AS fpr,
  CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::DOUBLE END AS precision, fp / {HOURS}::DOUBLE AS fah FROM sw)"""


def confusion_sql(threshold: float, strict: bool = False, weight: str = "1") -> str:
    op = ">" if strict else ">="
    c = lambda cond: f"coalesce(sum(CASE WHEN {cond} THEN {weight} END), 0)"
    return f"""c AS (SELECT {c(f'score {op} {threshold} AND y = 1')} AS tp, {c(f'score {op} {threshold} AND y = 0')} AS fp, {c(f'score < {threshold} AND y = 0' if not strict else f'score <= {threshold} AND y = 0')} AS tn,
  {c(f'score < {threshold} AND y = 1' if not strict else f'score <= {threshold} AND y = 1')} AS fn FROM s)"""


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@REGISTRY.add("AG4_confusion_matrix", f"WITH {S}, {confusion_sql(0.5)} SELECT tp::BIGINT AS tp, fp::BIGINT AS fp, tn::BIGINT AS tn, fn::BIGINT AS fn FROM c")
def confusion_matrix(spark, folder):
    return sc.confusion(stream(spark, folder), 0.5)


@REGISTRY.add("AG4_confusion_normalised", f"WITH {S}, {confusion_sql(0.5)} SELECT * FROM (SELECT 1 AS label, tp / (tp + fn)::DOUBLE AS predicted_1, fn / (tp + fn)::DOUBLE AS predicted_0 FROM c UNION ALL SELECT 0, fp / (fp + tn)::DOUBLE, tn / (fp + tn)::DOUBLE FROM c)")
def confusion_normalised(spark, folder):
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    rows = F.array(F.struct(F.lit(1).alias("label"), sc.ratio(tp, tp + fn).alias("predicted_1"), sc.ratio(fn, tp + fn).alias("predicted_0")), F.struct(F.lit(0).alias("label"), sc.ratio(fp, fp + tn).alias("predicted_1"), sc.ratio(tn, fp + tn).alias("predicted_0")))
    return sc.confusion(stream(spark, folder), 0.5).select(F.explode(rows).alias("r")).select("r.*")


@REGISTRY.add("AG5_weighted_accuracy", f"WITH {S} SELECT coalesce(sum(CASE WHEN (score > 0.5) = (y = 1) THEN w END) / nullif(sum(w), 0), 0) AS accuracy FROM s")
def weighted_accuracy(spark, folder):
    return sc.binary_metrics(sc.confusion(stream(spark, folder), 0.5, strict=True, weight="w")).select("accuracy")


@REGISTRY.add("AG6_weighted_prf", f"WITH {S}, {confusion_sql(0.5, True, 'w')} SELECT tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1 FROM c")
def weighted_prf(spark, folder):
    return sc.binary_metrics(sc.confusion(stream(spark, folder), 0.5, strict=True, weight="w")).select("precision", "recall", "f1")


@REGISTRY.add("AG7_derived_metrics", f"""WITH {S}, {confusion_sql(0.5)}, d AS (SELECT tp::DOUBLE AS tp, fp::DOUBLE AS fp, tn::DOUBLE AS tn, fn::DOUBLE AS fn FROM c),
r AS (SELECT *, tp/(tp+fn) AS recall, tn/(tn+fp) AS specificity, tp/(tp+fp) AS precision, tn/(tn+fn) AS npv, fp/(fp+tn) AS fpr, fn/(fn+tp) AS fnr, (tp+tn)/(tp+fp+tn+fn) AS acc,
  ((tp+fp)*(tp+fn)+(fn+tn)*(fp+tn))/((tp+fp+tn+fn)*(tp+fp+tn+fn)) AS pe FROM d)
SELECT round(specificity, 6) AS specificity, round(npv, 6) AS npv, round(fpr, 6) AS fpr, round(fnr, 6) AS fnr, round((recall+specificity)/2, 6) AS balanced_accuracy, round(recall+specificity-1, 6) AS informedness,
  round(precision+npv-1, 6) AS markedness, round((tp*tn-fp*fn)/sqrt((tp+fp)*(tp+fn)*(tn+fp)*(tn+fn)), 6) AS mcc, round((acc-pe)/(1-pe), 6) AS kappa, round(recall/(1-specificity), 6) AS lr_pos,
  round((1-recall)/specificity, 6) AS lr_neg, round(recall/(1-specificity)/((1-recall)/specificity), 6) AS dor FROM r""")
def derived(spark, folder):
    m = sc.binary_metrics(sc.confusion(stream(spark, folder), 0.5))
    return r6(m.select("specificity", "npv", "fpr", "fnr", "balanced_accuracy", "informedness", "markedness", "mcc", "kappa", "lr_pos", "lr_neg", "dor"))


@REGISTRY.add("AG8_roc_auc", f"""WITH {S}, r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM s)
SELECT round((sum(rk) FILTER (y = 1) - (count(*) FILTER (y = 1)) * (count(*) FILTER (y = 1) + 1) / 2.0::DOUBLE) / ((count(*) FILTER (y = 1))::DOUBLE * count(*) FILTER (y = 0)), 6) AS roc_auc FROM r""")
def roc_auc(spark, folder):
    return r6(sc.roc_auc(stream(spark, folder)))


@REGISTRY.add("AG9_average_precision", f"""WITH {S}, d AS (SELECT score, count(*) FILTER (raw = 1) AS p, count(*) AS n FROM s WHERE raw <> 2 GROUP BY score),
c AS (SELECT *, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS tot FROM d) SELECT round(sum(p * (tp / tot::DOUBLE)) / sum(p), 6) AS average_precision FROM c""")
def average_precision(spark, folder):
    return r6(sc.average_precision(stream(spark, folder), label="raw"))


@REGISTRY.add("AG10_curve_area", f"WITH {S}, {grid_sql(101)}, z AS (SELECT (fpr - lag(fpr) OVER o) * (recall + lag(recall) OVER o) / 2 AS a FROM ra WINDOW o AS (ORDER BY k DESC)) SELECT round(sum(a), 6) AS area FROM z")
def curve_area(spark, folder):
    return r6(sc.area(sc.rates(sc.sweep(stream(spark, folder), sc.linspace(101))), "fpr", "recall", F.desc("k")))


@REGISTRY.add("AG11_false_alarms_per_hour", f"WITH {S} SELECT count(*) FILTER (score >= 0.5 AND y = 0) AS fp, count(*) FILTER (score >= 0.5 AND y = 0) / {HOURS}::DOUBLE AS fah FROM s")
def fah(spark, folder):
    return sc.confusion(stream(spark, folder), 0.5).select("fp", (F.col("fp") / HOURS).alias("fah"))


@REGISTRY.add("AG12_roc_pr_curve", f"WITH {S}, {grid_sql(101)} SELECT k, threshold, fpr, recall, precision FROM ra")
def roc_pr(spark, folder):
    return sc.rates(sc.sweep(stream(spark, folder), sc.linspace(101))).select("k", "threshold", "fpr", "recall", "precision")


@REGISTRY.add("AG13_multi_threshold_counts", f"WITH {S}, {grid_sql(101, strict=False)} SELECT k, threshold, tp, fp, tn, fn FROM sw")
def multi_threshold(spark, folder):
    return sc.sweep(stream(spark, folder), sc.linspace(101), strict=False)


@REGISTRY.add("AG13_nearest_cutoff", f"WITH {S}, {grid_sql(101, strict=False)} SELECT threshold, tp, fp, tn, fn FROM sw ORDER BY abs(threshold - 0.4567), k LIMIT 1")
def nearest_cutoff(spark, folder):
    return sc.pick(sc.sweep(stream(spark, folder), sc.linspace(101), strict=False), F.abs(F.col("threshold") - 0.4567), F.col("k")).select("threshold", "tp", "fp", "tn", "fn")


@REGISTRY.add("AG14_adaptive_thresholds", f"""WITH {S}, u AS (SELECT score AS t, row_number() OVER (ORDER BY score) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT score FROM s)),
pk AS (SELECT DISTINCT floor(j * (n - 1) / 332.0)::BIGINT AS i FROM range(333) r(j), (SELECT max(n) AS n FROM u)), v AS (SELECT t FROM u WHERE n <= 333 OR i IN (SELECT i FROM pk)),
a AS (SELECT DISTINCT greatest(0.0::DOUBLE, least(1.0::DOUBLE, x)) AS t FROM (SELECT unnest([t - 1e-7::DOUBLE, t, t + 1e-7::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE]) AS x FROM v)),
b AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n FROM a), pj AS (SELECT DISTINCT floor(j * (n - 1) / 999.0)::BIGINT AS i FROM range(1000) r(j), (SELECT max(n) AS n FROM b))
SELECT (row_number() OVER (ORDER BY t) - 1)::INT AS k, t AS threshold FROM b WHERE n <= 1000 OR i IN (SELECT i FROM pj)""")
def adaptive(spark, folder):
    return sc.adaptive_grid(stream(spark, folder))


@REGISTRY.add("AG15_recall_at_no_false_alarm", f"WITH {S}, {grid_sql(101)} SELECT threshold, recall FROM ra ORDER BY CASE WHEN fp = 0 THEN 0 ELSE 1 END, CASE WHEN fp = 0 THEN k ELSE -k END LIMIT 1")
def recall_no_fa(spark, folder):
    return sc.recall_at_no_false_alarm(sc.sweep(stream(spark, folder), sc.linspace(101)))


@REGISTRY.add("AG16_recall_at_target_fah", f"WITH {S}, {grid_sql(101)} SELECT threshold, recall, fah FROM ra WHERE fah <= 20.0 ORDER BY recall DESC, fah, k LIMIT 1")
def recall_at_fah(spark, folder):
    return sc.recall_at_target_fah(sc.sweep(stream(spark, folder), sc.linspace(101)), HOURS, 20.0)


@REGISTRY.add("AG17_fah_at_target_recall", f"WITH {S}, {grid_sql(101)} SELECT threshold, recall, fah FROM ra WHERE recall >= 0.8 ORDER BY k DESC LIMIT 1")
def fah_at_recall(spark, folder):
    return sc.fah_at_target_recall(sc.sweep(stream(spark, folder), sc.linspace(101)), HOURS, 0.8)


@REGISTRY.add("AG18_average_viable_recall", f"WITH {S}, {grid_sql(101)}, v AS (SELECT fah / 200.0 AS x, recall FROM ra WHERE fah <= 200.0), z AS (SELECT (x - lag(x) OVER o) * (recall + lag(recall) OVER o) / 2 AS a FROM v WINDOW o AS (ORDER BY x, recall)) SELECT round(coalesce(sum(a), 0), 6) AS average_viable_recall FROM z")
def viable_recall(spark, folder):
    return r6(sc.average_viable_recall(sc.sweep(stream(spark, folder), sc.linspace(101)), HOURS, 200.0))


def viable_capped(swept: DataFrame, hours: float, cap: float) -> DataFrame:
    """The area of recall over false alarms per hour up to `cap`, recall at the cap interpolated, of repeated fah the first kept (from low to high), over the cap."""
    from pyspark.sql import Window

    s = sc.rates(swept, hours)
    first = s.groupBy("fah").agg(F.max("recall").alias("recall"))
    o = Window.orderBy("fah")
    p = first.select("fah", "recall", F.lead("fah").over(o).alias("f1"), F.lead("recall").over(o).alias("r1")).where((F.col("fah") < cap) & F.col("f1").isNotNull())
    end, r_end = F.least(F.col("f1"), F.lit(cap)), F.when(F.col("f1") <= cap, F.col("r1")).otherwise(F.col("recall") + (F.col("r1") - F.col("recall")) * (F.lit(cap) - F.col("fah")) / (F.col("f1") - F.col("fah")))
    return p.agg(F.coalesce(F.sum((end - F.col("fah")) * (F.col("recall") + r_end) / 2) / cap, F.lit(0.0)).alias("average_viable_recall"))


@REGISTRY.add("AG19_viable_recall_capped", f"""WITH {S}, {grid_sql(101)}, f AS (SELECT fah, max(recall) AS recall FROM ra GROUP BY fah), p AS (SELECT *, lead(fah) OVER o AS f1, lead(recall) OVER o AS r1 FROM f WINDOW o AS (ORDER BY fah)),
q AS (SELECT fah, recall, least(f1, 150.0) AS e, CASE WHEN f1 <= 150.0 THEN r1 ELSE recall + (r1 - recall) * (150.0 - fah) / (f1 - fah) END AS re FROM p WHERE fah < 150.0 AND f1 IS NOT NULL)
SELECT round(coalesce(sum((e - fah) * (recall + re) / 2) / 150.0, 0), 6) AS average_viable_recall FROM q""")
def viable_recall_capped(spark, folder):
    return r6(viable_capped(sc.sweep(stream(spark, folder), sc.linspace(101)), HOURS, 150.0))


def _faph_sql(most: float, compat: bool) -> str:
    y1, at = ("y0", 2.0) if compat else ("frr", most)
    return f"""WITH {S}, {grid_sql(101)}, p AS (SELECT k, fah AS faph, 1 - recall AS frr, lag(fah) OVER (ORDER BY k) AS x0, lag(1 - recall) OVER (ORDER BY k) AS y0 FROM ra), v AS (SELECT * FROM p WHERE faph <= {most}),
e AS (SELECT {most}::DOUBLE AS faph, CASE WHEN x0 IS NULL THEN frr ELSE (y0 * (faph - {at}) + {y1} * ({at} - x0)) / (faph - x0) END AS frr FROM v ORDER BY k LIMIT 1), i AS (SELECT faph, arg_min(frr, k) AS frr FROM v WHERE faph <> {most} GROUP BY faph)
SELECT faph, round(frr, 6) AS frr FROM (SELECT * FROM e UNION ALL SELECT * FROM i UNION ALL SELECT 0.0, 1.0 FROM v HAVING min(faph) > 0)"""


@REGISTRY.add("AG20_faph_frr_points", _faph_sql(150.0, False))
def faph_frr(spark, folder):
    return sc.faph_points(sc.sweep(stream(spark, folder), sc.linspace(101)), HOURS, 150.0).withColumn("frr", F.round("frr", 6))


@REGISTRY.add("AG20_faph_frr_points_compat", _faph_sql(150.0, True))
def faph_frr_compat(spark, folder):
    return sc.faph_points(sc.sweep(stream(spark, folder), sc.linspace(101)), HOURS, 150.0, compat=True).withColumn("frr", F.round("frr", 6))


_BEST = "CASE WHEN tp + fp = 0 OR tp = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1, (recall + 1 - fpr) / 2 AS balanced, (10.0 * fp + 5.0 * fn) / (tp + fp + tn + fn) AS cost"


@REGISTRY.add("AG21_threshold_sweep_best", f"""WITH {S}, {grid_sql(101, strict=False)}, m AS (SELECT *, {_BEST} FROM ra) SELECT * FROM (
SELECT 'balanced' AS criterion, threshold, round(balanced, 6) AS value FROM m ORDER BY round(balanced, 12) DESC, k LIMIT 1) UNION ALL (SELECT 'cost', threshold, round(cost, 6) FROM m ORDER BY round(cost, 12), k LIMIT 1) UNION ALL (SELECT 'f1', threshold, round(f1, 6) FROM m ORDER BY round(f1, 12) DESC, k LIMIT 1)""")
def sweep_best(spark, folder):
    s = sc.rates(sc.sweep(stream(spark, folder), sc.linspace(101), strict=False))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    m = s.select("k", "threshold", sc.ratio(2.0 * tp, 2 * tp + fp + fn).alias("f1"), ((F.col("recall") + 1 - F.col("fpr")) / 2).alias("balanced"), ((10.0 * fp + 5.0 * fn) / (tp + fp + tn + fn)).alias("cost"))
    best = lambda name, sign: sc.pick(m, sign(F.round(name, 12)), F.col("k")).select(F.lit(name).alias("criterion"), "threshold", F.round(name, 6).alias("value"))
    return best("balanced", F.desc).unionByName(best("cost", F.asc)).unionByName(best("f1", F.desc))


@REGISTRY.add("AG22_operating_points", f"""WITH {S}, {grid_sql(99, 0.01, 0.99, False)}, t AS (SELECT unnest([5.0, 20.0, 50.0, 100.0]) AS target), j AS (SELECT target, threshold, recall, fah, row_number() OVER (PARTITION BY target ORDER BY recall DESC, k) AS r FROM t JOIN ra ON fah <= target)
SELECT target::DOUBLE AS target, threshold, recall, fah FROM j WHERE r = 1""")
def operating_points(spark, folder):
    s = sc.rates(sc.sweep(stream(spark, folder), sc.linspace(99, 0.01, 0.99), strict=False), HOURS)
    targets = spark.createDataFrame([(5.0,), (20.0,), (50.0,), (100.0,)], "target double")
    w = Window.partitionBy("target").orderBy(F.desc("recall"), "k")
    return s.join(F.broadcast(targets), F.col("fah") <= F.col("target")).withColumn("r", F.row_number().over(w)).where("r = 1").select("target", "threshold", "recall", "fah")


@REGISTRY.add("AG23_coarse_sweep", f"WITH {S}, {grid_sql(9, 0.1, 0.9, False)} SELECT k, tp, fp, tn, fn, recall, precision, fpr, fah FROM ra")
def coarse(spark, folder):
    return sc.rates(sc.sweep(stream(spark, folder), sc.linspace(9, 0.1, 0.9), strict=False), HOURS).select("k", "tp", "fp", "tn", "fn", "recall", "precision", "fpr", "fah")


@REGISTRY.add("AG24_equal_error_rate", f"WITH {S}, {grid_sql(101)} SELECT fpr AS eer, threshold FROM ra ORDER BY round(abs(fpr - (1 - recall)), 12), k LIMIT 1")
def eer(spark, folder):
    return sc.pick(sc.rates(sc.sweep(stream(spark, folder), sc.linspace(101))), F.round(F.abs(F.col("fpr") - (1 - F.col("recall"))), 12), F.col("k")).select(F.col("fpr").alias("eer"), "threshold")


@REGISTRY.add("AG25_ks_statistic", f"WITH {S}, {grid_sql(101)} SELECT max(abs(recall - fpr)) AS ks FROM ra")
def ks(spark, folder):
    return sc.rates(sc.sweep(stream(spark, folder), sc.linspace(101))).agg(F.max(F.abs(F.col("recall") - F.col("fpr"))).alias("ks"))


def _bins_sql(n: int, right: bool) -> str:
    step = repr(1.0 / n)
    edge = f"(SELECT count(*) FROM range(1, {n}) e(i) WHERE score {'>' if right else '>='} i * {step}::DOUBLE)"
    return f"b AS (SELECT {edge}::INT AS bin, count(*) AS count, avg(score) AS mean_score, avg(y) AS observed FROM s GROUP BY 1)"


@REGISTRY.add("AG26_calibration_curve", f"WITH {S}, {_bins_sql(10, True)} SELECT i::INT AS bin, coalesce(count, 0) AS count, round(coalesce(mean_score, 0), 6) AS mean_score, round(coalesce(observed, 0), 6) AS observed FROM range(10) r(i) LEFT JOIN b ON b.bin = i")
def calibration(spark, folder):
    return r6(sc.calibration_curve(stream(spark, folder), 10))


@REGISTRY.add("AG27_ece", f"WITH {S}, {_bins_sql(15, False)} SELECT round(sum(abs(mean_score - observed) * count) / sum(count), 6) AS ece FROM b")
def ece(spark, folder):
    return r6(sc.expected_calibration_error(stream(spark, folder), 15))


@REGISTRY.add("AG27_ece_mce_from_curve", f"WITH {S}, {_bins_sql(12, True)} SELECT round(sum(abs(mean_score - observed) * count) / sum(count), 6) AS ece, round(max(abs(mean_score - observed)), 6) AS mce FROM b")
def ece_mce(spark, folder):
    return r6(sc.calibration_errors(sc.calibration_curve(stream(spark, folder), 12)))


@REGISTRY.add("AG28_brier", f"WITH {S} SELECT round(avg((score - y) * (score - y)), 6) AS brier FROM s")
def brier(spark, folder):
    return r6(sc.brier(stream(spark, folder)))


@REGISTRY.add("AG29_bootstrap_intervals")
def bootstrap(spark, folder):
    return sc.bootstrap(stream(spark, folder), 100, 0.5)


@REGISTRY.add("AG30_score_distribution", f"WITH {S} SELECT CASE WHEN raw = 1 THEN 'positive' WHEN raw = 2 THEN 'hard_negative' ELSE 'negative' END AS class, count(*) AS n, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std, median(score) AS median, min(score) AS min, max(score) AS max FROM s GROUP BY 1")
def distribution(spark, folder):
    name = F.when(F.col("raw") == 1, "positive").when(F.col("raw") == 2, "hard_negative").otherwise("negative")
    s = stream(spark, folder).withColumn("class", name)
    middle = exact_percentiles(s, ["class"], "score", {"median": 0.5})
    return s.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean"), F.round(F.stddev_pop("score"), 6).alias("std"), F.min("score").alias("min"), F.max("score").alias("max")).join(middle, "class")


@REGISTRY.add("AG31_percentile_summary", f"WITH {S} SELECT min(score) AS min, round(quantile_cont(score, 0.05), 6) AS p05, round(quantile_cont(score, 0.5), 6) AS p50, round(quantile_cont(score, 0.95), 6) AS p95, round(quantile_cont(score, 0.99), 6) AS p99, max(score) AS max, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std FROM s")
def percentiles(spark, folder):
    q = stream(spark, folder)
    p = exact_percentiles(q, [], "score", {"p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99})
    m = q.agg(F.min("score").alias("min"), F.max("score").alias("max"), F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"))
    r = lambda c: F.round(c, 6).alias(c)
    return m.join(F.broadcast(p)).select("min", r("p05"), r("p50"), r("p95"), r("p99"), "max", r("mean"), r("std"))  # a row each


@REGISTRY.add("AG32_per_category_rates", f"WITH {S} SELECT raw, count(*) AS n, CASE WHEN raw = 1 THEN count(*) FILTER (score >= 0.5) / count(*)::DOUBLE END AS tpr, CASE WHEN raw <> 1 THEN count(*) FILTER (score < 0.5) / count(*)::DOUBLE END AS tnr, CASE WHEN raw <> 1 THEN count(*) FILTER (score >= 0.5) / count(*)::DOUBLE END AS fpr FROM s GROUP BY raw")
def per_category(spark, folder):
    hit, n = F.count_if(F.col("score") >= 0.5), F.count(F.lit(1))
    pos = F.col("raw") == 1
    return stream(spark, folder).groupBy("raw").agg(n.alias("n"), hit.alias("h")).select("raw", "n", F.when(pos, F.col("h") / F.col("n")).alias("tpr"), F.when(~pos, (F.col("n") - F.col("h")) / F.col("n")).alias("tnr"), F.when(~pos, F.col("h") / F.col("n")).alias("fpr"))


@REGISTRY.add("AG33_lift_at_top", f"""WITH {S}, o AS (SELECT y, row_number() OVER (ORDER BY score DESC, row_id) AS r, count(*) OVER () AS n, sum(y) OVER () AS p FROM s), f AS (SELECT unnest([0.01, 0.05, 0.1]) AS share)
SELECT share::DOUBLE AS share, max(greatest(1, floor(n * share)))::BIGINT AS k, sum(y) FILTER (r <= greatest(1, floor(n * share))) / max(p)::DOUBLE AS capture, sum(y) FILTER (r <= greatest(1, floor(n * share))) / max(greatest(1, floor(n * share)))::DOUBLE AS precision,
  sum(y) FILTER (r <= greatest(1, floor(n * share))) / max(greatest(1, floor(n * share)))::DOUBLE / (max(p) / max(n)::DOUBLE) AS lift FROM o CROSS JOIN f GROUP BY share""")
def lift(spark, folder):
    s = stream(spark, folder)
    n, p = s.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    top = {share: max(1, math.floor(n * share)) for share in (0.01, 0.05, 0.1)}
    # The largest k only is sorted, as a top-k.
    head = s.orderBy(F.desc("score"), "row_id").limit(max(top.values())).select("y", F.row_number().over(Window.orderBy(F.desc("score"), "row_id")).alias("r"))
    f = spark.createDataFrame([(a, k) for a, k in top.items()], "share double, k bigint")
    got = head.join(F.broadcast(f), F.col("r") <= F.col("k")).groupBy("share", "k").agg(F.sum("y").alias("h"))
    return got.select("share", "k", (F.col("h") / p).alias("capture"), (F.col("h") / F.col("k")).alias("precision"), (F.col("h") / F.col("k") / F.lit(p / max(1, n))).alias("lift"))


@REGISTRY.add("AG48_confidence_drift", f"""WITH {S}, o AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY ts, row_id) AS i, count(*) OVER (PARTITION BY clip) AS n FROM s)
SELECT clip, round(avg(score), 6) AS mean, round(avg(CASE WHEN score > 0.9 THEN 1.0 ELSE 0 END), 6) AS high_share, round(avg(CASE WHEN score < 0.1 THEN 1.0 ELSE 0 END), 6) AS low_share, round(avg(1 - 2 * abs(score - 0.5)), 6) AS uncertainty,
  CASE WHEN max(n) >= 20 THEN round(abs(avg(score) FILTER (i > n - 10) - avg(score) FILTER (i <= 10)), 6) END AS drift FROM o GROUP BY clip""")
def drift(spark, folder):
    w, g = Window.partitionBy("clip").orderBy("ts", "row_id"), Window.partitionBy("clip")
    o = stream(spark, folder).withColumn("i", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(g))
    share = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 6)
    last, first = F.avg(F.when(F.col("i") > F.col("n") - 10, F.col("score"))), F.avg(F.when(F.col("i") <= 10, F.col("score")))
    return o.groupBy("clip").agg(F.round(F.avg("score"), 6).alias("mean"), share(F.col("score") > 0.9).alias("high_share"), share(F.col("score") < 0.1).alias("low_share"), F.round(F.avg(1 - 2 * F.abs(F.col("score") - 0.5)), 6).alias("uncertainty"), F.when(F.max("n") >= 20, F.round(F.abs(last - first), 6)).alias("drift"))


@REGISTRY.add("AG49_per_class_accuracy", f"WITH {S} SELECT avg(CASE WHEN score > 0.5 THEN 1.0 ELSE 0 END) FILTER (raw = 1) AS positive_accuracy, avg(CASE WHEN score <= 0.5 THEN 1.0 ELSE 0 END) FILTER (raw <> 1) AS negative_accuracy, avg(CASE WHEN score > 0.5 THEN 1.0 ELSE 0 END) AS predicted_positive FROM s")
def per_class(spark, folder):
    hit = F.when(F.col("score") > 0.5, 1.0).otherwise(0.0)
    return stream(spark, folder).agg(F.avg(F.when(F.col("raw") == 1, hit)).alias("positive_accuracy"), F.avg(F.when(F.col("raw") != 1, 1 - hit)).alias("negative_accuracy"), F.avg(hit).alias("predicted_positive"))


@REGISTRY.add("AG57_adaptive_threshold_fallback", f"WITH {S}, {grid_sql(101)}, t AS (SELECT threshold FROM ra WHERE fah <= 0.0 AND recall > 2 ORDER BY recall DESC, fah, k LIMIT 1) SELECT coalesce((SELECT threshold FROM t), (SELECT (median(score) FILTER (y = 1) + median(score) FILTER (y = 0)) / 2 FROM s), (SELECT median(score) FROM s)) AS threshold")
def adaptive_fallback(spark, folder):
    s = stream(spark, folder)
    point = sc.rates(sc.sweep(s, sc.linspace(101)), HOURS).where((F.col("fah") <= 0.0) & (F.col("recall") > 2)).agg(F.min("threshold").alias("t"))
    mid = s.agg(((F.median(F.when(F.col("y") == 1, F.col("score"))) + F.median(F.when(F.col("y") == 0, F.col("score")))) / 2).alias("m"), F.median("score").alias("a"))
    return point.join(F.broadcast(mid)).select(F.coalesce("t", "m", "a").alias("threshold"))


@REGISTRY.add("AG60_counts_from_rates", f"WITH {S}, {grid_sql(101)} SELECT threshold, floor(recall * (tp + fn) + 0.5)::BIGINT AS tp, floor(fpr * (fp + tn) + 0.5)::BIGINT AS fp FROM ra ORDER BY abs(threshold - 0.333), k LIMIT 1")
def counts_from_rates(spark, folder):
    s = sc.pick(sc.rates(sc.sweep(stream(spark, folder), sc.linspace(101))), F.abs(F.col("threshold") - 0.333), F.col("k"))
    return s.select("threshold", F.floor(F.col("recall") * (F.col("tp") + F.col("fn")) + 0.5).alias("tp"), F.floor(F.col("fpr") * (F.col("fp") + F.col("tn")) + 0.5).alias("fp"))


@REGISTRY.add("AG61_histogram", f"""WITH {S}, m AS (SELECT min(score) AS lo, max(score) AS hi FROM s) SELECT y, least(49, floor((score - lo) / ((hi - lo) / 50)))::INT AS bucket, count(*) AS n FROM s, m GROUP BY 1, 2""")
def bucket_histogram(spark, folder):
    s = stream(spark, folder)
    lo, hi = s.agg(F.min("score"), F.max("score")).first()
    return s.groupBy("y", F.least(F.lit(49), F.floor((F.col("score") - F.lit(lo)) / F.lit((hi - lo) / 50))).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("AG63_streaming_accuracy", f"""WITH {S}, l AS (SELECT clip, arg_max(score, ts) AS score, arg_max(y, ts) AS y FROM s GROUP BY clip), {confusion_sql(0.5, True).replace('FROM s', 'FROM l')}
SELECT tp::BIGINT AS tp, fp::BIGINT AS fp, tn::BIGINT AS tn, fn::BIGINT AS fn, (tp + tn) / (tp + fp + tn + fn)::DOUBLE AS accuracy FROM c""")
def streaming_accuracy(spark, folder):
    last = stream(spark, folder).groupBy("clip").agg(F.max_by("score", "ts").alias("score"), F.max_by("y", "ts").alias("y"))
    return sc.binary_metrics(sc.confusion(last, 0.5, strict=True), zero=math.nan).select("tp", "fp", "tn", "fn", "accuracy")


@REGISTRY.add("AG64_operating_curve", f"WITH {S}, {grid_sql(100, 0.01, 0.99, False)} SELECT k, fah, recall FROM ra")
def operating_curve(spark, folder):
    return sc.rates(sc.sweep(stream(spark, folder), sc.linspace(100, 0.01, 0.99), strict=False), HOURS).select("k", "fah", "recall")


@REGISTRY.add("AG65_evaluation_report", f"""WITH {S}, {confusion_sql(0.5)}, r AS (SELECT y, score, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM s)
SELECT (SELECT count(*) FROM s) AS n, (SELECT count(*) FROM s WHERE isnan(score) OR isinf(score)) AS n_bad, round((tp + tn) / (tp + fp + tn + fn)::DOUBLE, 6) AS accuracy, round(tp / (tp + fn)::DOUBLE, 6) AS recall,
  (SELECT round((sum(rk) FILTER (y = 1) - (count(*) FILTER (y = 1)) * (count(*) FILTER (y = 1) + 1) / 2.0::DOUBLE) / ((count(*) FILTER (y = 1))::DOUBLE * count(*) FILTER (y = 0)), 6) FROM r) AS roc_auc,
  (SELECT round(avg((score - y) * (score - y)), 6) FROM s) AS brier FROM c""")
def report(spark, folder):
    """At least ten rows and finite scores only; the parts of the report side by side."""
    s = stream(spark, folder)
    bad = F.count_if(F.isnan("score") | F.col("score").isin(math.inf, -math.inf))
    guard = s.agg(F.count(F.lit(1)).alias("n"), bad.alias("n_bad"))
    n, n_bad = guard.first()
    if n < 10 or n_bad:
        raise ValueError("an evaluation needs ten rows and finite scores")
    parts = (guard, sc.binary_metrics(sc.confusion(s, 0.5)).select("accuracy", "recall"), sc.roc_auc(s), sc.brier(s))
    out = parts[0]
    for p in parts[1:]:
        out = out.join(F.broadcast(p))  # one row each
    return r6(out)
