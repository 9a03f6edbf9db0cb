"""Reductions of score streams: rows of a score, a 0/1 label and perhaps a weight.

Sweeps never cross rows with thresholds: a row is mapped to the number of thresholds it passes, rows are counted by that number (a partial sum per task), and running totals over the
few thresholds give all counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

NAN = float("nan")


def linspace(n: int, low: float = 0.0, high: float = 1.0) -> list[float]:
    """n even steps as k times the step, which both engines compute alike."""
    if n < 2:
        return [low]
    step = (high - low) / (n - 1)
    return [low + k * step for k in range(n)]


def ratio(a: Column, b: Column, zero: float | None = 0.0) -> Column:
    """a / b, and `zero` where b is 0."""
    return F.when(b == 0, F.lit(zero).cast("double")).otherwise(a / b)


def confusion(df: DataFrame, threshold: float, *, score: str = "score", label: str = "y", strict: bool = False, weight: str | None = None) -> DataFrame:
    """One row of tp, fp, tn, fn. Null scores or labels count nowhere; without rows all are 0."""
    hit = F.col(score) > threshold if strict else F.col(score) >= threshold
    w = F.col(weight) if weight else F.lit(1)
    part = lambda c: F.coalesce(F.sum(F.when(c, w)), F.lit(0))
    pos = F.col(label) == 1
    return df.agg(part(hit & pos).alias("tp"), part(hit & ~pos).alias("fp"), part(~hit & ~pos).alias("tn"), part(~hit & pos).alias("fn"))


def binary_metrics(counts: DataFrame, zero: float | None = 0.0, eps: float = 0.0) -> DataFrame:
    """tp, fp, tn, fn and what follows from them; 0 / 0 is `zero` (0.0, or NaN in the other convention)."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    r = lambda a, b: ratio(a, b, zero)
    recall, spec, prec = r(tp, tp + fn), r(tn, tn + fp), r(tp, tp + fp)
    npv = r(tn, tn + fn)
    agree = r(tp + tn, n)
    chance = r((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    lr_pos, lr_neg = ratio(recall, 1 - spec, zero), ratio(1 - recall, spec, zero)
    return counts.select(
        "*", agree.alias("accuracy"), prec.alias("precision"), recall.alias("recall"), r(2 * tp, 2 * tp + fp + fn).alias("f1"), spec.alias("specificity"), npv.alias("npv"), (r(fp, fp + tn)).alias("fpr"), r(fn, fn + tp).alias("fnr"),
        ((recall + spec) / 2).alias("balanced_accuracy"), (recall + spec - 1).alias("informedness"), (prec + npv - 1).alias("markedness"),
        r(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))).alias("mcc"), r(agree - chance, 1 - chance).alias("kappa"), lr_pos.alias("lr_pos"), lr_neg.alias("lr_neg"), ratio(lr_pos, lr_neg, zero).alias("dor"),
    )


def _passed(df: DataFrame, thresholds: Sequence[float], score: str, strict: bool) -> DataFrame:
    """`df` with the number of thresholds that the score passes. NaN and null pass none."""
    edges = [math.nextafter(t, math.inf) if strict else t for t in thresholds]
    if any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError("thresholds must rise")
    clean = df.withColumn("_score", F.when(F.isnan(score), None).otherwise(F.col(score).cast("double")))
    return Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol="_score", outputCol="_passed", handleInvalid="keep").transform(clean).withColumn("_passed", F.when(F.col("_score").isNull(), 0).otherwise(F.col("_passed").cast("int"))).drop("_score")


def sweep(df: DataFrame, thresholds: Sequence[float], *, score: str = "score", label: str = "y", strict: bool = True, weight: str | None = None) -> DataFrame:
    """(k, threshold, tp, fp, tn, fn) of each of the rising `thresholds`. Null labels count nowhere."""
    spark = df.sparkSession
    w = F.col(weight) if weight else F.lit(1)
    zero = F.lit(0.0 if weight else 0).cast("double" if weight else "bigint")
    counted = _passed(df.where(F.col(label).isNotNull()), thresholds, score, strict).groupBy("_passed").agg(F.coalesce(F.sum(F.when(F.col(label) == 1, w)), zero).alias("p"), F.coalesce(F.sum(F.when(F.col(label) != 1, w)), zero).alias("n"))
    grid = spark.createDataFrame([(k, None if k == 0 else float(thresholds[k - 1])) for k in range(len(thresholds) + 1)], "_passed int, threshold double")
    full = grid.join(F.broadcast(counted), "_passed", "left").select("_passed", "threshold", F.coalesce("p", zero).alias("p"), F.coalesce("n", zero).alias("n"))
    # A row per threshold: one task is right.
    above = Window.orderBy(F.desc("_passed")).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.orderBy("_passed").rowsBetween(Window.unboundedPreceding, -1)
    s = full.select("_passed", "threshold", F.sum("p").over(above).alias("tp"), F.sum("n").over(above).alias("fp"), F.coalesce(F.sum("n").over(below), zero).alias("tn"), F.coalesce(F.sum("p").over(below), zero).alias("fn"))
    return s.where(F.col("_passed") > 0).select((F.col("_passed") - 1).alias("k"), "threshold", "tp", "fp", "tn", "fn")


def rates(swept: DataFrame, hours: float | None = None, zero_hours: float = math.inf) -> DataFrame:
    """recall, fpr, precision and, given hours, false alarms per hour of a sweep. No hours give `zero_hours`."""
    out = swept.withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn"))).withColumn("fpr", ratio(F.col("fp"), F.col("fp") + F.col("tn"))).withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp")))
    if hours is None:
        return out
    if hours < 0:
        raise ValueError("hours can't be negative")
    return out.withColumn("fah", F.col("fp") / F.lit(float(hours)) if hours > 0 else F.lit(float(zero_hours)))


def pick(df: DataFrame, *order: Column) -> DataFrame:
    """The first row in an order, as a top-1."""
    return df.orderBy(*order).limit(1)


def recall_at_no_false_alarm(swept: DataFrame) -> DataFrame:
    """(threshold, recall): the lowest threshold without a false alarm, else the highest."""
    s = rates(swept)
    return pick(s, F.when(F.col("fp") == 0, 0).otherwise(1), F.when(F.col("fp") == 0, F.col("k")).otherwise(-F.col("k"))).select("threshold", "recall")


def recall_at_target_fah(swept: DataFrame, hours: float, target: float) -> DataFrame:
    """(threshold, recall, fah): the most recall with fah <= target; ties by less fah, then the first threshold. If none is feasible: the last threshold, 0, infinity."""
    s = rates(swept, hours)
    ok = F.col("fah") <= target
    best = pick(s, F.when(ok, 0).otherwise(1), F.when(ok, -F.col("recall")), F.when(ok, F.col("fah")), F.when(ok, F.col("k")).otherwise(-F.col("k")))
    return best.select("threshold", F.when(ok, F.col("recall")).otherwise(0.0).alias("recall"), F.when(ok, F.col("fah")).otherwise(math.inf).alias("fah"))


def fah_at_target_recall(swept: DataFrame, hours: float, target: float) -> DataFrame:
    """(threshold, recall, fah): the highest threshold with recall >= target. If none: the last threshold, 0, infinity."""
    s = rates(swept, hours)
    ok = F.col("recall") >= target
    best = pick(s, F.when(ok, 0).otherwise(1), F.desc("k"))
    return best.select("threshold", F.when(ok, F.col("recall")).otherwise(0.0).alias("recall"), F.when(ok, F.col("fah")).otherwise(math.inf).alias("fah"))


def faph_points(swept: DataFrame, hours: float, most: float, compat: bool = False) -> DataFrame:
    """(faph, frr): false rejections over false accepts per hour up to `most`, in which a point at `most` is put between its neighbours, of repeated rates the first threshold's point counts,
    and (0, 1) is added where no threshold reaches 0.

    `compat` repeats what the older form of this curve does at `most`: both neighbours have the rejections of the one beyond, and 2.0 stands for `most` in the interpolation."""
    s = rates(swept, hours).select("k", F.col("fah").alias("faph"), (1 - F.col("recall")).alias("frr"))
    w = Window.orderBy("k")  # a row per threshold
    near = s.select("k", "faph", "frr", F.lag("faph").over(w).alias("x0"), F.lag("frr").over(w).alias("y0")).where(F.col("faph") <= most)
    first = near.orderBy("k").limit(1)
    y1, at = (F.col("y0"), 2.0) if compat else (F.col("frr"), most)
    between = (F.col("y0") * (F.col("faph") - at) + y1 * (at - F.col("x0"))) / (F.col("faph") - F.col("x0"))
    edge = first.select(F.lit(-1).alias("k"), F.lit(float(most)).alias("faph"), F.when(F.col("x0").isNull(), F.col("frr")).otherwise(between).alias("frr"))
    inner = near.groupBy("faph").agg(F.min_by("frr", "k").alias("frr"), F.min("k").alias("k")).where(F.col("faph") != most).select("k", "faph", "frr")
    points = edge.unionByName(inner)
    end = points.agg(F.min("faph").alias("m")).where("m > 0").select(F.lit(0.0).alias("faph"), F.lit(1.0).alias("frr"))
    return points.select("faph", "frr").unionByName(end)


def trapezoid(df: DataFrame, x: str, y: str, *order: Column) -> Column:
    """The area under y over x as a window expression to sum up."""
    w = Window.orderBy(*order)
    return (F.col(x) - F.lag(x).over(w)) * (F.col(y) + F.lag(y).over(w)) / 2


def area(df: DataFrame, x: str, y: str, *order: Column, name: str = "area") -> DataFrame:
    """One row with the trapezoid area; fewer than two points give 0."""
    return df.select(trapezoid(df, x, y, *order).alias("_a")).agg(F.coalesce(F.sum("_a"), F.lit(0.0)).alias(name))


def average_viable_recall(swept: DataFrame, hours: float, max_fah: float) -> DataFrame:
    """The area of recall over fah / max_fah, for fah <= max_fah, in order of fah and then recall; no hours count as fah 0."""
    s = rates(swept, hours, zero_hours=0.0).where(F.col("fah") <= max_fah).withColumn("x", F.col("fah") / max_fah)
    return area(s, "x", "recall", F.col("x"), F.col("recall"), name="average_viable_recall")


def histogram(df: DataFrame, *, score: str = "score", label: str = "y") -> DataFrame:
    """(score, pos, neg): positives and negatives by distinct score."""
    rows = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    return rows.groupBy(F.col(score).alias("score")).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))


def running_totals(df: DataFrame, order: str, sums: Sequence[str], *, descending: bool = False, buckets: int = 1024) -> DataFrame:
    """`df` with `<name>_before`: the total of each of `sums` over rows before this one in the order of the distinct values of `order`.

    Not one global sort: rows are bucketed by the quantiles of `order`, buckets are totalled (`buckets` rows at most), and only rows of a bucket are sorted together."""
    edges = sorted(set(df.approxQuantile(order, [i / buckets for i in range(1, buckets)], 1.0 / (4 * buckets)))) if buckets > 1 else []
    if edges:
        cut_at = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol="_o", outputCol="_bucket").transform(df.withColumn("_o", F.col(order).cast("double"))).drop("_o")
    else:
        cut_at = df.withColumn("_bucket", F.lit(0.0))
    way = F.desc if descending else F.asc
    totals = cut_at.groupBy("_bucket").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    w0 = Window.orderBy(way("_bucket")).rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket
    before = totals.select("_bucket", *[F.coalesce(F.sum(f"_{c}").over(w0), F.lit(0)).alias(f"_{c}_base") for c in sums])
    w = Window.partitionBy("_bucket").orderBy(way(order)).rowsBetween(Window.unboundedPreceding, -1)
    out = cut_at.join(F.broadcast(before), "_bucket")
    return out.select(*df.columns, *[(F.coalesce(F.sum(c).over(w), F.lit(0)) + F.col(f"_{c}_base")).alias(f"{c}_before") for c in sums])


def roc_auc(df: DataFrame, *, score: str = "score", label: str = "y") -> DataFrame:
    """The probability that a positive outscores a negative, ties as half; 0.5 for one class."""
    h = running_totals(histogram(df, score=score, label=label), "score", ["neg"])
    s = h.agg(F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)).alias("u"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return s.select(F.coalesce(F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("u") / (F.col("p").cast("double") * F.col("n"))), F.lit(0.5)).alias("roc_auc"))


def average_precision(df: DataFrame, *, score: str = "score", label: str = "y") -> DataFrame:
    """The sum of precision times gained recall at distinct scores from above; labels other than 0 and 1 are dropped; null for one class."""
    h = running_totals(histogram(df.where(F.col(label).isin(0, 1)), score=score, label=label), "score", ["pos", "neg"], descending=True)
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    s = h.agg(F.sum(F.col("pos") * tp / (tp + fp)).alias("a"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return s.select(F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("a") / F.col("p")).alias("average_precision"))


def calibration_curve(df: DataFrame, bins: int = 10, *, score: str = "score", label: str = "y") -> DataFrame:
    """(bin, count, mean_score, observed) of all bins, right-closed, 0 in the first; empty bins have zeros. Scores outside 0..1 or labels other than 0 and 1 raise."""
    if df.where(~F.col(score).between(0, 1) | ~F.col(label).isin(0, 1)).limit(1).count():
        raise ValueError("scores must lie in 0..1 and labels be 0 or 1")
    inner = linspace(bins + 1)[1:-1]
    binned = _passed(df, inner, score, strict=True) if inner else df.withColumn("_passed", F.lit(0))
    got = binned.groupBy("_passed").agg(F.count(score).alias("count"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("observed"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    z = F.lit(0.0)
    return grid.join(F.broadcast(got), F.col("bin") == F.col("_passed"), "left").select("bin", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("mean_score", z).alias("mean_score"), F.coalesce("observed", z).alias("observed"))


def calibration_errors(curve: DataFrame) -> DataFrame:
    """(ece, mce) of a calibration curve; no rows give 0."""
    gap = F.abs(F.col("mean_score") - F.col("observed"))
    return curve.agg(F.coalesce(F.sum(gap * F.col("count")) / F.nullif(F.sum("count"), F.lit(0)), F.lit(0.0)).alias("ece"), F.coalesce(F.max(F.when(F.col("count") > 0, gap)), F.lit(0.0)).alias("mce"))


def expected_calibration_error(df: DataFrame, bins: int = 15, *, score: str = "score", label: str = "y") -> DataFrame:
    """ECE over left-closed bins, the last closed; no rows give 0."""
    inner = linspace(bins + 1)[1:-1]
    got = _passed(df, inner, score, strict=False).groupBy("_passed").agg(F.count(score).alias("count"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("observed"))
    return calibration_errors(got).select("ece")


def brier(df: DataFrame, *, score: str = "score", label: str = "y") -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def adaptive_grid(df: DataFrame, *, score: str = "score", most_unique: int = 333, most: int = 1000, eps: float = 1e-7) -> DataFrame:
    """(k, threshold): distinct scores, thinned evenly to `most_unique`, each less and more eps, and 0 and 1, within 0..1; distinct and thinned evenly to `most`."""
    unique = decimate(df.where(F.col(score).isNotNull()).select(F.col(score).alias("t")).distinct(), "t", most_unique)
    both = unique.select(F.explode(F.array(F.col("t") - eps, F.col("t"), F.col("t") + eps, F.lit(0.0), F.lit(1.0))).alias("t"))
    clipped = both.select(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("t"))).alias("t")).distinct()
    return decimate(clipped, "t", most).select((F.row_number().over(Window.orderBy("t")) - 1).alias("k"), F.col("t").alias("threshold"))


def decimate(df: DataFrame, order: str, most: int) -> DataFrame:
    """At most `most` rows: those at the places floor(i (n - 1) / (most - 1)) in order."""
    n = df.count()
    if n <= most:
        return df
    ranked = running_totals(df.withColumn("_one", F.lit(1)), order, ["_one"])
    place = df.sparkSession.range(most).select(F.floor(F.col("id") * F.lit(n - 1) / F.lit(max(1, most - 1))).alias("_place")).distinct()
    return ranked.join(F.broadcast(place), F.col("_one_before") == F.col("_place"), "left_semi").select(*df.columns)


def bootstrap(df: DataFrame, replicates: int, threshold: float, *, score: str = "score", label: str = "y", seed: int = 42) -> DataFrame:
    """(metric, mean, std, low, high): 95 % intervals of recall, precision and F1 by the Poisson bootstrap.

    Were each row's weight in a replicate Poisson(1), a cell of the confusion matrix with n rows would weigh Poisson(n). So the rows are counted once, and only the four counts are drawn anew.
    Rows without a score or label take no part."""
    import numpy as np

    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    hit, real = F.col(score) >= threshold, F.col(label) == 1
    cells = known.agg(F.count_if(hit & real), F.count_if(hit & ~real), F.count_if(~hit & ~real), F.count_if(~hit & real)).first()
    drawn = np.random.default_rng(seed).poisson([max(0, n) for n in cells], (replicates, 4))
    counts = df.sparkSession.createDataFrame([(b, *map(int, r)) for b, r in enumerate(drawn)], "b int, tp bigint, fp bigint, tn bigint, fn bigint")
    m = binary_metrics(counts).select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("v")) for n in ("recall", "precision", "f1")])).alias("x")).select("x.*")
    q = lambda p: F.percentile("v", F.lit(p))
    return m.groupBy("metric").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), q(0.025).alias("low"), q(0.975).alias("high"))
