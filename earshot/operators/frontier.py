"""Skyline, hypervolume and best-candidate selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from earshot.session import cut


def skyline(df: DataFrame, low: str, *high: str, alone: int = 20_000) -> DataFrame:
    """The rows that no row dominates: none has `low` no larger and all of `high` no smaller, with one of them better. Equal rows stay together; rows with nulls are left out.

    For one `high` a running maximum over bucket totals does (no pairs). For more, each partition is first reduced to its own skyline, so that only those rows, few against all, are compared
    with each other, by ranges where there are more than `alone`."""
    known = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (low, *high)))
    if len(high) == 1:
        return _skyline_2d(known, low, high[0])
    local = known.mapInPandas(lambda batches: _local(batches, low, high), known.schema)
    return _merged(cut(local, "front"), low, high, alone)


def _merged(front: DataFrame, low: str, high: tuple[str, ...], alone: int) -> DataFrame:
    """The skyline of skylines of partitions: in one task up to `alone` rows, else by ranges of `low`.

    A row can only be dominated from its own range or a lower one, and by a range only if the corner of that range's bounds dominates the lowest bounds of the row's; rows visit just those."""
    n = front.count()
    if n <= alone:
        return front.coalesce(1).mapInPandas(lambda batches: _local(batches, low, high), front.schema)
    k = -(-n // alone)
    edges = sorted(set(front.approxQuantile(low, [i / k for i in range(1, k)], 0.2 / k)))
    ranged = front.withColumn("_range", sum((F.when(F.col(low) > e, 1).otherwise(0) for e in edges), F.lit(0)))
    bounds = ranged.groupBy("_range").agg(F.max(low), *[f(c) for c in high for f in (F.min, F.max)]).orderBy("_range").collect()  # a row per range
    visits = {r[0]: [o[0] for o in bounds if o[0] >= r[0] and all(r[2 * i + 3] >= o[2 * i + 2] for i in range(len(high)))] for r in bounds}
    to = F.create_map(*[x for r, t in visits.items() for x in (F.lit(r), F.array(*map(F.lit, t)))])
    sent = ranged.withColumn("_to", F.explode(F.element_at(to, F.col("_range"))))
    schema = front.schema

    def survivors(pdf):
        here = pdf["_range"] == pdf["_to"]
        kept = _dominant(pdf, low, high)
        return pdf[here & kept][schema.names]

    return sent.groupBy("_to").applyInPandas(survivors, schema)


def _skyline_2d(known: DataFrame, low: str, high: str) -> DataFrame:
    best = known.groupBy(F.col(low).alias("_x")).agg(F.max(high).alias("_y"))
    # Partitioned by ranges of x; the best of lower ranges is carried in as one number a range.
    n = 64
    edges = sorted(set(best.approxQuantile("_x", [i / n for i in range(1, n)], 0.002)))
    bucket = F.lit(0)
    for e in edges:
        bucket = bucket + F.when(F.col("_x") > e, 1).otherwise(0)
    b = best.withColumn("_b", bucket)
    tops = b.groupBy("_b").agg(F.max("_y").alias("_t"))
    before = tops.select("_b", F.max("_t").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))  # a row per range
    w = Window.partitionBy("_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    keep = b.join(F.broadcast(before), "_b").withColumn("_m", F.greatest(F.max("_y").over(w), F.col("_before"))).where(F.col("_m").isNull() | (F.col("_y") > F.col("_m"))).select("_x", "_y")
    return known.join(keep, (F.col(low) == F.col("_x")) & (F.col(high) == F.col("_y"))).drop("_x", "_y")


def _dominant(pdf, low: str, high: tuple[str, ...]):
    """Which rows no other dominates, by blocks of rows in the order of falling sums, so that what dominates comes first."""
    import numpy as np

    points = np.column_stack([-pdf[low].to_numpy(float), *(pdf[c].to_numpy(float) for c in high)])
    unique, back = np.unique(points, axis=0, return_inverse=True)
    order = np.argsort(-unique.sum(1), kind="stable")
    front = np.zeros((0, points.shape[1]))
    kept = np.zeros(len(unique), bool)
    for at in range(0, len(order), 256):
        some = order[at : at + 256]
        x = unique[some]
        beaten = np.zeros(len(x), bool)
        for lo in range(0, len(front), 8192):
            left = np.flatnonzero(~beaten)
            beaten[left] = (front[None, lo : lo + 8192] >= x[left, None]).all(2).any(1)
        left = np.flatnonzero(~beaten)
        y = x[left]
        inside = (y[None, :] >= y[:, None]).all(2)
        np.fill_diagonal(inside, False)
        good = left[~inside.any(1)]
        kept[some[good]] = True
        front = np.concatenate([front, x[good]])
    return kept[back.ravel()]


def _local(batches, low: str, high):
    import pandas as pd

    kept = None
    for pdf in batches:
        kept = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
        kept = kept[_dominant(kept, low, high)]
    if kept is not None:
        yield kept


def hypervolume(points: DataFrame, x: str, y: str, ref_x: float, ref_y: float) -> DataFrame:
    """One row: the area between the points of low x and high y and the reference; 0 without points
    strictly inside."""
    # Only the front counts, so the window is over its points, few against all.
    kept = points.select(x, y).where((F.col(x) < ref_x) & (F.col(y) > ref_y))
    front = skyline(kept, x, y)
    inside = front.select((F.lit(ref_x) - F.col(x)).alias("a"), (F.col(y) - F.lit(ref_y)).alias("b")).groupBy("a").agg(F.max("b").alias("b"))
    w = Window.orderBy(F.desc("a"))
    swept = inside.select("a", F.max("b").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("h"), F.coalesce(F.lead("a").over(w), F.lit(0.0)).alias("next"))
    return swept.agg(F.coalesce(F.sum((F.col("a") - F.col("next")) * F.col("h")), F.lit(0.0)).alias("hypervolume"))


def best_candidate(df: DataFrame, fah: str, recall: str, target_fah: float, target_recall: float, *tie: Column) -> DataFrame:
    """The row of most recall among those that meet both targets; if none does, the one of least 2 x relative excess of fah + relative deficit of recall."""
    meets = (F.col(fah) <= target_fah) & (F.col(recall) >= target_recall)
    far = 2.0 * F.greatest(F.lit(0.0), F.col(fah) - target_fah) / max(target_fah, 1e-8) + F.greatest(F.lit(0.0), F.lit(target_recall) - F.col(recall)) / max(target_recall, 1e-8)
    return df.orderBy(F.when(meets, 0).otherwise(1), F.when(meets, -F.col(recall)).otherwise(far), *tie).limit(1)


def prune_by_crowding(rows: list[dict], most: int, low: str, *high: str) -> list[dict]:
    """A bounded archive, at most a few hundred rows on the driver, less its most crowded members until `most` are left."""
    rows = list(rows)
    while len(rows) > most:
        distance = [0.0] * len(rows)
        for c in (low, *high):
            order = sorted(range(len(rows)), key=lambda i: (rows[i][c], i))
            span = rows[order[-1]][c] - rows[order[0]][c]
            distance[order[0]] = distance[order[-1]] = float("inf")
            if span > 1e-12:
                for k in range(1, len(rows) - 1):
                    distance[order[k]] += (rows[order[k + 1]][c] - rows[order[k - 1]][c]) / span
        rows.pop(min(range(len(rows)), key=lambda i: (distance[i], i)))
    return rows
