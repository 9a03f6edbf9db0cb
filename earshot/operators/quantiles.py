"""Exact percentiles per group without holding a group's values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def exact_percentiles(df: DataFrame, groups: Sequence[str], value: str, shares: dict[str, float], accuracy: int = 1000) -> DataFrame:
    """One row per group with a column for each of `shares`: the percentile with linear interpolation between order statistics, as `percentile` has it. Nulls and NaN are no values; groups
    without values have no row; null is a group.

    A rank-bounded sketch per group brackets each wanted rank, one pass over the distinct values counts what lies below the bracket, and only distinct values within it are sorted. Should a
    bracket miss, the group is sorted whole."""
    keys = [f"_g{i}" for i in range(len(groups))]
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col(value).cast("double").alias("_v"))
    around = 2.0 / accuracy
    edges = [e for p in shares.values() for e in (max(0.0, p - around), min(1.0, p + around))]
    sketch = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", edges, accuracy * 2).alias("_e"))
    counted = rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    met = _join(counted, sketch, keys)
    brackets = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(p).alias("p"), F.element_at("_e", 2 * i + 1).alias("lo"), F.element_at("_e", 2 * i + 2).alias("hi")) for i, (name, p) in enumerate(shares.items())])
    each = met.select(*keys, "_v", "_c", "_n", F.explode(brackets).alias("b")).select(*keys, "_v", "_c", "_n", "b.*")
    # What lies below a bracket becomes one row of its sum; the value next above it is kept for ranks at the edge.
    place = F.when(F.col("_v") < F.col("lo"), 0).when(F.col("_v") <= F.col("hi"), 1).otherwise(2)
    marked = each.withColumn("_place", place).withColumn("_key", F.when(place == 1, F.col("_v")))
    few = marked.groupBy(*keys, "name", "p", "_n", "_place", "_key").agg(F.sum("_c").alias("_c"), F.min("_v").alias("_least"))
    up = Window.partitionBy(*keys, "name").orderBy("_place", "_key").rowsBetween(Window.unboundedPreceding, 0)
    ranked = few.withColumn("_cum", F.sum("_c").over(up))
    rank = (F.col("_n") - 1) * F.col("p")
    low, high = F.floor(rank), F.least(F.floor(rank) + 1, F.col("_n") - 1)
    # The first row whose running count passes a rank holds the order statistic; above the bracket it is known only if it is the least there.
    first = lambda r: F.min(F.when(F.col("_cum") > r, F.struct("_cum", "_least", "_place", "_c")))
    found = ranked.groupBy(*keys, "name", "p", "_n").agg(first(low).alias("a"), first(high).alias("b"))
    held = lambda x, r: (F.col(f"{x}._place") == 1) | ((F.col(f"{x}._place") == 2) & (F.col(f"{x}._cum") - F.col(f"{x}._c") == r))
    over = ~(held("a", low) & held("b", high))
    x, y = F.col("a._least"), F.col("b._least")
    exact = F.when(x == y, x).otherwise(x * (1 - (rank - low)) + y * (rank - low))
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == n, exact)).alias(n) for n in shares], F.max(over).alias("_miss"))
    from earshot.session import cut

    done = cut(wide, "percentiles")
    names = list(shares)
    out = done.where(~F.col("_miss")).select(*keys, *names)
    if done.where("_miss").limit(1).count():
        again = _join(counted, done.where("_miss").select(*keys), keys)
        out = out.unionByName(again.groupBy(*keys).agg(*[F.percentile("_v", F.lit(p), F.col("_c")).alias(n) for n, p in shares.items()]))
    return out.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], *names)


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join in which null keys meet."""
    if not keys:
        return left.join(F.broadcast(right))  # one row
    other = right.select(*[F.col(k).alias(f"{k}_r") for k in keys], *[c for c in right.columns if c not in keys])
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"{k}_r"))
        on = c if on is None else on & c
    return left.join(other, on).drop(*[f"{k}_r" for k in keys])
