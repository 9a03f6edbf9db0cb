"""Per-key results without a task per hot key: aggregation in two stages, salted for heavy keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Agg:
    """One result column. kind: count, sum, min, max, avg, distinct (exact) or top (the `k` largest values, descending)."""

    name: str
    kind: str
    column: str | None = None
    k: int = 0


KINDS = ("count", "sum", "min", "max", "avg", "distinct", "top")


def heavy_keys(df: DataFrame, key: str, share: float) -> list:
    """The keys, null included, of at least `share` of all rows, and maybe some of little less, most rows first. There are at most about 1 / share of them, so they fit the driver at any size."""
    return heavy_and_total(df, key, share)[0]


def heavy_and_total(df: DataFrame, key: str, share: float) -> tuple[list, int]:
    """(`heavy_keys`, the number of all rows) by one pass that shuffles only sketches.

    A sketch of 20 / share frequent items counts no key too low, and too high by less than a fifth of `share` of all rows, so no heavy key is missed."""
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    tracked = min(1_000_000, int(20 / share) + 1)
    row = df.select(F.col(key).alias("key")).agg(F.expr(f"approx_top_k(key, {min(tracked, int(2 / share) + 1)}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [x["item"] for x in row["top"] or [] if x["count"] >= row["n"] * share], row["n"]


def _salt(key: str, spread: Sequence[Column], heavy: list, salts: int) -> Column:
    """The salt of a heavy key's row comes from a hash of the row, so that a task that runs again salts alike."""
    some = [k for k in heavy if k is not None]
    hot = (F.col(key).isin(some) if some else F.lit(False)) | (F.col(key).isNull() if None in heavy else F.lit(False))
    return F.when(F.coalesce(hot, F.lit(False)), F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(F.lit(0)).cast("int")


def salted_aggregate(df: DataFrame, key: str, aggs: Sequence[Agg], *, salt_by: Sequence[str], heavy_share: float = 0.01, salts: int = 64, heavy: list | None = None) -> DataFrame:
    """One row per key with `aggs`, in two stages.

    Rows of heavy keys (at least `heavy_share` of all rows, or those given as `heavy`) get one of `salts` salts from a hash of the columns `salt_by`, partial results are made
    per (key, salt), and these are merged per key: no task gets more than a salt's part of a key. The columns under `distinct` are salted by the value instead: equal values
    meet, and the counts of the salts add up.
    The null key is a key like any other; nulls are no values. Without rows there is no result row; `distinct` of no values is 0, `top` an empty array, other kinds null.
    Columns of `df` that aren't named play no part, whatever they are called."""
    for a in aggs:
        if a.kind not in KINDS or (a.column is None) != (a.kind == "count") or (a.kind == "top" and a.k < 1):
            raise ValueError(f"bad aggregate {a}")
    if heavy is None:
        heavy = heavy_keys(df, key, heavy_share)
    simple, distinct = [a for a in aggs if a.kind not in ("distinct",)], [a for a in aggs if a.kind == "distinct"]

    partial, merged = [F.count(F.lit(1)).alias("_n")], []
    for i, a in enumerate(simple):
        c = F.col(a.column) if a.column else None
        if a.kind == "count":
            merged.append(F.sum("_n").alias(a.name))
        elif a.kind == "avg":
            partial += [F.sum(c).alias(f"_s{i}"), F.count(c).alias(f"_c{i}")]
            merged.append((F.sum(f"_s{i}") / F.nullif(F.sum(f"_c{i}"), F.lit(0))).alias(a.name))
        elif a.kind == "top":
            continue
        else:
            f = {"sum": F.sum, "min": F.min, "max": F.max}[a.kind]
            partial.append(f(c).alias(f"_v{i}"))
            merged.append(f(f"_v{i}").alias(a.name))
    salted = df.withColumn("_salt", _salt(key, [F.col(c) for c in salt_by], heavy, salts))
    out = salted.groupBy(F.col(key).alias("_key"), "_salt").agg(*partial).groupBy("_key").agg(*merged, F.sum("_n").alias("_rows"))

    def add(out: DataFrame, more: DataFrame, name: str, default: Column) -> DataFrame:
        more = more.withColumnRenamed("_key", "_other")
        return out.join(more, F.col("_key").eqNullSafe(F.col("_other")), "left").drop("_other").withColumn(name, F.coalesce(F.col(name), default))

    for a in distinct:
        pairs = df.where(F.col(a.column).isNotNull()).select(F.col(key).alias("_key"), F.col(a.column).alias("_v")).distinct()
        each = pairs.withColumn("_salt", _salt("_key", [F.col("_v")], heavy, salts)).groupBy("_key", "_salt").agg(F.count(F.lit(1)).alias("_d"))
        out = add(out, each.groupBy("_key").agg(F.sum("_d").alias(a.name)), a.name, F.lit(0).cast("bigint"))
    for a in (x for x in simple if x.kind == "top"):
        kind = df.schema[a.column].dataType
        cap = lambda c, k=a.k: F.slice(F.sort_array(c, asc=False), 1, k)
        # Equal values are counted first, so a stage holds distinct values only; each salt keeps its k largest.
        counted = salted.where(F.col(a.column).isNotNull()).groupBy(F.col(key).alias("_key"), "_salt", F.col(a.column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        from pyspark.sql import Window

        rank = Window.partitionBy("_key", "_salt").orderBy(F.desc("_v"))
        kept = counted.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= a.k)
        lists = kept.select("_key", F.explode(F.array_repeat(F.col("_v"), F.least(F.col("_n"), F.lit(a.k)).cast("int"))).alias("_v")).groupBy("_key").agg(cap(F.collect_list("_v")).alias(a.name))
        out = add(out, lists, a.name, F.array().cast("array<" + kind.simpleString() + ">"))
    return out.select(F.col("_key").alias(key), *[a.name for a in aggs])


def keys_above(df: DataFrame, key: str, share_of: int, *, salt_by: Sequence[str]) -> DataFrame:
    """(key, n_rows) of the keys, null aside, that hold at least one in `share_of` of all rows of `df`: one pass for the sketch, one for the salted counts.

    Null keys count among all rows. An empty table gives no row."""
    heavy, total = heavy_and_total(df, key, 0.01)
    counts = salted_aggregate(df, key, [Agg("n_rows", "count")], salt_by=salt_by, heavy=heavy)
    return counts.where(F.col(key).isNotNull() & (F.col("n_rows") * share_of >= total))
