"""Gates, plans and lookups of corpus curation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from earshot.operators.quantiles import exact_percentiles


def percentile_gate(df: DataFrame, group: str, score: str, discarded: str, share: float, least: float | None = None) -> DataFrame:
    """`df` with `gate`: the first reason to discard a row, or null.

    The cutoff of a group is the exact linear percentile of its eligible rows (not yet discarded, with a score); no group's values are held in one place. Rows at or below it are discarded, and then those below `least`. A group without eligible rows has no cutoff."""
    number = F.col(score).isNotNull() & ~F.isnan(score)
    gone = F.coalesce(F.col(discarded), F.lit(False))
    cutoffs = exact_percentiles(df.where(~gone), [group], score, {"cutoff": share}).withColumnRenamed(group, "_g")
    joined = df.join(cutoffs, F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")
    low = F.lit(False) if least is None else F.col(score) < least
    return joined.withColumn("gate", F.when(gone, "already discarded").when(number & (F.col(score) <= F.col("cutoff")), "low percentile").when(number & low, "below minimum"))


def clip_gate(clip_ratio: Column, vad: Column, most_clip: float, least_vad: float, digits: int = 2) -> Column:
    """The first reason: too much clipping, then too little speech; else null."""
    return F.when(clip_ratio > most_clip, F.format_string(f"clipping %.{digits}f%% > %.{digits}f%%", clip_ratio * 100, F.lit(most_clip * 100))).when(vad < least_vad, F.format_string(f"vad %.{digits}f < %.{digits}f", vad, F.lit(least_vad)))


def issues(*checks: tuple[Column, str]) -> Column:
    """The messages of all checks that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(m)) for c, m in checks]))


def lookup(df: DataFrame, path: Column, table: DataFrame, table_path: str, value: str, fallback: Sequence[Column] = ()) -> DataFrame:
    """`df` with `value` by exact path, else by file name where the name is unambiguous in the table, else the first fallback that isn't null."""
    base = lambda c: F.regexp_extract(c, r"([^/]*)$", 1)
    exact = table.groupBy(F.col(table_path).alias("_p")).agg(F.min(value).alias("_v1"))
    # Names of several paths or values are ambiguous.
    by_name = table.groupBy(base(F.col(table_path)).alias("_b")).agg(F.count_distinct(table_path).alias("_n"), F.min(value).alias("_v2")).where("_n = 1").drop("_n")
    out = df.withColumn("_path", path).join(exact, F.col("_path") == F.col("_p"), "left").withColumn("_name", base(F.col("_path"))).join(by_name, F.col("_name") == F.col("_b"), "left")
    return out.withColumn(value, F.coalesce("_v1", "_v2", *fallback)).drop("_path", "_p", "_v1", "_name", "_b", "_v2")


def move_plan(df: DataFrame, source: Column, root: str, folder: Column) -> DataFrame:
    """(src, dst): what a move would do; carrying it out is the caller's. `undo` is the same with the sides swapped."""
    return df.select(source.alias("src"), F.concat_ws("/", F.lit(root), folder, F.regexp_extract(source, r"([^/]*)$", 1)).alias("dst"))


def undo_plan(plan: DataFrame) -> DataFrame:
    return plan.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def keep_first(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The first row per key in an order; null keys are no duplicates of each other. Rows are reduced to a minimum map-side, so a key of many copies is no load."""
    keyed = df.withColumn("_key", key)
    first = keyed.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.min_by(F.struct(*df.columns), F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])).alias("_row"))
    return first.select("_row.*").unionByName(keyed.where(F.col("_key").isNull()).select(*df.columns))


def overlap(df: DataFrame, key: Column, split: str) -> DataFrame:
    """(key, n_splits, n_rows) of the keys that lie in more than one split, null keys and splits aside; one shuffle."""
    known = df.select(key.alias("key"), F.col(split).alias("split")).where("key IS NOT NULL AND split IS NOT NULL")
    each = known.groupBy("key", "split").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.count(F.lit(1)).alias("n_splits"), F.sum("n").alias("n_rows"))
    return each.where("n_splits > 1")


def top_share(df: DataFrame, hits: Column, share: float, *order: Column) -> DataFrame:
    """The first max(1, floor(share x all rows)) of the rows that are hits, in an order."""
    n = df.count()
    return df.where(hits).orderBy(*order).limit(max(1, int(n * share)))


def top_per_group(df: DataFrame, groups: Sequence[str], k: int, *order: Column) -> DataFrame:
    """The first k rows of each group in an order (Spark keeps k per group and task before it shuffles)."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")
