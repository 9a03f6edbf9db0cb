"""Deterministic splits, samples and orders: what a generator's stream does elsewhere is a hash of the row here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from earshot.operators.scores import running_totals
from earshot.session import cut

SPAN = 2**52


def draw(*columns: Column) -> Column:
    """A whole number from 0 to 2^52 - 1 by the MD5 of the columns' text, the same in any engine."""
    return F.conv(F.left(F.md5(F.concat_ws(":", *[c.cast("string") for c in columns])), F.lit(13)), 16, 10).cast("bigint")


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return draw(*columns) / float(SPAN)


def group_split(df: DataFrame, group: str, row_id: str, train: float, val: float, seed: int = 42) -> DataFrame:
    """`df` with `assigned`: groups in the order of a hash, the first floor(n train) to train, the next floor(n val) to val, the rest to test; rows without a group are split likewise by themselves.

    The order is found by counts of hash buckets and a rank within the bucket, so no task sorts all groups."""
    keyed = df.withColumn("_k", F.coalesce(F.concat(F.lit("g"), F.col(group).cast("string")), F.concat(F.lit("r"), F.col(row_id).cast("string")))).withColumn("_own", F.col(group).isNull())
    groups = keyed.select("_k", "_own").distinct().withColumn("_h", F.md5(F.concat("_k", F.lit(f":{seed}")))).withColumn("_b", F.left("_h", F.lit(3)))
    sizes = groups.groupBy("_own", "_b").agg(F.count(F.lit(1)).alias("_n"))  # 4,096 rows a kind
    before = Window.partitionBy("_own").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(F.col("_own").alias("_o2"), F.col("_b").alias("_b2"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), F.sum("_n").over(Window.partitionBy("_own")).alias("_total"))
    rank = F.row_number().over(Window.partitionBy("_own", "_b").orderBy("_h", "_k")) - 1
    placed = groups.withColumn("_r", rank).join(F.broadcast(base), (F.col("_own") == F.col("_o2")) & (F.col("_b") == F.col("_b2")))
    i, n = F.col("_r") + F.col("_base"), F.col("_total")
    split = F.when(i < F.floor(n * F.lit(train)), "train").when(i < F.floor(n * F.lit(train)) + F.floor(n * F.lit(val)), "val").otherwise("test")
    return keyed.join(placed.select("_k", split.alias("assigned")), "_k").drop("_k", "_own")


def greedy_bins(sizes: list[tuple[str, int]], bins: int) -> dict[str, int]:
    """Groups, the largest first, each to the least filled bin."""
    fill, out = [0] * bins, {}
    for g, n in sorted(sizes, key=lambda x: (-x[1], x[0])):
        b = min(range(bins), key=lambda i: (fill[i], i))
        out[g] = b
        fill[b] += n
    return out


def five_way(df: DataFrame, group: str, *, parts: tuple[tuple[str, int], ...] = (("calibration", 2), ("representative", 1), ("confirm", 3), ("train", 10), ("eval", 4)), fine: int = 20_000) -> DataFrame:
    """`df` with `part`: groups in bins of like size by greedy filling, bins to parts by number. The null group is a group like others.

    Groups of less than one in `fine` of all rows are bundled by a hash into `fine` bundles, so that at most twice as many sizes go to the driver."""
    key = F.coalesce(F.concat(F.lit("g"), F.col(group).cast("string")), F.lit("n"))
    sizes = cut(df.groupBy(key.alias("_g")).agg(F.count(F.lit(1)).alias("_n")), "sizes")
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    bundled = sizes.withColumn("_bundle", F.when(F.col("_n") * fine >= total, F.col("_g")).otherwise(F.concat(F.lit("b"), F.pmod(draw(F.col("_g")), F.lit(fine)).cast("string"))))
    names = [name for name, k in parts for _ in range(k)]
    of = greedy_bins([(r["_bundle"], r["n"]) for r in bundled.groupBy("_bundle").agg(F.sum("_n").alias("n")).collect()], len(names))  # 2 x `fine` rows at most
    chosen = df.sparkSession.createDataFrame([(g, names[b]) for g, b in of.items()], "_b string, part string")
    parted = bundled.join(F.broadcast(chosen), F.col("_bundle") == F.col("_b")).select("_g", "part")
    return df.withColumn("_k", key).join(parted, F.col("_k") == F.col("_g")).drop("_k", "_g")


def shuffled(df: DataFrame, row_id: str, epoch: int, seed: int = 42) -> DataFrame:
    """`df` with `place`, its place from 0 on in an order by hash that differs by epoch. No task sorts all rows."""
    return _placed(df, draw(F.col(row_id), F.lit(epoch), F.lit(seed)))


def _placed(df: DataFrame, by: Column) -> DataFrame:
    ranked = running_totals(df.withColumn("_h", by).withColumn("_one", F.lit(1)), "_h", ["_one"])
    return ranked.withColumn("place", F.col("_one_before").cast("bigint")).drop("_h", "_one", "_one_before")


def sample(df: DataFrame, row_id: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, the first by hash."""
    return df.orderBy(draw(F.col(row_id), F.lit(seed)), row_id).limit(n)


def weighted_draws(df: DataFrame, row_id: str, weight: str, n: int, seed: int = 42, most_buckets: int = 1_000_000) -> DataFrame:
    """(draw, row_id): n draws with replacement by weight: each draw's point falls within a row's share of the running total in the order of a hash. Rows without a positive weight are never drawn.

    Points and shares meet by equal buckets of the total, about as many as there are rows: neither a sort of all rows in one task nor a comparison of all draws with all rows."""
    rows = df.where(F.col(weight) > 0).select(row_id, F.col(weight).alias("_w"))
    placed = cut(running_totals(rows.withColumn("_h", draw(F.col(row_id), F.lit(seed))), "_h", ["_w"]), "weights")
    count, total = placed.agg(F.count(F.lit(1)), F.sum("_w")).first()
    k = max(1, min(count, most_buckets))
    low, high = F.col("_w_before") / F.lit(total), (F.col("_w_before") + F.col("_w")) / F.lit(total)
    bucket = lambda x: F.least(F.floor(x * k), F.lit(k - 1)).cast("bigint")
    ranges = placed.select(row_id, low.alias("lo"), high.alias("hi")).withColumn("bucket", F.explode(F.sequence(bucket(F.col("lo")), bucket(F.col("hi")))))
    draws = df.sparkSession.range(n).select(F.col("id").alias("draw"), uniform(F.col("id"), F.lit(seed)).alias("u")).withColumn("bucket", bucket(F.col("u")))
    return draws.join(ranges, "bucket").where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi"))).select("draw", row_id)


def paired(df: DataFrame, row_id: str, others: DataFrame, order: str, seed: int = 42) -> DataFrame:
    """Each row of `df` with one row of `others`, drawn with replacement by a hash of the row: the one at the drawn place in the order of the number `order`, whose values are distinct."""
    held = cut(running_totals(others.withColumn("_one", F.lit(1)), order, ["_one"]), "others")
    return df.withColumn("_place", F.pmod(draw(F.col(row_id), F.lit(seed)), F.lit(max(1, held.count())))).join(held, F.col("_place") == F.col("_one_before")).drop("_place", "_one", "_one_before")


def representative_set(df: DataFrame, row_id: str, positive: Column, n: int, negatives_per_positive: int, seed: int = 42) -> DataFrame:
    """(row_id, place): about n rows, the first of each kind by hash: g negatives and then one positive, over and over, as far as both reach."""
    g = negatives_per_positive
    rounds = max(1, n // (g + 1))
    kinds = df.select(row_id, positive.alias("p")).where("p IS NOT NULL")
    head = sample(kinds.where("p"), row_id, rounds, seed).unionByName(sample(kinds.where(~F.col("p")), row_id, rounds * g, seed))
    ranked = head.withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy(draw(F.col(row_id), F.lit(seed)), row_id)) - 1)  # n rows
    place = F.when(F.col("p"), F.col("r") * (g + 1) + g).otherwise(F.floor(F.col("r") / g) * (g + 1) + F.col("r") % g)
    return ranked.select(row_id, place.cast("bigint").alias("place"))
