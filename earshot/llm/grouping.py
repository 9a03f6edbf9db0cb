"""Problem 2: splits that keep related rows together."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, functions as F

from earshot.llm.cutoffs import bounded
from earshot.operators.graph import components
from earshot.session import cut


def with_component(rows: DataFrame, member: str, links: DataFrame, a: str, b: str) -> DataFrame:
    """`rows` with the column `group`: the component of `member` through `links`, or `member` itself. Null members have the null group."""
    joined = components(links, a, b).select(F.col("id").alias("__id"), F.col("component").alias("__component"))
    return rows.join(joined, F.col(member) == F.col("__id"), "left").withColumn("group", F.coalesce("__component", F.col(member))).drop("__id", "__component")


def crossing_groups(rows: DataFrame, group: str, split: str) -> DataFrame:
    """The groups whose rows lie in more than one split, null splits and the null group aside. One row per group."""
    known = rows.where(F.col(split).isNotNull() & F.col(group).isNotNull())
    return known.groupBy(group).agg(F.min(split).alias("_a"), F.max(split).alias("_b")).where(F.col("_a") != F.col("_b")).select(group)


def difference(parts: list[list[tuple[int, list]]]) -> list[tuple[int, list]]:
    """The largest-differencing method over partial solutions, each a list of equally many (weight, members).

    The two solutions with the widest spread are combined, the heaviest bin of one with the lightest of the other, until one is left."""
    heap = []
    for i, bins in enumerate(parts):
        bins = sorted(bins, key=lambda x: (-x[0], x[1][:1]))
        heap.append((-(bins[0][0] - bins[-1][0]), i, bins))
    heapq.heapify(heap)
    fresh = len(parts)
    while len(heap) > 1:
        _, _, x = heapq.heappop(heap)
        _, _, y = heapq.heappop(heap)
        z = sorted(((p[0] + q[0], p[1] + q[1]) for p, q in zip(x, reversed(y), strict=True)), key=lambda b: (-b[0], b[1][:1]))
        heapq.heappush(heap, (-(z[0][0] - z[-1][0]), fresh, z))
        fresh += 1
    return heap[0][2] if heap else []


def allocate(bins: list[tuple[int, object]], shares: dict[str, float]) -> dict[object, str]:
    """A split for each whole bin, the heaviest first, each to the split that is furthest below its target."""
    total = sum(w for w, _ in bins)
    norm = sum(shares.values())
    want = {s: total * x / norm for s, x in shares.items() if x > 0}
    out = {}
    for w, b in sorted(bins, key=lambda x: (-x[0], str(x[1]))):
        best = max(want, key=lambda s: (want[s], s))
        out[b] = best
        want[best] -= w
    return out


def assign_splits(rows: DataFrame, targets: DataFrame, *, group: str, row_id: str, name: str = "split", share: str = "share", bins: int = 1000, per_block: int = 100_000, fan_in: int = 32, most_targets: int = 100) -> DataFrame:
    """`rows` with the column `assigned`: a split for every row, all rows of a group in one split, the splits' sizes near the target shares.

    Rows without a group are bundled by a hash of `row_id` into groups that are small against a bin. Groups that are as heavy as one of `bins` equal bins are bins of their own, `bins` at most.
    All others go by hash into blocks of about `per_block` groups, and the largest-differencing method makes `bins` bins of like weight in each block. Then, level by level, the bins of `fan_in`
    blocks are differenced in turn until one block is left: each step is one Arrow task of fan_in x bins numbers, and which bin went into which stays in a table. Only the last
    `bins` sums and the heavy groups reach the driver, which gives whole bins to splits by target share.
    targets: shares need not sum to 1; null or negative ones raise. Empty rows give no rows. Repeated rows stay repeated: equal row ids without a group stay together. Names that begin with
    two underscores are taken; other columns of `rows` are kept."""
    wanted = {r[name]: float(r[share]) for r in bounded(targets.select(name, share), most_targets) if r[name] is not None}
    if not wanted or any(not x >= 0 for x in wanted.values()) or not sum(wanted.values()) > 0:
        raise ValueError("targets need shares of 0 or more that aren't all 0")
    bundle = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(F.col(row_id)), F.lit(bins * 20)).cast("string"))
    keyed = rows.withColumn("__group", F.coalesce(F.col(group).cast("string"), bundle))
    weights = cut(keyed.groupBy("__group").agg(F.count(F.lit(1)).alias("w")), "weights")
    n_groups, total = weights.agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first()
    is_heavy = F.col("w") * bins >= max(2 * bins, total)
    heavy = [(r["w"], r["__group"]) for r in weights.where(is_heavy).collect()]  # `bins` at most
    blocks = max(1, -(-n_groups // per_block))

    light = weights.where(~is_heavy).withColumn("block", F.pmod(F.xxhash64("__group"), F.lit(blocks)).cast("int"))
    binned = cut(light.groupBy("block").applyInPandas(lambda pdf: _first_level(pdf, bins), "block int, bin int, w bigint, __group string"), "bins")
    moved, sums = [], binned.groupBy("block", "bin").agg(F.sum("w").alias("w"))
    while blocks > 1:
        blocks = -(-blocks // fan_in)
        level = cut(sums.withColumn("next", F.floor(F.col("block") / fan_in).cast("int")).groupBy("next").applyInPandas(lambda pdf: _next_level(pdf, bins), "block int, bin int, w bigint, next int, next_bin int"), "level")
        moved.append(level.select("block", "bin", "next", "next_bin"))
        sums = level.groupBy(F.col("next").alias("block"), F.col("next_bin").alias("bin")).agg(F.sum("w").alias("w"))
    of = allocate([(r["w"], r["bin"]) for r in sums.collect()] + [(w, g) for w, g in heavy], wanted)  # 2 x `bins` at most

    spark = rows.sparkSession
    for level in moved:
        binned = binned.select("__group", "block", "bin").join(level, ["block", "bin"]).select("__group", F.col("next").alias("block"), F.col("next_bin").alias("bin"))
    whole = spark.createDataFrame([(b, s) for b, s in of.items() if isinstance(b, int)], "bin int, assigned string")
    solo = spark.createDataFrame([(g, of[g]) for _, g in heavy], "__group string, assigned string")
    chosen = binned.join(F.broadcast(whole), "bin").select("__group", "assigned").unionByName(solo)  # `bins` rows at most
    return keyed.join(chosen, "__group").drop("__group")


def _first_level(pdf, bins: int):
    """A block of groups (block, __group, w) as (block, bin, w, __group)."""
    import pandas as pd

    made = _block_bins(list(zip(pdf["w"].tolist(), pdf["__group"].tolist())), bins)
    return pd.DataFrame([(int(pdf["block"].iat[0]), i, w, g) for i, members in enumerate(made) for w, g in members], columns=["block", "bin", "w", "__group"])


def _next_level(pdf, bins: int):
    """The bins of some blocks (block, bin, w, next) with the bin of the next level that each becomes part of."""
    import pandas as pd

    parts = []
    for b, part in pdf.sort_values(["block", "bin"]).groupby("block"):
        solution = [(w, [(b, i, w)]) for w, i in zip(part["w"].tolist(), part["bin"].tolist())]
        parts.append(solution + [(0, [])] * (bins - len(solution)))
    to = int(pdf["next"].iat[0])
    return pd.DataFrame([(b, i, w, to, k) for k, (_, members) in enumerate(difference(parts)) for b, i, w in members], columns=["block", "bin", "w", "next", "next_bin"])


def _block_bins(weights: list[tuple[int, str]], n: int) -> list[list[tuple[int, str]]]:
    """`_bins` for a block of many groups: runs of n groups in order of weight are solutions already, so that the heap holds one entry per n groups."""
    ordered = sorted(weights, key=lambda x: (-x[0], x[1]))
    parts = []
    for i in range(0, len(ordered), n):
        run = [(w, [(w, g)]) for w, g in ordered[i : i + n]]
        parts.append(run + [(0, [])] * (n - len(run)))
    return [members for _, members in difference(parts)]


def resolved_speaker(rows: DataFrame, known: Column, in_folder: Column, file: Column, speaker_map: DataFrame, map_file: Column, map_speaker: Column) -> DataFrame:
    """`rows` with the column `speaker`: the known one, else the folder's, else the one the map has for the file.

    A map that gives one file several speakers counts by the least id. Only rows that need the map are joined with it, on the file's whole path."""
    marked = rows.withColumn("speaker", F.coalesce(known, in_folder)).withColumn("__file", F.when(F.col("speaker").isNull(), file))
    least = speaker_map.select(map_file.alias("__file"), map_speaker.alias("__mapped")).where(F.col("__file").isNotNull() & F.col("__mapped").isNotNull()).groupBy("__file").agg(F.min("__mapped").alias("__mapped"))
    lacking = marked.where(F.col("__file").isNotNull()).join(least, "__file", "left").withColumn("speaker", F.col("__mapped")).drop("__mapped", "__file")
    return marked.where(F.col("__file").isNull()).drop("__file").unionByName(lacking)
