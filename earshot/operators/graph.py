"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from earshot.session import cut


def components(links: DataFrame, a: str, b: str, *, most_rounds: int = 60) -> DataFrame:
    """(id, component): the component, named by its least id, of every id that a link joins to another id.

    Large-star and small-star rounds in turn: each round points an id's neighbours to the least of them, so a chain of n links takes about log n rounds, and no id's links are ever
    gathered in one place beyond their minimum. Each round is written to the workspace. Repeated links, links of an id to itself and null ids change nothing."""
    edges = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    sign = lambda d: d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    before = sign(edges)
    for _ in range(most_rounds):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: the larger neighbours of u go to the least of u and its neighbours.
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        # Small star: u and its smaller neighbours go to the least of these.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        new = cut(small.where(F.col("u") != F.col("v")).distinct(), "links")
        after = sign(new)
        if after == before:
            return new.select(F.col("u").alias("id"), F.col("v").alias("component"))
        edges, before = new, after
    raise RuntimeError(f"no end after {most_rounds} rounds")
