"""Problem 3: a score cutoff per source that keeps a target share, by sketch-bracketed exact selection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from earshot.llm.names import named
from earshot.session import cut


@dataclass(frozen=True)
class Cutoffs:
    """rows: source, value, and the columns that were kept, one row per counted row. table: source, keep_pct, n_rows, cutoff, n_kept."""

    rows: DataFrame
    table: DataFrame


def bounded(targets: DataFrame, most: int) -> list:
    """The rows of a table that must be small."""
    rows = targets.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} targets")
    return rows


def source_cutoffs(scores: DataFrame, targets: DataFrame, *, source: str, value: str, keep: list[str], dropped: str | None = None, low: float = 0.0, high: float = 1.0, accuracy: int = 2000, most_targets: int = 5000, most_sorted: int = 1_000_000) -> Cutoffs:
    """For each source the highest value such that the rows at or above it are at least `keep_pct` percent of the source's counted rows.

    scores: a row counts if its `source` names one of the targets (spelling aside), `dropped` isn't true, and `value` is a number from `low` to `high`.
    targets: (source plain spelling, keep_pct 0 to 100), at most `most_targets` rows; a null name or percentage is no target, of repeated names the smallest percentage holds.

    1. A mergeable quantile sketch per source, whose rank error is bounded by rows / `accuracy`, gives a bracket around the wanted rank.
    2. One pass counts the rows above each bracket and groups those within it by value, so a hot source is counted by map-side partial sums and ties collapse.
    3. Only the distinct values within a bracket are sorted, `most_sorted` of a source at most: a bracket with more is parted by quantiles of these values, the parts' rows are counted, and the
    part that holds the rank is the new bracket, as often as needed. Where the exact counts show that a bracket misses the rank, the source is selected from a wider one.
    A source without counted rows has no cutoff row. An empty table gives no rows. Columns other than `source`, `value`, `dropped` and `keep` play no part."""
    if clash := {"source", "value", "cutoff"} & set(keep):
        raise ValueError(f"rename {sorted(clash)} first")
    wanted: dict[str, int] = {}
    for name, pct in bounded(targets, most_targets):
        if name is not None and pct is not None:
            wanted[name] = min(pct, wanted.get(name, pct))
    if any(not 0 <= p <= 100 for p in wanted.values()):
        raise ValueError("keep_pct must be from 0 to 100")
    v = F.col(value)
    counts = v.isNotNull() & ~F.isnan(v) & (v >= low) & (v <= high) & (F.lit(True) if dropped is None else F.coalesce(~F.col(dropped), F.lit(True)))
    rows = cut(_with_source(scores.where(counts).select(F.col(source).alias("__label"), v.alias("value"), *keep), list(wanted)), "scores")

    facts: dict[str, tuple[int, int]] = {}
    exact: dict[str, tuple] = {}
    around, left = 2.0 / accuracy, rows
    while wanted:
        found = _brackets(left, wanted, around, accuracy)
        facts |= {s: (n, wanted[s]) for s, (n, _, _) in found.items()}
        got = _select(left, {s: (lo, hi) for s, (_, lo, hi) in found.items()}, facts, most_sorted)
        exact |= {s: r for s, r in got.items() if r}
        missed = [s for s, r in got.items() if not r]
        if not missed:
            break
        # Not expected, as the sketch's error is bounded: a wider bracket, in the end all values.
        around, left = around * 8, rows.where(F.col("source").isin(missed))
    kind = scores.schema[value].dataType.simpleString()
    made = [(s, facts[s][1], facts[s][0], *r) for s, r in sorted(exact.items())]
    return Cutoffs(rows, scores.sparkSession.createDataFrame(made, f"source string, keep_pct int, n_rows bigint, cutoff {kind}, n_kept bigint"))


def _with_source(rows: DataFrame, names: list[str], most_labels: int = 100_000) -> DataFrame:
    """`rows` with `source` for `__label`; rows of none are left out. Each spelling is looked up once; up to `most_labels` of them are joined by broadcast."""
    labels = rows.groupBy("__label").agg(F.lit(1).alias("__one")).select("__label", named(F.col("__label"), names).alias("source"))
    labels = cut(labels.where(F.col("source").isNotNull()), "labels")
    known = F.broadcast(labels) if labels.count() <= most_labels else labels
    return rows.join(known, "__label").select("source", *[c for c in rows.columns if c != "__label"])


def _brackets(rows: DataFrame, wanted: dict[str, int], around: float, accuracy: int) -> dict[str, tuple]:
    """source -> (its rows, bracket): the quantiles at 1 - keep, less and more `around`. A row per target at most reaches the driver."""
    edge = lambda pct, sign: min(1.0, max(0.0, 1 - pct / 100 + sign * around))
    shares = sorted({edge(p, sign) for p in wanted.values() for sign in (-1, 1)})
    sketch = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("value", shares, accuracy).alias("q")).collect()
    return {r["source"]: (r["n"], r["q"][shares.index(edge(wanted[r["source"]], -1))], r["q"][shares.index(edge(wanted[r["source"]], 1))]) for r in sketch}


def _select(rows: DataFrame, bracket: dict[str, tuple], facts: dict, most_sorted: int) -> dict[str, tuple | None]:
    """(cutoff, rows kept) of each source, or None where the bracket doesn't hold the cutoff."""
    if not bracket:
        return {}
    spark = rows.sparkSession
    kind = rows.schema["value"].dataType.simpleString()
    known = spark.createDataFrame([(s, lo, hi, *facts[s]) for s, (lo, hi) in bracket.items()], f"source string, lo {kind}, hi {kind}, n_rows bigint, keep_pct int")
    joined = rows.join(F.broadcast(known), "source")  # a row per target at most
    below, above = F.coalesce(F.col("value") < F.col("lo"), F.lit(False)), F.coalesce(F.col("value") > F.col("hi"), F.lit(False))
    counted = joined.where(~below).groupBy("source", "n_rows", "keep_pct", F.when(~above, F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counted = cut(counted, "bracket")
    # Sources with too much to sort; a row per target at most.
    while big := [r["source"] for r in counted.where(F.col("value").isNotNull()).groupBy("source").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") > most_sorted).collect()]:
        counted = cut(counted.where(~F.col("source").isin(big)).unionByName(_narrowed(counted.where(F.col("source").isin(big)))), "bracket")
    upper = Window.partitionBy("source").orderBy(F.col("value").desc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    reached = counted.withColumn("kept", F.sum("n").over(upper)).where(F.col("kept") * 100 >= F.col("keep_pct") * F.col("n_rows"))
    best = reached.groupBy("source").agg(F.min("kept").alias("kept"), F.min_by("value", "kept").alias("value"), F.min_by(F.col("value").isNull(), "kept").alias("over"))
    got = {r["source"]: None if r["over"] else (r["value"], r["kept"]) for r in best.collect()}  # a row per target at most
    return {s: got.get(s) for s in bracket}


def _narrowed(counted: DataFrame, parts: int = 64) -> DataFrame:
    """(source, n_rows, keep_pct, value, n) with, of each source, only the part of its values that holds the rank, and one row with a null value for all rows above that part."""
    splits = counted.where(F.col("value").isNotNull()).groupBy("source").agg(F.percentile_approx("value", [i / parts for i in range(1, parts)], 20 * parts).alias("s"))
    part = F.when(F.col("value").isNull(), parts).otherwise(F.size(F.filter("s", lambda x: x < F.col("value"))))
    marked = counted.join(F.broadcast(splits), "source").withColumn("part", part).drop("s")  # a row per target at most
    totals = marked.groupBy("source", "n_rows", "keep_pct", "part").agg(F.sum("n").alias("t"))
    upper = Window.partitionBy("source").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, 0)  # `parts` rows a source
    reached = totals.withColumn("kept", F.sum("t").over(upper)).where(F.col("kept") * 100 >= F.col("keep_pct") * F.col("n_rows"))
    chosen = reached.groupBy("source", "n_rows", "keep_pct").agg(F.max("part").alias("part"), F.max_by(F.col("kept") - F.col("t"), "part").alias("above"))
    inside = marked.join(F.broadcast(chosen.select("source", "part")), ["source", "part"]).drop("part")  # a row per target at most
    over = chosen.where(F.col("above") > 0).select("source", "n_rows", "keep_pct", F.lit(None).cast(counted.schema["value"].dataType).alias("value"), F.col("above").alias("n"))
    return inside.select(*counted.columns).unionByName(over.select(*counted.columns))


def below_cutoff(found: Cutoffs) -> DataFrame:
    """The counted rows below their source's cutoff."""
    return found.rows.join(F.broadcast(found.table.select("source", "cutoff")), "source").where(F.col("value") < F.col("cutoff"))  # a row per target at most
