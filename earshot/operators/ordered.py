"""Operators over ordered rows. What a window frame can say is a window; what needs the state of the row before is a fold over sorted partitions that holds one state, not the rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Step = Callable[[Any, tuple], tuple[Any, list[tuple]]]


def sliding_detection(df: DataFrame, stream: Sequence[str], order: Sequence[str], *, score: str = "score", threshold: float, window: int, clip: str | None = None, name: str = "detected") -> DataFrame:
    """`df` with 1 where the sum of the last `window` scores exceeds threshold times their number; shorter beginnings count. With `clip`, windows begin anew where the clip id changes."""
    keys = list(stream)
    if window <= 1:
        return df.withColumn(name, (F.col(score) > threshold).cast("int"))
    if clip:
        df = islands(df, stream, order, clip, name="_island")
        keys.append("_island")
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(window - 1), 0)
    return df.withColumn(name, (F.sum(score).over(w) > F.lit(float(threshold)) * F.count(score).over(w)).cast("int")).drop("_island")


def islands(df: DataFrame, stream: Sequence[str], order: Sequence[str], id_column: str, name: str = "island") -> DataFrame:
    """`df` with the number of changes of `id_column` up to each row of its stream, from 0."""
    w = Window.partitionBy(*stream).orderBy(*order)
    changed = (~F.col(id_column).eqNullSafe(F.lag(id_column).over(w)) & (F.row_number().over(w) > 1)).cast("int")
    return df.withColumn("_changed", changed).withColumn(name, F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_changed")


def moving_average(df: DataFrame, stream: Sequence[str], order: Sequence[str], *, score: str = "score", window: int, skip: int = 0, name: str = "average") -> DataFrame:
    """The average of each complete window only, after the first `skip` rows of a stream."""
    w = Window.partitionBy(*stream).orderBy(*order)
    kept = df.withColumn("_i", F.row_number().over(w)).where(F.col("_i") > skip)
    frame = w.rowsBetween(-(window - 1), 0)
    return kept.withColumn(name, F.avg(score).over(frame)).withColumn("_n", F.count(F.lit(1)).over(frame)).where(F.col("_n") == window).drop("_n", "_i")


def max_moving_average(df: DataFrame, stream: Sequence[str], order: Sequence[str], *, score: str = "score", window: int, skip: int = 0) -> DataFrame:
    return moving_average(df, stream, order, score=score, window=window, skip=skip).groupBy(*stream).agg(F.max("average").alias("max_average"))


def fold(df: DataFrame, stream: Sequence[str], order: Sequence[str], start: Callable[[], Any], step: Step, schema: str, end: Callable[[Any], list[tuple]] | None = None) -> DataFrame:
    """Rows made by `step(state, row)` over each stream in order, and by `end(state)` behind its last row.

    Rows are the columns of `df`; what is made gets the stream's keys in front. Partitions are sorted and read in batches, and one state is held, so a long stream costs time but no memory."""
    keys = [df.columns.index(c) for c in stream]
    kinds = df.select(*stream).schema
    full = StructType([*kinds.fields, *StructType.fromDDL(schema).fields])
    arrow = to_arrow_schema(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, any_row = None, None, False
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                k = tuple(row[i] for i in keys)
                if not any_row or k != key:
                    if any_row and end:
                        out += [key + x for x in end(state)]
                    key, state, any_row = k, start(), True
                state, made = step(state, row)
                out += [k + x for x in made]
            yield _batch(out, arrow)
        if any_row and end:
            yield _batch([key + x for x in end(state)], arrow)

    return df.repartition(*[F.col(c) for c in stream]).sortWithinPartitions(*stream, *order).mapInArrow(run, full)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


# ---- step functions, shared by batch and stream

class Cooldown:
    """Counts accepts per cutoff: after one, `ignore` rows pass before the next; each stream begins with `ignore` rows to pass."""

    def __init__(self, cutoffs: Sequence[float], ignore: int, score: int) -> None:
        self.cutoffs, self.ignore, self.score = list(cutoffs), ignore, score

    def start(self) -> list:
        return [[self.ignore] * len(self.cutoffs), [0] * len(self.cutoffs), 0]

    def step(self, state: list, row: tuple) -> tuple[list, list[tuple]]:
        wait, hits, n = state
        p = row[self.score]
        for i, c in enumerate(self.cutoffs):
            if wait[i] > 0:
                wait[i] -= 1
            if wait[i] == 0 and p is not None and p > c:
                hits[i] += 1
                wait[i] = self.ignore
        return [wait, hits, n + 1], []

    def end(self, state: list) -> list[tuple]:
        return [(i, c, state[1][i], state[2]) for i, c in enumerate(self.cutoffs)]


class RisingEdge:
    """A row where the score comes to exceed `level`, at least `gap` rows and one more behind the last such row."""

    def __init__(self, level: float, gap: int, score: int) -> None:
        self.level, self.gap, self.score = level, gap, score

    def start(self) -> tuple:
        return (0.0, -math.inf, 0)

    def step(self, state: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        before, last, i = state
        p = row[self.score] or 0.0
        if before <= self.level < p and i - last > self.gap:
            return (p, i, i + 1), [(i,)]
        return (p, last, i + 1), []


class EmaAlert:
    """A row that exceeds `factor` times the running average of the rows before; the average takes the row in afterwards."""

    def __init__(self, value: int, alpha: float = 0.1, factor: float = 2.0) -> None:
        self.value, self.alpha, self.factor = value, alpha, factor

    def start(self) -> tuple:
        return (None, 0)

    def step(self, state: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        base, i = state
        x = row[self.value]
        if base is None:
            return (x, i + 1), [(i, x, x, False)]
        alert = base > 0 and x / base > self.factor
        return (self.alpha * x + (1 - self.alpha) * base, i + 1), [(i, x, base, alert)]


class AlertCooldown:
    """Lets an alert through if its message differs from the last one let through or `seconds` have passed since."""

    def __init__(self, message: int, at: int, seconds: float) -> None:
        self.message, self.at, self.seconds = message, at, seconds

    def start(self) -> tuple:
        return (None, -math.inf)

    def step(self, state: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        message, at = row[self.message], row[self.at]
        if message != state[0] or at - state[1] >= self.seconds:
            return (message, at), [(at, message)]
        return state, []


class Plateau:
    """Consecutive plateaus: after `patience` of them a reduction and a new count, after `most` reductions a stop."""

    def __init__(self, flag: int, patience: int, most: int, factor: float) -> None:
        self.flag, self.patience, self.most, self.factor = flag, patience, most, factor

    def start(self) -> tuple:
        return (0, 0, 0, False)

    def step(self, state: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        run, reduced, i, stopped = state
        action = "none"
        if not stopped:
            run = run + 1 if row[self.flag] else 0
            if run >= self.patience:
                if reduced < self.most:
                    run, reduced, action = 0, reduced + 1, "reduce"
                else:
                    stopped, action = True, "stop"
        return (run, reduced, i + 1, stopped), [(i, run, action, self.factor**reduced)]


def cooldown_counts(df: DataFrame, stream: Sequence[str], order: Sequence[str], *, score: str = "score", cutoffs: Sequence[float], ignore: int, hours_per_row: float | None = None) -> DataFrame:
    """(k, cutoff, accepts, n_rows[, per_hour]) over all streams together."""
    machine = Cooldown(cutoffs, ignore, df.columns.index(score))
    each = fold(df, stream, order, machine.start, machine.step, "_k int, _cutoff double, _accepts int, _rows bigint", machine.end)
    out = each.groupBy(F.col("_k").alias("k"), F.col("_cutoff").alias("cutoff")).agg(F.sum("_accepts").alias("accepts"), F.sum("_rows").alias("n_rows"))
    return out if hours_per_row is None else out.withColumn("per_hour", F.col("accepts") / (F.col("n_rows") * hours_per_row))


# ---- frames of arrays

def frames(values: Column, size: int, step: int) -> Column:
    """Overlapping frames of an array; the last one is filled with zeros, a short array makes one frame. An empty one makes one frame of zeros."""
    n = F.size(values)
    count = F.greatest(F.lit(1), F.ceil((n - size) / F.lit(float(step))).cast("int") + 1)
    zero = F.lit(0).cast("float")
    filled = F.concat(values, F.array_repeat(zero, F.greatest(F.lit(0), (count - 1) * step + size - n)))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(filled, i * step + 1, F.lit(size)))


def chunks(values: Column, size: int, keep_rest: bool = False, least: int = 1) -> Column:
    """Chunks of an array without overlap; the rest is dropped, or kept if it has `least` values. An array that makes no chunk gives an empty one."""
    n = F.size(values)
    count = F.ceil(n / F.lit(float(size))).cast("int") if keep_rest else F.floor(n / F.lit(float(size))).cast("int")
    cut_up = F.transform(F.filter(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: i < count), lambda i: F.slice(values, i * size + 1, F.lit(size)))
    return F.filter(cut_up, lambda c: F.size(c) >= least)


def speech_bounds(df: DataFrame, stream: Sequence[str], order: str, flag: str, pad: int) -> DataFrame:
    """(first, last) flagged position, widened by `pad` and kept within the stream; null without one."""
    hit = F.when(F.col(flag), F.col(order))
    g = df.groupBy(*stream).agg(F.min(hit).alias("a"), F.max(hit).alias("b"), F.min(order).alias("lo"), F.max(order).alias("hi"))
    return g.select(*stream, F.when(F.col("a").isNotNull(), F.greatest(F.col("a") - pad, F.col("lo"))).alias("first"), F.when(F.col("b").isNotNull(), F.least(F.col("b") + pad, F.col("hi"))).alias("last"))
