"""The ordered operators on streams: the step functions of the batch operators with their state kept by key."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from earshot.operators.quantiles import exact_percentiles


def fold_stream(df: DataFrame, keys: Sequence[str], order: Sequence[str], machine: Any, schema: str) -> DataFrame:
    """`operators.ordered.fold` on a stream: rows of a key are taken in order within each micro-batch and the state goes on to the next. Rows that come later than a batch with later
    ones are taken when they come. What `machine.end` makes isn't emitted, as a stream has no end."""
    full = StructType([*df.select(*keys).schema.fields, *StructType.fromDDL(schema).fields])
    columns = [f.name for f in full.fields]
    index = {c: i for i, c in enumerate(df.columns)}
    where = [index[c] for c in order]

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = pickle.loads(state.get[0]) if state.exists else machine.start()
        rows = sorted((r for pdf in batches for r in pdf.itertuples(index=False, name=None)), key=lambda r: tuple(r[i] for i in where))
        out = []
        for row in rows:
            held, made = machine.step(held, row)
            out += [key + x for x in made]
        state.update((pickle.dumps(held),))
        if out:
            yield pd.DataFrame(out, columns=columns)

    return df.groupBy(*keys).applyInPandasWithState(run, full, "state binary", "append", GroupStateTimeout.NoTimeout)


class RingBuffer:
    """The last n values: one row in, the values so far out, zeros in front until n have come."""

    def __init__(self, n: int, value: int, at: int) -> None:
        self.n, self.value, self.at = n, value, at

    def start(self) -> list[float]:
        return [0.0] * self.n

    def step(self, state: list[float], row: tuple) -> tuple[list[float], list[tuple]]:
        state = [*state, float(row[self.value])][-self.n :] if self.n else []
        return state, [(row[self.at], list(state))]


class StridedBuffer(RingBuffer):
    """As a ring buffer of n values, but a row comes out for every `stride` rows in."""

    def __init__(self, n: int, value: int, at: int, stride: int) -> None:
        super().__init__(n, value, at)
        self.stride = stride

    def start(self) -> tuple:
        return ([0.0] * self.n, 0)

    def step(self, state: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        held, i = state
        held = [*held, float(row[self.value])][-self.n :]
        return (held, i + 1), ([(row[self.at], list(held))] if (i + 1) % self.stride == 0 else [])


class Delay:
    """The value n rows before, 0 for the first n."""

    def __init__(self, n: int, value: int, at: int) -> None:
        self.n, self.value, self.at = n, value, at

    def start(self) -> list[float]:
        return [0.0] * self.n

    def step(self, state: list[float], row: tuple) -> tuple[list[float], list[tuple]]:
        if not self.n:
            return state, [(row[self.at], float(row[self.value]))]
        return [*state[1:], float(row[self.value])], [(row[self.at], state[0])]


class DetectionEvents:
    """Accepts by a moving average over `window` rows, with a cooldown: (row, average) of each accept."""

    def __init__(self, window: int, cutoff: float, ignore: int, value: int, at: int) -> None:
        self.window, self.cutoff, self.ignore, self.value, self.at = window, cutoff, ignore, value, at

    def start(self) -> tuple:
        return ([], self.ignore)

    def step(self, state: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        held, wait = state
        held = [*held, float(row[self.value])][-self.window :]
        wait = max(0, wait - 1)
        mean = sum(held) / len(held)
        if len(held) == self.window and wait == 0 and mean > self.cutoff:
            return (held, self.ignore), [(row[self.at], mean)]
        return (held, wait), []


# ---- the same in batch, as windows

def ring_buffer(value: Column, n: int, window: Window, missing: float = 0.0) -> Column:
    """The last n values of the window's order with `missing` in front."""
    held = F.collect_list(value).over(window.rowsBetween(-(n - 1), 0))
    return F.concat(F.array_repeat(F.lit(missing), n - F.size(held)), held)


def causal_pad(a: Column, n: int) -> Column:
    """n zeros in front: what a stream's buffer holds before the first row."""
    return F.concat(F.array_repeat(F.lit(0.0), n), a)


def keep_last(a: Column, n: int) -> Column:
    """The last n values, zeros in front where there are fewer."""
    size = F.size(a)
    return F.concat(F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), n - size)), F.slice(a, F.greatest(F.lit(1), size - n + 1), F.lit(n)))


def drop_last(a: Column, n: int) -> Column:
    return F.slice(a, F.lit(1), F.greatest(F.lit(0), F.size(a) - n))


def windowed_counts(stream: DataFrame, at: str, *keys: str, width: str, late: str, slide: str | None = None) -> DataFrame:
    """Counts by event-time window; a window closes once the watermark `late` behind has passed it."""
    timed = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    w = F.window(at, width, slide) if slide else F.window(at, width)
    return timed.groupBy(w, *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def run_to_table(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there, into Parquet under `path` with its checkpoint beside it (exactly once), and reads it."""
    q = stream.writeStream.format("parquet").option("path", f"{path}/data").option("checkpointLocation", f"{path}/checkpoint").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/data")


class BackgroundMiner:
    """Mines hard rows of each micro-batch beside the stream, one run in flight: the k highest-scored negatives so far, rewritten after each batch."""

    def __init__(self, path: str, k: int, score: str = "score", label: str = "y", row_id: str = "row_id") -> None:
        self.path, self.k, self.score, self.label, self.row_id = path, k, score, label, row_id
        self.batch = -1

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        top = batch.where(F.col(self.label) == 0).select(self.row_id, self.score)
        if self.batch >= 0:
            top = top.unionByName(batch.sparkSession.read.parquet(f"{self.path}/{self.batch}")).dropDuplicates([self.row_id])
        top.orderBy(F.desc(self.score), self.row_id).limit(self.k).write.mode("overwrite").parquet(f"{self.path}/{epoch}")
        self.batch = epoch

    def result(self, spark) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{self.batch}")


def gap_statistics(df: DataFrame, batch: str, stream: str, tolerance: float) -> DataFrame:
    """One row of how far a stream's values are from those of a batch: number, mean, largest and median of the absolute gaps, deviation of the gaps, and whether all are within the tolerance."""
    gaps = df.select((F.col(batch) - F.col(stream)).alias("gap"))
    far = F.abs(F.col("gap"))
    facts = gaps.agg(F.count(F.lit(1)).alias("n"), F.avg(far).alias("mean_gap"), F.max(far).alias("max_gap"), F.stddev_pop("gap").alias("std_gap"), (F.max(far) < tolerance).alias("passes"))
    middle = exact_percentiles(gaps.select(far.alias("gap")), [], "gap", {"median_gap": 0.5})
    return facts.crossJoin(F.broadcast(middle)).select("n", "mean_gap", "max_gap", F.col("median_gap"), "std_gap", "passes")  # one row each
