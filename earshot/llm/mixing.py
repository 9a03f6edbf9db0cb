"""Problem 6: a mix of sources to target shares of all tokens, chosen by hash thresholds."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from earshot.llm.cutoffs import bounded
from earshot.llm.names import named
from earshot.session import cut
from earshot.worker import kept

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that the tokenizer's vocabulary goes with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEVEL_BITS = 12


def with_token_counts(documents: DataFrame, text: str, keep: list[str], tokenizer: str = TOKENIZER) -> DataFrame:
    """The columns `keep` and `n_tokens`, the tokens of the whole text by a public byte-level vocabulary. Its file goes to each executor once, and a worker builds it once. Null and empty texts have 0."""
    schema = documents.select(*keep).schema.add("n_tokens", T.LongType())

    with open(tokenizer, "rb") as f:
        sent, name = documents.sparkSession.sparkContext.broadcast(f.read()), f"tokenizer {uuid.uuid4().hex}"  # as large as the vocabulary's file

    def encoding():
        import base64

        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, sent.value.splitlines())}
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept(name, encoding).encode_ordinary
        for batch in batches:
            n = pa.array([len(encode(t)) if t else 0 for t in batch.column(len(keep)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], n], names=[*keep, "n_tokens"])

    return documents.select(*keep, F.col(text).alias("_text")).mapInArrow(count, schema)


def mix(documents: DataFrame, targets: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", name: str = "source_name", share: str = "target_share", repeats: str = "max_repeats", budget: int | None = None, seed: int = 7, tokenizer: str = TOKENIZER, most_targets: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(the chosen documents: doc_id, source, n_tokens, copies; the report: source, target_share, max_repeats, available_tokens, wanted_tokens, mixed_tokens, share).

    The mix is `budget` tokens, or else as large as it can be with every source at its target share and no source used more than `max_repeats` times. A source that is wanted r times and a
    part takes every document r times, and the part once more: the documents whose hash lies below a threshold. The thresholds come from nested histograms of tokens by source and hash bucket;
    each level refines only the bucket in which a source's budget ends, down to one hash value, so nothing is sorted. The document at
    the threshold is taken if the source's tokens come nearer to the budget with it.

    Sources are known however spelled; documents of others, of none, or without tokens stay out. targets: at most `most_targets`; null names, shares or repeats are no target, of repeated
    names the first by name, share and repeats holds, negative numbers raise. A source without tokens can't be mixed and has share 0 (it doesn't hold the others back). Repeated documents count
    one by one; equal ids hash alike and stay together."""
    wanted: dict[str, tuple[float, int]] = {}
    for n, s, r in sorted((tuple(x) for x in bounded(targets.select(name, share, repeats), most_targets) if None not in tuple(x)), key=str):
        wanted.setdefault(n, (float(s), int(r)))
    if any(s < 0 or r < 0 for s, r in wanted.values()):
        raise ValueError("shares and repeats can't be negative")
    spark = documents.sparkSession
    known = documents.select(F.col(doc_id).alias("doc_id"), named(F.col(source), list(wanted), slips=False).alias("source"), F.col(text).alias("_t")).where(F.col("source").isNotNull() & (F.length("_t") > 0))
    rows = cut(with_token_counts(known, "_t", ["doc_id", "source"], tokenizer).withColumn("h", F.xxhash64("doc_id", F.lit(seed))), "tokens")

    have = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect() if r["n"]}  # a row per target at most
    able = {n: x for n, x in wanted.items() if have.get(n) and x[0] > 0 and x[1] > 0}
    whole = sum(s for s, _ in wanted.values()) or 1.0
    size = min((r * have[n] * whole / s for n, (s, r) in able.items()), default=0.0)
    if budget is not None:
        size = float(budget)
    goal = {n: min(size * s / whole, r * have[n]) for n, (s, r) in able.items()}
    times = {n: int(g // have[n]) for n, g in goal.items()}
    left = {n: g - times[n] * have[n] for n, g in goal.items()}
    threshold = _thresholds(rows, {n: x for n, x in left.items() if x >= 1})

    # Of a hash only the order of its unsigned bits counts; the sign bit is flipped for the comparison.
    facts = spark.createDataFrame([(n, times[n], threshold.get(n)) for n in goal], "source string, times int, below bigint")
    chosen = rows.join(F.broadcast(facts), "source")  # a row per target at most
    flip = lambda c: F.col(c).bitwiseXOR(F.lit(-(2**63)))
    extra = F.coalesce((flip("h") < flip("below")).cast("int"), F.lit(0))
    chosen = chosen.withColumn("copies", F.col("times") + extra).where((F.col("copies") > 0) & (F.col("n_tokens") > 0)).select("doc_id", "source", "n_tokens", "copies")

    got = {r["source"]: (r["n"], r["d"]) for r in chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("n"), F.count(F.lit(1)).alias("d")).collect()}  # a row per target at most
    total = sum(n for n, _ in got.values())
    report = [(n, s / whole, r, have.get(n, 0), int(goal.get(n, 0)), got.get(n, (0, 0))[1], got.get(n, (0, 0))[0], got.get(n, (0, 0))[0] / total if total else 0.0) for n, (s, r) in sorted(wanted.items())]
    return chosen, spark.createDataFrame(report, "source string, target_share double, max_repeats int, available_tokens bigint, wanted_tokens bigint, n_docs bigint, mixed_tokens bigint, share double")


def _thresholds(rows: DataFrame, budget: dict[str, float]) -> dict[str, int]:
    """source -> the hash below which, as unsigned numbers, the documents' tokens come nearest to the budget.

    Level by level the tokens of a source's boundary bucket are summed by 2^12 smaller buckets, and the one in which the budget ends is the next boundary. After the first level only the rows
    of boundary buckets are kept, one in 2^12; of a level a row per source reaches the driver."""
    spark, prefix, open_ = rows.sparkSession, dict.fromkeys(budget, 0), dict(budget)
    for level in range((64 + LEVEL_BITS - 1) // LEVEL_BITS):
        if not open_:
            break
        bits = min(LEVEL_BITS, 64 - level * LEVEL_BITS)
        bucket = F.shiftrightunsigned(F.shiftleft("h", level * LEVEL_BITS), 64 - bits).cast("int")
        above = F.shiftrightunsigned("h", 64 - level * LEVEL_BITS) if level else F.lit(0).cast("bigint")
        at = spark.createDataFrame([(s, prefix[s], rest) for s, rest in open_.items()], "source string, prefix bigint, rest double")
        inside = rows.join(F.broadcast(at), "source").where(above == F.col("prefix"))  # a row per target at most
        if level:
            rows = cut(inside.select("source", "h", "n_tokens"), "boundary")
            inside = rows.join(F.broadcast(at), "source")
        up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)  # 2^12 rows a source
        sums = inside.groupBy("source", "rest", bucket.alias("bucket")).agg(F.sum("n_tokens").alias("n")).withColumn("so_far", F.sum("n").over(up_to))
        edges = {r["source"]: r["e"] for r in sums.where(F.col("so_far") > F.col("rest")).groupBy("source").agg(F.min(F.struct("bucket", "so_far", "n")).alias("e")).collect()}
        for s in list(open_):
            if s not in edges:  # the whole bucket fits
                prefix[s] = ((prefix[s] + 1) << (64 - level * LEVEL_BITS)) if level else 2**64 - 1
                del open_[s]
            else:
                edge, so_far, n = edges[s]
                rest = open_[s] - (so_far - n)
                prefix[s], open_[s] = (prefix[s] << bits) | edge, rest
                if (level + 1) * LEVEL_BITS >= 64 and n - rest < rest:  # with the document of this hash the source comes nearer to its budget
                    prefix[s] += 1
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    return {s: signed(min(p, 2**64 - 1)) for s, p in prefix.items()}
