from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot.llm import mixing as mx

pytestmark = pytest.mark.skipif(not os.path.exists(mx.TOKENIZER), reason="no tokenizer files")


def docs(spark, n=600):
    source = F.when(F.col("id") % 10 < 6, "Big Source").when(F.col("id") % 10 < 9, "mid-source").otherwise("small_source\n")
    return spark.range(n).select(F.col("id").alias("doc_id"), source.alias("source"), F.repeat(F.lit("some words here "), (1 + F.col("id") % 7).cast("int")).alias("text"))


def targets(spark, *t):
    return spark.createDataFrame(t, "source_name string, target_share double, max_repeats int")


T3 = (("big-source", 0.3, 1), ("mid-source", 0.3, 2), ("small-source", 0.4, 3))


def test_shares(spark):
    chosen, report = mx.mix(docs(spark), targets(spark, *T3))
    r = {x.source: x for x in report.collect()}
    for n, s, most in T3:
        assert r[n].share == pytest.approx(s, abs=0.01) and r[n].mixed_tokens <= most * r[n].available_tokens
    assert chosen.agg(F.max("copies")).first()[0] <= 3 and chosen.groupBy("doc_id").count().where("count > 1").count() == 0
    assert sum(x.mixed_tokens for x in r.values()) == chosen.agg(F.sum(F.col("copies") * F.col("n_tokens"))).first()[0]
    assert rows(chosen) == rows(mx.mix(docs(spark), targets(spark, *T3))[0])


def test_thresholds_against_sorting(spark):
    rows_ = spark.range(500).select(F.lit("s").alias("source"), (1 + F.col("id") % 9).alias("n_tokens"), F.xxhash64("id").alias("h"))
    held = sorted(((r.h % 2**64, r.n_tokens) for r in rows_.collect()))
    for budget in (1.0, 7.0, 400.0, 1300.5, 10_000.0):
        below = mx._thresholds(rows_, {"s": budget})["s"] % 2**64
        best = min(abs(sum(n for _, n in held[:k]) - budget) for k in range(len(held) + 1))
        assert abs(sum(n for h, n in held if h < below) - budget) == best


def test_token_counts(spark):
    import base64

    import tiktoken

    with open(mx.TOKENIZER, "rb") as f:
        enc = tiktoken.Encoding("t", pat_str=mx.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})
    texts = ["", None, "hello world", "Ünïcode — 你好 " * 50, "x" * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert rows(mx.with_token_counts(df, "t", ["i"])) == [(i, len(enc.encode_ordinary(t)) if t else 0) for i, t in enumerate(texts)]


def test_edges(spark):
    chosen, report = mx.mix(docs(spark).limit(0), targets(spark, *T3))
    assert chosen.count() == 0 and report.count() == 3 and report.agg(F.sum("mixed_tokens")).first()[0] == 0
    chosen, report = mx.mix(docs(spark), targets(spark, ("absent", 0.5, 2), ("mid-source", 0.5, 1), (None, 0.1, 1), ("zero", 0.0, 1)))
    r = {x.source: x for x in report.collect()}
    assert r["mid-source"].mixed_tokens == r["mid-source"].available_tokens and r["absent"].share == 0.0
    odd = spark.createDataFrame([(1, "a", None), (1, "a", ""), (2, None, "x y"), (3, "a", "x y"), (3, "a", "x y")], "doc_id bigint, source string, text string")
    chosen, _ = mx.mix(odd, targets(spark, ("a", 1.0, 2)))
    assert [(x.doc_id, x.copies) for x in chosen.collect()] == [(3, 2), (3, 2)]
    with pytest.raises(ValueError):
        mx.mix(odd, targets(spark, ("a", -1.0, 2)))
