"""Scalar expressions of scores, decibels, quantisation and names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The parts of a clip's file name that say nothing about what was spoken, in the order in which they are taken off.
NAME_NOISE = (
    r"[-_]v?\d+$",
    r"[-_]?(sample|recording|clip|audio|rec|take|noise|ambient)[-_]?\d*$",  # in any case
    r"[-_]?\d{8}[-_]?\d{4,6}",
    r"[-_]?\d{8}$",
    r"[-_](?=.*(\d))(?=.*([a-z]))[a-z0-9]{4,6}(?=[-_])",
    r"[-_]\d{1,3}$",
)

# How a file's name gives its speaker, in order.
SPEAKER_IN_NAME = (r"^(hey_[a-zA-Z0-9]+)_\d{8}", r"^([a-zA-Z][a-zA-Z0-9]+)_\d{8,}")


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/](\.[^./]*)$", 1)


def parent(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/[^/]*$", 1)


def spoken_text(path: Column) -> Column:
    """What a file's name says was spoken: lower case words; `unknown` if nothing is left."""
    s = stem(path)
    for k, pattern in enumerate(NAME_NOISE):
        s = F.regexp_replace(s, "(?i)" + pattern if k == 1 else pattern, "")
    words = F.trim(F.regexp_replace(F.lower(F.regexp_replace(s, r"[-_]+", " ")), r"\s+", " "))
    return F.regexp_replace(words, "^$", "unknown")  # names the chain once, so that it is worked out once


def snake_case(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.regexp_replace(c, r"(?<=[a-z0-9])(?=[A-Z])", "_"))), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def named_speaker(path: Column, labels: list[str]) -> Column:
    """The speaker by the file's name, else its folder unless that is a label."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    some = lambda p: F.nullif(F.regexp_extract(name, p, 1), F.lit(""))
    folder = F.nullif(parent(path), F.lit(""))
    return F.coalesce(*map(some, SPEAKER_IN_NAME), F.when(~folder.isin(labels), folder))


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), x))))


def logit(p: Column, eps: float = 1e-7) -> Column:
    q = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), p))
    return F.log(q / (1 - q))


def temperature_scaled(p: Column, t: float) -> Column:
    return p if abs(t - 1) < 1e-6 else sigmoid(logit(p) / t)


def platt(p: Column, scale: float, bias: float) -> Column:
    return p if (scale, bias) == (1, 0) else sigmoid(scale * logit(p) + bias)


def to_uint8(p: Column) -> Column:
    """0..1 as 0..255, halves to even."""
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)) * 255, 0).cast("int")


def to_int8(x: Column, scale: float, zero_point: int, rounded: bool = True) -> Column:
    """Quantised to -128..127, rounded half to even or cut off."""
    q = x / scale + zero_point
    return F.greatest(F.lit(-128), F.least(F.lit(127), (F.bround(q, 0) if rounded else q).cast("int")))


def dequantised(q: Column, scale: float, zero_point: int) -> Column:
    return scale * (q - zero_point)


def quality_fast(snr: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), snr / 30.0))


def quality_full(overall: Column, vad: Column, snr: Column) -> Column:
    return 0.5 * (overall - 1) / 4 + 0.3 * vad + 0.2 * quality_fast(snr)


def risk(score: Column, high: float = 0.82, medium: float = 0.72) -> Column:
    return F.when(score >= high, "HIGH").when(score >= medium, "MEDIUM").otherwise("LOW")


def gain(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 20)


def finite(x: Column) -> Column:
    """Null for what JSON can't hold."""
    return F.when(F.isnan(x) | x.isin(float("inf"), float("-inf")), None).otherwise(x)


def pretty_size(n: Column) -> Column:
    out = F.format_string("%d B", n)
    for i, unit in enumerate(("KB", "MB", "GB", "TB"), 1):
        out = F.when(n >= 1024**i, F.format_string(f"%.1f {unit}", n / float(1024**i))).otherwise(out)
    return out


def pretty_duration(seconds: Column) -> Column:
    s = F.floor(seconds)
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("bigint"), F.floor(s % 3600 / 60).cast("bigint"), (s % 60).cast("bigint"))


def frame_count(n: Column, window: int, step: int) -> Column:
    return F.greatest(F.lit(1), F.ceil((n - window) / F.lit(float(step))).cast("int") + 1)


def parse_ints(c: Column) -> Column:
    """Integers of "1,2" or lists of "[5],[7,11]" as a flat array; null if it is neither."""
    return F.coalesce(F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<int>"), F.flatten(F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<array<int>>")))


def scaled_rate(base: float, batch: Column, reference: int, rule: str = "sqrt") -> Column:
    f = batch / float(reference)
    return base * (F.sqrt(f) if rule == "sqrt" else f)


def receptive_field(first_kernel: int, blocks: list[tuple[Column, Column, Column]]) -> Column:
    """Rows that a stack of convolutions sees: its first kernel, and for each block (repeats, kernels, stride) repeats x (largest kernel - 1) x stride."""
    return sum((repeats * (F.array_max(kernels) - 1) * stride for repeats, kernels, stride in blocks), F.lit(first_kernel))
