"""WAV files as rows: scans, header probes, validation and decoding by Arrow functions over binary content."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

EXTENSIONS = ("wav", "mp3", "flac", "ogg", "m4a", "aac")
INFO = "struct<rate:int,channels:int,bits:int,frames:bigint,duration_ms:double,error:string>"


def scan(spark: SparkSession, folders: dict[str, str], extensions: Sequence[str] = ("wav",)) -> DataFrame:
    """(path, length, modificationTime, content, label) of all files under each label's folder, extensions in either case. No folder raises; `content` is read only where it is used."""
    if not folders:
        raise ValueError("no folder to scan")
    out = None
    for label, folder in folders.items():
        part = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).withColumn("label", F.lit(label))
        out = part if out is None else out.unionByName(part)
    return out.where(F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)).isin([e.lower() for e in extensions]))


def size_duration_ms(length: Column, rate: int = 16000, frame_bytes: int = 2, header: int = 44) -> Column:
    """Duration by file size alone."""
    return (length - header) * 1000.0 / (rate * frame_bytes)


def _probe(b: bytes) -> tuple[dict, int, int]:
    """(format, data start, data size) of WAV bytes; raises ValueError."""
    if len(b) < 12 or b[:4] != b"RIFF" or b[8:12] != b"WAVE":
        raise ValueError("no RIFF/WAVE header")
    at, fmt = 12, None
    while at + 8 <= len(b):
        name, size = b[at : at + 4], struct.unpack_from("<I", b, at + 4)[0]
        if name == b"fmt ":
            if size < 16 or at + 24 > len(b):
                raise ValueError("short format chunk")
            kind, channels, rate, _, block, bits = struct.unpack_from("<HHIIHH", b, at + 8)
            if not channels or not rate or not block:
                raise ValueError("bad format chunk")
            fmt = {"kind": kind, "channels": channels, "rate": rate, "block": block, "bits": bits}
        elif name == b"data":
            if fmt is None:
                raise ValueError("data before format")
            return fmt, at + 8, size
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def _info(b: bytes | None) -> dict:
    none = {"rate": None, "channels": None, "bits": None, "frames": None, "duration_ms": -1.0}
    if b is None:
        return none | {"error": "missing"}
    try:
        fmt, start, size = _probe(b)
    except ValueError as e:
        return none | {"error": str(e)}
    frames = min(size, max(0, len(b) - start)) // fmt["block"]
    return {"rate": fmt["rate"], "channels": fmt["channels"], "bits": fmt["bits"], "frames": frames, "duration_ms": frames * 1000.0 / fmt["rate"], "error": None}


def wav_info(content: Column) -> Column:
    """Rate, channels, bits, frames and duration, or an error; never fails."""

    @F.pandas_udf(INFO)
    def run(x: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_info(b) for b in x], columns=["rate", "channels", "bits", "frames", "duration_ms", "error"]).astype({"rate": "Int32", "channels": "Int32", "bits": "Int32", "frames": "Int64"})

    return run(content)


def wav_check(content: Column, rate: int = 16000) -> Column:
    """What makes a file unfit (not 16-bit mono PCM of the rate, no frames, cut off), or null."""

    def one(b: bytes | None) -> str | None:
        if b is None:
            return "missing"
        try:
            fmt, start, size = _probe(b)
        except ValueError as e:
            return str(e)
        if fmt["rate"] != rate:
            return f"rate {fmt['rate']}"
        if fmt["bits"] != 16:
            return f"{fmt['bits']} bits"
        if fmt["channels"] != 1:
            return f"{fmt['channels']} channels"
        if size < fmt["block"]:
            return "no frames"
        return "cut off" if start + size > len(b) else None

    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series([one(b) for b in x], dtype="object")

    return run(content)


def pcm(b: bytes | None) -> list[float] | None:
    """Samples in -1..1 of 8, 16, 24 or 32-bit PCM, the mean of the channels; None if it can't be read."""
    if b is None:
        return None
    try:
        fmt, start, size = _probe(b)
    except ValueError:
        return None
    raw = b[start : start + size]
    width = fmt["bits"] // 8
    raw = raw[: len(raw) // fmt["block"] * fmt["block"]]
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 2:
        x = np.frombuffer(raw, "<i2").astype(np.float32) / 32768
    elif width == 3:
        u = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        v = u[:, 0] | u[:, 1] << 8 | u[:, 2] << 16
        x = (np.where(v >= 1 << 23, v - (1 << 24), v) / float(1 << 23)).astype(np.float32)
    elif width == 4:
        x = (np.frombuffer(raw, "<i4") / float(1 << 31)).astype(np.float32)
    else:
        return None
    return x.reshape(-1, fmt["channels"]).mean(1).tolist()


def wav_samples(content: Column) -> Column:
    @F.pandas_udf("array<float>")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series([pcm(b) for b in x], dtype="object")

    return run(content)


def pcm_ints(b: bytes | None) -> list[int] | None:
    """16-bit samples of 8-bit unsigned, 16, 24 or 32-bit PCM: wider ones lose their low bits, two or more channels give their average rounded down. None if it can't be read."""
    if b is None:
        return None
    try:
        fmt, start, size = _probe(b)
    except ValueError:
        return None
    width, raw = fmt["bits"] // 8, b[start : start + size]
    if width not in (1, 2, 3, 4):
        return None
    u = np.frombuffer(raw[: len(raw) // fmt["block"] * fmt["block"]], np.uint8).reshape(-1, width).astype(np.int64)
    value = sum(u[:, k] << 8 * k for k in range(width))
    value = value - 128 if width == 1 else np.where(value >= 1 << 8 * width - 1, value - (1 << 8 * width), value)
    v16 = value << 8 if width == 1 else value >> 8 * (width - 2)
    return (v16.reshape(-1, fmt["channels"]).sum(1) // fmt["channels"]).tolist()


def wav_ints(content: Column) -> Column:
    @F.pandas_udf("array<int>")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series([pcm_ints(b) for b in x], dtype="object")

    return run(content)


def wav_header(size: int, rate: int = 16000, bits: int = 16, channels: int = 1) -> bytes:
    """The 44 bytes in front of `size` bytes of samples."""
    width = bits // 8
    return b"RIFF" + struct.pack("<I", 36 + size) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, channels, rate, rate * width * channels, width * channels, bits) + b"data" + struct.pack("<I", size)


def wav_bytes(samples: Sequence[float], rate: int = 16000, bits: int = 16, channels: int = 1) -> bytes:
    width = bits // 8
    ints = [max(-(1 << bits - 1), min((1 << bits - 1) - 1, round(v * (1 << bits - 1)))) for v in samples]
    data = bytes((v + 128) & 255 for v in ints) if width == 1 else b"".join(v.to_bytes(width, "little", signed=True) for v in ints)
    return wav_header(len(data), rate, bits, channels) + data


def synthetic_corpus(spark: SparkSession, counts: dict[str, int] | None = None, seconds: float = 1.0, seed: int = 42) -> DataFrame:
    """(label, name, content): sine clips with noise by a hash, made in the tasks; 10 positive, 50 negative and 20 hard negative ones by default."""
    counts = counts or {"positive": 10, "negative": 50, "hard_negative": 20}
    rows = spark.createDataFrame([(k, n) for k, n in counts.items()], "label string, n int").select("label", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for label, i in zip(pdf["label"], pdf["i"]):
                r = np.random.default_rng([seed, i, *label.encode()])
                t = np.arange(int(16000 * seconds)) / 16000
                x = 0.5 * np.sin(2 * math.pi * (220 + 20 * i) * t) + 0.05 * r.standard_normal(len(t))
                out.append((label, f"{label}_{i:03d}.wav", wav_bytes(np.clip(x, -1, 1))))
            yield pd.DataFrame(out, columns=["label", "name", "content"])

    return rows.repartition(8).mapInPandas(make, "label string, name string, content binary")


def write_files(corpus: DataFrame, root: str) -> None:
    """Writes (label, name, content) as files of the workspace's file system, one at a time through the driver: for small corpora."""
    jvm = corpus.sparkSession.sparkContext._jvm
    conf = corpus.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for r in corpus.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{r['label']}/{r['name']}")
        out = path.getFileSystem(conf).create(path, True)
        out.write(bytes(r["content"]))
        out.close()
