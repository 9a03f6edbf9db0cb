"""Jaro-Winkler similarity, which Spark lacks, as an Arrow function."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F


def jaro_winkler_py(a: str, b: str, boost: float = 0.1) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used_a, used_b = [False] * len(a), [False] * len(b)
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used_b[j] and b[j] == ch:
                used_a[i] = used_b[j] = True
                break
    x, y = [c for c, u in zip(a, used_a) if u], [c for c, u in zip(b, used_b) if u]
    m = len(x)
    if not m:
        return 0.0
    swapped = sum(p != q for p, q in zip(x, y)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    prefix = 0
    for p, q in zip(a[:4], b[:4]):
        if p != q:
            break
        prefix += 1
    return jaro + prefix * boost * (1 - jaro) if jaro > 0.7 else jaro


def jaro_winkler(a: Column, b: Column) -> Column:
    """In 0..1; 0 for an empty or null side."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        known: dict[tuple, float] = {}
        out = []
        for pair in zip(x, y, strict=True):
            if pair not in known:
                known[pair] = jaro_winkler_py(*(v if isinstance(v, str) else "" for v in pair))
            out.append(known[pair])
        return pd.Series(out, dtype="float64")

    return run(a, b)
