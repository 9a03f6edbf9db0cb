"""Array expressions, all within the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def let(value: Column, f) -> Column:
    """f(value) with the value worked out once a row, however often f names it. Without it an expression inside a lambda is worked out again for each element."""
    return F.element_at(F.transform(F.array(value), f), 1)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda x, v: x + v.cast("double"))


def placed(a: Column) -> Column:
    """The sum of the values, each times its place from 1 on: unlike a plain sum it tells where values stand."""
    return total(F.transform(a, lambda v, i: v.cast("double") * (i + 1)))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda v: v.cast("double") * v.cast("double"))))


def normalised(a: Column) -> Column:
    """Of length one; a zero array stays as it is."""
    return let(norm(a), lambda n: F.transform(a, lambda v: v.cast("double") / F.when(n == 0, 1.0).otherwise(n)))


def cosine(a: Column, b: Column) -> Column:
    """0 if a side is zero."""
    return let(norm(a) * norm(b), lambda n: F.when(n == 0, 0.0).otherwise(dot(a, b) / n))


def pad_or_cut(a: Column, size: int | Column) -> Column:
    """The first `size` values, zeros behind where there are fewer."""
    return F.slice(F.concat(a, F.array_repeat(F.lit(0).cast("float"), F.lit(size) if isinstance(size, int) else size)), F.lit(1), F.lit(size) if isinstance(size, int) else size)


def fixed_length(a: Column, size: int, strategy: str, drawn: Column | None = None) -> Column:
    """`size` values: cut at the start or end, at a random place by a number drawn for the row, or nothing for longer arrays; shorter ones get zeros in front."""
    n = F.size(a)
    short = F.concat(F.array_repeat(F.lit(0).cast("float"), F.greatest(F.lit(0), size - n)), a)
    if strategy == "truncate_start":
        long = F.slice(a, n - size + 1, F.lit(size))
    elif strategy in ("truncate_end", "fixed_right_cutoff"):
        long = F.slice(a, 1, size)
    elif strategy == "random":
        long = F.slice(a, F.pmod(drawn, F.greatest(n - size + 1, F.lit(1))).cast("int") + 1, F.lit(size))
    elif strategy == "none":
        long = a
    else:
        raise ValueError(f"unknown strategy {strategy}")
    return F.when(n <= size, short).otherwise(long)


def masked(a: Column, start: Column, end: Column) -> Column:
    """Zero from start to before end."""
    return F.transform(a, lambda v, i: F.when((i >= start) & (i < end), F.lit(0).cast("float")).otherwise(v))


def resampled(a: Column, size: int) -> Column:
    """Linear interpolation to `size` values."""
    n = F.size(a)
    at = lambda i: i * (n - 1) / F.lit(float(max(1, size - 1)))
    value = lambda p: F.element_at(a, F.floor(p).cast("int") + 1).cast("double") * (1 - (p - F.floor(p))) + F.element_at(a, F.least(F.floor(p).cast("int") + 2, n)).cast("double") * (p - F.floor(p))
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: value(at(i)))


def trimmed_zeros(a: Column) -> Column:
    """Without zeros at either end; all zeros give an empty array."""
    places = F.filter(F.transform(a, lambda v, i: F.when(v != 0, i + 1)), lambda x: x.isNotNull())
    first, last = F.array_min(places), F.array_max(places)
    return F.when(F.size(places) == 0, F.slice(a, 1, 0)).otherwise(F.slice(a, F.coalesce(first, F.lit(1)), F.coalesce(last - first + 1, F.lit(0))))


def tiled(a: Column, size: int) -> Column:
    """Repeated until there are `size` values; an empty array gives an empty one."""
    return F.slice(F.flatten(F.array_repeat(a, F.ceil(F.lit(float(size)) / F.greatest(F.size(a), F.lit(1))).cast("int"))), 1, size)


def padded_both(a: Column, left: int, right: int) -> Column:
    z = F.lit(0).cast("float")
    return F.concat(F.array_repeat(z, left), a, F.array_repeat(z, right))


def convolved(a: Column, kernel: tuple[float, ...], peak: float) -> Column:
    """The full convolution with a short kernel, as shifted copies added up, brought to a peak; silence stays silence."""
    e = F.transform(a, lambda v: v.cast("double"))
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    scaled = lambda e, k: F.transform(e, lambda v: v * k)
    last = len(kernel) - 1

    def added(e: Column) -> Column:
        out = None
        for j, k in enumerate(kernel):
            shifted = F.concat(zeros(j), scaled(e, k), zeros(last - j))
            out = shifted if out is None else F.zip_with(out, shifted, lambda x, y: x + y)
        return let(out, lambda y: let(F.array_max(F.transform(y, lambda v: F.abs(v))), lambda p: F.transform(y, lambda v: F.when(p == 0, 0.0).otherwise(v / p * peak))))

    return let(e, added)
