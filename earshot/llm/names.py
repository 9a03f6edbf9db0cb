"""Which of some names a spelling stands for."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from earshot.functions.text import plain


def name_key(c: Column) -> Column:
    """What a source name is apart from its spelling: the letters and digits of its last path part."""
    last = F.regexp_extract(F.regexp_replace(plain(c), r"\\", "/"), r"([^/]*?)[/\s]*$", 1)
    return F.regexp_replace(last, "[^a-z0-9]", "")


def one_slip(a: Column, b: Column) -> Column:
    """One letter altered, left out, put in, or two neighbours swapped (letters in another order at two edits)."""
    distance = F.levenshtein(a, b)
    letters = lambda x: F.array_sort(F.split(x, ""))
    return (distance <= 1) | ((distance == 2) & (F.length(a) == F.length(b)) & (letters(a) == letters(b)))


def named(c: Column, names: list[str], slips: bool = True) -> Column:
    """Which of `names` (plain spellings) the value names, however written; null if none does.

    With `slips`, a name of six letters or more is still known by one slip if only one of the names is that near. `names` becomes part of the expression, so it must be small;
    the callers check that."""
    keys = {"".join(ch for ch in n.lower() if ch.isalnum()): n for n in names}
    key = name_key(c)
    if not keys:
        return F.lit(None).cast("string")
    table = F.create_map(*[F.lit(x) for kv in keys.items() for x in kv])
    exact = F.try_element_at(table, key)
    if not slips:
        return exact
    options = F.array(*[F.lit(k) for k in keys if len(k) >= 6]) if any(len(k) >= 6 for k in keys) else F.array().cast("array<string>")
    near = F.filter(options, lambda k: one_slip(k, key))
    return F.when(exact.isNotNull(), exact).when((F.length(key) >= 5) & (F.size(near) == 1), F.try_element_at(table, F.try_element_at(near, F.lit(1))))
