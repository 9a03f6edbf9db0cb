"""Spelling-blind forms of strings, as Catalyst expressions and as Python functions with the same tables."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

# Letters of other scripts that look like Latin ones, lower and upper case.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ѐ": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o",
    "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ſ": "s", "ɑ": "a", "ɡ": "g", "ß": "s",
}
_HIGH = re.compile("[^\x00-\x7f]+")
SPACES = "                 　"


@lru_cache(maxsize=1)
def folding() -> tuple[dict[str, str], str]:
    """(each character's single plain character, the characters to leave out), by rule from the Unicode tables."""
    to: dict[str, str] = dict(LOOK_ALIKES)
    out: list[str] = []
    for code in range(0x80, 0x10000):
        if 0xD800 <= code < 0xE000 or 0x3400 <= code < 0xD7FF:
            continue
        ch = chr(code)
        if ch in to:
            continue
        if ch in SPACES:
            to[ch] = " "
        elif unicodedata.category(ch) in ("Cf", "Mn", "Cc"):
            out.append(ch)
        else:
            plain = "".join(x for x in unicodedata.normalize("NFKD", ch) if unicodedata.category(x) != "Mn")
            if len(plain) == 1 and plain.isascii():
                to[ch] = plain
    for code in range(0x80, 0x3000):  # capitals of what is folded
        ch, low = chr(code), chr(code).lower()
        if ch not in to and low != ch and low in to:
            to[ch] = to[low]
    return to, "".join(out)


@lru_cache(maxsize=1)
def _translation() -> tuple[str, str]:
    to, out = folding()
    return "".join(to) + out, "".join(to.values())


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def plain(c: Column) -> Column:
    """Lower case with accents, full-width forms, look-alikes and unseen characters folded away. Null stays null."""
    source, target = _translation()
    return F.lower(F.when(is_ascii(c), c).otherwise(F.translate(c, source, target)))


@lru_cache(maxsize=1)
def plain_table() -> dict[int, str | None]:
    to, out = folding()
    return {ord(k): v for k, v in to.items()} | {ord(x): None for x in out}


def folded_py(s: str, table: dict) -> str:
    """`s` with what isn't ASCII folded by `plain_table()`. Only the runs outside ASCII are looked up, which in most texts are few."""
    return s if s.isascii() else _HIGH.sub(lambda m: m.group().translate(table), s)


def plain_py(s: str) -> str:
    """`plain` for one Python string."""
    return folded_py(s, plain_table()).lower()
