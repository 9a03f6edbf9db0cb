"""Speaker ids, splits and clip paths in their plain forms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from earshot.functions.text import plain

PLAIN_SPEAKER = r"^spk_[0-9]{9}$"
_SPEAKER = r"^\s*(?:spk|speaker)?[\s_.:#-]*([0-9o]*[0-9][0-9o]*)(?:\.0+)?\s*$"


def numbered(text: Column, pattern: str) -> Column:
    """The plain form of the speaker whose number the pattern finds, or null."""
    digits = F.regexp_replace(F.translate(F.regexp_extract(text, pattern, 1), "o", "0"), "^0+(?=.)", "")
    return F.when(digits == "", None).otherwise(F.concat(F.lit("spk_"), F.lpad(digits, F.greatest(F.length(digits), F.lit(9)), F.lit("0"))))


def speaker(c: Column) -> Column:
    """`spk_` and nine digits for any spelling of a speaker id; null for null, stand-ins and whatever names no number."""
    return F.when(c.rlike(PLAIN_SPEAKER), c).otherwise(numbered(plain(c), _SPEAKER))


def split_name(c: Column) -> Column:
    """train, validation or test; null if the value names none of them."""
    s = F.trim(plain(F.translate(c, "\t\r\n", "   ")))
    return F.when(s == "train", "train").when(s.isin("val", "validation"), "validation").when(s == "test", "test")
