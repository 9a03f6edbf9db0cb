"""Clip paths in one spelling and the speaker that a folder names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from earshot.functions.speakers import numbered
from earshot.functions.text import is_ascii, plain


def clip_path(c: Column) -> Column:
    """One spelling of a path: plain letters, forward slashes, no scheme, drive, `.`, `..`, doubled slash or outer blanks."""
    raw = F.when(F.instr(c, "%") > 0, F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)).otherwise(c)
    s = F.replace(plain(raw), F.lit("\\"), F.lit("/"))
    tidy = F.regexp_replace(F.regexp_replace(s, r"^\s*(?:file:|[a-z]:(?=/))?", "/"), r"\s+$", "")
    tidy = F.regexp_replace(tidy, r"/(?:\./|/)*", "/")
    while_up = tidy
    for _ in range(2):
        while_up = F.regexp_replace(while_up, r"/(?!\.\./)[^/]+/\.\./", "/")
    # Most paths need nothing of this.
    return F.when(is_ascii(c) & c.rlike(r"^(?:/[a-z0-9_][a-z0-9_.]*)+$"), c).otherwise(while_up)


def folder_speaker(path: Column) -> Column:
    """The speaker that a folder of a `clip_path` names, or null."""
    return F.when(F.instr(path, "/sp") > 0, numbered(path, r"/(?:spk|speaker)[_ .-]?([0-9o]*[0-9][0-9o]*)/"))
