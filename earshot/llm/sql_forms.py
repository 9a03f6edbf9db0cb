"""The plain forms of speakers, splits and paths in DuckDB's SQL, with the same tables, for the queries' SQL."""

from __future__ import annotations

from earshot.functions.text import folding

_FROM, _OUT = folding()


def plain_sql(x: str) -> str:
    return f"lower(translate({x}, '{''.join(_FROM)}{_OUT}', '{''.join(_FROM.values()).replace("'", "''")}'))"


def _numbered(x: str) -> str:
    return f"(CASE WHEN {x} <> '' THEN 'spk_' || lpad(regexp_replace(replace({x}, 'o', '0'), '^0+([0-9])', '\\1'), 9, '0') END)"


def id_sql(x: str) -> str:
    return _numbered(f"regexp_extract({plain_sql(x)}, '^\\s*(?:spk|speaker)?[\\s_.:#-]*([0-9o]*[0-9][0-9o]*)(?:\\.0+)?\\s*$', 1)")


def folder_sql(path: str) -> str:
    return _numbered(f"regexp_extract({path}, '/(?:spk|speaker)[_ .-]?([0-9o]*[0-9][0-9o]*)/', 1)")


def split_sql(x: str) -> str:
    """train, validation or test, or null."""
    s = f"trim({plain_sql(f"translate({x}, chr(10) || chr(9), '  ')")})"
    return f"(CASE {s} WHEN 'train' THEN 'train' WHEN 'val' THEN 'validation' WHEN 'validation' THEN 'validation' WHEN 'test' THEN 'test' END)"


def path_sql(x: str) -> str:
    slashed = f"replace({plain_sql(f'url_decode({x})')}, '\\', '/')"
    return f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({slashed}, '^\\s*(?:file:|[a-z]:)?', '/'), '\\s+$', ''), '/(?:\\./|/)*', '/', 'g'), '/[^/]+/\\.\\./', '/', 'g')"
