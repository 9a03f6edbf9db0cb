"""Small results as Markdown, HTML and text. A frame of more rows than a report can hold is refused, not cut."""

from __future__ import annotations

import html
import math
from collections.abc import Callable

from pyspark.sql import DataFrame

MOST = 2000


def _table(df: DataFrame, most: int) -> tuple[list[str], list[list[str]]]:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report holds {most} rows at most")
    return df.columns, [[_cell(v) for v in r] for r in rows]


def _cell(v: object) -> str:
    if v is None or (isinstance(v, float) and not math.isfinite(v)):
        return ""
    return f"{v:.6g}" if isinstance(v, float) else str(v)


def markdown(df: DataFrame, title: str = "", most: int = MOST) -> str:
    names, rows = _table(df, most)
    line: Callable[[list[str]], str] = lambda x: "| " + " | ".join(v.replace("|", "\\|").replace("\n", " ") for v in x) + " |"
    return "\n".join([*([f"## {title}", ""] if title else []), line(names), "|" + "-|" * len(names), *map(line, rows), ""])


def page(tables: dict[str, DataFrame], title: str, most: int = MOST) -> str:
    """One HTML page of titled tables."""
    out = [f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        names, rows = _table(df, most)
        row: Callable[[list[str], str], str] = lambda x, tag: "<tr>" + "".join(f"<{tag}>{html.escape(v)}</{tag}>" for v in x) + "</tr>"
        out.append(f"<h2>{html.escape(name)}</h2><table>{row(names, 'th')}{''.join(row(r, 'td') for r in rows)}</table>")
    return "\n".join(out)


def bars(df: DataFrame, label: str, value: str, width: int = 40, most: int = MOST) -> str:
    """A text bar chart, longest at `width` signs."""
    rows = [(str(r[label]), float(r[value] or 0)) for r in df.select(label, value).limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"a report holds {most} rows at most")
    top = max((v for _, v in rows), default=0) or 1
    pad = max((len(k) for k, _ in rows), default=0)
    return "\n".join(f"{k:<{pad}} {'#' * round(width * v / top)} {v:g}" for k, v in rows)
