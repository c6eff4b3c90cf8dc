"""Small results as Markdown or CSV text."""

from __future__ import annotations

import csv
import html
import io

from pyspark.sql import DataFrame

from ..guard import cell

MOST_ROWS = 10_000


def rows_of(df: DataFrame, most: int = MOST_ROWS) -> list[list]:
    """Rows of a report; a result that is larger than a report may be is refused."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are no report")
    return [[cell(v) for v in r] for r in rows]


def markdown(df: DataFrame, title: str) -> str:
    """A table whose columns line up; marks of the format inside a cell become entities."""
    table = [list(df.columns), *([("" if v is None else str(v)) for v in r] for r in rows_of(df))]
    table = [[html.escape(v, quote=False).replace("|", "&#124;").replace("\r", " ").replace("\n", "<br>") for v in r] for r in table]
    wide = [max(3, *(len(r[i]) for r in table)) for i in range(len(df.columns))]
    table.insert(1, ["-" * w for w in wide])
    body = "\n".join(f"| {' | '.join(v.ljust(w) for v, w in zip(r, wide, strict=True))} |" for r in table)
    return f"## {title}\n\n{body}\n"


def as_csv(df: DataFrame) -> str:
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(df.columns)
    writer.writerows(rows_of(df))
    return out.getvalue()


def chart(values: list[float], width: int = 640, height: int = 120) -> str:
    """A line of values as inline SVG, scaled to its box."""
    top, step = max([*map(float, values), 1e-12]), width / max(1, len(values) - 1)
    points = " ".join(f"{i * step:.1f},{height - height * float(v) / top:.1f}" for i, v in enumerate(values))
    return f'<svg viewBox="0 0 {width} {height}" width="{width}" height="{height}"><polyline fill="none" stroke="currentColor" points="{points}"/></svg>'


def page(title: str, series: dict[str, DataFrame]) -> str:
    """A page that needs no other file: for each (label, value) frame a chart and its rows."""
    parts = [f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>"]
    for name, df in series.items():
        rows = rows_of(df)
        cells = "".join(f"<tr><td>{html.escape(str(a))}</td><td>{html.escape(str(b))}</td></tr>" for a, b in rows)
        parts.append(f"<h2>{html.escape(name)}</h2>{chart([r[1] or 0 for r in rows])}<table>{cells}</table>")
    return "".join([*parts, "</body></html>"])
