"""HTML tables as grids: parsing, span expansion, repair and splitting.

The kernels work on one table's text in Arrow batches; where no span is
involved ``rough_grid`` does the same on the JVM.

Cases: null and empty html and html without a row give an empty grid; spans that
are no positive number count as one; ragged rows are padded with '' in the
spanned form and left as they are in the rough one.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from folioforge.functions import text as tx

#: Fixed value: the most columns of a cell by the HTML standard.
MAX_COLS = 1000


class Cell(NamedTuple):
    """One cell as written: its text, spans and whether it is a header cell."""

    text: str
    rows: int
    cols: int
    header: bool


def _span(value: str | None) -> int:
    return int(value) if value and value.strip().isdigit() and int(value) > 0 else 1


class _Reader(HTMLParser):
    """Rows of cells of the outermost table; nested tables add their text to the cell around them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[Cell]] = []
        self._depth = 0
        self._text: list[str] | None = None
        self._shape = (1, 1, False)

    def _close(self) -> None:
        if self._text is not None:
            lines = [" ".join(x.split()) for x in "".join(self._text).split("\n")]
            self.rows[-1].append(Cell("\n".join(x for x in lines if x), *self._shape))
            self._text = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "table":
            self._depth += 1
        if self._depth > 1:
            if tag in ("td", "th", "tr") and self._text is not None:
                self._text.append(" ")
            return
        if tag == "tr":
            self._close()
            self.rows.append([])
        elif tag in ("td", "th"):
            self._close()
            if not self.rows:
                self.rows.append([])
            given = dict(attrs)
            self._shape = (_span(given.get("rowspan")), min(_span(given.get("colspan")), MAX_COLS), tag == "th")
            self._text = []
        elif tag == "br" and self._text is not None:
            self._text.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag == "table":
            self._depth -= 1
        if self._depth <= 1 and tag in ("td", "th", "tr") or tag == "table" and self._depth == 0:
            self._close()

    def handle_data(self, data: str) -> None:
        if self._text is not None:
            self._text.append(re.sub(r"\s+", " ", data))


def read_cells(html: str | None) -> list[list[Cell]]:
    """Rows of cells as written."""
    if not html:
        return []
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader._close()
    return [r for r in reader.rows if r]


def place_cells(rows: Sequence[Sequence[Cell]]) -> list[list[tuple[Cell, bool] | None]]:
    """For every place of the grid its cell and whether it stands there itself; None where nothing reaches."""
    grid: list[dict[int, tuple[Cell, bool]]] = [{} for _ in rows]
    for y, row in enumerate(rows):
        x = 0
        for cell in row:
            while x in grid[y]:
                x += 1
            for dy in range(min(cell.rows, len(rows) - y)):
                for dx in range(cell.cols):
                    grid[y + dy].setdefault(x + dx, (cell, dx == dy == 0))
            x += cell.cols
    width = max((max(r, default=-1) + 1 for r in grid), default=0)
    return [[r.get(x) for x in range(width)] for r in grid]


def spanned_grid(html: str | None) -> list[list[str]]:
    """Rectangular grid in which spanning cells stand at every place they cover."""
    return [[c[0].text if c else "" for c in row] for row in place_cells(read_cells(html))]


def write_table(rows: Sequence[Sequence[tuple[str, int, int]]]) -> str:
    """Html of rows of (text, rowspan, colspan)."""

    def cell(text: str, down: int, across: int) -> str:
        inner = "<br>".join(markup.escape(x, quote=False) for x in text.split("\n"))
        return f"<td{f' rowspan="{down}"' if down > 1 else ''}{f' colspan="{across}"' if across > 1 else ''}>{inner}</td>"

    return "<table>" + "".join("<tr>" + "".join(cell(*c) for c in row) + "</tr>" for row in rows) + "</table>"


def expand_rows(html: str | None) -> str | None:
    """Row spans written out; column spans stay."""
    if not html:
        return html
    out = []
    for row in place_cells(read_cells(html)):
        cells, x = [], 0
        while x < len(row):
            at = row[x]
            across = 1
            while at and x + across < len(row) and row[x + across] and row[x + across][0] is at[0] and across < at[0].cols:
                across += 1
            cells.append((at[0].text if at else "", 1, across))
            x += across
        out.append(cells)
    return write_table(out)


def expand_columns(html: str | None) -> str | None:
    """Column spans written out, but a row of one and the same text stays one cell across the table."""
    if not html:
        return html
    out = []
    for row in place_cells(read_cells(html)):
        texts = [c[0].text if c else "" for c in row]
        if len(texts) > 1 and texts[0] and len(set(texts)) == 1:
            out.append([(texts[0], 1, len(texts))])
        else:
            out.append([(t, 1, 1) for t in texts])
    return write_table(out)


def split_merged(html: str | None, words: Sequence[str] = ("pin", "name", "no", "number", "type", "description", "signal", "ball", "terminal", "引脚", "名称", "类型", "描述")) -> list[str]:
    """Parts of a table that was joined from several: cut where a section row is followed by the repeated header.

    Needs five rows and two columns; the header must be the first row or follow
    a section row, hold two field words, and both parts need a data row; no row
    span may cross the cut.
    """
    rows = read_cells(html)
    placed = place_cells(rows)
    width = len(placed[0]) if placed else 0
    if len(rows) < 5 or width < 2:
        return [html] if html else []

    def section(y: int) -> bool:
        texts = {c[0].text for c in placed[y] if c}
        return len(rows[y]) == 1 and rows[y][0].cols >= width and len(texts) == 1

    def form(y: int) -> tuple[str, ...]:
        return tuple(c.text.lower() for c in rows[y])

    start = 1 if section(0) else 0
    head = form(start)
    if len(head) < 2 or sum(any(w in h for w in words) for h in head) < 2:
        return [html]
    cuts = []
    for y in range(start + 2, len(rows) - 1):
        if form(y) == head:
            at = y - 1 if section(y - 1) else y
            crossed = any(c and not c[1] and c in placed[at - 1] for c in placed[at])
            if at > start + 1 and not crossed and (not cuts or at > cuts[-1] + 1):
                cuts.append(at)
    if not cuts:
        return [html]
    bounds = [0, *cuts, len(rows)]
    return [write_table([[(c.text, c.rows, c.cols) for c in rows[y]] for y in range(a, b)]) for a, b in zip(bounds, bounds[1:])]


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def spanned_grid_udf(html: pd.Series) -> pd.Series:
    """``spanned_grid`` for a column."""
    return html.map(spanned_grid)


@F.pandas_udf(StringType())
def expand_rows_udf(html: pd.Series) -> pd.Series:
    """``expand_rows`` for a column."""
    return html.map(expand_rows)


@F.pandas_udf(StringType())
def expand_columns_udf(html: pd.Series) -> pd.Series:
    """``expand_columns`` for a column."""
    return html.map(expand_columns)


@F.pandas_udf(ArrayType(StringType()))
def split_merged_udf(html: pd.Series) -> pd.Series:
    """``split_merged`` for a column."""
    return html.map(split_merged)


def rough_grid(html: Column, lines: bool = False) -> Column:
    """Ragged grid without span expansion, on the JVM; ``lines`` keeps the line breaks of cells."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    return F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), tx.cell_text if lines else tx.plain_text))


def has_spans(html: Column) -> Column:
    return html.rlike("(?i)(row|col)span\\s*=")


def grid(html: Column, lines: bool = False) -> Column:
    """Rectangular grid: on the JVM where the table has no span, else by the kernel; ``lines`` keeps the line breaks of cells."""
    rough = rough_grid(html, lines)
    # bound in lambdas, so that the rough grid and its width are made once
    padded = lambda g: F.transform(F.array(F.array_max(F.transform(g, F.size))), lambda w: F.transform(g, lambda r: F.concat(r, F.array_repeat(F.lit(""), w - F.size(r)))))[0]
    flat = F.transform(F.array(rough), padded)[0]
    spanned = spanned_grid_udf(F.when(has_spans(html), html))
    if not lines:
        spanned = F.transform(spanned, lambda r: F.transform(r, lambda c: F.regexp_replace(c, "\n", " ")))
    return F.when(has_spans(html), spanned).otherwise(flat)


def with_grid(df: DataFrame, html: str, name: str = "grid", lines: bool = False) -> DataFrame:
    """``df`` with the grid as a column that is made once: a generator stands between it and all that uses it."""
    return df.select("*", F.explode(F.array(grid(F.col(html), lines))).alias(name))


def cells(df: DataFrame, key: Sequence[str], html: str) -> DataFrame:
    """(key, row_idx, col_idx, text): the long form of the grid."""
    rows = with_grid(df, html).select(*key, F.posexplode("grid").alias("row_idx", "row"))
    return rows.select(*key, "row_idx", F.posexplode("row").alias("col_idx", "text"))


def build_html(df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(key, html): one table per key from relational rows, in order."""
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("</td>")) for c in columns], F.lit("</tr>"))
    grouped = df.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*order, row.alias("html_row")))).alias("rs"))
    return grouped.select(*key, F.concat(F.lit("<table>"), F.array_join(F.transform("rs", lambda r: r["html_row"]), ""), F.lit("</table>")).alias("html"))


def table_rows(html: str) -> Iterator[list[str]]:
    """Rows of the spanned grid, for callers without Spark."""
    yield from spanned_grid(html)
