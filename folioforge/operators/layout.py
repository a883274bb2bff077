"""Page layout: furniture by margin rules, reading order, sheet regions, union of tables over pages."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import geometry as geo
from folioforge.functions import text as tx

#: Thresholds of the margin rules, as shares of the page.
TOP, BOTTOM, TALL, WIDE, NOTICE, LONG = 0.075, 0.925, 0.045, 0.9, 0.74, 80
#: Words of a first-page notice.
NOTICE_WORDS = ("copyright", "all rights reserved", "confidential", "subject to change", "trademark", "disclaimer", "important notice", "版权", "保留所有权利", "声明")
PAGE_NUMBER = r"(?i)^[\s\-–—\[(]*(?:page\s+)?\d{1,4}(?:\s*(?:/|of)\s*\d{1,4})?[\s\-–—\])]*$|^第\s*\d+\s*页(?:\s*共\s*\d+\s*页)?$"


def discard_reasons(blocks: DataFrame, doc: str = "document_name", page: str = "page_idx", text: str = "content", box: str = "bbox", size: str = "page_size", kind: str = "block_type") -> DataFrame:
    """``blocks`` with ``discard_reason``, null for blocks that stay; the first rule that holds decides.

    Explicit kinds, text, first-page notice, margin bands, page numbers in the
    bottom band, and small margin blocks whose text repeats over pages.
    """
    b, w, h = geo.Box.of(F.col(box)), F.get(size, F.lit(0)), F.get(size, F.lit(1))
    unit = geo.is_unit(b)
    sx, sy = F.when(unit, F.lit(1.0)).otherwise(w), F.when(unit, F.lit(1.0)).otherwise(h)
    placed = blocks.withColumns({"_top": b.y0 / sy, "_low": b.y1 / sy, "_high": (b.y1 - b.y0) / sy, "_wide": (b.x1 - b.x0) / sx, "_form": tx.margin_form(F.col(text))})
    small = (F.col("_high") <= TALL) & (F.col("_wide") <= WIDE)
    top, bottom = (F.col("_low") <= TOP) & (F.col("_high") <= TALL), (F.col("_top") >= BOTTOM) & (F.col("_high") <= TALL)
    margin = placed.where((top | bottom) & (F.length("_form") > 0) & (F.length(text) <= LONG))
    again = margin.groupBy(doc, "_form").agg(F.count_distinct(page).alias("_pages")).where("_pages >= 2").select(doc, "_form", F.lit(True).alias("_again"))
    notice = placed.where((F.col(page) == 0) & (F.col("_top") >= NOTICE)).groupBy(doc).agg(F.lower(F.array_join(F.array_sort(F.collect_list(text)), " ")).alias("_n"))
    hits = sum((F.col("_n").contains(word).cast("int") for word in NOTICE_WORDS), F.lit(0))
    notice = notice.where(hits >= 2).select(doc, F.lit(True).alias("_notice"))
    joined = placed.join(again, [doc, "_form"], "left").join(notice, doc, "left")
    reason = (
        F.when(F.col(kind).isin("header", "footer", "page_number", "page_footnote"), "type")
        .when(F.col(text).isNull(), None)
        .when(F.trim(text) == "", "empty")
        .when(F.coalesce("_notice", F.lit(False)) & (F.col(page) == 0) & (F.col("_top") >= NOTICE) & small, "first_page_notice")
        .when(bottom & F.trim(text).rlike(PAGE_NUMBER), "page_number")
        .when((top | bottom) & small & F.coalesce("_again", F.lit(False)), "repeated_margin_text")
    )
    return joined.withColumn("discard_reason", reason).drop("_top", "_low", "_high", "_wide", "_form", "_again", "_notice")


def scanned_signals(text: Column) -> dict[str, Column]:
    """Signals that tell whether extracted text can be used: characters, abnormal share, rare-block share, runs of marks."""
    size = F.greatest(F.length(text), F.lit(1))
    return {
        "chars": F.length(F.regexp_replace(text, r"\s+", "")),
        "abnormal": F.regexp_count(text, F.lit("[\\x{1}-\\x{8}\\x{FFFD}\\x{E000}-\\x{F8FF}]")) / size,
        "suspicious": F.regexp_count(text, F.lit("[\\x{7280}-\\x{72DF}]")) / F.greatest(F.regexp_count(text, F.lit("[\\x{4e00}-\\x{9fff}]")), F.lit(1)),
        "marks": F.regexp_count(text, F.lit("[!-/:-@\\[-`{-~]")) / size,
        "runs": F.aggregate(F.transform(F.regexp_extract_all(text, F.lit("[!-/:-@\\[-`{-~]{4,}"), F.lit(0)), F.length), F.lit(0), lambda a, n: a + n) / size,
    }


def _largest_gap(low: np.ndarray, high: np.ndarray, least: float) -> float | None:
    order = np.argsort(low, kind="stable")
    reach = np.maximum.accumulate(high[order])[:-1]
    gaps = low[order][1:] - reach
    if not len(gaps) or gaps.max() < least:
        return None
    at = int(gaps.argmax())
    return float(reach[at] + gaps[at] / 2)


def reading_order(boxes: np.ndarray, least: float = 5.0) -> list[int]:
    """Places of boxes (x0, y0, x1, y1) in reading order: cut recursively at the larger of the largest gaps, then top to bottom, left to right."""
    out: list[int] = []
    stack = [np.arange(len(boxes))]
    while stack:
        part = stack.pop()
        if len(part) <= 1:
            out += part.tolist()
            continue
        b = boxes[part]
        across, down = _largest_gap(b[:, 1], b[:, 3], least), _largest_gap(b[:, 0], b[:, 2], least)
        if across is not None:
            first = b[:, 3] <= across
        elif down is not None:
            first = b[:, 2] <= down
        else:
            out += part[np.lexsort((b[:, 0], b[:, 1]))].tolist()
            continue
        stack += [part[~first], part[first]]
    return out


def page_order(df: DataFrame, by: Sequence[str], key: str, box: str) -> DataFrame:
    """(by, key, place): reading order of each page; one page at a time."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def order(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key)
        boxes = np.array([list(b) for b in pdf[box]], float).reshape(-1, 4)
        at = reading_order(boxes)
        place = np.empty(len(at), np.int64)
        place[at] = np.arange(len(at))
        return pd.DataFrame({**{c: [v] * len(pdf) for c, v in zip(by, group)}, key: pdf[key].to_numpy(), "place": place})

    schema = ", ".join(f"{c} {kinds[c]}" for c in (*by, key)) + ", place bigint"
    return df.where(F.size(box) == 4).select(*by, key, box).groupBy(*by).applyInPandas(order, schema)


def regions(cells: set[tuple[int, int]], gap: int = 0) -> list[set[tuple[int, int]]]:
    """Groups of filled cells connected over at most ``gap`` empty ones in a row or column."""
    left, out = set(cells), []
    while left:
        seed = min(left)
        left.discard(seed)
        group, stack = {seed}, [seed]
        while stack:
            r, c = stack.pop()
            for d in range(1, gap + 2):
                for n in ((r + d, c), (r - d, c), (r, c + d), (r, c - d)):
                    if n in left:
                        left.discard(n)
                        group.add(n)
                        stack.append(n)
        out.append(group)
    return out


def sheet_regions(df: DataFrame, sheet: str, row: str, col: str, gap: int = 0) -> DataFrame:
    """(sheet, region, top, left, bottom, right, cells): the tables of each sheet of cells."""
    kind = df.schema[sheet].dataType.simpleString()

    def find(group: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [
            (group[0], i, min(r for r, _ in g), min(c for _, c in g), max(r for r, _ in g), max(c for _, c in g), len(g))
            for i, g in enumerate(regions(set(zip(pdf[row].astype(int), pdf[col].astype(int))), gap))
        ]
        return pd.DataFrame(rows, columns=[sheet, "region", "top", "left", "bottom", "right", "cells"])

    return df.select(sheet, row, col).groupBy(sheet).applyInPandas(find, f"{sheet} {kind}, region int, top int, left int, bottom int, right int, cells int")


def continued_tables(tables: DataFrame, doc: str = "document_name", page: str = "page_idx", width: float = 0.1) -> DataFrame:
    """Pairs of tables where the first block of a page goes on with the last one of the page before.

    Expects one row per table with ``is_first``, ``is_last``, ``box_width`` and
    ``columns``; both must be tables of equal columns and about equal width.
    """
    last = tables.where("is_last").select(doc, F.col(page).alias("_p"), F.col("table_id").alias("table_before"), F.col("box_width").alias("_w"), F.col("columns").alias("_c"))
    first = tables.where("is_first").withColumn("_p", F.col(page) - 1)
    close = F.abs(F.col("box_width") - F.col("_w")) < width * F.least("box_width", "_w")
    return first.join(last, [doc, "_p"]).where(close & (F.col("columns") == F.col("_c"))).select(doc, page, "table_before", "table_id")
