"""Small combinatorial kernels, one group at a time: best assignment, box suppression, packing, formula repair."""

from __future__ import annotations

import heapq
import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def best_assignment(score: np.ndarray) -> list[int]:
    """Column of every row (-1: none) so that the sum of scores is largest and no column is taken twice.

    Shortest augmenting paths with potentials, in cubic time; of rows beyond the
    number of columns those that add least stay without one.
    """
    score = np.asarray(score, float)
    if not score.size:
        return [-1] * score.shape[0]
    rows, cols = score.shape
    if rows > cols:
        taken = best_assignment(score.T)
        out = [-1] * rows
        for c, r in enumerate(taken):
            if r >= 0:
                out[r] = c
        return out
    cost = score.max() - score
    pot_r, pot_c = np.zeros(rows + 1), np.zeros(cols + 1)
    row_of = np.zeros(cols + 1, int)
    for r in range(1, rows + 1):
        row_of[0] = r
        least, used, way, c0 = np.full(cols + 1, np.inf), np.zeros(cols + 1, bool), np.zeros(cols + 1, int), 0
        while True:
            used[c0] = True
            free = ~used
            free[0] = False
            reduced = cost[row_of[c0] - 1] - pot_r[row_of[c0]] - pot_c[1:]
            better = free.copy()
            better[1:] &= reduced < least[1:]
            least[1:][better[1:]] = reduced[better[1:]]
            way[better] = c0
            c1 = int(np.where(free, least, np.inf).argmin())
            step = least[c1]
            pot_r[row_of[used]] += step
            pot_c[used] -= step
            least[~used] -= step
            c0 = c1
            if row_of[c0] == 0:
                break
        while c0:
            row_of[c0] = row_of[way[c0]]
            c0 = way[c0]
    out = [-1] * rows
    for c in range(1, cols + 1):
        if row_of[c]:
            out[row_of[c] - 1] = c - 1
    return out


def suppress(boxes: np.ndarray, scores: np.ndarray, most: float = 0.9) -> np.ndarray:
    """Places of the boxes that stay when, by falling score, boxes that share more than ``most`` with a kept one go."""
    order, keep = np.lexsort((np.arange(len(scores)), -scores)), []
    area = np.clip(boxes[:, 2] - boxes[:, 0], 0, None) * np.clip(boxes[:, 3] - boxes[:, 1], 0, None) if len(boxes) else np.zeros(0)
    while len(order):
        first, rest = order[0], order[1:]
        keep.append(int(first))
        w = np.clip(np.minimum(boxes[first, 2], boxes[rest, 2]) - np.maximum(boxes[first, 0], boxes[rest, 0]), 0, None)
        h = np.clip(np.minimum(boxes[first, 3], boxes[rest, 3]) - np.maximum(boxes[first, 1], boxes[rest, 1]), 0, None)
        whole = area[first] + area[rest] - w * h
        order = rest[~(np.divide(w * h, whole, out=np.zeros_like(whole), where=whole > 0) > most)]
    return np.array(sorted(keep), int)


def suppress_boxes(df: DataFrame, by: Sequence[str], key: str, box: str, score: str, most: float = 0.9) -> DataFrame:
    """Rows of each page that stay after greedy suppression; null scores count as 0."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key)
        kept = suppress(np.array([list(b) for b in pdf[box]], float).reshape(-1, 4), pdf[score].fillna(0).to_numpy(float), most)
        return pdf.iloc[kept][[*by, key]]

    slim = df.where(F.size(box) == 4).select(*by, key, box, score)
    return slim.groupBy(*by).applyInPandas(run, slim.select(*by, key).schema)


def pack(sizes: Sequence[int], room: int) -> list[int]:
    """Window of every item: largest first, each into the emptiest window that still holds it; larger ones get their own."""
    out, heap, count = [0] * len(sizes), [], 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        if heap and heap[0][0] + sizes[i] <= room:
            load, window = heapq.heappop(heap)
        else:
            load, window, count = 0, count, count + 1
        out[i] = window
        heapq.heappush(heap, (load + sizes[i], window))
    return out


_LEFT_RIGHT = re.compile(r"\\(left|right)(?![A-Za-z])")


def repair_formula(tex: str | None) -> str | None:
    """A formula with as many ``\\left`` as ``\\right`` and balanced braces, blanks squeezed."""
    if not tex:
        return tex
    out, depth = [], 0
    for i, c in enumerate(tex):
        if c in "{}" and (i == 0 or tex[i - 1] != "\\"):
            if c == "}" and not depth:
                continue
            depth += 1 if c == "{" else -1
        out.append(c)
    text = "".join(out) + "}" * depth
    sides = [m[1] for m in _LEFT_RIGHT.finditer(text)]
    open_ = 0
    fits = all((open_ := open_ + (1 if s == "left" else -1)) >= 0 for s in sides) and not open_
    if not fits:
        text = _LEFT_RIGHT.sub("", text)
    return re.sub(r"[ \t]+", " ", text).strip()


@F.pandas_udf(StringType())
def repair_formula_udf(tex: pd.Series) -> pd.Series:
    """``repair_formula`` for a column."""
    return tex.map(repair_formula)
