"""Associations: overlap, containment, nearest, prefix and ordered alignment.

Theta joins are done as equi-joins on grid cells with the exact predicate after
them; nothing is a cross join.
"""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import geometry as geo


def _cells(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size), F.floor(F.greatest(low, high) / size))


def overlap_join(left: DataFrame, right: DataFrame, by: Sequence[str], box_left: str, box_right: str, grid: float = 50.0) -> DataFrame:
    """Pairs of one partition whose boxes share area; box columns are arrays [x0, y0, x1, y1] of different names.

    Boxes are spread over horizontal stripes of height ``grid``; a pair is kept
    in the stripe where its common part begins, so no pair comes twice.
    """
    a, b = geo.Box.of(F.col(box_left)), geo.Box.of(F.col(box_right))
    cut = left.withColumn("_cell", F.explode(_cells(a.y0, a.y1, grid)))
    other = right.withColumn("_cell", F.explode(_cells(b.y0, b.y1, grid)))
    first = F.floor(F.greatest(a.y0, b.y0) / grid)
    return cut.join(other, [*by, "_cell"]).where((F.col("_cell") == first) & (geo.intersection(a, b) > 0)).drop("_cell")


def assign_first(pairs: DataFrame, by: Sequence[str], item: str, holder_order: str, ratio: Column, least: float) -> DataFrame:
    """Of the holders that cover more than ``least`` of an item the first in order takes it."""
    w = Window.partitionBy(*by, item).orderBy(holder_order)
    return pairs.where(ratio > least).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def nearest(pairs: DataFrame, by: Sequence[str], *distance: Column) -> DataFrame:
    """The row of each ``by`` with the least distances, in the order given."""
    w = Window.partitionBy(*by).orderBy(*distance)
    return pairs.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def contained(df: DataFrame, by: Sequence[str], key: str, box: str) -> DataFrame:
    """Rows whose box lies wholly within another one of the partition (of equal boxes the smaller key stays)."""
    outer = df.select(*by, F.col(key).alias("_outer"), F.col(box).alias("_box"))
    pairs = overlap_join(df, outer, by, box, "_box").where(F.col(key) != F.col("_outer"))
    a, b = geo.Box.of(F.col("_box")), geo.Box.of(F.col(box))
    inside = geo.contains(a, b) & (~geo.contains(b, a) | (F.col("_outer") < F.col(key)))
    return df.join(pairs.where(inside).select(*by, key).distinct(), [*by, key], "left_semi")


def longest_prefix(df: DataFrame, names: DataFrame, value: str, name: str, least: int = 3) -> DataFrame:
    """``df`` with the longest ``name`` that its ``value`` begins with; null where none does.

    An equi-join on all prefixes of a value, at least ``least`` characters long.
    """
    v = F.col(value)
    prefixes = df.where(F.length(v) >= least).select(value, F.explode(F.transform(F.sequence(F.lit(least), F.length(v)), lambda n: F.substring(v, F.lit(1), n))).alias(name)).distinct()
    best = prefixes.join(names.select(name).distinct(), name).groupBy(value).agg(F.max_by(name, F.length(name)).alias(name))
    return df.join(best, value, "left")


def wildcard(df: DataFrame, families: DataFrame, value: str, family: str) -> DataFrame:
    """Pairs of a value and a family name ending in x, whose stem of four or more characters the value begins with."""
    stems = families.where(F.col(family).rlike("^.{4,}x$")).select(family, F.lower(F.expr(f"substring({family}, 1, length({family}) - 1)")).alias("_stem"))
    v = F.lower(F.col(value))
    cut = df.where(F.length(v) >= 4).withColumn("_stem", F.explode(F.transform(F.sequence(F.lit(4), F.length(v)), lambda n: F.substring(v, F.lit(1), n))))
    return cut.join(stems, "_stem").where(F.length(value) == F.length(family)).drop("_stem")


def adjacent_number(df: DataFrame, by: Sequence[str], order: Sequence[str], kind: str, number: str, target: str) -> DataFrame:
    """For every row of kind ``number`` the key of the ``target`` row it belongs to: the row before, else the one after unless a number follows that."""
    w = Window.partitionBy(*by).orderBy(*order)
    before, after, then = F.lag(kind).over(w), F.lead(kind).over(w), F.lead(kind, 2).over(w)
    side = F.when(before == target, -1).when((after == target) & ~F.coalesce(then == number, F.lit(False)), 1)
    return df.withColumn("side", side).where((F.col(kind) == number) & F.col("side").isNotNull())


def similarity(a: str, b: str) -> float:
    """Share of matching runs of two texts, from 0 to 1."""
    return SequenceMatcher(None, a, b, autojunk=False).ratio() if a or b else 0.0


def align(left: list[str], right: list[str], most: int = 4, cost: float = 0.1) -> list[int]:
    """Place in ``left`` for every item of ``right``, never going back; -1 if ``left`` is empty.

    The alignment of the greatest total similarity, found by dynamic programming
    over prefixes of both lists. A step takes one item of each side, or one of one
    side with up to ``most`` of the other (split or merged items, ``cost`` for each
    more), or passes over an item; items of ``right`` passed over get the place before.
    """
    n, m = len(left), len(right)
    steps = [(1, 1), *((1, k) for k in range(2, most + 1)), *((k, 1) for k in range(2, most + 1)), (1, 0), (0, 1)]
    best = [[(0.0, 0, 0)] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            reached = []
            for order, (a, b) in enumerate(steps):
                if a > i or b > j:
                    continue
                gain = (similarity("".join(left[i - a : i]), "".join(right[j - b : j])) - cost * (a + b - 2)) * b if a and b else 0.0
                reached.append((best[i - a][j - b][0] + gain, -order, a, b))
            if reached:
                top = max(reached)
                best[i][j] = (top[0], top[2], top[3])
    out = [-1] * m
    i, j = n, m
    while i or j:
        _, a, b = best[i][j]
        if a and b:
            out[j - b : j] = [i - a] * b
        i, j = i - a, j - b
    for j in range(m):
        if out[j] < 0 and n:
            out[j] = out[j - 1] if j else 0
    return out


def align_sequences(left: DataFrame, right: DataFrame, by: str, order: str, text: str, value: str) -> DataFrame:
    """(by, order, value): rows of ``right`` with the ``value`` of the row of ``left`` they are aligned to; one document at a time."""

    def pair(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.sort_values(order), b.sort_values(order)
        at = align(a[text].fillna("").tolist(), b[text].fillna("").tolist())
        values = a[value].tolist()
        return pd.DataFrame({by: [key[0]] * len(b), order: b[order].tolist(), value: [values[i] if 0 <= i < len(values) else None for i in at]})

    kinds = {f.name: f.dataType.simpleString() for f in right.schema} | {value: left.schema[value].dataType.simpleString()}
    schema = f"{by} {kinds[by]}, {order} {kinds[order]}, {value} {kinds[value]}"
    fresh = right.select(*[F.col(c).alias(c) for c in (by, order, text)])  # new columns, where both sides come from one table
    return left.select(by, order, text, value).groupBy(by).cogroup(fresh.groupBy(by)).applyInPandas(pair, schema)
