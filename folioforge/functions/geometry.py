"""Box arithmetic on columns; a box is any struct or prefix with x0, y0, x1, y1."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    """Four columns of a box."""

    x0: Column
    y0: Column
    x1: Column
    y1: Column

    @classmethod
    def of(cls, array: Column) -> Box:
        """From an array column [x0, y0, x1, y1]; missing numbers are null."""
        return cls(*[F.get(array, F.lit(i)) for i in range(4)])

    @property
    def area(self) -> Column:
        return F.greatest(self.x1 - self.x0, F.lit(0.0)) * F.greatest(self.y1 - self.y0, F.lit(0.0))


def intersection(a: Box, b: Box) -> Column:
    width = F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0)
    height = F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0)
    return F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 for boxes without area."""
    inner = intersection(a, b)
    whole = a.area + b.area - inner
    return F.when(whole > 0, inner / whole).otherwise(0.0)


def overlap_of_smaller(a: Box, b: Box) -> Column:
    least = F.least(a.area, b.area)
    return F.when(least > 0, intersection(a, b) / least).otherwise(0.0)


def overlap_of_first(a: Box, b: Box) -> Column:
    return F.when(a.area > 0, intersection(a, b) / a.area).otherwise(0.0)


def y_overlap(a: Box, b: Box) -> Column:
    """Common height over the smaller height."""
    least = F.least(a.y1 - a.y0, b.y1 - b.y0)
    return F.when(least > 0, F.greatest(F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0), F.lit(0.0)) / least).otherwise(0.0)


def x_overlap(a: Box, b: Box) -> Column:
    """Common width over the smaller width."""
    least = F.least(a.x1 - a.x0, b.x1 - b.x0)
    return F.when(least > 0, F.greatest(F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0), F.lit(0.0)) / least).otherwise(0.0)


def contains(a: Box, b: Box) -> Column:
    return (a.x0 <= b.x0) & (a.y0 <= b.y0) & (a.x1 >= b.x1) & (a.y1 >= b.y1)


def edge_distance(a: Box, b: Box) -> Column:
    """Distance between the nearest edges; 0 where the boxes overlap."""
    dx = F.greatest(a.x0 - b.x1, b.x0 - a.x1, F.lit(0.0))
    dy = F.greatest(a.y0 - b.y1, b.y0 - a.y1, F.lit(0.0))
    return F.hypot(dx, dy)


def centre_distance(a: Box, b: Box) -> Column:
    return F.hypot((a.x0 + a.x1 - b.x0 - b.x1) / 2, (a.y0 + a.y1 - b.y0 - b.y1) / 2)


def position(a: Box, b: Box) -> Column:
    """Where ``a`` stands as seen from ``b``: left, right, bottom, top, or none of these alone."""
    return (
        F.when(a.x1 < b.x0, F.when(a.y1 < b.y0, "left-top").when(a.y0 > b.y1, "left-bottom").otherwise("left"))
        .when(a.x0 > b.x1, F.when(a.y1 < b.y0, "right-top").when(a.y0 > b.y1, "right-bottom").otherwise("right"))
        .when(a.y1 < b.y0, "top").when(a.y0 > b.y1, "bottom").otherwise("overlap")
    )


def to_thousandths(a: Box, width: Column, height: Column) -> list[Column]:
    """Box on a grid of 0 to 1000, cut to whole numbers."""
    return [(v * 1000 / s).cast("int") for v, s in zip(a, (width, height, width, height))]


def clamp(a: Box, width: Column, height: Column) -> Box:
    """The box within the page."""
    return Box(*[F.greatest(F.least(v, s), F.lit(0.0)) for v, s in zip(a, (width, height, width, height))])


def is_unit(a: Box) -> Column:
    """Whether the numbers are shares of the page."""
    return F.greatest(*[F.abs(v) for v in a]) <= 1.5
