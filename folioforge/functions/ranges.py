"""Expansion of pin ranges as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The ends of a range are at most this far apart, else it is no range.
LIMIT = 1000


def _series(prefix: Column, a: Column, b: Column, suffix: Column, width: Column, both_ways: bool) -> Column:
    low, high = a.try_cast("bigint"), b.try_cast("bigint")
    ok = (F.abs(high - low) <= LIMIT) & (F.lit(both_ways) | (low <= high))
    step = F.when(high < low, -1).otherwise(1).cast("bigint")
    pad = lambda n: F.when(F.length(n.cast("string")) >= width, n.cast("string")).otherwise(F.lpad(n.cast("string"), width, F.lit("0")))
    return F.when(ok, F.transform(F.sequence(low, high, step), lambda n: F.concat(prefix, pad(n), suffix)))


def _width(a: Column, b: Column, zero: str = "^0") -> Column:
    return F.when(a.rlike(zero) | b.rlike(zero), F.greatest(F.length(a), F.length(b))).otherwise(F.lit(1))


def expand_numbers(c: Column) -> Column:
    """``007-12`` as its numbers; null if the text is no ascending range or its ends are more than ``LIMIT`` apart."""
    a, b = F.regexp_extract(c, r"^\s*(\d+)\s*-\s*(\d+)\s*$", 1), F.regexp_extract(c, r"^\s*(\d+)\s*-\s*(\d+)\s*$", 2)
    return F.when(a != "", _series(F.lit(""), a, b, F.lit(""), _width(a, b), False))


def expand_lettered(c: Column) -> Column:
    """``D2-D9`` with the same letters on both sides, in any case."""
    p = r"^\s*([A-Za-z]+)\s*(\d+)\s*-\s*([A-Za-z]+)\s*(\d+)\s*$"
    part = lambda i: F.regexp_extract(c, p, i)
    return F.when((part(2) != "") & (F.upper(part(1)) == F.upper(part(3))), _series(part(1), part(2), part(4), F.lit(""), F.lit(1), False))


def expand_bracketed(c: Column) -> Column:
    """``Q[3:8]`` and ``BUS[9:2]_X``, either way, a lone 0 at an end being no leading zero; null unless there is exactly one bracket range."""
    p = r"^([^\[\]]*)\[\s*(\d+)\s*:\s*(\d+)\s*\]([^\[\]]*)$"
    part = lambda i: F.regexp_extract(c, p, i)
    return F.when(part(2) != "", _series(part(1), part(2), part(3), part(4), _width(part(2), part(3), "^0[0-9]"), True))


def expand_any(c: Column) -> Column:
    """The values of a range of any kind, else the text alone."""
    return F.coalesce(expand_bracketed(c), expand_numbers(c), expand_lettered(c), F.array(F.trim(c)))


def split_and_expand(c: Column) -> Column:
    """All values of a cell of pin numbers; ``N/A`` stays whole, null and blank give an empty list."""
    tight = F.regexp_replace(c, r"(?<=[0-9A-Za-z])\s*-\s*(?=[0-9A-Za-z])", "-")
    parts = F.filter(F.split(tight, r"[\s,，;；/／、|]+"), lambda x: x != "")
    return F.when(c.isNull() | (F.trim(c) == ""), F.array().cast("array<string>")).when(F.upper(F.trim(c)) == "N/A", F.array(F.trim(c))).otherwise(F.flatten(F.transform(parts, expand_any)))


def pair_names(numbers: Column, names: Column, raw: Column) -> Column:
    """(number, name) pairs where as many names as numbers are given, else every number with the raw name."""
    return F.when(F.size(names) == F.size(numbers), F.arrays_zip(numbers.alias("number"), names.alias("name"))).otherwise(F.transform(numbers, lambda n: F.struct(n.alias("number"), raw.alias("name"))))
