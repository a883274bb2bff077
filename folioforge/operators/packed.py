"""Splitting of cells that pack several values, by a parsing expression grammar.

A cell is read by ordered alternatives: a quoted value, a bracketed range, a
dashed range, a bare value. The first that matches up to a separator or the
end wins; a quote without its partner makes the quoted alternative fail, the
parser goes back and reads a bare value, and the item carries an error flag.

Cases: null and blank cells give no items; empty items are skipped; an
unclosed quote is flagged and dropped from the ends; a dashed range
whose ends are more than ``MAX_RANGE`` apart, a descending one or one with
differing letters is one value; a bracket range of any length stands for all
its values, which are made one by one; repeated rows of one id are split once.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The ends of a dashed range are at most this far apart, else it is one value.
MAX_RANGE = 1000
#: Rows that the splitter hands over at once.
BATCH = 10_000
ROW_SCHEMA = "key bigint, field_name string, item_no int, item_text string, start int, stop int, kind string, error string"
_ARROW_ROWS = pa.schema(
    [("key", pa.int64()), ("field_name", pa.string()), ("item_no", pa.int32()), ("item_text", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string()), ("error", pa.string())]
)


class Item(NamedTuple):
    """One value with its place in the cell and the grammar alternative that read it."""

    text: str
    start: int
    stop: int
    kind: str
    error: str | None


Alternative = Callable[[str, int, "re.Pattern[str]"], "tuple[str | Series, int, str, str | None] | None"]

_BREAK = r"<br\s*/?>|[\r\n]+"
_STRONG = rf"\s*(?:{_BREAK}|[,;|&、，；]|\s(?:and|和|et|und)(?=\s))\s*"
#: Separators by level, strictest first.
SEPARATORS = {
    "break": re.compile(rf"\s*(?:{_BREAK})\s*", re.I),
    "comma": re.compile(r"\s*[,;，；]\s*"),
    "strong": re.compile(_STRONG, re.I),
    "slash": re.compile(rf"{_STRONG}|\s*/\s*", re.I),
    "spaced slash": re.compile(rf"{_STRONG}|\s+/\s+", re.I),
    "blank": re.compile(rf"{_STRONG}|\s+", re.I),
    "any": re.compile(rf"{_STRONG}|\s*/\s*|\s+", re.I),
}
_QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "「": "」"}
_DASH = r"\s*[-–—~～−‐‑]\s*"
_BRACKET = re.compile(r"([^\s\[\],;|/]*)\[\s*(\d+)\s*:\s*(\d+)\s*\]([^\s\[\],;|/<]*)")
_RANGE = re.compile(rf"([A-Za-z]*)(\d+){_DASH}([A-Za-z]*)(\d+)")
_PIN = re.compile(r"[A-Za-z]{0,3}\d+[A-Za-z]?")


class Series(NamedTuple):
    """The values of a range, made one by one."""

    prefix: str
    numbers: range
    width: int
    suffix: str

    def values(self) -> Iterator[str]:
        return (f"{self.prefix}{str(n).zfill(self.width)}{self.suffix}" for n in self.numbers)


class Run(NamedTuple):
    """What one alternative read: a text or a series of any length, with its place."""

    value: str | Series
    start: int
    stop: int
    kind: str
    error: str | None

    def size(self) -> int:
        r = self.value.numbers if isinstance(self.value, Series) else None
        return abs(r.stop - r.start) if r else 1  # len() of a range ends at 2 ** 63

    def items(self) -> Iterator[Item]:
        for value in self.value.values() if isinstance(self.value, Series) else (self.value,):
            yield Item(_bare(value, self.kind), self.start, self.stop, self.kind, self.error)


def _bare(value: str, kind: str) -> str:
    value = value.strip()
    return value if kind == "quoted" else value.strip("\"'“”‘’").strip()


def _series(prefix: str, a: str, b: str, suffix: str, both_ways: bool) -> Series | None:
    low, high = int(a), int(b)
    if low == high or (low > high and not both_ways):
        return None
    width = len(a) if a.startswith("0") else len(b) if b.startswith("0") else 0
    step = 1 if high > low else -1
    return Series(prefix, range(low, high + step, step), width, suffix)


def _ends(text: str, at: int, sep: re.Pattern[str]) -> bool:
    while at < len(text) and text[at].isspace() and sep.match(text, at) is None:
        at += 1
    return at >= len(text) or sep.match(text, at) is not None


def quoted(text: str, at: int, sep: re.Pattern[str]):
    """A value between quotes, whole even if it holds separators; a doubled closing quote stands for itself."""
    close = _QUOTES.get(text[at])
    if close is None:
        return None
    stop = text.find(close, at + 1)
    while stop != -1:
        if _ends(text, stop + 1, sep):
            return text[at + 1 : stop].replace(close * 2, close), stop + 1, "quoted", None
        if text.startswith(close * 2, stop):
            stop = text.find(close, stop + 2)
        elif stop > at + 1 and (text[stop - 1].isspace() or sep.match(text, stop - 1)):
            return None  # this quote opens the next value
        else:
            stop = text.find(close, stop + 1)
    return None


def bracketed(both_ways: bool) -> Alternative:
    """``NAME[3:0]_A``: a bracket range with what stands before and after it."""

    def parse(text: str, at: int, sep: re.Pattern[str]):
        m = _BRACKET.match(text, at)
        if not m or not _ends(text, m.end(), sep):
            return None
        return _series(m[1], m[2], m[3], m[4], both_ways) or m[0], m.end(), "bracketed", None

    return parse


def dashed(text: str, at: int, sep: re.Pattern[str]):
    """``4-7``, ``A4 - A7``: ascending, with the same letters on both sides, else one value."""
    m = _RANGE.match(text, at)
    if not m or not _ends(text, m.end(), sep):
        return None
    series = _series(m[1], m[2], m[4], "", False) if m[1].upper() == m[3].upper() and int(m[4]) - int(m[2]) <= MAX_RANGE else None
    return series or m[0], m.end(), "range", None


def bare(text: str, at: int, sep: re.Pattern[str]):
    """Everything up to the next separator."""
    m = sep.search(text, at)
    while m and m.end() == m.start():
        m = sep.search(text, m.end() + 1)
    stop = m.start() if m else len(text)
    error = "unbalanced_quote" if text[at] in _QUOTES else None
    return text[at:stop], stop, "bare", error


def parse_runs(text: str | None, sep: re.Pattern[str], alternatives: tuple[Alternative, ...]) -> list[Run]:
    """What stands in one cell under one kind of separator, ranges unexpanded."""
    runs: list[Run] = []
    at, end = 0, len(text or "")
    while at < end:
        m = sep.match(text, at)
        if m and m.end() > at:
            at = m.end()
            continue
        if text[at].isspace():
            at += 1
            continue
        value, stop, kind, error = next(r for alt in alternatives if (r := alt(text, at, sep)))
        if isinstance(value, Series) or _bare(value, kind):
            runs.append(Run(value, at, stop, kind, error))
        at = max(stop, at + 1)
    return runs


def _expand(runs: list[Run]) -> list[Item]:
    return [i for r in runs for i in r.items()]


def parse_cell(text: str | None, sep: re.Pattern[str], alternatives: tuple[Alternative, ...]) -> list[Item]:
    """The items of one cell under one kind of separator."""
    return _expand(parse_runs(text, sep, alternatives))


NUMBER = (quoted, bracketed(False), dashed, bare)
NAME = (quoted, bracketed(True), bare)


def number_runs(text: str | None) -> list[Run]:
    """``split_numbers`` with ranges unexpanded."""
    if not text or not text.strip():
        return []
    for level in ("any", "slash", "blank"):
        runs = parse_runs(text, SEPARATORS[level], NUMBER)
        if all(r.kind != "bare" or _PIN.fullmatch(_bare(r.value, r.kind)) for r in runs):
            return runs
    return parse_runs(text, SEPARATORS["strong"], NUMBER)


def split_numbers(text: str | None) -> list[Item]:
    """The pin numbers of a cell; blanks and slashes part them only if all parts look like numbers."""
    return _expand(number_runs(text))


def name_runs(text: str | None, pins: int) -> list[Run]:
    """``split_names`` with ranges unexpanded."""
    if not text or not text.strip():
        return []
    if not pins:
        return parse_runs(text, SEPARATORS["comma"], NAME)
    for level in ("break", "strong", "spaced slash", "slash", "blank", "any"):
        runs = parse_runs(text, SEPARATORS[level], NAME)
        if sum(r.size() for r in runs) == pins:
            return runs
    return [Run(text.strip(), 0, len(text), "whole", None)]


def split_names(text: str | None, pins: int) -> list[Item]:
    """The names of a cell beside ``pins`` numbers (0: no number given).

    The separators are tried from the strictest; the first whose parts are as
    many as the numbers wins, else the cell is one name.
    """
    runs = name_runs(text, pins)
    if runs and runs[0].kind == "whole":
        return [Item(runs[0].value, runs[0].start, runs[0].stop, "bare", None)]
    return _expand(runs)


def split_packed(df: DataFrame, key: str = "row_id", number: str = "pin_no", name: str = "pin_name") -> DataFrame:
    """One row per value of the cells of ``df`` that hold two or more.

    Columns: key, field_name, item_no, item_text, start, stop, kind, error.
    One shuffle by key drops re-delivered rows; the parser then runs on Arrow
    batches, row by row, with no further exchange.
    """

    columns = ("field_name", "item_no", "item_text", "start", "stop", "kind", "error")

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for key, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                numbers = number_runs(a)
                pins = sum(r.size() for r in numbers)
                names = name_runs(b, pins)
                for field, runs in ((number, numbers), (name, names)):
                    if len(runs) > 1 or runs and runs[0].size() > 1:
                        for i, x in enumerate(x for r in runs for x in r.items()):
                            yield key, field, i + 1, *x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = items(batches)
        while part := list(itertools.islice(rows, BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], f.type) for i, f in enumerate(_ARROW_ROWS)], schema=_ARROW_ROWS)

    one = df.select(F.col(key).cast("bigint").alias("key"), F.col(number).alias("a"), F.col(name).alias("b")).where("key is not null").dropDuplicates(["key"])
    done = one.mapInArrow(run, ROW_SCHEMA)
    return done.select(F.col("key").alias(key), *columns)
