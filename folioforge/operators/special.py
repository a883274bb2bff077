"""Rules on titles and headers that settle a table before its columns are judged.

All are column expressions over a title, a header (``ARRAY<STRING>``) and a grid
(``ARRAY<ARRAY<STRING>>``), so a table is judged in its row, without a shuffle.
Nulls count as empty: a null title, header or grid fits no rule.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from folioforge.functions import text as tx
from folioforge.functions.width import full_to_half

# Words and patterns that decide on tables.
NOT_PINS = ("register description", "offset address", "timing requirement")
PIN_WORDS = ("pin", "ball", "terminal", "signal", "引脚", "端子", "信号")
PIN_TITLES = ("pin attributes", "terminal functions", "signal descriptions", "connectivity requirements")
BALL_CODE = r"\b[A-Z]{1,2}\d{1,3}\b"
PHYSICAL = ("pin no", "pin number", "ball number", "terminal no", "terminal number", "引脚编号", "端子编号")
MUX_WORDS = ("pin mux", "pinmux", "alternate function", "default mapping")
PORT_TITLE = r"\bport\s+p[a-z0-9.]*\b"
UNUSED = r"\bconnections?\s+for\s+unused\s+pins?(\s+and\s+modules)?\b|\bunused\s+pins?(\s+and\s+modules)?\s+connections?\b"
MODES = ("mii mac", "mii phy", "rmii mac", "rmii phy", "rgmii")
NUMBER_HEADER = r"^(pin|ball|terminal)\s*(no\.?|number|numbers|#)$|^(引脚编号|球号|焊球编号|端子编号)$"
WORD_TITLE = r"\btable\s+\d+([.-]\d+)?\s*[.:]?\s*word\s+\d+\b|^word\s+\d+$"
WORD_HEADERS = ("bit", "bit name", "description / function", "pin affected")
NUMBER_COLUMNS = ("balls", "ball numbers", "pins", "pin numbers", "terminals", "terminal numbers", "球号", "引脚编号", "端子编号")
REQUIREMENT = r"connection requirement|连接要求"
NAME_HEADERS = ("pin name", "ball name", "signal name", "terminal name", "引脚名称", "信号名称", "端子名称")
RESERVED = r"\breserved\b|\bno[ -]?connect\b|\bn/?c\b|left unconnected|leave unconnected|must not be connected|shall not be connected|do not connect"
ABSENT = r"do not exist on the package|does not exist on the package|not exist on the package|not present on the package|not available on the package|no ball exists|no pin exists"
PIN_LIST = r"^([A-Za-z]{1,3}\d{1,4}[A-Za-z]?|\d{1,4})([\s,，;/／、|]+([A-Za-z]{1,3}\d{1,4}[A-Za-z]?|\d{1,4}))*[\s,，;/／、|]*$"
CONTINUED = r"(\(续\)|\(续表\)|\(续上表\)|\(continued\)|\(cont\.\)|\(cont[’']d\)|\(…continued\)|(?<![\p{L}])continued|续表)$|\(continued\)"
PAGE_NOISE = r"\bcopyright\b|submit documentation feedback|product folder links|^(page\s*)?\d+\s*(of\s*\d+)?$"
TYPE_TITLES = r"signal type|pin type|terminal type|io type|i o type"
TYPE_ALONE = ("type", "i o", "io", "i/o")
TYPE_OTHERS = r"buffer|reset state|power source"


def _has(c: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(F.array_max(F.array(*[c.contains(w) for w in words])), F.lit(False))


def _like(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(pattern), F.lit(False))


def joined_form(header: Column) -> Column:
    """All headers in one line, in the form for comparison."""
    return tx.header_form(F.array_join(header, " "))


def low_form(c: Column) -> Column:
    """Lower case with single blanks; null as empty."""
    return F.lower(tx.squeeze(F.coalesce(c, F.lit(""))))


def bare_headers(header: Column) -> Column:
    """Headers in ``low_form`` without notes in brackets."""
    return F.transform(header, lambda h: low_form(F.regexp_replace(F.coalesce(h, F.lit("")), r"\[[^\]]+\]", " ")))


def may_hold_pins(title: Column, header: Column, grid: Column, ordering: Column) -> Column:
    """Whether a table is worth a look: words of its header or title, or a ball's code in its first eight rows."""
    h, t = joined_form(header), tx.header_form(F.coalesce(title, F.lit("")))
    code = _like(F.array_join(F.transform(F.slice(grid, 1, 8), lambda r: F.array_join(r, " ")), " "), BALL_CODE)
    return ~ordering & ~_has(h, NOT_PINS) & (_has(h, PIN_WORDS) | _has(t, PIN_TITLES) | code)


def maps_functions(title: Column, header: Column) -> Column:
    """Whether a table tells functions of ports, without a physical number."""
    h, t = joined_form(header), tx.header_form(F.coalesce(title, F.lit("")))
    return ~_has(h, PHYSICAL) & (_like(t, PORT_TITLE) | _has(F.concat_ws(" ", h, t), MUX_WORDS))


def is_unused(title: Column) -> Column:
    return _like(low_form(title), UNUSED)


def is_mode_matrix(header: Column) -> Column:
    """A physical number and then the five interface modes in this order, nothing else."""
    full = F.filter(bare_headers(header), lambda h: h != "")
    return F.coalesce(_like(F.get(full, F.lit(0)), NUMBER_HEADER) & (F.array_join(F.slice(full, 2, 100), "|") == "|".join(MODES)), F.lit(False))


def is_word_table(title: Column, header: Column, rows: Column) -> Column:
    """The bits of a control word, which only refer to pins."""
    h = bare_headers(header)
    whole = F.size(F.array_intersect(h, F.array(*map(F.lit, WORD_HEADERS)))) == len(WORD_HEADERS)
    filled = F.exists(rows, lambda r: F.exists(r, lambda c: F.trim(c) != ""))
    return _like(low_form(title), WORD_TITLE) & F.coalesce(whole & ~F.exists(h, lambda x: x.rlike(NUMBER_HEADER)) & filled, F.lit(False))


def reserved_rows(title: Column, header: Column, rows: Column) -> Column:
    """Places of the reserved rows of a table of reserved pins; null where it is none or a row can't be told."""
    t, h = low_form(title), bare_headers(header)
    subject = t.contains("reserved") & _has(t, ("ball", "pin", "terminal"))
    number = F.array_position(F.transform(h, lambda x: x.isin(*NUMBER_COLUMNS)), True) - 1
    need = F.array_position(F.transform(h, lambda x: x.rlike(REQUIREMENT)), True) - 1
    cell = lambda r, at: F.coalesce(F.get(r, at.cast("int")), F.lit(""))
    kind = lambda p, q: F.when((p == "") & (q == ""), "blank").when(q.rlike(ABSENT), "absent").when(q.rlike(RESERVED) & p.rlike(PIN_LIST), "reserved").otherwise("other")
    kinds = F.transform(rows, lambda r: kind(tx.squeeze(cell(r, number)), low_form(cell(r, need))))
    kept = F.filter(F.transform(kinds, lambda k, i: F.when(k == "reserved", i)), lambda i: i.isNotNull())
    fits = subject & (number >= 0) & (need >= 0) & ~F.exists(h, lambda x: _has(x, NAME_HEADERS)) & ~F.exists(kinds, lambda k: k == "other") & (F.size(kept) > 0)
    return F.when(fits, kept)


def special_kind(title: Column, header: Column, rows: Column) -> Column:
    """The first special rule that a table fits, null for none."""
    return (
        F.when(is_unused(title), "unused_pins")
        .when(is_mode_matrix(header), "interface_modes")
        .when(is_word_table(title, header, rows), "control_word")
        .when(reserved_rows(title, header, rows).isNotNull(), "reserved_pins")
    )


def wants_spans(html: Column, title: Column, grid: Column) -> Column:
    """Whether a table's spans are worth writing out: its title or first four rows name a pin and a field."""
    window = tx.header_form(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.array_join(F.flatten(F.slice(grid, 1, 4)), " ")))
    axis, leaf = r"\b(pin|ball|terminal)\b|引脚|端子|球", r"\b(name|type|description|no|number)\b|名称|类型|说明|描述|编号"
    return _like(html, r"(?i)\b(rowspan|colspan)\s*=") & _like(window, axis) & _like(window, leaf)


def is_continued(c: Column) -> Column:
    """Whether a text says that a table goes on; ``discontinued`` doesn't."""
    return _like(F.lower(full_to_half(F.trim(c))), CONTINUED)


def is_page_noise(c: Column) -> Column:
    return _like(low_form(c), PAGE_NOISE)


def header_hints(grid: Column) -> Column:
    """Per column the different texts of the first four rows, in a line."""
    first = F.slice(grid, 1, 4)
    width = F.coalesce(F.array_max(F.transform(first, F.size)), F.lit(0))
    text = lambda i: F.array_join(F.array_distinct(F.filter(F.transform(first, lambda r: F.trim(F.coalesce(F.get(r, i), F.lit("")))), lambda x: x != "")), " ")
    return F.when(width > 0, F.transform(F.sequence(F.lit(0), width - 1), text)).otherwise(F.array().cast("array<string>"))


def type_score(header: Column, score: Column, values: Column, is_type) -> Column:
    """How well a type column suits a pin's type: words of its header and its first twenty values."""
    h = tx.header_form(header)
    words = F.when(_like(h, TYPE_TITLES), 20).otherwise(0) + F.when(h.isin(*TYPE_ALONE), 10).otherwise(0) - F.when(_like(h, TYPE_OTHERS), 15).otherwise(0)
    return score + words + 3 * F.size(F.filter(F.slice(values, 1, 20), is_type))


def paths(grid: list[list[str]], last: int) -> list[list[str]]:
    """Per column the different header texts from the top row down to row ``last``.

    A blank above a text takes over from the column beside it if that one has the
    same text below and both sides don't differ in what they would give.
    """
    head = [[" ".join((c or "").split()) for c in row] for row in grid[: last + 1]]
    width = max(map(len, head), default=0)
    head = [row + [""] * (width - len(row)) for row in head]
    for upper, lower in reversed(list(zip(head, head[1:]))):
        for i, (own, below) in enumerate(zip(upper, lower)):
            if own or not below:
                continue
            beside = {upper[k] for k in (i - 1, i + 1) if 0 <= k < width and lower[k] == below and upper[k]}
            if len(beside) == 1:
                upper[i] = beside.pop()
    columns = zip(*head) if head else []
    return [list({x.lower(): x for x in reversed(c) if x}.values())[::-1] for c in columns]


@pandas_udf(ArrayType(ArrayType(StringType())))
def paths_udf(grid: pd.Series, last: pd.Series) -> pd.Series:
    return pd.Series([None if g is None else paths([list(r) for r in g], int(n)) for g, n in zip(grid, last)])
