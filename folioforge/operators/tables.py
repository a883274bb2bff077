"""Classification of tables and columns, with a reason for every table left out.

Decisions are column expressions over a table's grid (``ARRAY<ARRAY<STRING>>``),
so a table is judged in its row, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators import special as sp

#: What a header means, in the order in which it is tried, with the trust in it.
HEADER_RULES: list[tuple[str, str | None, int]] = [
    ("^$|^(pin|signal|terminal)? ?description", None, 0),
    ("(pin|ball|terminal) (no\\b|number)|引脚编号|端子编号|(引脚|端子|球) *编号", "pin_no", 5),
    ("^(pins|balls|terminals)$", "pin_no", 4),
    ("(pin|ball|signal|terminal) name|引脚名称|信号名称|引脚名|(引脚|信号|端子|球) *名称", "pin_name", 5),
    ("(signal|pin|terminal|i ?o) type|引脚类型|信号类型", "type", 5),
    ("^(no\\.?|number|signal no\\.?|ball|pin)$", "pin_no", 4),
    ("^(signal|name)$", "pin_name", 3),
    ("^(type|io|i o|类型)$| type$", "type", 3),
    ("package", "package", 2),
]
DESCRIPTION = "description|function|描述|说明"
#: The words of signal types.
TYPES = ("i", "o", "i/o", "io", "p", "g", "a", "d", "power", "ground", "input", "output", "pwr", "gnd", "nc", "—", "-")
FIRST_ROWS = 12
#: Titles of coordinate matrices, and headers that no such matrix has.
MATRIX_TITLES = "pin configuration|pinout|pin map|pin assignment"
MATRIX_NOT = "pin no|pin number|ball number|terminal no|signal name"
#: The columns of an ordering table.
ORDERING = ("orderable device", "package qty", "package type", "package drawing", "eco plan", "lead finish", "msl peak temp")


def role_form(c: Column) -> Column:
    """A header in the form that the rules are tried on."""
    return tx.header_form(tx.strip_footnotes(c))


def role_of(h: Column) -> Column:
    """struct(field, score) of a header in ``role_form``; the first rule that fits decides."""
    out = F.struct(F.lit(None).cast("string").alias("field"), F.lit(0).alias("score"))
    for pattern, field, score in reversed(HEADER_RULES):
        out = F.when(h.rlike(pattern), F.struct(F.lit(field).cast("string").alias("field"), F.lit(score).alias("score"))).otherwise(out)
    return out


def header_role(c: Column) -> Column:
    """struct(field, score) of a header as written."""
    return role_of(role_form(c))


def row_score(row: Column) -> Column:
    """How much a row looks like a header. Forms are made once per cell, then bound in the next lambda."""
    forms = F.transform(row, role_form)
    return F.aggregate(F.transform(forms, lambda h: role_of(h)["score"]), F.lit(0), lambda a, s: a + s)


def header_row(grid: Column) -> Column:
    """struct(score, index) of the best header among the first rows, the earliest on ties."""
    first = F.slice(grid, 1, FIRST_ROWS)
    return F.array_max(F.transform(first, lambda r, i: F.struct(row_score(r).alias("score"), (-i).alias("minus"))))


def column_fields(header: Column) -> Column:
    """struct(field, score) of every column; the description column is the first that says so and has no other role."""
    return F.transform(F.transform(header, role_form), lambda h: F.when(h.rlike(DESCRIPTION), F.struct(F.lit("description").alias("field"), F.lit(1).alias("score"))).otherwise(role_of(h)))


def field_index(fields: Column, name: str) -> Column:
    """Place of the first column with the best score for a field; null if there is none."""
    with_place = F.filter(F.transform(fields, lambda f, i: F.struct(f["score"].alias("score"), (-i).alias("minus"), f["field"].alias("field"))), lambda x: x["field"] == name)
    return -F.array_max(with_place)["minus"]


def single_value_row(row: Column) -> Column:
    """The only value of a row that holds one, repeated or alone; null else."""
    values = F.array_distinct(F.filter(row, lambda c: F.trim(c) != ""))
    return F.when((F.size(values) == 1) & (F.size(row) > 1), values[0])


def is_matrix(grid: Column, title: Column) -> Column:
    """A coordinate matrix: numbers in the header, single letters down the first column, and no header that names a number."""
    head = F.transform(F.coalesce(F.get(grid, F.lit(0)), F.array().cast("array<string>")), tx.header_form)
    numbers = F.size(F.filter(head, lambda c: c.rlike(r"^\d{1,3}$")))
    letters = F.size(F.filter(F.slice(grid, 2, FIRST_ROWS - 1), lambda r: F.coalesce(tx.header_form(F.get(r, F.lit(0))).rlike("^[a-z]$"), F.lit(False))))
    named = F.exists(head, lambda c: c.rlike(MATRIX_NOT))
    signal = F.coalesce(tx.header_form(title).rlike(MATRIX_TITLES), F.lit(False))
    return (F.size(grid) > 2) & ((signal & (numbers >= 2) & (letters >= 2)) | (~named & (numbers >= 4) & (letters >= 3)))


def is_ordering(header: Column) -> Column:
    """An ordering table: names the orderable device and another of its usual columns."""
    joined = tx.header_form(F.array_join(header, " "))
    hits = [joined.contains(w).cast("int") for w in ORDERING]
    return F.coalesce(joined.contains(ORDERING[0]) & (sum(hits, F.lit(0)) >= 2), F.lit(False))


def repeats_blocks(header: Column) -> Column:
    """Two or more equal blocks of number, name and type side by side, and nothing else."""
    roles = F.concat(F.array_join(F.transform(F.transform(header, role_form), lambda h: F.coalesce(role_of(h)["field"], F.lit("other"))), ","), F.lit(","))
    return roles.rlike("^(pin_no,pin_name,type,){2,}$|^(pin_no,pin_name,){2,}$")


def is_reserved(row: Column) -> Column:
    return F.exists(row, lambda c: F.lower(F.trim(c)).rlike("^(reserved|nc|n/c|no connect|rsvd)(-?\\d+)?$"))


def looks_like_pin(c: Column) -> Column:
    return F.trim(c).rlike("^[A-Z]{0,3}[0-9]{1,4}$")


def is_type(c: Column) -> Column:
    return F.lower(F.trim(c)).isin(*TYPES)


def decide(tables: DataFrame, grid: str = "grid", title: str = "title") -> DataFrame:
    """``tables`` with header row, columns and ``skip_reason`` (null: to be extracted); first reason wins."""
    g = F.col(grid)
    t = tables.withColumn("_best", header_row(g)).withColumn("header_idx", -F.col("_best")["minus"]).withColumn("header", F.get(g, F.col("header_idx"))).withColumn("_fields", column_fields(F.col("header")))
    t = t.withColumns({f"{name}_col": field_index(F.col("_fields"), name) for name in ("pin_no", "pin_name", "type", "description")})
    special = sp.special_kind(F.col(title), F.col("header"), F.slice(g, F.col("header_idx") + 2, F.greatest(F.size(g), F.lit(1))))
    reason = (
        F.when(g.isNull() | (F.size(g) < 2), "too_few_rows")
        .when(is_matrix(g, F.col(title)), "pinout_matrix")
        .when(is_ordering(F.col("header")), "ordering_table")
        .when(repeats_blocks(F.col("header")), "repeated_horizontal_blocks")
        .when(special.isin("unused_pins", "interface_modes", "control_word"), special)
        .when(F.coalesce(F.col("_best")["score"], F.lit(0)) < 4, "no_header")
        .when(F.col("pin_no_col").isNull(), "semantic_missing_pin_no_column")
    )
    return t.withColumn("skip_reason", reason).withColumn("header_score", F.col("_best")["score"]).drop("_best", "_fields")


def sample_rows(count: Column, index: Column) -> Column:
    """Whether a row belongs to the sample of its table: all of up to 30, else 8 + 4 + 8 or, beyond 200, 6 + 8 + 6 spread evenly."""
    middle = F.floor(count / 2) - 2
    few, many = (index < 8) | (index >= count - 8) | ((index >= middle) & (index < middle + 4)), (index < 6) | (index >= count - 6)
    inner = count - 12
    spread = F.exists(F.sequence(F.lit(0), F.lit(7)), lambda i: index == 6 + F.floor((i * 2 + 1) * inner / 16))
    return F.when(count <= 30, True).when(count <= 200, few).otherwise(many | spread)


def combined_headers(grid: Column, last: Column) -> Column:
    """Header text of each column over the rows down to ``last``, equal parts once."""
    rows = F.slice(grid, 1, last + 1)
    return F.transform(grid[0], lambda _, i: F.array_join(F.array_distinct(F.filter(F.transform(rows, lambda r: F.trim(F.coalesce(F.get(r, i), F.lit("")))), lambda x: x != "")), " "))
