"""Records from tables: rows to pins, ordered dedupe, nested results, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import ranges
from folioforge.functions import text as tx
from folioforge.operators import grid as gr
from folioforge.operators import tables as tb


def mapped(row: Column, place: Column) -> Column:
    """Value of an optional column: null if the table has no such column, '' if the cell is empty."""
    return F.when(place.isNotNull(), F.coalesce(F.trim(F.get(row, place)), F.lit("")))


def extract(tables: DataFrame, key: str = "table_id") -> DataFrame:
    """Pin records of all tables that are not left out: key, group, place and the fields.

    One pass: grid, decision, rows and values of a table are made where it is;
    nothing is shuffled.
    """
    decided = tb.decide(gr.with_grid(tables.select(key, "document_name", "page_idx", "title", "html"), "html", lines=True).drop("html")).where("skip_reason is null")
    rows = decided.select(key, "document_name", "page_idx", "header_idx", "pin_no_col", "pin_name_col", "type_col", "description_col", F.posexplode("grid").alias("row_idx", "row")).where("row_idx > header_idx")
    rows = rows.where(F.exists("row", lambda c: F.trim(c) != ""))
    section = tb.single_value_row(F.col("row"))
    w = Window.partitionBy(key).orderBy("row_idx").rowsBetween(Window.unboundedPreceding, 0)
    named = rows.withColumn("section", F.when(section.isNotNull() & ~tb.looks_like_pin(section), section)).withColumn("group", F.last("section", True).over(w))
    data = named.where("section is null")
    raw = mapped(F.col("row"), F.col("pin_name_col"))
    parts = data.withColumns({"_numbers": ranges.split_and_expand(mapped(F.col("row"), F.col("pin_no_col"))), "_names": tx.cell_lines(raw), "_raw": raw})  # each made once
    numbers, names = F.col("_numbers"), F.col("_names")
    pairs = F.when(F.size(names) == F.size(numbers), F.zip_with(numbers, names, lambda a, b: F.struct(a.alias("pin_no"), b.alias("pin_name")))).otherwise(F.transform(numbers, lambda n: F.struct(n.alias("pin_no"), F.col("_raw").alias("pin_name"))))
    some = F.when(F.size(numbers) == 0, F.array(F.struct(F.lit("").alias("pin_no"), F.col("_raw").alias("pin_name")))).otherwise(pairs)
    return parts.select(
        key, "document_name", "page_idx", F.coalesce("group", F.lit("")).alias("group"), "row_idx", F.posexplode(some).alias("pin_seq", "p"),
        mapped(F.col("row"), F.col("type_col")).alias("type"), mapped(F.col("row"), F.col("description_col")).alias("description"),
    ).select(key, "document_name", "page_idx", "group", "row_idx", "pin_seq", "p.pin_no", tx.clean_name(F.col("p.pin_name")).alias("pin_name"), "type", "description")


def ordered_dedupe(df: DataFrame, key: Sequence[str], order: Sequence[str], text: str) -> DataFrame:
    """The first row of each key, with the different non-empty values of ``text`` joined by line breaks in order of first appearance.

    One aggregation without a window: the first row is a minimum of structs.
    """
    rest = [c for c in df.columns if c not in key and c != text]
    first = F.min(F.struct(*order, *[F.col(c).alias(f"_{c}") for c in rest])).alias("first")
    texts = F.array_sort(F.collect_list(F.struct(*order, F.trim(F.col(text)).alias("t")))).alias("texts")
    joined = F.array_join(F.array_distinct(F.filter(F.transform("texts", lambda x: x["t"]), lambda t: t.isNotNull() & (t != ""))), "\n")
    return df.groupBy(*key).agg(first, texts).select(*key, *[F.col(f"first._{c}").alias(c) for c in rest], joined.alias(text))


def nested_result(pins: DataFrame, outer: str, group: str, order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(outer, group_list): records grouped twice, both levels in order of first appearance."""
    inner = pins.groupBy(outer, group).agg(F.min(F.struct(*order)).alias("at"), F.array_sort(F.collect_list(F.struct(*order, F.struct(*fields).alias("pin")))).alias("ps"))
    listed = inner.select(outer, F.struct("at", F.col(group).alias("group"), F.transform("ps", lambda p: p["pin"]).alias("pin_list")).alias("g"))
    return listed.groupBy(outer).agg(F.array_sort(F.collect_list("g")).alias("gs")).select(outer, F.transform("gs", lambda g: F.struct(g["group"].alias("group"), g["pin_list"].alias("pin_list"))).alias("group_list"))


def summary(pins: DataFrame, outer: str, group: str, page: str) -> DataFrame:
    """Counts and page ranges per group, per outer key and over all, in one pass of grouping sets."""
    return (
        pins.groupingSets([[outer, group], [outer], []], outer, group)
        .agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("pins"), F.count_distinct(page).alias("pages"), F.min(page).alias("first_page"), F.max(page).alias("last_page"))
        .select(outer, group, "level", "pins", "pages", "first_page", "last_page")
    )


def suffix_duplicates(df: DataFrame, scope: Sequence[str], name: str, order: Sequence[str]) -> DataFrame:
    """``name`` with a running number where it stands more than once in its scope."""
    by_name = Window.partitionBy(*scope, name)
    n = F.count("*").over(by_name)
    at = F.row_number().over(by_name.orderBy(*order))
    return df.withColumn(name, F.when(n > 1, F.concat(F.col(name), F.lit("_"), at)).otherwise(F.col(name)))


def merge_fields(values: Column) -> Column:
    """Different non-empty values of columns with the same meaning, as ``a | b``."""
    return F.array_join(F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (F.trim(v) != ""))), " | ")
