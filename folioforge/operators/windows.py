"""Order-dependent scans as windows: forward fill, islands, intervals, lines and paragraphs.

Order is carried by explicit ordinals. Every function takes the columns of its
partition, so a caller decides how finely the work is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _over(by: Sequence[str], order: Sequence[str | Column]):
    return Window.partitionBy(*by).orderBy(*order)


def forward_fill(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], column: str) -> DataFrame:
    """The last non-null value so far."""
    w = _over(by, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(column, F.last(column, ignorenulls=True).over(w))


def islands(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], starts: Column, name: str = "island") -> DataFrame:
    """Number of the island a row belongs to, 0 before the first start; ``starts`` may use ``lag`` over the same order."""
    w = _over(by, order)
    return df.withColumn("_start", F.coalesce(starts, F.lit(False)).cast("int")).withColumn(name, F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_start")


def gap_islands(df: DataFrame, by: Sequence[str], order: str, gap: float, name: str = "island") -> DataFrame:
    """Islands of rows whose distance in ``order`` to the row before is at most ``gap``."""
    w = _over(by, [order])
    return islands(df.withColumn("_before", F.lag(order).over(w)), by, [order], F.col("_before").isNull() | (F.col(order) - F.col("_before") > gap), name).drop("_before")


def merge_intervals(df: DataFrame, by: Sequence[str], low: str, high: str) -> DataFrame:
    """(by, low, high): the union of overlapping or touching intervals."""
    w = _over(by, [low, high])
    reach = F.max(high).over(w.rowsBetween(Window.unboundedPreceding, -1))
    numbered = islands(df.select(*by, low, high).withColumn("_reach", reach), by, [low, high], F.col("_reach").isNull() | (F.col(low) > F.col("_reach")))
    return numbered.groupBy(*by, "island").agg(F.min(low).alias(low), F.max(high).alias(high)).drop("island")


def subtract_intervals(df: DataFrame, masks: DataFrame, by: Sequence[str], low: str, high: str) -> DataFrame:
    """Parts of the intervals of ``df`` that no mask covers (whole numbers, both ends inside)."""
    merged = merge_intervals(masks, by, low, high).withColumnsRenamed({low: "_ml", high: "_mh"})
    base = df.select(*by, low, high).distinct()
    hits = base.join(merged, list(by), "left").where(F.col("_ml").isNull() | ((F.col("_ml") <= F.col(high)) & (F.col("_mh") >= F.col(low))))
    held = hits.groupBy(*by, low, high).agg(F.filter(F.array_sort(F.collect_list(F.struct("_ml", "_mh"))), lambda m: m["_ml"].isNotNull()).alias("ms"))
    none = base.join(held.select(*by, low, high), [*by, low, high], "left_anti").withColumn("ms", F.array().cast(held.schema["ms"].dataType))
    every = held.unionByName(none)
    starts = F.concat(F.array(F.col(low)), F.transform("ms", lambda m: m["_mh"] + 1))
    ends = F.concat(F.transform("ms", lambda m: m["_ml"] - 1), F.array(F.col(high)))
    parts = F.filter(F.zip_with(starts, ends, lambda a, b: F.struct(F.greatest(a, F.col(low)).alias("a"), F.least(b, F.col(high)).alias("b"))), lambda p: p["a"] <= p["b"])
    return every.select(*by, F.explode(parts).alias("p")).select(*by, F.col("p.a").alias(low), F.col("p.b").alias(high))


def lines_by_overlap(df: DataFrame, by: Sequence[str], y0: str, y1: str, x0: str, ratio: float = 0.6, name: str = "line") -> DataFrame:
    """Spans to lines: a span stays on the line of the span before it (by top edge) if they share more than ``ratio`` of the smaller height."""
    order = [y0, x0]
    w = _over(by, order)
    a0, a1 = F.lag(y0).over(w), F.lag(y1).over(w)
    shared = F.least(a1, F.col(y1)) - F.greatest(a0, F.col(y0))
    same = shared / F.least(a1 - a0, F.col(y1) - F.col(y0)) > ratio
    return islands(df.withColumn("_new", ~F.coalesce(same, F.lit(False))), by, order, F.col("_new"), name).drop("_new")


def rows_by_gap(df: DataFrame, by: Sequence[str], y: str, x: str, gap: float = 10.0) -> DataFrame:
    """Row number by gaps in y, and the place within the row by x."""
    return gap_islands(df, by, y, gap, "row_no").withColumn("row_place", F.row_number().over(Window.partitionBy(*by, "row_no").orderBy(x, y)))


def paragraph_starts(df: DataFrame, by: Sequence[str], order: Sequence[str | Column]) -> Column:
    """Whether a text block begins a paragraph: the block before ends a sentence, or this one begins with a capital or a digit.

    Expects ``text``; the blocks before are those of the same partition.
    """
    before = F.lag("text").over(_over(by, order))
    ends = F.trim(before).rlike("[.!?。！？…:：;；]$")
    begins = F.trim("text").rlike("^[A-Z0-9]")
    return before.isNull() | ends | begins


def merge_paragraphs(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(by, paragraph, text): blocks joined to paragraphs; hyphens at a seam fall before lower case."""
    marked = df.withColumn("_starts", paragraph_starts(df, by, order))
    numbered = islands(marked, by, order, F.col("_starts"), "paragraph")
    texts = numbered.groupBy(*by, "paragraph").agg(F.array_sort(F.collect_list(F.struct(*order, "text"))).alias("ts"))
    glue = lambda a, b: F.when(a == "", b).when(a.rlike("[A-Za-z]-$") & b.rlike("^[a-z]"), F.concat(F.regexp_replace(a, "-$", ""), b)).otherwise(F.concat(a, F.lit(" "), b))
    return texts.select(*by, "paragraph", F.aggregate("ts", F.lit(""), lambda acc, t: glue(acc, F.trim(t["text"]))).alias("text"))


def neighbours(df: DataFrame, by: Sequence[str], order: Sequence[str], flag: Column, reach: int = 3) -> Column:
    """How many rows within ``reach`` before and after, the row itself not counted, have the flag."""
    w = _over(by, order).rowsBetween(-reach, reach)
    return F.sum(flag.cast("int")).over(w) - flag.cast("int")


def page_window(df: DataFrame, order: Sequence[str], size: int = 64) -> DataFrame:
    """Number of the processing window of ``size`` rows over all documents.

    Running numbers over everything need no single task: rows are range-sorted,
    and the numbers of earlier partitions are added to those within each.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    local = placed.withColumn("_i", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = local.groupBy("_part").agg(F.max("_i").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    return local.join(F.broadcast(before), "_part").withColumn("window_no", F.floor((F.col("_before") + F.col("_i") - 1) / size).cast("int")).drop("_part", "_i", "_before")


def notes(df: DataFrame, by: Sequence[str], order: Sequence[str], kind: str = "type", text: str = "content", left: str = "x0", page: str = "page_idx", indent: float = 60.0) -> DataFrame:
    """(by, note_no, text): notes in reading order.

    A note begins at a block whose first line is NOTE or 注 alone and goes on
    until the page, the marker, a heading or the indent changes.
    """
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: F.trim(x) != "")
    marker = F.coalesce(F.trim(F.get(lines, F.lit(0))).rlike("^(NOTE|注)[:：]?$"), F.lit(False))
    rest = F.array_join(F.slice(lines, 2, 10_000), "\n")
    skip = F.col(kind).isin("header", "footer", "page_number")
    marked = islands(df.where(~skip).withColumn("_marker", marker).withColumn("_rest", F.when(marker, rest).otherwise(F.col(text))), by, order, F.col("_marker"), "note").where("note > 0")
    first = Window.partitionBy(*by, "note").orderBy(*order)
    own = first.rowsBetween(Window.unboundedPreceding, 0)
    stop = (F.col(page) != F.first(page).over(own)) | (F.col(left) < F.first(left).over(own) - indent) | ~F.col(kind).isin("text", "list") | (F.col(kind) == "title")
    live = marked.withColumn("_stop", stop.cast("int")).withColumn("_stopped", F.sum("_stop").over(own)).where("_stopped = 0")
    texts = live.groupBy(*by, "note").agg(F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct(*order, "_rest"))), lambda x: x["_rest"]), lambda t: F.trim(t) != ""), "\n").alias("text")).where("text <> ''")
    return texts.select(*by, F.row_number().over(Window.partitionBy(*by).orderBy("note")).alias("note_no"), "text")


def notes_map(found: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, notes): a map note1, note2, ... per document."""
    return found.groupBy(*by).agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("note_no", "text"))), lambda x: F.struct(F.concat(F.lit("note"), x["note_no"]), x["text"]))).alias("notes"))
