"""Blocks of pages in reading order: titles around tables, adjacent blocks, pipe tables, slots.

Windows run within pages, whose size is bounded by what a page holds; a document
of any length is spread over tasks. Null texts are no titles and end no run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How numbered titles begin.
TABLE_TITLE = r"(?i)^\s*(table|tabelle|tableau|表)\s*\d+"
FIGURE_TITLE = r"(?i)^\s*(figure|abbildung|bild|图)\s*\d+"


def titles_since(df: DataFrame, by: Sequence[str], order: Sequence[str], ends: Column, titles: dict[str, str], text: str) -> DataFrame:
    """``df`` with, for every name of ``titles``, the last text of its pattern since the row before that ``ends`` holds for."""
    w = Window.partitionBy(*by).orderBy(*order)
    parts = df.withColumn("_part", F.coalesce(F.sum(ends.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    local = Window.partitionBy(*by, "_part").orderBy(*order)
    return parts.withColumns({name: F.last(F.when(F.col(text).rlike(pattern), F.col(text)), ignorenulls=True).over(local) for name, pattern in titles.items()}).drop("_part")


def merge_adjacent(df: DataFrame, by: Sequence[str], order: Sequence[str], kind: str, text: str, count: str) -> DataFrame:
    """(by, run, kind, n, text): rows in order that have one ``kind`` joined by line breaks, with the number of different ``count``."""
    w = Window.partitionBy(*by).orderBy(*order)
    starts = ~F.coalesce(F.lag(kind).over(w) == F.col(kind), F.lit(False))
    runs = df.withColumn("_start", starts.cast("int")).withColumn("run", (F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("int"))
    lines = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_text"))))
    return runs.groupBy(*by, "run", kind).agg(F.count_distinct(count).alias("n"), F.array_join(F.transform(lines, lambda x: x["_text"]), "\n").alias("text"))


def pipe_tables(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_idx, col_idx, header, column_values) of the pipe tables of a text: runs of lines between pipes.

    The first line of a run is the header, rule lines fall away, missing cells are
    empty, cells beyond the header have no column. A text is folded in its row:
    lines are numbered and runs found with array functions, so nothing is shuffled.
    """
    lines = F.transform(F.split(F.regexp_replace(text, "\r", ""), "\n"), lambda x, i: F.struct(i.alias("i"), F.btrim(x, F.lit(" ")).alias("line")))
    piped = F.filter(lines, lambda x: x["line"].rlike(r"^\|.*\|$"))
    numbered = F.transform(piped, lambda x, k: F.struct((x["i"] - k).alias("run"), x["i"].alias("i"), F.transform(F.split(F.regexp_replace(x["line"], r"^\||\|$", ""), r"\|"), lambda c: F.btrim(c, F.lit(" "))).alias("cells")))
    rows = df.select(key, F.explode(F.array(numbered)).alias("rows"))
    runs = rows.select(key, "rows", F.explode(F.array_distinct(F.transform("rows", lambda r: r["run"]))).alias("run"))
    table = runs.select(key, F.expr("filter(rows, r -> r.run = run)").alias("t"))
    header = F.col("t")[0]["cells"]
    body = F.filter(F.slice("t", 2, F.size("t")), lambda r: ~F.array_join(r["cells"], "").rlike(r"^[-: ]+$"))
    wide = table.select(key, F.col("t")[0]["i"].alias("line_idx"), header.alias("header"), F.explode(F.array(body)).alias("body")).where(F.size("body") > 0)
    return wide.select(key, "line_idx", "body", F.posexplode("header").alias("col_idx", "header")).select(
        key, "line_idx", "col_idx", "header", F.expr("transform(body, r -> coalesce(get(r.cells, col_idx), ''))").alias("column_values")
    )


def single_slots(assignments: DataFrame) -> DataFrame:
    """(table_id, pkg, bound) of tables with assignments: the latest package where there is one slot, null where there are several."""
    per = assignments.where("coalesce(trim(pkg), '') <> ''").groupBy("table_id").agg(F.count_distinct("local_slot").alias("slots"), F.max_by("pkg", F.struct("assigned_at", "assignment_id")).alias("pkg"))
    one = F.col("slots") == 1
    return per.select("table_id", F.when(one, F.col("pkg")).alias("pkg"), F.when(one, "single_slot").otherwise("several_slots").alias("bound"))


def bucket_and_key(address: Column) -> Column:
    """struct(bucket, key) of ``s3://bucket/key``; empty texts where it is no such address."""
    return F.struct(F.regexp_extract(address, "^s3a?://([^/]+)/?", 1).alias("bucket"), F.regexp_extract(address, "^s3a?://[^/]+/(.*)$", 1).alias("key"))
