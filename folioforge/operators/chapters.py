"""Chapter context of lines and tables, as windows over heading levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import text as tx

LEVELS = 5


def with_chapters(lines: DataFrame, by: Sequence[str], order: str, text: str = "line") -> DataFrame:
    """``lines`` with ``chapters``, the titles from the outermost heading to the innermost that hold at the line.

    A heading closes all headings of its own and deeper levels. For each level
    the last heading is carried forward and counts while it is younger than the
    last heading of every outer level.
    """
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumns({"_level": tx.heading_level(F.col(text)), "_title": tx.heading_title(F.col(text))})
    last = {n: F.last(F.when(F.col("_level") == n, F.struct(F.col(order).alias("at"), F.col("_title").alias("title"))), True).over(w).alias(f"_h{n}") for n in range(1, LEVELS + 1)}
    held = marked.select("*", *last.values())
    parts = []
    for n in range(1, LEVELS + 1):
        here = F.col(f"_h{n}")
        outer = [F.coalesce(F.col(f"_h{k}")["at"], F.lit(-1)) for k in range(1, n)]
        alive = here.isNotNull() if not outer else here.isNotNull() & (here["at"] > (F.greatest(*outer) if len(outer) > 1 else outer[0]))
        parts.append(F.when(alive, here["title"]))
    return held.withColumn("chapters", F.filter(F.array(*parts), lambda t: t.isNotNull())).drop("_level", "_title", *[f"_h{n}" for n in range(1, LEVELS + 1)])


def contents_pages(pages: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    """(doc, first, last): the pages of a table of contents, from the first titled one on while pages hold numbered entries."""
    titled = F.lower(F.col(text)).rlike(r"(?m)^\s*(table of )?contents\s*$|^\s*目录\s*$")
    entries = F.regexp_count(F.col(text), F.lit(r"(?m)^\s*\d+(\.\d+)*\.?\s+\S.*?\.{0,}\s*\d+\s*$"))
    marked = pages.select(doc, page, titled.alias("_t"), (entries >= 2).alias("_e"))
    start = marked.where("_t").groupBy(doc).agg(F.min(page).alias("first"))
    w = Window.partitionBy(doc).orderBy(page).rowsBetween(Window.unboundedPreceding, 0)
    after = marked.join(start, doc).where(F.col(page) >= F.col("first"))
    run = after.withColumn("_go", F.min((F.col("_e") | (F.col(page) == F.col("first"))).cast("int")).over(w)).where("_go = 1")
    return run.groupBy(doc, "first").agg(F.max(page).alias("last")).select(doc, "first", "last")
