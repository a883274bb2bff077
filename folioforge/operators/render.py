"""Blocks as Markdown and as flat content lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import geometry as geo


def block_texts(spans: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(by, block_seq, block_type, text, html, image_path, bbox): spans gathered to blocks in reading order."""
    b = geo.Box.of(F.col("bbox"))
    piece = F.struct(*order, F.col("content").alias("c"))
    grouped = spans.groupBy(*by, "block_seq").agg(
        F.min("block_type").alias("block_type"), F.array_sort(F.collect_list(piece)).alias("ps"), F.max("html").alias("html"), F.max("image_path").alias("image_path"),
        F.min(b.x0).alias("x0"), F.min(b.y0).alias("y0"), F.max(b.x1).alias("x1"), F.max(b.y1).alias("y1"), F.first("page_size", True).alias("page_size"),
    )
    lines = F.filter(F.transform("ps", lambda p: F.trim(p["c"])), lambda c: c.isNotNull() & (c != ""))
    glue = lambda a, x: F.when(a == "", x).when(a.rlike("[A-Za-z]-$") & x.rlike("^[a-z]"), F.concat(F.regexp_replace(a, "-$", ""), x)).when(a.rlike("[\\x{4e00}-\\x{9fff}]$"), F.concat(a, x)).otherwise(F.concat(a, F.lit(" "), x))
    return grouped.select(*by, "block_seq", "block_type", F.aggregate(lines, F.lit(""), glue).alias("text"), "html", "image_path", F.array("x0", "y0", "x1", "y1").alias("bbox"), "page_size")


def markdown_block(kind: Column, text: Column, html: Column, image: Column) -> Column:
    """A block as Markdown: headings, tables, images, formulas, lists, text; null for blocks without anything to show."""
    return F.nullif(
        F.when(kind == "title", F.concat(F.lit("# "), text))
        .when(html.isNotNull(), html)
        .when(image.isNotNull(), F.concat(F.lit("![]("), image, F.lit(")")))
        .when(kind == "interline_equation", F.concat(F.lit("$$\n"), text, F.lit("\n$$")))
        .when(kind == "list", F.concat(F.lit("- "), text))
        .otherwise(text),
        F.lit(""),
    )


def markdown(blocks: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(by, markdown): blocks in order, parted by blank lines."""
    part = F.struct(*order, markdown_block(F.col("block_type"), F.col("text"), F.col("html"), F.col("image_path")).alias("m"))
    every = F.transform(F.array_sort(F.collect_list(part)), lambda p: p["m"])
    return blocks.groupBy(*by).agg(F.array_join(F.filter(every, lambda m: m.isNotNull()), "\n\n").alias("markdown"))


def content_list(blocks: DataFrame) -> DataFrame:
    """One typed item per block: type, text, level, image, table, formula format, box in thousandths and page."""
    kind = F.col("block_type")
    w, h = F.get("page_size", F.lit(0)), F.get("page_size", F.lit(1))
    box = F.array(*geo.to_thousandths(geo.Box.of(F.col("bbox")), w, h))
    is_table, is_image = kind.startswith("table"), kind.startswith("image")
    return blocks.select(
        "document_name", "page_idx", "block_seq",
        F.when(is_table, "table").when(is_image, "image").when(kind == "interline_equation", "equation").when(kind == "list", "list").otherwise("text").alias("type"),
        F.when(~is_table & ~is_image | kind.rlike("caption|footnote"), F.col("text")).alias("text"), F.when(kind == "title", 1).alias("text_level"), F.when(is_table, F.col("html")).alias("table_body"),
        F.when(is_image, F.col("image_path")).alias("img_path"), F.when(kind == "interline_equation", "latex").alias("text_format"), box.alias("bbox"),
    )
