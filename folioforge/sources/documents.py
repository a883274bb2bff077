"""Readers of files: bytes, parsed JSON, Markdown twins, content lists; kinds by their first bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = ("pdf", "png", "jpg", "jpeg", "docx", "pptx", "xlsx")
MARKDOWN = "document_name string, markdown_file string, markdown string"


def kind_of_bytes(content: Column) -> Column:
    """Kind of a file by its first bytes: pdf, png, jpg, zip (office files) or unknown."""
    head = F.hex(F.substring(content, 1, 8))
    return F.when(head.startswith("25504446"), "pdf").when(head.startswith("89504E47"), "png").when(head.startswith("FFD8FF"), "jpg").when(head.startswith("504B0304"), "zip").otherwise("unknown")


def read_files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """(path, name, stem, suffix, kind, length, content) of a folder's files with an allowed suffix."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{%s}" % ",".join(suffixes)).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("suffix"), kind_of_bytes(F.col("content")).alias("kind"), "length", "content")


def read_markdown_json(spark: SparkSession, path: str) -> DataFrame:
    """Final JSON objects whose Markdown holds a table; other files give no row."""
    rows = spark.read.schema(MARKDOWN).option("multiLine", "true").option("mode", "PERMISSIVE").json(path)
    return rows.where(F.lower("markdown").contains("<table"))


def read_middle_json(spark: SparkSession, path: str) -> DataFrame:
    """(document_name, middle_json) of whole JSON files, for ``operators.shred``."""
    files = spark.read.option("wholetext", "true").text(path)
    return files.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("document_name"), F.col("value").alias("middle_json"))


def page_slice(pages: DataFrame, first: int, last: int | None, page: str = "page_idx") -> DataFrame:
    """Pages from ``first`` to ``last``; None for the end."""
    c = F.col(page) >= first
    return pages.where(c if last is None or last < 0 else c & (F.col(page) <= last))


def artifacts(names: DataFrame, path: str = "path") -> DataFrame:
    """(stem, final, middle): final and middle files of one stem; stems that lack one of them are left out."""
    name = F.element_at(F.split(path, "/"), -1)
    stem = F.regexp_replace(name, r"(_middle)?\.json$", "")
    both = names.where(name.endswith(".json")).groupBy(stem.alias("stem")).agg(F.max(F.when(~name.endswith("_middle.json"), F.col(path))).alias("final"), F.max(F.when(name.endswith("_middle.json"), F.col(path))).alias("middle"))
    return both.where("final is not null and middle is not null")
