"""Writers: results as JSON, Markdown twins, batch summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """One JSON object per row, in folders by ``by`` if given."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(by) if by else writer).json(path)


def markdown_twin(df: DataFrame) -> DataFrame:
    """(document_name, json): the JSON twin of a Markdown text."""
    return df.select("document_name", F.to_json(F.struct("document_name", "markdown_file", "markdown")).alias("json"))


def batch_summary(results: DataFrame, ok: str = "ok", items: str = "items") -> DataFrame:
    """Totals of a batch: documents, successes, failures and items."""
    return results.agg(F.count("*").alias("documents"), F.count_if(F.col(ok)).alias("succeeded"), F.count_if(~F.col(ok)).alias("failed"), F.coalesce(F.sum(items), F.lit(0)).alias("items"))
