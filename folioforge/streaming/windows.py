"""Streams: windowed counts with watermarks, sessions, and completion of documents from their pages."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from folioforge.session import shared_folder


def read_stream(spark: SparkSession, folder: str, pattern: str, like: DataFrame) -> DataFrame:
    """A stream over the Parquet files of a folder whose names match ``pattern``."""
    return spark.readStream.schema(like.schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").parquet(folder)


def tumbling(stream: DataFrame, time: str, size: str, late: str, *keys: str) -> DataFrame:
    """Counts per window and key; rows later than ``late`` are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, size), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def sliding(stream: DataFrame, time: str, size: str, step: str, late: str, *keys: str) -> DataFrame:
    """Counts per sliding window and key."""
    return stream.withWatermark(time, late).groupBy(F.window(time, size, step), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def sessions(stream: DataFrame, time: str, gap: str, late: str, *keys: str) -> DataFrame:
    """Counts per session, which ends after ``gap`` without a row."""
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), *keys, "n")


def complete_documents(pages: DataFrame, doc: str = "document_name", page: str = "page_idx", total: str = "page_count") -> DataFrame:
    """(doc, pages): a document as soon as all its pages have come, once; repeated pages count once."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen: set[int] = set(state.get[0]) if state.exists else set()
        done = state.get[1] if state.exists else False
        need = None
        for part in parts:
            seen |= {int(p) for p in part[page]}
            need = int(part[total].max())
        if not done and need is not None and len(seen) >= need:
            done = True
            yield pd.DataFrame({doc: [key[0]], "pages": [len(seen)]})
        state.update((sorted(seen), done))

    return pages.groupBy(doc).applyInPandasWithState(step, f"{doc} string, pages bigint", "seen array<int>, done boolean", "append", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """What a stream over the files that are there now gives, by one ``availableNow`` run.

    Every batch is written as a table to the shared folder; in ``complete`` mode the
    last one holds the result. Nothing of it comes to the driver.
    """
    spark = stream.sparkSession
    place = f"{shared_folder(spark)}/stream-{name}-{uuid.uuid4().hex}"
    schema, last = stream.schema, []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{place}/batch={number:09d}")
        last.append(number)

    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{place}-state").trigger(availableNow=True).start()
    query.awaitTermination()
    if not last:
        return spark.createDataFrame([], schema)
    kept = last[-1:] if mode == "complete" else last
    return spark.read.schema(schema).parquet(*[f"{place}/batch={n:09d}" for n in sorted(set(kept))])


def state_ttl(options: dict[str, Any], hours: int) -> dict[str, Any]:
    """Options of a state variable that forgets keys after ``hours``."""
    return {**options, "ttlDurationMs": hours * 3_600_000}
