"""Session set-up, table access and lineage cuts shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "folioforge", cpus: int | str = "*", partitions: int = 8, memory: str = "20g") -> SparkSession:
    """A local session with the settings the operators expect (UTC, AQE, Arrow).

    On a cluster the session comes from spark-submit instead; no operator sets
    configuration of its own.
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``; on one machine a temporary one where that is unset."""
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix=f"folioforge-{os.getpid()}-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame, keep_partitioning: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there, so that nothing before it is done again.

    It is written as a compressed table. ``keep_partitioning`` makes a reliable
    checkpoint instead, which is larger, but lets later joins on the same key do
    without an exchange.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if keep_partitioning:
        return df.checkpoint()
    place = f"{folder}/cut-{uuid.uuid4().hex}"
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)
