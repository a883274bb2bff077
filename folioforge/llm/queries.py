"""Queries of the operators for model text, and their SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import bpe, canon, catalog, leak, oracle, pii, scanfix, survivor
from folioforge.session import table

TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
BPE_FILE = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of spans of one page that differ but print the same."""
    return canon.look_alike_pairs(table(spark, sf_dir, "spans"), "span_id", "content", ["document_name", "page_idx"])


def p1_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every span's content in its consistent form."""
    return canon.canonical(table(spark, sf_dir, "spans").select("span_id", "content"), "span_id", "content").select(F.col("id").alias("span_id"), F.col("canon").alias("content"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of noise from scanning in spans and tables."""
    return scanfix.find_noise(table(spark, sf_dir, "spans"), table(spark, sf_dir, "table_candidates"))


def p2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable paragraphs of the scanned pages."""
    return scanfix.paragraphs(table(spark, sf_dir, "spans"), table(spark, sf_dir, "table_candidates"))


def p2_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables with clean cells, without rows that are page furniture."""
    return scanfix.clean_tables(table(spark, sf_dir, "spans"), table(spark, sf_dir, "table_candidates"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of records of one pin."""
    return survivor.duplicate_pairs(table(spark, sf_dir, "pins"))


def p3_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per pin, built field by field."""
    return survivor.survivors(table(spark, sf_dir, "pins"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue entry that each assignment means."""
    return catalog.map_to_catalog(table(spark, sf_dir, "package_assignments"), table(spark, sf_dir, "package_catalog")).select("assignment_id", "entry_id")


def p4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that fit no entry, or several equally well, with the number of their rows."""
    rows = table(spark, sf_dir, "package_assignments").where("length(pkg) > 0").dropDuplicates(["assignment_id"])
    counts = rows.groupBy(F.col("pkg").alias("value")).agg(F.count("*").alias("assignments"))
    ranked = catalog.rank_entries(counts.select("value"), table(spark, sf_dir, "package_catalog"))
    return ranked.where(F.col("entry_id") == catalog.UNMATCHED).join(counts, "value").select("value", "assignments")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode_corpus(table(spark, sf_dir, "documents"), BPE_FILE)


def p7_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, their tokens and whether the streaming decoder gives back the text, by language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    ids = bpe.encode_corpus(docs, BPE_FILE)
    back = bpe.decode_corpus(ids, BPE_FILE).withColumnRenamed("text", "decoded")
    n = ids.select("doc_id", F.size("ids").alias("n"))
    return (
        docs.join(back, "doc_id").join(n, "doc_id").groupBy("lang")
        .agg(F.count("*").alias("docs"), F.sum("n").alias("tokens"), F.sum((F.coalesce("text", F.lit("")) == F.col("decoded")).cast("bigint")).alias("same"))
    )


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the held-out items that leaked into them word for word."""
    return p8_near(spark, sf_dir).where("exact").select("doc_id", "item_id")


def p8_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the items of which they hold enough within the edit budget, and the edits."""
    return leak.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each different piece of personal data of a document."""
    return pii.find_personal(table(spark, sf_dir, "documents")).select("doc_id", "kind", "item_text").distinct()


def p9_sanitised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts with typed placeholders in the place of personal data."""
    return pii.sanitise(table(spark, sf_dir, "documents"))


QUERIES = {
    "p1_found": p1_found,
    "p1_canonical": p1_canonical,
    "p2_found": p2_found,
    "p2_paragraphs": p2_paragraphs,
    "p2_tables": p2_tables,
    "p3_found": p3_found,
    "p3_survivors": p3_survivors,
    "p4_found": p4_found,
    "p4_unmatched": p4_unmatched,
    "p7_ids": p7_ids,
    "p7_roundtrip": p7_roundtrip,
    "p8_found": p8_found,
    "p8_near": p8_near,
    "p9_found": p9_found,
    "p9_sanitised": p9_sanitised,
}
ORACLE = oracle.ORACLE
