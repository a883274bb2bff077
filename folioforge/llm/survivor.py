"""One surviving record per group of duplicate pin records, built field by field.

Records with number and name are grouped by their written-out-normally forms
within (document, package); one aggregation per group takes, for every
attribute, the maximum of (has a value, not shortened, source priority, time,
value). Records that lack a number or a name are joined to these survivors and
belong to the only one they fit; their values then enter the same aggregation.

Cases: a record with neither number nor name, or whose part fits no or several
pins, is a group of its own; equal candidates are told apart by time and then by
value, so the result doesn't depend on row order; re-delivered rows count once;
null document or package forms its own group key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.width import full_to_half, strip_ignorables
from folioforge.session import cut

#: Trust in the ways a record can be made, highest first; unknown ways come last.
SOURCES = ("manual", "office", "rule", "vlm", "ocr")
ATTRIBUTES = ("pin_no", "pin_name", "type", "description")


def number_form(c: Column) -> Column:
    """``Pin 09.``, ``(9)``, ``#9`` and ``９`` as ``9``; ``a-12`` as ``A12``; null and blank as null."""
    s = F.upper(strip_ignorables(full_to_half(c)))
    s = F.regexp_replace(s, r"(?U)^\s*(?:(?:PIN|BALL|TERMINAL|NO|NR)\b[.\s]*)+", "")
    s = F.regexp_replace(s, r"[^A-Z0-9]", "")
    return F.nullif(F.regexp_replace(s, r"^([A-Z]*)0+(?=\d)", "$1"), F.lit(""))


def name_form(c: Column) -> Column:
    """Upper case without separators and footnote marks, the letter O as the digit; null and blank as null."""
    s = F.upper(strip_ignorables(full_to_half(c)))
    s = F.regexp_replace(s, r"(?U)(?:\s*\(\d{1,2}\)|[*†‡\s])+$", "")
    plus = F.translate(s, "+~", "PN")  # a sign tells D+ from D-
    s = F.regexp_replace(F.regexp_replace(plus, r"-$", "M"), r"(?U)[^\p{L}\p{N}]", "")
    return F.nullif(F.translate(s, "O", "0"), F.lit(""))


def _priority(c: Column, sources: Sequence[str]) -> Column:
    rank = F.lit(0)
    for place, source in enumerate(sources):
        rank = F.when(c == source, len(sources) - place).otherwise(rank)
    return rank


def members(df: DataFrame, sources: Sequence[str] = SOURCES, scope: Sequence[str] = ("document_name", "pkg"), key: str = "pin_id", source: str = "extractor", time: str = "extracted_at") -> DataFrame:
    """Every record once, with ``pin_key`` (the forms of the pin it is of; null if it is of none) and one composite struct per attribute."""
    scope_key = F.struct(*[F.col(c) for c in scope])
    best = [
        F.struct(
            (F.length(F.trim(F.col(a))) > 0).alias("filled"),
            (~F.col(a).endswith("…")).alias("whole"),
            _priority(F.col(source), sources).alias("priority"),
            F.col(time).cast("timestamp").alias("at"),
            F.col(a).alias("value"),
        ).alias(f"best_{a}")
        for a in ATTRIBUTES
    ]
    rows = df.select(F.col(key).alias("id"), scope_key.alias("scope"), number_form(F.col("pin_no")).alias("no"), name_form(F.col("pin_name")).alias("name"), *best).where("id is not null").dropDuplicates(["id"])
    rows = cut(rows)
    full = rows.where("no is not null and name is not null").withColumn("pin_key", F.struct("no", "name"))
    pins = full.select("scope", "pin_key").distinct()
    part = rows.where("no is null or name is null")

    def attach(records: DataFrame, field: str) -> DataFrame:
        only = pins.groupBy("scope", F.col(f"pin_key.{field}").alias(field)).agg(F.count("*").alias("n"), F.max("pin_key").alias("pin_key")).where("n = 1").drop("n")
        return _left(records, only, field)

    return (
        full.unionByName(attach(part.where("no is null and name is not null"), "name"))
        .unionByName(attach(part.where("name is null and no is not null"), "no"))
        .unionByName(part.where("no is null and name is null").withColumn("pin_key", F.lit(None).cast("struct<no:string,name:string>")))
    )


def _left(records: DataFrame, only: DataFrame, field: str) -> DataFrame:
    """Left join on scope and one form, both sides renamed apart."""
    o = only.withColumnRenamed("scope", "o_scope").withColumnRenamed(field, "o_field")
    return records.join(o, (records["scope"] == o["o_scope"]) & (records[field] == o["o_field"]), "left").drop("o_scope", "o_field")


def survivors(df: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    """One record per pin: scope, the surviving value of each attribute, how many records it stands for and the least id among them."""
    m = members(df, sources)
    alone = F.when(F.col("pin_key").isNull(), F.col("id"))
    kept = m.groupBy("scope", "pin_key", alone.alias("alone")).agg(
        F.min("id").alias("pin_id"), F.count("*").alias("records"), *[F.max(f"best_{a}").alias(f"best_{a}") for a in ATTRIBUTES]
    )
    return kept.select("pin_id", "scope.*", *[F.col(f"best_{a}.value").alias(a) for a in ATTRIBUTES], "records")


def duplicate_pairs(df: DataFrame) -> DataFrame:
    """(pin_id_a, pin_id_b), the smaller first, for all records of one pin."""
    m = cut(members(df).where("pin_key is not null").select("scope", "pin_key", "id"))
    a, b = m.withColumnRenamed("id", "pin_id_a"), m.withColumnRenamed("id", "pin_id_b")
    return a.join(b, ["scope", "pin_key"]).where("pin_id_a < pin_id_b").select("pin_id_a", "pin_id_b")
