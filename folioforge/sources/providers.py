"""Contracts of decoders and models that this engine doesn't contain.

A provider turns rows of one table into rows of another; its schemas are fixed
here, so everything after it is independent of how it is made.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame

#: Output tables of the providers.
SCHEMAS = {
    "characters": "document_name string, page_idx int, char_idx int, char string, bbox array<double>",
    "layout": "document_name string, page_idx int, label string, score double, bbox array<double>, index int",
    "recognised": "document_name string, page_idx int, bbox array<double>, text string, score double",
    "formulas": "document_name string, page_idx int, bbox array<double>, latex string",
    "blocks": "document_name string, page_idx int, block_seq int, type string, text string, html string, bbox array<double>",
    "cells": "document_name string, sheet string, row int, col int, text string, row_span int, col_span int",
    "decisions": "table_id bigint, should_extract boolean, role string, reason string, columns array<struct<column_index:int,role:string>>",
}


class Provider(Protocol):
    """A source of one of the tables in ``SCHEMAS``."""

    table: str

    def provide(self, inputs: DataFrame) -> DataFrame: ...


def checked(provider: Provider, inputs: DataFrame) -> DataFrame:
    """The provider's rows; refused if its columns aren't those of its table."""
    out = provider.provide(inputs)
    want = inputs.sparkSession.createDataFrame([], SCHEMAS[provider.table]).schema
    got = {f.name: f.dataType.simpleString() for f in out.schema}
    missing = [f.name for f in want if got.get(f.name) != f.dataType.simpleString()]
    if missing:
        raise ValueError(f"provider of {provider.table} lacks or mistypes {', '.join(missing)}")
    return out.select(*want.names)
