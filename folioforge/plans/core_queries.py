"""Queries of the general data operators (nested records, packed cells) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.packed import split_packed
from folioforge.operators.shred import LAYERS, NEEDED, OWNERS, page_tables, shred, span_places
from folioforge.session import table

FIELDS = {"pages": ("page_idx",), "blocks": ("type", "index", "level", "bbox"), "children": ("type", "index", "level", "bbox"), "lines": ("bbox",), "spans": ("type", "content", "score", "bbox")}


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all span objects of the parsed page trees."""
    return span_places(shred(table(spark, sf_dir, "parse_results"), "parse_id", "middle_json", scalars=False, objects=set().union(*NEEDED.values())))


def _entities(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fields = FIELDS[name]
        nodes = shred(table(spark, sf_dir, "parse_results"), "parse_id", "middle_json", scalars=dict.fromkeys(OWNERS[name], fields), objects=NEEDED[name])
        return page_tables(nodes, {name: fields})[name].withColumnRenamed("doc", "parse_id")

    query.__doc__ = f"Flat table of {name}, with each row's parent node and its scalar fields."
    return query


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The single values of packed pin numbers and names."""
    return split_packed(table(spark, sf_dir, "pin_rows")).select("row_id", "field_name", "item_no", "item_text")


def p6_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same values with their place in the cell, the grammar alternative and its error flag."""
    return split_packed(table(spark, sf_dir, "pin_rows"))


QUERIES = {
    "p5_found": p5_found,
    "p5_pages": _entities("pages"),
    "p5_blocks": _entities("blocks"),
    "p5_children": _entities("children"),
    "p5_lines": _entities("lines"),
    "p5_spans": _entities("spans"),
    "p6_found": p6_found,
    "p6_places": p6_places,
}

_PAGES = f"""
doc AS (SELECT DISTINCT parse_id, middle_json::JSON AS j FROM parse_results WHERE json_valid(middle_json)),
arr AS (SELECT parse_id, CASE WHEN json_type(j) = 'ARRAY' THEN j->'$[*]'
          ELSE coalesce(nullif(j->'$.pdf_info[*]', []), nullif(j->'$.pdf_info_list[*]', []), nullif(j->'$.pages[*]', []), j->'$.page_info_list[*]') END AS l FROM doc),
page AS (SELECT parse_id, l[i + 1] AS page, i AS page_seq FROM (SELECT parse_id, l, unnest(range(len(l))) AS i FROM arr)),
layers AS ({" UNION ALL ".join(f"SELECT parse_id, page_seq, '{k}' AS layer, page->'$.{k}[*]' AS l FROM page" for k in LAYERS)}),
block AS (SELECT parse_id, page_seq, layer, l[i + 1] AS block, i AS block_seq FROM (SELECT *, unnest(range(len(l))) AS i FROM layers)),
kids AS (SELECT *, block->'$.blocks[*]' AS l FROM block),
owner AS (SELECT parse_id, page_seq, layer, block_seq, -1 AS child_seq, block AS o FROM block
          UNION ALL SELECT parse_id, page_seq, layer, block_seq, i, l[i + 1] FROM (SELECT *, unnest(range(len(l))) AS i FROM kids)),
ls AS (SELECT *, o->'$.lines[*]' AS l FROM owner),
line AS (SELECT parse_id, page_seq, layer, block_seq, child_seq, i AS line_seq, l[i + 1] AS line FROM (SELECT *, unnest(range(len(l))) AS i FROM ls)),
ss AS (SELECT *, line->'$.spans[*]' AS l FROM line),
span AS (SELECT parse_id, page_seq, layer, block_seq, child_seq, line_seq, i AS span_seq, l[i + 1] AS span FROM (SELECT *, unnest(range(len(l))) AS i FROM ss))
"""
ORACLE = {
    "p5_found": f"""WITH {_PAGES}
SELECT parse_id, page_seq::INT AS page_seq, layer, block_seq::INT AS block_seq, child_seq::INT AS child_seq, line_seq::INT AS line_seq, span_seq::INT AS span_seq
FROM span WHERE json_type(span) = 'OBJECT'""",
}
