"""Adjacency-table shredding of nested JSON text.

``shred`` turns every document into rows of one edge table
``(doc, node, parent, label, ordinal, kind, scalar)``: an array is no node of
its own, its elements hang below the owning object with the array's key as
label and their place as ordinal. ``entity`` joins the object nodes of a label
with their scalar children and pivots these into the columns of a flat table;
parent and child tables are linked by ``(doc, parent) = (doc, node)``.

Cases: a null, empty or cut-off text has no nodes; null elements keep their
place (ordinals count them) but are nodes of kind ``null``; a missing optional
field is a null column; repeated rows of one document key are shredded once,
and of different texts of one key the longest, then the one of the greatest hash,
stands for it.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.session import cut

NODE_SCHEMA = "doc bigint, version bigint, node int, parent int, label string, ordinal int, kind string, scalar string"
_ARROW = pa.schema(
    [("doc", pa.int64()), ("version", pa.int64()), ("node", pa.int32()), ("parent", pa.int32()), ("label", pa.string()), ("ordinal", pa.int32()), ("kind", pa.string()), ("scalar", pa.string())]
)
#: Keys under which the page list may stand, and the arrays of blocks of a page (fixed values of the format).
PAGE_KEYS = ("pdf_info", "pdf_info_list", "pages", "page_info_list")
LAYERS = ("para_blocks", "preproc_blocks", "discarded_blocks", "blocks")
ROOT = "$"
#: The labels of the object nodes that the tables of a page tree are made of.
NEEDED = {"pages": {ROOT, *PAGE_KEYS}, "blocks": {ROOT, *PAGE_KEYS, *LAYERS}, "children": {ROOT, *PAGE_KEYS, *LAYERS}, "lines": {"lines"}, "spans": {"spans"}}
OWNERS = {"pages": (ROOT, *PAGE_KEYS), "blocks": LAYERS, "children": ("blocks",), "lines": ("lines",), "spans": ("spans",)}


def _scalar_text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def _parse(text: str | None):
    """The parsed text, or None where it is no complete JSON (NaN and Infinity are none)."""
    if not text:
        return None

    def refuse(word: str) -> None:
        raise ValueError(word)

    try:
        return json.loads(text, parse_constant=refuse)
    except (ValueError, RecursionError):
        return None


def walk(root: object, scalars: bool | Mapping[str, Collection[str]] = True, objects: Collection[str] | None = None) -> Iterator[tuple[int, int, str, int, str, str | None]]:
    """(node, parent, label, ordinal, kind, scalar) of the nodes, parents before children.

    ``scalars`` limits scalar nodes to the keys given for the label of their owner,
    ``objects`` the others to the labels given. The others have even numbers, which don't
    depend on what is left out, so tables made apart still link to each other.
    An explicit stack keeps depth bounded by memory, not by recursion.
    """
    number, scalar = 0, 1
    stack: list[tuple[object, int, str, int]] = [(root, -1, ROOT, 0)]
    while stack:
        value, parent, label, ordinal = stack.pop()
        shown = objects is None or label in objects
        if isinstance(value, dict):
            me, number = number, number + 2
            if shown:
                yield me, parent, label, ordinal, "object", None
            wanted = None if scalars is True else scalars.get(label, ()) if scalars else ()
            for key, child in value.items():
                if isinstance(child, dict):
                    stack.append((child, me, key, -1))
                elif isinstance(child, list) and (any(isinstance(x, (dict, list)) for x in child) or all(x is None for x in child)):
                    stack.extend((x, me, key, i) for i, x in enumerate(child))
                elif wanted is None or key in wanted:
                    values = isinstance(child, list)
                    yield scalar, me, key, -1, "list" if values else "null" if child is None else "scalar", json.dumps(child) if values else _scalar_text(child)
                    scalar += 2
        elif isinstance(value, list):
            me, number = number, number + 2
            if shown:
                yield me, parent, label, ordinal, "array", None
            stack.extend((x, me, label, i) for i, x in enumerate(value))
        elif value is None:
            me, number = number, number + 2
            if shown:
                yield me, parent, label, ordinal, "null", None
        elif scalars is True:
            yield scalar, parent, label, ordinal, "scalar", _scalar_text(value)
            scalar += 2


def shred(df: DataFrame, key: str, text: str, scalars: bool | Mapping[str, Collection[str]] = True, objects: Collection[str] | None = None) -> DataFrame:
    """The edge table of ``df[text]``, hash-partitioned by document and cut from its lineage.

    ``scalars`` and ``objects`` limit it to the nodes that a query needs, as in ``walk``.
    A document's nodes stay in one partition, so every later join of levels
    runs without another exchange.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _ARROW]
            for doc, version, body in zip(*(c.to_pylist() for c in batch.columns)):
                root = _parse(body)
                if not isinstance(root, (dict, list)) or doc is None:
                    continue
                for row in walk(root, scalars, objects):
                    out[0].append(doc)
                    out[1].append(version)
                    for column, x in zip(out[2:], row):
                        column.append(x)
                if len(out[0]) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, _ARROW)], schema=_ARROW)
                    out = [[] for _ in _ARROW]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, _ARROW)], schema=_ARROW)

    rows = df.select(F.col(key).cast("bigint").alias("doc"), F.xxhash64(text).alias("version"), F.col(text).alias("body"))
    nodes = rows.mapInArrow(run, NODE_SCHEMA).repartition("doc")
    chosen = rows.groupBy("doc").agg(F.max(F.struct(F.length("body"), "version")).alias("x")).select("doc", F.col("x.version").alias("version"))
    once = nodes.join(chosen, ["doc", "version"], "left_semi").drop("version").dropDuplicates(["doc", "node"])
    return cut(once, keep_partitioning=True)


def entity(nodes: DataFrame, label: str | Sequence[str], fields: Sequence[str] = ()) -> DataFrame:
    """Object nodes under ``label`` with their scalar children ``fields`` pivoted into columns.

    Columns: doc, node, parent, label, ordinal and one string column per field.
    """
    labels = [label] if isinstance(label, str) else list(label)
    own = nodes.where((F.col("kind") == "object") & F.col("label").isin(labels)).select("doc", "node", "parent", "label", "ordinal")
    if not fields:
        return own
    leaf = nodes.where(F.col("kind").isin("scalar", "list") & F.col("label").isin(list(fields)) & (F.col("ordinal") < 0))
    wide = leaf.groupBy("doc", F.col("parent").alias("node")).agg(*[F.max(F.when(F.col("label") == f, F.col("scalar"))).alias(f"f_{f}") for f in fields])
    return own.join(wide, ["doc", "node"], "left").select("doc", "node", "parent", "label", "ordinal", *[F.col(f"f_{f}").alias(f) for f in fields])


def _as(df: DataFrame, name: str, **extra: Column) -> DataFrame:
    return df.select("doc", F.col("node").alias(f"{name}_node"), F.col("parent").alias(f"{name}_parent"), F.col("ordinal").alias(f"{name}_seq"), *[c.alias(k) for k, c in extra.items()])


def page_tables(nodes: DataFrame, fields: dict[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """Flat tables pages, blocks, children, lines and spans of shredded page trees, each with its parent's node.

    ``fields`` names the scalar columns wanted of each table.
    """
    want = fields or {}
    top = nodes.where(F.col("label") == ROOT)
    root = top.where(F.col("parent") == -1).select("doc", F.col("node").alias("root"), F.col("kind").alias("root_kind"))
    pages = entity(nodes, (*PAGE_KEYS, ROOT), want.get("pages", ())).join(root, "doc").where(
        (F.col("parent") == F.col("root")) & F.when(F.col("root_kind") == "array", F.col("label") == ROOT).otherwise(F.col("label") != ROOT) & (F.col("ordinal") >= 0)
    )
    pages = pages.drop("root", "root_kind")
    held = entity(nodes, LAYERS, want.get("blocks", want.get("children", ()))).where("ordinal >= 0")
    owner = pages.select("doc", F.col("node").alias("parent"))
    blocks = held.join(owner, ["doc", "parent"], "left_semi")
    inner = held.where("label = 'blocks'").join(blocks.select("doc", F.col("node").alias("parent")), ["doc", "parent"], "left_semi")
    lines = entity(nodes, "lines", want.get("lines", ())).where("ordinal >= 0")
    spans = entity(nodes, "spans", want.get("spans", ())).where("ordinal >= 0")
    return {"pages": pages, "blocks": blocks, "children": inner, "lines": lines, "spans": spans}


def span_places(nodes: DataFrame) -> DataFrame:
    """Each span object below a line of a block, or of a block's child, with the places of its ancestors."""
    t = page_tables(nodes)
    pages = _as(t["pages"], "page")
    blocks = _link(_as(t["blocks"], "block", layer=F.col("label")), "block", pages, "page")
    direct = blocks.withColumn("child_seq", F.lit(-1)).withColumn("owner_node", F.col("block_node"))
    child = _link(_as(t["children"], "child"), "child", blocks, "block").withColumn("owner_node", F.col("child_node"))
    keep = ["doc", "page_seq", "layer", "block_seq", "child_seq", "owner_node"]
    owners = direct.select(*keep).unionByName(child.select(*keep))
    lines = _as(t["lines"], "line").withColumnRenamed("line_parent", "owner_node").join(owners, ["doc", "owner_node"])
    spans = _as(t["spans"], "span").withColumnRenamed("span_parent", "line_node").join(lines, ["doc", "line_node"])
    return spans.select(F.col("doc").alias("parse_id"), "page_seq", "layer", "block_seq", "child_seq", "line_seq", "span_seq")


def _link(child: DataFrame, name: str, parent: DataFrame, parent_name: str) -> DataFrame:
    return child.withColumnRenamed(f"{name}_parent", f"{parent_name}_node").join(parent, ["doc", f"{parent_name}_node"])
