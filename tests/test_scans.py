"""Windows, joins, layout, streams, sources and plans."""

import json
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.operators import joins as jn
from folioforge.operators import layout as ly
from folioforge.operators import render as rd
from folioforge.operators import windows as wn
from folioforge.sources import documents as src
from folioforge.sources import providers, sinks
from folioforge.streaming import windows as st


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_intervals(spark):
    rows = [("a", 1, 3), ("a", 3, 5), ("a", 9, 9), ("b", 0, 1)]
    df = spark.createDataFrame(rows, "k string, lo int, hi int")
    assert sorted(map(tuple, wn.merge_intervals(df, ["k"], "lo", "hi").collect())) == [("a", 1, 5), ("a", 9, 9), ("b", 0, 1)]
    masks = spark.createDataFrame([("a", 2, 2), ("a", 5, 20)], "k string, lo int, hi int")
    whole = spark.createDataFrame([("a", 0, 9), ("b", 0, 1)], "k string, lo int, hi int")
    assert sorted(map(tuple, wn.subtract_intervals(whole, masks, ["k"], "lo", "hi").collect())) == [("a", 0, 1), ("a", 3, 4), ("b", 0, 1)]


def test_paragraphs(spark):
    rows = [(1, 0, "The ampli-"), (1, 1, "fier is"), (1, 2, "good."), (1, 3, "Next one"), (1, 4, "2 more")]
    out = wn.merge_paragraphs(spark.createDataFrame(rows, "p int, n int, text string"), ["p"], ["n"])
    assert [r.text for r in out.orderBy("paragraph").collect()] == ["The amplifier is good.", "Next one", "2 more"]


def test_notes(spark):
    rows = [(0, 0, "text", "NOTE\nfirst", 100.0), (0, 1, "text", "second", 90.0), (0, 2, "footer", "x", 0.0), (0, 3, "title", "Head", 100.0), (0, 4, "text", "no", 100.0), (1, 5, "text", "注\nz", 100.0), (1, 6, "text", "left", 10.0), (2, 7, "text", "Note", 100.0)]
    df = spark.createDataFrame([("d", *r) for r in rows], "d string, page_idx int, n int, type string, content string, x0 double")
    assert wn.notes_map(wn.notes(df, ["d"], ["n"]), ["d"]).first().notes == {"note1": "first\nsecond", "note2": "z"}


def test_page_windows_number_everything_once(spark):
    df = wn.page_window(spark.range(1000).repartition(7), ["id"], 64)
    assert {(r.id, r.window_no) for r in df.collect()} == {(i, i // 64) for i in range(1000)}


def test_overlap_join_is_the_nested_loop(spark):
    rng = random.Random(1)
    box = lambda: (lambda x, y: [x, y, x + rng.uniform(1, 300), y + rng.uniform(1, 300)])(rng.uniform(0, 500), rng.uniform(-50, 500))
    a, b = [(1, i, box()) for i in range(60)], [(1, i, box()) for i in range(60)]
    left, right = spark.createDataFrame(a, "p int, i int, x array<double>"), spark.createDataFrame(b, "p int, j int, y array<double>")
    joined = jn.overlap_join(left, right, ["p"], "x", "y")
    want = {(i, j) for _, i, p in a for _, j, q in b if min(p[2], q[2]) > max(p[0], q[0]) and min(p[3], q[3]) > max(p[1], q[1])}
    rows = [(r.i, r.j) for r in joined.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert "CartesianProduct" not in plan(joined) and "NestedLoop" not in plan(joined)


def test_contained_boxes(spark):
    df = spark.createDataFrame([(1, 1, [0.0, 0.0, 9.0, 9.0]), (1, 2, [1.0, 1.0, 2.0, 2.0]), (1, 3, [0.0, 0.0, 9.0, 9.0])], "p int, k int, b array<double>")
    assert sorted(r.k for r in jn.contained(df, ["p"], "k", "b").collect()) == [2, 3]


def test_prefixes(spark):
    df = spark.createDataFrame([("CC430F5147X",), ("ZZZ",), ("CC",), (None,)], "v string")
    names = spark.createDataFrame([("CC430",), ("CC430F514",), ("XX",)], "n string")
    assert {r.v: r.n for r in jn.longest_prefix(df, names, "v", "n").collect()} == {"CC430F5147X": "CC430F514", "ZZZ": None, "CC": None, None: None}
    assert [tuple(r) for r in jn.wildcard(spark.createDataFrame([("CC430F5147",)], "v string"), spark.createDataFrame([("cc430f514x",), ("ccx",)], "f string"), "v", "f").select("v", "f").collect()] == [("CC430F5147", "cc430f514x")]


def test_alignment():
    a = ["alpha beta gamma delta", "epsilon zeta eta theta"]
    assert jn.align(a, a) == [0, 1]
    assert jn.align(a, ["alpha beta", " gamma delta", "epsilon zeta eta theta"]) == [0, 0, 1]
    assert jn.align(["alpha beta", " gamma delta", "epsilon zeta eta theta"], a) == [0, 2]
    assert jn.align([], ["x"]) == [-1] and jn.align(["x"], []) == []


def test_reading_order_of_columns():
    boxes = np.array([[0, 0, 200, 10], [0, 20, 90, 30], [110, 20, 200, 30], [0, 40, 90, 50], [110, 40, 200, 50]], float)
    mixed = [3, 0, 4, 1, 2]
    order = ly.reading_order(boxes[mixed])
    assert [mixed[i] for i in order][0] == 0 and sorted(order) == [0, 1, 2, 3, 4]
    assert ly.reading_order(np.zeros((0, 4))) == []


def test_regions():
    cells = {(0, 0), (0, 1), (1, 0), (5, 5), (5, 7)}
    assert sorted(map(len, ly.regions(cells))) == [1, 1, 3] and sorted(map(len, ly.regions(cells, 1))) == [2, 3]


def test_furniture(spark):
    size, rows = [600.0, 800.0], []
    for p in range(3):
        rows += [(p * 10, "d", p, size, "text", "Acme Rev. A", [50.0, 20.0, 200.0, 30.0]), (p * 10 + 1, "d", p, size, "text", "body", [50.0, 300.0, 200.0, 310.0]), (p * 10 + 2, "d", p, size, "text", f"Page {p} of 3", [50.0, 780.0, 200.0, 790.0])]
    rows += [(40, "d", 0, size, "footer", "x", [0.0, 0.0, 1.0, 1.0]), (41, "d", 0, size, "text", " ", [0.0, 300.0, 9.0, 310.0]), (42, "e", 0, size, "text", "once", [50.0, 20.0, 200.0, 30.0]), (43, "e", 0, size, "image", None, [50.0, 20.0, 200.0, 30.0])]
    df = spark.createDataFrame(rows, "id int, document_name string, page_idx int, page_size array<double>, block_type string, content string, bbox array<double>")
    got = {r.id: r.discard_reason for r in ly.discard_reasons(df).collect()}
    assert [got[i] for i in (0, 1, 2, 40, 41, 42, 43)] == ["repeated_margin_text", None, "page_number", "type", "empty", None, None]


def test_markdown(spark):
    rows = [("d", 0, 0, 0, "title", "Head", None, None), ("d", 0, 1, 0, "text", "ampli-", None, None), ("d", 0, 1, 1, "text", "fier", None, None), ("d", 0, 2, 0, "table_body", None, "<table></table>", None), ("d", 0, 3, 0, "image_body", None, None, "i.png"), ("d", 0, 4, 0, "text", "", None, None)]
    df = spark.createDataFrame([(*r, [0.0, 0.0, 61.2, 79.2], [612.0, 792.0]) for r in rows], "document_name string, page_idx int, block_seq int, line_seq int, block_type string, content string, html string, image_path string, bbox array<double>, page_size array<double>")
    blocks = rd.block_texts(df, ["document_name", "page_idx"], ["line_seq"])
    assert rd.markdown(blocks, ["document_name"], ["page_idx", "block_seq"]).first().markdown == "# Head\n\namplifier\n\n<table></table>\n\n![](i.png)"
    assert {tuple(r.bbox) for r in rd.content_list(blocks).collect()} == {(0, 0, 100, 100)}


def test_stream_equals_batch(spark, tmp_path):
    rng, start = random.Random(2), datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=rng.randrange(600)), rng.choice("ab")) for i in range(300)]
    df = spark.createDataFrame(rows, "event_id int, ts timestamp, event_type string")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = st.read_stream(spark, str(tmp_path / "in"), "*.parquet", df)
    got = {(r.start, r.event_type): r.n for r in st.run_once(st.tumbling(stream, "ts", "1 hour", "1 day", "event_type"), "tumbled").collect()}
    want = {}
    for _, t, k in rows:
        key = (t.replace(minute=0), k)
        want[key] = want.get(key, 0) + 1
    assert got == want


def test_documents_complete_once(spark, tmp_path):
    for i, part in enumerate([[("d", 0, 2), ("e", 0, 3)], [("d", 1, 2), ("d", 1, 2)], [("e", 1, 3), ("d", 0, 2)]]):
        spark.createDataFrame(part, "document_name string, page_idx int, page_count int").coalesce(1).write.parquet(str(tmp_path / "pages" / str(i)))
    like = spark.read.parquet(str(tmp_path / "pages" / "0"))
    stream = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "pages"))
    assert [tuple(r) for r in st.run_once(st.complete_documents(stream), "completed", "append").collect()] == [("d", 2)]


def test_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "b.docx").write_bytes(b"PK\x03\x04 x")
    (tmp_path / "c.txt").write_bytes(b"no")
    assert {(r.stem, r.suffix, r.kind) for r in src.read_files(spark, str(tmp_path)).collect()} == {("a", "pdf", "pdf"), ("b", "docx", "zip")}
    (tmp_path / "x.json").write_text(json.dumps({"document_name": "x", "markdown_file": "x.md", "markdown": "<TABLE>"}))
    (tmp_path / "y.json").write_text(json.dumps({"document_name": "y", "markdown": "no"}))
    assert [r.document_name for r in src.read_markdown_json(spark, str(tmp_path / "*.json")).collect()] == ["x"]
    assert {r.document_name for r in src.read_middle_json(spark, str(tmp_path / "*.json")).collect()} == {"x", "y"}
    sinks.write_json(spark.createDataFrame([("d", None, 1)], "doc string, a string, b int"), str(tmp_path / "out"), "doc")
    assert spark.read.json(str(tmp_path / "out")).first().b == 1


def test_provider_contract(spark):
    class Good:
        table = "formulas"

        def provide(self, inputs):
            return inputs.select(F.lit("d").alias("document_name"), F.lit(0).alias("page_idx"), F.array(F.lit(1.0)).alias("bbox"), F.lit("x").alias("latex"))

    class Bad(Good):
        table = "cells"

    assert providers.checked(Good(), spark.range(1)).count() == 1
    with pytest.raises(ValueError, match="cells"):
        providers.checked(Bad(), spark.range(1))


def test_whole_queries_leave_no_row_out(spark):
    from folioforge.plans import page_queries as pq
    from folioforge.plans import window_queries as wq

    lines = [(0, 0, "The ampli-"), (0, 1, "fier is on."), (1, 0, "输出电压"), (1, 1, "稳定"), (2, 0, "plain"), (2, 1, "text")]
    rows = [(i, "d", 0, b, n, 0, "text", "text", t, None, None, None, None, None) for i, (b, n, t) in enumerate(lines)]
    schema = "span_id bigint, document_name string, page_idx int, block_seq int, line_seq int, span_seq int, block_type string, type string, content string, loaded_at timestamp, html string, image_path string, bbox array<double>, page_size array<double>"
    texts = {r.block_seq: r.text for r in pq.whole_block_texts(spark.createDataFrame(rows, schema)).collect()}
    assert texts == {0: "The amplifier is on.", 1: "输出电压稳定", 2: "plain text"}
    names = {k: n for k, n in zip(range(1, 31), ["green metal", "green mint", "grey lace"] * 10)}
    got = {r.p_partkey: r.name for r in wq.whole_longest_prefix(spark.createDataFrame(list(names.items()), "p_partkey bigint, p_name string")).collect()}
    known = {n[: 4 + k % 5] for k, n in names.items()}
    assert got == {k: max((x for x in known if n.startswith(x)), key=len) for k, n in names.items()}


def test_every_table_is_split(spark):
    from folioforge.operators import grid as gr
    from folioforge.plans import table_queries as tq

    head, row = "<tr><td>Pin No.</td><td>Pin Name</td></tr>", "<tr><td>1</td><td>A</td></tr>"
    merged = f"<table>{head}{row * 2}<tr><td colspan='2'>Two</td></tr>{head}{row}</table>"
    df = spark.createDataFrame([(1, None, merged), (2, None, f"<table>{head}{row}</table>"), (3, None, None)], "table_id bigint, loaded_at timestamp, html string")
    got = {(r.table_id, r.part, r.html) for r in tq.whole_split_merged(df).collect()}
    assert got == {(k, i, h) for k, t in ((1, merged), (2, f"<table>{head}{row}</table>")) for i, h in enumerate(gr.split_merged(t))} and len(got) == 3


def test_blocks_of_pages(spark):
    from pyspark.sql import functions as F

    from folioforge.operators import blocks as bl

    texts = [(1, "a\n| H1 | H2 |\n|---|:-:|\n| 1 | x |\r\n| 2 |\nb\n| only |\n\n|N|\n|v|w|"), (2, None), (3, ""), (4, "| a | b")]
    got = {(r.k, r.line_idx, r.col_idx, r.header): r.column_values for r in bl.pipe_tables(spark.createDataFrame(texts, "k int, t string"), "k", "t").collect()}
    assert got == {(1, 1, 0, "H1"): ["1", "2"], (1, 1, 1, "H2"): ["x", ""], (1, 8, 0, "N"): ["v"]}
    rows = [("d", 0, 1, "text", "Table 1. A"), ("d", 0, 2, "table", None), ("d", 0, 3, "text", "Figure 2 x"), ("d", 0, 4, "table", None), ("d", 0, 5, "table", None), (None, None, 1, "table", None)]
    df = spark.createDataFrame(rows, "doc string, page int, seq int, kind string, text string")
    found = bl.titles_since(df, ["doc", "page"], ["seq"], F.col("kind") == "table", {"title": bl.TABLE_TITLE, "figure": bl.FIGURE_TITLE}, "text").where("kind = 'table'")
    assert sorted((r.doc or "", r.seq, r.title, r.figure) for r in found.collect()) == [("", 1, None, None), ("d", 2, "Table 1. A", None), ("d", 4, None, "Figure 2 x"), ("d", 5, None, None)]
    lists = spark.createDataFrame([("d", i, k, t) for i, (k, t) in enumerate([("list", "a"), ("list", "b"), ("text", "c"), ("list", "d"), (None, "e"), (None, "f")])], "doc string, seq int, kind string, text string")
    merged = bl.merge_adjacent(lists, ["doc"], ["seq"], "kind", "text", "seq").orderBy("run").collect()
    assert [(r.run, r.kind, r.n, r.text) for r in merged] == [(0, "list", 2, "a\nb"), (1, "text", 1, "c"), (2, "list", 1, "d"), (3, None, 1, "e"), (4, None, 1, "f")]
    slots = spark.createDataFrame([(1, 0, "A", 1, 1), (1, 0, "B", 2, 2), (2, 0, "A", 1, 3), (2, 1, "A", 1, 4), (3, 0, " ", 1, 5), (4, 0, None, 1, 6)], "table_id int, local_slot int, pkg string, assigned_at int, assignment_id int")
    assert {tuple(r) for r in bl.single_slots(slots).collect()} == {(1, "B", "single_slot"), (2, None, "several_slots")}
    assert bl.pipe_tables(spark.createDataFrame([], "k int, t string"), "k", "t").count() == 0
