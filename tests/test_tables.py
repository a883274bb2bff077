import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.operators import grid as gr
from folioforge.operators import records as rec
from folioforge.operators import tables as tb


def table(*rows, tag="td"):
    return "<table>" + "".join("<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in r) + "</tr>" for r in rows) + "</table>"


def test_spans_are_written_out():
    html = '<table><tr><td rowspan="2">a</td><td colspan="2">b</td></tr><tr><td>c</td><td>d<br>e</td></tr><tr><td colspan="0">f</td></tr></table>'
    assert gr.spanned_grid(html) == [["a", "b", "b"], ["a", "c", "d\ne"], ["f", "", ""]]
    assert gr.expand_rows(html) == '<table><tr><td>a</td><td colspan="2">b</td></tr><tr><td>a</td><td>c</td><td>d<br>e</td></tr><tr><td>f</td><td></td><td></td></tr></table>'


def test_section_row_stays_one_cell():
    assert gr.expand_columns('<table><tr><td colspan="2">S</td></tr><tr><td>a</td><td>b</td></tr></table>') == '<table><tr><td colspan="2">S</td></tr><tr><td>a</td><td>b</td></tr></table>'


@pytest.mark.parametrize("html", [None, "", "no table", "<table></table>", "<table><tr><td>open"])
def test_odd_tables_do_not_fail(html):
    assert isinstance(gr.spanned_grid(html), list)
    gr.expand_rows(html), gr.expand_columns(html), gr.split_merged(html)


@given(st.lists(st.lists(st.tuples(st.text("ab<&", max_size=3), st.integers(1, 3), st.integers(1, 3)), min_size=1, max_size=4), min_size=1, max_size=5))
def test_grid_is_rectangular_and_stable(rows):
    first = gr.spanned_grid(gr.write_table(rows))
    assert len({len(r) for r in first}) <= 1
    assert gr.spanned_grid(gr.write_table([[(c, 1, 1) for c in r] for r in first])) == first


def test_merged_table_is_cut():
    head = "<tr><td>Pin No.</td><td>Pin Name</td></tr>"
    html = f'<table><tr><td colspan="2">One</td></tr>{head}<tr><td>1</td><td>A</td></tr><tr><td colspan="2">Two</td></tr>{head}<tr><td>2</td><td>B</td></tr></table>'
    parts = gr.split_merged(html)
    assert len(parts) == 2 and "Two" in parts[1] and "One" in parts[0]
    crossing = html.replace("<tr><td>1</td><td>A</td></tr>", '<tr><td rowspan="3">1</td><td>A</td></tr>')
    assert len(gr.split_merged(crossing)) == 1
    assert gr.split_merged(table(["Pin", "Name"], ["1", "A"])) == [table(["Pin", "Name"], ["1", "A"])]


def test_jvm_grid_is_the_kernel(spark):
    rows = [(table(["Pin", "Name"], ["1", "A &amp; B"], ["2"]),), ('<table><tr><th rowspan="2">x</th><th>y</th></tr><tr><td>z</td></tr></table>',), (None,), ("",)]
    df = spark.createDataFrame(rows, "html string").select("html", gr.grid(F.col("html")).alias("g"))
    for r in df.collect():
        assert (r.g or []) == gr.spanned_grid(r.html)


@pytest.mark.parametrize(
    ("header", "field"),
    [("PIN NUMBERS", "pin_no"), ("Terminal Number (1)", "pin_no"), ("Ball", "pin_no"), ("Signal Name", "pin_name"), ("NAME", "pin_name"), ("I/O", "type"), ("Pin Type", "type"), ("Pin Description", None), ("Package", "package"), ("引脚编号", "pin_no"), ("", None)],
)
def test_header_roles(spark, header, field):
    assert spark.range(1).select(tb.header_role(F.lit(header))["field"].alias("f")).first().f == field


def decide(spark, *tables):
    df = spark.createDataFrame([(i, t, h) for i, (t, h) in enumerate(tables)], "table_id int, title string, html string")
    return {r.table_id: r.skip_reason for r in tb.decide(df.withColumn("grid", gr.grid(F.col("html")))).collect()}


def test_reasons(spark):
    got = decide(
        spark,
        ("", table(["Pin No.", "Pin Name"])), ("", table(["", "1", "2", "3", "4"], ["A", "", "", "", ""], ["B", "", "", "", ""], ["C", "", "", "", ""])),
        ("", table(["Orderable Device", "Status", "Package Type"], ["x", "y", "z"])), ("", table(["No.", "Pin Name", "Type", "No.", "Pin Name", "Type"], ["1", "A", "I", "2", "B", "I"])),
        ("Connections for unused pins", table(["Pin No.", "Pin Name"], ["1", "A"])), ("", table(["Pin Name", "Type"], ["A", "I"])), ("", table(["Pin No.", "Pin Name"], ["1", "A"])), (None, None), ("", table(["x"], ["y"])),
    )
    assert got == {0: "too_few_rows", 1: "pinout_matrix", 2: "ordering_table", 3: "repeated_horizontal_blocks", 4: "unused_pins", 5: "semantic_missing_pin_no_column", 6: None, 7: "too_few_rows", 8: "no_header"}


def test_extraction(spark):
    html = '<table><tr><td>PIN NUMBERS</td><td>Pin Name</td><td>Description</td></tr><tr><td colspan="3">Power</td></tr><tr><td>A1, A2</td><td>SIG_A<br>SIG_B</td><td>both</td></tr><tr><td></td><td>NC_X</td><td>d</td></tr><tr><td></td><td></td><td></td></tr><tr><td>B1</td><td></td><td>z</td></tr></table>'
    df = spark.createDataFrame([(1, "d", 0, "", html)], "table_id bigint, document_name string, page_idx int, title string, html string")
    got = [(r.group, r.pin_no, r.pin_name, r.type, r.description) for r in rec.extract(df).orderBy("row_idx", "pin_seq").collect()]
    assert got == [("Power", "A1", "SIG_A", None, "both"), ("Power", "A2", "SIG_B", None, "both"), ("Power", "", "NC_X", None, "d"), ("Power", "B1", "Reserved", None, "z")]


def test_dedupe_keeps_the_first_and_joins_texts(spark):
    rows = [("p", "A1", "VDD", 1, "P", "Core power"), ("p", "A1", "VDD", 2, "I", "Core power"), ("p", "A1", "VDD", 3, None, "Connect to 1.2 V"), ("q", "A1", "VDD", 4, "P", ""), ("p", "A1", "VDD", 5, None, None)]
    df = spark.createDataFrame(rows, "pkg string, pin_no string, pin_name string, seq int, type string, description string")
    out = rec.ordered_dedupe(df, ["pkg", "pin_no", "pin_name"], ["seq"], "description")
    assert sorted(tuple(r) for r in out.select("pkg", "seq", "type", "description").collect()) == [("p", 1, "P", "Core power\nConnect to 1.2 V"), ("q", 4, "P", "")]
    again = rec.ordered_dedupe(out.select(*df.columns), ["pkg", "pin_no", "pin_name"], ["seq"], "description")
    assert sorted(map(tuple, again.select(*df.columns).collect())) == sorted(map(tuple, out.select(*df.columns).collect()))
    shuffled = rec.ordered_dedupe(df.repartition(4, "seq"), ["pkg", "pin_no", "pin_name"], ["seq"], "description")
    assert sorted(map(tuple, shuffled.select(*df.columns).collect())) == sorted(map(tuple, out.select(*df.columns).collect()))


@pytest.mark.parametrize(("n", "size", "some"), [(30, 30, {0, 29}), (100, 20, {0, 7, 48, 51, 92, 99}), (880, 20, {0, 5, 874, 879})])
def test_samples(spark, n, size, some):
    picked = {r.id for r in spark.range(n).where(tb.sample_rows(F.lit(n), F.col("id"))).collect()}
    assert len(picked) == size and some <= picked


def test_whole_queries_cover_spanned_tables(spark):
    from folioforge.plans import table_queries as tq

    spanned = (
        '<table><tr><td rowspan="2">Pin No.</td><td colspan="2">Pin Name</td></tr><tr><td>A</td><td>B</td></tr>'
        '<tr><td colspan="3">Power</td></tr><tr><td>1</td><td>VDD</td><td>VSS</td></tr></table>'
    )
    tables = {1: spanned, 2: table(("Pin", "Type"), ("1", "I"), ("Same", "Same"))}
    df = spark.createDataFrame([(k, None, h) for k, h in tables.items()] + [(3, None, None), (4, None, "")], "table_id bigint, loaded_at timestamp, html string")
    grids = {k: gr.spanned_grid(h) for k, h in tables.items()}
    cells = {(r.table_id, r.row_idx, r.col_idx, r.text) for r in tq.whole_grid(df).collect()}
    assert cells == {(k, y, x, c) for k, g in grids.items() for y, row in enumerate(g) for x, c in enumerate(row)}
    sections = {(r.table_id, r.row_idx, r.section) for r in tq.whole_section_rows(df).collect()}
    assert sections == {(k, y, row[0]) for k, g in grids.items() for y, row in enumerate(g) if len(row) > 1 and len(set(row) - {""}) == 1}
    headers = {(r.table_id, r.col_idx): r.header for r in tq.whole_combined_headers(df).collect()}
    assert [headers[1, i] for i in range(3)] == ["Pin No.", "Pin Name A", "Pin Name B"] and headers[2, 0] == "Pin 1"
    roles = {r.header: (r.field, r.n) for r in tq.whole_header_roles(df).collect()}
    assert roles["pin no."] == ("pin_no", 1) and roles["pin name"] == ("pin_name", 2) and roles["pin"] == ("pin_no", 1)
    assert {(r.table_id, r.header_idx) for r in tq.whole_header_rows(df).collect()} == {(1, 0), (2, 0)}


def test_a_row_span_reaches_as_far_as_the_table():
    html = f'<table><tr><td rowspan="1500">B</td><td>0</td></tr>{"".join(f"<tr><td>{i}</td></tr>" for i in range(1, 1500))}</table>'
    assert gr.spanned_grid(html) == [["B", str(i)] for i in range(1500)]


def special_row(spark, title, header, rows):
    from pyspark.sql import functions as F

    from folioforge.operators import special as sp

    df = spark.createDataFrame([(title, header, rows)], "title string, header array<string>, rows array<array<string>>")
    args = F.col("title"), F.col("header"), F.col("rows")
    return tuple(df.select(sp.special_kind(*args), sp.reserved_rows(*args)).first())


def test_special_tables(spark):
    modes = ["Pin No.", "MII MAC", "MII PHY", "", "RMII MAC", "RMII PHY", "RGMII"]
    assert special_row(spark, "Connections for Unused Pins", ["Pin", "Name"], []) == ("unused_pins", None)
    assert special_row(spark, None, modes, [["1"] * 6]) == ("interface_modes", None)
    assert special_row(spark, None, [*modes, "Type"], [["1"] * 6]) == (None, None)
    bits = ["BIT", "BIT NAME", "DESCRIPTION / FUNCTION", "PIN AFFECTED [1]"]
    assert special_row(spark, "Table 7. Word 3", bits, [["", "x"]]) == ("control_word", None)
    assert special_row(spark, "Table 7. Word 3", [*bits, "Pin No."], [["", "x"]]) == (None, None)
    assert special_row(spark, "Table 7. Word 3", bits, [["", " "]]) == (None, None)
    head = ["Balls", "Connection Requirements"]
    rows = [["A1, B2", "Reserved. Must be left unconnected"], ["", ""], ["C3", "Ball does not exist on the package"], ["D4/D5", "NC"]]
    assert special_row(spark, "Reserved Balls", head, rows) == ("reserved_pins", [0, 3])
    assert special_row(spark, "Reserved Balls", head, [*rows, ["E5", "Tie to ground"]]) == (None, None)
    assert special_row(spark, "Reserved Balls", [*head, "Ball Name"], rows) == (None, None)
    assert special_row(spark, None, None, None) == (None, None)


def test_header_paths_take_over_from_the_column_beside():
    from folioforge.operators.special import paths

    grid = [["Pin", "PIN", "", "Type"], ["Name", "RGE", "RGE", ""], ["A", "1", "2", "I"]]
    assert paths(grid, 1) == [["Pin", "Name"], ["PIN", "RGE"], ["PIN", "RGE"], ["Type"]]
    assert paths([["a", "", "b"], ["x", "x", "x"]], 1) == [["a", "x"], ["x"], ["b", "x"]]  # both sides, and they differ
    assert paths([], 0) == [] and paths([["Pin", "pin"], ["pin", None]], 1) == [["Pin"], ["pin"]]


def test_matrix_and_ordering_tables(spark):
    from pyspark.sql import functions as F

    from folioforge.operators import tables as tb

    grid = [["", "1", "2", "3", "4"], *[[x, "p", "q", "r", "s"] for x in "ABC"]]
    named = [["Pin No.", "1", "2", "3", "4"], *grid[1:]]
    df = spark.createDataFrame([(1, grid, None), (2, named, None), (3, named, "Pin Assignment"), (4, None, None), (5, [["Orderable Device", "Eco Plan"]], None), (6, [["Orderable Device", "Status"]], None)], "k int, g array<array<string>>, t string")
    got = {r.k: (r.m, r.o) for r in df.select("k", F.coalesce(tb.is_matrix(F.col("g"), F.col("t")), F.lit(False)).alias("m"), tb.is_ordering(F.get("g", F.lit(0))).alias("o")).collect()}
    assert got == {1: (True, False), 2: (False, False), 3: (True, False), 4: (False, False), 5: (False, True), 6: (False, False)}


def test_continued_titles(spark):
    from pyspark.sql import functions as F

    from folioforge.operators.special import is_continued

    cases = {"Table 2 (continued)": True, "Table 2（续）": True, "续表": True, "Discontinued": False, "Pins continued": True, "(continued) Pins": True, "continued pins": False, "": False, None: False}
    rows = spark.createDataFrame([(k,) for k in cases], "c string").select("c", is_continued(F.col("c")).alias("x")).collect()
    assert {r.c: r.x for r in rows} == cases
