"""Queries of grids, table decisions and records, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators import blocks as bl
from folioforge.operators import grid as gr
from folioforge.operators import records as rec
from folioforge.operators import special as sp
from folioforge.operators import tables as tb
from folioforge.plans.registry import Registry

R = Registry()
_CELL = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(c, '<br\\s*/?>', ' ', 'gi'), '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g'))"
_ROWS = "list_transform(regexp_extract_all(html, '(?is)<tr[^>]*>(.*?)</tr>', 1), lambda r: list_transform(regexp_extract_all(r, '(?is)<t[dh][^>]*>(.*?)</t[dh]>', 1), lambda c: " + _CELL + "))"
_GRID = f"SELECT table_id, loaded_at, document_name, page_idx, title, {_ROWS} AS g, html FROM table_candidates WHERE html IS NOT NULL"


def _flat(tables: DataFrame) -> DataFrame:
    """All tables with their rough grid, in which cells stand once, whatever they span."""
    return tables.where("html is not null").select("*", F.explode(F.array(gr.rough_grid(F.col("html")))).alias("grid"))


def _whole(tables: DataFrame) -> DataFrame:
    """All tables that have a row, with spans written out in their grid."""
    return gr.with_grid(tables, "html").where(F.size("grid") > 0)


@R.add("prj05_rough_grid", "table_candidates", sql=f"""
SELECT table_id, loaded_at, (row_idx - 1)::INT AS row_idx, (col_idx - 1)::INT AS col_idx, row[col_idx] AS text FROM (
 SELECT *, unnest(range(1, len(row) + 1)) AS col_idx FROM (SELECT table_id, loaded_at, row_idx, g[row_idx] AS row FROM (SELECT *, unnest(range(1, len(g) + 1)) AS row_idx FROM ({_GRID}))))""")
def rough_grid(tables: DataFrame) -> DataFrame:
    """Cells of all tables as they stand in the rows, in long form."""
    rows = _flat(tables).select("table_id", "loaded_at", F.posexplode("grid").alias("row_idx", "row"))
    return rows.select("table_id", "loaded_at", "row_idx", F.posexplode("row").alias("col_idx", "text"))


@R.add("prj05_whole_grid", "table_candidates")
def whole_grid(tables: DataFrame) -> DataFrame:
    """Cells of all tables, in long form."""
    return gr.cells(tables, ["table_id", "loaded_at"], "html")


@R.add("prj07_spanned_grid", "part", sql="""
SELECT p_brand, (row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1)::INT AS row_idx, p_brand || '|' || p_partkey || '|' || p_name || '|' || p_name AS row FROM part""")
def spanned_grid(part: DataFrame) -> DataFrame:
    """A brand cell over all rows of its parts and a name over two columns, parsed back to full rows."""
    n = F.count("*").over(Window.partitionBy("p_brand"))
    first = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) == 1
    row = F.concat(F.lit("<tr>"), F.when(first, F.concat(F.lit('<td rowspan="'), n, F.lit('">'), "p_brand", F.lit("</td>"))).otherwise(""), F.lit("<td>"), "p_partkey", F.lit('</td><td colspan="2">'), "p_name", F.lit("</td></tr>"))
    made = part.select("p_brand", "p_partkey", row.alias("r")).groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "r"))).alias("rs"))
    html = made.select("p_brand", F.concat(F.lit("<table>"), F.array_join(F.transform("rs", lambda x: x["r"]), ""), F.lit("</table>")).alias("html"))
    return html.select("p_brand", F.posexplode(gr.grid(F.col("html"))).alias("row_idx", "row")).select("p_brand", "row_idx", F.array_join("row", "|").alias("row"))


@R.add("prj12_build_and_parse", "supplier", sql="SELECT s_nationkey, (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1)::INT AS row_idx, s_suppkey::VARCHAR AS s_suppkey, s_name FROM supplier")
def build_and_parse(supplier: DataFrame) -> DataFrame:
    """Tables built from relational rows and parsed back."""
    html = gr.build_html(supplier, ["s_nationkey"], ["s_suppkey"], ["s_suppkey", "s_name"])
    rows = html.select("s_nationkey", F.posexplode(gr.rough_grid(F.col("html"))).alias("row_idx", "row"))
    return rows.select("s_nationkey", "row_idx", F.col("row")[0].alias("s_suppkey"), F.col("row")[1].alias("s_name"))


@R.add("prj08_expand_rows", "table_candidates")
def expand_rows(tables: DataFrame) -> DataFrame:
    """Tables with row spans written out."""
    return tables.where(F.col("html").contains("rowspan")).select("table_id", "loaded_at", gr.expand_rows_udf("html").alias("html"))


@R.add("prj09_expand_columns", "table_candidates")
def expand_columns(tables: DataFrame) -> DataFrame:
    """Tables with column spans written out, section rows kept."""
    return tables.where(F.col("html").contains("colspan")).select("table_id", "loaded_at", gr.expand_columns_udf("html").alias("html"))


@R.add("win18_split_merged", "nation", "region", sql="SELECT n_regionkey AS key, (row_number() OVER (ORDER BY n_regionkey) - 1)::INT AS part, count(*) + 2 AS rows FROM nation GROUP BY n_regionkey")
def split_merged(nation: DataFrame, region: DataFrame) -> DataFrame:
    """One table of all regions, each under a section row and a repeated header, cut into its parts."""
    head = F.lit("<tr><td>Pin No.</td><td>Pin Name</td></tr>")
    body = nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("ns"))
    rows = F.array_join(F.transform("ns", lambda x: F.concat(F.lit("<tr><td>"), x["n_nationkey"], F.lit("</td><td>"), x["n_name"], F.lit("</td></tr>"))), "")
    one = body.select("n_regionkey", F.concat(F.lit('<tr><td colspan="2">Section '), "n_regionkey", F.lit("</td></tr>"), head, rows).alias("h"))
    whole = one.agg(F.array_sort(F.collect_list(F.struct("n_regionkey", "h"))).alias("all")).select(F.concat(F.lit("<table>"), F.array_join(F.transform("all", lambda x: x["h"]), ""), F.lit("</table>")).alias("html"))
    parts = whole.select(F.posexplode(gr.split_merged_udf("html")).alias("part", "html"))
    return parts.select(F.regexp_extract("html", r"Section (\d+)", 1).cast("int").alias("key"), "part", F.regexp_count("html", F.lit("<tr>")).cast("bigint").alias("rows"))


@R.add("win18_whole_split_merged", "table_candidates")
def whole_split_merged(tables: DataFrame) -> DataFrame:
    """The parts of every table."""
    return tables.select("table_id", "loaded_at", F.posexplode(gr.split_merged_udf("html")).alias("part", "html"))


_H = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace({}, '\\(\\s*\\d+(\\s*,\\s*\\d+)*\\s*\\)', '', 'g'))), '\\[[^\\]]*\\]', '', 'g'), '[$\\\\^†‡*]', '', 'g'), '[_/-]', ' ', 'g'), '\\s+', ' ', 'g'))"
_ROLE = "CASE " + " ".join(f"WHEN regexp_matches({{h}}, '{p}') THEN {{out{i}}}" for i, (p, _, _) in enumerate(tb.HEADER_RULES)) + " ELSE {none} END"
_FIELD = _ROLE.format(h="h", none="NULL", **{f"out{i}": f"'{f}'" if f else "NULL" for i, (_, f, _) in enumerate(tb.HEADER_RULES)})
_SCORE = _ROLE.format(h=_H.format("c"), none="0", **{f"out{i}": str(s) for i, (_, _, s) in enumerate(tb.HEADER_RULES)})


@R.add("stc01_header_roles", "table_candidates", sql=f"SELECT h AS header, {_FIELD} AS field, count(*) AS n FROM (SELECT {_H.format('unnest(g[1])')} AS h FROM ({_GRID})) GROUP BY ALL")
def header_roles(tables: DataFrame) -> DataFrame:
    """What the headers of all tables mean."""
    heads = _flat(tables).select(F.explode(F.get("grid", F.lit(0))).alias("c"))
    return heads.groupBy(tx.header_form(tx.strip_footnotes(F.col("c"))).alias("header"), tb.header_role(F.col("c"))["field"].alias("field")).agg(F.count("*").alias("n"))


@R.add("stc01_whole_header_roles", "table_candidates")
def whole_header_roles(tables: DataFrame) -> DataFrame:
    """What the headers of all tables mean, those with spans included."""
    heads = _whole(tables).select(F.explode(F.get("grid", F.lit(0))).alias("c"))
    return heads.groupBy(tx.header_form(tx.strip_footnotes(F.col("c"))).alias("header"), tb.header_role(F.col("c"))["field"].alias("field")).agg(F.count("*").alias("n"))


@R.add("agg12_header_row", "table_candidates", sql=f"""
SELECT table_id, loaded_at, max(s)::INT AS score, min_by(i, -s * 100 + i)::INT AS header_idx FROM (
 SELECT table_id, loaded_at, i - 1 AS i, list_sum(list_transform(g[i], lambda c: {_SCORE})) AS s FROM (SELECT *, unnest(range(1, least(len(g), 12) + 1)) AS i FROM ({_GRID}))) GROUP BY ALL""")
def header_rows(tables: DataFrame) -> DataFrame:
    """The header row of each table: the best of the first twelve, the earliest on ties."""
    best = tb.header_row(F.col("grid"))
    return _flat(tables).where(F.size("grid") > 0).select("table_id", "loaded_at", best["score"].alias("score"), (-best["minus"]).alias("header_idx"))


@R.add("agg12_whole_header_row", "table_candidates")
def whole_header_rows(tables: DataFrame) -> DataFrame:
    """The header row of each table, those with spans included."""
    best = tb.header_row(F.col("grid"))
    return _whole(tables).select("table_id", "loaded_at", best["score"].alias("score"), (-best["minus"]).alias("header_idx"))


@R.add("flt01_skip_reasons", "table_candidates")
def skip_reasons(tables: DataFrame) -> DataFrame:
    """How many tables are left out for which reason."""
    t = gr.with_grid(tables.select("table_id", "title", "html"), "html").drop("html")
    return tb.decide(t).groupBy(F.coalesce("skip_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("tables"))


@R.add("flt15_section_rows", "table_candidates", sql=f"""
SELECT table_id, loaded_at, (i - 1)::INT AS row_idx, v[1] AS section FROM (SELECT table_id, loaded_at, i, list_distinct(list_filter(g[i], lambda c: trim(c) <> '')) AS v, g[i] AS row FROM (SELECT *, unnest(range(1, len(g) + 1)) AS i FROM ({_GRID}))) WHERE len(v) = 1 AND len(row) > 1""")
def section_rows(tables: DataFrame) -> DataFrame:
    """Rows of several cells that hold one value."""
    rows = _flat(tables).select("table_id", "loaded_at", F.posexplode("grid").alias("row_idx", "row"))
    return rows.select("table_id", "loaded_at", "row_idx", tb.single_value_row(F.col("row")).alias("section")).where("section is not null")


@R.add("flt15_whole_section_rows", "table_candidates")
def whole_section_rows(tables: DataFrame) -> DataFrame:
    """Rows of several cells that hold one value, one cell over several columns included."""
    rows = _whole(tables).select("table_id", "loaded_at", F.posexplode("grid").alias("row_idx", "row"))
    return rows.select("table_id", "loaded_at", "row_idx", tb.single_value_row(F.col("row")).alias("section")).where("section is not null")


@R.add("prj13_combined_headers", "table_candidates", sql=f"""
SELECT table_id, loaded_at, (i - 1)::INT AS col_idx, CASE WHEN g[1][i] = '' THEN coalesce(g[2][i], '') WHEN coalesce(g[2][i], '') IN ('', g[1][i]) THEN g[1][i] ELSE g[1][i] || ' ' || g[2][i] END AS header FROM (SELECT *, unnest(range(1, len(g[1]) + 1)) AS i FROM ({_GRID}))""")
def combined_headers(tables: DataFrame) -> DataFrame:
    """Headers over the first two rows, equal parts once."""
    return _flat(tables).where(F.size("grid") > 0).select("table_id", "loaded_at", F.posexplode(tb.combined_headers(F.col("grid"), F.lit(1))).alias("col_idx", "header"))


@R.add("prj13_whole_combined_headers", "table_candidates")
def whole_combined_headers(tables: DataFrame) -> DataFrame:
    """Headers over the first two rows of all tables, equal parts once."""
    return _whole(tables).select("table_id", "loaded_at", F.posexplode(tb.combined_headers(F.col("grid"), F.lit(1))).alias("col_idx", "header"))


@R.add("prj30_row_sample", "orders", sql="""
SELECT o_orderkey FROM (SELECT o_orderkey, count(*) OVER w AS n, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders WINDOW w AS (PARTITION BY o_custkey))
WHERE n <= 30 OR (n <= 200 AND (i < 8 OR i >= n - 8 OR (i >= n // 2 - 2 AND i < n // 2 + 2))) OR (n > 200 AND (i < 6 OR i >= n - 6 OR list_contains(list_transform(range(8), lambda k: 6 + ((k * 2 + 1) * (n - 12)) // 16), i)))""")
def row_sample(orders: DataFrame) -> DataFrame:
    """The representative rows of every customer's orders."""
    w = Window.partitionBy("o_custkey")
    n, i = F.count("*").over(w), F.row_number().over(w.orderBy("o_orderkey")) - 1
    return orders.select("o_orderkey", n.alias("n"), i.alias("i")).where(tb.sample_rows(F.col("n"), F.col("i"))).select("o_orderkey")


_PINS = "(SELECT * FROM pins QUALIFY row_number() OVER (PARTITION BY pin_id ORDER BY loaded_at) = 1)"


def _once(pins: DataFrame) -> DataFrame:
    rest = [c for c in pins.columns if c not in ("pin_id", "loaded_at")]
    return pins.groupBy("pin_id").agg(F.min_by(F.struct("loaded_at", *rest), "loaded_at").alias("p")).select("pin_id", "p.*")


def _tables_once(tables: DataFrame, *columns: str) -> DataFrame:
    """Every table as it was delivered first, by one aggregation of the columns wanted."""
    return tables.groupBy("table_id").agg(F.min_by(F.struct(*columns), "loaded_at").alias("t")).select("table_id", "t.*")


@R.add("agg07_ordered_dedupe", "pins", sql=f"""
WITH p AS (SELECT document_name, pkg, pin_no, pin_name, pin_id, type, trim(description) AS d FROM {_PINS}),
f AS (SELECT document_name, pkg, pin_no, pin_name, d, min(pin_id) AS first FROM p WHERE d <> '' GROUP BY ALL),
t AS (SELECT document_name, pkg, pin_no, pin_name, string_agg(d, chr(10) ORDER BY first) AS description FROM f GROUP BY ALL)
SELECT k.document_name, k.pkg, k.pin_no, k.pin_name, k.pin_id, k.type, coalesce(t.description, '') AS description FROM (SELECT document_name, pkg, pin_no, pin_name, min(pin_id) AS pin_id, arg_min(struct_pack(t := type), pin_id).t AS type FROM p GROUP BY ALL) k
LEFT JOIN t ON k.document_name IS NOT DISTINCT FROM t.document_name AND k.pkg IS NOT DISTINCT FROM t.pkg AND k.pin_no IS NOT DISTINCT FROM t.pin_no AND k.pin_name IS NOT DISTINCT FROM t.pin_name""")
def ordered_dedupe(pins: DataFrame) -> DataFrame:
    """The first record of each package, number and name, with the descriptions of all."""
    cols = _once(pins).select("document_name", "pkg", "pin_no", "pin_name", "pin_id", "type", "description")
    return rec.ordered_dedupe(cols, ["document_name", "pkg", "pin_no", "pin_name"], ["pin_id"], "description")


@R.add("agg04_summary", "pins", sql="""
SELECT document_name, pkg, grouping(document_name, pkg)::INT AS level, count(*) AS pins, count(DISTINCT source_page) AS pages, min(source_page) AS first_page, max(source_page) AS last_page
FROM pins GROUP BY GROUPING SETS ((document_name, pkg), (document_name), ())""")
def summary(pins: DataFrame) -> DataFrame:
    """Pins and page ranges per package, document and in all."""
    return rec.summary(pins, "document_name", "pkg", "source_page")


@R.add("agg06_suffix_duplicates", "pins", sql=f"""
SELECT pin_id, CASE WHEN count(*) OVER (PARTITION BY document_name, pkg, pin_name) > 1 THEN pin_name || '_' || row_number() OVER (PARTITION BY document_name, pkg, pin_name ORDER BY pin_id) ELSE pin_name END AS pin_name FROM {_PINS}""")
def suffix_duplicates(pins: DataFrame) -> DataFrame:
    """Names that repeat within a package, numbered."""
    return rec.suffix_duplicates(_once(pins), ["document_name", "pkg"], "pin_name", ["pin_id"]).select("pin_id", "pin_name")


@R.add("agg08_merge_fields", "pins", sql="""
SELECT pin_id, loaded_at, CASE WHEN coalesce(trim(type), '') = '' THEN coalesce(group_name, '') WHEN coalesce(trim(group_name), '') IN ('', type) THEN type ELSE type || ' | ' || group_name END AS merged FROM pins""")
def merge_fields(pins: DataFrame) -> DataFrame:
    """Two columns with one meaning as one."""
    return pins.select("pin_id", "loaded_at", rec.merge_fields(F.array("type", "group_name")).alias("merged"))


@R.add("prj23_nested_result", "pins", sql=f"""
SELECT pkg_key, to_json(list(struct_pack("group" := g, pins := ps) ORDER BY first))::VARCHAR AS result FROM (
 SELECT document_name || '/' || pkg AS pkg_key, coalesce(group_name, '') AS g, min(pin_id) AS first, list(pin_id ORDER BY pin_id) AS ps FROM {_PINS} GROUP BY ALL) GROUP BY ALL""")
def nested_result(pins: DataFrame) -> DataFrame:
    """Packages with their groups and pins, as JSON."""
    p = _once(pins).select(F.concat("document_name", F.lit("/"), "pkg").alias("pkg_key"), F.coalesce("group_name", F.lit("")).alias("group"), "pin_id").where("pkg_key is not null")
    nested = rec.nested_result(p, "pkg_key", "group", ["pin_id"], ["pin_id"])
    slim = F.transform("group_list", lambda g: F.struct(g["group"].alias("group"), F.transform(g["pin_list"], lambda x: x["pin_id"]).alias("pins")))
    return nested.select("pkg_key", F.to_json(slim).alias("result"))


@R.add("stc14_extract_pins", "table_candidates", "package_assignments")
def extract_pins(tables: DataFrame, assignments: DataFrame) -> DataFrame:
    """The flagship: pin records of all tables with their package, deduplicated per document and package with merged descriptions.

    The package is that of the table's only slot; a table with several slots or none has a null one.
    """
    once = _tables_once(tables, "document_name", "page_idx", "title", "html")
    pins = rec.extract(once).join(bl.single_slots(assignments).select("table_id", "pkg"), "table_id", "left")
    return rec.ordered_dedupe(pins, ["document_name", "pkg", "pin_no", "pin_name"], ["table_id", "row_idx", "pin_seq"], "description")


@R.add("snk08_table_export", "table_candidates", sql="""
SELECT document_name, count(*) AS table_count, to_json(list(struct_pack(table_id := table_id, page_no := page_idx + 1, title := title) ORDER BY table_id))::VARCHAR AS table_list
FROM (SELECT * FROM table_candidates QUALIFY row_number() OVER (PARTITION BY table_id ORDER BY loaded_at) = 1) GROUP BY document_name""")
def table_export(tables: DataFrame) -> DataFrame:
    """Every document's tables as one JSON list with page numbers from one."""
    once = _tables_once(tables, "document_name", "page_idx", "title")
    item = F.struct("table_id", (F.col("page_idx") + 1).alias("page_no"), "title")
    return once.groupBy("document_name").agg(F.count("*").alias("table_count"), F.to_json(F.array_sort(F.collect_list(item)), {"ignoreNullFields": "false"}).alias("table_list"))


@R.add("agg09_best_column", "pins", sql="""
SELECT document_name, arg_max(c, n * 10 - i) AS best FROM (
 SELECT document_name, 'pin_no' AS c, 0 AS i, count(*) FILTER (coalesce(trim(pin_no), '') <> '') AS n FROM pins GROUP BY 1 UNION ALL SELECT document_name, 'type', 1, count(*) FILTER (coalesce(trim(type), '') <> '') FROM pins GROUP BY 1
 UNION ALL SELECT document_name, 'description', 2, count(*) FILTER (coalesce(trim(description), '') <> '') FROM pins GROUP BY 1) GROUP BY 1""")
def best_column(pins: DataFrame) -> DataFrame:
    """The most complete of three columns per document, the leftmost on ties."""
    names = ["pin_no", "type", "description"]
    n = [F.count_if(F.coalesce(F.trim(c), F.lit("")) != "").alias(c) for c in names]
    best = F.array_max(F.array(*[F.struct(F.col(c).alias("n"), F.lit(-i).alias("i"), F.lit(c).alias("c")) for i, c in enumerate(names)]))
    return pins.groupBy("document_name").agg(*n).select("document_name", best["c"].alias("best"))


@R.add("agg10_column_kind", "pin_rows", sql="""
SELECT table_id, CASE WHEN h >= greatest(2, n // 3) THEN 'pin' WHEN t >= greatest(2, n // 3) THEN 'type' ELSE 'other' END AS kind FROM (
 SELECT table_id, count(*) AS n, count(*) FILTER (regexp_matches(trim(v), '^[A-Z]{0,3}[0-9]{1,4}$')) AS h, count(*) FILTER (lower(trim(v)) IN ('i', 'o', 'i/o', 'p', 'g')) AS t
 FROM (SELECT table_id, pin_no AS v, row_number() OVER (PARTITION BY table_id ORDER BY row_id, loaded_at) AS i FROM pin_rows WHERE coalesce(trim(pin_no), '') <> '') WHERE i <= 20 GROUP BY 1)""")
def column_kind(rows: DataFrame) -> DataFrame:
    """What a table's number column holds, by its first twenty values."""
    w = Window.partitionBy("table_id").orderBy("row_id", "loaded_at")
    v = rows.where("coalesce(trim(pin_no), '') <> ''").select("table_id", F.col("pin_no").alias("v"), F.row_number().over(w).alias("i")).where("i <= 20")
    c = v.groupBy("table_id").agg(F.count("*").alias("n"), F.count_if(tb.looks_like_pin(F.col("v"))).alias("h"), F.count_if(F.lower(F.trim("v")).isin("i", "o", "i/o", "p", "g")).alias("t"))
    need = F.greatest(F.lit(2), F.floor(F.col("n") / 3))
    return c.select("table_id", F.when(F.col("h") >= need, "pin").when(F.col("t") >= need, "type").otherwise("other").alias("kind"))


@R.add("agg13_confusion_columns", "pins", sql="""
SELECT document_name, pkg, count(*) FILTER (length(trim(type)) = 1) * 1.0 / count(*) >= 0.6 AND count(DISTINCT upper(trim(type))) <= 6 AS confusable FROM pins WHERE coalesce(trim(type), '') <> '' GROUP BY 1, 2""")
def confusion_columns(pins: DataFrame) -> DataFrame:
    """Whether the type column of a package holds mostly single letters of few kinds."""
    t = F.trim("type")
    share = F.count_if(F.length(t) == 1) / F.count("*")
    return pins.where("coalesce(trim(type), '') <> ''").groupBy("document_name", "pkg").agg(((share >= 0.6) & (F.count_distinct(F.upper(t)) <= 6)).alias("confusable"))


# ---- rules on titles and headers, over the rough grid of every table

_FORM = _H.replace("regexp_replace({}, '\\(\\s*\\d+(\\s*,\\s*\\d+)*\\s*\\)', '', 'g')", "{}")
_LOW = "lower(trim(regexp_replace(coalesce({}, ''), '\\s+', ' ', 'g')))"
_HEAD = _FORM.format("array_to_string(g[1], ' ')")
_TITLE = _FORM.format("coalesce(title, '')")


def _any(column: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


_ORDER = f"(contains(h, 'orderable device') AND {' + '.join(f'contains(h, {w!r})::INT' for w in tb.ORDERING)} >= 2)"


@R.add("flt04_may_hold_pins", "table_candidates", sql=f"""
SELECT table_id, loaded_at, NOT {_ORDER} AND NOT {_any('h', sp.NOT_PINS)} AND ({_any('h', sp.PIN_WORDS)} OR {_any('t', sp.PIN_TITLES)} OR regexp_matches(b, '{sp.BALL_CODE}')) AS candidate
FROM (SELECT table_id, loaded_at, coalesce({_HEAD}, '') AS h, {_TITLE} AS t, array_to_string(list_transform(g[1:8], lambda r: array_to_string(r, ' ')), ' ') AS b FROM ({_GRID}))""")
def may_hold_pins(tables: DataFrame) -> DataFrame:
    """Which tables are worth a look."""
    head = F.get("grid", F.lit(0))
    return _flat(tables).select("table_id", "loaded_at", F.coalesce(sp.may_hold_pins(F.col("title"), F.coalesce(head, F.array().cast("array<string>")), F.col("grid"), tb.is_ordering(head)), F.lit(False)).alias("candidate"))


@R.add("flt05_maps_functions", "table_candidates", sql=f"""
SELECT table_id, loaded_at, NOT {_any('h', sp.PHYSICAL)} AND (regexp_matches(t, '{sp.PORT_TITLE}') OR {_any("h || ' ' || t", sp.MUX_WORDS)}) AS mapping FROM (SELECT table_id, loaded_at, coalesce({_HEAD}, '') AS h, {_TITLE} AS t FROM ({_GRID}))""")
def maps_functions(tables: DataFrame) -> DataFrame:
    """Which tables tell the functions of ports only."""
    return _flat(tables).select("table_id", "loaded_at", sp.maps_functions(F.col("title"), F.coalesce(F.get("grid", F.lit(0)), F.array().cast("array<string>"))).alias("mapping"))


@R.add("flt07_special_kinds", "table_candidates")
def special_kinds(tables: DataFrame) -> DataFrame:
    """The special rule that each table fits, with the places of reserved rows."""
    t = _whole(tables).withColumn("header", F.get("grid", F.lit(0))).withColumn("rows", F.slice("grid", 2, F.size("grid")))
    args = F.col("title"), F.col("header"), F.col("rows")
    return t.select("table_id", "loaded_at", sp.special_kind(*args).alias("kind"), sp.reserved_rows(*args).alias("rows"))


@R.add("flt14_wants_spans", "table_candidates", sql=f"""
SELECT table_id, loaded_at, regexp_matches(html, '(?i)\\b(rowspan|colspan)\\s*=') AND regexp_matches(w, '\\b(pin|ball|terminal)\\b|引脚|端子|球') AND regexp_matches(w, '\\b(name|type|description|no|number)\\b|名称|类型|说明|描述|编号') AS wanted
FROM (SELECT table_id, loaded_at, html, {_FORM.format("coalesce(title, '') || ' ' || coalesce(array_to_string(flatten(g[1:4]), ' '), '')")} AS w FROM ({_GRID}))""")
def wants_spans(tables: DataFrame) -> DataFrame:
    """Tables whose spans are worth writing out for a header of several rows."""
    return _flat(tables).select("table_id", "loaded_at", sp.wants_spans(F.col("html"), F.col("title"), F.col("grid")).alias("wanted"))


@R.add("flt31_continued", "table_candidates", sql=f"SELECT table_id, loaded_at, regexp_matches(lower(coalesce(title, '')), '(\\(续\\)|\\(续表\\)|\\(续上表\\)|\\(continued\\)|\\(cont\\.\\)|\\(cont[’'']d\\)|\\(…continued\\)|(^|[^\\p{{L}}])continued|续表)\\s*$|\\(continued\\)') AS continued FROM table_candidates")
def continued(tables: DataFrame) -> DataFrame:
    """Titles that say that their table goes on."""
    return tables.select("table_id", "loaded_at", sp.is_continued(F.col("title")).alias("continued"))


@R.add("flt33_page_noise", "spans", sql=f"SELECT span_id, loaded_at FROM spans WHERE regexp_matches({_LOW.format('content')}, '{sp.PAGE_NOISE}')")
def page_noise(spans: DataFrame) -> DataFrame:
    """Spans that are nothing but page furniture."""
    return spans.where(sp.is_page_noise(F.col("content"))).select("span_id", "loaded_at")


@R.add("prj15_header_hints", "table_candidates", sql=f"""
SELECT table_id, loaded_at, (i - 1)::INT AS col_idx, trim(array_to_string(list_filter([c1, CASE WHEN c2 <> c1 THEN c2 END, CASE WHEN c3 NOT IN (c1, c2) THEN c3 END, CASE WHEN c4 NOT IN (c1, c2, c3) THEN c4 END], lambda x: x <> ''), ' ')) AS hint FROM (
 SELECT table_id, loaded_at, i, coalesce(g[1][i], '') AS c1, coalesce(g[2][i], '') AS c2, coalesce(g[3][i], '') AS c3, coalesce(g[4][i], '') AS c4 FROM (SELECT *, unnest(range(1, list_max(list_transform(g[1:4], lambda r: len(r))) + 1)) AS i FROM ({_GRID}) WHERE len(g) > 0))""")
def header_hints(tables: DataFrame) -> DataFrame:
    """The texts of the first four rows per column, for finding catalogues."""
    return _flat(tables).select("table_id", "loaded_at", F.posexplode(sp.header_hints(F.col("grid"))).alias("col_idx", "hint"))


@R.add("prj14_header_paths", "table_candidates")
def header_paths(tables: DataFrame) -> DataFrame:
    """The path of header texts over each column, down to the best header row."""
    t = _whole(tables).withColumn("last", -tb.header_row(F.col("grid"))["minus"])
    return t.select("table_id", "loaded_at", F.posexplode(sp.paths_udf("grid", "last")).alias("col_idx", "path"))


@R.add("agg11_type_columns", "table_candidates", sql=f"""
WITH c AS (SELECT table_id, loaded_at, i, {_FORM.format("coalesce(g[1][i], '')")} AS h, list_filter(list_transform(g[2:31], lambda r: r[i]), lambda x: x IS NOT NULL)[1:20] AS v FROM (SELECT *, unnest(range(1, len(g[1]) + 1)) AS i FROM ({_GRID}) WHERE len(g) > 0)),
s AS (SELECT table_id, loaded_at, i, CASE WHEN regexp_matches(h, '{sp.TYPE_TITLES}') THEN 20 ELSE 0 END + CASE WHEN h IN ('type', 'i o', 'io', 'i/o') THEN 10 ELSE 0 END - CASE WHEN regexp_matches(h, '{sp.TYPE_OTHERS}') THEN 15 ELSE 0 END
 + 3 * len(list_filter(v, lambda x: lower(trim(x)) IN ({', '.join(f"'{t}'" for t in tb.TYPES)}))) AS score FROM c)
SELECT table_id, loaded_at, max(score)::INT AS score, (min_by(i, -score * 1000 + i) - 1)::INT AS col_idx FROM s GROUP BY ALL""")
def type_columns(tables: DataFrame) -> DataFrame:
    """The column of each table that suits a pin's type best, the leftmost on ties."""
    head = F.get("grid", F.lit(0))
    values = lambda i: F.filter(F.transform(F.slice("grid", 2, 30), lambda r: F.get(r, i)), lambda x: x.isNotNull())
    scored = F.transform(head, lambda h, i: F.struct(sp.type_score(h, F.lit(0), values(i), tb.is_type).alias("score"), (-i).alias("minus")))
    best = _flat(tables).where(F.size(head) > 0).select("table_id", "loaded_at", F.array_max(scored).alias("best"))
    return best.select("table_id", "loaded_at", F.col("best.score").cast("int").alias("score"), (-F.col("best.minus")).alias("col_idx"))


@R.add("prj22_public_result", "pins", sql=f"""
SELECT document_name, pkg, to_json(list(struct_pack("group" := g, pins := n) ORDER BY g))::VARCHAR AS groups FROM (
 SELECT document_name, pkg, coalesce(group_name, '') AS g, count(*) FILTER (coalesce(trim(pin_no), '') <> '') AS n FROM {_PINS} GROUP BY ALL) WHERE n > 0 GROUP BY ALL""")
def public_result(pins: DataFrame) -> DataFrame:
    """Packages with the number of numbered pins of their groups; groups and packages without a pin fall away."""
    numbered = pins.where("coalesce(trim(pin_no), '') <> ''").groupBy("document_name", "pkg", F.coalesce("group_name", F.lit("")).alias("group")).agg(F.count_distinct("pin_id").alias("pins"))
    return numbered.groupBy("document_name", "pkg").agg(F.to_json(F.array_sort(F.collect_list(F.struct("group", "pins")))).alias("groups"))
