"""Queries of layout, rendering, sources, streams and relational headline plans, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import geometry as geo
from folioforge.operators import assign as asg
from folioforge.operators import chapters as ch
from folioforge.operators import layout as ly
from folioforge.operators import render as rd
from folioforge.plans.registry import Registry
from folioforge.session import table
from folioforge.sources import documents as src
from folioforge.sources import sinks
from folioforge.streaming import windows as st

R = Registry()
_BY = ["document_name", "page_idx"]


def _once(spans: DataFrame) -> DataFrame:
    w = Window.partitionBy("span_id").orderBy("loaded_at")
    return spans.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


_ONCE = "(SELECT * FROM spans QUALIFY row_number() OVER (PARTITION BY span_id ORDER BY loaded_at) = 1)"


@R.add("flt19_discard_reasons", "spans", sql=f"""
WITH s AS (SELECT *, CASE WHEN greatest(abs(bbox[1]), abs(bbox[2]), abs(bbox[3]), abs(bbox[4])) <= 1.5 THEN 1.0 ELSE page_size[2] END AS h, CASE WHEN greatest(abs(bbox[1]), abs(bbox[2]), abs(bbox[3]), abs(bbox[4])) <= 1.5 THEN 1.0 ELSE page_size[1] END AS w FROM {_ONCE}),
p AS (SELECT *, regexp_replace(trim(regexp_replace(lower(content), '\\s+', ' ', 'g')), '^[\\s\\-–—|·.,:;]+|[\\s\\-–—|·.,:;]+$', '', 'g') AS form, (bbox[4] / h <= 0.075 OR bbox[2] / h >= 0.925) AND (bbox[4] - bbox[2]) / h <= 0.045 AS margin,
  bbox[2] / h >= 0.925 AND (bbox[4] - bbox[2]) / h <= 0.045 AS bottom, (bbox[4] - bbox[2]) / h <= 0.045 AND (bbox[3] - bbox[1]) / w <= 0.9 AS small FROM s),
r AS (SELECT document_name, form FROM p WHERE margin AND length(form) > 0 AND length(content) <= 80 GROUP BY ALL HAVING count(DISTINCT page_idx) >= 2),
b AS (SELECT document_name, lower(string_agg(content, ' ')) AS n FROM p WHERE page_idx = 0 AND bbox[2] / h >= 0.74 GROUP BY 1),
k AS (SELECT document_name FROM b WHERE contains(n, 'copyright')::INT + contains(n, 'all rights reserved')::INT + contains(n, 'confidential')::INT + contains(n, 'subject to change')::INT + contains(n, 'trademark')::INT + contains(n, 'disclaimer')::INT + contains(n, 'important notice')::INT + contains(n, '版权')::INT + contains(n, '保留所有权利')::INT + contains(n, '声明')::INT >= 2)
SELECT p.span_id, CASE WHEN p.block_type IN ('header', 'footer', 'page_number', 'page_footnote') THEN 'type' WHEN p.content IS NULL THEN NULL WHEN trim(p.content) = '' THEN 'empty'
  WHEN k.document_name IS NOT NULL AND p.page_idx = 0 AND p.bbox[2] / p.h >= 0.74 AND p.small THEN 'first_page_notice'
  WHEN p.bottom AND regexp_matches(trim(p.content), '(?i)^[\\s\\-–—\\[(]*(?:page\\s+)?\\d{{1,4}}(?:\\s*(?:/|of)\\s*\\d{{1,4}})?[\\s\\-–—\\])]*$|^第\\s*\\d+\\s*页(?:\\s*共\\s*\\d+\\s*页)?$') THEN 'page_number'
  WHEN p.margin AND p.small AND r.form IS NOT NULL THEN 'repeated_margin_text' END AS reason
FROM p LEFT JOIN r ON p.document_name = r.document_name AND p.form = r.form LEFT JOIN k ON p.document_name = k.document_name""")
def discard_reasons(spans: DataFrame) -> DataFrame:
    """Why each span is page furniture, by the margin rules."""
    return ly.discard_reasons(_once(spans)).select("span_id", F.col("discard_reason").alias("reason"))


@R.add("flt24_scanned_signals", "documents", sql="""
SELECT doc_id, length(regexp_replace(text, '\\s+', '', 'g'))::INT AS chars, round(length(regexp_replace(text, '[^!-/:-@\\[-`{-~]', '', 'g')) * 1.0 / greatest(length(text), 1), 9) AS marks,
 round(coalesce(list_sum(list_transform(regexp_extract_all(text, '[!-/:-@\\[-`{-~]{4,}'), lambda x: length(x))), 0) * 1.0 / greatest(length(text), 1), 9) AS runs FROM documents WHERE text IS NOT NULL""")
def scanned_signals(docs: DataFrame) -> DataFrame:
    """Signals that tell text from recognised or broken text."""
    s = ly.scanned_signals(F.col("text"))
    return docs.where("text is not null").select("doc_id", s["chars"].alias("chars"), F.round(s["marks"], 9).alias("marks"), F.round(s["runs"], 9).alias("runs"))


@R.add("flt36_vertical_blocks", "spans", sql="SELECT document_name, page_idx, block_seq, avg(CASE WHEN (bbox[4] - bbox[2]) / greatest(bbox[3] - bbox[1], 0.001) > 2 THEN 1.0 ELSE 0.0 END) > 0.8 AS vertical FROM spans GROUP BY ALL")
def vertical_blocks(spans: DataFrame) -> DataFrame:
    """Blocks whose spans stand upright."""
    b = geo.Box.of(F.col("bbox"))
    up = ((b.y1 - b.y0) / F.greatest(b.x1 - b.x0, F.lit(0.001)) > 2).cast("double")
    return spans.groupBy(*_BY, "block_seq").agg((F.avg(up) > 0.8).alias("vertical"))


@R.add("srt02_reading_order", "spans")
def reading_order(spans: DataFrame) -> DataFrame:
    """Reading order of the spans of each page by recursive cuts."""
    return ly.page_order(_once(spans), _BY, "span_id", "bbox")


@R.add("geo14_sheet_regions", "orders", sql="""
SELECT o_custkey AS sheet, count(DISTINCT o_orderkey) AS cells FROM orders GROUP BY 1""")
def sheet_regions(orders: DataFrame) -> DataFrame:
    """Cells of sheets made from orders, found again in their regions."""
    cells = orders.select(F.col("o_custkey").alias("sheet"), F.floor(F.col("o_orderkey") / 8).cast("int").alias("r"), (F.col("o_orderkey") % 8).cast("int").alias("c"))
    return ly.sheet_regions(cells, "sheet", "r", "c", 1).groupBy("sheet").agg(F.sum("cells").alias("cells"))


@R.add("win15_continued_tables", "spans", sql=f"""
WITH s AS (SELECT * FROM {_ONCE}), e AS (SELECT document_name, page_idx, min(block_seq) AS lo, max(block_seq) AS hi FROM s GROUP BY ALL),
t AS (SELECT s.document_name, s.page_idx, s.span_id AS table_id, s.block_seq = e.lo AS is_first, s.block_seq = e.hi AS is_last, s.bbox[3] - s.bbox[1] AS w FROM s JOIN e USING (document_name, page_idx) WHERE s.type = 'table')
SELECT a.document_name, a.page_idx, b.table_id AS table_before, a.table_id FROM t a JOIN t b ON a.document_name = b.document_name AND a.page_idx = b.page_idx + 1 AND a.is_first AND b.is_last AND abs(a.w - b.w) < 0.1 * least(a.w, b.w)""")
def continued_tables(spans: DataFrame) -> DataFrame:
    """Tables at a page's start that go on with the one at the end of the page before."""
    s = _once(spans)
    ends = s.groupBy(*_BY).agg(F.min("block_seq").alias("lo"), F.max("block_seq").alias("hi"))
    b = geo.Box.of(F.col("bbox"))
    t = s.where("type = 'table'").join(ends, _BY).select(*_BY, F.col("span_id").alias("table_id"), (F.col("block_seq") == F.col("lo")).alias("is_first"), (F.col("block_seq") == F.col("hi")).alias("is_last"), (b.x1 - b.x0).alias("box_width"), F.lit(0).alias("columns"))
    return ly.continued_tables(t)


@R.add("prj04_block_texts", "spans", sql=f"""
SELECT document_name, page_idx, block_seq, string_agg(trim(content), ' ' ORDER BY line_seq, span_seq, span_id) AS text FROM {_ONCE} WHERE type = 'text' AND content <> '' AND NOT regexp_matches(trim(content), '[A-Za-z]-$') AND NOT regexp_matches(trim(content), '[\\x{{4e00}}-\\x{{9fff}}]$') GROUP BY ALL""")
def block_texts(spans: DataFrame) -> DataFrame:
    """Texts of blocks, of the lines that end neither in a hyphen nor in a Chinese character."""
    s = _once(spans).where("type = 'text' and content <> ''").where(~F.trim("content").rlike("[A-Za-z]-$") & ~F.trim("content").rlike("[\\x{4e00}-\\x{9fff}]$"))
    return rd.block_texts(s, _BY, ["line_seq", "span_seq", "span_id"]).select(*_BY, "block_seq", "text")


@R.add("prj04_whole_block_texts", "spans")
def whole_block_texts(spans: DataFrame) -> DataFrame:
    """Texts of blocks, of all their lines."""
    s = _once(spans).where("type = 'text' and content <> ''")
    return rd.block_texts(s, _BY, ["line_seq", "span_seq", "span_id"]).select(*_BY, "block_seq", "text")


@R.add("prj26_markdown", "spans")
def markdown(spans: DataFrame) -> DataFrame:
    """Every document as Markdown."""
    blocks = rd.block_texts(_once(spans), _BY, ["line_seq", "span_seq", "span_id"])
    return rd.markdown(blocks, ["document_name"], ["page_idx", "block_seq"])


@R.add("prj24_content_list", "spans", sql=f"""
SELECT document_name, page_idx, block_seq, CASE WHEN starts_with(k, 'table') THEN 'table' WHEN starts_with(k, 'image') THEN 'image' WHEN k = 'interline_equation' THEN 'equation' WHEN k = 'list' THEN 'list' ELSE 'text' END AS type,
 CASE WHEN k = 'title' THEN 1 END::INT AS text_level, [trunc(x0 * 1000 / w)::INT, trunc(y0 * 1000 / h)::INT, trunc(x1 * 1000 / w)::INT, trunc(y1 * 1000 / h)::INT] AS bbox FROM (
 SELECT document_name, page_idx, block_seq, min(block_type) AS k, min(bbox[1]) AS x0, min(bbox[2]) AS y0, max(bbox[3]) AS x1, max(bbox[4]) AS y1, max(page_size[1]) AS w, max(page_size[2]) AS h FROM {_ONCE} GROUP BY ALL)""")
def content_list(spans: DataFrame) -> DataFrame:
    """The flat content list: type, heading level and box of every block."""
    blocks = rd.block_texts(_once(spans), _BY, ["line_seq", "span_seq", "span_id"])
    return rd.content_list(blocks).select(*_BY, "block_seq", "type", "text_level", "bbox")


@R.add("src05_page_slice", "spans", sql="SELECT span_id, loaded_at FROM spans WHERE page_idx BETWEEN 1 AND 2")
def page_slice(spans: DataFrame) -> DataFrame:
    """Spans of the second and third pages."""
    return src.page_slice(spans, 1, 2).select("span_id", "loaded_at")


@R.add("src03_kind_of_bytes", "documents", sql="""
SELECT doc_id, CASE WHEN starts_with(text, '%PDF') THEN 'pdf' ELSE 'unknown' END AS kind FROM documents WHERE text IS NOT NULL""")
def kind_of_bytes(docs: DataFrame) -> DataFrame:
    """Kind of the texts' bytes."""
    return docs.where("text is not null").select("doc_id", src.kind_of_bytes(F.encode("text", "UTF-8")).alias("kind"))


@R.add("src16_artifacts", "parse_results", sql="""
SELECT DISTINCT document_name AS stem, '/out/' || document_name || '.json' AS final, '/out/' || document_name || '_middle.json' AS middle FROM parse_results WHERE document_name IS NOT NULL""")
def artifacts(parses: DataFrame) -> DataFrame:
    """Final and middle files of every document, found by their names."""
    d = parses.select(F.explode(F.array(F.concat(F.lit("/out/"), "document_name", F.lit(".json")), F.concat(F.lit("/out/"), "document_name", F.lit("_middle.json")))).alias("path")).distinct()
    return src.artifacts(d)


@R.add("snk02_markdown_twin", "documents", sql="SELECT document_name, to_json(struct_pack(document_name := document_name, markdown_file := markdown_file, n := n_chars))::VARCHAR AS json FROM documents WHERE document_name IS NOT NULL AND markdown_file IS NOT NULL AND n_chars IS NOT NULL")
def markdown_twin(docs: DataFrame) -> DataFrame:
    """JSON twins (with the length in the place of the text)."""
    return docs.where("document_name is not null and markdown_file is not null and n_chars is not null").select("document_name", F.to_json(F.struct("document_name", "markdown_file", F.col("n_chars").alias("n"))).alias("json"))


@R.add("snk04_batch_summary", "parse_results", sql="SELECT count(*) AS documents, count(*) FILTER (length(middle_json) > 0) AS succeeded, count(*) - count(*) FILTER (length(middle_json) > 0) AS failed, sum(coalesce(length(middle_json), 0))::BIGINT AS items FROM parse_results")
def batch_summary(parses: DataFrame) -> DataFrame:
    """Totals of a batch of parses."""
    return sinks.batch_summary(parses.select((F.coalesce(F.length("middle_json"), F.lit(0)) > 0).alias("ok"), F.coalesce(F.length("middle_json"), F.lit(0)).cast("bigint").alias("items")))


@R.add("win06_chapters", "documents", sql="""
WITH l AS (SELECT doc_id, i, trim(line) AS t FROM (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS line FROM (SELECT doc_id, string_split(replace(text, chr(13), ''), chr(10)) AS a FROM documents WHERE text IS NOT NULL))),
h AS (SELECT doc_id, i, t, CASE WHEN regexp_matches(t, '^#{1,6}\\s+\\S') THEN length(regexp_extract(t, '^(#+)', 1)) END AS lv, trim(regexp_replace(regexp_replace(t, '^#{1,6}\\s+', ''), '^\\d{1,2}(\\.\\d{1,3}){0,4}\\.?\\s+', '')) AS title FROM l),
c AS (SELECT doc_id, i, t, last_value(CASE WHEN lv = 1 THEN i END IGNORE NULLS) OVER w AS a1, last_value(CASE WHEN lv = 1 THEN title END IGNORE NULLS) OVER w AS t1, last_value(CASE WHEN lv = 2 THEN i END IGNORE NULLS) OVER w AS a2, last_value(CASE WHEN lv = 2 THEN title END IGNORE NULLS) OVER w AS t2,
 last_value(CASE WHEN lv = 3 THEN i END IGNORE NULLS) OVER w AS a3, last_value(CASE WHEN lv = 3 THEN title END IGNORE NULLS) OVER w AS t3 FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING))
SELECT doc_id, i::INT AS line_no, concat_ws(' > ', t1, CASE WHEN a2 > coalesce(a1, -1) THEN t2 END, CASE WHEN a3 > greatest(coalesce(a1, -1), coalesce(a2, -1)) THEN t3 END) AS path FROM c WHERE starts_with(t, '|')""")
def chapters(docs: DataFrame) -> DataFrame:
    """The chapter path of every table row of the Markdown texts (headings with hashes)."""
    lines = docs.where("text is not null").select("doc_id", F.posexplode(F.split(F.replace("text", F.lit("\r"), F.lit("")), "\n")).alias("line_no", "line"))
    only = lines.withColumn("head", F.when(F.trim("line").startswith("#"), F.col("line")))
    return ch.with_chapters(only, ["doc_id"], "line_no", "head").where(F.trim("line").startswith("|")).select("doc_id", "line_no", F.array_join("chapters", " > ").alias("path"))


@R.add("jon05_suppressed_boxes", "spans")
def suppressed_boxes(spans: DataFrame) -> DataFrame:
    """Spans that stay when boxes on top of better ones go."""
    return asg.suppress_boxes(_once(spans), _BY, "span_id", "bbox", "score").select("span_id")


@R.add("str22_repair_formulas", "spans")
def repair_formulas(spans: DataFrame) -> DataFrame:
    """Formulas with balanced sides and braces."""
    return spans.where("type = 'interline_equation'").select("span_id", asg.repair_formula_udf("content").alias("formula"))


def _stream(make, mode: str = "complete"):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stream = st.read_stream(spark, f"{sf_dir}/events.parquet", "*", table(spark, sf_dir, "events"))
        out = st.run_once(make(stream.withColumn("ts", F.col("ts").cast("timestamp"))), f"s_{uuid.uuid4().hex}", mode)
        return out.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))

    return query


R.queries["stream_tumbling"] = _stream(lambda s: st.tumbling(s, "ts", "1 hour", "1 day", "event_type"))
R.oracle["stream_tumbling"] = "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY ALL"
R.queries["stream_sliding"] = _stream(lambda s: st.sliding(s, "ts", "2 hours", "1 hour", "1 day", "event_type"))
R.oracle["stream_sliding"] = "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts) - d * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events, (VALUES (0), (1)) v(d) GROUP BY ALL"
R.queries["stream_sessions"] = _stream(lambda s: st.sessions(s, "ts", "30 minutes", "1 day", "user_id"))
R.oracle["stream_sessions"] = """
WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS b FROM events), n AS (SELECT user_id, ts, sum(CASE WHEN b IS NULL OR ts >= b + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM e)
SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, user_id, count(*) AS n FROM n GROUP BY user_id, s"""


@R.add("rel_q1", "lineitem", sql="""
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_quantity), 6) AS avg_qty, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def rel_q1(lineitem: DataFrame) -> DataFrame:
    """Pricing summary: filter, group and aggregate."""
    return lineitem.where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp")).groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc"), F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.count("*").alias("n")
    )


@R.add("rel_q5", "customer", "orders", "lineitem", "supplier", "nation", "region", sql="""
SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name""")
def rel_q5(customer: DataFrame, orders: DataFrame, lineitem: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Revenue of local suppliers: a join of six tables."""
    o = customer.join(orders, F.col("c_custkey") == F.col("o_custkey"))
    l = o.join(lineitem, F.col("o_orderkey") == F.col("l_orderkey"))  # noqa: E741
    s = l.join(supplier, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
    n = s.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return n.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@R.add("rel_topk", "orders", sql="SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def rel_topk(orders: DataFrame) -> DataFrame:
    """The three largest orders of each customer."""
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return orders.withColumn("n", F.row_number().over(w)).where("n <= 3").select("o_custkey", "o_orderkey", "o_totalprice")
