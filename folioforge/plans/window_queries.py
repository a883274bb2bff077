"""Queries of windows, joins and aggregations, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import geometry as geo
from folioforge.functions import text as tx
from folioforge.operators import joins as jn
from folioforge.operators import windows as wn
from folioforge.plans.registry import Registry

R = Registry()
_PAGE = "PARTITION BY document_name, page_idx ORDER BY block_seq, line_seq, span_seq, span_id, loaded_at"
_ORDER = ["block_seq", "line_seq", "span_seq", "span_id", "loaded_at"]
_BY = ["document_name", "page_idx"]


@R.add("win01_forward_fill", "spans", sql=f"""
SELECT span_id, loaded_at, last_value(CASE WHEN block_type = 'title' THEN content END IGNORE NULLS) OVER ({_PAGE} ROWS UNBOUNDED PRECEDING) AS title FROM spans""")
def forward_fill(spans: DataFrame) -> DataFrame:
    """The title above every span of a page."""
    s = spans.withColumn("title", F.when(F.col("block_type") == "title", F.col("content")))
    return wn.forward_fill(s, _BY, _ORDER, "title").select("span_id", "loaded_at", "title")


@R.add("win02_sections", "spans", sql=f"SELECT span_id, loaded_at, sum(CASE WHEN block_type = 'title' THEN 1 ELSE 0 END) OVER ({_PAGE} ROWS UNBOUNDED PRECEDING)::INT AS section FROM spans")
def sections(spans: DataFrame) -> DataFrame:
    """Sections of a page, begun by its titles."""
    return wn.islands(spans, _BY, _ORDER, F.col("block_type") == "title", "section").select("span_id", "loaded_at", "section")


@R.add("win08_rows_by_gap", "spans", sql="""
WITH g AS (SELECT span_id, loaded_at, document_name, page_idx, bbox[1] AS x, bbox[2] AS y FROM spans),
n AS (SELECT *, sum(CASE WHEN b IS NULL OR y - b > 10 THEN 1 ELSE 0 END) OVER (PARTITION BY document_name, page_idx ORDER BY y, x, span_id, loaded_at ROWS UNBOUNDED PRECEDING) AS row_no FROM (SELECT *, lag(y) OVER (PARTITION BY document_name, page_idx ORDER BY y, x, span_id, loaded_at) AS b FROM g))
SELECT document_name, page_idx, row_no::INT AS row_no, count(*) AS spans FROM n GROUP BY ALL""")
def rows_by_gap(spans: DataFrame) -> DataFrame:
    """Rows of a page, parted by gaps of more than ten points."""
    s = spans.select(*_BY, "span_id", F.get("bbox", F.lit(0)).alias("x"), F.get("bbox", F.lit(1)).alias("y"))
    return wn.rows_by_gap(s, _BY, "y", "x").groupBy(*_BY, "row_no").agg(F.count("*").alias("spans"))


@R.add("win09_lines_by_overlap", "spans", sql="""
WITH g AS (SELECT DISTINCT document_name, page_idx, bbox[1] AS x0, bbox[2] AS y0, bbox[4] AS y1, span_id FROM spans),
l AS (SELECT *, lag(y0) OVER w AS a0, lag(y1) OVER w AS a1 FROM g WINDOW w AS (PARTITION BY document_name, page_idx ORDER BY y0, x0, span_id)),
n AS (SELECT *, sum(CASE WHEN coalesce((least(a1, y1) - greatest(a0, y0)) / least(a1 - a0, y1 - y0) > 0.6, false) THEN 0 ELSE 1 END) OVER (PARTITION BY document_name, page_idx ORDER BY y0, x0, span_id ROWS UNBOUNDED PRECEDING) AS line FROM l)
SELECT document_name, page_idx, max(line)::INT AS lines FROM n GROUP BY ALL""")
def lines_by_overlap(spans: DataFrame) -> DataFrame:
    """Number of visual lines of each page."""
    b = geo.Box.of(F.col("bbox"))
    s = spans.select(*_BY, "span_id", b.x0.alias("x0"), b.y0.alias("y0"), b.y1.alias("y1")).distinct()
    return wn.lines_by_overlap(s, _BY, "y0", "y1", "x0").groupBy(*_BY).agg(F.max("line").alias("lines"))


@R.add("win11_merge_intervals", "events", sql="""
WITH i AS (SELECT user_id, event_id AS lo, event_id + 40 AS hi FROM events), r AS (SELECT *, max(hi) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR lo > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM r) SELECT user_id, min(lo) AS lo, max(hi) AS hi FROM n GROUP BY user_id, g""")
def merge_intervals(events: DataFrame) -> DataFrame:
    """Unions of intervals per user."""
    return wn.merge_intervals(events.select("user_id", F.col("event_id").alias("lo"), (F.col("event_id") + 40).alias("hi")), ["user_id"], "lo", "hi")


@R.add("win11_subtract_intervals", "events", "orders", sql="""
WITH i AS (SELECT DISTINCT event_id // 100 AS k, (event_id // 100) * 100 AS lo, (event_id // 100) * 100 + 99 AS hi FROM events), p AS (SELECT k, unnest(range(lo, hi + 1)) AS v FROM i),
m AS (SELECT DISTINCT o_orderkey // 100 AS k, o_orderkey AS v FROM orders WHERE o_orderstatus = 'F'), q AS (SELECT p.k, p.v FROM p ANTI JOIN m ON p.k = m.k AND p.v = m.v),
g AS (SELECT k, v, v - row_number() OVER (PARTITION BY k ORDER BY v) AS g FROM q) SELECT k, min(v) AS lo, max(v) AS hi FROM g GROUP BY k, g""")
def subtract_intervals(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Blocks of a hundred numbers without those of finished orders."""
    k = F.floor(F.col("event_id") / 100)
    blocks = events.select(k.alias("k"), (k * 100).alias("lo"), (k * 100 + 99).alias("hi"))
    o = F.col("o_orderkey")
    masks = orders.where("o_orderstatus = 'F'").select(F.floor(o / 100).alias("k"), o.alias("lo"), o.alias("hi"))
    return wn.subtract_intervals(blocks, masks, ["k"], "lo", "hi")


@R.add("win12_merge_paragraphs", "spans", sql="""
WITH b AS (SELECT DISTINCT document_name, page_idx, block_seq, line_seq, span_id, content AS text FROM spans WHERE block_type = 'text' AND content IS NOT NULL),
m AS (SELECT *, lag(text) OVER w AS before FROM b WINDOW w AS (PARTITION BY document_name, page_idx ORDER BY block_seq, line_seq, span_id)),
n AS (SELECT document_name, page_idx, sum(CASE WHEN before IS NULL OR regexp_matches(trim(before), '[.!?。！？…:：;；]$') OR regexp_matches(trim(text), '^[A-Z0-9]') THEN 1 ELSE 0 END) OVER (PARTITION BY document_name, page_idx ORDER BY block_seq, line_seq, span_id ROWS UNBOUNDED PRECEDING) AS p FROM m)
SELECT document_name, page_idx, max(p) AS paragraphs FROM n GROUP BY ALL""")
def merge_paragraphs(spans: DataFrame) -> DataFrame:
    """Number of paragraphs of the running text of each page."""
    b = spans.where("block_type = 'text' and content is not null").select(*_BY, "block_seq", "line_seq", "span_id", F.col("content").alias("text")).distinct()
    return wn.merge_paragraphs(b, _BY, ["block_seq", "line_seq", "span_id"]).groupBy(*_BY).agg(F.count("*").alias("paragraphs"))


@R.add("win21_neighbours", "lineitem", sql="""
SELECT l_orderkey, l_linenumber, (coalesce(sum(CASE WHEN l_quantity > 10 THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 0) - CASE WHEN l_quantity > 10 THEN 1 ELSE 0 END)::BIGINT AS near FROM lineitem""")
def neighbours(lineitem: DataFrame) -> DataFrame:
    """How many lines of an order around a line are large."""
    n = wn.neighbours(lineitem, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], F.col("l_quantity") > 10)
    return lineitem.select("l_orderkey", "l_linenumber", n.alias("near"))


@R.add("win23_page_windows", "documents", sql="SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 64)::INT AS window_no FROM documents")
def page_windows(docs: DataFrame) -> DataFrame:
    """Windows of sixty-four over all documents."""
    return wn.page_window(docs.select("doc_id"), ["doc_id"]).select("doc_id", "window_no")


@R.add("win03_notes", "spans")
def notes(spans: DataFrame) -> DataFrame:
    """Notes of the documents, numbered in reading order."""
    b = geo.Box.of(F.col("bbox"))
    s = spans.where("content is not null").select("document_name", "page_idx", "block_seq", "line_seq", "span_id", F.col("block_type").alias("type"), "content", b.x0.alias("x0")).distinct()
    return wn.notes_map(wn.notes(s, ["document_name"], ["page_idx", "block_seq", "line_seq", "span_id"]), ["document_name"])


@R.add("agg01_repeated_margins", "spans", sql="""
SELECT document_name, form, count(DISTINCT page_idx) AS pages FROM (SELECT document_name, page_idx, regexp_replace(trim(regexp_replace(lower(content), '\\s+', ' ', 'g')), '^[\\s\\-–—|·.,:;]+|[\\s\\-–—|·.,:;]+$', '', 'g') AS form FROM spans
 WHERE content IS NOT NULL AND length(content) <= 80 AND (bbox[4] <= page_size[2] * 0.075 OR bbox[2] >= page_size[2] * 0.925)) GROUP BY ALL HAVING count(DISTINCT page_idx) >= 2""")
def repeated_margins(spans: DataFrame) -> DataFrame:
    """Margin lines that stand on two pages or more."""
    b, h = geo.Box.of(F.col("bbox")), F.get("page_size", F.lit(1))
    m = spans.where(F.col("content").isNotNull() & (F.length("content") <= 80) & ((b.y1 <= h * 0.075) | (b.y0 >= h * 0.925)))
    return m.groupBy("document_name", tx.margin_form(F.col("content")).alias("form")).agg(F.count_distinct("page_idx").alias("pages")).where("pages >= 2")


@R.add("agg03_removal_counts", "spans", sql="SELECT block_type, type, count(*) AS n FROM spans GROUP BY ROLLUP (block_type, type)")
def removal_counts(spans: DataFrame) -> DataFrame:
    """Counts by kind with subtotals."""
    return spans.rollup("block_type", "type").agg(F.count("*").alias("n"))


@R.add("agg20_union_boxes", "spans", sql="SELECT document_name, page_idx, block_seq, min(bbox[1]) AS x0, min(bbox[2]) AS y0, max(bbox[3]) AS x1, max(bbox[4]) AS y1 FROM spans GROUP BY ALL")
def union_boxes(spans: DataFrame) -> DataFrame:
    """Boxes of blocks around their spans."""
    b = geo.Box.of(F.col("bbox"))
    return spans.groupBy(*_BY, "block_seq").agg(F.min(b.x0).alias("x0"), F.min(b.y0).alias("y0"), F.max(b.x1).alias("x1"), F.max(b.y1).alias("y1"))


@R.add("agg21_median_height", "spans", sql="SELECT document_name, round(median(bbox[4] - bbox[2]), 6) AS height, round(median((bbox[3] - bbox[1]) / greatest(length(content), 1)), 6) AS char_width FROM spans WHERE content IS NOT NULL GROUP BY 1")
def median_height(spans: DataFrame) -> DataFrame:
    """Median line height and character width of each document."""
    b = geo.Box.of(F.col("bbox"))
    return spans.where("content is not null").groupBy("document_name").agg(F.round(F.median(b.y1 - b.y0), 6).alias("height"), F.round(F.median((b.x1 - b.x0) / F.greatest(F.length("content"), F.lit(1))), 6).alias("char_width"))


@R.add("agg22_title_height", "spans", sql="SELECT document_name, round(avg(bbox[4] - bbox[2]), 6) AS height FROM spans WHERE block_type = 'title' GROUP BY 1")
def title_height(spans: DataFrame) -> DataFrame:
    """Average height of title lines."""
    b = geo.Box.of(F.col("bbox"))
    return spans.where("block_type = 'title'").groupBy("document_name").agg(F.round(F.avg(b.y1 - b.y0), 6).alias("height"))


@R.add("agg27_text_quality", "documents", sql="""
SELECT doc_id, length(regexp_replace(text, '\\s+', '', 'g'))::INT AS chars, round((length(text) - length(regexp_replace(text, '[\\x{0}\\x{FFFD}\\x{E000}-\\x{F8FF}\\x{1}-\\x{8}]', '', 'g'))) * 1.0 / greatest(length(text), 1), 9) AS abnormal,
 round((length(text) - length(regexp_replace(text, '[!-/:-@\\[-`{-~]', '', 'g'))) * 1.0 / greatest(length(text), 1), 9) AS punctuation,
 CASE WHEN length(regexp_replace(text, '\\s+', '', 'g')) < 50 THEN 'ocr' WHEN (length(text) - length(regexp_replace(text, '[!-/:-@\\[-`{-~]', '', 'g'))) * 1.0 / greatest(length(text), 1) >= 0.25 AND regexp_matches(text, '[!-/:-@\\[-`{-~]{4}') THEN 'ocr' ELSE 'txt' END AS kind
FROM documents WHERE text IS NOT NULL""")
def text_quality(docs: DataFrame) -> DataFrame:
    """Signals of extracted text and whether it should be recognised anew."""
    t = F.col("text")
    size = F.greatest(F.length(t), F.lit(1))
    share = lambda p: F.round((F.length(t) - F.length(F.regexp_replace(t, p, ""))) / size, 9)
    chars, marks = F.length(F.regexp_replace(t, r"\s+", "")), "[!-/:-@\\[-`{-~]"
    odd = share("[\\x{0}\\x{FFFD}\\x{E000}-\\x{F8FF}\\x{1}-\\x{8}]")
    kind = F.when(chars < 50, "ocr").when((share(marks) >= 0.25) & t.rlike(marks + "{4}"), "ocr").otherwise("txt")
    return docs.where("text is not null").select("doc_id", chars.alias("chars"), odd.alias("abnormal"), share(marks).alias("punctuation"), kind.alias("kind"))


@R.add("jon01_repeated_blocks", "spans", sql="""
WITH m AS (SELECT span_id, loaded_at, document_name, page_idx, lower(trim(content)) AS form FROM spans WHERE content IS NOT NULL AND length(content) <= 80)
SELECT span_id, loaded_at FROM m SEMI JOIN (SELECT document_name, form FROM m GROUP BY ALL HAVING count(DISTINCT page_idx) >= 2) r ON m.document_name = r.document_name AND m.form = r.form""")
def repeated_blocks(spans: DataFrame) -> DataFrame:
    """Short lines whose text stands on another page of the document too."""
    m = spans.where("content is not null and length(content) <= 80").select("span_id", "loaded_at", *_BY, F.lower(F.trim("content")).alias("form"))
    again = m.groupBy("document_name", "form").agg(F.count_distinct("page_idx").alias("n")).where("n >= 2").select("document_name", "form")
    return m.join(again, ["document_name", "form"], "left_semi").select("span_id", "loaded_at")


@R.add("jon03_overlap_join", "spans", sql="""
WITH t AS (SELECT DISTINCT document_name, page_idx, span_id, bbox FROM spans WHERE type = 'table'), s AS (SELECT DISTINCT document_name, page_idx, span_id, bbox FROM spans WHERE type = 'text')
SELECT s.span_id, t.span_id AS table_id FROM s JOIN t ON s.document_name = t.document_name AND s.page_idx = t.page_idx AND least(s.bbox[3], t.bbox[3]) > greatest(s.bbox[1], t.bbox[1]) AND least(s.bbox[4], t.bbox[4]) > greatest(s.bbox[2], t.bbox[2])""")
def overlap_join(spans: DataFrame) -> DataFrame:
    """Text spans that lie on a table of their page."""
    t = spans.where("type = 'table'").select(*_BY, F.col("span_id").alias("table_id"), F.col("bbox").alias("table_box")).distinct()
    s = spans.where("type = 'text'").select(*_BY, "span_id", "bbox").distinct()
    return jn.overlap_join(s, t, _BY, "bbox", "table_box").select("span_id", "table_id")


@R.add("jon08_nearest_caption", "spans", sql="""
WITH c AS (SELECT DISTINCT document_name, page_idx, span_id, bbox FROM spans WHERE block_type = 'table_caption'), t AS (SELECT DISTINCT document_name, page_idx, span_id, bbox FROM spans WHERE type = 'table')
SELECT c.span_id, t.span_id AS table_id FROM c JOIN t ON c.document_name = t.document_name AND c.page_idx = t.page_idx
QUALIFY row_number() OVER (PARTITION BY c.span_id ORDER BY sqrt(pow(greatest(c.bbox[1] - t.bbox[3], t.bbox[1] - c.bbox[3], 0), 2) + pow(greatest(c.bbox[2] - t.bbox[4], t.bbox[2] - c.bbox[4], 0), 2)), t.span_id) = 1""")
def nearest_caption(spans: DataFrame) -> DataFrame:
    """The table nearest to every table caption of its page."""
    c = spans.where("block_type = 'table_caption'").select(*_BY, "span_id", F.col("bbox").alias("cb")).distinct()
    t = spans.where("type = 'table'").select(*_BY, F.col("span_id").alias("table_id"), F.col("bbox").alias("tb")).distinct()
    d = geo.edge_distance(geo.Box.of(F.col("cb")), geo.Box.of(F.col("tb")))
    return jn.nearest(c.join(t, _BY), ["span_id"], d, F.col("table_id")).select("span_id", "table_id")


@R.add("jon10_adjacent_number", "spans")
def adjacent_number(spans: DataFrame) -> DataFrame:
    """Which neighbour of a caption is its table, for captions right before or after one."""
    s = spans.select(*_BY, "block_seq", "span_id", "block_type").distinct()
    return jn.adjacent_number(s, _BY, ["block_seq", "span_id"], "block_type", "table_caption", "table_body").select("span_id", "side")


@R.add("jon14_longest_prefix", "part", sql="""
WITH n AS (SELECT DISTINCT substr(p_name, 1, 4 + (p_partkey % 5)::INT) AS name FROM part WHERE p_partkey % 7 = 0)
SELECT p_partkey, (SELECT max_by(name, length(name)) FROM n WHERE starts_with(p_name, name) AND length(name) >= 3) AS name FROM part""")
def longest_prefix(part: DataFrame) -> DataFrame:
    """The longest known beginning of every part's name."""
    names = part.where("p_partkey % 7 = 0").select(F.expr("substring(p_name, 1, 4 + p_partkey % 5)").alias("name"))
    return jn.longest_prefix(part.select("p_partkey", "p_name"), names, "p_name", "name").select("p_partkey", "name")


@R.add("jon14_whole_longest_prefix", "part")
def whole_longest_prefix(part: DataFrame) -> DataFrame:
    """The longest known beginning of every part's name, of the beginnings that all parts give."""
    names = part.select(F.expr("substring(p_name, 1, 4 + p_partkey % 5)").alias("name"))
    return jn.longest_prefix(part.select("p_partkey", "p_name"), names, "p_name", "name").select("p_partkey", "name")


@R.add("jon16_row_lookup", "pin_rows", "table_candidates", sql="SELECT r.row_id, r.loaded_at, t.title FROM pin_rows r LEFT JOIN (SELECT table_id, min(title) AS title FROM table_candidates GROUP BY 1) t ON r.table_id = t.table_id")
def row_lookup(rows: DataFrame, tables: DataFrame) -> DataFrame:
    """Rows with the title of their table."""
    return rows.join(tables.groupBy("table_id").agg(F.min("title").alias("title")), "table_id", "left").select("row_id", "loaded_at", "title")


@R.add("jon02_align_pages", "nation", "region", sql="SELECT n_regionkey, seq, page_no FROM (SELECT n_regionkey, (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::INT AS seq, n_nationkey + 1 AS page_no FROM nation) WHERE seq NOT IN (1, 3)")
def align_pages(nation: DataFrame, region: DataFrame) -> DataFrame:
    """A list aligned to a longer one of which it lacks the second and the fourth item, as final tables to source tables: the pages come from the texts."""
    w = Window.partitionBy("n_regionkey").orderBy("n_nationkey")
    src = nation.select("n_regionkey", (F.row_number().over(w) - 1).alias("seq"), F.col("n_name").alias("text"), (F.col("n_nationkey") + 1).alias("page_no"))
    return jn.align_sequences(src, src.where("seq not in (1, 3)").select("n_regionkey", "seq", "text"), "n_regionkey", "seq", "text", "page_no")


@R.add("set01_union_by_source", "spans", "table_candidates", sql="SELECT document_name, min(p) AS source FROM (SELECT document_name, 1 AS p FROM spans WHERE type = 'table' UNION ALL SELECT document_name, 2 FROM table_candidates) GROUP BY 1")
def union_by_source(spans: DataFrame, tables: DataFrame) -> DataFrame:
    """Documents with tables and the first source that has them."""
    both = spans.where("type = 'table'").select("document_name", F.lit(1).alias("p")).unionByName(tables.select("document_name", F.lit(2).alias("p")))
    return both.groupBy("document_name").agg(F.min("p").alias("source"))


@R.add("set02_except", "parse_results", "spans", sql="SELECT DISTINCT document_name FROM parse_results EXCEPT SELECT document_name FROM spans")
def except_(parses: DataFrame, spans: DataFrame) -> DataFrame:
    """Parsed documents without spans."""
    return parses.select("document_name").distinct().join(spans.select("document_name").distinct(), "document_name", "left_anti")


@R.add("set03_intersect", "table_candidates", sql="SELECT table_id, loaded_at, len(list_intersect(previous_chapter_titles, current_chapter_titles))::INT AS common FROM table_candidates")
def intersect(tables: DataFrame) -> DataFrame:
    """Titles that the chapters before and around a table have in common."""
    return tables.select("table_id", "loaded_at", F.size(F.array_intersect("previous_chapter_titles", "current_chapter_titles")).alias("common"))


@R.add("set04_first_seen", "pins", sql="SELECT document_name, string_agg(pkg, '|' ORDER BY first) AS packages FROM (SELECT document_name, pkg, min(pin_id) AS first FROM pins GROUP BY ALL) GROUP BY 1")
def first_seen(pins: DataFrame) -> DataFrame:
    """Packages of each document in order of first appearance."""
    first = pins.groupBy("document_name", "pkg").agg(F.min("pin_id").alias("first"))
    return first.groupBy("document_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "pkg"))), lambda x: x["pkg"]), "|").alias("packages"))


@R.add("srt03_children_by_index", "spans", sql="SELECT span_id, loaded_at, (row_number() OVER (PARTITION BY document_name, page_idx ORDER BY score NULLS LAST, block_seq, line_seq, span_seq, span_id, loaded_at))::INT AS place FROM spans")
def children_by_index(spans: DataFrame) -> DataFrame:
    """Spans of a page by score, those without at the end."""
    w = Window.partitionBy(*_BY).orderBy(F.asc_nulls_last("score"), *_ORDER)
    return spans.select("span_id", "loaded_at", F.row_number().over(w).alias("place"))


@R.add("srt07_even_sample", "spans", sql="""
WITH n AS (SELECT document_name, count(*) AS n FROM spans GROUP BY 1) SELECT document_name, list_sort(list_distinct(list_transform(range(10), lambda i: round_even(i * (n - 1) / 9.0, 0)::INT))) AS pages FROM n WHERE n > 10""")
def even_sample(spans: DataFrame) -> DataFrame:
    """Ten evenly spaced places of every document, halves to the even number."""
    n = spans.groupBy("document_name").agg(F.count("*").alias("n")).where("n > 10")
    places = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.bround(i * (F.col("n") - 1) / 9.0, 0).cast("int"))
    return n.select("document_name", F.array_sort(F.array_distinct(places)).alias("pages"))
