"""Queries of page blocks, titles around tables, lists and pipe tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.operators import blocks as bl
from folioforge.plans.registry import Registry

R = Registry()
_SPANS = "(SELECT * FROM spans QUALIFY row_number() OVER (PARTITION BY span_id ORDER BY loaded_at) = 1)"
_PAGE = "PARTITION BY document_name, page_idx ORDER BY block_seq, line_seq, span_seq, span_id"


def _once(spans: DataFrame, *columns: str) -> DataFrame:
    """Every span once, by one aggregation of the columns wanted."""
    return spans.groupBy("span_id").agg(F.min_by(F.struct(*columns), "loaded_at").alias("s")).select("span_id", "s.*")


@R.add("prj10_pipe_tables", "documents", sql="""
WITH l AS (SELECT doc_id, trim(line) AS line, i FROM (SELECT doc_id, string_split(replace(text, chr(13), ''), chr(10)) AS ls, unnest(range(1, len(ls) + 1)) AS i, ls[i] AS line FROM documents WHERE text IS NOT NULL)),
p AS (SELECT doc_id, line, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM l WHERE regexp_full_match(line, '\\|.*\\|')),
c AS (SELECT doc_id, run, min(i) OVER (PARTITION BY doc_id, run) AS first, i, list_transform(string_split(line[2:-2], '|'), lambda x: trim(x)) AS cells FROM p),
h AS (SELECT doc_id, run, first, cells AS header FROM c WHERE i = first),
r AS (SELECT c.doc_id, c.first, c.i, c.cells, h.header FROM c JOIN h USING (doc_id, run) WHERE c.i > c.first AND NOT regexp_full_match(array_to_string(c.cells, ''), '[-: ]+')),
v AS (SELECT doc_id, first, i, unnest(range(1, len(header) + 1)) AS k, header, cells FROM r)
SELECT doc_id, (first - 1)::INT AS line_idx, (k - 1)::INT AS col_idx, header[k] AS header, list(coalesce(cells[k], '') ORDER BY i) AS column_values FROM v GROUP BY doc_id, first, k, header""")
def pipe_tables(documents: DataFrame) -> DataFrame:
    """Every pipe table of the texts as columns: header and values in order."""
    return bl.pipe_tables(documents, "doc_id", "text")


@R.add("win04_table_titles", "spans", sql=f"""
WITH s AS (SELECT *, count(*) FILTER (type = 'table') OVER ({_PAGE} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS part FROM {_SPANS}),
t AS (SELECT *, last_value(CASE WHEN regexp_matches(content, '(?i)^\\s*(table|tabelle|tableau|表)\\s*\\d+') THEN content END IGNORE NULLS) OVER (PARTITION BY document_name, page_idx, part ORDER BY block_seq, line_seq, span_seq, span_id) AS title,
 last_value(CASE WHEN regexp_matches(content, '(?i)^\\s*(figure|abbildung|bild|图)\\s*\\d+') THEN content END IGNORE NULLS) OVER (PARTITION BY document_name, page_idx, part ORDER BY block_seq, line_seq, span_seq, span_id) AS figure FROM s)
SELECT span_id, title, figure FROM t WHERE type = 'table'""")
def table_titles(spans: DataFrame) -> DataFrame:
    """Each table span with the last numbered table and figure title since the table before it on the page."""
    s = _once(spans, "document_name", "page_idx", "block_seq", "line_seq", "span_seq", "type", "content")
    order = ["block_seq", "line_seq", "span_seq", "span_id"]
    return bl.titles_since(s, ["document_name", "page_idx"], order, F.col("type") == "table", {"title": bl.TABLE_TITLE, "figure": bl.FIGURE_TITLE}, "content").where("type = 'table'").select("span_id", "title", "figure")


@R.add("win20_merged_blocks", "spans", sql=f"""
WITH s AS (SELECT *, coalesce(lag(block_type) OVER ({_PAGE}) = block_type, false) AS same FROM {_SPANS} WHERE content IS NOT NULL),
g AS (SELECT *, sum((NOT same)::INT) OVER ({_PAGE} ROWS UNBOUNDED PRECEDING) AS run FROM s)
SELECT document_name, page_idx, (run - 1)::INT AS run, block_type, count(DISTINCT block_seq) AS blocks, string_agg(content, chr(10) ORDER BY block_seq, line_seq, span_seq, span_id) AS text FROM g WHERE block_type = 'list' GROUP BY ALL""")
def merged_blocks(spans: DataFrame) -> DataFrame:
    """Adjacent blocks of one type joined: the lists of every page."""
    s = _once(spans.where("content is not null"), "document_name", "page_idx", "block_seq", "line_seq", "span_seq", "block_type", "content")
    return bl.merge_adjacent(s, ["document_name", "page_idx"], ["block_seq", "line_seq", "span_seq", "span_id"], "block_type", "content", "block_seq").where("block_type = 'list'").withColumnRenamed("n", "blocks")


@R.add("win24_list_numbers", "spans", sql=f"""
SELECT span_id, row_number() OVER (PARTITION BY document_name, page_idx, block_seq ORDER BY line_seq, span_seq, span_id)::INT AS number FROM {_SPANS} WHERE block_type = 'list'""")
def list_numbers(spans: DataFrame) -> DataFrame:
    """Items of ordered lists counted, from one again in every list."""
    s = _once(spans.where("block_type = 'list'"), "document_name", "page_idx", "block_seq", "line_seq", "span_seq")
    w = Window.partitionBy("document_name", "page_idx", "block_seq").orderBy("line_seq", "span_seq", "span_id")
    return s.select("span_id", F.row_number().over(w).alias("number"))


@R.add("flt30_sure_spans", "spans", sql="SELECT span_id, loaded_at FROM spans WHERE score > 0.5 AND bbox[3] - bbox[1] >= 3")
def sure_spans(spans: DataFrame) -> DataFrame:
    """Recognised spans that are sure and wide enough."""
    return spans.where((F.col("score") > 0.5) & (F.get("bbox", F.lit(2)) - F.get("bbox", F.lit(0)) >= 3)).select("span_id", "loaded_at")


@R.add("flt38_empty_texts", "spans", sql="SELECT span_id, loaded_at FROM spans WHERE type = 'text' AND regexp_replace(coalesce(content, ''), '\\s+', '', 'g') = ''")
def empty_texts(spans: DataFrame) -> DataFrame:
    """Text spans without a text, which are pruned."""
    return spans.where((F.col("type") == "text") & (F.regexp_replace(F.coalesce("content", F.lit("")), r"\s+", "") == "")).select("span_id", "loaded_at")


@R.add("stc20_title_levels", "spans", sql=f"""
SELECT span_id, CASE WHEN page_idx = 0 AND row_number() OVER (PARTITION BY document_name, page_idx ORDER BY block_seq, line_seq, span_seq, span_id) = 1 THEN 1 ELSE 2 END AS level FROM {_SPANS} WHERE block_type = 'title'""")
def title_levels(spans: DataFrame) -> DataFrame:
    """Level one for the title a document begins with, two for the others."""
    s = _once(spans.where("block_type = 'title'"), "document_name", "page_idx", "block_seq", "line_seq", "span_seq")
    w = Window.partitionBy("document_name", "page_idx").orderBy("block_seq", "line_seq", "span_seq", "span_id")
    return s.select("span_id", F.when((F.col("page_idx") == 0) & (F.row_number().over(w) == 1), 1).otherwise(2).alias("level"))


@R.add("agg23_common_height", "spans", sql="""
SELECT document_name, arg_max(h, n * 100000 - h)::INT AS height FROM (SELECT document_name, round(bbox[4] - bbox[2])::INT AS h, count(*) AS n FROM spans WHERE bbox[4] IS NOT NULL AND type = 'text' GROUP BY ALL) GROUP BY 1""")
def common_height(spans: DataFrame) -> DataFrame:
    """The most frequent height of a document's text lines, the least on ties; counted by height before documents meet."""
    height = F.round(F.get("bbox", F.lit(3)) - F.get("bbox", F.lit(1))).cast("int")
    n = spans.where("type = 'text'").select("document_name", height.alias("h")).where("h is not null").groupBy("document_name", "h").agg(F.count("*").alias("n"))
    return n.groupBy("document_name").agg(F.max(F.struct("n", (-F.col("h")).alias("minus"))).alias("m")).select("document_name", (-F.col("m.minus")).alias("height"))


@R.add("agg24_blank_ratios", "table_candidates", sql="""
SELECT table_id, loaded_at, len(cells) AS cells, round(len(list_filter(cells, lambda c: c = '')) / greatest(len(cells), 1), 6) AS blank FROM (
 SELECT table_id, loaded_at, list_transform(regexp_extract_all(html, '(?is)<t[dh][^>]*>(.*?)</t[dh]>', 1), lambda c: trim(regexp_replace(regexp_replace(c, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))) AS cells FROM table_candidates WHERE html IS NOT NULL)""")
def blank_ratios(tables: DataFrame) -> DataFrame:
    """Cells of each table and the share of blank ones."""
    cells = F.regexp_extract_all("html", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))
    bare: Column = F.transform(cells, lambda c: F.regexp_replace(c, r"<[^>]+>|\s+", ""))
    t = tables.where("html is not null").select("table_id", "loaded_at", F.explode(F.array(bare)).alias("c"))
    return t.select("table_id", "loaded_at", F.size("c").cast("bigint").alias("cells"), F.round(F.size(F.filter("c", lambda x: x == "")) / F.greatest(F.size("c"), F.lit(1)), 6).alias("blank"))


@R.add("jon11_table_slots", "table_candidates", "package_assignments", sql="""
WITH a AS (SELECT table_id, count(DISTINCT local_slot) AS slots, arg_max(pkg, struct_pack(a := assigned_at, i := assignment_id)) AS pkg FROM package_assignments WHERE coalesce(trim(pkg), '') <> '' GROUP BY 1)
SELECT DISTINCT t.table_id, CASE WHEN a.slots = 1 THEN a.pkg END AS pkg, CASE WHEN a.slots = 1 THEN 'single_slot' WHEN a.slots > 1 THEN 'several_slots' ELSE 'unresolved' END AS bound FROM table_candidates t LEFT JOIN a USING (table_id)""")
def table_slots(tables: DataFrame, assignments: DataFrame) -> DataFrame:
    """The package of each table that has one slot, by its latest assignment; else why there is none."""
    return tables.select("table_id").distinct().join(bl.single_slots(assignments), "table_id", "left").select("table_id", "pkg", F.coalesce("bound", F.lit("unresolved")).alias("bound"))


@R.add("agg18_document_modes", "package_assignments", sql="""
SELECT document_name, CASE WHEN max(slots) = 1 AND count(DISTINCT pkg) = 1 THEN 'one_package' WHEN max(slots) = 1 THEN 'one_per_table' WHEN min(slots) > 1 THEN 'all_shared' ELSE 'mixed' END AS mode, count(*) AS tables
FROM (SELECT document_name, table_id, count(DISTINCT local_slot) AS slots, max(upper(trim(pkg))) AS pkg FROM package_assignments WHERE coalesce(trim(pkg), '') <> '' GROUP BY 1, 2) GROUP BY 1""")
def document_modes(assignments: DataFrame) -> DataFrame:
    """How the tables of a document share its packages."""
    per = assignments.where("coalesce(trim(pkg), '') <> ''").groupBy("document_name", "table_id").agg(F.count_distinct("local_slot").alias("slots"), F.max(F.upper(F.trim("pkg"))).alias("pkg"))
    least, most = F.min("slots"), F.max("slots")
    mode = F.when((most == 1) & (F.count_distinct("pkg") == 1), "one_package").when(most == 1, "one_per_table").when(least > 1, "all_shared").otherwise("mixed")
    return per.groupBy("document_name").agg(mode.alias("mode"), F.count("*").alias("tables"))


@R.add("src17_object_keys", "parse_results", sql="""
SELECT parse_id, loaded_at, regexp_extract(u, '^s3a?://([^/]+)/?', 1) AS bucket, regexp_extract(u, '^s3a?://[^/]+/(.*)$', 1) AS key FROM (SELECT parse_id, loaded_at, 's3://' || document_name || '/' || coalesce(markdown_file, '') AS u FROM parse_results)""")
def object_keys(results: DataFrame) -> DataFrame:
    """Bucket and key of object addresses."""
    at = bl.bucket_and_key(F.concat(F.lit("s3://"), "document_name", F.lit("/"), F.coalesce("markdown_file", F.lit(""))))
    return results.select("parse_id", "loaded_at", at["bucket"].alias("bucket"), at["key"].alias("key"))
