"""Queries of the scalar functions, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions import geometry as geo
from folioforge.functions import ranges
from folioforge.functions import text as tx
from folioforge.functions.width import full_to_half
from folioforge.plans.registry import Registry

R = Registry()
_SQUEEZE = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
_UNESCAPE = "replace(replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&')"
_CELLS = "SELECT table_id, unnest(regexp_extract_all(html, '<t[dh][^>]*>((?s:.*?))</t[dh]>', 1)) AS cell FROM table_candidates"


def _cells(tables: DataFrame) -> DataFrame:
    return tables.select("table_id", F.explode(F.regexp_extract_all("html", F.lit("<t[dh][^>]*>((?s:.*?))</t[dh]>"), F.lit(1))).alias("cell"))


@R.add("str01_plain_text", "table_candidates", sql=f"""
SELECT table_id, {_SQUEEZE.format(_UNESCAPE.format("regexp_replace(regexp_replace(cell, '<br\\s*/?>', ' ', 'gi'), '<[^>]+>', ' ', 'g')"))} AS text FROM ({_CELLS}) t""")
def plain_text(tables: DataFrame) -> DataFrame:
    """Every table cell as one line of text."""
    return _cells(tables).select("table_id", tx.plain_text(F.col("cell")).alias("text"))


@R.add("str02_cell_text", "table_candidates", sql=f"""
SELECT table_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(cell, '<br\\s*/?>', chr(10), 'gi'), chr(10)),
  lambda x: {_SQUEEZE.format(_UNESCAPE.format("regexp_replace(x, '<[^>]+>', ' ', 'g')"))}), lambda x: x <> ''), chr(10)) AS text FROM ({_CELLS}) t""")
def cell_text(tables: DataFrame) -> DataFrame:
    """Every table cell with its explicit line breaks."""
    return _cells(tables).select("table_id", tx.cell_text(F.col("cell")).alias("text"))


@R.add("str03_cell_lines", "table_candidates", sql=f"""
SELECT table_id, len(list_filter(list_transform(string_split(regexp_replace(cell, '<br\\s*/?>', chr(10), 'gi'), chr(10)), lambda x: trim(x)), lambda x: x <> ''))::INT AS lines,
  count(*) AS cells FROM ({_CELLS}) t GROUP BY ALL""")
def cell_lines(tables: DataFrame) -> DataFrame:
    """Number of explicit lines of the cells of each table."""
    return _cells(tables).select("table_id", F.size(tx.cell_lines(F.col("cell"))).alias("lines")).groupBy("table_id", "lines").agg(F.count("*").alias("cells"))


_FIRST_ROW = "SELECT table_id, unnest(regexp_extract_all(regexp_extract(html, '<tr[^>]*>((?s:.*?))</tr>', 1), '<t[dh][^>]*>((?s:.*?))</t[dh]>', 1)) AS header FROM table_candidates"
_HEADER_FORM = _SQUEEZE.format("regexp_replace(regexp_replace(regexp_replace(lower({}), '\\[[^\\]]*\\]', '', 'g'), '[$\\\\^†‡*]', '', 'g'), '[_/-]', ' ', 'g')")


def _headers(tables: DataFrame) -> DataFrame:
    row = F.regexp_extract("html", "<tr[^>]*>((?s:.*?))</tr>", 1)
    return tables.select("table_id", F.explode(F.regexp_extract_all(row, F.lit("<t[dh][^>]*>((?s:.*?))</t[dh]>"), F.lit(1))).alias("header"))


@R.add("str04_header_form", "table_candidates", sql=f"SELECT {_HEADER_FORM.format('header')} AS header, count(*) AS n FROM ({_FIRST_ROW}) t GROUP BY ALL")
def header_form(tables: DataFrame) -> DataFrame:
    """Normalised headers and how often they stand."""
    return _headers(tables).groupBy(tx.header_form(F.col("header")).alias("header")).agg(F.count("*").alias("n"))


@R.add("str05_strip_footnotes", "pins", sql="SELECT pin_id, trim(regexp_replace(pin_name, '\\(\\s*\\d+(\\s*,\\s*\\d+)*\\s*\\)', '', 'g')) AS name FROM pins")
def strip_footnotes(pins: DataFrame) -> DataFrame:
    """Names without footnote marks."""
    return pins.select("pin_id", tx.strip_footnotes(F.col("pin_name")).alias("name"))


@R.add("str06_compact_form", "spans", sql="SELECT span_id, regexp_replace(lower(content), '[^a-z0-9\\x{4e00}-\\x{9fff}]+', '', 'g') AS form FROM spans WHERE content IS NOT NULL")
def compact_form(spans: DataFrame) -> DataFrame:
    """Contents as their letters, digits and Chinese characters."""
    return spans.where("content is not null").select("span_id", tx.compact_form(F.col("content")).alias("form"))


@R.add("str07_margin_form", "spans", sql=f"""
SELECT span_id, regexp_replace({_SQUEEZE.format('lower(content)')}, '^[\\s\\-–—|·.,:;]+|[\\s\\-–—|·.,:;]+$', '', 'g') AS form FROM spans WHERE block_type = 'text' AND content IS NOT NULL""")
def margin_form(spans: DataFrame) -> DataFrame:
    """Text lines in the form in which margins are compared."""
    return spans.where("block_type = 'text' and content is not null").select("span_id", tx.margin_form(F.col("content")).alias("form"))


@R.add("str08_word_characters", "table_candidates", sql="SELECT table_id, regexp_replace(lower(regexp_replace(html, '<[^>]+>', ' ', 'g')), '[^\\p{L}\\p{N}_]+', '', 'g') AS form FROM table_candidates")
def word_characters(tables: DataFrame) -> DataFrame:
    """The visible word characters of a table, for likeness."""
    return tables.select("table_id", tx.word_characters(F.regexp_replace("html", "<[^>]+>", " ")).alias("form"))


@R.add("str09_group_titles", "table_candidates", sql="""
SELECT table_id, array_to_string(list_filter(list_transform(string_split(group_context, chr(10)), lambda x: trim(regexp_replace(regexp_replace(trim(x), '^#{1,6}\\s+', ''), '^\\d{1,2}(\\.\\d{1,3}){0,4}\\.?\\s+', ''))), lambda x: x <> ''), ' > ') AS path
FROM table_candidates WHERE group_context IS NOT NULL""")
def group_titles(tables: DataFrame) -> DataFrame:
    """The titles above a table without hashes and numbers, as one path."""
    parts = F.filter(F.transform(F.split("group_context", "\n"), tx.heading_title), lambda x: x != "")
    return tables.where("group_context is not null").select("table_id", F.array_join(parts, " > ").alias("path"))


@R.add("str10_clean_name", "pins", sql="""
SELECT pin_id, coalesce(nullif(trim(regexp_replace(regexp_replace(pin_name, '\\s*\\(continued\\)\\s*$', '', 'i'), '\\s*\\(\\d+\\)\\s*$', '')), ''), 'Reserved') AS name FROM pins""")
def clean_name(pins: DataFrame) -> DataFrame:
    """Pin names; Reserved where there is none."""
    return pins.select("pin_id", tx.clean_name(F.col("pin_name")).alias("name"))


@R.add("str11_full_to_half", "spans", sql="""
SELECT span_id, translate(content, array_to_string(list_transform(range(33, 127), lambda i: chr((i + 65248)::INT)), '') || chr(12288), array_to_string(list_transform(range(33, 127), lambda i: chr(i::INT)), '') || ' ') AS content
FROM spans WHERE content IS NOT NULL""")
def half_width(spans: DataFrame) -> DataFrame:
    """Contents with ASCII in the place of full-width forms."""
    return spans.where("content is not null").select("span_id", full_to_half(F.col("content")).alias("content"))


@R.add("str12_unique_stems", "parse_results", sql="""
WITH s AS (SELECT parse_id, loaded_at, lower(regexp_replace(markdown_file, '\\.[^.]*$', '')) AS stem FROM parse_results)
SELECT parse_id, loaded_at, stem || CASE WHEN row_number() OVER w > 1 THEN '_' || row_number() OVER w ELSE '' END AS stem FROM s WINDOW w AS (PARTITION BY stem ORDER BY parse_id, loaded_at)""")
def unique_stems(parses: DataFrame) -> DataFrame:
    """File stems made different by a number from the second on."""
    from pyspark.sql import Window

    s = parses.select("parse_id", "loaded_at", F.lower(F.regexp_replace("markdown_file", r"\.[^.]*$", "")).alias("stem"))
    n = F.row_number().over(Window.partitionBy("stem").orderBy("parse_id", "loaded_at"))
    return s.select("parse_id", "loaded_at", F.concat("stem", F.when(n > 1, F.concat(F.lit("_"), n)).otherwise("")).alias("stem"))


@R.add("str14_markdown_escape", "pins", sql="SELECT pin_id, regexp_replace(pin_name, '([*_`~$])', '\\\\\\1', 'g') AS name FROM pins WHERE pin_name NOT LIKE '%\\%'")
def markdown_escape(pins: DataFrame) -> DataFrame:
    """Names as Markdown text (these names hold no backslash, so the plain SQL is enough)."""
    return pins.where(~F.col("pin_name").contains("\\")).select("pin_id", tx.markdown_escape(F.col("pin_name")).alias("name"))


@R.add("str15_inline_math", "spans", sql="SELECT span_id, regexp_replace('at <eq>' || content || '</eq> end', '(?s)<eq>(.*?)</eq>', '$\\1$', 'g') AS text FROM spans WHERE type = 'interline_equation'")
def inline_math(spans: DataFrame) -> DataFrame:
    """Equation spans as inline formulas of a sentence."""
    return spans.where("type = 'interline_equation'").select("span_id", tx.inline_math(F.concat(F.lit("at <eq>"), "content", F.lit("</eq> end"))).alias("text"))


@R.add("str17_ligatures", "spans", sql="""
SELECT span_id, replace(replace(replace(replace(replace(content, 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl') AS content FROM spans WHERE regexp_matches(content, '[ﬀﬁﬂﬃﬄ]')""")
def ligatures(spans: DataFrame) -> DataFrame:
    """Contents with ligatures, written out."""
    return spans.where(F.col("content").rlike("[ﬀﬁﬂﬃﬄ]")).select("span_id", tx.unligature(F.col("content")).alias("content"))


@R.add("str18_hashes", "documents", sql="SELECT doc_id, md5(text) AS md5, upper(md5(text)) AS md5_upper, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL")
def hashes(docs: DataFrame) -> DataFrame:
    """Digests of the texts."""
    return docs.where("text is not null").select("doc_id", F.md5("text").alias("md5"), F.upper(F.md5("text")).alias("md5_upper"), F.sha2("text", 256).alias("sha256"))


@R.add("str20_undo_confusion", "pins")
def undo_confusion(pins: DataFrame) -> DataFrame:
    """Names with a digit inside letters read as the letter it looks like."""
    name = F.col("pin_name")
    return pins.where(tx.starts_alike(name)).select("pin_id", "pin_name", tx.undo_confusion(name).alias("read_as"))


@R.add("str21_glued_parts", "pins", sql="""
WITH g AS (SELECT pin_id, regexp_replace(pin_no || coalesce(lead(pin_no) OVER (PARTITION BY document_name, pkg ORDER BY pin_id, loaded_at), ''), '\\s', '', 'g') AS glued FROM pins WHERE pin_no IS NOT NULL)
SELECT pin_id, CASE WHEN array_to_string(regexp_extract_all(glued, '[A-Z]{1,2}[0-9]{1,2}'), '') = glued AND len(regexp_extract_all(glued, '[A-Z]{1,2}[0-9]{1,2}')) > 1 THEN array_to_string(regexp_extract_all(glued, '[A-Z]{1,2}[0-9]{1,2}'), ' ') ELSE glued END AS parts FROM g""")
def glued_parts(pins: DataFrame) -> DataFrame:
    """Neighbouring numbers written together, and parted again."""
    from pyspark.sql import Window

    after = F.lead("pin_no").over(Window.partitionBy("document_name", "pkg").orderBy("pin_id", "loaded_at"))
    g = pins.where("pin_no is not null").select("pin_id", F.regexp_replace(F.concat("pin_no", F.coalesce(after, F.lit(""))), r"\s", "").alias("glued"))
    return g.select("pin_id", F.array_join(tx.glued_parts(F.col("glued")), " ").alias("parts"))


_LINES = "SELECT doc_id, unnest(string_split(replace(text, chr(13), ''), chr(10))) AS line FROM documents WHERE text IS NOT NULL"


def _lines(docs: DataFrame) -> DataFrame:
    return docs.where("text is not null").select("doc_id", F.explode(F.split(F.replace("text", F.lit("\r"), F.lit("")), "\n")).alias("line"))


@R.add("str24_headings", "documents", sql=f"""
SELECT doc_id, level, trim(regexp_replace(regexp_replace(trim(line), '^#{{1,6}}\\s+', ''), '^\\d{{1,2}}(\\.\\d{{1,3}}){{0,4}}\\.?\\s+', '')) AS title FROM (
  SELECT doc_id, line, CASE WHEN regexp_matches(trim(line), '^#{{1,6}}\\s+\\S') THEN length(regexp_extract(trim(line), '^(#+)', 1))
    WHEN regexp_matches(trim(line), '^第[0-9一二三四五六七八九十百]+章|^(?i:chapter)\\s+\\d+') THEN 1
    WHEN regexp_matches(trim(line), '^\\d{{1,2}}(\\.\\d{{1,3}}){{0,4}}\\.?\\s+[A-Z]') THEN len(string_split(regexp_extract(trim(line), '^(\\d{{1,2}}(?:\\.\\d{{1,3}})*)', 1), '.')) END::INT AS level FROM ({_LINES}) t) WHERE level IS NOT NULL""")
def headings(docs: DataFrame) -> DataFrame:
    """Section headings of the documents with their level."""
    line = F.col("line")
    return _lines(docs).select("doc_id", tx.heading_level(line).alias("level"), tx.heading_title(line).alias("title")).where("level is not null")


@R.add("str25_package_parts", "package_assignments", sql="""
SELECT assignment_id, upper(regexp_extract(pkg, '([A-Za-z][A-Za-z0-9]*[A-Za-z])', 1)) AS family,
 CASE WHEN regexp_extract(pkg, '(?i)(\\d{1,4})\\s*-?\\s*(?:pin|ball|lead|L\\b)', 1) <> '' THEN regexp_extract(pkg, '(?i)(\\d{1,4})\\s*-?\\s*(?:pin|ball|lead|L\\b)', 1) ELSE regexp_extract(pkg, '[A-Za-z]\\s*-\\s*(\\d{1,4})(?:\\D|$)', 1) END AS pins
FROM package_assignments WHERE pkg IS NOT NULL""")
def package_parts(rows: DataFrame) -> DataFrame:
    """Family and pin count of package names."""
    pkg = F.col("pkg")
    return rows.where("pkg is not null").select("assignment_id", tx.package_family(pkg).alias("family"), tx.package_pins(pkg).alias("pins"))


@R.add("str26_named_in", "table_candidates", sql="""
SELECT table_id, (instr(t, n) > 0 AND length(n) > 0 AND NOT regexp_matches(substr(t, instr(t, n)::INT - 1, 1), '[a-z0-9]') AND NOT regexp_matches(substr(t, (instr(t, n) + length(n))::INT, 1), '[a-z0-9]')) AS named FROM (
 SELECT table_id, ' ' || lower(html) || ' ' AS t, lower(regexp_extract(title, '\\. (\\S+)', 1)) AS n FROM table_candidates WHERE title IS NOT NULL)""")
def named_in(tables: DataFrame) -> DataFrame:
    """Whether the first word of a table's title stands in the table."""
    word = F.regexp_extract("title", r"\. (\S+)", 1)
    return tables.where("title is not null").select("table_id", tx.named_in(F.col("html"), word).alias("named"))


@R.add("str28_protect_values", "spans", sql="""
SELECT span_id, regexp_replace(content || ' ', '(\\d) ((?:[kMGmµun]?(?:V|A|W|Hz|F|H|s|Ω)|°C|%)[^A-Za-z0-9_])', '\\1' || chr(160) || '\\2', 'g') AS text FROM spans WHERE regexp_matches(content, '\\d (V|A|mA|kHz|MHz|%)')""")
def protect_values(spans: DataFrame) -> DataFrame:
    """Numbers tied to their units by a no-break space."""
    return spans.where(F.col("content").rlike(r"\d (V|A|mA|kHz|MHz|%)")).select("span_id", tx.protect_values(F.concat("content", F.lit(" "))).alias("text"))


@R.add("str30_equation_tag", "spans", sql="SELECT span_id, content || '\\tag{' || regexp_replace('(' || page_idx || ')', '^[\\s(（]+|[\\s)）]+$', '', 'g') || '}' AS formula FROM spans WHERE type = 'interline_equation'")
def equation_tag(spans: DataFrame) -> DataFrame:
    """Equations tagged with a number."""
    return spans.where("type = 'interline_equation'").select("span_id", tx.equation_tag(F.col("content"), F.concat(F.lit("("), "page_idx", F.lit(")"))).alias("formula"))


@R.add("str16_language", "documents", sql="""
SELECT doc_id, CASE WHEN l > 0 THEN CASE WHEN z * 10 >= l THEN 'zh' ELSE 'en' END END AS script FROM (
 SELECT doc_id, length(regexp_replace(text, '[^\\x{4e00}-\\x{9fff}]', '', 'g')) AS z, length(regexp_replace(text, '[^\\p{L}]', '', 'g')) AS l FROM documents WHERE text IS NOT NULL)""")
def language(docs: DataFrame) -> DataFrame:
    """Script of a text by its share of Chinese characters."""
    return docs.where("text is not null").select("doc_id", tx.cjk_language(F.col("text")).alias("script"))


@R.add("arr07_slot_names", "pins", sql="""
SELECT pin_id, CASE WHEN c < 26 THEN chr(97 + c) WHEN c < 702 THEN chr((97 + (c - 26) // 26)::INT) || chr(97 + (c - 26) % 26) ELSE chr((97 + (c - 702) // 676)::INT) || chr((97 + (c - 702) // 26 % 26)::INT) || chr(97 + (c - 702) % 26) END AS slot
FROM (SELECT pin_id, (pin_id % 2000)::INT AS c FROM pins)""")
def slot_names(pins: DataFrame) -> DataFrame:
    """Running numbers as letters."""
    return pins.select("pin_id", tx.slot_name((F.col("pin_id") % 2000).cast("int")).alias("slot"))


@R.add("arr01_split_numbers", "pin_rows")
def split_numbers(rows: DataFrame) -> DataFrame:
    """All values of the number cells, ranges written out, with their place."""
    return rows.select("row_id", "loaded_at", F.posexplode(ranges.split_and_expand(F.col("pin_no"))).alias("pos", "value"))


@R.add("arr02_bracket_ranges", "part", sql="""
SELECT p_partkey, list_transform(CASE WHEN a <= b THEN range(a, b + 1) ELSE list_reverse(range(b, a + 1)) END, lambda n: 'L' || n || '_x') AS v
FROM (SELECT p_partkey, p_size AS a, (50 - p_size) AS b FROM part WHERE p_size <> 25)""")
def bracket_ranges(part: DataFrame) -> DataFrame:
    """Bracket ranges made from the sizes of parts, both ways."""
    cell = F.concat(F.lit("L["), "p_size", F.lit(":"), 50 - F.col("p_size"), F.lit("]_x"))
    return part.where("p_size <> 25").select("p_partkey", ranges.expand_bracketed(cell).alias("v"))


@R.add("arr03_number_ranges", "part", sql="SELECT p_partkey, list_transform(range(p_size, p_size + 4), lambda n: lpad(n::VARCHAR, 3, '0')) AS v FROM part WHERE p_size < 90")
def number_ranges(part: DataFrame) -> DataFrame:
    """Padded number ranges made from the sizes of parts."""
    pad = lambda c: F.lpad(c.cast("string"), 3, F.lit("0"))
    return part.where("p_size < 90").select("p_partkey", ranges.expand_numbers(F.concat(pad(F.col("p_size")), F.lit(" - "), pad(F.col("p_size") + 3))).alias("v"))


@R.add("arr04_lettered_ranges", "part", sql="SELECT p_partkey, list_transform(range(p_size, p_size + 4), lambda n: 'A' || n) AS v FROM part")
def lettered_ranges(part: DataFrame) -> DataFrame:
    """Ranges with the same letter on both sides."""
    return part.select("p_partkey", ranges.expand_lettered(F.concat(F.lit("A"), "p_size", F.lit("-a"), F.col("p_size") + 3)).alias("v"))


@R.add("arr06_pair_names", "pin_rows", sql=None)
def pair_names(rows: DataFrame) -> DataFrame:
    """Numbers paired with the explicit lines of the name cell where these are as many."""
    numbers, names = ranges.split_and_expand(F.col("pin_no")), tx.cell_lines(F.col("pin_name"))
    pairs = F.when(F.size(names) == F.size(numbers), F.zip_with(numbers, names, lambda a, b: F.struct(a.alias("number"), b.alias("name")))).otherwise(F.transform(numbers, lambda n: F.struct(n.alias("number"), F.col("pin_name").alias("name"))))
    return rows.where("pin_name is not null").select("row_id", "loaded_at", F.explode(pairs).alias("p")).select("row_id", "loaded_at", "p.number", "p.name")


_BOXES = "SELECT a.span_id AS id_a, b.span_id AS id_b, a.bbox AS p, b.bbox AS q FROM (SELECT * FROM spans WHERE line_seq = 0) a JOIN (SELECT * FROM spans WHERE line_seq = 0) b ON a.document_name = b.document_name AND a.page_idx = b.page_idx AND a.block_seq + 1 = b.block_seq"


def _box_pairs(spans: DataFrame) -> DataFrame:
    s = spans.where("line_seq = 0").select("document_name", "page_idx", "block_seq", "span_id", "bbox")
    b = s.select("document_name", "page_idx", (F.col("block_seq") - 1).alias("block_seq"), F.col("span_id").alias("id_b"), F.col("bbox").alias("q"))
    return s.withColumnsRenamed({"span_id": "id_a", "bbox": "p"}).join(b, ["document_name", "page_idx", "block_seq"])


@R.add("mth01_overlaps", "spans", sql=f"""
WITH b AS ({_BOXES}), m AS (SELECT *, greatest(least(p[3], q[3]) - greatest(p[1], q[1]), 0) AS w, greatest(least(p[4], q[4]) - greatest(p[2], q[2]), 0) AS h, (p[3] - p[1]) * (p[4] - p[2]) AS sp, (q[3] - q[1]) * (q[4] - q[2]) AS sq FROM b)
SELECT id_a, id_b, round(w * h / (sp + sq - w * h), 9) AS iou, round(w * h / least(sp, sq), 9) AS of_smaller, round(w * h / sp, 9) AS of_first,
 round(w / least(p[3] - p[1], q[3] - q[1]), 9) AS x_overlap, round(h / least(p[4] - p[2], q[4] - q[2]), 9) AS y_overlap FROM m""")
def overlaps(spans: DataFrame) -> DataFrame:
    """Overlap measures of neighbouring blocks."""
    p, q = geo.Box.of(F.col("p")), geo.Box.of(F.col("q"))
    r = lambda c: F.round(c, 9)
    return _box_pairs(spans).select("id_a", "id_b", r(geo.iou(p, q)).alias("iou"), r(geo.overlap_of_smaller(p, q)).alias("of_smaller"), r(geo.overlap_of_first(p, q)).alias("of_first"), r(geo.x_overlap(p, q)).alias("x_overlap"), r(geo.y_overlap(p, q)).alias("y_overlap"))


@R.add("mth02_distances", "spans", sql=f"""
WITH b AS ({_BOXES}) SELECT id_a, id_b, round(sqrt(pow(greatest(p[1] - q[3], q[1] - p[3], 0), 2) + pow(greatest(p[2] - q[4], q[2] - p[4], 0), 2)), 6) AS edge,
 round(sqrt(pow((p[1] + p[3] - q[1] - q[3]) / 2, 2) + pow((p[2] + p[4] - q[2] - q[4]) / 2, 2)), 6) AS centre, (p[1] <= q[1] AND p[2] <= q[2] AND p[3] >= q[3] AND p[4] >= q[4]) AS inside FROM b""")
def distances(spans: DataFrame) -> DataFrame:
    """Edge and centre distances of neighbouring blocks."""
    p, q = geo.Box.of(F.col("p")), geo.Box.of(F.col("q"))
    return _box_pairs(spans).select("id_a", "id_b", F.round(geo.edge_distance(p, q), 6).alias("edge"), F.round(geo.centre_distance(p, q), 6).alias("centre"), geo.contains(p, q).alias("inside"))


@R.add("mth04_thousandths", "spans", sql="""
SELECT span_id, trunc(bbox[1] * 1000 / page_size[1])::INT AS x0, trunc(bbox[2] * 1000 / page_size[2])::INT AS y0, trunc(bbox[3] * 1000 / page_size[1])::INT AS x1, trunc(bbox[4] * 1000 / page_size[2])::INT AS y1,
 greatest(abs(bbox[1]), abs(bbox[2]), abs(bbox[3]), abs(bbox[4])) <= 1.5 AS unit FROM spans""")
def thousandths(spans: DataFrame) -> DataFrame:
    """Boxes on a grid of a thousand, and whether they are given in page shares."""
    box, w, h = geo.Box.of(F.col("bbox")), F.get("page_size", F.lit(0)), F.get("page_size", F.lit(1))
    names = ("x0", "y0", "x1", "y1")
    return spans.select("span_id", *[c.alias(n) for c, n in zip(geo.to_thousandths(box, w, h), names)], geo.is_unit(box).alias("unit"))


@R.add("dat01_serial_dates", "events", sql="SELECT event_id, (DATE '1899-12-30' + (40000 + event_id % 9000)::INT)::VARCHAR AS day FROM events")
def serial_dates(events: DataFrame) -> DataFrame:
    """Spreadsheet serial numbers as ISO dates."""
    return events.select("event_id", F.date_add(F.lit("1899-12-30").cast("date"), (40000 + F.col("event_id") % 9000).cast("int")).cast("string").alias("day"))


@R.add("dat02_retention", "parse_results", sql="SELECT parse_id, loaded_at, parsed_at < (SELECT max(parsed_at) FROM parse_results) - INTERVAL 30 DAY AS expired FROM parse_results")
def retention(parses: DataFrame) -> DataFrame:
    """Parses that are older than thirty days before the newest one."""
    newest = parses.agg(F.max("parsed_at")).first()[0]
    return parses.select("parse_id", "loaded_at", (F.col("parsed_at") < F.lit(newest) - F.expr("interval 30 days")).alias("expired"))


@R.add("jsn02_fenced_json", "events", sql="SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def fenced_json(events: DataFrame) -> DataFrame:
    """A value of JSON that is wrapped in a code fence and prose."""
    reply = F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```\nDone."))
    inner = F.regexp_extract(reply, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    return events.select("event_id", F.get_json_object(inner, "$.k").alias("k"))
