"""String functions on columns: cells, headers, titles, names, codes. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The entities that cells are written with.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}
BREAK = r"(?i)<br\s*/?>"


def _replace_all(c: Column, pairs: dict[str, str]) -> Column:
    for old, new in pairs.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def strip(c: Column) -> Column:
    """Without blanks of any kind at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of blanks as one, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def unescape(c: Column) -> Column:
    return _replace_all(c, ENTITIES)


def plain_text(c: Column) -> Column:
    """Cell markup as one line of text."""
    return squeeze(unescape(F.regexp_replace(F.regexp_replace(c, BREAK, " "), "<[^>]+>", " ")))


def cell_lines(c: Column) -> Column:
    """The explicit lines of a cell, without empty ones."""
    parts = F.split(F.regexp_replace(c, BREAK, "\n"), "\n")
    return F.filter(F.transform(parts, lambda x: squeeze(unescape(F.regexp_replace(x, "<[^>]+>", " ")))), lambda x: x != "")


def cell_text(c: Column) -> Column:
    """Cell markup as text that keeps its line breaks."""
    return F.array_join(cell_lines(c), "\n")


def strip_footnotes(c: Column) -> Column:
    """A header without its ``(1)`` and ``(1, 2)`` marks."""
    return F.trim(F.regexp_replace(c, r"\(\s*\d+(\s*,\s*\d+)*\s*\)", ""))


def header_form(c: Column) -> Column:
    """Lower case, without bracketed notes and marks; joining characters as blanks."""
    s = F.regexp_replace(F.lower(c), r"\[[^\]]*\]", "")
    s = F.regexp_replace(s, "[$\\\\^†‡*]", "")
    return squeeze(F.regexp_replace(s, "[_/-]", " "))


def compact_form(c: Column) -> Column:
    """Only Latin letters, digits and Chinese characters, in lower case."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9\\x{4e00}-\\x{9fff}]+", "")


def margin_form(c: Column) -> Column:
    """A margin line for comparison: one-line lower case without marks at the ends."""
    return F.regexp_replace(squeeze(F.lower(c)), r"^[\s\-–—|·.,:;]+|[\s\-–—|·.,:;]+$", "")


def word_characters(c: Column) -> Column:
    """The letters, digits and underscores of a text."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", "")


def clean_name(c: Column, default: str = "Reserved") -> Column:
    """A pin name without its footnote and continuation marks; ``default`` where nothing is left."""
    s = F.regexp_replace(F.regexp_replace(c, r"(?i)\s*\(continued\)\s*$", ""), r"\s*\(\d+\)\s*$", "")
    return F.coalesce(F.nullif(F.trim(s), F.lit("")), F.lit(default))


def markdown_escape(c: Column) -> Column:
    r"""``* _ ` ~ $`` with a backslash, unless an odd number of backslashes already stands before."""
    return F.regexp_replace(c, r"(?<!\\)((?:\\\\)*)([*_`~$])", r"$1\\$2")


def inline_math(c: Column) -> Column:
    """``<eq>`` elements as inline formulas."""
    return F.regexp_replace(c, "(?s)<eq>(.*?)</eq>", r"\$$1\$")


def unligature(c: Column) -> Column:
    return _replace_all(c, LIGATURES)


def heading_level(c: Column) -> Column:
    """Level of a section heading: Markdown hashes, chapter words, or the parts of its number; null for other lines."""
    s = F.trim(c)
    return (
        F.when(s.rlike(r"^#{1,6}\s+\S"), F.length(F.regexp_extract(s, r"^(#+)", 1)))
        .when(s.rlike(r"^第[0-9一二三四五六七八九十百]+章|^(?i:chapter)\s+\d+"), F.lit(1))
        .when(s.rlike(r"^\d{1,2}(\.\d{1,3}){0,4}\.?\s+[A-Z]"), F.size(F.split(F.regexp_extract(s, r"^(\d{1,2}(?:\.\d{1,3})*)", 1), r"\.")))
    )


def heading_title(c: Column) -> Column:
    """A heading without hashes and number."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), r"^#{1,6}\s+", ""), r"^\d{1,2}(\.\d{1,3}){0,4}\.?\s+", ""))


def package_family(c: Column) -> Column:
    """Letters of a package name before its pin count."""
    return F.upper(F.regexp_extract(c, r"([A-Za-z][A-Za-z0-9]*[A-Za-z])", 1))


def package_pins(c: Column) -> Column:
    """Pin count of a package name: ``TSSOP-14``, ``8-pin PW``, ``14L SOIC``; '' if there is none."""
    direct = F.regexp_extract(c, r"(?i)(\d{1,4})\s*-?\s*(?:pin|ball|lead|L\b)", 1)
    after = F.regexp_extract(c, r"[A-Za-z]\s*-\s*(\d{1,4})(?:\D|$)", 1)
    return F.when(direct != "", direct).otherwise(after)


def named_in(text: Column, name: Column) -> Column:
    """Whether ``name`` stands in ``text`` as a whole word, in any case; no pattern is built from data."""
    t, n = F.concat(F.lit(" "), F.lower(text), F.lit(" ")), F.lower(name)
    at = F.instr(t, n)
    before, after = F.substring(t, at - 1, F.lit(1)), F.substring(t, at + F.length(n), F.lit(1))
    return (at > 0) & (F.length(n) > 0) & ~before.rlike("[a-z0-9]") & ~after.rlike("[a-z0-9]")


def protect_values(c: Column) -> Column:
    """The blank inside short values (``5 V``, ``10 MHz``) as a no-break space."""
    return F.regexp_replace(c, r"(\d) (?=(?:[kMGmµun]?(?:V|A|W|Hz|F|H|s|Ω)|°C|%)(?:\W|$))", "$1 ")


def equation_tag(formula: Column, number: Column) -> Column:
    """A formula with its number as tag."""
    return F.concat(formula, F.lit("\\tag{"), F.regexp_replace(number, r"^[\s(（]+|[\s)）]+$", ""), F.lit("}"))


def glued_parts(c: Column) -> Column:
    """Codes written together (``H2H1``, ``D11B10``) as their parts; one part where the text isn't wholly made of such codes."""
    parts = F.regexp_extract_all(c, F.lit("[A-Z]{1,2}[0-9]{1,2}"), F.lit(0))
    return F.when((F.array_join(parts, "") == c) & (F.size(parts) > 1), parts).otherwise(F.array(c))


def starts_alike(c: Column) -> Column:
    """Whether a name shows the marks of one-for-I and zero-for-O confusion inside letters."""
    return c.rlike("[A-Za-z][01][A-Za-z]|^[01][A-Za-z]{2}|[A-Za-z]{2}[01]$")


def undo_confusion(c: Column) -> Column:
    """One as I and zero as O where letters stand on both sides or the whole is one character."""
    s = F.regexp_replace(F.regexp_replace(c, "(?<=[A-Za-z])0(?=[A-Za-z])", "O"), "(?<=[A-Za-z])1(?=[A-Za-z])", "I")
    return F.when(c == "1", "I").when(c == "0", "O").when(c == "二", "—").otherwise(s)


def join_kind(left: Column, right: Column) -> Column:
    """How two lines of a paragraph join: ``glue`` (hyphen falls before lower case), ``none`` (Chinese), ``blank``."""
    return (
        F.when(left.rlike(r"[A-Za-z][-\x{ad}\x{2010}]\s*$") & right.rlike(r"^\s*[a-z]"), "glue")
        .when(left.rlike("[\\x{4e00}-\\x{9fff}\\x{3000}-\\x{303f}]\\s*$"), "none")
        .otherwise("blank")
    )


def cjk_language(c: Column) -> Column:
    """``zh`` where Chinese characters are at least a tenth of the letters, else ``en``; null for no letters."""
    chinese, letters = F.regexp_count(c, F.lit("[\\x{4e00}-\\x{9fff}]")), F.regexp_count(c, F.lit("[\\p{L}]"))
    return F.when(letters > 0, F.when(chinese * 10 >= letters, "zh").otherwise("en"))


def slot_name(c: Column) -> Column:
    """0, 1, ... as a, b, ..., z, aa, ab, ... (up to three letters)."""
    letter = lambda x: F.char(F.lit(97) + x)
    one, two = F.lit(26), F.lit(26 + 26 * 26)
    return (
        F.when(c < one, letter(c))
        .when(c < two, F.concat(letter(F.floor((c - 26) / 26)), letter((c - 26) % 26)))
        .otherwise(F.concat(letter(F.floor((c - two) / 676)), letter(F.floor((c - two) / 26) % 26), letter((c - two) % 26)))
    )
