"""SQL that gives the rows of the operators by the plain rule, for small tables."""

from __future__ import annotations

import unicodedata

from folioforge.functions.width import FULL, HALF
from folioforge.llm.canon import LOOK_ALIKES


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _half(column: str) -> str:
    return f"translate({column}, {_quote(FULL)}, {_quote(HALF)})"


_IGNORED = "[\\x{00AD}\\x{200B}-\\x{200F}\\x{2060}\\x{FE00}-\\x{FE0F}\\x{FEFF}]"
_BLANKS = "[\\x{00A0}\\x{2000}-\\x{200A}\\x{202F}\\x{205F}\\x{3000}]"
_RADICALS = [chr(c) for c in range(0x2F00, 0x2FD6)]
_ONE = {**LOOK_ALIKES, "µ": "μ", "‐": "-", "‑": "-", **{c: unicodedata.normalize("NFKC", c) for c in _RADICALS}}
_MANY = {c: unicodedata.normalize("NFKC", c) for c in "ﬀﬁﬂﬃﬄⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩⅪⅫ"}


def _printed(column: str) -> str:
    bare = f"regexp_replace({column}, {_quote(_IGNORED)}, '', 'g')"
    out = f"translate({_half(bare)}, {_quote(''.join(_ONE))}, {_quote(''.join(_ONE.values()))})"
    for c, x in _MANY.items():
        out = f"replace({out}, {_quote(c)}, {_quote(x)})"
    return f"trim(regexp_replace(nfc_normalize({out}), {_quote(_BLANKS)}, ' ', 'g'))"


P1 = f"""
WITH s AS (SELECT DISTINCT span_id, document_name, page_idx, content, {_printed('content')} AS form FROM spans WHERE content IS NOT NULL)
SELECT a.span_id AS span_id_a, b.span_id AS span_id_b FROM s a JOIN s b ON a.document_name = b.document_name AND a.page_idx = b.page_idx AND a.form = b.form AND a.span_id < b.span_id AND a.content <> b.content"""

def _upper(column: str) -> str:
    return f"upper(regexp_replace({_half(column)}, {_quote(_IGNORED)}, '', 'g'))"


_NO = f"nullif(regexp_replace(regexp_replace(regexp_replace({_upper('pin_no')}, '^\\s*(?:(?:PIN|BALL|TERMINAL|NO|NR)\\b[.\\s]*)+', ''), '[^A-Z0-9]', '', 'g'), '^([A-Z]*)0+([0-9])', '\\1\\2'), '')"
_NAME = f"nullif(translate(regexp_replace(regexp_replace(translate(regexp_replace({_upper('pin_name')}, '(?:\\s*\\(\\d{{1,2}}\\)|[*†‡\\s])+$', ''), '+~', 'PN'), '-$', 'M'), '[^\\p{{L}}\\p{{N}}]', '', 'g'), 'O', '0'), '')"
P3 = f"""
WITH r AS (SELECT DISTINCT pin_id, coalesce(document_name, '') || chr(1) || coalesce(pkg, '') AS scope, {_NO} AS no, {_NAME} AS name FROM pins),
f AS (SELECT * FROM r WHERE no IS NOT NULL AND name IS NOT NULL), k AS (SELECT DISTINCT scope, no, name FROM f),
m AS (SELECT pin_id, scope, no, name FROM f
 UNION ALL SELECT r.pin_id, k.scope, k.no, k.name FROM r JOIN k ON r.scope = k.scope AND r.name = k.name WHERE r.no IS NULL AND (SELECT count(*) FROM k j WHERE j.scope = r.scope AND j.name = r.name) = 1
 UNION ALL SELECT r.pin_id, k.scope, k.no, k.name FROM r JOIN k ON r.scope = k.scope AND r.no = k.no WHERE r.name IS NULL AND (SELECT count(*) FROM k j WHERE j.scope = r.scope AND j.no = r.no) = 1)
SELECT a.pin_id AS pin_id_a, b.pin_id AS pin_id_b FROM m a JOIN m b ON a.scope = b.scope AND a.no = b.no AND a.name = b.name AND a.pin_id < b.pin_id"""

P4 = f"""
WITH a AS (SELECT DISTINCT assignment_id, regexp_extract_all(lower(regexp_replace({_half('pkg')}, {_quote(_IGNORED)}, '', 'g')), 'x2dfn|[a-z]+|[0-9]+') AS t FROM package_assignments WHERE length(pkg) > 0),
d AS (SELECT assignment_id, min(entry_id) AS e FROM a JOIN package_catalog c ON list_contains(t, lower(package_drawing)) GROUP BY 1),
p AS (SELECT assignment_id, min(entry_id) AS e FROM a JOIN package_catalog c ON list_contains(t, lower(package_type)) AND list_contains(t, pin_count) GROUP BY 1)
SELECT a.assignment_id, coalesce(d.e, p.e, -1)::BIGINT AS entry_id FROM a LEFT JOIN d USING (assignment_id) LEFT JOIN p USING (assignment_id)"""

_WORDS = f"list_filter(list_transform(string_split_regex(lower({_half('text')}), '[\\s\\x{{00A0}}\\x{{2002}}\\x{{2007}}\\x{{202F}}]+'), lambda x: regexp_replace(x, '[^\\p{{L}}\\p{{N}}]', '', 'g')), lambda x: x <> '')"
P8 = f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL), iw AS (SELECT item_id, lang, {_WORDS} AS w FROM eval_items),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 10)) AS i FROM dw)), ig AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 10)) AS i FROM iw WHERE lang = 'en')),
ds AS (SELECT doc_id, array_to_string(w, '') AS s FROM dw), zs AS (SELECT item_id, array_to_string(w, '') AS s FROM iw WHERE lang = 'zh'),
dz AS (SELECT DISTINCT doc_id, substr(s, i::INT, 20) AS g FROM (SELECT *, unnest(range(1, length(s) - 18)) AS i FROM ds)), iz AS (SELECT DISTINCT item_id, substr(s, i::INT, 20) AS g FROM (SELECT *, unnest(range(1, length(s) - 18)) AS i FROM zs))
SELECT doc_id, item_id FROM dg JOIN ig USING (g) UNION SELECT doc_id, item_id FROM dz JOIN iz USING (g)"""

ORACLE = {"p1_found": P1, "p3_found": P3, "p4_found": P4, "p8_found": P8}
