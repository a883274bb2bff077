"""Personal data in free text, by how much its terms disclose.

1. Candidates: every text is scanned for stretches that have the form of an
   email address, phone or identity number, postal address or personal name,
   many of which are none (bridge circuits, firmware versions, lot numbers).
2. Corpus statistics: forms that can be nothing else (an address with @, a
   number with a country prefix) are the protected entities. Over all documents
   it is counted how often a term - part of a name candidate, or the word before
   or after a candidate - stands in one segment with a protected entity, and how
   often it stands at all. The disclosure of a term is the information, in
   bits, that it gives about such an entity; a few counts weigh little.
3. Decision: a candidate whose terms together disclose more than the threshold
   is personal data; the text comes out with a typed placeholder in its place.

Statistics and decisions are joins and aggregations over candidates; nothing is
collected, and frequent terms are salted.

Cases: null and empty texts have no rows; of overlapping candidates the sure
ones stay, then the set that discloses most; the same piece twice in a text is
one row of ``found``; texts are read whole.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.session import cut

THRESHOLD = 2.0
CONTEXT = 2.0
PRIOR = 2.0
SALT = 16
PLACEHOLDER = {"person_name": "[PERSON]", "email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "address": "[ADDRESS]"}

_SP = r"(?:[  ]|[ \t]?\r?\n(?!\s*\r?\n))"
_LINE = r"(?:[  ]\r?\n?|\r?\n)"
_DOMAIN = r"[A-Za-z0-9-]{1,40}"
_DOT = r"(?:\.|\s?[\[(]\s?dot\s?[\])]\s?)"
_AT = r"(?:\s?@\s?|\s?[\[(]\s?at\s?[\])]\s?)"
EMAIL = re.compile(rf"(?<![\w.+-])[A-Za-z0-9][\w.+-]{{0,63}}{_AT}{_DOMAIN}(?:{_DOT}{_DOMAIN}){{0,4}}{_DOT}[A-Za-z]{{2,12}}(?![\w-])", re.I | re.A)
NUMBER = re.compile(
    r"(?<![\w+.,/-])(?:\+|(?=[\d(（]))"  # nothing of a longer word or number before it
    r"(?:[(（]\d{2,5}[)）]|\d+)(?:(?:[ .\-/ ]|[ ]?\r?\n)?(?:[(（]\d{2,5}[)）]|\d+)){0,9}(?![\w/%°-])(?!\.\d)"
)
TAGGED_ID = re.compile(r"(?<![\w-])(?:[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z]|[A-Z]{2}\d{7}|[A-Z]\d[A-Z0-9]\d{6}|\d{17}[Xx])(?![\w-])")
#: The groups of digits in which identity and tax numbers are written.
ID_GROUPS = {(3, 2, 4), (2, 3, 3, 3), (1, 2, 2, 2, 3, 3, 2), (18,), (13,)}
PHONE = re.compile(
    r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,5}(?:[ .-]?\d{2,8}){1,5}"
    r"|00[1-9]\d[ -](?:\d{2,5})[ -]\d{2,6}(?:[ -]\d{2,6})?"
    r"|[(（]\d{3,5}[)）][ ]?\d{3,8}(?:[ -]\d{2,6}){0,2}"
    r"|\d{3}([-.])\d{3}\1\d{4}"
    r"|0\d{4} \d{3} \d{3}|0\d{3} \d{6}|0\d{2}[-/]\d{4,8}(?:-\d{3,4})?"
    r"|0\d(?:[ .]\d{2}){4}"
)
_TOWN = r"\p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+){0,2}"
ADDRESS = regex.compile(
    rf"""(?<![\p{{L}}\d.-])(?:
      (?:(?:Unit|Suite|Apt\.?|Flat|Floor|Room){_LINE}\w{{1,5}},{_LINE})?
      (?:P\.\s?O\.{_LINE}Box{_LINE}\d{{1,6}}|\d{{1,5}}[A-Za-z]?{_LINE}(?:\p{{Lu}}[\p{{L}}'’-]+{_LINE}){{1,3}}?(?:\p{{Lu}}\p{{L}}+\.?))
      (?:,{_LINE}(?:Unit|Suite|Apt\.?|Flat|Floor|Room){_LINE}\w{{1,5}})?
      (?:,{_LINE}|\r?\n){_TOWN}(?:,{_LINE}[A-Z]{{2}}{_LINE}\d{{5}}(?:-\d{{4}})?|{_LINE}[A-Z]{{1,2}}\d[A-Z\d]?{_LINE}\d[A-Z]{{2}})
      |\d{{1,4}}(?:{_LINE}(?:bis|ter|quater))?,{_LINE}(?:rue|avenue|allée|chemin|boulevard|place|impasse|quai|route|cours|passage|square){_LINE}[^,\n;:]{{2,30}}(?:\r?\n[^,\n;:]{{1,30}})?,{_LINE}\d{{5}}{_LINE}{_TOWN}
      |\p{{Lu}}[\p{{L}}.-]*(?:{_LINE}\p{{Lu}}[\p{{L}}.-]+){{0,2}}{_LINE}\d{{1,4}}{_SP}?[a-z]?,{_LINE}\d{{5}}{_LINE}{_TOWN}
    )(?![\p{{L}}\d])""",
    regex.X,
)
ADDRESS_ZH = re.compile(r"(?:[一-鿿]{2,3}省)?[一-鿿]{2}市(?:[一-鿿]{2}[区县])?[一-鿿]{1,6}?(?:大道|路|街|巷|弄)\s?\d+号(?:\s?\d+(?:号楼|栋|幢|座))?(?:\s?\d+单元)?(?:\s?\d+(?:室|房))?")
#: What any email and any address with a postcode must hold, looked for first.
_AT_SIGN = re.compile(r"@|[\[(]\s?at\s?[\])]", re.I)
_POSTCODE = re.compile(r"(?<=\s)(?:\d{5}(?!\d)|[A-Z]{1,2}\d[A-Z\d]?\s+\d[A-Z]{2}(?![A-Za-z]))")
#: Forms of address that stand before a name and are no part of it.
TITLES = {"mr", "mrs", "ms", "dr", "prof", "frau", "herr", "herrn", "mme", "mlle", "monsieur", "madame", "sir", "dipl", "ing", "m"}
#: Chinese family names of two characters.
DOUBLE_NAMES = "欧阳 太史 端木 上官 司马 东方 独孤 南宫 万俟 闻人 夏侯 诸葛 尉迟 公羊 赫连 澹台 皇甫 宗政 濮阳 公冶 太叔 申屠 公孙 慕容 仲孙 钟离 长孙 宇文 司徒 鲜于 司空 闾丘 子车 亓官 司寇 巫马 公西 颛孙 壤驷 公良 漆雕 乐正 宰父 谷梁 拓跋 夹谷 轩辕 令狐 段干 百里 呼延 东郭 南门 羊舌 微生 梁丘 左丘 东门 西门 第五".split()
#: The most frequent Chinese family names of one character.
SINGLE_NAMES = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何林罗高郑梁谢宋唐许韩冯邓曹彭曾肖田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈姚卢姜崔钟谭陆汪范金石廖贾夏韦傅方白邹孟熊秦邱江尹薛闫段雷侯龙史陶黎贺顾毛郝龚邵万钱严覃武戴莫孔向汤"
_CAP = r"(?:\p{Lu}[\p{Ll}’']+|\p{Lu}{2,}(?![\p{Ll}_\d]))"
_FAMILY = rf"{_CAP}(?:-\r?\n?{_CAP})*"
_NAME = regex.compile(
    rf"""(?<![\p{{L}}\d_.-])(?:
      (?P<a>(?P<ag>{_CAP}(?:-{_CAP})?){_SP}(?:(?:\p{{Lu}}\.{_SP}?){{1,2}}{_SP}?)?(?P<af>{_FAMILY}))
     |(?P<b>(?:\p{{Lu}}\.{_SP}?){{1,2}}(?P<bf>{_FAMILY}))
     |(?P<c>(?P<cf>{_FAMILY}),{_SP}(?:(?P<cg>{_CAP}(?:-{_CAP})?)(?:{_SP}\p{{Lu}}\.)?|\p{{Lu}}\.))
    )(?![\p{{L}}\d_])""",
    regex.X,
)
_NAME_ZH = re.compile(rf"(?:{'|'.join(DOUBLE_NAMES)})[一-鿿]{{2}}")
_NAME_ZH_SHORT = re.compile(rf"(?=([{SINGLE_NAMES}])([一-鿿]{{1,2}}))")
_CUE_ZH = re.compile(r"(?:联系人|收件人|负责人|审核人|借用人|姓名)[：:]?\s?([一-鿿]{2,3})(?=[，,。；;\s]|$)")
_SEGMENT = re.compile(r"[\r\n]{2,}|(?:\r?\n)(?=[#>|\-])|(?<=[a-zà-ÿ)\d]{2}[.?!])[ ](?=[A-ZÀ-Þ“(])|[。？！]|  +")
_WORD_BEFORE = re.compile(r"([\w.'’-]+[:：]?|[(（|<>/：，,;])\s*$")
_WORD_AFTER = re.compile(r"\s*([\w'’-]+|[^\w\s])")


class Candidate(NamedTuple):
    """A stretch of text that has the form of a kind; ``sure`` where the form alone decides."""

    kind: str
    start: int
    stop: int
    sure: bool
    terms: list[str]


def _low(word: str) -> str:
    return unicodedata.normalize("NFC", word).casefold()


def _context(text: str, start: int, stop: int) -> list[str]:
    before = _WORD_BEFORE.search(text, max(0, start - 30), start)
    after = _WORD_AFTER.match(text, stop)
    return [f"<{_low(before[1]) if before else '^'}", f">{_low(after[1]) if after else '$'}"]


def _groups(number: str) -> tuple[int, ...]:
    return tuple(len(x) for x in re.findall(r"\d+", number))


def _family(name: str) -> list[str]:
    """Terms of a family name: its parts, and their beginnings, which rare names share."""
    parts = [_low(x) for x in re.split(r"-\s*", name)]
    return [*(f"f:{x}" for x in parts), f"p:{parts[0][:4]}"]


def candidates(text: str) -> list[Candidate]:
    """All candidates of a text, overlapping ones included."""
    out: list[Candidate] = []
    if _AT_SIGN.search(text):
        for m in EMAIL.finditer(text):
            out.append(Candidate("email", m.start(), m.end(), True, []))
    for m in TAGGED_ID.finditer(text):
        out.append(Candidate("id_number", m.start(), m.end(), True, _context(text, m.start(), m.end())))
    for m in NUMBER.finditer(text):
        number = m[0].rstrip(" .-/")
        stop = m.start() + len(number)
        digits = sum(map(str.isdigit, number))
        if not 8 <= digits <= 18:
            continue
        flat = re.sub(r"[\r\n ]+", " ", number).replace("  ", " ")
        groups, context = _groups(flat), _context(text, m.start(), stop)
        if PHONE.fullmatch(flat):
            out.append(Candidate("phone", m.start(), stop, True, context))
        elif groups in ID_GROUPS and not re.search(r"[./()]", flat):
            out.append(Candidate("id_number", m.start(), stop, True, context))
        elif len(groups) == 1 and digits <= 13:
            out.append(Candidate("number", m.start(), stop, False, context))
    if _POSTCODE.search(text):
        out += [Candidate("address", m.start(), m.end(), True, []) for m in ADDRESS.finditer(text)]
    if "号" in text:
        out += [Candidate("address", m.start(), m.end(), True, []) for m in ADDRESS_ZH.finditer(text)]
    for m in _NAME.finditer(text, overlapped=True):
        if m["a"]:
            if _low(m["ag"]) in TITLES or _low(m["af"]) in TITLES:
                continue
            kind, terms = "a", [f"g:{_low(m['ag'])}", *_family(m["af"])]
        elif m["b"]:
            rest = text[m.end() : m.end() + 30]
            if regex.match(rf"[  ]{_CAP}(?![\p{{L}}\d_])", rest):
                continue  # the letter is a form of address before a whole name
            kind, terms = "b", _family(m["bf"])
        else:
            kind, terms = "c", [*_family(m["cf"]), *([f"g:{_low(m['cg'])}"] if m["cg"] else [])]
        lines = m[0].count("\n")
        if lines and (lines > 1 or text[text.rfind("\n", 0, m.start()) + 1 : m.start() + 1].lstrip()[:1] in "#|>-"):
            continue  # a heading or a table row doesn't run on
        if kind == "b" and regex.search(r"(?:\d\s?|°)$", text[max(0, m.start() - 3) : m.start()]):
            continue  # the letter is a unit
        caps = [x for x in re.findall(r"\b[A-Z]{2,}\b", text[max(0, m.start() - 30) : m.end() + 30])]
        if m[0].isupper() and len(caps) > 4:
            continue  # a text in capitals
        out.append(Candidate(f"name {kind}", m.start(), m.end(), False, [*terms, *_context(text, m.start(), m.end())]))
    for m in _NAME_ZH.finditer(text):
        out.append(Candidate("name z", m.start(), m.end(), False, [f"z:{m[0][:2]}", f"z2:{m[0][2:]}"]))
    for m in _NAME_ZH_SHORT.finditer(text):
        for stop in range(m.start() + 2, m.end(2) + 1):
            around = [f"<{text[max(0, m.start() - 2) : m.start()]}", f">{text[stop : stop + 2]}"]
            out.append(Candidate("name s", m.start(), stop, False, [f"z:{m[1]}", *(f"z1:{x}" for x in text[m.start() + 1 : stop]), *around]))
    for m in _CUE_ZH.finditer(text):
        out.append(Candidate("name z", m.start(1), m.end(1), False, [f"<{text[m.start():m.start(1)].rstrip('：: ')}"]))
    return out


def _bounds(text: str) -> list[int]:
    return [m.end() for m in _SEGMENT.finditer(text)] + [len(text) + 1]


_SCHEMA = "k {kind}, no int, kind string, start int, stop int, sure boolean, protected boolean, terms array<string>, item string"


def scan(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per candidate: key, kind, place, terms, and whether its segment holds a protected entity besides it."""
    kind = df.schema[key].dataType.simpleString()
    names = ["k", "no", "kind", "start", "stop", "sure", "protected", "terms", "item"]
    types = [None, pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.list_(pa.string()), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key_type = batch.schema.field(0).type
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                rows: list[tuple] = []
                for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if k is None or not t:
                        continue
                    found = candidates(t)
                    if not found:
                        continue
                    ends = _bounds(t) if any(c.sure for c in found) else []
                    segment = [bisect_right(ends, c.start) for c in found]
                    held: dict[int, list[int]] = {}
                    for i, c in enumerate(found):
                        if c.sure:
                            held.setdefault(segment[i], []).append(i)
                    for i, c in enumerate(found):
                        others = any(j != i for j in held.get(segment[i], ()))
                        rows.append((k, i, c.kind, c.start, c.stop, c.sure, others, c.terms, t[c.start : c.stop]))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[i] or key_type) for i in range(len(names))], names=names)

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null").mapInArrow(run, _SCHEMA.format(kind=kind))


def _bits(n: str, hit: str, base: float) -> Column:
    """Information, in bits, of a term met ``n`` times, ``hit`` of them with what is asked for; ``PRIOR`` counts at the base rate are added."""
    return F.log2((F.col(hit) + PRIOR * base) / (F.col(n) + PRIOR) / base)


def _rate(df: DataFrame, hit: Column) -> float:
    share = df.agg(F.avg(hit.cast("double"))).first()[0]
    return min(0.5, max(1e-3, share or 1e-3))


def name_disclosure(names: DataFrame, base: float) -> DataFrame:
    """(term, bits) of the terms of name candidates (k, no, terms, hit): what a term tells about a hit, against the rate ``base``."""
    return names.select(F.explode("terms").alias("term"), "hit").groupBy("term").agg(F.count("*").alias("n"), F.sum(F.col("hit").cast("bigint")).alias("hits")).select("term", _bits("n", "hits", base).alias("bits"))


def number_disclosure(numbers: DataFrame) -> DataFrame:
    """(term, as_kind, bits) of words before a number: what they tell about phone and identity numbers."""
    beside = numbers.select(F.explode(F.filter("terms", lambda x: x.startswith("<"))).alias("term"), "kind")
    kinds = ("phone", "id_number")
    counts = beside.groupBy("term").agg(F.count("*").alias("n"), *[F.sum((F.col("kind") == k).cast("bigint")).alias(k) for k in kinds])
    rates = {k: _rate(numbers, F.col("kind") == k) for k in kinds}
    return counts.select("term", F.explode(F.array(*[F.struct(F.lit(k).alias("as_kind"), _bits("n", k, rates[k]).alias("bits")) for k in kinds])).alias("x")).select("term", "x.*")


def _salted(scores: DataFrame) -> DataFrame:
    return scores.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))


def _salt() -> Column:
    return F.pmod(F.hash("k", "no"), F.lit(SALT))


def judge_names(names: DataFrame, base: float) -> DataFrame:
    """(k, no, bits): the sum of the bits of a candidate's terms, less those against it (``against``).

    The words around a candidate can speak for it, up to ``CONTEXT`` bits each;
    only its own words can speak against it.
    """
    own = F.col("bits")
    scores = _salted(name_disclosure(names, base).withColumn("bits", F.when(F.col("term").rlike("^[<>]"), F.least(F.greatest(own, F.lit(0.0)), F.lit(CONTEXT))).otherwise(own)))
    terms = names.select("k", "no", "against", F.explode("terms").alias("term")).withColumn("salt", _salt())
    return terms.join(scores, ["term", "salt"]).groupBy("k", "no").agg((F.sum("bits") - F.first("against")).alias("bits"))


def _part(mark: str) -> Column:
    return F.get(F.filter("terms", lambda x: x.startswith(mark)), F.lit(0))


def fixed_phrases(names: DataFrame, base: float) -> DataFrame:
    """(given, phrase): first parts that only ever stand with one second part, and the bits against their being names.

    The bits grow with the number of different surroundings, so that copies of one
    text count once, and reach at most what a term can say for a name.
    """
    rows = names.select(_part("g:").alias("given"), _part("f:").alias("family"), F.struct(_part("<"), _part(">")).alias("around")).where("given is not null").distinct()
    pairs = rows.groupBy("given").agg(F.count_distinct("around").alias("n"), F.min("family").alias("low"), F.max("family").alias("high"))
    return pairs.where("n >= 3 and low = high").select("given", F.least(F.log2("n"), F.lit(-math.log2(base))).alias("phrase"))


def _against(names: DataFrame, phrases: DataFrame) -> DataFrame:
    """``names`` with the bits of their phrase, if any; the join is salted."""
    salted = names.withColumn("given", _part("g:")).withColumn("salt", _salt())
    return salted.join(_salted(phrases), ["given", "salt"], "left").drop("given", "salt")


def decide(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The accepted candidates: (k, kind, start, stop, item, bits), overlaps resolved.

    Names are judged twice: first by the protected entities beside them, then by
    how often their terms belong to names that the first judgement accepted.
    """
    names = found.where("kind like 'name %'").select("k", "no", "kind", "terms", F.col("protected").alias("hit"))
    firm = F.col("kind") != "name s"  # the many short stretches of Chinese text don't set the rates
    total = names.where(firm).count()
    base = _rate(names.where(firm), F.col("hit"))
    against = F.when(F.col("hit"), 0.0).otherwise(F.coalesce("phrase", F.lit(0.0)))
    names = cut(_against(names, fixed_phrases(names, base)).withColumn("against", against).drop("phrase"))
    first = judge_names(names, base).select("k", "no", (F.col("bits") >= threshold).alias("hit"))
    second = cut(names.drop("hit").join(first, ["k", "no"]))
    accepted = second.where(firm & F.col("hit")).count()
    judged_names = judge_names(second, min(0.5, max(1e-3, accepted / max(total, 1)))).where(F.col("bits") >= threshold).withColumn("as_kind", F.lit("person_name"))
    numbers = found.where("kind in ('phone', 'id_number', 'number')").select("k", "no", "kind", "terms")
    scores = _salted(number_disclosure(numbers))
    judged_numbers = (
        numbers.where("kind = 'number'").select("k", "no", F.explode(F.filter("terms", lambda x: x.startswith("<"))).alias("term")).withColumn("salt", _salt())
        .join(scores, ["term", "salt"]).groupBy("k", "no").agg(F.max(F.struct("bits", "as_kind")).alias("best"))
        .select("k", "no", F.col("best.bits").alias("bits"), F.col("best.as_kind").alias("as_kind")).where("bits > 0")
    )
    taken = found.where("not sure").join(judged_names.unionByName(judged_numbers), ["k", "no"]).select("k", F.col("as_kind").alias("kind"), "start", "stop", "item", "bits")
    sure = found.where("sure").select("k", "kind", "start", "stop", "item", F.lit(None).cast("double").alias("bits"))
    return resolve(sure.unionByName(taken))


def choose(every: list[dict]) -> list[dict]:
    """Of the stretches of one text a set without overlaps: sure ones first, then those that disclose most in all."""
    kept, end = [], 0
    for c in sorted((c for c in every if c["bits"] is None), key=lambda c: (c["start"], -c["stop"])):
        if c["start"] >= end:
            kept.append(c)
            end = c["stop"]
    stops = [s["stop"] for s in kept]

    def apart(c: dict) -> bool:
        next_ = bisect_right(stops, c["start"])  # the first sure one that ends behind the start
        return next_ == len(kept) or kept[next_]["start"] >= c["stop"]

    free = sorted((c for c in every if c["bits"] is not None and apart(c)), key=lambda c: (c["stop"], c["start"]))
    ends = [c["stop"] for c in free]
    best: list[tuple[float, int]] = [(0.0, -1)]
    for i, c in enumerate(free):
        before = bisect_right(ends, c["start"], 0, i)
        with_it = best[before][0] + c["bits"]
        best.append((with_it, before) if with_it > best[i][0] else (best[i][0], -1))
    i = len(free)
    while i:
        if best[i][1] >= 0:
            kept.append(free[i - 1])
            i = best[i][1]
        else:
            i -= 1
    return kept


def resolve(taken: DataFrame) -> DataFrame:
    """``choose`` for every text."""
    per_text = taken.groupBy("k").agg(F.collect_list(F.struct("start", "stop", "kind", "item", "bits")).alias("all"))
    kind = taken.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, c["kind"], c["start"], c["stop"], c["item"], c["bits"]) for k, every in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for c in choose(every)]
            types = [batch.schema.field(0).type, pa.string(), pa.int32(), pa.int32(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["k", "kind", "start", "stop", "item", "bits"])

    return per_text.mapInArrow(run, f"k {kind}, kind string, start int, stop int, item string, bits double")


def find_personal(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, kind, item_text, start, stop, bits) of all personal data in the texts."""
    found = decide(cut(scan(df, key, text)), threshold)
    return found.select(F.col("k").alias(key), "kind", F.col("item").alias("item_text"), "start", "stop", "bits")


def sanitise(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with typed placeholders in the place of personal data; all else stays, null texts included."""
    kind = df.schema[key].dataType.simpleString()
    spans = find_personal(df, key, text, threshold).groupBy(F.col(key).alias("k")).agg(F.array_sort(F.collect_list(F.struct("start", "stop", "kind"))).alias("spans"))
    both = df.select(F.col(key).alias("k"), F.col(text).alias("t")).join(spans, "k", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for t, every in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if t and every:
                    parts, at = [], 0
                    for s in every:
                        parts += [t[at : s["start"]], PLACEHOLDER[s["kind"]]]
                        at = s["stop"]
                    t = "".join([*parts, t[at:]])
                texts.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["k", "t"])

    return both.mapInArrow(run, f"k {kind}, t string").withColumnRenamed("k", key).withColumnRenamed("t", text)
