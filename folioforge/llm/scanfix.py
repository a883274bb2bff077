"""Noise in text from scanned pages: furniture, broken words, misread characters.

1. Vocabulary: the tokens of all spans and tables are counted; words (and
   hyphenated compounds) that make up at least ``SHARE`` of all tokens are the
   vocabulary of every task: at most ``1 / SHARE`` of them. Rarer words stay in the
   table of counts; the few tokens that the vocabulary can't decide on are
   joined with it: one that is a confusion of a word ``RATIO`` times as frequent is misread.
2. Lines of a page are labelled header, body or break by a hidden Markov model
   over layout symbols (place on the page, type of block, whether the line is
   nothing but a page number). Its parameters start from what the states mean
   and are re-estimated by Baum-Welch on all pages: each round sums up expected
   counts in the tasks, over the different sequences of symbols and their pages.
3. In one pass over the pages, body lines are joined: a hyphen at a line's end is
   noise unless the compound is in the vocabulary; tokens outside the
   vocabulary that become a word of it by undoing confusions of shape are misread.
   Words broken over pages meet by a join of page ends with page starts.
4. Rows of tables are furniture if a Markov chain of the words of the header
   lines found in 2 accepts them.

Pages are spread by (document, page), so a document of any size is worked on in
parallel, and nothing of it has to fit into one task.

Cases: null contents stay out; spans without a box count as the middle of the
page; pages with a single line and documents with a single page have no running
line; re-delivered rows count once; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.width import full_to_half, strip_ignorables
from folioforge.llm.canon import LOOK_ALIKES
from folioforge.session import cut

SHARE = 2e-5
LEAST = 3
RATIO = 20
#: Rounds of Baum-Welch, the parts of one that expected counts are rounded to (sums fit 63 bits up to 10**11 lines), and the lines that are worked on side by side.
ROUNDS = 3
UNIT = 2**26
CELLS = 100_000
PAGES_A_BLOCK = 256
HEADER, BODY, BREAK = 0, 1, 2
#: Confusions of shape, as (seen, meant), all in lower case.
CONFUSIONS = [
    ("c", "e"), ("f", "t"), ("o", "a"), ("1", "i"), ("1", "l"), ("5", "s"), ("0", "o"), ("u", "n"), ("ii", "u"), ("ii", "n"), ("cl", "d"), ("d", "cl"), ("|", "l"), ("|", "i"),
    ("b", "h"), ("h", "b"), ("6", "b"), ("8", "b"), ("9", "g"), ("6", "g"), ("vv", "w"), ("rn", "m"), ("m", "rn"), ("v", "y"), ("i", "l"), ("l", "i"), ("n", "u"), ("e", "c"),
    ("a", "o"), ("t", "f"), ("2", "z"), ("i", "t"), ("ri", "n"), ("nn", "m"), ("q", "g"),
    ("0", "a"), ("6", "h"), ("i1", "u"), ("1i", "u"), ("i1", "n"), ("1i", "n"), ("c1", "d"), ("c|", "d"), ("i|", "u"), ("|i", "u"), ("||", "ll"), ("11", "ll"),
]
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
_TOKEN = r"[\p{L}\p{N}|]+(?:-[\p{L}\p{N}|]+)*"
WORD = re.compile(r"[^\W_]+(?:\|+[^\W_]+)*\|?|\|[^\W_]+(?:\|+[^\W_]+)*")
_MARK = "-­¬‐‑"
_MARKS = frozenset(_MARK)
_BROKEN = re.compile(rf"([^\W\d_]+(?:-[^\W\d_]+)*)[{_MARK}]\s*$")
_SENTENCE_END = re.compile(r"[.!?:;。！？：；][\W_]*$")
_FIRST = re.compile(r"\s*([^\W\d_]+(?:-[^\W\d_]+)*)")
_NUMBER = r"[0-9lI|OoSBZ]{1,6}"
PAGE_NO = re.compile(rf"[\W_]*(?:(?:page|seite|p\.|s\.|第)\s*)?(?P<n>[ivxlc]{{1,7}}|{_NUMBER})\s*(?:(?:of|von|sur|de|/)\s*(?P<m>{_NUMBER}))?\s*(?:页)?[\W_]*", re.I)
#: A character that no page-number line has.
_NO_PAGE_NO = r"[hjkmqwyHJKMQWY\x{4e00}-\x{7b2b}\x{7b2d}-\x{9874}\x{9876}-\x{9fff}]"
_ROMAN = re.compile(r"(?=.)c{0,3}(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})")
_ID = re.compile(r"[A-Z]{2,4}\d{3,}\w*(?:-\w+)?")
_LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
_NO_WORD = re.compile(r"\d+|[a-z]{1,4}\d{1,3}[a-z]?|[a-z]{2,4}\d{3,}\w*|\d+[a-z]{1,2}|.")
TEXT_TYPES = ("text",)
RARE_LETTERS = 4


#: Anything but ASCII, Latin letters with accents, dashes, Chinese characters and a few signs. The intersection comes first: a negated class with all of it is twenty times slower on the JVM.
_ODD = r"[\x{80}-\x{10FFFF}&&[^°¬µΩÀ-ÿ\x{2013}-\x{2026}\x{3001}\x{3002}\x{4e00}-\x{9fff}]]"


def _plainly(c: Column) -> Column:
    """Look-alikes, widths, hyphens, blanks and ligatures spelled plainly."""
    s = F.translate(strip_ignorables(full_to_half(c)), "".join(LOOK_ALIKES) + "‑‐\u00a0\u2002\u2007\u202f", "".join(LOOK_ALIKES.values()) + "--    ")
    for seen, meant in LIGATURES.items():
        s = F.replace(s, F.lit(seen), F.lit(meant))
    return s


def readable(c: Column) -> Column:
    """A line spelled plainly; the soft hyphen at its end stays as a mark. Only lines with unusual characters are rewritten."""
    return F.when(c.rlike(_ODD), _plainly(F.regexp_replace(c, "\\x{00AD}\\s*$", "¬"))).otherwise(c)


def table_text(c: Column) -> Column:
    """A table spelled plainly; soft hyphens before a break in a cell stay as marks."""
    return F.when(c.rlike(_ODD), _plainly(F.regexp_replace(c, "\\x{00AD}(\\s*(?:<br\\s*/?>|\\n))", "¬$1"))).otherwise(c)


def counted(texts: DataFrame) -> DataFrame:
    """(token, n) of ``texts`` (text), in lower case."""
    return cut(texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_TOKEN), F.lit(0))).alias("token")).groupBy("token").agg(F.count("*").alias("n")))


def word_counts(counts: DataFrame) -> DataFrame:
    """(token, n) with compounds taken apart."""
    return counts.select(F.explode(F.split("token", "-")).alias("token"), "n").where("token <> ''").groupBy("token").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """(words, compounds) that reach ``SHARE`` of all tokens, compounds a fifth of it; at most ``1 / SHARE`` and ``5 / SHARE``."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST, total * SHARE)
    compounds = counts.where(F.col("token").contains("-") & (F.col("n") >= max(LEAST, least / 5))).select(F.lit(True).alias("compound"), "token")
    both = word_counts(counts).where(F.col("n") >= least).select(F.lit(False).alias("compound"), "token").unionByName(compounds).collect()
    return frozenset(r.token for r in both if not r.compound), frozenset(r.token for r in both if r.compound)


def rare_misreads(counts: DataFrame, words: frozenset[str]) -> DataFrame:
    """(token, meant) of tokens outside of the vocabulary that are a confusion of a word outside of it, ``RATIO`` times as frequent."""
    given = counts.sparkSession.sparkContext.broadcast(words)

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(given.value, frozenset())
        for batch in batches:
            out = [(t, n, e) for t, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t not in reader.words and reader.meant(t) is None for e in {t, *(e for e, _ in reader._edits(t))}]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate((pa.string(), pa.int64(), pa.string()))], names=["token", "n", "edit"])

    made = cut(word_counts(counts).where(F.length("token") >= RARE_LETTERS).mapInArrow(edits, "token string, n bigint, edit string"))
    own = made.where("token = edit").select(F.col("token").alias("edit"), F.col("n").alias("m")).where((F.col("m") >= LEAST) & ~F.col("edit").rlike("[0-9|]"))
    return made.where("token <> edit").join(own, "edit").where(F.col("m") >= RATIO * F.col("n")).groupBy("token").agg(F.max_by("edit", F.struct("m", "edit")).alias("meant"))


class Reader:
    """Decides on words, with a memory of what it has decided."""

    def __init__(self, words: frozenset[str], compounds: frozenset[str]) -> None:
        self.words, self.compounds = words, compounds
        self.inner = {f"{a}-{b}" for c in compounds for a, b in itertools.pairwise(c.split("-"))}
        self.longest = max(map(len, words), default=0)
        self._known: dict[str, str | None] = {}
        self._fine: set[str] = set()
        self._right: set[str] = set()
        self._rare: set[str] = set()
        self._by_first: dict[str, list[tuple[str, str]]] = {}
        for seen, meant in CONFUSIONS:
            self._by_first.setdefault(seen[0], []).append((seen, meant))

    def meant(self, token: str) -> str | None:
        """The word of the vocabulary that a token was misread from; None if it is read right or unknown."""
        low = token.lower()
        if low in self.words:
            return None
        if low not in self._known:
            if len(self._known) > 500_000:
                self._known.clear()
            self._known[low] = self._repair(low)
        return self._known[low]

    def misread(self, tokens: list[str]) -> list[tuple[str, str]]:
        """(token, meant) of the misread ones; meant is None for words that the table of counts has to decide on."""
        fine, out = self._fine, []
        if fine.issuperset(tokens):
            return out
        for t in tokens:
            if t in fine:
                continue
            if meant := self.meant(t):
                out.append((t, meant))
            elif self.is_rare(t):
                out.append((t, None))
            else:
                if len(fine) > 500_000:
                    fine.clear()
                fine.add(t)
        return out

    def is_rare(self, token: str) -> bool:
        """A word of letters outside of the vocabulary."""
        low = token.lower()
        return len(low) >= RARE_LETTERS and low not in self.words and low.isalpha() and _LETTERS.fullmatch(low) is not None

    def doubtful(self, head: str, tail: str) -> tuple[str, str] | None:
        """(word, compound) that the table of counts has to decide between, where ``broken`` said no only because both halves are words."""
        head, tail = head.lower(), tail.lower()
        last, first = head.split("-")[-1], tail.split("-")[0]
        if f"{head}-{tail}" in self.compounds or f"{last}-{first}" in self.inner:
            return None
        return last + first, f"{head}-{tail}"

    def wrong_pieces(self, pieces: Iterable[str]) -> list[tuple[str, str]]:
        """``misread`` over the tokens of pieces of text that end at blanks or tags; pieces once found right aren't split again."""
        right, out = self._right, []
        for piece in set(pieces) - right:
            if wrong := self.misread(WORD.findall(piece)):
                out += wrong
            else:
                if len(right) > 500_000:
                    right.clear()
                right.add(piece)
        return out

    def _edits(self, word: str, start: int = 0) -> Iterator[tuple[str, int]]:
        for i in range(start, len(word)):
            for seen, meant in self._by_first.get(word[i], ()):
                if word.startswith(seen, i):
                    yield word[:i] + meant + word[i + len(seen) :], i + len(meant)

    def _repair(self, low: str) -> str | None:
        if len(low) > self.longest + 2 or _NO_WORD.fullmatch(low) or sum(map(str.isalpha, low)) * 2 < len(low):
            return None
        once = list(self._edits(low))
        for word, _ in once:
            if word in self.words and len(word) > 1 and not word.isdigit():
                return word
        if len(low) >= 5:
            for word, at in once:
                for again, _ in self._edits(word, at):
                    if again in self.words:
                        return again
        return None

    def broken(self, head: str, tail: str) -> bool:
        """Whether ``head-`` and ``tail`` are one word, not a compound with its own hyphen."""
        head, tail = head.lower(), tail.lower()
        last, first = head.split("-")[-1], tail.split("-")[0]
        if last + first in self.words or self.meant(last + first):
            return True
        last, first = self.meant(last) or last, self.meant(first) or first
        if f"{head}-{tail}" in self.compounds or f"{last}-{first}" in self.inner:
            return False
        both = last in self.words and first in self.words and len(first) > 2 and len(last) > 2
        return not both


def wrong_number(text: str) -> bool:
    """Whether the number of a page-number line has a letter in the place of a digit."""
    m = PAGE_NO.fullmatch(text.strip())
    if not m:
        return False
    for n in (m["n"], m["m"]):
        if n and not n.isdigit() and not (n.islower() and n != "l" and _ROMAN.fullmatch(n)):
            return True
    return False


# ---- hidden Markov model over layout symbols

PLACES, KINDS = 22, 4


def symbols(y: np.ndarray, kind: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Symbol of a line: percent of the height at the margins (one place for the middle), group of block types, page number or not."""
    percent = np.clip(np.nan_to_num(y * 100, nan=50.0), 0, 99.9).astype(np.int64)
    place = np.where(percent < 10, percent, np.where(percent >= 90, percent - 79, 10))
    return (place * KINDS + kind) * 2 + number


def kind_of(block_type: str | None) -> int:
    """Group of block types: running text and headings, captions and notes, lists, others."""
    if block_type is None or block_type in ("text", "title"):
        return 0
    return 1 if "caption" in block_type or "footnote" in block_type else 2 if block_type == "list" else 3


def _side_by_side(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(lines of each page, the pages as rows of one grid)."""
    size = np.array([len(p) for p in pages])
    grid = np.zeros((len(pages), int(size.max())), np.int64)
    for i, p in enumerate(pages):
        grid[i, : len(p)] = p
    return size, grid


class Model:
    """Start, transition and emission probabilities of the three states."""

    def __init__(self) -> None:
        n = PLACES * KINDS * 2
        emit = np.full((3, n), 1e-4)
        place = np.arange(n) // (KINDS * 2)
        kind, number = np.arange(n) // 2 % KINDS, np.arange(n) % 2
        margin = (place < 6) | (place > 14)
        emit[HEADER, margin & (kind == 0) & (number == 0)] = 1.0
        emit[BREAK, margin & (kind == 0) & (number == 1)] = 1.0
        emit[BODY, place == 10] = 1.0
        emit[BODY, (place > 5) & (place < 15)] = 0.3
        emit[BODY, margin & (kind != 0)] = 0.1
        never = (kind == 1) | (place == 10)  # captions and notes, and the middle of a page, are never furniture
        emit[HEADER, never] = emit[BREAK, never] = 0.0
        emit[BODY, kind == 1] += 0.1
        self.emit = emit / emit.sum(1, keepdims=True)
        self.start = np.array([0.6, 0.3, 0.1])
        self.move = np.array([[0.1, 0.6, 0.3], [0.05, 0.9, 0.05], [0.3, 0.5, 0.2]])

    def expected(self, pages: list[np.ndarray], times: np.ndarray) -> np.ndarray:
        """Counts of starts, moves and emissions expected in pages, each taken ``times``: one row of whole numbers of ``1 / UNIT``, so sums don't depend on their order."""
        size, grid = _side_by_side(pages)
        width, grid = grid.shape[1], grid.T
        live = np.arange(width)[:, None] < size[None]  # (line, page)
        seen = self.emit[:, grid].transpose(1, 0, 2) * live[:, None]  # (line, state, page)
        alpha, beta, scale = np.zeros_like(seen), np.ones_like(seen), np.ones(grid.shape)
        for t in range(width):
            row = ((alpha[t - 1][:, None] * self.move[:, :, None]).sum(0) if t else self.start[:, None]) * seen[t]
            scale[t] = np.where(live[t], row.sum(0), 1.0)
            alpha[t] = row / scale[t]
        start, move, emit = np.zeros(3, np.int64), np.zeros((3, 3), np.int64), np.zeros(self.emit.shape, np.int64)
        for t in range(width - 2, -1, -1):
            on, ahead = live[t + 1], seen[t + 1] * beta[t + 1]
            beta[t] = np.where(on, (self.move[:, :, None] * ahead[None]).sum(1) / scale[t + 1], 1.0)
            x = alpha[t][:, None] * self.move[:, :, None] * ahead[None]
            move += (np.rint(x / np.where(on, x.sum((0, 1)), 1.0) * UNIT).astype(np.int64) * times).sum(2)
        gamma = alpha * beta
        gamma = np.rint(gamma / np.where(live, gamma.sum(1), 1.0)[:, None] * UNIT).astype(np.int64) * times
        start += gamma[0].sum(1)
        for state in range(3):
            np.add.at(emit[state], grid[live], gamma[:, state][live])
        return np.concatenate([start, move.ravel(), emit.ravel()])

    def revised(self, prior: np.ndarray, counts: np.ndarray) -> Model:
        """The model of expected counts as ``expected`` gives them (in ones) and of ``prior`` counts of emissions; starts and moves as they were count as ten lines."""
        n = self.emit.size
        out = Model()
        start, move, emit = self.start * 10 + counts[:3], self.move * 10 + counts[3:12].reshape(3, 3), prior + counts[12 : 12 + n].reshape(self.emit.shape)
        out.start, out.move, out.emit = start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True)
        return out

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi for many pages at once, the pages side by side."""
        if not pages:
            return []
        size, grid = _side_by_side(pages)
        width = grid.shape[1]
        emit, move = np.log(np.maximum(self.emit, 1e-300)), np.log(self.move)
        score = np.log(self.start)[None] + emit[:, grid[:, 0]].T
        back = np.zeros((width, len(pages), 3), np.int8)
        for t in range(1, width):
            step = score[:, :, None] + move[None]
            back[t] = step.argmax(1)
            new = step.max(1) + emit[:, grid[:, t]].T
            live = (t < size)[:, None]
            score = np.where(live, new, score)
            back[t] = np.where(live, back[t], np.arange(3, dtype=np.int8)[None])
        state = score.argmax(1)
        out = np.zeros((width, len(pages)), np.int8)
        for t in range(width - 1, -1, -1):
            out[t] = state
            state = back[t][np.arange(len(pages)), state]
        return [out[: size[i], i] for i in range(len(pages))]


# ---- pages

_OUT = pa.schema([("tag", pa.string()), ("id", pa.int64()), ("doc", pa.string()), ("page", pa.int32()), ("block", pa.int32()), ("a", pa.string()), ("b", pa.string()), ("pos", pa.int32())])
_OUT_DDL = "tag string, id bigint, doc string, page int, block int, a string, b string, pos int"


def read_page(reader: Reader, doc: str, page: int, rows: list[tuple], states: np.ndarray) -> list[tuple]:
    """Findings of one page. rows: (id, block, line, type, text, number-form), in reading order.

    Tags: ``running`` (a: band, b: text), ``page_no``, ``misread``, ``hyphen``;
    ``open`` for a word broken at the page's end (a: head), ``runon`` for a last line
    in the middle of a sentence, ``begin`` for the
    first line of the page's running text (a: its first word, if that can be the
    rest of a broken one), ``maybe`` if that word looks misread unless it is such a
    rest, ``rare`` for a word (a) and ``perhaps`` for a broken one (a: whole, b: as
    compound) that the table of counts decides on, ``text`` for a repaired body line.
    """
    out: list[tuple] = []
    pending: tuple | None = None  # (id, block, head) of a broken word
    last: tuple | None = None  # (id, block, text) of the last line of running text
    began = False
    body: list[list] = []
    for (id_, block, _line, kind, text, number, low), state in zip(rows, states):
        if state == BREAK or state == HEADER and number:
            out.append(("page_no", id_, doc, page, block, None, None))
            if wrong_number(text):
                out.append(("misread", id_, doc, page, block, None, None))
            continue
        if state == HEADER:
            tokens = WORD.findall(text)
            out.append(("running", id_, doc, page, block, "top" if low < 0.5 else "bottom", text))
            if len(tokens) > 1 and re.fullmatch(r"[\dlI|O]{1,4}", tokens[-1]) and not tokens[-1].isdigit() and re.search(r"Rev\W+\w\s+\S+$", text):
                out.append(("misread", id_, doc, page, block, None, None))
                continue
            wrong = reader.misread(tokens)
            if any(m for _, m in wrong):
                out.append(("misread", id_, doc, page, block, None, None))
            else:
                out += [("rare", id_, doc, page, block, t.lower(), None) for t, _ in wrong]
            continue
        end = _BROKEN.search(text) if text.rstrip()[-1:] in _MARKS else None
        skip = 0
        if pending and kind in TEXT_TYPES:
            first = _FIRST.match(text)
            if first and (block == pending[1] or first[1][0].islower()):
                head, tail = pending[2], first[1]
                skip = 1
                if reader.broken(head, tail):
                    out.append(("hyphen", pending[0], doc, page, pending[1], None, None))
                    last, begin = head.split("-")[-1], tail.split("-")[0]
                    whole = reader.meant(last + begin)
                    if whole:
                        at = next((i for i, (x, y) in enumerate(zip((last + begin).lower(), whole)) if x != y), len(last))
                        out.append(("misread", pending[0] if at < len(last) else id_, doc, page, block, None, None))
                    if body and body[-1][0] == pending[0]:
                        body[-1][2] = text_cut(body[-1][2]) + (whole or last + begin)
                        body[-1][3] = True
                        text = text[first.end() - len(tail) + len(begin) :]
                        skip = 0
                else:
                    if either := reader.doubtful(head, tail):
                        out.append(("perhaps", pending[0], doc, page, pending[1], *either))
                    for t, where in ((head.split("-")[-1], pending[0]), (tail.split("-")[0], id_)):
                        if reader.meant(t):
                            out.append(("misread", where, doc, page, block, None, None))
                pending = None
        if kind in TEXT_TYPES and not began:
            began = True
            first = _FIRST.match(text)
            lower = bool(first and first[1][0].islower() and not skip)
            out.append(("begin", id_, doc, page, block, first[1] if lower else None, None))
            if lower:
                if reader.meant(word := WORD.search(text)[0]):
                    skip = 1
                    out.append(("maybe", id_, doc, page, block, word, None))
        wrong = reader.wrong_pieces(text.split())
        if wrong:
            tokens = WORD.findall(text)
            wrong = reader.misread(tokens[skip : len(tokens) - 1 if end else len(tokens)])
        sure = [x for x in wrong if x[1]]
        if wrong and not sure:
            out += [("rare", id_, doc, page, block, t.lower(), None) for t, _ in wrong]
        if sure:
            out.append(("misread", id_, doc, page, block, None, None))
            for t, meant in sure:
                text = text.replace(t, meant.capitalize() if t[0].isupper() else meant, 1)
        if kind in TEXT_TYPES:
            pending = (id_, block, end[1]) if end else pending
            last = (id_, block, text)
        body.append([id_, block, text, False])
    if pending:
        out.append(("open", pending[0], doc, page, pending[1], pending[2], None))
    elif last and not _SENTENCE_END.search(last[2]):
        out.append(("runon", last[0], doc, page, last[1], None, None))
    for id_, block, text, glued in body:
        out.append(("text", id_, doc, page, block, text, "glue" if glued else ""))
    return out


def text_cut(text: str) -> str:
    """A line without the broken word at its end."""
    m = _BROKEN.search(text)
    return text[: m.end(1) - len(m[1].split("-")[-1])] if m else text


def lines_of(spans: DataFrame) -> DataFrame:
    """Text lines once, in columns the page pass needs."""
    height = F.coalesce(F.get("page_size", F.lit(1)), F.lit(792.0))
    rows = spans.where("content is not null and span_id is not null").select(
        "span_id", "document_name", "page_idx", "block_seq", "line_seq", "span_seq", "block_type", readable(F.col("content")).alias("text"), (F.get("bbox", F.lit(1)) / height).cast("float").alias("y")
    )
    return rows


def is_page_number(text: str) -> bool:
    t = text.strip()
    return len(t) < 20 and PAGE_NO.fullmatch(t) is not None


def page_symbols(lines: DataFrame) -> DataFrame:
    """(seq, n): the symbols of a page's lines in reading order, a byte for each, and how many pages have just these; re-delivered lines count once."""
    text = F.when(~F.col("text").rlike(_NO_PAGE_NO), F.col("text")).alias("text")
    order = ["document_name", "page_idx", "block_seq", "line_seq", "span_seq", "span_id"]
    placed = lines.select(*order, "block_type", text, "y").repartition("document_name", "page_idx").sortWithinPartitions(*order).select("document_name", "page_idx", "span_id", "block_type", "text", "y")

    def once(ids: list[int], codes: bytearray) -> bytes:
        first: dict[int, int] = {}
        if len(set(ids)) < len(ids):
            for i, code in zip(ids, codes):
                first.setdefault(i, code)
        return bytes(first.values() if first else codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, codes = None, [], bytearray()
        for batch in batches:
            docs, pages, kinds = (batch.column(c).dictionary_encode(null_encoding="encode") for c in ("document_name", "page_idx", "block_type"))
            texts, every = batch.column("text"), batch.column("span_id").to_numpy().tolist()
            number = np.zeros(len(every), int)
            for i, t in zip(np.flatnonzero(texts.is_valid()), texts.drop_null().to_pylist()):
                number[i] = is_page_number(t if t.isascii() else unicodedata.normalize("NFC", t))
            kind = np.array([kind_of(k) for k in kinds.dictionary.to_pylist()], int)[kinds.indices.to_numpy()]
            symbol = symbols(batch.column("y").to_numpy(zero_copy_only=False).astype(float), kind, number).astype(np.uint8).tobytes()
            turns = np.diff(docs.indices.to_numpy()).astype(bool) | np.diff(pages.indices.to_numpy()).astype(bool)
            out = []
            for start, end in itertools.pairwise([0, *(np.flatnonzero(turns) + 1).tolist(), len(every)] if every else []):
                at = (docs[start].as_py(), pages[start].as_py())
                if at != key:
                    if codes:
                        out.append(once(ids, codes))
                    key, ids, codes = at, [], bytearray()
                ids += every[start:end]
                codes += symbol[start:end]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["seq"])
        if codes:
            yield pa.RecordBatch.from_arrays([pa.array([once(ids, codes)], pa.binary())], names=["seq"])

    return placed.mapInArrow(run, "seq binary").groupBy("seq").agg(F.count("*").alias("n"))


def expected_counts(pages: DataFrame, model: Model) -> np.ndarray:
    """``model.expected`` in ones over all of ``pages`` (seq, n); the driver gets one sum for each parameter."""
    given = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = sorted(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), key=lambda p: len(p[0]))
            total, block = 0, []
            for i, (seq, n) in enumerate(every):
                block.append((np.frombuffer(seq, np.uint8), n))
                if i + 1 == len(every) or len(every[i + 1][0]) * (len(block) + 1) > CELLS:
                    total = total + given.value.expected([p for p, _ in block], np.array([n for _, n in block], np.int64))
                    block = []
            if every:
                yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, pa.int64())], names=["at", "n"])

    sums = pages.mapInArrow(run, "at int, n bigint").groupBy("at").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n")).collect()
    out = np.zeros(12 + model.emit.size)
    for r in sums:
        out[r.at] = int(r.n) / UNIT
    return out


def fit(lines: DataFrame) -> Model:
    """The model, re-estimated by Baum-Welch on all lines; what it starts from counts as much as a quarter of them."""
    pages = cut(page_symbols(lines))
    total = pages.agg(F.sum(F.length("seq") * F.col("n"))).first()[0] or 0
    model = Model()
    prior = model.emit * max(100, total // 4)
    for _ in range(ROUNDS if total else 0):
        model = model.revised(prior, expected_counts(pages, model))
    return model


def read_pages(lines: DataFrame, words: frozenset[str], compounds: frozenset[str], model: Model, tags: set[str] | None = None) -> DataFrame:
    """Findings of all pages (tag, id, doc, page, block, a, b, pos: order on the page); one exchange by page.

    A broadcast carries the vocabulary (bounded by ``1 / SHARE``) and the model.
    """
    given = lines.sparkSession.sparkContext.broadcast((words, compounds, model))
    columns = ["document_name", "page_idx", "span_id", "block_seq", "line_seq", "block_type", "text", "y"]
    placed = lines.repartition("document_name", "page_idx").sortWithinPartitions("document_name", "page_idx", "block_seq", "line_seq", "span_seq", "span_id").select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_, compounds_, model_ = given.value
        reader = Reader(words_, compounds_)

        def flush(pages: list[tuple]) -> pa.RecordBatch:
            every = [r for p in pages for r in p[2]]
            codes = symbols(np.array([np.nan if r[6] is None else r[6] for r in every]), np.array([kind_of(r[3]) for r in every]), np.array([int(r[5]) for r in every]))
            cuts = np.cumsum([len(p[2]) for p in pages])[:-1]
            out: list[tuple] = []
            for (doc, page, rows), states in zip(pages, model_.label(np.split(codes, cuts))):
                found = read_page(reader, doc, page, rows, states)
                out += [(*f, i) for i, f in enumerate(found) if tags is None or f[0] in tags]
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(_OUT)], schema=_OUT)

        key, rows, pages, held = None, [], [], 0
        seen = None
        for batch in batches:
            for doc, page, id_, block, line, kind, text, y in zip(*(c.to_pylist() for c in batch.columns)):
                if (doc, page) != key:
                    if rows:
                        pages.append((*key, rows))
                        held += len(rows)
                        if held > 5000:
                            yield flush(pages)
                            pages, held = [], 0
                    key, rows, seen = (doc, page), [], set()
                if id_ in seen:
                    continue  # delivered again
                seen.add(id_)
                if not text.isascii():
                    text = unicodedata.normalize("NFC", text)
                rows.append((id_, block, line, kind, text, is_page_number(text), 0.5 if y is None else y))
        if rows:
            pages.append((*key, rows))
        if pages:
            yield flush(pages)

    return placed.mapInArrow(run, _OUT_DDL)


def running_lines(found: DataFrame) -> DataFrame:
    """Header-labelled lines (id, doc, band, text) of bands that have them on two pages or more."""
    own = found.where("tag = 'running'").select("id", "doc", "page", F.col("a").alias("band"), F.col("b").alias("text"))
    bands = own.select("doc", "band", "page").distinct().groupBy("doc", "band").agg(F.count("*").alias("n")).where("n > 1").select("doc", "band", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("salt"))
    return own.withColumn("salt", F.pmod(F.hash("id"), F.lit(8))).join(bands, ["doc", "band", "salt"], "left_semi").select("id", "doc", "band", "text")


def next_pages(found: DataFrame) -> DataFrame:
    """(id, doc, page, block, head, tail, tail_id, tail_page, tail_block): each word broken at a page's end with the beginning of the next page that has running text.

    Pages are looked up in blocks of ``PAGES_A_BLOCK`` first, then from block to block,
    so that a document of any length is spread over tasks.
    """
    block = F.floor(F.col("page") / PAGES_A_BLOCK)
    rest = F.struct(F.col("page").alias("page"), F.col("id").alias("tail_id"), F.col("a").alias("tail"), F.col("block").alias("tail_block"))
    none = [F.lit(None).cast(k).alias(c) for c, k in (("id", "bigint"), ("head", "string"), ("block", "int"))]
    begins = found.where("tag = 'begin' and page is not null").select("doc", "page", F.lit(0).alias("open"), *none, rest.alias("rest"))
    ends = found.where("tag = 'open' and page is not null").select("doc", "page", F.lit(1).alias("open"), "id", F.col("a").alias("head"), "block", F.lit(None).cast(begins.schema["rest"].dataType).alias("rest"))
    later = lambda keys, at: Window.partitionBy(*keys).orderBy(F.desc(at), F.desc("open")).rowsBetween(Window.unboundedPreceding, -1)
    near = begins.unionByName(ends).withColumn("part", block)
    near = cut(near.withColumn("next", F.last("rest", ignorenulls=True).over(later(["doc", "part"], "page"))).where("open = 1"))
    left = near.where("next is null").drop("next")
    first = begins.withColumn("part", block).groupBy("doc", "part").agg(F.min("rest").alias("rest")).select("doc", F.col("rest.page").alias("page"), F.lit(0).alias("open"), *none, "rest", "part")
    far = first.unionByName(left).withColumn("next", F.last("rest", ignorenulls=True).over(later(["doc"], "part"))).where("open = 1")
    return near.where("next is not null").unionByName(far).select("id", "doc", "page", "block", "head", "next.tail", "next.tail_id", F.col("next.page").alias("tail_page"), "next.tail_block").where("tail is not null")


def page_breaks(found: DataFrame, words: frozenset[str], compounds: frozenset[str]) -> DataFrame:
    """(tag, id, a, b) for words broken at a page's end: hyphen, misread and perhaps, as in ``read_page``."""
    near = next_pages(found).select("id", "head", "tail", "tail_id")
    given = found.sparkSession.sparkContext.broadcast((words, compounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(*given.value)
        for batch in batches:
            out = []
            for id_, head, tail, tail_id in zip(*(c.to_pylist() for c in batch.columns)):
                last, first = head.split("-")[-1], tail.split("-")[0]
                if reader.broken(head, tail):
                    out.append(("hyphen", id_, None, None))
                    if whole := reader.meant(last + first):
                        out.append(("misread", id_ if not whole.startswith(last.lower()) else tail_id, None, None))
                else:
                    if either := reader.doubtful(head, tail):
                        out.append(("perhaps", id_, *either))
                    out += [("misread", i, None, None) for t, i in ((last, id_), (first, tail_id)) if reader.meant(t)]
                out.append(("continued", tail_id, None, None))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64() if i == 1 else pa.string()) for i in range(4)], names=["tag", "id", "a", "b"])

    joined = cut(near.mapInArrow(run, "tag string, id bigint, a string, b string"))
    nothing = F.lit(None).cast("string")
    alone = found.where("tag = 'maybe'").select("id").join(joined.where("tag = 'continued'").select("id"), "id", "left_anti").select(F.lit("misread").alias("tag"), "id", nothing.alias("a"), nothing.alias("b"))
    return joined.where("tag <> 'continued'").unionByName(alone)


def by_counts(doubts: DataFrame, counts: DataFrame, words: frozenset[str]) -> DataFrame:
    """(origin, id, noise) of the rows of ``doubts`` (origin, id, tag, a, b) that the table of counts decides on."""
    rare = doubts.where("tag = 'rare'").select("origin", "id", F.col("a").alias("token")).join(rare_misreads(counts, words), "token").select("origin", "id", F.lit("misread").alias("noise"))
    whole = counts.select(F.col("token").alias("a"), F.col("n").alias("n_whole")).where(F.col("n") >= LEAST)
    apart = counts.select(F.col("token").alias("b"), F.col("n").alias("n_apart"))
    perhaps = doubts.where("tag = 'perhaps'").join(whole, "a").join(apart, "b", "left").where("n_whole > coalesce(n_apart, 0)").select("origin", "id", F.lit("hyphen").alias("noise"))
    return rare.unionByName(perhaps)


# ---- tables

_EMPTY = r"(?:<t[dh]\b[^>]*+>\s*+</t[dh]\s*+>\s*+)*+"
_LONE = re.compile(rf"<tr\b[^>]*+>\s*+{_EMPTY}<t[dh]\b[^>]*+>((?:[^<]++|<(?!/?t[dhr]\b))++)</t[dh]\s*+>\s*+{_EMPTY}</tr\s*+>", re.S | re.I)  # a row with one filled cell
_TAG = re.compile(r"<[^>]*>")
_TAGS = re.compile(r"(?:<[^>]*>\s*)+")
_BREAK_SIGN = re.compile(rf"[{_MARK}]\s*(?:<br|\n)", re.I)  # what any broken word in a cell must hold, looked for first
_CELL_BREAK = re.compile(rf"([^\W\d_]+(?:-[^\W\d_]+)*)[{_MARK}]\s*(?:<br\s*/?>|\n)\s*([^\W\d_]+(?:-[^\W\d_]+)*)", re.I)
_WRONG_IO = re.compile(r">\s*(?!I/O)[1lI|]/[O0]\s*<")


def chain_tokens(text: str) -> list[str]:
    """Words of a line for the chain, with codes and numbers made alike."""
    return ["^", *re.findall(r"<id>|#|[^\W_]+|\|", re.sub(r"\d+", "#", _ID.sub("<id>", text))), "$"]


def header_chain(running: DataFrame) -> frozenset[tuple[str, str]]:
    """Word pairs that make up at least ``SHARE`` of all pairs of the header lines: at most ``1 / SHARE``."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [p for t in batch.column(0).to_pylist() for p in itertools.pairwise(chain_tokens(t))]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in both], pa.string()), pa.array([p[1] for p in both], pa.string())], names=["a", "b"])

    counts = cut(running.select("text").mapInArrow(pairs, "a string, b string").groupBy("a", "b").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return frozenset((r[0], r[1]) for r in counts.where(F.col("n") >= max(2.0, total * SHARE)).select("a", "b").collect())


def is_furniture(chain: frozenset[tuple[str, str]], text: str) -> bool:
    """Whether the words of a table's row follow each other as in header lines."""
    both = list(itertools.pairwise(chain_tokens(text)))
    return len(both) > 2 and sum(p in chain for p in both) >= 0.6 * len(both)


def read_table(reader: Reader, chain: frozenset[tuple[str, str]], html: str) -> set[tuple[str, str | None, str | None]]:
    """Kinds of noise in one table, as (tag, a, b); ``rare`` and ``perhaps`` as in ``read_page``."""
    kinds: set[tuple[str, str | None, str | None]] = set()
    for cell in _LONE.findall(html):
        text = _TAG.sub(" ", cell).strip()
        if not text:
            continue
        if PAGE_NO.fullmatch(text):
            kinds.add(("page_no", None, None))
            if wrong_number(text):
                kinds.add(("misread", None, None))
        elif is_furniture(chain, text):
            kinds.add(("running", None, None))
    if _WRONG_IO.search(html):
        kinds.add(("misread", None, None))

    def glue(m: re.Match[str]) -> str:
        if reader.broken(m[1], m[2]):
            kinds.add(("hyphen", None, None))
            return m[1] + m[2]
        if either := reader.doubtful(m[1], m[2]):
            kinds.add(("perhaps", *either))
        return f"{m[1]}-{m[2]}"

    text = _CELL_BREAK.sub(glue, html) if _BREAK_SIGN.search(html) else html
    if ("misread", None, None) not in kinds:
        wrong = reader.wrong_pieces(_TAGS.split(text))
        kinds |= {("misread", None, None)} if any(m for _, m in wrong) else {("rare", t.lower(), None) for t, _ in wrong}
    return kinds


def clean_table(reader: Reader, chain: frozenset[tuple[str, str]], html: str) -> str:
    """The table without furniture rows, with words whole and misread ones spelled right."""

    def row(m: re.Match[str]) -> str:
        text = _TAG.sub(" ", m[1]).strip()
        return "" if text and (PAGE_NO.fullmatch(text) or is_furniture(chain, text)) else m[0]

    def glue(m: re.Match[str]) -> str:
        return m[1] + m[2] if reader.broken(m[1], m[2]) else f"{m[1]}-{m[2]}"

    def word(m: re.Match[str]) -> str:
        meant = reader.meant(m[0])
        return m[0] if not meant else meant.upper() if m[0].isupper() and len(m[0]) > 1 else meant.capitalize() if m[0][0].isupper() else meant

    out = _WRONG_IO.sub(">I/O<", _LONE.sub(row, html))
    if _BREAK_SIGN.search(out):
        out = _CELL_BREAK.sub(glue, out)
    tags = _TAG.findall(out)
    texts = [WORD.sub(word, t) if any(m for _, m in reader.wrong_pieces([t])) else t for t in _TAG.split(out)]
    return "".join(itertools.chain.from_iterable(zip(texts, [*tags, ""])))


def _over_tables(tables: DataFrame, read, words: frozenset[str], compounds: frozenset[str], chain: frozenset[tuple[str, str]], names: list[str], ddl: str) -> DataFrame:
    """``read(reader, chain, html)``, an iterable of tuples, for every table, after its id; no exchange."""
    given = tables.sparkSession.sparkContext.broadcast((words, compounds, chain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_, compounds_, chain_ = given.value
        reader = Reader(words_, compounds_)
        for batch in batches:
            out = [(i, *x) for i, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for x in read(reader, chain_, h)]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.string() if k else pa.int64()) for k in range(len(names))], names=names)

    rows = tables.where("table_id is not null and html is not null").select(F.col("table_id").alias("id"), table_text(F.col("html")).alias("html"))
    return rows.mapInArrow(run, ddl)


def read_tables(tables: DataFrame, words: frozenset[str], compounds: frozenset[str], chain: frozenset[tuple[str, str]]) -> DataFrame:
    """(id, tag, a, b) of all tables; re-delivered findings stay in."""
    return _over_tables(tables, read_table, words, compounds, chain, ["id", "tag", "a", "b"], "id bigint, tag string, a string, b string")


def clean_tables(spans: DataFrame, tables: DataFrame) -> DataFrame:
    """(table_id, html): every table once, with clean cells."""
    lines, words, compounds, model, _ = _prepare(spans, tables)
    chain = header_chain(running_lines(cut(read_pages(lines, words, compounds, model, {"running"}))))
    out = _over_tables(tables, lambda r, c, h: [(clean_table(r, c, h),)], words, compounds, chain, ["id", "html"], "id bigint, html string")
    return out.select(F.col("id").alias("table_id"), "html").groupBy("table_id").agg(F.max("html").alias("html"))


def _prepare(spans: DataFrame, tables: DataFrame):
    lines = lines_of(spans)
    in_tables = tables.where("html is not null").select(F.regexp_replace(table_text(F.col("html")), "<[^>]*>", " ").alias("text"))
    counts = counted(lines.select("text").unionByName(in_tables))
    words, compounds = vocabulary(counts)
    return lines, words, compounds, fit(lines), counts


def find_noise(spans: DataFrame, tables: DataFrame) -> DataFrame:
    """(origin, origin_id, noise): each kind of noise of each span and table."""
    lines, words, compounds, model, counts = _prepare(spans, tables)
    found = cut(read_pages(lines, words, compounds, model, {"running", "page_no", "misread", "hyphen", "open", "begin", "maybe", "rare", "perhaps"}))
    running = cut(running_lines(found))
    breaks = page_breaks(found, words, compounds)
    of_tables = cut(read_tables(tables, words, compounds, header_chain(running)))
    parts = [("span", found), ("span", breaks), ("table", of_tables)]
    sure = [d.where("tag in ('page_no', 'misread', 'hyphen') or tag = 'running' and " + ("true" if o == "table" else "false")).select(F.lit(o).alias("origin"), "id", F.col("tag").alias("noise")) for o, d in parts]
    doubts = [d.where("tag in ('rare', 'perhaps')").select(F.lit(o).alias("origin"), "id", "tag", "a", "b") for o, d in parts]
    every = [*sure, running.select(F.lit("span").alias("origin"), "id", F.lit("running").alias("noise")), by_counts(cut(reduce(DataFrame.unionByName, doubts)), counts, words)]
    return reduce(DataFrame.unionByName, every).select("origin", F.col("id").alias("origin_id"), "noise").distinct()


def _roots(links: DataFrame) -> DataFrame:
    """(block, root) of chains of ``links`` (source, target): pointers are doubled until none moves."""
    now = cut(links.select(F.col("target").alias("block"), F.col("source").alias("root")))
    while True:
        jump = now.select(F.col("block").alias("root"), F.col("root").alias("further"))
        new = cut(now.join(jump, "root", "left").select("block", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now = new.drop("moved")
        if new.where("moved").isEmpty():
            return now


def paragraphs(spans: DataFrame, tables: DataFrame) -> DataFrame:
    """(document_name, page_idx, block_seq, text): running text without furniture, words whole and readable.

    One row per paragraph, under its first block; it takes in the blocks of later
    pages where a word or a sentence runs on there. Lines that only look like
    furniture (their band has them on one page) stay in.
    """
    lines, words, compounds, model, _ = _prepare(spans, tables)
    found = cut(read_pages(lines, words, compounds, model, {"text", "running", "open", "runon", "begin"}))
    of_block = F.struct("doc", "page", "block")
    furniture = running_lines(found).select("id")
    unsure = found.where("tag = 'running'").join(furniture, "id", "left_anti").select("id", of_block.alias("at"), "pos", F.col("b").alias("a"), F.lit("").alias("b"))
    body = found.where("tag = 'text'").select("id", of_block.alias("at"), "pos", "a", "b").unionByName(unsure)
    given = spans.sparkSession.sparkContext.broadcast((words, compounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(*given.value)
        for batch in batches:
            out = []
            for head, tail in zip(batch.column("head").to_pylist(), batch.column("tail").to_pylist()):
                if head is None:
                    out.append(None)
                    continue
                last, first = head.split("-")[-1], tail.split("-")[0]
                out.append(reader.meant(last + first) or last + first if reader.broken(head, tail) else f"{last}-{first}")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "whole"])

    over = next_pages(found.where("tag in ('open', 'runon', 'begin')").withColumn("tag", F.when(F.col("tag") == "runon", "open").otherwise(F.col("tag"))))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in over.schema)
    over = cut(over.mapInArrow(run, f"{kinds}, whole string"))
    links = over.select(of_block.alias("source"), F.struct("doc", F.col("tail_page").alias("page"), F.col("tail_block").alias("block")).alias("target"))
    heads = over.where("head is not null").select("id", "whole")
    tails = over.where("head is not null").select(F.col("tail_id").alias("id"), F.lit(True).alias("begun")).distinct()
    whole_lines = body.join(heads, "id", "left").join(tails, "id", "left").select(
        "at", "pos", "b",
        F.when(F.col("whole").isNotNull(), F.concat(F.regexp_replace(F.when(F.col("begun"), F.regexp_replace("a", r"^\s*\p{L}+", "")).otherwise(F.col("a")), rf"\p{{L}}+[{_MARK}]\s*$", ""), "whole")).when(F.col("begun"), F.regexp_replace("a", r"^\s*\p{L}+", "")).otherwise(F.col("a")).alias("a"),
        F.when(F.col("whole").isNotNull(), F.lit("glue")).otherwise(F.col("b")).alias("glue"),
    ).drop("b")
    roots = _roots(links)
    placed = whole_lines.join(roots, whole_lines["at"] == roots["block"], "left").select(F.coalesce("root", "at").alias("root"), F.struct("at.page", "at.block", "pos", "a", "glue").alias("x"))
    joined = F.aggregate("xs", F.lit(""), lambda acc, x: F.concat(acc, x["a"], F.when(x["glue"] == "glue", "").otherwise(" ")))
    return placed.groupBy("root").agg(F.array_sort(F.collect_list("x")).alias("xs")).select(
        F.col("root.doc").alias("document_name"), F.col("root.page").alias("page_idx"), F.col("root.block").alias("block_seq"), F.trim(F.regexp_replace(joined, r"\s+", " ")).alias("text")
    )
