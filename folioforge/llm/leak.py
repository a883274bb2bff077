"""Held-out items that leaked into a corpus: q-gram lemma filter and banded alignment.

Texts are compared as streams of letters and digits (NFKC, lower case; markup,
punctuation, blanks and line breaks fall away). All q-grams of a block of items
stand in sorted tables, which every task gets; items are worked off in blocks of
about ``MAX_ITEM_CHARS`` letters, of which the driver holds one at a time.
A document's q-grams are looked up at once with array operations; the hits are
counted by item and by diagonal band (bands overlap by half, so that every
passage lies wholly within one). By the q-gram lemma a passage of ``m`` letters
with at most ``k`` edits keeps ``m + 1 - q * (k + 1)`` of its q-grams within a
band of ``k`` diagonals; bands with fewer hits are dropped, the rest is aligned
within the band. A document is reported if the alignment holds the least passage
of an item with at most ``k`` edits; ``exact`` tells whether it also does so
without any, word for word.

The length of q-grams goes by the least passage of an item, in classes, so that a
short item doesn't weaken the filter of the others; items of fewer than
``SHORT`` letters are looked up whole and without edits.

Cases: null, empty and blank texts and items match nothing; an item shorter
than the least run counts when it occurs whole; copies of a text each get their
rows; texts are read whole, however long.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.session import cut

Q = 12
EDITS = 1
MIN_WORDS = 12
MIN_LETTERS = 20
MAX_ITEM_CHARS = 4_000_000
SHORT = 6
_NOT_WORD = re.compile(r"[\W_]+")
_TAG = re.compile(r"</?[A-Za-z][^<>]{0,200}>")
_ENTITY = re.compile(r"&(?:#\d{1,7}|#x[0-9a-fA-F]{1,6}|[A-Za-z]{2,10});")
_CJK = re.compile(r"[㐀-鿿豈-﫿]")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str) -> str:
    """NFKC, lower case, without tags and entities."""
    if "<" in text:
        text = _TAG.sub("", text)
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m[0]), text)
    return unicodedata.normalize("NFKC", text).lower()


def stream(text: str | None) -> str:
    """The letters and digits of a text in a row."""
    return _NOT_WORD.sub("", plain(text)) if text else ""


def words(text: str) -> list[str]:
    """Blank-separated words, each as its letters and digits."""
    return [w for w in (_NOT_WORD.sub("", x) for x in plain(text).split()) if w]


_SLOW = 0xFFFFFFFF


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    """For every character of the basic plane what ``stream`` makes of it: one letter, 0 for nothing, or ``_SLOW`` where it depends on others or gives several."""
    out = np.zeros(0x10000, np.uint32)
    for c in range(0x10000):
        x = chr(c)
        if 0xD800 <= c < 0xE000 or 0x1100 <= c < 0x1200 or unicodedata.combining(x) or x in "Σς":
            out[c] = _SLOW
            continue
        w = _NOT_WORD.sub("", unicodedata.normalize("NFKC", x).lower())
        out[c] = 0 if not w else ord(w) if len(w) == 1 else _SLOW
    return out


def codes(text: str) -> np.ndarray:
    """``stream(text)`` as an array of code points, by table where that gives the same."""
    if "<" not in text and "&" not in text:
        raw = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if not len(raw) or raw.max() < 0x10000:
            out = _table()[raw]
            if not (out == _SLOW).any():
                return out[out != 0]
    return np.frombuffer(stream(text).encode("utf-32-le"), np.uint32)


def grams(code: np.ndarray, q: int = Q) -> np.ndarray:
    """64-bit hashes of all q-grams of a stream, put together from those of halves."""
    if len(code) < q:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        part, size = code.astype(np.uint64) + np.uint64(1), 1
        out, done = None, 0
        rest = q
        while rest:
            if rest & 1:
                out = part if out is None else out[: len(part) - done] * _BASE + part[done:]
                done += size
            rest >>= 1
            if rest:
                part = part[:-size] * np.uint64(0xC2B2AE3D27D4EB4F + size) + part[size:]
                part = part ^ (part >> np.uint64(31))
                size *= 2
        out = out[: len(code) - q + 1]
        return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Item:
    """A held-out text as stream, with the places at which its words begin."""

    number: int
    letters: str
    starts: list[int]
    least: int
    cjk: bool

    @classmethod
    def of(cls, number: int, text: str, min_words: int, min_letters: int) -> Item | None:
        letters = stream(text)
        if not letters:
            return None
        if len(_CJK.findall(text)) * 2 > len(letters):
            return cls(number, letters, [], min(min_letters, len(letters)), True)
        starts = [0]
        for w in words(text):
            starts.append(starts[-1] + len(w))
        n = min(min_words, len(starts) - 1)
        return cls(number, letters, starts, min(starts[i + n] - starts[i] for i in range(len(starts) - n)), False)


class Index:
    """Sorted q-gram table of a block of items, with a bit table before it."""

    BITS = 22

    def __init__(self, items: list[Item], q: int, edits: int) -> None:
        self.items, self.edits, self.q = items, edits, q
        least = min((i.least for i in items), default=q)
        keys = [grams(codes(i.letters), self.q) for i in items]
        self.keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.item = np.concatenate([np.full(len(k), n, np.int64) for n, k in enumerate(keys)])[order] if keys else np.empty(0, np.int64)
        self.place = np.concatenate([np.arange(len(k), dtype=np.int64) for k in keys])[order] if keys else np.empty(0, np.int64)
        self.bits = np.zeros(1 << self.BITS, bool)
        self.bits[(self.keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True
        #: By the q-gram lemma no passage of any of the items has fewer hits.
        self.fewest = max(1, least + 1 - self.q * (edits + 1))

    def hits(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, place in item, place in text) of every shared q-gram."""
        own = grams(code, self.q)
        at = np.flatnonzero(self.bits[(own >> np.uint64(64 - self.BITS)).astype(np.int64)])
        key = own[at]
        low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        count = high - low
        some = count > 0
        at, low, count = at[some], low[some], count[some]
        if not len(at):
            return at, at, at
        which = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        return self.item[which], self.place[which], np.repeat(at, count)

    def regions(self, code: np.ndarray) -> Iterator[tuple[Item, int, int, int]]:
        """(item, lowest diagonal, first and last place in the text) of bands that meet the bound."""
        item, place, at = self.hits(code)
        if len(item) < self.fewest:
            return
        width = 2 * max(1, self.edits)
        size = np.array([i.least for i in self.items])
        need = np.maximum(1, size + 1 - self.q * (self.edits + 1))
        diagonal = at - place + (1 << 40)
        for shift in (0, width // 2):
            band = (diagonal + shift) // width
            order = np.lexsort((at, band, item))
            i, b, a = item[order], band[order], at[order]
            edge = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (b[1:] != b[:-1]))))
            for s, e in zip(edge, np.append(edge[1:], len(i))):
                if e - s >= need[i[s]]:
                    yield self.items[int(i[s])], int(b[s]) * width - shift - (1 << 40), int(a[s]), int(a[e - 1]) + self.q


def align(letters: str, item: str, low: int, width: int, first: int, last: int) -> tuple[int, list[tuple[int, int, int]]]:
    """Banded alignment of ``letters[first:last]`` with the item on diagonals ``low .. low + width``.

    Gives the fewest edits and the exact runs (place in text, place in item,
    length) of one such alignment.
    """
    far = 1 << 30
    span = range(width + 1)
    row = [0 if 0 <= first - (low + d) <= len(item) else far for d in span]
    back: list[list[int]] = []
    for t in range(first, last):
        new, moves = [far] * (width + 1), [0] * (width + 1)
        for d in range(width, -1, -1):
            j = t - (low + d)  # the item's letter against letters[t]
            best, move = far, 0
            if 0 <= j < len(item):
                best = row[d] + (letters[t] != item[j])
                move = 1 if letters[t] == item[j] else 2
            if d and row[d - 1] + 1 < best:  # the text has a letter more
                best, move = row[d - 1] + 1, 3
            if d < width and new[d + 1] + 1 < best:  # the item has a letter more
                best, move = new[d + 1] + 1, 4
            new[d], moves[d] = best, move
        row = new
        back.append(moves)
    d = min(span, key=lambda x: row[x])
    edits, runs, t = row[d], [], last
    length = 0
    while t > first and row[d] < far:
        move = back[t - 1 - first][d]
        if move == 1:
            length += 1
            t -= 1
            continue
        if length:
            runs.append((t, t - (low + d), length))
            length = 0
        if move == 3:
            t, d = t - 1, d - 1
        elif move == 4:
            d += 1
        elif move == 2:
            t -= 1
        else:
            break
    if length:
        runs.append((t, t - (low + d), length))
    return edits, runs


def stretches(runs: list[tuple[int, int, int]], edits: int) -> Iterator[tuple[int, int, int]]:
    """(first and last place in the item, edits) of runs of one alignment, each joined with as many of the next as the budget allows."""
    runs = sorted(runs)
    for i, (t, j, n) in enumerate(runs):
        end_t, end_j, cost = t + n, j + n, 0
        for t2, j2, n2 in runs[i + 1 :]:
            gap = max(t2 - end_t, j2 - end_j)
            if t2 < end_t or j2 < end_j or cost + gap > edits:
                break
            end_t, end_j, cost = t2 + n2, j2 + n2, cost + gap
        yield j, end_j, cost


def _grow(letters: str, item: str, run: tuple[int, int, int]) -> tuple[int, int, int]:
    t, j, n = run
    while t and j and letters[t - 1] == item[j - 1]:
        t, j, n = t - 1, j - 1, n + 1
    while t + n < len(letters) and j + n < len(item) and letters[t + n] == item[j + n]:
        n += 1
    return t, j, n


def _diagonal_runs(letters: str, item: str, low: int, width: int, first: int, last: int, least: int) -> Iterator[tuple[int, int, int]]:
    for d in range(low, low + width + 1):
        a, b = max(first, d, 0), min(last, d + len(item), len(letters))
        start = a
        for t in range(a, b + 1):
            if t == b or letters[t] != item[t - d]:
                if t - start >= least:
                    yield start, start - d, t - start
                start = t + 1


class Borders:
    """Whether a place of a text's stream is where one of its words begins or ends."""

    def __init__(self, text: str) -> None:
        self.places, at = {0}, 0
        for part in re.split(r"[\W_]+", plain(text)):
            at += len(part)
            self.places.add(at)


def indexes(items: list[Item], q: int = Q, edits: int = EDITS) -> list[Index]:
    """Tables of items by script and by the length of q-gram that suits their least passage."""
    classes: dict[tuple[bool, int, int], list[Item]] = {}
    for i in items:
        if i.least < SHORT:
            key = (i.cjk, i.least, 0)
        else:
            top, size = (min(q, 6) if i.cjk else q), i.least // (edits + 1)
            key = (i.cjk, next((x for x in (top, 6, 3) if x <= min(size, top)), 2), edits)
        classes.setdefault(key, []).append(i)
    return [Index(part, size, k) for (_, size, k), part in classes.items()]


def leaks(text: str, tables: list[Index], min_words: int = MIN_WORDS) -> dict[int, tuple[int, int, bool]]:
    """Item -> (letters of its longest passage, its edits, whether exact) for every item that leaked into a text."""
    code = codes(text)
    found: dict[int, tuple[int, int, bool]] = {}
    seen: set[tuple] = set()
    borders: Borders | None = None
    letters = ""
    for index, (item, low, first, last) in ((t, r) for t in tables for r in t.regions(code)):
        width = 2 * max(1, index.edits)
        letters = letters or code.tobytes().decode("utf-32-le")
        key = (item.number, low // width, first, last)
        if key in seen:
            continue
        seen.add(key)
        more = index.q + index.edits  # within the item the passage may go on where an edit took the q-grams
        start = min(first, max(0, first - more, low + width))
        end = max(last, min(len(letters), last + more, low + len(item.letters)))
        _, aligned = align(letters, item.letters, low, width, start, end)
        runs = {_grow(letters, item.letters, r) for r in aligned if r[2] >= min(index.q, item.least)}
        runs |= {_grow(letters, item.letters, r) for r in _diagonal_runs(letters, item.letters, low, width, first, last, item.least)}
        best: tuple[bool, int, int] | None = None  # (exact, letters, -edits)
        need = min(min_words, len(item.starts) - 1)
        for t, j, n in runs:
            if n < item.least:
                continue
            if item.cjk:
                best = max(best or (True, n, 0), (True, n, 0))
                continue
            borders = borders or Borders(text)
            inside = [s for s in item.starts if j <= s <= j + n and t + s - j in borders.places]
            # consecutive word borders of the item that are borders of the text as well
            places = [item.starts.index(s) for s in inside]
            if places and places[-1] - places[0] >= need:
                best = max(best or (True, 0, 0), (True, inside[-1] - inside[0], 0))
        if not best and index.edits:
            for j, stop, cost in stretches(aligned, index.edits):
                inside = [s for s in item.starts if j <= s <= stop]
                if stop - j >= item.least and (item.cjk or len(inside) > need):
                    best = max(best or (False, 0, 0), (False, stop - j, -cost))
        if best:
            old = found.get(item.number)
            now = (best[1], -best[2], best[0])
            found[item.number] = max(old, now, key=lambda x: (x[2], x[0], -x[1])) if old else now
    return found


def find_leaks(
    corpus: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    min_words: int = MIN_WORDS,
    min_letters: int = MIN_LETTERS,
    q: int = Q,
    edits: int = EDITS,
) -> DataFrame:
    """(key, item_id, run_letters, edits, exact) for every document of ``corpus`` that holds an item or enough of it.

    The corpus isn't shuffled; it is read once for every block of items. With
    several blocks each one's rows are written before the next block is fetched, so
    the driver and a broadcast hold one block, whatever the number of items.
    """
    spark = corpus.sparkSession
    kind, item_kind = corpus.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    given_items = items.select(F.col(item_key).alias("k"), F.col(item_text).alias("t")).where("k is not null and t is not null").distinct()
    letters = given_items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = 1 if letters <= MAX_ITEM_CHARS else -(-2 * letters // MAX_ITEM_CHARS)
    source = corpus.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null")
    schema = f"k {kind}, item {item_kind}, run_letters int, edits int, exact boolean"
    types = [pa.int32(), pa.int32(), pa.bool_()]

    def search(block: list[tuple]) -> DataFrame:
        given = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys = [k for k, _ in given.value]
            made = [Item.of(n, t, min_words, min_letters) for n, (_, t) in enumerate(given.value)]
            tables = indexes([i for i in made if i], q, edits)
            for batch in batches:
                out = [(k, keys[n], *x) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for n, x in leaks(t, tables, min_words).items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], batch.schema.field(0).type), pa.array([o[1] for o in out]) if out else pa.nulls(0, pa.int64()), *[pa.array([o[i + 2] for o in out], x) for i, x in enumerate(types)]],
                    names=["k", "item", "run_letters", "edits", "exact"],
                )

        return source.mapInArrow(run, schema)

    fetch = lambda b: [(r.k, r.t) for r in given_items.where(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == b).collect()]
    result = search(fetch(0))
    if blocks > 1:
        result = cut(result)
        for b in range(1, blocks):
            result = result.unionByName(cut(search(fetch(b))))
    return result.withColumnRenamed("k", key).withColumnRenamed("item", "item_id" if item_key == key else item_key)
