"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

The merges are compiled to an automaton over the bytes of the vocabulary
(a trie with failure links). A state of the transducer is the automaton's node,
the last token given out, and, for every place at which a token may still
begin, the tokens found but not yet certain. Reading a byte adds the one token
that ends here and fits its predecessor; tokens on which all open places agree
are given out at once, so the lookahead is bounded by the longest token.
States and transitions are made when first needed and kept.

A pair (a, b) fits when the merges, applied to the bytes of a and b together,
leave exactly a and b; by induction the chain of fitting tokens is the result of
the merges on the whole piece.

Cases: null and empty texts give an empty list; strings of special tokens are
ordinary text; lone surrogates cannot occur in a Spark string.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the published pre-tokenisation pattern of this vocabulary.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MAX_FILE = 32 << 20
MAX_STATES = 100_000
MAX_PIECES = 300_000


def read_ranks(path: str) -> bytes:
    """The vocabulary file; refused above ``MAX_FILE`` bytes, since every worker gets a copy."""
    with open(path, "rb") as f:
        data = f.read(MAX_FILE + 1)
    if len(data) > MAX_FILE:
        raise ValueError(f"{path} is larger than {MAX_FILE} bytes")
    return data


class Transducer:
    """BPE of one piece of text; states are made lazily."""

    def __init__(self, data: bytes) -> None:
        self.ranks: dict[bytes, int] = {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}
        self.tokens: dict[int, bytes] = {v: k for k, v in self.ranks.items()}
        self._goto: dict[int, int] = {}
        self._depth, self._word = [0], [-1]
        for word, rank in self.ranks.items():
            node = 0
            for byte in word:
                at = node << 8 | byte
                if (nxt := self._goto.get(at)) is None:
                    nxt = self._goto[at] = len(self._depth)
                    self._depth.append(self._depth[node] + 1)
                    self._word.append(-1)
                node = nxt
            self._word[node] = rank
        self._fail = [0] * len(self._depth)
        for at, node in sorted(self._goto.items(), key=lambda x: self._depth[x[1]]):
            parent, byte = at >> 8, at & 255
            if parent:
                back = self._fail[parent]
                while back and back << 8 | byte not in self._goto:
                    back = self._fail[back]
                self._fail[node] = self._goto.get(back << 8 | byte, 0)
        self._fits: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget the states made so far."""
        self._ids: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._next: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._start = self._state((0, -1, ((),)))

    def _state(self, key: tuple) -> int:
        number = self._ids.get(key)
        if number is None:
            number = self._ids[key] = len(self._states)
            self._states.append(key)
        return number

    def merge(self, word: bytes) -> list[int]:
        """The merges applied one by one, lowest rank first, leftmost first: the definition."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min(((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _fit(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self._fits.get(key)
        if known is None:
            if left < 0:
                known = self.merge(self.tokens[right]) == [right]
            else:
                known = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
            self._fits[key] = known
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        node, last, open_ = self._states[state]
        while node and node << 8 | byte not in self._goto:
            node = self._fail[node]
        node = self._goto.get(node << 8 | byte, 0)
        depth, found, walk = self._depth[node], None, node
        while walk:
            token, size = self._word[walk], self._depth[walk]
            if token >= 0 and size <= len(open_):
                before = open_[size - 1]
                if before is not None and self._fit(before[-1] if before else last, token):
                    found = (*before, token)
                    break
            walk = self._fail[walk]
        live = (found, *open_[:depth])
        sure = [x for x in live if x is not None]
        given = 0
        shortest = min(map(len, sure))
        while given < shortest and all(x[given] == sure[0][given] for x in sure):
            given += 1
        out = sure[0][:given]
        if given:
            live, last = tuple(None if x is None else x[given:] for x in live), out[-1]
        return self._state((node, last, live)), out

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one piece."""
        if len(self._states) > MAX_STATES:
            self.reset()
        out: list[int] = []
        state, after = self._start, self._next
        for byte in word:
            key = state << 8 | byte
            step = after.get(key)
            if step is None:
                step = after[key] = self._step(state, byte)
            state = step[0]
            if step[1]:
                out += step[1]
        out += self._states[state][2][0]
        return out


class Encoder:
    """Whole texts: pieces by pattern, each through the transducer, with a bounded memory of pieces."""

    def __init__(self, data: bytes) -> None:
        self.transducer = Transducer(data)
        self._split = regex.compile(PIECES).findall
        self._known: dict[str, list[int]] = {}

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        known, out = self._known, []
        for piece in self._split(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= MAX_PIECES:
                    known.clear()
                ids = self.transducer.encode(piece.encode())
                if len(piece) < 64:
                    known[piece] = ids
            out += ids
        return out


#: UTF-8 by the byte: allowed range of the first continuation byte for special lead bytes (fixed values of the encoding).
_SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


class Utf8Machine:
    """Incremental UTF-8: bytes in, complete characters out; a wrong byte gives U+FFFD once per maximal bad part."""

    def __init__(self) -> None:
        self._need, self._value, self._low, self._high = 0, 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out: list[str] = []
        for byte in data:
            if self._need:
                if self._low <= byte <= self._high:
                    self._value, self._need, self._low, self._high = self._value << 6 | byte & 63, self._need - 1, 0x80, 0xBF
                    if not self._need:
                        out.append(chr(self._value))
                    continue
                out.append("�")
                self._need, self._low, self._high = 0, 0x80, 0xBF
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                self._need = 1 if byte < 0xE0 else 2 if byte < 0xF0 else 3
                self._value = byte & (0x3F >> self._need)
                self._low, self._high = _SECOND.get(byte, (0x80, 0xBF))
            else:
                out.append("�")
        return "".join(out)

    def close(self) -> str:
        """What is left: U+FFFD if a character was cut off."""
        cut, self._need = self._need, 0
        return "�" if cut else ""


def decode_stream(ids: Iterable[int], tokens: dict[int, bytes]) -> Iterator[str]:
    """Text of the tokens as they come; characters split over tokens come out whole."""
    machine = Utf8Machine()
    for i in ids:
        if part := machine.feed(tokens[i]):
            yield part
    if part := machine.close():
        yield part


_WORKER: dict[int, Encoder] = {}


def _encoder(data: bytes) -> Encoder:
    key = hash(data)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Encoder(data)
    return _WORKER[key]


def encode_corpus(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) of every row of ``df``: no shuffle, Arrow batches, one transducer per worker process."""
    data = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(data.value).encode
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = [encode(t) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
                flat = np.fromiter((i for r in rows for i in r), np.int32, int(ends[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["k", "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def decode_corpus(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) from (key, ids), by the streaming decoder; a null list gives an empty text."""
    data = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _encoder(data.value).transducer.tokens
        for batch in batches:
            texts = ["".join(decode_stream(r or (), tokens)) for r in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["k", "text"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("k"), F.col(ids).alias("ids")).mapInArrow(run, f"k {kind}, text string").withColumnRenamed("k", key)
