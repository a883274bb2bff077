"""One consistent spelling for text that looks the same.

The corpus gives the vocabulary: its tokens with their counts. Tokens that hold
anything but plain characters are carried through a trie of the vocabulary by a
weighted edit automaton in which look-alike letters, widths, ligatures,
compositions and characters without a mark cost nothing; the canonical spelling
is the plain one, else the most frequent one, that is reached without cost.
What reaches no word of the vocabulary is spelled by the table alone.

The vocabulary is never collected: words and tokens meet in shards by the
beginning of their visible form, and each shard builds its tries prefix by prefix.

Cases: null contents stay out; empty and blank contents have the empty form;
kinds of blank become the ASCII blank and blanks at the ends fall away, while
their number inside counts; raised digits, case and accents are kept apart;
a repeated id gives its pairs once; texts of any length are read whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.session import cut

#: Letters of other scripts that print like a Latin letter.
LOOK_ALIKES = dict(
    zip(
        "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνοАВЕКМНОРСТХЅІЈҮаеорсухѕіјһԁԛԝ"  # Greek and Cyrillic
        "ՍՏՕհոսցօզյ"  # Armenian
        "ᎠᎡᎢᎪᎫᎬᎳᎷᎻᎽᏀᏃᏆᏏᏔᏚᏞᏟᏢᏦᏩᏴ"  # Cherokee
        "ɑɡⅼⅽⅾⅿ",  # letters of phonetics and numerals
        "ABEZHIKMNOPTYXvoABEKMHOPCTXSIJYaeopcyxsijhdqw"
        "USOhnugoqj"
        "DRTAJEWMHYGZIbWSLCPKGB"
        "aglcdm",
        strict=True,
    )
)
#: Hyphens that print like the ASCII one.
HYPHENS = "‐‑"
#: Decompositions that leave the printed form as it is.
SAME_PRINT = ("<compat>", "<noBreak>", "<wide>", "<narrow>")
_BLANK = r"[ \t\n\x0B\f\r\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Characters that the table leaves as they are and that no other character is taken for.
_STABLE = "\\x21-\\x7E°ΩÀ-ÖØ-öø-ÿ\\x{4E00}-\\x{9FFF}"
_PLAIN = f"^[{_STABLE}]+(?: +[{_STABLE}]+)*$"
_PLAIN_TOKEN = f"^[{_STABLE}]*$"
SALT = 8


def is_ignorable(c: str) -> bool:
    """Characters that leave no mark: format and control characters, variation selectors, fillers."""
    return unicodedata.category(c) in ("Cf", "Cc") and not c.isspace() or "︀" <= c <= "️" or c in "͏ᅟᅠ឴឵ㅤﾠ"


@lru_cache(maxsize=65536)
def visible(c: str) -> str:
    """What one character prints as, decomposed; '' for nothing."""
    if is_ignorable(c):
        return ""
    if c.isspace():
        return " "
    if c in HYPHENS:
        return "-"
    tag = unicodedata.decomposition(c).split(" ")[0]
    out = unicodedata.normalize("NFKC", c) if tag in SAME_PRINT else unicodedata.normalize("NFC", c)
    if out.startswith(" ") and len(out) > 1:
        out = c  # a spacing accent is no blank
    return unicodedata.normalize("NFD", "".join(LOOK_ALIKES.get(x, x) for x in out))


def skeleton(token: str) -> str:
    """The printed form of a token, decomposed: equal for tokens that look alike."""
    return unicodedata.normalize("NFD", "".join(map(visible, token)))


def spelled(token: str) -> str:
    """A token spelled by the table alone."""
    return unicodedata.normalize("NFC", skeleton(token))


def preferred(word: str, count: int) -> tuple:
    """Order of spellings of one printed form: plain ones, then frequent ones, then by code."""
    return (not word.isascii(), -count, word)


class Trie:
    """Words by their printed form; the last node of a form holds its preferred spelling."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, word: str, count: int) -> None:
        node = self.root
        for c in skeleton(word):
            node = node.setdefault(c, {})
        rank = preferred(word, count)
        if "" not in node or rank < node[""]:
            node[""] = rank

    def search(self, token: str, budget: int = 0) -> tuple[int, str] | None:
        """(cost, word) of the best word within ``budget``; look-alikes and ignorables cost 0, other edits 1."""
        node = self.root
        for c in token:
            for x in visible(c):
                node = node.get(x) if node is not None else None
        if node is not None and "" in node:
            return 0, node[""][-1]
        form = skeleton(token)
        if not budget:  # marks may stand in another order than in the word
            node = self.root
            for x in form:
                if (node := node.get(x)) is None:
                    return None
            return (0, node[""][-1]) if "" in node else None
        best: tuple | None = None
        stack = [(self.root, list(range(len(form) + 1)))]
        while stack:
            node, row = stack.pop()
            if "" in node and row[-1] <= budget and (best is None or (row[-1], node[""]) < best):
                best = (row[-1], node[""])
            for c, child in node.items():
                if c == "":
                    continue
                new = [row[0] + 1]
                for i, x in enumerate(form):
                    new.append(min(new[-1] + 1, row[i + 1] + 1, row[i] + (x != c)))
                if min(new) <= budget:
                    stack.append((child, new))
        return (best[0], best[1][-1]) if best else None


def _canonical_tokens(tokens: DataFrame) -> DataFrame:
    """(token, canon) for tokens whose canonical spelling differs, from (token, n) of the whole vocabulary.

    Tokens and words are spread by the first characters of the printed form
    and sorted, so a task holds the trie of one prefix at a time.
    """

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [spelled(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(forms, pa.string())], names=["token", "n", "form"])

    odd = tokens.where(~F.col("token").rlike(_PLAIN_TOKEN)).mapInArrow(form, "token string, n bigint, form string")
    odd = cut(odd.withColumn("plain", F.lit(False)))
    plain = tokens.where(F.col("token").rlike(_PLAIN_TOKEN))
    # only words that a token could reach are put into the tries
    words = plain.join(odd.select(F.col("form").alias("token")).distinct(), "token", "left_semi").select("token", "n", F.col("token").alias("form"), F.lit(True).alias("plain"))
    shard = F.substring("form", 1, 3)
    both = words.unionByName(odd).withColumn("shard", shard).repartition("shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(trie: Trie, asked: list[str]) -> pa.RecordBatch:
            pairs = [(t, hit[1] if (hit := trie.search(t)) else spelled(t)) for t in asked]
            pairs = [p for p in pairs if p[0] != p[1]]
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], names=["token", "canon"])

        now, trie, asked = None, Trie(), []
        for batch in batches:
            for token, n, is_plain, key in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if key != now:
                    if asked:
                        yield done(trie, asked)
                    now, trie, asked = key, Trie(), []
                if is_plain or is_word(token):
                    trie.add(token, n)
                if not is_plain:
                    asked.append(token)
        if asked:
            yield done(trie, asked)

    return both.select("token", "n", "form", "plain", "shard").mapInArrow(run, "token string, canon string")


_LATIN = re.compile(r"[A-Za-zÀ-ɏ]")


def is_word(token: str) -> bool:
    """May serve as a canonical spelling: composed, without ignorables, and as the table spells it or wholly in another alphabet."""
    clean = token == unicodedata.normalize("NFC", token) and not any(map(is_ignorable, token))
    return clean and (spelled(token) == token or len(token) > 1 and not _LATIN.search(token) and not any("！" <= c <= "￮" for c in token) and all(c in LOOK_ALIKES or visible(c) == c for c in token))


def _split(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows that are their own form, one row per other text with its canonical form), both (id, text, rest, canon)."""
    rest = [c for c in df.columns if c not in (key, text)]
    given = df.select(F.col(key).alias("id"), F.col(text).alias("text"), *[F.col(c) for c in rest]).where("text is not null and id is not null")
    is_plain = F.col("text").rlike(_PLAIN)
    plain, odd = given.where(is_plain), given.where(~is_plain)
    parts = F.split(F.regexp_replace("text", f"^{_BLANK}+|{_BLANK}+$", ""), _BLANK)
    tokens = plain.select(F.explode(F.split("text", " ")).alias("token")).unionAll(odd.select(F.explode(parts).alias("token")))
    words = tokens.where("token <> ''").groupBy("token").agg(F.count("*").alias("n"))
    changed = _canonical_tokens(cut(words)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    pieces = odd.select("id", "text", *rest, F.posexplode(parts).alias("pos", "token")).withColumn("salt", F.pmod(F.hash("id"), F.lit(SALT)))
    spelled_ = pieces.join(changed, ["token", "salt"], "left").withColumn("t", F.coalesce("canon", "token"))
    whole = spelled_.groupBy("id").agg(*[F.first(c).alias(c) for c in ("text", *rest)], F.array_sort(F.collect_set(F.struct("pos", "t"))).alias("ts"))
    return plain.withColumn("canon", F.col("text")), whole.select("id", "text", *rest, F.array_join(F.transform("ts", lambda x: x["t"]), " ").alias("canon"))


def canonical(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key as id, text, other columns, canon) of every row with a text, once per key.

    Plain texts are their own form and take no part in the joins.
    """
    plain, odd = _split(df, key, text)
    return plain.unionByName(odd).dropDuplicates(["id"])


def look_alike_pairs(df: DataFrame, key: str, text: str, scope: list[str]) -> DataFrame:
    """(key_a, key_b), the smaller first: rows of one scope with different texts that print the same.

    One of a pair is never plain, so the few other texts are joined with all.
    """
    plain, odd = _split(df.select(key, text, *scope), key, text)
    odd = cut(odd)
    on = [*scope, "canon"]
    other = lambda d: d.select(*on, F.col("id").alias("b"), F.col("text").alias("text_b"))
    pairs = odd.join(other(plain), on).where("text <> text_b").unionByName(odd.join(other(odd), on).where("text <> text_b and id < b"))
    return pairs.select(F.least("id", "b").alias(f"{key}_a"), F.greatest("id", "b").alias(f"{key}_b")).distinct()
