"""Mapping of freely written values to the entries of a reference list.

Only distinct values and distinct tokens are worked on. A token is repaired by a
join with the reference vocabulary on deletion neighbourhoods (equal keys after
at most one deletion on either side), verified by edit distance; digits that
look like letters are folded first. The repaired tokens of a value then rank the
entries by soft TF-IDF: similarity of the token times the rarity of the
reference token, summed over type, drawing and count. An entry that an exactly
read token of the value contradicts is out. The best entry wins; none, or several
equally good ones, give -1.

Cases: null and empty values have no row; a number alone names no entry; width,
case, punctuation and blanks make no difference; a value met a million times is
ranked once and joined back with the salt of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.width import full_to_half, strip_ignorables
from folioforge.session import cut

ROLES = {"type": "package_type", "drawing": "package_drawing", "count": "pin_count"}
SALT = 8
FOLDED, REPAIRED = 0.95, 0.8
UNMATCHED = -1


def fold(c: Column) -> Column:
    """Digits as the letters they are taken for."""
    return F.translate(c, "05182", "osibz")


def _clean(c: Column) -> Column:
    return F.lower(strip_ignorables(full_to_half(c)))


def reference_tokens(entries: DataFrame, entry: str = "entry_id") -> DataFrame:
    """(entry, role, ref, idf): the tokens of every entry with their rarity among all entries."""
    parts = entries.select(F.col(entry).alias("entry"), F.explode(F.array(*[F.struct(F.lit(r).alias("role"), _clean(F.col(c)).alias("ref")) for r, c in ROLES.items()])).alias("t")).select("entry", "t.*").where("ref is not null and ref <> ''").distinct()
    total = entries.select(entry).distinct().count()
    rarity = parts.groupBy("role", "ref").agg(F.log((F.lit(total) + 1) / F.count("*")).alias("idf"))
    return cut(parts.join(rarity, ["role", "ref"]))


def _deletions(c: Column) -> Column:
    """The word and all words with one letter less."""
    return F.array_distinct(F.concat(F.array(c), F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))))


def repair_tokens(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(token, role, ref, sim) for distinct ``tokens`` (token) against ``vocabulary`` (role, ref), by exact, folded and edited match.

    Only words of four letters and more are repaired by edits; numbers are
    compared exactly.
    """
    words = vocabulary.where("role <> 'count'")
    exact = tokens.join(vocabulary, tokens["token"] == vocabulary["ref"]).select("token", "role", "ref", F.lit(1.0).alias("sim"))
    mixed = tokens.where(F.col("token").rlike("[a-z]") & F.col("token").rlike("[0-9]"))
    folded = mixed.join(words, fold(mixed["token"]) == fold(words["ref"])).where("token <> ref").select("token", "role", "ref", F.lit(FOLDED).alias("sim"))
    a = tokens.where((F.length("token") >= 3) & F.col("token").rlike("[a-z]")).select("token", F.explode(_deletions(fold(F.col("token")))).alias("key"))
    b = words.where(F.length("ref") >= 4).select("role", "ref", F.explode(_deletions(fold(F.col("ref")))).alias("key"))
    sorted_ = lambda c: F.array_sort(F.split(c, ""))
    distance = F.levenshtein(fold(F.col("token")), fold(F.col("ref")))
    near = (distance == 1) | ((distance == 2) & (F.length("token") == F.length("ref")) & (sorted_(fold(F.col("token"))) == sorted_(fold(F.col("ref")))))
    edited = a.join(b, "key").select("token", "role", "ref").distinct().where(near & (F.col("token") != F.col("ref"))).withColumn("sim", F.lit(REPAIRED))
    return exact.unionByName(folded).unionByName(edited).groupBy("token", "role", "ref").agg(F.max("sim").alias("sim"))


def tokens_of(values: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(value, token) of distinct values; digits at a word's end are tokens of their own unless the word is a folded reference word."""
    raw = cut(values.select("value", F.explode(F.array_distinct(F.filter(F.split(_clean(F.col("value")), "[^a-z0-9]+"), lambda x: x != ""))).alias("raw")))
    distinct = raw.select("raw").distinct()
    known = vocabulary.where("role <> 'count'").select(fold(F.col("ref")).alias("f")).distinct()
    whole = distinct.join(known, fold(distinct["raw"]) == known["f"], "left_semi").where("raw rlike '[a-z]'").select("raw", F.array("raw").alias("parts"))
    rest = distinct.join(whole.select("raw"), "raw", "left_anti")
    split = rest.select("raw", F.filter(F.array(F.regexp_extract("raw", "^([0-9]*)", 1), F.regexp_replace("raw", "^[0-9]+|[0-9]+$", ""), F.when(F.col("raw").rlike("[a-z]"), F.regexp_extract("raw", "([0-9]*)$", 1))), lambda x: x.isNotNull() & (x != "")).alias("parts"))
    return cut(raw.join(whole.unionByName(split), "raw").select("value", F.explode("parts").alias("token")).distinct())


def rank_entries(values: DataFrame, entries: DataFrame, entry: str = "entry_id") -> DataFrame:
    """(value, entry_id, score) of distinct ``values`` (value): the entry meant, or -1."""
    ref = reference_tokens(entries, entry)
    vocabulary = ref.select("role", "ref").distinct()
    tokens = tokens_of(values, vocabulary)
    repaired = repair_tokens(cut(tokens.select("token").distinct()), vocabulary)
    hits = cut(tokens.join(repaired, "token"))
    sure = hits.where("sim >= 0.95")
    states = tokens.groupBy("value").agg(F.max(F.col("token").rlike("^[0-9]+$")).alias("has_count")).join(
        sure.groupBy("value").agg(F.max(F.col("role") == "type").alias("has_type"), F.max(F.col("role") == "drawing").alias("has_drawing")), "value", "left"
    )
    role = lambda r: F.max(F.when(F.col("role") == r, F.col("sim") * F.col("idf")))
    sure_role = lambda r: F.coalesce(F.max((F.col("role") == r) & (F.col("sim") >= 0.95)), F.lit(False))
    candidates = (
        hits.join(ref, ["role", "ref"])
        .groupBy("value", "entry")
        .agg(*[role(r).alias(r) for r in ROLES], *[sure_role(r).alias(f"sure_{r}") for r in ROLES])
        .join(states, "value")
        .where("type is not null or drawing is not null")
    )
    fits = candidates.where(
        (~F.coalesce("has_type", F.lit(False)) | F.col("sure_type")) & (~F.coalesce("has_drawing", F.lit(False)) | F.col("sure_drawing")) & (~F.coalesce("has_count", F.lit(False)) | F.col("sure_count"))
    )
    scored = fits.select("value", "entry", F.round(sum((F.coalesce(F.col(r), F.lit(0.0)) for r in ROLES), F.lit(0.0)), 6).alias("score"))
    top = scored.groupBy("value").agg(F.max("score").alias("score"))
    best = scored.join(top, ["value", "score"]).groupBy("value").agg(F.max("score").alias("score"), F.count("*").alias("n"), F.max("entry").alias("entry"))
    known = best.select("value", F.when(F.col("n") == 1, F.col("entry")).otherwise(UNMATCHED).alias("entry_id"), "score")
    return values.join(known, "value", "left").select("value", F.coalesce("entry_id", F.lit(UNMATCHED)).cast("bigint").alias("entry_id"), F.coalesce("score", F.lit(0.0)).alias("score"))


def map_to_catalog(df: DataFrame, entries: DataFrame, key: str = "assignment_id", value: str = "pkg") -> DataFrame:
    """(key, entry_id, score) of every row of ``df`` with a value."""
    rows = df.select(F.col(key).alias("k"), F.col(value).alias("value")).where("k is not null and length(value) > 0").dropDuplicates(["k"])
    ranked = rank_entries(cut(rows.select("value").distinct()), entries)
    salted = ranked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return rows.withColumn("salt", F.pmod(F.hash("k"), F.lit(SALT))).join(salted, ["value", "salt"]).select(F.col("k").alias(key), "entry_id", "score")
