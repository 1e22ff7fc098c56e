"""Problem 1: duplicates hidden by formatting differences.

Each side of a record is reduced to its words (runs of letters and digits, lower case,
full-width forms folded); the two sides are put in a fixed order, so that field order does
not matter; the result is hashed to 128 bits (MD5) beside an independent 64-bit check value.
Counting is a plain aggregate, so it combines on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.session import skew_join, written

# Full-width ASCII forms stand at a fixed distance from the plain ones.
_WIDE = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F)) + "　"
_PLAIN = "".join(chr(c) for c in range(0x21, 0x7F)) + " "


def canonical_words(c: Column) -> Column:
    """Words of a text joined by single blanks; null stays null, a wordless text becomes ''."""
    return F.trim(F.regexp_replace(F.lower(F.translate(c, _WIDE, _PLAIN)), r"[^\p{L}\p{N}]+", " "))


def record_keys(df: DataFrame, id_col: str, left: str, right: str) -> DataFrame:
    """One row (id, k, chk) per distinct (record id, content) of df.

    k is the 128-bit hash of the canonical record with its sides in byte order, chk a 64-bit
    hash of the same text by another function. Rows with a null or wordless side or a null id
    are left out. Extra columns don't matter; a row repeated under its id counts once. The
    shuffle key includes the id, so that no group of copies, however large, meets in one task.
    """
    a, b = canonical_words(F.col(left)), canonical_words(F.col(right))
    sides = df.select(F.col(id_col).alias("id"), a.alias("a"), b.alias("b")).where("id IS NOT NULL AND a <> '' AND b <> ''")
    text = F.concat_ws("\u0001", F.least("a", "b"), F.greatest("a", "b"))
    keyed = sides.select("id", F.unhex(F.md5(text)).alias("k"), F.xxhash64(text, F.length(text)).alias("chk"))
    return keyed.distinct()


def copy_counts(keys: DataFrame) -> DataFrame:
    """(k, chk, keep_id, copies) per canonical record. Two contents that share the 128-bit
    hash but differ in the check value stay apart; see collisions()."""
    return keys.groupBy("k", "chk").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("copies"))


def collisions(counts: DataFrame) -> DataFrame:
    """128-bit hashes that stand for more than one content (expected: none)."""
    return counts.groupBy("k").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1")


def duplicate_pairs(df: DataFrame, id_col: str, left: str, right: str) -> DataFrame:
    """(keep_id, id) for every record whose content also stands under a smaller id.

    Copies find their group by skew_join(), so a group may hold any share of the records. An
    empty input gives an empty result.
    """
    keys = written(record_keys(df, id_col, left, right), "p1-keys")
    groups = copy_counts(keys).where("copies > 1").select("k", "chk", "keep_id")
    return skew_join(keys, groups, ["k", "chk"]).where("id <> keep_id").select("keep_id", "id")


def collapsed_records(df: DataFrame, id_col: str, left: str, right: str) -> DataFrame:
    """One row (keep_id, copies) per canonical record, copies counting distinct ids."""
    return copy_counts(record_keys(df, id_col, left, right)).select("keep_id", "copies")
