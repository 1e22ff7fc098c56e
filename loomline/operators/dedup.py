"""Exact and near deduplication. "First" is by an explicit id everywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.session import skew_join, written


def first_of(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Rows with the smallest id of their key. A plain aggregate, so a frequent key combines on the map side."""
    cols = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(id_col, *[c for c in cols if c != id_col])).alias("__x"))
    return best.select(*keys, *(F.col(f"__x.{c}").alias(c) for c in cols)).select(*df.columns)


def at_most(df: DataFrame, keys: list[str], id_col: str, n: int) -> DataFrame:
    """The n rows of smallest id of each key (the rank limit is applied before the shuffle as well)."""
    w = Window.partitionBy(*keys).orderBy(id_col)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def best_of(df: DataFrame, keys: list[str], score: str, id_col: str) -> DataFrame:
    """The row of each key with the largest score, of equal ones with the smallest id. A null score is the least."""
    cols = [c for c in df.columns if c not in keys]
    rest = [c for c in cols if c not in (score, id_col)]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(score, -F.col(id_col))).alias("__x"))
    return best.select(*keys, *(F.col(f"__x.{c}").alias(c) for c in [score, id_col, *rest])).select(*df.columns)


def held_out(train: DataFrame, evals: DataFrame, src: str, tgt: str, norm, mode: str = "both", scope: tuple[str, ...] = ("lang_dir",), id_col: str = "line_id") -> DataFrame:
    """Training pairs that repeat neither an evaluation pair nor an earlier training pair.

    Normalised sides decide. Pairs with an empty side are dropped. By mode also repeated sources
    ("src"), targets ("tgt"), either ("both") or none ("neither") are dropped; "first" counts over
    all non-empty rows, evaluation before training, whether or not another side drops them. Evaluation rows
    hold for a direction and its reverse.
    """
    # normalised once, and from there on digests instead of texts
    def digests(df: DataFrame, label: str, *more: Column) -> DataFrame:
        x = df.select(*scope, *more, norm(F.col(src)).alias("a"), norm(F.col(tgt)).alias("b")).where("a <> '' AND b <> ''")
        return written(x.select(*scope, *(["id"] if more else []), F.md5("a").alias("a"), F.md5("b").alias("b")), label)

    own, e = digests(train, "held-train", F.col(id_col).alias("id")), digests(evals, "held-eval")
    if "lang_dir" in scope:
        turned = e.select(*[F.regexp_replace("lang_dir", r"^(.*)-(.*)$", "$2-$1").alias("lang_dir") if c == "lang_dir" else c for c in scope], F.col("b").alias("a"), F.col("a").alias("b"))
        e = e.unionByName(turned)
    keep = own.select("id", *scope)
    for cols in [["a", "b"], *([["a"]] if mode in ("src", "both") else []), *([["b"]] if mode in ("tgt", "both") else [])]:
        keys = [*scope, *cols]
        firsts = own.groupBy(*keys).agg(F.min("id").alias("id")).join(e.select(*keys).distinct(), keys, "left_anti")
        keep = keep.join(firsts.select("id"), "id", "left_semi")
    return keep


def sort_unique(df: DataFrame, text: str, order: list[str]) -> DataFrame:
    """One row per text, the first in the given order."""
    rest = [c for c in df.columns if c != text]
    rank = [*order, *(c for c in rest if c not in order)]
    best = df.groupBy(text).agg(F.min(F.struct(*rank)).alias("__x"))
    return best.select(text, *(F.col(f"__x.{c}").alias(c) for c in rank)).select(*df.columns)


_PRIME = (1 << 31) - 1


def _signatures(perms: int, bands: int, rows: int, order: int, seed: int):
    """Arrow function: the hash of each band of each text's MinHash signature over its character shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.random.default_rng(seed)
        a, b = r.integers(1, _PRIME, perms, dtype=np.int64), r.integers(0, _PRIME, perms, dtype=np.int64)
        power = np.array([pow(1_000_003, k, _PRIME) for k in range(order)], dtype=np.int64)
        # a band's key is a random linear form of its minima, in 64 bits
        mix = r.integers(1 << 62, size=(1, rows), dtype=np.int64) * 2 + 1
        salt = r.integers(1 << 62, size=bands, dtype=np.int64)
        for batch in batches:
            ids, keys = [], []
            for i, t in zip(batch.column("id").to_pylist(), batch.column("t").to_pylist(), strict=True):
                if not t:
                    continue
                c = np.frombuffer(t.encode("utf-32-le"), np.uint32).astype(np.int64)
                n = max(1, len(c) - order + 1)
                h = np.zeros(n, np.int64)
                for k in range(min(order, len(c))):
                    h = (h + c[k : k + n] * power[k]) % _PRIME
                h = np.unique(h)
                sig = np.full(perms, _PRIME, np.int64)
                for lo in range(0, len(h), 4_096):
                    sig = np.minimum(sig, ((a[:, None] * h[None, lo : lo + 4_096] + b[:, None]) % _PRIME).min(1))
                ids += [i] * bands
                keys.append((sig[: bands * rows].reshape(bands, rows) * mix).sum(1) + salt)  # modulo 2**64
            yield pa.record_batch([pa.array(ids, batch.schema.field("id").type), pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64))], names=["id", "bucket"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(a, b) with b the largest id of a's connected component, for every other id of it; edges are (a, b) with a < b.

    Alternating large and small stars: every round ties the ids around an id to the largest of them, until
    only stars are left (rounds grow with the logarithm of the ids).
    """
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    edges = written(edges.select("a", "b").distinct(), "edges")
    seen, now = None, mark(edges)
    while now != seen:
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
        most = both.groupBy("u").agg(F.greatest(F.max("v"), F.col("u")).alias("m"))
        large = skew_join(edges.select(F.col("a").alias("v"), F.col("b").alias("u")), most, ["u"]).select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "large-stars")
        top = large.groupBy("a").agg(F.max("b").alias("m"))
        small = skew_join(large, top, ["a"]).where("b < m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.unionByName(top.withColumnRenamed("m", "b")).distinct(), "edges")
        seen, now = now, mark(edges)
    return edges


def near_duplicates(df: DataFrame, id_col: str, text: Column, perms: int = 100, bands: int = 10, rows: int = 10, order: int = 5, seed: int = 1) -> DataFrame:
    """(id, class_id, dropped) per row: rows collide if they share a MinHash band; a row is dropped if
    it collides with one of a larger id (the last one stays). class_id is the largest id of all rows that
    collisions connect it with, its own if none; a row that collides with smaller ids only isn't dropped, though its
    class may have a larger id. Null and empty texts collide with nothing. Equal texts are represented once, so
    copies don't meet in a bucket; buckets are reduced to their largest id by an aggregate, which links all their rows.
    """
    if bands * rows > perms:
        raise ValueError("bands * rows must not exceed the number of permutations")
    kind = dict(df.dtypes)[id_col]
    own = df.select(F.col(id_col).alias("id"), text.alias("t")).withColumn("k", F.md5("t"))
    own = written(own.select("id", "k", "t"), "lsh-texts")
    reps = own.where("t <> ''").groupBy("k").agg(F.max("id").alias("id"), F.max("t").alias("t"))
    buckets = written(reps.select("id", "t").mapInArrow(_signatures(perms, bands, rows, order, seed), f"id {kind}, bucket long"), "lsh-buckets")
    tops = buckets.groupBy("bucket").agg(F.max("id").alias("top"))
    links = skew_join(buckets, tops, ["bucket"]).where("id < top").select(F.col("id").alias("a"), F.col("top").alias("b"))
    links = written(links.distinct(), "lsh-links")
    tied = reps.select("k", "id").join(components(links).select(F.col("a").alias("id"), F.col("b").alias("class_id")), "id", "left")
    tied = tied.join(links.select(F.col("a").alias("id"), F.lit(True).alias("hit")).distinct(), "id", "left")
    of_key = tied.select("k", F.col("id").alias("rep"), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("hit", F.lit(False)).alias("hit"))
    named = skew_join(own.where("t <> ''").select("id", "k"), of_key, ["k"]).select("id", "class_id", (F.col("hit") | (F.col("id") < F.col("rep"))).alias("dropped"))
    blank = own.where("t IS NULL OR t = ''").select("id", F.col("id").alias("class_id"), F.lit(False).alias("dropped"))
    return named.unionByName(blank)
