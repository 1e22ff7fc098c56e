"""Deterministic sampling, sharding and batching. Order and assignment come from hashes of ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.session import maybe_broadcast


def md5_order(*cols: str, seed: int = 0) -> Column:
    """A pseudo-random order that any engine with md5 can repeat."""
    return F.md5(F.concat_ws(":", *(F.col(c).cast("string") for c in cols), F.lit(str(seed))))


def md5_bucket(n: Column | int, *cols: str, seed: int = 0) -> Column:
    """Bucket 0..n-1 from the first 8 hex digits of the md5."""
    return F.pmod(F.conv(F.substring(md5_order(*cols, seed=seed), 1, 8), 16, 10).cast("long"), n if isinstance(n, Column) else F.lit(n))


def _first_by_hash(df: DataFrame, group: str, id_col: str, quota: DataFrame, seed: int) -> DataFrame:
    """The rows with the least hashes of each group, as many as quota (group, quota) says, without ranking whole groups: a histogram of
    4,096 hash ranges per group tells up to which range rows are kept, and only the rows of that range are ranked. Exact. A null group
    is one; groups without a quota fall out."""
    bucket = F.conv(F.substring(md5_order(id_col, seed=seed), 1, 3), 16, 10).cast("int")
    hist = df.groupBy(F.col(group).alias("__g"), bucket.alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy("__g").orderBy("__b"))  # at most 4,096 rows a group
    hist = hist.withColumn("__upto", upto).join(quota.select(F.col(group).alias("__q"), "quota"), F.col("__g").eqNullSafe(F.col("__q")))
    edge = F.min(F.when(F.col("__upto") >= F.col("quota"), F.struct(F.col("__b").alias("b"), (F.col("__upto") - F.col("__n")).alias("n"))))
    cuts = hist.groupBy("__g").agg(edge.alias("__e"), F.max("quota").alias("__quota")).where("__quota > 0")
    cuts = maybe_broadcast(cuts.select("__g", F.coalesce("__e.b", F.lit(4_096)).alias("__cut"), (F.col("__quota") - F.coalesce("__e.n", F.lit(0))).alias("__left")))
    own = df.withColumn("__b", bucket).join(cuts, F.col(group).eqNullSafe(F.col("__g")))
    w = Window.partitionBy("__g").orderBy(md5_order(id_col, seed=seed), id_col)
    edge_rows = own.where("__b = __cut").withColumn("__rn", F.row_number().over(w)).where("__rn <= __left")
    return own.where("__b < __cut").select(*df.columns).unionByName(edge_rows.select(*df.columns))


def sample_per_group(df: DataFrame, group: str, id_col: str, n: Column | int, seed: int = 0) -> DataFrame:
    """n rows of each group (all if it has fewer), the same ones on every run. n may be a column that is one value within a group."""
    quota = df.groupBy(group).agg((F.max(n) if isinstance(n, Column) else F.lit(n)).cast("long").alias("quota"))
    return _first_by_hash(df, group, id_col, quota, seed)


def temperature_quota(counts: DataFrame, group: str, n: str, budget: int, temperature: float) -> DataFrame:
    """Rows to take of each group: proportional to share ** (1 / temperature), of min(budget, all rows)."""
    every = Window.partitionBy()  # counts has one row per group
    t = counts.withColumn("__t", F.pow(F.col(n) / F.sum(n).over(every), 1.0 / temperature)).withColumn("__b", F.least(F.lit(budget), F.sum(n).over(every)))
    return t.withColumn("quota", F.floor(F.col("__t") / F.sum("__t").over(every) * F.col("__b")).cast("long")).drop("__t", "__b")


def temperature_sample(df: DataFrame, group: str, id_col: str, budget: int, temperature: float, seed: int = 0) -> DataFrame:
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return _first_by_hash(df, group, id_col, temperature_quota(counts, group, "n", budget, temperature).select(group, "quota"), seed)


def shard_count(n_direction: Column, n_all: Column, smallest: int = 250_000, largest: int = 5_000_000) -> Column:
    return F.least(F.ceil(n_direction / smallest), F.ceil(n_all / largest))


def shard_with_replacement(df: DataFrame, id_col: str, line_no: str, shards: int, copies: float, seed: int = 0) -> DataFrame:
    """Each row in ⌈copies⌉ or ⌊copies⌋ distinct shards: the former for the first frac * 1000 of each 1000 lines; at most all shards."""
    low = int(copies)
    often = round((copies - low) * 1000)
    want = F.least(F.lit(shards), F.when(F.pmod(F.col(line_no), F.lit(1000)) < often, low + 1).otherwise(low))
    ordered = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(F.md5(F.concat_ws(":", F.col(id_col).cast("string"), s.cast("string"), F.lit(str(seed)))).alias("h"), s.alias("s"))))
    return df.withColumn("shard", F.explode(F.transform(F.slice(ordered, F.lit(1), want), lambda x: x["s"])))


def holdout(df: DataFrame, group: str, parts: int, part: int, seed: int = 0) -> DataFrame:
    """Rows of the groups that fall into one of `parts` equally likely parts."""
    return df.where(md5_bucket(parts, group, seed=seed) == part)


def shuffled_batches(df: DataFrame, id_col: str, size: int, lanes: int, seed: int = 0) -> DataFrame:
    """Rows in a pseudo-random order with a lane, and a batch number and place within the lane."""
    w = Window.partitionBy("lane").orderBy(md5_order(id_col, seed=seed), id_col)
    return df.withColumn("lane", md5_bucket(lanes, id_col, seed=seed + 1)).withColumn("__r", F.row_number().over(w) - 1).withColumn("batch", F.floor(F.col("__r") / size)).withColumn("place", F.col("__r") % size).drop("__r")
