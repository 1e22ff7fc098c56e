"""Session helpers: scratch folder, durable intermediate tables, size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Default ceiling, in rows, for a side that is broadcast by hint.
BROADCAST_ROWS = 200_000

_own_dirs: list[str] = []


def _forget_own() -> None:
    for d in _own_dirs:
        shutil.rmtree(d, ignore_errors=True)


def scratch_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, as named by spark.checkpoint.dir.

    Only where the session names none and all runs on one machine (tests, notebooks) a
    private folder is made, which goes away with the process; on a cluster that is an error,
    since executors would write to their own disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own_dirs:
        _own_dirs.append(tempfile.mkdtemp(prefix="loomline-"))
        atexit.register(_forget_own)
    return "file://" + _own_dirs[0]


def written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df once as Parquet in the shared scratch folder and return the table read back.

    Cuts the lineage: a lost executor costs the re-read of files, not the recomputation
    of everything before. Each call writes under a fresh name.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    w = df.write.mode("error").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Remove the files of a table made by written(), once nothing reads it any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    roots = {os.path.dirname(f) for f in df.inputFiles()}
    for r in roots:
        p = jvm.org.apache.hadoop.fs.Path(r)
        p.getFileSystem(conf).delete(p, True)


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if df has at most `limit` rows, counted no further than the limit."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def skew_join(big: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of a side that may hold very frequent keys with one of few rows a key.

    Keys with more than a ten-thousandth of big's rows are, by construction, at most ten
    thousand; the rows of `small` with these keys are broadcast and big's rows stay where
    they are. The rest, without hot keys, is joined in the ordinary way.
    """
    bound = max(10_000, big.count() // 10_000)
    hot = F.broadcast(big.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > bound).select(*on))
    large = F.broadcast(small.join(hot, on, "left_semi"))
    return big.join(large, on).unionByName(big.join(hot, on, "left_anti").join(small, on))
