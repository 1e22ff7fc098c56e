"""Incremental curation with Structured Streaming: clean, deduplicate and count as files arrive."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.session import scratch_dir


def _timed(stream: DataFrame, time: str) -> DataFrame:
    """Event times without a zone are taken in the session's."""
    return stream.withColumn(time, F.col(time).cast("timestamp"))


def first_seen(stream: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """Rows whose key wasn't seen within the watermark before; state older than the delay is dropped."""
    return _timed(stream, time).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def first_times(stream: DataFrame, keys: list[str], time: str) -> DataFrame:
    """The first time of each key as the stream has it so far; for the complete mode, with one row of state a key."""
    return _timed(stream, time).groupBy(*keys).agg(F.min(time).alias(f"first_{time}"))


def windowed_counts(stream: DataFrame, time: str, key: str, width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Counts per key in tumbling windows; late rows within the delay are counted."""
    return _timed(stream, time).withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def run_once(spark: SparkSession, out: DataFrame, mode: str = "append") -> DataFrame:
    """Process everything there is and return it as a table in the scratch folder."""
    base = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    if mode == "append":
        q = out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start()
    else:
        q = out.writeStream.foreachBatch(lambda d, _: d.write.mode("overwrite").parquet(f"{base}/out")).option("checkpointLocation", f"{base}/state").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")


def stream_of(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A file stream of one table of a folder."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)
