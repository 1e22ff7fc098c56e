"""Audio segments: overlap elimination and duration batches, which depend on the rows kept before."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.operators.analytics import with_totals


def drop_overlaps(df: DataFrame, path: str, start: str, end: str, factor: str, score: str, id_col: str, most: float = 0.2, method: str = "fraction") -> DataFrame:
    """Segments of each path by start; one that overlaps the last kept by more than `most` replaces it if its score is
    higher, else falls out. A pass over the segments sorted by path and start that holds one segment at a time. Rows with a null
    in these columns fall out.
    """
    own = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in (path, start, end, factor, score)))
    own = own.select(F.col(path).alias("p"), *(F.col(c).cast("double").alias(n) for c, n in ((start, "s"), (end, "e"))), F.col(id_col).cast("long").alias("i"), *(F.col(c).cast("double").alias(n) for c, n in ((factor, "f"), (score, "v"))))

    def shared(a: tuple, b: tuple) -> float:
        common = (min(a[2], b[2]) - max(a[1], b[1])) / a[4]
        d1, d2 = (a[2] - a[1]) / a[4], (b[2] - b[1]) / b[4]
        whole = max(d1, d2) if method == "fraction" else d1 + d2 - common
        return common / whole if common > 0 and whole else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        names = ["p", "s", "e", "i", "f", "v"]
        for b in batches:
            out = []
            for x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if last is None or last[0] != x[0] or shared(last, x) <= most:
                    out += [last] if last else []
                    last = x
                elif last[5] < x[5]:
                    last = x
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, b.schema.types, strict=True)], names=names)
        if last:
            yield pa.record_batch([pa.array([c], t) for c, t in zip(last, b.schema.types, strict=True)], names=names)

    kind = dict(df.dtypes)[path]
    kept = own.repartition("p").sortWithinPartitions("p", "s", "e", "i").mapInArrow(run, f"p {kind}, s double, e double, i long, f double, v double")
    return kept.select(F.col("p").alias(path), F.col("i").alias(id_col), F.col("s").alias(start), F.col("e").alias(end), F.col("f").alias(factor), F.col("v").alias(score))


def duration_batches(df: DataFrame, lane: str, order: str, duration: str, most: float, most_rows: int | None = None) -> DataFrame:
    """Consecutive rows of a lane, in the given order, in batches of at most so long (and so many rows) in all; a longer row is a batch of
    its own. A null duration is 0. A pass over sorted rows that holds two numbers; with the length as order and tokens
    as duration it makes batches of rows of like length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, batch, held, n = object(), 0, 0.0, 0
        for b in batches:
            out = []
            for k, d in zip(b.column(lane).to_pylist(), b.column(duration).to_pylist(), strict=True):
                d = d or 0.0
                if k != now:
                    now, batch, held, n = k, 0, 0.0, 0
                elif held + d > most or (most_rows and n >= most_rows):
                    batch, held, n = batch + 1, 0.0, 0
                held, n = held + d, n + 1
                out.append(batch)
            yield pa.record_batch([*b.columns, pa.array(out, pa.int64())], names=[*b.schema.names, "batch"])

    kind = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.repartition(lane).sortWithinPartitions(lane, order).mapInArrow(run, kind + ", batch long")


def file_stats(df: DataFrame, path: str, kept: str, hours: str) -> DataFrame:
    """Kept share of each file, mean and population deviation over files, and whether it is a three-sigma outlier."""
    per = df.groupBy(path).agg(F.avg(F.col(kept).cast("double")).alias("kept_share"), F.sum(hours).alias("hours"))
    whole = per.agg(F.avg("kept_share").alias("mean"), F.stddev_pop("kept_share").alias("deviation"))
    return with_totals(per, whole).withColumn("outlier", F.abs(F.col("kept_share") - F.col("mean")) > 3 * F.col("deviation"))
