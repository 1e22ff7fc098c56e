"""Writers. Spark's commit protocol makes every write atomic; parts merge by listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cell(c: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[\t\r\n]+", " ")


def write_tsv(df: DataFrame, path: str, columns: list[str], header: bool = False, compression: str = "gzip") -> None:
    """TSV; tabs and line ends within values become blanks, nulls empty fields."""
    df.select(*(_cell(c).alias(c) for c in columns)).write.csv(path, sep="\t", header=header, compression=compression, quote="", escape="", emptyValue="", nullValue="")


def write_bitext(pairs: DataFrame, path: str, score: str, left: str, right: str) -> None:
    write_tsv(pairs, path, [score, left, right])


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.json(path, compression="gzip")


def write_shards(df: DataFrame, path: str, by: list[str], max_rows: int | None = None) -> None:
    """Parquet partitioned by columns; with max_rows files are cut at so many rows."""
    w = df.write.partitionBy(*by).option("compression", "zstd")
    (w.option("maxRecordsPerFile", max_rows) if max_rows else w).parquet(path)


def replicated(df: DataFrame, shards: int, col: str = "shard") -> DataFrame:
    """Every row once in every shard (evaluation data beside each training shard)."""
    return df.withColumn(col, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))


def checked_vectors(df: DataFrame, col: str, dim: int) -> DataFrame:
    """Fails at run time on a vector of another dimension."""
    return df.withColumn(col, F.when(F.size(col) == dim, F.col(col)).otherwise(F.raise_error(F.lit(f"vector dimension is not {dim}"))))


def sampled_vectors(df: DataFrame, id_col: str, col: str, share: float = 1.0, half: bool = False, seed: int = 0) -> DataFrame:
    """About a share of the rows, the same ones on every run, to be written; half: entries rounded to half precision (kept as floats)."""
    from loomline.operators.sampling import md5_bucket

    own = df.where(md5_bucket(1_000, id_col, seed=seed) < round(share * 1_000))
    return own.withColumn(col, rounded_half(F.col(col))) if half else own


def rounded_half(c: Column) -> Column:
    """Floats rounded to eleven significant bits, the precision of half floats within their normal range; smaller ones to 2**-24."""
    def one(x: Column) -> Column:
        step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.abs(x))) - 10, F.lit(-24)))
        return F.when((x == 0) | x.isNull() | F.isnan(x), x).otherwise((F.rint(x.cast("double") / step) * step).cast("float"))

    return F.transform(c, one)


def write_filtered(df: DataFrame, counts: DataFrame, path: str, by: str) -> None:
    """Kept rows by group as Parquet, and beside them the counters with a total of all groups."""
    df.write.partitionBy(by).option("compression", "zstd").parquet(f"{path}/rows")
    numbers = [c for c, t in counts.dtypes if t in ("bigint", "int") and c != by]
    total = counts.agg(*(F.sum(c).alias(c) for c in numbers)).withColumn(by, F.lit("total"))
    counts.select(by, *numbers).unionByName(total.select(by, *numbers)).coalesce(1).write.json(f"{path}/counters")


def write_bitext_meta(pairs: DataFrame, path: str, score: str, left: str, right: str, meta: str) -> None:
    """The bitext TSV and, in the same order of rows, the metadata TSV."""
    write_bitext(pairs, f"{path}/bitext", score, left, right)
    write_tsv(pairs, f"{path}/meta", [meta])
