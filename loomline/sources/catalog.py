"""Finding corpora: shards, parallel pairs, manifests, and facts read from file headers."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.sources.readers import shard_id


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, name, bytes) of the files below a folder; the contents aren't read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))


def find_shards(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """Shards of a corpus in the order of their numbers; none is an error."""
    out = list_files(spark, root, glob).withColumn("shard", shard_id(F.col("name"))).orderBy("shard", "name")
    if out.isEmpty():
        raise FileNotFoundError(f"no shards match {glob} below {root}")
    return out


def corpus_pairs(files: DataFrame, pattern: str = r"^(.*)\.([a-z]{3}(?:_[A-Z][a-z]{3})?)(?:\.gz|\.xz)?$", exclude: tuple[str, ...] = ()) -> DataFrame:
    """(direction, corpus, src, tgt) of files `corpus.lang` in folders named `src-tgt`; a corpus without its partner
    or named in exclude is left out."""
    x = files.withColumn("corpus", F.regexp_extract("name", pattern, 1)).withColumn("lang", F.regexp_extract("name", pattern, 2))
    x = x.withColumn("direction", F.element_at(F.split("path", "/"), -2)).where("corpus <> ''").where(~F.col("corpus").isin(*exclude) if exclude else F.lit(True))
    d = F.split("direction", "-")
    side = lambda i, n: x.where(F.col("lang") == F.get(d, i)).select("direction", "corpus", F.col("path").alias(n))
    return side(0, "src").join(side(1, "tgt"), ["direction", "corpus"])


def corpora_of(config: dict) -> list[tuple[str, str, str]]:
    """(fold, direction, corpus) of a nested configuration; the name `total` is reserved."""
    out = [(fold, direction, corpus) for fold, ds in config.items() for direction, cs in (ds or {}).items() for corpus in (cs or {})]
    if any(c == "total" for _, _, c in out):
        raise ValueError("a corpus must not be named total")
    return out


def manifest_chunks(df: DataFrame, order: str, chunks: int) -> DataFrame:
    """Rows in `chunks` consecutive parts of equal size, the last with the rest; the order tells all rows apart."""
    from loomline.operators.analytics import with_totals
    from loomline.operators.records import numbered

    n = with_totals(numbered(df, [order], "__row"), df.agg(F.count(F.lit(1)).alias("__n")))
    size = F.greatest(F.lit(1), F.floor(F.col("__n") / chunks))
    return n.withColumn("chunk", F.least(F.floor(F.col("__row") / size), F.lit(chunks - 1)).cast("int")).drop("__n", "__row")


def wav_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(name, duration_ms) of the wave files of a folder, from their headers; a broken file has a null duration."""
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for data in pdf.content:
                try:
                    with wave.open(io.BytesIO(data)) as w:
                        out.append(round(1000 * w.getnframes() / w.getframerate()))
                except (wave.Error, EOFError):
                    out.append(None)
            yield pd.DataFrame({"name": pdf.path.str.rsplit("/", n=1).str[-1], "duration_ms": pd.array(out, "Int64")})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(root).select("path", "content").mapInPandas(run, "name string, duration_ms long")


def read_alignments(spark: SparkSession, path: str, low: float = float("-inf"), high: float = float("inf")) -> DataFrame:
    """(score, src_idx, tgt_idx, direction) of an .npz file of mined pairs within a score window, best first."""
    import numpy as np
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for data in pdf.content:
                z = np.load(io.BytesIO(data), allow_pickle=False)
                n = len(z["scores"])
                back = int(z["bwd_pos"]) if "bwd_pos" in z else n
                yield pd.DataFrame({"score": z["scores"].astype(float), "src_idx": z["src_idx"].astype("int64"), "tgt_idx": z["tgt_idx"].astype("int64"), "direction": np.where(np.arange(n) < back, "fwd", "bwd")})

    df = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "score double, src_idx long, tgt_idx long, direction string")
    return df.where(F.col("score").between(low, high)).orderBy(F.desc("score"), "src_idx", "tgt_idx")


def row_counts(df: DataFrame, by: list[Column]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def best_checkpoint(scores: DataFrame, select: str = "valid", report: str = "test") -> DataFrame:
    """(checkpoint, select score, report score) of the checkpoint that is best on one split; one row."""
    best = scores.where(F.col("split") == select).agg(F.max_by("checkpoint", F.struct("bleu", "checkpoint")).alias("checkpoint"), F.max("bleu").alias("select_score"))
    return best.join(scores.where(F.col("split") == report).select("checkpoint", F.col("bleu").alias("report_score")), "checkpoint", "left")
