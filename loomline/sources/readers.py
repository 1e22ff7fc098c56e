"""Readers of corpora: lines, header and headerless TSV, mined pairs, parallel files, arrays."""

from __future__ import annotations

import io
import lzma
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.session import maybe_broadcast


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, text) of plain, .gz or .xz text; line_no from 0 within each file, broken bytes replaced.

    Plain files are read in splits, so they may be of any size: lines are numbered within a split and shifted by the
    lines of the splits before. Compressed files are one unit of work each.
    """
    src = spark.read.option("lineSep", "\n").option("pathGlobFilter", "{*.gz,*[^z]}").text(path)
    rows = src.select(F.expr("make_valid_utf8(value)").alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))
    per = rows.groupBy("file", "at").agg(F.count(F.lit(1)).alias("lines"), F.min("n").alias("first"))
    # one row for each split of a file
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = maybe_broadcast(per.select(F.col("file").alias("f"), F.col("at").alias("a"), "first", before.alias("before")))
    met = rows.join(starts, (F.col("file") == F.col("f")) & (F.col("at") == F.col("a")))
    return met.select("file", (F.col("before") + F.col("n") - F.col("first")).alias("line_no"), "text").unionByName(_packed_lines(spark, path))


def _packed_lines(spark: SparkSession, path: str) -> DataFrame:
    """read_lines() of .xz files, for which Spark has no codec."""
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf.path, pdf.content, strict=True):
                held: list[str] = []
                at = 0
                for line in lzma.open(io.BytesIO(data)):
                    held.append(line.decode("utf-8", errors="replace").rstrip("\n"))
                    if len(held) >= 10_000:
                        yield pd.DataFrame({"file": name, "line_no": range(at, at + len(held)), "text": held})
                        at, held = at + len(held), []
                if held:
                    yield pd.DataFrame({"file": name, "line_no": range(at, at + len(held)), "text": held})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xz").load(path)
    return files.select("path", "content").mapInPandas(run, "file string, line_no long, text string")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """(text) of splittable text without line numbers: the scalable scan."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """TSV with a header line; with columns only these, an unknown one is an error."""
    df = spark.read.csv(path, sep="\t", header=True, quote="", escape="")
    missing = set(columns or ()) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.select(*columns) if columns else df


def read_mined(spark: SparkSession, path: str) -> DataFrame:
    """(score, src, tgt) of headerless mined TSV; both sides stripped."""
    df = spark.read.csv(path, sep="\t", schema="score double, src string, tgt string", quote="", escape="")
    return df.select("score", F.trim("src").alias("src"), F.trim("tgt").alias("tgt"))


def read_parallel(spark: SparkSession, src: str, tgt: str, meta: str | None = None) -> DataFrame:
    """(line_no, src, tgt[, meta]) of files aligned by position; the shortest decides, metadata may be missing."""
    one = lambda p, n: read_lines(spark, p).select("line_no", F.trim("text").alias(n))
    out = one(src, "src").join(one(tgt, "tgt"), "line_no")
    return out.join(one(meta, "meta"), "line_no", "left") if meta else out


def line_range(df: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Rows with start <= line_no < end; None is open."""
    df = df.where(F.col("line_no") >= start) if start is not None else df
    return df.where(F.col("line_no") < end) if end is not None else df


def read_npy(spark: SparkSession, path: str, dim: int | None = None, dtype: str = "float32") -> DataFrame:
    """(file, row, embedding) of .npy arrays of half or single floats; a file without a header needs a dim."""
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf.path, pdf.content, strict=True):
                if data[:6] == b"\x93NUMPY":
                    a = np.load(io.BytesIO(data), allow_pickle=False)
                elif dim:
                    a = np.frombuffer(data, dtype).reshape(-1, dim)
                else:
                    raise ValueError(f"{name} has no header and no dimension is given")
                for at in range(0, len(a), 10_000):
                    part = a[at : at + 10_000].astype(np.float32)
                    yield pd.DataFrame({"file": name, "row": range(at, at + len(part)), "embedding": list(part)})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, row long, embedding array<float>")


def shard_id(name: Column) -> Column:
    """Number between dots in a file name, 0 if there is none."""
    n = F.regexp_extract(name, r"\.([0-9]{3})\.", 1)
    return F.when(n == "", F.lit(0)).otherwise(n.cast("int"))


def tagged_lines(df: DataFrame, tag: str, column: int, text: str = "text") -> DataFrame:
    """Column of the tab-separated lines that begin with a tag, as in the output of a translator."""
    return df.where(F.col(text).startswith(tag)).select(F.get(F.split(text, "\t"), column).alias("value"))


def parse_scores(df: DataFrame, text: str = "text") -> DataFrame:
    """(checkpoint, split, bleu) of score lines `checkpoint split BLEU = x, ...`."""
    p = r"^(\S+)\s+(\S+)\s+BLEU\S*\s*=\s*([0-9]+(?:\.[0-9]+)?)"
    return df.where(F.col(text).rlike(p)).select(F.regexp_extract(text, p, 1).alias("checkpoint"), F.regexp_extract(text, p, 2).alias("split"), F.regexp_extract(text, p, 3).cast("double").alias("bleu"))


def split_meta(line: Column, corpus: Column, first: tuple[str, ...] = ("cc200xl", "ia2022"), last: tuple[str, ...] = ("paracrawl",)) -> Column:
    """struct(text, meta): content before the metadata or, for some corpora, after it."""
    after = F.lit(False)
    for p in last:
        after = after | corpus.startswith(p)
    parts = F.split(line, "\t")
    head = F.struct(F.get(parts, 0).alias("text"), F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), "\t").alias("meta"))
    tail = F.struct(F.element_at(parts, -1).alias("text"), F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "\t").alias("meta"))
    return F.when(after, tail).otherwise(head)


def split_row(line: Column, meta_fields: int = 5) -> Column:
    """struct(meta array, text) of white-space separated fields, of which the first ones are metadata."""
    parts = F.filter(F.split(line, r"\s+"), lambda x: x != "")
    return F.struct(F.slice(parts, 1, meta_fields).alias("meta"), F.array_join(F.slice(parts, meta_fields + 1, F.greatest(F.size(parts), F.lit(1))), " ").alias("text"))


def lookup_language(df: DataFrame, lang: str, table: DataFrame, source: str, target: str) -> DataFrame:
    """df with `target` of a fixed equivalence table; a language without an entry stands for itself."""
    small = maybe_broadcast(table.select(F.col(source).alias("__k"), F.col(target).alias("__v")).dropDuplicates(["__k"]))
    return df.join(small, df[lang] == small["__k"], "left").withColumn(target, F.coalesce("__v", lang)).drop("__k", "__v")


#: Script of languages by the beginning of their codes; the first that fits counts.
LANGUAGE_SCRIPTS = {
    "rus": "Cyrl", "ukr": "Cyrl", "bul": "Cyrl", "ell": "Grek", "heb": "Hebr", "arb": "Arab", "hin": "Deva", "ben": "Beng", "tha": "Thai", "kor": "Hang", "jpn": "Jpan", "zho": "Hans",
    "eng": "Latn", "fra": "Latn", "deu": "Latn", "spa": "Latn", "ita": "Latn", "por": "Latn", "nld": "Latn",
}


def language_script(lang: Column, scripts: dict[str, str] | None = None) -> Column:
    """Script of a language: what its code names after an underscore, else that of the first table entry it begins with; null if none fits."""
    named = F.regexp_extract(lang, r"_([A-Z][a-z]{3})$", 1)
    found = F.coalesce(*(F.when(lang.startswith(k), F.lit(v)) for k, v in (scripts or LANGUAGE_SCRIPTS).items()))
    return F.when(named != "", named).otherwise(found)


def split_at(df: DataFrame, line: str, k: int, sep: str = "\t") -> DataFrame:
    """df with meta (the first k fields, joined) and text (the field after them); rows with fewer than two fields, or
    without the text field, are dropped."""
    parts = F.split(line, sep)
    out = df.withColumn("__p", parts).where((F.size("__p") >= 2) & (F.size("__p") > k))
    return out.withColumn("meta", F.array_join(F.slice("__p", 1, max(k, 1)), sep) if k else F.lit("")).withColumn("text", F.get("__p", F.lit(k))).drop("__p")


def skip_header(df: DataFrame, rows: int = 1) -> DataFrame:
    """(line_no, text) of read_lines() without the first lines of each file, numbered from 0 after them."""
    return df.where(F.col("line_no") >= rows).withColumn("line_no", F.col("line_no") - rows)
