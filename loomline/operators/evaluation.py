"""Evaluation of translations and alignments: BLEU, alignment error, contribution matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import char_ngrams


def _grams(words: Column, n: int) -> Column:
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - n + 1)), lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))).otherwise(F.expr("array()").cast("array<string>"))


def bleu(df: DataFrame, group: str, id_col: str, hyp: str, ref: str, most: int = 4) -> DataFrame:
    """Corpus BLEU per group: clipped n-gram precisions, geometric mean, brevity penalty; 0 if a precision is 0."""
    w = df.select(F.col(group).alias("g"), F.col(id_col).alias("i"), F.split(F.col(hyp), " ").alias("h"), F.split(F.col(ref), " ").alias("r"))
    lengths = w.groupBy("g").agg(F.sum(F.size("h")).alias("hyp_len"), F.sum(F.size("r")).alias("ref_len"))
    def tagged(c: str, side: int) -> Column:
        # a lambda of a higher-order function takes its second argument as the index, so n is bound outside
        of = lambda n: F.transform(_grams(F.col(c), n), lambda x: F.struct(F.lit(n).alias("n"), x.alias("x"), F.lit(side).alias("s")))
        return F.flatten(F.array(*(of(n) for n in range(1, most + 1))))

    one = w.select("g", "i", F.inline(F.concat(tagged("h", 0), tagged("r", 1))))
    per = one.groupBy("g", "i", "n", "x").agg(F.count_if(F.col("s") == 0).alias("ch"), F.count_if(F.col("s") == 1).alias("cr"))
    by_n = per.groupBy("g", "n").agg(F.sum(F.least("ch", "cr")).alias("hit"), F.sum("ch").alias("all"))
    p = by_n.groupBy("g").agg(F.sum(F.when(F.col("hit") > 0, F.ln(F.col("hit") / F.col("all")))).alias("logs"), F.count_if(F.col("hit") > 0).alias("found"))
    brief = F.when(F.col("hyp_len") >= F.col("ref_len"), F.lit(1.0)).otherwise(F.exp(1 - F.col("ref_len") / F.col("hyp_len")))
    score = F.when(F.col("found") == most, 100 * brief * F.exp(F.col("logs") / most)).otherwise(F.lit(0.0))
    return lengths.join(p, "g").select(F.col("g").alias(group), "hyp_len", "ref_len", score.alias("bleu"))


def chrf(df: DataFrame, group: str, id_col: str, hyp: str, ref: str, most: int = 6, beta: float = 2.0) -> DataFrame:
    """Corpus chrF per group, 0 to 100: precision and recall of character n-grams without blanks, averaged over the orders that
    occur on either side, as an F measure with recall weighted beta times. Rows without both sides don't count."""
    own = df.where(F.col(hyp).isNotNull() & F.col(ref).isNotNull()).select(F.col(group).alias("g"), F.col(id_col).alias("i"), F.col(hyp).alias("h"), F.col(ref).alias("r"))

    def tagged(c: str, side: int) -> Column:
        of = lambda n: F.transform(char_ngrams(F.col(c), n), lambda x: F.struct(F.lit(n).alias("n"), x.alias("x"), F.lit(side).alias("s")))
        return F.flatten(F.array(*(of(n) for n in range(1, most + 1))))

    per = own.select("g", "i", F.inline(F.concat(tagged("h", 0), tagged("r", 1)))).groupBy("g", "i", "n", "x").agg(F.count_if(F.col("s") == 0).alias("ch"), F.count_if(F.col("s") == 1).alias("cr"))
    by_n = per.groupBy("g", "n").agg(F.sum(F.least("ch", "cr")).alias("hit"), F.sum("ch").alias("ah"), F.sum("cr").alias("ar"))
    ratio = lambda a: F.avg(F.coalesce(F.try_divide(F.col("hit"), F.col(a)), F.lit(0.0)))
    pr = by_n.groupBy("g").agg(ratio("ah").alias("p"), ratio("ar").alias("r"))
    score = F.coalesce(100 * (1 + beta**2) * F.try_divide(F.col("p") * F.col("r"), beta**2 * F.col("p") + F.col("r")), F.lit(0.0))
    return pr.select(F.col("g").alias(group), score.alias("chrf"))


def rollout(df: DataFrame, id_col: str, layers: str) -> DataFrame:
    """(id, matrix): contributions through all layers of each row's square attention matrices (layers by rows by columns): each with its
    rows made to sum to 1 and half the identity added for the residual, multiplied from the first layer to the last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column("x").to_pylist():
                whole = None
                for layer in x or []:
                    a = np.array(layer, np.float64)
                    a = 0.5 * a / np.maximum(a.sum(1, keepdims=True), 1e-12) + 0.5 * np.eye(len(a))
                    whole = a if whole is None else a @ whole
                out.append(whole.tolist() if whole is not None else None)
            yield pa.record_batch([b.column("id"), pa.array(out, pa.list_(pa.list_(pa.float64())))], names=["id", "matrix"])

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("id"), F.col(layers).alias("x")).mapInArrow(run, f"id {kind}, matrix array<array<double>>")


def alignment_error(df: DataFrame, sure: str, possible: str, found: str) -> DataFrame:
    """Alignment error rate, precision and recall over arrays of links; one row."""
    both = lambda a, b: F.sum(F.size(F.array_intersect(a, b)))
    s = df.agg(both(found, possible).alias("ap"), both(found, sure).alias("as_"), F.sum(F.size(F.array_distinct(found))).alias("a"), F.sum(F.size(F.array_distinct(sure))).alias("s"))
    one = F.lit(1)
    return s.select(
        (1 - (F.col("ap") + F.col("as_")) / F.greatest(one, F.col("a") + F.col("s"))).alias("aer"),
        (F.col("ap") / F.greatest(one, F.col("a"))).alias("precision"), (F.col("as_") / F.greatest(one, F.col("s"))).alias("recall"),
    )


def contribution_metrics(m: Column, n_src: Column, skip_first: bool = False) -> Column:
    """Struct of sentence measures of a contribution matrix (rows: target tokens, columns: source tokens and then
    the prefix). Only the first n_src columns count; with skip_first the first row, a special token, doesn't."""
    sc = F.transform(F.slice(m, F.lit(2), F.greatest(F.size(m), F.lit(1))) if skip_first else m, lambda row: F.slice(row, F.lit(1), n_src))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    mean = lambda a: total(a) / F.size(a)
    columns = F.transform(F.sequence(F.lit(0), n_src - 1), lambda j: F.transform(sc, lambda row: F.get(row, j)))
    by_tgt, top_tgt = F.transform(sc, total), F.transform(sc, F.array_max)
    by_src, top_src = F.transform(columns, total), F.transform(columns, F.array_max)
    share = lambda a, f: F.size(F.filter(a, f)) / F.size(a)
    at_least = lambda t: lambda x: x >= t / 100
    whole = total(by_tgt)
    without_last = F.transform(sc, lambda row: total(F.slice(row, F.lit(1), n_src - 1)))
    return F.struct(
        mean(by_tgt).alias("avg_sc"), F.array_min(by_tgt).alias("min_sc"), mean(top_tgt).alias("top_sc_mean"), F.array_min(top_tgt).alias("top_sc_min"),
        *(share(by_tgt, at_least(t)).alias(f"sc_above_{t}") for t in (50, 40, 30, 20, 10)),
        (1 - total(F.transform(sc, lambda row: F.element_at(row, -1))) / whole).alias("sc_share_wo_eos"), mean(without_last).alias("avg_sc_wo_eos"),
        F.when(F.size(by_tgt) > 1, mean(F.slice(by_tgt, F.lit(2), F.size(by_tgt)))).alias("avg_sc_wo_lang"),
        total(F.transform(by_tgt, lambda x: -(x / whole) * F.ln(x / whole))).alias("sc_entropy"),
        share(top_src, lambda x: x < 0.01).alias("src_max_contr_below_001"), F.array_min(top_src).alias("src_max_contr_min"),
        share(by_src, lambda x: x < 0.1).alias("src_sum_contr_below_01"), mean(by_src).alias("src_sum_contr_mean"), F.array_min(by_src).alias("src_sum_contr_min"),
    )


def matrix_links(m: Column, threshold: float = 0.08) -> Column:
    """array<struct<tgt,src>> of the cells above a threshold."""
    cells = F.flatten(F.transform(m, lambda row, i: F.transform(row, lambda x, j: F.struct(i.alias("tgt"), j.alias("src"), x.alias("x")))))
    return F.transform(F.filter(cells, lambda c: c["x"] > threshold), lambda c: F.struct(c["tgt"].alias("tgt"), c["src"].alias("src")))


def mlp_scores(df: DataFrame, id_col: str, features: str, layers: list[tuple[np.ndarray, np.ndarray]], activation: str = "tanh") -> DataFrame:
    """(id, score) of a feed-forward network with given weights, by matrix products per Arrow batch."""
    act = {"tanh": np.tanh, "relu": lambda x: np.maximum(x, 0)}[activation]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
            for k, (w, c) in enumerate(layers):
                x = x @ w + c
                x = act(x) if k < len(layers) - 1 else x
            yield pa.record_batch([b.column("id"), pa.array(x[:, 0])], names=["id", "score"])

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("id"), F.col(features).alias("x")).mapInArrow(run, f"id {kind}, score double")


def hashed_embedding(df: DataFrame, id_col: str, text: str, dim: int = 64, order: int = 3) -> DataFrame:
    """(id, embedding): deterministic stand-in for a sentence encoder: signed hashed character n-grams, unit length.
    Any function of this shape can take its place. A null or empty text has a zero vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.zeros((b.num_rows, dim), np.float64)
            for i, t in enumerate(b.column("t").to_pylist()):
                c = np.frombuffer((t or "").lower().encode("utf-32-le"), np.uint32).astype(np.uint64)
                if len(c):
                    n = max(1, len(c) - order + 1)
                    h = np.zeros(n, np.uint64)
                    for k in range(min(order, len(c))):
                        h = (h ^ c[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
                        h ^= h >> np.uint64(29)
                    h = np.unique(h)
                    np.add.at(rows[i], (h % np.uint64(dim)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0))
            rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(rows.astype(np.float32).reshape(-1)), dim).cast(pa.list_(pa.float32()))
            yield pa.record_batch([b.column("id"), flat], names=["id", "embedding"])

    kind = dict(df.dtypes)[id_col]
    return df.select(F.col(id_col).alias("id"), F.col(text).alias("t")).mapInArrow(run, f"id {kind}, embedding array<float>")
