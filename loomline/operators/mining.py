"""Bitext mining: nearest-neighbour joins, margins, candidate selection and text lookup."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.vector import margin, similarity
from loomline.session import written


def index_kind(rows: int) -> str:
    """Search strategy by the number of indexed rows."""
    return "exact" if rows <= 10_000 else "cells"


#: Cells a query looks into.
PROBES = 32


def neighbor_rows(lists: DataFrame) -> DataFrame:
    """(src_id, direction, rank, tgt_id, dist) of neighbour lists; repeated lists count once, entries of -1 are none."""
    flat = lists.select("src_id", "direction", "indices", "dists").dropDuplicates(["src_id", "direction"])
    flat = flat.select("src_id", "direction", F.posexplode(F.arrays_zip("indices", "dists")).alias("rank", "x"))
    return flat.select("src_id", "direction", "rank", F.col("x.indices").alias("tgt_id"), F.col("x.dists").cast("double").alias("dist")).where("tgt_id >= 0")


def margins(neighbors: DataFrame, kind: str = "ratio", norm: str = "mean") -> DataFrame:
    """neighbors with the margin of each pair: its similarity against the average of the mean (or last) similarities
    of both ends. A target without a list of its own has no margin and drops out."""
    sim = neighbors.withColumn("sim", similarity(F.col("dist")))
    own = F.avg("sim") if norm == "mean" else F.max_by("sim", "rank")
    per = sim.groupBy("src_id", "direction").agg(own.alias("avg"))
    ends = per.select(F.col("src_id").alias("tgt_id"), F.col("avg").alias("avg_t"))
    both = sim.join(per, ["src_id", "direction"]).join(ends.groupBy("tgt_id").agg(F.max("avg_t").alias("avg_t")), "tgt_id")
    return both.select("src_id", "direction", "rank", "tgt_id", "sim", margin(F.col("sim"), F.col("avg"), F.col("avg_t"), kind).alias("margin"))


def mine(neighbors: DataFrame, threshold: float = 1.06, k_extract: int = 1, kind: str = "ratio", norm: str = "mean", mine_type: str = "union", resort: bool = True) -> DataFrame:
    """(score, x_id, y_id, direction): of each query its k_extract best candidates of at least the threshold.

    x2y candidates come out as (query, target), y2x ones as (target, query). union keeps both bags, so a
    pair found both ways stands twice; intersection keeps pairs found both ways, with the larger score.
    """
    order = [F.desc("margin"), F.asc("rank")] if resort else [F.asc("rank")]
    best = margins(neighbors, kind, norm).withColumn("rn", F.row_number().over(Window.partitionBy("src_id", "direction").orderBy(*order, "tgt_id")))
    best = best.where((F.col("rn") <= k_extract) & (F.col("margin") >= threshold))
    fwd = best.where("direction = 'x2y'").select(F.col("margin").alias("score"), F.col("src_id").alias("x_id"), F.col("tgt_id").alias("y_id"), F.lit("fwd").alias("direction"))
    bwd = best.where("direction = 'y2x'").select(F.col("margin").alias("score"), F.col("tgt_id").alias("x_id"), F.col("src_id").alias("y_id"), F.lit("bwd").alias("direction"))
    if mine_type == "forward":
        return fwd
    if mine_type == "backward":
        return bwd
    both = fwd.unionByName(bwd)
    if mine_type == "union":
        return both
    return both.groupBy("x_id", "y_id").agg(F.max("score").alias("score"), F.count_distinct("direction").alias("n")).where("n = 2").select("score", "x_id", "y_id", F.lit("both").alias("direction"))


def with_texts(pairs: DataFrame, texts: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """Join both ends of mined pairs to a table of their texts or metadata; pairs with a missing end fall out."""
    left = texts.select(F.col(id_col).alias("x_id"), *(F.col(c).alias(f"x_{c}") for c in cols))
    right = texts.select(F.col(id_col).alias("y_id"), *(F.col(c).alias(f"y_{c}") for c in cols))
    return pairs.join(left, "x_id").join(right, "y_id")


def _top(q_ids, q, x_ids, x, k):
    s = q @ x.T
    s[q_ids[:, None] == x_ids[None, :]] = -np.inf
    m = min(k, s.shape[1])
    best = np.argpartition(-s, m - 1, axis=1)[:, :m]
    cos = np.take_along_axis(s, best, 1)
    keep = np.isfinite(cos)
    rows = np.repeat(np.arange(len(q_ids)), m).reshape(-1, m)[keep]
    return q_ids[rows], x_ids[best[keep]], cos[keep]


def _units(col, dim):
    e = col.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return e / np.linalg.norm(e, axis=1, keepdims=True)


def _block(dim: int, k: int):
    def run(q: pa.Table, x: pa.Table) -> pa.Table:
        out: list[tuple] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if q.num_rows and x.num_rows:
            qi, qe, xi, xe = q.column("id").to_numpy(), _units(q.column("vec"), dim), x.column("xid").to_numpy(), _units(x.column("xvec"), dim)
            out += [_top(qi[a : a + 512], qe[a : a + 512], xi[b : b + 4_096], xe[b : b + 4_096], k) for a in range(0, len(qi), 512) for b in range(0, len(xi), 4_096)]
        return pa.table([np.concatenate([o[i] for o in out]) for i in range(3)], names=["q_id", "x_id", "cos"])

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q_id").orderBy(F.desc("c"), "x_id")
    return found.withColumn("c", F.round("cos", 10)).distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("q_id", "rank", "x_id", F.col("c").alias("cos"))


def exact_neighbors(queries: DataFrame, index: DataFrame, dim: int, k: int = 5, block_rows: int = 4_096) -> DataFrame:
    """(q_id, rank, x_id, cos): the k nearest rows of index (id, vec) of every query (id, vec), itself left out.

    Exact, by matrix products of blocks: every block of queries meets every block of the index once, and the best
    of the blocks are merged. Meant for a query set far smaller than the index.
    """
    nq, nx = queries.count(), index.count()
    bq, bx = max(1, -(-nq // block_rows)), max(1, -(-nx // block_rows))
    q = queries.select("id", "vec", F.pmod(F.xxhash64("id"), F.lit(bq)).cast("int").alias("qb")).withColumn("xb", F.explode(F.sequence(F.lit(0), F.lit(bx - 1))))
    x = index.select(F.col("id").alias("xid"), F.col("vec").alias("xvec"), F.pmod(F.xxhash64("id"), F.lit(bx)).cast("int").alias("xb2")).withColumn("qb2", F.explode(F.sequence(F.lit(0), F.lit(bq - 1))))
    found = q.groupBy("qb", "xb").cogroup(x.groupBy("qb2", "xb2")).applyInArrow(_block(dim, k + 1), "q_id long, x_id long, cos double")
    return _ranked(found, k)


def fit_cells(index: DataFrame, dim: int, cells: int, sample: int = 20_000, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Spherical k-means centres of at most `sample` rows picked by a hash of their id."""
    rows = index.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample).select("vec").toPandas().vec
    e = np.stack(rows.to_numpy()).astype(np.float64) if len(rows) else np.zeros((1, dim))
    e /= np.maximum(np.linalg.norm(e, axis=1, keepdims=True), 1e-12)
    r = np.random.default_rng(seed)
    c = e[r.permutation(len(e))[: min(cells, len(e))]]
    for _ in range(rounds):
        own = (e @ c.T).argmax(1)
        s = np.zeros_like(c)
        np.add.at(s, own, e)
        n = np.linalg.norm(s, axis=1, keepdims=True)
        c = np.where(n > 0, s / np.maximum(n, 1e-12), c)
    return c


def _assign(centres: np.ndarray, dim: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = min(probes, len(centres))
                near = np.argpartition(-(_units(pa.chunked_array([b.column("vec")]), dim) @ centres.T), m - 1, axis=1)[:, :m]
                rows = pa.array(np.repeat(np.arange(b.num_rows), m))
                yield pa.record_batch([b.column("id").take(rows), b.column("vec").take(rows), pa.array(near.reshape(-1).astype(np.int32))], names=["id", "vec", "cell"])

    return run


def cell_neighbors(queries: DataFrame, index: DataFrame, dim: int, k: int = 5, cells: int | None = None, probes: int | None = None, part_rows: int = 20_000) -> DataFrame:
    """As exact_neighbors, but a query looks only into the `probes` cells whose centres are nearest to it.

    Every row of the index is in a cell. A large cell is cut into parts of about part_rows rows, which its
    queries all visit, so no cell has to fit in a task. probes is a fixed number, so a query's work grows with the root
    of the index (rows of a cell), not with the index.
    """
    n = index.count()
    cells = cells or max(1, int(np.sqrt(n)))
    probes = probes or PROBES
    centres = fit_cells(index, dim, cells)
    x = written(index.select("id", "vec").mapInArrow(_assign(centres, dim, 1), "id long, vec array<float>, cell int"), "cells")
    q = queries.select("id", "vec").mapInArrow(_assign(centres, dim, probes), "id long, vec array<float>, cell int")
    parts = F.broadcast(x.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("parts")))  # at most `cells` rows
    xp = x.join(parts, "cell").select(F.col("id").alias("xid"), F.col("vec").alias("xvec"), F.col("cell").alias("xcell"), F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("xpart"))
    qp = q.join(parts, "cell").select("id", "vec", F.col("cell").alias("qcell"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("qpart"))
    found = qp.groupBy("qcell", "qpart").cogroup(xp.groupBy("xcell", "xpart")).applyInArrow(_block(dim, k + 1), "q_id long, x_id long, cos double")
    return _ranked(found, k)


def score_window(pairs: DataFrame, low: float, high: float, score: str = "score") -> DataFrame:
    return pairs.where(F.col(score).between(low, high))


def merge_sorted(pairs: DataFrame, left: str, right: str, score: str, id_col: str) -> DataFrame:
    """Score-sorted union of shards without repeated text pairs; the best score stays."""
    from loomline.operators.dedup import best_of

    return best_of(pairs, [left, right], score, id_col).orderBy(F.desc(score), id_col)


