"""Problem 2: the k most similar vectors of every vector, by shifted Hilbert orderings.

Vectors are projected on a few random orthogonal directions, shifted by a random offset and
numbered along a Hilbert curve; several such orderings differ in directions and offset.
Spark range-partitions and sorts each ordering. A range of it, tens of thousands of vectors near each
other, is ordered again along curves of its own; in each ordering every window of rows is compared with
itself and the windows before and after by whole-vector cosines, and the best of all orderings are
merged and ranked by exact cosines. The number of orderings grows with the number of vectors, so
that recall doesn't fall. Equal vectors are represented once, with their smallest ids, so that any number
of copies costs nothing. Vectors of a group too dense for a window (parallel or almost equal ones)
are found by how many rows of a window are close to them, and are compared with all vectors in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.session import dropped, skew_join, written

WINDOW, DIMS, BITS = 128, 12, 5
#: Rows of a range: a sixth of all, within these bounds.
LEAST_RANGE, MOST_RANGE = 4_096, 65_536
#: Share of pairs at the least similarity of interest that all ranges together may miss.
MISSED = 0.01
#: A vector is crowded if more than a window's rows within three windows have this cosine with it; rows of a block of the exact search.
CONE, BLOCK = 0.85, 16_384


def range_rows(vectors: int) -> int:
    """Rows of a range of an ordering of so many vectors."""
    return max(LEAST_RANGE, min(MOST_RANGE, vectors // 6))


def orderings(vectors: int, missed: float = MISSED) -> int:
    """Orderings needed so that two vectors of cosine 0.85 share the range of at least one but for a share of
    `missed`. Each halving of the vectors keeps such a pair together with probability 0.81 (measured; the two sides of a
    random plane do so with 1 - arccos(0.85) / pi = 0.82)."""
    together = 0.96 * 0.81 ** max(0.0, math.log2(max(1, vectors) / range_rows(vectors)))
    return max(2, math.ceil(math.log(missed) / math.log(1 - together)))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of non-negative cell numbers below 2**bits.

    Works on all points at once: from the highest bit down, reflect and exchange axes so that
    the sub-cube gets the orientation of the curve in it, Gray-decode, then interleave.
    """
    axes = [a.astype(np.int64) for a in np.asarray(cells).T]
    dims = len(axes)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            inside = (axes[i] & bit) != 0
            swap = np.where(inside, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = axes[0] ^ np.where(inside, low, swap)
            if i:
                axes[i] = axes[i] ^ swap
    for i in range(1, dims):
        axes[i] = axes[i] ^ axes[i - 1]
    carry = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        carry ^= np.where((axes[-1] & (1 << level)) != 0, (1 << level) - 1, 0)
    key = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for a in axes:
            key = (key << 1) | (((a ^ carry) >> level) & 1)
    return key


def _curve(number: int, dim: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(7919 + number)
    q, _ = np.linalg.qr(r.standard_normal((dim, min(dims, dim))))
    return q, r.random(min(dims, dim))


def _cells(units: np.ndarray, directions: np.ndarray, shift: np.ndarray, bits: int) -> np.ndarray:
    """Cell numbers of unit vectors; 70 % of an axis holds the data, the rest leaves room for the offset."""
    at = ((units @ directions.astype(units.dtype)) * (np.sqrt(units.shape[1]) / 6.4) + 0.5) * 0.7 + 0.3 * shift
    return np.clip(at * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)


def _units(col: pa.Array, dim: int) -> np.ndarray:
    e = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return e / np.linalg.norm(e, axis=1, keepdims=True)


def _keys(dim: int, curves: int, dims: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = [_curve(c, dim, dims) for c in range(curves)]
        for b in batches:
            if not b.num_rows:
                continue
            e = _units(b.column("vec"), dim)
            for c, (directions, shift) in enumerate(drawn):
                n = b.num_rows
                yield pa.record_batch(
                    [pa.array(np.full(n, c, np.int32)), pa.array(hilbert_keys(_cells(e, directions, shift, bits), bits)), b.column("id"), b.column("vec")],
                    names=["curve", "key", "id", "vec"],
                )

    return run


def _best(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, keep: int, cone: float):
    """Ids and cosines (to ten decimals) of the `keep` best candidates of each row, of equal cosines the
    smaller ids, and how many candidates reach the cosine `cone`."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    s = q @ c.T
    s[q_ids[:, None] == c_ids[None, :]] = -np.inf
    close = (s >= cone).sum(1)
    # whole numbers of 1e-10, less a fraction by the place in order of id: no ties are left
    s *= 1e10
    np.rint(s, out=s)
    s -= np.arange(len(c)) / (1 << 16)
    m = min(keep, s.shape[1])
    part = np.argpartition(-s, m - 1, axis=1)[:, :m] if m < s.shape[1] else np.broadcast_to(np.arange(m), (len(s), m))
    return c_ids[part], np.ceil(np.take_along_axis(s, part, 1)) / 1e10, close


def _near_lists(ids: np.ndarray, nbr: np.ndarray, cos: np.ndarray) -> list[pa.Array]:
    ok = np.isfinite(cos)
    offsets = np.concatenate([[0], np.cumsum(ok.sum(1))]).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(-cos[ok]), pa.array(nbr[ok])], names=["d", "id"])
    return [pa.array(ids), pa.ListArray.from_arrays(pa.array(offsets), pairs)]


def _ranked(row: np.ndarray, cand: np.ndarray, cos: np.ndarray, ids: np.ndarray, n: int, most: int):
    """Of candidates (row, cand, cos), each once, the `most` best of each row as arrays (n, most): candidates (-1 for none)
    and cosines; of equal cosines the smaller ids."""
    order = np.lexsort((cand, row))
    row, cand, cos = row[order], cand[order], cos[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (cand[1:] != cand[:-1])
    row, cand, cos = row[first], cand[first], cos[first]
    order = np.lexsort((ids[cand], -cos, row))
    row, cand, cos = row[order], cand[order], cos[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    ok = place < most
    best, top = np.full((n, most), -1, np.int64), np.full((n, most), -np.inf)
    best[row[ok], place[ok]], top[row[ok], place[ok]] = cand[ok], cos[ok]
    return best, top


def nearest_in_range(ids: np.ndarray, units: np.ndarray, keep: int, window: int, cone: float, seed: int, dims: int = DIMS, bits: int = BITS):
    """(neighbour ids, cosines, most close) of the rows of a range, given in the order of its curve.

    Orderings of the range's own follow, as many as make up for the windows being a small part of it. Candidates are
    found with single precision; a few more than wanted are then ranked by exact cosines to ten decimals.
    """
    n = len(ids)
    if n <= 8 * window:
        window = n  # so few rows are all compared
    light, most = units.astype(np.float32), keep + 3
    close = np.zeros(n, np.int64)
    best, top = np.full((n, most), -1, np.int64), np.full((n, most), -np.inf)
    turns = 1 if n <= window else math.ceil(math.log2(n / window)) + 3
    for turn in range(turns):
        if turn:
            directions, shift = _curve(seed * 1_009 + turn, units.shape[1], dims)
            perm = np.argsort(hilbert_keys(_cells(light, directions, shift, bits), bits), kind="stable")
        else:
            perm = np.arange(n)
        rows, cands, values = [np.repeat(np.arange(n), (best >= 0).sum(1))], [best[best >= 0]], [top[best >= 0]]
        sorted_, limit = light[perm], (top[:, -1] - 2e-6)[perm].astype(np.float32)
        for lo in range(0, n, window):
            hi, a, b = min(n, lo + window), max(0, lo - window), min(n, lo + 2 * window)
            s = sorted_[lo:hi] @ sorted_[a:b].T
            np.fill_diagonal(s[:, lo - a :], -2.0)
            q = perm[lo:hi]
            close[q] = np.maximum(close[q], (s >= cone).sum(1))
            if not turn and s.shape[1] > most:  # all that equal the last wanted one come along
                limit[lo:hi] = np.partition(s, -most, axis=1)[:, -most] - 2e-6
            r, c = np.nonzero(s > np.maximum(limit[lo:hi, None], -1.5))
            rows.append(q[r])
            cands.append(perm[a + c])
            values.append(np.rint(s[r, c].astype(np.float64) * 1e6) / 1e6)
        best, top = _ranked(np.concatenate(rows), np.concatenate(cands), np.concatenate(values), ids, n, most)
    row, place = np.nonzero(best >= 0)
    cand = best[row, place]
    cos = np.concatenate([np.einsum("ij,ij->i", units[row[i : i + 65_536]], units[cand[i : i + 65_536]]) for i in range(0, len(row), 65_536)] or [np.zeros(0)])
    best, top = _ranked(row, cand, np.rint(cos * 1e10) / 1e10, ids, n, keep)
    return np.where(best >= 0, ids[best], -1), top, close


def _ranges(dim: int, keep: int, window: int, cone: float, rows: int, dims: int, bits: int):
    def out(curve: int, parts: list):
        i, e = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        nbr, cos, close = nearest_in_range(i, e, keep, window, cone, 50 + curve, dims, bits)
        # of few rows all are compared, so none is crowded
        return pa.record_batch([*_near_lists(i, nbr, cos), pa.array((close > window) & (len(i) > 8 * window))], names=["id", "near", "crowded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by (curve, key); a partition that got far more rows than planned is taken in ranges, each
        # beginning with the last windows of the one before
        held: list[tuple[np.ndarray, np.ndarray]] = []
        curve, size = -1, 0
        for b in batches:
            c, i = b.column("curve").to_numpy(), b.column("id").to_numpy()
            e = _units(b.column("vec"), dim) if b.num_rows else None
            at = 0
            while at < b.num_rows:
                if c[at] != curve or size >= 2 * rows:
                    if held:
                        yield out(curve, held)
                    tail = [(np.concatenate([p[0] for p in held])[-2 * window :], np.concatenate([p[1] for p in held])[-2 * window :])] if held and c[at] == curve else []
                    held, curve, size = tail, int(c[at]), sum(len(p[0]) for p in tail)
                end = min(at + int(np.searchsorted(c[at:], c[at], side="right")), at + max(1, 2 * rows - size))
                held.append((i[at:end], e[at:end]))
                size += end - at
                at = end
        if held:
            yield out(curve, held)

    return run


def _exact(crowded: DataFrame, every: DataFrame, dim: int, keep: int, block: int) -> DataFrame:
    """(id, near) of the crowded vectors, compared with every vector: blocks of one side meet blocks of the other."""
    asked, held = (max(1, -(-x.count() // block)) for x in (crowded, every))

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        q, c = q.combine_chunks(), c.combine_chunks()
        rows = []
        if q.num_rows and c.num_rows:
            c_ids, c_vec = c.column("id").to_numpy(), _units(c.column("vec").combine_chunks(), dim)
            q_ids, q_vec = q.column("id").to_numpy(), _units(q.column("vec").combine_chunks(), dim)
            for lo in range(0, len(q_ids), 256):
                ids = q_ids[lo : lo + 256]
                nbr, cos, _ = _best(ids, q_vec[lo : lo + 256], c_ids, c_vec, keep, 2.0)
                rows.append(pa.record_batch(_near_lists(ids, nbr, cos), names=["id", "near"]))
        near = pa.list_(pa.struct([("d", pa.float64()), ("id", pa.int64())]))
        return pa.Table.from_batches(rows, pa.schema([("id", pa.int64()), ("near", near)]))

    def spread(df: DataFrame, own: int, own_name: str, other: int, other_name: str) -> DataFrame:
        at = df.select("id", "vec", F.pmod(F.xxhash64("id"), F.lit(own)).cast("int").alias(own_name))
        return at.withColumn(other_name, F.explode(F.sequence(F.lit(0), F.lit(other - 1)))).groupBy("a", "b")

    met = spread(crowded, asked, "a", held, "b").cogroup(spread(every, held, "b", asked, "a"))
    near = met.applyInArrow(run, "id long, near array<struct<d: double, id: long>>")
    return near.groupBy("id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, keep).alias("near"))


def usable_vectors(df: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """(id, vec) of the non-null vectors of the right dimension with finite entries, not all zero."""
    ok = F.expr(f"size({vec_col}) = {dim} AND forall({vec_col}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists({vec_col}, x -> x <> 0)")
    return df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).where(ok).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))


def similar_vectors(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = 128, k: int = 5,
    curves: int | None = None, window: int = WINDOW, dims: int = DIMS, bits: int = BITS, cone: float = CONE, block: int = BLOCK, rows: int | None = None,
) -> DataFrame:
    """(id, indices, dists): the k most similar other vectors of each usable vector, nearest
    first, dists = 2 - 2 cos; of equal cosines the smaller id comes first.

    Approximate in the candidates, exact in the cosines (double precision, compared to ten
    decimals). curves and rows (of a range) follow from the number of vectors by orderings() and range_rows().
    A vector with more than `window` others of cosine `cone` within three windows is
    compared with all vectors instead, since the windows may have cut its group. Null, all-zero, non-finite vectors and those of another dimension take no part;
    an id repeated with the same vector counts once. Fewer than k others give shorter lists, a
    lone vector empty ones. Of a group of equal vectors only the k + 1 smallest ids can be
    among the k nearest of anything, so the group is searched once and those ids stand for it;
    all its members get their rows.
    """
    base = usable_vectors(df, id_col, vec_col, dim).select("id", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))
    first = Window.partitionBy("h1", "h2").orderBy("id")
    smallest = base.withColumn("rn", F.rank().over(first)).where(F.col("rn") <= k + 1)
    reps = smallest.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.sort_array(F.collect_set("id")).alias("ids"), F.min_by("vec", "id").alias("vec"))
    reps = written(reps, "p2-vectors")
    count = reps.count()
    curves, rows = curves or orderings(count), rows or range_rows(count)
    keyed = reps.select(F.col("rep").alias("id"), "vec").mapInArrow(_keys(dim, curves, dims, bits), "curve int, key long, id long, vec array<float>")
    ordered = keyed.repartitionByRange(max(1, -(-count // rows) * curves), "curve", "key", "id").sortWithinPartitions("curve", "key", "id")
    near = ordered.mapInArrow(_ranges(dim, k + 1, window, cone, rows, dims, bits), "id long, near array<struct<d: double, id: long>>, crowded boolean")
    # at most curves * (k + 1) candidates meet here per vector
    merged = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))), 1, k + 1)
    best = written(near.groupBy("id").agg(merged.alias("near"), F.max("crowded").alias("crowded")), "p2-near")
    scratch = [best]
    crowded = best.where("crowded").select("id")
    if crowded.limit(1).count():
        vectors = reps.select(F.col("rep").alias("id"), "vec")
        asked = written(vectors.join(crowded, "id", "left_semi"), "p2-crowded")
        scratch.append(asked)
        best = best.where("NOT crowded").select("id", "near").unionByName(_exact(asked, vectors, dim, k + 1, block))
    multi = reps.where("size(ids) > 1").select("h1", "h2", "rep", "ids")
    other = multi.select(F.col("rep").alias("other"), F.col("ids").alias("copies"))
    pairs = best.select("id", F.explode("near").alias("x")).select("id", "x.d", F.col("x.id").alias("other"))
    spread = pairs.join(other, "other", "left").select("id", "d", F.coalesce("copies", F.array("other")).alias("ids"))
    spread = spread.unionByName(multi.select(F.col("rep").alias("id"), F.lit(-1.0).alias("d"), "ids"))
    listed = spread.groupBy("id").agg(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(F.col("d"), i.alias("id"))))).alias("near"))
    listed = reps.select(F.col("rep").alias("id"), "h1", "h2", (F.size("ids") > 1).alias("copied")).join(listed, "id", "left")
    listed = written(
        listed.select("id", "h1", "h2", "copied", F.slice(F.array_sort(F.coalesce("near", F.expr("array()"))), 1, k + 1).alias("near")), "p2-lists",
    )
    for t in scratch:  # read for the last time
        dropped(t)
    members = skew_join(base.select("id", "h1", "h2"), listed.where("copied").select("h1", "h2", "near"), ["h1", "h2"])
    every = listed.where("NOT copied").select("id", "near").unionByName(members.select("id", "near").distinct())
    kept = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)
    return every.select("id", kept.alias("near")).select(
        "id", F.transform("near", lambda x: x["id"]).alias("indices"), F.transform("near", lambda x: (F.lit(2.0) + F.lit(2.0) * x["d"])).alias("dists")
    )


def similar_pairs(df: DataFrame, least_cos: float = 0.85, **params) -> DataFrame:
    """(id, neighbor_id) for the listed neighbours of at least the given cosine."""
    near = similar_vectors(df, **params).select("id", F.explode(F.arrays_zip("indices", "dists")).alias("x"))
    return near.where(F.col("x.dists") <= 2 - 2 * least_cos).select("id", F.col("x.indices").alias("neighbor_id"))
