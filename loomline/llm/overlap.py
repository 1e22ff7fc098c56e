"""Problem 3: the same or nearly the same lines across splits.

An exact prefix-filter bipartite join. Two word sequences count as nearly the same if at most
a fifth of the longer one's words have to be inserted, deleted or replaced. One edit changes
at most q word shingles of q words, which bounds from below how many shingles two such lines
share and so how many of a line's rarest shingles suffice to find every partner.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.canonical import canonical_words
from loomline.session import BROADCAST_ROWS, dropped, maybe_broadcast, skew_join, written

#: Words per shingle. The general rule of five would lose partners at one edit in five words
#: (five edits destroy up to 25 shingles), two words leave a usable bound for all lengths.
Q = 2
#: Largest share of edited words: one in FRACTION.
FRACTION = 5


def sided(df: DataFrame, id_col: str, lang_col: str = "lang_dir", src: str = "src", tgt: str = "tgt") -> DataFrame:
    """(id, lang, words): both sides of each line with their language; wordless sides fall out."""
    lang = F.split(F.col(lang_col), "-")
    both = F.array(
        F.struct(F.get(lang, 0).alias("lang"), canonical_words(F.col(src)).alias("t")),
        F.struct(F.get(lang, 1).alias("lang"), canonical_words(F.col(tgt)).alias("t")),
    )
    return df.select(F.col(id_col).alias("id"), F.inline(both)).where("id IS NOT NULL AND lang IS NOT NULL AND t <> ''").select("id", "lang", "t")


def _shingles(lang: Column, words: Column) -> Column:
    """Hashes of a language and its word bigrams, with a mark before the first word and after the last (n + 1 of n words),
    repeats numbered, so that the list is a set."""
    padded = F.concat(F.array(F.lit("\u0002")), words, F.array(F.lit("\u0003")))
    # bound by a lambda, so that the text is split once and not at every shingle
    pairs = F.transform(F.array(padded), lambda p: F.transform(F.sequence(F.lit(0), F.size(p) - 2), lambda i: F.xxhash64(lang, F.get(p, i), F.get(p, i + 1))))
    return F.get(pairs, 0)


def _numbered(df: DataFrame, col: str) -> DataFrame:
    """Repeats within a line get their own identity: (shingle, how many times before)."""
    nth = F.expr(f"IF(size(array_distinct({col})) = size({col}), {col}, transform({col}, (z, i) -> IF(array_position({col}, z) = i + 1, z, xxhash64(z, size(filter(slice({col}, 1, i), y -> y = z))))))")
    return df.withColumn(col, nth)


def _shared(longest: Column) -> Column:
    """Shingles that two lines share at least, the longer of which has so many words."""
    return longest + 1 - Q * F.floor(longest / FRACTION)


def _needed(n: Column) -> Column:
    """Shingles that a line of n words shares at least with any partner: the least of
    _shared() over the longer length from n on, which is at n or the next multiple of FRACTION."""
    return F.least(_shared(n), _shared(F.ceil(n / FRACTION) * FRACTION)).cast("int")


def _least(n: np.ndarray) -> np.ndarray:
    """_needed() of numpy arrays."""
    shared = lambda x: x + 1 - Q * (x // FRACTION)
    return np.minimum(shared(n), shared(-(-n // FRACTION) * FRACTION))


def _prefixes(wanted: np.ndarray, rank: np.ndarray):
    """Arrow function: (c, n, s, rest) of the prefix of each row's shingles g, all of which are in a sorted array, in the
    order of their ranks; rest is how many are left from there on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = b.column("g")
            flat, size = g.flatten().to_numpy(), np.diff(np.asarray(g.offsets)).astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), size)
            order = np.lexsort((rank[np.searchsorted(wanted, flat)], row)) if len(flat) else np.zeros(0, np.int64)
            row, flat = row[order], flat[order]
            rest = size[row] - (np.arange(len(row)) - (np.cumsum(size) - size)[row])
            keep = rest >= _least(b.column("n").to_numpy().astype(np.int64))[row]
            own = b.take(pa.array(row[keep]))
            yield pa.record_batch([own.column("c"), own.column("n"), pa.array(flat[keep]), pa.array(rest[keep])], names=["c", "n", "s", "rest"])

    return run


def _known(wanted: np.ndarray):
    """Arrow function: keeps of each row's shingles g those of a sorted array, and of the rows those with enough left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = b.column("g")
            flat, edges = g.flatten().to_numpy(), np.asarray(g.offsets) - g.offsets[0].as_py()
            at = np.minimum(np.searchsorted(wanted, flat), max(0, len(wanted) - 1))
            has = wanted[at] == flat if len(wanted) else np.zeros(len(flat), bool)
            upto = np.concatenate([[0], np.cumsum(has)])
            size, n = upto[edges[1:]] - upto[edges[:-1]], b.column("n").to_numpy().astype(np.int64)
            keep = size >= _least(n)
            flat = flat[has & np.repeat(keep, np.diff(edges))]
            offsets = np.concatenate([[0], np.cumsum(size[keep])]).astype(np.int32)
            some = b.filter(pa.array(keep))
            yield pa.record_batch([some.column("c"), some.column("n"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["c", "n", "g"])

    return run


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the rows whose word sequences a, b are within the allowed edit distance."""

    def near(a: list[str], b: list[str]) -> bool:
        longest = max(len(a), len(b))
        most = longest // FRACTION
        if a == b:
            return True
        if abs(len(a) - len(b)) > most or not most:
            return False
        inf = most + 1
        row = [j if j <= most else inf for j in range(len(b) + 1)]
        for i, x in enumerate(a, 1):
            lo, hi = max(1, i - most), min(len(b), i + most)
            new = [inf] * (len(b) + 1)
            if i <= most:
                new[0] = i
            for j in range(lo, hi + 1):
                v = row[j - 1] if x == b[j - 1] else 1 + min(row[j - 1], row[j], new[j - 1])
                new[j] = v if v < inf else inf
            row = new
            if min(row[lo - 1 : hi + 1]) > most:
                return False
        return row[-1] <= most

    for b in batches:
        keep = [near(x.split(" "), y.split(" ")) for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True)]
        yield b.select(["e", "t"]).filter(pa.array(keep, pa.bool_()))


def side_links(evals: DataFrame, train: DataFrame, id_col: str = "line_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(eval sides, training sides, pairs): sides as (id, c), c standing for the language and words of a side, and
    the pairs (e, t) of such classes that are the same or nearly so.

    Equal sides are one class on either side of the join, so lines copied many times cost one
    probe. Only the training shingles that the evaluation split has too are kept (8 bytes each), and of a
    class only if they are enough for a match; texts are looked up for pairs that share enough of them. A table is
    broadcast only if it was counted to be small.
    """
    w = F.split("t", " ")

    def sides(df: DataFrame, label: str) -> DataFrame:
        return written(sided(df, id_col).withColumn("c", F.xxhash64("lang", "t")), label)

    e_side, t_side = sides(evals, "p3-eval"), sides(train, "p3-train")
    def shingled(side: DataFrame) -> DataFrame:
        return _numbered(side.select("c", "t", F.size(w).alias("n"), _shingles(F.col("lang"), w).alias("g")), "g")

    first = e_side.groupBy("c").agg(F.min(F.struct("lang", "t")).alias("x")).select("c", "x.lang", "x.t")
    e_text = written(shingled(first), "p3-eval-texts")
    wanted = written(e_text.select(F.explode("g").alias("s")).distinct(), "p3-wanted")

    # (c, n, g): the shingles of a training class that the evaluation split knows, if they are enough; one of any copies
    every = shingled(t_side).select("c", "n", "g")
    small = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    if small:
        few = np.sort(wanted.toArrow().column("s").to_numpy())
        known = every.mapInArrow(_known(few), "c long, n int, g array<long>").groupBy("c", "n").agg(F.collect_set("g")[0].alias("g"))
    else:
        met_here = every.select("c", "n", F.explode("g").alias("s")).join(wanted, "s", "left_semi")
        known = met_here.groupBy("c", "n").agg(F.collect_set("s").alias("g")).where(F.size("g") >= _needed(F.col("n")))
    t_known = written(known, "p3-known")

    # global order: shingles by how many training classes have them, rarest first
    seen = t_known.select(F.explode("g").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("f"))
    order = written(wanted.join(seen, "s", "left").select("s", F.coalesce("f", F.lit(0)).alias("f")), "p3-order")

    if small:
        f = order.toArrow().sort_by("s").column("f").to_numpy()
        rank = np.empty(len(few), np.int64)
        rank[np.lexsort((few, f))] = np.arange(len(few))

    def prefixes(text: DataFrame) -> DataFrame:
        """(c, n, s, rest): the shingles of each class's prefix, with how many of its shingles are
        left from there on. Shingles unknown to the evaluation split stand first: they are the rarest."""
        if small:
            return text.select("c", "n", "g").mapInArrow(_prefixes(few, rank), "c long, n int, s long, rest long")
        ranked = text.select("c", "n", F.explode("g").alias("s")).join(order, "s")
        per = ranked.groupBy("c", "n").agg(F.sort_array(F.collect_list(F.struct("f", "s"))).alias("o"))
        # of n + 1 shingles, the last _needed() - 1 can't be the first that is shared
        room = F.greatest(F.lit(0), F.size("o") - _needed(F.col("n")) + 1)
        cut = per.select("c", "n", F.size("o").alias("k"), F.posexplode(F.slice("o", 1, room)).alias("i", "x"))
        return cut.select("c", "n", F.col("x.s").alias("s"), (F.col("k") - F.col("i")).alias("rest"))

    index = written(prefixes(e_text).select("s", F.col("c").alias("e"), F.col("n").alias("en"), F.col("rest").alias("e_rest")), "p3-index")
    probe = prefixes(t_known).select("s", F.col("c").alias("t"), F.col("n").alias("tn"), F.col("rest").alias("t_rest"))
    longest = F.greatest("en", "tn")
    met = (
        probe.join(maybe_broadcast(index), "s")
        .where(F.abs(F.col("en") - F.col("tn")) <= F.floor(longest / FRACTION))
        .where(F.least("e_rest", "t_rest") >= _shared(longest))
        .select("e", "t").distinct()
    )
    left = e_text.select(F.col("c").alias("e"), F.col("t").alias("a"), F.col("g").alias("ag"), F.col("n").alias("an"))
    right = t_known.select(F.col("c").alias("t"), F.col("g").alias("bg"), F.col("n").alias("bn"))
    enough = met.join(right, "t").join(maybe_broadcast(left), "e").where(F.size(F.array_intersect("ag", "bg")) >= _shared(F.greatest("an", "bn")))
    close = written(enough.select("e", "t", "a"), "p3-close")
    texts = t_side.join(maybe_broadcast(close.select(F.col("t").alias("c")).distinct()), "c", "left_semi").groupBy("c").agg(F.min("t").alias("b"))
    pairs = written(close.join(texts.withColumnRenamed("c", "t"), "t").select("e", "t", "a", "b").mapInArrow(_within, "e long, t long"), "p3-pairs")
    for table in (e_text, wanted, t_known, order, index, close):  # read for the last time
        dropped(table)
    return e_side.select("id", "c"), t_side.select("id", "c"), pairs


def near_lines(evals: DataFrame, train: DataFrame, id_col: str = "line_id") -> DataFrame:
    """(eval_id, train_id) of every eval line and train line that have a side of the same
    language the same or nearly so; distinct. Null and wordless sides take no part; an id delivered again counts once."""
    e_side, t_side, pairs = side_links(evals, train, id_col)
    lines = skew_join(t_side.select(F.col("c").alias("t"), F.col("id").alias("train_id")), pairs, ["t"])
    evals_of = e_side.select(F.col("c").alias("e"), F.col("id").alias("eval_id"))
    return lines.join(maybe_broadcast(evals_of), "e").select("eval_id", "train_id").distinct()


def overlap_rates(evals: DataFrame, train: DataFrame) -> DataFrame:
    """Per fold and eval set of the evaluation lines and corpus of the training lines: how
    many lines overlap, and as a share of the eval set's and the corpus's lines.

    A null fold, eval_set or corpus is a group of its own. Training lines delivered again
    count once, by their last delivery. Lines are counted by their classes: the pairs of copies are never made.
    """
    e = written(evals.groupBy("line_id").agg(F.max(F.struct("fold", "eval_set")).alias("x")).select(F.col("line_id").alias("id"), "x.fold", "x.eval_set"), "p3-evals")
    t = written(train.groupBy("line_id").agg(F.max(F.struct("loaded_at", "corpus")).alias("x")).select(F.col("line_id").alias("id"), "x.corpus"), "p3-lines")
    e_side, t_side, pairs = side_links(evals, train)
    e_in = written(e_side.join(e, "id").select("id", F.col("c").alias("e"), F.struct("fold", "eval_set").alias("own")).distinct(), "p3-eval-groups")
    t_in = written(t_side.join(t, "id").select("id", F.col("c").alias("t"), F.struct("corpus").alias("of")).distinct(), "p3-train-groups")
    # which groups each class is met by: classes times groups, however many lines are behind them
    met_by = pairs.join(t_in.select("t", "of").distinct(), "t").select("e", "of").distinct()
    meets = pairs.join(e_in.select("e", "own").distinct(), "e").select("t", "own").distinct()
    e_hits = e_in.join(met_by, "e").groupBy("own", "of").agg(F.count_distinct("id").alias("eval_hits"))
    t_hits = skew_join(t_in, meets, ["t"]).groupBy("own", "of").agg(F.count_distinct("id").alias("train_hits"))
    of_e = e.groupBy(F.struct("fold", "eval_set").alias("own")).agg(F.count(F.lit(1)).alias("eval_lines"))
    of_t = t.groupBy(F.struct("corpus").alias("of")).agg(F.count(F.lit(1)).alias("train_lines"))
    # structs compare with their null fields as equal
    return e_hits.join(t_hits, ["own", "of"]).join(of_e, "own").join(of_t, "of").select(
        "own.fold", "own.eval_set", "of.corpus", "eval_hits", "eval_lines", "train_hits", "train_lines",
        (F.col("eval_hits") / F.col("eval_lines")).alias("eval_rate"), (F.col("train_hits") / F.col("train_lines")).alias("train_rate"),
    )
