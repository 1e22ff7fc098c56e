"""Problem 6: score cutoffs that keep a target fraction per source, by histogram refinement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.session import BROADCAST_ROWS, dropped, written

#: Bins per source and round.
BINS = 1024


def latest_scores(lines: DataFrame) -> DataFrame:
    """(corpus, line_id, score) of each line's last delivery.

    The delivery with the largest loaded_at counts (null sorts first); among equal times the
    larger score, then corpus. Null line_ids are left out. The corrected score may be null or
    NaN: such a line has no score then.
    """
    newest = F.max(F.struct("loaded_at", "score", "corpus")).alias("d")
    return (
        lines.where("line_id IS NOT NULL").groupBy("line_id").agg(newest)
        .select("d.corpus", "line_id", "d.score")
    )


def _position(score: Column, lo: Column, hi: Column, turn: int) -> Column:
    """Bin of a score within [lo, hi]: a monotone map, so bins are in score order.

    Rounds take turns between a linear, a logarithmic and an arc-tangent scale, so that
    outliers and infinities can't stall the refinement.
    """
    scale = (lambda x: x, lambda x: F.signum(x) * F.log1p(F.abs(x)), F.atan)[turn % 3]
    share = (scale(score) - scale(lo)) / (scale(hi) - scale(lo))
    place = F.floor(share * BINS)
    # an infinite width gives no share: the ends then are bins of their own
    edge = F.when(score >= hi, F.lit(BINS - 1)).when(score <= lo, F.lit(0)).otherwise(F.lit(BINS // 2))
    inner = F.when(share.isNull() | F.isnan(share), edge).otherwise(F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 1)))
    return F.when(score >= hi, F.lit(BINS - 1)).when(score <= lo, F.lit(0)).otherwise(inner).cast("int")


def score_cutoffs(scores: DataFrame, targets: DataFrame) -> DataFrame:
    """(corpus, keep_pct, n, cutoff) per corpus of targets.

    scores: (corpus, score) rows; null and NaN scores don't count. cutoff is the largest
    score that at least keep_pct * n / 100 records reach; of a keep_pct of 0 the largest
    score. A corpus without scored records has n = 0 and a null cutoff, as has a null
    keep_pct. Each round counts the scores of every undecided source into bins, finds the bin
    with the wanted rank and narrows to the smallest and largest score seen in it; it ends
    when those are equal. What is kept between rounds is one row per source, in a table.
    """
    spark = scores.sparkSession
    wanted = targets.groupBy("corpus").agg(F.max("keep_pct").alias("keep_pct")).where("corpus IS NOT NULL")
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    small = F.broadcast if few else (lambda d: d)
    usable = scores.where("score IS NOT NULL AND NOT isnan(score)").select("corpus", "score")
    first = usable.groupBy("corpus").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi"))
    state = written(
        wanted.join(first, "corpus", "left").select(
            "corpus", "keep_pct", F.coalesce("n", F.lit(0)).alias("n"), "lo", "hi",
            F.greatest(F.lit(1), F.ceil((F.col("keep_pct") * F.coalesce("n", F.lit(0))) / F.lit(100.0))).cast("long").alias("rank"),
        ), "p6-state",
    )
    turn = 0
    while not state.where("lo < hi").isEmpty():
        open_ = state.where("lo < hi")
        part = usable.join(small(open_.select("corpus", "lo", "hi")), "corpus").where("score >= lo AND score <= hi")
        hist = (
            part.select("corpus", "score", _position(F.col("score"), F.col("lo"), F.col("hi"), turn).alias("bin"))
            .groupBy("corpus", "bin").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("b_lo"), F.max("score").alias("b_hi"))
        )
        down = Window.partitionBy("corpus").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        hit = (
            hist.withColumn("reach", F.sum("c").over(down)).join(small(open_.select("corpus", "rank")), "corpus")
            .where((F.col("reach") >= F.col("rank")) & (F.col("reach") - F.col("c") < F.col("rank")))
            .select("corpus", "b_lo", "b_hi", (F.col("rank") - F.col("reach") + F.col("c")).alias("b_rank"))
        )
        narrower = state.join(hit, "corpus", "left").select(
            "corpus", "keep_pct", "n",
            F.coalesce("b_lo", "lo").alias("lo"), F.coalesce("b_hi", "hi").alias("hi"), F.coalesce("b_rank", "rank").alias("rank"),
        )
        last, state = state, written(narrower, "p6-state")
        dropped(last)
        turn += 1
    cut = F.when(F.col("keep_pct").isNotNull(), F.col("lo"))
    return state.select("corpus", "keep_pct", "n", cut.alias("cutoff"))


def kept_records(lines: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The scored lines (corpus, line_id, score), the cutoffs, and the lines that reach them."""
    names = targets.select("corpus").where("corpus IS NOT NULL").distinct()
    few = names.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    # the last delivery decides on corpus and score, so the corpus can't be filtered before
    scored = latest_scores(lines.select("line_id", "corpus", "score", "loaded_at")).where("score IS NOT NULL AND NOT isnan(score)")
    scored = written(scored.join(F.broadcast(names) if few else names, "corpus", "left_semi"), "p6-scores")
    cuts = score_cutoffs(scored, targets)
    kept = scored.join(F.broadcast(cuts) if few else cuts, "corpus").where("score >= cutoff")
    return scored, cuts, kept.select("corpus", "line_id", "score", "cutoff")


def cutoff_report(lines: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target corpus: keep_pct, n, cutoff, kept, and what its fixed thresholds would keep.

    A null threshold keeps nothing (kept_mine, kept_bitext are null then).
    """
    scored, cuts, _ = kept_records(lines, targets)
    fixed = targets.groupBy("corpus").agg(F.max("mine_threshold").alias("mine"), F.max("bitext_threshold").alias("bitext"))
    limits = cuts.join(fixed, "corpus")
    few = limits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    at_least = lambda t: F.when(F.first(t).isNotNull() & ~F.isnan(F.first(t)), F.count_if(F.col("score") >= F.col(t)))
    counted = (
        scored.join(F.broadcast(limits) if few else limits, "corpus").groupBy("corpus")
        .agg(F.count_if(F.col("score") >= F.col("cutoff")).alias("kept"), at_least("mine").alias("kept_mine"), at_least("bitext").alias("kept_bitext"))
    )
    return cuts.join(counted, "corpus", "left").select("corpus", "keep_pct", "n", "cutoff", F.coalesce("kept", F.lit(0)).alias("kept"), "kept_mine", "kept_bitext")
