"""Corpus statistics: shares, pivots, grouping sets, ranks and tests, all as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row, by a broadcast lookup of a constant key."""
    return df.withColumn("__one", F.lit(1)).join(F.broadcast(totals.withColumn("__one", F.lit(1))), "__one").drop("__one")


def shares(df: DataFrame, keys: list[str]) -> DataFrame:
    """Count and share of all rows per key."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return with_totals(per, per.agg(F.sum("n").alias("__all"))).withColumn("share", F.col("n") / F.col("__all")).drop("__all")


def pivot_shares(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Share of each value of a column within a row key, missing ones 0, and the row's count."""
    out = [F.coalesce(F.count_if(F.col(column) == v) / F.count(F.lit(1)), F.lit(0.0)).alias(v) for v in values]
    return df.groupBy(row).agg(F.count(F.lit(1)).alias("n"), *out)


def pivot_mean(df: DataFrame, row: str, column: str, values: list[str], measure: str) -> DataFrame:
    """Mean of a measure by row and column value, and the mean of the row's means that exist."""
    means = [F.avg(F.when(F.col(column) == v, F.col(measure))).alias(v) for v in values]
    wide = df.groupBy(row).agg(*means)
    present = F.filter(F.array(*values), lambda x: x.isNotNull())
    return wide.withColumn("row_mean", F.try_divide(F.aggregate(present, F.lit(0.0), lambda a, x: a + x), F.size(present)))


def hierarchy(df: DataFrame, levels: list[str], measure: Column) -> DataFrame:
    """Mean and count for every prefix of the levels, the whole included; `level` tells how many are set."""
    aggs = [F.avg(measure).alias("mean"), F.count(F.lit(1)).alias("n"), F.grouping_id().alias("__g")]
    depth = F.lit(len(levels)) - F.bit_count("__g")
    return df.rollup(*levels).agg(*aggs).withColumn("level", depth.cast("int")).drop("__g")


def cumulative_share(per: DataFrame, group: str, order: list[Column], n: str) -> DataFrame:
    """Running count and share within a group of an aggregated table."""
    w = Window.partitionBy(group).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per.withColumn("running", F.sum(n).over(run)).withColumn("running_share", F.sum(n).over(run) / F.sum(n).over(Window.partitionBy(group)))


def gini_impurity(df: DataFrame, group: list[str], category: str) -> DataFrame:
    """1 - sum of squared shares; null for a group with a missing or empty category."""
    per = df.groupBy(*group, category).agg(F.count(F.lit(1)).alias("n"))
    blank = F.max((F.col(category).isNull() | (F.col(category).cast("string") == "")).cast("int"))
    return per.groupBy(*group).agg(F.sum("n").alias("n_all"), F.sum(F.col("n") * F.col("n")).alias("sq"), blank.alias("blank")).select(
        *group, "n_all", F.when(F.col("blank") == 0, 1 - F.col("sq") / (F.col("n_all") * F.col("n_all"))).alias("gini"))


def round_bin(c: Column, width: float = 0.05) -> Column:
    """Centre of the bin of a value, halves to even."""
    return F.bround((c - width / 2) / width, 0) * width + width / 2


def detection(df: DataFrame, group: list[str], predicted: Column, actual: Column) -> DataFrame:
    """Precision, recall, F1 and lift over the base rate."""
    tp, fp, fn = F.count_if(predicted & actual), F.count_if(predicted & ~actual), F.count_if(~predicted & actual)
    base = df.groupBy(*group).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), F.count(F.lit(1)).alias("n"))
    p, r = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    return base.select(*group, "n", "tp", "fp", "fn", p.alias("precision"), r.alias("recall"), F.try_divide(2 * p * r, p + r).alias("f1"), F.try_divide(p * F.col("n"), F.col("tp") + F.col("fn")).alias("lift"))


def value_ranks(df: DataFrame, value: str) -> DataFrame:
    """(value, n, rank) of the distinct values: the average rank of equal values among all rows.

    Counts per value are summed in two levels over range partitions, so no task sorts all rows: within a
    range by a window, over ranges by their sums.
    """
    per = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    parts = per.repartitionByRange(value).withColumn("__p", F.spark_partition_id())
    from loomline.session import written

    parts = written(parts, "ranks")  # the ranges are fixed from here on
    sums = parts.groupBy("__p").agg(F.sum("n").alias("__s"))
    before = sums.withColumn("__b", F.coalesce(F.sum("__s").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__p", "__b")
    w = Window.partitionBy("__p").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    up = parts.join(F.broadcast(before), "__p").withColumn("__r", F.sum("n").over(w) + F.col("__b"))  # one row per range
    return up.select(value, "n", (F.col("__r") - (F.col("n") - 1) / 2).alias("rank"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the curve by the rank sum of the positives, ties averaged; one row."""
    ranked = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    ranks = value_ranks(ranked, score)
    per = ranked.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("q")).join(ranks, score)
    s = per.agg(F.sum(F.col("rank") * F.col("p")).alias("r"), F.sum("p").alias("p"), F.sum("q").alias("q"))
    return s.select("p", "q", F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * F.col("q")).alias("auc"))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation with averaged ranks, and Pearson's; one row."""
    own = df.select(a, b).where(f"`{a}` IS NOT NULL AND `{b}` IS NOT NULL")
    ra, rb = value_ranks(own, a).select(a, F.col("rank").alias("ra")), value_ranks(own, b).select(b, F.col("rank").alias("rb"))
    return own.join(ra, a).join(rb, b).agg(F.count(F.lit(1)).alias("n"), F.corr("ra", "rb").alias("spearman"), F.corr(a, b).alias("pearson"))


def dense_rank_correlation(df: DataFrame, group: list[str], a: str, b: str) -> DataFrame:
    """1 - 6 sum d² / (n (n² - 1)) on dense ranks within small groups."""
    d = F.dense_rank().over(Window.partitionBy(*group).orderBy(a)) - F.dense_rank().over(Window.partitionBy(*group).orderBy(b))
    n = F.count(F.lit(1))
    return df.select(*group, d.cast("double").alias("d")).groupBy(*group).agg((1 - F.try_divide(6 * F.sum(F.col("d") * F.col("d")), n * (n * n - 1))).alias("rho"), n.alias("n"))


def mode_of(df: DataFrame, group: list[str], value: str, severity: Column) -> DataFrame:
    """Most frequent value per group, of equally frequent ones the most severe."""
    per = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(*group).agg(F.max_by(F.col(value), F.struct("n", severity)).alias("mode"), F.max("n").alias("n"))


def two_proportion_z(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """z statistic of two shares against equality."""
    p = (k1 + k2) / (n1 + n2)
    return F.try_divide(k1 / n1 - k2 / n2, F.sqrt(p * (1 - p) * (1 / n1 + 1 / n2)))


def upper_p(z: Column) -> Column:
    """One-sided normal p-value, by the rational approximation of the error function (error below 1.5e-7).
    The coefficients are fixed values of a published table."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = poly * F.exp(-x * x) / 2
    return F.when(z >= 0, tail).otherwise(1 - tail)


def paired_t(df: DataFrame, group: list[str], a: str, b: str) -> DataFrame:
    d = F.col(a) - F.col(b)
    return df.groupBy(*group).agg(F.count(d).alias("n"), F.try_divide(F.avg(d) * F.sqrt(F.count(d)), F.stddev_samp(d)).alias("t"))


def fleiss_kappa(df: DataFrame, item: str, category: str) -> DataFrame:
    """Agreement of several raters on items with the same number of ratings each; one row."""
    per = df.groupBy(item, category).agg(F.count(F.lit(1)).alias("n"))
    items = per.groupBy(item).agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.col("n")).alias("sq")).where("m > 1")
    pi = items.agg(F.avg((F.col("sq") - F.col("m")) / (F.col("m") * (F.col("m") - 1))).alias("p_mean"), F.sum("m").alias("all"))
    pj = per.join(items.select(item), item, "left_semi").groupBy(category).agg(F.sum("n").alias("c"))
    pe = with_totals(pj, pi).agg(F.sum(F.pow(F.col("c") / F.col("all"), F.lit(2))).alias("p_chance"), F.max("p_mean").alias("p_mean"))
    return pe.select("p_mean", "p_chance", F.try_divide(F.col("p_mean") - F.col("p_chance"), 1 - F.col("p_chance")).alias("kappa"))


def bootstrap_correlation(df: DataFrame, id_col: str, a: str, b: str, rounds: int = 100, seed: int = 1) -> DataFrame:
    """Percentile interval (2.5, 97.5) of Pearson's correlation over Poisson bootstrap rounds.

    Each row takes part in round r as often as a Poisson(1) variable drawn from a hash of its id and r says, so the
    rounds are plain weighted sums of one pass over the rows.
    """
    own = df.where(f"`{a}` IS NOT NULL AND `{b}` IS NOT NULL").select(id_col, F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
    u = F.pmod(F.xxhash64(id_col, "r", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    # cumulative Poisson(1) probabilities
    w = F.when(u < 0.36787944, 0).when(u < 0.73575888, 1).when(u < 0.9196986, 2).when(u < 0.98101184, 3).when(u < 0.99634015, 4).when(u < 0.99940582, 5).otherwise(6)
    drawn = own.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))).withColumn("w", w.cast("double")).where("w > 0")
    s = drawn.groupBy("r").agg(*(F.sum(F.col("w") * e).alias(n) for n, e in (("n", F.lit(1.0)), ("x", F.col("a")), ("y", F.col("b")), ("xx", F.col("a") * F.col("a")), ("yy", F.col("b") * F.col("b")), ("xy", F.col("a") * F.col("b")))))
    c = (F.col("n") * F.col("xy") - F.col("x") * F.col("y")) / F.sqrt((F.col("n") * F.col("xx") - F.col("x") * F.col("x")) * (F.col("n") * F.col("yy") - F.col("y") * F.col("y")))
    return s.select(c.alias("c")).agg(F.percentile("c", 0.025).alias("low"), F.percentile("c", 0.975).alias("high"))
