"""Operators on plain records: selection, merging, numbering, counting. Nulls are kept as nulls unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.operators.analytics import with_totals
from loomline.session import maybe_broadcast, written

# ---------------------------------------------------------------- selection


def include_exclude(df: DataFrame, col: str, include: DataFrame | None = None, exclude: list | None = None, exclude_col: str | None = None) -> DataFrame:
    """Rows whose value is in the one-column table `include` and whose other value isn't in the list `exclude`; a null passes neither test."""
    if include is not None:
        df = df.join(maybe_broadcast(include.select(F.col(include.columns[0]).alias(col)).distinct()), col, "left_semi")
    return df.where(~F.col(exclude_col or col).isin(*exclude)) if exclude else df


def outside(df: DataFrame, col: str, listed: DataFrame) -> DataFrame:
    """Rows with a value that a one-column table doesn't list; null values fall out."""
    return df.where(F.col(col).isNotNull()).join(maybe_broadcast(listed.select(F.col(listed.columns[0]).alias(col)).distinct()), col, "left_anti")


def box(df: DataFrame, **limits: tuple[float, float]) -> DataFrame:
    """Rows with every named column within its limits, both included."""
    return df.where(reduce(lambda a, b: a & b, (F.col(c).between(lo, hi) for c, (lo, hi) in limits.items())))


def risky(df: DataFrame, groups: dict[str, list[str]], text: str, harmless: str) -> DataFrame:
    """Rows of the listed groups whose text doesn't hold a harmless word (in any case); a null text holds none."""
    own = reduce(lambda a, b: a & b, (F.col(c).isin(*v) for c, v in groups.items()))
    return df.where(own & ~F.coalesce(F.lower(text).contains(harmless.lower()), F.lit(False)))


def accepted(df: DataFrame, score: str, order: list[str], threshold: float, most: int | None = None) -> DataFrame:
    """Rows that reach a score, the first `most` of them in the given order; null and NaN scores reach none."""
    kept = df.where((F.col(score) >= threshold) & ~F.isnan(score))
    return kept.orderBy(*order).limit(most) if most is not None else kept


def top_groups(df: DataFrame, group: str, n: int) -> DataFrame:
    """The n largest groups with their sizes, of equal ones the first by name."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), group).limit(n)


def best_hypothesis(df: DataFrame, group: str, score: str, id_col: str, hypothesis: str) -> DataFrame:
    """Per group the hypothesis of the highest score and the score; of equal scores that of the smallest id. Null scores take no part."""
    x = df.where(F.col(score).isNotNull()).groupBy(group).agg(F.max_by(F.struct(id_col, hypothesis, score), F.struct(score, -F.col(id_col))).alias("x"))
    return x.select(group, f"x.{id_col}", f"x.{hypothesis}", F.col(f"x.{score}").alias("best"))


# ---------------------------------------------------------------- columns


def most_severe(*cases: tuple[str, Column], otherwise: str = "none") -> Column:
    """Name of the first case that holds; cases come in order of severity. A null case doesn't hold."""
    return F.coalesce(*(F.when(c, F.lit(name)) for name, c in cases), F.lit(otherwise))


def row_max(*cols: str) -> Column:
    """Largest of several columns, nulls left out."""
    return F.greatest(*cols)


def complement(col: str) -> Column:
    return 1 - F.col(col)


def parse_size(c: Column) -> Column:
    """Number of a size like 10, 10K, 10KB or 1.5 GB: K, M, G, T are powers of 1000, with B of 1024; null if it isn't one."""
    p = r"(?i)^\s*([0-9]+(?:\.[0-9]+)?)\s*([KMGT]?)(B?)\s*$"
    unit, binary = F.upper(F.regexp_extract(c, p, 2)), F.upper(F.regexp_extract(c, p, 3)) == "B"
    power = F.when(unit == "", 0).when(unit == "K", 1).when(unit == "M", 2).when(unit == "G", 3).otherwise(4)
    return F.when(c.rlike(p), F.regexp_extract(c, p, 1).cast("double") * F.pow(F.when(binary, 1024).otherwise(1000), power)).cast("long")


def sequence_position(tokens: Column, phrase: Column) -> Column:
    """Place (from 0) of the first occurrence of a sequence of tokens, -1 if there is none or the phrase is empty."""
    k = F.size(phrase)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(tokens) - k, F.lit(0))), lambda i: F.slice(tokens, i + 1, F.greatest(k, F.lit(1))) == phrase)
    return F.when(tokens.isNotNull() & phrase.isNotNull(), F.when(k > 0, F.coalesce(F.get(starts, 0), F.lit(-1))).otherwise(F.lit(-1)))


# ---------------------------------------------------------------- numbering


def numbered(df: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """Rows numbered from 0 in the order of columns that tell all rows apart, without one task seeing all rows: ranges are numbered
    each on its own, then shifted by the sizes of the ranges before."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    ranged = written(ranged.select(*df.columns, F.shiftright("__at", 33).alias("__part"), F.col("__at").bitwiseAND((1 << 33) - 1).alias("__row")), "numbered")
    sizes = sorted((r[0], r[1]) for r in ranged.groupBy("__part").count().collect())  # one row a range
    shift, starts = 0, []
    for part, n in sizes:
        starts.append((part, shift))
        shift += n
    table = F.broadcast(spark.createDataFrame(starts, "__part long, __start long"))
    return ranged.join(table, "__part").select(*df.columns, (F.col("__row") + F.col("__start")).alias(name))


def quantiles(df: DataFrame, group: str, col: str, q: float, name: str = "quantile") -> DataFrame:
    """(group, name): the exact quantile of each group, linear between the values around it. Null values take no part; rows are
    put in order by ranges, so no task holds all values of a group. A null group is one."""
    own = df.where(F.col(col).isNotNull()).select(group, col)
    counted = own.groupBy(group, col).agg(F.count(F.lit(1)).alias("__n"))
    sizes = own.groupBy(group).agg(F.count(F.lit(1)).alias("__all"))
    ranked = running_total(counted, group, col, "__n").join(F.broadcast(sizes.withColumnRenamed(group, "__g")), F.col(group).eqNullSafe(F.col("__g")))
    at = (F.col("__all") - 1) * q
    inside = lambda r: (F.col("__before") <= r) & (r < F.col("__before") + F.col("__n"))
    picked = ranked.where(inside(F.floor(at)) | inside(F.ceil(at)))
    low, high = F.max(F.when(inside(F.floor(at)), F.col(col))), F.max(F.when(inside(F.ceil(at)), F.col(col)))
    return picked.groupBy(group).agg((low + (high - low) * F.max(at - F.floor(at))).alias(name))


def running_total(df: DataFrame, group: str, order: str, amount: str, before: str = "__before") -> DataFrame:
    """Adds the sum of an amount over the rows of the group that come before, rows being told apart by (group, order)."""
    ranged = written(df.repartitionByRange(group, order).withColumn("__part", F.spark_partition_id()), "running")
    inside = Window.partitionBy("__part", group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # a group has one row for each range it reaches into
    over = Window.partitionBy("__g").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(F.col(group).alias("__g"), F.col("__part").alias("__p")).agg(F.sum(amount).alias("__sum"))
    sums = sums.withColumn("__start", F.coalesce(F.sum("__sum").over(over), F.lit(0))).drop("__sum")
    local = ranged.withColumn(before, F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    met = local.join(maybe_broadcast(sums), (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g")))
    return met.withColumn(before, F.col(before) + F.col("__start")).drop("__g", "__p", "__start", "__part")


def dense_ids(df: DataFrame, value: str, order: str, name: str = "id") -> DataFrame:
    """(value, name): distinct values numbered from 0 by where they first occur."""
    first = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(order).alias("__first"))
    return numbered(first, ["__first", value], name).select(value, name)


# ---------------------------------------------------------------- merging


def zip_parts(df: DataFrame, id_col: str, a: str, b: str, sep: str) -> DataFrame:
    """(id, n, a, b): the parts of two separated lists side by side, as many as the shorter one has."""
    x = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(id_col, F.split(a, sep).alias("__a"), F.split(b, sep).alias("__b"))
    n = F.least(F.size("__a"), F.size("__b"))
    both = F.arrays_zip(F.slice("__a", F.lit(1), n).alias("x"), F.slice("__b", F.lit(1), n).alias("y"))
    return x.select(id_col, F.posexplode(both).alias("n", "p")).select(id_col, F.col("n").cast("long").alias("n"), F.col("p.x").alias(a), F.col("p.y").alias(b))


def later_wins(frames: list[DataFrame], key: str) -> DataFrame:
    """Frames joined on a key; of a column that several have the last frame's values count."""
    def two(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.drop(*(set(a.columns) & set(b.columns) - {key})).join(b, key)

    return reduce(two, frames)


def outer_counts(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows per key of each frame side by side, null where a frame lacks the key; null keys don't meet."""
    per = [df.groupBy(key).agg(F.count(F.lit(1)).alias(n)) for n, df in frames.items()]
    return reduce(lambda a, b: a.join(b, key, "full_outer"), per)


def added(frames: list[DataFrame], keys: list[str], amounts: list[str]) -> DataFrame:
    """Counters of several frames added up per key; a null counter adds nothing."""
    return reduce(lambda a, b: a.unionByName(b), (f.select(*keys, *amounts) for f in frames)).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in amounts))


def prefixed(df: DataFrame, prefix: str, keep: list[str], renames: dict[str, str] | None = None) -> DataFrame:
    """Columns other than `keep` with a prefix, after optional renames."""
    names = renames or {}
    return df.select(*(F.col(c).alias(c if c in keep else prefix + names.get(c, c)) for c in df.columns))


def checked_zip(a: DataFrame, b: DataFrame, key: str, same: str, flag: str | None = None) -> DataFrame:
    """Rows of two frames with one row per key side by side. It is an error, raised at run time, if a key is missing on one side or the
    column `same` differs; flag: a column of b whose presence is added as has_<flag>."""
    right = b.select(F.col(key).alias("__k"), F.col(same).alias("__same"), *(c for c in b.columns if c not in (key, same)))
    out = a.join(right, a[key] == right["__k"], "full_outer")
    fine = F.col(key).isNotNull() & F.col("__k").isNotNull() & F.col(same).eqNullSafe(F.col("__same"))
    out = out.withColumn(key, F.when(fine, F.col(key)).otherwise(F.raise_error(F.lit("the sides don't match")).cast(dict(a.dtypes)[key]))).drop("__k", "__same")
    return out.withColumn(f"has_{flag}", F.col(flag).isNotNull()) if flag else out


def both_ways(df: DataFrame, direction: str) -> DataFrame:
    """Directions x-y for which the data has y-x too."""
    own = df.select(direction).where(F.col(direction).isNotNull()).distinct()
    turned = own.select(F.regexp_replace(direction, r"^(.*)-(.*)$", "$2-$1").alias(direction))
    return own.join(turned, direction, "left_semi")


# ---------------------------------------------------------------- counts


def validated(df: DataFrame, group: str, src: str, tgt: str, meta: str) -> DataFrame:
    """Per group the lines of both sides and of the metadata, and whether the sides have equally many."""
    n = F.count
    return df.groupBy(group).agg(n(src).alias("src_lines"), n(tgt).alias("tgt_lines"), n(meta).alias("meta_lines"), (n(src) == n(tgt)).alias("aligned"))


def splits_of(df: DataFrame, group: str, most: int) -> DataFrame:
    """How many splits of at most so many rows each group needs."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / most).cast("long").alias("splits"))


def split_rows(df: DataFrame, group: str, id_col: str, most: int) -> DataFrame:
    """df with the split each row goes to: parts of about `most` rows by a hash of the id."""
    from loomline.operators.sampling import md5_bucket

    per = maybe_broadcast(splits_of(df, group, most).select(F.col(group).alias("__g"), F.col("splits").alias("__k")))
    return df.join(per, F.col(group).eqNullSafe(F.col("__g"))).withColumn("split", md5_bucket(F.col("__k"), id_col)).drop("__g", "__k")


def length_factors(df: DataFrame, lang: str, text: str, base: str) -> DataFrame:
    """Characters per language and the base language's characters relative to them; empty texts don't count."""
    per = df.where(F.col(text) != "").groupBy(lang).agg(F.sum(F.length(text)).alias("chars"))
    return with_totals(per, per.where(F.col(lang) == base).agg(F.sum("chars").alias("__base"))).select(lang, "chars", (F.col("__base") / F.col("chars")).alias("factor"))


def score_summary(df: DataFrame, score: str, threshold: float) -> DataFrame:
    """One row: how many scores, the lowest and highest, and how many reach a threshold, compared to nine decimals."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.min(score), 6).alias("low"), F.round(F.max(score), 6).alias("high"), F.count_if(F.round(score, 9) >= threshold).alias("above"))


def without_any(df: DataFrame, group: str, good: Column) -> DataFrame:
    """Groups with rows of which none is good, with their sizes."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("total"), F.count_if(good).alias("__good")).where("__good = 0").drop("__good")


def group_summary(df: DataFrame, group: str, measure: str, above: float) -> DataFrame:
    """Per group: count, mean, exact median and share above a value of a measure; null measures don't count."""
    own = df.where(F.col(measure).isNotNull())
    per = own.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(measure).alias("mean"), F.avg((F.col(measure) > above).cast("int")).alias("above"))
    middle = quantiles(own, group, measure, 0.5, "median").withColumnRenamed(group, "__g")
    return per.join(middle, F.col(group).eqNullSafe(F.col("__g"))).drop("__g")


def share_above_quantile(df: DataFrame, group: str, measure: str, q: float) -> DataFrame:
    """Per group the share and number of rows at or above the quantile of all."""
    own = df.where(F.col(measure).isNotNull()).select(group, measure)
    cut = quantiles(own.withColumn("__one", F.lit(1)), "__one", measure, q, "__t").select("__t")
    top = F.col(measure) >= F.col("__t")
    return with_totals(own, cut).groupBy(group).agg(F.avg(top.cast("int")).alias("share"), F.count_if(top).alias("n"))


def precision_at_recall(df: DataFrame, score: str, positive: Column, recall: float) -> DataFrame:
    """One row: precision and size of the rows at or above the score that keeps a share `recall` of the positives."""
    own = df.where(F.col(score).isNotNull()).select(score, positive.alias("__y")).where("__y IS NOT NULL")
    cut = quantiles(own.where("__y").withColumn("__one", F.lit(1)), "__one", score, 1 - recall, "__t").select("__t")
    return with_totals(own, cut).where(F.col(score) >= F.col("__t")).agg(F.avg(F.col("__y").cast("int")).alias("precision"), F.count(F.lit(1)).alias("n"))


def class_means(df: DataFrame, group: str, measures: list[str]) -> DataFrame:
    """Mean of each measure per class, and the mean of these means."""
    x = df.groupBy(group).agg(*(F.avg(c).alias(c) for c in measures))
    return x.withColumn("row_mean", sum((F.col(c) for c in measures), F.lit(0.0)) / len(measures))


def word_pivot(words: DataFrame, category: str, word: str, column: str, values: list[str]) -> DataFrame:
    """Counts of each (category, word, trailing signs cut off) by the values of a column, and in all."""
    bare = F.regexp_replace(F.lower(word), r"[^\p{L}\p{N}]+$", "")
    out = [F.count_if(F.col(column) == v).alias(v) for v in values]
    return words.select(category, bare.alias("word"), column).where("word <> ''").groupBy(category, "word").agg(*out, F.count(F.lit(1)).alias("total"))


def phrase_hits(df: DataFrame, id_col: str, text: Column, phrases: DataFrame, most: int = 4) -> DataFrame:
    """(id, phrase, n): how often each listed phrase of at most `most` words occurs in a text, as whole words in any case. A join of
    the text's word sequences with the list, so the list may be long."""
    from loomline.functions.text import word_format

    words = F.filter(F.split(word_format(text), " "), lambda w: w != "")
    none = F.expr("array()").cast("array<string>")

    def runs(k: int) -> Column:
        # one argument only: a second one would be taken as the index
        each = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - k + 1, F.lit(1))), lambda i: F.array_join(F.slice("w", i, F.lit(k)), " "))
        return F.when(F.size("w") >= k, each).otherwise(none)

    x = df.select(id_col, words.alias("w")).where("size(w) > 0")
    x = x.select(id_col, F.explode(F.concat(*(runs(k) for k in range(1, most + 1)))).alias("phrase"))
    listed = phrases.select(F.trim(word_format(F.col(phrases.columns[0]))).alias("phrase")).where("phrase <> ''").distinct()
    return x.join(maybe_broadcast(listed), "phrase", "left_semi").groupBy(id_col, "phrase").agg(F.count(F.lit(1)).alias("n"))


def phrase_summary(df: DataFrame, hits: DataFrame, id_col: str) -> DataFrame:
    """One row: occurrences, lines with any, all lines and the share of lines with any."""
    some = hits.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("phrases"), F.count_distinct(id_col).alias("lines_with"))
    return with_totals(df.agg(F.count(F.lit(1)).alias("lines")), some).select("phrases", "lines_with", "lines", F.try_divide(F.col("lines_with"), F.col("lines")).alias("share"))


# ---------------------------------------------------------------- word lists, vocabularies


def word_list(df: DataFrame, col: str) -> DataFrame:
    """(word): distinct entries of a list, as words apart by single blanks, each also in lower case; empty ones left out."""
    from loomline.functions.text import toxicity_tokens

    own = F.trim(toxicity_tokens(F.col(col)))
    return df.select(F.explode(F.array(own, F.lower(own))).alias("word")).where("word <> ''").distinct()


#: The first entries of a vocabulary.
SPECIALS = ("<s>", "<pad>", "</s>", "<unk>")


def vocabulary(words: DataFrame, col: str, most: int | None = None) -> DataFrame:
    """(word, n, id): words by falling count, then by name, numbered after the special entries."""
    per = words.where(F.col(col).isNotNull() & (F.col(col) != "")).groupBy(F.col(col).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    ids = numbered(per.withColumn("__k", -F.col("n")), ["__k", "word"], "id").drop("__k")
    ids = ids.withColumn("id", F.col("id") + len(SPECIALS))
    return ids.where(F.col("id") < most + len(SPECIALS)) if most else ids


def binarized(df: DataFrame, id_col: str, text: str, vocab: DataFrame) -> DataFrame:
    """(id, tokens): vocabulary ids of the words of a text, unknown words as <unk>, with </s> at the end; a null or empty text is </s> only."""
    end, unknown = SPECIALS.index("</s>"), SPECIALS.index("<unk>")
    words = df.select(id_col, F.posexplode(F.filter(F.split(text, r"\s+"), lambda w: w != "")).alias("place", "word"))
    coded = words.join(maybe_broadcast(vocab.select("word", F.col("id").cast("int").alias("__i"))), "word", "left")
    per = coded.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", F.coalesce("__i", F.lit(unknown)).alias("i")))), lambda x: x["i"]).alias("t"))
    return df.select(id_col).join(per, id_col, "left").select(id_col, F.concat(F.coalesce("t", F.expr("array()").cast("array<int>")), F.array(F.lit(end))).alias("tokens"))
