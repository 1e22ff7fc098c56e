"""Language identification by naive Bayes over words, with thresholds, exclusions and an unknown label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.operators.analytics import with_totals
from loomline.session import maybe_broadcast, written


def _words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}+"), F.lit(0))


def fit_languages(docs: DataFrame, text: str, label: str, langs: list[str], least: int = 2) -> DataFrame:
    """(word, gains, base): for each word seen at least so often in texts labelled with one of langs, the logarithms of its counts plus one
    by language, and in every row the logarithms of the languages' sizes. Counted over all labelled texts. Wrong labels
    weigh little as long as most are right."""
    own = docs.where(F.col(label).isin(*langs)).select(F.col(label).alias("l"), F.explode(_words(F.col(text))).alias("word"))
    per = own.groupBy("word").agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col("l") == g).alias(f"n{i}") for i, g in enumerate(langs))).where(F.col("n") >= least)
    per = written(per, "language-words")
    size = per.agg(F.count(F.lit(1)).alias("v"), *(F.sum(f"n{i}").alias(f"s{i}") for i in range(len(langs))))
    base = size.select(F.array(*(F.ln(F.coalesce(f"s{i}", F.lit(0)) + F.col("v") + 1) for i in range(len(langs)))).alias("base"))
    return with_totals(per.select("word", F.array(*(F.ln(F.col(f"n{i}") + 1.0) for i in range(len(langs)))).alias("gains")), base)


def language_scores(df: DataFrame, id_col: str, text: str, model: DataFrame, langs: list[str]) -> DataFrame:
    """(id, words, probs): probability of each language by the mean log likelihood of a text's known words; a text without known words
    has no row. One row per id is expected."""
    words = df.select(id_col, F.explode(_words(F.col(text))).alias("word")).groupBy(id_col, "word").agg(F.count(F.lit(1)).alias("n"))
    met = words.join(maybe_broadcast(model), "word")
    sums = [F.sum(F.col("n") * (F.get("gains", F.lit(i)) - F.get("base", F.lit(i)))).alias(f"g{i}") for i in range(len(langs))]
    per = met.groupBy(id_col).agg(F.sum("n").alias("words"), *sums)
    mean = [F.exp(F.col(f"g{i}") / F.col("words")) for i in range(len(langs))]
    total = sum(mean[1:], mean[0])
    return per.select(id_col, "words", F.map_from_arrays(F.array(*map(F.lit, langs)), F.array(*(m / total for m in mean))).alias("probs"))


def pick_language(probs: Column, thresholds: dict[str, float] | None = None, before: bool = False, unknown: str = "und") -> Column:
    """struct(lang, p) of a map of probabilities: the most probable language, of equal ones the first by name. With thresholds by language
    (0 where none is given) a language below its own is no candidate (before), or turns into the unknown label afterwards."""
    limit: Column = F.lit(0.0)
    items = F.transform(F.map_entries(probs), lambda e: F.struct((-e["value"]).alias("d"), e["key"].alias("lang")))
    limits = F.create_map(*(F.lit(x) for kv in (thresholds or {}).items() for x in kv)) if thresholds else None
    below = lambda e: (-e["d"] < F.coalesce(F.try_element_at(limits, e["lang"]), limit)) if limits is not None else F.lit(False)
    if before:
        items = F.filter(items, lambda e: ~below(e))
    best = F.get(F.transform(F.array(F.get(F.array_sort(items), 0)), lambda e: F.struct(F.when(e.isNull() | below(e), F.lit(unknown)).otherwise(e["lang"]).alias("lang"), F.round(-e["d"], 6).alias("p"))), 0)
    return F.when(probs.isNotNull(), best)


def language_drop(probs: Column, expected: Column, thresholds: dict[str, float], default: float = 0.0, excluded: Column | None = None) -> Column:
    """Whether the probability of the expected language is at most its threshold; a negative threshold, an excluded row or a
    text without a probability drops nothing."""
    limit = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in thresholds.items() for x in kv)), expected), F.lit(default)) if thresholds else F.lit(default)
    drop = (limit >= 0) & (F.round(F.coalesce(F.try_element_at(probs, expected), F.lit(0.0)), 6) <= limit) & probs.isNotNull()
    drop = drop & ~F.coalesce(excluded, F.lit(False)) if excluded is not None else drop
    return F.coalesce(drop, F.lit(False))


def bare_letters(c: Column) -> Column:
    """Lower-case text without digits, links and punctuation, as a classifier of close languages reads it; blanks are single."""
    out = F.regexp_replace(F.lower(c), r"[\p{Nd}\p{P}\p{S}]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"\bhttps?\S*|\bwww\S*", ""), r"\s+", " "))


def close_language_drop(c: Column, wrong: Column, least: int = 40) -> Column:
    """Whether a text has the wrong one of two close languages; texts of fewer letters pass."""
    return F.coalesce((F.length(bare_letters(c)) >= least) & wrong, F.lit(False))
