"""Row filters as predicates, and the ordered chain with a reason per dropped row."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions import text as T


@dataclass(frozen=True)
class Rule:
    """A filter: a name and the condition under which a row is dropped. A null condition keeps it."""

    name: str
    drop: Column


def chain(df: DataFrame, rules: list[Rule], reason: str = "drop_reason") -> DataFrame:
    """Add the name of the first rule that drops a row, null for kept rows. One pass; the order of
    rules is the order in which reasons are given."""
    out: Column = F.lit(None).cast("string")
    for r in reversed(rules):
        out = F.when(F.coalesce(r.drop, F.lit(False)), F.lit(r.name)).otherwise(out)
    return df.withColumn(reason, out)


def counters(df: DataFrame, rules: list[Rule], by: str, reason: str = "drop_reason") -> DataFrame:
    """Per group: rows before and after, and rows dropped by each rule."""
    drops = [F.count_if(F.col(reason) == r.name).alias(r.name) for r in rules]
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("total_before"), F.count_if(F.col(reason).isNull()).alias("total_after"), *drops)


def empty(src: str, tgt: str | None = None) -> Column:
    blank = F.col(src).isNull() | (F.col(src) == "")
    return blank | (F.col(tgt) == "") if tgt else blank


@dataclass(frozen=True)
class LengthRule:
    """Length limits on scaled character counts; a limit of None or 0 is off. Factors by language, 1 where missing."""

    min_len: int | None = 1
    max_len: int | None = 1050
    max_ratio: float | None = 9.0
    min_unique_ratio: float | None = None
    factors: dict[str, float] = field(default_factory=dict)

    def _scaled(self, col: str, lang: str | Column | None) -> Column:
        f: Column = F.lit(1.0)
        if lang is not None:
            name = F.col(lang) if isinstance(lang, str) else lang
            for k, v in self.factors.items():
                f = F.when(name == k, F.lit(v)).otherwise(f)
        return F.greatest(F.lit(1.0), F.length(col) * f)

    def rules(self, src: str, tgt: str, src_lang=None, tgt_lang=None, order: int = 6) -> list[Rule]:
        s, t = self._scaled(src, src_lang), self._scaled(tgt, tgt_lang)
        out = [Rule("empty", empty(src, tgt))]
        if self.min_len:
            out.append(Rule("min_len", (s < self.min_len) | (t < self.min_len)))
        if self.max_len:
            out.append(Rule("max_len", (s > self.max_len) | (t > self.max_len)))
        if self.max_ratio:
            out.append(Rule("max_len_ratio", F.greatest(s / t, t / s) > self.max_ratio))
        if self.min_unique_ratio:
            grams = T.char_ngrams(F.col(src), order)
            out.append(Rule("unique_ratio", F.try_divide(F.size(F.array_distinct(grams)), F.size(grams)) < self.min_unique_ratio))
        return out


def digit_ratio(c: Column) -> Column:
    return T.count_of(c, r"\p{Nd}") / (T.count_of(c, r"\p{L}") + 1)


def alpha_word_share(c: Column) -> Column:
    """Share of the parts between blanks that have a letter; empty parts count."""
    parts = F.split(c, " ")
    return F.size(F.filter(parts, lambda w: w.rlike(r"\p{L}"))) / F.size(parts)


def has_ellipsis(c: Column) -> Column:
    return c.rlike(r"\.{3,}")


def symbol_rules(src: str, tgt: str, keep_numbers: bool = False, hashtags: int | None = 3, digits: float = 0.5, alpha_words: float = 0.5) -> list[Rule]:
    cols = (F.col(src), F.col(tgt))
    anyone = lambda f: f(cols[0]) | F.coalesce(f(cols[1]), F.lit(False))
    out = []
    if not keep_numbers:
        # dates and numbers alike hold a digit
        out.append(Rule("numbers", anyone(lambda c: c.rlike(r"\p{Nd}"))))
    if hashtags:
        out.append(Rule("hashtags", anyone(lambda c: F.length(c) - F.length(F.replace(c, F.lit("#"), F.lit(""))) > hashtags)))
    out.append(Rule("digit_ratio", anyone(lambda c: digit_ratio(c) > digits)))
    out.append(Rule("alpha_words", anyone(lambda c: alpha_word_share(c) < alpha_words)))
    return out


def score_rule(score: str, threshold: float = 1.06) -> Rule:
    """Null, NaN and zero scores pass."""
    c = F.col(score)
    return Rule("score", c.isNotNull() & ~F.isnan(c) & (c != 0) & (c < threshold))


def keep_text(
    c: Column, min_chars: int = 10, max_chars: int = 500, max_punct: float = 0.2, max_number: float = 0.2, min_space: float = 0.03, max_space: float = 0.5,
    max_emoji: float = 0.2, max_run: int | None = 10,
) -> Column:
    """Whether a sentence has plausible length and character shares; null for null."""
    n = F.length(c)
    share = lambda p: F.coalesce(F.try_divide(T.count_of(c, p), n), F.lit(0.0))
    space = share(r"[\t-\r ]")
    ok = (n >= min_chars) & (n <= max_chars) & (n > 0)
    ok = ok & (share(T.PUNCT) <= max_punct) & (share("[0-9]") <= max_number) & space.between(min_space, max_space) & (share(T.EMOJI) <= max_emoji)
    return ok & (T.longest_run(c) <= max_run) if max_run else ok


def toxicity_rules(src: str, tgt: str, src_words: list[str], tgt_words: list[str], max_count: int | None = None, max_difference: int | None = 2) -> list[Rule]:
    a, b = T.toxicity_count(F.col(src), src_words), T.toxicity_count(F.col(tgt), tgt_words)
    out = [Rule("toxicity", (a > max_count) | (b > max_count))] if max_count is not None else []
    return [*out, Rule("toxicity_difference", F.abs(a - b) > max_difference)] if max_difference is not None else out


def language_rules(prob: str, threshold: float = 0.0) -> list[Rule]:
    """Drop where the probability of the expected language is at most the threshold; a negative one is off."""
    return [Rule("lid", F.col(prob) <= threshold)] if threshold >= 0 else []


def languages_crossed(pred_src: Column, pred_tgt: Column, src_lang: Column, tgt_lang: Column) -> Column:
    """A side looks like the language of the other side."""
    return (pred_src == tgt_lang) | (pred_tgt == src_lang)


def token_rules(src: str, tgt: str, low: int = 1, high: int = 250, ratio: float = 2.5) -> list[Rule]:
    n = lambda c: F.size(F.filter(F.split(F.col(c), r"\s+"), lambda x: x != ""))
    a, b = n(src), n(tgt)
    return [Rule("token_count", ~a.between(low, high) | ~b.between(low, high)), Rule("token_ratio", F.greatest(F.try_divide(a, b), F.try_divide(b, a)) > ratio)]


def line_outcome(clean: Column, expected_script: Column, script: Column, expected_lang: Column, lang: Column, prob: Column, script_min: float, lid_min: Column, **limits) -> Column:
    """What becomes of a sentence: kept, or the first of filtered, extra_filtered (without links and tags),
    script_filtered, script_mismatch, lid_filtered, lid_mismatch."""
    bare = F.trim(T.replace_hashtags(T.replace_urls(clean)))
    return (
        F.when(~keep_text(clean, **limits), "filtered").when(~keep_text(bare, **limits), "extra_filtered").when(F.coalesce(script["share"], F.lit(0.0)) < script_min, "script_filtered")
        .when(~F.coalesce(script["script"] == expected_script, F.lit(False)), "script_mismatch").when(prob < lid_min, "lid_filtered").when(lang != expected_lang, "lid_mismatch").otherwise("kept")
    )
