import unicodedata

import pytest
from pyspark.sql import functions as F

from loomline.functions import text as T
from loomline.operators import filters as FI


def one(spark, expr, *texts):
    return [r[0] for r in spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, i int").orderBy("i").select(expr(F.col("t"))).collect()]


def test_replacers(spark):
    assert one(spark, lambda c: T.replace_urls(c, "_"), "bonjour bonjour http://www.example.com hello how") == ["bonjour bonjour _ hello how"]
    assert one(spark, lambda c: T.replace_urls(c, " "), "https://instagram.com/test files") == ["  files"]
    assert one(spark, lambda c: T.replace_hashtags(c, "[HASHTAG]"), "a #bonjour b #abc") == ["a [HASHTAG] b #abc"]
    assert one(spark, T.replace_non_printing, "\x00\x11Hello​World") == ["  Hello World"]
    assert one(spark, T.demojize, "😺😸😹😻😼cats😽🙀😿😾", "more 😻😼😽 cats", None, "") == ["cats", "more cats", None, ""]
    assert one(spark, lambda c: T.demojize(c, " "), "some 😻😼😽 cats") == ["some     cats"]


@pytest.mark.parametrize(("text", "script", "share"), [
    ("this is a latin script.", "Latn", 1.0), ("isso é escrita latina 1234", "Latn", 1.0), ("এটি বাংলা লিপি", "Beng", 1.0), ("นี่คืออักษรไทย", "Thai", 1.0),
    ("এ 1234 b", None, 0.0), ("এ.ก,b গ", None, 0.0), ("1234", None, 0.0), ("  ", None, 0.0), ("", None, 0.0),
])
def test_script(spark, text, script, share):
    got = one(spark, lambda c: T.predict_script(T.script_counts(c)), text)[0]
    if text == "এ.ก,b গ":
        # two of four letters are Bengali: no tie of all scripts
        assert got.script == "Beng" and got.share == 0.5
    else:
        assert (got.script, got.share) == (script, share)


def test_accents_follow_the_normal_form(spark):
    text = "Ünïcödé ñandú Ёлка naïve é Ǆ ẞ ß Åström"
    want = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
    assert one(spark, T.strip_accents, text, None) == [want, None]


def test_normalize(spark):
    assert one(spark, T.normalize_whitespace, " a\t  b\n", "", None) == ["a b", "", None]
    assert one(spark, T.replace_unicode_punct, "「a」—…１") == ['"a" - ..."']
    assert one(spark, T.normalize_for_dedup, "Élan 12٣ «x»") == ["elan 000 x"]
    assert one(spark, T.balance_quotes, '"abc', 'abc"', '"abc"', '"', None) == ["abc", "abc", '"abc"', "", None]
    assert one(spark, T.normalize_line, '  “abc  d') == ["abc d"]


def test_keep_text(spark):
    strict = {"min_chars": 1, "max_chars": 200, "max_punct": 1.0, "max_number": 1.0, "min_space": 0.0, "max_space": 1.0, "max_emoji": 1.0, "max_run": 10}
    keep = lambda t, **kw: one(spark, lambda c: FI.keep_text(c, **(strict | kw)), t)[0]
    assert keep("I like this one", min_chars=5, max_punct=0.5, max_number=0.5, min_space=0.05, max_space=0.5, max_emoji=0.2)
    assert not keep("short?", min_chars=100)
    assert not keep("long?", max_chars=2)
    assert not keep("you like numbers? 123564136576101, 020, 03. 0800, 084", max_number=0.1)
    assert not keep("cats😺😸😹😻😼😽🙀😿😾", max_emoji=0.1)
    assert not keep("hahahahhahahhahahhahahaha", min_space=0.05)
    assert not keep("aaaaaaaaaaaaaaaaaaaaaaa b", max_run=15)
    assert not keep("")
    assert keep(None) is None


def test_sentences(spark):
    got = one(spark, T.sentences, "One here. Two here! and more?\nThree\n\n", "", None)
    assert got == [["One here.", "Two here! and more?", "Three"], [], None]


def test_ngrams_and_subwords(spark):
    assert one(spark, lambda c: T.char_ngrams(c, 2), "a bc", "a", None) == [["ab", "bc"], [], None]
    assert one(spark, lambda c: T.shingles(c, 3), "abcabc", "ab") == [["abc", "bca", "cab"], ["ab"]]
    tokens = spark.sql("SELECT array('▁he', 'llo', '▁wor', 'ld', '</s>') AS t")
    assert tokens.select(T.merge_subwords(F.col("t"))).first()[0] == [0, 0, 1, 1, 2]
    assert [tuple(x) for x in one(spark, T.parse_alignment, "3-2 5p4")[0]] == [(3, 2), (5, 4)]
    assert [tuple(x) for x in one(spark, lambda c: T.parse_alignment(c, reverse=True, one_indexed=True), "3-2")[0]] == [(1, 2)]


def test_chain_first_reason_and_counts(spark):
    df = spark.createDataFrame([("c", "short", "x", 2.0), ("c", None, "x", 2.0), ("c", "a fine sentence here", "another fine sentence", 0.5), ("c", "a fine sentence here", "another fine sentence", 0.0),
                                ("c", "a fine sentence here", "b" * 400, None)], "corpus string, src string, tgt string, score double")
    rules = [FI.score_rule("score"), *FI.LengthRule(min_len=6).rules("src", "tgt")]
    out = FI.chain(df, rules)
    assert [r.drop_reason for r in out.collect()] == ["min_len", "empty", "score", None, "max_len_ratio"]
    c = FI.counters(out, rules, "corpus").first().asDict()
    assert (c["total_before"], c["total_after"], c["min_len"], c["score"]) == (5, 1, 1, 1)


def test_symbol_rules(spark):
    df = spark.createDataFrame([("no digits", "none"), ("in the year 1999", "x y"), ("a #b #c #d #e", "x"), ("11 22 a", "x"), (". . . a", "x")], "src string, tgt string")
    assert [r.drop_reason for r in FI.chain(df, FI.symbol_rules("src", "tgt", keep_numbers=True)).collect()] == [None, None, "hashtags", "digit_ratio", "alpha_words"]
    assert FI.chain(df, FI.symbol_rules("src", "tgt")).collect()[1].drop_reason == "numbers"


def test_language_and_toxicity_rules(spark):
    df = spark.createDataFrame([("You idiot, idiot!", "fine", 0.0), ("ok", "ok", 0.4)], "src string, tgt string, p double")
    assert df.select(T.toxicity_count(F.col("src"), ["idiot", "you"])).collect()[0][0] == 2
    assert [r.drop_reason for r in FI.chain(df, FI.toxicity_rules("src", "tgt", ["idiot"], ["idiot"], max_count=0)).collect()] == ["toxicity", None]
    assert [r.drop_reason for r in FI.chain(df, FI.language_rules("p")).collect()] == ["lid", None]
