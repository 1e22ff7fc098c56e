import gzip
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.functions import text as T
from loomline.functions import vector as V
from loomline.operators import evaluation as E
from loomline.operators import language as L
from loomline.operators import records as R
from loomline.operators import sampling as S
from loomline.operators import segments as G
from loomline.plans import pipelines as P
from loomline.plans import registry
from loomline.sources import readers, sinks


def test_numbered_and_dense_ids(spark):
    values = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    assert {r.v: r.number for r in R.numbered(df, ["v"]).collect()} == {v: i for i, v in enumerate(sorted(values))}
    assert R.numbered(df.limit(0), ["v"]).count() == 0
    rows = [(i, w) for i, w in enumerate(["oak", "elm", "oak", None, "ash", "elm"])]
    ids = R.dense_ids(spark.createDataFrame(rows, "place long, w string"), "w", "place")
    assert {r.w: r.id for r in ids.collect()} == {"oak": 0, "elm": 1, "ash": 2}


def test_quantiles(spark):
    r = np.random.default_rng(2)
    rows = [(g, float(round(x, 1))) for g, n in (("a", 400), ("b", 7), (None, 30)) for x in r.normal(size=n)] + [("a", None), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for q in (0.0, 0.3, 0.5, 1.0):
        got = {x.g: x.quantile for x in R.quantiles(df, "g", "v", q).collect()}
        assert got.keys() == {"a", "b", None}
        for g in got:
            assert got[g] == pytest.approx(float(np.quantile([v for h, v in rows if h == g and v is not None], q)))


def test_sampling_keeps_the_least_hashes(spark):
    df = spark.range(9_000).select(F.col("id"), F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b").alias("g"))
    for n in (0, 1, 50, 100_000):
        got = S.sample_per_group(df, "g", "id", n).groupBy("g").count().collect()
        assert {r.g: r["count"] for r in got} == {g: min(n, k) for g, k in (("a", 6300), ("b", 1800), (None, 900)) if n}
    from pyspark.sql import Window

    ranked = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(S.md5_order("id"), "id"))).where("r <= 50")
    assert {r.id for r in ranked.collect()} == {r.id for r in S.sample_per_group(df, "g", "id", 50).collect()}


def test_sizes_and_sequences(spark):
    df = spark.createDataFrame([("10",), ("10K",), ("2 kb",), ("1.5MB",), ("3 G",), ("x",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(R.parse_size(F.col("s"))).collect()] == [10, 10_000, 2_048, 1_572_864, 3_000_000_000, None, None, None]
    rows = [(["a", "b", "a", "b", "c"], ["a", "b", "c"]), (["a"], ["a", "b"]), ([], ["a"]), (["a"], []), (None, ["a"])]
    got = spark.createDataFrame(rows, "t array<string>, p array<string>").select(R.sequence_position(F.col("t"), F.col("p"))).collect()
    assert [r[0] for r in got] == [2, -1, -1, -1, None]


def test_merging(spark):
    a = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "k int, s string, n int")
    b = spark.createDataFrame([(1, "x", 50), (2, "y", None)], "k int, s string, m int")
    assert sorted(map(tuple, R.checked_zip(a, b, "k", "s", "m").collect())) == [(1, "x", 5, 50, True), (2, "y", 6, None, False)]
    for broken in (b.where("k = 1"), b.withColumn("s", F.lit("z"))):
        with pytest.raises(Exception, match="the sides don't match"):
            R.checked_zip(a, broken, "k", "s").collect()
    assert R.later_wins([a, b.select("k", F.col("m").alias("n"))], "k").orderBy("k").collect()[0].n == 50
    assert R.prefixed(a, "src_", ["k"], {"n": "count"}).columns == ["k", "src_s", "src_count"]
    d = spark.createDataFrame([("a-b",), ("b-a",), ("a-c",), (None,)], "d string")
    assert {r.d for r in R.both_ways(d, "d").collect()} == {"a-b", "b-a"}


def test_selection(spark):
    df = spark.createDataFrame([(1, 0.5, "a"), (2, 2.0, "b"), (3, None, "c"), (4, float("nan"), "d"), (5, 1.5, None)], "i int, s double, c string")
    assert [r.i for r in R.accepted(df, "s", ["i"], 1.0).orderBy("i").collect()] == [2, 5] and R.accepted(df, "s", ["i"], 0.0, 1).first().i == 1
    assert R.accepted(df, "s", ["i"], 0.0, 0).count() == 0
    assert {r.i for r in R.outside(df, "c", df.where("i < 3").select("c")).collect()} == {3, 4}
    assert R.best_hypothesis(df.withColumn("g", F.lit("z")), "g", "s", "i", "c").where("NOT isnan(best)").count() <= 1


def test_words(spark):
    lists = spark.createDataFrame([("Bad-Word",), ("ugly",), ("",), (None,), ("ugly",)], "w string")
    assert {r.word for r in R.word_list(lists, "w").collect()} == {"Bad - Word", "bad - word", "ugly"}
    docs = spark.createDataFrame([(1, "In front of the house, in front of it"), (2, "Nothing"), (3, None), (4, "")], "i int, t string")
    hits = R.phrase_hits(docs, "i", F.col("t"), spark.createDataFrame([("in front of",), ("the",), ("absent",)], "p string"))
    assert {(r.i, r.phrase, r.n) for r in hits.collect()} == {(1, "in front of", 2), (1, "the", 1)}
    assert tuple(R.phrase_summary(docs, hits, "i").first()) == (3, 1, 4, 0.25)
    vocab = R.vocabulary(spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "w string"), "w", 2)
    assert {r.word: r.id for r in vocab.collect()} == {"b": 4, "a": 5}
    coded = R.binarized(spark.createDataFrame([(1, "a c  b"), (2, None), (3, "")], "i int, t string"), "i", "t", vocab)
    assert {r.i: r.tokens for r in coded.collect()} == {1: [5, 3, 4, 2], 2: [2], 3: [2]}


def test_word_values_and_accents(spark):
    x = spark.createDataFrame([(["▁ab", "c", "▁d"], [1.0, 2.0, 4.0]), ([], []), (None, None)], "t array<string>, v array<double>")
    got = x.select(T.word_values(F.col("t"), F.col("v")).alias("s"), T.word_values(F.col("t"), F.col("v"), "mean").alias("m")).collect()
    assert [(r.s, r.m) for r in got] == [([3.0, 4.0], [1.5, 4.0]), ([], []), (None, None)]
    y = spark.createDataFrame([("ガギ パ é ạ 한",)], "t string").select(T.strip_accents(F.col("t"))).first()[0]
    assert y == "カキ ハ e a 한"
    z = spark.createDataFrame([("1️⃣ go 🏴󠁧󠁢󠁥󠁮󠁧󠁿 3",)], "t string").select(T.demojize(F.col("t"))).first()[0]
    assert z == "go 3"
    blanks = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    assert spark.createDataFrame([("a-b c",)], "t string").select(T.toxicity_count(F.col("t"), ["a-b"], blanks)).first()[0] == 1


def test_languages(spark):
    said = {"eng_Latn": ["the cat and the dog", "a dog in the house"], "deu_Latn": ["die Katze und der Hund", "ein Hund in dem Haus"]}
    docs = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate((g, t) for g, ts in said.items() for t in ts)], "i int, t string, g string")
    langs = sorted(said)
    model = L.fit_languages(docs, "t", "g", langs, least=1)
    asked = spark.createDataFrame([(1, "the dog"), (2, "der Hund"), (3, "xyzzy"), (4, None), (5, "")], "i int, t string")
    out = L.language_scores(asked, "i", "t", model, langs)
    pick = lambda *a, **k: {r.i: r.b.lang for r in out.select("i", L.pick_language(F.col("probs"), *a, **k).alias("b")).collect()}
    assert pick() == {1: "eng_Latn", 2: "deu_Latn"}
    assert pick({"eng_Latn": 1.1}) == {1: "und", 2: "deu_Latn"} and pick({"eng_Latn": 1.1}, before=True) == {1: "deu_Latn", 2: "deu_Latn"}
    drop = lambda *a, **k: [r[0] for r in out.orderBy("i").select(L.language_drop(F.col("probs"), F.lit("eng_Latn"), *a, **k)).collect()]
    assert drop({}, 0.5) == [False, True] and drop({"eng_Latn": -1.0}) == [False, False] and drop({}, 0.5, excluded=F.lit(True)) == [False, False]
    short = spark.createDataFrame([("Abc 12, http://x.y",), ("a" * 50,), (None,)], "t string")
    assert [r[0] for r in short.select(L.close_language_drop(F.col("t"), F.lit(True))).collect()] == [False, True, False]
    assert short.select(L.bare_letters(F.col("t"))).first()[0] == "abc"
    codes = spark.createDataFrame([("rus",), ("eng_Latn",), ("srp_Cyrl",), ("qqq",), (None,)], "g string")
    assert [r[0] for r in codes.select(readers.language_script(F.col("g"))).collect()] == ["Cyrl", "Latn", "Cyrl", None, None]


def test_segments_out_and_in(spark):
    x = spark.createDataFrame([(1.5, "clip|0|48000|16"), (0.9, "clip|0|48000|16"), (1.5, "clip|0|32000|16"), (1.5, "words only")], "v double, t string")
    s = x.select("v", "t", V.parse_segment(F.col("t")).alias("s"))
    assert [r[0] for r in s.select(V.segment_text(F.col("s"))).collect()] == ["clip|0|48000|16"] * 2 + ["clip|0|32000|16", None]
    assert [r[0] for r in s.where("s.kind = 'audio'").select(V.long_enough(F.col("v"), F.col("s"), 1.0, 2.0)).collect()] == [True, False, False]


def test_batches_of_like_length(spark):
    df = spark.createDataFrame([(0, i, n) for i, n in enumerate([5, 1, 9, 2, 2, 40])], "lane int, i int, n int")
    got = {r.i: r.batch for r in G.duration_batches(df, "lane", "n", "n", 10, most_rows=3).collect()}
    assert got == {1: 0, 3: 0, 4: 0, 0: 1, 2: 2, 5: 3}


def test_measures(spark):
    df = spark.createDataFrame([("g", 1, "abc d", "abc d"), ("h", 2, "xyz", "abc"), ("h", 3, None, "q")], "g string, i int, h string, r string")
    got = {r.g: r.chrf for r in E.chrf(df, "g", "i", "h", "r").collect()}
    assert got["g"] == pytest.approx(100) and got["h"] == 0
    layers = np.random.default_rng(3).random((2, 3, 3))
    out = E.rollout(spark.createDataFrame([(1, layers.tolist()), (2, None)], "i int, a array<array<array<double>>>"), "i", "a").orderBy("id").collect()
    one = [0.5 * a / a.sum(1, keepdims=True) + 0.5 * np.eye(3) for a in layers]
    assert np.allclose(out[0].matrix, one[1] @ one[0]) and out[1].matrix is None
    m = spark.createDataFrame([([[0.5, 0.1, 0.4], [0.2, 0.3, 0.5]],)], "m array<array<double>>")
    c = m.select(E.contribution_metrics(F.col("m"), F.lit(2)).alias("c")).first().c
    assert len(c) == 18 and c.src_sum_contr_mean == pytest.approx(0.55) and c.avg_sc == pytest.approx(0.55)
    assert m.select(E.contribution_metrics(F.col("m"), F.lit(2), skip_first=True).alias("c")).first().c.avg_sc == pytest.approx(0.5)


def test_sinks(spark, tmp_path):
    v = spark.createDataFrame([(i, [0.1 * i, 1 / 3, -2049.0, 0.0]) for i in range(400)], "i long, v array<float>")
    some = sinks.sampled_vectors(v, "i", "v", 0.5, half=True)
    assert 120 < some.count() < 280
    for r in some.limit(5).collect():
        assert np.array_equal(np.array(r.v, np.float32), np.array([0.1 * r.i, 1 / 3, -2049.0, 0.0], np.float32).astype(np.float16).astype(np.float32))
    counts = spark.createDataFrame([("a", 2, 1), ("b", 3, 3)], "corpus string, before long, after long")
    sinks.write_filtered(spark.createDataFrame([("a", "x"), ("b", "y")], "corpus string, t string"), counts, str(tmp_path / "o"), "corpus")
    found = [json.loads(x) for p in (tmp_path / "o" / "counters").glob("*.json") for x in p.read_text().splitlines()]
    assert {"corpus": "total", "before": 5, "after": 4} in found and len(found) == 3
    x = spark.createDataFrame([("m1\ttext one",), ("alone",), (None,)], "line string")
    assert [(r.meta, r.text) for r in readers.split_at(x, "line", 1).collect()] == [("m1", "text one")]
    (tmp_path / "h.txt").write_text("head\na\nb\n")
    with gzip.open(tmp_path / "i.gz", "wt") as f:
        f.write("head\nc\n")
    got = readers.skip_header(readers.read_lines(spark, str(tmp_path / "[hi].*")))
    assert {(r.file[-4:], r.line_no, r.text) for r in got.collect()} == {(".txt", 0, "a"), (".txt", 1, "b"), ("i.gz", 0, "c")}


def test_large_files_are_read_in_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 70) for i in range(30_000)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        got = readers.read_lines(spark, str(tmp_path / "big.txt"))
        assert [r.text for r in got.orderBy("line_no").collect()] == lines and got.agg(F.max("line_no")).first()[0] == 29_999
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_stages(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    cfg = {"n": random.random()}
    for _ in range(2):
        assert registry.staged(spark, "three", "1", cfg, build).count() == 3
    assert len(calls) == 1
    registry.staged(spark, "three", "1", cfg, build, valid=lambda d: False)
    registry.staged(spark, "three", "2", cfg, build)
    assert len(calls) == 3
    assert registry.composed(lambda d: d.where("id > 0"), lambda d: d.limit(1))(spark.range(3)).count() == 1


def test_text_to_pairs(spark):
    words = {"x": "nil one two three four five six seven eight nine".split(), "y": "nul een twee drie vier vijf zes zeven acht negen".split()}
    spell = lambda side, n: " ".join(words[side][int(c)] for c in f"{n:03d}")
    side = lambda s, first: spark.createDataFrame([(first + n, spell(s, n)) for n in range(120)], "id long, text string")

    def encode(df):
        def run(it):
            for pdf in it:
                number = pdf.text.map(lambda t: int("".join(str((words["x"] if w in words["x"] else words["y"]).index(w)) for w in t.split())))
                yield pdf[["id"]].assign(embedding=[[float((n + 1) >> b & 1) for b in range(8)] for n in number])

        return df.mapInPandas(run, "id long, embedding array<float>")

    got = P.mine_texts(side("x", 0), side("y", 1000), encode, 8, k=4, mine_type="forward").collect()
    assert {(r.x_id, r.y_id - 1000) for r in got} >= {(n, n) for n in range(120) if bin(n + 1).count("1") > 1} and all(r.x_text and r.y_text for r in got)
