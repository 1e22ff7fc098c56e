import gzip
import lzma
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.plans import registry
from loomline.sources import catalog, readers, sinks


def test_lines_of_any_compression(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\ntwo\n\xff\n")
    with gzip.open(tmp_path / "b.gz", "wb") as f:
        f.write(b"x\ny\nz\n")
    with lzma.open(tmp_path / "c.xz", "wb") as f:
        f.write("é\n".encode())
    got = {(r.file.rsplit("/", 1)[1], r.line_no): r.text for r in readers.read_lines(spark, str(tmp_path)).collect()}
    assert got == {("a.txt", 0): "one", ("a.txt", 1): "two", ("a.txt", 2): "�", ("b.gz", 0): "x", ("b.gz", 1): "y", ("b.gz", 2): "z", ("c.xz", 0): "é"}


def test_mined_and_parallel(spark, tmp_path):
    (tmp_path / "m.tsv").write_text('1.75\tred door \t"rote Tür\n1.125\tcold\tkalt\n')
    assert [tuple(r) for r in readers.read_mined(spark, str(tmp_path / "m.tsv")).collect()] == [(1.75, "red door", '"rote Tür'), (1.125, "cold", "kalt")]
    (tmp_path / "s").write_text("a\nb\nc\n")
    (tmp_path / "t").write_text("A\nB\n")
    (tmp_path / "meta").write_text("m\n")
    got = readers.read_parallel(spark, *(str(tmp_path / x) for x in ("s", "t", "meta"))).orderBy("line_no")
    assert [(r.src, r.tgt, r.meta) for r in got.collect()] == [("a", "A", "m"), ("b", "B", None)]
    assert readers.line_range(got, 1).count() == 1 and readers.line_range(got, 0, 0).count() == 0


def test_header_tsv(spark, tmp_path):
    (tmp_path / "h.tsv").write_text("src\ttgt\n1\t2\n")
    assert readers.read_tsv(spark, str(tmp_path / "h.tsv"), ["tgt"]).first()[0] == "2"
    with pytest.raises(ValueError, match="no such columns"):
        readers.read_tsv(spark, str(tmp_path / "h.tsv"), ["other"])


def test_arrays(spark, tmp_path):
    a = np.arange(12, dtype=np.float16).reshape(3, 4)
    np.save(tmp_path / "a.npy", a)
    got = readers.read_npy(spark, str(tmp_path / "a.npy")).orderBy("row").collect()
    assert np.array_equal(np.array([r.embedding for r in got]), a.astype(np.float32))
    (tmp_path / "raw.npy").write_bytes(a.astype(np.float32).tobytes())
    assert readers.read_npy(spark, str(tmp_path / "raw.npy"), dim=4).count() == 3
    np.savez(tmp_path / "x.npz", scores=np.array([1.0, 1.3, 1.1]), src_idx=np.array([1, 2, 3]), tgt_idx=np.array([4, 5, 6]), bwd_pos=2)
    assert [(r.src_idx, r.direction) for r in catalog.read_alignments(spark, str(tmp_path / "x.npz"), 1.05).collect()] == [(2, "fwd"), (3, "bwd")]


def test_discovery(spark, tmp_path):
    d = tmp_path / "eng-fra"
    d.mkdir()
    for n in ("news.eng.gz", "news.fra.gz", "talks.eng", "web.001.eng"):
        (d / n).write_bytes(b"x")
    files = catalog.list_files(spark, str(tmp_path))
    assert [r.corpus for r in catalog.corpus_pairs(files).collect()] == ["news"]
    assert catalog.corpus_pairs(files, exclude=("news",)).count() == 0
    assert [r["shard"] for r in catalog.find_shards(spark, str(tmp_path), "web*").collect()] == [1]
    with pytest.raises(FileNotFoundError):
        catalog.find_shards(spark, str(tmp_path), "none*")
    assert catalog.corpora_of({"train": {"a-b": {"x": 1, "y": 2}, "c-d": None}}) == [("train", "a-b", "x"), ("train", "a-b", "y")]


def test_audio(spark, tmp_path):
    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(8000)
        w.writeframes(b"\0\0" * 4000)
    (tmp_path / "b.wav").write_bytes(b"broken")
    assert {r.name: r.duration_ms for r in catalog.wav_manifest(spark, str(tmp_path)).collect()} == {"a.wav": 500, "b.wav": None}
    chunks = catalog.manifest_chunks(spark.range(10), "id", 3)
    assert {r.chunk: r["count"] for r in chunks.groupBy("chunk").count().collect()} == {0: 3, 1: 3, 2: 4}


def test_meta_split(spark):
    x = spark.createDataFrame([("text\ta\tb", "cc200xl"), ("a\tb\ttext", "paracrawl9"), ("only", "x"), (None, "x")], "line string, corpus string")
    got = x.select(readers.split_meta(F.col("line"), F.col("corpus")).alias("m")).collect()
    assert [(r.m.text, r.m.meta) for r in got[:3]] == [("text", "a\tb"), ("text", "a\tb"), ("only", "")]
    row = spark.createDataFrame([("c 1  2 h 0.9 the text here",)], "line string").select(readers.split_row(F.col("line")).alias("r")).first().r
    assert row.meta == ["c", "1", "2", "h", "0.9"] and row.text == "the text here"


def test_scores_and_tags(spark):
    lines = spark.createDataFrame([("ck1 valid BLEU4 = 20.5, x",), ("ck2 valid BLEU = 21, x",), ("ck2 test BLEU = 19.0",), ("noise",), ("H-1\t-0.5\thallo",)], "text string")
    best = catalog.best_checkpoint(readers.parse_scores(lines)).first()
    assert (best.checkpoint, best.select_score, best.report_score) == ("ck2", 21.0, 19.0)
    assert readers.tagged_lines(lines, "H-", 2).first().value == "hallo"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1.5, "a\tb\nc", None), (0.5, '"q"', "d")], "score double, src string, tgt string")
    sinks.write_bitext(df, str(tmp_path / "o"), "score", "src", "tgt")
    got = {r.score: (r.src, r.tgt) for r in readers.read_mined(spark, str(tmp_path / "o")).collect()}
    assert got == {1.5: ("a b c", None), 0.5: ('"q"', "d")}
    sinks.write_shards(spark.range(10).withColumn("shard", F.col("id") % 2), str(tmp_path / "p"), ["shard"], max_rows=2)
    assert spark.read.parquet(str(tmp_path / "p")).where("shard = 1").count() == 5
    assert sinks.replicated(df, 3).count() == 6
    with pytest.raises(Exception, match="dimension"):
        sinks.checked_vectors(spark.sql("SELECT array(1.0, 2.0) AS v"), "v", 3).collect()


def test_lookup(spark):
    t = spark.createDataFrame([("hrv", "hbs"), ("bos", "hbs")], "a string, b string")
    got = readers.lookup_language(spark.createDataFrame([("hrv",), ("eng",), (None,)], "lang string"), "lang", t, "a", "b").collect()
    assert [r.b for r in got] == ["hbs", "eng", None]


def test_extension_points(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "a b")], "id int, t string")
    words = registry.map_lines(df, lambda rows: ({"id": r["id"], "w": w} for r in rows for w in r["t"].split()), "id int, w string")
    assert words.count() == 5
    with_state = registry.map_lines(df, lambda rows, s: ({"id": r["id"], "w": s} for r in rows), "id int, w string", setup=lambda: "state")
    assert {r.w for r in with_state.collect()} == {"state"}
    once = registry.once_per_value(df, "t", lambda x: x.withColumn("n", F.length("t")))
    assert sorted(r.n for r in once.collect()) == [1, 3, 3]

    @registry.step("double")
    def double(x):
        return x.union(x)

    assert registry.build("double", df).count() == 6
    with pytest.raises(KeyError):
        registry.build("nothing")
    with pytest.raises(Exception, match="broken"):
        registry.checked(df, small=F.col("id") < 3).collect()
    total = registry.map_reduce(df, lambda p: p.groupby("t", as_index=False).agg(n=("id", "size")), "t string, n long", ["t"], [F.sum("n").alias("n")])
    assert {r.t: r.n for r in total.collect()} == {"a b": 2, "c": 1}


def test_streams(spark):
    from loomline.streaming import incremental as inc

    d = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{d}/events.parquet")
    seen = inc.run_once(spark, inc.first_seen(inc.stream_of(spark, d, "events").select("user_id", "ts"), ["user_id"], "ts", "3650 days"))
    assert seen.count() == events.select("user_id").distinct().count()
    per = inc.run_once(spark, inc.windowed_counts(inc.stream_of(spark, d, "events"), "ts", "event_type"), "complete")
    assert per.agg(F.sum("n")).first()[0] == events.count()
