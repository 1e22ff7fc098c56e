import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomline.llm import abuse, bpe, canonical, cutoff, hilbert_knn, lid, mixing, overlap, splitting

# ------------------------------------------------------------------ 1


def test_duplicates_hidden_by_formatting(spark):
    rows = [
        (5, "The cat, sat!", "Le chat"), (3, "LE  CHAT", "the—cat​sat"), (9, "the cat sat", "le chat."), (9, "the cat sat", "le chat."), (1, "other", "thing"),
        (2, None, "le chat"), (4, "...", "le chat"), (6, "", ""), (7, "ｔｈｅ cat sat", "le chat"), (None, "the cat sat", "le chat"), (8, "thecat sat", "le chat"),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "line_id long, src string, tgt string, k string, chk string")
    got = {(r.keep_id, r.id) for r in canonical.duplicate_pairs(df, "line_id", "src", "tgt").collect()}
    assert got == {(3, 5), (3, 7), (3, 9)}
    copies = {r.keep_id: r.copies for r in canonical.collapsed_records(df, "line_id", "src", "tgt").collect()}
    assert copies == {3: 4, 1: 1, 8: 1}
    assert canonical.duplicate_pairs(df.limit(0), "line_id", "src", "tgt").count() == 0
    assert canonical.collisions(canonical.copy_counts(canonical.record_keys(df, "line_id", "src", "tgt"))).count() == 0


def test_one_group_of_most_rows(spark):
    df = spark.range(12_000).select(F.col("id").alias("line_id"), F.lit("a b").alias("src"), F.lit("C").alias("tgt"))
    out = canonical.duplicate_pairs(df, "line_id", "src", "tgt")
    assert out.count() == 11_999 and out.select("keep_id").distinct().collect()[0][0] == 0


# ------------------------------------------------------------------ 2


def test_hilbert_keys_walk_the_grid():
    for dims, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = hilbert_knn.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_similar_vectors(spark):
    r = np.random.default_rng(3)
    centres = r.standard_normal((150, 16))
    x = (centres[r.integers(0, 150, 1500)] + 0.3 * r.standard_normal((1500, 16))).astype(np.float32)
    x[100:140] = x[100]  # a group of copies larger than k
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    sim = np.round(u @ u.T, 10)
    np.fill_diagonal(sim, -2)
    want = {(i, int(j)) for i in range(1500) for j in np.lexsort((np.arange(1500), -sim[i]))[:5] if sim[i, j] >= 0.85}
    rows = [(i, v.tolist(), 1, "z") for i, v in enumerate(x)] + [(9001, None, 1, "z"), (9002, [0.0] * 16, 1, "z"), (9003, [1.0] * 8, 1, "z"), (9004, [float("nan")] * 16, 1, "z")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, key int, near string")
    got = {tuple(q) for q in hilbert_knn.similar_pairs(df, 0.85, dim=16, curves=8, window=64, dims=8, bits=6).collect()}
    assert len(got & want) / len(want) >= 0.97 and len(got - want) / len(got) < 0.03
    assert {p for p in got if 100 <= p[0] < 140} == {p for p in want if 100 <= p[0] < 140}
    lists = hilbert_knn.similar_vectors(df, dim=16, curves=2, window=64)
    assert lists.count() == 1500
    one = hilbert_knn.similar_vectors(df.where("vec_id = 7"), dim=16).collect()
    assert len(one) == 1 and one[0].indices == []
    assert hilbert_knn.similar_vectors(df.limit(0), dim=16).count() == 0


def test_similar_vectors_of_dense_groups(spark):
    # a group of parallel vectors and one of almost equal ones, both far larger than three windows
    r = np.random.default_rng(4)
    x = r.standard_normal((2400, 32))
    x[:800] = x[0] * r.uniform(0.5, 2, (800, 1))
    x[800:1600] = x[800] + 0.01 * r.standard_normal((800, 32))
    x = x[r.permutation(2400)].astype(np.float32)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    sim = np.round(u @ u.T, 10)
    np.fill_diagonal(sim, -2)
    want = {(i, int(j)) for i in range(2400) for j in np.lexsort((np.arange(2400), -sim[i]))[:5] if sim[i, j] >= 0.85}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = [tuple(q) for q in hilbert_knn.similar_pairs(df, 0.85, dim=32, window=32).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    blocks = hilbert_knn.similar_pairs(df, 0.85, dim=32, window=32, curves=2, block=1000)
    assert {tuple(q) for q in blocks.collect()} == want


def test_ranges_and_orderings():
    assert hilbert_knn.orderings(0) >= 2 and hilbert_knn.orderings(2_000_000) > hilbert_knn.orderings(40_000)
    assert hilbert_knn.range_rows(10) == hilbert_knn.LEAST_RANGE and hilbert_knn.range_rows(10**9) == hilbert_knn.MOST_RANGE
    r = np.random.default_rng(8)
    x = r.standard_normal((3000, 24))
    x[1500:] = x[:1500] + 0.4 * r.standard_normal((1500, 24))
    x[40:60] = x[40]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = r.permutation(3000) * 7
    sim = np.rint(x @ x.T * 1e10) / 1e10
    np.fill_diagonal(sim, -2)
    best = [ids[np.lexsort((ids, -row))[:6]] for row in sim]
    exact = hilbert_knn.nearest_in_range(ids, x, 6, 400, 0.85, 1)[0]
    assert all((a == b).all() for a, b in zip(exact, best, strict=True))
    near, cos, _ = hilbert_knn.nearest_in_range(ids, x, 6, 64, 0.85, 1)
    pairs = [(i, j) for i in range(3000) for j in range(6) if sim[i].max() > 0 and np.sort(sim[i])[-1 - j] >= 0.85]
    assert np.mean([best[i][j] in near[i] for i, j in pairs]) > 0.95
    assert hilbert_knn.nearest_in_range(ids[:1], x[:1], 6, 64, 0.85, 1)[1].max() == -np.inf


# ------------------------------------------------------------------ 3


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_near_lines_against_all_pairs(spark, monkeypatch):
    r = random.Random(5)
    word = lambda: r.choice("abcdefgh")
    base = [[word() for _ in range(r.randint(1, 14))] for _ in range(30)]

    def changed(w):
        w = list(w)
        for _ in range(r.randint(0, 3)):
            at, do = r.randrange(len(w) + 1), r.random()
            if do < 0.4:
                w.insert(at, word())
            elif w and at < len(w):
                w[at : at + 1] = [] if do < 0.7 else [word()]
        return w

    e = [(i, "en-de", " ".join(w), None if i % 7 == 0 else " ".join(changed(base[-i]))) for i, w in enumerate(base)]
    t = [(1000 + i, r.choice(["en-de", "de-en", "en-fr"]), " ".join(changed(r.choice(base))).upper(), r.choice(["", None, "A a a a a a", " ".join(changed(r.choice(base)))])) for i in range(250)]
    t += t[:20]
    schema = "line_id long, lang_dir string, src string, tgt string"
    want = set()
    side = lambda x: [(g, tuple((s or "").lower().split())) for g, s in zip(x[1].split("-"), x[2:]) if (s or "").split()]
    for x, y in itertools.product(e, t):
        for (g, a), (h, b) in itertools.product(side(x), side(y)):
            if g == h and edits(a, b) <= max(len(a), len(b)) // 5:
                want.add((x[0], y[0]))
    ed, td = spark.createDataFrame(e, schema), spark.createDataFrame(t, schema)
    assert {tuple(q) for q in overlap.near_lines(ed, td).collect()} == want
    monkeypatch.setattr(overlap, "BROADCAST_ROWS", 3)  # the way of large evaluation splits
    assert {tuple(q) for q in overlap.near_lines(ed, td).collect()} == want
    monkeypatch.undo()
    assert overlap.near_lines(ed, td.limit(0)).count() == 0 and overlap.near_lines(ed.limit(0), td).count() == 0


# ------------------------------------------------------------------ 4

SENTENCES = {
    "eng_Latn": "The cat sits under the table. She walks to the market every morning. We read the newspaper with the children. The weather was very cold this winter.",
    "deu_Latn": "Die Katze sitzt unter dem Tisch. Sie geht jeden Morgen zum Markt. Wir lesen die Zeitung mit den Kindern. Das Wetter war diesen Winter sehr kalt.",
    "rus_Cyrl": "Кошка сидит под столом. Она каждое утро ходит на рынок. Мы читаем газету с детьми. Погода этой зимой была очень холодной.",
}


def test_languages(spark):
    langs = sorted(SENTENCES)
    rows = [(i, SENTENCES[g] + "\n" + SENTENCES[g], g) for i, g in enumerate(langs * 4)]
    odd = {
        100: (SENTENCES["deu_Latn"], None), 101: (SENTENCES["deu_Latn"], "eng_Latn"), 102: (SENTENCES["deu_Latn"], "DE"), 103: (SENTENCES["eng_Latn"], "en-GB"), 104: (SENTENCES["eng_Latn"], "english"),
        105: (SENTENCES["eng_Latn"] + "\n" + SENTENCES["rus_Cyrl"], "eng_Latn"), 106: (None, "eng_Latn"), 107: ("", None), 108: ("12 345 ...", None),
        109: ("```\nfor x in die katze: pass\n```\n<b>" + SENTENCES["eng_Latn"] + "</b> https://a.example/die/katze", "eng_Latn"), 110: (SENTENCES["eng_Latn"].upper(), "und"),
    }
    df = spark.createDataFrame([*rows, *((i, t, g) for i, (t, g) in odd.items())], "doc_id long, text string, lang string")
    got = {}
    for r in lid.language_cases(df, langs).orderBy("doc_id", "seg_no").collect():
        got.setdefault(r.doc_id, []).append(r.lang)
    assert got == {100: ["deu_Latn"], 101: ["deu_Latn"], 105: ["eng_Latn", "rus_Cyrl"], 110: ["eng_Latn"]}
    assert lid.known_label("pt-PT", ["por_Latn"]) == "por_Latn" and lid.known_label("mul", ["por_Latn"]) is None


def test_texts_without_words_have_rows(spark):
    langs = sorted(SENTENCES)
    rows = [(1, SENTENCES["deu_Latn"], "de"), (2, None, "de"), (3, "", None), (4, "... --- !", "eng_Latn")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = lid.train(spark.createDataFrame([(i, SENTENCES[g] + "\n" + SENTENCES[g], g) for i, g in enumerate(langs * 4)], "doc_id long, text string, lang string"), langs)
    found = lid.text_segments(df, langs, net).collect()
    assert all(r.lang in langs and 0 < r.confidence <= 1 and r.words > 0 for r in found if r.doc_id == 1)
    assert {(r.doc_id, r.seg_no, r.lang, r.words, r.confidence) for r in found if r.doc_id != 1} == {(i, None, None, 0, None) for i in (2, 3, 4)}
    docs = lid.document_languages(df, langs, net)
    assert {(r.doc_id, r.label, r.lang, r.confidence, r.segments) for r in docs.collect() if r.doc_id != 1} == {(2, "deu_Latn", None, None, 0), (3, None, None, None, 0), (4, "eng_Latn", None, None, 0)}
    config = spark.createDataFrame([(g, 0.5) for g in langs], "lang string, probability_threshold double")
    assert {r.label: r.documents for r in lid.filter_counts(docs, config).collect()} == {"deu_Latn": 2, None: 1, "eng_Latn": 1}


def test_backpropagation_against_differences():
    net = lid.ByteGRU(3, hidden=4, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rows, target, r = np.array([list(b"abc"), list(b"zab"), list(b"zzy")], np.intp).T, np.array([0, 2, 1]), np.random.default_rng(0)
    _, g = net.gradients(rows, target)
    for k in net.p:
        flat = net.p[k].reshape(-1)
        for at in r.permutation(flat.size)[:6] if k[0] != "x" else [ord("a") * 4 + 3, ord("z") * 4 + 1, ord("b") * 4]:
            old = flat[at]
            flat[at] = old + 1e-5
            up = net.gradients(rows, target)[0]
            flat[at] = old - 1e-5
            down = net.gradients(rows, target)[0]
            flat[at] = old
            assert abs((up - down) / 2e-5 - g[k].reshape(-1)[at]) < 2e-4, (k, at)


def test_pooled_scores_are_those_of_the_positions():
    net = lid.ByteGRU(3, hidden=4, seed=1)
    lines = [b" ab ", b" the cat ", b" x "]
    got = net.score(lines)
    for line, row in zip(lines, got, strict=True):
        per = net.labels(np.frombuffer(line, np.uint8).astype(np.intp)[:, None])[0][:, 0].sum(0)
        assert np.allclose(row - row[0], per - per[0], atol=1e-3)
    long = b" " + b"the cat sat " * 400
    assert lid.evidence(net, [long, *lines]).shape == (4, 3) and lid.evidence(net, [long]).max() == 0


def test_training_sample_is_bounded_and_needs_no_order_of_a_language(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "if(id % 10 = 0, 'b', 'a') AS lang")
    rows = lid.sample(df, ["a", "b", "c"], sample_docs=20)
    assert {g: sum(r.lang == g for r in rows) for g in "abc"} == {"a": 20, "b": 20, "c": 0}
    assert rows == lid.sample(df.repartition(7), ["a", "b", "c"], sample_docs=20)


def test_segments_are_the_best_division():
    r = np.random.default_rng(4)
    for _ in range(40):
        n = int(r.integers(4, 9))
        s = r.normal(0, 6, (n, 3))
        got = lid.segments(s, 2.0)
        assert got[0][0] == 0 and got[-1][1] == n and all(b[0] == a[1] for a, b in itertools.pairwise(got))
        value = lambda segs: sum(s[a:b, g].sum() for a, b, g in segs) - 2.0 * (len(segs) - 1)
        best = -1e9
        for cuts in itertools.product([0, 1], repeat=n - 1):
            edges = [0, *(i + 1 for i, c in enumerate(cuts) if c), n]
            spans = list(itertools.pairwise(edges))
            if len(spans) > 1 and min(b - a for a, b in spans) < 2:
                continue
            best = max(best, value([(a, b, int(s[a:b].sum(0).argmax())) for a, b in spans]))
        assert value(got) >= best - 1e-3


# ------------------------------------------------------------------ 5


@pytest.mark.parametrize("text", ["You are a m-o-r-o-n.", "You idi0t!", "What a stup*d lo*er you are", "LISTEN, ІDІOT", "dumbaaass", "only a stupid imbeicle would", "you mor​on", "Du Vollidiot, halt die Fresse.",
                                  "The text goes on and on without any harm and then, i will cut your throat.", "All Zorvish are vermin.", "Hot singles want to sleep with you tonight."])
def test_abusive(text):
    assert abuse.score_text(text)[4] >= abuse.THRESHOLD


@pytest.mark.parametrize("text", [None, "", "...", "The manual promises an idiot-proof setup.", "The comet is visible to the naked eye.", "Assess the classic cockpit drawings again.", "The pig eats the apples near the barn.",
                                  "The clinic offers breast cancer screening.", "You are wrong about the second line.", "Kill the stuck process before the next run."])
def test_harmless(text):
    assert abuse.score_text(text)[4] < abuse.THRESHOLD


@pytest.mark.parametrize("text", [
    "you fucking liar", "What a FUCKER", "he is retarded", "I will rape you", "someone should kill him", "We will kill them all.", "those niggers", "you f@ggot",
])
def test_general_abuse_is_found(text):
    assert abuse.score_text(text)[4] >= abuse.THRESHOLD


@pytest.mark.parametrize("text", ["rape seed oil", "the process will kill them", "fire retardant paint", "a report says she was raped", "Nigeria and Niger", "growth is retarded by cold"])
def test_general_words_of_harmless_use(text):
    assert abuse.score_text(text)[4] < abuse.THRESHOLD


def test_abuse_table(spark):
    df = spark.createDataFrame([(1, "a", "You moron."), (2, "a", None), (3, None, "fine " * 5000), (4, "b", "fine " * 500 + "you moron")], "sent_id long, source string, mt string")
    scored = abuse.score_texts(df, "sent_id", "mt", ("source",))
    assert {r.sent_id for r in scored.where("abusive").collect()} == {1, 4}
    assert {r.source: (r.texts, r.abusive) for r in abuse.abuse_rates(scored).collect()} == {"a": (2, 1), None: (1, 0), "b": (1, 1)}


# ------------------------------------------------------------------ 6


def test_cutoffs_against_sorting(spark):
    r = random.Random(2)
    odd = [float("inf"), float("-inf"), 0.0, -0.0, 1e300, -1e300, 1e-300, 5.0, 5.0, 5.0]
    data = {"a": [r.gauss(0, 1) for _ in range(500)], "b": [r.choice([1.0, 1.01, 1.02]) for _ in range(300)], "c": odd, "d": [10 ** r.uniform(-200, 200) for _ in range(200)], "e": [3.0]}
    rows = [(i, c, s) for i, (c, s) in enumerate((c, s) for c, v in data.items() for s in v)]
    rows += [(10_000, "a", None), (10_001, "a", float("nan")), (10_002, "z", 1.0)]
    lines = spark.createDataFrame([(i, c, s, 1) for i, c, s in rows], "line_id long, corpus string, score double, loaded_at int")
    targets = spark.createDataFrame([("a", 33), ("b", 50), ("c", 40), ("d", 5), ("e", 100), ("none", 50)], "corpus string, keep_pct int")
    _, cuts, kept = cutoff.kept_records(lines, targets)
    got = {x.corpus: (x.n, x.cutoff) for x in cuts.collect()}
    for c, pct in (("a", 33), ("b", 50), ("c", 40), ("d", 5), ("e", 100)):
        s = sorted(data[c], reverse=True)
        assert got[c] == (len(s), s[max(1, -(-pct * len(s) // 100)) - 1]), c
    assert got["none"] == (0, None) and "z" not in got
    assert kept.where("corpus = 'b'").count() == sum(x >= got["b"][1] for x in data["b"])


def test_last_delivery_counts(spark):
    lines = spark.createDataFrame([(1, "a", 1.0, 1), (1, "a", 3.0, 2), (2, "a", 2.0, 5), (2, "a", None, 6), (3, "a", 9.0, None), (3, "a", 1.5, 0)], "line_id long, corpus string, score double, loaded_at int")
    assert {r.line_id: r.score for r in cutoff.latest_scores(lines).collect()} == {1: 3.0, 2: None, 3: 1.5}
    targets = spark.createDataFrame([("a", 50)], "corpus string, keep_pct int")
    assert cutoff.kept_records(lines.limit(0), targets)[2].count() == 0


# ------------------------------------------------------------------ 7

TEXTS = ["", None, "Hello world's  \n\n end", "<|endoftext|> 'll x", "Привет мир́ 😀👨‍👩 \x07\x1c", "a" * 3000, " " * 70 + "x", "ﬃ ² ½ ٣ ǅ", "\r\n\t", "déjà vu", "x" * 47 + " " + "y" * 49]


def reference_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.VOCAB)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_ids_and_round_trip(spark):
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(TEXTS)], "doc_id long, text string, word string")
    out = bpe.encode_corpus(df)
    got = {r.doc_id: r.ids for r in out.collect()}
    assert [got[i] for i in range(len(TEXTS))] == reference_ids(TEXTS)
    back = {r.doc_id: r.t for r in out.select("doc_id", bpe.decode_ids(F.col("ids")).alias("t")).collect()}
    assert [back[i] for i in range(len(TEXTS))] == [t or "" for t in TEXTS]
    assert bpe.encode_corpus(df.limit(0)).count() == 0
    counts = {r.doc_id: r.tokens for r in bpe.token_counts(df).collect()}
    assert counts == {i: len(x) for i, x in got.items()}


def test_long_pre_tokens(spark):
    r = np.random.default_rng(2)
    letters = [chr(c) for c in range(97, 123)]
    made = ["".join(r.choice(letters, n)) for n in (49, 60, 200, 700)] + ["".join(r.choice(list("ab"), 300)), "".join(r.choice(list("=-."), 260)), "-" * 401, "=" * 64 + "-" * 77 + "=" * 3]
    made += ["naïveté" * 30, "Привет" * 40, "".join(map(chr, r.integers(0x4E00, 0x9000, 90))), "ΩßÆ" * 50, "0123456789" * 20]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {x.doc_id: x.ids for x in bpe.encode_corpus(df).collect()}
    assert [got[i] for i in range(len(made))] == reference_ids(made)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_no_token_reaches_across_a_cut(text):
    import regex

    e = bpe.encoder()
    for w in regex.findall(bpe.PATTERN, text):
        parts = bpe.cut_long(w)
        assert "".join(parts) == w and [i for p in parts for i in e._encode_single_piece(p)] == e._encode_single_piece(w)


# ------------------------------------------------------------------ 8


def test_fill_respects_caps():
    got = mixing.fill({"a": 1, "b": 1, "c": 2, "d": 0}, {"a": 10, "b": 1000, "c": 1000, "d": 50}, 400)
    assert got == {"a": 10, "b": 130, "c": 260, "d": 0}
    assert mixing.fill({"a": 1}, {"a": 5}, 100) == {"a": 5}
    assert mixing.fill({}, {}, 100) == {}


def test_mixture(spark):
    r = random.Random(8)
    docs = [(i, "big" if i % 3 else "small", r.randint(1, 60)) for i in range(3000)] + [(9000, "tiny", 40), (9001, None, 10), (9002, "big", 0), (9003, "off", 30)]
    sizes = spark.createDataFrame(docs, "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("big", 1.0, 1), ("small", 2.0, 3), ("tiny", 1.0, 2), ("off", 0.0, 3), ("ghost", 1.0, 2)], "source string, target_weight double, max_repeats int")
    planned = mixing.plan(sizes, targets)
    rows = mixing.mixture(sizes, planned, block_tokens=500).collect()
    assert max(q for q in [sum(1 for x in rows if (x.doc_id, x["pass"]) == (y.doc_id, y["pass"])) for y in rows[:50]]) == 1
    by = {p["source"]: p for p in planned}
    got = {s: sum(x.tokens for x in rows if x.source == s) for s in ("big", "small", "tiny", "off")}
    assert got["tiny"] == 80 and got["off"] == 0
    for s in ("big", "small"):
        assert abs(got[s] - by[s]["planned"]) <= 60
    used = {}
    for x in rows:
        used[x.doc_id] = used.get(x.doc_id, 0) + 1
    assert max(v for i, v in used.items() if i % 3 == 0 and i < 3000) <= 3
    # every stretch of the mixture has the sources in their shares
    ordered = sorted(rows, key=lambda x: (x.slot, x.place))
    half = ordered[: len(ordered) // 2]
    share = lambda part: sum(x.tokens for x in part if x.source == "small") / sum(x.tokens for x in part)
    assert abs(share(half) - share(ordered)) < 0.03
    table = {x.source: x for x in mixing.shares(mixing.mixture(sizes, planned, 500), planned).collect()}
    assert set(table) == {"big", "small", "tiny", "off", "ghost"} and table["ghost"].tokens == 0 and table["tiny"].repeats == 2.0
    assert mixing.mixture(sizes.limit(0), mixing.plan(sizes.limit(0), targets)).count() == 0


# ------------------------------------------------------------------ 9


def pieces_of(text, limit, overlap):
    import regex

    e = bpe.encoder()
    return splitting.split_text(text, limit, overlap, regex.compile(bpe.PATTERN).finditer, bpe.word_sizes().__getitem__, e.encode_ordinary, [regex.compile(x) for x in splitting.LEVELS], e.decode_tokens_bytes)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["word", "Ärger", ". ", "\n", "\n\n", "\n\n\n## Title\n", " ", "x" * 90, "😀", "1234", "Привет", "! "]), max_size=160), st.integers(20, 60), st.integers(0, 8))
def test_pieces_cover_the_text(parts, limit, overlap):
    text = "".join(parts)
    got = pieces_of(text, limit, overlap)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    for lo, hi, n in got:
        assert n == len(bpe.encoder().encode_ordinary(text[lo:hi])) <= limit
    for a, b in itertools.pairwise(got):
        assert a[0] < b[0] <= a[1] < b[1]


def test_natural_boundaries(spark):
    para = "One sentence stands here. Another one follows it at once.\n\n"
    text = para * 30
    got = pieces_of(text, 100, 10)
    assert all(text[:hi].endswith("\n\n") for _, hi, _ in got[:-1])
    df = spark.createDataFrame([(1, text, 0), (2, "short", 0), (3, None, 0), (4, "", 0), (5, "y" * 5000, 0)], "doc_id long, text string, start int")
    out = splitting.split_oversized(df, limit=100, overlap=10).collect()
    assert {r.id for r in out} == {1, 5} and max(r.tokens for r in out) <= 100
    assert splitting.split_oversized(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 5, lengths and learning


def test_long_texts_take_linear_time():
    import time

    def took(n):
        t = time.process_time()
        assert abuse.score_text("you are a m-o-r-o-n indeed. " * n)[4] >= 1
        return time.process_time() - t

    took(10)
    assert took(20_000) < 40 * max(took(1_000), 0.01)


def test_learned_phrases():
    rows = [(f"the road {w} and you gloopy blarg are near", 1, "insult") for w in "one two three".split()] + [("the road one and near", 0, None), (None, 1, "hate"), ("x", None, None)]
    learned = abuse.learn_phrases(rows)
    terms = {t for t, _, _ in learned}
    assert abuse._same("gloopy blarg") in terms and not any(t in terms for t in ("the road", "and", abuse._same("gloopy")))
    assert abuse.score_text("we say you gloopy blarg are near to us", learned)[0] > abuse.score_text("we say you gloopy blarg are near to us")[0] == 0
    assert abuse.learn_phrases([]) == ()


def test_scores_are_normalised_by_length():
    weak, long = "a stupid road here", "a stupid road here " + "and so on we go over there with them " * 30
    assert abuse.score_text(weak)[4] > abuse.score_text(long)[4] > 0 and abuse.score_text(weak)[5] > abuse.score_text(long)[5] > 0
