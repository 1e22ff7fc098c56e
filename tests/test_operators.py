import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.functions import vector as V
from loomline.operators import analytics as A
from loomline.operators import dedup as D
from loomline.operators import evaluation as E
from loomline.operators import mining as M
from loomline.operators import sampling as S
from loomline.operators import segments as G

# distances and ids of two nearest lists in each direction, four vectors a side
X2Y = ([[0.1, 0.5], [0.4, 0.45], [0.2, 0.9], [0.3, 0.35]], [[3, 0], [1, 2], [0, 1], [2, 3]])
Y2X = ([[0.25, 0.6], [0.15, 0.8], [0.3, 0.7], [0.05, 0.55]], [[2, 0], [1, 3], [3, 1], [0, 3]])


@pytest.fixture(scope="module")
def neighbors(spark):
    rows = [(10 + i, "x2y", r, 20 + t, float(d)) for i, (ds, ts) in enumerate(zip(*X2Y, strict=True)) for r, (d, t) in enumerate(zip(ds, ts, strict=True))]
    rows += [(20 + i, "y2x", r, 10 + t, float(d)) for i, (ds, ts) in enumerate(zip(*Y2X, strict=True)) for r, (d, t) in enumerate(zip(ds, ts, strict=True))]
    return spark.createDataFrame(rows, "src_id long, direction string, rank int, tgt_id long, dist double")


def model_margins(own, other):
    """Similarity 2 - d of a pair over the mean similarity of both sides' lists, one line after the other."""
    mean = lambda ds: sum(2 - d for d in ds) / len(ds)
    return {(i, t): (2 - d) / ((mean(own[0][i]) + mean(other[0][t])) / 2) for i in range(4) for d, t in zip(own[0][i], own[1][i], strict=True)}


def model_mined(threshold, k, kind):
    def best(own, other):
        m = model_margins(own, other)
        out = []
        for i in range(4):
            top = sorted(((v, t) for (j, t), v in m.items() if i == j), reverse=True)[:k]
            out += [(v, i, t) for v, t in top if v >= threshold]
        return out

    f, g = best(X2Y, Y2X), [(v, t, i) for v, i, t in best(Y2X, X2Y)]
    both = {x[1:] for x in f} & {x[1:] for x in g}
    return {"forward": f, "backward": g, "union": f + g, "intersection": [x for x in f if x[1:] in both]}[kind]


def mined(df):
    return sorted((r.x_id - 10, r.y_id - 20) for r in df.collect())


def test_margins(neighbors):
    got = {(r.src_id - 10, r.tgt_id - 20): r.margin for r in M.margins(neighbors).where("direction = 'x2y'").collect()}
    want = model_margins(X2Y, Y2X)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-7 for k in want)


@pytest.mark.parametrize("kind", ["forward", "backward", "union", "intersection"])
@pytest.mark.parametrize("k", [1, 2])
def test_mining(neighbors, kind, k):
    for threshold in (0.9, 1.05):
        assert mined(M.mine(neighbors, threshold, k_extract=k, mine_type=kind)) == sorted(x[1:] for x in model_mined(threshold, k, kind))


def test_neighbor_search(spark):
    r = np.random.default_rng(0)
    centres = r.standard_normal((20, 16))
    x = (centres[r.integers(0, 20, 600)] + 0.25 * r.standard_normal((600, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<float>")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    sim = u @ u.T
    np.fill_diagonal(sim, -2)
    want = {(q, int(t)) for q in range(0, 600, 20) for t in np.argsort(-sim[q])[:4]}
    q = df.where("id % 20 = 0")
    assert {(r.q_id, r.x_id) for r in M.exact_neighbors(q, df, 16, 4, block_rows=100).collect()} == want
    near = {(r.q_id, r.x_id) for r in M.cell_neighbors(q, df, 16, 4, cells=12, probes=5, part_rows=50).collect()}
    assert len(near & want) / len(want) >= 0.9
    assert M.exact_neighbors(q.limit(0), df, 16, 4).count() == 0


def test_merge_sorted(spark):
    rows = [(9.0, "a", "b"), (7.0, "c", "d"), (6.0, "c", "d"), (4.0, "e", "f"), (9.0, "a", "b"), (9.0, "a", "b"), (8.0, "c", "d"), (5.0, "c", "d"), (4.0, "e", "g"), (4.0, "h", "g")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "score double, src string, tgt string, id long")
    got = [(r.score, r.src, r.tgt) for r in M.merge_sorted(df, "src", "tgt", "score", "id").collect()]
    assert got == [(9.0, "a", "b"), (8.0, "c", "d"), (4.0, "e", "f"), (4.0, "e", "g"), (4.0, "h", "g")]


def held_out_model(train, evals, mode):
    """One line after the other, with sets of what was seen."""
    seen = {"p": set(), "a": set(), "b": set()}
    out = []
    for a, b in evals:
        seen["p"].add((a, b)), seen["a"].add(a), seen["b"].add(b)
    for i, (a, b) in enumerate(train):
        if not a or not b:
            continue
        new = {"p": (a, b) not in seen["p"], "a": a not in seen["a"], "b": b not in seen["b"]}
        if new["p"] and (mode not in ("src", "both") or new["a"]) and (mode not in ("tgt", "both") or new["b"]):
            out.append(i)
        seen["p"].add((a, b)), seen["a"].add(a), seen["b"].add(b)
    return out


@pytest.mark.parametrize("mode", ["both", "src", "tgt", "neither"])
def test_held_out(spark, mode):
    r = random.Random(mode)
    word = lambda k: r.choice(["", *"abcdef"[:k]])
    train = [(word(6), word(6)) for _ in range(60)]
    evals = [("a", "b"), ("", "c")]
    t = spark.createDataFrame([(i, a, b, "x") for i, (a, b) in enumerate(train)], "line_id long, src string, tgt string, scope string")
    e = spark.createDataFrame([(i, a, b, "x") for i, (a, b) in enumerate(evals)], "line_id long, src string, tgt string, scope string")
    got = sorted(x.id for x in D.held_out(t, e, "src", "tgt", lambda c: c, mode, scope=("scope",)).collect())
    assert got == held_out_model(train, [p for p in evals if all(p)], mode)


def test_near_duplicates_last_one_stays(spark):
    base = "the quick brown fox jumps over the lazy dog and runs away from the old grey wolf"
    rows = [(1, base), (2, base + "."), (3, "something else entirely, with other words in it"), (4, base), (5, None), (6, ""), (7, "")]
    df = spark.createDataFrame(rows, "id long, t string")
    got = {r.id: (r.class_id, r.dropped) for r in D.near_duplicates(df, "id", F.col("t"), perms=60, bands=20, rows=3).collect()}
    assert got[1] == (4, True) and got[4] == (4, False) and got[2] == (4, True)
    assert got[3] == (3, False) and got[5] == (5, False) and got[6] == (6, False) and got[7] == (7, False)
    assert D.near_duplicates(df.limit(0), "id", F.col("t")).count() == 0


def test_near_duplicates_keep_links_of_all_buckets(spark):
    one, two = "the quick brown fox jumps over the lazy dog", "zwölf Boxkämpfer jagen Viktor quer durch Sylt"
    df = spark.createDataFrame([(1, f"{one} {two}"), (2, one), (3, two), (4, "0123456789" * 3), (5, one)], "id long, t string")
    got = {r.id: (r.class_id, r.dropped) for r in D.near_duplicates(df, "id", F.col("t"), perms=60, bands=60, rows=1).collect()}
    # 5 and 3 meet only through 1: one class, and neither is dropped for the other
    assert got == {1: (5, True), 2: (5, True), 3: (5, False), 4: (4, False), 5: (5, False)}


def test_components_of_chains(spark):
    order = [7, 1, 9, 3, 12, 2, 8, 5, 11, 4, 10, 6]
    edges = [(min(p), max(p)) for p in [*zip(order, order[1:]), (20, 21), (20, 22)]]
    got = {tuple(r) for r in D.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 12) for i in range(1, 12)} | {(20, 22), (21, 22)}
    assert D.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_caps_and_firsts(spark):
    df = spark.createDataFrame([(3, "a", 1.0), (1, "a", None), (2, "a", 5.0), (4, None, 1.0), (5, None, 2.0)], "id long, k string, v double")
    assert sorted(r.id for r in D.first_of(df, ["k"], "id").collect()) == [1, 4]
    assert sorted(r.id for r in D.at_most(df, ["k"], "id", 2).collect()) == [1, 2, 4, 5]
    assert sorted(r.id for r in D.best_of(df, ["k"], "v", "id").collect()) == [2, 5]


def test_overlap(spark):
    one = lambda *a, m="fraction": spark.range(1).select(V.overlap(*(F.lit(float(x)) for x in a), m)).first()[0]
    assert one(0, 10, 1, 15, 25, 1) == 0
    assert abs(one(0, 10, 1, 5, 17, 1) - 5 / 12) < 1e-12
    assert abs(one(0, 10, 1, 5, 17, 1, m="iou") - 5 / 17) < 1e-12


def test_drop_overlaps(spark):
    rows = [(0, "p", 5, 10, 1, 1.1), (1, "p", 6, 10, 1, 1.2), (2, "p", 6, 11, 1, 1.1), (3, "q", 0, 5, 1, 1.0), (4, "q", 5, 9, 1, 1.0), (5, None, 5, 9, 1, 1.0), (6, "q", None, 9, 1, 1.0)]
    df = spark.createDataFrame(rows, "id long, path string, s long, e long, f long, score double")
    assert sorted(r.id for r in G.drop_overlaps(df, "path", "s", "e", "f", "score", "id", most=0.1).collect()) == [1, 3, 4]


def test_segment_parsing(spark):
    texts = ["path 10 15 20 30 40", "path 10 15", "path 10|15 20", "path start 10 15", "path|10|15", "path|10|15|16", "path 10 15 x", None, ""]
    got = [r.s for r in spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, i int").orderBy("i").select(V.parse_segment(F.col("t")).alias("s")).collect()]
    assert [g.kind for g in got] == ["text"] * 5 + ["audio", "audio", "text", "text"]
    assert (got[5].start, got[5].end, got[5].factor, got[6].factor) == (10, 15, 16, 16)
    with_factor = spark.createDataFrame([("path|10|15",)], "t string").select(V.parse_segment(F.col("t"), 8).alias("s")).first().s
    assert (with_factor.kind, with_factor.factor) == ("audio", 8)


def test_duration_batches(spark):
    df = spark.createDataFrame([(0, i, d) for i, d in enumerate([4.0, 4.0, 4.0, 20.0, 1.0])], "lane int, i int, d double")
    assert [r.batch for r in G.duration_batches(df, "lane", "i", "d", 10.0).orderBy("i").collect()] == [0, 0, 1, 2, 3]


def test_sampling(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3).cast("string").alias("g"))
    assert {r.g: r["count"] for r in S.sample_per_group(df, "g", "id", 7).groupBy("g").count().collect()} == {"0": 7, "1": 7, "2": 7}
    sharded = S.shard_with_replacement(df, "id", "id", 5, 2.25)
    per = Counter(Counter(r.id for r in sharded.collect()).values())
    assert per == {3: 500, 2: 1500}
    quota = S.temperature_quota(spark.createDataFrame([("a", 900), ("b", 100)], "g string, n long"), "g", "n", 100, 1.0)
    assert {r.g: r.quota for r in quota.collect()} == {"a": 90, "b": 10}


def test_gini_and_rates(spark):
    df = spark.createDataFrame([("g", "a"), ("g", "a"), ("g", "b"), ("h", None), ("h", "a")], "g string, c string")
    got = {r.g: r.gini for r in A.gini_impurity(df, ["g"], "c").collect()}
    assert abs(got["g"] - 4 / 9) < 1e-12 and got["h"] is None
    p = spark.range(1).select(A.upper_p(F.lit(1.6448536))).first()[0]
    assert abs(p - 0.05) < 1e-5


def test_auc_against_pairs(spark):
    r = random.Random(1)
    rows = [(r.choice([0.1, 0.2, 0.3, 0.4]), int(r.random() < 0.5)) for _ in range(80)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(A.roc_auc(spark.createDataFrame(rows, "s double, y int"), "s", "y").first().auc - want) < 1e-12


def test_bleu(spark):
    df = spark.createDataFrame([("g", 1, "the cat sat on the mat today", "the cat sat on the mat today"), ("h", 1, "a b c d e", "a b c d f")], "g string, i long, h string, r string")
    got = {r.g: r.bleu for r in E.bleu(df, "g", "i", "h", "r").collect()}
    assert abs(got["g"] - 100) < 1e-9
    assert abs(got["h"] - 100 * math.exp(sum(math.log(x) for x in (4 / 5, 3 / 4, 2 / 3, 1 / 2)) / 4)) < 1e-9


def test_contribution_metrics(spark):
    m = np.array([[0.3, 0.2, 0.1, 0.4], [0.1, 0.005, 0.2, 0.695]])
    got = spark.createDataFrame([(m.tolist(), 3)], "m array<array<double>>, n int").select(E.contribution_metrics(F.col("m"), F.col("n")).alias("c"), E.matrix_links(F.col("m")).alias("l")).first()
    sc = m[:, :3]
    t, s = sc.sum(1), sc.sum(0)
    assert abs(got.c.avg_sc - t.mean()) < 1e-12 and abs(got.c.min_sc - t.min()) < 1e-12
    assert got.c.sc_above_50 == (t >= 0.5).mean() and got.c.sc_above_30 == (t >= 0.3).mean()
    assert abs(got.c.sc_share_wo_eos - (1 - sc[:, -1].sum() / sc.sum())) < 1e-12
    assert abs(got.c.sc_entropy - (-(t / t.sum()) * np.log(t / t.sum())).sum()) < 1e-12
    assert abs(got.c.src_sum_contr_min - s.min()) < 1e-12
    assert {(x.tgt, x.src) for x in got.l} == {(int(i), int(j)) for i, j in zip(*np.where(m > 0.08))}


def test_mlp(spark):
    r = np.random.default_rng(0)
    layers = [(r.standard_normal((4, 3)), r.standard_normal(3)), (r.standard_normal((3, 1)), r.standard_normal(1))]
    x = r.standard_normal((5, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    got = [q.score for q in E.mlp_scores(df, "id", "x", layers).orderBy("id").collect()]
    assert np.allclose(got, (np.tanh(x @ layers[0][0] + layers[0][1]) @ layers[1][0] + layers[1][1])[:, 0])


def test_vector_features(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>")
    got = df.select(V.l2_normalize(F.col("a")).alias("u"), V.l2_normalize(F.col("z")).alias("z"), V.cosine(F.col("a"), F.col("z")).alias("c"), V.comparison_features(F.col("a"), F.col("a"), F.col("z")).alias("f")).first()
    assert got.u == [0.6, 0.8] and got.z == [0.0, 0.0] and got.c is None and len(got.f) == 12
