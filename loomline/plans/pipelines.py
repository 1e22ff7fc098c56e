"""Whole pipelines: plain functions that chain the operators into one plan each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions import text as T
from loomline.operators import dedup as D
from loomline.operators import filters as FI
from loomline.operators import language as L
from loomline.operators import mining as M
from loomline.operators import sampling as S
from loomline.operators.analytics import with_totals
from loomline.session import written

def monolingual(docs: DataFrame, text: str = "text", lang: str = "lang", langs: list[str] | None = None, thresholds: dict[str, float] | None = None, script_min: float = 0.5, lid_min: float = 0.5) -> DataFrame:
    """(doc_id, n, outcome, clean) of every sentence: split, clean (with Unicode's compatibility forms), filter, script, language; kept
    sentences once per text. Languages are told by naive Bayes over words, fitted on the labels of all documents; langs: those to tell
    apart, by default all labels of the form eng_Latn."""
    langs = langs or sorted(r[0] for r in docs.select(lang).where(F.col(lang).rlike("^[a-z]{3}_[A-Z][a-z]{3}$")).distinct().limit(1_000).collect())
    model = written(L.fit_languages(docs, text, lang, langs), "language-model")
    x = docs.select("doc_id", F.col(lang).alias("lang"), F.posexplode(T.sentences(F.col(text))).alias("n", "raw"))
    clean = T.replace_non_printing(T.normalize_whitespace(T.replace_unicode_punct(F.col("raw"))))
    # a stage of its own: inlined, the cleaning would run again for every measure of the sentence
    x = written(x.select("doc_id", "lang", "n", T.nfkc()(clean).alias("clean")), "sentences")
    told = L.language_scores(x.select(F.struct("doc_id", "n").alias("k"), "clean"), "k", "clean", model, langs).select("k.doc_id", "k.n", L.pick_language(F.col("probs")).alias("top"))
    x = x.join(told, ["doc_id", "n"], "left").withColumn("script", T.predict_script(T.script_counts(F.col("clean"))))
    limits = F.coalesce(F.try_element_at(F.create_map(*(F.lit(v) for kv in thresholds.items() for v in kv)), F.col("top")["lang"]), F.lit(lid_min)) if thresholds else F.lit(lid_min)
    out = FI.line_outcome(F.col("clean"), F.element_at(F.split("lang", "_"), -1), F.col("script"), F.col("lang"), F.col("top")["lang"], F.coalesce(F.col("top")["p"], F.lit(0.0)), script_min, limits)
    x = written(x.select("doc_id", "n", out.alias("outcome"), "clean"), "monolingual")  # read for the kept and for the rest
    kept = D.sort_unique(x.where("outcome = 'kept'"), "clean", ["doc_id", "n"])
    return kept.unionByName(x.where("outcome <> 'kept' OR outcome IS NULL"))


def bitext_filtering(lines: DataFrame, model: DataFrame | None = None, langs: list[str] | None = None, lid_min: float = 0.1, words: tuple[list[str], list[str]] | None = None, fuzzy: bool = False) -> DataFrame:
    """(corpus, line_id, src, tgt) that pass the filter chain, once per normalised pair and corpus.

    Stages: score, lengths, symbols; with a language model (fit_languages) the languages of both sides against lang_dir, sides of known
    words only; with word lists the toxicity of one side against the other; exact pairs; with fuzzy near copies of a pair, of which
    the last stays."""
    rules = [FI.score_rule("score"), *FI.LengthRule(min_len=5).rules("src", "tgt"), *FI.symbol_rules("src", "tgt", keep_numbers=True)]
    rules += FI.toxicity_rules("src", "tgt", *words) if words else []
    n = lambda c: T.normalize_for_dedup(T.normalize_line(F.col(c)))
    kept = FI.chain(lines.select("corpus", "line_id", "lang_dir", "score", "src", "tgt").distinct(), rules).where("drop_reason IS NULL").drop("drop_reason", "score")
    if model is not None:
        kept = written(kept, "filtered-pairs")
        for i, c in enumerate(("src", "tgt")):
            probs = L.language_scores(kept.select(F.struct("line_id", c).alias("k"), F.col(c).alias("t")).distinct(), "k", "t", model, langs).select(F.col("k.line_id").alias("line_id"), F.col(f"k.{c}").alias(c), "probs")
            told = kept.join(probs, ["line_id", c], "left")
            kept = told.where(~L.language_drop(F.col("probs"), F.get(F.split("lang_dir", "-"), i), {}, lid_min)).drop("probs")
    keyed = kept.withColumn("k", F.md5(F.concat_ws("\t", n("src"), n("tgt"))))
    once = D.first_of(keyed.select("corpus", "line_id", "src", "tgt", "k"), ["corpus", "k"], "line_id").drop("k")
    if not fuzzy:
        return once
    once = written(once, "filtered-once")
    near = D.near_duplicates(once.groupBy("line_id").agg(F.min(F.struct("src", "tgt")).alias("x")), "line_id", F.concat_ws("\t", T.normalize_for_dedup(F.col("x.src")), T.normalize_for_dedup(F.col("x.tgt"))))
    return once.join(near.where("dropped").select(F.col("id").alias("line_id")), "line_id", "left_anti").select("corpus", "line_id", "src", "tgt")


def global_mining(neighbors: DataFrame, texts: DataFrame, threshold: float = 1.06) -> DataFrame:
    """Mined pairs with the place of both lines, best score first, each pair of places once."""
    pairs = M.mine(M.neighbor_rows(neighbors), threshold)
    placed = M.with_texts(pairs, texts, "vec_id", ["corpus", "line_no"])
    best = placed.groupBy("x_corpus", "x_line_no", "y_corpus", "y_line_no").agg(F.max("score").alias("score"))
    return best.orderBy(F.desc("score"), "x_corpus", "x_line_no", "y_corpus", "y_line_no")


def mine_texts(x: DataFrame, y: DataFrame, encode, dim: int, k: int = 4, threshold: float = 1.06, mine_type: str = "union") -> DataFrame:
    """(score, x_id, y_id, direction, x_text, y_text): pairs of lines mined from two sides (id, text) with ids of their own, from text to
    pairs: encode, index, nearest neighbours both ways, margins, mining. encode turns (id, text) into (id, embedding).
    Small sides are searched exactly, large ones by cells; lines without an embedding take no part."""
    def vectors(side: DataFrame, label: str) -> DataFrame:
        v = written(encode(side).select("id", F.col("embedding").alias("vec")), label)
        return v.where(F.exists("vec", lambda e: e != 0))

    vx, vy = vectors(x, "mine-x"), vectors(y, "mine-y")
    search = M.exact_neighbors if M.index_kind(max(vx.count(), vy.count())) == "exact" else M.cell_neighbors
    one = lambda q, i, way: search(q, i, dim, k).select(F.col("q_id").alias("src_id"), F.lit(way).alias("direction"), (F.col("rank") - 1).alias("rank"), F.col("x_id").alias("tgt_id"), (2 - 2 * F.col("cos")).alias("dist"))
    near = written(one(vx, vy, "x2y").unionByName(one(vy, vx, "y2x")), "mine-neighbors")
    pairs = M.mine(near, threshold, mine_type=mine_type)
    texts = x.select("id", "text").unionByName(y.select("id", "text"))
    return M.with_texts(pairs, texts, "id", ["text"])


def prepare_data(train: DataFrame, evals: DataFrame, mode: str = "both", smallest: int = 250, largest: int = 5_000) -> DataFrame:
    """(lang_dir, shard, id) of the training lines that repeat neither evaluation nor earlier lines, in as many shards
    as their direction needs."""
    norm = lambda c: T.normalize_for_dedup(T.normalize_whitespace(c))
    once = train.select("line_id", "lang_dir", "src", "tgt").distinct()
    kept = D.held_out(once, evals, "src", "tgt", norm, mode)
    per = kept.groupBy("lang_dir").agg(F.count(F.lit(1)).alias("n"))
    shards = with_totals(per, per.agg(F.sum("n").alias("n_all"))).select("lang_dir", S.shard_count(F.col("n"), F.col("n_all"), smallest, largest).cast("int").alias("shards"))
    return kept.join(shards, "lang_dir").select("lang_dir", S.md5_bucket(F.col("shards"), "id").alias("shard"), "id")
