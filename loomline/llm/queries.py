"""Queries of the nine problems and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.session import read_table as table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.canonical import duplicate_pairs

    return duplicate_pairs(table(spark, d, "mining_lines"), "line_id", "src", "tgt").select(F.col("keep_id").alias("keep_line_id"), F.col("id").alias("line_id"))


def p1_records(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.canonical import collapsed_records

    return collapsed_records(table(spark, d, "mining_lines"), "line_id", "src", "tgt").select(F.col("keep_id").alias("keep_line_id"), "copies")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.hilbert_knn import similar_pairs

    return similar_pairs(table(spark, d, "sent_vectors"), 0.85).select(F.col("id").alias("vec_id"), "neighbor_id")


def p2_neighbors(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.hilbert_knn import similar_vectors

    return similar_vectors(table(spark, d, "sent_vectors")).withColumnRenamed("id", "vec_id")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.overlap import near_lines

    pairs = near_lines(table(spark, d, "eval_lines"), table(spark, d, "train_lines"))
    return pairs.select(F.col("eval_id").alias("eval_line_id"), F.col("train_id").alias("train_line_id"))


def p3_rates(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.overlap import overlap_rates

    return overlap_rates(table(spark, d, "eval_lines"), table(spark, d, "train_lines"))


def _langs(spark: SparkSession, d: str) -> list[str]:
    """The languages of the fixed configuration table."""
    return sorted(r.lang for r in table(spark, d, "lid_config").select("lang").where("lang IS NOT NULL").distinct().collect())


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.lid import language_cases

    return language_cases(table(spark, d, "documents"), _langs(spark, d))


def p4_documents(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.lid import document_languages

    return document_languages(table(spark, d, "documents"), _langs(spark, d))


def p4_segments(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.lid import text_segments

    return text_segments(table(spark, d, "documents"), _langs(spark, d))


def p4_counts(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.lid import document_languages, filter_counts

    return filter_counts(document_languages(table(spark, d, "documents"), _langs(spark, d)), table(spark, d, "lid_config"))


def _p5_scored(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.abuse import latest, learned_from, score_texts

    own = latest(table(spark, d, "test_input_de"), "sent_id", "made_at", ["mt", "source"])
    return score_texts(own, "sent_id", "mt", ("source",), learned_from(table(spark, d, "tox_labels")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _p5_scored(spark, d).where("abusive").select("sent_id")


def p5_scores(spark: SparkSession, d: str) -> DataFrame:
    return _p5_scored(spark, d)


def p5_rates(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.abuse import abuse_rates

    return abuse_rates(_p5_scored(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.cutoff import kept_records

    return kept_records(table(spark, d, "mining_lines"), table(spark, d, "keep_targets"))[2].select("corpus", "line_id")


def p6_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.cutoff import cutoff_report

    return cutoff_report(table(spark, d, "mining_lines"), table(spark, d, "keep_targets"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.bpe import encode_corpus, session_vocab

    return encode_corpus(table(spark, d, "documents"), path=session_vocab(spark))


def p7_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Whether the ids of each document decode to its text (null and empty: to '')."""
    from loomline.llm.bpe import decode_ids, encode_corpus, session_vocab

    docs, vocab = table(spark, d, "documents"), session_vocab(spark)
    back = encode_corpus(docs, path=vocab).select("doc_id", F.coalesce(decode_ids(F.col("ids"), vocab), F.lit("")).alias("decoded"))
    return docs.select("doc_id", "text").join(back, "doc_id").select("doc_id", (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("same"))


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.bpe import token_counts
    from loomline.llm.mixing import mix

    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), token_counts)[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.bpe import token_counts
    from loomline.llm.mixing import mix, shares

    return shares(*mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), token_counts))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.splitting import split_oversized

    return split_oversized(table(spark, d, "documents")).where("piece_no = 1").select(F.col("id").alias("doc_id"))


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    from loomline.llm.splitting import split_oversized

    return split_oversized(table(spark, d, "documents")).withColumnRenamed("id", "doc_id")


def queries() -> dict:
    return {
        "p1_found": p1_found, "p1_records": p1_records, "p2_found": p2_found, "p2_neighbors": p2_neighbors,
        "p3_found": p3_found, "p3_rates": p3_rates, "p4_found": p4_found, "p4_documents": p4_documents, "p4_segments": p4_segments, "p4_counts": p4_counts, "p5_found": p5_found, "p5_scores": p5_scores, "p5_rates": p5_rates, "p6_found": p6_found, "p6_cutoffs": p6_cutoffs,
        "p7_ids": p7_ids, "p7_round_trip": p7_round_trip, "p8_mixture": p8_mixture, "p8_shares": p8_shares, "p9_found": p9_found, "p9_pieces": p9_pieces,
    }


_P1 = """
WITH s AS (
  SELECT line_id, trim(regexp_replace(lower(src), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS a,
         trim(regexp_replace(lower(tgt), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS b
  FROM mining_lines WHERE line_id IS NOT NULL AND src IS NOT NULL AND tgt IS NOT NULL),
r AS (SELECT DISTINCT line_id, least(a, b) AS x, greatest(a, b) AS y FROM s WHERE a <> '' AND b <> ''),
g AS (SELECT x, y, min(line_id) AS keep_line_id, count(*) AS copies FROM r GROUP BY x, y)
"""

_P2 = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM sent_vectors
           WHERE embedding IS NOT NULL AND len(embedding) = 128 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
c AS (SELECT a.vec_id, b.vec_id AS neighbor_id, round(list_cosine_similarity(a.e, b.e), 10) AS cos FROM v a JOIN v b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cos DESC, neighbor_id) AS rn FROM c)
"""

# Words of a pair of lines become single characters, so that levenshtein() counts words; a prefix filter comes first.
_P3 = """
WITH a AS (
  SELECT 0 AS split, line_id, unnest([{'lang': split_part(lang_dir, '-', 1), 't': src}, {'lang': split_part(lang_dir, '-', 2), 't': tgt}], recursive := true) FROM eval_lines
  UNION ALL
  SELECT 1, line_id, unnest([{'lang': split_part(lang_dir, '-', 1), 't': src}, {'lang': split_part(lang_dir, '-', 2), 't': tgt}], recursive := true) FROM train_lines),
c AS (SELECT DISTINCT split, line_id, lang, trim(regexp_replace(lower(t), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS t FROM a WHERE t IS NOT NULL AND lang IS NOT NULL AND line_id IS NOT NULL),
x AS (SELECT DISTINCT split, lang, t, string_split(t, ' ') AS w, list_distinct(string_split(t, ' ')) AS u FROM c WHERE t <> ''),
p AS (SELECT e.lang, e.t AS et, r.t AS tt, e.w AS ew, r.w AS tw, list_distinct(list_concat(e.u, r.u)) AS v, greatest(len(e.w), len(r.w)) // 5 AS most FROM x e JOIN x r
      ON e.split = 0 AND r.split = 1 AND e.lang = r.lang AND abs(len(e.w) - len(r.w)) <= greatest(len(e.w), len(r.w)) // 5
      WHERE len(list_intersect(e.u, r.u)) >= len(e.u) - greatest(len(e.w), len(r.w)) // 5),
n AS (SELECT lang, et, tt FROM p WHERE et = tt OR (most > 0 AND
      levenshtein(list_aggregate(list_transform(ew, lambda z: chr(33 + list_position(v, z)::INT)), 'string_agg', ''), list_aggregate(list_transform(tw, lambda z: chr(33 + list_position(v, z)::INT)), 'string_agg', '')) <= most)),
m AS (SELECT DISTINCT e.line_id AS eval_line_id, r.line_id AS train_line_id FROM n JOIN c e ON e.split = 0 AND e.lang = n.lang AND e.t = et JOIN c r ON r.split = 1 AND r.lang = n.lang AND r.t = tt)
"""

_P6 = """
WITH latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY loaded_at DESC NULLS LAST, score DESC NULLS LAST, corpus DESC) AS rn
                 FROM mining_lines WHERE line_id IS NOT NULL) WHERE rn = 1),
s AS (SELECT l.corpus, line_id, score, t.keep_pct, t.mine_threshold, t.bitext_threshold FROM latest l JOIN keep_targets t ON l.corpus = t.corpus
      WHERE score IS NOT NULL AND NOT isnan(score)),
k AS (SELECT *, count(*) OVER (PARTITION BY corpus) AS n, row_number() OVER (PARTITION BY corpus ORDER BY score DESC) AS pos FROM s),
c AS (SELECT corpus, max(n) AS n, max(score) FILTER (WHERE pos = greatest(1, CAST(ceil(keep_pct * n / 100.0) AS BIGINT))) AS cutoff FROM k GROUP BY corpus)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _P1 + "SELECT keep_line_id, line_id FROM r JOIN g USING (x, y) WHERE line_id <> keep_line_id",
        "p1_records": _P1 + "SELECT keep_line_id, copies FROM g",
        "p2_found": _P2 + "SELECT vec_id, neighbor_id FROM r WHERE rn <= 5 AND cos >= 0.85",
        "p2_neighbors": _P2 + """SELECT v.vec_id, coalesce(list(neighbor_id ORDER BY rn) FILTER (WHERE rn <= 5), []) AS indices, coalesce(list(2 - 2 * cos ORDER BY rn) FILTER (WHERE rn <= 5), []) AS dists
FROM v LEFT JOIN r ON v.vec_id = r.vec_id GROUP BY v.vec_id""",
        "p3_found": _P3 + "SELECT DISTINCT eval_line_id, train_line_id FROM m",
        "p3_rates": _P3 + """,
ei AS (SELECT line_id, max(fold) AS fold, max(eval_set) AS eval_set FROM eval_lines GROUP BY line_id),
ti AS (SELECT line_id, corpus FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY loaded_at DESC NULLS LAST, corpus DESC NULLS LAST) AS rn FROM train_lines) WHERE rn = 1),
h AS (SELECT fold, eval_set, corpus, count(DISTINCT eval_line_id) AS eval_hits, count(DISTINCT train_line_id) AS train_hits
      FROM m JOIN ei ON ei.line_id = eval_line_id JOIN ti ON ti.line_id = train_line_id GROUP BY fold, eval_set, corpus),
ne AS (SELECT fold, eval_set, count(*) AS eval_lines FROM ei GROUP BY fold, eval_set), nt AS (SELECT corpus, count(*) AS train_lines FROM ti GROUP BY corpus)
SELECT h.fold, h.eval_set, h.corpus, eval_hits, eval_lines, train_hits, train_lines, eval_hits / eval_lines AS eval_rate, train_hits / train_lines AS train_rate
FROM h JOIN ne ON h.fold IS NOT DISTINCT FROM ne.fold AND h.eval_set IS NOT DISTINCT FROM ne.eval_set JOIN nt ON h.corpus IS NOT DISTINCT FROM nt.corpus""",
        "p6_found": _P6 + "SELECT s.corpus, line_id FROM s JOIN c ON s.corpus = c.corpus WHERE score >= cutoff",
        "p6_cutoffs": _P6 + """
SELECT t.corpus, t.keep_pct, coalesce(c.n, 0) AS n, c.cutoff, count(s.line_id) FILTER (WHERE s.score >= c.cutoff) AS kept,
  CASE WHEN c.n IS NOT NULL AND t.mine_threshold IS NOT NULL AND NOT isnan(t.mine_threshold) THEN count(s.line_id) FILTER (WHERE s.score >= t.mine_threshold) END AS kept_mine,
  CASE WHEN c.n IS NOT NULL AND t.bitext_threshold IS NOT NULL AND NOT isnan(t.bitext_threshold) THEN count(s.line_id) FILTER (WHERE s.score >= t.bitext_threshold) END AS kept_bitext
FROM keep_targets t LEFT JOIN c ON t.corpus = c.corpus LEFT JOIN s ON t.corpus = s.corpus
GROUP BY t.corpus, t.keep_pct, t.mine_threshold, t.bitext_threshold, c.n, c.cutoff""",
        "p7_round_trip": "SELECT doc_id, true AS same FROM documents",
    }
