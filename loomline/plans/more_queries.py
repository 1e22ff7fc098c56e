"""Further named queries: languages, word lists, vocabularies, numbering, merging, measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomline.functions import text as T
from loomline.functions import vector as V
from loomline.operators import evaluation as E
from loomline.operators import language as L
from loomline.operators import records as R
from loomline.operators import sampling as S
from loomline.plans.queries import query
from loomline.session import read_table as table

# ---------------------------------------------------------------- languages

_LANGS = ["deu_Latn", "eng_Latn", "fra_Latn", "ita_Latn", "nld_Latn", "por_Latn", "rus_Cyrl", "spa_Latn"]
_MODEL = r"""WITH t AS (SELECT lang AS l, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents WHERE lang IN (""" + ", ".join(f"'{g}'" for g in _LANGS) + r""")),
k AS (SELECT word FROM t GROUP BY word HAVING count(*) >= 2), c AS (SELECT l, word, count(*) AS n FROM t JOIN k USING (word) GROUP BY l, word),
g AS (SELECT unnest([""" + ", ".join(f"'{g}'" for g in _LANGS) + r"""]) AS l), z AS (SELECT g.l, ln(coalesce(sum(n), 0) + (SELECT count(*) FROM k) + 1) AS base FROM g LEFT JOIN c USING (l) GROUP BY g.l),
m AS (SELECT k.word, g.l, ln(coalesce(c.n, 0) + 1.0) - z.base AS gain FROM k CROSS JOIN g JOIN z ON z.l = g.l LEFT JOIN c ON c.word = k.word AND c.l = g.l),
"""
_PROBS = r"""w AS (SELECT id, unnest(regexp_extract_all(lower(x), '\p{L}+')) AS word FROM i), u AS (SELECT id, word, count(*) AS n FROM w GROUP BY id, word),
e AS (SELECT id, l, sum(u.n)::BIGINT AS words, exp(sum(u.n * gain) / sum(u.n)) AS v FROM u JOIN m USING (word) GROUP BY id, l),
p AS (SELECT id, l, words, round(v / sum(v) OVER (PARTITION BY id), 6) AS p, v FROM e),
"""


def _model(spark, d):
    return L.fit_languages(table(spark, d, "documents"), "text", "lang", _LANGS)


@query(_MODEL + "i AS (SELECT doc_id AS id, text AS x FROM documents)," + _PROBS + """b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY v DESC, l) AS rn FROM p)
SELECT id AS doc_id, words, CASE WHEN p < coalesce(t.probability_threshold, 0) THEN 'und' ELSE l END AS lang, p FROM b LEFT JOIN lid_config t ON t.lang = l WHERE rn = 1""")
def q_document_languages(spark, d):
    limits = {r.lang: r.probability_threshold for r in table(spark, d, "lid_config").collect()}  # a fixed table
    x = L.language_scores(table(spark, d, "documents"), "doc_id", "text", _model(spark, d), _LANGS)
    return x.select("doc_id", "words", L.pick_language(F.col("probs"), limits).alias("b")).select("doc_id", "words", "b.lang", "b.p")


@query(_MODEL + "i AS (SELECT DISTINCT line_id AS id, src AS x FROM train_lines)," + _PROBS.rstrip().rstrip(",") + """
SELECT t.line_id, t.lang_dir, coalesce(p.p <= 0.2 AND t.corpus <> 'opencaps', false) AS dropped FROM (SELECT DISTINCT line_id, lang_dir, corpus FROM train_lines) t
LEFT JOIN p ON p.id = t.line_id AND p.l = split_part(t.lang_dir, '-', 1)""")
def q_language_filter(spark, d):
    t = table(spark, d, "train_lines")
    probs = L.language_scores(t.select("line_id", "src").distinct(), "line_id", "src", _model(spark, d), _LANGS)
    lines = t.select("line_id", "lang_dir", "corpus").distinct().join(probs, "line_id", "left")
    drop = L.language_drop(F.col("probs"), F.get(F.split("lang_dir", "-"), 0), {}, 0.2, excluded=F.col("corpus") == "opencaps")
    return lines.select("line_id", "lang_dir", drop.alias("dropped"))


_BARE = r"trim(regexp_replace(regexp_replace(regexp_replace(lower(mt), '[\p{Nd}\p{P}\p{S}]', '', 'g'), '\bhttps?[^\t\n\v\f\r ]*|\bwww[^\t\n\v\f\r ]*', '', 'g'), '[\t\n\v\f\r ]+', ' ', 'g'), ' ')"


@query(f"SELECT sent_id, made_at, {_BARE} AS bare, coalesce(length({_BARE}) >= 40 AND mt_system = 'oldphrase', false) AS dropped FROM test_input_de")
def q_close_languages(spark, d):
    return table(spark, d, "test_input_de").select("sent_id", "made_at", L.bare_letters(F.col("mt")).alias("bare"), L.close_language_drop(F.col("mt"), F.col("mt_system") == "oldphrase").alias("dropped"))


@query("SELECT l.lang, CASE WHEN l.lang LIKE 'rus%' THEN 'Cyrl' ELSE 'Latn' END AS script FROM lid_config l")
def q_language_scripts(spark, d):
    from loomline.sources.readers import language_script

    return table(spark, d, "lid_config").select("lang", language_script(F.col("lang")).alias("script"))


# ---------------------------------------------------------------- selection and segments


@query("SELECT line_id, score FROM (SELECT DISTINCT line_id, score FROM mining_lines) WHERE score >= 1.2 AND NOT isnan(score) ORDER BY line_id, score LIMIT 50")
def q_accepted(spark, d):
    return R.accepted(table(spark, d, "mining_lines").select("line_id", "score").distinct(), "score", ["line_id", "score"], 1.2, 50)


@query("""WITH s AS (SELECT DISTINCT line_id, score, string_split(src, '|') AS x FROM mining_lines WHERE regexp_matches(src, '^[^|]*\\|[0-9]+\\|[0-9]+\\|[0-9]+$') AND score IS NOT NULL AND NOT isnan(score))
SELECT line_id, score, x[1] || '|' || x[2] || '|' || x[3] || '|' || x[4] AS segment FROM s WHERE score > 1.05 AND (CAST(x[3] AS BIGINT) - CAST(x[2] AS BIGINT)) / (CAST(x[4] AS BIGINT) * 1000) > 2""")
def q_audio_kept(spark, d):
    x = table(spark, d, "mining_lines").where(F.contains("src", F.lit("|"))).select("line_id", "score", V.parse_segment(F.col("src")).alias("s")).where("s.kind = 'audio' AND score IS NOT NULL AND NOT isnan(score)").distinct()
    return x.where(V.long_enough(F.col("score"), F.col("s"), 1.05, 2.0)).select("line_id", "score", V.segment_text(F.col("s")).alias("segment"))


@query("SELECT lang_dir FROM (SELECT DISTINCT lang_dir FROM train_lines) a WHERE split_part(lang_dir, '-', 2) || '-' || split_part(lang_dir, '-', 1) IN (SELECT lang_dir FROM train_lines)")
def q_both_ways(spark, d):
    return R.both_ways(table(spark, d, "train_lines"), "lang_dir")


@query("""SELECT vec_id, lang, split::BIGINT AS split FROM (SELECT vec_id, v.lang, ('0x' || substr(md5(vec_id || ':0'), 1, 8))::BIGINT % k AS split FROM sent_vectors v JOIN (SELECT lang, ceil(count(*) / 50)::BIGINT AS k FROM sent_vectors GROUP BY lang) s ON v.lang IS NOT DISTINCT FROM s.lang)""")
def q_language_splits(spark, d):
    return R.split_rows(table(spark, d, "sent_vectors").select("vec_id", "lang"), "lang", "vec_id", 50).select("vec_id", "lang", F.col("split").cast("long").alias("split"))


@query("SELECT vec_id, ('0x' || substr(md5(vec_id || ':3'), 1, 8))::BIGINT % 1000 < 250 AS kept FROM sent_vectors WHERE ('0x' || substr(md5(vec_id || ':3'), 1, 8))::BIGINT % 1000 < 250")
def q_vector_sample(spark, d):
    from loomline.sources.sinks import sampled_vectors

    return sampled_vectors(table(spark, d, "sent_vectors"), "vec_id", "embedding", 0.25, half=True, seed=3).select("vec_id", F.lit(True).alias("kept"))


@query("""SELECT source, count(*) AS lines, count(*) FILTER (WHERE len(string_split(line, chr(9))) >= 2) AS kept, sum(CASE WHEN len(string_split(line, chr(9))) >= 2 THEN length(string_split(line, chr(9))[2]) END)::BIGINT AS chars
FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL) GROUP BY source""")
def q_split_column(spark, d):
    from loomline.sources.readers import split_at

    x = table(spark, d, "documents").select("source", F.explode(F.split("text", "\n")).alias("line"))
    kept = split_at(x, "line", 1)
    n = x.groupBy("source").agg(F.count(F.lit(1)).alias("lines"))
    per = kept.groupBy(F.col("source").alias("s")).agg(F.count(F.lit(1)).alias("kept"), F.sum(F.length("text")).alias("chars"))
    return n.join(per, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "lines", F.coalesce("kept", F.lit(0)).alias("kept"), "chars")


# ---------------------------------------------------------------- words, phrases, vocabularies

_TOKENS = r"trim(regexp_replace(regexp_replace(X, '([\p{P}\p{S}\p{Han}])', ' \1 ', 'g'), '[\t\n\v\f\r ]+', ' ', 'g'), ' ')"


@query("SELECT DISTINCT word FROM (SELECT unnest([" + _TOKENS.replace("X", "p_type") + ", lower(" + _TOKENS.replace("X", "p_type") + "), " + _TOKENS.replace("X", "p_brand") + ", lower(" + _TOKENS.replace("X", "p_brand") + ")]) AS word FROM part) WHERE word <> ''")
def q_word_list(spark, d):
    p = table(spark, d, "part")
    return R.word_list(p.select(F.col("p_type").alias("w")).union(p.select("p_brand")), "w")


_FORM = r"trim(regexp_replace(lower(X), '[^\p{L}\p{N}_]+', ' ', 'g'))"
_PHRASES = "WITH p AS (SELECT unnest(['in front of', 'the teacher', 'idiot', 'with some luck', 'every evening']) AS phrase), t AS (SELECT sent_id, ' ' || replace(" + _FORM.replace("X", "mt") + ", ' ', '  ') || ' ' AS x FROM (SELECT sent_id, max(mt) AS mt FROM test_input_de GROUP BY sent_id)),"


def _phrases(spark, d):
    x = table(spark, d, "test_input_de").groupBy("sent_id").agg(F.max("mt").alias("mt"))
    listed = spark.createDataFrame([(p,) for p in ("in front of", "The teacher", "idiot", "with some luck", "every evening", "idiot")], "p string")
    return x, R.phrase_hits(x, "sent_id", F.col("mt"), listed)


@query(_PHRASES + """
h AS (SELECT sent_id, phrase, (length(x) - length(replace(x, ' ' || replace(phrase, ' ', '  ') || ' ', ''))) // (length(replace(phrase, ' ', '  ')) + 2) AS n FROM t, p)
SELECT phrase, sum(n)::BIGINT AS n, count(*) AS lines FROM h WHERE n > 0 GROUP BY phrase""")
def q_phrase_counts(spark, d):
    return _phrases(spark, d)[1].groupBy("phrase").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("lines"))


@query(_PHRASES + """
h AS (SELECT sent_id, sum((length(x) - length(replace(x, ' ' || replace(phrase, ' ', '  ') || ' ', ''))) // (length(replace(phrase, ' ', '  ')) + 2)) AS n FROM t, p GROUP BY sent_id)
SELECT sum(n)::BIGINT AS phrases, count(*) FILTER (WHERE n > 0) AS lines_with, (SELECT count(*) FROM t) AS lines, count(*) FILTER (WHERE n > 0) / (SELECT count(*) FROM t) AS share FROM h""")
def q_phrase_summary(spark, d):
    x, hits = _phrases(spark, d)
    return R.phrase_summary(x, hits, "sent_id").select(F.col("phrases").cast("long").alias("phrases"), "lines_with", "lines", "share")


@query(r"""WITH w AS (SELECT source, mt_system, regexp_replace(lower(unnest(string_split(mt, ' '))), '[^\p{L}\p{N}]+$', '') AS word FROM test_input_de)
SELECT source, word, count(*) FILTER (WHERE mt_system = 'oldphrase') AS oldphrase, count(*) FILTER (WHERE mt_system = 'nimbus-s') AS "nimbus-s", count(*) AS total FROM w WHERE word <> '' GROUP BY source, word""")
def q_word_pivot(spark, d):
    w = table(spark, d, "test_input_de").select("source", "mt_system", F.explode(F.split("mt", " ")).alias("w"))
    return R.word_pivot(w, "source", "w", "mt_system", ["oldphrase", "nimbus-s"])


@query("WITH x AS (SELECT label_id, length(mt) AS found, abusive AS flag FROM tox_labels), y AS (SELECT label_id, length(mt) * 2 AS found, abusive AS flag FROM tox_labels WHERE label_id % 2 = 0) SELECT x.label_id, x.found AS src_count, x.flag AS src_flag, y.found AS mt_count, y.flag AS mt_flag FROM x JOIN y USING (label_id)")
def q_paired_sides(spark, d):
    """Both sides' columns with their own prefix, for the rows that both have."""
    t = table(spark, d, "tox_labels")
    one = lambda n: t.select("label_id", (F.length("mt") * n).alias("found"), F.col("abusive").alias("flag"))
    names = {"found": "count"}
    return R.prefixed(one(1), "src_", ["label_id"], names).join(R.prefixed(one(2).where("label_id % 2 = 0"), "mt_", ["label_id"], names), "label_id")


@query(r"""WITH w AS (SELECT unnest(list_filter(regexp_split_to_array(src, '[\t\n\v\f\r ]+'), lambda x: x <> '')) AS word FROM train_lines), c AS (SELECT word, count(*) AS n FROM w GROUP BY word)
SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 + 4 AS id FROM c QUALIFY id < 304""")
def q_word_dictionary(spark, d):
    return R.vocabulary(table(spark, d, "train_lines").select(F.explode(F.split("src", r"\s+")).alias("w")), "w", 300)


@query(r"""WITH w AS (SELECT unnest(list_filter(regexp_split_to_array(src, '[\t\n\v\f\r ]+'), lambda x: x <> '')) AS word FROM train_lines), c AS (SELECT word, count(*) AS n FROM w GROUP BY word),
v AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 + 4 AS id FROM c QUALIFY id < 304),
s AS (SELECT line_id, list_filter(regexp_split_to_array(src, '[\t\n\v\f\r ]+'), lambda x: x <> '') AS t FROM eval_lines),
u AS (SELECT line_id, unnest(t) AS word, generate_subscripts(t, 1) AS k FROM s), b AS (SELECT u.line_id, list(coalesce(v.id, 3)::INT ORDER BY k) AS ids FROM u LEFT JOIN v USING (word) GROUP BY u.line_id)
SELECT s.line_id, len(coalesce(ids, [])) + 1 AS n, array_to_string(list_concat(coalesce(ids, []), [2]), ' ') AS tokens FROM s LEFT JOIN b USING (line_id)""")
def q_binarized(spark, d):
    vocab = R.vocabulary(table(spark, d, "train_lines").select(F.explode(F.split("src", r"\s+")).alias("w")), "w", 300)
    out = R.binarized(table(spark, d, "eval_lines"), "line_id", "src", vocab)
    return out.select("line_id", F.size("tokens").cast("long").alias("n"), F.array_join(F.col("tokens").cast("array<string>"), " ").alias("tokens"))


@query("SELECT value, row_number() OVER (ORDER BY f, value) - 1 AS id FROM (SELECT src AS value, min(line_id) AS f FROM eval_lines WHERE src IS NOT NULL GROUP BY src)")
def q_dictionary_encode(spark, d):
    return R.dense_ids(table(spark, d, "eval_lines").select(F.col("src").alias("value"), "line_id"), "value", "line_id")


@query("SELECT line_id, row_number() OVER (ORDER BY line_id) - 1 AS number FROM (SELECT DISTINCT line_id FROM train_lines)")
def q_numbered(spark, d):
    return R.numbered(table(spark, d, "train_lines").select("line_id").distinct(), ["line_id"])


@query("""WITH t AS (SELECT label_id, string_split(lower(mt), ' ') AS w FROM tox_labels WHERE mt IS NOT NULL), q AS (SELECT ['in', 'front', 'of'] AS p)
SELECT label_id, coalesce(list_filter(generate_series(0, greatest(len(w) - 3, 0)), lambda i: w[i + 1:i + 3] = p)[1], -1)::BIGINT AS place FROM t, q""")
def q_sequence_position(spark, d):
    phrase = F.array(F.lit("in"), F.lit("front"), F.lit("of"))
    return table(spark, d, "tox_labels").where("mt IS NOT NULL").select("label_id", R.sequence_position(F.split(F.lower("mt"), " "), phrase).cast("long").alias("place"))


@query("""WITH t AS (SELECT label_id, string_split(mt, ' ') AS w FROM tox_labels WHERE mt IS NOT NULL), u AS (SELECT label_id, generate_subscripts(w, 1) AS k, unnest(w) AS x FROM t),
n AS (SELECT *, sum(CASE WHEN k = 1 OR length(x) > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY label_id ORDER BY k) AS g FROM u), s AS (SELECT label_id, g, sum(length(x))::DOUBLE AS v, avg(length(x)) AS m FROM n GROUP BY label_id, g)
SELECT label_id, count(*) AS words, max(v) AS largest, round(sum(m), 6) AS means FROM s GROUP BY label_id""")
def q_word_values(spark, d):
    """Lengths of sub-words added up to words; here words of more than three letters begin one."""
    w = F.split("mt", " ")
    tokens = F.transform(w, lambda x: F.when(F.length(x) > 3, F.concat(F.lit("▁"), x)).otherwise(F.concat(F.lit("."), x)))
    x = table(spark, d, "tox_labels").where("mt IS NOT NULL").select("label_id", T.word_values(tokens, F.transform(w, F.length)).alias("s"), T.word_values(tokens, F.transform(w, F.length), "mean").alias("m"))
    return x.select("label_id", F.size("s").cast("long").alias("words"), F.array_max("s").alias("largest"), F.round(F.aggregate("m", F.lit(0.0), lambda a, b: a + b), 6).alias("means"))


@query("""WITH s AS (SELECT p_partkey, p_size || CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'K' WHEN 2 THEN 'KB' WHEN 3 THEN ' mb' ELSE 'x' END AS size, p_size, p_partkey % 5 AS k FROM part)
SELECT p_partkey, size, CASE k WHEN 0 THEN p_size WHEN 1 THEN p_size * 1000 WHEN 2 THEN p_size * 1024 WHEN 3 THEN p_size * 1048576 END::BIGINT AS n FROM s""")
def q_parse_size(spark, d):
    k = F.col("p_partkey") % 5
    size = F.concat(F.col("p_size").cast("string"), F.when(k == 0, "").when(k == 1, "K").when(k == 2, "KB").when(k == 3, " mb").otherwise("x"))
    return table(spark, d, "part").select("p_partkey", size.alias("size"), R.parse_size(size).alias("n"))


# ---------------------------------------------------------------- merging


@query("SELECT label_id, mt, abusive, abuse_kind IS NOT NULL AS has_abuse_kind, abuse_kind FROM tox_labels")
def q_checked_zip(spark, d):
    t = table(spark, d, "tox_labels")
    return R.checked_zip(t.select("label_id", "mt", "abusive"), t.select("label_id", "mt", "abuse_kind"), "label_id", "mt", "abuse_kind")


@query("SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_orderdate, length(substr(o_orderdate::VARCHAR, 1, 10))::BIGINT AS n FROM orders")
def q_later_wins(spark, d):
    o = table(spark, d, "orders")
    return R.later_wins([o.select("o_orderkey", "o_totalprice", "o_orderdate"), o.select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.length(F.substring(F.col("o_orderdate").cast("string"), 1, 10)).cast("long").alias("n"))], "o_orderkey")


@query("""WITH g AS (SELECT source, mt_system, count(*) AS n FROM test_input_de WHERE avg_sc > 0.6 GROUP BY source, mt_system)
SELECT t.sent_id, t.made_at, t.source, t.mt_system, g.n FROM test_input_de t LEFT JOIN g ON t.source = g.source AND t.mt_system = g.mt_system""")
def q_left_merge(spark, d):
    t = table(spark, d, "test_input_de")
    g = t.where("avg_sc > 0.6").groupBy("source", "mt_system").agg(F.count(F.lit(1)).alias("n"))
    return t.select("sent_id", "made_at", "source", "mt_system").join(g, ["source", "mt_system"], "left").select("sent_id", "made_at", "source", "mt_system", "n")


@query("SELECT e.line_id, count(t.line_id) AS found, min(t.corpus) AS corpus FROM eval_lines e LEFT JOIN (SELECT DISTINCT line_id, src, corpus FROM train_lines) t ON e.src = t.src GROUP BY e.line_id")
def q_text_lookup(spark, d):
    t = table(spark, d, "train_lines").select(F.col("line_id").alias("t"), "src", "corpus").distinct()
    return table(spark, d, "eval_lines").select("line_id", "src").join(t, "src", "left").groupBy("line_id").agg(F.count("t").alias("found"), F.min("corpus").alias("corpus"))


# ---------------------------------------------------------------- measures


def _chrf_sql(most: int) -> str:
    return f"""WITH p AS (SELECT source AS g, sent_id AS i, replace(replace(min(mt), ' the ', ' '), ' ', '') AS h, replace(min(mt), ' ', '') AS r FROM test_input_de WHERE mt IS NOT NULL AND source IS NOT NULL GROUP BY source, sent_id),
n AS (SELECT unnest(generate_series(1, {most})) AS n),
h AS (SELECT g, i, n, unnest(list_transform(generate_series(1, length(h) - n + 1), lambda k: substr(h, k, n))) AS x FROM p, n WHERE length(h) >= n),
r AS (SELECT g, i, n, unnest(list_transform(generate_series(1, length(r) - n + 1), lambda k: substr(r, k, n))) AS x FROM p, n WHERE length(r) >= n),
c AS (SELECT g, i, n, x, sum(a) AS a, sum(b) AS b FROM (SELECT g, i, n, x, 1 AS a, 0 AS b FROM h UNION ALL SELECT g, i, n, x, 0, 1 FROM r) GROUP BY ALL),
s AS (SELECT g, n, sum(least(a, b)) AS hit, sum(a) AS ah, sum(b) AS ar FROM c GROUP BY g, n), q AS (SELECT g, avg(coalesce(hit / nullif(ah, 0), 0)) AS p, avg(coalesce(hit / nullif(ar, 0), 0)) AS r FROM s GROUP BY g)
SELECT g AS source, round(coalesce(100 * 5 * p * r / nullif(4 * p + r, 0), 0), 6) AS chrf FROM q"""


@query(_chrf_sql(6))
def q_chrf(spark, d):
    x = table(spark, d, "test_input_de").where("mt IS NOT NULL AND source IS NOT NULL").groupBy("source", "sent_id").agg(F.min("mt").alias("r"))
    out = E.chrf(x.select("source", "sent_id", F.replace("r", F.lit(" the "), F.lit(" ")).alias("h"), "r"), "source", "sent_id", "h", "r")
    return out.select("source", F.round("chrf", 6).alias("chrf"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def q_stream_dedup(spark, d):
    from loomline.streaming.incremental import first_seen, run_once, stream_of

    return run_once(spark, first_seen(stream_of(spark, d, "events").select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "3650 days")).select("user_id", "event_type")


@query("SELECT doc_id FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id || ':5'), doc_id) AS rn FROM documents) WHERE rn <= CASE WHEN source = 'opencaps' THEN 40 ELSE 7 END")
def q_sample_by_quota(spark, d):
    n = F.when(F.coalesce(F.col("source") == "opencaps", F.lit(False)), 40).otherwise(7)
    return S.sample_per_group(table(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", n, 5).select("doc_id")
