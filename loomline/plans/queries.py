"""Named queries of the engine's own operators, with SQL to compare them with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import text as T
from loomline.functions import vector as V
from loomline.operators import analytics as A
from loomline.operators import dedup as D
from loomline.operators import evaluation as E
from loomline.operators import filters as FI
from loomline.operators import mining as M
from loomline.operators import records as R
from loomline.operators import sampling as S
from loomline.operators import segments as G
from loomline.plans import pipelines as P
from loomline.session import read_table as table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---------------------------------------------------------------- SQL fragments of the text functions

_WS = T.SPACE
_PUNCT1 = {k: v for k, v in T.UNICODE_PUNCT.items() if len(v) == 1}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, {_q(_WS + '+')}, ' ', 'g'))"


def _sql_punct(x: str) -> str:
    out = f"translate({x}, {_q(''.join(_PUNCT1))}, {_q(''.join(_PUNCT1.values()))})"
    for k, v in T.UNICODE_PUNCT.items():
        if len(v) > 1:
            out = f"replace({out}, {_q(k)}, {_q(v)})"
    return out


def _sql_nonprinting(x: str) -> str:
    return rf"regexp_replace({x}, '[\x00-\x1f\x7f-\x{{9f}}]', '', 'g')"


def _sql_dedup(x: str) -> str:
    """normalize_for_dedup without accents."""
    return rf"translate(regexp_replace(lower({x}), '\p{{Nd}}', '0', 'g'), {_q(''.join(T.UNICODE_PUNCT))}, '')"


def _sql_count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {_q(pattern)}))"


def _sql_spacing(x: str, language: str) -> str:
    for pattern, by in T.spacing_steps(language):
        x = f"regexp_replace({x}, {_q(pattern)}, {_q(by.replace('$', chr(92)))}, 'g')"
    return x


def _sql_emoji(x: str, by: str) -> str:
    return f"regexp_replace({x}, {_q(T.emoji_pattern(by))}, {_q(by)}, 'g')"


_LINES = "(SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL)"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "lang", "source", F.explode(F.split("text", "\n")).alias("line"))


# ---------------------------------------------------------------- scans and projections


@query(f"SELECT lang, source, count(*) AS n FROM {_LINES} GROUP BY GROUPING SETS ((lang), (source), (lang, source))")
def q_line_counts(spark, d):
    return _lines(spark, d).groupingSets([["lang"], ["source"], ["lang", "source"]], "lang", "source").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT doc_id, {_sql_ws('text')} AS clean FROM documents")
def q_normalize_whitespace(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_whitespace(F.col("text")).alias("clean"))


@query(f"SELECT line_id, {_sql_punct('src')} AS replaced, translate(src, {_q(''.join(T.UNICODE_PUNCT))}, '') AS removed FROM mining_lines")
def q_unicode_punct(spark, d):
    return table(spark, d, "mining_lines").select("line_id", T.replace_unicode_punct(F.col("src")).alias("replaced"), T.remove_unicode_punct(F.col("src")).alias("removed"))


@query(f"""WITH x AS (SELECT doc_id, {_sql_nonprinting(_sql_punct(_sql_ws('text')))} AS t FROM documents),
y AS (SELECT doc_id, CASE WHEN length(t) - length(replace(t, '"', '')) = 1 AND t LIKE '"%' THEN t[2:] ELSE t END AS t FROM x)
SELECT doc_id, CASE WHEN length(t) - length(replace(t, '"', '')) = 1 AND t LIKE '%"' THEN t[:-2] ELSE t END AS clean FROM y""")
def q_normalize_line(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_line(F.col("text")).alias("clean"))


@query(rf"""SELECT doc_id, regexp_replace(text, {_q(T.URL)}, '_', 'g') AS urls, regexp_replace(text, '[#@][A-Za-z0-9_]{{4,}}', '[TAG]', 'g') AS tags FROM documents""")
def q_replacers(spark, d):
    return table(spark, d, "documents").select("doc_id", T.replace_urls(F.col("text"), "_").alias("urls"), T.replace_hashtags(F.col("text"), "[TAG]").alias("tags"))


@query(f"SELECT doc_id, {_sql_dedup('text')} AS plain FROM documents")
def q_normalize_for_dedup(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_for_dedup(F.col("text"), accent=False).alias("plain"))


@query("SELECT line_id, strip_accents(src) AS plain FROM mining_lines")
def q_strip_accents(spark, d):
    return table(spark, d, "mining_lines").select("line_id", T.strip_accents(F.col("src")).alias("plain"))


@query()
def q_normal_form(spark, d):
    return table(spark, d, "documents").select("doc_id", T.nfkc()(F.col("text")).alias("nfkc"))


@query(f"SELECT line_id, {_sql_spacing('src', 'en')} AS en, {_sql_spacing('src', 'fr')} AS fr FROM mining_lines")
def q_spacing(spark, d):
    return table(spark, d, "mining_lines").select("line_id", T.normalize_spacing(F.col("src"), "en").alias("en"), T.normalize_spacing(F.col("src"), "fr").alias("fr"))


@query(f"SELECT doc_id, {_sql_emoji('text', '')} AS plain, {_sql_emoji('text', ' ')} AS spaced FROM documents")
def q_demojize(spark, d):
    return table(spark, d, "documents").select("doc_id", T.demojize(F.col("text")).alias("plain"), T.demojize(F.col("text"), " ").alias("spaced"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, md5(props) AS h FROM events")
def q_json_field(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.md5("props").alias("h"))


@query("""WITH x AS (SELECT doc_id, string_split(line, chr(9)) AS f, coalesce(source LIKE 'hollowcrawl%' OR source LIKE 'opencaps%', false) AS last FROM """ + _LINES + """ WHERE contains(line, chr(9)))
SELECT doc_id, CASE WHEN last THEN f[-1] ELSE f[1] END AS head, array_to_string(CASE WHEN last THEN f[1:-2] ELSE f[2:] END, chr(9)) AS rest FROM x""")
def q_meta_split(spark, d):
    from loomline.sources.readers import split_meta

    x = _lines(spark, d).where(F.contains("line", F.lit("\t"))).select("doc_id", split_meta(F.col("line"), F.coalesce("source", F.lit("")), last=("hollowcrawl", "opencaps")).alias("m"))
    return x.select("doc_id", F.col("m.text").alias("head"), F.col("m.meta").alias("rest"))


@query("""WITH x AS (SELECT doc_id, list_filter(regexp_split_to_array(line, '[\\t-\\r ]+'), lambda w: w <> '') AS w FROM """ + _LINES + """)
SELECT doc_id, array_to_string(w[1:5], ' ') AS meta, array_to_string(w[6:], ' ') AS text FROM x""")
def q_distillation_split(spark, d):
    from loomline.sources.readers import split_row

    x = _lines(spark, d).select("doc_id", split_row(F.col("line")).alias("r"))
    return x.select("doc_id", F.array_join("r.meta", " ").alias("meta"), F.col("r.text").alias("text"))


@query("""WITH s AS (SELECT line_id, score, src, tgt, regexp_matches(src, '^[^|]*\\|[0-9]+\\|[0-9]+\\|[0-9]+$') AS bar, regexp_matches(src, '^[^ ]* [0-9]+ [0-9]+ [^ ]*$') AS blank FROM mining_lines),
p AS (SELECT line_id, CASE WHEN bar THEN string_split(src, '|') WHEN blank THEN string_split(src, ' ') END AS x, bar, blank FROM s)
SELECT line_id, CASE WHEN bar OR blank THEN 'audio' ELSE 'text' END AS kind, x[1] AS path, CAST(x[2] AS BIGINT) AS start, CAST(x[3] AS BIGINT) AS "end", CASE WHEN bar THEN CAST(x[4] AS BIGINT) WHEN blank THEN 16 END AS factor FROM p""")
def q_segments(spark, d):
    x = table(spark, d, "mining_lines").select("line_id", V.parse_segment(F.col("src")).alias("s"))
    return x.select("line_id", "s.kind", "s.path", "s.start", "s.end", "s.factor")


@query("""SELECT line_id, split_part(lang_dir, '-', 1) AS src_lang, split_part(lang_dir, '-', 2) AS tgt_lang, split_part(lang_dir, '-', 2) || '-' || split_part(lang_dir, '-', 1) AS reversed FROM train_lines""")
def q_directions(spark, d):
    s = F.split("lang_dir", "-")
    return table(spark, d, "train_lines").select("line_id", s[0].alias("src_lang"), s[1].alias("tgt_lang"), F.concat_ws("-", s[1], s[0]).alias("reversed"))


@query()
def q_sentence_counts(spark, d):
    x = table(spark, d, "documents").where("text IS NOT NULL").select("lang", F.explode(T.sentences(F.col("text"))).alias("s"))
    return x.groupBy("lang").agg(F.count(F.lit(1)).alias("sentences"))


@query()
def q_sentences(spark, d):
    x = table(spark, d, "documents").select("doc_id", F.posexplode(T.sentences(F.col("text"))).alias("n", "raw"))
    clean = T.replace_non_printing(T.normalize_whitespace(T.replace_unicode_punct(F.col("raw"))))
    return x.select("doc_id", "n", F.xxhash64("raw").alias("line_hash"), "raw", clean.alias("clean"))


# ---------------------------------------------------------------- filters

_LENGTH = FI.LengthRule(min_len=30, max_len=300, max_ratio=1.8, factors={"rus_Cyrl": 1.1, "deu_Latn": 0.95})


def _pairs(spark, d):
    return table(spark, d, "mining_lines").withColumn("_s", F.split("lang_dir", "-"))


def _rules():
    c = F.col
    return [FI.score_rule("score"), *_LENGTH.rules("src", "tgt", F.get(c("_s"), 0), F.get(c("_s"), 1)), *FI.symbol_rules("src", "tgt", keep_numbers=True, digits=0.08)]


def _factor_sql(lang: str) -> str:
    return f"CASE {lang} WHEN 'rus_Cyrl' THEN 1.1::DOUBLE WHEN 'deu_Latn' THEN 0.95::DOUBLE ELSE 1.0::DOUBLE END"


_CHAIN = rf"""WITH x AS (SELECT *, greatest(1.0::DOUBLE, length(src) * {_factor_sql("split_part(lang_dir, '-', 1)")}) AS s, greatest(1.0::DOUBLE, length(tgt) * {_factor_sql("split_part(lang_dir, '-', 2)")}) AS t FROM mining_lines),
y AS (SELECT line_id, corpus, CASE WHEN score IS NOT NULL AND NOT isnan(score) AND score <> 0 AND score < 1.06 THEN 'score'
 WHEN src IS NULL OR src = '' OR tgt = '' THEN 'empty' WHEN s < 30 OR t < 30 THEN 'min_len' WHEN s > 300 OR t > 300 THEN 'max_len' WHEN greatest(s / t, t / s) > 1.8 THEN 'max_len_ratio'
 WHEN length(src) - length(replace(src, '#', '')) > 3 OR length(tgt) - length(replace(tgt, '#', '')) > 3 THEN 'hashtags'
 WHEN {_sql_count('src', chr(92) + 'p{Nd}')} / ({_sql_count('src', chr(92) + 'p{L}')} + 1) > 0.08 OR {_sql_count('tgt', chr(92) + 'p{Nd}')} / ({_sql_count('tgt', chr(92) + 'p{L}')} + 1) > 0.08 THEN 'digit_ratio'
 WHEN len(list_filter(string_split(src, ' '), lambda w: regexp_matches(w, '\p{{L}}'))) / len(string_split(src, ' ')) < 0.5
   OR len(list_filter(string_split(tgt, ' '), lambda w: regexp_matches(w, '\p{{L}}'))) / len(string_split(tgt, ' ')) < 0.5 THEN 'alpha_words' END AS drop_reason FROM x)
"""


@query(_CHAIN + "SELECT line_id, corpus, drop_reason FROM y")
def q_filter_chain(spark, d):
    return FI.chain(_pairs(spark, d), _rules()).select("line_id", "corpus", "drop_reason")


@query(_CHAIN + "SELECT corpus, count(*) AS total_before, count(*) FILTER (WHERE drop_reason IS NULL) AS total_after, " + ", ".join(
    f"count(*) FILTER (WHERE drop_reason = '{r}') AS {r}" for r in ("score", "empty", "min_len", "max_len", "max_len_ratio", "hashtags", "digit_ratio", "alpha_words")) + " FROM y GROUP BY corpus")
def q_filter_counts(spark, d):
    return FI.counters(FI.chain(_pairs(spark, d), _rules()), _rules(), "corpus")


@query(f"""WITH x AS (SELECT doc_id, line, length(line) AS n FROM {_LINES})
SELECT doc_id, count(*) FILTER (WHERE n BETWEEN 10 AND 500 AND {_sql_count('line', T.PUNCT)} / n <= 0.2 AND {_sql_count('line', '[0-9]')} / n <= 0.2
  AND {_sql_count('line', chr(92) + 't')} / n + {_sql_count('line', '[' + chr(92) + 'n-' + chr(92) + 'r ]')} / n BETWEEN 0.03 AND 0.5 AND {_sql_count('line', T.EMOJI)} / n <= 0.2) AS kept, count(*) AS lines
FROM x GROUP BY doc_id""")
def q_keep_text(spark, d):
    keep = FI.keep_text(F.col("line"), max_run=None)
    return _lines(spark, d).groupBy("doc_id").agg(F.count_if(keep).alias("kept"), F.count(F.lit(1)).alias("lines"))


@query()
def q_keep_text_runs(spark, d):
    return _lines(spark, d).groupBy("source").agg(F.count_if(FI.keep_text(F.col("line"))).alias("kept"), F.max(T.longest_run(F.col("line"))).alias("longest_run"), F.count(F.lit(1)).alias("lines"))


@query(f"""WITH x AS (SELECT doc_id, regexp_replace(text, {_q(T.SCRIPTLESS)}, '', 'g') AS t FROM documents WHERE text IS NOT NULL),
y AS (SELECT doc_id, unnest([{', '.join("{'script': '" + n + "', 'n': length(t) - length(regexp_replace(t, '" + T.script_class(n) + "', '', 'g'))}" for n in T.SCRIPTS)}]) AS c FROM x),
z AS (SELECT doc_id, c.script AS script, c.n AS n FROM y WHERE c.n > 0),
r AS (SELECT doc_id, script, n, sum(n) OVER (PARTITION BY doc_id) AS total, count(*) OVER (PARTITION BY doc_id) AS k, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, script) AS rn FROM z)
SELECT doc_id, CASE WHEN k > 1 AND k * n = total THEN NULL ELSE script END AS script, CASE WHEN k > 1 AND k * n = total THEN 0 ELSE n / total END AS share FROM r WHERE rn = 1
UNION ALL SELECT doc_id, NULL, 0 FROM x WHERE doc_id NOT IN (SELECT doc_id FROM z)""")
def q_script(spark, d):
    x = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", T.predict_script(T.script_counts(F.col("text"))).alias("p"))
    return x.select("doc_id", "p.script", "p.share")


@query("""SELECT line_id, score FROM mining_lines WHERE score BETWEEN 1.04 AND 1.25""")
def q_score_window(spark, d):
    return M.score_window(table(spark, d, "mining_lines"), 1.04, 1.25).select("line_id", "score")


@query("""SELECT m.line_id, m.corpus FROM mining_lines m WHERE corpus IN (SELECT corpus FROM keep_targets WHERE keep_pct >= 50) AND lang_dir NOT IN ('eng_Latn-fra_Latn', 'fra_Latn-eng_Latn')""")
def q_include_exclude(spark, d):
    wanted = table(spark, d, "keep_targets").where("keep_pct >= 50").select("corpus")
    return R.include_exclude(table(spark, d, "mining_lines"), "corpus", wanted, ["eng_Latn-fra_Latn", "fra_Latn-eng_Latn"], "lang_dir").select("line_id", "corpus")


@query("""SELECT sent_id FROM test_input_de WHERE avg_sc BETWEEN 0.4 AND 0.7 AND min_sc BETWEEN 0.2 AND 0.5""")
def q_box(spark, d):
    return R.box(table(spark, d, "test_input_de"), avg_sc=(0.4, 0.7), min_sc=(0.2, 0.5)).select("sent_id")


@query(r"""WITH t AS (SELECT line_id, len(list_filter(regexp_split_to_array(src, '[\t-\r ]+'), lambda w: w <> '')) AS a, len(list_filter(regexp_split_to_array(tgt, '[\t-\r ]+'), lambda w: w <> '')) AS b FROM train_lines WHERE src IS NOT NULL AND tgt IS NOT NULL)
SELECT line_id, CASE WHEN a NOT BETWEEN 1 AND 250 OR b NOT BETWEEN 1 AND 250 THEN 'token_count' WHEN greatest(a / b, b / a) > 1.3 THEN 'token_ratio' END AS drop_reason FROM t""")
def q_token_limits(spark, d):
    return FI.chain(table(spark, d, "train_lines").where("src IS NOT NULL AND tgt IS NOT NULL"), FI.token_rules("src", "tgt", ratio=1.3)).select("line_id", "drop_reason")


# ---------------------------------------------------------------- deduplication


@query(f"""WITH x AS (SELECT doc_id, source, {_sql_dedup(_sql_ws('text'))} AS n FROM documents WHERE text IS NOT NULL)
SELECT min(doc_id) AS doc_id, source, count(*) AS copies, md5(n) AS h FROM x GROUP BY source, n""")
def q_exact_dedup(spark, d):
    x = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "source", T.normalize_for_dedup(T.normalize_whitespace(F.col("text")), accent=False).alias("n"))
    # grouping on the digest keeps the shuffle narrow
    return x.select("doc_id", "source", F.md5("n").alias("h")).groupBy("source", "h").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))


@query("SELECT line_id FROM (SELECT line_id, row_number() OVER (PARTITION BY corpus, lower(tgt) ORDER BY line_id) AS rn FROM (SELECT DISTINCT line_id, corpus, tgt FROM train_lines)) WHERE rn <= 2")
def q_cap_per_target(spark, d):
    x = table(spark, d, "train_lines").select("line_id", "corpus", F.lower("tgt").alias("t"), "tgt").distinct()
    return D.at_most(x, ["corpus", "t"], "line_id", 2).select("line_id")


@query("SELECT line_id FROM (SELECT line_id, row_number() OVER (PARTITION BY corpus, lower(src) ORDER BY line_id) AS rn FROM (SELECT DISTINCT line_id, corpus, src FROM train_lines)) WHERE rn <= 2")
def q_cap_per_source(spark, d):
    x = table(spark, d, "train_lines").select("line_id", "corpus", F.lower("src").alias("s"), "src").distinct()
    return D.at_most(x, ["corpus", "s"], "line_id", 2).select("line_id")


@query("SELECT min(line_id) AS line_id, corpus FROM train_lines WHERE src IS NOT NULL AND tgt IS NOT NULL GROUP BY corpus, lower(src), lower(tgt)")
def q_pair_dedup(spark, d):
    x = table(spark, d, "train_lines").where("src IS NOT NULL AND tgt IS NOT NULL").select("line_id", "corpus", F.lower("src").alias("a"), F.lower("tgt").alias("b"))
    return D.first_of(x, ["corpus", "a", "b"], "line_id").select("line_id", "corpus")


def _held_sql(mode: str, accents: bool = False) -> str:
    n = lambda c: f"strip_accents({_sql_dedup(_sql_ws(c))})" if accents else _sql_dedup(_sql_ws(c))
    tests = {"src": ["a"], "tgt": ["b"], "both": ["a", "b"], "neither": []}[mode]
    keys = [["a", "b"], *([t] for t in tests)]
    conds = " AND ".join(
        f"t.line_id = (SELECT min(line_id) FROM o WHERE o.lang_dir = t.lang_dir AND {' AND '.join(f'o.{c} = t.{c}' for c in k)}) AND NOT EXISTS (SELECT 1 FROM e WHERE e.lang_dir = t.lang_dir AND {' AND '.join(f'e.{c} = t.{c}' for c in k)})"
        for k in keys)
    return f"""WITH o AS (SELECT DISTINCT line_id, lang_dir, {n("src")} AS a, {n("tgt")} AS b FROM train_lines WHERE {n("src")} <> '' AND {n("tgt")} <> ''),
e0 AS (SELECT lang_dir, {n("src")} AS a, {n("tgt")} AS b FROM eval_lines WHERE {n("src")} <> '' AND {n("tgt")} <> ''),
e AS (SELECT * FROM e0 UNION ALL SELECT split_part(lang_dir, '-', 2) || '-' || split_part(lang_dir, '-', 1), b, a FROM e0)
SELECT t.line_id, t.lang_dir FROM o t WHERE {conds}"""


def _held(spark, d, mode):
    norm = lambda c: T.normalize_for_dedup(T.normalize_whitespace(c), accent=False)
    once = table(spark, d, "train_lines").select("line_id", "lang_dir", "src", "tgt").distinct()
    return D.held_out(once, table(spark, d, "eval_lines"), "src", "tgt", norm, mode).withColumnRenamed("id", "line_id")


@query(_held_sql("both"))
def q_held_out_both(spark, d):
    return _held(spark, d, "both")


@query(_held_sql("src"))
def q_held_out_src(spark, d):
    return _held(spark, d, "src")


@query(_held_sql("neither"))
def q_held_out_neither(spark, d):
    return _held(spark, d, "neither")


@query(f"SELECT line, source, doc_id FROM (SELECT line, source, doc_id, row_number() OVER (PARTITION BY line ORDER BY source NULLS FIRST, doc_id) AS rn FROM {_LINES}) WHERE rn = 1")
def q_sort_unique(spark, d):
    return D.sort_unique(_lines(spark, d).select("line", "source", "doc_id"), "line", ["source", "doc_id"])


@query()
def q_near_duplicates(spark, d):
    return D.near_duplicates(table(spark, d, "documents"), "doc_id", T.normalize_for_dedup(T.normalize_whitespace(F.col("text"))))


@query("""SELECT src, tgt, max(score) AS score FROM mining_lines WHERE score IS NOT NULL AND NOT isnan(score) AND src IS NOT NULL AND tgt IS NOT NULL GROUP BY src, tgt""")
def q_merge_sorted(spark, d):
    x = table(spark, d, "mining_lines").where("score IS NOT NULL AND NOT isnan(score) AND src IS NOT NULL AND tgt IS NOT NULL").select("line_id", "score", "src", "tgt")
    return M.merge_sorted(x, "src", "tgt", "score", "line_id").select("src", "tgt", "score")


# ---------------------------------------------------------------- mining


def _knn_sql(norm: str = "mean", kind: str = "ratio") -> str:
    own = "avg(sim)" if norm == "mean" else "arg_max(sim, rank)"
    m = {"ratio": "sim / ((p.a + e.a) / 2)", "distance": "sim - (p.a + e.a) / 2", "absolute": "sim"}[kind]
    return f"""WITH l AS (SELECT DISTINCT ON (src_id, direction) src_id, direction, indices, dists FROM neighbors),
n AS (SELECT src_id, direction, unnest(generate_series(0, len(indices) - 1)) AS rank, unnest(indices) AS tgt_id, unnest(dists)::DOUBLE AS dist FROM l),
s AS (SELECT src_id, direction, rank, tgt_id, 2 - CASE WHEN dist IS NULL OR isnan(dist) THEN 2 ELSE dist END AS sim FROM n WHERE tgt_id >= 0),
p AS (SELECT src_id, direction, {own} AS a FROM s GROUP BY src_id, direction), e AS (SELECT src_id, max(a) AS a FROM p GROUP BY src_id),
m AS (SELECT s.src_id, s.direction, rank, tgt_id, {m} AS margin FROM s JOIN p USING (src_id, direction) JOIN e ON e.src_id = s.tgt_id),
b AS (SELECT *, row_number() OVER (PARTITION BY src_id, direction ORDER BY margin DESC, rank, tgt_id) AS rn FROM m),
f AS (SELECT round(margin, 9) AS score, src_id AS x_id, tgt_id AS y_id, 'fwd' AS direction FROM b WHERE direction = 'x2y' AND rn <= K AND margin >= 1.0),
g AS (SELECT round(margin, 9) AS score, tgt_id AS x_id, src_id AS y_id, 'bwd' AS direction FROM b WHERE direction = 'y2x' AND rn <= K AND margin >= 1.0)
"""


def _mine(spark, d, **kw):
    out = M.mine(M.neighbor_rows(table(spark, d, "neighbors")), threshold=1.0, **kw)
    return out.select(F.round("score", 9).alias("score"), "x_id", "y_id", "direction")


@query(_knn_sql().replace("rn <= K", "rn <= 1") + "SELECT * FROM f")
def q_mine_forward(spark, d):
    return _mine(spark, d, mine_type="forward")


@query(_knn_sql("last").replace("rn <= K", "rn <= 2") + "SELECT * FROM g")
def q_mine_backward_last(spark, d):
    return _mine(spark, d, mine_type="backward", norm="last", k_extract=2)


@query(_knn_sql().replace("rn <= K", "rn <= 1") + "SELECT * FROM f UNION ALL SELECT * FROM g")
def q_mine_union(spark, d):
    return _mine(spark, d)


@query(_knn_sql().replace("rn <= K", "rn <= 3") + "SELECT greatest(f.score, g.score) AS score, x_id, y_id, 'both' AS direction FROM f JOIN g USING (x_id, y_id)")
def q_mine_intersection(spark, d):
    return _mine(spark, d, mine_type="intersection", k_extract=3)


@query(_knn_sql("mean", "distance").replace("rn <= K", "rn <= 1").replace("margin >= 1.0", "margin >= 0.1") + "SELECT count(*) AS n, round(min(score), 6) AS low, round(max(score), 6) AS high, count(*) FILTER (WHERE score >= 0.3) AS above FROM f")
def q_margin_stats(spark, d):
    return R.score_summary(M.mine(M.neighbor_rows(table(spark, d, "neighbors")), threshold=0.1, kind="distance", mine_type="forward"), "score", 0.3)


@query(_knn_sql().replace("rn <= K", "rn <= 1") + "SELECT x_id, y_id, a.corpus AS x_corpus, a.line_no AS x_line_no, b.corpus AS y_corpus, b.line_no AS y_line_no FROM f JOIN sent_vectors a ON a.vec_id = x_id JOIN sent_vectors b ON b.vec_id = y_id")
def q_mined_lookup(spark, d):
    return M.with_texts(_mine(spark, d, mine_type="forward"), table(spark, d, "sent_vectors"), "vec_id", ["corpus", "line_no"]).select("x_id", "y_id", "x_corpus", "x_line_no", "y_corpus", "y_line_no")


_USABLE = "SELECT vec_id, embedding::DOUBLE[] AS e FROM sent_vectors WHERE embedding IS NOT NULL AND len(embedding) = 128 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"


def _usable(spark, d):
    ok = F.expr("embedding IS NOT NULL AND size(embedding) = 128 AND exists(embedding, x -> x <> 0)")
    return table(spark, d, "sent_vectors").where(ok).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))


@query(f"""WITH v AS ({_USABLE}), c AS (SELECT a.vec_id AS q_id, b.vec_id AS x_id, round(list_cosine_similarity(a.e, b.e), 10) AS cos FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
SELECT q_id, x_id, rank FROM (SELECT q_id, x_id, row_number() OVER (PARTITION BY q_id ORDER BY cos DESC, x_id) AS rank FROM c) WHERE rank <= 5""")
def q_exact_neighbors(spark, d):
    v = _usable(spark, d)
    return M.exact_neighbors(v.where("id % 20 = 0"), v, 128, 5).select("q_id", "x_id", "rank")


@query(f"""WITH v AS ({_USABLE}), c AS (SELECT a.vec_id AS q_id, b.vec_id AS x_id, round(list_cosine_similarity(a.e, b.e), 10) AS cos FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0)
SELECT q_id, x_id, rank, cos FROM (SELECT q_id, x_id, cos, row_number() OVER (PARTITION BY q_id ORDER BY cos DESC, x_id) AS rank FROM c) WHERE rank <= 5""")
def q_cell_neighbors(spark, d):
    v = _usable(spark, d)
    return M.cell_neighbors(v.where("id % 20 = 0"), v, 128, 5)


@query(f"""WITH v AS ({_USABLE}), n AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM v)
SELECT vec_id, round(list_dot_product(u, u), 6) AS len, round(u[1], 6) AS first FROM n""")
def q_l2_normalize(spark, d):
    x = _usable(spark, d).select(F.col("id").alias("vec_id"), V.l2_normalize(F.col("vec")).alias("u"))
    return x.select("vec_id", F.round(V.dot(F.col("u"), F.col("u")), 6).alias("len"), F.round(F.get("u", 0), 6).alias("first"))


@query(f"""WITH l AS (SELECT DISTINCT ON (src_id, direction) src_id, indices[1] AS t FROM neighbors WHERE indices[1] >= 0), v AS ({_USABLE})
SELECT src_id, t AS tgt_id, round(list_cosine_similarity(a.e, b.e), 6) AS cos FROM l JOIN v a ON a.vec_id = src_id JOIN v b ON b.vec_id = t""")
def q_pair_cosine(spark, d):
    pairs = table(spark, d, "neighbors").dropDuplicates(["src_id", "direction"]).select("src_id", F.get("indices", 0).alias("tgt_id")).where("tgt_id >= 0")
    v = _usable(spark, d)
    x = pairs.join(v.select(F.col("id").alias("src_id"), F.col("vec").alias("a")), "src_id").join(v.select(F.col("id").alias("tgt_id"), F.col("vec").alias("b")), "tgt_id")
    return x.select("src_id", "tgt_id", F.round(V.cosine(F.col("a"), F.col("b")), 6).alias("cos"))


# ---------------------------------------------------------------- sampling and sharding


def _sql_bucket(n: str, cols: str, seed: int = 0) -> str:
    return f"('0x' || substr(md5({cols} || ':{seed}'), 1, 8))::BIGINT % {n}"


@query("""WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), t AS (SELECT lang, n, pow(n / (SELECT sum(n) FROM c), 1.0 / 2.0) AS t FROM c),
q AS (SELECT lang, CAST(floor(t / (SELECT sum(t) FROM t) * least(300, (SELECT sum(n) FROM c))) AS BIGINT) AS quota FROM t)
SELECT doc_id, d.lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || ':0'), doc_id) AS rn FROM documents) d JOIN q ON d.lang IS NOT DISTINCT FROM q.lang WHERE rn <= quota""")
def q_temperature_sample(spark, d):
    return S.temperature_sample(table(spark, d, "documents"), "lang", "doc_id", 300, 2.0).select("doc_id", "lang")


@query("SELECT sent_id, source FROM (SELECT sent_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(sent_id || ':3'), sent_id) AS rn FROM (SELECT DISTINCT sent_id, source FROM test_input_de)) WHERE rn <= 10")
def q_sample_per_source(spark, d):
    return S.sample_per_group(table(spark, d, "test_input_de").select("sent_id", "source").distinct(), "source", "sent_id", 10, 3)


@query("SELECT lang_dir, n, least(ceil(n / 250), ceil(sum(n) OVER () / 5000))::BIGINT AS shards FROM (SELECT lang_dir, count(*) AS n FROM train_lines GROUP BY lang_dir)")
def q_shard_counts(spark, d):
    per = table(spark, d, "train_lines").groupBy("lang_dir").agg(F.count(F.lit(1)).alias("n"))
    return A.with_totals(per, per.agg(F.sum("n").alias("n_all"))).select("lang_dir", "n", S.shard_count(F.col("n"), F.col("n_all"), 250, 5000).cast("long").alias("shards"))


@query(f"SELECT t.line_id, j.job_id, {_sql_bucket('j.num_shards', 't.line_id')} AS shard FROM (SELECT DISTINCT line_id, lang_dir, corpus FROM train_lines) t JOIN dedup_sharding_jobs j ON t.lang_dir = j.lang_dir AND list_contains(j.train_datasets, t.corpus)")
def q_shard_assign(spark, d):
    jobs = F.broadcast(table(spark, d, "dedup_sharding_jobs").select("job_id", "lang_dir", "num_shards", F.explode("train_datasets").alias("corpus")))  # a fixed table
    x = table(spark, d, "train_lines").select("line_id", "lang_dir", "corpus").distinct().join(jobs, ["lang_dir", "corpus"])
    return x.select("line_id", "job_id", S.md5_bucket(F.col("num_shards"), "line_id").alias("shard"))


@query("""WITH x AS (SELECT sent_id, unnest(generate_series(0, 7)) AS s FROM (SELECT DISTINCT sent_id FROM test_input_de)), r AS (SELECT sent_id, s, row_number() OVER (PARTITION BY sent_id ORDER BY md5(sent_id || ':' || s || ':0')) AS rn FROM x)
SELECT sent_id, s AS shard FROM r WHERE rn <= CASE WHEN sent_id % 1000 < 250 THEN 3 ELSE 2 END""")
def q_shard_replacement(spark, d):
    return S.shard_with_replacement(table(spark, d, "test_input_de").select("sent_id").distinct(), "sent_id", "sent_id", 8, 2.25).select("sent_id", F.col("shard").cast("long").alias("shard"))


@query(f"SELECT vec_id, lang FROM sent_vectors WHERE {_sql_bucket('4', 'lang', 5)} = 1")
def q_holdout(spark, d):
    return S.holdout(table(spark, d, "sent_vectors").select("vec_id", "lang"), "lang", 4, 1, 5)


@query("""WITH x AS (SELECT DISTINCT sent_id, ('0x' || substr(md5(sent_id || ':1'), 1, 8))::BIGINT % 8 AS lane FROM test_input_de), r AS (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY md5(sent_id || ':0'), sent_id) - 1 AS r FROM x)
SELECT sent_id, lane, r // 32 AS batch, r % 32 AS place FROM r""")
def q_batches(spark, d):
    return S.shuffled_batches(table(spark, d, "test_input_de").select("sent_id").distinct(), "sent_id", 32, 8)


@query("SELECT source, avg_sc, sent_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY avg_sc DESC NULLS LAST, sent_id) AS rn FROM (SELECT DISTINCT source, avg_sc, sent_id FROM test_input_de)) WHERE rn <= 3")
def q_top_per_source(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("source").orderBy(F.col("avg_sc").desc_nulls_last(), "sent_id")
    return table(spark, d, "test_input_de").select("source", "avg_sc", "sent_id").distinct().withColumn("rn", F.row_number().over(w)).where("rn <= 3").drop("rn")


@query("""WITH x AS (SELECT sent_id, source, mt, avg_sc FROM (SELECT *, row_number() OVER (PARTITION BY sent_id ORDER BY made_at DESC NULLS LAST, source DESC NULLS LAST, mt DESC NULLS LAST, avg_sc DESC NULLS LAST) AS rn FROM test_input_de) WHERE rn = 1 AND avg_sc IS NOT NULL)
SELECT source, sent_id, mt, avg_sc AS best FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY avg_sc DESC, sent_id) AS k FROM x) WHERE k = 1""")
def q_best_hypothesis(spark, d):
    x = table(spark, d, "test_input_de").groupBy("sent_id").agg(F.max(F.struct("made_at", "source", "mt", "avg_sc")).alias("x")).select("sent_id", "x.*")
    return R.best_hypothesis(x, "source", "avg_sc", "sent_id", "mt")


# ---------------------------------------------------------------- aggregates

_COUNTERS = ("kept", "filtered", "extra_filtered", "script_filtered", "script_mismatch", "lid_filtered", "lid_mismatch", "paragraphs", "sentences")


@query("SELECT source, lang, " + ", ".join(f"sum({c})::BIGINT AS {c}" for c in _COUNTERS) + " FROM (SELECT DISTINCT * FROM mono_results) GROUP BY source, lang")
def q_mono_counters(spark, d):
    own = table(spark, d, "mono_results").distinct()
    return R.added([own.where("kept >= filtered"), own.where("kept < filtered OR kept IS NULL OR filtered IS NULL")], ["source", "lang"], list(_COUNTERS))


@query("SELECT source, lang, avg(kept / sentences) AS mean, count(*) AS n FROM (SELECT DISTINCT * FROM mono_results WHERE sentences > 0) GROUP BY ROLLUP (source, lang)")
def q_hierarchy(spark, d):
    x = table(spark, d, "mono_results").distinct().where("sentences > 0")
    return A.hierarchy(x, ["source", "lang"], F.col("kept") / F.col("sentences")).drop("level")


_LANGS = ("eng_Latn", "fra_Latn", "deu_Latn", "spa_Latn", "ita_Latn", "por_Latn", "nld_Latn", "rus_Cyrl")


@query("SELECT source, count(*) AS n, " + ", ".join(f"count(*) FILTER (WHERE lang = '{v}') / count(*) AS {v}" for v in _LANGS) + " FROM documents GROUP BY source")
def q_pivot_shares(spark, d):
    return A.pivot_shares(table(spark, d, "documents"), "source", "lang", list(_LANGS))


@query("WITH p AS (SELECT source, " + ", ".join(f"avg(kept) FILTER (WHERE lang = '{v}') AS {v}" for v in _LANGS) + " FROM mono_results GROUP BY source) SELECT *, list_avg(list_filter([" + ", ".join(_LANGS) + "], lambda x: x IS NOT NULL)) AS row_mean FROM p")
def q_pivot_mean(spark, d):
    return A.pivot_mean(table(spark, d, "mono_results"), "source", "lang", list(_LANGS), "kept")


@query("SELECT source, lang, count(*) AS n, count(*) / (SELECT count(*) FROM documents) AS share FROM documents GROUP BY source, lang")
def q_shares(spark, d):
    return A.shares(table(spark, d, "documents"), ["source", "lang"])


@query("""WITH c AS (SELECT source, lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY source, lang)
SELECT source, lang, n, sum(n) OVER w::BIGINT AS running, sum(n) OVER w / sum(n) OVER (PARTITION BY source) AS running_share FROM c WINDOW w AS (PARTITION BY source ORDER BY n DESC, lang ROWS UNBOUNDED PRECEDING)""")
def q_cumulative(spark, d):
    per = table(spark, d, "documents").where("lang IS NOT NULL").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    return A.cumulative_share(per, "source", [F.desc("n"), F.asc("lang")], "n")


@query("""WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang)
SELECT source, sum(n)::BIGINT AS n_all, CASE WHEN bool_or(lang IS NULL OR lang = '') THEN NULL ELSE 1 - sum(n * n) / (sum(n) * sum(n)) END AS gini FROM c GROUP BY source""")
def q_gini(spark, d):
    return A.gini_impurity(table(spark, d, "documents"), ["source"], "lang")


@query("""WITH x AS (SELECT source, avg_sc < 0.55 AS p, min_sc < 0.4 AS a FROM test_input_de WHERE avg_sc IS NOT NULL AND min_sc IS NOT NULL),
y AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE p AND a) AS tp, count(*) FILTER (WHERE p AND NOT a) AS fp, count(*) FILTER (WHERE NOT p AND a) AS fn FROM x GROUP BY source)
SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall,
 CASE WHEN tp > 0 THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) END AS f1, CASE WHEN tp + fp > 0 AND tp + fn > 0 THEN tp / (tp + fp) * n / (tp + fn) END AS lift FROM y""")
def q_precision_recall(spark, d):
    x = table(spark, d, "test_input_de").where("avg_sc IS NOT NULL AND min_sc IS NOT NULL")
    return A.detection(x, ["source"], F.col("avg_sc") < 0.55, F.col("min_sc") < 0.4)


_WORDS = ["idiot", "moron", "cretin", "imbecile", "bastard", "loser", "stupid", "scum", "porn", "vermin", "go to hell", "shut up"]
_TOK = r"' ' || trim(regexp_replace(regexp_replace(TEXT, '([\p{P}\p{S}\p{Han}])', ' \1 ', 'g'), " + _q(_WS + "+") + r", ' ', 'g')) || ' '"


_TOX = f"greatest(len(list_filter([{', '.join(map(_q, _WORDS))}], lambda w: contains({_TOK.replace('TEXT', 'mt')}, ' ' || w || ' '))), len(list_filter([{', '.join(map(_q, _WORDS))}], lambda w: contains({_TOK.replace('TEXT', 'lower(mt)')}, ' ' || w || ' '))))"


@query(f"SELECT label_id, {_TOX} AS hits FROM tox_labels")
def q_toxicity_count(spark, d):
    return table(spark, d, "tox_labels").select("label_id", T.toxicity_count(F.col("mt"), _WORDS).alias("hits"))


@query(f"SELECT w AS word, count(*) AS n FROM (SELECT unnest(list_filter([{', '.join(map(_q, _WORDS))}], lambda w: contains({_TOK.replace('TEXT', 'lower(mt)')}, ' ' || w || ' '))) AS w FROM test_input_de WHERE mt IS NOT NULL) GROUP BY w")
def q_toxicity_words(spark, d):
    x = table(spark, d, "test_input_de").where("mt IS NOT NULL").select(F.explode(T.listed(T.toxicity_tokens(F.lower("mt")), _WORDS)).alias("word"))
    return x.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH x AS (SELECT {_TOX} AS s, abusive AS y FROM tox_labels), r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS r FROM x)
SELECT count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y <> 1) AS q, (sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2) / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y <> 1)) AS auc FROM r""")
def q_toxicity_auc(spark, d):
    x = table(spark, d, "tox_labels").select(T.toxicity_count(F.col("mt"), _WORDS).alias("s"), "abusive")
    return A.roc_auc(x, "s", "abusive")


@query("""WITH x AS (SELECT avg_sc AS a, min_sc AS b FROM test_input_de WHERE avg_sc IS NOT NULL AND min_sc IS NOT NULL),
r AS (SELECT a, b, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2 AS rb FROM x)
SELECT count(*) AS n, corr(ra, rb) AS spearman, corr(a, b) AS pearson FROM r""")
def q_spearman(spark, d):
    return A.spearman(table(spark, d, "test_input_de"), "avg_sc", "min_sc")


@query("""WITH r AS (SELECT source, dense_rank() OVER (PARTITION BY source ORDER BY kept) - dense_rank() OVER (PARTITION BY source ORDER BY filtered) AS d FROM (SELECT DISTINCT source, input_file, kept, filtered FROM mono_results))
SELECT source, count(*) AS n, CASE WHEN count(*) > 1 THEN 1 - 6 * sum(d * d) / (count(*) * (count(*) * count(*) - 1)) END AS rho FROM r GROUP BY source""")
def q_dense_rank_correlation(spark, d):
    return A.dense_rank_correlation(table(spark, d, "mono_results").select("source", "input_file", "kept", "filtered").distinct(), ["source"], "kept", "filtered")


@query("""WITH c AS (SELECT source, mt_system, count(*) AS n FROM test_input_de WHERE mt_system IS NOT NULL GROUP BY source, mt_system)
SELECT source, mt_system AS mode, n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, mt_system DESC) AS rn FROM c) WHERE rn = 1""")
def q_mode(spark, d):
    return A.mode_of(table(spark, d, "test_input_de").where("mt_system IS NOT NULL"), ["source"], "mt_system", F.col("mt_system"))


@query("""SELECT source, count(*) AS n, avg(avg_sc) AS mean, median(avg_sc) AS median, count(*) FILTER (WHERE avg_sc > 0.7) / count(*) AS above FROM test_input_de WHERE avg_sc IS NOT NULL GROUP BY source""")
def q_group_summary(spark, d):
    return R.group_summary(table(spark, d, "test_input_de"), "source", "avg_sc", 0.7)


@query("""WITH q AS (SELECT quantile_cont(avg_sc, 0.9) AS t FROM test_input_de WHERE avg_sc IS NOT NULL)
SELECT source, avg((avg_sc >= t)::INT) AS share, count(*) FILTER (WHERE avg_sc >= t) AS n FROM test_input_de, q WHERE avg_sc IS NOT NULL GROUP BY source""")
def q_quantile_share(spark, d):
    return R.share_above_quantile(table(spark, d, "test_input_de"), "source", "avg_sc", 0.9)


@query("""WITH t AS (SELECT quantile_cont(avg_sc, 0.2) AS t FROM test_input_de WHERE min_sc < 0.4 AND avg_sc IS NOT NULL) SELECT avg((min_sc < 0.4)::INT) AS precision, count(*) AS n FROM test_input_de, t WHERE avg_sc >= t AND min_sc IS NOT NULL""")
def q_precision_at_recall(spark, d):
    return R.precision_at_recall(table(spark, d, "test_input_de"), "avg_sc", F.col("min_sc") < 0.4, 0.8)


@query("""SELECT mt_system, """ + ", ".join(f"count(*) FILTER (WHERE source = '{s}') / count(*) AS {s}" for s in ("hollowcrawl", "reedweb", "opencaps")) + """, count(*) AS n FROM test_input_de GROUP BY mt_system""")
def q_crosstab(spark, d):
    return A.pivot_shares(table(spark, d, "test_input_de"), "mt_system", "source", ["hollowcrawl", "reedweb", "opencaps"])


@query("""WITH k AS (SELECT corpus, count(*) AS n, count(*) FILTER (WHERE direction = 'fwd') AS k FROM mining_lines WHERE direction IS NOT NULL GROUP BY corpus), a AS (SELECT sum(n) AS n, sum(k) AS k FROM k)
SELECT corpus, round((k.k / k.n - a.k / a.n) / sqrt((k.k + a.k) / (k.n + a.n) * (1 - (k.k + a.k) / (k.n + a.n)) * (1 / k.n + 1 / a.n)), 6) AS z FROM k, a""")
def q_two_proportions(spark, d):
    per = table(spark, d, "mining_lines").where("direction IS NOT NULL").groupBy("corpus").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("direction") == "fwd").alias("k"))
    x = A.with_totals(per, per.agg(F.sum("n").alias("n2"), F.sum("k").alias("k2")))
    return x.select("corpus", F.round(A.two_proportion_z(F.col("k"), F.col("n"), F.col("k2"), F.col("n2")), 6).alias("z"))


@query("SELECT source, count(avg_sc - min_sc) AS n, avg(avg_sc - min_sc) * sqrt(count(avg_sc - min_sc)) / CASE WHEN count(avg_sc - min_sc) > 1 THEN stddev_samp(avg_sc - min_sc) END AS t FROM test_input_de GROUP BY source")
def q_paired_t(spark, d):
    return A.paired_t(table(spark, d, "test_input_de"), ["source"], "avg_sc", "min_sc")


@query()
def q_bootstrap(spark, d):
    return A.bootstrap_correlation(table(spark, d, "test_input_de"), "sent_id", "avg_sc", "min_sc")


@query("""WITH c AS (SELECT source, lang, count(*) AS n FROM (SELECT DISTINCT source, input_file, lang FROM mono_results WHERE lang IS NOT NULL) GROUP BY source, lang),
i AS (SELECT source, sum(n) AS m, sum(n * n) AS sq FROM c GROUP BY source HAVING sum(n) > 1), p AS (SELECT avg((sq - m) / (m * (m - 1))) AS p_mean, sum(m) AS t FROM i),
j AS (SELECT lang, sum(n) AS c FROM c WHERE source IN (SELECT source FROM i) GROUP BY lang), e AS (SELECT sum(pow(c / t, 2)) AS p_chance FROM j, p) SELECT p_mean, p_chance, (p_mean - p_chance) / (1 - p_chance) AS kappa FROM p, e""")
def q_kappa(spark, d):
    return A.fleiss_kappa(table(spark, d, "mono_results").where("lang IS NOT NULL").select("source", "input_file", "lang").distinct(), "source", "lang")


@query("SELECT lang, sum(length(text))::BIGINT AS chars, (SELECT sum(length(text)) FROM documents WHERE lang = 'eng_Latn') / sum(length(text)) AS factor FROM documents WHERE text IS NOT NULL AND text <> '' GROUP BY lang")
def q_length_factors(spark, d):
    return R.length_factors(table(spark, d, "documents"), "lang", "text", "eng_Latn")


@query("""SELECT src_lang, tgt_lang, lang_dir, count(*) AS n FROM (SELECT lang_dir, split_part(lang_dir, '-', 1) AS src_lang, split_part(lang_dir, '-', 2) AS tgt_lang FROM train_lines) GROUP BY GROUPING SETS ((src_lang), (tgt_lang), (lang_dir))""")
def q_train_counts(spark, d):
    s = F.split("lang_dir", "-")
    x = table(spark, d, "train_lines").select("lang_dir", s[0].alias("src_lang"), s[1].alias("tgt_lang"))
    return x.groupingSets([["src_lang"], ["tgt_lang"], ["lang_dir"]], "src_lang", "tgt_lang", "lang_dir").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT corpus FROM train_lines UNION SELECT corpus FROM mining_lines")
def q_union_corpora(spark, d):
    return table(spark, d, "train_lines").select("corpus").union(table(spark, d, "mining_lines").select("corpus")).distinct()


@query("SELECT corpus FROM keep_targets EXCEPT SELECT corpus FROM mining_lines")
def q_missing_corpora(spark, d):
    return table(spark, d, "keep_targets").select("corpus").subtract(table(spark, d, "mining_lines").select("corpus"))


@query("SELECT corpus, count(*) AS total FROM mining_lines GROUP BY corpus HAVING count(*) FILTER (WHERE score >= 1.06 AND NOT isnan(score)) = 0")
def q_empty_corpora(spark, d):
    return R.without_any(table(spark, d, "mining_lines"), "corpus", (F.col("score") >= 1.06) & ~F.isnan("score"))


@query("SELECT w AS word, sum(n)::BIGINT AS n FROM (SELECT unnest(regexp_extract_all(lower(src), '\\p{L}+')) AS w, 1 AS n FROM train_lines UNION ALL SELECT unnest(regexp_extract_all(lower(tgt), '\\p{L}+')), 1 FROM train_lines) GROUP BY w")
def q_vocabulary(spark, d):
    t = table(spark, d, "train_lines")
    words = lambda c: t.select(F.explode(F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}+"), F.lit(0))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return R.added([words("src"), words("tgt")], ["word"], ["n"])


# ---------------------------------------------------------------- segments, evaluation, streams


def _audio(spark, d):
    x = table(spark, d, "mining_lines").where("score IS NOT NULL AND NOT isnan(score)").groupBy("line_id").agg(F.max_by(F.struct("src", "score"), "loaded_at").alias("m"))
    return x.select("line_id", F.col("m.score").alias("score"), V.parse_segment(F.col("m.src")).alias("s")).where("s.kind = 'audio'").select("line_id", "score", "s.path", "s.start", "s.end", "s.factor")


_AUDIO = r"""WITH RECURSIVE m AS (SELECT line_id, arg_max({'src': src, 'score': score}, loaded_at) AS m FROM mining_lines WHERE score IS NOT NULL AND NOT isnan(score) GROUP BY line_id),
t AS (SELECT line_id, m.score AS score, m.src AS src, regexp_matches(m.src, '^[^|]*\|[0-9]+\|[0-9]+\|[0-9]+$') AS bar FROM m WHERE regexp_matches(m.src, '^[^|]*\|[0-9]+\|[0-9]+\|[0-9]+$') OR regexp_matches(m.src, '^[^ ]* [0-9]+ [0-9]+ [^ ]*$')),
x AS (SELECT line_id, score, bar, string_split(src, CASE WHEN bar THEN '|' ELSE ' ' END) AS p FROM t),
a AS (SELECT line_id, score, p[1] AS path, p[2]::DOUBLE AS s, p[3]::DOUBLE AS e, CASE WHEN bar THEN p[4]::DOUBLE ELSE 16 END AS f FROM x),
"""


@query(_AUDIO + """o AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY s, e, line_id) AS k FROM a),
r AS (SELECT path, k, line_id, s, e, f, score, 1 AS g FROM o WHERE k = 1 UNION ALL
 SELECT z.path, z.k, CASE WHEN hit AND NOT up THEN z.li ELSE z.line_id END, CASE WHEN hit AND NOT up THEN z.ls ELSE z.s END, CASE WHEN hit AND NOT up THEN z.le ELSE z.e END, CASE WHEN hit AND NOT up THEN z.lf ELSE z.f END,
  CASE WHEN hit AND NOT up THEN z.lv ELSE z.score END, CASE WHEN hit THEN z.g ELSE z.g + 1 END FROM (
  SELECT o.*, r.line_id AS li, r.s AS ls, r.e AS le, r.f AS lf, r.score AS lv, r.g, r.score < o.score AS up,
   coalesce((least(r.e, o.e) - greatest(r.s, o.s)) / r.f > 0 AND ((least(r.e, o.e) - greatest(r.s, o.s)) / r.f) / nullif(greatest((r.e - r.s) / r.f, (o.e - o.s) / o.f), 0) > 0.2, false) AS hit
  FROM r JOIN o ON o.path = r.path AND o.k = r.k + 1) z)
SELECT path, l.line_id AS line_id, l.s AS start, l.e AS "end", l.f AS factor, l.score AS score FROM (SELECT path, g, arg_max({'line_id': line_id, 's': s, 'e': e, 'f': f, 'score': score}, k) AS l FROM r GROUP BY path, g)""")
def q_segment_overlap(spark, d):
    return G.drop_overlaps(_audio(spark, d), "path", "start", "end", "factor", "score", "line_id")


@query(_AUDIO + """n AS (SELECT greatest(1, count(*) // 10000) AS n FROM a), l AS (SELECT line_id, (e - s) / f / 1000 AS seconds, ('0x' || substr(md5(path || ':0'), 1, 8))::BIGINT % n AS lane FROM a, n),
o AS (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY line_id) AS k FROM l),
r AS (SELECT lane, k, line_id, seconds, seconds AS held, 0::BIGINT AS batch FROM o WHERE k = 1 UNION ALL
 SELECT o.lane, o.k, o.line_id, o.seconds, CASE WHEN r.held + o.seconds > 10 THEN o.seconds ELSE r.held + o.seconds END, CASE WHEN r.held + o.seconds > 10 THEN r.batch + 1 ELSE r.batch END FROM r JOIN o ON o.lane = r.lane AND o.k = r.k + 1)
SELECT lane, line_id, seconds, batch FROM r""")
def q_duration_batches(spark, d):
    x = _audio(spark, d).withColumn("seconds", V.duration(F.col("start"), F.col("end"), F.col("factor")) / 1000)
    x = x.withColumn("lane", S.md5_bucket(max(1, x.count() // 10_000), "path"))  # lanes of some ten thousand rows
    return G.duration_batches(x.select("lane", "line_id", "seconds"), "lane", "line_id", "seconds", 10.0)


@query("""WITH x AS (SELECT corpus, avg((score >= 1)::INT::DOUBLE) AS kept_share, sum(length(src))::DOUBLE AS hours FROM mining_lines WHERE score IS NOT NULL AND NOT isnan(score) GROUP BY corpus), y AS (SELECT avg(kept_share) AS mean, stddev_pop(kept_share) AS deviation FROM x)
SELECT corpus, kept_share, hours, mean, deviation, abs(kept_share - mean) > 3 * deviation AS outlier FROM x, y""")
def q_file_stats(spark, d):
    x = table(spark, d, "mining_lines").where("score IS NOT NULL AND NOT isnan(score)").select("corpus", (F.col("score") >= 1).alias("ok"), F.length("src").cast("double").alias("len"))
    return G.file_stats(x, "corpus", "ok", "len")


@query("""WITH p AS (SELECT source AS g, sent_id AS i, string_split(replace(min(mt), ' the ', ' '), ' ') AS h, string_split(min(mt), ' ') AS r FROM test_input_de WHERE mt IS NOT NULL AND mt <> '' AND source IS NOT NULL GROUP BY source, sent_id),
l AS (SELECT g, sum(len(h)) AS hl, sum(len(r)) AS rl FROM p GROUP BY g),
n AS (SELECT unnest([1, 2, 3, 4]) AS n),
h AS (SELECT g, i, n, unnest(list_transform(generate_series(1, len(h) - n + 1), lambda k: array_to_string(h[k:k + n - 1], ' '))) AS x FROM p, n WHERE len(h) >= n),
r AS (SELECT g, i, n, unnest(list_transform(generate_series(1, len(r) - n + 1), lambda k: array_to_string(r[k:k + n - 1], ' '))) AS x FROM p, n WHERE len(r) >= n),
ch AS (SELECT g, i, n, x, count(*) AS c FROM h GROUP BY ALL), cr AS (SELECT g, i, n, x, count(*) AS c FROM r GROUP BY ALL),
m AS (SELECT g, n, sum(least(ch.c, coalesce(cr.c, 0))) AS hit, sum(ch.c) AS t FROM ch LEFT JOIN cr USING (g, i, n, x) GROUP BY g, n),
s AS (SELECT g, sum(ln(hit / t)) FILTER (WHERE hit > 0) AS logs, count(*) FILTER (WHERE hit > 0) AS f FROM m GROUP BY g)
SELECT l.g AS source, hl::BIGINT AS hyp_len, rl::BIGINT AS ref_len, CASE WHEN f = 4 THEN 100 * CASE WHEN hl >= rl THEN 1 ELSE exp(1 - rl / hl) END * exp(logs / 4) ELSE 0 END AS bleu FROM l JOIN s ON l.g = s.g""")
def q_bleu(spark, d):
    """Up to four words: the translations of a source with their articles left out, against the whole ones."""
    x = table(spark, d, "test_input_de").where("mt IS NOT NULL AND mt <> '' AND source IS NOT NULL").groupBy("source", "sent_id").agg(F.min("mt").alias("r"))
    return E.bleu(x.select("source", "sent_id", F.replace("r", F.lit(" the "), F.lit(" ")).alias("h"), "r"), "source", "sent_id", "h", "r")


@query("""WITH x AS (SELECT DISTINCT ON (src_id, direction) src_id, indices AS f, indices[1:3] AS s, indices[1:4] AS p FROM neighbors ORDER BY src_id, direction),
y AS (SELECT sum(len(list_intersect(f, p))) AS ap, sum(len(list_intersect(f, s))) AS sa, sum(len(list_distinct(f))) AS a, sum(len(list_distinct(s))) AS s FROM x) SELECT 1 - (ap + sa) / greatest(1, a + s) AS aer, ap / greatest(1, a) AS precision, sa / greatest(1, s) AS recall FROM y""")
def q_alignment_error(spark, d):
    x = table(spark, d, "neighbors").dropDuplicates(["src_id", "direction"]).select("indices", F.slice("indices", 1, 3).alias("s"), F.slice("indices", 1, 4).alias("p"))
    return E.alignment_error(x, "s", "p", "indices")


@query()
def q_contributions(spark, d):
    """Measures of contribution matrices, here made of the lengths of source and target words."""
    w = lambda c: F.filter(F.split(F.col(c), r"\s+"), lambda x: x != "")
    x = table(spark, d, "test_input_de").where("src IS NOT NULL AND mt IS NOT NULL").select("sent_id", w("src").alias("s"), w("mt").alias("t")).where("size(s) > 1 AND size(t) > 0")
    one = lambda t: F.transform(F.col("s"), lambda s: 1.0 / (1.0 + F.abs(F.length(s) - F.length(t))) / F.size("s"))
    m = x.select("sent_id", F.transform("t", one).alias("m"), F.size("s").alias("n"))
    return m.select("sent_id", E.contribution_metrics(F.col("m"), F.col("n")).alias("c"), F.size(E.matrix_links(F.col("m"))).alias("links")).select("sent_id", "c.*", "links")


@query()
def q_embed(spark, d):
    return E.hashed_embedding(table(spark, d, "tox_labels"), "label_id", "mt", 32).withColumnRenamed("id", "label_id")


@query("SELECT user_id, event_type, min(ts) AS first_ts FROM events GROUP BY user_id, event_type")
def q_stream_first_seen(spark, d):
    from loomline.streaming.incremental import first_times, run_once, stream_of

    seen = run_once(spark, first_times(stream_of(spark, d, "events"), ["user_id", "event_type"], "ts"), "complete")
    return seen.withColumn("first_ts", F.col("first_ts").cast("timestamp_ntz"))


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def q_stream_windows(spark, d):
    from loomline.streaming.incremental import run_once, stream_of, windowed_counts

    out = run_once(spark, windowed_counts(stream_of(spark, d, "events"), "ts", "event_type"), "complete")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


# ---------------------------------------------------------------- further projections, joins and aggregates


@query("SELECT round_even((avg_sc - 0.025) / 0.05, 0) * 0.05 + 0.025 AS bin, count(*) AS n FROM test_input_de WHERE avg_sc IS NOT NULL GROUP BY 1")
def q_round_bins(spark, d):
    return table(spark, d, "test_input_de").where("avg_sc IS NOT NULL").groupBy(A.round_bin(F.col("avg_sc")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT sent_id, CASE WHEN mt IS NULL OR mt = '' THEN 'missing' WHEN mt = src THEN 'untranslated' WHEN min_sc < 0.3 THEN 'detached' WHEN length(mt) * 3 < length(src) THEN 'cut' ELSE 'none' END AS error FROM test_input_de")
def q_severity(spark, d):
    c = F.col
    worst = R.most_severe(("missing", c("mt").isNull() | (c("mt") == "")), ("untranslated", c("mt") == c("src")), ("detached", c("min_sc") < 0.3), ("cut", F.length("mt") * 3 < F.length("src")))
    return table(spark, d, "test_input_de").select("sent_id", worst.alias("error"))


@query("SELECT sent_id, greatest(avg_sc, min_sc) AS top, 1 - min_sc AS rest FROM test_input_de")
def q_row_max(spark, d):
    return table(spark, d, "test_input_de").select("sent_id", R.row_max("avg_sc", "min_sc").alias("top"), R.complement("min_sc").alias("rest"))


@query("SELECT sent_id FROM test_input_de WHERE source IN ('letters', 'forumq', 'helpdesk') AND mt_system IN ('oldphrase', 'nimbus-s') AND NOT coalesce(mt ILIKE '%you%', false)")
def q_high_risk(spark, d):
    groups = {"source": ["letters", "forumq", "helpdesk"], "mt_system": ["oldphrase", "nimbus-s"]}
    return R.risky(table(spark, d, "test_input_de"), groups, "mt", "you").select("sent_id")


@query("""WITH x AS (SELECT DISTINCT line_id, string_split(src, ', ') AS a, string_split(tgt, ', ') AS b FROM train_lines WHERE src IS NOT NULL AND tgt IS NOT NULL),
y AS (SELECT line_id, a, b, unnest(generate_series(1, least(len(a), len(b)))) AS i FROM x) SELECT line_id, i - 1 AS n, a[i] AS src, b[i] AS tgt FROM y""")
def q_zip_parts(spark, d):
    return R.zip_parts(table(spark, d, "train_lines").select("line_id", "src", "tgt").distinct(), "line_id", "src", "tgt", ", ")


@query("SELECT coalesce(a.corpus, b.corpus) AS corpus, a.n AS train, b.n AS mined FROM (SELECT corpus, count(*) AS n FROM train_lines GROUP BY corpus) a FULL JOIN (SELECT corpus, count(*) AS n FROM mining_lines GROUP BY corpus) b ON a.corpus = b.corpus")
def q_outer_counts(spark, d):
    return R.outer_counts({"train": table(spark, d, "train_lines"), "mined": table(spark, d, "mining_lines")}, "corpus")


@query("""WITH k AS (SELECT line_id, fold, array_to_string(list_sort(string_split(lang_dir, '-')), '-') AS k FROM eval_lines), j AS (SELECT job_id, array_to_string(list_sort(string_split(lang_dir, '-')), '-') AS k FROM dedup_sharding_jobs)
SELECT job_id, fold, count(line_id) AS lines FROM j LEFT JOIN k ON j.k = k.k GROUP BY job_id, fold""")
def q_eval_lookup(spark, d):
    key = F.array_join(F.array_sort(F.split("lang_dir", "-")), "-").alias("k")
    jobs = F.broadcast(table(spark, d, "dedup_sharding_jobs").select("job_id", key))  # a fixed table
    e = table(spark, d, "eval_lines").select("line_id", "fold", key)
    return jobs.join(e, "k", "left").groupBy("job_id", "fold").agg(F.count("line_id").alias("lines"))


@query("SELECT m.line_id, coalesce(k.keep_pct::VARCHAR, '') AS keep_pct FROM mining_lines m LEFT JOIN keep_targets k ON m.corpus = k.corpus")
def q_metadata_lookup(spark, d):
    k = F.broadcast(table(spark, d, "keep_targets").select("corpus", F.col("keep_pct").cast("string").alias("keep_pct")))  # a fixed table
    return table(spark, d, "mining_lines").join(k, "corpus", "left").select("line_id", F.coalesce("keep_pct", F.lit("")).alias("keep_pct"))


@query(r"SELECT label_id, ' ' || trim(regexp_replace(lower(mt), '[^\p{L}\p{N}_]+', ' ', 'g')) || ' ' AS words FROM tox_labels")
def q_word_format(spark, d):
    return table(spark, d, "tox_labels").select("label_id", T.word_format(F.col("mt")).alias("words"))


@query("""WITH x AS (SELECT line_id, replace(src, ' ', '') AS s FROM eval_lines WHERE length(replace(src, ' ', '')) >= 6), y AS (SELECT line_id, list_transform(generate_series(1, length(s) - 5), lambda i: substr(s, i, 6)) AS g FROM x)
SELECT line_id, len(g) AS grams, len(list_distinct(g)) AS distinct_grams FROM y""")
def q_char_ngrams(spark, d):
    x = table(spark, d, "eval_lines").where(F.length(F.replace("src", F.lit(" "), F.lit(""))) >= 6).select("line_id", T.char_ngrams(F.col("src"), 6).alias("g"))
    return x.select("line_id", F.size("g").cast("long").alias("grams"), F.size(F.array_distinct("g")).cast("long").alias("distinct_grams"))


@query(r"""WITH w AS (SELECT label_id, unnest(regexp_split_to_array(lower(mt), '[^a-z]+')) AS w, generate_subscripts(regexp_split_to_array(lower(mt), '[^a-z]+'), 1) - 1 AS place FROM tox_labels)
SELECT label_id, w AS word, place FROM w WHERE w IN ('idiot', 'moron', 'cretin', 'loser', 'stupid')""")
def q_word_positions(spark, d):
    x = table(spark, d, "tox_labels").select("label_id", F.posexplode(F.split(F.lower("mt"), "[^a-z]+")).alias("place", "word"))
    return x.where(F.col("word").isin("idiot", "moron", "cretin", "loser", "stupid")).select("label_id", "word", F.col("place").cast("long").alias("place"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents WHERE text IS NOT NULL)
SELECT doc_id, n, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at FROM l""")
def q_line_offsets(spark, d):
    # a fold within the document: no shuffle, no window over rows
    lengths = F.transform(F.split("text", "\n"), lambda x: F.length(x) + 1)
    ends = F.aggregate(lengths, F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    x = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.posexplode(F.slice(ends, F.lit(1), F.size(F.split("text", "\n")))).alias("n", "at"))
    return x.select("doc_id", F.col("n").cast("long").alias("n"), "at")


@query("SELECT lang_dir, sum(n)::BIGINT AS n FROM (SELECT lang_dir, count(*) AS n FROM train_lines GROUP BY lang_dir UNION ALL SELECT lang_dir, count(*) FROM mining_lines GROUP BY lang_dir) GROUP BY lang_dir")
def q_direction_sizes(spark, d):
    per = lambda t: table(spark, d, t).groupBy("lang_dir").agg(F.count(F.lit(1)).alias("n"))
    return per("train_lines").unionByName(per("mining_lines")).groupBy("lang_dir").agg(F.sum("n").alias("n")).orderBy("n", "lang_dir")


@query("SELECT corpus, count(src) AS src_lines, count(tgt) AS tgt_lines, count(metadata) AS meta_lines, count(src) = count(tgt) AS aligned FROM train_lines GROUP BY corpus")
def q_validate(spark, d):
    return R.validated(table(spark, d, "train_lines"), "corpus", "src", "tgt", "metadata")


@query("SELECT lang, count(*) AS n, ceil(count(*) / 50)::BIGINT AS splits FROM sent_vectors GROUP BY lang")
def q_split_languages(spark, d):
    return R.splits_of(table(spark, d, "sent_vectors"), "lang", 50)


@query("SELECT vec_id, corpus FROM (SELECT vec_id, corpus, row_number() OVER (PARTITION BY corpus ORDER BY md5(vec_id || ':7'), vec_id) AS rn FROM sent_vectors) WHERE rn <= 3")
def q_sample_vectors(spark, d):
    return S.sample_per_group(table(spark, d, "sent_vectors").select("vec_id", "corpus"), "corpus", "vec_id", 3, 7)


@query("SELECT line_id FROM train_lines WHERE lang_dir NOT IN (SELECT lang_dir FROM dedup_sharding_jobs)")
def q_excluded_directions(spark, d):
    return R.outside(table(spark, d, "train_lines"), "lang_dir", table(spark, d, "dedup_sharding_jobs").select("lang_dir")).select("line_id")


@query("""WITH l AS (SELECT DISTINCT ON (src_id) src_id, indices FROM neighbors ORDER BY src_id, direction), p AS (SELECT a.src_id AS a, b.src_id AS b, a.indices AS x, b.indices AS y FROM l a JOIN l b ON b.src_id = a.indices[1])
SELECT a, b, len(list_intersect(x, y)) AS common FROM p""")
def q_common_neighbors(spark, d):
    x = table(spark, d, "neighbors").groupBy("src_id").agg(F.min_by("indices", "direction").alias("x"))
    y = x.select(F.col("src_id").alias("b"), F.col("x").alias("y"))
    p = x.select(F.col("src_id").alias("a"), "x", F.get("x", 0).alias("b")).join(y, "b")
    return p.select("a", "b", F.size(F.array_intersect("x", "y")).cast("long").alias("common"))


@query("SELECT job_id, t.corpus, e.eval_set FROM (SELECT job_id, unnest(train_datasets) AS corpus FROM dedup_sharding_jobs) t LEFT JOIN (SELECT job_id, unnest(eval_datasets) AS eval_set FROM dedup_sharding_jobs) e USING (job_id)")
def q_flatten_config(spark, d):
    j = table(spark, d, "dedup_sharding_jobs")
    return j.select("job_id", F.explode("train_datasets").alias("corpus"), "eval_datasets").select("job_id", "corpus", F.explode_outer("eval_datasets").alias("eval_set"))


@query("""SELECT source, avg(avg_sc) FILTER (WHERE mt_system = 'oldphrase') AS old_mean, avg(avg_sc) FILTER (WHERE mt_system <> 'oldphrase') AS new_mean, count(*) FILTER (WHERE min_sc > 0.3) / count(*) AS above_3, count(*) FILTER (WHERE min_sc > 0.4) / count(*) AS above_4 FROM test_input_de GROUP BY source""")
def q_split_means(spark, d):
    m = lambda cond: F.avg(F.when(cond, F.col("avg_sc")))
    share = lambda t: F.count_if(F.col("min_sc") > t) / F.count(F.lit(1))
    return table(spark, d, "test_input_de").groupBy("source").agg(m(F.col("mt_system") == "oldphrase").alias("old_mean"), m(F.col("mt_system") != "oldphrase").alias("new_mean"), share(0.3).alias("above_3"), share(0.4).alias("above_4"))


@query("SELECT mt_system, avg(avg_sc) AS avg_sc, avg(min_sc) AS min_sc, (avg(avg_sc) + avg(min_sc)) / 2 AS row_mean FROM test_input_de GROUP BY mt_system")
def q_class_means(spark, d):
    return R.class_means(table(spark, d, "test_input_de"), "mt_system", ["avg_sc", "min_sc"])


@query("SELECT source, n FROM (SELECT source, count(*) AS n FROM test_input_de GROUP BY source) ORDER BY n DESC, source LIMIT 5")
def q_top_groups(spark, d):
    return R.top_groups(table(spark, d, "test_input_de"), "source", 5)


@query("SELECT source, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents WHERE lang IS NOT NULL GROUP BY source")
def q_first_per_source(spark, d):
    return table(spark, d, "documents").where("lang IS NOT NULL").groupBy("source").agg(F.min("doc_id").alias("doc_id"), F.min_by("lang", "doc_id").alias("lang"))


@query(rf"""SELECT score, trim(regexp_replace(src, '[\t\r\n]+', ' ', 'g'), ' ') AS src, trim(regexp_replace(tgt, '[\t\r\n]+', ' ', 'g'), ' ') AS tgt FROM mining_lines WHERE score >= 1.06 AND NOT isnan(score) AND length(trim(regexp_replace(src, '[\t\r\n]+', ' ', 'g'), ' ')) > 0 AND length(trim(regexp_replace(tgt, '[\t\r\n]+', ' ', 'g'), ' ')) > 0""")
def q_tsv_round_trip(spark, d):
    import uuid

    from loomline.session import scratch_dir
    from loomline.sources.readers import read_mined
    from loomline.sources.sinks import write_bitext

    path = f"{scratch_dir(spark)}/tsv-{uuid.uuid4().hex}"
    write_bitext(table(spark, d, "mining_lines").where("score >= 1.06 AND NOT isnan(score)"), path, "score", "src", "tgt")
    return read_mined(spark, path).where("length(src) > 0 AND length(tgt) > 0")


@query("SELECT line_id, lang_dir, fold FROM eval_lines")
def q_jsonl_round_trip(spark, d):
    import uuid

    from loomline.session import scratch_dir
    from loomline.sources.sinks import write_jsonl

    path = f"{scratch_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    x = table(spark, d, "eval_lines").select("line_id", "lang_dir", "fold")
    write_jsonl(x, path)
    return spark.read.schema(x.schema).json(path)


@query("SELECT vec_id, len(embedding) AS dim FROM sent_vectors WHERE len(embedding) = 128")
def q_checked_vectors(spark, d):
    from loomline.sources.sinks import checked_vectors

    return checked_vectors(table(spark, d, "sent_vectors").where("size(embedding) = 128"), "embedding", 128).select("vec_id", F.size("embedding").cast("long").alias("dim"))


@query("SELECT e.line_id, s.shard FROM eval_lines e, (SELECT unnest([0, 1, 2, 3]) AS shard) s")
def q_replicated_eval(spark, d):
    from loomline.sources.sinks import replicated

    return replicated(table(spark, d, "eval_lines").select("line_id"), 4)


# ---------------------------------------------------------------- pipelines


@query()
def q_monolingual(spark, d):
    return P.monolingual(table(spark, d, "documents"))


@query()
def q_bitext_filtering(spark, d):
    from loomline.operators import language as L
    from loomline.plans.more_queries import _LANGS

    model = L.fit_languages(table(spark, d, "documents"), "text", "lang", _LANGS)
    bad = ["idiot", "moron", "cretin", "loser", "stupid", "bastard"]
    return P.bitext_filtering(table(spark, d, "mining_lines"), model, _LANGS, words=(bad, bad), fuzzy=True)


@query(_knn_sql().replace("rn <= K", "rn <= 1").replace("margin >= 1.0", "margin >= 1.06").replace("round(margin, 9)", "margin") + """, a AS (SELECT * FROM f UNION ALL SELECT * FROM g)
SELECT x.corpus AS x_corpus, x.line_no AS x_line_no, y.corpus AS y_corpus, y.line_no AS y_line_no, max(score) AS score FROM a JOIN sent_vectors x ON x.vec_id = x_id JOIN sent_vectors y ON y.vec_id = y_id GROUP BY 1, 2, 3, 4""")
def q_global_mining(spark, d):
    return P.global_mining(table(spark, d, "neighbors"), table(spark, d, "sent_vectors"))


@query("WITH h AS (" + _held_sql("both", True) + """), n AS (SELECT lang_dir, count(*) AS n FROM h GROUP BY lang_dir), k AS (SELECT lang_dir, least(ceil(n / 250), ceil((SELECT sum(n) FROM n) / 5000))::BIGINT AS k FROM n)
SELECT h.lang_dir, ('0x' || substr(md5(line_id || ':0'), 1, 8))::BIGINT % k AS shard, line_id AS id FROM h JOIN k ON h.lang_dir = k.lang_dir""")
def q_prepare_data(spark, d):
    return P.prepare_data(table(spark, d, "train_lines"), table(spark, d, "eval_lines"))


from loomline.plans import more_queries as _more  # noqa: E402, F401  registers its queries
