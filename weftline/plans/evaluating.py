"""Queries on evaluation, language-model output, augmentation, filter configuration and registries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import align as A
from weftline.operators import catalog as K
from weftline.operators import clean as C
from weftline.operators import evaluate as V
from weftline.operators import logs as G
from weftline.operators import measure as N
from weftline.operators import rank as R
from weftline.operators import scorers as S
from weftline.plans.cleaning import COUNT, LINE, W, same
from weftline.plans.merging import GRAMS, MATCH, WORDS
from weftline.sources import derived as D

STEPS = [
    {"filter": "remove_empty_lines"},
    {"filter": "normalize_whitespace"},
    {"filter": "regexp", "parameters": {"pattern": "[0-9]+", "to": "7"}, "language": "trg"},
    {"filter": "max_length", "parameters": {"least": 1, "most": 60}},
    {"filter": "src_trg_ratio", "parameters": {"ratio": 0.4}},
]
MODELS = (0.15, 10.6)


def _events(spark, d):
    return D.read(spark, d, "events")


def _word(n):
    return F.element_at(F.array(*(F.lit(x) for x in ("flores", "mtdata", "sacrebleu", "tc", ""))), (n % 5 + 1).cast("int"))


def _corpus_bleu(spark, d):
    c = D.candidates(spark, d).where("rank < 2")
    return V.corpus_scores(c, "rank", metrics=("bleu",)).select("rank", "lines", F.round("bleu", 6).alias("bleu"))


def _corpus_chrf(spark, d):
    return V.corpus_scores(D.candidates(spark, d), "rank", metrics=("chrf",)).select("rank", F.round("chrf", 6).alias("chrf"))


def _metrics_files(spark, d):
    """Files of one to four lines, of which some are no numbers."""
    i = F.col("event_id")
    third = F.when(i % 3 == 0, F.concat(F.lit("\n0."), (i % 90 + 10).cast("string"))).otherwise("")
    text = F.concat((i % 50).cast("string"), F.lit(".5\n "), (i % 60).cast("string"), F.lit(".25 "), third, F.when(i % 7 == 0, "\n1\n2").otherwise("\nNo subsets"))
    s = V.metrics_file(text)
    return _events(spark, d).select("event_id", s["bleu_detok"].alias("bleu_detok"), s["chrf"].alias("chrf"), F.round(s["comet"], 6).alias("comet"))


def _metrics_names(spark, d):
    i = F.col("event_id")
    name = F.concat(_word(i), F.lit("_"), F.when(i % 4 == 0, "aug-mix_").otherwise(""), F.when(i % 11 == 0, "").otherwise(F.col("event_type")))
    return _events(spark, d).select("event_id", *(c.alias(k) for k, c in V.metrics_name(name).items()))


def _answers(spark, d):
    """Answers whose JSON stands bare, in a fence or with commas too many, and some that hold none."""
    i = F.col("event_id")
    body = F.concat(F.lit('{"score": '), (i % 5 + 1).cast("string"), F.lit(', "why": "'), "event_type", F.lit('"'), F.when(i % 2 == 0, ",").otherwise(""), F.lit("}"))
    text = F.when(i % 7 == 0, F.lit("no idea")).when(i % 3 == 0, F.concat(F.lit("Here it is:\n```json\n"), body, F.lit("\n```\nDone."))).otherwise(F.concat(F.lit("\n"), body))
    return _events(spark, d).select("event_id", V.parsed_answer(text, "score INT, why STRING").alias("x")).select("event_id", F.coalesce("x.score", F.lit(0)).alias("score"), "x.why")


def _generations(spark, d):
    flat = _events(spark, d).where(F.col("event_id") < F.floor(_events(spark, d).agg((F.max("event_id") + 1) / 4).scalar()) * 4)
    n = F.lit(4)
    g = V.grouped_generations(flat.select(F.col("event_id").alias("pos"), F.col("event_type").alias("text")), 4, 2**40)
    return g.select("input", F.array_join("candidates", "|").alias("candidates"), n.alias("n"))


def _evaluations(spark, d):
    e = _events(spark, d).where("event_id % 3 <> 0")
    return e.select(F.concat(F.lit("m"), (F.col("user_id") % 40).cast("string")).alias("model"), (F.col("event_id") % 11).alias("group"), F.col("event_id").alias("eval_id"), F.col("event_id").alias("created"))


def _fallback(spark, d):
    models = D.read(spark, d, "customer").select(F.concat(F.lit("m"), (F.col("c_custkey") % 45).cast("string")).alias("model"), (F.col("c_custkey") % 13).alias("group")).distinct()
    return V.with_fallback(models, _evaluations(spark, d)).withColumn("eval_id", F.coalesce("eval_id", F.lit(-1)))


def _external(spark, d):
    runs = D.read(spark, d, "customer").select("c_custkey", F.concat(F.lit("p"), (F.col("c_custkey") % 30).cast("string")).alias("langpair"))
    scores = D.read(spark, d, "supplier").groupBy(F.concat(F.lit("p"), (F.col("s_suppkey") % 25).cast("string")).alias("langpair"), F.concat(F.lit("g"), (F.col("s_nationkey") % 3).cast("string")).alias("scorer")).agg(F.max("s_suppkey").cast("double").alias("score"))
    x = V.with_external(runs, scores)
    shown = F.array_join(F.transform(F.map_entries("external"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("long").cast("string"))), ";")
    return x.select("c_custkey", "langpair", shown.alias("external"))


def _completed(spark, d):
    i = F.col("event_id")
    state = lambda k: F.when((i + k) % 3 == 0, "failed").otherwise("completed")
    runs = F.array(*(F.struct(state(k).alias("state"), (i * 10 + k).alias("resolved")) for k in range(3)))
    return _events(spark, d).select("event_id", F.coalesce(G.completed_at(F.when(i % 4 == 0, F.slice(runs, 1, 1)).otherwise(runs)), F.lit(-1)).alias("completed"))


def _chinese(spark, d):
    """Lines of which some end in characters of one script or of both."""
    n = F.col("line_no") % 4
    return D.pairs(spark, d).withColumn("src", F.concat("src", F.when(n == 1, "開門").when(n == 2, "开门").when(n == 3, "開门").otherwise("")))


def _hplt(spark, d, which):
    return C.collected_lines(D.scored_documents(spark, d), "en", 3.0, 400, 500)[which]


def _thresholded(spark, d):
    """Scores above 0.9, then all pairs with score 1, as a threshold of 0 has it."""
    p = D.pairs(spark, d).select(*LINE, "score")
    return C.threshold(p, 0.9).withColumn("part", F.lit("above")).unionByName(C.threshold(p, 0).withColumn("part", F.lit("all")))


def _currency(spark, d):
    p = D.pairs(spark, d).withColumns({"src": F.concat("src", F.when(F.col("line_no") % 3 == 0, " $5").otherwise("")), "trg": F.concat("trg", F.when(F.col("doc_id") % 2 == 0, " 5 USD").otherwise(" $5"))})
    return p.where(~C.currencies_match(F.col("src"), F.col("trg"))).select(*LINE)


def _wiki(spark, d):
    t = F.concat(F.lit("=="), F.lit(" "), "text", F.lit("[12] [[Page|shown]] [[Plain]] <code>x = 1</code> [https://e.org/a name] =="))
    return D.lines(spark, d).select(*LINE, C.fix_wiki(t).alias("text"))


def _scripts(spark, d):
    x = D.read(spark, d, "documents")
    return x.select("doc_id", *(c.alias(k) for k, c in S.script_of(F.col("lang")).items()))


def _symmetric(spark, d):
    """Two directions' alignments of each pair, drawn from its numbers, joined by intersection and union."""
    i, j = F.col("doc_id"), F.col("line_no")
    pair = lambda a, b: F.struct((a % 5).cast("int").alias("s"), (b % 5).cast("int").alias("t"))
    f, b = F.array(*(pair(i + k, j + 2 * k) for k in range(4))), F.array(*(pair(i + 2 * k, j + 4 * k) for k in range(4)))
    shown = lambda c: F.array_join(F.transform(F.array_sort(c), lambda p: F.concat_ws("-", p["s"].cast("string"), p["t"].cast("string"))), " ")
    return D.pairs(spark, d).select(*LINE, *(shown(A.symmetrize(F.array_distinct(f), F.array_distinct(b), how)).alias(how.replace("-", "_")) for how in ("intersect", "union")))


def _mixed(spark, d, what):
    p = D.pairs(spark, d).select("pos", "src", "trg")
    return {"mix": lambda: S.augment_mix(p, "pos", True, True), "noise": lambda: S.noise_pairs(p, "pos"), "typos": lambda: S.typos(p.select("pos", "src"), "src", "pos"), "inline": lambda: _inline(p)}[what]()


def _inline(p):
    aln = F.when(F.col("pos") % 3 > 0, F.array(F.struct(F.lit(0).alias("s"), F.lit(0).alias("t"))))
    a, b = S.inline_noise(F.col("src"), F.col("trg"), F.coalesce(aln, F.array().cast("array<struct<s:int,t:int>>")), F.col("pos"))
    return p.select("pos", a.alias("src"), b.alias("trg"))


QUERIES = {
    "corpus_bleu": _corpus_bleu,
    "corpus_chrf": _corpus_chrf,
    "sentence_chrf": lambda s, d: D.candidates(s, d).select("idx", "rank", F.round(R.candidate_score(F.col("hyp"), F.col("ref"), "chrf"), 6).alias("chrf")),
    "metrics_file_parse": _metrics_files,
    "metrics_name_parse": _metrics_names,
    "mean_scores": lambda s, d: V.mean_scores(_events(s, d).withColumn("comet", F.col("event_id") % 97 / 97.0), "event_type", "comet", "value"),
    "metricx_input": lambda s, d: D.pairs(s, d).select(*LINE, V.metricx_input(F.col("src"), F.col("trg")).alias("qe"), V.metricx_input(F.col("src"), F.col("trg"), F.col("src")).alias("ref")),
    "comet_delta": lambda s, d: _events(s, d).select("event_id", F.round(V.comet_delta(F.col("event_id") % 50 + 40.0, F.col("event_id") % 60 / 100.0), 6).alias("delta")),
    "throughput": lambda s, d: V.throughput(D.lines(s, d).withColumn("seconds", (F.col("doc_id") % 7).cast("double")), "lang", "text", "seconds").select("lang", *(F.round(c, 6).alias(c) for c in ("lines_per_second", "chars_per_second"))),
    "qe_argmin": lambda s, d: V.lowest_error(D.candidates(s, d).withColumn("error", ((F.col("idx") * 7 + F.col("rank") * 13) % 10).cast("double")), "idx", "rank", "error", "hyp"),
    "nbest_references": lambda s, d: V.with_references(D.candidates(s, d).select("idx", "rank", "hyp"), D.lines(s, d).where("line_no % 2 = 0").select(F.col("pos").alias("idx"), F.col("text").alias("ref"))),
    "group_generations": _generations,
    "llm_json": _answers,
    "llm_prompt": lambda s, d: D.lines(s, d).select(*LINE, V.prompt(F.col("text"), "English", "German", "reasoned").alias("prompt")),
    "token_cost": lambda s, d: V.token_cost(D.read(s, d, "conversations").select("role", F.length("text").cast("long").alias("tokens_in"), (F.col("turn") + 1).alias("tokens_out")), "role", "tokens_in", "tokens_out", *MODELS).withColumn("cost", F.round("cost", 8)),
    "group_metrics_table": lambda s, d: V.group_table(_events(s, d).select("event_id", F.col("user_id").cast("string").alias("model"), F.lit("flores").alias("importer"), F.col("event_type").alias("dataset"), F.lit(None).cast("string").alias("augmentation"), F.col("value").alias("bleu_detok"), (F.col("event_id") * 1.0).alias("chrf"), F.lit(None).cast("double").alias("comet")), "fi-en"),
    "published_values": lambda s, d: V.published(_events(s, d).select(F.col("event_id").alias("up"), F.col("value").alias("cost"), F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("gnorm")), "up", "train"),
    "eval_fallback": _fallback,
    "external_scores": _external,
    "completed_time": _completed,
    "chunk_number": lambda s, d: _events(s, d).select("event_id", F.coalesce(G.chunk_number(F.concat(F.lit("translate-mono-"), "event_type", F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit("-"), (F.col("event_id") % 20).cast("string"), F.when(F.col("event_id") % 3 == 1, "/20").otherwise(""))))), F.lit(-1)).alias("chunk")),
    "earliest_date": lambda s, d: _events(s, d).groupBy("user_id").agg(F.min("ts").alias("first")),
    "size_by_type": lambda s, d: D.read(s, d, "part").groupBy("p_brand").agg(F.sum("p_size").alias("size")),
    "total_sizes": lambda s, d: D.lines(s, d).groupBy("dataset").agg(F.sum(F.octet_length("text") + 1).alias("bytes"), F.count("*").alias("sentences")),
    "cluster_percentiles": lambda s, d: N.size_percentiles(N.cluster_sizes(_events(s, d), "user_id")).withColumn("size", F.round("size", 6)),
    "hplt_collect": lambda s, d: _hplt(s, d, 0),
    "hplt_counters": lambda s, d: _hplt(s, d, 1),
    "japanese_signs": lambda s, d: D.lines(s, d).select(*LINE, C.japanese_signs(F.concat("text", F.lit("今日!何?時:...。・・・ . . .，字,次.a"))).alias("text")),
    "chinese_pairs": lambda s, d: C.chinese_pairs(_chinese(s, d), "simplified").select(*LINE, "src", "trg"),
    "chinese_counts": lambda s, d: C.chinese_counts(_chinese(s, d), "simplified", "src"),
    "filter_pipeline": lambda s, d: C.filter_pipeline(D.pairs(s, d).select(*LINE, "src", "trg"), STEPS),
    "directed_pairs": lambda s, d: C.directed(D.pairs(s, d).select(*LINE, "src", "trg"), "en", "ru", "ru", "en"),
    "score_threshold": _thresholded,
    "currency_mismatch": _currency,
    "fix_wiki": _wiki,
    "alpha_ratio": lambda s, d: D.pairs(s, d).where(C.alpha_ok(F.col("src"), C.ALPHABETS["en"]) & C.alpha_ok(F.col("trg"), C.ALPHABETS["en"])).select(*LINE),
    "script_lookup": _scripts,
    "symmetrize": _symmetric,
    "symmetrize_grow": lambda s, d: A.grown(D.pairs(s, d).select("pos", F.concat_ws(" ", *(F.concat_ws("-", (F.col("doc_id") + k) % 4, (F.col("line_no") + k) % 4) for k in range(3))).alias("f"), F.concat_ws(" ", *(F.concat_ws("-", (F.col("doc_id") + k) % 4, (F.col("line_no") + 2 * k) % 4) for k in range(3))).alias("b")), "f", "b").select("pos", "alignment"),
    "debpe": lambda s, d: D.lines(s, d).select(*LINE, R.debpe(F.regexp_replace("text", "([a-z]{3})(?=[a-z])", "$1@@ ")).alias("text")),
    "wrap_tokens": lambda s, d: D.lines(s, d).select(*LINE, F.explode(A.wrap_tokens(T.words(F.col("text")), 9)).alias("w")).groupBy(*LINE, F.size("w").alias("tokens")).agg(F.count("*").alias("n")),
    "joined_sentences": lambda s, d: A.concatenated(D.lines(s, d).withColumn("gap", F.when(F.col("line_no") % 2 == 0, "  ").otherwise("\n")), "doc_id", "line_no", "text", "gap"),
    "sampled_rows": lambda s, d: A.rows_of(D.lines(s, d), D.lines(s, d).where("pos % 10 = 3").select("pos"), "pos").select(*LINE, "text"),
    "usable_entries": lambda s, d: K.without_tag(D.read(s, d, "documents").select("doc_id", F.array(F.col("lang"), F.when(F.col("doc_id") % 3 == 0, "task_categories:automatic-speech-recognition").otherwise("text")).alias("tags")), "automatic-speech-recognition").select("doc_id"),
    "language_tags": lambda s, d: D.read(s, d, "documents").select("doc_id", K.language_tags(F.array(F.concat(F.lit("language:"), "lang"), F.col("source"), F.when(F.col("doc_id") % 2 == 0, "language:xx").otherwise("size:1K"))).alias("languages")),
    "news_index": lambda s, d: D.read(s, d, "part").select("p_partkey", K.news_entries(F.concat(F.lit('<a href="news.'), (2007 + F.col("p_partkey") % 15).cast("string"), F.lit('.en.shuffled.deduped.gz">x</a></td><td align="right">'), (F.col("p_partkey") % 900).cast("string"), F.lit(".5"), F.element_at(F.array(F.lit("K"), F.lit("M"), F.lit("G")), (F.col("p_partkey") % 3 + 1).cast("int")), F.lit(" </td>"))).alias("e")).select("p_partkey", F.explode("e").alias("e")).select("p_partkey", "e.year", "e.bytes"),
    "config_merge": lambda s, d: D.read(s, d, "part").select("p_partkey", K.merged_config(K.arguments(F.concat(F.lit("--size "), F.col("p_size").cast("string"), F.lit(" --quiet"))), K.arguments(F.concat(F.lit("--size 7 --mini-batch "), (F.col("p_partkey") % 9).cast("string"), F.lit(" --devices 0 1")))).alias("m")).select("p_partkey", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";").alias("config")),
    "augment_mix": lambda s, d: _mixed(s, d, "mix"),
    "augment_noise": lambda s, d: _mixed(s, d, "noise"),
    "augment_typos": lambda s, d: _mixed(s, d, "typos"),
    "augment_inline_noise": lambda s, d: _mixed(s, d, "inline"),
}

_SUM = ", ".join(f"sum(m{n}) AS m{n}, sum(len(h{n})) AS c{n}" for n in range(1, 5))
_JA = r"[\x{3040}-\x{309F}\x{30A0}-\x{30FF}\x{FF00}-\x{FFEF}\x{4E00}-\x{9FAF}\x{3000}-\x{303F}\x{3400}-\x{4DBF}"
_STEPS = [(rf"({_JA}?])!", r"\1！"), (rf"({_JA}?])\?", r"\1？"), (rf"({_JA}?]):", r"\1："), (r"\.\.\.。", "..."), ("・・・", "…"), (r"\. ?\. ?\. ?", "…"), ("，", "、"), (rf"{_JA}],", "、"), (rf"{_JA}]\.\b", "。")]
_ja = "text || '今日!何?時:...。・・・ . . .，字,次.a'"
for _p, _t in _STEPS:
    _ja = f"regexp_replace({_ja}, '{_p}', '{_t}', 'g')"
CHINESE = f"WITH {D.PAIRS}, Z AS (SELECT doc_id, line_no, src || (['', '開門', '开门', '開门'])[line_no % 4 + 1] AS src, trg, line_no % 4 AS n FROM P)"
_ALPHA = lambda c: f"len(regexp_extract_all({c}, '(?:^|[{W}])[A-Za-z]'))::DOUBLE / greatest({COUNT(c)}, 1) >= 0.4 AND len(regexp_extract_all({c}, '[A-Za-z]'))::DOUBLE / greatest(len(replace({c}, ' ', '')), 1) >= 0.5"
_STRIPPED = lambda c: rf"regexp_replace({c}, '^[{W}]+|[{W}]+$', '', 'g')"
_CUR = r"[$€£¥₽₹₩]|\b(?:USD|EUR|GBP|JPY|RUB|CHF)\b"
_LANGS = "(VALUES ('en', 'eng_Latn'), ('de', 'deu_Latn'), ('fr', 'fra_Latn'), ('es', 'spa_Latn')) AS s(lang, hplt)"

ORACLES = {
    "corpus_bleu": f"""WITH {D.CANDIDATES}, X AS (SELECT idx, rank, {WORDS('hyp')} AS h, {WORDS('ref')} AS r FROM N WHERE rank < 2), G AS (SELECT *, {GRAMS.format('h')}, {GRAMS.format('r')} FROM X), MM AS (SELECT *, {MATCH} FROM G),
S AS (SELECT rank, count(*) AS lines, sum(len(h)) AS hl, sum(len(r)) AS rl, {_SUM} FROM MM GROUP BY rank)
SELECT rank, lines, round(CASE WHEN least(m1, m2, m3, m4) = 0 THEN 0 ELSE 100 * CASE WHEN hl > rl THEN 1 ELSE exp(1 - rl::DOUBLE / hl) END * exp((ln(m1::DOUBLE / c1) + ln(m2::DOUBLE / c2) + ln(m3::DOUBLE / c3) + ln(m4::DOUBLE / c4)) / 4) END, 6) AS bleu FROM S""",
    "metrics_file_parse": "SELECT event_id, CASE WHEN n THEN event_id % 50 + 0.5::DOUBLE END AS bleu_detok, CASE WHEN n THEN event_id % 60 + 0.25::DOUBLE END AS chrf, CASE WHEN n AND event_id % 3 = 0 THEN round((event_id % 90 + 10) / 100.0::DOUBLE * 100, 6) END AS comet FROM (SELECT *, event_id % 7 <> 0 AS n FROM events)",
    "metrics_name_parse": "SELECT event_id, CASE WHEN ok THEN i END AS importer, CASE WHEN ok AND event_id % 4 = 0 THEN 'aug-mix' END AS augmentation, CASE WHEN ok THEN event_type END AS dataset FROM (SELECT *, (['flores', 'mtdata', 'sacrebleu', 'tc', ''])[event_id % 5 + 1] AS i, event_id % 5 < 3 AND event_id % 11 <> 0 AS ok FROM events)",
    "mean_scores": "SELECT event_type, round(avg(event_id % 97 / 97.0::DOUBLE) * 100, 4) AS comet, round(avg(value), 2) AS metricx FROM events GROUP BY 1",
    "metricx_input": f"WITH {D.PAIRS} SELECT doc_id, line_no, 'source: ' || src || ' candidate: ' || trg AS qe, 'source: ' || src || ' candidate: ' || trg || ' reference: ' || src AS ref FROM P",
    "comet_delta": "SELECT event_id, round(100 * (1 - (event_id % 60 / 100.0::DOUBLE) / ((event_id % 50 + 40) / 100.0::DOUBLE)), 6) AS delta FROM events",
    "throughput": f"WITH {D.LINES} SELECT lang, round(count(*) / sum(doc_id % 7), 6) AS lines_per_second, round(sum(len(text)) / sum(doc_id % 7), 6) AS chars_per_second FROM L GROUP BY lang",
    "qe_argmin": f"WITH {D.CANDIDATES}, E AS (SELECT idx, rank, hyp, ((idx * 7 + rank * 13) % 10)::DOUBLE AS error FROM N) SELECT idx, hyp, error FROM (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY error, rank) AS rn FROM E) WHERE rn = 1",
    "nbest_references": f"WITH {D.CANDIDATES} SELECT N.idx, N.rank, N.hyp, L.text AS ref FROM N JOIN L ON L.pos = N.idx AND L.line_no % 2 = 0",
    "group_generations": "SELECT event_id // 4 AS input, string_agg(event_type, '|' ORDER BY event_id) AS candidates, 4 AS n FROM events WHERE event_id < (SELECT (max(event_id) + 1) // 4 * 4 FROM events) GROUP BY 1",
    "llm_json": "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_id % 5 + 1 ELSE 0 END::INT AS score, CASE WHEN event_id % 7 <> 0 THEN event_type END AS why FROM events",
    "llm_prompt": f"WITH {D.LINES} SELECT doc_id, line_no, 'You translate from English to German. Think about terms and tone first, then write the translation as the last line of your answer.' || chr(10) || chr(10) || text AS prompt FROM L",
    "token_cost": f"SELECT role, sum(len(text))::BIGINT AS tokens_in, sum(turn + 1)::BIGINT AS tokens_out, round((sum(len(text)) * {MODELS[0]} + sum(turn + 1) * {MODELS[1]}) / 1000000.0::DOUBLE, 8) AS cost FROM conversations GROUP BY role",
    "group_metrics_table": """SELECT 'fi-en' AS "Group", user_id::VARCHAR AS "Model", 'flores' AS "Importer", event_type AS "Dataset", NULL::VARCHAR AS "Augmentation", value AS bleu_detok, event_id::DOUBLE AS chrf, NULL::DOUBLE AS comet FROM events""",
    "published_values": "SELECT event_id AS step, 'train/cost' AS key, value FROM events WHERE value IS NOT NULL UNION ALL SELECT event_id, 'train/gnorm', user_id::DOUBLE FROM events WHERE event_id % 3 = 0",
    "eval_fallback": "WITH M AS (SELECT DISTINCT 'm' || (c_custkey % 45) AS model, c_custkey % 13 AS grp FROM customer), E AS (SELECT 'm' || (user_id % 40) AS model, event_id % 11 AS grp, event_id FROM events WHERE event_id % 3 <> 0) SELECT model, grp AS \"group\", coalesce((SELECT max(event_id) FROM E WHERE E.model = M.model AND E.grp = M.grp), (SELECT max(event_id) FROM E WHERE E.model = M.model), -1) AS eval_id FROM M",
    "external_scores": "WITH S AS (SELECT 'p' || (s_suppkey % 25) AS langpair, 'g' || (s_nationkey % 3) AS scorer, max(s_suppkey) AS score FROM supplier GROUP BY 1, 2), X AS (SELECT langpair, string_agg(scorer || '=' || score, ';' ORDER BY scorer) AS external FROM S GROUP BY 1) SELECT c_custkey, 'p' || (c_custkey % 30) AS langpair, coalesce(external, '') AS external FROM customer LEFT JOIN X ON X.langpair = 'p' || (c_custkey % 30)",
    "completed_time": "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN CASE WHEN event_id % 3 <> 0 THEN event_id * 10 ELSE -1 END WHEN (event_id + 2) % 3 <> 0 THEN event_id * 10 + 2 ELSE event_id * 10 + 1 END AS completed FROM events",
    "chunk_number": "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_id % 20 ELSE -1 END AS chunk FROM events",
    "earliest_date": "SELECT user_id, min(ts) AS first FROM events GROUP BY user_id",
    "size_by_type": "SELECT p_brand, sum(p_size)::BIGINT AS size FROM part GROUP BY 1",
    "total_sizes": f"WITH {D.LINES} SELECT dataset, sum(strlen(text) + 1)::BIGINT AS bytes, count(*) AS sentences FROM L GROUP BY dataset",
    "cluster_percentiles": "WITH S AS (SELECT count(*) AS n FROM events GROUP BY user_id), P AS (SELECT [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]::DOUBLE[] AS p, quantile_cont(n, [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]) AS q FROM S) SELECT unnest(p) AS point, round(unnest(q)::DOUBLE, 6) AS size FROM P",
    "japanese_signs": f"WITH {D.LINES} SELECT doc_id, line_no, {_ja} AS text FROM L",
    "chinese_pairs": CHINESE + " SELECT doc_id, line_no, src, trg FROM Z WHERE n = 2",
    "chinese_counts": CHINESE + " SELECT count(*) AS visited, count(*) FILTER (n IN (1, 3)) AS converted, count(*) FILTER (n = 2) AS simplified, count(*) FILTER (n = 1) AS traditional, count(*) FILTER (n = 3) AS both, count(*) FILTER (n = 0) AS none FROM Z",
    "filter_pipeline": f"WITH {D.PAIRS}, A AS (SELECT doc_id, line_no, regexp_replace(src, '[{W}]+', ' ', 'g') AS src, regexp_replace(regexp_replace(trg, '[{W}]+', ' ', 'g'), '[0-9]+', '7', 'g') AS trg FROM P WHERE src <> '' AND trg <> '') SELECT * FROM A WHERE {COUNT('src')} BETWEEN 1 AND 60 AND {COUNT('trg')} BETWEEN 1 AND 60 AND least(len(src), len(trg)) >= greatest(len(src), len(trg)) * 0.4",
    "directed_pairs": f"WITH {D.PAIRS} SELECT doc_id, line_no, trg AS src, src AS trg FROM P",
    "score_threshold": f"WITH {D.PAIRS} SELECT doc_id, line_no, score, 'above' AS part FROM P WHERE score > 0.9 UNION ALL SELECT doc_id, line_no, 1.0::DOUBLE, 'all' FROM P",
    "currency_mismatch": f"WITH {D.PAIRS}, U AS (SELECT doc_id, line_no, src || CASE WHEN line_no % 3 = 0 THEN ' $5' ELSE '' END AS src, trg || CASE WHEN doc_id % 2 = 0 THEN ' 5 USD' ELSE ' $5' END AS trg FROM P) SELECT doc_id, line_no FROM U WHERE NOT ({same(_CUR)})",
    "alpha_ratio": f"WITH {D.PAIRS}, A AS (SELECT doc_id, line_no, {_STRIPPED('src')} AS src, {_STRIPPED('trg')} AS trg FROM P) SELECT doc_id, line_no FROM A WHERE {_ALPHA('src')} AND {_ALPHA('trg')}",
    "script_lookup": f"SELECT doc_id, hplt, 'Latin' AS script, 'alphabetic' AS kind, true AS bicameral, true AS phonemic FROM documents JOIN {_LANGS} USING (lang)",
    "symmetrize": f"""WITH {D.PAIRS}, X AS (SELECT doc_id, line_no, list_distinct(list_transform(range(4), lambda k: ((doc_id + k) % 5) || '-' || ((line_no + 2 * k) % 5))) AS f, list_distinct(list_transform(range(4), lambda k: ((doc_id + 2 * k) % 5) || '-' || ((line_no + 4 * k) % 5))) AS b FROM P)
SELECT doc_id, line_no, array_to_string(list_sort(list_intersect(f, b)), ' ') AS intersect, array_to_string(list_sort(list_distinct(list_concat(f, b))), ' ') AS union FROM X""",
    "debpe": f"WITH {D.LINES} SELECT doc_id, line_no, text FROM L",
    "wrap_tokens": f"WITH {D.LINES}, C AS (SELECT doc_id, line_no, len({WORDS('text')}) AS n FROM L), X AS (SELECT doc_id, line_no, 8 AS tokens, n // 8 AS n FROM C UNION ALL SELECT doc_id, line_no, n % 8, 1 FROM C WHERE n % 8 > 0 OR n = 0) SELECT doc_id, line_no, tokens::INT AS tokens, n FROM X WHERE n > 0",
    "joined_sentences": f"WITH {D.LINES}, M AS (SELECT doc_id, max(line_no) AS last FROM L GROUP BY 1) SELECT L.doc_id, string_agg(text || CASE WHEN line_no = last THEN '' WHEN line_no % 2 = 0 THEN '  ' ELSE chr(10) END, '' ORDER BY line_no) AS faithful, string_agg(text, ' ' ORDER BY line_no) AS spaced FROM L JOIN M ON L.doc_id = M.doc_id GROUP BY 1",
    "sampled_rows": f"WITH {D.LINES} SELECT doc_id, line_no, text FROM L WHERE pos % 10 = 3",
    "usable_entries": "SELECT doc_id FROM documents WHERE doc_id % 3 <> 0",
    "language_tags": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END AS languages FROM documents",
    "news_index": "SELECT p_partkey, 2007 + p_partkey % 15 AS year, round((p_partkey % 900 + 0.5) * ([1000, 1000000, 1000000000])[p_partkey % 3 + 1])::BIGINT AS bytes FROM part",
    "config_merge": "SELECT p_partkey, 'devices=0,1;mini-batch=' || (p_partkey % 9) || ';quiet=true;size=7' AS config FROM part",
}
