"""Queries on logs, labels, catalogues, models, pages and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import align as A
from weftline.operators import catalog as C
from weftline.operators import logs as G
from weftline.operators import evaluate as V
from weftline.operators import merge as M
from weftline.operators import scorers as S
from weftline.sources import derived as D
from weftline.streaming import events as E


def _values(columns: str, rows: list[tuple]) -> str:
    def one(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(one(x) for x in v) + "]"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return f"({columns}) AS (VALUES " + ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows) + ")"


#: How the tables are told as tasks, runs, models and catalogues: by the same rules in DataFrames and in SQL.
MODELS_OF = ("student", "teacher", "teacher-base", "student-finetuned", "backward", "quantized", "distillation-student-model-train")
CALLED = ("student", "teacher", "teacher-base", "student-finetune", "backwards", "quantized", "student")
SETS = ("flores", "mtdata", "sacrebleu")


def _pick(names, at):
    return F.get(F.array(*(F.lit(n) for n in names)), F.pmod(at, F.lit(len(names))).cast("int"))


def _picked(names, at: str) -> str:
    return f"([{', '.join(repr(n) for n in names)}])[({at}) % {len(names)} + 1]"


def _label_rows(spark, d):
    """(event_id, label): labels of training tasks, of evaluations and of neither, from events."""
    i = F.col("event_id")
    number = F.when(i % 4 == 1, F.concat(F.lit("-"), (i % 9 + 1).cast("string"))).otherwise("")
    train = F.concat(F.when(i % 2 == 0, F.lit("train-")).otherwise(""), _pick(MODELS_OF, i), F.lit("-en-hu"), number)
    importer = _pick(SETS, F.floor(i / 7))
    twice = F.when(i % 2 == 0, F.concat(F.lit("-"), importer)).otherwise("")
    aug = F.when(i % 5 == 0, F.lit("aug-mix_")).otherwise("")
    test = F.concat(F.when(i % 8 < 4, F.lit("evaluate-")).otherwise("eval_"), _pick(MODELS_OF[:6], i), F.lit("-"), importer, twice, F.lit("_"), aug, "event_type", F.lit("-en-hu"), number, F.when(i % 4 == 1, F.lit("_9")).otherwise(""))
    other = F.concat(F.lit("bicleaner-"), "event_type")
    return D.read(spark, d, "events").select("event_id", F.when(i % 3 == 0, train).when(i % 3 == 1, test).otherwise(other).alias("label"))


LABEL_SQL = f"""B AS (SELECT event_id, event_type, event_id % 3 AS kind, {_picked(CALLED, "event_id")} AS trained, {_picked(CALLED[:6], "event_id")} AS tested, {_picked(SETS, "event_id // 7")} AS importer,
  CASE WHEN event_id % 4 = 1 THEN (event_id % 9 + 1)::VARCHAR END AS number FROM events),
K AS (SELECT event_id, CASE kind WHEN 0 THEN trained WHEN 1 THEN tested END AS called, number, CASE WHEN kind = 1 THEN importer END AS importer, CASE WHEN kind = 1 THEN event_type END AS dataset, CASE WHEN kind = 1 AND event_id % 5 = 0 THEN 'aug-mix' END AS augmentation FROM B),
J AS (SELECT event_id, CASE WHEN called IS NULL THEN NULL WHEN number IS NOT NULL THEN called || '-' || number WHEN called = 'teacher' THEN 'teacher-1' ELSE called END AS model, importer, dataset, augmentation FROM K)"""


def _tasks(spark, d):
    """(task_id, label, states, created): events as tasks of 40 labels, with one to three runs."""
    i = F.col("event_id")
    last = F.when(i % 5 == 0, "failed").when(i % 7 == 0, "exception").otherwise("completed")
    states = F.when(i % 2 == 0, F.array(F.lit("failed"), last)).otherwise(F.array(last))
    return D.read(spark, d, "events").select(i.cast("string").alias("task_id"), F.concat(F.when(i % 3 == 0, F.lit("train-")).otherwise("score-"), "event_type", F.lit("-"), (F.col("user_id") % 4).cast("string")).alias("label"), states.alias("states"), (i * 7919 % 100_003).alias("created"))


TASK_SQL = "T AS (SELECT event_id::VARCHAR AS task_id, CASE WHEN event_id % 3 = 0 THEN 'train-' ELSE 'score-' END || event_type || '-' || (user_id % 4) AS label, event_id % 5 <> 0 AND event_id % 7 <> 0 AS done, event_id * 7919 % 100003 AS created FROM events)"


def _training(spark, d):
    """(task_id, model): orders as training tasks."""
    return D.read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("task_id"), F.concat(F.lit("m"), (F.col("o_custkey") % 50).cast("string")).alias("model"))


def _evals(spark, d):
    """(eval_id, model, dependencies): events as evaluations, each of two tasks."""
    i = F.col("event_id")
    return D.read(spark, d, "events").select(i.cast("string").alias("eval_id"), F.concat(F.lit("m"), (F.col("user_id") % 60).cast("string")).alias("model"), F.array(i.cast("string"), (i + 1).cast("string")).alias("dependencies"))


RUN_SQL = "T AS (SELECT o_orderkey::VARCHAR AS task_id, 'm' || (o_custkey % 50) AS model FROM orders), E AS (SELECT event_id::VARCHAR AS eval_id, 'm' || (user_id % 60) AS model, event_id AS i FROM events)"


def _catalog(spark, d):
    """(name, sentences, size_class, downloads): parts as corpora; some names are listed, some too long."""
    k, listed = F.col("p_partkey"), F.concat(_pick(C.SKIPPED, F.col("p_partkey")), F.lit("/v"), (F.col("p_partkey") % 3).cast("string"))
    plain = F.concat(F.lit("corpus-"), F.translate((k % 97).cast("string"), "0123456789", "abcdefghij"), F.when(k % 11 == 0, F.repeat(F.lit("x"), F.lit(90))).otherwise(""), F.when(k % 13 == 0, F.lit("-newstest")).otherwise(""), F.when(k % 2 == 0, F.lit("_train-1-eng-fin")).otherwise("/v1"))
    return D.read(spark, d, "part").select("p_partkey", F.when(k % 17 == 0, listed).otherwise(plain).alias("name"), (k * 37 % 5000).alias("sentences"), (k % 4).alias("size_class"), (k * 31 % 1009).alias("downloads"))


_NAME = "CASE WHEN p_partkey % 17 = 0 THEN " + _picked(C.SKIPPED, "p_partkey") + " || '/v' || (p_partkey % 3) ELSE 'corpus-' || translate((p_partkey % 97)::VARCHAR, '0123456789', 'abcdefghij') || CASE WHEN p_partkey % 11 = 0 THEN repeat('x', 90) ELSE '' END || CASE WHEN p_partkey % 13 = 0 THEN '-newstest' ELSE '' END || CASE WHEN p_partkey % 2 = 0 THEN '_train-1-eng-fin' ELSE '/v1' END END"
CATALOG_SQL = f"K AS (SELECT p_partkey, {_NAME} AS name, p_partkey * 37 % 5000 AS sentences, p_partkey % 4 AS size_class, p_partkey * 31 % 1009 AS downloads FROM part)"


def _models(spark, d):
    """(src, trg, version, channel): suppliers' parts as models of 30 languages into and out of English."""
    k, other = F.col("p_partkey"), F.concat(F.lit("l"), (F.col("p_partkey") % 30).cast("string"))
    version = F.concat_ws(".", (k % 3 + 1).cast("string"), (k % 12).cast("string"), F.when(k % 5 == 0, F.concat((k % 4).cast("string"), F.lit("a"), (k % 3).cast("string"))))
    return D.read(spark, d, "part").select(F.when(k % 2 == 0, "en").otherwise(other).alias("src"), F.when(k % 2 == 0, other).otherwise("en").alias("trg"), version.alias("version"), F.when(k % 7 < 3, "release").otherwise("nightly").alias("channel"))


MODEL_SQL = "M AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'en' ELSE 'l' || (p_partkey % 30) END AS src, CASE WHEN p_partkey % 2 = 0 THEN 'l' || (p_partkey % 30) ELSE 'en' END AS trg, (p_partkey % 3 + 1) || '.' || (p_partkey % 12) || CASE WHEN p_partkey % 5 = 0 THEN '.' || (p_partkey % 4) || 'a' || (p_partkey % 3) ELSE '' END AS version, CASE WHEN p_partkey % 7 < 3 THEN 'release' ELSE 'nightly' END AS channel FROM part), ML AS (SELECT *, CASE WHEN src = 'en' THEN trg ELSE src END AS lang FROM M)"
FILES = ("model.npz", "vocab.spm", "valid.log", "optimizer.npz")


def _runs(spark, d):
    """(run_id, artifacts): customers as runs that hold some files."""
    k = F.col("c_custkey")
    held = F.array_compact(F.array(*(F.when(k % m != 0, F.lit(f)) for f, m in zip(FILES, (2, 3, 5, 7), strict=True))))
    return D.read(spark, d, "customer").select(F.lpad(k.cast("string"), 9, "0").alias("run_id"), held.alias("artifacts"))


def _with_lang(models):
    return models.withColumn("lang", F.when(F.col("src") == "en", F.col("trg")).otherwise(F.col("src")))


def _training_lines(spark, d):
    """Events written as a trainer's log."""
    e = D.read(spark, d, "events").where("value IS NOT NULL").select("event_id", "user_id", F.round("value", 2).alias("value"))
    n = F.concat(F.lit("1,"), F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0"))
    text = F.concat(F.lit("[2024-01-01 00:00:00] Ep. "), F.floor(F.col("event_id") / 100).cast("string"), F.lit(" : Up. "), F.col("event_id").cast("string"), F.lit(" : Sen. "), n, F.lit(" : Cost "), F.col("value").cast("decimal(20,2)").cast("string"), F.lit(" : Time 12.50s : 900.00 words/s : gNorm 0.5000"))
    text = F.concat(text, F.when(F.col("event_id") % 2 == 0, " : L.r. 3.0e-04").otherwise(""))
    return e.select("event_id", "user_id", text.alias("text"))


TRAIN_SQL = "E AS (SELECT event_id, user_id, round(value, 2)::DECIMAL(20,2) AS v FROM events WHERE value IS NOT NULL)"
KEYS = ("chrf", "ce-mean-words", "bleu-detok", "perplexity")


def _validation_lines(spark, d):
    e = D.read(spark, d, "events").where("value IS NOT NULL")
    key = F.get(F.array(*(F.lit(k) for k in KEYS)), (F.col("event_id") % 4).cast("int"))
    stalled = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" : stalled "), (F.col("event_id") % 7).cast("string"), F.lit(" times"))).otherwise(" : new best")
    text = F.concat(F.lit("[2024-01-01 00:00:00] [valid] Ep. "), F.floor(F.col("event_id") / 100).cast("string"), F.lit(" : Up. "), F.floor(F.col("event_id") / 6).cast("string"), F.lit(" : "), key, F.lit(" : "), F.round("value", 2).cast("decimal(20,2)").cast("string"), stalled)
    return e.select("event_id", "ts", text.alias("text"))


VALID_SQL = "V AS (SELECT event_id, event_id // 100 AS epoch, event_id // 6 AS up, (['chrf','ce_mean_words','bleu_detok','perplexity'])[(event_id % 4) + 1] AS key, abs(round(value, 2)::DECIMAL(20,2))::DOUBLE AS value, CASE WHEN event_id % 3 = 0 THEN event_id % 7 END AS stalled, value AS raw FROM events WHERE value IS NOT NULL)"


def _marker_lines(spark, d):
    x = D.lines(spark, d).withColumn("text", F.when(F.col("line_no") == 1, F.concat(F.lit("[task 2024-01-01T00:00:00.000Z] [marian] "), "text")).otherwise(F.concat(F.lit("[task 2024-01-01T00:00:00.000Z] "), "text")))
    return G.from_marker(x, "doc_id", "line_no").select("doc_id", "line_no", "text")


def _metric_lines(spark, d):
    e = D.read(spark, d, "events").where("value IS NOT NULL")
    text = F.when(F.col("event_id") % 5 == 0, "+ tee metrics").otherwise(F.round(F.abs("value"), 2).cast("decimal(20,2)").cast("string"))
    return G.metrics_after(e.select("user_id", "event_id", text.alias("text")), "user_id", "event_id", "^\\+ tee")


def _labels(spark, d):
    return G.parsed_labels(_label_rows(spark, d)).drop("label")


def _metrics(spark, d):
    """Events as metrics of five models, read from two sources."""
    e = D.read(spark, d, "events").where("value IS NOT NULL").select(F.concat(F.lit("m"), (F.col("user_id") % 5).cast("string")).alias("model"), F.lit("flores").alias("importer"), F.col("event_type").alias("dataset"), F.when(F.col("event_id") % 2 == 0, "aug-mix").alias("augmentation"), F.round("value", 1).alias("bleu_detok"), (F.col("event_id") % 70).cast("double").alias("chrf"), "event_id")
    return G.metrics_by_model(e.where("event_id % 2 = 0").drop("event_id"), e.where("event_id % 2 = 1").drop("event_id"))


def _llm_last(spark, d):
    """The last line of an answer, between white space of all kinds."""
    text = F.concat(F.lit(" \n\t"), "text", F.when(F.col("turn") % 2 == 0, F.lit(" \n\r\n\t ")).otherwise(""))
    return D.read(spark, d, "conversations").select("conv_id", "turn", T.last_line(text).alias("answer"))


def _eval_rows(spark, d):
    """Rows of the evaluations among the labels, with both scores, which are on the lines of a metrics file."""
    x = G.parsed_labels(_label_rows(spark, d).where(F.col("label").rlike("^eval")))
    text = F.concat((F.col("event_id") % 60).cast("string"), F.lit(".5\n"), (F.col("event_id") % 80).cast("string"), F.lit(".25\nno subsets"))
    s = V.metrics_file(text)
    return x.select("event_id", "model", F.concat_ws("_", "importer", "dataset").alias("dataset"), F.col("augmentation").alias("aug"), s["bleu_detok"].alias("bleu"), s["chrf"].alias("chrf"))


def _html(spark, d):
    return D.read(spark, d, "pages").select("page_id", A.extract_text(F.col("html")).alias("x")).select("page_id", "x.text", "x.well_formed")


def _map(spark, d):
    x = D.lines(spark, d)
    tokens = F.array_join(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"), F.lit(0)), " ")
    return x.select("doc_id", "line_no", A.map_indices(tokens, F.col("text")).alias("map"))


def _cached(spark, d):
    """A deterministic stand-in translates each distinct line once."""
    return A.distinct_then_join(D.lines(spark, d).select("pos", "text"), "text", S.DigestScorer(3), "score").select("pos", "score")


def _remap(spark, d):
    x = D.pairs(spark, d).select("pos", F.concat_ws(" ", *(F.concat_ws("-", (F.col("pos") + i) % 3, (F.col("line_no") + i) % 3) for i in range(4))).alias("aln"))
    m = F.array(F.lit(0), F.lit(0), F.lit(1))
    out = A.remap(A.parse_alignment(F.col("aln")), m, m)
    return x.select("pos", F.array_join(F.transform(out, lambda p: F.concat_ws("-", p["s"].cast("string"), p["t"].cast("string"))), " ").alias("aln"))


def _wall(spark, d):
    e = D.read(spark, d, "events").select("user_id", "event_id", F.unix_timestamp("ts").alias("at"))
    return G.gap_corrected(e, "user_id", "event_id", "at").withColumn("wall", F.round("wall", 4))


QUERIES = {
    "parse_training_log": lambda s, d: G.training_epochs(_training_lines(s, d)).select("event_id", "epoch", "up", "sen", "cost", "time", "rate", "gnorm", "learning_rate"),
    "parse_validation_log": lambda s, d: G.validation_values(_validation_lines(s, d)).select("event_id", "epoch", "up", "key", "value", F.coalesce("stalled", F.lit(0)).alias("stalled")),
    "validation_assemble": lambda s, d: G.assembled(G.validation_values(_validation_lines(s, d))),
    "log_deltas": lambda s, d: G.deltas(D.read(s, d, "events").select("user_id", "event_id"), "user_id", "event_id", "event_id").withColumn("delta", F.coalesce("delta", F.lit(0))),
    "metrics_from_log": _metric_lines,
    "log_from_marker": _marker_lines,
    "wall_clock_gaps": _wall,
    "parse_task_label": _labels,
    "latest_task": lambda s, d: G.latest_task(_tasks(s, d), "^train"),
    "earliest_task": lambda s, d: G.latest_task(_tasks(s, d), "^train", earliest=True),
    "runs_with_metrics": lambda s, d: G.runs_with_metrics(_training(s, d), _evals(s, d)),
    "missing_runs": lambda s, d: G.missing_runs(_evals(s, d), _training(s, d)),
    "metrics_by_model": _metrics,
    "eval_rows": _eval_rows,
    "resumable_run": lambda s, d: G.resumable_run(_runs(s, d), [["model.npz", "vocab.spm"], ["model.npz", "other"]]),
    "registry_search": lambda s, d: C.search(_models(s, d), 'en src:en -channel:nightly unknown:x "rel"'),
    "catalog_skip_reason": lambda s, d: _catalog(s, d).select("p_partkey", "name", C.skip_reason(F.col("name"), F.col("sentences")).alias("reason")),
    "catalog_antijoin": lambda s, d: C.not_visited(_catalog(s, d), _catalog(s, d).where("p_partkey % 29 = 3")).select("p_partkey", "name"),
    "catalog_sort": lambda s, d: C.by_size(_catalog(s, d), "p_partkey").select("p_partkey", "place"),
    "version_sort": lambda s, d: C.latest_versions(_with_lang(_models(s, d))),
    "model_pairs": lambda s, d: C.model_pairs(_models(s, d)),
    "language_counts": lambda s, d: C.language_counts(_with_lang(_models(s, d))),
    "record_sync": lambda s, d: M.record_sync(D.read(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("id")), D.read(s, d, "events").select(F.col("event_id").cast("string").alias("id"))),
    "llm_last_line": _llm_last,
    "html_extract_text": _html,
    "map_indices": _map,
    "alignment_remap": _remap,
    "cached_translate": _cached,
    "ext_events_tumbling": lambda s, d: E.windows(D.read(s, d, "events"), "1 hour").withColumn("total", F.round("total", 4)),
    "ext_events_sliding": lambda s, d: E.windows(D.read(s, d, "events"), "1 hour", "30 minutes").withColumn("total", F.round("total", 4)),
    "ext_events_session": lambda s, d: E.sessions(D.read(s, d, "events")),
}

NORMAL = r"regexp_replace(regexp_replace(lower(regexp_replace(name, '-\w{3}-\w{3}$', '')), '[^a-z]', '', 'g'), 'train$', '')"
WINDOW = "time_bucket(INTERVAL '{}', ts, TIMESTAMP '1970-01-01')"

ORACLES = {
    "parse_training_log": f"WITH {TRAIN_SQL} SELECT event_id, event_id // 100 AS epoch, event_id AS up, 1000 + event_id % 1000 AS sen, v::DOUBLE AS cost, 12.5::DOUBLE AS time, 900.0::DOUBLE AS rate, 0.5::DOUBLE AS gnorm, CASE WHEN event_id % 2 = 0 THEN 0.0003::DOUBLE END AS learning_rate FROM E WHERE v >= 0",
    "parse_validation_log": f"WITH {VALID_SQL} SELECT event_id, epoch, up, key, value, coalesce(stalled, 0) AS stalled FROM V WHERE raw >= 0",
    "validation_assemble": f"WITH {VALID_SQL}, A AS (SELECT epoch, up, " + ", ".join(f"max(value) FILTER (key = '{k}') AS {k}" for k in ("chrf", "ce_mean_words", "bleu_detok", "perplexity")) + " FROM V GROUP BY 1, 2) SELECT * FROM A WHERE chrf IS NOT NULL AND ce_mean_words IS NOT NULL AND bleu_detok IS NOT NULL",
    "log_deltas": "SELECT user_id, event_id, coalesce(event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS delta FROM events",
    "metrics_from_log": "WITH E AS (SELECT user_id, event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE round(abs(value), 2)::DOUBLE END AS v FROM events WHERE value IS NOT NULL), L AS (SELECT *, lead(v, 1) OVER w AS b, lead(v, 2) OVER w AS c FROM E WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT user_id, arg_min(b, event_id) AS bleu_detok, arg_min(c, event_id) AS chrf FROM L WHERE v IS NULL AND b IS NOT NULL AND c IS NOT NULL GROUP BY user_id",
    "log_from_marker": f"WITH {D.LINES} SELECT doc_id, line_no, CASE WHEN line_no = 1 THEN '[marian] ' ELSE '' END || text AS text FROM (SELECT *, max((line_no = 1 OR contains(text, '[marian]'))::INT) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS seen FROM L) WHERE seen = 1",
    "parse_task_label": f"WITH {LABEL_SQL} SELECT event_id, model, importer, dataset, augmentation FROM J",
    "latest_task": f"WITH {TASK_SQL}, R AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY created DESC, task_id DESC) AS rn FROM T WHERE done AND label LIKE 'train%') SELECT label, task_id, created FROM R WHERE rn = 1",
    "earliest_task": f"WITH {TASK_SQL}, R AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY created, task_id) AS rn FROM T WHERE done AND label LIKE 'train%') SELECT label, task_id, created FROM R WHERE rn = 1",
    "runs_with_metrics": f"WITH {RUN_SQL} SELECT T.task_id, T.model, E.eval_id FROM T LEFT JOIN E ON T.model = E.model AND T.task_id IN (E.i::VARCHAR, (E.i + 1)::VARCHAR)",
    "missing_runs": f"WITH {RUN_SQL} SELECT DISTINCT model FROM E WHERE model NOT IN (SELECT model FROM T)",
    "metrics_by_model": "WITH X AS (SELECT 'm' || (user_id % 5) AS model, concat_ws('/', 'flores', event_type, CASE WHEN event_id % 2 = 0 THEN 'aug-mix' ELSE '-' END, round(value, 1)::DECIMAL(8,2)::VARCHAR, (event_id % 70)::DECIMAL(8,2)::VARCHAR) AS row FROM events WHERE value IS NOT NULL) SELECT model, count(*) AS n, string_agg(row, ';' ORDER BY row) AS metrics FROM X GROUP BY model",
    "eval_rows": f"WITH {LABEL_SQL} SELECT event_id, model, importer || '_' || dataset AS dataset, augmentation AS aug, event_id % 60 + 0.5::DOUBLE AS bleu, event_id % 80 + 0.25::DOUBLE AS chrf FROM J WHERE importer IS NOT NULL",
    "resumable_run": "SELECT max(lpad(c_custkey::VARCHAR, 9, '0')) AS run_id FROM customer WHERE c_custkey % 2 <> 0 AND c_custkey % 3 <> 0",
    "registry_search": f"WITH {MODEL_SQL} SELECT src, trg, version, channel FROM M WHERE contains(lower(concat_ws(' ', src, trg, version, channel)), 'en') AND contains(lower(concat_ws(' ', src, trg, version, channel)), 'rel') AND contains(src, 'en') AND NOT contains(channel, 'nightly')",
    "catalog_skip_reason": f"WITH {CATALOG_SQL} SELECT p_partkey, name, CASE WHEN " + " OR ".join(f"contains(name, '{s}')" for s in C.SKIPPED) + " THEN 'skipped' WHEN sentences < 200 THEN 'too_small' WHEN length(name) > 80 THEN 'too_long' END AS reason FROM K",
    "catalog_antijoin": f"WITH {CATALOG_SQL} SELECT p_partkey, name FROM K WHERE NOT contains(lower(name), 'opus') AND NOT contains(lower(name), 'newstest') AND NOT contains(lower(name), 'unv1') AND {NORMAL} NOT IN (SELECT {NORMAL} FROM K WHERE p_partkey % 29 = 3)",
    "catalog_sort": f"WITH {CATALOG_SQL} SELECT p_partkey, row_number() OVER (ORDER BY size_class DESC, downloads DESC, p_partkey) AS place FROM K",
    "version_sort": f"WITH {MODEL_SQL}, S AS (SELECT lang, version, list_concat(list_transform(range(3 - len(string_split(version, '.'))), lambda i: '0'), string_split(version, '.')) AS p FROM ML), O AS (SELECT lang, version, row_number() OVER (PARTITION BY lang ORDER BY p[1]::INT DESC, p[2]::INT DESC, regexp_extract(p[3], '^(\\d+)', 1)::INT DESC, (regexp_extract(p[3], '^\\d+([a-z]\\d?)', 1) = '') DESC, regexp_extract(p[3], '^\\d+([a-z]\\d?)', 1) DESC) AS rn FROM S) SELECT lang, version FROM O WHERE rn = 1",
    "model_pairs": f"WITH {MODEL_SQL} SELECT lang, version, count(*) FILTER (trg = 'en') AS to_pivot, count(*) FILTER (src = 'en') AS from_pivot FROM ML GROUP BY 1, 2",
    "language_counts": f"WITH {MODEL_SQL}, D AS (SELECT DISTINCT channel, lang FROM ML), N AS (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM D) SELECT channel, count(*) AS languages, count(*) FILTER (n = 1) AS only_here FROM N GROUP BY 1",
    "record_sync": "SELECT coalesce(L.id, R.id) AS id, CASE WHEN L.id IS NULL THEN 'create' WHEN R.id IS NULL THEN 'delete' ELSE 'keep' END AS action FROM (SELECT DISTINCT o_orderkey::VARCHAR AS id FROM orders) L FULL JOIN (SELECT event_id::VARCHAR AS id FROM events) R ON L.id = R.id",
    "llm_last_line": "SELECT conv_id, turn, regexp_extract(rtrim(text, ' ' || chr(9) || chr(10) || chr(13)), '[^\\n]*$') AS answer FROM conversations",
    "alignment_remap": f"""WITH {D.PAIRS}, A AS (SELECT pos, list_transform(range(4), lambda i: ((pos + i) % 3)::VARCHAR || '-' || ((line_no + i) % 3)::VARCHAR) AS a FROM P),
B AS (SELECT pos, list_transform(a, lambda x: (CASE x[1] WHEN '2' THEN '1' ELSE '0' END) || '-' || (CASE x[3] WHEN '2' THEN '1' ELSE '0' END)) AS b FROM A)
SELECT pos, array_to_string(list_filter(b, lambda x, i: list_position(b, x) = i), ' ') AS aln FROM B""",
    "ext_events_tumbling": f"SELECT {WINDOW.format('1 hour')} AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "ext_events_sliding": f"WITH X AS (SELECT {WINDOW.format('30 minutes')} AS start, event_type, value FROM events UNION ALL SELECT {WINDOW.format('30 minutes')} - INTERVAL '30 minutes', event_type, value FROM events) SELECT start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM X GROUP BY 1, 2",
    "ext_events_session": "WITH A AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '20 minutes' OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS fresh FROM events), B AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM A) SELECT user_id, min(ts) AS start, count(*) AS n FROM B GROUP BY user_id, s",
}
