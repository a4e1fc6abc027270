"""Queries that merge, sample and rank corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions.text import SPACE_RE2 as W
from weftline.operators import align as L
from weftline.operators import measure as A
from weftline.operators import merge as M
from weftline.operators import rank as R
from weftline.operators import sample as S
from weftline.sources import derived as D

KEY = lambda c: rf"nfc_normalize(regexp_replace({c}, '^[{W}]+|[{W}]+$', '', 'g'))"
PAIR = ["dataset", "pos", "src", "trg", "score"]
STRETCH = D.LINES_EACH * 50
SEED, SAMPLE, PARTS, BATCH = 7, 500, 10, 64


def _distill(spark, d):
    p = D.pairs(spark, d)
    return M.distinct_pairs(p, p.where(F.col("score") > 0.5))


def _union(spark, d):
    p = D.pairs(spark, d)
    return p.select(*PAIR).unionByName(p.where(F.col("score") > 0.5).select(*PAIR))


def _zip(spark, d):
    """Two sides read apart from each other: all lines but a document's last, and all but its first, a place back."""
    x = D.lines(spark, d)
    last = D.documents(spark, d).select(F.col("doc_id").alias("i"), (F.size(F.split("text", "\n")) - 1).alias("last"))
    src = x.join(last, F.col("doc_id") == F.col("i")).where("line_no < last").select("dataset", "pos", F.col("text").alias("src"))
    trg = x.where("line_no > 0").select("dataset", (F.col("pos") - 1).alias("pos"), F.col("text").alias("trg"))
    return M.zip_by_position(src, trg)


def _mono_kept(spark, d):
    return M.first_lines(D.lines(spark, d), D.parallel_side(spark, d)).select("dataset", "pos", "text")


def _ce(spark, d):
    x = D.pairs(spark, d)
    return S.trim_worst(x, 0.05, "score", F.floor(F.col("pos") / STRETCH), F.col("pos")).select("pos", "score")


def _chunks(spark, d):
    x = D.lines(spark, d).select("pos", "text")
    return S.chunks(x, PARTS, F.floor(F.col("pos") / STRETCH), F.col("pos")).select("pos", F.col("chunk"))


def _collected(spark, d):
    """Chunks put together again: as many rows, in the same order."""
    c = _chunks(spark, d)
    return c.groupBy("chunk").agg(F.count("*").alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"))


def _llm_batches(spark, d):
    x = D.pairs(spark, d)
    b = S.batches(x.select("pos", "src"), BATCH, F.floor(F.col("pos") / STRETCH), F.col("pos"))
    line = F.concat(F.lit("example "), (F.col("rank") % BATCH).cast("string"), F.lit(" "), F.col("src"))
    return b.withColumn("line", line).groupBy("batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "line"))), lambda r: r["line"]), "\n").alias("prompt"))


def _diverse(spark, d):
    return S.round_robin(D.read(spark, d, "embeddings").select("vec_id", "label"), 100, "label", "vec_id").select("vec_id", "label", "turn")


def _mix(spark, d):
    x = D.lines(spark, d).select("pos", "text", "lang")
    return S.weighted_mix({"en": (x.where("lang = 'en'"), 0.7), "other": (x.where("lang <> 'en'"), 0.3)}, 1000, SEED, "pos").select("pos", "corpus")


def _token_batches(spark, d):
    x = D.lines(spark, d).withColumn("n", F.regexp_count("text", F.lit("[^ ]+")))
    return S.padded_batches(x, 512, "n", F.floor(F.col("pos") / STRETCH), F.col("pos")).select("pos", "bucket", "batch")


def _bleu(spark, d):
    return R.sentence_bleu(D.candidates(spark, d)).select("idx", "rank", F.round("bleu", 6).alias("bleu"))


def _extract(spark, d):
    x = R.sentence_bleu(D.candidates(spark, d)).withColumn("bleu", F.round("bleu", 9))
    return R.best_candidate(x)


def _nbest(spark, d):
    c = D.candidates(spark, d)
    line = F.concat_ws(" ||| ", F.col("idx").cast("string"), "hyp", F.lit("F0= -1.5 F1= -2.5"), F.concat(F.lit("-"), F.col("rank").cast("string"), F.lit(".25")))
    line = F.when(F.col("rank") == 0, F.concat(F.col("idx").cast("string"), F.lit(" |||"))).otherwise(line)
    return R.parse_nbest(c.select("rank", line.alias("text"))).select("rank", "idx", "hyp", "features", "nbest_score")


def _lexicon(spark, d):
    p = D.pairs(spark, d).select(F.lower("src").alias("src"), F.lower("trg").alias("trg"))
    return R.lexical_table(p.withColumn("alignment", L.diagonal(F.col("src"), F.col("trg"))))


def _shortlist(spark, d):
    return R.shortlist(_lexicon(spark, d))


def _unit(spark, d):
    v = A.normalized(F.col("embedding"))
    return D.read(spark, d, "embeddings").select("vec_id", F.array_join(F.transform(v, lambda x: F.round(x, 5).cast("decimal(12,5)").cast("string")), " ").alias("vector"))


def _centroids(spark, d):
    x = D.read(spark, d, "embeddings").select("vec_id", A.normalized(F.col("embedding")).alias("v"))
    return A.nearest_centroid(x, "v", x.where("vec_id < 10").select("vec_id", "v")).select("vec_id", F.col("cluster"), F.round("similarity", 6).alias("similarity"))


def _length(spark, d):
    return A.histogram(D.lines(spark, d), F.length("text") + 1)


def _log(spark, d):
    x = A.log_histogram(_length(spark, d))
    return x.select("bin", "n")


def _metric_table(spark, d):
    x = D.read(spark, d, "events").groupBy("event_type", (F.col("user_id") % 4).alias("model")).agg(F.round(F.avg("value"), 6).alias("value"))
    return A.pivoted(x.withColumn("model", F.concat(F.lit("m"), "model")), "event_type", "model", "value", ["m0", "m1", "m2", "m3"])


def _summary(spark, d):
    x = D.read(spark, d, "events").select(F.col("event_type").alias("criterion"), (F.col("event_id") % 5 + 1).alias("score"))
    return A.score_summary(x).select("criterion", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "n1", "n2", "n3", "n4", "n5")


QUERIES = {
    "merge_parallel_dedup": lambda s, d: M.best_per_target(D.pairs(s, d)).select(*PAIR),
    "merge_parallel_stats": lambda s, d: M.kept_by_dataset(D.pairs(s, d)),
    "union_corpora": _union,
    "positional_zip": _zip,
    "mono_antijoin_parallel": lambda s, d: M.without(D.lines(s, d), D.parallel_side(s, d)).select("dataset", "pos", "text"),
    "merge_mono_dedup": _mono_kept,
    "merge_mono_stats": lambda s, d: M.mono_stats(D.lines(s, d), D.parallel_side(s, d)),
    "merge_distillation_dedup": _distill,
    "sample_bounded": lambda s, d: S.bounded(D.lines(s, d), SAMPLE, SEED, F.col("pos")).select("pos", "text"),
    "diverse_sample": _diverse,
    "split_chunks": _chunks,
    "collect_chunks": _collected,
    "llm_batches": _llm_batches,
    "curriculum_mix": _mix,
    "token_batches": _token_batches,
    "ce_filter": _ce,
    "sentence_bleu": _bleu,
    "extract_best": _extract,
    "nbest_parse": _nbest,
    "lexical_table": lambda s, d: _lexicon(s, d).withColumn("prob", F.round("prob", 6)),
    "prune_shortlist": _shortlist,
    "l2_normalize": _unit,
    "nearest_centroid": _centroids,
    "cluster_sizes": lambda s, d: A.cluster_sizes(D.read(s, d, "embeddings"), "label"),
    "length_histogram": _length,
    "word_histogram": lambda s, d: A.histogram(D.lines(s, d), F.regexp_count("text", F.lit("[^ ]+"))),
    "log_histogram": _log,
    "metric_pivot": _metric_table,
    "eval_summary": _summary,
}

BEST = f"WITH {D.PAIRS}, B AS (SELECT *, row_number() OVER (PARTITION BY {KEY('trg')} ORDER BY score DESC, dataset, pos) AS rn FROM P)"
MONO = f"""WITH {D.PARALLEL}, QK AS (SELECT DISTINCT {KEY('text')} AS key FROM Q), LK AS (SELECT *, {KEY('text')} AS key FROM L),
V AS (SELECT LK.*, CASE WHEN QK.key IS NOT NULL THEN 'parallel_dup' WHEN row_number() OVER (PARTITION BY LK.key ORDER BY dataset, pos) > 1 THEN 'mono_dup' ELSE 'kept' END AS verdict FROM LK LEFT JOIN QK ON LK.key = QK.key)"""
GRAMS = ", ".join(f"CASE WHEN len({{0}}) >= {n} THEN list_transform(range(1, len({{0}}) - {n} + 2), lambda i: array_to_string({{0}}[i:i + {n - 1}], ' ')) ELSE [] END AS {{0}}{n}" for n in range(1, 5))
MATCH = ", ".join(f"coalesce(list_sum(list_transform(list_distinct(h{n}), lambda g: least(len(list_filter(h{n}, lambda x: x = g)), len(list_filter(r{n}, lambda x: x = g))))), 0) AS m{n}" for n in range(1, 5))
PREC = ", ".join(f"CASE WHEN len(h{n}) = 0 THEN 0.0 ELSE (m{n} + 1.0::DOUBLE) / (len(h{n}) + 1.0::DOUBLE) END AS p{n}" for n in range(1, 5))
WORDS = lambda c: rf"list_filter(regexp_split_to_array({c}, '[{W}]+'), lambda x: x <> '')"
BLEU = f"""WITH {D.CANDIDATES}, T AS (SELECT idx, rank, hyp, {WORDS('hyp')} AS h, {WORDS('ref')} AS r FROM N), G AS (SELECT *, {GRAMS.format('h')}, {GRAMS.format('r')} FROM T),
MM AS (SELECT *, {MATCH} FROM G), PP AS (SELECT *, {PREC} FROM MM),
BL AS (SELECT idx, rank, hyp, CASE WHEN least(p1, p2, p3, p4) > 0 THEN exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4) ELSE 0.0 END * CASE WHEN len(r) = 0 OR len(h) = 0 OR len(h) > len(r) THEN 1.0 ELSE exp(1 - len(r)::DOUBLE / len(h)) END AS bleu FROM PP)"""
UNIT = "U AS (SELECT vec_id, CASE WHEN sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) = 0 THEN list_transform(embedding, lambda x: x::DOUBLE) ELSE list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) END AS v FROM embeddings)"
LEX = rf"""WITH {D.PAIRS}, X AS (SELECT s[i] AS src, t[i] AS trg FROM (SELECT s, t, unnest(range(1, least(len(s), len(t)) + 1)) AS i FROM (SELECT {WORDS('lower(src)')} AS s, {WORDS('lower(trg)')} AS t FROM P))),
C AS (SELECT src, trg, count(*) AS n FROM X GROUP BY 1, 2), LX AS (SELECT src, trg, n / sum(n) OVER (PARTITION BY src) AS prob FROM C)"""

ORACLES = {
    "merge_parallel_dedup": BEST + " SELECT dataset, pos, src, trg, score FROM B WHERE rn = 1",
    "merge_parallel_stats": BEST + " SELECT dataset, count(*) AS visited, count(*) FILTER (rn = 1) AS kept, count(*) FILTER (rn > 1) AS filtered FROM B GROUP BY ROLLUP (dataset)",
    "union_corpora": f"WITH {D.PAIRS} SELECT dataset, pos, src, trg, score FROM P UNION ALL SELECT dataset, pos, src, trg, score FROM P WHERE score > 0.5",
    "positional_zip": f"WITH {D.LINES} SELECT a.dataset, a.pos, a.text AS src, b.text AS trg FROM L a JOIN L b ON a.doc_id = b.doc_id AND b.line_no = a.line_no + 1",
    "mono_antijoin_parallel": MONO + " SELECT dataset, pos, text FROM V WHERE verdict <> 'parallel_dup'",
    "merge_mono_dedup": MONO + " SELECT dataset, pos, text FROM V WHERE verdict = 'kept'",
    "merge_mono_stats": MONO + " SELECT count(*) AS visited, count(*) FILTER (verdict = 'kept') AS kept, count(*) FILTER (verdict = 'parallel_dup') AS parallel_duplicates, count(*) FILTER (verdict = 'mono_dup') AS mono_duplicates, coalesce(sum(len(text) + 1) FILTER (verdict = 'kept'), 0)::BIGINT AS final_codepoints, count(*) - count(*) FILTER (verdict = 'kept') AS filtered, (SELECT count(*) FROM QK) AS parallel_corpus_lines FROM V",
    "merge_distillation_dedup": f"WITH {D.PAIRS} SELECT DISTINCT src, trg FROM P",
    "sample_bounded": f"WITH {D.LINES} SELECT pos, text FROM L ORDER BY md5('{SEED}:' || pos), pos LIMIT {SAMPLE}",
    "diverse_sample": "SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id DESC) AS turn FROM embeddings ORDER BY turn, label LIMIT 100",
    "split_chunks": f"WITH {D.LINES} SELECT pos, (row_number() OVER (ORDER BY pos) - 1) // ((SELECT (count(*) + {PARTS - 1}) // {PARTS} FROM L)) + 1 AS chunk FROM L",
    "collect_chunks": f"WITH {D.LINES}, C AS (SELECT pos, (row_number() OVER (ORDER BY pos) - 1) // ((SELECT (count(*) + {PARTS - 1}) // {PARTS} FROM L)) + 1 AS chunk FROM L) SELECT chunk, count(*) AS n, min(pos) AS first, max(pos) AS last FROM C GROUP BY 1",
    "llm_batches": f"WITH {D.PAIRS}, R AS (SELECT src, row_number() OVER (ORDER BY pos) - 1 AS rank FROM P) SELECT rank // {BATCH} AS batch, string_agg('example ' || (rank % {BATCH}) || ' ' || src, chr(10) ORDER BY rank) AS prompt FROM R GROUP BY 1",
    "curriculum_mix": f"WITH {D.LINES} (SELECT pos, 'en' AS corpus FROM L WHERE lang = 'en' ORDER BY md5('{SEED}:' || pos), pos LIMIT 700) UNION ALL (SELECT pos, 'other' AS corpus FROM L WHERE lang <> 'en' ORDER BY md5('{SEED}:' || pos), pos LIMIT 300)",
    "token_batches": f"WITH {D.LINES}, B AS (SELECT pos, ceil(greatest(len(regexp_extract_all(text, '[^ ]+')), 1) / 10.0)::BIGINT AS bucket FROM L) SELECT pos, bucket, (row_number() OVER (PARTITION BY bucket ORDER BY pos) - 1) // greatest(1, 512 // (bucket * 10)) AS batch FROM B",
    "ce_filter": f"WITH {D.PAIRS}, R AS (SELECT pos, score, row_number() OVER (ORDER BY score, pos) - 1 AS rank FROM P) SELECT pos, score FROM R WHERE rank >= greatest((SELECT floor(count(*) * 0.05) FROM P) - 1, 0)",
    "sentence_bleu": BLEU + " SELECT idx, rank, round(bleu, 6) AS bleu FROM BL",
    "extract_best": BLEU + " SELECT idx, hyp FROM (SELECT *, row_number() OVER (PARTITION BY idx ORDER BY round(bleu, 9) DESC, rank) AS rn FROM BL) WHERE rn = 1",
    "nbest_parse": f"WITH {D.CANDIDATES} SELECT rank, idx, CASE WHEN rank = 0 THEN '' ELSE hyp END AS hyp, CASE WHEN rank = 0 THEN '' ELSE 'F0= -1.5 F1= -2.5' END AS features, CASE WHEN rank > 0 THEN -(rank + 0.25)::DOUBLE END AS nbest_score FROM N",
    "lexical_table": LEX + " SELECT src, trg, round(prob, 6) AS prob FROM LX",
    "prune_shortlist": LEX + ", VO AS (SELECT trg FROM LX GROUP BY trg ORDER BY count(*) DESC, trg LIMIT 102) SELECT src, trg FROM (SELECT src, trg, row_number() OVER (PARTITION BY src ORDER BY prob DESC, trg) AS rn FROM LX) WHERE rn <= 100 UNION SELECT src, trg FROM LX WHERE trg IN (SELECT trg FROM VO)",
    "l2_normalize": f"WITH {UNIT} SELECT vec_id, array_to_string(list_transform(v, lambda x: CASE WHEN round(x, 5) = 0 THEN '0.00000' ELSE round(x, 5)::DECIMAL(12,5)::VARCHAR END), ' ') AS vector FROM U",
    "nearest_centroid": f"WITH {UNIT}, S AS (SELECT U.vec_id, c.vec_id AS cluster, list_sum(list_transform(list_zip(U.v, c.v), lambda p: p[1] * p[2])) AS s FROM U, (SELECT * FROM U WHERE vec_id < 10) c) SELECT vec_id, cluster, round(s, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, cluster) AS rn FROM S) WHERE rn = 1",
    "cluster_sizes": "SELECT label, count(*) AS n FROM embeddings GROUP BY label",
    "length_histogram": f"WITH {D.LINES} SELECT len(text) + 1 AS value, count(*) AS n FROM L GROUP BY 1",
    "word_histogram": f"WITH {D.LINES} SELECT len(regexp_extract_all(text, '[^ ]+'))::BIGINT AS value, count(*) AS n FROM L GROUP BY 1",
    "log_histogram": f"""WITH {D.LINES}, H AS (SELECT len(text) + 1 AS value, count(*) AS n FROM L GROUP BY 1), MX AS (SELECT max(value) AS m FROM H),
ED AS (SELECT list_concat([1.0::DOUBLE, 2.0::DOUBLE], list_filter(list_transform(range(30), lambda i: pow(10.0::DOUBLE, log10(m) * i / 29)), lambda x: x > 2)) AS e FROM MX)
SELECT least(len(list_filter(e, lambda x: x <= value)), len(e) - 1)::BIGINT AS bin, sum(n)::BIGINT AS n FROM H, ED WHERE value >= 1 AND value <= list_max(e) GROUP BY 1""",
    "metric_pivot": "SELECT event_type, " + ", ".join(f"round(avg(value) FILTER (user_id % 4 = {k}), 6) AS m{k}" for k in range(4)) + " FROM events GROUP BY event_type",
    "eval_summary": "SELECT event_type AS criterion, round(avg(event_id % 5 + 1), 6) AS mean, round(median(event_id % 5 + 1), 6) AS median, " + ", ".join(f"count(*) FILTER (event_id % 5 + 1 = {k}) AS n{k}" for k in range(1, 6)) + " FROM events GROUP BY 1",
}
