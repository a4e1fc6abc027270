"""Queries on texts, pairs and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import clean as C
from weftline.operators import scorers as S
from weftline.sources import derived as D

W = T.SPACE_RE2
STRIPPED = lambda c: rf"regexp_replace(replace({c}, chr(9), ' '), '^[{W}]+|[{W}]+$', '', 'g')"
STRIP = rf"regexp_replace(text, '^[{W}]+|[{W}]+$', '', 'g')"
LINE = ["doc_id", "line_no"]
THRESHOLDS, DEFAULT_THRESHOLD = {"src0": 0.7, "src1": 0.3}, 0.5

NAMES = [
    ("opus_ELRC-3075-wikipedia_health/v1",), ("mtdata_ELRC-convention_against_torture_other_cruel_inhuman_or_degrading_treatment-1-ell-eng",), ("https://storage.googleapis.com/corpora/news.2020.[LANG].zst",),
    ("http://example.org/data/set-1.en.txt.gz",), ("news-crawl_news.2021",), ("flores_aug-mix_devtest",), ("mtdata_aug-title_Neulab-tedtalks_train-1-eng-fin",), ("725-Hallituskausi_2011_2",), ("plain",),
]
NAME_SQL = "K(name) AS (VALUES " + ", ".join(f"('{n}')" for (n,) in NAMES) + ")"
SIZES = [(0,), (5,), (999,), (1000,), (1550,), (113_000_000,), (2_500_000_000,)]


def _names(spark):
    return spark.createDataFrame(NAMES, "name string")


def _text(rewrite):
    return lambda spark, d: D.lines(spark, d).select(*LINE, rewrite(F.col("text")).alias("text"))


def _pairs(keep):
    return lambda spark, d: (lambda p: p.where(keep(F.col("src"), F.col("trg"))).select(*LINE, "src", "trg"))(D.pairs(spark, d))


def _deescape_page(spark, d):
    return D.read(spark, d, "pages").select("page_id", T.deescape(F.col("html")).alias("text"))


def _fixes(spark, d):
    x = D.lines(spark, d)
    parts = [x.select(*LINE, F.lit(k).alias("fix"), T.fix_dataset(F.col("text"), k).alias("text")) for k in sorted(T.DATASET_FIXES)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _fixes_sql() -> str:
    parts = []
    for k in sorted(T.DATASET_FIXES):
        e = "text"
        for pattern, to in T.DATASET_FIXES[k]:
            to = to.replace("$1", r"\1").replace("$2", r"\2").replace("'", "''")
            pattern = pattern.replace("'", "''").replace("\\u200b", "\\x{200b}")
            e = f"regexp_replace({e}, '{pattern}', '{to}', 'g')"
        parts.append(f"SELECT doc_id, line_no, '{k}' AS fix, {e} AS text FROM L")
    return f"WITH {D.LINES} {' UNION ALL '.join(parts)}"


def _deescape_sql() -> str:
    e = "html"
    for a, b in T.ENTITIES:
        e = f"replace({e}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    return f"SELECT page_id, {e} AS text FROM pages"


def _reasons(spark, d):
    return C.mono_reasons(D.lines(spark, d)).select(*LINE, F.coalesce("reason", F.lit("KEPT")).alias("reason"))


def _reason_sql(tail: str) -> str:
    case = lambda what: "CASE lang " + " ".join(f"WHEN '{k}' THEN len(regexp_extract_all(t, '{what.replace('@', v)}'))" for k, v in C.ALPHABETS.items()) + " END"
    starts, letters = case(f"(?:^|[{W}])[@]"), case("[@]")
    return f"""WITH {D.LINES}, S AS (SELECT *, {STRIP} AS t FROM L), M AS (SELECT *, len(regexp_extract_all(t, '[^{W}]+')) AS n, {starts} AS starts, {letters} AS letters, len(replace(t, ' ', '')) AS solid FROM S),
R AS (SELECT doc_id, line_no, text, CASE WHEN t = '' THEN 'EMPTY' WHEN n < {C.MIN_WORDS} THEN 'TOO_SHORT' WHEN n > {C.MAX_WORDS} THEN 'TOO_LONG'
  WHEN starts / n::DOUBLE < {C.WORD_SHARE} THEN 'RATIO_ALPHA' WHEN letters / solid::DOUBLE < {C.CHAR_SHARE} THEN 'RATIO_CHARS' ELSE 'KEPT' END AS reason FROM M) {tail}"""


def _threshold_split(spark, d):
    p = D.pairs(spark, d)
    return p.select(*LINE, "score", F.when(F.col("score") > 0.5, "best").otherwise("rest").alias("part"))


def _by_dataset(spark, d):
    x = C.thresholds_by_dataset(D.pairs(spark, d), THRESHOLDS, DEFAULT_THRESHOLD)
    return x.where(F.col("score") > F.col("threshold")).select("dataset", *LINE, "score", "threshold")


def _stats(spark, d):
    x = C.document_lines(D.scored_documents(spark, d), "en", 3.0, 400)
    n = lambda v: F.count_if((F.col("verdict") == v) & F.col("line_no").isNotNull()).alias(v)
    return x.agg(F.count_distinct("doc_id").alias("documents"), F.count("line_no").alias("lines"), *(n(v) for v in ("doc_score", "doc_lang", "line_lang", "too_long", "kept")))


DOCS_SQL = f"""WITH {D.LINES}, R AS (SELECT doc_id, line_no, text, CASE WHEN doc_id % 11 < 3.0 THEN 'doc_score' WHEN lang <> 'en' THEN 'doc_lang'
  WHEN (doc_id + line_no) % 7 = 0 THEN 'line_lang' WHEN len(text) > 400 THEN 'too_long' ELSE 'kept' END AS verdict FROM L)"""


def _hplt_lines(spark, d):
    return C.document_lines(D.scored_documents(spark, d), "en", 3.0, 400).where("verdict = 'kept'").select(*LINE, "text")


def _name_parts(spark, d):
    a, b = T.dataset_key(F.col("name"))
    return _names(spark).select("name", a.alias("importer"), b.alias("dataset"))


def _import_ids(spark, d):
    a, b, c = T.import_id(F.col("name"))
    return _names(spark).select("name", a.alias("importer"), b.alias("augmentation"), c.alias("dataset"))


def _lang_filter(spark, d):
    """A detector's label and the text; the label here is the document's language, behind a prefix as detectors write it."""
    x = D.lines(spark, d).withColumn("label", F.concat(F.lit("__label__"), "lang"))
    return C.language_ok(x, "en", F.col("label")).select(*LINE, "text")


def _urls(spark, d):
    """Pairs of which every third names a page on one side only, or another one."""
    page = F.concat(F.lit(" https://example.org/p"), (F.col("line_no") % 4).cast("string"))
    other = F.concat(F.lit(" https://example.org/p"), (F.col("doc_id") % 4).cast("string"))
    return D.pairs(spark, d).withColumns({"src": F.concat("src", F.when(F.col("line_no") % 3 == 0, page).otherwise("")), "trg": F.concat("trg", F.when(F.col("line_no") % 3 == 0, other).otherwise(""))})


def _tsv(spark, d):
    from weftline.operators.merge import build_tsv

    aln = F.when(F.col("line_no") % 5 == 0, F.lit(" ")).otherwise(F.concat_ws("-", F.col("line_no") % 3, F.col("line_no") % 2))
    return build_tsv(D.pairs(spark, d).withColumn("aln", aln))


def _frequent(spark, d):
    a, b = C.remove_frequent(F.concat(F.lit("• "), F.col("src")), F.col("trg"))
    return D.pairs(spark, d).select(*LINE, a.alias("src"), b.alias("trg"))


def _augment(how):
    return _text(lambda t: S.augment(t, how))


def _punct(spark, d):
    a, b = S.strip_endings(F.col("src"), F.col("trg"))
    return D.pairs(spark, d).select(*LINE, a.alias("src"), b.alias("trg"))


COUNT = lambda c: rf"len(regexp_extract_all({c}, '[^{W}]+'))"
PAIR_SQL = f"WITH {D.PAIRS} SELECT doc_id, line_no, src, trg FROM P WHERE "
same = lambda p: f"list_sort(regexp_extract_all(src, '{p}')) = list_sort(regexp_extract_all(trg, '{p}'))"

QUERIES = {
    "deescape_text": _deescape_page,
    "strip_nonprinting": _text(T.strip_nonprinting),
    "dataset_fixes": _fixes,
    "collapse_whitespace": _text(C.collapse_space),
    "tab_to_space": _text(lambda t: F.translate(t, "\t", " ")),
    "plain_punctuation": _text(C.plain_punctuation),
    "mono_rules_reason": _reasons,
    "mono_rules_keep": lambda spark, d: _reasons(spark, d).where("reason = 'KEPT'").select(*LINE),
    "lang_filter": _lang_filter,
    "pair_nonempty_filter": _pairs(C.nonempty),
    "pair_length_filter": _pairs(C.length_ok),
    "pair_word_length_filter": _pairs(lambda a, b: C.word_length_ok(a, 14) & C.word_length_ok(b, 14)),
    "pair_ratio_filter": _pairs(C.ratio_ok),
    "num_mismatch": _pairs(lambda a, b: ~C.numbers_match(a, b)),
    "url_mismatch": lambda spark, d: _urls(spark, d).where(~C.urls_match(F.col("src"), F.col("trg"))).select(*LINE, "src", "trg"),
    "frequent_patterns": _frequent,
    "score_threshold_split": _threshold_split,
    "threshold_by_dataset": _by_dataset,
    "build_training_tsv": _tsv,
    "dataset_key_parse": _name_parts,
    "dataset_name_sanitize": lambda spark, d: _names(spark).select("name", T.sanitize_dataset(F.col("name")).alias("label")),
    "import_id_parse": _import_ids,
    "corpus_name_normalize": lambda spark, d: _names(spark).select("name", T.corpus_name(F.col("name")).alias("key")),
    "estimate_sentences": lambda spark, d: spark.createDataFrame(SIZES, "size long").select("size", T.estimate_sentences(F.col("size")).alias("sentences")),
    "format_bytes": lambda spark, d: spark.createDataFrame(SIZES, "size long").select("size", T.format_bytes(F.col("size")).alias("shown")),
    "hplt_stats": _stats,
    "hplt_lines": _hplt_lines,
    "hplt_merge_lines": lambda spark, d: C.merge_lines(D.scored_documents(spark, d), "en", 3.0, 400),
    "norm_key": lambda spark, d: D.lines(spark, d).select(*LINE, T.norm_key(F.col("text")).alias("key")),
    "augment_upper": _augment("upper"),
    "augment_title": _augment("title"),
    "augment_punct": _punct,
}

_SIZE_SQL = "K(size) AS (VALUES " + ", ".join(f"({s}::BIGINT)" for (s,) in SIZES) + ")"
_UNIT = "(length(size::VARCHAR) - 1) // 3"
ORACLES = {
    "deescape_text": _deescape_sql(),
    "strip_nonprinting": f"WITH {D.LINES} SELECT doc_id, line_no, regexp_replace(text, '\\p{{C}}', ' ', 'g') AS text FROM L",
    "dataset_fixes": _fixes_sql(),
    "collapse_whitespace": f"WITH {D.LINES} SELECT doc_id, line_no, regexp_replace(text, '[{W}]+', ' ', 'g') AS text FROM L",
    "tab_to_space": f"WITH {D.LINES} SELECT doc_id, line_no, replace(text, chr(9), ' ') AS text FROM L",
    "plain_punctuation": f"WITH {D.LINES} SELECT doc_id, line_no, translate(text, '{''.join(C.FULL_WIDTH)}', '{''.join(C.FULL_WIDTH.values())}') AS text FROM L",
    "mono_rules_reason": _reason_sql("SELECT doc_id, line_no, reason FROM R"),
    "mono_rules_keep": _reason_sql("SELECT doc_id, line_no FROM R WHERE reason = 'KEPT'"),
    "lang_filter": f"WITH {D.LINES} SELECT doc_id, line_no, string_split(text, chr(9))[1] AS text FROM L WHERE lang = 'en'",
    "pair_nonempty_filter": PAIR_SQL + "src <> '' AND trg <> ''",
    "pair_length_filter": PAIR_SQL + f"{COUNT('src')} BETWEEN 1 AND 150 AND {COUNT('trg')} BETWEEN 1 AND 150",
    "pair_word_length_filter": PAIR_SQL + " AND ".join(f"NOT regexp_matches({c}, '[^{W}]{{15,}}')" for c in ("src", "trg")),
    "pair_ratio_filter": PAIR_SQL + "least(len(src), len(trg)) >= greatest(len(src), len(trg)) * 0.5",
    "num_mismatch": PAIR_SQL + f"NOT ({same('[0-9]+')})",
    "url_mismatch": f"WITH {D.PAIRS}, U AS (SELECT doc_id, line_no, src || CASE WHEN line_no % 3 = 0 THEN ' https://example.org/p' || (line_no % 4) ELSE '' END AS src, trg || CASE WHEN line_no % 3 = 0 THEN ' https://example.org/p' || (doc_id % 4) ELSE '' END AS trg FROM P) SELECT * FROM U WHERE line_no % 3 = 0 AND line_no % 4 <> doc_id % 4",
    "frequent_patterns": f"""WITH {D.PAIRS}, A AS (SELECT doc_id, line_no, '• ' || src AS src, trg FROM P),
B AS (SELECT doc_id, line_no, CASE WHEN h THEN regexp_replace(src, '^ -', '') ELSE src END AS src, CASE WHEN h THEN regexp_replace(trg, '^ -', '') ELSE trg END AS trg FROM (SELECT *, regexp_matches(src || chr(9) || trg, '^ -') AS h FROM A)),
C AS (SELECT doc_id, line_no, replace(src, ' (Ekumenická Bible)', '') AS src, replace(trg, ' (Ekumenická Bible)', '') AS trg FROM B),
E AS (SELECT doc_id, line_no, CASE WHEN h THEN regexp_replace(src, '^• *', '') ELSE src END AS src, CASE WHEN h THEN regexp_replace(trg, '^• *', '') ELSE trg END AS trg FROM (SELECT *, regexp_matches(src || chr(9) || trg, '^• *[^\\t]*\\t[^•]') AS h FROM C))
SELECT doc_id, line_no, CASE WHEN h THEN regexp_replace(src, '^• *', '') ELSE src END AS src, CASE WHEN h THEN regexp_replace(trg, '^• *', '') ELSE trg END AS trg FROM (SELECT *, regexp_matches(src || chr(9) || trg, '^[^•][^\\t]*\\t•') AS h FROM E)""",
    "score_threshold_split": f"WITH {D.PAIRS} SELECT doc_id, line_no, score, CASE WHEN score > 0.5 THEN 'best' ELSE 'rest' END AS part FROM P",
    "threshold_by_dataset": f"WITH {D.PAIRS}, T AS (SELECT *, CASE dataset {' '.join(f'WHEN {k!r} THEN {v}' for k, v in THRESHOLDS.items())} ELSE {DEFAULT_THRESHOLD} END::DOUBLE AS threshold FROM P) SELECT dataset, doc_id, line_no, score, threshold FROM T WHERE score > threshold",
    "build_training_tsv": f"WITH {D.PAIRS} SELECT dataset, pos, {STRIPPED('src')} || chr(9) || {STRIPPED('trg')} || chr(9) || (line_no % 3) || '-' || (line_no % 2) AS line FROM P WHERE line_no % 5 <> 0",
    "dataset_key_parse": f"WITH {NAME_SQL} SELECT name, CASE WHEN ok THEN left(name, i - 1) END AS importer, CASE WHEN ok THEN substr(name, i + 1) END AS dataset FROM (SELECT name, instr(name, '_') AS i, instr(name, '_') > 1 AND instr(name, '_') < length(name) AS ok FROM K)",
    "dataset_name_sanitize": f"""WITH {NAME_SQL}, A AS (SELECT name, regexp_extract(name, '^https?://([^/:?#]+)', 1) AS host, replace(replace(regexp_replace(regexp_extract(name, '([^/]*)$', 1), '\\.[^.]*$', ''), '.[LANG]', ''), '[LANG]', '') AS stem, left(md5(name), 6) AS digest FROM K)
SELECT name, regexp_replace(CASE WHEN starts_with(name, 'http') THEN CASE WHEN host = 'storage.googleapis.com' THEN 'gcp' ELSE host END || '_' || stem || '_' || digest WHEN length(name) > 50 THEN left(name, 50) || '_' || digest ELSE name END, '://|[/.:\\[\\]]', '_', 'g') AS label FROM A""",
    "import_id_parse": f"WITH {NAME_SQL} SELECT name, " + ", ".join(f"nullif(regexp_extract(name, '^([a-z]*)_(aug[a-z\\-]*)?_?(.+)$', {i}), '') AS {c}" for i, c in ((1, "importer"), (2, "augmentation"), (3, "dataset"))) + " FROM K",
    "corpus_name_normalize": f"WITH {NAME_SQL} SELECT name, regexp_replace(regexp_replace(lower(regexp_replace(name, '-\\w{{3}}-\\w{{3}}$', '')), '[^a-z]', '', 'g'), 'train$', '') AS key FROM K",
    "estimate_sentences": f"WITH {_SIZE_SQL} SELECT size, size // 113 AS sentences FROM K",
    "format_bytes": f"WITH {_SIZE_SQL} SELECT size, CASE WHEN size = 0 THEN '0 B' ELSE round(size / pow(1000.0, {_UNIT}), 1)::DECIMAL(20,1)::VARCHAR || ' ' || (['B','KB','MB','GB','TB'])[{_UNIT} + 1] END AS shown FROM K",
    "hplt_stats": DOCS_SQL + " SELECT count(DISTINCT doc_id) AS documents, count(*) AS lines, " + ", ".join(f"count(*) FILTER (verdict = '{v}') AS {v}" for v in ("doc_score", "doc_lang", "line_lang", "too_long", "kept")) + " FROM R",
    "hplt_lines": DOCS_SQL + " SELECT doc_id, line_no, text FROM R WHERE verdict = 'kept'",
    "norm_key": f"WITH {D.LINES} SELECT doc_id, line_no, nfc_normalize({STRIP}) AS key FROM L",
    "augment_upper": f"WITH {D.LINES} SELECT doc_id, line_no, upper(replace(text, 'ß', 'ss')) AS text FROM L",
    "augment_punct": f"WITH {D.PAIRS}, E AS (SELECT *, list_position(['.', '!', '?', '…'], translate(right(src, 1), '。！？', '.!?')) AS a, list_position(['.', '!', '?', '…'], translate(right(trg, 1), '。！？', '.!?')) AS b FROM P) SELECT doc_id, line_no, CASE WHEN a = b THEN left(src, length(src) - 1) ELSE src END AS src, CASE WHEN a = b THEN left(trg, length(trg) - 1) ELSE trg END AS trg FROM E",
    "augment_title": f"WITH {D.LINES} SELECT doc_id, line_no, array_to_string(list_transform(string_split(text, ' '), lambda w: replace(upper(left(w, 1)), 'ẞ', 'Ss') || lower(w[2:])), ' ') AS text FROM L",
}
