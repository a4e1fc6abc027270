"""Queries on streams side by side, catalogue forms, markup and vectors; and SQL of queries that other modules register."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import align as A
from weftline.operators import catalog as K
from weftline.operators import measure as N
from weftline.operators import merge as M
from weftline.sources import derived as D

from .cleaning import DOCS_SQL, LINE, STRIP
from .merging import WORDS

EXCLUDED = ("SMALL", "zinc")
TAGS = ("p", "b", "i", "br")


def _side_by_side(s, d):
    """Five streams of one corpus: both sides, both tokenised, and the alignment."""
    p = D.pairs(s, d).select("pos", "src", "trg", F.concat_ws("-", F.col("doc_id") % 9, F.col("line_no") % 9).alias("aln"))
    stream = lambda c: p.select("pos", c.alias("text"))
    spaced = lambda c: F.array_join(F.split(c, " "), "▁")
    return M.zipped({"src": stream(F.col("src")), "trg": stream(F.col("trg")), "tok_src": stream(spaced("src")), "tok_trg": stream(spaced("trg")), "aln": stream(F.col("aln"))})


def _answers(s, d):
    """Parts as a catalogue's answers, three corpora each; some have no pairs, and some answers aren't JSON."""
    k = F.col("p_partkey")
    entry = lambda i: F.concat(F.lit('{"corpus": "c'), (k % 50).cast("string"), F.lit(f'", "version": "v{i}", "source": "en", "target": "de", "alignment_pairs": '), F.when((k + i) % 4 == 0, '""').otherwise((k * i).cast("string")), F.lit(', "size": 5}'))
    return D.read(s, d, "part").select(F.when(k % 10 == 0, "<html>").otherwise(F.concat(F.lit('{"corpora": ['), F.concat_ws(", ", entry(1), entry(2), entry(3)), F.lit("]}"))).alias("value"))


def _stacks(s, d):
    """Open tags of each line and of the next, drawn from their numbers."""
    stack = lambda n: F.filter(F.array(*(F.when((n + F.col("doc_id")) % m != 0, t) for m, t in zip((5, 2, 3, 4), TAGS, strict=True))), lambda t: t.isNotNull())
    closed, opened = A.tag_changes(stack(F.col("line_no")), stack(F.col("line_no") + 1))
    return D.lines(s, d).select(*LINE, F.array_join(closed, " ").alias("closed"), F.array_join(opened, " ").alias("opened"))


def _pooled(s, d):
    v = F.col("embedding")
    x = D.read(s, d, "embeddings").select("vec_id", N.mean_pooled(F.array(v, F.reverse(v), v), F.array(F.lit(1), (F.col("label") % 2).cast("int"), F.lit(0))).alias("u"))
    return x.select("vec_id", F.array_join(F.transform("u", lambda y: F.when(F.round(y, 5) == 0, "0.00000").otherwise(F.round(y, 5).cast("decimal(12,5)").cast("string"))), " ").alias("vector"))


def _word_quality(s, d):
    """Each word in two tokens, of which the second is less likely the longer the word is; then an end."""
    w = T.words(F.col("text"))
    tokens = F.concat(F.flatten(F.transform(w, lambda x: F.array(F.concat(F.lit(" "), F.left(x, F.lit(1))), F.concat(F.lit("-"), F.substr(x, F.lit(2)))))), F.array(F.lit("")))
    probs = F.concat(F.flatten(F.transform(w, lambda x: F.array(F.lit(-0.5), -F.length(x) / 4.0))), F.array(F.lit(-9.0)))
    x = D.lines(s, d).select("pos", A.word_quality(tokens, probs).alias("q"))
    return x.select("pos", F.size("q.words").cast("long").alias("words"), F.round("q.score", 6).alias("score"))


QUERIES = {
    "zip_streams": _side_by_side,
    "listed_names": lambda s, d: K.listed(D.read(s, d, "part"), "p_name", list(EXCLUDED)),
    "opus_catalogue": lambda s, d: K.opus_entries(_answers(s, d)).select("key", "source", "target", "alignment_pairs", "size"),
    "table_lines": lambda s, d: K.table_lines(D.read(s, d, "nation"), ["n_nationkey", "n_name"]),
    "sorted_table": lambda s, d: K.by_text(D.read(s, d, "supplier"), "s_suppkey", down=True).select("s_suppkey", "s_name"),
    "usable_sources": lambda s, d: K.usable_sources(D.read(s, d, "documents").select("doc_id", F.concat(F.lit("en-"), "lang").alias("lp"), F.when(F.col("doc_id") % 5 > 0, F.col("doc_id") % 5 == 1).alias("is_bad_source")), "en-de").select("doc_id"),
    "tag_changes": _stacks,
    "mean_pooling": _pooled,
    "word_quality": _word_quality,
}

_STACK = lambda n: "list_filter([" + ", ".join(f"CASE WHEN ({n} + doc_id) % {m} <> 0 THEN '{t}' END" for m, t in zip((5, 2, 3, 4), TAGS, strict=True)) + "], lambda t: t IS NOT NULL)"
_DRAW = lambda what, key="pos", seed=0: f"(('0x' || left(md5('{seed}:{what}:' || {key}), 8))::BIGINT / 4294967296.0::DOUBLE)"
_NOISE = lambda i: f"translate(left(md5('0:{i}:' || pos), (2 + floor({_DRAW(f'size{i}')} * 8))::INT), '0123456789', 'ghijk%#@&!')"
_THREE = " || ' ' || ".join(_NOISE(i) for i in range(3))
#: A column through four kinds of typing errors, each in a subquery of its own.
_FIRST = {"swap": "substr(t, i + 1, 1) || substr(t, i, 1)", "drop": "substr(t, i + 1, 1)", "double": "substr(t, i, 1) || substr(t, i, 1) || substr(t, i + 1, 1)", "replace": f"substr('etaoinsrhl', 1 + floor({_DRAW('letter')} * 10)::INT, 1) || substr(t, i + 1, 1)"}


def _typed(table: str) -> str:
    """SQL for a table's rows with column t typed wrong."""
    for what, middle in _FIRST.items():
        table = f"(SELECT * EXCLUDE (i) REPLACE (CASE WHEN length(t) > 1 THEN substr(t, 1, i - 1) || {middle} || substr(t, i + 2) ELSE t END AS t) FROM (SELECT *, 1 + floor({_DRAW(what)} * greatest(length(t) - 1, 1))::INT AS i FROM {table}))"
    return table


_SAME = "list_position(['.', '!', '?', '…'], translate(right(src, 1), '。！？', '.!?')) = list_position(['.', '!', '?', '…'], translate(right(trg, 1), '。！？', '.!?'))"
_CUT = lambda c: f"CASE WHEN {_SAME} THEN left({c}, length({c}) - 1) ELSE {c} END"
_TITLE = lambda c: f"array_to_string(list_transform(string_split({c}, ' '), lambda w: replace(upper(left(w, 1)), 'ẞ', 'Ss') || lower(w[2:])), ' ')"
_MIXED = lambda c, typed: f"CASE how WHEN 'punct' THEN {_CUT(c)} WHEN 'title' THEN {_TITLE(c)} WHEN 'upper' THEN upper(replace({c}, 'ß', 'ss')) WHEN 'typos' THEN {typed} ELSE {c} END"
_HIT = lambda what: f"{_DRAW(what)} < 0.05"
#: Merged lines by recursion over the lines of a document: what is open, and what a line closes.
MERGED = DOCS_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """, X AS (SELECT doc_id, line_no, text, verdict = 'kept' AS ok FROM R WHERE verdict NOT IN ('doc_score', 'doc_lang')),
S AS (SELECT DISTINCT doc_id, -1::BIGINT AS line_no, '' AS open, NULL::VARCHAR AS closed FROM X UNION ALL
  SELECT X.doc_id, X.line_no, CASE WHEN NOT ok THEN '' WHEN open = '' THEN text WHEN len(open) + len(text) + 1 <= 400 THEN open || ' ' || text ELSE text END,
    CASE WHEN open <> '' AND (NOT ok OR len(open) + len(text) + 1 > 400) THEN open END FROM S JOIN X ON X.doc_id = S.doc_id AND X.line_no = S.line_no + 1),
E AS (SELECT doc_id, line_no, closed AS text FROM S WHERE closed IS NOT NULL UNION ALL
  SELECT doc_id, line_no + 1, open FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no DESC) AS back FROM S) WHERE back = 1 AND open <> ''),
G AS (SELECT * FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS chunk_no, text FROM E) WHERE """ + STRIP + " <> '')"  # fmt: skip
KEYED = MERGED + f", F AS (SELECT *, row_number() OVER (PARTITION BY nfc_normalize({STRIP}) ORDER BY doc_id, chunk_no) AS nth FROM G)"
_WIKI = "'== ' || text || '[12] [[Page|shown]] [[Plain]] <code>x = 1</code> [https://e.org/a name] =='"
for _p, _t in ((r"\[\d+\]", ""), (r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", r"\1"), (r"\[https?://\S+ ([^\]]*)\]", r"\1"), (r"^=+\s*(.*?)\s*=+$", r"\1"), (r"<code>.*?</code>", "")):
    _WIKI = f"regexp_replace({_WIKI}, '{_p}', '{_t}', 'g')"

ORACLES = {
    "zip_streams": f"WITH {D.PAIRS} SELECT pos, src, trg, replace(src, ' ', '▁') AS tok_src, replace(trg, ' ', '▁') AS tok_trg, (doc_id % 9) || '-' || (line_no % 9) AS aln FROM P",
    "listed_names": "SELECT DISTINCT p_name FROM part WHERE " + " AND ".join(f"p_name NOT ILIKE '%{x}%'" for x in EXCLUDED),
    "opus_catalogue": "SELECT 'opus_c' || (p_partkey % 50) || '/v' || i AS key, 'en' AS source, 'de' AS target, p_partkey * i AS alignment_pairs, 5::BIGINT AS size FROM part, unnest([1, 2, 3]) AS u(i) WHERE p_partkey % 10 <> 0 AND (p_partkey + i) % 4 <> 0 AND p_partkey > 0",
    "table_lines": "SELECT rpad(n_nationkey::VARCHAR, greatest(len('n_nationkey'), (SELECT max(len(n_nationkey::VARCHAR)) FROM nation))::INT, ' ') || ' ' || rpad(n_name, greatest(len('n_name'), (SELECT max(len(n_name)) FROM nation))::INT, ' ') AS line FROM nation",
    "sorted_table": "SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey::VARCHAR DESC",
    "usable_sources": "SELECT doc_id FROM documents WHERE lang = 'de' AND doc_id % 5 > 1",
    "tag_changes": f"WITH {D.LINES}, A AS (SELECT doc_id, line_no, {_STACK('line_no')} AS a, {_STACK('(line_no + 1)')} AS b FROM L), N AS (SELECT *, coalesce(list_max(list_filter(range(1, 5), lambda k: a[1:k] = b[1:k] AND len(a) >= k AND len(b) >= k)), 0) AS n FROM A) SELECT doc_id, line_no, array_to_string(list_filter(list_reverse(a[n + 1:]), lambda t: t <> 'br'), ' ') AS closed, array_to_string(b[n + 1:], ' ') AS opened FROM N",
    "mean_pooling": "WITH E AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS a, list_reverse(list_transform(embedding, lambda x: x::DOUBLE)) AS b, label % 2 AS m FROM embeddings), P AS (SELECT vec_id, list_transform(list_zip(a, b), lambda z: (z[1] + m * z[2]) / (1 + m)) AS p FROM E), U AS (SELECT vec_id, list_transform(p, lambda x: x / sqrt(list_sum(list_transform(p, lambda y: y * y)))) AS v FROM P) SELECT vec_id, array_to_string(list_transform(v, lambda x: CASE WHEN round(x, 5) = 0 THEN '0.00000' ELSE round(x, 5)::DECIMAL(12,5)::VARCHAR END), ' ') AS vector FROM U",
    "word_quality": f"WITH {D.LINES}, Q AS (SELECT pos, {WORDS('text')} AS w FROM L) SELECT pos, len(w) AS words, round(list_avg(list_transform(w, lambda x: (-0.5 - len(x) / 4.0::DOUBLE) / 2)), 6) AS score FROM Q",
    "wall_clock_gaps": "WITH E AS (SELECT user_id, event_id, epoch(date_trunc('second', ts))::BIGINT AS \"at\" FROM events), A AS (SELECT *, \"at\" - lag(\"at\") OVER (PARTITION BY user_id ORDER BY event_id) AS gap FROM E), B AS (SELECT *, CASE WHEN gap > 1200 THEN coalesce(avg(CASE WHEN gap <= 1200 THEN gap END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE gap END AS fixed FROM A) SELECT user_id, event_id, \"at\", round(coalesce(sum(fixed) OVER (PARTITION BY user_id ORDER BY event_id), 0)::DOUBLE, 4) AS wall FROM B",
    "hplt_merge_lines": MERGED + " SELECT doc_id, chunk_no, text FROM G",
    "hplt_collect": KEYED + " SELECT doc_id, chunk_no, text FROM F WHERE nth = 1 ORDER BY doc_id, chunk_no LIMIT 500",
    "hplt_counters": KEYED + " SELECT (SELECT count(DISTINCT doc_id) FROM R) AS documents, " + ", ".join(f"(SELECT count({what}) FROM R WHERE verdict {test}) AS {name}" for name, what, test in (("visited", "*", "IN ('kept', 'line_lang', 'too_long')"), ("kept", "*", "= 'kept'"), ("filtered", "*", "IN ('line_lang', 'too_long')"), ("doc_score", "DISTINCT doc_id", "= 'doc_score'"), ("doc_lang", "DISTINCT doc_id", "= 'doc_lang'"), ("line_lang", "*", "= 'line_lang'"), ("too_long", "*", "= 'too_long'"))) + ", (SELECT count(*) FROM F WHERE nth > 1) AS duplicate_lines, (SELECT least(count(*), 500) FROM F WHERE nth = 1) AS final_lines",
    "fix_wiki": f"WITH {D.LINES} SELECT doc_id, line_no, {_WIKI} AS text FROM L",
    "cached_translate": f"WITH {D.LINES} SELECT pos, floor(('0x' || left(md5('3' || chr(9) || text), 8))::BIGINT / 4294967296.0::DOUBLE * 10000) / 10000 AS score FROM L",
    "augment_noise": f"WITH {D.PAIRS} SELECT pos, src, trg, false AS noise FROM P UNION ALL SELECT pos, {_THREE}, {_THREE}, true FROM P",
    "augment_typos": f"WITH {D.PAIRS} SELECT pos, t AS src FROM " + _typed("(SELECT pos, src AS t FROM P)"),
    "augment_inline_noise": f"WITH {D.PAIRS}, Y AS (SELECT *, string_split(src, ' ') AS s, string_split(trg, ' ') AS t FROM P) SELECT pos, CASE WHEN pos % 3 > 0 THEN array_to_string(list_concat(s[1:1], [{_NOISE(0)}], s[2:]), ' ') ELSE src END AS src, CASE WHEN pos % 3 > 0 THEN array_to_string(list_concat(t[1:1], [{_NOISE(0)}], t[2:]), ' ') ELSE trg END AS trg FROM Y",
    "augment_mix": f"WITH {D.PAIRS}, H AS (SELECT pos, src, trg, src AS t, CASE WHEN {_HIT('punct')} THEN 'punct' WHEN {_HIT('title')} THEN 'title' WHEN {_HIT('upper')} THEN 'upper' WHEN {_HIT('typos')} THEN 'typos' END AS how FROM P) SELECT pos, {_MIXED('src', 't')} AS src, {_MIXED('trg', 'trg')} AS trg, how FROM {_typed('H')} UNION ALL SELECT pos, {_THREE}, {_THREE}, 'noise' FROM P WHERE {_HIT('noise')}",
}
