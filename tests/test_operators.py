"""Operators on small rows whose results are known."""

from collections import Counter

import re
import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import align, catalog, clean, evaluate, logs, measure, merge, rank, sample, scorers
from weftline.sources import files

#: Three corpora: within the hills two targets repeat, lakes and hills share three, and one target is in all three.
PAIRS = {
    "hills": [("oak", "chêne", 0.4), ("elm", "orme", 0.9), ("old elm", "orme", 0.2), ("ash", "frêne", 0.7), ("fir", "sapin", 0.5), ("a fir", "sapin", 0.5), ("rock", "roche", 0.3)],
    "lakes": [("oak tree", "chêne", 0.8), ("pike", "brochet", 0.6), ("ash tree", "frêne", 0.1), ("reed", "roseau", 1.0), ("rocks", "roche", 0.3)],
    "plains": [("an oak", "chêne", 0.8), ("hare", "lièvre", 0.05)],
}


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(d, i, *r) for d, rs in PAIRS.items() for i, r in enumerate(rs)], "dataset string, pos long, src string, trg string, score double")


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_best_per_target(pairs):
    """The highest score wins; of equal scores the first by corpus and place."""
    kept = {(r.dataset, r.src) for r in merge.best_per_target(pairs).collect()}
    assert kept == {("hills", "elm"), ("hills", "ash"), ("hills", "fir"), ("hills", "rock"), ("lakes", "oak tree"), ("lakes", "pike"), ("lakes", "reed"), ("plains", "hare")}
    got = {r.dataset: (r.visited, r.kept, r.filtered) for r in merge.kept_by_dataset(pairs).collect()}
    assert got == {"hills": (7, 4, 3), "lakes": (5, 3, 2), "plains": (2, 1, 1), None: (14, 8, 6)}


def test_mono(spark):
    parallel = spark.createDataFrame([(t,) for t in ("sun", "moon", "e\u0301toile", "moon")], "text string")
    papers = ["rain", "sun", "snow", "rain ", "wind"]
    forum = ["étoile", "wind", "hail", "moon", "hail", "fog"]
    mono = spark.createDataFrame([(d, i, t) for d, ts in (("papers", papers), ("forum", forum)) for i, t in enumerate(ts)], "dataset string, pos long, text string")
    assert {(r.dataset, r.pos, r.text) for r in merge.first_lines(mono, parallel).collect()} == {("papers", 0, "rain"), ("papers", 2, "snow"), ("forum", 1, "wind"), ("forum", 2, "hail"), ("forum", 5, "fog")}
    r = merge.mono_stats(mono, parallel).first()
    assert (r.visited, r.kept, r.filtered, r.parallel_duplicates, r.mono_duplicates, r.final_codepoints, r.parallel_corpus_lines) == (11, 5, 6, 3, 3, 24, 3)
    none = merge.mono_stats(mono.where("1 = 0"), parallel).first()
    assert (none.visited, none.kept, none.parallel_duplicates, none.mono_duplicates, none.final_codepoints, none.parallel_corpus_lines) == (0, 0, 0, 0, 0, 3)


def test_zip_by_position_raises_on_a_gap(spark):
    a = spark.createDataFrame([("d", 0, "x"), ("d", 1, "y")], "dataset string, pos long, src string")
    b = spark.createDataFrame([("d", 0, "u")], "dataset string, pos long, trg string")
    assert [tuple(r) for r in merge.zip_by_position(a.where("pos = 0"), b).collect()] == [("d", 0, "x", "u")]
    with pytest.raises(Exception, match="no partner at d 1"):
        merge.zip_by_position(a, b).collect()


def test_tsv_strips_all_white_space(spark):
    rows = spark.createDataFrame([("d", 0, " a\tb\u3000", "\xa0c\n", " 0-0 "), ("d", 1, "x", "y", " \t\xa0")], "dataset string, pos long, src string, trg string, aln string")
    assert [r.line for r in merge.build_tsv(rows).collect()] == ["a b\tc\t0-0"]


def test_keys(spark):
    rows = ["é", "é", " x", "\x1cx", "　x ", "\tx", "x", ""]
    got = [r.k for r in spark.createDataFrame([(t,) for t in rows], "t string").select(T.norm_key(F.col("t")).alias("k")).collect()]
    assert got[0] == got[1] and set(got[2:7]) == {"x"} and got[7] == ""


def test_deescape_order(spark):
    assert one(spark, T.deescape(F.lit("&amp;lt; &lt; &#124;"))) == "&lt; < |"


def test_chunks(spark):
    df = spark.range(47)
    got = {r.chunk: r.n for r in sample.chunks(df, 10, F.floor(F.col("id") / 7), F.col("id")).groupBy("chunk").agg(F.count("*").alias("n")).collect()}
    assert got == {**{k: 5 for k in range(1, 10)}, 10: 2}


def test_bounded_sample_is_even(spark):
    df = sample.bounded(spark.range(100_000), 20_000, 1, F.col("id"))
    got = df.groupBy(F.floor(F.col("id") / 10_000)).count().collect()
    assert df.count() == 20_000 and all(abs(r["count"] / 20_000 - 0.1) < 0.01 for r in got)


def test_ranks_are_global(spark):
    """Ranks over more stretches than are summed at once, and within groups."""
    df = spark.range(30_000).select((29_999 - F.col("id")).alias("x"), (F.col("id") % 3).alias("g"))
    got = sample.ranked(df, F.floor(F.col("x") / 2), F.col("x")).agg(F.max(F.abs(F.col("x") - F.col("rank"))).alias("off"), F.min("total").alias("a"), F.max("total").alias("b")).first()
    assert (got.off, got.a, got.b) == (0, 30_000, 30_000)
    got = sample.ranked(df, F.floor(F.col("x") / 7), F.col("x"), by=("g",)).agg(F.max(F.abs(F.floor(F.col("x") / 3) - F.col("rank"))).alias("off"), F.max("total").alias("n")).first()
    assert (got.off, got.n) == (0, 10_000)


def test_trim_cuts_within_ties(spark):
    df = spark.range(100).select("id", (F.floor(F.col("id") / 10) / 10.0).alias("score"))
    for share, left in ((0.05, 96), (0.155, 86), (0.0, 100), (1.0, 1)):
        got = sample.trim_worst(df, share, "score", F.floor(F.col("id") / 3), F.col("id"))
        assert sorted(r.id for r in got.collect()) == list(range(100 - left, 100))


def test_padded_batches_and_turns(spark):
    df = spark.range(50).select("id", F.lit(10).alias("n"))
    assert {r["count"] for r in sample.padded_batches(df, 40, "n", F.floor(F.col("id") / 4), F.col("id")).groupBy("batch").count().collect()} == {4, 2}
    got = sample.round_robin(spark.range(20).select("id", (F.col("id") < 18).cast("int").alias("c")), 6, "c", "id").collect()
    assert [(r.c, r.id) for r in got] == [(0, 19), (1, 17), (0, 18), (1, 16), (1, 15), (1, 14)]


def test_word_bounds(spark):
    rows = spark.createDataFrame([(t,) for t in ("", " ", "a", " a b ", "a\u3000b\xa0c", "a " * 150, "a " * 151)], "t string")
    assert [r.x for r in rows.select(clean.words_between(F.col("t"), 1, 150).alias("x")).collect()] == [False, False, True, True, True, True, False]


def test_batched_bleu_equals_the_plain_one():
    import pandas as pd

    rng = np.random.default_rng(3)
    made = [" ".join(rng.choice(list("abcd"), rng.integers(0, 12))) for _ in range(400)]
    a, b = pd.Series([*made[:200], None, "a b c d"]), pd.Series([*made[200:], "x", None])
    assert rank.bleu_batch(a, b) == pytest.approx([rank.bleu(x or "", y or "") for x, y in zip(a, b, strict=True)], abs=1e-12)


@pytest.mark.parametrize("piece", [rank.PIECE, 700])
def test_batched_chrf_equals_the_plain_one(monkeypatch, piece):
    """Changed copies, unlike texts, nulls, blanks and many different signs; texts in one piece and in several."""
    import pandas as pd

    monkeypatch.setattr(rank, "PIECE", piece)
    rng = np.random.default_rng(3)
    made = ["".join(rng.choice(list("abAB c\u3000\n\U0001f600"), rng.integers(0, 50))) for _ in range(600)]
    changed = [t[:20].lower() + t[21:] if i % 2 else made[i * 7 % 600] for i, t in enumerate(made)]
    many = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 300))) for _ in range(20)]
    a = pd.Series([*made, *many, None, "x", None])
    b = pd.Series([*changed, *("".join(rng.permutation(list(t))) + t[5:40] for t in many), "y", None, None])
    assert rank.chrf_batch(a, b) == pytest.approx([rank.chrf(x or "", y or "") for x, y in zip(a, b, strict=True)], abs=1e-12)
    assert rank.bleu_batch(a, b) == pytest.approx([rank.bleu(x or "", y or "") for x, y in zip(a, b, strict=True)], abs=1e-12)
    assert "chrf" in rank.BATCHED and not len(rank.chrf_batch(a[:0], b[:0]))


def test_only_the_metrics_asked_for_are_counted(spark):
    df = spark.createDataFrame([("p", "a b c d e", "a b c d f"), ("q", "no", "one two"), ("q", None, "a")], "k string, hyp string, ref string")
    both = {r.k: r for r in evaluate.corpus_scores(df, "k").collect()}
    for name in ("bleu", "chrf"):
        got = evaluate.corpus_scores(df, "k", metrics=(name,))
        assert got.columns == ["k", "lines", name]
        assert {r.k: r[name] for r in got.collect()} == {k: r[name] for k, r in both.items()}


def test_corpus_scores(spark):
    """Sums over the corpus, not means of sentences; a perfect corpus has 100 of both."""
    df = spark.createDataFrame([("p", "a b c d e", "a b c d e"), ("p", "u v w x", "u v w x"), ("q", "a b c d x", "a b c d e f"), ("q", "no", "one two"), ("r", "z", "a")], "k string, hyp string, ref string")
    got = {r.k: r for r in evaluate.corpus_scores(df, "k").collect()}
    assert (got["p"].bleu, got["p"].chrf) == pytest.approx((100, 100)) and (got["r"].bleu, got["r"].chrf) == (0, 0)
    match, possible = (4, 3, 2, 1), (6, 4, 3, 2)
    want = 100 * np.exp(1 - 8 / 6) * np.prod([m / n for m, n in zip(match, possible, strict=True)]) ** 0.25
    assert got["q"].bleu == pytest.approx(want)
    grams = lambda t, n: Counter(t[i : i + n] for i in range(len(t) - n + 1))
    sides, p, q = [("abcdx", "abcdef"), ("no", "onetwo")], [], []
    for n in range(1, 7):
        both, h, r = sum((grams(a, n) & grams(b, n)).total() for a, b in sides), sum(grams(a, n).total() for a, _ in sides), sum(grams(b, n).total() for _, b in sides)
        if h and r:
            p.append(both / h)
            q.append(both / r)
    p, q = sum(p) / len(p), sum(q) / len(q)
    assert got["q"].chrf == pytest.approx(100 * 5 * p * q / (4 * p + q))


def test_generations_must_be_whole(spark):
    flat = spark.range(6).select(F.col("id").alias("pos"), F.col("id").cast("string").alias("text"))
    assert [r.candidates for r in evaluate.grouped_generations(flat, 3, 2).orderBy("input").collect()] == [["0", "1", "2"], ["3", "4", "5"]]
    with pytest.raises(Exception, match="not 4 candidates"):
        evaluate.grouped_generations(flat, 4, 2).collect()


def test_answers(spark):
    texts = ["```json\n{\"a\": [1, 2,],}\n```", "so:\n```\n{\"a\": []}\n``` end", " {\"a\": [3]} ", "none", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(evaluate.parsed_answer(F.col("t"), "a ARRAY<INT>").alias("x")).collect()
    assert [r.x.a if r.x else None for r in got] == [[1, 2], [], [3], None, None]
    assert one(spark, T.last_line(F.lit("thinking\nthe answer\u3000\n \t\n"))) == "the answer"


def test_bleu_short_is_zero():
    assert rank.bleu("a b c", "a b c") == 0.0 and rank.bleu("a b c d", "a b c d") == pytest.approx(1.0)
    assert rank.bleu("a b c d", "") > 0 and rank.chrf("abc", "abc") == pytest.approx(1.0) and rank.chrf("", "a") == 0.0


def test_shortlist(spark):
    lex = spark.createDataFrame([("a", "x", 0.5), ("a", "y", 0.3), ("a", "z", 0.2), ("b", "z", 1.0), ("c", "z", 0.1), ("c", "w", 0.9)], "src string, trg string, prob double")
    assert {(r.src, r.trg) for r in rank.shortlist(lex, 1, -1).collect()} == {("a", "x"), ("a", "z"), ("b", "z"), ("c", "w"), ("c", "z")}


def test_lexical_table(spark):
    """Every aligned word counts, the later ones of a text too."""
    df = spark.createDataFrame([("big dog", "gros chien", [(0, 0), (1, 1)]), ("dog", "chienne", [(0, 0), (0, 7)])], "src string, trg string, alignment array<struct<s:int,t:int>>")
    assert {tuple(r) for r in rank.lexical_table(df).collect()} == {("big", "gros", 1.0), ("dog", "chien", 0.5), ("dog", "chienne", 0.5)}


def test_symmetrize():
    """The diagonal is agreed on; neighbours join while a word lacks a pair, and far pairs of lonely words come last."""
    f, b = {(0, 0), (1, 1), (2, 1), (4, 4)}, {(0, 0), (1, 1), (1, 2), (5, 5)}
    assert align.grow_diag_final_and(f, b) == [(0, 0), (1, 1), (1, 2), (2, 1), (4, 4), (5, 5)]
    assert align.grow_diag_final_and({(0, 1)}, {(1, 0)}) == [(0, 1), (1, 0)] and align.grow_diag_final_and(set(), set()) == []


def test_tags_and_joins(spark):
    closed, opened = align.tag_changes(F.array(*map(F.lit, ("p", "b", "i"))), F.array(*map(F.lit, ("p", "u"))))
    assert one(spark, closed) == ["i", "b"] and one(spark, opened) == ["u"]
    df = spark.createDataFrame([(1, 0, "A.", "  "), (1, 1, "B.", "\n")], "d long, i long, t string, g string")
    r = align.concatenated(df, "d", "i", "t", "g").first()
    assert (r.faithful, r.spaced) == ("A.  B.", "A. B.")


def test_index_map():
    assert align.index_map("Well , yes !".split(), "Well, yes!".split()) == [0, 0, 1, 1]
    assert align.index_map("So , up-to-date and - fine .".split(), "So, up-to-date and - fine.".split()) == [0, 0, 1, 2, 3, 4, 4]
    assert align.index_map([], []) == []


def test_quality_scores():
    """The features, coefficients and scores of a published model's test."""
    f = np.array([[-0.3, -0.3, 1, -0.183683336], [-0.0001, -0.0001, 1, -0.183683336], [-0.002, -0.002, 1, -0.183683336], [-0.5, -0.5, 1, -0.183683336], [-0.15, -0.2, 2, -0.183683336]])
    got = align.quality_scores(f, np.array([0.99, 0.9, -0.2, 0.5]), -0.3, np.array([0.2, 0.3, 2.5, 0.1]), np.array([-0.1, -0.77, 5, -0.5]))
    assert got == pytest.approx([-2.14596, -4.41793, -4.403, -0.93204, -3.03343], abs=1e-3)


def test_word_quality(spark):
    """The five words of the published model's test, the last of two tokens, before an end."""
    probs = [-0.3, -0.0001, -0.002, -0.5, -0.2, -0.1, -0.101]
    tokens = ["How", " are", " you", " do", " ing", "?", ""]
    assert align.word_ranges(tokens) == [(0, 1), (1, 2), (2, 3), (3, 4), (4, 6)]
    assert align.word_features(np.array(probs), align.word_ranges(tokens))[4] == pytest.approx([-0.15, -0.2, 2, sum(probs[:6]) / 6])
    model = {"coefficients": np.array([0.99, 0.9, -0.2, 0.5]), "intercept": -0.3, "scale": np.array([0.2, 0.3, 2.5, 0.1]), "mean": np.array([-0.1, -0.77, 5, -0.5])}
    df = spark.createDataFrame([(tokens, probs), ([], []), ([""], [-1.0]), (None, None)], "t array<string>, p array<double>")
    got = [r.x for r in df.select(align.word_quality(F.col("t"), F.col("p"), model).alias("x")).collect()]
    assert [w.score for w in got[0].words] == pytest.approx([-2.14596, -4.41793, -4.403, -0.93204, -3.03343], abs=1e-2)
    assert [(len(x.words), x.score) for x in got[1:]] == [(0, None)] * 3
    plain = df.select(align.word_quality(F.col("t"), F.col("p")).alias("x")).first().x
    assert plain.words[4].score == pytest.approx(-0.15) and plain.words[0].end == 1


def test_words_align_as_one():
    """A word of two tokens goes where the later one points, unless that one is less likely and outside the former's markup."""
    soft = np.array([[0.9, 0.1, 0, 0], [0.2, 0.8, 0, 0], [0, 0.3, 0.6, 0.1], [0, 0.1, 0.2, 0.7]])
    tokens = ["Wor", "ld", " now", ""]
    assert list(align.hard_alignment(soft)) == [0, 1, 2, 3]
    assert list(align.hard_alignment(soft, tokens)) == [1, 1, 2, 3]
    tags = [("b",), (), (), ()]
    assert list(align.hard_alignment(soft, tokens, tags)) == [0, 0, 2, 3]
    soft[1] = [0.05, 0.95, 0, 0]
    assert list(align.hard_alignment(soft, tokens, tags)) == [1, 1, 2, 3]
    assert not align.goes_on("a,", "b") and not align.goes_on("a", " b") and align.goes_on("a", "b")


def test_pivot_of_other_cuts():
    """Pivot 'abcd' as ab|cd|end on the source side and abc|d|end on the target side; rows stay distributions."""
    source_side, target_side = np.array([[0, 2], [2, 4], [4, 4]]), np.array([[0, 3], [3, 4], [4, 4]])
    assert align.shared_bytes(source_side, target_side) == pytest.approx(np.array([[2 / 3, 1 / 3, 0], [0, 1, 0], [0, 0, 1]]))
    first, second = np.array([[1.0, 0], [0, 1.0], [0, 1.0]]), np.array([[0.5, 0.5, 0], [0, 0, 1.0]])
    got = align.compose(first, second, source_side, target_side)
    assert got == pytest.approx(np.array([[1 / 3, 2 / 3], [0, 1]])) and got.sum(axis=1) == pytest.approx([1, 1])
    assert align.compose(np.eye(2), np.eye(2)) == pytest.approx(np.eye(2))


def test_catalogue_forms(spark):
    df = spark.createDataFrame([("Bibel-v2", 3), ("abc", 20), ("Abd", None), ("abc", 1)], "name string, n int")
    assert [r.name for r in catalog.listed(df, "name", ["BIBEL"]).collect()] == ["Abd", "abc"]
    assert {r.line for r in catalog.table_lines(df, ["name", "n"]).collect()} == {"Bibel-v2 3 ", "abc      20", "Abd        ", "abc      1 "}
    assert [r.n for r in catalog.by_text(df, "n").collect()] == [None, 1, 20, 3] and [r.n for r in catalog.by_text(df, "n", True).collect()] == [3, 20, 1, None]
    answer = '{"corpora": [{"corpus": "Books", "version": "v1", "source": "en", "target": "de", "alignment_pairs": 7}, {"corpus": "X", "version": "v2", "alignment_pairs": ""}]}'
    got = catalog.opus_entries(spark.createDataFrame([(answer,), ("no json",), (None,)], "value string")).collect()
    assert [(r.key, r.alignment_pairs) for r in got] == [("opus_Books/v1", 7)]
    lp = spark.createDataFrame([("en-de", False), ("en-de", True), ("en-fi", False), ("en-de", None)], "lp string, is_bad_source boolean")
    assert catalog.usable_sources(lp, "en-de").count() == 1


def test_gaps(spark):
    """A break before any gap counts nothing; later ones count the mean of the gaps that were no breaks."""
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate((0, 5000, 5100, 5300, 9000, 9010))], "run int, i int, at long")
    assert [r.wall for r in logs.gap_corrected(df, "run", "i", "at").orderBy("i").collect()] == pytest.approx([0, 0, 100, 300, 450, 460])


def test_zipped(spark):
    side = lambda xs: spark.createDataFrame(list(enumerate(xs)), "pos long, text string")
    got = merge.zipped({"a": side(["x", None]), "b": side(["y", "z"]), "c": side(["1", "2"])}).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(0, "x", "y", "1"), (1, None, "z", "2")]
    with pytest.raises(Exception, match="differ in length at 1"):
        merge.zipped({"a": side(["x"]), "b": side(["y", "z"])}).collect()


def test_page_text():
    assert align.page_text("<p>hello <b>world</b></p><script>x</script>") == ("hello world", True)
    assert align.page_text("<p>a<div>b</p> &amp; c") == ("a\nb\n& c", False)
    assert align.page_text("") == ("", True)


def test_chinese(spark):
    t, s = "中文簡繁轉換開源項目", "中文简繁转换开源项目"
    assert one(spark, clean.chinese_script(F.lit(t))) == "traditional" and one(spark, clean.chinese_script(F.lit(s))) == "simplified"
    assert one(spark, clean.chinese_script(F.lit("hello"))) == "none"
    assert one(spark, clean.convert_chinese(F.lit("開源"), "simplified")) == "开源" and one(spark, clean.convert_chinese(F.lit("hello"), "simplified")) == "hello"


def test_merge_lines(spark):
    df = spark.createDataFrame([(1, ["en"], [9.0], ["en", "en", "unk", "en"], "aa\nbb\ncc\ndd\nlost"), (2, ["en"], [1.0], ["en"], "x")], "doc_id long, lang array<string>, doc_scores array<double>, seg_langs array<string>, text string")
    assert [(r.doc_id, r.text) for r in clean.merge_lines(df, "en", 3.0, 5).orderBy("doc_id", "chunk_no").collect()] == [(1, "aa bb"), (1, "dd")]
    assert clean.document_lines(df, "en", 3.0, 5).where("verdict = 'kept'").count() == 3


def test_log_edges_are_closed(spark):
    h = spark.createDataFrame([(0, 5), (1, 1), (2, 1), (1000, 1)], "value long, n long")
    assert measure.log_histogram(h).agg(F.sum("n")).first()[0] == 3


def test_search_and_versions(spark):
    assert T.search_terms('a src:en -trg:"x y" "b c"') == ([("src", "en", False), ("trg", "x y", True)], ["a", "b c"])
    df = spark.createDataFrame([("1.0",), ("1.0a1",), ("1.10",), ("2.0",), ("1.9.1",)], "v string")
    assert [r.v for r in df.orderBy(catalog.version_key(F.col("v"))).collect()] == ["1.0a1", "1.0", "1.10", "2.0", "1.9.1"]


def test_gaps(spark):
    df = spark.createDataFrame([("r", i, t) for i, t in enumerate((0, 10, 30, 5000))], "run string, i long, at long")
    assert [r.wall for r in logs.gap_corrected(df, "run", "i", "at").orderBy("i").collect()] == [0.0, 10.0, 30.0, 45.0]


def test_tokenizer_round_trip(spark):
    t = scorers.SpaceTokenizer()
    assert one(spark, t.detokenize(t.tokenize(F.lit("abc def. 2016, pp.")))) == "abc def. 2016, pp."
    assert one(spark, F.array_join(t.tokenize(F.lit("abc def.")), " ")) == "abc ▁ def ."


def test_labels(spark):
    """Names that begin alike, numbers in three places, importers named twice, and labels of neither kind."""
    want = {
        "train-teacher-all-2-en-xx": ("teacher-all-2", None, None, None), "teacher-en-xx-1_2": ("teacher-1", None, None, None), "train-teacher-en-xx": ("teacher-1", None, None, None),
        "backtranslations-train-backwards-model-en-xx": ("backwards", None, None, None), "finetuned-student-en-xx": ("finetune-student", None, None, None), "train-student": ("student", None, None, None),
        "evaluate-backward-url-news_2020-en-xx": ("backwards", "url", "news_2020", None), "eval_teacher-base3_flores_dev": ("teacher-base-3", "flores", "dev", None),
        "evaluate-student-sacrebleu-sacrebleu_aug-upper_wmt08-en-xx": ("student", "sacrebleu", "wmt08", "aug-upper"), "evaluate-teacher-mtdata_Some-set_test-1-eng-xxx-en-xx-2/3": ("teacher-2", "mtdata", "Some-set_test-1-eng-xxx", None),
        "train-studently-en-xx": (None,) * 4, "evaluate-student-elsewhere_dev": (None,) * 4, "merge-corpus-en-xx": (None,) * 4, "": (None,) * 4,
    }
    got = {r.label: (r.model, r.importer, r.dataset, r.augmentation) for r in logs.parsed_labels(spark.createDataFrame([(k,) for k in want], "label string")).collect()}
    assert got == want


def test_log_lines(spark):
    rows = [
        ("[2024-01-01 00:00:00] Ep. 1 : Up. 500 : Sen. 1,234,567 : Cost 3.25 * 900 after 8 : Time 12.50s : 900.10 words/s : gNorm 0.5 : L.r. 3.0e-04",), ("[x] Ep. 2 : Up. 7 : Sen. 9 : Cost -1.0 : Time 1s : 1 words/s : gNorm 1",),
        ("[t] [valid] Ep. 1 : Up. 500 : ce-mean-words : 2.25 : stalled 3 times (last best: 2.1)",), ("[t] [valid] Ep. 1 : Up. 500 : chrf : 50.5 : new best",), ("[valid] nothing",), ("plain",),
    ]
    lines = spark.createDataFrame(rows, "text string")
    (r,) = logs.training_epochs(lines).collect()
    assert (r.epoch, r.up, r.sen, r.cost, r.time, r.rate, r.gnorm, r.learning_rate) == (1, 500, 1_234_567, 3.25, 12.5, 900.1, 0.5, 3e-4)
    assert sorted((r.key, r.value, r.stalled) for r in logs.validation_values(lines).collect()) == [("ce_mean_words", 2.25, 3), ("chrf", 50.5, None)]


def test_filter_configuration():
    have = {"ru-en/opus_set-v1", "zh-en/default", "opus_lake-v1", "mtdata_hill"}
    assert clean.filter_config("opus_set/v1", "ru", "en", have) == ("ru-en/opus_set-v1", [])
    assert clean.filter_config("opus_set/v1", "fr", "en", have) == ("default", ["currency_mismatch"])
    assert clean.filter_config("opus_lake/v1", "fr", "en", have) == ("opus_lake-v1", ["currency_mismatch"])
    assert clean.filter_config("opus_lake/v1", "fr", "en", have, "defaults") == ("default", ["currency_mismatch"])
    assert clean.filter_config("opus_lake/v1", "zh", "en", have) == ("zh-en/default", []) and clean.filter_config("mtdata_hill", "en", "ru", have) == ("mtdata_hill", [])


def test_augmentations(spark):
    df = spark.range(4000).select("id", F.lit("one two three.").alias("src"), F.lit("un deux trois.").alias("trg"))
    assert scorers.typos(df, "src", "id").where("src = 'one two three.'").count() < 200
    assert scorers.noise_pairs(df, "id").count() == 8000 and scorers.noise_pairs(df, "id").where("noise AND src <> trg").count() == 0
    got = {r.how: r["count"] for r in scorers.augment_mix(df, "id", True, True).groupBy("how").count().collect()}
    assert got[None] > 3000 and all(120 < got[k] < 280 for k in ("punct", "title", "upper", "typos", "noise"))
    assert set(r.how for r in scorers.augment_mix(df, "id", False, False).select("how").distinct().collect()) == {None, "punct", "noise"}
    a, b = scorers.strip_endings(F.lit("Why?"), F.lit("为什么？"))
    assert (one(spark, a), one(spark, b)) == ("Why", "为什么") and one(spark, scorers.strip_endings(F.lit("Why?"), F.lit("So."))[0]) == "Why?"


def test_hplt_collects_across_documents(spark):
    """A line that an earlier document gave is a duplicate; lines stop at the limit, in the documents' order."""
    rows = [(1, ["en"], [9.0], ["en", "en"], "aaaa\nbbbb"), (2, ["en"], [9.0], ["en", "fr", "en"], "aaaa\nzz\ncccccccc"), (3, ["en"], [1.0], ["en"], "low"), (4, ["de"], [9.0], ["en"], "de"), (5, ["en"], [9.0], ["en"], " bbbb ")]
    df = spark.createDataFrame(rows, "doc_id long, lang array<string>, doc_scores array<double>, seg_langs array<string>, text string")
    lines, counters = clean.collected_lines(df, "en", 3.0, 6, 2)
    assert [(r.doc_id, r.text) for r in lines.collect()] == [(1, "aaaa"), (1, "bbbb")]
    r = counters.first()
    assert (r.documents, r.visited, r.kept, r.filtered, r.doc_score, r.doc_lang, r.line_lang, r.too_long, r.duplicate_lines, r.final_lines) == (5, 6, 4, 2, 1, 1, 1, 1, 2, 2)


def test_zip_lines_end_as_in_text_files(spark, tmp_path):
    """Separators that Python's splitlines knows and line files don't are no ends of lines."""
    import zipfile

    body = "a\x1cb c\x85d\u2028e\r\nf\rg\x0bh\n"
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("m.txt", body)
    (tmp_path / "m.txt").write_bytes(body.encode())
    of = lambda name: [r.text for r in files.read_lines(spark, str(tmp_path / name)).orderBy("line_no").collect()]
    assert of("z.zip") == of("m.txt") == ["a\x1cb c\x85d\u2028e", "f", "g\x0bh"]


def test_files_of_many_splits_keep_their_order(spark, tmp_path):
    (tmp_path / "long.txt").write_text("".join(f"line {i}\n" for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        got = files.read_lines(spark, str(tmp_path / "long.txt"))
        assert got.where(F.col("text") != F.concat(F.lit("line "), F.col("line_no").cast("string"))).count() == 0 and got.count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    some = spark.createDataFrame([("a", "b"), ("c", "d")], "src string, trg string")
    files.write_sample(some, str(tmp_path / "sample"), 10)
    text = "".join(p.read_text() for p in (tmp_path / "sample").glob("part-*"))
    assert text.startswith(files.BOM) and text.count(files.BOM) == 1 and "a\nb\n" in text


def test_nearest_centroid(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, None), (4, [1.0])], "id long, v array<double>")
    centroids = spark.createDataFrame([(7, [1.0, 0.0]), (5, [1.0, 0.0]), (9, [0.0, 1.0])], "id long, v array<double>")
    assert [(r.id, r.cluster, r.similarity) for r in measure.nearest_centroid(df, "v", centroids).orderBy("id").collect()] == [(1, 5, 1.0), (2, 9, 0.8), (3, None, None), (4, None, None)]
    pooled = one(spark, measure.mean_pooled(F.array(F.array(F.lit(3.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(4.0)), F.array(F.lit(9.0), F.lit(9.0))), F.array(F.lit(1), F.lit(1), F.lit(0))))
    assert pooled == pytest.approx([0.6, 0.8])


def test_files(spark, tmp_path):
    import gzip
    import zipfile

    (tmp_path / "a.en").write_text("one\ntwo\n")
    with gzip.open(tmp_path / "a.fr.gz", "wt") as f:
        f.write("un\ndeux\n")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("m.txt", "x\ny\n")
    got = files.read_parallel(spark, str(tmp_path / "a.en"), str(tmp_path / "a.fr.gz"), dataset="d").orderBy("pos").collect()
    assert [(r.src, r.trg, r.score) for r in got] == [("one", "un", 1.0), ("two", "deux", 1.0)]
    assert [r.text for r in files.read_lines(spark, str(tmp_path / "z.zip")).orderBy("line_no").collect()] == ["x", "y"]
    (tmp_path / "b.fr").write_text("un\n")
    with pytest.raises(Exception, match="differ in length"):
        files.read_parallel(spark, str(tmp_path / "a.en"), str(tmp_path / "b.fr")).collect()


def test_stream_assembles(spark, tmp_path):
    from weftline.streaming.events import assemble_stream

    keys = ("chrf", "ce-mean-words", "bleu-detok")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "log.txt").write_text("".join(f"[2024-01-01 00:00:00] [valid] Ep. 1 : Up. {u} : {k} : {u}.5 : new best\n" for u in (500, 1000) for k in keys[: 3 if u == 500 else 2]))
    lines = spark.readStream.text(str(tmp_path / "in")).withColumnRenamed("value", "text")
    q = assemble_stream(lines, None).writeStream.format("memory").queryName("assembled").option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert [tuple(r) for r in spark.sql("select epoch, up, chrf from assembled").collect()] == [(1, 500, 500.5)]


def test_mono_rules_by_table_equal_plain_python(spark):
    """Each rule against str methods on odd white space, signs and languages; as the query asks, the rule is worked out once, without regexes."""
    rng, known = np.random.default_rng(1), list("aéßZ1.-?  \t\x1c\x85\xa0　​漢\U0001f600")
    rows = [("".join(rng.choice(known, rng.integers(0, 25))), ["en", "de", "fr", "es", "zh", "xx", None][i % 7]) for i in range(3000)]
    rows += [(None, "en"), ("a b", None), ("a " * 150, "en"), ("a " * 151, "en"), ("漢" * 151, "ja"), ("漢", "ko")]

    def plain(text, lang):
        if text is None:
            return None
        t = text.strip()
        words = list(t) if lang in clean.BY_CHARACTER else t.split()
        if not t:
            return "EMPTY"
        if not 2 <= len(words) <= 150:
            return "TOO_SHORT" if len(words) < 2 else "TOO_LONG"
        if lang in clean.ALPHABETS:
            letter = re.compile(f"[{clean.ALPHABETS[lang]}]")
            if sum(bool(letter.match(w)) for w in words) / len(words) < 0.4:
                return "RATIO_ALPHA"
            if len(letter.findall(t)) / len(t.replace(" ", "")) < 0.5:
                return "RATIO_CHARS"
        return None

    df = clean.mono_reasons(spark.createDataFrame(rows, "text string, lang string"))
    assert [r.reason for r in df.collect()] == [plain(*r) for r in rows]
    plan = df.where("coalesce(reason, 'KEPT') = 'KEPT'").select("text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "regexp" not in plan
