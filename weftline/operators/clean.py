"""Filters on one text or on a pair, as reasons and predicates, and document filters of scored crawls."""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import SPACE, count_words, norm_key, strip

#: Letters of languages whose share is checked; ours.
ALPHABETS = {"en": "A-Za-z", "de": "A-Za-zÄÖÜäöüß", "fr": "A-Za-zÀÂÆÇÈÉÊËÎÏÔŒÙÛÜŸàâæçèéêëîïôœùûüÿ", "es": "A-Za-zÁÉÍÑÓÚÜáéíñóúü"}
BY_CHARACTER = ("zh", "ja", "ko")
MIN_WORDS, MAX_WORDS, WORD_SHARE, CHAR_SHARE = 2, 150, 0.4, 0.5
URL = r"https?://[^\s]+|www\.[^\s]+"


#: Why a line is dropped, in the order of the rules.
REASONS = ["EMPTY", "TOO_SHORT", "TOO_LONG", "RATIO_ALPHA", "RATIO_CHARS"]
#: Characters that are looked at at once.
PIECE = 500_000


@cache
def _kinds() -> np.ndarray:
    """What each character is, as bits: white space, a plain space, a letter of each of ALPHABETS."""
    kinds = np.zeros(0x110000, np.uint8)
    for k, signs in enumerate([SPACE, " ", *ALPHABETS.values()]):
        found = np.array([ord(c) for c in re.findall(f"[{signs}]", "".join(map(chr, range(0x3001))), re.ASCII)])
        kinds[found] |= 1 << k
    return kinds


def failed_rule(texts: list[str], langs: list[str | None], kinds: np.ndarray) -> np.ndarray:
    """The number of the first rule in REASONS that each text fails, from 1, or 0."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends, kind = np.cumsum(size), kinds[points]
    sums = lambda x: (lambda c: c[ends] - c[ends - size])(np.append(0, np.cumsum(x)))
    solid = kind & 1 == 0
    after = np.append(True, ~solid[:-1])[: len(solid)]  # what is before is white space, or another text
    after[(ends - size)[size > 0]] = True
    start = solid & after
    # The stripped text: from the first to the last character that isn't white space.
    at, n_solid = np.flatnonzero(solid), sums(solid)
    last = np.cumsum(n_solid)
    some = n_solid > 0
    length, spaces, total = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.append(0, np.cumsum(kind & 2 > 0))
    first, end = at[(last - n_solid)[some]], at[last[some] - 1] + 1
    length[some], spaces[some] = end - first, total[end] - total[first]
    lang = np.array([x or "" for x in langs], object)
    n = np.where(np.isin(lang, BY_CHARACTER), length, sums(start))
    bad_words, bad_signs = np.zeros(len(texts), bool), np.zeros(len(texts), bool)
    for k, code in enumerate(ALPHABETS, 2):
        if len(own := np.flatnonzero((lang == code) & (n > 0))):
            letter = kind >> k & 1 == 1
            bad_words[own] = sums(start & letter)[own] / n[own] < WORD_SHARE
            bad_signs[own] = sums(letter)[own] / (length - spaces)[own] < CHAR_SHARE
    return np.select([~some, n < MIN_WORDS, n > MAX_WORDS, bad_words, bad_signs], [1, 2, 3, 4, 5], 0).astype(np.int32)


def mono_reasons(lines: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lines with `reason`, why a line is dropped, or null: the first of EMPTY, TOO_SHORT, TOO_LONG, RATIO_ALPHA, RATIO_CHARS.

    All characters of a batch are looked up in one table; regular expressions over classes so large take many times as
    long. A null text has no reason.
    """

    @F.pandas_udf("int")
    def run(texts: pd.Series, langs: pd.Series) -> pd.Series:
        kinds, out = _kinds(), np.zeros(len(texts), np.int32)
        given = np.flatnonzero(texts.notna())
        size = np.cumsum([len(texts.iat[i]) for i in given])
        for part in np.split(given, np.flatnonzero(np.diff(size // PIECE)) + 1):
            out[part] = failed_rule(texts.iloc[part].tolist(), langs.iloc[part].tolist(), kinds)
        return pd.Series(out)

    return lines.withColumn("reason", F.get(F.array(*map(F.lit, REASONS)), run(F.col(text), F.col(lang)) - 1))


def language_ok(df: DataFrame, lang: str, label: Column, text: str = "text") -> DataFrame:
    """Rows whose detected label ends in the language's two letters; of their text, what stands before a tab."""
    return df.where(F.right(label, F.lit(2)) == lang).withColumn(text, F.split_part(F.col(text), F.lit("\t"), F.lit(1)))


def nonempty(src: Column, trg: Column) -> Column:
    return (src != "") & (trg != "")


def collapse_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"[{SPACE}]+", " ")


def length_ok(src: Column, trg: Column, least: int = 1, most: int = MAX_WORDS) -> Column:
    return words_between(src, least, most) & words_between(trg, least, most)


def words_between(text: Column, least: int, most: int) -> Column:
    """Whether a text has so many words: one search that stops at the word beyond."""
    word, gap = rf"[^{SPACE}]++", rf"[{SPACE}]++"
    return text.rlike(rf"^(?:{gap})?+(?:{word}(?:{gap}|$)){{{least},{most}}}+$")


def word_length_ok(text: Column, most: int = 150) -> Column:
    return ~text.rlike(rf"[^{SPACE}]{{{most + 1},}}")


def ratio_ok(src: Column, trg: Column, least: float = 0.5) -> Column:
    """The shorter side, in characters, is at least this share of the longer."""
    a, b = F.length(src), F.length(trg)
    return F.greatest(a, b).isNotNull() & (F.least(a, b) >= F.greatest(a, b) * F.lit(least))


def _same(src: Column, trg: Column, pattern: str) -> Column:
    a, b = (F.array_sort(F.regexp_extract_all(x, F.lit(pattern), F.lit(0))) for x in (src, trg))
    return a == b


def numbers_match(src: Column, trg: Column) -> Column:
    """Both sides hold the same numbers, as often."""
    return _same(src, trg, r"[0-9]+")


def urls_match(src: Column, trg: Column) -> Column:
    return _same(src, trg, URL)


def currencies_match(src: Column, trg: Column) -> Column:
    return _same(src, trg, r"[$€£¥₽₹₩]|\b(?:USD|EUR|GBP|JPY|RUB|CHF)\b")


def alpha_ok(text: Column, alphabet: str, words: float = WORD_SHARE, chars: float = CHAR_SHARE) -> Column:
    """The shares of words that begin with a letter, and of letters among the signs, reach their bounds."""
    t = strip(text)
    n, solid = F.greatest(count_words(t), F.lit(1)), F.greatest(F.length(F.replace(t, F.lit(" "), F.lit(""))), F.lit(1))
    return (F.regexp_count(t, F.lit(rf"(?<![^{SPACE}])[{alphabet}]")) / n >= words) & (F.regexp_count(t, F.lit(f"[{alphabet}]")) / solid >= chars)


def fix_wiki(text: Column) -> Column:
    """Without footnote marks, wiki links, headings' signs and code spans."""
    for pattern, to in ((r"\[\d+\]", ""), (r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", "$1"), (r"\[https?://\S+ ([^\]]*)\]", "$1"), (r"^=+\s*(.*?)\s*=+$", "$1"), (r"<code>.*?</code>", "")):
        text = F.regexp_replace(text, pattern, to)
    return text


#: Condition on "source<tab>target", then what is removed on either side.
FREQUENT = [("^ -", "^ -"), (r" \(Ekumenická Bible\)", r" \(Ekumenická Bible\)"), (r"^• *[^\t]*\t[^•]", "^• *"), (r"^[^•][^\t]*\t•", "^• *")]


def remove_frequent(src: Column, trg: Column) -> tuple[Column, Column]:
    """Both sides without frequent patterns; each rule sees the pair that the rule before it left."""
    for condition, gone in FREQUENT:
        hit = F.concat_ws("\t", src, trg).rlike(condition)
        src, trg = F.when(hit, F.regexp_replace(src, gone, "")).otherwise(src), F.when(hit, F.regexp_replace(trg, gone, "")).otherwise(trg)
    return src, trg


#: Full-width punctuation and its plain form.
FULL_WIDTH = {"，": ",", "。": ".", "：": ":", "；": ";", "？": "?", "！": "!", "（": "(", "）": ")"}


def plain_punctuation(text: Column) -> Column:
    return F.translate(text, "".join(FULL_WIDTH), "".join(FULL_WIDTH.values()))


#: Characters that only one of the two Chinese scripts uses, pairwise; a starting set, given as a parameter.
TRADITIONAL, SIMPLIFIED = "國語漢龍開關門問間聞學習電腦網轉換項詞彙別繁", "国语汉龙开关门问间闻学习电脑网转换项词汇别繁"


def chinese_script(text: Column, traditional: str = TRADITIONAL, simplified: str = SIMPLIFIED) -> Column:
    """'traditional', 'simplified', 'both' or 'none'."""
    t_only = "".join(a for a, b in zip(traditional, simplified, strict=True) if a != b)
    s_only = "".join(b for a, b in zip(traditional, simplified, strict=True) if a != b)
    t, s = text.rlike(f"[{t_only}]"), text.rlike(f"[{s_only}]")
    return F.when(t & s, "both").when(t, "traditional").when(s, "simplified").otherwise("none")


def convert_chinese(text: Column, to: str, traditional: str = TRADITIONAL, simplified: str = SIMPLIFIED) -> Column:
    """Character by character into 'traditional' or 'simplified'; text in that script or in none stays."""
    a, b = (simplified, traditional) if to == "traditional" else (traditional, simplified)
    return F.when(chinese_script(text, traditional, simplified).isin("none", to), text).otherwise(F.translate(text, a, b))


def chinese_pairs(df: DataFrame, script: str, src: str = "src", trg: str = "trg", side: str = "src") -> DataFrame:
    """Pairs whose Chinese side is in just that script; rows go as a whole, so both sides stay aligned."""
    return df.where(chinese_script(F.col(src if side == "src" else trg)) == script)


def chinese_counts(df: DataFrame, to: str, text: str = "text") -> DataFrame:
    """One row of counters of a conversion: visited, converted, and lines of each script."""
    script = chinese_script(F.col(text))
    counted = df.select(script.alias("script")).agg(F.count("*").alias("visited"), F.count_if(~F.col("script").isin("none", to)).alias("converted"), *(F.count_if(F.col("script") == k).alias(k) for k in ("simplified", "traditional", "both", "none")))
    return counted


#: Patterns and replacements for Japanese, in order; the last two lose the sign that they look at.
_JA = r"\u3040-\u309F\u30A0-\u30FF\uFF00-\uFFEF\u4E00-\u9FAF\u3000-\u303F\u3400-\u4DBF"
JAPANESE = [
    (rf"([{_JA}?])!", "$1\uff01"), (rf"([{_JA}?])\?", "$1\uff1f"), (rf"([{_JA}?]):", "$1\uff1a"),
    ("\\.\\.\\.\u3002", "..."), ("\u30fb\u30fb\u30fb", "\u2026"), (r"\. ?\. ?\. ?", "\u2026"), ("\uff0c", "\u3001"),
    (rf"([{_JA}]),", "\u3001"), (rf"([{_JA}])\.\b", "\u3002"),
]


def japanese_signs(text: Column) -> Column:
    for pattern, to in JAPANESE:
        text = F.regexp_replace(text, pattern, to)
    return text


#: Languages written in Latin letters, of those that filters are set up for.
LATIN = frozenset("ca cs da de en es et fi fr hr hu id is it lt lv ms mt nb nl nn pl pt ro sk sl sq sv tr vi".split())


def filter_config(dataset: str, src: str, trg: str, available: set[str], mode: str = "custom") -> tuple[str, list[str]]:
    """(configuration, filters added to it): the most special one there is.

    From special to general: this data set for this pair, the pair's default, this data set, the default; a data set's
    name also with '-' for '/'. Both sides in Latin letters get a check of currencies, but in a pair's own configuration.
    """
    names = [dataset, dataset.replace("/", "-")]
    places = [*(f"{src}-{trg}/{n}" for n in names), f"{src}-{trg}/default", *names] if mode == "custom" else []
    found = next((p for p in places if p in available), "default")
    own = found.startswith(f"{src}-{trg}/")
    return found, ["currency_mismatch"] if not own and {src, trg} <= LATIN else []


def filter_pipeline(df: DataFrame, steps: list[dict]) -> DataFrame:
    """Pairs through a list of {filter, parameters, language}: 'src', 'trg' or None for both sides, as one lazy plan."""
    rewrites = {"normalize_whitespace": lambda t, p: collapse_space(t), "fix_wiki": lambda t, p: fix_wiki(t), "plain_punctuation": lambda t, p: plain_punctuation(t), "japanese_signs": lambda t, p: japanese_signs(t), "regexp": lambda t, p: F.regexp_replace(t, p["pattern"], p["to"])}
    tests = {
        "remove_empty_lines": lambda a, b, p: nonempty(a, b), "max_length": lambda a, b, p: length_ok(a, b, p.get("least", 1), p.get("most", MAX_WORDS)), "src_trg_ratio": lambda a, b, p: ratio_ok(a, b, p.get("ratio", 0.5)),
        "max_word_length": lambda a, b, p: word_length_ok(a, p.get("most", 150)) & word_length_ok(b, p.get("most", 150)), "num_mismatch": lambda a, b, p: numbers_match(a, b), "url_mismatch": lambda a, b, p: urls_match(a, b),
        "currency_mismatch": lambda a, b, p: currencies_match(a, b), "alpha_ratio": lambda a, b, p: alpha_ok(a, p["src"]) & alpha_ok(b, p["trg"]),
    }
    for step in steps:
        name, given, side = step["filter"], step.get("parameters", {}), step.get("language")
        if name in rewrites:
            for c in ("src", "trg") if side is None else (side,):
                df = df.withColumn(c, rewrites[name](F.col(c), given))
        elif name == "remove_frequent_patterns":
            a, b = remove_frequent(F.col("src"), F.col("trg"))
            df = df.withColumns({"src": a, "trg": b})
        elif name in tests:
            df = df.where(tests[name](F.col("src"), F.col("trg"), given))
        else:
            raise ValueError(f"no filter {name}")
    return df


def directed(df: DataFrame, src: str, trg: str, model_src: str, model_trg: str) -> DataFrame:
    """Pairs with their sides exchanged where the model goes the other way."""
    if model_src == trg or model_trg == src:
        other = {"src": "trg", "trg": "src"}
        return df.select(*(F.col(other.get(c, c)).alias(c) for c in df.columns))
    return df


def threshold(df: DataFrame, least: float | Column, score: str = "score") -> DataFrame:
    """Rows above the threshold; a threshold of 0 passes all, with score 1."""
    if isinstance(least, (int, float)):
        return df.withColumn(score, F.lit(1.0)) if least == 0 else df.where(F.col(score) > least)
    return df.where(F.col(score) > least)


def thresholds_by_dataset(df: DataFrame, overrides: dict[str, float], default: float) -> DataFrame:
    """df with the threshold of each row's dataset. The overrides are configuration, so they become one map literal."""
    if not overrides:
        return df.withColumn("threshold", F.lit(default))
    table = F.create_map(*(F.lit(x) for kv in overrides.items() for x in kv))
    return df.withColumn("threshold", F.coalesce(F.element_at(table, F.col("dataset")), F.lit(default)))


def document_lines(docs: DataFrame, locale: str, least: float, longest: int) -> DataFrame:
    """Lines of scored documents with what became of them: doc_score, doc_lang, line_lang, too_long or kept.

    Documents are judged before lines; lines and their languages pair up to the shorter of both.
    """
    doc = F.when(F.get("doc_scores", F.lit(0)) < least, "doc_score").when(F.get("lang", F.lit(0)) != locale, "doc_lang")
    d = docs.withColumn("verdict", doc).withColumn("parts", F.split("text", "\n"))
    n = F.least(F.size("parts"), F.size("seg_langs"))
    d = d.withColumn("zipped", F.arrays_zip(F.slice("parts", 1, n).alias("line"), F.slice("seg_langs", 1, n).alias("seg")))
    x = d.select("doc_id", "verdict", F.posexplode_outer("zipped").alias("line_no", "z"))
    line = F.coalesce("verdict", F.when(F.col("z.seg") != locale, "line_lang").when(F.length("z.line") > longest, "too_long").otherwise("kept"))
    return x.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.col("z.line").alias("text"), line.alias("verdict"))


def merge_lines(docs: DataFrame, locale: str, least: float, longest: int) -> DataFrame:
    """(doc_id, chunk_no, text): kept neighbouring lines of a document joined while they fit; other lines end a chunk.

    A fold over the document's own array, so no state crosses rows.
    """
    n = F.least(F.size("parts"), F.size("seg_langs"))
    d = docs.where((F.get("doc_scores", F.lit(0)) >= least) & (F.get("lang", F.lit(0)) == locale)).withColumn("parts", F.split("text", "\n"))
    zipped = F.arrays_zip(F.slice("parts", 1, n).alias("line"), F.slice("seg_langs", 1, n).alias("seg"))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, z: Column) -> Column:
        line = z["line"]
        ok = (z["seg"] == locale) & (F.length(line) <= longest)
        closed = F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
        fits = F.length(acc["open"]) + F.length(line) + 1 <= longest
        joined = F.when(acc["open"] == "", line).otherwise(F.concat(acc["open"], F.lit(" "), line))
        return F.when(~ok, F.struct(closed.alias("done"), F.lit("").alias("open"))).when((acc["open"] == "") | fits, F.struct(acc["done"].alias("done"), joined.alias("open"))).otherwise(F.struct(closed.alias("done"), line.alias("open")))

    end = lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
    return d.select("doc_id", F.posexplode(F.aggregate(zipped, start, step, end)).alias("chunk_no", "text")).where(strip(F.col("text")) != "").withColumn("chunk_no", F.col("chunk_no").cast("long"))


def collected_lines(docs: DataFrame, locale: str, least: float, longest: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(lines, counters): merged lines (pos, text) of all documents in their order, each key once, at most `most` of them.

    counters, one row: documents, lines visited, kept and filtered, documents that failed by score and by language, lines
    that failed by language and by length, duplicate lines and final lines. A line is a duplicate if an earlier one has its
    key. pos is (document, number of the line) in order; the first `most` of them are a top-n, not a sort of all.
    """
    judged = document_lines(docs, locale, least, longest)
    one = judged.agg(
        F.count_distinct("doc_id").alias("documents"), F.count_if(F.col("verdict").isin("kept", "line_lang", "too_long") & F.col("line_no").isNotNull()).alias("visited"), F.count_if(F.col("verdict") == "kept").alias("kept"),
        F.count_distinct(F.when(F.col("verdict") == "doc_score", F.col("doc_id"))).alias("doc_score"), F.count_distinct(F.when(F.col("verdict") == "doc_lang", F.col("doc_id"))).alias("doc_lang"),
        F.count_if(F.col("verdict") == "line_lang").alias("line_lang"), F.count_if(F.col("verdict") == "too_long").alias("too_long"),
    )
    merged = merge_lines(docs, locale, least, longest).withColumn("key", F.coalesce(norm_key(F.col("text")), F.lit("")))
    first = merged.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "chunk_no", "text")).alias("x"))
    counts = first.agg(F.sum(F.col("n") - 1).alias("duplicates"), F.least(F.count("*"), F.lit(most)).alias("final"))
    out = first.select("x.*").orderBy("doc_id", "chunk_no").limit(most)
    totals = one.withColumn("filtered", F.col("visited") - F.col("kept")).withColumn("duplicate_lines", F.coalesce(counts.select("duplicates").scalar(), F.lit(0))).withColumn("final_lines", counts.select("final").scalar())
    return out, totals
