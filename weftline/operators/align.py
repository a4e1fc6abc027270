"""Alignments, markup and quality estimates: folds over one row's own sequences, in Arrow or pandas batches."""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import words


def index_map(tokens: list[str], original: list[str]) -> list[int]:
    """For each token the word that it is a part of: words are used up by the characters of tokens."""
    out, word, left = [], 0, len(original[0]) if original else 0
    for t in tokens:
        need = len(t)
        while left == 0 and word + 1 < len(original):
            word += 1
            left = len(original[word])
        out.append(word)
        left = max(0, left - need)
    return out


def map_indices(tokens: Column, original: Column) -> Column:
    """'token-word' pairs for two space-separated columns."""

    @F.pandas_udf("string")
    def run(t: pd.Series, o: pd.Series) -> pd.Series:
        return pd.Series([" ".join(f"{i}-{w}" for i, w in enumerate(index_map((a or "").split(), (b or "").split()))) for a, b in zip(t, o, strict=True)])

    return run(tokens, original)


def parse_alignment(aln: Column) -> Column:
    """'0-1 2-3' as an array of (s, t)."""
    pairs = F.filter(F.split(aln, " "), lambda p: p != "")
    return F.transform(pairs, lambda p: F.struct(F.split_part(p, F.lit("-"), F.lit(1)).cast("int").alias("s"), F.split_part(p, F.lit("-"), F.lit(2)).cast("int").alias("t")))


def remap(pairs: Column, src_map: Column, trg_map: Column) -> Column:
    """Pairs of tokens as pairs of words, each once; an index outside its map raises."""
    at = lambda m, i: F.element_at(m, i + 1)
    return F.array_distinct(F.transform(pairs, lambda p: F.struct(at(src_map, p["s"]).alias("s"), at(trg_map, p["t"]).alias("t"))))


def diagonal(src: Column, trg: Column) -> Column:
    """A stand-in for an aligner: words of the same number, as far as both texts go, as an array of (s, t)."""
    n = F.least(F.size(words(src)), F.size(words(trg)))
    return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.struct(i.alias("s"), i.alias("t")))


def symmetrize(forward: Column, backward: Column, how: str = "intersect") -> Column:
    """Both directions' pairs: intersect, union, or those of the union beside an agreed pair (grow)."""
    both = F.array_intersect(forward, backward)
    if how == "intersect":
        return both
    either = F.array_distinct(F.concat(forward, backward))
    if how == "union":
        return either
    return F.filter(either, lambda p: F.exists(both, lambda q: (F.abs(p["s"] - q["s"]) <= 1) & (F.abs(p["t"] - q["t"]) <= 1)))


def grow_diag_final_and(forward: set[tuple[int, int]], backward: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """The agreed pairs, grown by neighbours of the union that have a word without a pair, then by pairs of the union of
    which both words have none."""
    found = forward & backward
    either = sorted(forward | backward)
    s, t = {a for a, _ in found}, {b for _, b in found}
    grew = True
    while grew:
        grew = False
        for a, b in either:
            if (a, b) in found or (a in s and b in t):
                continue
            if any((a + i, b + j) in found for i in (-1, 0, 1) for j in (-1, 0, 1)):
                found.add((a, b))
                s.add(a)
                t.add(b)
                grew = True
    for side in (forward, backward):
        for a, b in sorted(side):
            if a not in s and b not in t:
                found.add((a, b))
                s.add(a)
                t.add(b)
    return sorted(found)


def grown(df: DataFrame, forward: str, backward: str) -> DataFrame:
    """df with `alignment`: both directions' '0-1 2-3' joined by grow-diag-final-and."""

    @F.pandas_udf("string")
    def run(f: pd.Series, b: pd.Series) -> pd.Series:
        pairs = lambda x: {tuple(map(int, p.split("-"))) for p in (x or "").split()}
        return pd.Series([" ".join(f"{s}-{t}" for s, t in grow_diag_final_and(pairs(x), pairs(y))) for x, y in zip(f, b, strict=True)])

    return df.withColumn("alignment", run(F.col(forward), F.col(backward)))


def concatenated(sentences: DataFrame, by: str, order: str, text: str, gap: str) -> DataFrame:
    """(by, faithful, spaced): sentences joined by what stood between them in the source, and by a space."""
    x = sentences.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(order, text, gap))).alias("x"))
    pieces = F.transform("x", lambda p, i: F.concat(p[text], F.when(i + 1 < F.size("x"), p[gap]).otherwise("")))
    return x.select(by, F.array_join(pieces, "").alias("faithful"), F.array_join(F.transform("x", lambda p: p[text]), " ").alias("spaced"))


#: Elements without an end.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def tag_changes(before: Column, after: Column) -> tuple[Column, Column]:
    """(closed, opened) tags from one stack of open tags to the next: what is beyond their common beginning, closed from
    within. Elements without an end are opened but never closed."""
    same = F.aggregate(F.zip_with(before, after, lambda a, b: a.eqNullSafe(b)), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, x: F.struct((s["n"] + F.when(s["on"] & x, 1).otherwise(0)).alias("n"), (s["on"] & x).alias("on")), lambda s: s["n"])
    rest = lambda c: F.slice(c, same + 1, F.greatest(F.size(c) - same, F.lit(0)))
    return F.reverse(F.filter(rest(before), lambda t: ~F.lower(t).isin(*VOID))), rest(after)


def rows_of(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a sample of ids."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


class _Text(HTMLParser):
    BLOCK = frozenset("address article aside blockquote br dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul title".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.open: list[str] = []
        self.hidden, self.sound = 0, True

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCK:
            self.out.append("\n")
        if tag not in VOID:
            self.open.append(tag)
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag in self.BLOCK:
            self.out.append("\n")
        if tag in self.open:
            while self.open[-1] != tag:
                self.sound = False
                self.hidden -= self.open.pop() in ("script", "style")
            self.open.pop()
            self.hidden -= tag in ("script", "style")
        elif tag not in VOID:
            self.sound = False

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def page_text(markup: str) -> tuple[str, bool]:
    """(visible text, whether all tags were closed in order); broken markup never raises."""
    p = _Text()
    p.feed(markup)
    p.close()
    text = re.sub(r"[^\S\n]+", " ", html.unescape("".join(p.out)))
    return "\n".join(x.strip() for x in text.split("\n") if x.strip()), p.sound and not p.open


def extract_text(markup: Column) -> Column:
    """A struct of text and well_formed."""

    @F.pandas_udf("text string, well_formed boolean")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([page_text(x or "") for x in s], columns=["text", "well_formed"])

    return run(markup)


#: Signs that end a word on either side of them, for tokens that go on with the one before.
BREAKS = "\n ,.(){}[]"


def goes_on(before: str, token: str) -> bool:
    """Whether a token is a further part of the word that the token before is of."""
    return bool(before) and bool(token) and before[-1] not in BREAKS and token[0] not in BREAKS


def hard_alignment(soft: np.ndarray, tokens: list[str] | None = None, tags: list[tuple] | None = None) -> np.ndarray:
    """For each target token a source token: that of the highest probability, and one for all tokens of a word.

    Within a word, a token's own best takes over from the one so far if its markup holds the former's (tags: open tags of
    each source token), or if it is at least as likely as the former was for the token before. The last token, the end,
    goes with the source's end. Without tokens each is aligned on its own.
    """
    best = soft.argmax(axis=1)
    if tokens is None or not len(best):
        return best
    tags, start = tags or [()] * soft.shape[1], 0
    for t in range(1, len(best) - 1):
        if not goes_on(tokens[t - 1], tokens[t]):
            start = t
            continue
        now, former = best[t], best[t - 1]
        holds = tags[now][: len(tags[former])] == tags[former]
        best[start : t + 1] = now if holds or soft[t, now] >= soft[t - 1, former] else former
    best[-1] = soft.shape[1] - 1
    return best


def shared_bytes(source_side: np.ndarray, target_side: np.ndarray) -> np.ndarray:
    """(target side x source side): the share of each pivot token's bytes on the target side within each one on the source side.

    Both sides: (n, 2) begins and ends of tokens of one text. Empty tokens, as ends are, go with equal ones.
    """
    begin = np.maximum(target_side[:, None, 0], source_side[None, :, 0])
    end = np.minimum(target_side[:, None, 1], source_side[None, :, 1])
    size = (target_side[:, 1] - target_side[:, 0])[:, None]
    equal = (target_side[:, None] == source_side[None]).all(axis=2)
    return np.where(size > 0, np.clip(end - begin, 0, None) / np.maximum(size, 1), equal)


def compose(first: np.ndarray, second: np.ndarray, source_side: np.ndarray | None = None, target_side: np.ndarray | None = None) -> np.ndarray:
    """P(source | target) through a pivot: the product of both steps, by way of the bytes that both models' tokens of the
    pivot text share where they cut it differently."""
    return second @ first if source_side is None else second @ shared_bytes(source_side, target_side) @ first


def word_ranges(tokens: list[str]) -> list[tuple[int, int]]:
    """First and last-but-one token of each word: words begin with white space; the last token, the end, is of none."""
    n = len(tokens) - 1
    starts = [i for i in range(n) if i == 0 or tokens[i][:1].isspace()]
    return list(zip(starts, [*starts[1:], n], strict=True)) if starts else []


def word_features(log_probs: np.ndarray, ranges: list[tuple[int, int]]) -> np.ndarray:
    """(words x 4): mean and least log-probability of a word's tokens, their number, and the mean over all words' tokens."""
    if not ranges:
        return np.zeros((0, 4))
    starts, ends = np.array(ranges).T
    inner = np.asarray(log_probs, float)[: ends[-1]]
    n = ends - starts
    return np.column_stack([np.add.reduceat(inner, starts) / n, np.minimum.reduceat(inner, starts), n, np.full(len(n), inner.mean())])


def word_quality(tokens: Column, log_probs: Column, model: dict | None = None) -> Column:
    """A struct of words (first token, token behind the last, score) and the sentence's score, the mean of its words'.

    Without a model the score is the mean log-probability; with one (coefficients, intercept, scale, mean) quality_scores.
    Texts without words have an empty list and no score.
    """

    @F.pandas_udf("words array<struct<begin:int,end:int,score:double>>, score double")
    def run(t: pd.Series, p: pd.Series) -> pd.DataFrame:
        out = []
        for own, probs in zip(t, p, strict=True):
            ranges = word_ranges(list(own)) if own is not None and probs is not None else []
            f = word_features(probs, ranges)
            scores = quality_scores(f, **model) if model and ranges else f[:, 0]
            out.append(([{"begin": a, "end": b, "score": float(x)} for (a, b), x in zip(ranges, scores, strict=True)], float(scores.mean()) if ranges else None))
        return pd.DataFrame(out, columns=["words", "score"])

    return run(tokens, log_probs)


def quality_scores(features: np.ndarray, coefficients: np.ndarray, intercept: float, scale: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Log-probability that a word is wrong: log(1 - sigmoid(x)) of standardised features."""
    x = (features - mean) / np.where(scale == 0, 1, scale) @ coefficients + intercept
    return -np.logaddexp(0, x)


def wrap_tokens(tokens: Column, longest: int) -> Column:
    """Arrays of at most longest - 1 tokens, which leaves room for an end."""
    step = longest - 1
    return F.when(F.size(tokens) == 0, F.array(tokens)).otherwise(F.transform(F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / step).cast("int")), lambda i: F.slice(tokens, i * step + 1, step)))


def distinct_then_join(df: DataFrame, column: str, work, result: str) -> DataFrame:
    """df with work(column) worked out once for each distinct value."""
    once = df.select(column).distinct().withColumn(result, work(F.col(column)))
    return df.join(once, column, "left")
