"""Candidates, their scores, and lexical tables."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import words

ORDERS = 4
#: Words or characters of both sides that are counted at once.
PIECE = 500_000


def parse_nbest(lines: DataFrame, column: str = "text") -> DataFrame:
    """(idx, hyp, features, score) of 'idx ||| hypothesis ||| features ||| score'; a bare index has an empty hypothesis."""
    f = F.split(F.col(column), r" ?\|\|\| ?")
    return lines.withColumns({"idx": F.get(f, F.lit(0)).cast("long"), "hyp": F.coalesce(F.get(f, F.lit(1)), F.lit("")), "features": F.coalesce(F.get(f, F.lit(2)), F.lit("")), "nbest_score": F.get(f, F.lit(3)).try_cast("double")})


def debpe(text: Column) -> Column:
    return F.regexp_replace(text, "@@ +", "")


def _counts(words_: list[str], n: int) -> Counter:
    return Counter(zip(*(words_[i:] for i in range(n)), strict=False))


def bleu(hyp: str, ref: str) -> float:
    """Sentence BLEU: matches and possibilities get one each unless an order has none of either, which scores 0."""
    h, r, logs = hyp.split(), ref.split(), 0.0
    if len(h) < ORDERS:
        return 0.0
    for n in range(1, ORDERS + 1):
        logs += math.log(((_counts(h, n) & _counts(r, n)).total() + 1.0) / (len(h) - n + 2.0))
    brevity = 1.0 if not r or len(h) > len(r) else math.exp(1 - len(r) / len(h))
    return math.exp(logs / ORDERS) * brevity


def chrf(hyp: str, ref: str, order: int = 6, beta: float = 2.0) -> float:
    """Sentence chrF: mean F over the character n-grams, without spaces, that both sides are long enough for."""
    h, r = "".join(hyp.split()), "".join(ref.split())
    scores = []
    for n in range(1, min(order, len(h), len(r)) + 1):
        a, b = Counter(h[i : i + n] for i in range(len(h) - n + 1)), Counter(r[i : i + n] for i in range(len(r) - n + 1))
        both = (a & b).total()
        p, q = both / a.total(), both / b.total()
        scores.append((1 + beta**2) * p * q / (beta**2 * p + q) if both else 0.0)
    return sum(scores) / len(scores) if scores else 0.0


#: Scores of a candidate against a reference, by name.
METRICS = {"bleu": bleu, "chrf": chrf}


def _numbered(sides: list[list[list[str]]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(numbers of the words of all texts, words of each text) of both sides."""
    number: dict[str, int] = {}
    flat = [np.fromiter((number.setdefault(w, len(number)) for x in side for w in x), np.int64) for side in sides]
    return [(ids, np.fromiter(map(len, side), np.int64, len(side))) for ids, side in zip(flat, sides, strict=True)]


def _lettered(sides: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(numbers of the characters of all texts, characters of each text) of both sides."""
    points = [np.frombuffer("".join(x).encode("utf-32-le", "surrogatepass"), "<u4") for x in sides]
    known = np.zeros(max(int(x.max(initial=0)) for x in points) + 1, bool)
    for x in points:
        known[x] = True
    number = np.cumsum(known) - 1
    return [(number[x], np.fromiter(map(len, t), np.int64, len(t))) for x, t in zip(points, sides, strict=True)]


def clipped(h: tuple[np.ndarray, np.ndarray], r: tuple[np.ndarray, np.ndarray], orders: int) -> np.ndarray:
    """Clipped n-gram matches of each row, exactly: [order - 1, row]. h, r: numbers of all rows' symbols, symbols of each row.

    An n-gram that stands at the same place on both sides is a match and takes one from both counts. Only what is left
    is counted, and only of rows where both sides have something left.
    """
    (hi, hs), (ri, rs) = h, r
    rows = len(hs)
    out = np.zeros((orders, rows), np.int64)
    ends, row = [np.cumsum(x) for x in (hs, rs)], [np.repeat(np.arange(rows), x) for x in (hs, rs)]
    left = [e[w] - np.arange(len(w)) for e, w in zip(ends, row, strict=True)]
    both = np.minimum(hs, rs)
    inner = np.arange(int(both.sum())) - np.repeat(np.cumsum(both) - both, both)
    at = [np.repeat(e - x, both) + inner for e, x in zip(ends, (hs, rs), strict=True)]
    same = np.zeros(len(hi) + orders, bool)
    same[at[0]] = hi[at[0]] == ri[at[1]]
    paired = np.ones(len(hi), bool)
    signs = int(max(hi.max(initial=0), ri.max(initial=0))) + 1
    for n in range(1, orders + 1):
        paired = paired & same[n - 1 : n - 1 + len(hi)] & (left[0] >= n)
        total = np.append(0, np.cumsum(paired))
        out[n - 1] = total[ends[0]] - total[ends[0] - hs]
        over = (np.maximum(hs - n + 1, 0) > out[n - 1]) & (np.maximum(rs - n + 1, 0) > out[n - 1])
        if not over.any():
            continue
        taken = np.zeros(len(ri), bool)
        taken[at[1]] = paired[at[0]]
        rest = [np.flatnonzero((x >= n) & ~t & over[w]) for x, t, w in zip(left, (paired, taken), row, strict=True)]
        where = np.concatenate([w[x] for w, x in zip(row, rest, strict=True)])
        side = np.repeat(np.array([0, 1]), [len(x) for x in rest])
        code, span = where, rows
        for k in range(n):  # (row, symbols so far) as one number, in the order of rows
            if span * signs >= 1 << 62:
                distinct, code = np.unique(code, return_inverse=True)
                span = len(distinct)
            code, span = code * signs + np.concatenate([x[y + k] for x, y in zip((hi, ri), rest, strict=True)]), span * signs
        key = np.sort(code << 1 | side)
        first = np.flatnonzero(np.append(True, key[1:] >> 1 != key[:-1] >> 1))
        on_ref = np.add.reduceat(key & 1, first)
        matches = np.minimum(on_ref, np.diff(np.append(first, len(key))) - on_ref)
        out[n - 1] += np.bincount(np.sort(where)[first], matches, rows).astype(np.int64)
    return out


def ngram_matches(hyps: pd.Series, refs: pd.Series, orders: int, characters: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of hyps, symbols of refs, clipped matches [order - 1, row]); symbols are words, or characters without spaces."""
    words = [[(t or "").split() for t in x] for x in (hyps, refs)]
    h, r = [["".join(t) for t in x] for x in words] if characters else words
    sizes = [np.fromiter(map(len, x), np.int64, len(x)) for x in (h, r)]
    # Of a text that the other one holds as a whole, every n-gram matches.
    held = [x in y or y in x if characters else x == y[: len(x)] for x, y in zip(h, r, strict=True)]
    least = np.minimum(*sizes)
    out = np.stack([np.maximum(least - n, 0) for n in range(orders)])
    rest = np.flatnonzero(~np.array(held, bool))
    cuts = np.flatnonzero(np.diff(np.cumsum((sizes[0] + sizes[1])[rest]) // PIECE)) + 1
    for part in np.split(rest, cuts):
        if len(part):
            out[:, part] = clipped(*(_lettered if characters else _numbered)([[x[i] for i in part] for x in (h, r)]), orders)
    return *sizes, out


def bleu_batch(hyps: pd.Series, refs: pd.Series) -> np.ndarray:
    """bleu() of all rows of a batch at once."""
    h, r, matches = ngram_matches(hyps, refs, ORDERS)
    a, b = h.astype(float), r.astype(float)
    logs = np.zeros(len(a))
    for n in range(1, ORDERS + 1):
        logs += np.log((matches[n - 1] + 1.0) / np.maximum(a - n + 2.0, 1.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        brevity = np.where((b == 0) | (a > b), 1.0, np.exp(1 - b / a))
    return np.where(a < ORDERS, 0.0, np.exp(logs / ORDERS) * brevity)


def chrf_batch(hyps: pd.Series, refs: pd.Series, order: int = 6, beta: float = 2.0) -> np.ndarray:
    """chrf() of all rows of a batch at once."""
    h, r, matches = ngram_matches(hyps, refs, order, True)
    total = np.zeros(len(h))
    for n in range(1, order + 1):
        p, q = matches[n - 1] / np.maximum(h - n + 1, 1), matches[n - 1] / np.maximum(r - n + 1, 1)
        total += np.where(matches[n - 1] > 0, (1 + beta**2) * p * q / np.where(matches[n - 1] > 0, beta**2 * p + q, 1.0), 0.0)
    scores = np.minimum(order, np.minimum(h, r))
    return np.where(scores > 0, total / np.maximum(scores, 1), 0.0)


#: Metrics that are worked out for a whole batch at once.
BATCHED = {"bleu": bleu_batch, "chrf": chrf_batch}


def candidate_score(hyp: Column, ref: Column, metric: str = "bleu") -> Column:
    """Counts of n-grams are beyond Spark's array functions at a fair price, so this goes by Arrow batches."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        if metric in BATCHED:
            return pd.Series(BATCHED[metric](a, b))
        return pd.Series([METRICS[metric](x or "", y or "") for x, y in zip(a, b, strict=True)], dtype=float)

    return run(hyp, ref)


def sentence_bleu(df: DataFrame, hyp: str = "hyp", ref: str = "ref", name: str = "bleu") -> DataFrame:
    return df.withColumn(name, candidate_score(F.col(hyp), F.col(ref)))


def best_candidate(scored: DataFrame, score: str = "bleu") -> DataFrame:
    """(idx, hyp): of each index the candidate of the highest score; of equal ones the first."""
    return scored.groupBy("idx").agg(F.max_by("hyp", F.struct(F.col(score), -F.col("rank"))).alias("hyp"))


def shortlist(lexicon: DataFrame, best: int = 100, first: int = 100) -> DataFrame:
    """(src, trg): for each source the best targets, and those of the commonest `first` + 2 targets that it has at all.

    lexicon: a table (src, trg, prob), read twice. How common a target is, is how many sources have it.
    """
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("prob"), "trg"))
    common = lexicon.groupBy("trg").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "trg").limit(first + 2).select("trg", F.lit(True).alias("common"))
    marked = lexicon.join(F.broadcast(common), "trg", "left").withColumn("rn", rank)
    return marked.where((F.col("rn") <= best) | F.col("common")).select("src", "trg")


def lexical_table(aligned: DataFrame) -> DataFrame:
    """(src, trg, prob): p(target word | source word) from how often words are aligned.

    aligned: (src, trg, alignment), texts and an array of (s, t) word numbers; pairs of numbers that a text doesn't have are
    left out. Counts combine before the shuffle.
    """
    a, b = words(F.col("src")), words(F.col("trg"))
    d = aligned.select(a.alias("a"), b.alias("b"), F.col("alignment").alias("x"))
    d = d.select(F.explode(F.transform("x", lambda p: F.struct(F.get("a", p["s"]).alias("src"), F.get("b", p["t"]).alias("trg")))).alias("w")).select("w.*")
    c = d.where("src IS NOT NULL AND trg IS NOT NULL").groupBy("src", "trg").agg(F.count("*").alias("n"))
    total = c.groupBy("src").agg(F.sum("n").alias("m"))
    return c.join(total, "src").select("src", "trg", (F.col("n") / F.col("m")).alias("prob"))
