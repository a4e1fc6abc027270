"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, look-alike letters, digits and signs standing for letters before another letter, or after
one at the end of a word, where ! and | are taken for punctuation), and an Aho-Corasick automaton finds the lexicon's words and word beginnings. Hits within an exception phrase don't count.
The sum of weights, and the sum for each hundred words, give the score by a logistic curve.

The lexicon is learned: words and word beginnings that are far more frequent in toxic than in other labelled documents,
counted once a document on a bounded sample (`TOXIC_ROWS` and `OTHER_ROWS`, those of the lowest xxhash64 of doc_id) of rows
whose crc32(doc_id) mod 3 is not 1. A fifth of the sample, by another digest of doc_id, is kept from the lexicon and fits
the curve, so the curve never sees a text whose words were chosen because of it. At most `PATTERNS` patterns are kept, the
most significant ones; on sf0.1 and check_l the sample yields fewer, so the bound takes nothing away there. `EXTRA` adds
words with a weight of their own. Labels are used for nothing else, and language, source and id never enter a score.

Edge cases: null and empty texts have no hits and get the score of such texts; a text of any length is matched whole;
without labels of both kinds only EXTRA counts, on a fixed curve; patterns of equal significance are taken in
alphabetical order; an empty table gives an empty result; repeated rows are scored each, and count once each where they
are learned from; null ids count as not held out and are never learned from; further columns, whatever their names, are
not looked at.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried, map_batches, ready, stored, table

TOXIC_ROWS, OTHER_ROWS = 4_000, 8_000
PATTERNS = 5_000
MIN_DOCS, MIN_G2, MIN_WEIGHT = 2, 24.0, 2.0
STEMS = (4, 5, 6)
THRESHOLD = 0.7
#: Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
LOOKALIKES = dict(zip("авекмнорстухіјѕԁɡһӏαβεικνορτυχωƖ", "abekmhopctyxijsdghlabeiknoptuxwl", strict=True))
SUBSTITUTES = {"0": "o", "1": "l", "!": "l", "|": "l", "3": "e", "4": "a", "@": "a", "5": "s", "$": "s", "7": "t", "8": "b"}
#: Words that count whatever the labels say, and phrases in which such words are harmless.
EXTRA = {"idiot": 3.0, "moron": 3.0, "scum": 3.0, "stupid": 2.0}
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "pathetic fallacy", "pond scum", "soap scum")

_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = re.compile(r"[0134578!|@$]+(?=[^\W\d_])|(?<=[^\W\d_])[0134578@$]+(?![^\W_])")


class _Fold(dict):
    """Character table: case, accents and look-alikes. i and l are one letter, since 1 stands for either."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        base = "".join(x for x in unicodedata.normalize("NFKD", c.lower()) if not unicodedata.combining(x))
        out = "".join(LOOKALIKES.get(x, x) for x in base.lower()) or c
        self[code] = out.replace("i", "l")
        return self[code]


_TABLE = _Fold()


def fold(text: str) -> str:
    """The words of a text, folded, with one space before, between and after them."""
    text = text.translate(_TABLE)
    text = _SIGNS.sub(lambda m: "".join(SUBSTITUTES[c] for c in m[0]), text)
    return f" {' '.join(_WORD.findall(text))} "


@dataclass
class Model:
    """patterns: ' word ' or ' beginning' -> weight; curve: intercept and slopes of log1p(weight) and log1p(weight for 100 words)."""

    patterns: dict[str, float]
    curve: tuple[float, float, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


class Matcher:
    def __init__(self, model: Model) -> None:
        import ahocorasick

        self.curve = model.curve
        self.automaton = ahocorasick.Automaton()
        for p, w in model.patterns.items():
            self.automaton.add_word(p, (len(p), w))
        for phrase in model.exceptions:
            p = fold(phrase)
            self.automaton.add_word(p, (len(p), None))
        self.automaton.make_automaton()

    def hits(self, text: str) -> tuple[float, int, int]:
        """(sum of weights, hits, words)."""
        folded = fold(text)
        found, safe = [], []
        if len(self.automaton):
            for end, (n, w) in self.automaton.iter(folded):
                (safe if w is None else found).append((end - n + 1, end, w))
        if safe:
            found = [f for f in found if not any(a <= f[0] and f[1] <= b for a, b, _ in safe)]
        best: dict[int, float] = {}  # a word counts once, by its heaviest pattern
        for start, _, w in found:
            best[start] = max(w, best.get(start, w))
        return math.fsum(best.values()), len(best), max(0, folded.count(" ") - 1)

    def score(self, weight: float, words: int) -> float:
        a, b, c = self.curve
        x = a + b * math.log1p(weight) + c * math.log1p(100 * weight / max(words, 1))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, x))))


_matchers: dict[str, Matcher] = {}


def matcher(model: Model) -> Matcher:
    """One for each worker process and model."""
    if model.key not in _matchers:
        _matchers.clear()
        _matchers[model.key] = Matcher(model)
    return _matchers[model.key]


def scored(model: Model, text: Column) -> Column:
    """A struct of score, hits, weight and words for a text column."""

    def run(batch: pd.Series) -> pd.DataFrame:
        m = matcher(model)
        got = [m.hits(t or "") for t in batch]
        return pd.DataFrame({"score": [m.score(w, n) for w, _, n in got], "hits": np.array([h for _, h, _ in got], np.int64), "weight": [w for w, _, _ in got], "words": np.array([n for _, _, n in got], np.int64)})

    return F.pandas_udf(run, "score double, hits long, weight double, words long")(text)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, toxic, tune): the bounded sample of labelled documents to learn from, as a stored table; tune marks the curve's."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    one = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic"))
    chosen = [one.where(F.col("toxic") == t).orderBy(F.xxhash64("_id"), "_id").limit(n) for t, n in ((1, TOXIC_ROWS), (0, OTHER_ROWS))]
    chosen = stored(chosen[0].unionByName(chosen[1]), "toxic-ids")
    d = docs.select(F.col(id_col).alias("_d"), F.col(text_col).cast("string").alias("text"))
    return stored(d.join(F.broadcast(chosen), F.col("_d") == F.col("_id")).select("text", F.col("toxic").cast("int").alias("toxic"), (F.pmod(F.xxhash64(F.lit("curve"), "_id"), F.lit(5)) == 0).alias("tune")), "toxic-sample")


def _features(folded: str) -> Counter:
    """Each word of a text once, and each beginning as often as different words of the text have it."""
    words = {w for w in folded.split() if len(w) > 2}
    out = Counter(f" {w} " for w in words)
    out.update(f" {w[:n]}" for w in words for n in STEMS if len(w) > n)
    return out


def lexicon(rows: DataFrame) -> dict[str, float]:
    """Weights of the words and beginnings that tell toxic from other documents. rows: (text, toxic)."""

    def make():
        def work(batch):
            counts, docs = (Counter(), Counter()), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = _features(fold(text or ""))
                found[""] = sum(len(k) > 1 and k[-1] == " " for k in found)  # all words
                counts[label].update(found)
                if label:
                    docs.update(found.keys())
            keys = list(counts[0].keys() | counts[1].keys())
            return [keys, [counts[1][k] for k in keys], [counts[0][k] for k in keys], [docs[k] for k in keys]]

        return work

    c = stored(map_batches(rows, make, "pattern string, a long, b long, docs long").groupBy("pattern").agg(*(F.sum(x).alias(x) for x in ("a", "b", "docs"))), "patterns")
    total = c.where(F.col("pattern") == "").first()
    if total is None or not total.a or not total.b:
        return {}
    a, b, n, t, o = F.col("a"), F.col("b"), F.col("a") + F.col("b"), float(total.a), float(total.b)
    weight = F.log((a + 0.5) / (t + 1.0)) - F.log((b + 0.5) / (o + 1.0))
    g2 = 2 * (a * F.log(a * (t + o) / (n * t)) + F.when(b > 0, b * F.log(b * (t + o) / (n * o))).otherwise(0.0))
    usable = c.where((F.col("docs") >= MIN_DOCS) & (F.col("pattern") != ""))
    best = usable.select("pattern", weight.alias("weight"), g2.alias("g2")).where((F.col("weight") >= MIN_WEIGHT) & (F.col("g2") >= MIN_G2))
    return {r.pattern: r.weight for r in best.orderBy(F.desc("g2"), "pattern").limit(PATTERNS).collect()}


def curve(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> tuple[float, float, float]:
    """Logistic regression of y on two columns by Newton's method; slopes are kept from falling below zero."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty * np.eye(len(w)), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(0.0, w[1])), float(max(0.0, w[2]))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    rows = sample(docs, labels)
    patterns = {fold(k): v for k, v in EXTRA.items()} | lexicon(rows.where("NOT tune").select("text", "toxic"))
    model = Model(patterns, (-3.0, 2.0, 0.5))
    got = rows.where("tune").select("toxic", scored(model, F.col("text")).alias("s")).select("toxic", "s.weight", "s.words").toPandas()  # of the bounded sample
    got = got.sort_values(["toxic", "weight", "words"])  # sums in one order
    if got.toxic.nunique() == 2:
        x = np.column_stack([np.log1p(got.weight), np.log1p(100 * got.weight / got.words.clip(lower=1))])
        model = Model(patterns, curve(x, got.toxic.to_numpy(float)))
    return model


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored(model, F.col("text")).alias("s"))
    return found.select("doc_id", "held_out", F.col("s.score").alias("score"), (F.col("s.score") >= THRESHOLD).cast("int").alias("predicted"), F.col("s.hits").alias("hits"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't rejected."""
    ready(spark)
    model = fit(docs, table(spark, sf_dir, "labels"))
    return carried(docs, "text").withColumn("s", scored(model, F.col("text"))).where(F.col("s.score") < THRESHOLD).select("_row.*")
