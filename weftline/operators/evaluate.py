"""Evaluation: corpus scores, scores of models from outside, metrics files, language-model output and its price."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import strip
from weftline.operators.logs import IMPORTERS
from weftline.operators.rank import ORDERS, ngram_matches

CHARACTERS = 6


def ngram_counts(df: DataFrame, hyp: str = "hyp", ref: str = "ref", words: bool = True, characters: bool = True) -> DataFrame:
    """df with `grams`: words of both sides (h, r), and matches and possible matches of each order of words and of
    characters (match0, possible0, char_match0, char_hyp0, char_ref0 and so on), of the kinds that are asked for."""
    names = ["h", "r", *(f"{x}{k}" for x in ("match", "possible") for k in range(ORDERS))] if words else []
    names += [f"{x}{k}" for x in ("char_match", "char_hyp", "char_ref") for k in range(CHARACTERS)] if characters else []

    @F.pandas_udf(", ".join(f"{x} long" for x in names))
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        possible = lambda size, orders: [np.maximum(size - k, 0) for k in range(orders)]
        out = []
        if words:
            h, r, match = ngram_matches(a, b, ORDERS)
            out += [h, r, *match, *possible(h, ORDERS)]
        if characters:
            h, r, match = ngram_matches(a, b, CHARACTERS, True)
            out += [*match, *possible(h, CHARACTERS), *possible(r, CHARACTERS)]
        return pd.DataFrame(dict(zip(names, out, strict=True)))

    return df.withColumn("grams", run(F.col(hyp), F.col(ref)))


def corpus_scores(df: DataFrame, by: str, hyp: str = "hyp", ref: str = "ref", metrics: tuple[str, ...] = ("bleu", "chrf")) -> DataFrame:
    """(by, lines, bleu, chrf) in percent, from sums of n-gram counts; tokens are words between white space.

    BLEU is the geometric mean of the precisions of one to four words, 0 if any is 0, times the brevity penalty. chrF is
    the F2 of the mean precision and recall over one to six characters, spaces left out, as far as either side has them.
    metrics: which of the two are counted and returned.
    """
    x = ngram_counts(df.select(by, hyp, ref), hyp, ref, "bleu" in metrics, "chrf" in metrics)
    s = x.groupBy(by).agg(F.count("*").alias("lines"), *(F.sum(f"grams.{f.name}").alias(f.name) for f in x.schema["grams"].dataType))
    logs = sum((F.log(F.col(f"match{k}") / F.col(f"possible{k}")) for k in range(ORDERS)), F.lit(0.0))
    some = F.least(*(F.col(f"match{k}") for k in range(ORDERS))) > 0
    brevity = F.when(F.col("h") > F.col("r"), 1.0).otherwise(F.exp(1 - F.col("r") / F.col("h")))
    bleu = F.when(some, 100 * brevity * F.exp(logs / ORDERS)).otherwise(0.0)
    usable = [(F.col(f"char_hyp{k}") > 0) & (F.col(f"char_ref{k}") > 0) for k in range(CHARACTERS)]
    orders = sum((u.cast("int") for u in usable), F.lit(0))
    mean = lambda side: sum((F.when(u, F.col(f"char_match{k}") / F.col(f"{side}{k}")).otherwise(0.0) for k, u in enumerate(usable)), F.lit(0.0)) / orders
    p, q = mean("char_hyp"), mean("char_ref")
    chrf = F.when((orders > 0) & (p + q > 0), 100 * 5 * p * q / (4 * p + q)).otherwise(0.0)
    return s.select(by, "lines", *(v.alias(k) for k, v in (("bleu", bleu), ("chrf", chrf)) if k in metrics))


def mean_scores(df: DataFrame, by: str, comet: str, metricx: str) -> DataFrame:
    """(by, comet, metricx): means of the scores of two models, COMET as percent with four decimals, MetricX with two."""
    return df.groupBy(by).agg(F.round(F.avg(comet) * 100, 4).alias("comet"), F.round(F.avg(metricx), 2).alias("metricx"))


def metricx_input(source: Column, candidate: Column, reference: Column | None = None) -> Column:
    """What MetricX reads; without a reference it estimates quality."""
    parts = [F.lit("source: "), source, F.lit(" candidate: "), candidate]
    return F.concat(*parts, *([] if reference is None else [F.lit(" reference: "), reference]))


def comet_delta(mine: Column, theirs: Column) -> Column:
    """How far theirs is below mine, in percent of mine; mine in percent already."""
    return F.when(mine != 0, 100 * (1 - theirs / (mine / 100)))


def throughput(df: DataFrame, by: str, text: str, seconds: str) -> DataFrame:
    """(by, lines_per_second, chars_per_second) as ratios of sums; null where no time has passed."""
    s = df.groupBy(by).agg(F.count("*").alias("n"), F.sum(F.length(text)).alias("c"), F.sum(seconds).alias("t"))
    rate = lambda x: F.when(F.col("t") > 0, F.col(x) / F.col("t"))
    return s.select(by, rate("n").alias("lines_per_second"), rate("c").alias("chars_per_second"))


def lowest_error(candidates: DataFrame, source: str, rank: str, error: str, hyp: str) -> DataFrame:
    """(source, hyp, error): each source's candidate of the lowest estimated error; of equal ones the first."""
    x = candidates.groupBy(source).agg(F.min(F.struct(error, rank, hyp)).alias("x"))
    return x.select(source, F.col(f"x.{hyp}").alias(hyp), F.col(f"x.{error}").alias(error))


def with_references(candidates: DataFrame, references: DataFrame) -> DataFrame:
    """Candidates of n-best lists beside their index's reference; candidates without one are left out."""
    return candidates.join(references, "idx")


def grouped_generations(flat: DataFrame, n: int, inputs: int, pos: str = "pos", text: str = "text") -> DataFrame:
    """(input, candidates): n consecutive generations for each input, in order; raises unless there are n * inputs."""
    g = flat.groupBy(F.floor(F.col(pos) / n).cast("long").alias("input")).agg(F.array_sort(F.collect_list(F.struct(pos, text))).alias("x"))
    whole = (F.size("x") == n) & (F.col("input") >= 0) & (F.col("input") < inputs)
    wrong = F.raise_error(F.concat_ws(" ", F.lit(f"not {n} candidates for input"), F.col("input").cast("string")))
    return g.select("input", F.when(whole, F.transform("x", lambda c: c[text])).otherwise(wrong).alias("candidates"))


def metrics_file(text: Column) -> Column:
    """A struct of bleu_detok, chrf and comet (in percent) of a metrics file: its lines that are numbers, two or three of
    them in that order; null for any other count."""
    numbers = F.filter(F.transform(F.split(text, "\n"), lambda x: strip(x).try_cast("double")), lambda v: v.isNotNull())
    at = lambda k: F.get(numbers, F.lit(k))
    return F.when(F.size(numbers).isin(2, 3), F.struct(at(0).alias("bleu_detok"), at(1).alias("chrf"), (at(2) * 100).alias("comet")))


def metrics_lines(bleu: Column, chrf: Column, comet: Column | None = None) -> Column:
    """The text of a metrics file: a number a line."""
    return F.concat_ws("\n", *(x.cast("string") for x in (bleu, chrf, *([] if comet is None else [comet]))))


def metrics_name(name: Column) -> dict[str, Column]:
    """importer, augmentation and dataset of a metrics file's name, 'importer_[aug-..._]dataset'; nulls for other names."""
    importer = F.split_part(name, F.lit("_"), F.lit(1))
    rest = F.substr(name, F.length(importer) + 2)
    aug = F.when(F.startswith(rest, F.lit("aug-")), F.split_part(rest, F.lit("_"), F.lit(1)))
    dataset = F.when(aug.isNull(), rest).otherwise(F.substr(rest, F.length(aug) + 2))
    ok = importer.isin(*IMPORTERS) & (dataset != "")
    return {"importer": F.when(ok, importer), "augmentation": F.when(ok, aug), "dataset": F.when(ok, dataset)}


def unfenced(answer: Column) -> Column:
    """A model's answer without the fence around its JSON, and without commas before closing brackets."""
    body = F.regexp_extract(answer, r"(?s)```(?:json)?\s*\n(.*?)\n?\s*```", 1)
    body = F.when(body == "", strip(answer)).otherwise(strip(body))
    return F.regexp_replace(body, r",(\s*[}\]])", "$1")


def parsed_answer(answer: Column, schema: str) -> Column:
    """The answer's JSON by a schema; null where it is none."""
    return F.from_json(unfenced(answer), schema, {"mode": "PERMISSIVE"})


def token_cost(df: DataFrame, by: str, read: str, written: str, read_price: float, written_price: float) -> DataFrame:
    """(by, read, written, cost): tokens that went in and out, and what they cost at prices for a million."""
    s = df.groupBy(by).agg(F.sum(read).alias(read), F.sum(written).alias(written))
    return s.withColumn("cost", (F.col(read) * read_price + F.col(written) * written_price) / 1_000_000)


#: How a text is handed to a language model, by name: {src} and {trg} are languages, {text} is the text.
PROMPTS = {
    "plain": "Translate the text below from {src} to {trg}. Answer with the translation only.\n\n{text}",
    "reasoned": "You translate from {src} to {trg}. Think about terms and tone first, then write the translation as the last line of your answer.\n\n{text}",
}


def prompt(text: Column, src: str, trg: str, kind: str = "plain") -> Column:
    head, tail = PROMPTS[kind].replace("{src}", src).replace("{trg}", trg).split("{text}")
    return F.concat(F.lit(head), text, F.lit(tail))


def group_table(metrics: DataFrame, group: str) -> DataFrame:
    """The table of a group's metrics under its column names; metrics: (model, importer, dataset, augmentation, bleu_detok, chrf, comet)."""
    columns = {"Group": F.lit(group), "Model": "model", "Importer": "importer", "Dataset": "dataset", "Augmentation": "augmentation", "bleu_detok": "bleu_detok", "chrf": "chrf", "comet": "comet"}
    return metrics.select(*((v if isinstance(v, Column) else F.col(v)).alias(k) for k, v in columns.items()))


def published(records: DataFrame, step: str, prefix: str) -> DataFrame:
    """(step, key, value): each value of a record that isn't null, under prefix/name, as trackers take them."""
    names = [c for c in records.columns if c != step]
    pairs = F.explode(F.array(*(F.struct(F.lit(f"{prefix}/{c}").alias("key"), F.col(c).cast("double").alias("value")) for c in names)))
    return records.select(F.col(step).alias("step"), pairs.alias("x")).select("step", "x.key", "x.value").where("value IS NOT NULL")


def with_fallback(models: DataFrame, evaluations: DataFrame) -> DataFrame:
    """(model, group, eval_id): the newest evaluation of a model within its group, else its newest anywhere."""
    newest = F.max(F.struct("created", "eval_id")).alias("x")
    near = evaluations.groupBy("model", "group").agg(newest).select("model", "group", F.col("x.eval_id").alias("near"))
    far = evaluations.groupBy("model").agg(newest).select("model", F.col("x.eval_id").alias("far"))
    return models.join(near, ["model", "group"], "left").join(far, "model", "left").select("model", "group", F.coalesce("near", "far").alias("eval_id"))


def with_external(runs: DataFrame, scores: DataFrame) -> DataFrame:
    """Runs with a map from scorer to score of others' systems for the same language pair; empty where there is none."""
    m = scores.groupBy("langpair").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("scorer", "score")))).alias("external"))
    return runs.join(m, "langpair", "left").withColumn("external", F.coalesce("external", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))))
