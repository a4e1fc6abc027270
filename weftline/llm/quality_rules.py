"""Quality rules: counts of a text, a base rule, and a hashed n-gram log-likelihood ratio. DataFrame functions only.

Two multinomials over hashed words and word pairs are estimated: one from trusted documents, one from all documents.
A document's score is the mean over its n-grams of log(p_trusted / p_raw); every document at or above the threshold that
passes the base rule is kept. Both the score and the verdict are deterministic.

Trusted are all documents labelled quality 1; the raw counts cover all documents. The threshold comes from all labelled
documents that pass the base rule, and of the trusted ones only from the fifth that the counts don't use: it lies halfway
between the score that 99 of 100 trusted documents reach and the score that 99 of 100 documents labelled 0 don't exceed.
Where only one kind is labelled, its score is the threshold; where none is, nothing is rejected by score. No label is
left out. Labelled ids are broadcast up to `BROADCAST_IDS` and joined in a shuffle above that; the exact percentiles of
the scores, of 16 bytes for each labelled document, are merged in one place.

Edge cases: a null or empty text has no words, fails the base rule and scores 0; without trusted documents every score
is 0, so only the base rule decides; a text of any length is read whole, in memory that grows with its words; scores that
equal the threshold are kept, and a document labelled both ways is trusted; an empty table gives an empty result;
repeated rows count each; a null doc_id is never trusted and passes through; columns of documents may have any names,
since stages carry rows as one column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANK, carried, ready, stored, table

BUCKETS = 10_000
#: Labelled ids up to which they are broadcast.
BROADCAST_IDS = 1_000_000
#: Share of either kind of labelled documents that the threshold may get wrong, and every how many-th of the trusted sets it.
MISSED, TUNE = 0.01, 5
#: Added to each count, on the scale of the trusted documents' counts: a bucket needs about as many trusted n-grams to count for half.
PRIOR = 20.0
#: Different repeated windows up to which membership is looked up one by one; above that, windows are sorted.
FEW = 64
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def grams_of(words: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of every word, then of every pair of neighbours, in order."""
    single = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)))
    pair = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.pmod(F.xxhash64(F.get(words, i - 1), F.get(words, i)), F.lit(buckets)))
    return F.when(F.size(words) > 1, F.concat(single, pair)).otherwise(single)


def ratio_model(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """One row, one array: log(p_trusted / p_raw) of every bucket, smoothed by PRIOR.

    trusted_ids: (doc_id), without repeats, read twice. Only where they are too many to be broadcast are texts shuffled.
    """
    marked = handy(trusted_ids.select(F.col("doc_id").alias("_t_id")))
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    d = d.join(marked, F.col("_id") == F.col("_t_id"), "left").select(F.col("_t_id").isNotNull().cast("long").alias("_good"), words_of(F.col("_text")).alias("_words"))
    counts = d.select("_good", F.explode(grams_of(F.col("_words"), buckets)).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("_good").alias("good"))
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(counts, "bucket", "left").select("bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("good", F.lit(0)).alias("good"))
    one = every.agg(F.array_sort(F.collect_list(F.struct("bucket", "raw", "good"))).alias("x"), F.sum("raw").alias("n"), F.sum("good").alias("m"))  # `buckets` rows
    return one.select(
        F.when(F.col("m") == 0, F.array_repeat(F.lit(0.0), buckets))
        .otherwise(F.transform("x", lambda r: F.log((r["good"] + F.lit(PRIOR)) / (r["raw"] * (F.col("m") / F.col("n")) + F.lit(PRIOR)))))
        .alias("ratios")
    )


def measure(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """docs with the counts of the base rule; names start with prefix. _words stays as a helper to be dropped.

    A document without a repeated window, as most are, only has its windows compared as a set. Each helper is read twice
    or more by the next one, so that Catalyst keeps it apart and doesn't work it out again within a loop over words.
    """
    p = prefix
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.withColumn("_words", words_of(F.col(text_col)))
    w = F.col("_words")
    later = lambda c, k: F.slice(c, k + 1, F.greatest(F.size(c) - k, F.lit(0)))
    chain = lambda a, b: F.xxhash64(a, b)
    d = d.withColumn("_h", F.transform(w, lambda x: F.xxhash64(x)))
    d = d.withColumn("_p", F.zip_with("_h", later(F.col("_h"), 1), chain).alias("_p"))
    d = d.withColumn("_p", F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(F.zip_with(F.slice("_p", 1, F.greatest(F.size(w) - 2, F.lit(0))), later(F.col("_h"), 2), chain)))
    t = F.col("_p")  # the windows' hashes, in order
    d = d.withColumn("_s", F.when(F.size(F.array_distinct(t)) < F.size(t), F.sort_array(t)).otherwise(F.array().cast("array<bigint>")))
    s = F.col("_s")
    d = d.withColumn("_twice", F.array_distinct(F.filter(s, lambda x, k: x.eqNullSafe(F.get(s, k + 1)))))
    twice = F.col("_twice")
    some = F.filter(F.transform(t, lambda x, i: F.when(F.array_contains(twice, x), i)), lambda i: i.isNotNull())
    d = d.withColumn("_all", F.when(F.size(twice) > FEW, F.sort_array(F.transform(t, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    v = F.col("_all")
    many = F.transform(F.filter(v, lambda x, k: x["h"].eqNullSafe(F.get(v, k - 1)["h"]) | x["h"].eqNullSafe(F.get(v, k + 1)["h"])), lambda x: x["i"])
    d = d.withColumn("_pos", F.when(F.size(twice) == 0, F.array().cast("array<int>")).when(F.size(twice) <= FEW, some).otherwise(F.sort_array(many)))
    q = F.col("_pos")
    gaps = F.zip_with(F.slice(q, 2, F.greatest(F.size(q) - 1, F.lit(0))), F.slice(q, 1, F.greatest(F.size(q) - 1, F.lit(0))), lambda b, a: F.least(F.lit(3), b - a))
    d = d.withColumn(f"{p}n_repeat_words", F.when(F.size(q) == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3), lambda a, x: a + x)).cast("long"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("_lines", lines)
    return d.withColumns(
        {
            f"{p}n_words": F.size(w).cast("long"),
            f"{p}word_chars": F.length(F.array_join(w, "")).cast("long"),
            f"{p}n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
            f"{p}n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    ).drop("_lines", "_pos", "_h", "_p", "_s", "_twice", "_all")


def scored(docs: DataFrame, ratios: DataFrame, text_col: str = "text", prefix: str = "", buckets: int = BUCKETS) -> DataFrame:
    """docs with the counts, base_failed and llr. ratios: the row of ratio_model."""
    p = prefix
    d = measure(docs, text_col, prefix).withColumn("_grams", grams_of(F.col("_words"), buckets)).withColumn("_ratios", ratios.select("ratios").scalar())
    total = F.aggregate("_grams", F.lit(0.0), lambda a, g: a + F.get(F.col("_ratios"), g.cast("int")))
    d = d.withColumn(f"{p}llr", F.when(F.size("_grams") == 0, F.lit(0.0)).otherwise(total / F.size("_grams")))
    n = F.col(f"{p}n_words")
    return d.withColumn(f"{p}base_failed", (n < MIN_WORDS) | (100 * F.col(f"{p}n_repeat_words") > 50 * n)).drop("_words", "_grams", "_ratios")


def judge(docs: DataFrame, model: DataFrame, text_col: str = "text", prefix: str = "", buckets: int = BUCKETS) -> DataFrame:
    """docs with the counts, base_failed, llr and kept. model: the row of fit.

    Write the result before filtering by it, or filter as stage() does: Catalyst moves a plain filter below the
    projections and so repeats them within the loops over words.
    """
    p = prefix
    d = scored(docs, model, text_col, prefix, buckets)
    return d.withColumn(f"{p}kept", ~F.col(f"{p}base_failed") & (F.col(f"{p}llr") >= model.select("threshold").scalar()))


def labelled(labels: DataFrame, quality: int) -> DataFrame:
    """Ids of the documents of that label, each once."""
    return labels.where((F.col("quality") == quality) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def handy(ids: DataFrame) -> DataFrame:
    """ids, to be broadcast if they are few enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def fit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: ratios and threshold."""
    good = stored(labelled(labels, 1).withColumn("tune", F.pmod(F.xxhash64(F.lit("threshold"), "doc_id"), F.lit(TUNE)) == 0), "trusted")
    ratios = stored(ratio_model(docs, good.where("NOT tune")), "ratios")
    bad = labelled(labels, 0).join(good.select("doc_id"), "doc_id", "left_anti")
    ids = stored(good.where("tune").select("doc_id", F.lit(True).alias("good")).unionByName(bad.select("doc_id", F.lit(False).alias("good"))), "tune").withColumnRenamed("doc_id", "_t_id")
    some = docs.select(F.col("doc_id").alias("_id"), "text").join(handy(ids), F.col("_id") == F.col("_t_id")).select("good", "text")
    llr = stored(scored(some, ratios).select("good", "base_failed", "llr"), "tuned")
    at = lambda kind, q: F.percentile(F.when(F.col("good") == kind, F.col("llr")), q)
    reach = llr.where("NOT base_failed").agg(at(True, MISSED).alias("a"), at(False, 1 - MISSED).alias("b"))
    threshold = reach.select(F.coalesce((F.col("a") + F.col("b")) / 2, "a", "b", F.lit(float("-inf"))).alias("threshold"))
    return stored(ratios.withColumn("threshold", threshold.scalar()), "quality")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return judge(docs, model).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are kept.

    The verdict stands beside a row number, which is not deterministic to Catalyst: so the filter stays above the
    projections that work it out, rather than repeat them within the loops over words.
    """
    ready(spark)
    judged = judge(carried(docs, "text"), fit(docs, table(spark, sf_dir, "labels"))).withColumn("number", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("number") >= 0)).select("_row.*")
