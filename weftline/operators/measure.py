"""Histograms, summaries, pivots and vectors."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: Column) -> DataFrame:
    return df.select(value.cast("long").alias("value")).groupBy("value").agg(F.count("*").alias("n"))


def log_edges(most: int, bins: int = 30) -> list[float]:
    """Edges 1, 2 and those of `bins` logarithmic steps up to most that lie above 2."""
    steps = [10 ** (math.log10(most) * i / (bins - 1)) for i in range(bins)] if most > 1 else []
    return [1.0, 2.0, *(x for x in steps if x > 2)]


def log_histogram(hist: DataFrame, bins: int = 30) -> DataFrame:
    """(bin, lower, upper, n) of a histogram (value, n); the last bin is closed and values below 1 fall out."""
    most = hist.agg(F.max("value")).first()[0] or 0
    edges = log_edges(most, bins)
    table = F.array(*(F.lit(x) for x in edges))
    at = F.least(F.size(F.filter(table, lambda e: e <= F.col("value"))), F.lit(len(edges) - 1))
    x = hist.where((F.col("value") >= 1) & (F.col("value") <= F.lit(max(edges)))).withColumn("bin", at.cast("long"))
    return x.groupBy("bin").agg(F.sum("n").alias("n")).select("bin", F.get(table, (F.col("bin") - 1).cast("int")).alias("lower"), F.get(table, F.col("bin").cast("int")).alias("upper"), "n")


def score_summary(scores: DataFrame) -> DataFrame:
    """Per criterion: mean, median and how often each of 1 to 5 was given. scores: (criterion, score)."""
    given = [F.count_if(F.col("score") == k).alias(f"n{k}") for k in range(1, 6)]
    return scores.groupBy("criterion").agg(F.avg("score").alias("mean"), F.median("score").alias("median"), *given)


def pivoted(df: DataFrame, row: str, column: str, value: str, columns: list[str]) -> DataFrame:
    return df.groupBy(row).pivot(column, columns).agg(F.max(value))


def cluster_sizes(df: DataFrame, cluster: str) -> DataFrame:
    return df.groupBy(cluster).agg(F.count("*").alias("n"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def normalized(vector: Column) -> Column:
    """The vector at unit length; a zero vector stays. The norm stands outside the lambda, which would work it out for each number."""
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(dot(v, v))
    return F.when(norm == 0, v).otherwise(F.zip_with(v, F.array_repeat(norm, F.size(v)), lambda x, n: x / n))


#: Numbers that a matrix of centroids may hold: 5,000 of 1,024 dimensions and more, 64 MB as doubles.
CENTROID_NUMBERS = 8_000_000


def nearest_centroid(df: DataFrame, vector: str, centroids: DataFrame) -> DataFrame:
    """df with `cluster` and `similarity`: the centroid of the largest dot product, of equal ones the lowest id.

    centroids (id, vector) are a model's parameters: their number is checked, then they are one broadcast matrix, by which
    Arrow batches of vectors are multiplied. Vectors that are null or of another length get nulls.
    """
    name, column = centroids.columns
    size = centroids.agg(F.coalesce(F.sum(F.size(column)), F.lit(0))).first()[0]
    if size > CENTROID_NUMBERS:
        raise ValueError(f"{size} numbers of centroids; deal them out and take the best of the parts instead")
    rows = sorted((r[0], r[1]) for r in centroids.collect())
    sent = df.sparkSession.sparkContext.broadcast((np.array([k for k, _ in rows], np.int64), np.array([v for _, v in rows], float)))

    @F.pandas_udf("cluster long, similarity double")
    def run(batch: pd.Series) -> pd.DataFrame:
        ids, matrix = sent.value
        ok = np.array([v is not None and len(v) == matrix.shape[-1] for v in batch], bool) & (len(ids) > 0)
        out = pd.DataFrame({"cluster": pd.Series([None] * len(batch), dtype="Int64"), "similarity": pd.Series([None] * len(batch), dtype="Float64")})
        if ok.any():
            sims = np.stack([np.asarray(v, float) for v, k in zip(batch, ok, strict=True) if k]) @ matrix.T
            best = (sims >= sims.max(axis=1, keepdims=True) - 1e-12).argmax(axis=1)
            out.loc[ok, "cluster"] = ids[best]
            out.loc[ok, "similarity"] = sims[np.arange(len(best)), best]
        return out

    return df.withColumn("best", run(F.col(vector))).withColumn("cluster", F.col("best.cluster")).withColumn("similarity", F.col("best.similarity")).drop("best")


def mean_pooled(tokens: Column, mask: Column) -> Column:
    """Mean of the token vectors whose mask is 1, at unit length. tokens: array of vectors; mask: array of 0 and 1."""
    kept = F.transform(F.filter(F.arrays_zip(tokens.alias("v"), mask.alias("m")), lambda x: x["m"] == 1), lambda x: F.transform(x["v"], lambda y: y.cast("double")))
    total = F.aggregate(F.slice(kept, 2, F.greatest(F.size(kept) - 1, F.lit(0))), F.get(kept, F.lit(0)), lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
    return normalized(total)  # the number of vectors cancels out


def size_percentiles(sizes: DataFrame, points: tuple[float, ...] = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    """(point, size): percentiles of the clusters' sizes."""
    x = sizes.agg(F.percentile("n", F.array(*(F.lit(p) for p in points))).alias("p"))
    return x.select(F.posexplode("p").alias("i", "size")).select(F.get(F.array(*(F.lit(p) for p in points)), F.col("i")).alias("point"), "size")


def cluster_model(df: DataFrame, vector: str, k: int, seed: int = 0):
    """k-means of array columns, by Spark's own."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    return KMeans(k=k, seed=seed, featuresCol="v").fit(df.select(array_to_vector(vector).alias("v")))
