"""Token counts from an exact length histogram.

Documents are encoded and counted by encoded length. From the histogram alone, suffix sums answer for every context
limit L: tokens left after cutting documents to L, documents cut, and exact quantiles of length. Nothing is sampled.

Edge cases: a null or empty text has length 0 and its own histogram row; an empty table gives an empty histogram;
further columns are not looked at; null ids count like any document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, ready, stored, table, texts
from .encoders import encoder

VOCABULARY = "byte_bpe_50k.json"
#: Lengths per stretch of the two-level suffix sums.
STRETCH = 1024


def length_histogram(docs: DataFrame, path: str, kind: str = "byte", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(n_tokens, n_docs): how many documents have each encoded length."""

    def make():
        enc = encoder(kind, path)
        return lambda batch: [enc.count(batch.column(1))]

    return map_batches(texts(docs, id_col, text_col), make, "n_tokens long").groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """One row for each length that occurs, taken as context limit.

    docs_at_least and tokens_at_least are suffix sums; truncated_total is the tokens left when every document is cut to
    the limit; docs_up_to / total_docs places the length among the quantiles. Between two lengths that occur,
    truncated_total is linear with slope docs_at_least of the next, so these rows answer every limit.
    """
    h = histogram.withColumn("stretch", F.floor(F.col("n_tokens") / STRETCH)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    sums = h.groupBy("stretch").agg(F.sum("n_docs").alias("sd"), F.sum("tokens").alias("st"))
    above = Window.orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)  # one row for each STRETCH lengths
    sums = sums.select("stretch", F.coalesce(F.sum("sd").over(above), F.lit(0)).alias("docs_after"), F.coalesce(F.sum("st").over(above), F.lit(0)).alias("tokens_after"), F.sum("sd").over(Window.partitionBy()).alias("total_docs"), F.sum("st").over(Window.partitionBy()).alias("total_tokens"))
    within = Window.partitionBy("stretch").orderBy(F.desc("n_tokens"))
    x = h.withColumn("d", F.sum("n_docs").over(within)).withColumn("t", F.sum("tokens").over(within)).join(sums, "stretch")
    at_least, tokens_at_least = F.col("d") + F.col("docs_after"), F.col("t") + F.col("tokens_after")
    return x.select(
        F.col("n_tokens").alias("context_limit"),
        "n_docs",
        at_least.alias("docs_at_least"),
        tokens_at_least.alias("tokens_at_least"),
        (F.col("total_tokens") - tokens_at_least + F.col("n_tokens") * at_least).alias("truncated_total"),
        (F.col("total_docs") - at_least + F.col("n_docs")).alias("docs_up_to"),
        "total_docs",
        "total_tokens",
    )


def truncated_total(limits: DataFrame, limit: int) -> int:
    """Tokens left when documents are cut to `limit`, from the rows of limit_table."""
    row = limits.where(F.col("context_limit") >= limit).orderBy("context_limit").select("context_limit", "docs_at_least", "truncated_total").first()
    if row:
        return row.truncated_total - (row.context_limit - limit) * row.docs_at_least
    row = limits.select("total_tokens").first()
    return row.total_tokens if row else 0


def quantile(limits: DataFrame, q: float) -> int | None:
    """The smallest length that at least q of the documents do not exceed."""
    row = limits.where(F.col("docs_up_to") >= F.ceil(F.lit(q) * F.col("total_docs"))).orderBy("context_limit").select("context_limit").first()
    return row.context_limit if row else None


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    histogram = stored(length_histogram(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)), "lengths")
    return limit_table(histogram)
