"""Sampling, chunking, ranking and percentile cuts that depend on content and seed, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bounded(df: DataFrame, n: int, seed: int, key: Column) -> DataFrame:
    """n rows, or all: those of the lowest digest of seed and key. Plans as a top-n, not as a full sort."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return df.withColumn("_digest", digest).orderBy("_digest", key).limit(n).drop("_digest")


def shuffled(df: DataFrame, seed: int, key: Column) -> DataFrame:
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), key)


#: Stretches whose sizes are summed in one place before sums of sums are.
GROUP = 4096


def ranked(df: DataFrame, stretch: Column, *order: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """df with `rank` from 0 in a global order, or in one for each value of `by`, and `total`, the rows ranked together.

    stretch must ascend with the order, in whole numbers; each stretch is ranked by itself. The sizes of the stretches
    before are summed in groups of GROUP stretches, and only the groups' sums in one place: a row for 4,096 stretches.
    """
    d = df.withColumn("_stretch", stretch.cast("long"))
    keys = [F.col(c) for c in by]
    sizes = d.groupBy(*keys, "_stretch").agg(F.count("*").alias("_n")).withColumn("_group", F.floor(F.col("_stretch") / GROUP))
    groups = sizes.groupBy(*keys, "_group").agg(F.sum("_n").alias("_m"))
    before = Window.partitionBy(*keys).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(*keys, "_group", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_far"), F.sum("_m").over(Window.partitionBy(*keys)).alias("total"))
    near = Window.partitionBy(*keys, "_group").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_near", F.coalesce(F.sum("_n").over(near), F.lit(0))).join(groups, [*by, "_group"])
    sizes = sizes.select(*keys, "_stretch", (F.col("_far") + F.col("_near")).alias("_before"), "total")
    within = F.row_number().over(Window.partitionBy(*keys, "_stretch").orderBy(*order)) - 1
    return d.withColumn("_within", within).join(sizes, [*by, "_stretch"]).withColumn("rank", F.col("_before") + F.col("_within")).drop("_stretch", "_within", "_before")


def chunks(df: DataFrame, parts: int, stretch: Column, *order: Column) -> DataFrame:
    """df with `chunk` from 1: contiguous runs of ceil(rows / parts) rows."""
    per = F.ceil(F.col("total") / parts)
    return ranked(df, stretch, *order).withColumn("chunk", F.floor(F.col("rank") / per).cast("long") + 1).drop("total")


def trim_worst(df: DataFrame, share: float, score: str, stretch: Column, *order: Column) -> DataFrame:
    """Without the lowest rows: from line floor(n * share) on, counted from 1, so one row fewer goes.

    Rows are counted by score; only those of the boundary's score are ranked, by `order`, along which stretch ascends.
    """
    counts = ranked_counts(df, score)
    cut = F.greatest(F.floor(F.col("total") * share) - 1, F.lit(0))
    edge = counts.where((F.col("before") <= cut) & (cut < F.col("before") + F.col("n"))).select(F.col(score).alias("edge"), (cut - F.col("before")).alias("skip"))
    at, skip = edge.select("edge").scalar(), edge.select("skip").scalar()
    ties = ranked(df.where(F.col(score) == at), stretch, *order).where(F.col("rank") >= skip).drop("rank", "total")
    return df.where(F.col(score) > at).unionByName(ties)


def ranked_counts(df: DataFrame, score: str) -> DataFrame:
    """(score, n, before, total): rows of each score, rows of lower scores, and all rows."""
    c = df.groupBy(score).agg(F.count("*").alias("n")).withColumn("_group", F.floor(F.col(score) * 1000))
    g = c.groupBy("_group").agg(F.sum("n").alias("_m"))
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)  # a row for each thousandth
    g = g.select("_group", F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_far"), F.sum("_m").over(Window.partitionBy()).alias("total"))
    near = Window.partitionBy("_group").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    return c.join(g, "_group").select(score, "n", (F.col("_far") + F.coalesce(F.sum("n").over(near), F.lit(0))).alias("before"), "total")


def round_robin(df: DataFrame, n: int, cluster: str, id_col: str) -> DataFrame:
    """n rows taken from clusters in turn, the highest ids first. No cluster gives more than n rows, so ranks stop there."""
    turn = F.row_number().over(Window.partitionBy(cluster).orderBy(F.desc(id_col)))
    return df.withColumn("turn", turn).where(F.col("turn") <= n).orderBy("turn", cluster).limit(n)


def weighted_mix(corpora: dict[str, tuple[DataFrame, float]], n: int, seed: int, key: str) -> DataFrame:
    """n rows drawn from corpora in proportion to their weights, by digest."""
    total, out = sum(w for _, w in corpora.values()), None
    for name, (df, w) in corpora.items():
        part = bounded(df, round(n * w / total), seed, F.col(key)).withColumn("corpus", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def batches(df: DataFrame, size: int, stretch: Column, *order: Column) -> DataFrame:
    return ranked(df, stretch, *order).withColumn("batch", F.floor(F.col("rank") / size).cast("long")).drop("total")


def padded_batches(df: DataFrame, limit: int, tokens: str, stretch: Column, *order: Column) -> DataFrame:
    """Rows of like length together: `bucket` by length in tens, and `batch` within it, so padded sizes stay under limit."""
    d = df.withColumn("bucket", F.ceil(F.greatest(F.col(tokens), F.lit(1)) / 10).cast("long"))
    per = F.greatest(F.lit(1), F.floor(F.lit(limit) / (F.col("bucket") * 10)))
    return ranked(d, stretch, *order, by=("bucket",)).withColumn("batch", F.floor(F.col("rank") / per).cast("long")).drop("rank", "total")
