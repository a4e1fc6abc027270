"""Union, deduplication and joins of corpora, and their accounting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import norm_key, strip


def best_per_target(pairs: DataFrame) -> DataFrame:
    """For each target key the pair of the highest score; of equal scores the first by dataset and position."""
    keyed = pairs.withColumn("key", norm_key(F.col("trg")))
    first = Window.partitionBy("key").orderBy(F.desc("score"), "dataset", "pos")
    return keyed.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn", "key")


def kept_by_dataset(pairs: DataFrame) -> DataFrame:
    """(dataset, visited, kept, filtered) and a total, whose dataset is null.

    Pairs are counted by target and dataset first, which combines before the shuffle; a target's best pair is then found
    among its datasets.
    """
    keyed = pairs.select("dataset", norm_key(F.col("trg")).alias("key"), F.struct(F.col("score"), (-F.col("pos")).alias("late")).alias("best"))
    c = keyed.groupBy("key", "dataset").agg(F.count("*").alias("n"), F.max("best").alias("best"))
    first = Window.partitionBy("key").orderBy(F.desc("best.score"), "dataset")
    x = c.withColumn("k", (F.row_number().over(first) == 1).cast("long")).rollup("dataset").agg(F.sum("n").alias("visited"), F.sum("k").alias("kept"))
    return x.select("dataset", "visited", "kept", (F.col("visited") - F.col("kept")).alias("filtered"))


def keyed(df: DataFrame) -> DataFrame:
    """df with `key`; a null text has an empty key. The key is never null, so joins on it needn't work it out twice."""
    return df.withColumn("key", F.coalesce(norm_key(F.col("text")), F.lit("")))


def without(mono: DataFrame, parallel: DataFrame) -> DataFrame:
    """Lines of mono whose key isn't one of parallel's."""
    return keyed(mono).join(keyed(parallel).select("key").distinct(), "key", "left_anti").drop("key")


def first_lines(mono: DataFrame, parallel: DataFrame) -> DataFrame:
    """Of the lines whose key isn't one of parallel's, the first by dataset and position of each key.

    An aggregate, so that a line that stands everywhere is combined before the shuffle.
    """
    rest = keyed(mono).join(keyed(parallel).select("key").distinct(), "key", "left_anti")
    row = F.struct("dataset", "pos", *(c for c in mono.columns if c not in ("dataset", "pos")))
    return rest.groupBy("key").agg(F.min_by(row, F.struct("dataset", "pos")).alias("row")).select("row.*").select(*mono.columns)


def mono_stats(mono: DataFrame, parallel: DataFrame) -> DataFrame:
    """One row of counters; code points include each line's end."""
    theirs = keyed(parallel).select("key").distinct().withColumn("hit", F.lit(1))
    c = keyed(mono).groupBy("key").agg(F.count("*").alias("n"), F.min_by(F.length("text") + 1, F.struct("dataset", "pos")).alias("points"))
    x = c.join(theirs, "key", "full").select("n", "points", F.col("hit").isNotNull().alias("theirs"))
    add = lambda what, when: F.coalesce(F.sum(F.when(when, what)), F.lit(0))
    mine = F.col("n").isNotNull()
    s = x.agg(
        add(F.col("n"), mine).alias("visited"), F.count_if(mine & ~F.col("theirs")).alias("kept"), add(F.col("n"), mine & F.col("theirs")).alias("parallel_duplicates"),
        add(F.col("n") - 1, mine & ~F.col("theirs")).alias("mono_duplicates"), add(F.col("points"), mine & ~F.col("theirs")).alias("final_codepoints"), F.count_if(F.col("theirs")).alias("parallel_corpus_lines"),
    )
    return s.withColumn("filtered", F.col("visited") - F.col("kept"))


def distinct_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("src", "trg").unionByName(b.select("src", "trg")).dropDuplicates(["src", "trg"])


def zip_by_position(src: DataFrame, trg: DataFrame) -> DataFrame:
    """(dataset, pos, src, trg) of two corpora that go by dataset and pos; raises where one side has no partner."""
    x = src.withColumn("_s", F.lit(True)).join(trg.withColumn("_t", F.lit(True)), ["dataset", "pos"], "full")
    alone = F.raise_error(F.concat_ws(" ", F.lit("no partner at"), "dataset", F.col("pos").cast("string")))
    return x.select("dataset", "pos", F.when(F.col("_s") & F.col("_t"), F.col("src")).otherwise(alone).alias("src"), "trg")


def zipped(parts: dict[str, DataFrame], by: str = "pos", text: str = "text") -> DataFrame:
    """(by, one column for each part): any number of line streams side by side, in one shuffle of their union.

    Raises where a stream lacks a line that another has; a null text is a line.
    """
    names = list(parts)
    tagged = [df.select(by, F.lit(i).alias("_part"), F.struct(F.col(text)).alias("_line")) for i, df in enumerate(parts.values())]
    x = reduce(DataFrame.unionByName, tagged).groupBy(by).agg(*(F.max(F.when(F.col("_part") == i, F.col("_line"))).alias(f"_{i}") for i in range(len(names))))
    short = F.raise_error(F.concat(F.lit("streams differ in length at "), F.col(by).cast("string")))
    first = F.when(F.greatest(*(F.isnull(f"_{i}") for i in range(len(names)))), short).otherwise(F.col(f"_0.{text}"))
    return x.select(by, first.alias(names[0]), *(F.col(f"_{i}.{text}").alias(n) for i, n in enumerate(names) if i))


def build_tsv(rows: DataFrame) -> DataFrame:
    """(dataset, pos, line): fields stripped of white space and joined by tabs; rows with an empty alignment are dropped."""
    s, t, a = (strip(F.translate(c, "\t", " ")) for c in ("src", "trg", "aln"))
    return rows.where(strip(F.col("aln")) != "").select("dataset", "pos", F.concat_ws("\t", s, t, a).alias("line"))


def record_sync(local: DataFrame, remote: DataFrame) -> DataFrame:
    """(id, action): keep what is on both sides, delete what is only local, create what is only remote."""
    a, b = local.select("id").distinct().withColumn("l", F.lit(True)), remote.select("id").distinct().withColumn("r", F.lit(True))
    action = F.when(F.col("l") & F.col("r"), "keep").when(F.col("l"), "delete").otherwise("create")
    return a.join(b, "id", "full").select("id", action.alias("action"))
