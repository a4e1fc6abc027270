"""Corpora derived from the tables: lines, pairs, documents with scores, candidates; as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Lines of a document that positions leave room for: pos is doc_id * LINES_EACH + line number.
LINES_EACH = 100_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; where the scan has fewer splits than the session has cores, they are dealt out by id first."""
    d, cores = read(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism
    return d.repartition(cores, "doc_id") if d.rdd.getNumPartitions() < cores else d


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, pos, doc_id, line_no, lang, text): lines of documents; pos orders them."""
    d = documents(spark, sf_dir).select("doc_id", "lang", F.col("source").alias("dataset"), F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
    return d.select("dataset", (F.col("doc_id") * LINES_EACH + F.col("line_no")).alias("pos"), "doc_id", F.col("line_no").cast("long").alias("line_no"), "lang", "text")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, pos, doc_id, line_no, src, trg, score): neighbouring lines as pairs, made within each document's row."""
    parts = F.split("text", "\n")
    d = documents(spark, sf_dir).where("text IS NOT NULL").select("doc_id", F.col("source").alias("dataset"), parts.alias("p"))
    both = F.arrays_zip(F.slice("p", 1, F.size("p") - 1).alias("src"), F.slice("p", 2, F.size("p") - 1).alias("trg"))
    x = d.where(F.size("p") > 1).select("dataset", "doc_id", F.posexplode(both).alias("line_no", "z"))
    score = ((F.col("doc_id") * 31 + F.col("line_no") * 17) % 101) / F.lit(100.0)
    return x.select("dataset", (F.col("doc_id") * LINES_EACH + F.col("line_no")).alias("pos"), "doc_id", F.col("line_no").cast("long").alias("line_no"), F.col("z.src").alias("src"), F.col("z.trg").alias("trg"), score.alias("score"))


def parallel_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text): benchmark passages and the lines of every tenth document, as the corpus that mono data must not repeat."""
    return read(spark, sf_dir, "benchmark").select("text").unionByName(lines(spark, sf_dir).where(F.col("doc_id") % 10 == 0).select("text"))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang array, doc_scores array, seg_langs array, text): documents as crawls give them."""
    d = documents(spark, sf_dir).withColumnRenamed("lang", "l")
    seg = F.transform(F.split("text", "\n"), lambda _, i: F.when((F.col("doc_id") + i) % 7 == 0, F.lit("unk")).otherwise(F.col("l")))
    return d.select("doc_id", F.array("l").alias("lang"), F.array((F.col("doc_id") % 11).cast("double")).alias("doc_scores"), seg.alias("seg_langs"), "text")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(idx, rank, hyp, ref): three candidates of each line that isn't blank, and the line itself."""
    x = lines(spark, sf_dir).where(F.trim("text").rlike("[^ ]")).select(F.col("pos").alias("idx"), F.col("text").alias("ref"))
    w = F.split("ref", " ")
    half = F.array_join(F.slice(w, 1, F.greatest(F.floor(F.size(w) / 2).cast("int"), F.lit(1))), " ")
    return x.select("idx", "ref", F.posexplode(F.array(half, F.lower("ref"), F.col("ref"))).alias("rank", "hyp")).withColumn("rank", F.col("rank").cast("long"))


LINES = f"""L AS (SELECT source AS dataset, doc_id * {LINES_EACH} + line_no AS pos, doc_id, line_no, lang, text FROM (
  SELECT source, doc_id, lang, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10)))::BIGINT)) AS line_no FROM documents))"""
PAIRS = LINES + """, P AS (SELECT dataset, pos, doc_id, line_no, src, trg, ((doc_id * 31 + line_no * 17) % 101) / 100.0::DOUBLE AS score FROM (
  SELECT *, text AS src, lead(text) OVER (PARTITION BY doc_id ORDER BY line_no) AS trg FROM L) WHERE trg IS NOT NULL)"""
PARALLEL = LINES + ", Q AS (SELECT text FROM benchmark UNION ALL SELECT text FROM L WHERE doc_id % 10 = 0)"
CANDIDATES = LINES + """, C AS (SELECT pos AS idx, text AS ref, string_split(text, ' ') AS w FROM L WHERE regexp_matches(text, '[^ ]')),
N AS (SELECT idx, ref, 0::BIGINT AS rank, array_to_string(w[1:greatest(len(w) // 2, 1)], ' ') AS hyp FROM C
  UNION ALL SELECT idx, ref, 1, lower(ref) FROM C UNION ALL SELECT idx, ref, 2, ref FROM C)"""
