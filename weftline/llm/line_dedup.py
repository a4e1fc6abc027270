"""Site-relative boilerplate lines. DataFrame functions only.

For each site, the pages that contain a line are divided by the pages of the site; lines above `ratio` that stand on at
least `min_pages` pages are boilerplate there and are dropped from every page of the site. A line is compared without
the spaces around it; blank lines are neither counted nor dropped. A line repeated within one page counts once.

Only digests of lines are shuffled, already distinct within a page and counted map-side. A boilerplate line covers more
than `ratio` of a site's pages, so a site has fewer than (mean lines a page) / ratio of them; the list of all sites is
broadcast while it has at most `BROADCAST_LINES` lines, and beyond that joined by site with Spark splitting hot sites.

Edge cases: null text stays null and has no lines; null site is a site of its own; repeated rows are pages each; an
empty table gives an empty result; a text whose lines all go becomes empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried, ready, stored, table

RATIO = 0.1
MIN_PAGES = 3
#: The stage's own bounds, below op2's, which its SQL fixes: what a site repeats stands on few of its pages, but a line of
#: its own stands on one. Five pages tell them apart on any site; the ratio only asks more of sites of over 1,000 pages.
STAGE_RATIO, STAGE_MIN_PAGES = 0.005, 5
BROADCAST_LINES = 100_000


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line)))


def _keys(text: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""), _key))


def boilerplate(pages: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(_host, _drop): digests of the boilerplate lines of each site that has any."""
    p = pages.select(F.col(host_col).alias("_host"), _keys(F.col(text_col)).alias("_keys"))
    totals = p.groupBy("_host").agg(F.count("*").alias("_total"))
    lines = p.select("_host", F.explode("_keys").alias("_key")).groupBy("_host", "_key").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_pages)
    totals = totals.withColumnRenamed("_host", "_h")
    over = lines.join(totals, F.col("_host").eqNullSafe(F.col("_h"))).where(F.col("_n") > F.lit(ratio) * F.col("_total"))
    return over.groupBy("_host").agg(F.array_sort(F.collect_list("_key")).alias("_drop"))


def drop_lines(pages: DataFrame, found: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """pages with text_col rewritten, _n_lines and _n_dropped added. found: a stored result of boilerplate()."""
    n = found.agg(F.coalesce(F.sum(F.size("_drop")), F.lit(0))).first()[0]
    found = found.withColumnRenamed("_host", "_h")
    text = F.col(text_col)
    d = pages.join(F.broadcast(found) if n <= BROADCAST_LINES else found, F.col(host_col).eqNullSafe(F.col("_h")), "left")
    d = d.withColumn("_lines", F.split(text, "\n"))
    kept = F.filter("_lines", lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("_drop"), _key(x)))
    d = d.withColumn("_left", F.when(F.col("_drop").isNull(), F.col("_lines")).otherwise(kept))
    d = d.withColumn("_n_lines", F.coalesce(F.size(F.filter("_lines", lambda x: F.trim(x) != "")), F.lit(0)).cast("long"))
    d = d.withColumn("_n_dropped", F.when(text.isNull(), F.lit(0)).otherwise(F.size("_lines") - F.size("_left")).cast("long"))
    return d.withColumn(text_col, F.when(F.col("_n_dropped") == 0, text).otherwise(F.array_join("_left", "\n"))).drop("_lines", "_left", "_drop", "_h")


def dedup_lines(pages: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    return drop_lines(pages, stored(boilerplate(pages, host_col, text_col, ratio, min_pages), "boilerplate"), host_col, text_col)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return dedup_lines(docs).select("doc_id", F.col("source").alias("host"), F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), "text")


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, source AS host, pos, line FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)
), totals AS (SELECT source AS host, count(*) AS total FROM documents GROUP BY 1),
counted AS (SELECT host, trim(line, ' ') AS k, count(DISTINCT doc_id) AS n FROM lines WHERE trim(line, ' ') <> '' GROUP BY 1, 2),
bad AS (SELECT c.host, c.k FROM counted c JOIN totals t ON c.host IS NOT DISTINCT FROM t.host WHERE c.n >= {MIN_PAGES} AND c.n > {RATIO} * t.total),
marked AS (SELECT l.*, b.k IS NOT NULL AS drop_it, trim(line, ' ') <> '' AS solid FROM lines l LEFT JOIN bad b ON l.host IS NOT DISTINCT FROM b.host AND trim(l.line, ' ') = b.k)
SELECT d.doc_id, d.source AS host, coalesce(m.n_lines, 0)::BIGINT AS n_lines, coalesce(m.n_dropped, 0)::BIGINT AS n_dropped,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(m.body, '') END AS text
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (solid) AS n_lines, count(*) FILTER (drop_it) AS n_dropped, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drop_it) AS body
  FROM marked GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its boilerplate lines dropped; n_chars follows the text."""
    ready(spark)
    d = dedup_lines(carried(docs, "source", "text"), ratio=STAGE_RATIO, min_pages=STAGE_MIN_PAGES)
    new = {"text": F.col("text"), "n_chars": F.when(F.col("_n_dropped") == 0, F.col("_row.n_chars")).otherwise(F.length("text").cast("long")) if "n_chars" in docs.columns else None}
    return d.select(*[new[c].alias(c) if c in new else F.col(f"_row.`{c}`") for c in docs.columns])
