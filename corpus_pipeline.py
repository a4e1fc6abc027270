"""The cleaning pipeline: STAGES over `documents`, each stage written as Parquet and reread as the next one's input.

Every stage but the last keeps the columns of documents. Near duplicates are documents whose five-word shingles have a
Jaccard similarity of 0.8 or more (near_copies.py): candidates are SimHash's at three of 64 bits, by op8's bit-sliced
comparison, and then those of MinHash bands, since most pairs at 0.8 differ in more bits.
ORACLE_SQL is None: learned weights, hashed n-grams, fingerprints and packing aren't expressible in SQL;
tests/llm/test_stages.py holds every stage and run() against brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import line_dedup, packing, quality_rules, simhash, toxicity
from weftline.llm.common import ready, stored, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("quality_rules", quality_rules.stage),
    ("line_dedup", line_dedup.stage),
    ("simhash_near_dedup", simhash.stage),
    ("best_fit_packing", packing.stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the documents of sf_dir."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
