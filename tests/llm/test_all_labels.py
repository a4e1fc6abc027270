"""Quality rules learn from every label, however many there are."""

import math

import pytest
from pyspark.sql import functions as F

from weftline.llm import quality_rules
from weftline.llm.common import ready


@pytest.mark.parametrize("broadcast", [quality_rules.BROADCAST_IDS, 10])
def test_no_label_is_left_out(spark, monkeypatch, broadcast):
    """25,000 trusted texts of one word, 20,000 others of another: more than any bound on samples that there was."""
    monkeypatch.setattr(quality_rules, "BROADCAST_IDS", broadcast)
    monkeypatch.setattr(quality_rules, "MIN_WORDS", 1)
    ready(spark)
    docs = spark.range(45_000, numPartitions=4).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 25_000, "good").otherwise("bad").alias("text"))
    labels = docs.select("doc_id", F.when(F.col("doc_id") < 25_000, 1).otherwise(0).alias("quality"))
    model = quality_rules.fit(docs, labels).first()
    m = labels.where(f"quality = 1 AND pmod(xxhash64('threshold', doc_id), {quality_rules.TUNE}) <> 0").count()
    bucket = {r.text: r.b for r in docs.groupBy("text").agg(F.first(F.pmod(F.xxhash64("text"), F.lit(quality_rules.BUCKETS))).alias("b")).collect()}
    ratio = lambda good, raw: math.log((good + quality_rules.PRIOR) / (raw * (m / 45_000) + quality_rules.PRIOR))
    good, bad = ratio(m, 25_000), ratio(0, 20_000)
    assert [model.ratios[bucket["good"]], model.ratios[bucket["bad"]]] == pytest.approx([good, bad], abs=1e-12)
    assert model.threshold == pytest.approx((good + bad) / 2, abs=1e-12)
