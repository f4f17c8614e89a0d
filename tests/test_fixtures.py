"""Derived fixtures match the documented sizes."""

from pyspark.sql import functions as F

from tidemark.plans.fixtures import churn_records, current_batches, reference_slice, scored_events

from conftest import SF_MID


def test_churn_mart_sizes(spark):
    r = churn_records(spark, SF_MID)
    assert r.count() == 1498
    assert r.filter(F.col("churn") == "Yes").count() == 703


def test_scored_table_pools_and_batches(spark):
    s = scored_events(spark, SF_MID)
    assert s.filter((F.col("data_source") == "test") & F.col("y").isNotNull()).count() == 0
    assert s.filter((F.col("data_source") == "train_holdout") & F.col("y").isNull()).count() == 0
    ref = reference_slice(s).count()
    cur = current_batches(spark, SF_MID)
    assert ref + cur.count() == s.count()
    sizes = [r["n"] for r in cur.groupBy("data_source", "batch_id").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) == 1000
