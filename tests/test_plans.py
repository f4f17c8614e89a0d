"""Plan guards: distributed ranks, pushdown and pruning."""

from pyspark.sql import functions as F

from tidemark.operators import evaluate as EV
from tidemark.operators import split as SP
from tidemark.plans.fixtures import churn_records, scored_events, with_batches
from tidemark.sources.tables import read_table

from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_never_use_a_single_partition(spark):
    r = churn_records(spark, SF_SMALL)
    for df in (SP.stratified_folds(r, "churn"), with_batches(scored_events(spark, SF_SMALL)),
               EV.roc_auc(scored_events(spark, SF_SMALL).filter("y is not null"), ["data_source"])):
        assert "SinglePartition" not in plan(df)


def test_filter_and_columns_reach_the_scan(spark):
    ev = read_table(spark, SF_SMALL, "events")
    df = ev.filter(F.col("value") > 10).select("event_id", "value")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,10.0)]" in p
    assert "ReadSchema: struct<event_id:bigint,value:double>" in p


def _final_plan(df):
    """The settled plan of the frame itself (a write would settle another execution)."""
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "AdaptiveSparkPlan" not in p or "isFinalPlan=true" in p
    return p


def test_flagship_has_no_pairwise_joins(spark):
    import __spark_entry__ as E
    p = _final_plan(E.entry(spark))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_reports_use_top_k_and_partial_aggregates(spark):
    import __spark_entry__ as E
    q = E.queries()
    recent = q["recent_batches"](spark, SF_SMALL)
    assert "TakeOrderedAndProject" in recent._jdf.queryExecution().executedPlan().toString()
    latest = _final_plan(q["latest_auc"](spark, SF_SMALL))
    # the panel is a keyless partial aggregate (max_by), never a sort by time
    assert "Aggregate(key=[]" in latest or "Aggregate(keys=[]" in latest
    assert "Sort [ts" not in latest


def test_mart_reads_each_table_once(spark):
    from tidemark.plans.fixtures import churn_mart
    assert _final_plan(churn_mart(spark, SF_SMALL)).split("== Initial Plan ==")[0].count("Scan parquet") == 2
