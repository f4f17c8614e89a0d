"""Derived tables the operators run on, built by Spark from the given tables.

*Scored table* (from ``events``): a labelled and an unlabelled pool, a score,
a reference slice by time and fixed-size batches in id order.

*Churn mart* (from ``customer`` + ``orders``): per-customer history features
before a cut-off date and a churn label (no order on or after it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.materialize import materialize
from tidemark.operators.rank import dist_rank, with_quantile_bucket, default_bucket_count
from tidemark.sources.tables import read_table

# Fixed values of the fixtures.
REFERENCE_END = "2024-01-11 00:00:00"
LABELLED_SOURCE = "train_holdout"
UNLABELLED_SOURCE = "test"
BATCH_SIZE = 1000
CHURN_CUTOFF = "2001-02-01 00:00:00"


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    ds = F.when(F.col("user_id") % 2 == 0, F.lit(LABELLED_SOURCE)).otherwise(F.lit(UNLABELLED_SOURCE))
    y = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    return ev.select(
        F.col("event_id").alias("id"), "ts", "value", "user_id", "event_type",
        ds.alias("data_source"),
        F.when(ds == LABELLED_SOURCE, y).cast("int").alias("y"),
        F.round(1 / (1 + F.exp(-(F.col("value") - 50) / 50)), 6).alias("p"))


def reference_slice(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("ts") < F.lit(REFERENCE_END).cast("timestamp_ntz"))


def current_slice(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("ts") >= F.lit(REFERENCE_END).cast("timestamp_ntz"))


def with_batches(df: DataFrame, size: int = BATCH_SIZE, partition_by=("data_source",),
                 order_col: str = "id", n_buckets: int | None = None) -> DataFrame:
    """Fixed-size batches in ``order_col`` order per pool; the last one is short.

    ``batch_id = (rank - 1) div size`` with a distributed rank: rows are split
    by approximate quantiles of the order key, so no pool is ranked by a
    single task.
    """
    nb = n_buckets or default_bucket_count(df.sparkSession)
    parts = list(partition_by)
    b = with_quantile_bucket(df, parts, order_col, nb, name="_ob")
    r = dist_rank(b, parts, [order_col], "_ob", name="_rank").drop("_ob")
    return r.withColumn("batch_id", F.floor((F.col("_rank") - 1) / F.lit(size)).cast("int")).drop("_rank")


def current_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current slice with batch ids, written once (read by every metric)."""
    return materialize(with_batches(current_slice(scored_events(spark, sf_dir))))


def churn_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    cust = read_table(spark, sf_dir, "customer")
    cutoff = F.lit(CHURN_CUTOFF).cast("timestamp_ntz")
    before = F.col("o_orderdate") < cutoff
    flag = lambda hit: F.max(F.when(before & hit, 1).otherwise(0))
    # one scan and one aggregate of the orders: history before the cut-off, and whether any follows
    hist = (orders.groupBy("o_custkey")
            .agg(F.count(F.when(before, 1)).alias("n_orders"),
                 F.sum(F.when(before, F.col("o_totalprice"))).alias("total_spend"),
                 F.datediff(cutoff, F.min(F.when(before, F.col("o_orderdate")))).alias("tenure_days"),
                 flag(F.col("o_orderpriority") == "1-URGENT").alias("has_urgent"),
                 flag(F.col("o_orderpriority") == "5-LOW").alias("has_low"),
                 flag(F.col("o_orderstatus") == "P").alias("has_pending"),
                 F.max((F.col("o_orderdate") >= cutoff).cast("int")).alias("_later"))
            .filter("n_orders > 0"))
    m = cust.select(F.col("c_custkey").alias("id"), "c_mktsegment", "c_acctbal").join(hist, F.col("id") == F.col("o_custkey"))
    return m.select(
        "id", "c_mktsegment", "c_acctbal", "o_custkey", "n_orders", "total_spend", "tenure_days",
        "has_urgent", "has_low", "has_pending",
        F.when(F.col("_later") == 1, F.lit("No")).otherwise(F.lit("Yes")).alias("churn"))


def yes_no(c) -> F.Column:
    return F.when(F.col(c) == 1, F.lit("Yes")).otherwise(F.lit("No"))


def churn_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The churn mart in record form: Yes/No flags, label Yes/No."""
    m = churn_mart(spark, sf_dir)
    return m.select("id", "c_mktsegment", "c_acctbal", "n_orders", "total_spend", "tenure_days",
                    yes_no("has_urgent").alias("urgent"), yes_no("has_low").alias("low"),
                    yes_no("has_pending").alias("pending"), "churn")
