"""Connected components of a link table by alternating large and small stars.

Each round is two minimum aggregates and two joins on the node id.  Both sides
of a join are written tables, so the adaptive planner can split a hub with
very many links over tasks.  Links stay in Spark.  Whether they have become
stars is one aggregate over their ends, not a further round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.materialize import materialize


def _settled(e: DataFrame) -> bool:
    """Whether the links are stars: every larger end has one link, and is no smaller end."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionAll(e.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    per = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count(F.lit(1)).alias("n"))
    return per.filter("ups > 1 or (ups = 1 and n > 1)").isEmpty()


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-min")
    # the larger neighbours of u are exactly the rows whose smaller end is u
    up = e.select(F.col("v").alias("u"), F.col("u").alias("w"))
    return up.join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = materialize(e.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
    moved = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (two columns); the component is its smallest node.

    Loops and rows with a null end are ignored; repeated links count once.
    """
    a, b = links.columns[:2]
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
    e = materialize(e.distinct(), "cc-links")
    for _ in range(max_rounds):
        if _settled(e):
            break
        e = materialize(_small_star(materialize(_large_star(e), "cc-large")), "cc-small")
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return materialize(e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots), "cc")
