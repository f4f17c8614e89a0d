"""Distributed prefix sums, ranks and as-of lookups.

A window with a small-cardinality ``PARTITION BY`` (two classes, two data
sources, one column) or none at all is executed by one task per key.  When one
key holds a third of all rows that task holds a third of the table.  The
helpers here split every key into ordered *buckets* first:

1. each row gets a bucket number that is non-decreasing in the sort order;
2. per ``(key, bucket)`` totals are aggregated (map-side partial aggregate);
3. an exclusive prefix over the bucket totals gives each bucket its offset —
   this window runs over the tiny totals table, not over rows;
4. the offsets are joined back on ``(key, bucket)``; the planner picks a
   broadcast or a shuffle join from the measured size of the totals (AQE),
   so nothing is broadcast on a guess;
5. the row-level window runs per ``(key, bucket)``: many small tasks.

The bucket count sets the split (``default_bucket_count``: four per shuffle
partition); at cluster scale a bucket should hold a few million rows.  Keys
are matched null-safely, so rows with a null key are ranked, not dropped.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import join_keys

BKT = "_bkt"


def _names(cols) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def default_bucket_count(spark) -> int:
    """Four buckets per shuffle partition, at least 64."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(64, 4 * n)


def unit_bucket(c, n_buckets: int) -> Column:
    """Bucket for a key known to lie in [0, 1] (hash draws, probabilities, shares)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.greatest(F.least(F.floor(col * F.lit(n_buckets)), F.lit(n_buckets - 1)), F.lit(0)).cast("int")


def with_quantile_bucket(df: DataFrame, partition_by, value: str, n_buckets: int,
                         accuracy: int | None = None, name: str = BKT) -> DataFrame:
    """Add a bucket column from approximate quantiles of ``value`` over the whole table.

    Buckets are monotone in ``value``, so they serve every key: no ``(key,
    bucket)`` holds more than about ``1 / n_buckets`` of all rows, however the
    rows spread over keys.  The ``n_buckets - 1`` boundaries come from
    ``percentile_approx`` (a mergeable sketch, one pass) and are applied with a
    binary search (``Bucketizer``).  Ties land in one bucket; callers that
    expect many reduce their rows to counts per distinct value first.
    ``partition_by`` names the keys for the reader's sake.
    """
    from pyspark.ml.feature import Bucketizer

    probs = F.array(*[F.lit(i / n_buckets) for i in range(1, n_buckets)])
    row = df.agg(F.percentile_approx(F.col(value).cast("double"), probs, accuracy or max(10000, 10 * n_buckets)).alias("_b")).first()
    inner = sorted({x for x in (row["_b"] or []) if x is not None and x == x and abs(x) != float("inf")})
    if not inner:  # one bucket (or no values): nothing to search
        return df.withColumn(name, F.lit(0))
    splits = [float("-inf")] + inner + [float("inf")]
    tmp = "_qb_in"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=name + "_d", handleInvalid="keep")
    out = b.transform(df.withColumn(tmp, F.col(value).cast("double")))
    return out.withColumn(name, F.col(name + "_d").cast("int")).drop(tmp, name + "_d")


def dist_cumsum(df: DataFrame, partition_by, order_by: Sequence, bucket: Column | str | None,
                sums: dict[str, Column | str], inclusive: bool = True, totals_as: dict[str, str] | None = None,
                few_keys: bool = False) -> DataFrame:
    """Running sums in ``order_by`` order within ``partition_by``.

    ``totals_as`` names columns for the totals of sums over the whole key; they
    come with the bucket offsets, without another join (not for a None bucket).

    ``bucket`` must be non-decreasing in ``order_by`` within each key; None
    says that every key is small by definition (a batch of fixed size), and a
    plain window does.  ``sums`` maps output name -> column to accumulate.
    With ``inclusive`` the current row is included (ROWS UNBOUNDED PRECEDING
    .. CURRENT ROW).  ``few_keys`` says that the schema bounds the keys (names of
    columns): their bucket offsets are broadcast, and rows are shuffled once.
    """
    parts = _names(partition_by)
    if bucket is None:
        hi = Window.currentRow if inclusive else -1
        w = Window.partitionBy(*parts).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, hi)
        for name, expr in sums.items():
            df = df.withColumn(name, F.coalesce(F.sum(F.col(expr) if isinstance(expr, str) else expr).over(w), F.lit(0)))
        return df
    b = df.withColumn(BKT, F.col(bucket) if isinstance(bucket, str) else bucket)
    tmp = {name: f"_v_{i}" for i, name in enumerate(sums)}
    for name, expr in sums.items():
        b = b.withColumn(tmp[name], F.col(expr) if isinstance(expr, str) else expr)
    keys = parts + [BKT]
    totals = b.groupBy(*keys).agg(*[F.sum(t).alias(t + "_tot") for t in tmp.values()])
    wb = Window.partitionBy(*parts).orderBy(BKT).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parts)
    offsets = totals.select(*keys, *[
        F.coalesce(F.sum(t + "_tot").over(wb), F.lit(0)).alias(t + "_off") for t in tmp.values()],
        *[F.sum(tmp[name] + "_tot").over(whole).alias(total) for name, total in (totals_as or {}).items()])
    joined = join_keys(b, F.broadcast(offsets) if few_keys else offsets, keys, "inner")
    hi = Window.currentRow if inclusive else -1
    wr = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, hi)
    for name, t in tmp.items():
        joined = joined.withColumn(name, F.col(t + "_off") + F.coalesce(F.sum(t).over(wr), F.lit(0)))
    return joined.drop(*[t for t in tmp.values()], *[t + "_off" for t in tmp.values()], BKT)


def dist_rank(df: DataFrame, partition_by, order_by: Sequence, bucket: Column | str,
              name: str = "rank", size: str | None = None) -> DataFrame:
    """``row_number()`` within ``partition_by`` without a one-task window; ``size`` names a column for the key's rows.

    ``order_by`` must be unique within a key for a deterministic result.
    """
    return dist_cumsum(df, partition_by, order_by, bucket, {name: F.lit(1).cast("long")}, totals_as={name: size} if size else None)


def dist_asof_next(df: DataFrame, partition_by, order_by: Sequence, bucket: Column | str,
                   is_target: Column, payload: Sequence[str], few_keys: bool = False) -> DataFrame:
    """For every row, the payload of the first *target* row at or after it.

    The forward as-of lookup used for quantile crossings: rows are sorted by
    ``order_by`` within ``partition_by``; targets are the rows where
    ``is_target`` holds.  A bucket with no later target inside it takes the
    first target of the next non-empty bucket from a small carry table, which
    is broadcast if the schema bounds the keys (``few_keys``).
    """
    parts = _names(partition_by)
    b = df.withColumn(BKT, F.col(bucket) if isinstance(bucket, str) else bucket) \
          .withColumn("_tgt", is_target)
    plain = b
    keys = parts + [BKT]
    # "first target at or after" == "last target at or before" in reversed
    # order; a growing frame keeps the window linear (a frame ending at
    # UNBOUNDED FOLLOWING is re-evaluated per row).
    desc = [(F.col(o) if isinstance(o, str) else o).desc() for o in order_by]
    wr = Window.partitionBy(*keys).orderBy(*desc).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for p in payload:
        b = b.withColumn("_loc_" + p, F.last(F.when(F.col("_tgt"), F.col(p)), ignorenulls=True).over(wr))
    order_struct = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order_by])
    # one aggregate before the window: the buckets there are, and the first target of each
    firsts = plain.groupBy(*keys).agg(F.min_by(F.when(F.col("_tgt"), F.struct(*[F.col(p).alias(p) for p in payload])),
                                               F.when(F.col("_tgt"), order_struct)).alias("_first"))
    wc = Window.partitionBy(*parts).orderBy(F.col(BKT).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = firsts.select(*keys, *[F.last(F.col("_first." + p), ignorenulls=True).over(wc).alias("_car_" + p) for p in payload])
    out = join_keys(b, F.broadcast(carry) if few_keys else carry, keys, "left")
    for p in payload:
        out = out.withColumn("_next_" + p, F.coalesce(F.col("_loc_" + p), F.col("_car_" + p)))
    return out.drop(BKT, "_tgt", *["_loc_" + p for p in payload], *["_car_" + p for p in payload])
