"""Reproducible splits, folds, batches and pools.

Every "random" choice is the hash draw ``u(seed, id)`` (see
``tidemark.functions.hash_uniform``) — identical after retries and on any
executor.  Ranks inside a class use the distributed rank: classes are few and
one may hold most rows, so rows are bucketed by the draw itself (uniform on
[0, 1)), never ranked by one task per class.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import hash_uniform
from tidemark.operators.rank import default_bucket_count, dist_rank, unit_bucket

# Fixed values of the reference: seed, folds, reference share, batch size.
SEED = 42
N_FOLDS = 5
REFERENCE_FRAC = 0.2


def random_split(df: DataFrame, frac: float = 0.8, seed=SEED, key: str = "id",
                 names=("train", "test")) -> DataFrame:
    """Row-independent split: ``u < frac`` goes to the first part."""
    return df.withColumn("split", F.when(hash_uniform(seed, key) < frac, F.lit(names[0]))
                         .otherwise(F.lit(names[1])))


def class_rank(df: DataFrame, label: str, seed=SEED, key: str = "id",
               n_buckets: int | None = None) -> DataFrame:
    """Rank by ``(u, id)`` within each class; adds ``_u``, ``class_rank``, ``class_n``."""
    nb = n_buckets or default_bucket_count(df.sparkSession)
    d = df.withColumn("_u", hash_uniform(seed, key))
    return dist_rank(d, [label], ["_u", key], unit_bucket("_u", nb), name="class_rank", size="class_n")


def stratified_split(df: DataFrame, label: str, frac: float = REFERENCE_FRAC, seed=SEED,
                     key: str = "id", names=("reference", "holdout")) -> DataFrame:
    """Per class, the ``round(frac * n_class)`` smallest draws form the first part."""
    r = class_rank(df, label, seed, key)
    first = F.col("class_rank") <= F.round(F.lit(frac) * F.col("class_n"))
    return r.withColumn("split", F.when(first, F.lit(names[0])).otherwise(F.lit(names[1]))) \
            .drop("_u", "class_rank", "class_n")


def stratified_folds(df: DataFrame, label: str, k: int = N_FOLDS, seed=SEED, key: str = "id") -> DataFrame:
    """Fold number ``(class_rank - 1) mod k``: per-class fold sizes differ by <= 1."""
    r = class_rank(df, label, seed, key)
    return r.withColumn("fold", ((F.col("class_rank") - 1) % k).cast("int")) \
            .drop("_u", "class_rank", "class_n")


def pools(labelled: DataFrame, unlabelled: DataFrame,
          names: Sequence[str] = ("train_holdout", "test")) -> DataFrame:
    """One table of both replay pools with a ``data_source`` column."""
    a = labelled.withColumn("data_source", F.lit(names[0]))
    b = unlabelled.withColumn("data_source", F.lit(names[1]))
    return a.unionByName(b, allowMissingColumns=True)
