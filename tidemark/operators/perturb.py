"""What-if perturbation: shift a table by a known amount, per batch.

Pure column expressions driven by the hash draw ``u(seed, column, id, tag)``,
so the same row always gets the same noise (retries and re-reads agree).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import gaussian_from_uniforms, hash_uniform, lenient_double

# The reference's drift knobs and their defaults.
MODES = ("none", "sustained", "gradual", "cycle")
DEFAULT_START = 0
DEFAULT_RAMP = 5
DEFAULT_PERIOD = 6
NUMERIC_SHIFT_STD = 1.5
NOISE_STD = 0.5
FLIP_PER_INTENSITY = 0.4
FLIP_MAX = 0.5
CATEGORICAL_SWAP_PROB = 0.4
DRIFT_SEED = 7


def intensity(global_batch: Column | str, mode: str, start: int = DEFAULT_START,
              ramp: int = DEFAULT_RAMP, period: int = DEFAULT_PERIOD) -> Column:
    """Drift intensity for a global batch number (0 before ``start``)."""
    gb = F.col(global_batch) if isinstance(global_batch, str) else global_batch
    off = gb - F.lit(start)
    ramp = max(1, ramp)
    half = max(1, max(2, period) // 2)
    if mode == "sustained":
        val = F.lit(1.0)
    elif mode == "gradual":
        val = F.least(F.lit(1.0), (off + 1).cast("double") / F.lit(float(ramp)))
    elif mode == "cycle":
        val = F.when(F.floor(off / F.lit(half)) % 2 == 1, F.lit(1.0)).otherwise(F.lit(0.0))
    else:
        return F.lit(0.0)
    return F.when(gb < F.lit(start), F.lit(0.0)).otherwise(val)


def global_batch_number(df: DataFrame, order: Sequence[str] = ("train_holdout", "test"),
                        source: str = "data_source", batch: str = "batch_id") -> DataFrame:
    """Batch number running across pools, labelled pool first.

    The offsets are the batch counts of the earlier pools: one tiny aggregate
    (one row per pool) joined back by pool name.
    """
    counts = df.groupBy(source).agg((F.max(batch) + 1).alias("_nb"))
    rank = F.lit(len(order))
    for i, name in reversed(list(enumerate(order))):
        rank = F.when(F.col(source) == name, F.lit(i)).otherwise(rank)
    counts = counts.withColumn("_pos", rank)
    from pyspark.sql import Window
    w = Window.orderBy("_pos", source).rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(source, F.coalesce(F.sum("_nb").over(w), F.lit(0)).alias("_off"))  # one row per pool
    return df.join(F.broadcast(offs), source).withColumn(
        "global_batch", (F.col("_off") + F.col(batch)).cast("int")).drop("_off")


def shift_numeric(col: str, std: Column | float, inten: Column, key: str = "id", seed=DRIFT_SEED,
                  integral: bool = False) -> Column:
    """``lenient(x) + N(inten*1.5*std, 0.5*std)``, clipped at 0; rounded if integral.
    Intensity 0 leaves the value unchanged."""
    s = F.lit(std) if isinstance(std, (int, float)) else std
    z = gaussian_from_uniforms(hash_uniform(seed, F.lit(col), key, F.lit("a")),
                               hash_uniform(seed, F.lit(col), key, F.lit("b")))
    x = lenient_double(col)
    new = F.greatest(x + inten * NUMERIC_SHIFT_STD * s + z * NOISE_STD * s, F.lit(0.0))
    if integral:
        new = F.round(new).cast("int")
    return F.when(inten > 0, new).otherwise(F.col(col))


def flip_binary(col: str, inten: Column, key: str = "id", seed=DRIFT_SEED) -> Column:
    """Flip a 0/1 column with probability ``min(0.5, 0.4*intensity)``."""
    p = F.least(F.lit(FLIP_MAX), inten * FLIP_PER_INTENSITY)
    u = hash_uniform(seed, F.lit(col), key, F.lit("flip"))
    return F.when((inten > 0) & (u < p), 1 - F.col(col)).otherwise(F.col(col))


def swap_category(col: str, choices: Sequence[str], inten: Column, key: str = "id",
                  seed=DRIFT_SEED, swap_prob: float = CATEGORICAL_SWAP_PROB) -> Column:
    """With probability ``min(1, swap_prob*intensity)`` replace by a uniform draw
    of the observed categories (the draw may return the same value)."""
    if not choices:
        return F.col(col)
    p = F.least(F.lit(1.0), inten * swap_prob)
    u1 = hash_uniform(seed, F.lit(col), key, F.lit("swap"))
    u2 = hash_uniform(seed, F.lit(col), key, F.lit("pick"))
    arr = F.array(*[F.lit(c) for c in choices])
    pick = F.element_at(arr, (F.floor(u2 * len(choices)) + 1).cast("int"))
    return F.when((inten > 0) & (u1 < p), pick).otherwise(F.col(col))


def blank_cells(col: str, inten: Column, rate: float, key: str = "id", seed=DRIFT_SEED) -> Column:
    """Null with probability ``intensity*rate`` (applied after scoring)."""
    u = hash_uniform(seed, F.lit(col), key, F.lit("blank"))
    return F.when((inten * rate > 0) & (u < inten * rate), F.lit(None)).otherwise(F.col(col))
