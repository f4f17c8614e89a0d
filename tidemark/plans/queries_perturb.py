"""Queries: what-if perturbation of the current batches and the monitor's
reaction to it (drift intensity ramps up over the global batch number)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.operators import features as FE
from tidemark.operators import perturb as X
from tidemark.operators.materialize import materialize
from tidemark.plans.catalog import register
from tidemark.plans.fixtures import current_batches, reference_slice, scored_events
from tidemark.plans.monitoring import MonitorSpec, batch_metrics
from tidemark.plans.sql.common import SCORED
from tidemark.plans.sql.monitoring import BATCH_METRICS

MODE = "gradual"
BLANK_RATE = 0.2


def with_intensity(cur, mode=MODE):
    g = X.global_batch_number(cur)
    return g.withColumn("intensity", X.intensity("global_batch", mode))


def ref_std(ref, column):
    """Population std of a reference column (0 -> 1), one row."""
    st = D.reference_stats(D.to_long(ref, [], [column]))
    return st.select(F.col("ref_std").alias(f"_std_{column}"))


def perturbed_current(spark, sf, mode=MODE, blank_rate=BLANK_RATE):
    """X2-X5 on the current batches; the score is recomputed from the shifted
    inputs (the model sees the drift); labels stay untouched (X6); cells are
    blanked after scoring."""
    ref = reference_slice(scored_events(spark, sf))
    cur = with_intensity(current_batches(spark, sf), mode)
    cats = FE.fit_categories(ref, ["event_type"])["event_type"]
    cur = cur.crossJoin(F.broadcast(ref_std(ref, "value")))  # one row
    inten = F.col("intensity")
    cur = (cur.withColumn("value", X.shift_numeric("value", F.col("_std_value"), inten))
              .withColumn("event_type", X.swap_category("event_type", cats, inten))
              .withColumn("p", F.round(1 / (1 + F.exp(-(F.col("value") - 50) / 50)), 6)))
    cur = (cur.withColumn("value", X.blank_cells("value", inten, blank_rate))
              .withColumn("event_type", X.blank_cells("event_type", inten, blank_rate)))
    # every metric reads the perturbed batches: compute the hash draws once
    return ref, materialize(cur.drop("_std_value"), "perturbed_batches")


GB_SQL = f"""WITH {SCORED},
b AS (SELECT DISTINCT data_source, batch_id FROM cur),
nb AS (SELECT max(batch_id) + 1 AS n FROM cur WHERE data_source = 'train_holdout'),
g AS (SELECT data_source, batch_id,
             CAST(batch_id + CASE WHEN data_source = 'test' THEN (SELECT n FROM nb) ELSE 0 END AS INTEGER) AS global_batch
      FROM b)"""

INTENSITY_SQL = GB_SQL + """
SELECT data_source, batch_id, global_batch,
       CAST(1.0 AS DOUBLE) AS intensity_sustained,
       least(CAST(1.0 AS DOUBLE), CAST(global_batch + 1 AS DOUBLE) / 5.0) AS intensity_gradual,
       CASE WHEN (global_batch // 3) % 2 = 1 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS intensity_cycle,
       CAST(0.0 AS DOUBLE) AS intensity_none
FROM g"""


@register("intensity", INTENSITY_SQL)
def q_intensity(spark, sf):
    b = current_batches(spark, sf).select("data_source", "batch_id").distinct()
    g = X.global_batch_number(b)
    return g.select("data_source", "batch_id", "global_batch",
                    *[X.intensity("global_batch", m).alias(f"intensity_{m}")
                      for m in ("sustained", "gradual", "cycle", "none")])


def _u(col, tag):
    return (f"(CAST(('0x' || substr(md5('7:{col}:' || CAST(c.id AS VARCHAR) || ':{tag}'), 1, 8)) AS BIGINT)"
            f" / 4294967296.0)")


CUR_I = GB_SQL + """,
ci AS (SELECT c.*, g.global_batch, least(CAST(1.0 AS DOUBLE), CAST(g.global_batch + 1 AS DOUBLE) / 5.0) AS intensity
       FROM cur c JOIN g ON g.data_source = c.data_source AND g.batch_id = c.batch_id),
sd AS (SELECT CASE WHEN stddev_pop(value) > 0 THEN stddev_pop(value) ELSE 1.0 END AS s FROM ref)"""


def _z(col):
    return f"(sqrt(-2 * ln(greatest({_u(col, 'a')}, 1e-12))) * cos(6.283185307179586 * {_u(col, 'b')}))"


SHIFT_EXPR = (f"CASE WHEN c.intensity > 0 THEN greatest(c.value + c.intensity * 1.5 * sd.s + {_z('value')} * 0.5 * sd.s, 0.0) "
              "ELSE c.value END")
SHIFT_SQL = CUR_I + f"\nSELECT c.id, round({SHIFT_EXPR}, 6) AS value_shifted FROM ci c, sd"


@register("shift_numeric", SHIFT_SQL)
def q_shift(spark, sf):
    ref = reference_slice(scored_events(spark, sf))
    cur = with_intensity(current_batches(spark, sf)).crossJoin(F.broadcast(ref_std(ref, "value")))
    return cur.select("id", F.round(X.shift_numeric("value", F.col("_std_value"), F.col("intensity")), 6)
                      .alias("value_shifted"))


FLIP_SQL = CUR_I + f"""
SELECT c.id, CASE WHEN c.intensity > 0 AND {_u('weekend', 'flip')} < least(0.5, c.intensity * 0.4)
                  THEN 1 - CAST(dayofweek(c.ts) IN (0, 6) AS INTEGER)
                  ELSE CAST(dayofweek(c.ts) IN (0, 6) AS INTEGER) END AS weekend
FROM ci c"""


@register("flip_binary", FLIP_SQL)
def q_flip(spark, sf):
    cur = with_intensity(current_batches(spark, sf))
    cur = cur.withColumn("weekend", F.dayofweek("ts").isin(1, 7).cast("int"))
    return cur.select("id", X.flip_binary("weekend", F.col("intensity")).alias("weekend"))


SWAP_SQL = CUR_I + f""",
cats AS (SELECT list_sort(list(DISTINCT event_type)) AS l FROM ref)
SELECT c.id, CASE WHEN c.intensity > 0 AND {_u('event_type', 'swap')} < least(1.0, c.intensity * 0.4)
                  THEN l[CAST(floor({_u('event_type', 'pick')} * len(l)) + 1 AS INTEGER)]
                  ELSE c.event_type END AS event_type
FROM ci c, cats"""


@register("swap_category", SWAP_SQL)
def q_swap(spark, sf):
    ref = reference_slice(scored_events(spark, sf))
    cats = FE.fit_categories(ref, ["event_type"])["event_type"]
    cur = with_intensity(current_batches(spark, sf))
    return cur.select("id", X.swap_category("event_type", cats, F.col("intensity")).alias("event_type"))


BLANK_SQL = CUR_I + f"""
SELECT c.id, CASE WHEN c.intensity * 0.2 > 0 AND {_u('value', 'blank')} < c.intensity * 0.2 THEN NULL ELSE c.value END AS value
FROM ci c"""


@register("blank_cells", BLANK_SQL)
def q_blank(spark, sf):
    cur = with_intensity(current_batches(spark, sf))
    return cur.select("id", X.blank_cells("value", F.col("intensity"), BLANK_RATE).alias("value"))


def _perturbed_metrics_sql():
    scored = SCORED.replace("cur AS (SELECT *,", "cur0 AS (SELECT *,")
    gb = GB_SQL.replace(f"WITH {SCORED}", "").replace("FROM cur", "FROM cur0")
    pert = f"""{scored},
{gb.strip().lstrip(',')},
ci AS (SELECT c.*, least(CAST(1.0 AS DOUBLE), CAST(g.global_batch + 1 AS DOUBLE) / 5.0) AS intensity
       FROM cur0 c JOIN g ON g.data_source = c.data_source AND g.batch_id = c.batch_id),
sd AS (SELECT CASE WHEN stddev_pop(value) > 0 THEN stddev_pop(value) ELSE 1.0 END AS s FROM ref),
cats AS (SELECT list_sort(list(DISTINCT event_type)) AS l FROM ref),
sh AS (SELECT c.id, c.ts, c.user_id, c.data_source, c.y, c.batch_id, c.intensity,
              {SHIFT_EXPR} AS value,
              CASE WHEN c.intensity > 0 AND {_u('event_type', 'swap')} < least(1.0, c.intensity * 0.4)
                   THEN l[CAST(floor({_u('event_type', 'pick')} * len(l)) + 1 AS INTEGER)]
                   ELSE c.event_type END AS event_type
       FROM ci c, sd, cats),
cur AS (SELECT c.id, c.ts, c.user_id, c.data_source, c.y, c.batch_id, c.intensity,
               round(1 / (1 + exp(-(c.value - 50) / 50)), 6) AS p,
               CASE WHEN c.intensity * 0.2 > 0 AND {_u('value', 'blank')} < c.intensity * 0.2 THEN NULL ELSE c.value END AS value,
               CASE WHEN c.intensity * 0.2 > 0 AND {_u('event_type', 'blank')} < c.intensity * 0.2 THEN NULL ELSE c.event_type END AS event_type
        FROM sh c)"""
    body = BATCH_METRICS.replace(f"WITH {SCORED},", f"WITH {pert},", 1)
    body = body.replace("0.0::DOUBLE AS drift_intensity", "b.drift_intensity")
    body = body.replace("avg(p) AS mean_predicted_churn_prob\n", "avg(p) AS mean_predicted_churn_prob, max(intensity) AS drift_intensity\n")
    return body


@register("perturbed_metrics", _perturbed_metrics_sql())
def q_perturbed_metrics(spark, sf):
    ref, cur = perturbed_current(spark, sf)
    spec = MonitorSpec(numeric=("value",), categorical=("event_type",), intensity="intensity", bounded=True)
    return batch_metrics(ref, cur, spec)


MISSING_SQL = _perturbed_metrics_sql().split("\nSELECT b.data_source")[0] + """
SELECT data_source, batch_id,
       sum(CAST(value IS NULL AS BIGINT) + CAST(event_type IS NULL AS BIGINT) + CAST(p IS NULL AS BIGINT))
         * 1.0 / (count(*) * 3) AS share_missing_values
FROM cur GROUP BY data_source, batch_id"""


@register("missing_share", MISSING_SQL)
def q_missing_share(spark, sf):
    """Null cells / (rows x columns) of the feature + prediction projection of
    the perturbed batches (cells blanked after scoring)."""
    _, cur = perturbed_current(spark, sf)
    return D.missing_share(cur, ["data_source", "batch_id"], ["value", "event_type", "p"])


SHIFT_HOUR = (f"CASE WHEN c.intensity > 0 THEN CAST(round(greatest(c.hour + c.intensity * 1.5 * sh.s "
              f"+ {_z('hour')} * 0.5 * sh.s, 0.0)) AS INTEGER) ELSE c.hour END")
SHIFT_INT_SQL = CUR_I.replace("SELECT c.*, g.global_batch", "SELECT c.*, CAST(hour(c.ts) AS INTEGER) AS hour, g.global_batch") \
    + """,
sh AS (SELECT CASE WHEN stddev_pop(hour(ts)) > 0 THEN stddev_pop(hour(ts)) ELSE 1.0 END AS s FROM ref)""" \
    + f"\nSELECT c.id, {SHIFT_HOUR} AS hour_shifted FROM ci c, sh"


@register("shift_integral", SHIFT_INT_SQL)
def q_shift_integral(spark, sf):
    """X2 on an integer column (hour of the event): shifted, clipped at 0,
    rounded back to an integer."""
    ref = reference_slice(scored_events(spark, sf)).withColumn("hour", F.hour("ts"))
    cur = with_intensity(current_batches(spark, sf)).withColumn("hour", F.hour("ts"))
    cur = cur.crossJoin(F.broadcast(ref_std(ref, "hour")))  # one row
    return cur.select("id", X.shift_numeric("hour", F.col("_std_hour"), F.col("intensity"), integral=True)
                      .alias("hour_shifted"))
