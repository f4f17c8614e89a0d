"""Oracle SQL for drift and per-batch metrics (naive, per-group definitions)."""

from tidemark.plans.sql.common import SCORED

# Numeric W1 by the textbook definition: merge reference and group points,
# integrate |F_ref - F_cur| between consecutive points.
NUMERIC_W1 = """
rnum AS (SELECT 'value' AS col, value AS v FROM ref UNION ALL SELECT 'p', p FROM ref),
cnum AS (SELECT * FROM (SELECT data_source, batch_id, 'value' AS col, value AS v FROM cur
         UNION ALL SELECT data_source, batch_id, 'p', p FROM cur) WHERE v IS NOT NULL),
rstat AS (SELECT col, avg(v) AS ref_mean,
                 CASE WHEN stddev_pop(v) > 0 THEN stddev_pop(v) ELSE 1.0 END AS ref_std FROM rnum GROUP BY col),
rcdf AS (SELECT col, v, sum(count(*)) OVER (PARTITION BY col ORDER BY v) * 1.0
                        / sum(count(*)) OVER (PARTITION BY col) AS F FROM rnum GROUP BY col, v),
ccdf AS (SELECT data_source, batch_id, col, v,
                sum(count(*)) OVER (PARTITION BY data_source, batch_id, col ORDER BY v) * 1.0
                / sum(count(*)) OVER (PARTITION BY data_source, batch_id, col) AS F
         FROM cnum GROUP BY data_source, batch_id, col, v),
grp AS (SELECT DISTINCT data_source, batch_id, col FROM ccdf),
z AS (SELECT DISTINCT * FROM (
        SELECT g.data_source, g.batch_id, g.col, r.v FROM grp g JOIN rcdf r ON r.col = g.col
        UNION ALL SELECT data_source, batch_id, col, v FROM ccdf)),
zz AS (SELECT *, lead(v) OVER (PARTITION BY data_source, batch_id, col ORDER BY v) AS v_next FROM z),
zf AS (SELECT zz.*, coalesce(r.F, 0) AS Fr FROM zz ASOF LEFT JOIN rcdf r ON zz.col = r.col AND zz.v >= r.v),
zc AS (SELECT zf.*, coalesce(c.F, 0) AS Fc FROM zf ASOF LEFT JOIN ccdf c
         ON zf.data_source = c.data_source AND zf.batch_id = c.batch_id AND zf.col = c.col AND zf.v >= c.v),
w1 AS (SELECT data_source, batch_id, col,
              sum(CASE WHEN v_next IS NOT NULL THEN abs(Fr - Fc) * (v_next - v) ELSE 0 END) AS wasserstein,
              max(greatest(abs(Fr - Fc), 0)) AS ks0
       FROM zc GROUP BY data_source, batch_id, col),
ndrift AS (SELECT w1.data_source, w1.batch_id, w1.col, w1.wasserstein,
                  w1.wasserstein / s.ref_std AS drift_score
           FROM w1 JOIN rstat s ON s.col = w1.col)"""

CATEGORICAL_JS = """
rcat AS (SELECT 'event_type' AS col, event_type AS v FROM ref
         UNION ALL SELECT 'y', CAST(y AS VARCHAR) FROM ref WHERE y IS NOT NULL),
ccat AS (SELECT data_source, batch_id, 'event_type' AS col, event_type AS v FROM cur WHERE event_type IS NOT NULL
         UNION ALL SELECT data_source, batch_id, 'y', CAST(y AS VARCHAR) FROM cur WHERE y IS NOT NULL),
rs AS (SELECT col, v, count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY col) AS q FROM rcat GROUP BY col, v),
cs AS (SELECT data_source, batch_id, col, v,
              count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY data_source, batch_id, col) AS p
       FROM ccat GROUP BY data_source, batch_id, col, v),
cg AS (SELECT DISTINCT data_source, batch_id, col FROM cs),
allv AS (SELECT cg.data_source, cg.batch_id, cg.col, rs.v FROM cg JOIN rs ON rs.col = cg.col
         UNION SELECT data_source, batch_id, col, v FROM cs),
jsd AS (SELECT a.data_source, a.batch_id, a.col,
               sqrt(greatest(sum(
                 CASE WHEN coalesce(c.p, 0) > 0 THEN 0.5 * c.p * log2(c.p / ((coalesce(c.p, 0) + coalesce(r.q, 0)) / 2)) ELSE 0 END
               + CASE WHEN coalesce(r.q, 0) > 0 THEN 0.5 * r.q * log2(r.q / ((coalesce(c.p, 0) + coalesce(r.q, 0)) / 2)) ELSE 0 END), 0)) AS drift_score
        FROM allv a
        LEFT JOIN cs c ON c.data_source = a.data_source AND c.batch_id = a.batch_id AND c.col = a.col AND c.v = a.v
        LEFT JOIN rs r ON r.col = a.col AND r.v = a.v
        GROUP BY a.data_source, a.batch_id, a.col)"""

QUALITY = """
ranked AS (SELECT data_source, batch_id, y,
                  rank() OVER (PARTITION BY data_source, batch_id ORDER BY p)
                  + (count(*) OVER (PARTITION BY data_source, batch_id, p) - 1) / 2.0 AS r
           FROM cur WHERE y IS NOT NULL),
auc AS (SELECT data_source, batch_id,
               CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN
                 (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * 1.0 * sum(1 - y)) END AS roc_auc
        FROM ranked GROUP BY data_source, batch_id),
qual AS (SELECT data_source, batch_id, count(y) AS n_lab,
                avg(CAST(y AS DOUBLE)) AS churn_rate,
                avg(CASE WHEN y IS NOT NULL THEN CAST(y = CAST(p >= 0.5 AS INTEGER) AS DOUBLE) END) AS accuracy,
                avg(CASE WHEN y IS NOT NULL THEN -(y * ln(least(greatest(p, 1e-6), 1 - 1e-6))
                     + (1 - y) * ln(1 - least(greatest(p, 1e-6), 1 - 1e-6))) END) AS log_loss
         FROM cur GROUP BY data_source, batch_id)"""

BATCH_METRICS = f"""
WITH {SCORED},
{NUMERIC_W1},
{CATEGORICAL_JS},
{QUALITY},
alld AS (SELECT data_source, batch_id, col, drift_score FROM ndrift
         UNION ALL SELECT data_source, batch_id, col, drift_score FROM jsd),
dagg AS (SELECT data_source, batch_id,
                CAST(sum(CASE WHEN drift_score >= 0.1 THEN 1 ELSE 0 END) AS INTEGER) AS num_drifted_columns,
                max(CASE WHEN col = 'p' THEN drift_score END) AS prediction_drift
         FROM alld GROUP BY data_source, batch_id),
basic AS (SELECT data_source, batch_id, max(ts) AS ts, count(*) AS batch_size,
                 sum(CAST(value IS NULL AS BIGINT) + CAST(event_type IS NULL AS BIGINT) + CAST(p IS NULL AS BIGINT)) AS nb,
                 sum(CAST(y IS NULL AS BIGINT)) AS ny, count(y) AS n_lab, avg(p) AS mean_predicted_churn_prob
          FROM cur GROUP BY data_source, batch_id)
SELECT b.data_source, b.batch_id, b.ts, b.batch_size,
       coalesce(d.num_drifted_columns, 0) AS num_drifted_columns,
       coalesce(d.num_drifted_columns, 0) * 1.0 / (3 + CASE WHEN b.n_lab > 0 THEN 1 ELSE 0 END) AS share_drifted_columns,
       d.prediction_drift,
       (b.nb + CASE WHEN b.n_lab > 0 THEN b.ny ELSE 0 END) * 1.0
         / (b.batch_size * (3 + CASE WHEN b.n_lab > 0 THEN 1 ELSE 0 END)) AS share_missing_values,
       b.mean_predicted_churn_prob,
       CASE WHEN b.n_lab > 0 THEN q.churn_rate END AS churn_rate,
       CASE WHEN b.n_lab > 0 THEN q.accuracy END AS accuracy,
       CASE WHEN b.n_lab > 0 THEN a.roc_auc END AS roc_auc,
       CASE WHEN b.n_lab > 0 THEN q.log_loss END AS log_loss,
       0.0::DOUBLE AS drift_intensity
FROM basic b
LEFT JOIN dagg d ON d.data_source = b.data_source AND d.batch_id = b.batch_id
LEFT JOIN qual q ON q.data_source = b.data_source AND q.batch_id = b.batch_id
LEFT JOIN auc a ON a.data_source = b.data_source AND a.batch_id = b.batch_id
"""
