"""Oracle SQL for evaluation metrics, drift statistics and perturbation."""

from tidemark.plans.sql.common import SCORED, u_sql
from tidemark.plans.sql.monitoring import CATEGORICAL_JS, NUMERIC_W1

LAB = "lab AS (SELECT * FROM cur WHERE y IS NOT NULL)"

CONF = (f"WITH {SCORED}, {LAB} SELECT data_source, batch_id, "
        "CAST(sum(CASE WHEN y = 1 AND p >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tp, "
        "CAST(sum(CASE WHEN y = 0 AND p >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
        "CAST(sum(CASE WHEN y = 1 AND p < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
        "CAST(sum(CASE WHEN y = 0 AND p < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tn "
        "FROM lab GROUP BY data_source, batch_id")


def ratio_sql(name, num, den):
    return (f"WITH {SCORED}, {LAB}, c AS ({CONF.split(LAB + ' ', 1)[1]}) "
            f"SELECT data_source, batch_id, CASE WHEN ({den}) > 0 THEN ({num}) * 1.0 / ({den}) ELSE 0.0 END AS {name} FROM c")


ACCURACY = (f"WITH {SCORED}, {LAB} SELECT data_source, batch_id, "
            "avg(CAST(y = CAST(p >= 0.5 AS INTEGER) AS DOUBLE)) AS accuracy FROM lab GROUP BY data_source, batch_id")
PRECISION = ratio_sql("precision", "tp", "tp + fp")
RECALL = ratio_sql("recall", "tp", "tp + fn")
F1 = ratio_sql("f1", "2 * tp", "2 * tp + fp + fn")
LOG_LOSS = (f"WITH {SCORED}, {LAB} SELECT data_source, batch_id, "
            "avg(-(y * ln(least(greatest(p, 1e-6), 1 - 1e-6)) + (1 - y) * ln(1 - least(greatest(p, 1e-6), 1 - 1e-6)))) "
            "AS log_loss FROM lab GROUP BY data_source, batch_id")
ROC_AUC = f"""WITH {SCORED}, {LAB},
ranked AS (SELECT data_source, batch_id, y,
                  rank() OVER (PARTITION BY data_source, batch_id ORDER BY p)
                  + (count(*) OVER (PARTITION BY data_source, batch_id, p) - 1) / 2.0 AS r FROM lab)
SELECT data_source, batch_id,
       CASE WHEN sum(y) > 0 AND sum(1 - y) > 0 THEN
         (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * 1.0 * sum(1 - y)) END AS roc_auc
FROM ranked GROUP BY data_source, batch_id"""
ROC_POINTS = f"""WITH {SCORED}, {LAB},
cnt AS (SELECT data_source, batch_id, p AS threshold, sum(y) AS pos, sum(1 - y) AS neg FROM lab GROUP BY ALL),
c2 AS (SELECT *, sum(pos) OVER (PARTITION BY data_source, batch_id ORDER BY threshold DESC) AS pos_ge,
              sum(neg) OVER (PARTITION BY data_source, batch_id ORDER BY threshold DESC) AS neg_ge,
              sum(pos) OVER (PARTITION BY data_source, batch_id) AS P,
              sum(neg) OVER (PARTITION BY data_source, batch_id) AS N FROM cnt)
SELECT data_source, batch_id, threshold,
       CASE WHEN P > 0 THEN pos_ge * 1.0 / P ELSE 0.0 END AS tpr,
       CASE WHEN N > 0 THEN neg_ge * 1.0 / N ELSE 0.0 END AS fpr FROM c2"""
CALIBRATION = (f"WITH {SCORED}, {LAB} SELECT data_source, batch_id, 'mean_predicted' AS metric, avg(p) AS value "
               "FROM lab GROUP BY ALL UNION ALL SELECT data_source, batch_id, 'churn_rate', avg(CAST(y AS DOUBLE)) "
               "FROM lab GROUP BY ALL")

# Fold metrics of two scoring families over stratified folds of the labelled rows.
FOLDS = f"""lab AS (SELECT * FROM scored WHERE y IS NOT NULL),
rk AS (SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY {u_sql(42, 'id')}, id) - 1) % 5 AS INTEGER) AS fold FROM lab),
fam AS (SELECT 'a' AS family, fold, y, p FROM rk
        UNION ALL SELECT 'b', fold, y, round(1 / (1 + exp(-(value - 40) / 60)), 6) FROM rk),
ranked AS (SELECT family, fold, y, p,
                  rank() OVER (PARTITION BY family, fold ORDER BY p)
                  + (count(*) OVER (PARTITION BY family, fold, p) - 1) / 2.0 AS r FROM fam),
fm AS (SELECT family, fold, 'auc' AS metric,
              (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * 1.0 * sum(1 - y)) AS value
       FROM ranked GROUP BY family, fold
       UNION ALL SELECT family, fold, 'accuracy', avg(CAST(y = CAST(p >= 0.5 AS INTEGER) AS DOUBLE)) FROM fam GROUP BY ALL
       UNION ALL SELECT family, fold, 'log_loss',
              avg(-(y * ln(least(greatest(p, 1e-6), 1 - 1e-6)) + (1 - y) * ln(1 - least(greatest(p, 1e-6), 1 - 1e-6))))
              FROM fam GROUP BY ALL)"""
FOLD_METRICS = f"WITH {SCORED}, {FOLDS} SELECT family, fold, metric, value FROM fm"
CV_SUMMARY = f"WITH {SCORED}, {FOLDS} SELECT family, metric, avg(value) AS mean, stddev_pop(value) AS std FROM fm GROUP BY ALL"
ENSEMBLE_AUC = (f"WITH {SCORED}, {FOLDS} SELECT avg(m) AS ensemble_auc FROM "
                "(SELECT family, avg(value) AS m FROM fm WHERE metric = 'auc' GROUP BY family)")
FOLD_WIDE = (f"WITH {SCORED}, {FOLDS} SELECT fold, "
             "max(CASE WHEN family = 'a' AND metric = 'auc' THEN value END) AS a_auc, "
             "max(CASE WHEN family = 'b' AND metric = 'auc' THEN value END) AS b_auc, "
             "max(CASE WHEN family = 'a' AND metric = 'accuracy' THEN value END) AS a_accuracy, "
             "max(CASE WHEN family = 'b' AND metric = 'accuracy' THEN value END) AS b_accuracy, "
             "max(CASE WHEN family = 'a' AND metric = 'log_loss' THEN value END) AS a_log_loss, "
             "max(CASE WHEN family = 'b' AND metric = 'log_loss' THEN value END) AS b_log_loss, "
             "max(CASE WHEN family = 'a' AND metric = 'f1' THEN value END) AS a_f1, "
             "max(CASE WHEN family = 'b' AND metric = 'f1' THEN value END) AS b_f1 "
             "FROM (SELECT family, fold, metric, value FROM fm UNION ALL SELECT family, fold, 'f1', "
             "coalesce(2.0 * sum(CAST(y = 1 AND p >= 0.5 AS INTEGER)) / nullif(sum(CAST(p >= 0.5 AS INTEGER)) + sum(y), 0), 0.0) "
             "FROM fam GROUP BY family, fold) GROUP BY fold")

# Drift statistics.
REF_PROFILE = (f"WITH {SCORED}, rnum AS (SELECT 'value' AS col, value AS v FROM ref UNION ALL SELECT 'p', p FROM ref) "
               "SELECT col AS column, count(*) AS ref_n, avg(v) AS ref_mean, "
               "CAST(min(v) AS DOUBLE) AS ref_min, CAST(max(v) AS DOUBLE) AS ref_max, "
               "CASE WHEN stddev_pop(v) > 0 THEN stddev_pop(v) ELSE 1.0 END AS ref_std FROM rnum GROUP BY col")
REF_SHARES = (f"WITH {SCORED}, rcat AS (SELECT 'event_type' AS col, event_type AS v FROM ref "
              "UNION ALL SELECT 'y', CAST(y AS VARCHAR) FROM ref WHERE y IS NOT NULL) "
              "SELECT col AS column, v AS value, count(*) AS ref_count, sum(count(*)) OVER (PARTITION BY col) AS ref_total, "
              "count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY col) AS q FROM rcat GROUP BY col, v")
W1 = (f"WITH {SCORED}, {NUMERIC_W1} SELECT data_source, batch_id, col AS column, wasserstein, drift_score, "
      "drift_score >= 0.1 AS drifted FROM ndrift")
KS = f"WITH {SCORED}, {NUMERIC_W1} SELECT data_source, batch_id, col AS column, max(abs(Fr - Fc)) AS ks FROM zc GROUP BY ALL"
JS = (f"WITH {SCORED}, {CATEGORICAL_JS} SELECT data_source, batch_id, col AS column, drift_score AS jensen_shannon, "
      "drift_score >= 0.1 AS drifted FROM jsd")
CHI2 = f"""WITH {SCORED}, {CATEGORICAL_JS},
cc AS (SELECT data_source, batch_id, col, v, count(*) AS o, sum(count(*)) OVER (PARTITION BY data_source, batch_id, col) AS n
       FROM ccat GROUP BY data_source, batch_id, col, v),
g AS (SELECT DISTINCT data_source, batch_id, col, n FROM cc),
ex AS (SELECT g.data_source, g.batch_id, g.col, rs.v, g.n * rs.q AS e FROM g JOIN rs ON rs.col = g.col)
SELECT ex.data_source, ex.batch_id, ex.col AS column,
       sum((coalesce(cc.o, 0) - ex.e) * (coalesce(cc.o, 0) - ex.e) / ex.e) AS chi2,
       CAST(count(*) - 1 AS BIGINT) AS chi2_df
FROM ex LEFT JOIN cc ON cc.data_source = ex.data_source AND cc.batch_id = ex.batch_id AND cc.col = ex.col AND cc.v = ex.v
GROUP BY ex.data_source, ex.batch_id, ex.col"""
PSI = f"""WITH {SCORED},
rnum AS (SELECT 'value' AS col, value AS v FROM ref UNION ALL SELECT 'p', p FROM ref),
cnum AS (SELECT data_source, batch_id, 'value' AS col, value AS v FROM cur UNION ALL SELECT data_source, batch_id, 'p', p FROM cur),
rst AS (SELECT col, min(v) AS lo, max(v) AS hi FROM rnum GROUP BY col),
rb AS (SELECT r.col, CAST(least(greatest(floor((v - lo) / (greatest(hi - lo, 1e-12) / 10)), 0), 9) AS INTEGER) AS bin,
              count(*) AS n FROM rnum r JOIN rst ON rst.col = r.col GROUP BY ALL),
rt AS (SELECT col, sum(n) AS tot FROM rb GROUP BY col),
cb AS (SELECT data_source, batch_id, c.col, CAST(least(greatest(floor((v - lo) / (greatest(hi - lo, 1e-12) / 10)), 0), 9) AS INTEGER) AS bin,
              count(*) AS n FROM cnum c JOIN rst ON rst.col = c.col GROUP BY ALL),
ct AS (SELECT data_source, batch_id, col, sum(n) AS tot FROM cb GROUP BY ALL),
grid AS (SELECT ct.*, CAST(range AS INTEGER) AS bin FROM ct, range(0, 10))
SELECT grid.data_source, grid.batch_id, grid.col AS column,
       sum((greatest(coalesce(cb.n, 0) * 1.0 / grid.tot, 1e-4) - greatest(coalesce(rb.n, 0) * 1.0 / rt.tot, 1e-4))
           * ln(greatest(coalesce(cb.n, 0) * 1.0 / grid.tot, 1e-4) / greatest(coalesce(rb.n, 0) * 1.0 / rt.tot, 1e-4))) AS psi
FROM grid LEFT JOIN cb ON cb.data_source = grid.data_source AND cb.batch_id = grid.batch_id AND cb.col = grid.col AND cb.bin = grid.bin
LEFT JOIN rb ON rb.col = grid.col AND rb.bin = grid.bin JOIN rt ON rt.col = grid.col
GROUP BY ALL"""
DATASET_DRIFT = f"""WITH {SCORED}, {NUMERIC_W1}, {CATEGORICAL_JS},
alld AS (SELECT data_source, batch_id, col, drift_score FROM ndrift UNION ALL SELECT data_source, batch_id, col, drift_score FROM jsd),
lab AS (SELECT data_source, batch_id, count(y) AS n_lab FROM cur GROUP BY ALL)
SELECT a.data_source, a.batch_id, CAST(sum(CASE WHEN drift_score >= 0.1 THEN 1 ELSE 0 END) AS INTEGER) AS num_drifted_columns,
       sum(CASE WHEN drift_score >= 0.1 THEN 1 ELSE 0 END) * 1.0 / (3 + CASE WHEN max(l.n_lab) > 0 THEN 1 ELSE 0 END) AS share_drifted_columns
FROM alld a JOIN lab l ON l.data_source = a.data_source AND l.batch_id = a.batch_id GROUP BY a.data_source, a.batch_id"""
PRED_DRIFT = (f"WITH {SCORED}, {NUMERIC_W1} SELECT data_source, batch_id, drift_score AS prediction_drift "
              "FROM ndrift WHERE col = 'p'")
MEAN_SCORE = f"WITH {SCORED} SELECT data_source, batch_id, avg(p) AS mean_predicted_churn_prob FROM cur GROUP BY ALL"


def _chi2_p(x: str, df: str) -> str:
    y, z = f"({x} / 2)", f"sqrt({x} / 2)"
    erf = f"(2 / sqrt(pi()) * list_sum([exp(i * ln(2) + (2 * i + 1) * ln({z}) - {y} - lgamma(i + 1.5) - (i + 1) * ln(2) + ln(pi()) / 2) for i in range(0, 200 + 3 * {y}::BIGINT)]))"
    even = f"list_sum([exp(i * ln({y}) - {y} - lgamma(i + 1)) for i in range(0, {df} // 2)])"
    odd = f"greatest(1 - {erf}, 0) + coalesce(list_sum([exp((i - 0.5) * ln({y}) - {y} - lgamma(i + 0.5)) for i in range(1, ({df} - 1) // 2 + 1)]), 0)"
    return f"CASE WHEN {df} <= 0 THEN 'NaN'::DOUBLE WHEN {x} <= 0 THEN 1.0 WHEN {df} % 2 = 0 THEN {even} ELSE {odd} END"


_BOTH = """
cc AS (SELECT data_source, batch_id, col, v, count(*) AS c FROM ccat GROUP BY ALL),
rc AS (SELECT col, v, count(*) AS r FROM rcat GROUP BY ALL),
two AS (SELECT data_source, batch_id, col, v, max(c) AS c, max(r) AS r
        FROM (SELECT data_source, batch_id, col, v, c, 0 AS r FROM cc
              UNION ALL SELECT g.data_source, g.batch_id, rc.col, rc.v, 0, rc.r FROM (SELECT DISTINCT data_source, batch_id, col FROM cc) g JOIN rc ON rc.col = g.col) GROUP BY ALL),
tot AS (SELECT *, sum(c) OVER w AS n, sum(r) OVER w AS m FROM two WINDOW w AS (PARTITION BY data_source, batch_id, col)),
homog AS (SELECT data_source, batch_id, col,
                 sum(pow(c - n * (c + r) / (n + m), 2) / (n * (c + r) / (n + m)) + pow(r - m * (c + r) / (n + m), 2) / (m * (c + r) / (n + m))) AS homogeneity,
                 count(*) - 1 AS homogeneity_df FROM tot GROUP BY ALL)"""
HOMOGENEITY = f'WITH {SCORED}, {CATEGORICAL_JS}, {_BOTH} SELECT data_source, batch_id, col AS "column", homogeneity, homogeneity_df FROM homog'

_KS_P = """CASE WHEN lam < 0.1 THEN 1.0 ELSE least(greatest(list_sum([(CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END) * exp(-2.0 * k * k * lam * lam) for k in range(1, 101)]), 0), 1) END"""
PVALUES = f"""WITH {SCORED}, {NUMERIC_W1}, {CATEGORICAL_JS}, {_BOTH},
ks AS (SELECT data_source, batch_id, col, max(abs(Fr - Fc)) AS d FROM zc GROUP BY ALL),
sizes AS (SELECT c.*, r.m FROM (SELECT data_source, batch_id, col, count(*) AS n FROM cnum GROUP BY ALL) c JOIN (SELECT col, count(*) AS m FROM rnum WHERE v IS NOT NULL GROUP BY col) r USING (col)),
lam AS (SELECT *, (sqrt(n * m / (n + m)::DOUBLE) + 0.12 + 0.11 / sqrt(n * m / (n + m)::DOUBLE)) * d AS lam FROM ks JOIN sizes USING (data_source, batch_id, col)),
fit AS (SELECT data_source, batch_id, col, sum(CASE WHEN r > 0 THEN pow(c - n * r / m, 2) / (n * r / m) ELSE 0 END) AS chi2, count(*) FILTER (r > 0) - 1 AS df FROM tot GROUP BY ALL)
SELECT data_source, batch_id, col AS "column", 'ks' AS test, d AS statistic, round({_KS_P}, 9) AS p_value FROM lam
UNION ALL SELECT data_source, batch_id, col, 'chi2', chi2, round({_chi2_p('chi2', 'df')}, 9) FROM fit
UNION ALL SELECT data_source, batch_id, col, 'homogeneity', homogeneity, round({_chi2_p('homogeneity', 'homogeneity_df')}, 9) FROM homog"""

PSI_DECILES = f"""WITH {SCORED},
rnum AS (SELECT 'value' AS col, value AS v FROM ref WHERE value IS NOT NULL UNION ALL SELECT 'p', p FROM ref WHERE p IS NOT NULL),
cnum AS (SELECT data_source, batch_id, 'value' AS col, value AS v FROM cur WHERE value IS NOT NULL UNION ALL SELECT data_source, batch_id, 'p', p FROM cur WHERE p IS NOT NULL),
rr AS (SELECT col, v, row_number() OVER (PARTITION BY col ORDER BY v) AS rn, count(*) OVER (PARTITION BY col) AS n FROM rnum),
cut AS (SELECT col, list(v ORDER BY i) AS b FROM rr, range(1, 10) AS t(i) WHERE rn = greatest(1, ceil(i / 10.0::DOUBLE * n)::BIGINT) GROUP BY col),
rb AS (SELECT col, bin, count(*) / sum(count(*)) OVER (PARTITION BY col) AS e FROM (SELECT col, len(list_filter(b, lambda x: x <= v)) AS bin FROM rnum JOIN cut USING (col)) GROUP BY col, bin),
cb AS (SELECT data_source, batch_id, col, bin, count(*) / sum(count(*)) OVER (PARTITION BY data_source, batch_id, col) AS a
       FROM (SELECT data_source, batch_id, col, len(list_filter(b, lambda x: x <= v)) AS bin FROM cnum JOIN cut USING (col)) GROUP BY data_source, batch_id, col, bin),
g AS (SELECT DISTINCT data_source, batch_id, col, i AS bin FROM cb, range(0, 10) AS t(i)),
s AS (SELECT g.*, greatest(coalesce(a, 0), 1e-4) AS a, greatest(coalesce(e, 0), 1e-4) AS e FROM g LEFT JOIN cb USING (data_source, batch_id, col, bin) LEFT JOIN rb USING (col, bin))
SELECT data_source, batch_id, col AS "column", sum((a - e) * ln(a / e)) AS psi FROM s GROUP BY ALL"""
