"""Oracle SQL of the grid drift: the same bins over raw values, and the exact statistics that the bounds must hold."""

from tidemark.plans.sql.common import SCORED

POINTS = 256

#: reference side: edges at the quantile ranks i / 256, counts and distances per bin
REFERENCE = f"""
rnum AS (SELECT 'value' AS col, value AS v FROM ref WHERE value IS NOT NULL UNION ALL SELECT 'p', p FROM ref WHERE p IS NOT NULL),
rstat AS (SELECT col, CASE WHEN stddev_pop(v) > 0 THEN stddev_pop(v) ELSE 1.0 END AS ref_std FROM rnum GROUP BY col),
rrank AS (SELECT col, v, row_number() OVER (PARTITION BY col ORDER BY v) AS rn, count(*) OVER (PARTITION BY col) AS n FROM rnum),
edge AS (SELECT col, e, row_number() OVER (PARTITION BY col ORDER BY e) AS k
         FROM (SELECT DISTINCT col, v AS e FROM rrank, range(0, {POINTS + 1}) AS t(i) WHERE rn = greatest(1, (i * n + {POINTS - 1}) // {POINTS}))),
bins AS (SELECT col, k AS bin, e AS lo, lead(e) OVER (PARTITION BY col ORDER BY k) - e AS width FROM edge
         UNION ALL SELECT col, 0, min(e), NULL FROM edge GROUP BY col),
rbin AS (SELECT r.col, coalesce(k, 0) AS bin, r.v FROM rnum r ASOF LEFT JOIN edge ON edge.col = r.col AND r.v >= edge.e),
rcell AS (SELECT b.col, b.bin, b.lo, b.width, count(v) AS n, coalesce(sum(abs(v - lo)), 0) AS d FROM bins b LEFT JOIN rbin USING (col, bin) GROUP BY ALL),
rgrid AS (SELECT col, bin, lo, width, sum(n) OVER (PARTITION BY col ORDER BY bin) / sum(n) OVER (PARTITION BY col) AS r_hi, d / sum(n) OVER (PARTITION BY col) AS dist,
                 coalesce(sum(n) OVER (PARTITION BY col ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(n) OVER (PARTITION BY col) AS r_lo
          FROM rcell)"""


def drift(a: str, b: str, rows: str) -> str:
    """Grid drift of the relation ``rows`` per group (a, b): table gdrift; the exact W1 and KS: table exact."""
    return f"""
{REFERENCE},
cnum AS (SELECT {a} AS ga, {b} AS gb, 'value' AS col, value AS v, CAST(NULL AS INTEGER) AS y FROM {rows} WHERE value IS NOT NULL
         UNION ALL SELECT {a}, {b}, 'p', p, y FROM {rows} WHERE p IS NOT NULL),
cbin AS (SELECT c.ga, c.gb, c.col, coalesce(k, 0) AS bin, c.v, c.y FROM cnum c ASOF LEFT JOIN edge ON edge.col = c.col AND c.v >= edge.e),
cell AS (SELECT g.ga, g.gb, g.col, r.bin, r.width, r.r_hi, r.dist, r.r_lo, g.n_all, count(c.v) AS n, coalesce(sum(abs(c.v - r.lo)), 0) / any_value(g.n_all) AS d,
                count(*) FILTER (c.y = 1) AS pos, count(*) FILTER (c.y = 0) AS neg
         FROM (SELECT ga, gb, col, count(*) AS n_all FROM cnum GROUP BY ALL) g JOIN rgrid r ON r.col = g.col
         LEFT JOIN cbin c ON c.ga = g.ga AND c.gb = g.gb AND c.col = g.col AND c.bin = r.bin GROUP BY ALL),
gcell AS (SELECT *, sum(n) OVER (PARTITION BY ga, gb, col ORDER BY bin) / n_all AS c_hi,
                 coalesce(sum(n) OVER (PARTITION BY ga, gb, col ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / n_all AS c_lo,
                 coalesce(sum(neg) OVER (PARTITION BY ga, gb, col ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
          FROM cell),
gap AS (SELECT *, CASE WHEN width IS NULL THEN abs(d - dist) ELSE abs((c_hi - r_hi) * width - (d - dist)) END AS w FROM gcell),
gdrift AS (SELECT ga, gb, col, any_value(n_all) AS cur_n, sum(w) AS wasserstein, max(abs(c_hi - r_hi)) AS ks,
                  sum(CASE WHEN width IS NOT NULL AND c_lo < r_hi AND r_lo < c_hi THEN greatest(greatest(c_hi - r_lo, r_hi - c_lo) * width - w, 0) ELSE 0 END) AS wasserstein_error,
                  greatest(max(greatest(c_hi - r_lo, r_hi - c_lo)) - max(abs(c_hi - r_hi)), 0) AS ks_error,
                  CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(pos * below) / (sum(pos) * sum(neg)) END AS auc_low,
                  CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(pos * below + pos * neg) / (sum(pos) * sum(neg)) END AS auc_high
           FROM gap GROUP BY ga, gb, col),
rcdf AS (SELECT col, v, sum(count(*)) OVER (PARTITION BY col ORDER BY v) / sum(count(*)) OVER (PARTITION BY col) AS f FROM rnum GROUP BY col, v),
ccdf AS (SELECT ga, gb, col, v, sum(count(*)) OVER (PARTITION BY ga, gb, col ORDER BY v) / sum(count(*)) OVER (PARTITION BY ga, gb, col) AS f FROM cnum GROUP BY ga, gb, col, v),
axis AS (SELECT DISTINCT * FROM (SELECT g.ga, g.gb, g.col, r.v FROM (SELECT DISTINCT ga, gb, col FROM ccdf) g JOIN rcdf r ON r.col = g.col
                                 UNION ALL SELECT ga, gb, col, v FROM ccdf)),
step AS (SELECT *, lead(v) OVER (PARTITION BY ga, gb, col ORDER BY v) - v AS dv FROM axis),
with_r AS (SELECT s.*, coalesce(r.f, 0) AS fr FROM step s ASOF LEFT JOIN rcdf r ON s.col = r.col AND s.v >= r.v),
with_c AS (SELECT s.*, coalesce(c.f, 0) AS fc FROM with_r s ASOF LEFT JOIN ccdf c ON s.ga = c.ga AND s.gb = c.gb AND s.col = c.col AND s.v >= c.v),
exact AS (SELECT ga, gb, col, sum(coalesce(abs(fr - fc) * dv, 0)) AS w1, max(abs(fr - fc)) AS ks FROM with_c GROUP BY ALL)"""


GRID_DRIFT = f"""WITH {SCORED}, {drift('data_source', 'batch_id', 'cur')}
SELECT ga AS data_source, gb AS batch_id, col AS "column", wasserstein, wasserstein_error, g.ks, ks_error, wasserstein / ref_std AS drift_score,
       wasserstein / ref_std >= 0.1 AS drifted,
       w1 >= wasserstein - 1e-9 AND w1 <= wasserstein + wasserstein_error + 1e-9 AND e.ks >= g.ks - 1e-9 AND e.ks <= g.ks + ks_error + 1e-9 AS bounds_hold
FROM gdrift g JOIN exact e USING (ga, gb, col) JOIN rstat USING (col)"""


def window_metrics(rows: str) -> str:
    """Metrics per window and source of ``rows`` (with window_start and window_end)."""
    return f"""{drift('window_start', 'data_source', rows)},
ccat AS (SELECT window_start AS ga, data_source AS gb, 'event_type' AS col, event_type AS v FROM {rows} WHERE event_type IS NOT NULL
         UNION ALL SELECT window_start, data_source, 'y', y::VARCHAR FROM {rows} WHERE y IS NOT NULL),
rshare AS (SELECT col, v, count(*) / sum(count(*)) OVER (PARTITION BY col) AS q
           FROM (SELECT 'event_type' AS col, event_type AS v FROM ref WHERE event_type IS NOT NULL UNION ALL SELECT 'y', y::VARCHAR FROM ref WHERE y IS NOT NULL) GROUP BY col, v),
cshare AS (SELECT ga, gb, col, v, count(*) / sum(count(*)) OVER (PARTITION BY ga, gb, col) AS c FROM ccat GROUP BY ga, gb, col, v),
both_ AS (SELECT ga, gb, col, v, max(c) AS c, max(q) AS q
          FROM (SELECT ga, gb, col, v, c, 0 AS q FROM cshare UNION ALL SELECT ga, gb, s.col, s.v, 0, s.q FROM (SELECT DISTINCT ga, gb, col FROM cshare) g JOIN rshare s ON s.col = g.col) GROUP BY ALL),
js AS (SELECT ga, gb, col, sqrt(greatest(sum(CASE WHEN c > 0 THEN 0.5 * c * log2(2 * c / (c + q)) ELSE 0 END + CASE WHEN q > 0 THEN 0.5 * q * log2(2 * q / (c + q)) ELSE 0 END), 0)) AS js
       FROM both_ GROUP BY ALL),
dcount AS (SELECT ga, gb, sum(d) AS nd, max(js) AS max_js
           FROM (SELECT ga, gb, (wasserstein / ref_std >= 0.1)::INT AS d, NULL AS js FROM gdrift JOIN rstat USING (col) UNION ALL SELECT ga, gb, (js >= 0.1)::INT, js FROM js) GROUP BY ALL),
pcol AS (SELECT g.*, wasserstein / ref_std AS score, w1 FROM gdrift g JOIN rstat USING (col) JOIN exact USING (ga, gb, col) WHERE col = 'p'),
qual AS (SELECT window_start AS ga, data_source AS gb, window_end, count(*) AS n, count(y) AS nl, avg(y) AS rate, avg(CASE WHEN y IS NOT NULL THEN (y = (p >= 0.5)::INT)::INT END) AS accuracy,
                avg(CASE WHEN y IS NOT NULL THEN -(y * ln(least(greatest(p, 1e-6), 1 - 1e-6)) + (1 - y) * ln(1 - least(greatest(p, 1e-6), 1 - 1e-6))) END) AS log_loss,
                count(*) FILTER (value IS NULL) + count(*) FILTER (p IS NULL) + count(*) FILTER (event_type IS NULL) + CASE WHEN count(y) > 0 THEN count(*) - count(y) ELSE 0 END AS nulls
         FROM {rows} GROUP BY ALL),
ranked AS (SELECT window_start AS ga, data_source AS gb, y, rank() OVER (PARTITION BY window_start, data_source ORDER BY p)
                  + (count(*) OVER (PARTITION BY window_start, data_source, p) - 1) / 2.0 AS r FROM {rows} WHERE y IS NOT NULL),
auc AS (SELECT ga, gb, CASE WHEN sum(y) * sum(1 - y) > 0 THEN (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) END AS auc FROM ranked GROUP BY ALL)
SELECT q.ga AS window_start, q.window_end, q.gb AS data_source, q.n, q.nl AS n_labelled, nd::INTEGER AS num_drifted_columns,
       nd / (3 + (nl > 0)::INT) AS share_drifted_columns, p.score AS prediction_drift, p.wasserstein AS prediction_w1, p.wasserstein_error AS prediction_w1_error, max_js,
       q.nulls / (q.n * (3 + (nl > 0)::INT)) AS share_missing_values, q.rate AS churn_rate, q.accuracy, q.log_loss, p.auc_low, p.auc_high,
       w1 >= p.wasserstein - 1e-9 AND w1 <= p.wasserstein + p.wasserstein_error + 1e-9 AND coalesce(auc BETWEEN auc_low - 1e-9 AND auc_high + 1e-9, nl = 0 OR auc_low IS NULL) AS bounds_hold
FROM qual q JOIN pcol p USING (ga, gb) JOIN dcount USING (ga, gb) LEFT JOIN auc USING (ga, gb)"""


_CLOSED = "window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'"
DAYS = f"""WITH {SCORED},
win AS (SELECT * FROM (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end, * FROM scored) WHERE {_CLOSED}),
{window_metrics('win')}"""
SLIDING = f"""WITH {SCORED},
win AS (SELECT * FROM (SELECT s AS window_start, s + INTERVAL '2 days' AS window_end, e.*
                       FROM scored e, (VALUES (0), (1)) AS k(i), LATERAL (SELECT time_bucket(INTERVAL '1 day', ts) - i * INTERVAL '1 day' AS s)) WHERE {_CLOSED}),
{window_metrics('win')}"""
BATCHES = f"""WITH {SCORED},
win AS (SELECT batch_id AS window_start, batch_id AS window_end, * EXCLUDE (batch_id) FROM cur),
metrics AS (SELECT * FROM (WITH {window_metrics('win').lstrip()}))
SELECT window_start AS batch_id, * EXCLUDE (window_start, window_end) FROM metrics"""
