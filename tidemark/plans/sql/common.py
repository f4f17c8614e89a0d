"""Shared SQL fragments: the derived fixtures written for DuckDB."""

SCORED = """
scored AS (
  SELECT event_id AS id, ts, value, user_id, event_type,
         CASE WHEN user_id % 2 = 0 THEN 'train_holdout' ELSE 'test' END AS data_source,
         CAST(CASE WHEN user_id % 2 = 0 THEN CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END END AS INTEGER) AS y,
         round(1 / (1 + exp(-(value - 50) / 50)), 6) AS p
  FROM events),
ref AS (SELECT * FROM scored WHERE ts < TIMESTAMP '2024-01-11 00:00:00'),
cur AS (SELECT *, CAST((row_number() OVER (PARTITION BY data_source ORDER BY id) - 1) // 1000 AS INTEGER) AS batch_id
        FROM scored WHERE ts >= TIMESTAMP '2024-01-11 00:00:00')"""

MART = """
hist AS (
  SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total_spend,
         CAST(datediff('day', min(o_orderdate), TIMESTAMP '2001-02-01 00:00:00') AS INTEGER) AS tenure_days,
         max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS has_urgent,
         max(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS has_low,
         max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS has_pending
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-02-01 00:00:00' GROUP BY o_custkey),
later AS (SELECT DISTINCT o_custkey AS later_key FROM orders WHERE o_orderdate >= TIMESTAMP '2001-02-01 00:00:00'),
mart AS (
  SELECT c_custkey AS id, c_mktsegment, c_acctbal, h.*,
         CASE WHEN l.later_key IS NULL THEN 'Yes' ELSE 'No' END AS churn
  FROM customer JOIN hist h ON h.o_custkey = c_custkey
  LEFT JOIN later l ON l.later_key = c_custkey),
records AS (
  SELECT id, c_mktsegment, c_acctbal, n_orders, total_spend, tenure_days,
         CASE WHEN has_urgent = 1 THEN 'Yes' ELSE 'No' END AS urgent,
         CASE WHEN has_low = 1 THEN 'Yes' ELSE 'No' END AS low,
         CASE WHEN has_pending = 1 THEN 'Yes' ELSE 'No' END AS pending,
         churn
  FROM mart)"""


def u_sql(seed, key: str) -> str:
    """The hash draw u(seed, key) in DuckDB."""
    return (f"(CAST(('0x' || substr(md5('{seed}' || ':' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"
            f" / 4294967296.0)")
