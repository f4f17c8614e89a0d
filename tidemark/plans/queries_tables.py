"""Queries over the churn mart / records and the scored events:
projections and encodings, validation, profiling, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import (clip, count_equal, decide, dict_map, lenient_double,
                                        round_score, smoothed_ratio, to_int)
from tidemark.operators import features as FE
from tidemark.operators import profile as PR
from tidemark.operators import split as SP
from tidemark.operators import validate as V
from tidemark.plans.catalog import register
from tidemark.plans.fixtures import churn_mart, churn_records, scored_events, with_batches
from tidemark.plans.sql.common import MART, SCORED, u_sql
from tidemark.sources.tables import read_table

W_MART = f"WITH {MART}\n"
W_SCORED = f"WITH {SCORED}\n"
REC_COLS = ["id", "c_mktsegment", "c_acctbal", "n_orders", "total_spend", "tenure_days",
            "urgent", "low", "pending", "churn"]
NUMERIC_REC = ["c_acctbal", "n_orders", "total_spend", "tenure_days"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _dq(c):
    return '"' + c + '"'


# ---------------------------------------------------------------- projections

@register("drop_cols", W_MART + "SELECT id, c_mktsegment, n_orders, total_spend, tenure_days, urgent, low, "
          "pending, churn FROM records")
def q_drop_cols(spark, sf):
    return FE.drop_columns(churn_records(spark, sf), ["c_acctbal", "gender"])


@register("model_inputs", W_MART + "SELECT c_mktsegment, c_acctbal, n_orders, total_spend, tenure_days, "
          "urgent, low, pending FROM records")
def q_model_inputs(spark, sf):
    return FE.model_inputs(churn_records(spark, sf), exclude=("id", "gender", "churn"))


TYPED_SQL = f"WITH {MART} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{'numeric' if c in ('id', *NUMERIC_REC) else 'string'}' AS kind, "
    f"count(DISTINCT \"{c}\") AS n_distinct FROM records" for c in REC_COLS)


@register("typed_columns", TYPED_SQL)
def q_typed_columns(spark, sf):
    """Columns of the churn records by Spark type (numeric / string), with the
    number of distinct values of each (one aggregate over the records)."""
    records = churn_records(spark, sf)
    num, _ = FE.typed_columns(records)
    return PR.distinct_counts(records).select(
        "column", F.when(F.col("column").isin(num), "numeric").otherwise("string").alias("kind"), "n_distinct")


RAW_SQL = ("CASE WHEN event_type = 'error' THEN ' ' WHEN event_type = 'view' THEN 'x' || CAST(value AS VARCHAR) "
           "ELSE CAST(value AS VARCHAR) END")


ODD_SQL = ("CASE CAST(event_id % 11 AS INTEGER) WHEN 0 THEN 'NaN' WHEN 1 THEN '1d' WHEN 2 THEN '2.5f' WHEN 3 THEN '' WHEN 4 THEN NULL "
           "WHEN 5 THEN '0x1p3' WHEN 6 THEN ' 12.5 ' WHEN 7 THEN '1e3' WHEN 8 THEN 'nan' WHEN 9 THEN '-' ELSE CAST(value AS VARCHAR) END")


@register("lenient_odd_text", f"SELECT event_id AS id, CASE WHEN event_id % 11 IN (0, 1, 2, 3, 4, 5, 8, 9) THEN 0.0 "
          f"ELSE CAST(trim({ODD_SQL}) AS DOUBLE) END AS parsed FROM events")
def q_lenient_odd(spark, sf):
    """Odd numbers in a text column: NaN, Java suffixes, hexadecimal, blank and null become 0.0."""
    odd = {0: "NaN", 1: "1d", 2: "2.5f", 3: "", 5: "0x1p3", 6: " 12.5 ", 7: "1e3", 8: "nan", 9: "-"}
    k = F.col("event_id") % 11
    raw = F.when(k == 10, F.col("value").cast("string"))
    for i, text in odd.items():
        raw = raw.when(k == i, F.lit(text))
    return read_table(spark, sf, "events").select(F.col("event_id").alias("id"), raw.alias("raw")).select("id", lenient_double("raw").alias("parsed"))


@register("lenient_numeric", f"SELECT event_id AS id, coalesce(TRY_CAST(trim({RAW_SQL}) AS DOUBLE), 0.0) AS parsed "
          "FROM events")
def q_lenient(spark, sf):
    ev = read_table(spark, sf, "events")
    raw = (F.when(F.col("event_type") == "error", F.lit(" "))
           .when(F.col("event_type") == "view", F.concat(F.lit("x"), F.col("value").cast("string")))
           .otherwise(F.col("value").cast("string")))
    return ev.select(F.col("event_id").alias("id"), raw.alias("raw")) \
             .select("id", lenient_double("raw").alias("parsed"))


@register("cast_int", "SELECT event_id AS id, CAST(trunc(value) AS INTEGER) AS value_int FROM events")
def q_cast_int(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select(F.col("event_id").alias("id"), to_int("value").alias("value_int"))


@register("smoothed_ratio", W_MART + "SELECT id, total_spend / (n_orders + 1) AS avg_spend FROM records")
def q_ratio(spark, sf):
    r = churn_records(spark, sf)
    return r.select("id", smoothed_ratio("total_spend", "n_orders").alias("avg_spend"))


@register("count_flags", W_MART + "SELECT id, CAST((urgent = 'Yes')::INT + (low = 'Yes')::INT "
          "+ (pending = 'Yes')::INT AS INTEGER) AS n_flags FROM records")
def q_count_flags(spark, sf):
    r = churn_records(spark, sf)
    return r.select("id", count_equal(["urgent", "low", "pending"], "Yes").alias("n_flags"))


@register("dict_map", W_MART + "SELECT id, CASE urgent WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS urgent_code, "
          "CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS label, "
          "CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 0 END AS segment_code FROM records")
def q_dict_map(spark, sf):
    r = churn_records(spark, sf)
    return r.select("id", dict_map("urgent", FE.BINARY_MAP).alias("urgent_code"),
                    dict_map("churn", FE.BINARY_MAP).alias("label"),
                    dict_map("c_mktsegment", {"BUILDING": 1, "MACHINERY": 0}).alias("segment_code"))


ONE_HOT_SQL = W_MART + "SELECT id, " + ", ".join(
    f"CAST(coalesce(c_mktsegment = '{v}', false) AS INTEGER) AS \"c_mktsegment_{v}\"" for v in SEGMENTS[1:]) \
    + " FROM records"


@register("one_hot", ONE_HOT_SQL)
def q_one_hot(spark, sf):
    r = churn_records(spark, sf)
    cats = FE.fit_categories(r, ["c_mktsegment"])
    return r.select("id", *FE.one_hot_columns("c_mktsegment", cats["c_mktsegment"]))


FEATURE_COLS = (NUMERIC_REC + ["urgent", "low", "pending", "avg_spend", "n_flags"]
                + [f"c_mktsegment_{v}" for v in SEGMENTS[1:]])

FEATURE_SQL = W_MART + """, enc AS (
  SELECT id, c_acctbal, n_orders, total_spend, tenure_days,
         CASE urgent WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS urgent,
         CASE low WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS low,
         CASE pending WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS pending,
         total_spend / (n_orders + 1) AS avg_spend,
         CAST((urgent = 'Yes')::INT + (low = 'Yes')::INT + (pending = 'Yes')::INT AS INTEGER) AS n_flags,
         """ + ", ".join(f"CAST(coalesce(c_mktsegment = '{v}', false) AS INTEGER) AS \"c_mktsegment_{v}\""
                          for v in SEGMENTS[1:]) + """,
         CAST(CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INTEGER) AS label
  FROM records)
SELECT * FROM enc"""


@register("feature_table", FEATURE_SQL)
def q_feature_table(spark, sf):
    r = churn_records(spark, sf)
    spec = FE.MART_SPEC.fit(r)
    return spec.transform(r)


ALIGN_SQL = W_MART + """, enc AS (
  SELECT id, c_acctbal, n_orders, total_spend, tenure_days,
         CASE urgent WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS urgent,
         CASE low WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS low,
         CASE pending WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS pending,
         total_spend / (n_orders + 1) AS avg_spend,
         CAST((urgent = 'Yes')::INT + (low = 'Yes')::INT + (pending = 'Yes')::INT AS INTEGER) AS n_flags,
         """ + ", ".join(
    ("0 AS \"c_mktsegment_MACHINERY\"" if v == "MACHINERY" else
     f"CAST(coalesce(c_mktsegment = '{v}', false) AS INTEGER) AS \"c_mktsegment_{v}\"") for v in SEGMENTS[1:]) + """
  FROM records WHERE c_mktsegment <> 'MACHINERY')
SELECT * FROM enc"""


@register("align_columns", ALIGN_SQL)
def q_align(spark, sf):
    """A table scored after training lacks one category and has an extra
    column: alignment to the trained list fills the dummy with 0."""
    r = churn_records(spark, sf)
    spec = FE.MART_SPEC.fit(r)
    part = r.filter(F.col("c_mktsegment") != "MACHINERY")
    local = FE.FeatureSpec(**{**spec.__dict__, "categories": None, "columns": None}).fit(part)
    enc = local.transform(part, with_target=False).withColumn("extra_col", F.lit(1))
    return FE.align_columns(enc, spec.columns, keep=["id"])


P_RAW = "1 / (1 + exp(-(value - 50) / 50))"


@register("round_score", f"SELECT event_id AS id, round({P_RAW}, 6) AS churn_probability FROM events")
def q_round(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select(F.col("event_id").alias("id"),
                     round_score(1 / (1 + F.exp(-(F.col("value") - 50) / 50)), 6).alias("churn_probability"))


@register("decide", f"SELECT event_id AS id, CAST({P_RAW} >= 0.5 AS INTEGER) AS churn, "
          f"CAST(round({P_RAW}, 6) >= 0.5 AS INTEGER) AS churn_served FROM events")
def q_decide(spark, sf):
    ev = read_table(spark, sf, "events")
    raw = 1 / (1 + F.exp(-(F.col("value") - 50) / 50))
    return ev.select(F.col("event_id").alias("id"), decide(raw).alias("churn"),
                     decide(round_score(raw)).alias("churn_served"))


@register("clip", W_MART + "SELECT id, greatest(c_acctbal, 0) AS acctbal_clipped, "
          "least(greatest(total_spend / 1e6, 1e-6), 1 - 1e-6) AS share_clipped FROM records")
def q_clip(spark, sf):
    r = churn_records(spark, sf)
    return r.select("id", clip("c_acctbal", lower=0.0).alias("acctbal_clipped"),
                    clip(F.col("total_spend") / 1e6, 1e-6, 1 - 1e-6).alias("share_clipped"))


# ---------------------------------------------------------------- validation

def _rule_sql(rules_sql):
    """concat_ws of failing rule names, and their count."""
    errs = ", ".join(f"CASE WHEN NOT ({cond}) THEN '{name}' END" for name, cond in rules_sql)
    cnt = " + ".join(f"CASE WHEN NOT ({cond}) THEN 1 ELSE 0 END" for name, cond in rules_sql)
    return f"concat_ws(';', {errs}) AS errors, CAST({cnt} AS INTEGER) AS n_errors"


ENUM_SQL = [("c_mktsegment:enum", "c_mktsegment IS NULL OR c_mktsegment IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY')")] + \
    [(f"{c}:enum", f"{c} IS NULL OR {c} IN ('Yes','No')") for c in ("urgent", "low", "pending")]
RANGE_SQL = [(f"{c}:range", f"TRY_CAST({c} AS DOUBLE) IS NULL OR TRY_CAST({c} AS DOUBLE) >= 0") for c in NUMERIC_REC]
REQ_SQL = [(f"{c}:required", f"{c} IS NOT NULL" + (f" AND TRY_CAST({c} AS {t}) IS NOT NULL" if t else ""))
           for c, t in (("c_mktsegment", None), ("urgent", None), ("low", None), ("pending", None),
                        ("c_acctbal", "DOUBLE"), ("n_orders", "BIGINT"), ("total_spend", "DOUBLE"),
                        ("tenure_days", "INTEGER"))]


def _only(kind):
    return [r for r in V.mart_rules() if r.rule == kind]


@register("validate_enum", W_MART + f"SELECT id, {_rule_sql(ENUM_SQL)} FROM records")
def q_v_enum(spark, sf):
    return V.check(churn_records(spark, sf), _only("enum")).select("id", "errors", "n_errors")


LIT_SQL = [(f"{c}:literal", f"{c} IS NULL OR {c} IN (0, 1)") for c in ("has_urgent", "has_low", "has_pending")]


@register("validate_literal", W_MART + f"SELECT id, {_rule_sql(LIT_SQL)} FROM mart")
def q_v_literal(spark, sf):
    rules = [V.literal_rule(c, [0, 1]) for c in ("has_urgent", "has_low", "has_pending")]
    return V.check(churn_mart(spark, sf), rules).select("id", "errors", "n_errors")


@register("validate_range", W_MART + f"SELECT id, {_rule_sql(RANGE_SQL)} FROM records")
def q_v_range(spark, sf):
    return V.check(churn_records(spark, sf), _only("range")).select("id", "errors", "n_errors")


@register("validate_required", W_MART + f"SELECT id, {_rule_sql(REQ_SQL)} FROM records")
def q_v_required(spark, sf):
    return V.check(churn_records(spark, sf), _only("required")).select("id", "errors", "n_errors")


@register("validate_cross", W_MART + "SELECT id, CASE WHEN coalesce(low = 'Yes', false) AND NOT coalesce(urgent = 'No', false) "
          "THEN 'urgent:cross' ELSE '' END AS warnings FROM records")
def q_v_cross(spark, sf):
    return V.check(churn_records(spark, sf), V.mart_rules(with_cross=True)).select("id", "warnings")


ALL_SQL = ENUM_SQL + RANGE_SQL + REQ_SQL


@register("quarantine", W_MART + f", chk AS (SELECT id, {_rule_sql(ALL_SQL)} FROM records) "
          "SELECT id, errors, n_errors FROM chk WHERE n_errors > 0")
def q_quarantine(spark, sf):
    _, bad = V.split_valid(churn_records(spark, sf), V.mart_rules())
    return bad.select("id", "errors", "n_errors")


@register("validate_nonempty", W_MART + "SELECT count(*) AS n_rows FROM records")
def q_v_nonempty(spark, sf):
    r = V.require_nonempty(churn_records(spark, sf))
    return r.agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- profiling

@register("shape", W_MART + f"SELECT count(*) AS n_rows, {len(REC_COLS)} AS n_cols FROM records")
def q_shape(spark, sf):
    return PR.shape(churn_records(spark, sf))


def _kind(c):
    return "numeric" if c in ("id", *NUMERIC_REC) else "string"


COLINFO_SQL = W_MART + " UNION ALL ".join(
    f"SELECT '{c}' AS column, {i} AS position, '{_kind(c)}' AS kind, count({c}) AS non_null FROM records"
    for i, c in enumerate(REC_COLS))


@register("column_info", COLINFO_SQL)
def q_column_info(spark, sf):
    return PR.column_info(churn_records(spark, sf))


SC_COLS = ["id", "ts", "value", "user_id", "event_type", "data_source", "y", "p"]
NULLS_SQL = W_SCORED + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(sum(CAST({c} IS NULL AS INTEGER)) AS BIGINT) AS nulls FROM scored" for c in SC_COLS)


@register("null_counts", NULLS_SQL)
def q_null_counts(spark, sf):
    return PR.null_counts(scored_events(spark, sf))


@register("duplicate_rows", "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM ("
          "SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus, o_orderpriority)")
def q_dups(spark, sf):
    o = read_table(spark, sf, "orders")
    return PR.duplicate_rows(o, ["o_custkey", "o_orderstatus", "o_orderpriority"])


DISTINCT_SQL = W_MART + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_distinct FROM records" for c in REC_COLS)


@register("distinct_counts", DISTINCT_SQL)
def q_distinct(spark, sf):
    return PR.distinct_counts(churn_records(spark, sf))


SKEW_SQL = W_MART + " UNION ALL ".join(
    f"SELECT '{c}' AS column, skewness({c}) AS skewness FROM records" for c in NUMERIC_REC)


@register("skewness", SKEW_SQL)
def q_skew(spark, sf):
    return PR.skewness(churn_records(spark, sf), NUMERIC_REC)


CORR_SQL = W_MART + " UNION ALL ".join(
    [f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM records"
     for i, a in enumerate(NUMERIC_REC) for b in NUMERIC_REC[i + 1:]]
    + [f"SELECT '{b}' AS a, '{a}' AS b, corr({a}, {b}) AS corr FROM records"
       for i, a in enumerate(NUMERIC_REC) for b in NUMERIC_REC[i + 1:]]
    + [f"SELECT '{a}' AS a, '{a}' AS b, 1.0::DOUBLE AS corr" for a in NUMERIC_REC])


@register("correlation", CORR_SQL)
def q_corr(spark, sf):
    return PR.correlation(churn_records(spark, sf), NUMERIC_REC)


HIST_SQL = W_MART + """, st AS (SELECT min(total_spend) AS lo, max(total_spend) AS hi FROM records),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((total_spend - lo) / ((hi - lo) / 50)), 49) END AS INTEGER) AS bin,
             count(*) AS cnt FROM records, st GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(0, 50))
SELECT g.bin, lo + g.bin * (hi - lo) / 50 AS lower, lo + (g.bin + 1) * (hi - lo) / 50 AS upper,
       coalesce(cnt, 0) AS count
FROM g CROSS JOIN st LEFT JOIN b ON b.bin = g.bin"""


@register("histogram", HIST_SQL)
def q_hist(spark, sf):
    return PR.histogram(churn_records(spark, sf), "total_spend", 50)


DENSITY_SQL = W_MART + """, base AS (SELECT churn AS cls, total_spend AS x FROM records WHERE total_spend IS NOT NULL),
st AS (SELECT min(x) AS lo, max(x) AS hi FROM base),
cls AS (SELECT cls, count(*) AS n, stddev_samp(x) AS sd FROM base GROUP BY cls),
fine AS (SELECT cls, CAST(least(floor((x - lo) / greatest((hi - lo) / 1024, 1e-12)), 1023) AS INTEGER) AS b,
                count(*) AS nb FROM base, st GROUP BY 1, 2),
fx AS (SELECT fine.*, lo + (b + 0.5) * greatest((hi - lo) / 1024, 1e-12) AS xb FROM fine, st),
grid AS (SELECT CAST(range AS INTEGER) AS gi, lo + range * (hi - lo) / 199 AS g FROM range(0, 200), st)
SELECT fx.cls AS churn, gi, g,
       sum(nb * exp(-0.5 * pow((g - xb) / (sd * pow(n, -0.2)), 2))) / (n * (sd * pow(n, -0.2)) * sqrt(2 * pi())) AS density
FROM fx JOIN cls ON cls.cls = fx.cls CROSS JOIN grid
GROUP BY fx.cls, gi, g, n, sd"""


@register("density", DENSITY_SQL)
def q_density(spark, sf):
    return PR.density(churn_records(spark, sf), "total_spend", "churn")


LINEAR_SQL = W_MART + """, v AS (SELECT churn AS cls, total_spend AS x FROM records WHERE total_spend IS NOT NULL),
cls AS (SELECT cls, count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS h FROM v GROUP BY cls),
st AS (SELECT min(x) AS lo, max(x) AS hi, (SELECT min(h) FROM cls WHERE h > 0) AS h0 FROM v),
w AS (SELECT lo, hi, greatest((hi - lo) / greatest(1024, ceil(8 * (hi - lo) / h0)), 1e-12) AS width FROM st),
a AS (SELECT cls, (x - lo) / width AS t FROM v, w),
fine AS (SELECT cls, b, sum(wt) AS nb FROM (SELECT cls, floor(t) AS b, floor(t) + 1 - t AS wt FROM a UNION ALL SELECT cls, floor(t) + 1, t - floor(t) FROM a) GROUP BY cls, b HAVING sum(wt) > 0),
grid AS (SELECT CAST(range AS INTEGER) AS gi, lo + range * (hi - lo) / 199 AS g FROM range(0, 200), w),
binned AS (SELECT f.cls, gi, g, sum(nb * exp(-0.5 * pow((g - (lo + b * width)) / h, 2))) / (n * h * sqrt(2 * pi())) AS density, width * width / (8 * h * h * h * sqrt(2 * pi())) AS error
           FROM fine f JOIN cls USING (cls) CROSS JOIN grid CROSS JOIN w WHERE h > 0 GROUP BY f.cls, gi, g, n, h, width),
raw AS (SELECT v.cls, gi, sum(exp(-0.5 * pow((g - x) / h, 2))) / (n * h * sqrt(2 * pi())) AS density FROM v JOIN cls USING (cls) CROSS JOIN grid WHERE h > 0 GROUP BY v.cls, gi, n, h)
SELECT b.cls AS churn, b.gi, b.g, b.density, b.error, abs(b.density - raw.density) <= b.error * (1 + 1e-9) AS within_bound FROM binned b JOIN raw ON raw.cls = b.cls AND raw.gi = b.gi"""


@register("density_linear", LINEAR_SQL)
def q_density_linear(spark, sf):
    """Density by linear binning with its error bound; SQL holds it against the raw values."""
    return PR.linear_density(churn_records(spark, sf), "total_spend", "churn").withColumn("within_bound", F.lit(True))


CONT_COLS = ["c_mktsegment", "urgent", "low", "pending"]
CONT_SQL = W_MART + " UNION ALL ".join(
    f"SELECT '{c}' AS column, {c} AS value, churn, count(*) AS count FROM records GROUP BY {c}, churn"
    for c in CONT_COLS)


@register("contingency", CONT_SQL)
def q_cont(spark, sf):
    return PR.contingency(churn_records(spark, sf), CONT_COLS, "churn")


@register("score_summary", W_SCORED + "SELECT data_source, avg(p) AS mean, stddev_pop(p) AS std, "
          "CAST(min(p) AS DOUBLE) AS min, CAST(max(p) AS DOUBLE) AS max, median(p) AS median "
          "FROM scored GROUP BY data_source")
def q_score_summary(spark, sf):
    return PR.score_summary(scored_events(spark, sf), "p", ["data_source"])


@register("positive_rate", W_MART + "SELECT avg(CASE churn WHEN 'Yes' THEN 1 ELSE 0 END) AS positive_rate, "
          "round(avg(CASE churn WHEN 'Yes' THEN 1 ELSE 0 END), 4) AS positive_rate_rounded FROM records")
def q_positive_rate(spark, sf):
    r = churn_records(spark, sf)
    y = dict_map("churn", FE.BINARY_MAP)
    return r.agg(F.avg(y).alias("positive_rate")) \
            .withColumn("positive_rate_rounded", F.round("positive_rate", 4))


@register("head", W_MART + "SELECT * FROM records ORDER BY id LIMIT 5")
def q_head(spark, sf):
    return PR.head(churn_records(spark, sf), 5, "id")


@register("sample", W_MART + f"SELECT * FROM records ORDER BY {u_sql(7, 'id')}, id LIMIT 3")
def q_sample(spark, sf):
    return PR.sample_rows(churn_records(spark, sf), 3, 7, "id")


# ---------------------------------------------------------------- splits

@register("split_random", W_MART + f"SELECT id, CASE WHEN {u_sql(42, 'id')} < 0.8 THEN 'train' ELSE 'test' END AS split "
          "FROM records")
def q_split_random(spark, sf):
    return SP.random_split(churn_records(spark, sf)).select("id", "split")


RANKED_SQL = W_MART + f""", rk AS (
  SELECT id, churn, row_number() OVER (PARTITION BY churn ORDER BY {u_sql(42, 'id')}, id) AS r,
         count(*) OVER (PARTITION BY churn) AS n FROM records)"""


@register("split_stratified", RANKED_SQL + " SELECT id, churn, CASE WHEN r <= round(0.2 * n) THEN 'reference' "
          "ELSE 'holdout' END AS split FROM rk")
def q_split_strat(spark, sf):
    return SP.stratified_split(churn_records(spark, sf), "churn").select("id", "churn", "split")


@register("stratified_folds", RANKED_SQL + " SELECT id, churn, CAST((r - 1) % 5 AS INTEGER) AS fold FROM rk")
def q_folds(spark, sf):
    return SP.stratified_folds(churn_records(spark, sf), "churn").select("id", "churn", "fold")


@register("row_batches", W_SCORED + "SELECT id, data_source, CAST((row_number() OVER (PARTITION BY data_source "
          "ORDER BY id) - 1) // 1000 AS INTEGER) AS batch_id FROM scored")
def q_row_batches(spark, sf):
    return with_batches(scored_events(spark, sf)).select("id", "data_source", "batch_id")


@register("pools", W_SCORED + "SELECT id, value, event_type, y, 'train_holdout' AS data_source FROM scored "
          "WHERE y IS NOT NULL UNION ALL SELECT id, value, event_type, NULL::INTEGER AS y, 'test' AS data_source "
          "FROM scored WHERE y IS NULL")
def q_pools(spark, sf):
    s = scored_events(spark, sf)
    lab = s.filter(F.col("y").isNotNull()).select("id", "value", "event_type", "y")
    unl = s.filter(F.col("y").isNull()).select("id", "value", "event_type")
    return SP.pools(lab, unl)


N_WIDE = 70
WIDE_SPARK = ["CASE WHEN event_id % {m} = 0 THEN NULL ELSE sin(value * {k}) + user_id % {m} END".format(m=i % 13 + 3, k=i + 1) for i in range(N_WIDE)]


@register("correlation_wide", "WITH w AS (SELECT " + ", ".join(f"{e} AS x{i}" for i, e in enumerate(WIDE_SPARK)) + " FROM events) "
          + " UNION ALL ".join(f"SELECT 'x{a}' AS a, 'x{b}' AS b, corr(x{a}, x{b}) AS corr FROM w" for a in (0, 33, 69) for b in range(N_WIDE) if a != b))
def q_correlation_wide(spark, sf):
    """Pairwise-complete correlations of 70 columns with nulls; three columns against all others."""
    wide = read_table(spark, sf, "events").select(*[F.expr(e).alias(f"x{i}") for i, e in enumerate(WIDE_SPARK)])
    return PR.correlation(wide, wide.columns).filter(F.col("a").isin("x0", "x33", "x69") & (F.col("a") != F.col("b")))


@register("grouped_median", "SELECT user_id, median(CAST(value AS DOUBLE)) AS median FROM events GROUP BY user_id")
def q_grouped_median(spark, sf):
    """Exact medians of many groups (a group per user)."""
    return PR.exact_median(read_table(spark, sf, "events"), "value", ["user_id"])
