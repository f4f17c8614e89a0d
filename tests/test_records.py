"""Golden record, broken records and the frozen feature list."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import lenient_double
from tidemark.operators import customer_record as SC
from tidemark.operators import validate as V

SAMPLE = dict(SeniorCitizen=0, Partner="Yes", Dependents="Yes", tenure=29, PhoneService="Yes",
              MultipleLines="No", InternetService="DSL", OnlineSecurity="Yes", OnlineBackup="No",
              DeviceProtection="Yes", TechSupport="Yes", StreamingTV="No", StreamingMovies="No",
              Contract="One year", PaperlessBilling="Yes", PaymentMethod="Mailed check",
              MonthlyCharges=60.10, TotalCharges=1653.85)


def _df(spark, rows):
    return spark.createDataFrame([tuple(r.get(n) for n, _ in SC.FIELDS) for r in rows], SC.RECORD_SCHEMA) \
        .withColumn("id", F.monotonically_increasing_id())


def test_golden_record(spark):
    spec = SC.frozen_customer_spec()
    row = spec.transform(_df(spark, [SAMPLE]), keep=()).first().asDict()
    assert list(row) == list(spec.columns)
    assert len(spec.columns) == 31
    assert row["AvgMonthlyCharge"] == pytest.approx(1653.85 / 30)
    assert row["TotalServices"] == 4
    ones = {k for k, v in row.items() if "_" in k and v == 1}
    assert ones == {"OnlineSecurity_Yes", "DeviceProtection_Yes", "TechSupport_Yes", "Contract_One year",
                    "PaymentMethod_Mailed check"}
    assert row["Partner"] == 1 and row["PaperlessBilling"] == 1


def test_feature_order_matches_contract():
    spec = SC.frozen_customer_spec()
    expected = ["SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService", "PaperlessBilling",
                "MonthlyCharges", "TotalCharges", "AvgMonthlyCharge", "TotalServices",
                "MultipleLines_No phone service", "MultipleLines_Yes", "InternetService_Fiber optic",
                "InternetService_No"]
    assert list(spec.columns[:14]) == expected
    assert spec.columns[-3:] == ("PaymentMethod_Credit card (automatic)", "PaymentMethod_Electronic check",
                                 "PaymentMethod_Mailed check")


@pytest.mark.parametrize("field,value,rule", [
    ("Contract", "month", "Contract:enum"),
    ("SeniorCitizen", 2, "SeniorCitizen:literal"),
    ("tenure", -1, "tenure:range"),
    ("MonthlyCharges", None, "MonthlyCharges:required"),
])
def test_broken_records(spark, field, value, rule):
    rec = dict(SAMPLE)
    rec[field] = value
    valid, bad = V.split_valid(_df(spark, [SAMPLE, rec]), SC.record_rules())
    assert valid.count() == 1
    errs = [r["errors"] for r in bad.collect()]
    assert errs == [rule]


def test_cross_rule_is_warning_only(spark):
    rec = dict(SAMPLE, InternetService="No", TechSupport="Yes")
    checked = V.check(_df(spark, [rec]), SC.record_rules(with_cross=True)).first()
    # enum passes, the cross-field rule only warns
    assert checked["n_errors"] == 0
    warned = checked["warnings"].split(";")
    assert warned == [f"{c}:cross" for c in SC.INTERNET_ADDONS]
    ok = dict(rec, **{c: "No internet service" for c in SC.INTERNET_ADDONS})
    assert V.check(_df(spark, [ok]), SC.record_rules(with_cross=True)).first()["warnings"] == ""


def test_blank_total_charges_is_zero(spark):
    df = spark.createDataFrame([(" ",), ("12.5",), ("abc",), (None,)], "t string")
    assert [r[0] for r in df.select(lenient_double("t")).collect()] == [0.0, 12.5, 0.0, 0.0]


def test_empty_batch_rejected(spark):
    with pytest.raises(ValueError):
        V.require_nonempty(_df(spark, []))


def test_spec_json_roundtrip(spark):
    spec = SC.frozen_customer_spec()
    j = json.loads(spec.to_json())
    assert j["columns"] == list(spec.columns)
