"""Record sources: header CSV with a blank number, JSON array files."""

import json

from pyspark.sql import functions as F

from tidemark.functions.columns import lenient_double
from tidemark.operators import customer_record as SC
from tidemark.sources import sinks as K

HEADER = ["id", "gender"] + [n for n, _ in SC.FIELDS] + ["Churn"]
ROW = ["7", "Female", "0", "Yes", "No", "1", "No", "No phone service", "DSL", "No", "Yes", "No", "No", "No",
       "No", "Month-to-month", "Yes", "Electronic check", "29.85"]


def test_csv_with_blank_total_charges(spark, tmp_path):
    p = tmp_path / "train.csv"
    p.write_text(",".join(HEADER) + "\n" + ",".join(ROW + [" ", "No"]) + "\n"
                 + ",".join(["8"] + ROW[1:] + ["29.85", "Yes"]) + "\n")
    df = K.read_csv(spark, str(p), SC.TRAIN_CSV_SCHEMA)
    df = df.withColumn("TotalCharges", lenient_double("TotalCharges"))
    got = {r["id"]: r["TotalCharges"] for r in df.collect()}
    assert got == {7: 0.0, 8: 29.85}  # id kept, blank parsed to 0.0
    assert dict(df.dtypes)["id"] == "bigint"


def test_json_array_records(spark, tmp_path):
    recs = [{"SeniorCitizen": 0, "tenure": 3, "Contract": "One year"},
            {"SeniorCitizen": 1, "tenure": 5, "Contract": "Two year"}]
    p = tmp_path / "batch.json"
    p.write_text(json.dumps(recs))
    df = K.read_json_records(spark, str(p), SC.RECORD_SCHEMA, multiline=True)
    assert df.count() == 2
    assert sorted(r["tenure"] for r in df.collect()) == [3, 5]
    assert df.filter(F.col("MonthlyCharges").isNotNull()).count() == 0  # absent -> null -> V4 catches it
