"""The customer record of the churn model: schema, validation rules and
feature recipe.

These are the contract values a user of the original service relies on.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.operators import validate as V
from tidemark.operators.features import FeatureSpec

# Field domains of the customer record.
YES_NO = ["Yes", "No"]
MULTIPLE_LINES = ["Yes", "No", "No phone service"]
INTERNET_SERVICE = ["DSL", "Fiber optic", "No"]
INTERNET_DEPENDENT = ["Yes", "No", "No internet service"]
CONTRACT = ["Month-to-month", "One year", "Two year"]
PAYMENT_METHOD = ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"]
SENIOR_CITIZEN = [0, 1]

# Feature recipe lists.
SERVICE_COLUMNS = ["PhoneService", "MultipleLines", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
                   "TechSupport", "StreamingTV", "StreamingMovies"]
ONE_HOT_COLUMNS = ["MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
                   "TechSupport", "StreamingTV", "StreamingMovies", "Contract", "PaymentMethod"]
BINARY_COLUMNS = ["Partner", "Dependents", "PhoneService", "PaperlessBilling"]
INTERNET_ADDONS = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
                   "StreamingMovies"]

FIELDS = [
    ("SeniorCitizen", IntegerType()), ("Partner", StringType()), ("Dependents", StringType()),
    ("tenure", IntegerType()), ("PhoneService", StringType()), ("MultipleLines", StringType()),
    ("InternetService", StringType()), ("OnlineSecurity", StringType()), ("OnlineBackup", StringType()),
    ("DeviceProtection", StringType()), ("TechSupport", StringType()), ("StreamingTV", StringType()),
    ("StreamingMovies", StringType()), ("Contract", StringType()), ("PaperlessBilling", StringType()),
    ("PaymentMethod", StringType()), ("MonthlyCharges", DoubleType()), ("TotalCharges", DoubleType()),
]
RECORD_SCHEMA = StructType([StructField(n, t, True) for n, t in FIELDS])
TRAIN_SCHEMA = StructType([StructField("id", LongType(), True), StructField("gender", StringType(), True)]
                          + RECORD_SCHEMA.fields + [StructField("Churn", StringType(), True)])
# Raw CSV: TotalCharges may be blank, so it is read as text and parsed leniently.
TRAIN_CSV_SCHEMA = StructType([f if f.name != "TotalCharges" else StructField("TotalCharges", StringType(), True)
                               for f in TRAIN_SCHEMA.fields])

ENUMS = {"Partner": YES_NO, "Dependents": YES_NO, "PhoneService": YES_NO, "PaperlessBilling": YES_NO,
         "MultipleLines": MULTIPLE_LINES, "InternetService": INTERNET_SERVICE, "Contract": CONTRACT,
         "PaymentMethod": PAYMENT_METHOD, **{c: INTERNET_DEPENDENT for c in INTERNET_ADDONS}}


def record_rules(with_cross: bool = False, present=None) -> list:
    """V1–V4 for every field; V6 (documented, not enforced) as a warning."""
    rules = [V.enum_rule(c, vals) for c, vals in ENUMS.items()]
    rules.append(V.literal_rule("SeniorCitizen", SENIOR_CITIZEN))
    rules += [V.range_rule(c, ge=0) for c in ("tenure", "MonthlyCharges", "TotalCharges")]
    types = {"SeniorCitizen": "int", "tenure": "int", "MonthlyCharges": "double", "TotalCharges": "double"}
    for n, _ in FIELDS:
        if present is not None and n not in present:
            rules.append(V.Rule(n, "required", F.lit(False)))
        else:
            rules.append(V.required_rule(n, types.get(n)))
    if with_cross:
        for c in INTERNET_ADDONS:
            rules.append(V.implies_rule(c, F.col("InternetService") == "No",
                                        F.col(c) == "No internet service"))
    return rules


CUSTOMER_SPEC = FeatureSpec(
    id_col="id", target="Churn",
    ratio=("TotalCharges", "tenure", "AvgMonthlyCharge"),
    flag_columns=tuple(SERVICE_COLUMNS), flag_name="TotalServices",
    binary_columns=tuple(BINARY_COLUMNS), one_hot=tuple(ONE_HOT_COLUMNS), drop=("gender",),
)


def frozen_customer_spec() -> FeatureSpec:
    """The spec with categories frozen to the record domains (the 31-column
    list), so even a one-row request keeps every dummy column."""
    from dataclasses import replace
    cats = {c: sorted(ENUMS[c]) for c in ONE_HOT_COLUMNS}
    plain = [n for n, _ in FIELDS if n not in ONE_HOT_COLUMNS] + ["AvgMonthlyCharge", "TotalServices"]
    cols = plain + [f"{c}_{v}" for c in ONE_HOT_COLUMNS for v in cats[c][1:]]
    return replace(CUSTOMER_SPEC, categories=cats, columns=tuple(cols))
