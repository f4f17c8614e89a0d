"""Shared fixtures of the training-data tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from tidemark.session import ship_package
    ship_package(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns whose names clash with the operators' own."""
    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", "x", 1, 2.0, True, None, "y") for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, source string, id string, n_words int, size double, kept boolean, rep string, names string")
        return df.repartition(partitions) if rows else df
    return make
