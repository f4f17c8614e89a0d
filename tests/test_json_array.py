"""JSON arrays read by several tasks equal Spark's one-task reader."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.plans.fixtures import churn_records
from tidemark.plans.queries_reports import q_scan_json_array
from tidemark.sources import json_array as JA
from tidemark.sources.json_array import json_records, read_json_array

SCHEMA = "id long, text string, nested struct<a: long, b: array<string>>, list array<struct<x: long>>"


def records(n, seed=1):
    rng = random.Random(seed)
    odd = ['}', '{', '"', '\\', '\\"', '}{', '],[', 'é日本', '\n', 'a' * 300, '', '\\\\"}', '{"id": 1}']
    return [{"id": i, "text": "".join(rng.choice(odd) for _ in range(rng.randrange(0, 6))), "nested": {"a": i, "b": [rng.choice(odd)] * rng.randrange(0, 3)},
             "list": [{"x": j} for j in range(rng.randrange(0, 4))]} for i in range(n)]


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]

    def to(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield to
    for n, v in zip(names, old):
        spark.conf.set(n, v)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("ascii_", [True, False])
def test_same_rows_at_any_split(spark, tmp_path, small_splits, indent, ascii_):
    path = tmp_path / "array.json"
    path.write_text(json.dumps(records(60), indent=indent, ensure_ascii=ascii_), encoding="utf-8")
    want = sorted(map(str, spark.read.schema(SCHEMA).option("multiLine", True).json(str(path)).collect()))
    assert len(want) == 60
    for size in (300, 2000, 1 << 20):
        small_splits(size)
        assert sorted(map(str, read_json_array(spark, str(path), SCHEMA).collect())) == want, size


def test_several_files_long_records_and_bare_objects(spark, tmp_path, small_splits):
    rows = records(30, 2)
    rows[7]["text"] = "x}" * 4000  # longer than many splits
    for i in range(3):
        (tmp_path / f"part{i}.json").write_text(json.dumps(rows[10 * i:10 * i + 10]))
    (tmp_path / "bare.json").write_text("\n".join(json.dumps(r) for r in records(5, 3)))
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text(" [ ] ")
    (tmp_path / "mixed.json").write_text('[1, "a}", null, {"id": 77}, [{"id": 78}], {}]')
    small_splits(150)
    got = sorted(r.text for r in json_records(spark, str(tmp_path)).collect())
    want = [json.dumps(r) for r in rows] + [json.dumps(r) for r in records(5, 3)] + ['{"id": 77}', "{}"]
    assert [json.loads(t) for t in got] == [json.loads(t) for t in sorted(want)]


def test_large_array_is_read_by_many_tasks(spark, tmp_path, small_splits):
    path = str(tmp_path / "large.json")
    row = json.dumps({"id": 0, "text": "some } text \\ " * 20})[8:]
    with open(path, "w") as f:
        f.write("[")
        for i in range(60_000):
            f.write(("," if i else "") + '{"id": %d' % i + row)
        f.write("]")
    small_splits(2 << 20)
    df = read_json_array(spark, path, "id long, text string")
    assert df.rdd.getNumPartitions() > 5
    r = df.agg(F.count("id"), F.sum("id"), F.countDistinct("text")).first()
    assert tuple(r) == (60_000, sum(range(60_000)), 1)


@pytest.fixture
def all_partitions(spark):
    """Every shuffle partition stays one of its own."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, old)


def test_query_keeps_all_records_of_many_partitions(spark, all_partitions):
    want = sorted(map(str, churn_records(spark, SF_SMALL).collect()))
    assert sorted(map(str, q_scan_json_array(spark, SF_SMALL).collect())) == want


@pytest.mark.parametrize("n", [0, 1, 2, 500])
def test_rows_are_written_as_one_array(spark, tmp_path, all_partitions, n):
    rows = spark.range(n).withColumn("text", F.when(F.col("id") % 3 > 0, F.lit('a "]" b'))).join(spark.range(n), "id")
    JA.write_json_array(rows, str(tmp_path / "array"))
    file, = (tmp_path / "array").glob("part-*")
    got = json.loads(file.read_text())
    assert sorted(got, key=lambda r: r["id"]) == [{"id": i, "text": 'a "]" b' if i % 3 else None} for i in range(n)]


def test_other_elements_longer_than_splits_are_skipped(spark, tmp_path, small_splits):
    inner = [{"id": -1, "text": "]}{["}, [[{"id": -2}]]] * 25
    rows = [{"id": 1}, inner, {"id": 2, "list": [inner]}, [inner, [inner]], {"id": 3}, [], inner, [inner]]
    (tmp_path / "array.json").write_text(json.dumps(rows))
    (tmp_path / "late.json").write_text("\n".join(json.dumps(r) for r in ({"id": 4}, inner, {"id": 5}, [inner, inner])))
    want = ['{"id": 1}', json.dumps(rows[2]), '{"id": 3}', '{"id": 4}', '{"id": 5}']
    for size in (500, 1 << 20):
        small_splits(size)
        assert sorted(r.text for r in json_records(spark, str(tmp_path)).collect()) == sorted(want), size


def test_random_elements_at_any_split(spark, tmp_path, small_splits):
    rng = random.Random(5)

    def value(depth):
        kind = rng.randrange(6 if depth else 3)
        if kind < 3:
            return [rng.randrange(99), rng.choice(['}', '"[', '\\"{', ']', 'é']) * rng.randrange(9), None][kind]
        many = [value(depth - 1) for _ in range(rng.randrange(9))]
        return many if kind < 5 else {f"k{i}": v for i, v in enumerate(many)}

    files = [[value(4) for _ in range(30)] for _ in range(3)]
    for i, elements in enumerate(files):
        (tmp_path / f"f{i}.json").write_text(json.dumps(elements, ensure_ascii=False))
    want = sorted(json.dumps(e, ensure_ascii=False) for elements in files for e in elements if isinstance(e, dict))
    assert len(want) > 9 and max(map(len, want)) > 300
    for size in (100, 700):
        small_splits(size)
        assert sorted(r.text for r in json_records(spark, str(tmp_path)).collect()) == want, size


def test_long_pieces_are_scanned_in_short_runs():
    values = [b"x" * 300_000] * 50 + [b"y" * 5_000_000] + [b"z"] * 9
    names = ["a"] * 20 + ["b"] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(names), pa.array([0] * 60, pa.int64()), pa.array(values, pa.binary())], names=["file", "block", "value"])
    runs = list(JA._by_split([batch]))
    for name in "ab":
        assert b"".join(raw for file, _, raw in runs if file == name) == b"".join(v + b"}" for n, v in zip(names, values) if n == name)
    assert sorted(len(raw) for _, _, raw in runs)[-2] < 3 << 20  # all but the one piece that is longer
