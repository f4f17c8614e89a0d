"""Numbers under concurrent writers; schema log and compaction of the metrics table."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark.operators import registry as REG
from tidemark.sources import markers as MK
from tidemark.sources import metrics_table as MT
from tidemark.sources.sinks import latest_per_key


def test_numbers_are_taken_once(spark, tmp_path):
    folder = str(tmp_path / "numbers")
    with ThreadPoolExecutor(8) as ex:
        got = list(ex.map(lambda _: MK.take_number(spark, folder, 5), range(40)))
    assert sorted(got) == list(range(5, 45)) == MK.numbers(spark, folder)
    assert MK.take_number(spark, folder, 100) == 100
    path = f"{folder}/note.txt"
    assert MK.create_exclusive(spark, path, "é one") and not MK.create_exclusive(spark, path, "two")
    assert MK.read_text(spark, path) == "é one"


def test_eight_threads_register_eight_versions(spark, tmp_path):
    root = str(tmp_path / "registry")
    assert REG.register_version(spark, root, "a/b", "run-0", "uri", 0.5) == 1
    with ThreadPoolExecutor(8) as ex:
        got = list(ex.map(lambda i: REG.register_version(spark, root, "a/b", f"run-{i}", "uri", 0.5), range(1, 9)))
        trials = list(ex.map(lambda _: REG.next_trial(spark, root, "s", "boost"), range(8)))
    assert sorted(got) == list(range(2, 10)) and sorted(trials) == list(range(8))
    versions = spark.read.schema(REG.VERSIONS_SCHEMA).parquet(f"{root}/model_versions")
    assert sorted(r.version for r in versions.collect()) == list(range(1, 10))
    assert REG.register_version(spark, root, "other", "run", "uri", None) == 1


def test_numbers_go_on_after_tables_without_markers(spark, tmp_path):
    root = str(tmp_path / "old")
    spark.createDataFrame([("m", 7, "r", "u", "", 0.1, dt.datetime(2024, 1, 1))], REG.VERSIONS_SCHEMA).write.parquet(f"{root}/model_versions")
    REG.append_trial(spark, root, "s", "boost", 3, "{}", 0.5)
    assert REG.register_version(spark, root, "m", "r", "u", 0.2) == 8
    assert REG.next_trial(spark, root, "s", "boost") == 4


def rows(spark, lo, hi, written):
    start = dt.datetime(2024, 1, 1)
    data = [(start + dt.timedelta(hours=6 * i), ("a", "b")[i % 2], i, float(i) + written / 10, written) for i in range(lo, hi)]
    df = spark.createDataFrame(data, "ts timestamp, data_source string, batch_id int, value double, written_at int")
    return df.withColumn("day", F.to_date("ts"))


def test_compaction_keeps_what_reports_see(spark, tmp_path):
    path = str(tmp_path / "metrics")
    with pytest.raises(FileNotFoundError):
        MT.read(spark, path)
    for i, (lo, hi) in enumerate([(0, 10), (5, 15), (12, 20), (0, 4)]):
        df = rows(spark, lo, hi, i)
        MT.append(df if i < 2 else df.withColumn("extra", F.lit(i)), path, "run")
    assert MK.numbers(spark, f"{path}/_schema") == [1, 2]  # a version for the new column, none for the rest
    view = lambda: sorted(map(str, latest_per_key(MT.read(spark, path, {"extra": -1, "new": 0})).collect()))
    before = view()
    files = MT.data_files(spark, path)
    assert max(map(len, files.values())) > 1 and len(before) == 20
    assert MT.compact(spark, path) == sum(len(f) > 1 for f in files.values())
    after = MT.data_files(spark, path)
    assert view() == before and {len(f) for f in after.values()} == {1} and set(after) == set(files)
    assert MT.read(spark, path).count() == 20  # replays are gone from the files
    assert MT.compact(spark, path) == 0 and not [p for p in (tmp_path / "metrics").iterdir() if p.name.startswith("_staging")]
    MT.append(rows(spark, 0, 3, 9), path, "run")  # the table goes on
    assert latest_per_key(MT.read(spark, path)).filter("value > 0.85 and batch_id = 0").count() == 1


def test_compaction_that_died_shows_no_row_twice(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "metrics")
    for i in range(3):
        MT.append(rows(spark, 0, 12, i), path, "run")
    before = sorted(map(str, latest_per_key(MT.read(spark, path)).collect()))
    files = MT.data_files(spark, path)
    spark_fs = MT._fs

    class NoDelete:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == "delete":
                raise KeyboardInterrupt
            return getattr(self.fs, name)

    monkeypatch.setattr(MT, "_fs", lambda s, p: (NoDelete(spark_fs(s, p)[0]), spark_fs(s, p)[1]))
    with pytest.raises(KeyboardInterrupt):
        MT.compact(spark, path)
    monkeypatch.setattr(MT, "_fs", spark_fs)
    assert sum(map(len, MT.data_files(spark, path).values())) > sum(map(len, files.values()))
    assert sorted(map(str, latest_per_key(MT.read(spark, path)).collect())) == before
    MT.compact(spark, path)
    assert sorted(map(str, latest_per_key(MT.read(spark, path)).collect())) == before
    assert {len(f) for f in MT.data_files(spark, path).values()} == {1}


def test_schema_is_additive(spark, tmp_path):
    path = str(tmp_path / "metrics")
    MT.append(rows(spark, 0, 2, 0), path, "run")
    with pytest.raises(ValueError, match="value"):
        MT.append(rows(spark, 0, 2, 1).withColumn("value", F.lit("text")), path, "run")
    with ThreadPoolExecutor(4) as ex:
        list(ex.map(lambda i: MT.append(rows(spark, 2 + i, 3 + i, 1).withColumn(f"c{i}", F.lit(i)), path, "run"), range(4)))
    m = MT.read(spark, path)
    assert {f"c{i}" for i in range(4)} <= set(m.columns) and m.count() == 6
