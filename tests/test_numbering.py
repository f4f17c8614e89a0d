"""Batch numbers of arriving rows: continuous over epochs, the same after replays, bounded state."""

import os
from collections import Counter

from pyspark.sql import functions as F

from tidemark.operators.materialize import materialize, temporary_tables
from tidemark.session import scratch_path
from tidemark.streaming import jobs as ST
from tidemark.streaming.numbering import number_rows, numbered_epochs

SCHEMA = "id long, data_source string, v double"


def arrivals(spark, lo, hi):
    return spark.createDataFrame([(i, (None, "a", "a", "b")[i % 4], float(i)) for i in range(lo, hi)], SCHEMA)


def expected(hi, size):
    seen, out = Counter(), {}
    for i in range(hi):
        s = (None, "a", "a", "b")[i % 4]
        out[i] = (s, seen[s] // size)
        seen[s] += 1
    return out


def numbered(spark, root):
    return {r.id: (r.data_source, r.batch_id) for r in spark.read.parquet(f"{root}/numbered").collect()}


def test_numbers_go_on_over_epochs_and_replays(spark):
    root = scratch_path(spark, "numbering")
    seen = []
    run = numbered_epochs(spark, root, lambda df, epoch: seen.append((epoch, df.count())), size=100)
    for epoch, (lo, hi) in enumerate([(0, 130), (130, 137), (137, 137), (137, 900)]):
        run(arrivals(spark, lo, hi), epoch)
        run(arrivals(spark, lo, hi), epoch)  # a replay
    assert numbered(spark, root) == expected(900, 100)
    sizes = Counter(numbered(spark, root).values())
    assert all(n == 100 for (s, b), n in sizes.items() if b < max(x for t, x in sizes if t == s))
    assert seen == [(0, 130), (0, 130), (1, 7), (1, 7), (2, 0), (2, 0), (3, 763), (3, 763)]
    assert sorted(os.listdir(f"{root}/offsets".replace("file:", ""))) == ["epoch=2", "epoch=3"]


def test_unnumbered_files_restart_from_checkpoint(spark):
    root, src = scratch_path(spark, "numbering"), scratch_path(spark, "files")
    for lo, hi in ((0, 250), (250, 600), (600, 1000)):
        arrivals(spark, lo, hi).coalesce(1).write.mode("append").parquet(src)
        ST.run_foreach_batch(ST.file_stream(spark, src, SCHEMA, max_files_per_trigger=1), numbered_epochs(spark, root, size=64), f"{root}/checkpoint")
    assert numbered(spark, root) == expected(1000, 64)


def test_ties_and_null_order(spark):
    rows = spark.createDataFrame([(None, "a", 1.0), (None, "a", 2.0), (5, "a", 1.0), (5, "a", 1.0), (5, "a", 3.0)], SCHEMA)
    a, b = (sorted(map(str, number_rows(rows.repartition(n), None, size=2).collect())) for n in (1, 4))
    assert a == b and Counter(r.split("batch_id=")[1] for r in a) == {"0)": 2, "1)": 2, "2)": 1}
    assert number_rows(rows.filter(F.lit(False)), None).count() == 0


def test_temporary_tables_are_deleted(spark):
    with temporary_tables(spark):
        t = materialize(spark.range(3), "temporary")
        path = t.inputFiles()[0].replace("file://", "")
        assert os.path.exists(path)
        with temporary_tables(spark):
            inner = materialize(spark.range(2), "inner").inputFiles()[0].replace("file://", "")
        assert not os.path.exists(inner)
    assert not os.path.exists(path)
    kept = materialize(spark.range(3), "kept").inputFiles()[0].replace("file://", "")
    assert os.path.exists(kept)
