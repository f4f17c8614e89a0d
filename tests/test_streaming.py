"""Streaming: pacing, restart from checkpoint, watermark."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.streaming import jobs as ST


def test_available_now_one_file_per_trigger_and_restart(spark, tmp_path):
    src = str(tmp_path / "src")
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).withColumn("v", F.col("id") * 2.0) \
            .coalesce(1).write.mode("append").parquet(src)
    seen = []

    def fn(df, epoch):
        seen.append((epoch, df.count()))

    ck = str(tmp_path / "ck")
    ST.run_foreach_batch(ST.file_stream(spark, src, "id long, v double", max_files_per_trigger=1), fn, ck)
    assert [e for e, _ in seen] == [0, 1, 2] and sum(n for _, n in seen) == 30
    # a restart with the same checkpoint processes nothing again
    ST.run_foreach_batch(ST.file_stream(spark, src, "id long, v double", max_files_per_trigger=1), fn, ck)
    assert len(seen) == 3


def test_processing_time_trigger(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(5).write.parquet(src)
    out = str(tmp_path / "out")
    q = ST.run_to_files(ST.file_stream(spark, src, "id long"), out, str(tmp_path / "ck"),
                        once=False, interval="1 second")
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(out).count() == 5


def test_watermark_drops_late_rows(spark, tmp_path):
    src = str(tmp_path / "src")
    t0 = dt.datetime(2024, 1, 1)
    rows1 = [(t0 + dt.timedelta(hours=h), "a", 1, 0.5) for h in range(0, 50, 5)]
    spark.createDataFrame(rows1, "ts timestamp_ntz, data_source string, y int, p double") \
        .coalesce(1).write.parquet(src)
    schema = "ts timestamp_ntz, data_source string, y int, p double"
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        s = ST.file_stream(spark, src, schema, max_files_per_trigger=1)
        ST.run_to_files(ST.windowed_counts(s, size="1 day", watermark="1 hour"), out, ck)

    run()
    late = [(t0 + dt.timedelta(hours=1), "a", 1, 0.5)]  # day 1, after the watermark passed it
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(src)
    run()
    got = {r["window_start"].day: r["n"] for r in spark.read.parquet(out).collect()}
    assert got[1] == 5  # the late row was not added to the closed first day
    assert 2 not in got  # the newest day is still open


def test_streamed_metrics_of_split_batches_and_replay(spark, tmp_path):
    """A batch that arrives in several files has one row, equal to the batch job's; a replayed epoch changes nothing."""
    from tidemark.plans.fixtures import BATCH_SIZE, current_batches, reference_slice, scored_events
    from tidemark.plans.monitoring import EVENTS_SPEC, batch_metrics, metrics_per_epoch, reference_profile, stream_metrics_table
    from conftest import SF_SMALL
    ev = scored_events(spark, SF_SMALL)
    profile = reference_profile(reference_slice(ev), EVENTS_SPEC, persist=True)
    cur = current_batches(spark, SF_SMALL)
    root = str(tmp_path / "m")
    step = metrics_per_epoch(spark, root, EVENTS_SPEC, profile, BATCH_SIZE)
    parts = [cur.filter(F.col("id") % 4 == i) for i in range(4)]  # every part holds rows of every batch
    for epoch, part in enumerate(parts):
        step(part, epoch)
        if epoch == 2:
            step(part, epoch)  # replay
    key = ["data_source", "batch_id"]
    got = {tuple(r[k] for k in key): r.asDict() for r in stream_metrics_table(spark, root).drop("epoch").collect()}
    want = {tuple(r[k] for k in key): r.asDict() for r in batch_metrics(None, cur, EVENTS_SPEC, profile).collect()}
    assert got.keys() == want.keys()
    for k in want:
        for c, v in want[k].items():
            assert got[k][c] == v or abs(got[k][c] - v) < 1e-9, (k, c, got[k][c], v)


def test_epoch_rows_are_replaced(spark, tmp_path):
    out = str(tmp_path / "t")
    for n in (3, 5):
        ST.write_epoch(spark.range(n), out, 0)
    ST.write_epoch(spark.range(2), out, 1)
    assert spark.read.parquet(out).groupBy("batch").count().orderBy("batch").collect() == [(0, 5), (1, 2)]
