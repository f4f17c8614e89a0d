"""What an epoch of the monitoring streams looks up and writes."""

import random

from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.plans import monitoring as MO

SCHEMA = "id long, ts timestamp_ntz, value double, event_type string, y int, p double, data_source string, batch_id int"


def batches(spark, n_batches, size, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_batches * size):
        value = round(rnd.gauss(i % 5, 2), 1) if i % 11 else None  # ties and nulls
        rows.append((i, None, value, rnd.choice("abc"), rnd.randrange(2), rnd.random(), "s", i // size))
    return spark.createDataFrame(rows, SCHEMA)


def profile_of(spark):
    return MO.reference_profile(batches(spark, 3, 50, seed=1), MO.EVENTS_SPEC, persist=True)


def test_batches_look_up_each_share_once(spark, monkeypatch):
    """Shares of batches of one size are looked up once, however many batches there are; results are those of the split form."""
    sent, plain = [], D.dist_asof_next

    def counting(df, *args, **kwargs):
        sent.append(df.filter("side = 0").count())
        return plain(df, *args, **kwargs)

    monkeypatch.setattr(D, "dist_asof_next", counting)
    profile, size, g = profile_of(spark), 20, ["data_source", "batch_id"]
    long = D.to_long(batches(spark, 40, size), g, ["value", "p"])
    got = {(r.batch_id, r.column): r for r in D.numeric_drift(None, long, g, profile=profile, bounded=True).collect()}
    # batches of 17 to 20 values of two columns: fewer than 2 * (16 + 17 + 18 + 19) shares, of 40 * 40 values
    assert sent[0] < 140
    want = {(r.batch_id, r.column): r for r in D.numeric_drift(None, long, g, profile=profile).collect()}
    assert got.keys() == want.keys() and len(got) == 80
    for k, w in want.items():
        assert abs(got[k].wasserstein - w.wasserstein) < 1e-9 and abs(got[k].ks - w.ks) < 1e-12 and got[k].cur_n == w.cur_n


def test_open_batches_are_not_written_again(spark, tmp_path, monkeypatch):
    """An epoch's rows are written once, and tables that come written not at all; rows by split batches are those of the whole."""
    names, plain = [], MO.materialize

    def noting(df, name="stage"):
        names.append((name, df.count()))
        return plain(df, name)

    monkeypatch.setattr(MO, "materialize", noting)
    profile, cur = profile_of(spark), plain(batches(spark, 6, 20), "current")
    for written in (False, True):
        root, names[:] = str(tmp_path / f"w{written}"), []
        step = MO.metrics_per_epoch(spark, root, MO.EVENTS_SPEC, profile, 20, written=written)
        for epoch in range(3):
            step(cur.filter(F.col("id") % 3 == epoch), epoch)
        assert sum(n for _, n in names if n > 6) == (0 if written else 120)  # six batches; tables of batches aside
        got = {r.batch_id: r.asDict() for r in MO.stream_metrics_table(spark, root).drop("epoch").collect()}
        want = {r.batch_id: r.asDict() for r in MO.batch_metrics(None, cur, MO.EVENTS_SPEC, profile).collect()}
        assert got.keys() == want.keys()
        for k, row in want.items():
            for c, v in row.items():
                assert got[k][c] == v or abs(got[k][c] - v) < 1e-9, (k, c)
        assert spark.read.parquet(f"{root}/state/epoch=2").count() == 0


def test_arrivals_are_written_and_read_by_many_tasks(spark, monkeypatch):
    """An arrival is one micro-batch of as many files as tasks wrote; ids go on from one to the next."""
    from conftest import SF_SMALL
    from tidemark.plans import queries_stream as Q

    seen, plain_numbers, plain_tables, plain_metrics = [], Q.numbered_epochs, Q.materialize, Q.metrics_per_epoch

    def noting(spark, root, then, **options):
        step = plain_numbers(spark, root, then, **options)

        def per_epoch(df, epoch):
            ids = df.agg(F.min("id"), F.max("id"), F.count("id")).first()
            seen.append((epoch, df.select(F.input_file_name()).distinct().count(), *ids))
            step(df, epoch)

        return per_epoch

    monkeypatch.setattr(Q, "numbered_epochs", noting)
    monkeypatch.setattr(Q, "materialize", lambda df, name: plain_tables(df.repartition(4), name))
    options = []
    monkeypatch.setattr(Q, "metrics_per_epoch", lambda *a, **k: options.append(k) or plain_metrics(*a, **k))
    rows = Q.q_stream_numbering(spark, SF_SMALL).count()
    assert [e for e, *_ in seen] == [0, 1, 2] and all(files > 1 for _, files, *_ in seen)
    assert seen[0][3] < seen[1][2] and seen[1][3] < seen[2][2] and sum(s[4] for s in seen) == rows
    assert options[0]["written"]  # the numbered tables are read as they are
