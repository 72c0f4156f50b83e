"""Streaming merge: same mart whatever the micro-batch pacing; equals the batch fold."""

from tests.conftest import SF_SMALL
from tripmetrics.plans.catalog import DEFAULT, workspace
from tripmetrics.plans.keys_fold import fold_hourly_df
from tripmetrics.streaming import live as L


def test_stream_fold_independent_of_pacing(spark, monkeypatch):
    ws = workspace(spark, SF_SMALL, DEFAULT)
    path = L.landing_for(spark, ws.raw_trips)
    schema = ws.raw_trips.schema
    orig = L._read_stream
    results = []
    for n in (2, 1000):
        monkeypatch.setattr(L, "_read_stream", lambda s, p, sc, files_per_trigger=16, _n=n: orig(s, p, sc, _n))
        results.append(L.stream_fold(spark, path, schema, ws.dims, ws.params))
    a, b = results
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    batch = fold_hourly_df(ws)
    assert a.exceptAll(batch).count() == 0 and batch.exceptAll(a).count() == 0


def test_stream_hourly_equals_batch(spark):
    ws = workspace(spark, SF_SMALL, DEFAULT)
    path = L.landing_for(spark, ws.raw_trips)
    s = L.stream_hourly(spark, path, ws.raw_trips.schema, ws.dims, ws.params)
    assert s.exceptAll(ws.hourly).count() == 0 and ws.hourly.exceptAll(s).count() == 0


def test_stream_fold_resumes_after_restart(spark):
    """Drain loads 0-1, land loads 2-3, restart on the same state: the mart
    equals the one-pass fold of all four loads (no load counted twice)."""
    from pyspark.sql import functions as F
    from tripmetrics.session import scratch_path

    ws = workspace(spark, SF_SMALL, DEFAULT)
    landing, state = scratch_path(spark, "t-landing"), scratch_path(spark, "t-state")
    schema = ws.raw_trips.schema
    L.land_batches(ws.raw_trips.filter(F.col("batch_id") <= 1), landing)
    first = L.stream_fold(spark, landing, schema, ws.dims, ws.params, state_dir=state)
    assert first.count() > 0
    L.land_batches(ws.raw_trips.filter(F.col("batch_id") >= 2), landing)
    again = L.stream_fold(spark, landing, schema, ws.dims, ws.params, state_dir=state)
    batch = fold_hourly_df(ws)
    assert again.exceptAll(batch).count() == 0 and batch.exceptAll(again).count() == 0


def test_a_second_drain_touches_its_days_alone(spark):
    """Two late records of one day: the second drain writes that day of the
    sums and the mart, no other; an epoch that comes again changes nothing."""
    from pyspark.sql import functions as F
    from tripmetrics.plans.warehouse import Warehouse
    from tripmetrics.session import scratch_path

    ws = workspace(spark, SF_SMALL, DEFAULT)
    landing, state = scratch_path(spark, "t-landing"), scratch_path(spark, "t-state")
    schema = ws.raw_trips.schema
    few = ws.raw_trips.filter("date(pickup_datetime) between '2024-02-01' and '2024-02-05'")
    L.land_batches(few.filter("batch_id <= 1"), landing)
    first = L.stream_hourly(spark, landing, schema, ws.dims, ws.params, state_dir=state)
    n, before = first.agg(F.sum("trip_count")).first()[0], Warehouse(spark, state).head()
    late = few.filter("batch_id = 2 and date(pickup_datetime) = '2024-02-03'")
    L.land_batches(late, landing)
    again = L.stream_hourly(spark, landing, schema, ws.dims, ws.params, state_dir=state)
    after = Warehouse(spark, state).head()
    for t in (L.CUBE, L.MART):
        assert [d for d in after["tables"][t] if after["tables"][t][d] != before["tables"][t].get(d)] == ["2024-02-03"]
    assert again.agg(F.sum("trip_count")).first()[0] == n + L.clean_stream(late, ws.dims, ws.params).count()
    assert len(after["loads"]) == len(before["loads"]) + 1
    L.stream_hourly(spark, landing, schema, ws.dims, ws.params, state_dir=state)
    assert Warehouse(spark, state).head() == after


def test_stream_dedupe_keeps_old_trips_and_first_arrivals(spark):
    """Loads 200 days apart, a trip id repeated by a later load and by the
    same one: every id once, the first arrival's row, after a restart too."""
    from datetime import timedelta
    from pyspark.sql import functions as F
    from tripmetrics.session import scratch_path

    ws = workspace(spark, SF_SMALL, DEFAULT)
    landing, state = scratch_path(spark, "t-landing"), scratch_path(spark, "t-state")
    schema = ws.raw_trips.schema
    raw = ws.raw_trips.filter("batch_id = 0 and dropoff_datetime is not null")
    L.land_batches(raw.unionByName(raw), landing)
    first = L.stream_dedupe(spark, landing, schema, ws.dims, ws.params, state_dir=state)
    want = ws.staged.filter("batch_id = 0")
    assert first.exceptAll(want).count() == 0 and want.exceptAll(first).count() == 0
    for c in ("pickup_datetime", "dropoff_datetime"):
        raw = raw.withColumn(c, F.col(c) - timedelta(days=200))
    late = raw.withColumn("batch_id", F.lit(1)).withColumn(
        "trip_id", F.when(F.col("passenger_count") == 1, F.col("trip_id")).otherwise(F.concat("trip_id", F.lit("-late"))))
    L.land_batches(late, landing)
    again = L.stream_dedupe(spark, landing, schema, ws.dims, ws.params, state_dir=state)
    assert again.count() == again.select("trip_id").distinct().count()
    assert first.exceptAll(again).count() == 0
    assert again.filter("trip_id like '%-late'").count() == want.filter("passenger_count <> 1").count()


def test_small_files_are_taken_together(spark, tmp_path):
    """Micro-batches are paced by bytes: 20 small files are one, and the days are written once."""
    ws = workspace(spark, SF_SMALL, DEFAULT)
    rows, path, state = ws.raw_trips.limit(200).repartition(20), str(tmp_path / "in"), str(tmp_path / "state")
    rows.write.parquet(path)
    L.stream_hourly(spark, path, ws.raw_trips.schema, ws.dims, ws.params, state_dir=state)
    assert len(list((tmp_path / "state" / "_commits").glob("*.json"))) == 1
