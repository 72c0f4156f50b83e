"""The batch ETL job: stored marts by day, commits, replays, run and check logs."""

import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripmetrics.functions.columns import rnd
from tripmetrics.operators import marts as M
from tripmetrics.operators import merge as MG
from tripmetrics.plans import etl
from tripmetrics.plans.etl import run_backfill, run_daily, run_etl
from tripmetrics.plans.runlog import RunLog
from tripmetrics.plans.warehouse import Warehouse
from tripmetrics.plans.workspace import Workspace, land
from tripmetrics.session import FREED, freed_shuffles

MARTS = [etl.HOURLY, etl.NEIGHBORHOOD, etl.DAILY]


@pytest.fixture(scope="module")
def ws(spark):
    """The fixture's records of a few days, landed once."""
    ws = Workspace(spark, SF_SMALL)
    days = ["2024-01-20", "2024-02-10", "2024-03-22", "2024-03-25", "2024-03-28", "2024-03-30"]
    ws.raw_trips, ws.raw_weather = (land(spark, SF_SMALL, f"few-{n}", lambda *_, df=df, t=t: df.where(F.col(t).cast("date").cast("string").isin(days)))
                                    for n, df, t in (("trips", ws.raw_trips, "pickup_datetime"), ("weather", ws.raw_weather, "recorded_at")))
    return ws


@pytest.fixture
def out():
    return tempfile.mkdtemp(prefix="tm-etl-")


def run(spark, ws, out, b, trips=None):
    trips = ws.raw_trips.filter(F.col("batch_id") == b) if trips is None else trips
    return run_etl(spark, trips, ws.raw_weather, out, ws.dims, ws.params, b)


def mart_rows(spark, out, name):
    df = Warehouse(spark, out).read(name).drop("computed_at")
    return sorted(map(tuple, df.collect()), key=str)


def staged(spark, out, ws):
    return etl.staged_trips(Warehouse(spark, out), ws.clean)


def test_two_loads_and_replay(spark, ws, out):
    for b in (0, 1):
        run(spark, ws, out, b)
    head = Warehouse(spark, out).head()
    assert not run(spark, ws, out, 1)["applied"]
    assert Warehouse(spark, out).head() == head          # replayed load changes no mart

    stored = Warehouse(spark, out).read(etl.HOURLY)
    half = [c for c, r in MG.HOURLY_RULES.items() if r == "half"]
    stored = stored.select(*MG.HOURLY_KEYS, *[rnd(c, 6).alias(c) if c in half else F.col(c) for c in MG.HOURLY_RULES])
    per_batch = M.hourly_pulse(M.trip_cube(ws.clean.filter(F.col("batch_id") <= 1), ["batch_id"]), ["batch_id"])
    once = MG.fold(per_batch, MG.HOURLY_KEYS, MG.HOURLY_RULES)
    assert stored.exceptAll(once).count() == 0 and once.exceptAll(stored).count() == 0

    rows = staged(spark, out, ws)
    assert rows.count() == rows.select("trip_id").distinct().count() > 0   # insert-or-ignore across loads
    assert rows.where("loaded_at is null").count() == 0
    log = spark.read.parquet(f"{out}/dq_log")
    assert log.filter(F.col("load_id") == 0).count() > 0 and log.where("run_id is null or logged_at is null").count() == 0


def test_text_records_without_batch_id(spark, ws, out):
    """Feed-shaped text records (no batch id, some bad values) go through the job."""
    from tripmetrics.sources.adapters import dirty_trips_from_tables
    run(spark, ws, out, 7, dirty_trips_from_tables(spark, SF_SMALL).drop("batch_id"))
    assert Warehouse(spark, out).read(etl.HOURLY).count() > 0
    assert staged(spark, out, ws).select(F.min("batch_id")).first()[0] == 7


def test_late_and_repeated_loads(spark, ws, out):
    """Loads 2, 1, 2, 0: every load reaches the marts once, raw and log hold it once."""
    for b in (2, 1, 2, 0):
        run(spark, ws, out, b)
    hourly = Warehouse(spark, out).read(etl.HOURLY)
    clean = ws.clean.filter(F.col("batch_id") <= 2)
    assert hourly.agg(F.sum("trip_count")).first()[0] == clean.count()
    assert spark.read.parquet(f"{out}/raw_trips").count() == ws.raw_trips.filter(F.col("batch_id") <= 2).count()
    log = spark.read.parquet(f"{out}/dq_log").groupBy("load_id").count().collect()
    assert sorted(r.load_id for r in log) == [0, 1, 2] and len({r["count"] for r in log}) == 1


def test_a_day_is_one_partition_and_a_window_opens_its_days(spark, ws, out):
    run(spark, ws, out, 0)
    before = Warehouse(spark, out).head()["tables"]
    day = "2024-02-10"
    run(spark, ws, out, 1, ws.raw_trips.filter(F.col("pickup_datetime").cast("date") == day))
    wh = Warehouse(spark, out)
    for name in MARTS:
        now = wh.head()["tables"][name]
        assert [d for d in now if now[d] != before[name].get(d)] == [day]
    since = "2024-03-24"
    for name in (etl.HOURLY, etl.DAILY):
        files = wh.read(name, since).inputFiles()
        days = {f.split("/day=")[1][:10] for f in files}
        assert days == {d for d in wh.days(name) if d >= since} and len(files) == len(days) == 3
    assert wh.vacuum(keep=1) == 3 + len([t for t in before if before[t] != wh.head()["tables"][t] and t not in MARTS for d in before[t] if before[t][d] != wh.head()["tables"][t][d]])
    assert wh.read(etl.HOURLY).count() == Warehouse(spark, out).read(etl.HOURLY).count() > 0


def test_crash_between_marts_then_again(spark, ws, out, monkeypatch):
    """A load that dies behind its first mart shows nothing, leaves a failed
    run, and gives the same tables when it is run again."""
    run(spark, ws, out, 0)
    shown = {m: mart_rows(spark, out, m) for m in MARTS}
    real, calls = Warehouse.write, []

    def write(self, table, *a, **k):
        calls.append(table)
        if table == etl.NEIGHBORHOOD:
            raise RuntimeError("executor lost for good")
        return real(self, table, *a, **k)

    monkeypatch.setattr(Warehouse, "write", write)
    with pytest.raises(RuntimeError):
        run(spark, ws, out, 1)
    monkeypatch.setattr(Warehouse, "write", real)
    assert etl.HOURLY in calls and {m: mart_rows(spark, out, m) for m in MARTS} == shown
    log = {r.run_id: r for r in RunLog(spark, out).latest().collect()}
    assert log["trips-1"].status == "failed" and "lost for good" in log["trips-1"].error_message
    assert staged(spark, out, ws).where("load_id = 1").count() == 0
    run(spark, ws, out, 1)
    clean = tempfile.mkdtemp(prefix="tm-etl-")
    for b in (0, 1):
        run(spark, ws, clean, b)
    for m in MARTS:
        assert mart_rows(spark, out, m) == mart_rows(spark, clean, m)
    assert staged(spark, out, ws).count() == staged(spark, clean, ws).count()
    log = {r.run_id: r for r in RunLog(spark, out).latest().collect()}
    assert log["trips-1"].status == "success" and log["trips-1"].error_message is None


def test_half_written_commit_is_passed_over(spark, ws, out):
    run(spark, ws, out, 0)
    wh = Warehouse(spark, out)
    with open(f"{out}/_commits/{wh.next_seq():012d}.json", "w") as f:
        f.write('{"seq": 2, "loads"')
    assert wh.head()["seq"] == 1 and wh.next_seq() == 3
    run(spark, ws, out, 1)
    assert Warehouse(spark, out).head()["seq"] == 3 and set(Warehouse(spark, out).head()["loads"]) == {"0", "1"}
    with pytest.raises(Exception, match="exist"):
        wh.commit("other", 3, {})


def test_run_log_counts_and_failure(spark, ws, out):
    run(spark, ws, out, 0)
    with pytest.raises(Exception):
        run(spark, ws, out, 1, ws.raw_trips.drop("pickup_datetime"))
    log = RunLog(spark, out)
    rows = {r.run_id: r for r in log.latest().collect()}
    raw, clean = ws.raw_trips.where("batch_id = 0"), ws.clean.where("batch_id = 0")
    whole = rows["trips-0"]
    assert (whole.status, whole.rows_extracted, whole.rows_loaded) == ("success", raw.count(), clean.count())
    assert whole.finished_at >= whole.started_at and rows["trips-1"].status == "failed" and rows["trips-1"].error_message
    per = {r.city: r["count"] for r in raw.groupBy("city").count().collect()}
    assert {r.city: r.rows_extracted for r in rows.values() if r.run_id.startswith("trips-0:")} == per
    assert all(r.rows_rejected == r.rows_extracted - r.rows_loaded and r.rows_inserted <= r.rows_loaded for r in rows.values())
    assert log.events().where("status = 'running'").count() == 2


def test_stored_keys_are_not_shuffled(spark, ws, out):
    """The stored key column meets a load's keys bucket by bucket: no exchange
    between its scan and the join, and no sort."""
    run(spark, ws, out, 0)
    fresh = MG.stage_trips(ws.clean, staged(spark, out, ws))
    fresh.collect()
    lines = fresh._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    at = next(i for i, x in enumerate(lines) if "Scan parquet" in x and "stg_taxi_trips" in x)
    assert "Bucketed: true" in lines[at]
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789"))
    above = []
    for x in reversed(lines[:at]):
        d = len(x) - len(x.lstrip(" :+-*()0123456789"))
        if d < depth:
            above.append(x)
            depth = d
        if "ShuffledHashJoin" in x:
            break
    assert any("ShuffledHashJoin" in x for x in above) and not any("Exchange" in x or "Sort " in x for x in above), above


def test_backfill_resumes_and_rolls_up(spark, ws, out, monkeypatch):
    loads = [(b, ws.raw_trips.filter(F.col("batch_id") == b), ws.raw_weather) for b in range(3)]
    real, seen = etl._load, []

    def dies(*a):
        seen.append(a[6])
        if len(seen) == 2:
            raise RuntimeError("out of memory")
        return real(*a)

    monkeypatch.setattr(etl, "_load", dies)
    with pytest.raises(RuntimeError):
        run_backfill(spark, loads, out, ws.dims, ws.params)
    got = run_backfill(spark, loads, out, ws.dims, ws.params)
    assert seen == [0, 1, 1, 2] and got["chunks"] == 3 and got["ran"] == 2
    wh = Warehouse(spark, out)
    week = wh.read(etl.WEEKLY).drop("computed_at")
    want = M.weekly_trends(wh.read(etl.DAILY), wh.read(etl.HOURLY), ws.params)
    assert sorted(map(tuple, week.select(*want.columns).collect())) == sorted(map(tuple, want.collect())) != []
    head = wh.head()
    run_daily(spark, out, ws.params)
    again = Warehouse(spark, out)
    assert sorted(map(tuple, again.read(etl.WEEKLY).drop("computed_at").collect())) == sorted(map(tuple, week.collect()))
    assert again.head()["seq"] == head["seq"] + 1
    report = etl.check_log(spark, out).where("run_id like 'trips_daily%'")
    assert report.groupBy("city").count().where("count <> 5").count() == 0 and report.count() > 0
    assert run_daily(spark, tempfile.mkdtemp(prefix="tm-etl-"), ws.params)["applied"] is False


def test_totals_equal_the_layers(spark, ws, out):
    """Running totals are what a scan of the layers gives, also with re-sent rows."""
    run(spark, ws, out, 0)
    run(spark, ws, out, 1, ws.raw_trips.filter("batch_id <= 1"))
    t = {r.city: r for r in Warehouse(spark, out).read(etl.TOTALS).collect()}
    rows = staged(spark, out, ws).groupBy("city").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("r"))
    for r in rows.collect():
        assert (t[r.city].stg_trips, t[r.city].revenue) == (r.n, r.r)
    raw = ws.raw_trips.where("batch_id = 0").unionByName(ws.raw_trips.where("batch_id <= 1")).groupBy("city").count().collect()
    assert {r.city: r["count"] for r in raw} == {c: x.raw_trips for c, x in t.items() if x.raw_trips}


def test_bad_text_is_quarantined_and_the_rest_replayed(spark, ws, out):
    """Malformed text, a field of another type and missing text land in the
    quarantine with their load and file; every other record comes back as it was."""
    run(spark, ws, out, 0)
    bad = ['{"trip_id": "x", "fare_amount": ', '{"trip_id": "y", "passenger_count": "many"}', None]
    rows = spark.createDataFrame([("AFRICA", "feed", t) for t in bad], "city string, source string, raw_json string")
    etl._landed(rows.unionByName(etl.FD.land_trips(ws.raw_trips.where("batch_id = 1"))), 1, f"{out}/raw_trips", "city")
    got = etl.replay(spark, out, 1)
    want = ws.raw_trips.where("batch_id = 1").select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    kept = spark.read.parquet(f"{out}/quarantine").collect()
    assert sorted((r.raw_json or "", r.reason) for r in kept) == sorted((t or "", "no text" if t is None else "not a record") for t in bad)
    assert all(r.load_id == 1 and "load_id=1" in r.file and r.ingested_at for r in kept)
    assert etl.replay(spark, out, 0).count() == ws.raw_trips.where("batch_id = 0").count()
    assert spark.read.parquet(f"{out}/quarantine").where("load_id = 0").count() == 0


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def test_shuffles_leave_the_disk_with_the_write(spark, tmp_path):
    """Landing and staging leave no shuffle file behind, without a garbage collection of the driver; the setting ends with them."""
    rows = spark.range(2000).selectExpr("cast(id % 500 AS string) AS trip_id", "id AS n")
    before = shuffle_files(spark)
    land(spark, SF_SMALL, "dealt-anew", lambda *_: rows.repartition(4, "n"))
    with freed_shuffles(spark):
        assert Warehouse(spark, str(tmp_path / "w"), 4).stage("stg", MG.first_per_key(rows, "trip_id", ["n"]), "trip_id", 1).count() == 500
    assert spark.conf.get(FREED, None) is None
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    spark.conf.set(FREED, "false")
    with freed_shuffles(spark):
        assert spark.conf.get(FREED) == "false"
    assert spark.conf.get(FREED) == "false"
    spark.conf.unset(FREED)


def test_staging_in_steps_gives_the_same_rows(spark, tmp_path, monkeypatch):
    """Buckets made a few at a time: every row once, in its bucket, with and without rows staged before."""
    rows = spark.range(600).selectExpr("cast(id % 200 AS string) AS trip_id", "'c' AS city", "id AS n")
    monkeypatch.setattr("tripmetrics.plans.warehouse.STAGE_BUCKETS", 3)
    writer, into = type(rows.write), []
    real = writer.insertInto
    monkeypatch.setattr(writer, "insertInto", lambda self, name, *a: (into.append(name), real(self, name, *a))[1])
    wh, schema = Warehouse(spark, str(tmp_path / "w"), 8), rows.schema
    first = MG.insert_or_ignore(rows.where("n < 90"), "trip_id", ["trip_id"], ["n"])
    assert wh.stage("stg", first, "trip_id", 1).count() == 90 and len(into) == 3
    wh.commit(1, 1, {})
    got = wh.stage("stg", MG.insert_or_ignore(rows, "trip_id", ["trip_id"], ["n"], wh.staged("stg", schema, "trip_id", without=2)), "trip_id", 2)
    assert sorted((int(r.trip_id), r.n) for r in got.collect()) == [(i, i) for i in range(90, 200)] and len(into) == 6
    of = {(r.f, r.b) for r in got.selectExpr("int(regexp_extract(input_file_name(), '_([0-9]{5})[.]c', 1)) AS f", "pmod(hash(trip_id), 8) AS b").collect()}
    assert {f for f, _ in of} == set(range(8)) and all(f == b for f, b in of)


def test_landed_trips_are_not_written_again(spark, ws, out, monkeypatch):
    """A load of landed trips writes no cleaned batch and its JSON when staging is done, also if that failed; the tables are the same."""
    seen, stage, landed = [], Warehouse.stage, etl._landed
    monkeypatch.setattr(Warehouse, "drop", lambda self, folder: None)
    monkeypatch.setattr(Warehouse, "stage", lambda self, table, *a: (stage(self, table, *a), seen.append(table))[0])
    monkeypatch.setattr(etl, "_landed", lambda df, load, path, *a: (seen.append(path.rsplit("/", 1)[1]), landed(df, load, path, *a))[1])
    trips, plain = ws.raw_trips.where("batch_id = 0"), tempfile.mkdtemp(prefix="tm-etl-")
    for to, known in ((out, True), (plain, False)):
        run_etl(spark, trips, ws.raw_weather, to, ws.dims, ws.params, 0, landed=known)
        assert Warehouse(spark, to).exists("_batches/load=0/enriched") is not known
    assert seen.index("raw_trips") > seen.index(etl.STAGED_TRIPS)
    for name in (*MARTS, etl.TOTALS):
        a, b = (sorted(map(str, Warehouse(spark, x).read(name).drop("computed_at").collect())) for x in (out, plain))
        assert a == b != []
    a, b = (sorted(map(str, staged(spark, x, ws).drop("loaded_at").collect())) for x in (out, plain))
    assert a == b != []
    a, b = (sorted(r.raw_json for r in spark.read.parquet(f"{x}/raw_trips").collect()) for x in (out, plain))
    assert a == b != []

    def fails(self, table, *a):
        if table == etl.STAGED_TRIPS:
            raise RuntimeError("no space left")
        return stage(self, table, *a)

    monkeypatch.setattr(Warehouse, "stage", fails)
    with pytest.raises(RuntimeError, match="no space left"):
        run_etl(spark, trips, ws.raw_weather, out, ws.dims, ws.params, 1, landed=True)
    assert spark.read.parquet(f"{out}/raw_trips").where("load_id = 1").count() == trips.count()
