"""Plan-shape checks that keep the scale properties from regressing."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tripmetrics.operators import clean as CL
from tripmetrics.operators import merge as MG
from tripmetrics.operators import serve as SV
from tripmetrics.plans.catalog import DEFAULT, workspace
from tripmetrics.plans.warehouse import Warehouse
from tripmetrics.plans.workspace import fingerprint
from tripmetrics.session import INITIAL, INPUT_PER_PARTITION, SPLITS, shuffle_width, tune


def plan_of(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()      # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def raw_scans(plan):
    """Scans of the landed raw trips (recognised by their read schema)."""
    return len(re.findall(r"ReadSchema: struct<trip_id:string,city:string", plan))


def test_top_n_is_map_side(spark):
    p = plan_of(spark, "recent_trips")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_marts_aggregate_map_side_and_scan_once(spark):
    p = plan_of(spark, "hourly_pulse")
    assert "partial_sum" in p and raw_scans(p) == 1
    assert raw_scans(plan_of(spark, "daily_summary")) == 1     # both roll-ups from one cube


def test_window_bound_reaches_the_scan(spark):
    ws = workspace(spark, SF_SMALL, DEFAULT)
    p = ws.hourly_since("2024-03-24")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(pickup_datetime", p)
    p = E.queries()["weather_join"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(recorded_at", p)


SERVED = ["weekday_pattern", "neighborhood_totals", "top_hours", "kpi_busiest_hour", "kpis", "data_counts", "available_cities", "city_catalog",
          "hours_covered", "recent_hourly", "recent_daily", "recent_weather_impact", "weather_scatter", "weekly_trends", "weather_impact", "run_stats",
          "status_summary", "dq_warehouse_report", "hourly_average", "weekday_vs_weekend", "pulse_by_hour", "fare_by_hour", "heatmap_pivot",
          "top_neighborhoods", "top_hours_share", "run_history", "dq_recent"]


@pytest.mark.parametrize("key", SERVED)
def test_read_queries_open_no_raw_or_staged_file(spark, key):
    df = E.queries()[key](spark, SF_SMALL)
    assert not [f for f in df.inputFiles() if re.search(r"/raw-|/raw_trips/|/stg_|/_batches/", f)]


def test_windows_open_their_days_alone(spark):
    since = SV.days_back(DEFAULT, DEFAULT.recent_daily_days)
    for key in ("recent_daily", "recent_hourly"):
        days = {re.search(r"/day=([\d-]+)/", f).group(1) for f in E.queries()[key](spark, SF_SMALL).inputFiles()}
        assert days and min(days) >= since and len(days) <= DEFAULT.recent_daily_days + 1


def test_landed_layer_follows_its_files(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"1")
    one = fingerprint(spark, str(tmp_path))
    (tmp_path / "a.parquet").write_bytes(b"22")
    assert fingerprint(spark, str(tmp_path)) != one == one


def test_staging_first_wins_is_partial_aggregate(spark):
    p = plan_of(spark, "stage_trips")
    assert "partial_min(struct" in p and "Window" not in p


def test_shuffles_widen_with_the_input(spark):
    """More input bytes, more partitions at the start of a shuffle; the caller's own settings stay."""
    tune(spark, 0)
    assert shuffle_width(spark) == 4 and spark.conf.get(INITIAL, None) is None
    tune(spark, 60 * INPUT_PER_PARTITION)
    assert shuffle_width(spark) == 60
    tune(spark, 600 * INPUT_PER_PARTITION)
    assert shuffle_width(spark) == 600
    spark.conf.set(INITIAL, "7")
    tune(spark, 60 * INPUT_PER_PARTITION)
    assert shuffle_width(spark) == 7
    spark.conf.unset(INITIAL)
    tune(spark, 60 * INPUT_PER_PARTITION)
    tune(spark, 0)
    assert shuffle_width(spark) == 4 and spark.conf.get("spark.sql.files.maxPartitionBytes") == "32MB"


def test_writes_by_city_are_not_sorted(spark, tmp_path):
    """A task keeps a file open a city, and does not sort its rows (JSON text) by city first."""
    tune(spark)
    spark.range(40).selectExpr("id % 3 AS city", "id").createOrReplaceTempView("by_city")
    spark.sql(f"CREATE TABLE kept_by_city (id long, city long) USING parquet PARTITIONED BY (city) LOCATION '{tmp_path}/rows'")
    try:
        insert = "INSERT INTO kept_by_city SELECT id, city FROM by_city"
        assert "Sort" not in spark.sql(f"EXPLAIN {insert}").first()[0]
        spark.sql(insert)
        assert sorted(r.id for r in spark.table("kept_by_city").collect()) == list(range(40))
    finally:
        spark.sql("DROP TABLE kept_by_city")


def test_staged_rows_are_dealt_once(spark, tmp_path, monkeypatch):
    """Rows dealt by their key for the first-wins pick go to the bucketed table as they are, a file a bucket at most;
    in a session of another width they are dealt again."""
    rows = spark.createDataFrame([(str(i % 50), "c", i) for i in range(200)], "trip_id string, city string, n int")
    first, frame, dealt = MG.first_per_key(rows, "trip_id", ["n"]), type(rows), []
    orig = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, *a: (dealt.append(a), orig(self, *a))[1])
    for buckets, again in ((shuffle_width(spark), 0), (3, 1)):
        wh = Warehouse(spark, str(tmp_path / f"w{buckets}"), buckets)
        got = wh.stage("stg", first, "trip_id", 1)
        assert sorted((int(r.trip_id), r.n) for r in got.collect()) == [(i, i) for i in range(50)]
        assert len(got.inputFiles()) <= buckets and len(dealt) == again


def test_staged_rows_are_not_sorted_for_the_write(spark, tmp_path):
    """A task keeps a file open a bucket; only the first-wins pick sorts, not the write after it."""
    tune(spark)
    rows = spark.createDataFrame([(str(i), i) for i in range(40)], "trip_id string, n int")
    name = Warehouse(spark, str(tmp_path / "w"), 3)._staging("stg", rows.schema, "trip_id")
    rows.createOrReplaceTempView("unsorted")
    try:
        assert "Sort" not in spark.sql(f"EXPLAIN INSERT INTO {name} PARTITION (load_id = '1') SELECT trip_id, n FROM unsorted").first()[0]
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_staging_moves_no_column_of_the_pickup_time(spark, monkeypatch):
    """What the pickup time decides is not shuffled and sorted with a trip, but made of it again; the rows stay the same."""
    clean, moved, first = workspace(spark, SF_SMALL, DEFAULT).clean, [], MG.first_per_key
    want = sorted(map(tuple, MG.stage_trips(clean).collect()))
    monkeypatch.setattr(MG, "first_per_key", lambda df, *a: (moved.extend(df.columns), first(df, *a))[1])
    got = MG.stage_trips(clean, derived=CL.of_pickup())
    assert "pickup_datetime" in moved and len(set(moved) & set(CL.of_pickup())) == 0 and len(CL.of_pickup()) == 6
    assert got.columns == clean.columns and sorted(map(tuple, got.collect())) == want != []


def test_splits_grow_with_the_input(spark):
    """More input bytes, more splits of a scan, whatever the shuffles' width; the caller's own number stays."""
    tune(spark, 3 * INPUT_PER_PARTITION)
    assert spark.conf.get(SPLITS) == "3"
    tune(spark, 300 * INPUT_PER_PARTITION)
    assert spark.conf.get(SPLITS) == "300"
    tune(spark, 0)
    assert spark.conf.get(SPLITS, None) is None
    spark.conf.set(SPLITS, "5")
    tune(spark, 300 * INPUT_PER_PARTITION)
    assert spark.conf.get(SPLITS) == "5"
    spark.conf.unset(SPLITS)
    tune(spark, 0)
