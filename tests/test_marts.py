"""Marts on hand-made clean trips: ties, pulse score, percentages."""

from datetime import datetime

from tripmetrics.operators import marts as M
from tripmetrics.settings import Params

COLS = ("trip_id string, city string, pickup_datetime timestamp_ntz, pickup_date string, pickup_hour int, pickup_weekday int, "
        "pickup_weekday_name string, pickup_neighborhood string, passenger_count int, "
        "trip_distance_miles double, fare_amount double, tip_amount double, total_amount double, "
        "trip_duration_min double, speed_mph double, is_surge_hour int, is_airport_trip int")


def t(i, hour, nb="A", fare=10.0, tip=1.0, total=11.5, speed=15.0, airport=0, date="2024-01-06", city="X"):
    ts = datetime.strptime(date, "%Y-%m-%d").replace(hour=hour)
    return (f"t{i}", city, ts, date, hour, ts.weekday(), ts.strftime("%A"), nb, 2, 3.0, fare, tip, total, 12.0, speed,
            int(hour in (7, 8, 9, 16, 17, 18, 19)), airport)


def cube(spark, rows):
    return M.trip_cube(spark.createDataFrame(rows, COLS))


def test_hourly_pulse_values(spark):
    rows = [t(1, 8, fare=20.0, tip=4.0, speed=30.0, airport=1), t(2, 8, fare=10.0, tip=0.0, speed=10.0),
            t(3, 3, fare=0.0, tip=0.0, speed=0.0)]
    h = {r["hour"]: r for r in M.hourly_pulse(cube(spark, rows)).collect()}
    r8 = h[8]
    assert r8["trip_count"] == 2 and r8["total_passengers"] == 4
    assert r8["avg_fare"] == 15.0 and r8["tip_rate_pct"] == 13.33
    assert r8["surge_trip_pct"] == 100.0 and r8["airport_pct"] == 50.0
    # 2/500*40 + 15/25*20 + min(20/20*20, 20) + 1*20 = 0.16 + 12 + 20 + 20
    assert r8["pulse_score"] == 52.16
    r3 = h[3]
    assert r3["tip_rate_pct"] == 0.0 and r3["pulse_score"] == 0.08   # zero fare -> tip rate 0, speed 0 -> 0
    assert r3["total_revenue"] == 11.5


def test_daily_ties_take_first_hour_and_name(spark):
    rows = [t(1, 5, nb="B"), t(2, 5, nb="A"), t(3, 9, nb="A"), t(4, 9, nb="B"), t(5, 2, nb="C")]
    d = M.daily_summary(cube(spark, rows)).first()
    assert d["busiest_hour"] == 5      # 5 and 9 tie on 2 trips
    assert d["quietest_hour"] == 2
    assert d["peak_neighborhood"] == "A"  # A and B tie on 2 trips
    assert d["weekend_flag"] == 1 and d["total_trips"] == 5


def test_neighbourhood_rank_min_method(spark):
    rows = [t(1, 1, nb="A"), t(2, 1, nb="A"), t(3, 1, nb="B"), t(4, 1, nb="B"), t(5, 1, nb="C")]
    r = {x["neighborhood"]: x["rank_by_trips"] for x in M.neighborhood_stats(cube(spark, rows)).collect()}
    assert r == {"A": 1, "B": 1, "C": 3}


def test_weekly_trends_window_and_ties(spark):
    rows = [t(1, 4, date="2024-03-20"), t(2, 4, date="2024-03-25"), t(3, 6, date="2024-03-25"),
            t(4, 6, date="2024-03-26"), t(5, 7, date="2024-03-26")]
    c = cube(spark, rows)
    w = M.weekly_trends(M.daily_summary(c), M.hourly_pulse(c), Params(as_of=datetime(2024, 3, 31))).first()
    assert w["week_start"] == "2024-03-24" and w["week_end"] == "2024-03-31"
    assert w["total_trips"] == 4 and w["avg_daily_trips"] == 2.0
    assert w["peak_day"] == "2024-03-25" and w["peak_hour"] == 4
