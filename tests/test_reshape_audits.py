"""Page reshaping (densify, pivot, shares) and re-aimed audits on hand-made rows."""

from pyspark.sql import functions as F

from tripmetrics.operators import audits as AU
from tripmetrics.operators import reshape as RS

PAT = "city string, day_of_week int, day_name string, hour int, avg_trips double, avg_pulse double, avg_fare double"


def pattern(spark):
    return spark.createDataFrame([
        ("X", 0, "Monday", 8, 10.0, 50.0, 12.0),
        ("X", 5, "Saturday", 8, 4.0, 30.0, 0.0),
        ("X", 1, "Tuesday", 23, None, 10.0, None),
    ], PAT)


def test_densify_and_weekday_split(spark):
    ha = {r["hour"]: r["avg_trips"] for r in RS.hourly_average(pattern(spark)).collect()}
    assert len(ha) == 24 and ha[8] == 7.0 and ha[23] == 0.0 and ha[0] == 0.0
    ww = {r["hour"]: (r["weekday_avg"], r["weekend_avg"]) for r in RS.weekday_vs_weekend(pattern(spark)).collect()}
    assert ww[8] == (10.0, 4.0) and ww[23] == (0.0, 0.0)
    fb = {r["hour"]: r["avg_fare"] for r in RS.fare_by_hour(pattern(spark)).collect()}
    assert fb[8] == 12.0 and fb[23] == 0.0            # zero / missing fares left out
    pk = [r["hour"] for r in RS.pulse_by_hour(pattern(spark)).collect() if r["is_peak"]]
    assert pk == [8]


def test_heatmap_pivot(spark):
    rows = {r["day_name"]: r for r in RS.heatmap_pivot(pattern(spark)).collect()}
    assert set(rows) == {"Monday", "Saturday", "Tuesday"}    # only days present
    assert rows["Monday"]["h8"] == 10.0 and rows["Monday"]["h9"] == 0.0 and rows["Tuesday"]["h23"] == 0.0


def test_top_hours_share(spark):
    top = spark.createDataFrame([("X", 8, 50.0), ("X", 9, 25.0), ("Y", 1, 0.0)], "city string, hour int, avg_pulse double")
    r = {(x["city"], x["hour"]): (x["position"], x["share_pct"]) for x in RS.top_hours_share(top).collect()}
    assert r[("X", 8)] == (1, 100.0) and r[("X", 9)] == (2, 50.0) and r[("Y", 1)] == (1, 0.0)


def test_expected_fare_and_bands(spark, dims):
    clean = spark.createDataFrame(
        [("t1", "New York", 20.0, 4.0, 10.0, 8, 12.0), ("t2", "Atlantis", 1.0, 0.0, 0.0, 2, 50.0)],
        "trip_id string, city string, fare_amount double, trip_distance_miles double, "
        "trip_duration_min double, pickup_hour int, speed_mph double")
    ef = {r["trip_id"]: r for r in AU.expected_fare(clean, dims).collect()}
    assert ef["t1"]["expected_fare"] == 16.5 and ef["t1"]["fare_residual"] == 3.5   # 3 + 4*2.5 + 10*0.35
    assert ef["t2"]["expected_fare"] == 3.0                                          # default city's base fare
    sb = {(r["city"], r["band"]): r for r in AU.speed_band_audit(clean, dims).collect()}
    assert sb[("New York", "rush")]["in_band"] == 1                                 # 12 in (8, 18)
    assert sb[("Atlantis", "night")]["out_of_band"] == 1                            # 50 above (20, 35)


def test_condition_flags(spark):
    w = spark.createDataFrame([("a", "Light Rain"), ("b", "Drizzle"), ("c", "Light Snow"), ("d", None)],
                              "weather_id string, condition string").withColumn("city", F.lit("X"))
    got = {r["weather_id"]: (r["is_rain"], r["is_snow"]) for r in AU.condition_flags(w).collect()}
    assert got == {"a": (1, 0), "b": (1, 0), "c": (0, 1), "d": (0, 0)}
