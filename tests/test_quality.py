"""Sequential quality checks on hand-made rows."""

from datetime import datetime

from pyspark.sql import functions as F

from tripmetrics.operators import quality as Q
from tripmetrics.settings import Params

COLS = "city string, pickup_datetime timestamp_ntz, trip_distance_miles double, fare_amount double, " \
       "passenger_count int, trip_duration_min double, payment_type string"
P = Params(as_of=datetime(2024, 3, 31))


def row(city="X", fare=10.0, dist=1.0, pax=1, dur=5.0, ts=datetime(2024, 1, 1, 8), pay="Cash"):
    return (city, ts, dist, fare, pax, dur, pay)


def log(spark, rows):
    df = Q.with_first_fail(spark.createDataFrame(rows, COLS), P)
    return {r["check_name"]: r for r in Q.dq_log(Q.dq_counts(df)).collect()}, df


def test_first_failing_check_wins_and_bases_shrink(spark):
    rows = [row(fare=-1.0, dist=500.0),  # fails fare first (and distance)
            row(dist=500.0),             # fails distance
            row(pax=9), row(dur=None),   # passenger, duration (NULL is out of range)
            row(ts=datetime(2018, 5, 1)), row(), row(fare=0.0)]
    lg, df = log(spark, rows)
    ff = [r[0] for r in df.select("first_fail").collect()]
    assert ff == ["fare_range", "distance_range", "passenger_range", "duration_range", "date_range", None, None]
    assert lg["fare_range"]["actual"] == "1 out of range"
    assert lg["distance_range"]["actual"] == "1 out of range"
    assert lg["date_range"]["status"] == "WARN"
    assert lg["zero_fare"]["actual"] == "1" and lg["zero_fare"]["status"] == "WARN"
    assert lg["completeness"]["actual"] == "28.6%"
    assert lg["completeness"]["status"] == "WARN"
    assert Q.survivors(df, P).count() == 2


def test_warn_fail_threshold_uses_current_base(spark):
    # 100 rows: 4 bad fares -> 4 < 5.0 -> WARN; then 5 bad distances of 96 -> 5 >= 4.8 -> FAIL
    rows = [row(fare=-1.0)] * 4 + [row(dist=-1.0)] * 5 + [row()] * 91
    lg, _ = log(spark, rows)
    assert lg["fare_range"]["status"] == "WARN"
    assert lg["distance_range"]["status"] == "FAIL"
    assert lg["passenger_range"]["status"] == "PASS"
    assert lg["completeness"]["actual"] == "91.0%"


def test_null_checks_and_zero_fare_no_charge(spark):
    rows = [row(fare=0.0, pay="No Charge"), row()]
    lg, _ = log(spark, rows)
    assert lg["zero_fare"]["status"] == "PASS"
    assert lg["null_check_fare_amount"]["status"] == "PASS"
    assert lg["completeness"]["actual"] == "100.0%" and lg["completeness"]["status"] == "PASS"
    assert [lg[k]["check_seq"] for k in ("null_check_pickup_datetime", "completeness")] == [1, 10]


def test_survivors_equal_first_fail_is_null(spark):
    rows = [row(fare=float(i % 7) - 1, pax=i % 8, dur=float(i % 200) if i % 13 else None) for i in range(200)]
    df = Q.with_first_fail(spark.createDataFrame(rows, COLS), P)
    a = Q.survivors(df, P).count()
    b = df.filter(F.col("first_fail").isNull()).count()
    assert a == b
