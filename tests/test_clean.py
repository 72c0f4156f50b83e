"""Trip enrichment steps on hand-made rows."""

from datetime import datetime

from pyspark.sql import functions as F

from tripmetrics.functions import columns as C
from tripmetrics.operators import clean as CL

SCHEMA = ("trip_id string, city string, pickup_datetime string, dropoff_datetime string, "
          "pickup_neighborhood string, dropoff_neighborhood string, passenger_count string, "
          "trip_distance_miles string, fare_amount string, tip_amount string, total_amount string, "
          "payment_type string, trip_duration_min string, speed_mph string")


def trip(i, **kw):
    base = dict(trip_id=f"t{i}", city="New York", pickup_datetime="2024-01-01T08:00:00",
                dropoff_datetime="2024-01-01T08:30:00", pickup_neighborhood="Midtown",
                dropoff_neighborhood="SoHo", passenger_count="1", trip_distance_miles="5",
                fare_amount="20", tip_amount="2", total_amount="23", payment_type="1",
                trip_duration_min="0", speed_mph="0")
    base.update(kw)
    return tuple(base[k] for k in base)


def enrich(spark, dims, rows):
    return {r["trip_id"]: r for r in CL.enrich_trips(spark.createDataFrame(rows, SCHEMA), dims).collect()}


def test_extract_parse_and_derive(spark, dims):
    rows = [trip(1), trip(2, dropoff_datetime=None), trip(3, pickup_datetime="bad"),
            trip(4, fare_amount="n/a", passenger_count=""), trip(5, trip_duration_min="12", speed_mph="95"),
            trip(6, trip_distance_miles="1", trip_duration_min="0", dropoff_datetime="2024-01-01T08:03:00")]
    r = enrich(spark, dims, rows)
    assert "t3" not in r                                  # unparseable pickup dropped
    assert r["t1"]["trip_duration_min"] == 30.0 and r["t1"]["speed_mph"] == 10.0
    assert r["t2"]["trip_duration_min"] is None and r["t2"]["speed_mph"] == 0.0
    assert r["t4"]["fare_amount"] == 0.0 and r["t4"]["passenger_count"] == 1
    assert r["t5"]["speed_mph"] == 80.0                   # clipped
    assert r["t6"]["speed_mph"] == 20.0                   # 1 mile in 3 minutes
    assert r["t1"]["pickup_hour"] == 8 and r["t1"]["pickup_weekday"] == 0
    assert r["t1"]["pickup_weekday_name"] == "Monday" and r["t1"]["pickup_date"] == "2024-01-01"
    assert r["t1"]["is_surge_hour"] == 1 and r["t1"]["is_weekend"] == 0


def test_payment_neighbourhood_airport(spark, dims):
    rows = [trip(1, payment_type="3"), trip(2, payment_type="5"), trip(3, payment_type=None),
            trip(4, pickup_neighborhood=None, dropoff_neighborhood="JFK Airport"),
            trip(5, city="Atlantis", pickup_neighborhood="LaGuardia Airport"),
            trip(6, city="London", dropoff_neighborhood="JFK Airport")]
    r = enrich(spark, dims, rows)
    assert r["t1"]["payment_type"] == "No Charge"
    assert r["t2"]["payment_type"] == "5"
    assert r["t3"]["payment_type"] == "None"
    assert r["t4"]["pickup_neighborhood"] == "Unknown" and r["t4"]["is_airport_trip"] == 1
    assert r["t5"]["is_airport_trip"] == 1                 # unknown city: default city's airports
    assert r["t6"]["is_airport_trip"] == 0                 # another city's airport


def test_clip_keeps_null_and_rounding_half_up(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (100.0,), (2.675,), (1.005,)], "x double")
    got = [r[0] for r in df.select(C.clip("x", 0.0, 80.0)).collect()]
    assert got == [None, 0.0, 80.0, 2.675, 1.005]
    assert [r[0] for r in df.select(C.rnd("x", 2)).collect()][3:] == [2.68, 1.01]


def test_surrogate_id_unique(spark):
    df = spark.createDataFrame([("a", 1.0)] * 5 + [("b", 2.0)], "city string, fare double")
    ids = CL.with_trip_id(df)
    assert ids.select(F.countDistinct("trip_id")).first()[0] == 6


def test_day_name_each_weekday(spark):
    days = [datetime(2024, 1, d) for d in range(1, 8)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    got = df.select(C.weekday_of("ts"), C.day_name_of("ts")).collect()
    assert [tuple(r) for r in got] == list(enumerate(
        ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]))


def test_text_is_zone_free(spark):
    """Wall-clock text and calendar parts do not move under a session zone
    with a daylight-saving gap."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 5, 120000),)], "ts timestamp_ntz")
        r = df.select(C.ts_text("ts"), C.date_text("ts"), C.hour_of("ts"), C.day_name_of("ts")).first()
        assert tuple(r) == ("2024-03-10 02:30:05.120000", "2024-03-10", 2, "Sunday")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_nan_text_is_no_number(spark):
    from tripmetrics.operators.clean import extract_trips, extract_weather
    raw = spark.createDataFrame([("NaN", "nan", "NaN"), ("2.5", "x", "3")], "fare_amount string, speed_mph string, passenger_count string")
    assert [tuple(r) for r in extract_trips(raw).select("fare_amount", "speed_mph", "passenger_count").collect()] == [(0.0, 0.0, 1), (2.5, 0.0, 3)]
    assert extract_weather(spark.createDataFrame([("NaN",)], "temp_f string")).first().temp_f is None


def test_surrogate_ids_depend_on_content_alone(spark):
    rows = spark.range(500).select(F.concat(F.lit("c"), F.col("id") % 7).alias("city"), F.col("id").cast("double").alias("fare_amount"),
                                   F.when(F.col("id") % 3 == 0, F.lit("")).alias("payment_type"), F.lit(1).alias("batch_id"))
    rows = rows.unionByName(rows.filter("fare_amount < 100"))
    ids = CL.with_trip_id(rows.repartition(3)).select("trip_id")
    again = CL.with_trip_id(rows.withColumn("batch_id", F.lit(2)).repartition(11, "fare_amount")).select("trip_id")
    assert ids.distinct().count() == 600 and ids.exceptAll(again).count() == 0


def test_surrogate_ids_are_of_the_record_as_it_came(spark, dims):
    """What enrichment derives (surge hours, clips, defaults) is no part of an id."""
    from tripmetrics.operators import clean as CL
    rows = [("New York", "2024-03-01 08:00:00", "2024-03-01 08:10:00", "a", "b", "1", "2.5", "10", "0", "11", "1", "0", "900")]
    raw = spark.createDataFrame(rows, "city string, pickup_datetime string, dropoff_datetime string, pickup_neighborhood string, dropoff_neighborhood string, "
                                      "passenger_count string, trip_distance_miles string, fare_amount string, tip_amount string, total_amount string, "
                                      "payment_type string, trip_duration_min string, speed_mph string")
    want = CL.with_trip_id(raw).first().trip_id
    assert CL.enrich_trips(raw, dims).first().trip_id == want


def test_ts_text_digits_and_cost(spark):
    """Six digits of the fraction, whatever the cast leaves out; no pattern is parsed for each row."""
    rows = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 1), datetime(2024, 12, 31, 23, 59, 59, 999999),
            datetime(33, 1, 2, 0, 0, 0, 500000), datetime(9999, 12, 31, 10, 0, 0, 120)]
    df = spark.createDataFrame([(d,) for d in rows] + [(None,)], "ts timestamp_ntz").select(C.ts_text("ts").alias("t"))
    assert [r.t for r in df.collect()] == [f"{d.year:04d}-{d:%m-%d %H:%M:%S.%f}" for d in rows] + [None]
    assert "format_string" not in df._jdf.queryExecution().optimizedPlan().toString()
