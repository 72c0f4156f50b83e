"""Feed payload decoding and raw landing round trip."""

import json

from tripmetrics.sources import feeds as FD


def test_trip_feed_defaults_and_bad_rows(spark):
    docs = [
        {"tpep_pickup_datetime": "2024-01-01T10:00:00.000", "pulocationid": "132", "passenger_count": "",
         "trip_distance": "3.5", "fare_amount": "12.5", "payment_type": "2"},
        {"tpep_pickup_datetime": "2024-01-01T11:00:00.000", "fare_amount": "n/a"},
        {},
    ]
    landed = spark.createDataFrame([(f"t{i}", "New York", json.dumps(d)) for i, d in enumerate(docs)],
                                   "trip_id string, city string, raw_json string")
    got = {r["trip_id"]: r for r in FD.normalize_trip_feed(landed).collect()}
    assert set(got) == {"t0", "t2"}                      # t1 has an unparseable fare
    assert got["t0"]["passenger_count"] == 1 and got["t0"]["trip_distance_miles"] == 3.5
    assert got["t0"]["dropoff_neighborhood"] == "Unknown" and got["t0"]["payment_type"] == "2"
    assert got["t2"]["payment_type"] == "1" and got["t2"]["pickup_datetime"] == ""
    assert got["t2"]["fare_amount"] == 0.0 and got["t2"]["trip_duration_min"] == 0.0


def test_weather_feed(spark):
    doc = {"main": {"temp": 51.3, "feels_like": 48.0, "humidity": 80}, "wind": {"speed": 7.5},
           "weather": [{"id": 501, "description": "moderate rain"}]}
    landed = spark.createDataFrame([("w1", None, "London", json.dumps(doc))],
                                   "id string, ingested_at timestamp_ntz, city string, raw_json string")
    r = FD.normalize_weather_feed(landed).first()
    assert r["condition"] == "Moderate Rain" and r["is_rain"] == 1 and r["is_snow"] == 0
    assert r["visibility_mi"] == 6.2                     # default 10 km
    assert r["temp_f"] == 51.3 and r["humidity_pct"] == 80


def test_weather_feed_without_entry_and_slashes(spark):
    from tripmetrics.sources.feeds import normalize_weather_feed
    rows = [("a", "2024-01-01", "X", '{"main":{"temp":1.0},"weather":[]}'), ("b", "2024-01-01", "X", '{"weather":[{"id":731,"description":"sand/dust whirls"}]}')]
    got = normalize_weather_feed(spark.createDataFrame(rows, "id string, ingested_at string, city string, raw_json string")).collect()
    assert [(r.weather_id, r.condition) for r in got] == [("b", "Sand/Dust Whirls")]


def _parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json")


def test_a_record_is_parsed_once(spark):
    feed = spark.createDataFrame([("t", "c", "{}", "f", 1)], "trip_id string, city string, raw_json string, file string, load_id int")
    weather = spark.createDataFrame([("w", "2024-01-01", "c", "{}")], "id string, ingested_at string, city string, raw_json string")
    for df in (FD.normalize_trip_feed(feed), FD.replay_trips(feed), FD.quarantined(feed), FD.normalize_weather_feed(weather)):
        assert _parses(df) == 1


def test_no_text_and_no_json(spark):
    rows = [("t0", "c", None), ("t1", "c", "no json"), ("t2", "c", '{"trip_id": "t2", "passenger_count": 2}')]
    landed = spark.createDataFrame(rows, "trip_id string, city string, raw_json string")
    assert [r.trip_id for r in FD.replay_trips(landed.drop("trip_id")).collect()] == ["t2"]
    assert sorted((r.trip_id, r.reason) for r in FD.quarantined(landed).collect()) == [("t0", "no text"), ("t1", "not a record")]
    assert {r.trip_id: r.passenger_count for r in FD.normalize_trip_feed(landed).collect()}["t2"] == 2
