"""Monthly source: schema drift over months, only the asked folders opened."""

import re

from tripmetrics.session import scratch_path
from tripmetrics.sources import months as MO


def test_months_of_different_columns_read_as_one(spark):
    path = scratch_path(spark, "t-months")
    jan = spark.createDataFrame([("a", "X", 2, 1.5, "old")], "trip_id string, city string, passenger_count int, fare_amount double, gone string")
    feb = spark.createDataFrame([("b", "X", "3", 7), ("c", "Y", "many", 8)], "trip_id string, CITY string, passenger_count string, fare_amount long")
    for m, df in ((1, jan), (2, feb)):
        df.write.parquet(f"{path}/year=2024/month={m}")
    jan.write.parquet(f"{path}/year=2023/month=12")
    assert MO.months(spark, path) == ["2023-12", "2024-01", "2024-02"]
    got = MO.read_months(spark, path, first="2024-01")
    assert got.schema == MO.TRIP_RECORD_SCHEMA
    rows = sorted((r.trip_id, r.city, r.passenger_count, r.fare_amount, r.tip_amount) for r in got.collect())
    assert rows == [("a", "X", 2, 1.5, None), ("b", "X", 3, 7.0, None), ("c", "Y", None, 8.0, None)]
    files = MO.read_months(spark, path, "2024-02", "2024-02").inputFiles()
    assert files and {re.search(r"year=(\d+)/month=(\d+)", f).groups() for f in files} == {("2024", "2")}
    assert MO.read_months(spark, path, first="2025-01").count() == 0 and MO.months(spark, path + "-none") == []
