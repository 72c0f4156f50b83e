"""Per-group top-n: the exact cutoff form equals the plain ranked selection."""

import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tripmetrics.operators import serve as SV


def test_latest_n_per_equals_ranked_selection(spark):
    rnd = random.Random(3)
    base = datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        city = rnd.choice(["A", "A", "A", "B", "C"])          # A is a hot group
        ts = None if rnd.random() < 0.01 else base + timedelta(minutes=rnd.randint(0, 60 * 24 * 5))
        rows.append((city, ts, f"t{i % 2500}", rnd.randint(0, 3)))   # repeated ids and times
    df = spark.createDataFrame(rows, "city string, ts timestamp_ntz, id string, v int")
    order = [F.col("ts").desc_nulls_last(), F.col("id"), F.col("v")]
    limits = spark.createDataFrame([("A", 700), ("B", 5), ("C", 10_000)], "city string, lim int")
    x = df.join(limits, "city")
    got = SV.latest_n_per(x, "city", "ts", order, "lim").drop("lim")
    w = Window.partitionBy("city").orderBy(*order)
    want = x.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= F.col("lim")).drop("rn", "lim")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.filter(F.col("city") == "A").count() == 700


def test_recent_trips_takes_any_limit(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("city"), F.col("id").cast("string").alias("trip_id"),
                                  F.timestamp_add("MINUTE", F.col("id") % 1700, F.lit("2024-03-01").cast("timestamp_ntz")).alias("pickup_datetime"))
    got = {(r.city, r.trip_id) for r in SV.recent_trips(df, 1001).collect()}
    rows = sorted(df.collect(), key=lambda r: (-r.pickup_datetime.timestamp(), r.trip_id))
    assert got == {(r.city, r.trip_id) for c in "ab" for r in [x for x in rows if x.city == c][:1001]}
    top = SV.top_n_per(df, ["city"], [F.col("trip_id").cast("int")], 2000).groupBy("city").count().collect()
    assert {r["city"]: r["count"] for r in top} == {"a": 2000, "b": 1000}
