"""Second-level grouping the original does in its web page, as DataFrames.

All inputs are the weekday pattern (city x weekday x hour, at most 168 rows
per city) or the top-hours list, so every window here is bounded by the
size of a day-hour grid, never by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C

HOURS = list(range(24))


def dense_hours(df: DataFrame) -> DataFrame:
    """Every (city, hour 0..23) for the cities present in ``df``."""
    return df.select("city").distinct().select("city", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))


def _densify(df: DataFrame, value_cols: list[str]) -> DataFrame:
    """Left join onto the 24-hour grid; a missing hour reads 0."""
    grid = dense_hours(df)
    out = grid.join(df, ["city", "hour"], "left")
    return out.select("city", "hour", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in value_cols])


def hourly_average(pattern: DataFrame) -> DataFrame:
    """Mean over weekdays of the mean trips, by hour."""
    agg = pattern.groupBy("city", "hour").agg(C.rnd(F.avg(F.coalesce("avg_trips", F.lit(0.0))), 6).alias("avg_trips"))
    return _densify(agg, ["avg_trips"])


def weekday_vs_weekend(pattern: DataFrame) -> DataFrame:
    """Mean trips by hour on weekdays (0-4) and at weekends (5-6)."""
    t = F.coalesce(F.col("avg_trips"), F.lit(0.0))
    agg = pattern.groupBy("city", "hour").agg(
        C.rnd(F.avg(F.when(F.col("day_of_week") <= 4, t)), 6).alias("weekday_avg"),
        C.rnd(F.avg(F.when(F.col("day_of_week") >= 5, t)), 6).alias("weekend_avg"))
    return _densify(agg, ["weekday_avg", "weekend_avg"])


def pulse_by_hour(pattern: DataFrame) -> DataFrame:
    """Mean pulse by hour, with the peak hour(s) marked."""
    agg = pattern.groupBy("city", "hour").agg(
        C.rnd(F.avg(F.coalesce(F.col("avg_pulse"), F.lit(0.0))), 6).alias("avg_pulse"))
    d = _densify(agg, ["avg_pulse"])
    mx = F.max("avg_pulse").over(Window.partitionBy("city"))
    return d.withColumn("is_peak", F.col("avg_pulse") == mx)


def fare_by_hour(pattern: DataFrame) -> DataFrame:
    """Mean fare by hour over rows with a non-zero fare."""
    f = F.col("avg_fare")
    agg = pattern.groupBy("city", "hour").agg(
        C.rnd(F.avg(F.when(f.isNotNull() & (f != 0), f)), 6).alias("avg_fare"))
    return _densify(agg, ["avg_fare"])


def heatmap_pivot(pattern: DataFrame) -> DataFrame:
    """Weekday x 24-hour matrix of mean trips: one row per weekday present,
    columns h0..h23, a missing cell is 0."""
    p = (pattern.groupBy("city", "day_of_week", "day_name")
                .pivot("hour", HOURS)
                .agg(F.max(C.rnd(F.coalesce(F.col("avg_trips"), F.lit(0.0)), 6))))
    return p.select("city", "day_of_week", "day_name",
                    *[F.coalesce(F.col(str(h)), F.lit(0.0)).alias(f"h{h}") for h in HOURS])


def top_hours_share(top: DataFrame) -> DataFrame:
    """Top hours with their position (1..n) and pulse as a share of the
    best hour's (the maximum guarded to 1 when it is 0)."""
    w = Window.partitionBy("city")
    mx = F.max("avg_pulse").over(w)
    mx = F.when(mx.isNull() | (mx == 0), F.lit(1.0)).otherwise(mx)
    pos = F.row_number().over(w.orderBy(F.col("avg_pulse").desc(), F.col("hour")))
    return top.select("city", "hour", "avg_pulse", pos.alias("position"),
                      C.rnd(F.col("avg_pulse") / mx * 100, 1).alias("share_pct"))
