"""Analytics marts over clean trips, for all cities in one plan.

Plan shape: clean trips are aggregated once at the finest grain the marts
share, (city, date, hour, neighbourhood) - map-side partial aggregation
first, so only partial sums cross the shuffle and a hot key costs no more
than any other.  The hourly, neighbourhood and daily marts are roll-ups of
that small cube; the daily mart needs two roll-ups and takes both in one
GROUPING SETS aggregation, so it too scans the trips once.
Averages are sums / counts of the cube, rounded half-up at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import columns as C
from ..settings import Params

# The cube groups on the date value and weekday number; the date text and
# day name of the marts are formatted on the aggregated rows only.
CUBE_KEYS = ["city", "day", "hour", "day_of_week", "neighborhood"]
SUMS = ["n", "pax", "fare_s", "dist_s", "dur_s", "speed_s", "rev", "tip_s", "surge", "airport"]


def _date(c="day"):
    return F.col(c).cast("string")


def _day_name(c="day_of_week"):
    return F.element_at(F.array(*[F.lit(d) for d in S.DAY_NAMES]), F.col(c) + 1)


def trip_cube(clean: DataFrame, extra_keys: list[str] = ()) -> DataFrame:
    return (clean.groupBy(*extra_keys,
                          F.col("city"), F.col("pickup_datetime").cast("date").alias("day"),
                          F.col("pickup_hour").alias("hour"),
                          F.col("pickup_weekday").alias("day_of_week"),
                          F.col("pickup_neighborhood").alias("neighborhood"))
                 .agg(F.count("trip_id").alias("n"),
                      F.sum("passenger_count").cast("bigint").alias("pax"),
                      F.sum("fare_amount").alias("fare_s"),
                      F.sum("trip_distance_miles").alias("dist_s"),
                      F.sum("trip_duration_min").alias("dur_s"),
                      F.sum("speed_mph").alias("speed_s"),
                      C.money_sum("total_amount").alias("rev"),
                      F.sum("tip_amount").alias("tip_s"),
                      F.sum("is_surge_hour").cast("bigint").alias("surge"),
                      F.sum("is_airport_trip").cast("bigint").alias("airport")))


def _rollup(cube: DataFrame, keys: list[str]) -> DataFrame:
    return cube.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


def hour_level(cube: DataFrame, extra_keys: list[str] = ()) -> DataFrame:
    return _rollup(cube, [*extra_keys, "city", "day", "hour", "day_of_week"])


def hourly_pulse(cube: DataFrame, extra_keys: list[str] = ()) -> DataFrame:
    h = hour_level(cube, extra_keys)
    n = F.col("n")
    avg_fare, avg_speed = F.col("fare_s") / n, F.col("speed_s") / n
    tip_avg = F.col("tip_s") / n
    surge_pct = C.rnd(F.col("surge") / n * 100, 2)
    return h.select(
        *extra_keys, "city", _date().alias("date"), "hour", "day_of_week", _day_name().alias("day_name"),
        n.alias("trip_count"),
        F.col("pax").alias("total_passengers"),
        C.rnd(avg_fare, 4).alias("avg_fare"),
        C.rnd(F.col("dist_s") / n, 4).alias("avg_distance"),
        C.rnd(F.col("dur_s") / n, 4).alias("avg_duration_min"),
        C.rnd(avg_speed, 4).alias("avg_speed_mph"),
        C.rnd(F.col("rev"), 4).alias("total_revenue"),
        F.coalesce(C.rnd(F.when(avg_fare != 0, tip_avg / avg_fare * 100), 2), F.lit(0.0)).alias("tip_rate_pct"),
        surge_pct.alias("surge_trip_pct"),
        C.rnd(F.col("airport") / n * 100, 2).alias("airport_pct"),
        C.rnd(C.pulse_score(n, avg_fare, avg_speed, surge_pct), 4).alias("pulse_score"),
    )


def neighborhood_level(cube: DataFrame, extra_keys: list[str] = ()) -> DataFrame:
    return _rollup(cube, [*extra_keys, "city", "day", "neighborhood"])


def neighborhood_stats(cube: DataFrame, extra_keys: list[str] = ()) -> DataFrame:
    """Per (city, date, pickup neighbourhood); averages unrounded; rank by
    trips within the day, ties share the lowest rank."""
    nb = neighborhood_level(cube, extra_keys)
    w = Window.partitionBy(*extra_keys, "city", "day").orderBy(F.col("n").desc())
    return nb.select(
        *extra_keys, "city", _date().alias("date"), "neighborhood",
        F.col("n").alias("trip_count"),
        (F.col("fare_s") / F.col("n")).alias("avg_fare"),
        F.col("rev").cast("double").alias("total_revenue"),
        (F.col("dist_s") / F.col("n")).alias("avg_distance"),
        F.rank().over(w).cast("int").alias("rank_by_trips"),
    )


def daily_summary(cube: DataFrame, extra_keys: list[str] = ()) -> DataFrame:
    """Per (city, date): totals, 4-dp means, busiest / quietest hour (first
    hour on ties) and peak neighbourhood (first name on ties).

    The hour roll-up and the neighbourhood roll-up of the cube are one
    GROUPING SETS aggregation, so the cube (and the scan under it) is
    computed once; a second small aggregation per day combines them.
    """
    day_keys = [*extra_keys, "city", "day"]
    sets = (cube.groupingSets([[*day_keys, "hour", "day_of_week"], [*day_keys, "neighborhood"]],
                              *day_keys, "hour", "day_of_week", "neighborhood")
                .agg(*[F.sum(c).alias(c) for c in ("n", "pax", "rev", "fare_s", "dist_s", "dur_s")],
                     F.grouping("neighborhood").alias("_hour_set")))
    h = F.col("_hour_set") == 1
    nb = ~h
    days = sets.groupBy(*day_keys).agg(
        *[F.sum(F.when(h, F.col(c))).alias(c) for c in ("n", "pax", "rev", "fare_s", "dist_s", "dur_s")],
        F.max_by(F.when(h, F.col("hour")), F.when(h, F.struct(F.col("n"), -F.col("hour")))).alias("busiest_hour"),
        F.min_by(F.when(h, F.col("hour")), F.when(h, F.struct(F.col("n"), F.col("hour")))).alias("quietest_hour"),
        F.min_by(F.when(nb, F.col("neighborhood")),
                 F.when(nb, F.struct(-F.col("n"), F.col("neighborhood")))).alias("peak_neighborhood"),
        F.max(F.when(h, F.col("day_of_week"))).alias("dow"))
    n = F.col("n")
    return days.select(
        *extra_keys, "city", _date().alias("date"),
        n.alias("total_trips"),
        F.col("pax").alias("total_passengers"),
        C.rnd(F.col("rev"), 4).alias("total_revenue"),
        C.rnd(F.col("fare_s") / n, 4).alias("avg_fare"),
        C.rnd(F.col("dist_s") / n, 4).alias("avg_distance"),
        C.rnd(F.col("dur_s") / n, 4).alias("avg_duration_min"),
        F.col("busiest_hour").cast("int").alias("busiest_hour"),
        F.col("quietest_hour").cast("int").alias("quietest_hour"),
        "peak_neighborhood",
        F.col("dow").isin(5, 6).cast("int").alias("weekend_flag"),
    )


def hour_counts(cube: DataFrame) -> DataFrame:
    return hour_level(cube).select("city", _date().alias("date"), "hour", F.col("n").alias("trip_count"))


def week_start(params: Params) -> str:
    from datetime import timedelta
    return (params.as_of - timedelta(days=params.rollup_days)).strftime("%Y-%m-%d")


def weekly_trends(daily: DataFrame, hourly: DataFrame, params: Params, extra_keys: list[str] = ()) -> DataFrame:
    """Trailing-week roll-up per city: dates >= as_of - 7 days (no upper
    bound).  Top day and top (date, hour) by trips, earliest on ties."""
    ws = week_start(params)
    keys = [*extra_keys, "city"]
    d = daily.filter(F.col("date") >= ws).groupBy(*keys).agg(
        F.sum("total_trips").alias("total_trips"),
        C.money_sum("total_revenue").alias("total_revenue"),
        F.avg("total_trips").alias("avg_daily_trips"),
        F.min_by("date", F.struct(-F.col("total_trips"), F.col("date"))).alias("peak_day"))
    h = hourly.filter(F.col("date") >= ws).groupBy(*keys).agg(
        F.min_by("hour", F.struct(-F.col("trip_count"), F.col("date"), F.col("hour"))).alias("peak_hour"))
    return d.join(h, keys, "left").select(
        *keys, F.lit(ws).alias("week_start"), F.lit(params.as_of_date).alias("week_end"),
        F.col("total_trips").cast("bigint").alias("total_trips"),
        F.col("total_revenue").cast("double").alias("total_revenue"),
        C.rnd("avg_daily_trips", 6).alias("avg_daily_trips"),
        "peak_day", F.col("peak_hour").cast("int").alias("peak_hour"))


def weekly_after_loads(daily: DataFrame, hourly: DataFrame, params: Params, load: str = "batch_id") -> DataFrame:
    """The weekly mart after a roll-up behind every load, from the loads' own
    daily and hourly marts (any number of loads, none repeated).

    A city's row first appears with its first load that has days in the
    window; what the merge keeps from then (week end, daily mean, peaks) is
    that load's roll-up, and what it replaces (totals) is the last roll-up,
    over all loads."""
    kept = ["week_end", "avg_daily_trips", "peak_day", "peak_hour"]
    each = weekly_trends(daily, hourly, params, [load]).groupBy("city", "week_start").agg(
        F.min_by(F.struct(*kept), F.col(load)).alias("f"), F.sum("total_trips").cast("bigint").alias("total_trips"),
        C.money_sum("total_revenue").cast("double").alias("total_revenue"))
    return each.select("city", "week_start", "f.week_end", "total_trips", "total_revenue", *[f"f.{c}" for c in kept[1:]])


def weather_keys(weather: DataFrame) -> DataFrame:
    return weather.withColumn("date", C.date_text("recorded_at")).withColumn("hour", C.hour_of("recorded_at"))


WEATHER_FIELDS = ["temp_f", "condition", "is_rain", "is_snow", "wind_speed_mph"]


def weather_join(hourly: DataFrame, weather: DataFrame, params: Params) -> DataFrame:
    """Hourly pulse of the trailing week LEFT JOIN every weather reading of
    the same city, date and hour (fans out on several readings)."""
    ws = week_start(params)
    p = hourly.filter(F.col("date") >= ws).select("city", "date", "hour", "trip_count", "avg_fare")
    weather = weather.filter(F.col("recorded_at") >= F.lit(f"{ws} 00:00:00").cast("timestamp_ntz"))   # reaches the scan
    w = weather_keys(weather).select("city", "date", "hour", "weather_id", *WEATHER_FIELDS)
    return p.join(w, ["city", "date", "hour"], "left")


def latest_readings(weather: DataFrame) -> DataFrame:
    """(city, date, hour, reading): the reading with the greatest recorded_at,
    then id, so that loads merge by taking the greater one."""
    reading = F.struct("recorded_at", "weather_id", *WEATHER_FIELDS)
    return weather_keys(weather).groupBy("city", "date", "hour").agg(F.max(reading).alias("reading"))


def impact(hourly: DataFrame, readings: DataFrame) -> DataFrame:
    """Hourly pulse with the hour's latest reading, if there is one: 1:1."""
    return hourly.select("city", "date", "hour", "trip_count", "avg_fare").join(
        readings.select("city", "date", "hour", *WEATHER_FIELDS), ["city", "date", "hour"], "left")


def weather_impact(hourly: DataFrame, weather: DataFrame, params: Params) -> DataFrame:
    """Weather-impact mart: like ``weather_join`` but one row per (city, date,
    hour) - the latest reading wins (greatest recorded_at, then id).  The
    readings are reduced per hour before the join, so the join is 1:1."""
    ws = week_start(params)
    latest = latest_readings(weather).filter(F.col("date") >= ws).select("city", "date", "hour", "reading.*")
    return impact(hourly.filter(F.col("date") >= ws), latest)
