"""Checks re-aimed from the original's trip and weather simulator.

The simulator's tariff, demand weights, speed bands and seasonal norms
become audits of real records: each is a broadcast join with a small
dimension (bounded by the number of cities / hours / months) and column
arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import columns as C
from ..sources.dims import Dims
from ..sources.tables import small_rows


def _with_city_profile(df: DataFrame, dims: Dims) -> DataFrame:
    """Join the trip's city profile; a city without one takes the default's."""
    rows = small_rows(dims.city.filter(F.col("city") == dims.default_city), 1)
    d = rows[0] if rows else None
    prof = dims.city.drop("display_name", "country", "currency", "currency_code", "timezone")
    cols = [c for c in prof.columns if c != "city"]
    x = df.join(F.broadcast(prof.select("city", *[F.col(c).alias(f"_p_{c}") for c in cols])), "city", "left")
    for c in cols:
        x = x.withColumn(f"p_{c}", F.coalesce(F.col(f"_p_{c}"), F.lit(d[c] if d else None))).drop(f"_p_{c}")
    return x


def expected_fare(clean: DataFrame, dims: Dims) -> DataFrame:
    """Tariff fare (base + miles x rate + minutes x rate, capped at the fare
    limit, at least the base fare) and the residual of the charged fare."""
    x = _with_city_profile(clean, dims)
    raw = F.col("p_base_fare") + F.col("trip_distance_miles") * F.col("p_per_mile_rate") \
        + F.col("trip_duration_min") * F.col("p_per_min_rate")
    capped = C.rnd(F.when(raw > S.MAX_FARE_AMOUNT, F.lit(float(S.MAX_FARE_AMOUNT))).otherwise(raw), 2)
    exp = F.when(capped < F.col("p_base_fare"), F.col("p_base_fare")).otherwise(capped)
    return x.select("trip_id", "city", "fare_amount", exp.alias("expected_fare"),
                    C.rnd(F.col("fare_amount") - exp, 2).alias("fare_residual"))


def demand_weight(clean: DataFrame, dims: Dims) -> DataFrame:
    """Hour weight and weekday multiplier of each trip (defaults 0.5 / 1.0)."""
    x = (clean.join(dims.hour_weight.withColumnRenamed("hour", "pickup_hour"), "pickup_hour", "left")
              .join(dims.weekday_mult.withColumnRenamed("weekday", "pickup_weekday"), "pickup_weekday", "left"))
    hw = F.coalesce(F.col("hour_weight"), F.lit(S.HOUR_WEIGHT_DEFAULT))
    wm = F.coalesce(F.col("weekday_mult"), F.lit(S.WEEKDAY_MULTIPLIER_DEFAULT))
    return x.select("trip_id", "city", "pickup_hour", "pickup_weekday", hw.alias("hour_weight"),
                    wm.alias("weekday_mult"), C.rnd(hw * wm, 4).alias("demand_weight"))


def speed_band(hour) -> F.Column:
    h = C.col(hour)
    return F.when(h.isin(*S.SURGE_HOURS), "rush").when(h.isin(*S.NIGHT_HOURS), "night").otherwise("day")


def speed_band_audit(clean: DataFrame, dims: Dims) -> DataFrame:
    """Trips per city and speed band (rush / night / day) and how many
    travel inside the city's band."""
    x = _with_city_profile(clean, dims).withColumn("band", speed_band("pickup_hour"))
    lo = F.when(F.col("band") == "rush", F.col("p_speed_rush_lo")).when(F.col("band") == "night", F.col("p_speed_night_lo")).otherwise(F.col("p_speed_day_lo"))
    hi = F.when(F.col("band") == "rush", F.col("p_speed_rush_hi")).when(F.col("band") == "night", F.col("p_speed_night_hi")).otherwise(F.col("p_speed_day_hi"))
    inb = F.coalesce((F.col("speed_mph") >= lo) & (F.col("speed_mph") <= hi), F.lit(False))
    return x.groupBy("city", "band").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(inb).alias("in_band"),
        F.count_if(~inb).alias("out_of_band"),
        C.rnd(F.avg("speed_mph"), 6).alias("avg_speed"))


def temp_anomaly(weather: DataFrame, dims: Dims) -> DataFrame:
    """Reading minus the city's normal temperature for the month (65 F when
    there is no norm)."""
    x = weather.withColumn("month", F.month("recorded_at").cast("int")).join(
        dims.season.withColumnRenamed("temp_f", "norm_temp_f"), ["city", "month"], "left")
    norm = F.coalesce(F.col("norm_temp_f"), F.lit(float(S.SEASON_TEMP_DEFAULT)))
    return x.select("weather_id", "city", "month", norm.alias("norm_temp_f"), "temp_f",
                    C.rnd(F.col("temp_f") - norm, 4).alias("temp_anomaly"))


def condition_flags(weather: DataFrame) -> DataFrame:
    """Rain when the condition names rain or drizzle, snow when it names snow."""
    c = F.coalesce(F.col("condition"), F.lit(""))
    return weather.select("weather_id", "city", "condition",
                          (c.contains("Rain") | c.contains("Drizzle")).cast("int").alias("is_rain"),
                          c.contains("Snow").cast("int").alias("is_snow"))
