"""Dimension tables built from the city profiles.

They are small by construction (one row per city / airport / month / hour),
so the joins that use them broadcast them: the size bound is the length of
the list they are built from, checked here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings as S
from .tables import bounded_broadcast, read_table

MAX_DIM_ROWS = 100_000

CITY_SCHEMA = (
    "city string, display_name string, country string, currency string, currency_code string, "
    "timezone string, base_fare double, per_mile_rate double, per_min_rate double, "
    "speed_day_lo double, speed_day_hi double, speed_rush_lo double, speed_rush_hi double, "
    "speed_night_lo double, speed_night_hi double")

# FIXED VALUES of the test fixture: each region stands in for one city
# profile; ANTARCTICA has no trips (FIXTURES.md).
FIXTURE_CITY_PROFILE = {
    "AFRICA": "New York",
    "AMERICA": "London",
    "ASIA": "Chicago",
    "EUROPE": "Paris",
    "MIDDLE EAST": "Sydney",
    "ANTARCTICA": "Mumbai",
}
FIXTURE_DEFAULT_CITY = "AFRICA"
FIXTURE_AIRPORT_NATION_MAX = 5  # nations with n_nationkey < 5 are airports


@dataclass
class Dims:
    city: DataFrame
    airport: DataFrame
    season: DataFrame
    hour_weight: DataFrame
    weekday_mult: DataFrame
    default_city: str


def _small(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    if len(rows) > MAX_DIM_ROWS:
        raise ValueError(f"dimension of {len(rows)} rows is over the broadcast bound")
    return F.broadcast(spark.createDataFrame(rows, schema))


def _city_row(name: str, p: dict, display: str | None = None) -> tuple:
    return (name, display or p["display_name"], p["country"], p["currency"], p["currency_code"],
            p["timezone"], float(p["base_fare"]), float(p["per_mile_rate"]), float(p["per_min_rate"]),
            *[float(v) for band in ("speed_day", "speed_rush", "speed_night") for v in p[band]])


def _common(spark: SparkSession):
    hw = _small(spark, [(h, float(w)) for h, w in S.HOUR_WEIGHTS.items()], "hour int, hour_weight double")
    wm = _small(spark, [(d, float(m)) for d, m in S.WEEKDAY_MULTIPLIERS.items()], "weekday int, weekday_mult double")
    return hw, wm


def profile_dims(spark: SparkSession) -> Dims:
    """Dimensions of the real city profiles."""
    cities = [_city_row(n, p) for n, p in S.CITY_PROFILES.items()]
    airports = [(n, a) for n, p in S.CITY_PROFILES.items() for a in p["airports"]]
    season = [(n, m + 1, float(t)) for n, p in S.CITY_PROFILES.items() for m, t in enumerate(p["seasonal_temps"])]
    hw, wm = _common(spark)
    return Dims(_small(spark, cities, CITY_SCHEMA),
                _small(spark, airports, "city string, neighborhood string"),
                _small(spark, season, "city string, month int, temp_f double"),
                hw, wm, S.DEFAULT_CITY)


def fixture_dims(spark: SparkSession, sf_dir: str) -> Dims:
    """Dimensions of the test fixture: regions take the profiles above and
    the airports are the first nation of each region."""
    cities = [_city_row(c, S.CITY_PROFILES[p], display=c.title()) for c, p in FIXTURE_CITY_PROFILE.items()]
    season = [(c, m + 1, float(t)) for c, p in FIXTURE_CITY_PROFILE.items()
              for m, t in enumerate(S.CITY_PROFILES[p]["seasonal_temps"])]
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"]) \
        .filter(F.col("n_nationkey") < FIXTURE_AIRPORT_NATION_MAX)
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    airport = nation.join(region, nation.n_regionkey == region.r_regionkey) \
        .select(F.col("r_name").alias("city"), F.col("n_name").alias("neighborhood"))
    hw, wm = _common(spark)
    return Dims(_small(spark, cities, CITY_SCHEMA), bounded_broadcast(airport, MAX_DIM_ROWS),
                _small(spark, season, "city string, month int, temp_f double"), hw, wm,
                FIXTURE_DEFAULT_CITY)
