"""Query keys: raw feeds, per-step cleaning, audits, staging
(A2-A9, B1-B14, B21-B25, M1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import settings as S
from ..functions import columns as C
from ..operators import audits as AU
from ..operators import clean as CL
from ..sources import adapters as A
from ..session import scratch_path
from ..sources import feeds as FD
from ..sources import months as MO
from .catalog import register
from .oracle import R, TS, _values, cols_sql, q, with_base
from .workspace import land

# -- raw text inputs ----------------------------------------------------------

DIRTY = """
, dirty AS (
  SELECT trip_id, city,
    CASE WHEN l_orderkey % 227 = 0 THEN 'bad' ELSE CAST(pickup_datetime AS VARCHAR) END AS pickup_datetime,
    CAST(dropoff_datetime AS VARCHAR) AS dropoff_datetime, pickup_neighborhood, dropoff_neighborhood,
    CASE WHEN l_partkey % 223 = 0 THEN '' ELSE CAST(passenger_count AS VARCHAR) END AS passenger_count,
    CAST(trip_distance_miles AS VARCHAR) AS trip_distance_miles,
    CASE WHEN l_partkey % 211 = 0 THEN 'n/a' ELSE CAST(fare_amount AS VARCHAR) END AS fare_amount,
    CAST(tip_amount AS VARCHAR) AS tip_amount, CAST(total_amount AS VARCHAR) AS total_amount,
    CASE WHEN l_partkey % 229 = 0 THEN NULL ELSE payment_type END AS payment_type,
    CAST(trip_duration_min AS VARCHAR) AS trip_duration_min, CAST(speed_mph AS VARCHAR) AS speed_mph, batch_id
  FROM raw_trips),
extracted AS (
  SELECT trip_id, city, pickup_datetime, dropoff_datetime, pickup_neighborhood, dropoff_neighborhood,
    coalesce(TRY_CAST(TRY_CAST(passenger_count AS DOUBLE) AS INT), 1) AS passenger_count,
    coalesce(TRY_CAST(trip_distance_miles AS DOUBLE), 0.0E0) AS trip_distance_miles,
    coalesce(TRY_CAST(fare_amount AS DOUBLE), 0.0E0) AS fare_amount,
    coalesce(TRY_CAST(tip_amount AS DOUBLE), 0.0E0) AS tip_amount,
    coalesce(TRY_CAST(total_amount AS DOUBLE), 0.0E0) AS total_amount, payment_type,
    coalesce(TRY_CAST(trip_duration_min AS DOUBLE), 0.0E0) AS trip_duration_min,
    coalesce(TRY_CAST(speed_mph AS DOUBLE), 0.0E0) AS speed_mph, batch_id
  FROM dirty)
"""


def dirty(ws):
    """The raw-text feed of the fixture, landed once like the typed trips."""
    return land(ws.spark, ws.sf_dir, "dirty-trips", A.dirty_trips_from_tables)


@register("extract_trips", lambda p: with_base(p, DIRTY + """
SELECT trip_id, city, passenger_count, trip_distance_miles, fare_amount, tip_amount, total_amount,
  trip_duration_min, speed_mph FROM extracted"""))
def extract_trips(ws):
    return CL.extract_trips(dirty(ws), ws.dims.default_city).select(
        "trip_id", "city", "passenger_count", *CL.NUMERIC_TRIP_COLUMNS)


@register("parse_times", lambda p: with_base(p, DIRTY + f"""
SELECT trip_id, city, {TS('TRY_CAST(pickup_datetime AS TIMESTAMP)')} AS pickup_datetime,
  {TS('TRY_CAST(dropoff_datetime AS TIMESTAMP)')} AS dropoff_datetime
FROM extracted WHERE TRY_CAST(pickup_datetime AS TIMESTAMP) IS NOT NULL"""))
def parse_times(ws):
    return CL.parse_times(CL.extract_trips(dirty(ws))).select("trip_id", "city", "pickup_datetime", "dropoff_datetime")


@register("decode_payment", lambda p: with_base(p, DIRTY + f"""
SELECT trip_id, payment_type AS payment_code,
  coalesce(CASE payment_type {' '.join(f'WHEN {q(k)} THEN {q(v)}' for k, v in S.PAYMENT_NAMES.items())} END, payment_type, 'None') AS payment_type
FROM dirty"""))
def decode_payment(ws):
    d = dirty(ws)
    return d.select("trip_id", F.col("payment_type").alias("payment_code"), C.decode_payment("payment_type").alias("payment_type"))


@register("extract_weather", lambda p: with_base(p, """
SELECT weather_id, city, temp_f, feels_like_f, CAST(humidity_pct AS DOUBLE) AS humidity_pct, wind_speed_mph, visibility_mi
FROM weather"""))
def extract_weather(ws):
    text = ws.raw_weather.select(*[F.col(c).cast("string").alias(c) if c in CL.NUMERIC_WEATHER_COLUMNS else F.col(c)
                                   for c in ws.raw_weather.columns])
    return CL.extract_weather(text).select("weather_id", "city", *CL.NUMERIC_WEATHER_COLUMNS)


def _feed_sql(p):
    num = lambda c, d, t: f"CASE WHEN {c} IS NULL OR {c} = '' THEN CAST({d} AS {t}) ELSE TRY_CAST({c} AS {t}) END"
    return DIRTY + f"""
, feed AS (SELECT trip_id, city, coalesce(pickup_datetime, '') AS pickup_datetime, coalesce(dropoff_datetime, '') AS dropoff_datetime,
    coalesce(pickup_neighborhood, 'Unknown') AS pickup_neighborhood, coalesce(dropoff_neighborhood, 'Unknown') AS dropoff_neighborhood,
    {num('passenger_count', 1, 'INT')} AS passenger_count, {num('trip_distance_miles', 0, 'DOUBLE')} AS trip_distance_miles,
    {num('fare_amount', 0, 'DOUBLE')} AS fare_amount, {num('tip_amount', 0, 'DOUBLE')} AS tip_amount,
    {num('total_amount', 0, 'DOUBLE')} AS total_amount, coalesce(payment_type, '1') AS payment_type,
    0.0E0 AS trip_duration_min, 0.0E0 AS speed_mph, batch_id
  FROM dirty),
feed_ok AS (SELECT * FROM feed WHERE passenger_count IS NOT NULL AND trip_distance_miles IS NOT NULL
    AND fare_amount IS NOT NULL AND tip_amount IS NOT NULL AND total_amount IS NOT NULL)
"""


FEED_COLS = ["trip_id", "city", "pickup_datetime", "dropoff_datetime", "pickup_neighborhood", "dropoff_neighborhood",
             "passenger_count", "trip_distance_miles", "fare_amount", "tip_amount", "total_amount", "payment_type",
             "trip_duration_min", "speed_mph"]


def _feed(ws):
    return FD.normalize_trip_feed(FD.trip_feed_payload(dirty(ws)))


@register("normalize_trip_json", lambda p: with_base(p, _feed_sql(p) + f"SELECT {', '.join(FEED_COLS)} FROM feed_ok"))
def normalize_trip_json(ws):
    return _feed(ws)


def _title(x):
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


@register("normalize_weather_json", lambda p: with_base(p, f"""
SELECT weather_id, {TS('recorded_at')} AS recorded_at, city, temp_f, feels_like_f, humidity_pct, wind_speed_mph,
  {_title('condition')} AS condition, condition_code,
  {R(R(f'visibility_mi * {S.METRES_PER_MILE}', 0) + f' / {S.METRES_PER_MILE}', 1)} AS visibility_mi,
  CAST(condition_code >= {S.RAIN_CODES[0]} AND condition_code < {S.RAIN_CODES[1]} AS INT) AS is_rain,
  CAST(condition_code >= {S.SNOW_CODES[0]} AND condition_code < {S.SNOW_CODES[1]} AS INT) AS is_snow
FROM weather"""))
def normalize_weather_json(ws):
    return FD.normalize_weather_feed(FD.weather_feed_payload(ws.raw_weather))


def _landed(ws, name):
    return FD.landed_files(ws.spark, f"{ws.stored.base}/{name}")


@register("raw_land", lambda p: with_base(p, """
SELECT city, 'trips' AS layer, 'synthetic' AS source, count(*) AS n_rows, count(*) AS n_records, TRUE AS traced,
  CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM raw_trips GROUP BY city
UNION ALL SELECT city, 'weather', 'weather', count(*), count(*), TRUE, CAST(sum(CAST(temp_f AS DECIMAL(18,2))) AS DOUBLE) FROM weather GROUP BY city"""))
def raw_land(ws):
    """What the job landed, read back from its JSON: rows, rows that are
    records, and a sum over a field of them."""
    n = F.count(F.lit(1)).alias("n_rows")
    traced = F.bool_and(F.col("ingested_at").isNotNull() & F.col("file").contains("load_id=")).alias("traced")
    t = _landed(ws, "raw_trips")
    good = FD.replay_trips(t).groupBy("city").agg(F.count(F.lit(1)).alias("n_records"), C.money_sum("total_amount").cast("double").alias("amount"))
    t = t.groupBy("city", "source").agg(n, traced).join(good, "city").select("city", F.lit("trips").alias("layer"), "source", "n_rows", "n_records", "traced", "amount")
    temp = F.get_json_object("raw_json", "$.temp_f").cast("decimal(18,2)")
    w = _landed(ws, "raw_weather").groupBy("city").agg(n, F.count(temp).alias("n_records"), traced, F.sum(temp).cast("double").alias("amount"))
    return t.unionByName(w.select("city", F.lit("weather").alias("layer"), F.lit("weather").alias("source"), "n_rows", "n_records", "traced", "amount"))


@register("raw_replay", lambda p: with_base(p, f"SELECT {cols_sql(A.TRIP_COLUMNS)} FROM raw_trips"))
def raw_replay(ws):
    return FD.replay_trips(_landed(ws, "raw_trips")).select(*A.TRIP_COLUMNS)


@register("scan_months", lambda p: with_base(p, "SELECT " + cols_sql(A.TRIP_COLUMNS).replace(
    "tip_amount", "CASE WHEN month(pickup_datetime) <> 2 THEN tip_amount END AS tip_amount") + " FROM raw_trips WHERE pickup_datetime >= TIMESTAMP '2024-02-01'"))
def scan_months(ws):
    """Monthly trip files from February on; February's lack the tips, March's hold counts as text."""
    path = scratch_path(ws.spark, "months")
    t = ws.raw_trips
    for m, month in ((1, t), (2, t.drop("tip_amount")), (3, t.withColumn("passenger_count", F.col("passenger_count").cast("string")))):
        MO.write_months(month.where(F.month("pickup_datetime") == m), path)
    return MO.read_months(ws.spark, path, first="2024-02").select(*A.TRIP_COLUMNS)


# -- dimensions ---------------------------------------------------------------

@register("dim_tables", lambda p: with_base(p, f"""
SELECT d.city, d.display_name, d.country, d.currency, d.base_fare, d.per_mile_rate, d.per_min_rate, d.speed_day_lo, d.speed_rush_hi, d.speed_night_hi,
  a.airport FROM dim_city d LEFT JOIN (SELECT city, neighborhood AS airport FROM airports) a ON a.city = d.city"""))
def dim_tables(ws):
    """Cities with their tariffs, speed bands and airports."""
    cols = ["city", "display_name", "country", "currency", "base_fare", "per_mile_rate", "per_min_rate", "speed_day_lo", "speed_rush_hi", "speed_night_hi"]
    return ws.dims.city.select(*cols).join(ws.dims.airport.withColumnRenamed("neighborhood", "airport"), "city", "left")


# -- per-step enrichment (before the quality checks) --------------------------

@register("calendar_parts", lambda p: with_base(p, """
SELECT trip_id, city, pickup_hour, pickup_weekday, pickup_weekday_name, pickup_date FROM enriched"""))
def calendar_parts(ws):
    return ws.enriched.select("trip_id", "city", "pickup_hour", "pickup_weekday", "pickup_weekday_name", "pickup_date")


@register("derive_duration", lambda p: with_base(p, "SELECT trip_id, city, trip_duration_min FROM enriched"))
def derive_duration(ws):
    return ws.enriched.select("trip_id", "city", "trip_duration_min")


@register("derive_speed", lambda p: with_base(p, "SELECT trip_id, city, speed_mph FROM enriched"))
def derive_speed(ws):
    return ws.enriched.select("trip_id", "city", "speed_mph")


@register("trip_flags", lambda p: with_base(p, "SELECT trip_id, city, is_surge_hour, is_weekend, is_airport_trip FROM enriched"))
def trip_flags(ws):
    return ws.enriched.select("trip_id", "city", "is_surge_hour", "is_weekend", "is_airport_trip")


@register("fill_neighborhood", lambda p: with_base(p, "SELECT trip_id, city, pickup_neighborhood, dropoff_neighborhood FROM enriched"))
def fill_neighborhood(ws):
    return ws.enriched.select("trip_id", "city", "pickup_neighborhood", "dropoff_neighborhood")


RECORD = ", ".join(c for c in A.TRIP_COLUMNS if c not in ("trip_id", "batch_id"))


@register("surrogate_id", lambda p: with_base(p, f"""
, content AS (SELECT {RECORD}, row_number() OVER (
  PARTITION BY {RECORD}, batch_id) AS nth FROM raw_trips)
SELECT city, n_rows, n_ids FROM (SELECT city, count(*) AS n_rows FROM content GROUP BY city)
JOIN (SELECT city, count(*) AS n_ids FROM (SELECT DISTINCT * FROM content) GROUP BY city) USING (city)"""))
def surrogate_id(ws):
    ided = CL.with_trip_id(ws.raw_trips.drop("trip_id"))
    return ided.groupBy("city").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("trip_id").alias("n_ids"))


# -- staging ------------------------------------------------------------------

@register("stage_trips", lambda p: with_base(p, f"SELECT {cols_sql(CL.KEEP_COLUMNS)}, batch_id FROM staged"))
def stage_trips(ws):
    return ws.staged


@register("stage_weather", lambda p: with_base(p, "SELECT " + cols_sql(A.WEATHER_COLUMNS).replace(
    "humidity_pct", "CAST(humidity_pct AS DOUBLE) AS humidity_pct", 1) + " FROM staged_weather"))
def stage_weather(ws):
    return ws.staged_weather


# -- simulator re-aims ----------------------------------------------------------

@register("expected_fare", lambda p: with_base(p, f"""
, ef0 AS (SELECT c.trip_id, c.city, c.fare_amount, d.base_fare,
    d.base_fare + c.trip_distance_miles * d.per_mile_rate + c.trip_duration_min * d.per_min_rate AS r
  FROM clean c JOIN dim_city d ON d.city = c.city),
ef AS (SELECT *, {R(f'CASE WHEN r > {S.MAX_FARE_AMOUNT} THEN {float(S.MAX_FARE_AMOUNT)}E0 ELSE r END', 2)} AS capped FROM ef0)
SELECT trip_id, city, fare_amount, CASE WHEN capped < base_fare THEN base_fare ELSE capped END AS expected_fare,
  {R('fare_amount - CASE WHEN capped < base_fare THEN base_fare ELSE capped END', 2)} AS fare_residual FROM ef"""))
def expected_fare(ws):
    return AU.expected_fare(ws.clean, ws.dims)


def _weights_sql():
    hw = _values([(h, float(w)) for h, w in S.HOUR_WEIGHTS.items()], ["hour", "hour_weight"])
    wm = _values([(d, float(m)) for d, m in S.WEEKDAY_MULTIPLIERS.items()], ["weekday", "weekday_mult"])
    return f", hw AS (SELECT * FROM {hw}), wm AS (SELECT * FROM {wm})\n"


@register("demand_weight", lambda p: with_base(p, _weights_sql() + f"""
SELECT c.trip_id, c.city, c.pickup_hour, c.pickup_weekday,
  coalesce(hw.hour_weight, {S.HOUR_WEIGHT_DEFAULT}E0) AS hour_weight, coalesce(wm.weekday_mult, {S.WEEKDAY_MULTIPLIER_DEFAULT}E0) AS weekday_mult,
  {R(f'coalesce(hw.hour_weight, {S.HOUR_WEIGHT_DEFAULT}E0) * coalesce(wm.weekday_mult, {S.WEEKDAY_MULTIPLIER_DEFAULT}E0)', 4)} AS demand_weight
FROM clean c LEFT JOIN hw ON hw.hour = c.pickup_hour LEFT JOIN wm ON wm.weekday = c.pickup_weekday"""))
def demand_weight(ws):
    return AU.demand_weight(ws.clean, ws.dims)


@register("speed_band_audit", lambda p: with_base(p, f"""
, b AS (SELECT c.city, c.speed_mph,
    CASE WHEN c.pickup_hour IN ({', '.join(map(str, S.SURGE_HOURS))}) THEN 'rush'
         WHEN c.pickup_hour IN ({', '.join(map(str, S.NIGHT_HOURS))}) THEN 'night' ELSE 'day' END AS band,
    d.speed_rush_lo, d.speed_rush_hi, d.speed_night_lo, d.speed_night_hi, d.speed_day_lo, d.speed_day_hi
  FROM clean c JOIN dim_city d ON d.city = c.city),
b2 AS (SELECT *, coalesce(speed_mph >= CASE band WHEN 'rush' THEN speed_rush_lo WHEN 'night' THEN speed_night_lo ELSE speed_day_lo END
                  AND speed_mph <= CASE band WHEN 'rush' THEN speed_rush_hi WHEN 'night' THEN speed_night_hi ELSE speed_day_hi END, false) AS inb
       FROM b)
SELECT city, band, count(*) AS trips, count(*) FILTER (WHERE inb) AS in_band, count(*) FILTER (WHERE NOT inb) AS out_of_band,
  {R('avg(speed_mph)', 6)} AS avg_speed FROM b2 GROUP BY city, band"""))
def speed_band_audit(ws):
    return AU.speed_band_audit(ws.clean, ws.dims)


def _season_sql():
    from ..sources.dims import FIXTURE_CITY_PROFILE
    rows = [(c, m + 1, float(t)) for c, pr in FIXTURE_CITY_PROFILE.items()
            for m, t in enumerate(S.CITY_PROFILES[pr]["seasonal_temps"])]
    return f", season AS (SELECT * FROM {_values(rows, ['city', 'month', 'norm_temp_f'])})\n"


@register("temp_anomaly", lambda p: with_base(p, _season_sql() + f"""
SELECT w.weather_id, w.city, CAST(month(w.recorded_at) AS INT) AS month,
  coalesce(s.norm_temp_f, {float(S.SEASON_TEMP_DEFAULT)}E0) AS norm_temp_f, w.temp_f,
  {R(f'w.temp_f - coalesce(s.norm_temp_f, {float(S.SEASON_TEMP_DEFAULT)}E0)', 4)} AS temp_anomaly
FROM weather w LEFT JOIN season s ON s.city = w.city AND s.month = month(w.recorded_at)"""))
def temp_anomaly(ws):
    return AU.temp_anomaly(ws.weather, ws.dims)


@register("condition_flags", lambda p: with_base(p, """
SELECT weather_id, city, condition,
  CAST(contains(coalesce(condition, ''), 'Rain') OR contains(coalesce(condition, ''), 'Drizzle') AS INT) AS is_rain,
  CAST(contains(coalesce(condition, ''), 'Snow') AS INT) AS is_snow FROM weather"""))
def condition_flags(ws):
    return AU.condition_flags(ws.weather)
