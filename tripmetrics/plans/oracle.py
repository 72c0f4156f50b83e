"""ANSI SQL (DuckDB dialect) twins of the query keys.

Each key's SQL starts from the driver's raw tables through the same fixture
mapping and recomputes the answer directly (no shared code with the Spark
plans), so a match is an independent check.  ``R(x, d)`` rounds half-up
through a decimal exactly as ``functions.columns.rnd`` does.
"""

from __future__ import annotations

from datetime import timedelta

from .. import settings as S
from ..sources import adapters as A
from ..sources import dims as D
from ..settings import Params


def R(x: str, d: int) -> str:
    return f"CAST(ROUND(CAST(({x}) AS DECIMAL(30,12)), {d}) AS DOUBLE)"


def TS(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows, cols) -> str:
    def lit(v):
        if isinstance(v, str):
            return q(v)
        if isinstance(v, float):
            return f"CAST({v!r} AS DOUBLE)"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def _city_rows():
    out = []
    for c, p in D.FIXTURE_CITY_PROFILE.items():
        pr = S.CITY_PROFILES[p]
        out.append((c, c.title(), pr["country"], pr["currency"], float(pr["base_fare"]), float(pr["per_mile_rate"]),
                    float(pr["per_min_rate"]), *[float(v) for b in ("speed_day", "speed_rush", "speed_night") for v in pr[b]]))
    return out


CITY_COLS = ["city", "display_name", "country", "currency", "base_fare", "per_mile_rate", "per_min_rate",
             "speed_day_lo", "speed_day_hi", "speed_rush_lo", "speed_rush_hi", "speed_night_lo", "speed_night_hi"]


def week_start(p: Params) -> str:
    return (p.as_of - timedelta(days=p.rollup_days)).strftime("%Y-%m-%d")


def base_ctes(p: Params) -> str:
    """Adapter -> enrichment -> first_fail -> clean -> marts, as CTEs."""
    pay = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in S.PAYMENT_NAMES.items())
    surge = ", ".join(str(h) for h in S.SURGE_HOURS)
    wcity = " ".join(f"WHEN {i} THEN {q(c)}" for i, c in enumerate(A.WEATHER_CITIES))
    wcond = " ".join(f"WHEN {q(k)} THEN {q(v[0])}" for k, v in A.WEATHER_BY_EVENT.items())
    wcode = " ".join(f"WHEN {q(k)} THEN {v[1]}" for k, v in A.WEATHER_BY_EVENT.items())
    ws = week_start(p)
    return f"""
geo AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
trip_src AS (
  SELECT l.*, o.o_orderdate, o.o_orderpriority, c.c_custkey, cg.n_name AS c_nation, cg.r_name,
         sg.n_name AS s_nation,
         TIMESTAMP '{A.TRIP_EPOCH}' + to_days(CAST(date_diff('day', DATE '{A.ORDER_EPOCH}', CAST(o.o_orderdate AS DATE)) % {A.SPAN_DAYS} AS INT))
           + to_seconds((l.l_orderkey*7919 + l.l_partkey*31 + l.l_linenumber*10007) % 86400) AS pk_ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo cg ON c.c_nationkey = cg.n_nationkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN geo sg ON s.s_nationkey = sg.n_nationkey),
raw_trips AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS trip_id,
    r_name AS city, pk_ts AS pickup_datetime,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE pk_ts + to_seconds((5 + l_partkey % 180) * 60) END AS dropoff_datetime,
    CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_nation END AS pickup_neighborhood,
    s_nation AS dropoff_neighborhood,
    CAST(l_linenumber AS INT) AS passenger_count,
    CASE WHEN l_quantity = 50 THEN 125.0E0 ELSE l_quantity / 2 END AS trip_distance_miles,
    CASE WHEN l_discount = 0 AND l_tax = 0 AND l_returnflag = 'R' THEN -(floor(l_extendedprice/10)/100)
         WHEN l_discount = 0 AND l_tax = 0 AND l_returnflag = 'A' THEN 0.0E0
         ELSE floor(l_extendedprice/10)/100 END AS fare_amount,
    floor(l_extendedprice*l_discount/10)/100 AS tip_amount,
    floor(l_extendedprice*(1+l_discount+l_tax)/10)/100 AS total_amount,
    substr(o_orderpriority, 1, 1) AS payment_type,
    CASE WHEN l_linestatus = 'O' THEN 0.0E0 ELSE CAST(5 + l_partkey % 180 AS DOUBLE) END AS trip_duration_min,
    CASE WHEN l_linestatus = 'O' THEN 0.0E0 ELSE CAST(8 + l_suppkey % 90 AS DOUBLE) END AS speed_mph,
    CAST(l_orderkey % 4 AS INT) AS batch_id,
    l_orderkey, l_partkey
  FROM trip_src),
airports AS (SELECT r_name AS city, n_name AS neighborhood FROM geo WHERE n_nationkey < {D.FIXTURE_AIRPORT_NATION_MAX}),
dim_city AS (SELECT * FROM {_values(_city_rows(), CITY_COLS)}),
t_cal AS (
  SELECT trip_id, city, pickup_datetime, dropoff_datetime, pickup_neighborhood, dropoff_neighborhood,
    passenger_count, trip_distance_miles, fare_amount, tip_amount, total_amount, payment_type,
    trip_duration_min, speed_mph, batch_id,
    CAST(hour(pickup_datetime) AS INT) AS pickup_hour,
    CAST(isodow(pickup_datetime) - 1 AS INT) AS pickup_weekday,
    dayname(pickup_datetime) AS pickup_weekday_name,
    strftime(pickup_datetime, '%Y-%m-%d') AS pickup_date,
    date_diff('microsecond', pickup_datetime, dropoff_datetime) / 60000000.0E0 AS elapsed_min
  FROM raw_trips WHERE pickup_datetime IS NOT NULL),
t_dur AS (
  SELECT * EXCLUDE (trip_duration_min, elapsed_min),
    CASE WHEN trip_duration_min <= 0 THEN (CASE WHEN elapsed_min < 0 THEN 0.0E0 ELSE elapsed_min END)
         ELSE trip_duration_min END AS trip_duration_min
  FROM t_cal),
t_speed AS (
  SELECT * EXCLUDE (speed_mph),
    CASE WHEN sp0 < 0 THEN 0.0E0 WHEN sp0 > 80 THEN 80.0E0 ELSE sp0 END AS speed_mph
  FROM (SELECT *, CASE WHEN speed_mph <= 0 AND trip_duration_min > 0
                       THEN {R('trip_distance_miles / (trip_duration_min / 60)', 2)} ELSE speed_mph END AS sp0
        FROM t_dur)),
enriched AS (
  SELECT trip_id, city, pickup_datetime, dropoff_datetime, pickup_hour, pickup_weekday, pickup_weekday_name,
    pickup_date, coalesce(pickup_neighborhood, 'Unknown') AS pickup_neighborhood,
    coalesce(dropoff_neighborhood, 'Unknown') AS dropoff_neighborhood, passenger_count,
    trip_distance_miles, fare_amount, tip_amount, total_amount,
    coalesce(CASE payment_type {pay} END, payment_type, 'None') AS payment_type,
    trip_duration_min, speed_mph,
    CAST(pickup_hour IN ({surge}) AS INT) AS is_surge_hour,
    CAST(pickup_weekday >= 5 AS INT) AS is_weekend,
    CAST(EXISTS (SELECT 1 FROM airports a WHERE a.city = t.city AND a.neighborhood = t.pickup_neighborhood)
         OR EXISTS (SELECT 1 FROM airports a WHERE a.city = t.city AND a.neighborhood = t.dropoff_neighborhood) AS INT)
      AS is_airport_trip,
    batch_id
  FROM t_speed t),
ff AS (
  SELECT *, CASE
    WHEN NOT coalesce(fare_amount >= 0 AND fare_amount <= {S.MAX_FARE_AMOUNT}, false) THEN 'fare_range'
    WHEN NOT coalesce(trip_distance_miles >= 0 AND trip_distance_miles <= {S.MAX_TRIP_DISTANCE_MILES}, false) THEN 'distance_range'
    WHEN NOT coalesce(passenger_count >= {S.MIN_PASSENGER_COUNT} AND passenger_count <= {S.MAX_PASSENGER_COUNT}, false) THEN 'passenger_range'
    WHEN NOT coalesce(trip_duration_min >= 0 AND trip_duration_min <= {S.MAX_TRIP_DURATION_MIN}, false) THEN 'duration_range'
    WHEN NOT coalesce(pickup_datetime >= TIMESTAMP '{S.DQ_MIN_PICKUP}' AND pickup_datetime <= TIMESTAMP '{p.as_of_ts}', false) THEN 'date_range'
    END AS first_fail
  FROM enriched),
clean AS (SELECT * EXCLUDE (first_fail) FROM ff WHERE first_fail IS NULL),
hourly_raw AS (
  SELECT city, pickup_date AS date, pickup_hour AS hour, pickup_weekday AS day_of_week,
    pickup_weekday_name AS day_name, count(trip_id) AS trip_count,
    CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
    avg(fare_amount) AS af, avg(trip_distance_miles) AS ad, avg(trip_duration_min) AS adur,
    avg(speed_mph) AS asp, sum(CAST(total_amount AS DECIMAL(18,2))) AS rev, avg(tip_amount) AS tip_avg,
    sum(is_surge_hour) AS surge, sum(is_airport_trip) AS airport
  FROM clean GROUP BY ALL),
hourly_pct AS (SELECT *, {R('surge / trip_count * 100', 2)} AS surge_pct FROM hourly_raw),
hourly AS (
  SELECT city, date, hour, day_of_week, day_name, trip_count, total_passengers,
    {R('af', 4)} AS avg_fare, {R('ad', 4)} AS avg_distance, {R('adur', 4)} AS avg_duration_min,
    {R('asp', 4)} AS avg_speed_mph, {R('rev', 4)} AS total_revenue,
    coalesce({R('CASE WHEN af <> 0 THEN tip_avg / af * 100 END', 2)}, 0.0E0) AS tip_rate_pct,
    surge_pct AS surge_trip_pct, {R('airport / trip_count * 100', 2)} AS airport_pct,
    {R(R('''CASE WHEN ts > 100 THEN 100.0E0 ELSE ts END''', 2), 4)} AS pulse_score
  FROM (SELECT *, least(trip_count / 500.0E0 * 40, 40.0E0)
          + CASE WHEN af / 25 * 20 > 20 THEN 20.0E0 ELSE af / 25 * 20 END
          + CASE WHEN asp > 0 THEN (CASE WHEN asp / 20 * 20 > 20 THEN 20.0E0 ELSE asp / 20 * 20 END) ELSE 0.0E0 END
          + surge_pct / 100 * 20 AS ts FROM hourly_pct)),
nbhd AS (
  SELECT city, pickup_date AS date, pickup_neighborhood AS neighborhood, count(trip_id) AS trip_count,
    avg(fare_amount) AS avg_fare, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
    avg(trip_distance_miles) AS avg_distance,
    CAST(rank() OVER (PARTITION BY city, pickup_date ORDER BY count(trip_id) DESC) AS INT) AS rank_by_trips
  FROM clean GROUP BY city, pickup_date, pickup_neighborhood),
hour_cnt AS (SELECT city, pickup_date AS date, pickup_hour AS hour, count(*) AS cnt FROM clean GROUP BY ALL),
nb_cnt AS (SELECT city, pickup_date AS date, pickup_neighborhood AS nb, count(*) AS cnt FROM clean GROUP BY ALL),
daily AS (
  SELECT d.city, d.date, total_trips, total_passengers, {R('rev', 4)} AS total_revenue,
    {R('af', 4)} AS avg_fare, {R('ad', 4)} AS avg_distance, {R('adur', 4)} AS avg_duration_min,
    (SELECT hour FROM hour_cnt h WHERE h.city = d.city AND h.date = d.date ORDER BY cnt DESC, hour ASC LIMIT 1) AS busiest_hour,
    (SELECT hour FROM hour_cnt h WHERE h.city = d.city AND h.date = d.date ORDER BY cnt ASC, hour ASC LIMIT 1) AS quietest_hour,
    (SELECT nb FROM nb_cnt h WHERE h.city = d.city AND h.date = d.date ORDER BY cnt DESC, nb ASC LIMIT 1) AS peak_neighborhood,
    CAST(isodow(CAST(d.date AS DATE)) IN (6, 7) AS INT) AS weekend_flag
  FROM (SELECT city, pickup_date AS date, count(trip_id) AS total_trips,
          CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
          sum(CAST(total_amount AS DECIMAL(18,2))) AS rev, avg(fare_amount) AS af,
          avg(trip_distance_miles) AS ad, avg(trip_duration_min) AS adur
        FROM clean GROUP BY ALL) d),
weather AS (
  SELECT 'w' || CAST(event_id AS VARCHAR) AS weather_id, ts AS recorded_at,
    CASE event_id % 5 {wcity} END AS city,
    CAST(20 + user_id % 80 AS DOUBLE) AS temp_f, CAST(17 + user_id % 80 AS DOUBLE) AS feels_like_f,
    CAST(40 + event_id % 56 AS INT) AS humidity_pct, CAST(2 + event_id % 17 AS DOUBLE) AS wind_speed_mph,
    CASE event_type {wcond} END AS condition, CAST(CASE event_type {wcode} END AS INT) AS condition_code,
    CASE WHEN event_type IN ('click', 'error') THEN 4.0E0 + event_id % 7 ELSE 10.0E0 END AS visibility_mi,
    CAST(event_type IN ('click', 'purchase') AS INT) AS is_rain,
    CAST(event_type = 'signup' AS INT) AS is_snow
  FROM events),
weather_k AS (SELECT *, strftime(recorded_at, '%Y-%m-%d') AS date, CAST(hour(recorded_at) AS INT) AS hour FROM weather),
staged AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY batch_id, {', '.join(c + ' NULLS FIRST' for c in _stage_order())}) AS rn
    FROM clean WHERE dropoff_datetime IS NOT NULL) WHERE rn = 1),
staged_weather AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY weather_id ORDER BY {', '.join(c + ' NULLS FIRST' for c in A.WEATHER_COLUMNS)}) AS rn
    FROM weather WHERE recorded_at IS NOT NULL AND city IS NOT NULL) WHERE rn = 1),
week_daily AS (SELECT * FROM daily WHERE date >= '{ws}'),
week_hourly AS (SELECT * FROM hourly WHERE date >= '{ws}')
"""


def _stage_order():
    from ..operators.clean import KEEP_COLUMNS
    return KEEP_COLUMNS


def cols_sql(cols, ts=("pickup_datetime", "dropoff_datetime", "recorded_at")) -> str:
    """Select list rendering zone-less timestamps as ISO text."""
    return ", ".join(f"{TS(c)} AS {c}" if c in ts else c for c in cols)


def with_base(p: Params, sql: str) -> str:
    return f"WITH {base_ctes(p)}\n{sql}"
