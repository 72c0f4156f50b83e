"""Query keys: read queries, page reshaping, runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import reshape as RS
from ..operators import runs as RU
from ..operators import serve as SV
from . import etl as ETL
from .catalog import JANUARY, register
from .keys_fold import LOAD_ROWS
from .keys_marts import WI_SQL
from .keys_quality import DQ_CTES
from .oracle import R, cols_sql, with_base
from .runlog import RunLog

R6 = lambda x: R(x, 6)

# The log of the job's runs, as it must be; its times are the clock's and not compared.
# One load of everything: a run a city.
RUNS_CTE = """
, runs AS (SELECT 'trips-0:' || city AS run_id, city, count(*) AS rows_extracted FROM raw_trips GROUP BY city)
"""
# Load by load: a run a city and load, and one for each load and for the daily roll-up.
LOADS_CTE = LOAD_ROWS + """
, runs0 AS (
  SELECT r.batch_id, r.city, r.n AS rows_extracted, coalesce(c.n, 0) AS rows_loaded, coalesce(s.n, 0) AS rows_inserted
  FROM (SELECT batch_id, city, count(*) AS n FROM raw_l GROUP BY ALL) r
  LEFT JOIN (SELECT batch_id, city, count(*) AS n FROM clean_l GROUP BY ALL) c ON c.batch_id = r.batch_id AND c.city = r.city
  LEFT JOIN (SELECT batch_id, city, count(*) AS n FROM staged GROUP BY ALL) s ON s.batch_id = r.batch_id AND s.city = r.city),
runs1 AS (SELECT *, 'trips_backfill-' || CAST(batch_id AS VARCHAR) AS load_run FROM runs0),
runs AS (
  SELECT load_run || ':' || city AS run_id, 'trips_backfill' AS dag_id, 'transform_load' AS task_id, city, 'success' AS status,
    rows_extracted, rows_loaded, rows_extracted - rows_loaded AS rows_rejected, rows_inserted, batch_id FROM runs1
  UNION ALL SELECT load_run, 'trips_backfill', 'transform_load', NULL, 'success', CAST(sum(rows_extracted) AS BIGINT), CAST(sum(rows_loaded) AS BIGINT),
    CAST(sum(rows_extracted - rows_loaded) AS BIGINT), CAST(sum(rows_inserted) AS BIGINT), batch_id FROM runs1 GROUP BY load_run, batch_id
  UNION ALL SELECT 'trips_daily-{asof}', 'trips_daily', 'daily_rollup', NULL, 'success', 0, 0, 0, 0, NULL)
"""
RUN_OUT = ["run_id", "dag_id", "task_id", "city", "status", "rows_extracted", "rows_loaded", "rows_rejected", "rows_inserted"]


def loads_sql(p, tail):
    return with_base(p, LOADS_CTE.replace("{asof}", p.as_of_date) + tail)


PATTERN = """
, pattern AS (SELECT city, day_of_week, day_name, hour, avg(trip_count) AS avg_trips, avg(pulse_score) AS avg_pulse,
                     avg(avg_fare) AS avg_fare FROM hourly GROUP BY ALL),
grid AS (SELECT c.city, CAST(h.range AS INT) AS hour FROM (SELECT DISTINCT city FROM pattern) c CROSS JOIN range(24) h)
"""

HOUR_PROFILE = f"""
, hp AS (SELECT city, hour, {R6('avg(trip_count)')} AS avg_trips, {R6('avg(pulse_score)')} AS avg_pulse,
          {R6('avg(avg_fare)')} AS avg_fare, {R6('avg(total_revenue)')} AS avg_revenue, count(*) AS data_points
         FROM hourly GROUP BY city, hour),
top AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY avg_pulse DESC, hour) AS rn FROM hp)
        WHERE rn <= {{n}})
"""

NB_TOTALS = f"""
, nbt AS (SELECT city, neighborhood, CAST(sum(trip_count) AS BIGINT) AS total_trips, {R6('avg(avg_fare)')} AS avg_fare,
           CAST(sum(CAST(total_revenue AS DECIMAL(24,6))) AS DOUBLE) AS total_revenue, {R6('avg(avg_distance)')} AS avg_distance
          FROM nbhd GROUP BY city, neighborhood)
"""


def pattern(ws):
    return SV.weekday_pattern(ws.mart(ETL.HOURLY))


# -- read queries -----------------------------------------------------------

@register("weekday_pattern", lambda p: with_base(p, PATTERN + f"""
SELECT city, day_of_week, day_name, hour, {R6('avg_trips')} AS avg_trips, {R6('avg_pulse')} AS avg_pulse,
  {R6('avg_fare')} AS avg_fare FROM pattern"""))
def weekday_pattern(ws):
    return pattern(ws).select("city", "day_of_week", "day_name", "hour",
                              *[C.rnd(c, 6).alias(c) for c in ("avg_trips", "avg_pulse", "avg_fare")])


def _nb_totals(ws):
    t = SV.neighborhood_totals(ws.mart(ETL.NEIGHBORHOOD))
    return t.select("city", "neighborhood", "total_trips", C.rnd("avg_fare", 6).alias("avg_fare"),
                    "total_revenue", C.rnd("avg_distance", 6).alias("avg_distance"))


@register("neighborhood_totals", lambda p: with_base(p, NB_TOTALS + "SELECT * FROM nbt"))
def neighborhood_totals(ws):
    return _nb_totals(ws).orderBy("city", F.col("total_trips").desc(), "neighborhood")


@register("top_hours", lambda p: with_base(p, HOUR_PROFILE.replace("{n}", str(p.top_hours_n)) + "SELECT * FROM top"))
def top_hours(ws):
    return SV.top_hours(ws.mart(ETL.HOURLY), ws.params.top_hours_n)


@register("kpi_busiest_hour", lambda p: with_base(p, HOUR_PROFILE.replace("{n}", "24") + """
SELECT city, hour AS busiest_hour, avg_trips AS max_avg_trips FROM (
  SELECT *, row_number() OVER (PARTITION BY city ORDER BY avg_trips DESC, hour) AS rn FROM hp) WHERE rn = 1"""))
def kpi_busiest_hour(ws):
    return SV.busiest_hour(ws.mart(ETL.HOURLY))


@register("kpis", lambda p: with_base(p, RUNS_CTE + HOUR_PROFILE.replace("{n}", "24") + f"""
, bh AS (SELECT city, hour AS busiest_hour FROM (
  SELECT *, row_number() OVER (PARTITION BY city ORDER BY avg_trips DESC, hour) AS rn FROM hp) WHERE rn = 1),
st AS (SELECT city, count(*) AS total_trips, CAST(coalesce(sum(CAST(total_amount AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_revenue,
         coalesce({R6('avg(fare_amount)')}, 0.0E0) AS avg_fare,
         coalesce({R6('avg(speed_mph) FILTER (WHERE speed_mph > 0)')}, 0.0E0) AS avg_speed FROM staged GROUP BY city),
rn AS (SELECT city, count(*) AS pipeline_runs, max(run_id) AS last_run_id FROM runs GROUP BY city)
SELECT st.city, total_trips, total_revenue, avg_fare, avg_speed, coalesce(pipeline_runs, 0) AS pipeline_runs, last_run_id, busiest_hour
FROM st LEFT JOIN rn ON rn.city = st.city LEFT JOIN bh ON bh.city = st.city"""))
def kpis(ws):
    return _kpis(ws).drop("last_run")


def _runs(ws, loads=False):
    wh = ws.loads if loads else ws.stored
    return RunLog(ws.spark, wh.base).latest()


def _kpis(ws):
    return SV.kpis(ws.stored.read(ETL.TOTALS), _runs(ws), ws.mart(ETL.HOURLY))


def _marts(ws):
    return {"agg_hourly": ws.mart(ETL.HOURLY), "agg_daily": ws.mart(ETL.DAILY), "agg_nbhd": ws.mart(ETL.NEIGHBORHOOD)}


def _data_counts(ws):
    tables = _marts(ws) | {"pipeline_runs": _runs(ws).where("city is not null")}
    return SV.data_counts(ws.stored.read(ETL.TOTALS), tables, ETL.check_log(ws.spark, ws.stored.base))


DATA_COUNTS_SQL = """
, dc_u AS (
  SELECT city, 'raw_trips' AS metric, count(*) AS n FROM raw_trips GROUP BY city
  UNION ALL SELECT city, 'stg_trips', count(*) FROM staged GROUP BY city
  UNION ALL SELECT city, 'agg_hourly', count(*) FROM hourly GROUP BY city
  UNION ALL SELECT city, 'agg_daily', count(*) FROM daily GROUP BY city
  UNION ALL SELECT city, 'agg_nbhd', count(*) FROM nbhd GROUP BY city
  UNION ALL SELECT city, 'weather_rows', count(*) FROM staged_weather GROUP BY city
  UNION ALL SELECT city, 'pipeline_runs', count(*) FROM runs GROUP BY city),
dc AS (SELECT city,
  CAST(coalesce(sum(n) FILTER (WHERE metric = 'raw_trips'), 0) AS BIGINT) AS raw_trips,
  CAST(coalesce(sum(n) FILTER (WHERE metric = 'stg_trips'), 0) AS BIGINT) AS stg_trips,
  CAST(coalesce(sum(n) FILTER (WHERE metric = 'agg_hourly'), 0) AS BIGINT) AS agg_hourly,
  CAST(coalesce(sum(n) FILTER (WHERE metric = 'agg_daily'), 0) AS BIGINT) AS agg_daily,
  CAST(coalesce(sum(n) FILTER (WHERE metric = 'agg_nbhd'), 0) AS BIGINT) AS agg_nbhd,
  CAST(coalesce(sum(n) FILTER (WHERE metric = 'weather_rows'), 0) AS BIGINT) AS weather_rows,
  CAST(coalesce(sum(n) FILTER (WHERE metric = 'pipeline_runs'), 0) AS BIGINT) AS pipeline_runs,
  (SELECT CAST(count(*) AS BIGINT) FROM dq_log) + 5 * (SELECT count(*) FROM (SELECT city FROM raw_trips UNION SELECT city FROM weather)) AS dq_checks
  FROM dc_u GROUP BY city)
"""


def data_counts_sql(p, tail):
    return with_base(p, DQ_CTES + RUNS_CTE + DATA_COUNTS_SQL + tail)


@register("data_counts", lambda p: data_counts_sql(p, "SELECT * FROM dc"))
def data_counts(ws):
    return _data_counts(ws)


@register("available_cities", lambda p: with_base(p, "SELECT city, count(*) AS trip_count FROM staged GROUP BY city"))
def available_cities(ws):
    return SV.available_cities(ws.stored.read(ETL.TOTALS))


@register("city_catalog", lambda p: with_base(p, """
, av AS (SELECT city, count(*) AS trip_count FROM staged GROUP BY city)
SELECT d.city, d.display_name, d.country, d.currency, av.trip_count IS NOT NULL AS has_data,
  CAST(coalesce(av.trip_count, 0) AS BIGINT) AS trip_count FROM dim_city d LEFT JOIN av ON av.city = d.city"""))
def city_catalog(ws):
    return SV.city_catalog(ws.dims.city, ws.stored.read(ETL.TOTALS))


@register("hours_covered", lambda p: with_base(p, "SELECT city, count(DISTINCT hour) AS hours_covered FROM hourly GROUP BY city"))
def hours_covered(ws):
    return SV.hours_covered(ws.mart(ETL.HOURLY))


def _days_back(p, days):
    from datetime import timedelta
    return (p.as_of - timedelta(days=days)).strftime("%Y-%m-%d")


@register("recent_hourly", lambda p: with_base(p, f"SELECT * FROM hourly WHERE date >= '{_days_back(p, p.recent_hourly_days)}'"))
def recent_hourly(ws):
    p = ws.params
    return SV.recent_hourly(ws.mart(ETL.HOURLY, SV.days_back(p, p.recent_hourly_days)), p, p.recent_hourly_days)


@register("recent_daily", lambda p: with_base(p, f"SELECT * FROM daily WHERE date >= '{_days_back(p, p.recent_daily_days)}'"))
def recent_daily(ws):
    p = ws.params
    return SV.recent_daily(ws.mart(ETL.DAILY, SV.days_back(p, p.recent_daily_days)), p, p.recent_daily_days)


RECENT_WI = """
, rwi AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY date DESC, hour DESC) AS rn FROM wi)
          WHERE rn <= {n})
"""


def _wi(ws):
    return ws.mart(ETL.IMPACT)


@register("recent_weather_impact", lambda p: with_base(p, WI_SQL + RECENT_WI.replace("{n}", str(p.recent_weather_n))
                                                       + "SELECT * FROM rwi"), JANUARY)
def recent_weather_impact(ws):
    return SV.recent_weather_impact(_wi(ws), ws.params.recent_weather_n)


@register("weather_scatter", lambda p: with_base(p, WI_SQL + """
SELECT city, date, hour, temp_f, trip_count,
  CASE WHEN is_rain = 1 THEN 'rain' WHEN is_snow = 1 THEN 'snow' ELSE 'dry' END AS weather_class
FROM wi WHERE coalesce(temp_f <> 0, false) AND coalesce(trip_count <> 0, false)"""), JANUARY)
def weather_scatter(ws):
    return SV.weather_scatter(_wi(ws))


def _staged_cols():
    from ..operators.clean import KEEP_COLUMNS
    return KEEP_COLUMNS + ["batch_id"]


@register("recent_trips", lambda p: with_base(p, f"""
SELECT {cols_sql(_staged_cols())} FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY pickup_datetime DESC, trip_id) AS rn
  FROM staged) WHERE rn <= {p.recent_trips_n}"""))
def recent_trips(ws):
    return SV.recent_trips(ws.stored_trips, ws.params.recent_trips_n)


@register("run_history", lambda p: loads_sql(p, f"""
SELECT {', '.join(RUN_OUT)} FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY batch_id DESC) AS rn FROM runs WHERE city IS NOT NULL)
WHERE rn <= {p.run_history_n}"""))
def run_history(ws):
    return SV.run_history(_runs(ws, loads=True).where("city is not null"), ws.params.run_history_n).select(*RUN_OUT)


@register("run_latest", lambda p: loads_sql(p, f"SELECT {', '.join(RUN_OUT)}, TRUE AS finished FROM runs"))
def run_latest(ws):
    return _runs(ws, loads=True).select(*RUN_OUT, (F.col("finished_at") >= F.col("started_at")).alias("finished"))


@register("top_neighborhoods", lambda p: with_base(p, NB_TOTALS + f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY total_trips DESC, neighborhood) AS rn FROM nbt)
WHERE rn <= {p.top_neighborhoods_n}"""))
def top_neighborhoods(ws):
    return SV.top_neighborhoods(_nb_totals(ws), ws.params.top_neighborhoods_n)


@register("run_stats", lambda p: with_base(p, """
, c AS (
  SELECT city, 'raw_trips' AS m, count(*) AS n FROM raw_trips GROUP BY city
  UNION ALL SELECT city, 'raw_weather', count(*) FROM weather GROUP BY city
  UNION ALL SELECT city, 'stg_trips_loaded', count(*) FROM clean GROUP BY city
  UNION ALL SELECT city, 'stg_trips_inserted', count(*) FROM staged GROUP BY city
  UNION ALL SELECT city, 'stg_weather_loaded', count(*) FROM staged_weather GROUP BY city
  UNION ALL SELECT city, 'agg_hourly_rows', count(*) FROM hourly GROUP BY city
  UNION ALL SELECT city, 'agg_nbhd_rows', count(*) FROM nbhd GROUP BY city
  UNION ALL SELECT city, 'agg_daily_rows', count(*) FROM daily GROUP BY city),
w AS (SELECT city,
  CAST(coalesce(sum(n) FILTER (WHERE m = 'raw_trips'), 0) AS BIGINT) AS raw_trips,
  CAST(coalesce(sum(n) FILTER (WHERE m = 'raw_weather'), 0) AS BIGINT) AS raw_weather,
  CAST(coalesce(sum(n) FILTER (WHERE m = 'stg_trips_loaded'), 0) AS BIGINT) AS stg_trips_loaded,
  CAST(coalesce(sum(n) FILTER (WHERE m = 'stg_trips_inserted'), 0) AS BIGINT) AS stg_trips_inserted,
  CAST(coalesce(sum(n) FILTER (WHERE m = 'stg_weather_loaded'), 0) AS BIGINT) AS stg_weather_loaded,
  CAST(coalesce(sum(n) FILTER (WHERE m = 'agg_hourly_rows'), 0) AS BIGINT) AS agg_hourly_rows,
  CAST(coalesce(sum(n) FILTER (WHERE m = 'agg_nbhd_rows'), 0) AS BIGINT) AS agg_nbhd_rows,
  CAST(coalesce(sum(n) FILTER (WHERE m = 'agg_daily_rows'), 0) AS BIGINT) AS agg_daily_rows
  FROM c GROUP BY city)
SELECT *, raw_trips - stg_trips_loaded AS rows_rejected FROM w"""))
def run_stats(ws):
    return SV.run_stats(ws.stored.read(ETL.TOTALS), {f"{k}_rows": v for k, v in _marts(ws).items()})


@register("batch_stats", lambda p: loads_sql(p, """
SELECT city, CAST(sum(rows_loaded) AS BIGINT) AS total_loaded, count(*) AS chunks FROM runs WHERE city IS NOT NULL GROUP BY city"""))
def batch_stats(ws):
    return RU.batch_stats(_runs(ws, loads=True))


@register("status_summary", lambda p: data_counts_sql(p, HOUR_PROFILE.replace("{n}", "24") + f"""
, bh AS (SELECT city, hour AS busiest_hour FROM (
  SELECT *, row_number() OVER (PARTITION BY city ORDER BY avg_trips DESC, hour) AS rn FROM hp) WHERE rn = 1),
st AS (SELECT city, count(*) AS total_trips, CAST(coalesce(sum(CAST(total_amount AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_revenue,
         coalesce({R6('avg(fare_amount)')}, 0.0E0) AS avg_fare FROM staged GROUP BY city),
rl AS (SELECT city, max(run_id) AS last_run_id, count(*) AS history_rows FROM runs GROUP BY city)
SELECT dc.*, st.total_trips, st.total_revenue, st.avg_fare, bh.busiest_hour, rl.last_run_id, CAST(rl.history_rows AS BIGINT) AS history_rows
FROM dc LEFT JOIN st ON st.city = dc.city LEFT JOIN bh ON bh.city = dc.city LEFT JOIN rl ON rl.city = dc.city"""))
def status_summary(ws):
    k = _kpis(ws).select("city", "total_trips", "total_revenue", "avg_fare", "busiest_hour", "last_run_id")
    hist = SV.run_history(_runs(ws).where("city is not null"), ws.params.run_history_n).groupBy("city").agg(F.count(F.lit(1)).alias("history_rows"))
    return _data_counts(ws).join(k, "city", "left").join(hist, "city", "left")


# -- page reshaping -----------------------------------------------------------

@register("hourly_average", lambda p: with_base(p, PATTERN + f"""
SELECT g.city, g.hour, coalesce(v.avg_trips, 0.0E0) AS avg_trips FROM grid g LEFT JOIN
  (SELECT city, hour, {R6('avg(coalesce(avg_trips, 0))')} AS avg_trips FROM pattern GROUP BY city, hour) v
  ON v.city = g.city AND v.hour = g.hour"""))
def hourly_average(ws):
    return RS.hourly_average(pattern(ws))


@register("weekday_vs_weekend", lambda p: with_base(p, PATTERN + f"""
SELECT g.city, g.hour, coalesce(v.weekday_avg, 0.0E0) AS weekday_avg, coalesce(v.weekend_avg, 0.0E0) AS weekend_avg
FROM grid g LEFT JOIN (SELECT city, hour,
    {R6('avg(CASE WHEN day_of_week <= 4 THEN coalesce(avg_trips, 0) END)')} AS weekday_avg,
    {R6('avg(CASE WHEN day_of_week >= 5 THEN coalesce(avg_trips, 0) END)')} AS weekend_avg
  FROM pattern GROUP BY city, hour) v ON v.city = g.city AND v.hour = g.hour"""))
def weekday_vs_weekend(ws):
    return RS.weekday_vs_weekend(pattern(ws))


@register("pulse_by_hour", lambda p: with_base(p, PATTERN + f"""
, pb AS (SELECT g.city, g.hour, coalesce(v.avg_pulse, 0.0E0) AS avg_pulse FROM grid g LEFT JOIN
  (SELECT city, hour, {R6('avg(coalesce(avg_pulse, 0))')} AS avg_pulse FROM pattern GROUP BY city, hour) v
  ON v.city = g.city AND v.hour = g.hour)
SELECT *, avg_pulse = max(avg_pulse) OVER (PARTITION BY city) AS is_peak FROM pb"""))
def pulse_by_hour(ws):
    return RS.pulse_by_hour(pattern(ws))


@register("fare_by_hour", lambda p: with_base(p, PATTERN + f"""
SELECT g.city, g.hour, coalesce(v.avg_fare, 0.0E0) AS avg_fare FROM grid g LEFT JOIN
  (SELECT city, hour, {R6('avg(CASE WHEN avg_fare IS NOT NULL AND avg_fare <> 0 THEN avg_fare END)')} AS avg_fare
   FROM pattern GROUP BY city, hour) v ON v.city = g.city AND v.hour = g.hour"""))
def fare_by_hour(ws):
    return RS.fare_by_hour(pattern(ws))


@register("heatmap_pivot", lambda p: with_base(p, PATTERN + "SELECT city, day_of_week, day_name, " + ", ".join(
    f"coalesce(max(CASE WHEN hour = {h} THEN {R6('coalesce(avg_trips, 0)')} END), 0.0E0) AS h{h}" for h in range(24))
    + " FROM pattern GROUP BY city, day_of_week, day_name"))
def heatmap_pivot(ws):
    return RS.heatmap_pivot(pattern(ws))


@register("top_hours_share", lambda p: with_base(p, HOUR_PROFILE.replace("{n}", str(p.top_hours_n)) + f"""
SELECT city, hour, avg_pulse, CAST(row_number() OVER (PARTITION BY city ORDER BY avg_pulse DESC, hour) AS INTEGER) AS position,
  {R('avg_pulse / CASE WHEN max(avg_pulse) OVER (PARTITION BY city) IS NULL OR max(avg_pulse) OVER (PARTITION BY city) = 0 THEN 1.0E0 ELSE max(avg_pulse) OVER (PARTITION BY city) END * 100', 1)} AS share_pct
FROM top"""))
def top_hours_share(ws):
    return RS.top_hours_share(SV.top_hours(ws.mart(ETL.HOURLY), ws.params.top_hours_n))
