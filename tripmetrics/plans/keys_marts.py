"""Query keys: mart details, weekly roll-up, weather impact."""

from __future__ import annotations

from ..operators import marts as M
from . import etl as ETL
from .catalog import DEFAULT, JANUARY, register
from .oracle import R, week_start, with_base


@register("hour_counts", lambda p: with_base(p, "SELECT city, date, hour, cnt AS trip_count FROM hour_cnt"))
def hour_counts(ws):
    return M.hour_counts(ws.cube)


@register("busiest_quietest", lambda p: with_base(p, "SELECT city, date, busiest_hour, quietest_hour FROM daily"))
def busiest_quietest(ws):
    return ws.daily.select("city", "date", "busiest_hour", "quietest_hour")


@register("peak_neighborhood", lambda p: with_base(p, "SELECT city, date, peak_neighborhood FROM daily"))
def peak_neighborhood(ws):
    return ws.daily.select("city", "date", "peak_neighborhood")


@register("pulse_score", lambda p: with_base(p, """
SELECT city, date, hour, trip_count, avg_fare, avg_speed_mph, surge_trip_pct, pulse_score FROM hourly"""))
def pulse_score(ws):
    return ws.hourly.select("city", "date", "hour", "trip_count", "avg_fare", "avg_speed_mph",
                            "surge_trip_pct", "pulse_score")


def weekly_sql(daily="week_daily", hourly="week_hourly"):
    return lambda p: with_base(p, f"""
SELECT d.city, '{week_start(p)}' AS week_start, '{p.as_of_date}' AS week_end,
  CAST(sum(d.total_trips) AS BIGINT) AS total_trips,
  CAST(sum(CAST(d.total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
  {R('avg(d.total_trips)', 6)} AS avg_daily_trips,
  (SELECT x.date FROM {daily} x WHERE x.city = d.city ORDER BY x.total_trips DESC, x.date LIMIT 1) AS peak_day,
  (SELECT x.hour FROM {hourly} x WHERE x.city = d.city ORDER BY x.trip_count DESC, x.date, x.hour LIMIT 1) AS peak_hour
FROM {daily} d GROUP BY d.city""")


@register("weekly_trends", weekly_sql(), DEFAULT)
def weekly_trends(ws):
    return ws.mart(ETL.WEEKLY)


WI_SQL = """
, wl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city, date, hour ORDER BY recorded_at DESC, weather_id DESC) AS rn
                        FROM (SELECT *, strftime(recorded_at, '%Y-%m-%d') AS date, CAST(hour(recorded_at) AS INT) AS hour
                              FROM staged_weather)) WHERE rn = 1),
wi AS (SELECT h.city, h.date, h.hour, h.trip_count, h.avg_fare, w.temp_f, w.condition, w.is_rain, w.is_snow, w.wind_speed_mph
       FROM week_hourly h LEFT JOIN wl w ON w.city = h.city AND w.date = h.date AND w.hour = h.hour)
"""


@register("weather_impact", lambda p: with_base(p, WI_SQL + "SELECT * FROM wi"), JANUARY)
def weather_impact(ws):
    return ws.mart(ETL.IMPACT)


@register("weather_join", lambda p: with_base(p, f"""
SELECT h.city, h.date, h.hour, h.trip_count, h.avg_fare, w.weather_id, w.temp_f, w.condition, w.is_rain, w.is_snow, w.wind_speed_mph
FROM week_hourly h LEFT JOIN (SELECT *, strftime(recorded_at, '%Y-%m-%d') AS date, CAST(hour(recorded_at) AS INT) AS hour FROM staged_weather) w
  ON w.city = h.city AND w.date = h.date AND w.hour = h.hour"""), JANUARY)
def weather_join(ws):
    return M.weather_join(ws.mart(ETL.HOURLY, M.week_start(ws.params)), ws.stored_weather, ws.params)

