"""Query keys: scans, cleaning, quality, marts."""

from __future__ import annotations

from ..operators.clean import KEEP_COLUMNS
from ..sources.adapters import TRIP_COLUMNS
from .catalog import register
from .oracle import R, cols_sql, with_base


@register("scan_trips", lambda p: with_base(p, f"SELECT {cols_sql(TRIP_COLUMNS)} FROM raw_trips"))
def scan_trips(ws):
    return ws.raw_trips


@register("clean_trips", lambda p: with_base(p, f"SELECT {cols_sql(KEEP_COLUMNS)}, batch_id FROM clean"))
def clean_trips(ws):
    return ws.clean


@register("hourly_pulse", lambda p: with_base(p, "SELECT * FROM hourly"))
def hourly_pulse(ws):
    return ws.hourly


@register("neighborhood_stats", lambda p: with_base(p, f"""
SELECT city, date, neighborhood, trip_count, {R('avg_fare', 6)} AS avg_fare, total_revenue,
       {R('avg_distance', 6)} AS avg_distance, rank_by_trips FROM nbhd"""))
def neighborhood_stats(ws):
    from ..functions.columns import rnd
    n = ws.neighborhood
    return n.withColumn("avg_fare", rnd("avg_fare", 6)).withColumn("avg_distance", rnd("avg_distance", 6))


@register("daily_summary", lambda p: with_base(p, "SELECT * FROM daily"))
def daily_summary(ws):
    return ws.daily

