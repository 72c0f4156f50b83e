"""Query keys: the incremental load as Structured Streaming.

Each key lands the fixture's four loads as files, drains a streaming query
over them with ``availableNow`` and returns what the sink holds.
"""

from __future__ import annotations

from ..operators.clean import KEEP_COLUMNS
from ..operators import merge as MG
from ..streaming import live as L
from .catalog import register
from .keys_fold import BATCH_CTES, fold_sql
from .oracle import cols_sql, with_base


def _landing(ws):
    return L.landing_for(ws.spark, ws.raw_trips), ws.raw_trips.schema


@register("stream_clean", lambda p: with_base(p, f"SELECT {cols_sql(KEEP_COLUMNS)}, batch_id FROM clean"))
def stream_clean(ws):
    path, schema = _landing(ws)
    return L.stream_clean(ws.spark, path, schema, ws.dims, ws.params)


@register("stream_dedupe", lambda p: with_base(p, "SELECT DISTINCT trip_id, city FROM clean WHERE dropoff_datetime IS NOT NULL"))
def stream_dedupe(ws):
    path, schema = _landing(ws)
    return L.stream_dedupe(ws.spark, path, schema, ws.dims, ws.params).select("trip_id", "city")


@register("stream_hourly", lambda p: with_base(p, "SELECT * FROM hourly"))
def stream_hourly(ws):
    path, schema = _landing(ws)
    return L.stream_hourly(ws.spark, path, schema, ws.dims, ws.params)


@register("stream_fold_hourly", lambda p: with_base(p, BATCH_CTES + fold_sql("hourly_b", MG.HOURLY_KEYS, MG.HOURLY_RULES)))
def stream_fold_hourly(ws):
    path, schema = _landing(ws)
    return L.stream_fold(ws.spark, path, schema, ws.dims, ws.params)
