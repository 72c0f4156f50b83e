"""Query keys: marts merged over several loads.

The fixture's four batches (``batch_id``) are four loads in order.  Each
load's marts are computed with ``batch_id`` as an extra key from one
pre-aggregate, then all loads fold in one pass (``merge.fold``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import clean as CL
from ..operators import marts as M
from ..operators import merge as MG
from ..sources import feeds as FD
from . import etl as ETL
from .catalog import register
from .oracle import R, TS, cols_sql, week_start, with_base

# The rows of the loads that ``Workspace.loads`` runs: each batch, and a tenth of the one before again.
AGAIN = "batch_id < 3 AND CAST(split_part(trip_id, '-', 1) AS BIGINT) % 10 = 0"
LOAD_ROWS = "".join(f"""
, {t}_l AS (SELECT *, batch_id AS load FROM {t} UNION ALL SELECT * REPLACE (batch_id + 1 AS batch_id), batch_id + 1 FROM {t} WHERE {AGAIN})"""
                    for t in ("raw_trips", "clean", "ff")).replace("raw_trips_l", "raw_l") + "\n"

# -- per-batch marts (SQL) ------------------------------------------------------

BATCH_CTES = f"""
, hourly_b0 AS (
  SELECT batch_id, city, pickup_date AS date, pickup_hour AS hour, pickup_weekday AS day_of_week,
    pickup_weekday_name AS day_name, count(trip_id) AS trip_count,
    CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
    avg(fare_amount) AS af, avg(trip_distance_miles) AS ad, avg(trip_duration_min) AS adur,
    avg(speed_mph) AS asp, sum(CAST(total_amount AS DECIMAL(18,2))) AS rev, avg(tip_amount) AS tip_avg,
    sum(is_surge_hour) AS surge, sum(is_airport_trip) AS airport
  FROM clean GROUP BY ALL),
hourly_b1 AS (SELECT *, {R('surge / trip_count * 100', 2)} AS surge_pct FROM hourly_b0),
hourly_b AS (
  SELECT batch_id, city, date, hour, day_of_week, day_name, trip_count, total_passengers,
    {R('af', 4)} AS avg_fare, {R('ad', 4)} AS avg_distance, {R('adur', 4)} AS avg_duration_min,
    {R('asp', 4)} AS avg_speed_mph, {R('rev', 4)} AS total_revenue,
    coalesce({R('CASE WHEN af <> 0 THEN tip_avg / af * 100 END', 2)}, 0.0E0) AS tip_rate_pct,
    surge_pct AS surge_trip_pct, {R('airport / trip_count * 100', 2)} AS airport_pct,
    {R(R('CASE WHEN ts > 100 THEN 100.0E0 ELSE ts END', 2), 4)} AS pulse_score
  FROM (SELECT *, least(trip_count / 500.0E0 * 40, 40.0E0)
          + CASE WHEN af / 25 * 20 > 20 THEN 20.0E0 ELSE af / 25 * 20 END
          + CASE WHEN asp > 0 THEN (CASE WHEN asp / 20 * 20 > 20 THEN 20.0E0 ELSE asp / 20 * 20 END) ELSE 0.0E0 END
          + surge_pct / 100 * 20 AS ts FROM hourly_b1)),
nbhd_b AS (
  SELECT batch_id, city, pickup_date AS date, pickup_neighborhood AS neighborhood, count(trip_id) AS trip_count,
    avg(fare_amount) AS avg_fare, CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
    avg(trip_distance_miles) AS avg_distance,
    CAST(rank() OVER (PARTITION BY batch_id, city, pickup_date ORDER BY count(trip_id) DESC) AS INT) AS rank_by_trips
  FROM clean GROUP BY batch_id, city, pickup_date, pickup_neighborhood),
hour_cnt_b AS (SELECT batch_id, city, pickup_date AS date, pickup_hour AS hour, count(*) AS cnt FROM clean GROUP BY ALL),
nb_cnt_b AS (SELECT batch_id, city, pickup_date AS date, pickup_neighborhood AS nb, count(*) AS cnt FROM clean GROUP BY ALL),
daily_b AS (
  SELECT d.batch_id, d.city, d.date, total_trips, total_passengers, {R('rev', 4)} AS total_revenue,
    {R('af', 4)} AS avg_fare, {R('ad', 4)} AS avg_distance, {R('adur', 4)} AS avg_duration_min,
    (SELECT hour FROM hour_cnt_b h WHERE h.batch_id = d.batch_id AND h.city = d.city AND h.date = d.date ORDER BY cnt DESC, hour LIMIT 1) AS busiest_hour,
    (SELECT hour FROM hour_cnt_b h WHERE h.batch_id = d.batch_id AND h.city = d.city AND h.date = d.date ORDER BY cnt ASC, hour LIMIT 1) AS quietest_hour,
    (SELECT nb FROM nb_cnt_b h WHERE h.batch_id = d.batch_id AND h.city = d.city AND h.date = d.date ORDER BY cnt DESC, nb LIMIT 1) AS peak_neighborhood,
    CAST(isodow(CAST(d.date AS DATE)) IN (6, 7) AS INT) AS weekend_flag
  FROM (SELECT batch_id, city, pickup_date AS date, count(trip_id) AS total_trips,
          CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
          sum(CAST(total_amount AS DECIMAL(18,2))) AS rev, avg(fare_amount) AS af,
          avg(trip_distance_miles) AS ad, avg(trip_duration_min) AS adur
        FROM clean GROUP BY ALL) d)
"""

FLOATS = {"total_revenue", "avg_fare", "avg_distance", "avg_duration_min", "avg_speed_mph", "tip_rate_pct",
          "surge_trip_pct", "airport_pct", "pulse_score", "avg_daily_trips"}


def fold_sql(src: str, keys: list[str], rules: dict, order: str = "batch_id", round_half: bool = True) -> str:
    k = ", ".join(keys)
    aggs = []
    for c, r in rules.items():
        if r == "+":
            aggs.append(f"CAST(sum(CAST({c} AS DECIMAL(24,6))) AS DOUBLE) AS {c}" if c in FLOATS
                        else f"CAST(sum({c}) AS BIGINT) AS {c}")
        elif r == "half":
            s = f"sum(CAST({c} AS DECIMAL(18,8)) * CAST(_w AS DECIMAL(19,17)))"
            aggs.append(f"{R(s, 6) if round_half else f'CAST({s} AS DOUBLE)'} AS {c}")
        elif r == "max":
            aggs.append(f"CASE WHEN count({c}) < count(*) THEN NULL ELSE max({c}) END AS {c}")
        elif r == "old":
            aggs.append(f"arg_min({c}, {order}) AS {c}")
        elif r == "new":
            aggs.append(f"arg_max({c}, {order}) AS {c}")
    return f"""SELECT {k}, {', '.join(aggs)} FROM (
  SELECT *, CASE WHEN _i = 1 THEN pow(0.5, _n - 1) ELSE pow(0.5, _n - _i + 1) END AS _w FROM (
    SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {order}) AS _i, count(*) OVER (PARTITION BY {k}) AS _n FROM {src}))
GROUP BY {k}"""


def batch_sql(p, tail):
    return with_base(p, BATCH_CTES + tail)


def _bh(ws):
    return M.hourly_pulse(ws.batch_cube, ["batch_id"])


def _bn(ws):
    return M.neighborhood_stats(ws.batch_cube, ["batch_id"])


def _bd(ws):
    return M.daily_summary(ws.batch_cube, ["batch_id"])


def fold_hourly_df(ws):
    return MG.fold(_bh(ws), MG.HOURLY_KEYS, MG.HOURLY_RULES)


@register("fold_hourly", lambda p: batch_sql(p, fold_sql("hourly_b", MG.HOURLY_KEYS, MG.HOURLY_RULES)))
def fold_hourly(ws):
    return fold_hourly_df(ws)


@register("fold_neighborhood", lambda p: batch_sql(p, f"""
SELECT * EXCLUDE (avg_distance), {R('avg_distance', 6)} AS avg_distance FROM (
{fold_sql("nbhd_b", MG.NEIGHBORHOOD_KEYS, MG.NEIGHBORHOOD_RULES)})"""))
def fold_neighborhood(ws):
    f = MG.fold(_bn(ws), MG.NEIGHBORHOOD_KEYS, MG.NEIGHBORHOOD_RULES)
    return f.withColumn("avg_distance", C.rnd("avg_distance", 6))


@register("fold_daily", lambda p: batch_sql(p, fold_sql("daily_b", MG.DAILY_KEYS, MG.DAILY_RULES)))
def fold_daily(ws):
    return MG.fold(_bd(ws), MG.DAILY_KEYS, MG.DAILY_RULES)


# -- weekly roll-up after every load, merged (M5) and the backfill (T6) -------

def weekly_runs_sql(p):
    ws = week_start(p)
    return f"""
, runs_r AS (SELECT DISTINCT batch_id AS run FROM raw_trips),
daily_r AS (SELECT r.run, d.city, d.date, CAST(sum(d.total_trips) AS BIGINT) AS total_trips,
    CAST(sum(CAST(d.total_revenue AS DECIMAL(24,6))) AS DOUBLE) AS total_revenue
  FROM daily_b d JOIN runs_r r ON r.run >= d.batch_id GROUP BY r.run, d.city, d.date),
hourly_r AS (SELECT r.run, h.city, h.date, h.hour, CAST(sum(h.trip_count) AS BIGINT) AS trip_count
  FROM hourly_b h JOIN runs_r r ON r.run >= h.batch_id GROUP BY r.run, h.city, h.date, h.hour),
wd AS (SELECT * FROM daily_r WHERE date >= '{ws}'),
wh AS (SELECT * FROM hourly_r WHERE date >= '{ws}'),
weekly_r AS (
  SELECT d.run, d.city, '{ws}' AS week_start, '{p.as_of_date}' AS week_end,
    CAST(sum(d.total_trips) AS BIGINT) AS total_trips,
    CAST(sum(CAST(d.total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
    {R('avg(d.total_trips)', 6)} AS avg_daily_trips,
    (SELECT x.date FROM wd x WHERE x.run = d.run AND x.city = d.city ORDER BY x.total_trips DESC, x.date LIMIT 1) AS peak_day,
    (SELECT x.hour FROM wh x WHERE x.run = d.run AND x.city = d.city ORDER BY x.trip_count DESC, x.date, x.hour LIMIT 1) AS peak_hour
  FROM wd d GROUP BY d.run, d.city)
"""


@register("fold_weekly", lambda p: batch_sql(p, weekly_runs_sql(p) + fold_sql("weekly_r", MG.WEEKLY_KEYS, MG.WEEKLY_RULES, "run")))
def fold_weekly(ws):
    return M.weekly_after_loads(_bd(ws), _bh(ws), ws.params)


# -- the job's stored tables after four loads (M2-M4, D5, T6) -----------------

def step_sql(src: str, keys: list[str], rules: dict) -> str:
    """The loads of each key merged one after the other, in their order."""
    out = []
    for c, r in rules.items():
        values = f"list({c} ORDER BY batch_id)"
        step = {"+": "a + b", "half": "(a + b) / 2", "max": "CASE WHEN b > a THEN b ELSE a END"}.get(r)
        if r in ("old", "new"):
            x = f"{'arg_min' if r == 'old' else 'arg_max'}({c}, batch_id)"
            out.append(f"{R(x, 6) if c in FLOATS else x} AS {c}")
        else:
            x = f"list_reduce({values}, lambda a, b: {step})"
            out.append(f"{R(x, 6) if c in FLOATS else f'CAST({x} AS BIGINT)'} AS {c}")
    return f"SELECT {', '.join(keys)}, {', '.join(out)} FROM {src} GROUP BY {', '.join(keys)}"


def loads_sql(p, tail):
    return with_base(p, LOAD_ROWS + BATCH_CTES.replace("FROM clean", "FROM clean_l") + tail)


def _stored(ws, name, rules):
    m = ws.mart(name, loads=True)
    return m.select(*[C.rnd(c, 6).alias(c) if c in FLOATS else F.col(c) for c in m.columns])


@register("etl_marts", lambda p: loads_sql(p, step_sql("hourly_b", MG.HOURLY_KEYS, MG.HOURLY_RULES)))
def etl_marts(ws):
    return _stored(ws, ETL.HOURLY, MG.HOURLY_RULES)


@register("etl_neighborhood", lambda p: loads_sql(p, step_sql("nbhd_b", MG.NEIGHBORHOOD_KEYS, MG.NEIGHBORHOOD_RULES)))
def etl_neighborhood(ws):
    return _stored(ws, ETL.NEIGHBORHOOD, MG.NEIGHBORHOOD_RULES)


@register("etl_daily", lambda p: loads_sql(p, step_sql("daily_b", MG.DAILY_KEYS, MG.DAILY_RULES)))
def etl_daily(ws):
    return _stored(ws, ETL.DAILY, MG.DAILY_RULES)


@register("etl_staging", lambda p: with_base(p, f"SELECT {cols_sql(CL.KEEP_COLUMNS)}, batch_id, CAST(batch_id AS VARCHAR) AS load_id FROM staged"))
def etl_staging(ws):
    """Trips as staged by four loads that each send a tenth of the one before again: the first arrival stays."""
    return ETL.staged_trips(ws.loads, ws.clean).drop("loaded_at")


@register("backfill_fold", lambda p: loads_sql(p, weekly_runs_sql(p) + "SELECT * EXCLUDE (run) FROM weekly_r WHERE run = (SELECT max(run) FROM runs_r)"))
def backfill_fold(ws):
    """Backfill: the chunks run one by one into the stored marts, then the
    trailing-week roll-up over them."""
    return ws.mart(ETL.WEEKLY, loads=True)


# -- two trip sources (S1) ----------------------------------------------------------

UNION_COLS = ["trip_id", "city", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance_miles",
              "fare_amount", "tip_amount", "total_amount", "payment_type"]


def union_sources_df(ws):
    """Bag union of the feed's records (decoded) and the second source's."""
    feed_rows = ws.raw_trips.filter(F.col("batch_id") == 0)
    feed = FD.normalize_trip_feed(FD.trip_feed_payload(feed_rows)).select(
        "trip_id", "city", F.col("pickup_datetime").try_cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("dropoff_datetime").try_cast("timestamp_ntz").alias("dropoff_datetime"),
        *UNION_COLS[4:])
    second = ws.raw_trips.filter(F.col("batch_id") != 0).select(*UNION_COLS)
    return (feed.withColumn("source", F.lit("feed"))
                .unionByName(second.withColumn("source", F.lit("synthetic")), allowMissingColumns=True))


def union_sql(p):
    cols = ", ".join(TS(c) + " AS " + c if "datetime" in c else c for c in UNION_COLS)
    return with_base(p, f"""
SELECT 'feed' AS source, {cols} FROM raw_trips WHERE batch_id = 0
UNION ALL SELECT 'synthetic', {cols} FROM raw_trips WHERE batch_id <> 0""")


@register("union_sources", union_sql)
def union_sources(ws):
    return union_sources_df(ws)
