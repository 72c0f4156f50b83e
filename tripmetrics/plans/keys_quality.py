"""Query keys: data-quality checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from .. import settings as S
from ..operators import quality as Q
from ..operators import serve as SV
from . import etl as ETL
from .catalog import DEFAULT, register
from .keys_fold import LOAD_ROWS
from .oracle import R, with_base

DQ_CTES = f"""
, dqc AS (
  SELECT city, count(*) AS n_in,
    count(*) FILTER (WHERE pickup_datetime IS NULL) AS null_pickup_datetime,
    count(*) FILTER (WHERE trip_distance_miles IS NULL) AS null_trip_distance_miles,
    count(*) FILTER (WHERE fare_amount IS NULL) AS null_fare_amount,
    count(*) FILTER (WHERE first_fail = 'fare_range') AS f1,
    count(*) FILTER (WHERE first_fail = 'distance_range') AS f2,
    count(*) FILTER (WHERE first_fail = 'passenger_range') AS f3,
    count(*) FILTER (WHERE first_fail = 'duration_range') AS f4,
    count(*) FILTER (WHERE first_fail = 'date_range') AS f5,
    count(*) FILTER (WHERE first_fail IS NULL AND fare_amount = 0 AND payment_type <> 'No Charge') AS zero_fare,
    count(*) FILTER (WHERE first_fail IS NULL) AS n_out
  FROM ff GROUP BY city),
dqb AS (SELECT *, n_in AS b1, n_in - f1 AS b2, n_in - f1 - f2 AS b3, n_in - f1 - f2 - f3 AS b4,
          CASE WHEN n_in = 0 THEN 100.0E0 ELSE {R('n_out / n_in * 100', 1)} END AS comp FROM dqc),
dq_log AS (
  SELECT city, 1 AS check_seq, 'null_check_pickup_datetime' AS check_name, 'stg_taxi_trips' AS table_name,
    CASE WHEN null_pickup_datetime = 0 THEN 'PASS' ELSE 'FAIL' END AS status, '0' AS expected, CAST(null_pickup_datetime AS VARCHAR) AS actual FROM dqb
  UNION ALL SELECT city, 2, 'null_check_trip_distance_miles', 'stg_taxi_trips',
    CASE WHEN null_trip_distance_miles = 0 THEN 'PASS' ELSE 'FAIL' END, '0', CAST(null_trip_distance_miles AS VARCHAR) FROM dqb
  UNION ALL SELECT city, 3, 'null_check_fare_amount', 'stg_taxi_trips',
    CASE WHEN null_fare_amount = 0 THEN 'PASS' ELSE 'FAIL' END, '0', CAST(null_fare_amount AS VARCHAR) FROM dqb
  {''.join(f'''UNION ALL SELECT city, {3 + i}, '{n}', 'stg_taxi_trips',
    CASE WHEN f{i} = 0 THEN 'PASS' WHEN f{i} < b{i} * CAST({S.DQ_WARN_SHARE} AS DOUBLE) THEN 'WARN' ELSE 'FAIL' END,
    'in range', CAST(f{i} AS VARCHAR) || ' out of range' FROM dqb
  ''' for i, n in enumerate(['fare_range', 'distance_range', 'passenger_range', 'duration_range'], start=1))}
  UNION ALL SELECT city, 8, 'date_range', 'stg_taxi_trips', CASE WHEN f5 = 0 THEN 'PASS' ELSE 'WARN' END,
    '2019-now', CAST(f5 AS VARCHAR) || ' bad' FROM dqb
  UNION ALL SELECT city, 9, 'zero_fare', 'stg_taxi_trips', CASE WHEN zero_fare = 0 THEN 'PASS' ELSE 'WARN' END,
    '0', CAST(zero_fare AS VARCHAR) FROM dqb
  UNION ALL SELECT city, 10, 'completeness', 'stg_taxi_trips', CASE WHEN comp >= {S.DQ_COMPLETENESS_PASS} THEN 'PASS' ELSE 'WARN' END,
    '≥{S.DQ_COMPLETENESS_PASS}%', CASE WHEN n_in = 0 THEN '100' ELSE CAST(CAST(comp AS DECIMAL(5,1)) AS VARCHAR) END || '%' FROM dqb)
"""


def dq_sql(p, tail):
    return with_base(p, DQ_CTES + tail)


def _log(ws):
    return Q.dq_log(ws.dq_counts)


@register("dq_log", lambda p: dq_sql(p, "SELECT * FROM dq_log"))
def dq_log(ws):
    return _log(ws)


@register("dq_null_checks", lambda p: dq_sql(p, "SELECT * FROM dq_log WHERE check_name LIKE 'null_check_%'"))
def dq_null_checks(ws):
    return _log(ws).filter(F.col("check_name").startswith("null_check_"))


@register("dq_range_checks", lambda p: dq_sql(p, "SELECT * FROM dq_log WHERE check_name LIKE '%_range' AND check_name <> 'date_range'"))
def dq_range_checks(ws):
    return _log(ws).filter(F.col("check_name").isin(*[c[0] for c in Q.RANGE_CHECKS]))


# "now" a week before the last pickup, so the date check rejects rows (WARN).
DATE_CHECK = DEFAULT.with_(as_of=datetime(2024, 3, 25))


@register("dq_date_check", lambda p: dq_sql(p, "SELECT * FROM dq_log WHERE check_name = 'date_range'"), DATE_CHECK)
def dq_date_check(ws):
    return _log(ws).filter(F.col("check_name") == "date_range")


@register("dq_zero_fare", lambda p: dq_sql(p, "SELECT * FROM dq_log WHERE check_name = 'zero_fare'"))
def dq_zero_fare(ws):
    return _log(ws).filter(F.col("check_name") == "zero_fare")


@register("dq_completeness", lambda p: dq_sql(p, f"""
SELECT city, n_in AS original_rows, n_out AS kept_rows, n_in - n_out AS rejected_rows, comp AS completeness_pct,
  CASE WHEN comp >= {S.DQ_COMPLETENESS_PASS} THEN 'PASS' ELSE 'WARN' END AS status FROM dqb"""))
def dq_completeness(ws):
    return Q.dq_completeness(ws.dq_counts)


@register("dq_survivors", lambda p: with_base(p, "SELECT trip_id, city, batch_id FROM ff WHERE first_fail IS NULL"))
def dq_survivors(ws):
    return Q.survivors(ws.enriched, ws.params).select("trip_id", "city", "batch_id")


@register("dq_rejects", lambda p: with_base(p, """
SELECT city, coalesce(first_fail, 'kept') AS reason, count(*) AS n_rows FROM ff GROUP BY ALL"""))
def dq_rejects(ws):
    return Q.dq_rejects(ws.enriched)


REPORT_CTES = """
, st AS (SELECT city, count(*) AS stg_trips, count(*) FILTER (WHERE fare_amount < 0) AS neg_fares,
           count(*) FILTER (WHERE pickup_neighborhood IS NULL) AS null_hoods FROM staged GROUP BY city),
hp AS (SELECT city, count(DISTINCT hour) AS hours_covered,
          count(*) FILTER (WHERE pulse_score < 0 OR pulse_score > 100) AS bad_pulse FROM hourly GROUP BY city),
x AS (SELECT coalesce(st.city, hp.city) AS city, coalesce(stg_trips, 0) AS stg_trips, coalesce(neg_fares, 0) AS neg_fares,
         coalesce(null_hoods, 0) AS null_hoods, coalesce(hours_covered, 0) AS hours_covered, coalesce(bad_pulse, 0) AS bad_pulse
      FROM st FULL OUTER JOIN hp ON st.city = hp.city)
"""


def report_sql(p, lead=""):
    """The report's rows; ``lead`` gives columns before them, with {i} the check's place."""
    rows = [("stg_trips_not_empty", "stg_taxi_trips", "stg_trips > 0", "FAIL", ">0", "stg_trips"),
            ("hourly_coverage", "agg_hourly_pulse", f"hours_covered >= {p.hours_covered_min}", "WARN", f">={p.hours_covered_min} hours", "hours_covered"),
            ("no_negative_fares", "stg_taxi_trips", "neg_fares = 0", "FAIL", "0", "neg_fares"),
            ("no_null_neighborhoods", "stg_taxi_trips", "null_hoods = 0", "WARN", "0", "null_hoods"),
            ("pulse_score_range", "agg_hourly_pulse", "bad_pulse = 0", "FAIL", "0-100", "bad_pulse")]
    return " UNION ALL ".join(f"SELECT {lead.replace('{i}', str(i))}city, '{n}' AS check_name, '{t}' AS table_name, CASE WHEN {ok} THEN 'PASS' ELSE '{bad}' END AS status, "
                              f"'{e}' AS expected, CAST({a} AS VARCHAR) AS actual FROM x" for i, (n, t, ok, bad, e, a) in enumerate(rows, 1))


# the check log of the loads, one by one
LOAD_DQ = DQ_CTES.replace("SELECT city, ", "SELECT load, city, ").replace("FROM ff GROUP BY city", "FROM ff_l GROUP BY load, city")


def recent_sql(p):
    return with_base(p, LOAD_ROWS + REPORT_CTES + LOAD_DQ + f"""
, log AS (
  SELECT 'trips_backfill-' || CAST(load AS VARCHAR) AS run_id, load AS moment, check_seq, city, check_name, table_name, status, expected, actual FROM dq_log
  UNION ALL {report_sql(p, f"'trips_daily-{p.as_of_date}' AS run_id, 99 AS moment, {{i}} AS check_seq, ")})
SELECT * EXCLUDE (moment) FROM (SELECT * FROM log ORDER BY moment DESC, city DESC, check_seq DESC LIMIT {p.dq_recent_n})""")


@register("dq_recent", recent_sql)
def dq_recent(ws):
    log = ETL.check_log(ws.spark, ws.loads.base)
    return SV.dq_recent(log, ws.params.dq_recent_n).select("run_id", "city", "check_seq", "check_name", "table_name", "status", "expected", "actual")


@register("dq_warehouse_report", lambda p: with_base(p, REPORT_CTES + report_sql(p)))
def dq_warehouse_report(ws):
    return Q.warehouse_checks(ws.stored.read(ETL.TOTALS), ws.mart(ETL.HOURLY), ws.params).drop("check_seq")
