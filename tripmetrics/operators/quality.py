"""Sequential data-quality checks in one pass.

The checks run in order and each one only sees the rows the earlier ones
kept.  Instead of filtering step by step, every row gets the name of the
first check it fails (``first_fail``); one grouped aggregate per city then
gives every count, and each check's base is the input count minus the
rows rejected before it.  Survivors are ``first_fail IS NULL`` (written
as the conjunction of the checks so each part can be pushed down).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import columns as C
from ..settings import Params

TABLE = "stg_taxi_trips"

# (check name, column, low, high) - checked in this order, rows failing are rejected.
RANGE_CHECKS = [
    ("fare_range", "fare_amount", 0, S.MAX_FARE_AMOUNT),
    ("distance_range", "trip_distance_miles", 0, S.MAX_TRIP_DISTANCE_MILES),
    ("passenger_range", "passenger_count", S.MIN_PASSENGER_COUNT, S.MAX_PASSENGER_COUNT),
    ("duration_range", "trip_duration_min", 0, S.MAX_TRIP_DURATION_MIN),
]
NULL_CHECK_COLUMNS = ["pickup_datetime", "trip_distance_miles", "fare_amount"]
REJECT_ORDER = [c[0] for c in RANGE_CHECKS] + ["date_range"]


def checks(params: Params) -> list[tuple[str, Column]]:
    """(name, passes) of every rejecting check, in order."""
    tests = [(name, C.in_range(col, lo, hi)) for name, col, lo, hi in RANGE_CHECKS]
    tests.append(("date_range", C.in_range(
        "pickup_datetime", F.lit(S.DQ_MIN_PICKUP).cast("timestamp_ntz"),
        F.lit(params.as_of_ts).cast("timestamp_ntz"))))
    return tests


def with_first_fail(df: DataFrame, params: Params) -> DataFrame:
    """Add ``first_fail``: the first rejecting check of the row, or NULL."""
    expr = None
    for name, ok in checks(params):
        expr = (F.when(~ok, F.lit(name)) if expr is None else expr.when(~ok, F.lit(name)))
    return df.withColumn("first_fail", expr.otherwise(F.lit(None).cast("string")))


def survivors(df: DataFrame, params: Params) -> DataFrame:
    """Rows passing every check.  Written as a conjunction (equal to
    ``first_fail IS NULL``) so Catalyst can push each check down to the
    earliest operator that has its columns - down to the scan."""
    ok = None
    for _, t in checks(params):
        ok = t if ok is None else ok & t
    return df.filter(ok)


def dq_counts(df_ff: DataFrame, keys=("city",)) -> DataFrame:
    """One row per city with every number the check log needs."""
    ff = F.col("first_fail")
    aggs = [F.count(F.lit(1)).alias("n_in")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in NULL_CHECK_COLUMNS]
    aggs += [F.count_if(ff == n).alias(f"fail_{n}") for n in REJECT_ORDER]
    aggs.append(F.count_if(ff.isNull() & (F.col("fare_amount") == 0)
                           & (F.col("payment_type") != "No Charge")).alias("zero_fare"))
    aggs.append(F.count_if(ff.isNull()).alias("n_out"))
    return df_ff.groupBy(*keys).agg(*aggs)


def _range_status(fails, base):
    return (F.when(fails == 0, F.lit("PASS"))
             .when(fails < base * F.lit(S.DQ_WARN_SHARE), F.lit("WARN"))
             .otherwise(F.lit("FAIL")))


def dq_log(counts: DataFrame, keys=("city",)) -> DataFrame:
    """The check log: one row per check and city, in check order."""
    entries = []
    seq = 0

    def entry(name, status, expected, actual):
        nonlocal seq
        seq += 1
        return F.struct(F.lit(seq).alias("check_seq"), F.lit(name).alias("check_name"),
                        F.lit(TABLE).alias("table_name"), status.alias("status"),
                        F.lit(expected).alias("expected"), actual.cast("string").alias("actual"))

    for c in NULL_CHECK_COLUMNS:
        n = F.col(f"null_{c}")
        entries.append(entry(f"null_check_{c}", F.when(n == 0, "PASS").otherwise("FAIL"), "0", n))
    base = F.col("n_in")
    for name, _, _, _ in RANGE_CHECKS:
        fails = F.col(f"fail_{name}")
        entries.append(entry(name, _range_status(fails, base), "in range",
                             F.concat(fails.cast("string"), F.lit(" out of range"))))
        base = base - fails
    bad = F.col("fail_date_range")
    entries.append(entry("date_range", F.when(bad == 0, "PASS").otherwise("WARN"), "2019-now",
                         F.concat(bad.cast("string"), F.lit(" bad"))))
    zf = F.col("zero_fare")
    entries.append(entry("zero_fare", F.when(zf == 0, "PASS").otherwise("WARN"), "0", zf))
    comp = completeness_col()
    entries.append(entry("completeness",
                         F.when(comp >= S.DQ_COMPLETENESS_PASS, "PASS").otherwise("WARN"),
                         f"≥{S.DQ_COMPLETENESS_PASS}%",
                         F.concat(F.when(F.col("n_in") == 0, F.lit("100"))
                                  .otherwise(comp.cast("decimal(5,1)").cast("string")), F.lit("%"))))
    return counts.select(*keys, F.inline(F.array(*entries)))


def completeness_col():
    n_in, n_out = F.col("n_in"), F.col("n_out")
    return F.when(n_in == 0, F.lit(100.0)).otherwise(C.rnd(n_out / n_in * 100, 1))


def dq_rejects(df_ff: DataFrame) -> DataFrame:
    """Kept and rejected rows per city and reason."""
    return (df_ff.groupBy("city", F.coalesce(F.col("first_fail"), F.lit("kept")).alias("reason"))
                 .agg(F.count(F.lit(1)).alias("n_rows")))


def dq_completeness(counts: DataFrame) -> DataFrame:
    comp = completeness_col()
    return counts.select("city", F.col("n_in").alias("original_rows"), F.col("n_out").alias("kept_rows"),
                         (F.col("n_in") - F.col("n_out")).alias("rejected_rows"),
                         comp.alias("completeness_pct"),
                         F.when(comp >= S.DQ_COMPLETENESS_PASS, "PASS").otherwise("WARN").alias("status"))


def warehouse_report(staged: DataFrame, hourly: DataFrame, params: Params) -> DataFrame:
    """Five warehouse checks per city: one conditional aggregate per table."""
    st = staged.groupBy("city").agg(
        F.count(F.lit(1)).alias("stg_trips"),
        F.count_if(F.col("fare_amount") < 0).alias("neg_fares"),
        F.count_if(F.col("pickup_neighborhood").isNull()).alias("null_hoods"))
    return warehouse_checks(st, hourly, params).drop("check_seq")


def warehouse_checks(totals: DataFrame, hourly: DataFrame, params: Params) -> DataFrame:
    """The same checks from each city's running totals and the hourly mart."""
    hp = hourly.groupBy("city").agg(
        F.countDistinct("hour").alias("hours_covered"),
        F.count_if((F.col("pulse_score") < 0) | (F.col("pulse_score") > 100)).alias("bad_pulse"))
    x = totals.select("city", "stg_trips", "neg_fares", "null_hoods").join(hp, "city", "full_outer").select(
        "city", *[F.coalesce(F.col(c), F.lit(0)).alias(c)
                  for c in ("stg_trips", "neg_fares", "null_hoods", "hours_covered", "bad_pulse")])

    seq = iter(range(1, 6))

    def e(name, table, status, expected, actual):
        return F.struct(F.lit(next(seq)).alias("check_seq"), F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
                        status.alias("status"), F.lit(expected).alias("expected"),
                        F.col(actual).cast("string").alias("actual"))

    ok = lambda c, bad: F.when(F.col(c) == 0, "PASS").otherwise(bad)
    return x.select("city", F.inline(F.array(
        e("stg_trips_not_empty", TABLE, F.when(F.col("stg_trips") > 0, "PASS").otherwise("FAIL"), ">0", "stg_trips"),
        e("hourly_coverage", "agg_hourly_pulse",
          F.when(F.col("hours_covered") >= params.hours_covered_min, "PASS").otherwise("WARN"),
          f">={params.hours_covered_min} hours", "hours_covered"),
        e("no_negative_fares", TABLE, ok("neg_fares", "FAIL"), "0", "neg_fares"),
        e("no_null_neighborhoods", TABLE, ok("null_hoods", "WARN"), "0", "null_hoods"),
        e("pulse_score_range", "agg_hourly_pulse", ok("bad_pulse", "FAIL"), "0-100", "bad_pulse"),
    )))
