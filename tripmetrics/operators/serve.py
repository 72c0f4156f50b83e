"""Read queries over staging and the marts, for all cities at once.

A "LIMIT n" of the original (which answers one city per call) is n per
city here: ``row_number`` over the city window followed by ``<= n``, which
Spark plans as a WindowGroupLimit (a map-side top-n per city before the
shuffle), so a city holding most rows never reaches one task whole.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..settings import Params


# Spark applies the map-side WindowGroupLimit up to this n
# (spark.sql.optimizer.windowGroupLimitThreshold); above it use latest_n_per.
WINDOW_LIMIT_MAX = 1000


def top_n_per(df: DataFrame, part: list[str], order: list, n: int) -> DataFrame:
    """First n rows per group.  Up to ``WINDOW_LIMIT_MAX`` every map task
    takes a partial top-n, so a group never reaches a task whole; above it
    the answer is the same without that step, which suits mart-sized tables
    (``latest_n_per`` is for large ones)."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def latest_n_per(df: DataFrame, part: str, ts: str, order: list, n) -> DataFrame:
    """The n latest rows of each ``part`` by ``order`` (which must start with
    ``ts`` descending), for n too large for a map-side window limit.

    Exact, and no task sorts a whole group: rows are counted per (part, hour)
    - a small pre-aggregated table - and a running sum over hours from the
    latest finds each group's boundary hour.  Hours after it are taken whole
    (a join, no sort); only the boundary hour's rows are ranked.  ``n`` is an
    int or a column of ``df`` (a per-group limit).
    """
    n_col = F.lit(n) if isinstance(n, int) else F.col(n)
    day = F.date_trunc("hour", F.col(ts))
    x = df.withColumn("_day", day).withColumn("_n", n_col)
    days = x.groupBy(part, "_day").agg(F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"))
    w = Window.partitionBy(part).orderBy(F.col("_day").desc()).rowsBetween(Window.unboundedPreceding, 0)
    days = (days.withColumn("_upto", F.sum("_c").over(w))
                .withColumn("_before", F.col("_upto") - F.col("_c"))
                .filter(F.col("_before") < F.col("_n"))
                .select(part, "_day", (F.col("_upto") <= F.col("_n")).alias("_whole"),
                        (F.col("_n") - F.col("_before")).alias("_rest")))
    d = days.withColumnRenamed(part, "_p").withColumnRenamed("_day", "_d")
    y = x.join(d, (F.col(part) == F.col("_p")) & F.col("_day").eqNullSafe(F.col("_d"))).drop("_p", "_d")
    whole = y.filter(F.col("_whole"))
    edge = y.filter(~F.col("_whole"))
    rw = Window.partitionBy(part, "_day").orderBy(*order)
    edge = edge.withColumn("_rn", F.row_number().over(rw)).filter(F.col("_rn") <= F.col("_rest")).drop("_rn")
    return whole.unionByName(edge).drop("_day", "_n", "_whole", "_rest")


def days_back(params: Params, days: int) -> str:
    return (params.as_of - timedelta(days=days)).strftime("%Y-%m-%d")


def weekday_pattern(hourly: DataFrame) -> DataFrame:
    """Per (city, weekday, hour): mean trips, pulse and fare of the hourly
    mart (day name is a function of the weekday, so it is a key too)."""
    return hourly.groupBy("city", "day_of_week", "day_name", "hour").agg(
        F.avg("trip_count").alias("avg_trips"),
        F.avg("pulse_score").alias("avg_pulse"),
        F.avg("avg_fare").alias("avg_fare"))


def neighborhood_totals(nbhd: DataFrame) -> DataFrame:
    """Per (city, neighbourhood) over all days; daily averages are averaged
    unweighted, as the original does."""
    return nbhd.groupBy("city", "neighborhood").agg(
        F.sum("trip_count").alias("total_trips"),
        F.avg("avg_fare").alias("avg_fare"),
        F.sum(F.col("total_revenue").cast("decimal(24,6)")).cast("double").alias("total_revenue"),
        F.avg("avg_distance").alias("avg_distance"))


def hour_profile(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("city", "hour").agg(
        F.avg("trip_count").alias("avg_trips"),
        F.avg("pulse_score").alias("avg_pulse"),
        F.avg("avg_fare").alias("avg_fare"),
        F.avg("total_revenue").alias("avg_revenue"),
        F.count(F.lit(1)).alias("data_points"))


def top_hours(hourly: DataFrame, n: int) -> DataFrame:
    """The n hours with the highest mean pulse per city (earlier hour on ties)."""
    prof = hour_profile(hourly).select(
        "city", "hour", *[C.rnd(c, 6).alias(c) for c in ("avg_trips", "avg_pulse", "avg_fare", "avg_revenue")],
        "data_points")
    return top_n_per(prof, ["city"], [F.col("avg_pulse").desc(), F.col("hour")], n)


def busiest_hour(hourly: DataFrame) -> DataFrame:
    """Hour with the highest mean trip count per city (earliest on ties)."""
    prof = hour_profile(hourly).withColumn("avg_trips", C.rnd("avg_trips", 6))
    return prof.groupBy("city").agg(
        F.max_by("hour", F.struct(F.col("avg_trips"), -F.col("hour"))).alias("busiest_hour"),
        F.max("avg_trips").alias("max_avg_trips"))


def kpis(totals: DataFrame, runs: DataFrame, hourly: DataFrame) -> DataFrame:
    """Headline numbers per city, from its running totals, the run log and the
    hourly mart; no raw or staged row is read."""
    mean = lambda s, n: F.coalesce(C.rnd(F.col(s).cast("double") / F.when(F.col(n) > 0, F.col(n)), 6), F.lit(0.0))
    st = totals.where("stg_trips > 0").select(
        "city", F.col("stg_trips").alias("total_trips"), F.col("revenue").cast("double").alias("total_revenue"),
        mean("fare_sum", "fare_n").alias("avg_fare"), mean("speed_sum", "speed_n").alias("avg_speed"))
    ok = F.col("status") == "success"
    rn = runs.where("city is not null").groupBy("city").agg(
        F.count_if(ok).alias("pipeline_runs"),
        F.max(F.when(ok, F.col("finished_at"))).alias("last_run"),
        F.max_by(F.when(ok, F.col("run_id")), F.when(ok, F.col("finished_at"))).alias("last_run_id"))
    bh = busiest_hour(hourly).select("city", "busiest_hour")
    return (st.join(rn, "city", "left").join(bh, "city", "left")
              .select("city", "total_trips", "total_revenue", "avg_fare", "avg_speed",
                      F.coalesce("pipeline_runs", F.lit(0)).alias("pipeline_runs"), "last_run", "last_run_id", "busiest_hour"))


DATA_COUNT_METRICS = ["raw_trips", "stg_trips", "agg_hourly", "agg_daily", "agg_nbhd",
                      "weather_rows", "pipeline_runs"]


def _counts(totals: DataFrame, kept: dict[str, str], tables: dict[str, DataFrame]) -> DataFrame:
    """Per city: running totals (column -> name) and the rows of small tables."""
    rows = totals.select("city", *[F.col(c).alias(n) for c, n in kept.items()], *[F.lit(0).cast("long").alias(n) for n in tables])
    for name, df in tables.items():
        own = df.groupBy("city").agg(F.count(F.lit(1)).alias(name))
        rows = rows.unionByName(own.select("city", *[F.col(c) if c == name else F.lit(0).cast("long").alias(c) for c in rows.columns[1:]]))
    return rows.groupBy("city").agg(*[F.sum(c).alias(c) for c in rows.columns[1:]])


def data_counts(totals: DataFrame, tables: dict[str, DataFrame], dq_log: DataFrame) -> DataFrame:
    """Row counts per city of each layer: of raw and staged layers as they were
    counted when they came, of marts and the run log now; the check-log count
    is global, as in the original."""
    wide = _counts(totals, {c: c for c in ("raw_trips", "stg_trips", "weather_rows")}, tables).select("city", *DATA_COUNT_METRICS)
    n = dq_log.groupBy().agg(F.count(F.lit(1)).alias("dq_checks"))
    # one-row global total: a broadcast join on a constant key (size 1 by construction)
    return wide.withColumn("_k", F.lit(1)).join(F.broadcast(n.withColumn("_k", F.lit(1))), "_k", "left").drop("_k")


def run_stats(totals: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Per city: what the loads read, kept and wrote (attempted and actually
    inserted staging rows both given), and the rejected count."""
    kept = {"raw_trips": "raw_trips", "raw_weather": "raw_weather", "clean_trips": "stg_trips_loaded", "stg_trips": "stg_trips_inserted",
            "weather_rows": "stg_weather_loaded"}
    return _counts(totals, kept, tables).withColumn("rows_rejected", F.col("raw_trips") - F.col("stg_trips_loaded"))


def available_cities(totals: DataFrame) -> DataFrame:
    """Cities with trips, the one with most trips first."""
    return totals.where("stg_trips > 0").select("city", F.col("stg_trips").alias("trip_count")).orderBy(F.col("trip_count").desc(), "city")


def city_catalog(dim_city: DataFrame, totals: DataFrame) -> DataFrame:
    """Every configured city, with has_data and its trip count (0 if none)."""
    avail = available_cities(totals)
    return dim_city.select("city", "display_name", "country", "currency").join(avail, "city", "left").select(
        "city", "display_name", "country", "currency",
        F.col("trip_count").isNotNull().alias("has_data"),
        F.coalesce(F.col("trip_count"), F.lit(0)).cast("bigint").alias("trip_count"))


def hours_covered(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("city").agg(F.countDistinct("hour").alias("hours_covered"))


def recent_hourly(hourly: DataFrame, params: Params, days: int) -> DataFrame:
    """Hourly rows of the last days, by date and hour."""
    return hourly.filter(F.col("date") >= days_back(params, days)).orderBy("date", "hour", "city")


def recent_daily(daily: DataFrame, params: Params, days: int) -> DataFrame:
    """Daily rows of the last days, the newest first."""
    return daily.filter(F.col("date") >= days_back(params, days)).orderBy(F.col("date").desc(), "city")


def recent_weather_impact(wi: DataFrame, n: int) -> DataFrame:
    return top_n_per(wi, ["city"], [F.col("date").desc(), F.col("hour").desc()], n)


def recent_trips(staged: DataFrame, n: int) -> DataFrame:
    """The n latest trips per city, for any n."""
    order = [F.col("pickup_datetime").desc(), F.col("trip_id")]
    if n > WINDOW_LIMIT_MAX:
        return latest_n_per(staged, "city", "pickup_datetime", order, n)
    return top_n_per(staged, ["city"], order, n)


def run_history(runs: DataFrame, n: int, per_city: bool = True) -> DataFrame:
    """The n latest runs per city, or of all cities together."""
    order = [F.col("started_at").desc(), F.col("run_id")]
    return top_n_per(runs, ["city"], order, n) if per_city else runs.orderBy(*order).limit(n)


def dq_recent(dq_log: DataFrame, n: int, run_id: str | None = None) -> DataFrame:
    """All check rows of a run, or the latest n of all runs: the newest first,
    those of one moment from the last city and check back."""
    order = [F.col("logged_at").desc(), F.col("city").desc(), F.col("check_seq").desc()]
    return dq_log.orderBy(*order).limit(n) if run_id is None else dq_log.where(F.col("run_id") == run_id).orderBy(*order)


def top_neighborhoods(totals: DataFrame, n: int) -> DataFrame:
    return top_n_per(totals, ["city"], [F.col("total_trips").desc(), F.col("neighborhood")], n)


def weather_scatter(wi: DataFrame) -> DataFrame:
    """Points with a temperature and trips; class rain > snow > dry."""
    return wi.filter(F.coalesce(F.col("temp_f") != 0, F.lit(False)) & F.coalesce(F.col("trip_count") != 0, F.lit(False))) \
        .select("city", "date", "hour", "temp_f", "trip_count",
                F.when(F.col("is_rain") == 1, "rain").when(F.col("is_snow") == 1, "snow").otherwise("dry").alias("weather_class"))
