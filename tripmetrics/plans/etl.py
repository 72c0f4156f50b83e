"""The batch ETL job: loads, daily roll-up and backfill over stored tables.

    run_etl       raw landing -> clean + check log -> staging (insert-or-ignore)
                  -> hourly / neighbourhood / daily marts, readings by hour and
                  running totals, merged into the days the load touches
    run_daily     weekly trends, weather impact and the warehouse report, from
                  the stored marts of the trailing window
    run_backfill  many loads, those applied already left out, then run_daily

Layout under ``out_dir`` (shared storage): ``raw_trips``, ``raw_weather``
(JSON text by load and city), ``dq_log``, ``pipeline_runs``, and the tables of
``warehouse.Warehouse``.  The cleaned batch is written once and later steps
read it back, so a lost executor only re-runs the step it was in; of trips
that are a plain scan of stored files already each step makes the cleaned rows
anew instead, and their JSON text is written when the staged rows no longer lie
on the disk twice.  What a write shuffled leaves the disk with it.  One commit
record makes all tables of a load current together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as CL
from ..operators import marts as M
from ..operators import merge as MG
from ..operators import quality as Q
from ..session import freed_shuffles
from ..settings import Params
from ..sources import feeds as FD
from ..sources.dims import Dims
from .runlog import RunLog, now, stamped
from .warehouse import Warehouse

HOURLY, NEIGHBORHOOD, DAILY = "agg_hourly_pulse", "agg_neighborhood_stats", "agg_daily_summary"
WEEKLY, IMPACT, READINGS, TOTALS = "agg_weekly_trends", "agg_weather_impact", "weather_by_hour", "city_totals"
COMPUTED = {"computed_at": "new"}
MART_RULES = {
    HOURLY: (MG.HOURLY_KEYS, MG.HOURLY_RULES | COMPUTED),
    NEIGHBORHOOD: (MG.NEIGHBORHOOD_KEYS, MG.NEIGHBORHOOD_RULES | COMPUTED),
    DAILY: (MG.DAILY_KEYS, MG.DAILY_RULES | COMPUTED),
}
STAGED_TRIPS, STAGED_WEATHER = "stg_taxi_trips", "stg_weather"
TASK = "transform_load"


def _landed(df: DataFrame, load_id: int, path: str, *parts: str) -> DataFrame:
    """Writes a load under its own partition, in place of an earlier try of it; returns it as read back."""
    out = df.withColumn("ingested_at", F.lit(now()).cast("timestamp_ntz")).withColumn("load_id", F.lit(load_id))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy("load_id", *parts).parquet(path))
    return df.sparkSession.read.option("basePath", path).parquet(f"{path}/load_id={load_id}")


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], int]]:
    """The frame, and its row count once the job that writes it is done."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), lambda: seen.get["n"]


def run_etl(spark: SparkSession, trips: DataFrame, weather: DataFrame, out_dir: str, dims: Dims, params: Params, load_id: int,
            run_id: str | None = None, dag_id: str = "trips", buckets: int | None = None, landed: bool = False) -> dict:
    """Run one load and log the run.  ``landed``: the trips are a plain scan of
    stored files that stay as they are.  A load already applied changes nothing
    but the run log; loads may come late or out of order: each is merged once,
    in the order of arrival.  A load that fails leaves a failed run and no
    change that readers see, and can be run again."""
    wh, log = Warehouse(spark, out_dir, buckets), RunLog(spark, out_dir)
    run_id, started = run_id or f"{dag_id}-{load_id}", now()
    if wh.applied(load_id):
        return {"load_id": load_id, "run_id": run_id, "out_dir": wh.base, "applied": False}
    log.start(run_id, dag_id, TASK, started)
    counts: dict = {None: (0, 0, 0)}
    try:
        with freed_shuffles(spark):
            stats = _load(spark, wh, trips, weather, dims, params, load_id, run_id, counts, landed)
    except Exception as e:
        log.finish(run_id, dag_id, TASK, started, "failed", {c: (0, 0, 0) for c in counts}, str(e)[:2000])
        raise
    log.finish(run_id, dag_id, TASK, started, "success", counts)
    wh.drop(f"_batches/load={load_id}")
    return {"load_id": load_id, "run_id": run_id, "out_dir": wh.base, "applied": True, **stats}


def _load(spark: SparkSession, wh: Warehouse, trips: DataFrame, weather: DataFrame, dims: Dims, params: Params, load_id: int, run_id: str,
          counts: dict, landed: bool = False) -> dict:
    out, seq, batch = wh.base, wh.next_seq(), f"{wh.base}/_batches/load={load_id}"
    if "batch_id" not in trips.columns:  # records from a feed: the load is the batch
        trips = trips.withColumn("batch_id", F.lit(load_id).cast("int"))
    with ThreadPoolExecutor(8) as pool:     # independent jobs, many of them of a few small tasks
        go = lambda f, *args: pool.submit(inheritable_thread_target(spark)(f), *args)
        weather_done = go(_load_weather, wh, weather, load_id, seq)
        # raw layer: JSON text by load and city
        seen_trips, extracted = _counted(FD.land_trips(trips), f"trips-{run_id}")

        def land(after: Future | None = None) -> DataFrame:
            wait([] if after is None else [after])
            return _landed(seen_trips, load_id, f"{out}/raw_trips", "city")

        landing = None if landed else go(land)
        # clean + quality: written once and read back, or made anew of landed trips
        enriched = Q.with_first_fail(CL.enrich_trips(trips, dims), params)
        if not landed:
            enriched.write.mode("overwrite").option("compression", "zstd").parquet(f"{batch}/enriched")
            enriched = spark.read.parquet(f"{batch}/enriched")
        clean = Q.survivors(enriched, params).select(*CL.KEEP_COLUMNS, "batch_id")
        checked = go(_check, enriched, f"{batch}/dq", f"{out}/dq_log", load_id, run_id)
        # staging: insert-or-ignore against what other loads staged
        fresh = MG.stage_trips(clean, wh.staged(STAGED_TRIPS, _staged_schema(clean), "trip_id", without=load_id), CL.of_pickup())
        staging = go(wh.stage, STAGED_TRIPS, fresh.withColumn("loaded_at", F.lit(now()).cast("timestamp_ntz")), "trip_id", load_id)
        landing = landing or go(land, staging)     # landed trips: beside the staged rows, not beside their shuffle
        # marts: the small cube is written once; only the load's days are merged
        M.trip_cube(clean).write.mode("overwrite").parquet(f"{batch}/cube")
        cube = spark.read.parquet(f"{batch}/cube")
        days = [r["d"] for r in cube.select(F.col("day").cast("string").alias("d")).distinct().collect()]
        at = F.lit(now()).cast("timestamp_ntz").alias("computed_at")
        merging = {name: go(wh.merge, name, df.select("*", at), *MART_RULES[name], days, seq) for name, df in
                   ((HOURLY, M.hourly_pulse(cube)), (NEIGHBORHOOD, M.neighborhood_stats(cube)), (DAILY, M.daily_summary(cube)))}
        raw = landing.result()
        cities = [r["city"] for r in raw.select(F.col("city").cast("string").alias("city")).where("city is not null").distinct().collect()]
        counts.update(dict.fromkeys([None, *cities], (0, 0, 0)))
        raw_weather, readings, by_hour = weather_done.result()
        (dq, checks), staged = checked.result(), staging.result()
        changed = {name: job.result() for name, job in merging.items()} | {READINGS: by_hour}
    # one row a city (a bounded dimension): what the load adds to the totals, and what the run log says
    delta = MG.city_totals(raw, raw_weather, dq, checks, staged, readings)
    rows = delta.collect()
    totals = spark.createDataFrame(rows, delta.schema).withColumn("part", F.lit("all"))
    changed[TOTALS] = wh.merge(TOTALS, totals, ["city", "part"], dict.fromkeys(MG.TOTALS, "+"), ["all"], seq, "part")
    counts.update({r["city"]: (r["raw_trips"], r["clean_trips"], r["stg_trips"]) for r in rows if r["city"] in cities})
    counts[None] = extracted(), sum(r["clean_trips"] for r in rows), sum(r["stg_trips"] for r in rows)
    wh.commit(load_id, seq, changed)
    return {"raw_trips": counts[None][0], "stg_trips_loaded": counts[None][1], "stg_trips_inserted": counts[None][2], "days": len(days)}


def _load_weather(wh: Warehouse, weather: DataFrame, load_id: int, seq: int) -> tuple:
    """Lands and stages a load's readings and merges the latest of each hour;
    returns the landed rows, the staged ones and what the merge changed."""
    raw = _landed(FD.land_weather(weather), load_id, f"{wh.base}/raw_weather", "city")
    w = CL.extract_weather(weather)
    fresh = MG.stage_weather(w, wh.staged(STAGED_WEATHER, _staged_schema(w), "weather_id", without=load_id))
    staged = wh.stage(STAGED_WEATHER, fresh.withColumn("loaded_at", F.lit(now()).cast("timestamp_ntz")), "weather_id", load_id)
    by_hour = M.latest_readings(staged)
    days = [r["date"] for r in by_hour.select("date").distinct().collect()]
    return raw, staged, wh.merge(READINGS, by_hour, ["city", "date", "hour"], {"reading": "max"}, days, seq)


def _check(enriched: DataFrame, counts_path: str, log_path: str, load_id: int, run_id: str) -> tuple[DataFrame, DataFrame]:
    """The check counts of a load (one pass) and its rows of the check log, both as written."""
    Q.dq_counts(enriched).coalesce(1).write.mode("overwrite").parquet(counts_path)
    dq = enriched.sparkSession.read.parquet(counts_path)
    checks = stamped(Q.dq_log(dq), run_id, now())
    (checks.withColumn("load_id", F.lit(load_id)).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("load_id").parquet(log_path))
    return dq, checks


def _staged_schema(rows: DataFrame):
    return rows.limit(0).withColumn("loaded_at", F.lit(None).cast("timestamp_ntz")).schema


def staged_trips(wh: Warehouse, like: DataFrame) -> DataFrame | None:
    """Staged trips of all applied loads, with ``load_id`` and ``loaded_at``."""
    return wh.staged(STAGED_TRIPS, _staged_schema(like), "trip_id")


def staged_weather(wh: Warehouse, like: DataFrame) -> DataFrame | None:
    return wh.staged(STAGED_WEATHER, _staged_schema(like), "weather_id")


def readings(wh: Warehouse, since: str | None = None) -> DataFrame | None:
    """The latest reading of each city and hour."""
    r = wh.read(READINGS, since)
    return None if r is None else r.select("city", "date", "hour", "reading.*")


def replay(spark: SparkSession, out_dir: str, load_id: int) -> DataFrame:
    """The trips of a landed load, decoded from its JSON; rows that are no
    records are kept whole in ``quarantine``, in place of an earlier replay's."""
    out = out_dir.rstrip("/")
    landed = FD.landed_files(spark, f"{out}/raw_trips").where(F.col("load_id") == load_id)
    (FD.quarantined(landed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(f"{out}/quarantine"))
    return FD.replay_trips(landed)


def run_daily(spark: SparkSession, out_dir: str, params: Params, dag_id: str = "trips_daily") -> dict:
    """The daily roll-up: weekly trends (merged by their rules), weather impact
    of the trailing window (replaced) and the warehouse report, from the stored
    marts; only the window's days are opened.  Run again it gives the same
    rows.  Nothing is done, and False returned, before the first load."""
    wh, log, task = Warehouse(spark, out_dir), RunLog(spark, out_dir), "daily_rollup"
    run_id, started = f"{dag_id}-{params.as_of_date}", now()
    since = M.week_start(params)
    hourly, daily, totals = wh.read(HOURLY, since), wh.read(DAILY, since), wh.read(TOTALS)
    if totals is None:
        return {"run_id": run_id, "applied": False}
    log.start(run_id, dag_id, task, started)
    try:
        seq, at = wh.next_seq(), F.lit(now()).cast("timestamp_ntz").alias("computed_at")
        weekly = M.weekly_trends(daily, hourly, params).select("*", at)
        changed = {WEEKLY: wh.merge(WEEKLY, weekly, MG.WEEKLY_KEYS, MG.WEEKLY_RULES | COMPUTED, [since], seq, "week_start"),
                   IMPACT: wh.write(IMPACT, M.impact(hourly, readings(wh, since)).select("*", at), seq)}
        report = stamped(Q.warehouse_checks(totals, wh.read(HOURLY), params), run_id, now())
        (report.withColumn("load_id", F.lit(run_id)).coalesce(1).write.mode("overwrite")
               .option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(f"{wh.base}/dq_log"))
        wh.commit(run_id, seq, changed)
    except Exception as e:
        log.finish(run_id, dag_id, task, started, "failed", {None: (0, 0, 0)}, str(e)[:2000])
        raise
    log.finish(run_id, dag_id, task, started, "success", {None: (0, 0, 0)})
    return {"run_id": run_id, "applied": True}


def check_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """All rows of the check log, of loads and reports, with run and time."""
    cols = "city string, check_seq int, check_name string, table_name string, status string, expected string, actual string, run_id string, logged_at timestamp_ntz, load_id string"
    return spark.read.schema(cols).parquet(f"{out_dir.rstrip('/')}/dq_log")


def run_backfill(spark: SparkSession, loads: Iterable[tuple[int, DataFrame, DataFrame]], out_dir: str, dims: Dims, params: Params,
                 dag_id: str = "trips_backfill", buckets: int | None = None) -> dict:
    """Run (load id, trips, weather) in their order, then the daily roll-up.
    Loads applied by an earlier try are left out, so a backfill that died is
    run again from its first missing load."""
    done = [run_etl(spark, t, w, out_dir, dims, params, i, dag_id=dag_id, buckets=buckets) for i, t, w in loads]
    run_daily(spark, out_dir, params)
    ran = [s for s in done if s["applied"]]
    return {"total_loaded": sum(s["stg_trips_loaded"] for s in ran), "chunks": len(done), "ran": len(ran)}
