"""Incremental loads as Structured Streaming queries.

The original merges each hourly run into stored marts.  Here every run is
a set of new files in a landing folder and a streaming query picks them up
(``trigger(availableNow=True)`` drains what has landed, then stops):

* ``stream_clean``  - the batch cleaning plan applied to the stream; file sink.
* ``stream_dedupe`` - insert-or-ignore across runs by ``trip_id`` against
  the staged rows of earlier epochs, for trips of any age.
* ``stream_hourly`` - the hourly mart kept up with the stream.
* ``stream_fold``   - the hourly mart after the loads in the stream, merged by
  the column rules in load order.

The two marts are stored tables cut by day (``plans.warehouse``), with the sums
they are made of (per load, hour and neighbourhood) beside them.  A micro-batch
adds its partial sums to the days it touches, makes those days' mart rows anew
and commits both in one record named after the epoch, so a replayed epoch
counts once, a restarted query reads only files it has not seen, and no other
day is read or written.  There is no watermark: late rows of any age are added
to their hour, as in the original, and the state is the stored table itself.

All paths are under the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as CL
from ..operators import marts as M
from ..operators import merge as MG
from ..operators import quality as Q
from ..plans.warehouse import Warehouse
from ..session import scratch_path
from ..settings import Params
from ..sources.dims import Dims


def land_batches(df: DataFrame, path: str, batch_col: str = "batch_id") -> None:
    """Land the loads as files partitioned by load id (one job, any number
    of files per load; the stream does not depend on file boundaries)."""
    df.write.mode("append").partitionBy(batch_col).parquet(path)


BYTES_PER_TRIGGER = 512 * 2**20


def _read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """Stream the landing folder, a micro-batch at most ``BYTES_PER_TRIGGER``
    of files, or ``files_per_trigger`` files if that is given: every
    micro-batch makes the days it touches anew, so small files are taken
    together.  This only paces the micro-batches."""
    pace = ("maxBytesPerTrigger", BYTES_PER_TRIGGER) if files_per_trigger is None else ("maxFilesPerTrigger", files_per_trigger)
    return spark.readStream.schema(schema).option(*pace).option("latestFirst", "false").parquet(path)


def clean_stream(stream: DataFrame, dims: Dims, params: Params) -> DataFrame:
    """The batch cleaning plan, unchanged, on a streaming frame (the quality
    survivors are a row-local filter, so they stream)."""
    return Q.survivors(CL.enrich_trips(stream, dims), params).select(*CL.KEEP_COLUMNS, "batch_id")


def _drain(q):
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def stream_clean(spark: SparkSession, landing: str, schema, dims: Dims, params: Params) -> DataFrame:
    out, ck = scratch_path(spark, "stream-clean-out"), scratch_path(spark, "stream-clean-ck")
    q = (clean_stream(_read_stream(spark, landing, schema), dims, params)
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start())
    _drain(q)
    return spark.read.parquet(out)


def stream_dedupe(spark: SparkSession, landing: str, schema, dims: Dims, params: Params,
                  state_dir: str | None = None) -> DataFrame:
    """Staging rows of all loads, each trip id once, whatever its age.

    A micro-batch is inserted-or-ignored against the rows that earlier epochs
    staged in a table bucketed by trip id, whose keys are neither shuffled nor
    sorted for it; a replayed epoch that was committed changes nothing, another
    takes its own place.  No watermark is needed and no state is kept beside
    the table itself."""
    base = state_dir or scratch_path(spark, "stream-dedupe")
    rows = clean_stream(_read_stream(spark, landing, schema), dims, params)

    def insert(batch: DataFrame, epoch: int):
        wh, load = Warehouse(batch.sparkSession, base), f"epoch-{epoch}"
        if not wh.applied(load):
            wh.stage(STAGED, MG.stage_trips(batch, wh.staged(STAGED, rows.schema, "trip_id", without=load), CL.of_pickup()), "trip_id", load)
            wh.commit(load, wh.next_seq(), {})

    q = rows.writeStream.option("checkpointLocation", f"{base}/_checkpoint").foreachBatch(insert).trigger(availableNow=True).start()
    _drain(q)
    staged = Warehouse(spark, base).staged(STAGED, rows.schema, "trip_id")
    return spark.createDataFrame([], rows.schema) if staged is None else staged.drop("load_id")


STAGED = "staged"
CUBE, MART = "stream_cube", "stream_mart"
CUBE_KEYS = ["batch_id", "city", "date", "hour", "day_of_week", "neighborhood"]


def _keep(spark: SparkSession, landing: str, schema, dims: Dims, params: Params, base: str, mart: Callable[[DataFrame], DataFrame]) -> Warehouse:
    """Drain the landing folder into the stored sums and the mart of them."""
    wh = Warehouse(spark, base)

    def add(batch: DataFrame, epoch: int):
        load = f"epoch-{epoch}"
        if wh.applied(load):
            return
        seq, path = wh.next_seq(), f"{base}/_epoch"
        M.trip_cube(batch, ["batch_id"]).withColumn("date", F.col("day").cast("string")).drop("day").write.mode("overwrite").parquet(path)
        part = spark.read.parquet(path)
        days = [r["date"] for r in part.select("date").distinct().collect()]
        changed = {CUBE: wh.merge(CUBE, part, CUBE_KEYS, dict.fromkeys(M.SUMS, "+"), days, seq)}
        sums = spark.read.schema(changed[CUBE][1]).parquet(*[f"{base}/{CUBE}/day={d}/v={seq}" for d in days]) if days else part
        changed[MART] = wh.write(MART, mart(sums.withColumn("day", F.col("date").cast("date"))), seq)
        wh.commit(load, seq, changed)

    q = (clean_stream(_read_stream(spark, landing, schema), dims, params)
         .writeStream.option("checkpointLocation", f"{base}/_checkpoint")
         .foreachBatch(add).trigger(availableNow=True).start())
    _drain(q)
    return wh


def stream_hourly(spark: SparkSession, landing: str, schema, dims: Dims, params: Params,
                  state_dir: str | None = None) -> DataFrame:
    """The hourly mart over all records of the stream."""
    base = state_dir or scratch_path(spark, "stream-hourly")
    return _keep(spark, landing, schema, dims, params, base, M.hourly_pulse).read(MART)


def stream_fold(spark: SparkSession, landing: str, schema, dims: Dims, params: Params,
                keys=MG.HOURLY_KEYS, rules=MG.HOURLY_RULES, state_dir: str | None = None) -> DataFrame:
    """The loads in the stream merged into the hourly mart by the column
    rules, in load order, whether a load came in several micro-batches or
    several loads in one.  Pass the same ``state_dir`` again to resume."""
    base = state_dir or scratch_path(spark, "stream-fold")
    return _keep(spark, landing, schema, dims, params, base, lambda sums: MG.fold(M.hourly_pulse(sums, ["batch_id"]), keys, rules)).read(MART)


def landing_for(spark: SparkSession, trips: DataFrame) -> str:
    path = scratch_path(spark, "landing")
    land_batches(trips, path)
    return path
