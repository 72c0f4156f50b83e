"""Plan assembly over one set of input tables.

``Workspace`` wires sources -> cleaning -> quality -> marts as lazy DataFrame
plans, built once per workspace; each query key picks the plans it needs.
Two things run jobs when first asked for: the raw layer is landed, and the
stored tables that read queries use are made by the ETL job, once for all
records as one load (``stored``) and once load by load (``loads``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import clean as CL
from ..operators import marts as M
from ..operators import merge as MG
from ..operators import quality as Q
from ..session import freed_shuffles, scratch_path
from ..settings import Params
from ..sources import adapters as A
from ..sources.dims import Dims, fixture_dims
from . import etl as ETL
from .warehouse import Warehouse


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params | None = None,
                 dims: Dims | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.params = params or Params()
        self._dims = dims

    # -- sources -----------------------------------------------------------
    @cached_property
    def dims(self) -> Dims:
        return self._dims or fixture_dims(self.spark, self.sf_dir)

    @cached_property
    def raw_trips(self) -> DataFrame:
        return land(self.spark, self.sf_dir, "trips", A.trips_from_tables)

    @cached_property
    def raw_weather(self) -> DataFrame:
        return land(self.spark, self.sf_dir, "weather", A.weather_from_tables)

    # -- cleaning + quality --------------------------------------------------
    @cached_property
    def enriched(self) -> DataFrame:
        """Enriched trips (null pickups dropped) with ``first_fail``."""
        return Q.with_first_fail(CL.enrich_trips(self.raw_trips, self.dims), self.params)

    @cached_property
    def clean(self) -> DataFrame:
        return Q.survivors(self.enriched, self.params).select(*CL.KEEP_COLUMNS, "batch_id")

    @cached_property
    def dq_counts(self) -> DataFrame:
        return Q.dq_counts(self.enriched)

    @cached_property
    def weather(self) -> DataFrame:
        return CL.extract_weather(self.raw_weather)

    # -- marts (single batch: all clean trips are one load) -----------------
    @cached_property
    def cube(self) -> DataFrame:
        return M.trip_cube(self.clean)

    @cached_property
    def hourly(self) -> DataFrame:
        return M.hourly_pulse(self.cube)

    @cached_property
    def neighborhood(self) -> DataFrame:
        return M.neighborhood_stats(self.cube)

    @cached_property
    def daily(self) -> DataFrame:
        return M.daily_summary(self.cube)

    # -- marts of a trailing window ------------------------------------------
    def clean_since(self, day: str) -> DataFrame:
        """Clean trips picked up on or after ``day`` (yyyy-MM-dd).  The bound
        is on the raw pickup column, so it reaches the Parquet scan as a
        pushed filter (row groups outside the window are skipped); it equals
        the marts' ``date >= day`` on the derived date text."""
        return self.clean.filter(F.col("pickup_datetime") >= F.lit(f"{day} 00:00:00").cast("timestamp_ntz"))

    def hourly_since(self, day: str) -> DataFrame:
        return M.hourly_pulse(M.trip_cube(self.clean_since(day)))

    def daily_since(self, day: str) -> DataFrame:
        return M.daily_summary(M.trip_cube(self.clean_since(day)))

    # -- per-batch marts for the fold ---------------------------------------
    @cached_property
    def batch_cube(self) -> DataFrame:
        return M.trip_cube(self.clean, ["batch_id"])

    # -- stored tables -----------------------------------------------------
    @cached_property
    def stored(self) -> Warehouse:
        """The warehouse after all records as one load and a daily roll-up."""
        out = scratch_path(self.spark, "warehouse")
        ETL.run_etl(self.spark, self.raw_trips, self.raw_weather, out, self.dims, self.params, 0, landed=True)
        ETL.run_daily(self.spark, out, self.params)
        return Warehouse(self.spark, out)

    @cached_property
    def loads(self) -> Warehouse:
        """The warehouse after a backfill of the fixture's loads one by one;
        each load also sends again a tenth of the one before."""
        out = scratch_path(self.spark, "warehouse-loads")
        order = F.substring_index("trip_id", "-", 1).cast("long")
        again = lambda b: (F.col("batch_id") == b - 1) & (order % 10 == 0)
        chunks = [(b, self.raw_trips.where((F.col("batch_id") == b) | again(b)), self.raw_weather) for b in range(A.N_BATCHES)]
        ETL.run_backfill(self.spark, chunks, out, self.dims, self.params)
        return Warehouse(self.spark, out)

    def mart(self, name: str, since: str | None = None, loads: bool = False) -> DataFrame:
        """A stored mart; with ``since`` only its days from there on are opened."""
        return (self.loads if loads else self.stored).read(name, since).drop("computed_at")

    @property
    def stored_trips(self) -> DataFrame:
        return ETL.staged_trips(self.stored, self.clean).drop("load_id", "loaded_at")

    @property
    def stored_weather(self) -> DataFrame:
        return ETL.staged_weather(self.stored, self.weather).drop("load_id", "loaded_at")

    # -- staging -----------------------------------------------------------
    @cached_property
    def staged(self) -> DataFrame:
        return MG.stage_trips(self.clean, derived=CL.of_pickup())

    @cached_property
    def staged_weather(self) -> DataFrame:
        return MG.stage_weather(self.weather)


_LANDED: dict = {}


def fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input tables' files, so that what was
    made from other files is never taken for theirs."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out, todo = [], list(fs.listStatus(path))
    while todo:
        f = todo.pop()
        if f.isDirectory():
            todo += fs.listStatus(f.getPath())
        else:
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def land(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """The raw layer: records mapped from the input tables are written once
    per session and state of the input files to the shared scratch folder and
    read back, as the original lands raw records before transforming them.
    Every plan then starts from a plain Parquet scan (parallel, prunable)
    instead of re-running the mapping joins, and lineage is cut there."""
    k = (id(spark), sf_dir, name, fingerprint(spark, sf_dir))
    hit = _LANDED.get(k)
    if hit is not None and hit[0] is spark:
        return spark.read.parquet(hit[1])
    df = build(spark, sf_dir)
    path = scratch_path(spark, f"raw-{name}")
    with freed_shuffles(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    _LANDED[k] = (spark, path)
    return spark.read.parquet(path).select(*df.columns)


def present(df: DataFrame) -> DataFrame:
    """Query output form: zone-less timestamps as ISO text (as the original
    stores them), everything else unchanged."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("timestamp_ntz", "timestamp"):
            out.append(C.ts_text(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
