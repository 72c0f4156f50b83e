"""The run log: an append-only table of run events, and the check log.

A run appends a 'running' row when it starts and its final row when it ends
or fails, so a run that died is still to be seen as running.  Rows are of the
whole load (city NULL) and, at the end, of each city in it; the counts come
from the passes that wrote the load.  Both tables are folders of small files.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import runs as RU

EVENTS = ("run_id string, dag_id string, task_id string, city string, status string, started_at timestamp_ntz, finished_at timestamp_ntz, "
          "rows_extracted long, rows_loaded long, rows_rejected long, rows_inserted long, error_message string, event_seq int")


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class RunLog:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.path = spark, f"{base.rstrip('/')}/pipeline_runs"

    def append(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(self.path)

    def start(self, run_id: str, dag_id: str, task_id: str, at: datetime) -> None:
        self.append([(run_id, dag_id, task_id, None, "running", at, None, 0, 0, 0, 0, None, 1)])

    def finish(self, run_id: str, dag_id: str, task_id: str, started: datetime, status: str, counts: dict[str | None, tuple], error: str | None = None) -> None:
        """``counts`` by city (None: the load): rows extracted, loaded (clean), inserted into staging."""
        end = now()
        self.append([(run_id if city is None else f"{run_id}:{city}", dag_id, task_id, city, status, started, end, x, n, x - n, i, error, 2)
                     for city, (x, n, i) in counts.items()])

    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENTS).parquet(self.path)

    def latest(self) -> DataFrame:
        """The last state of each run."""
        return RU.run_latest(self.events())


def stamped(log: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """Rows of the check log with their run and time."""
    return log.withColumn("run_id", F.lit(run_id)).withColumn("logged_at", F.lit(at).cast("timestamp_ntz"))
