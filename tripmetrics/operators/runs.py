"""Run accounting: run statistics, the run log and its latest state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN_COLUMNS = ["run_id", "dag_id", "task_id", "city", "status", "started_at", "finished_at",
               "rows_extracted", "rows_loaded", "rows_rejected", "rows_inserted", "error_message"]


def run_latest(events: DataFrame) -> DataFrame:
    """Latest state per run id (insert-or-replace at start, update at end);
    a run id that starts again takes the place of its earlier run."""
    rest = [c for c in RUN_COLUMNS if c != "run_id"]
    return (events.groupBy("run_id").agg(F.max_by(F.struct(*rest), F.struct("started_at", "event_seq")).alias("r"))
                  .select("run_id", "r.*"))


def batch_stats(runs: DataFrame) -> DataFrame:
    """Backfill summary per city, from the run log: attempted staging rows
    summed over chunks, chunk count."""
    ok = runs.where("status = 'success' and city is not null")
    return ok.groupBy("city").agg(F.sum("rows_loaded").cast("bigint").alias("total_loaded"), F.count(F.lit(1)).alias("chunks"))
