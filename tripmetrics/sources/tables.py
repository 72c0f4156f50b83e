"""Parquet scans of the input tables, projected to the columns a plan uses
(Catalyst pushes the projection and any filter into the Parquet reader)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def bounded_broadcast(df: DataFrame, max_rows: int, otherwise: str | None = None) -> DataFrame:
    """Broadcast ``df`` only after checking it holds at most ``max_rows`` rows.

    Used for dimension tables whose size is bounded by their definition
    (regions, nations, cities).  Above the bound the frame is returned
    unhinted (or with the join hint ``otherwise``, e.g. "merge") and the
    planner / AQE choose a shuffle join from runtime sizes.  The check is a
    ``limit(max_rows + 1)`` count, made each time: a table that has grown is
    seen to have grown.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df.hint(otherwise) if otherwise else df


_SMALL_ROWS: dict[int, list] = {}


def small_rows(df: DataFrame, max_rows: int) -> list:
    """Rows of a dimension known to be small, fetched once per session.

    Raises if the frame holds more than ``max_rows`` rows: this is only for
    bounded lookups (a city's airports or tariff), never for data.
    """
    key = df.semanticHash()
    rows = _SMALL_ROWS.get(key)
    if rows is None:
        rows = df.limit(max_rows + 1).collect()
        if len(rows) > max_rows:
            raise ValueError(f"lookup of more than {max_rows} rows")
        _SMALL_ROWS[key] = rows
    return rows
