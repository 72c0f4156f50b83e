"""Monthly trip files: a ``year=<y>/month=<m>`` layout under one declared schema.

Files of different months come with different columns and types (a column
that is missing, new, or an integer in one month and a double in the next).
Each month is read by its own files' schema and brought to the declared one:
a missing column is NULL, a further one is left out, a value that does not fit
the declared type is NULL.  Only the folders of the months asked for are
listed and opened; there are twelve a year, however large they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .feeds import TRIP_RECORD_SCHEMA


def months(spark: SparkSession, path: str) -> list[str]:
    """The months (yyyy-MM) that have a folder, in order."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/year=*/month=*")) or []
    parts = [(f.getPath().getParent().getName(), f.getPath().getName()) for f in found]
    return sorted(f"{int(y.removeprefix('year=')):04d}-{int(m.removeprefix('month=')):02d}" for y, m in parts)


def read_months(spark: SparkSession, path: str, first: str | None = None, last: str | None = None, schema: StructType = TRIP_RECORD_SCHEMA) -> DataFrame:
    """Rows of the months from ``first`` to ``last`` (yyyy-MM, inclusive), as ``schema``."""
    frames = []
    for m in months(spark, path):
        if (first is None or m >= first) and (last is None or m <= last):
            year, month = m.split("-")
            folder = next(f for f in (f"{path.rstrip('/')}/year={year}/month={x}" for x in (str(int(month)), month)) if _exists(spark, f))
            df = spark.read.parquet(folder)
            have = {c.lower(): c for c in df.columns}
            frames.append(df.select(*[(F.col(f"`{have[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name)
                                      for f in schema]))
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_months(trips: DataFrame, path: str, time: str = "pickup_datetime") -> None:
    """Writes trips in the layout, by the month of ``time``."""
    (trips.withColumn("year", F.year(time)).withColumn("month", F.month(time)).write.mode("append").partitionBy("year", "month").parquet(path))
