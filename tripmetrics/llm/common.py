"""What several operators share: shared storage, batches, names, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Rows per Arrow batch: a batch of long texts must fit a Python worker.
BATCH_ROWS = "1000"
WIDE_EDGES = 1_000_000


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on, only where Spark's own default
    still stands."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, BATCH_ROWS)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: cuts the
    lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_dir(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder in shared storage for files that tasks write."""
    path = scratch_path(spark, name)
    return path if "://" in path else ("file://" + path.removeprefix("file:"))


def open_fs(uri: str):
    """(file system, path) of a URI, usable in tasks and on the driver."""
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def attempt_name(prefix: str, suffix: str) -> str:
    """A file name of this task attempt alone.  Only files named in rows that
    Spark committed are ever read, so a lost or repeated attempt leaves at
    most an unread file."""
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


def fresh(columns: list[str], name: str) -> str:
    """``name``, or a longer form of it that no column has (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def col(name: str) -> Column:
    """A top-level column by exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def components(nodes_edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges (a, b): rows (id, root),
    root the smallest id reachable, one row for each id that has an edge.

    Alternating large-star / small-star rounds: each round links the larger
    neighbours of a node (then the smaller ones) to the node's smallest
    neighbour, so every edge set stays linear in the first one and a node
    with very many neighbours is only ever aggregated with min(), never
    gathered.  Each round is written to shared storage; the end is reached
    when a round changes no edge.  Over ``WIDE_EDGES`` edges the minima are
    written too, so that both sides of the joins come from plain shuffles and
    the skew join can split a hub.
    """
    e = (nodes_edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v"))
         .where("u is not null and v is not null and u <> v"))
    e = materialize(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    seen, put = None, lambda d: d
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = put(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = (both.where("v > u").join(low, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = put(large.distinct())
        low2 = put(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(low2, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v")).where("u <> v").distinct())
        e = materialize(small, name)
        stat = e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"),
                     F.sum(F.expr("xxhash64(v, u) >> 24"))).first()
        if tuple(stat) == seen:
            break
        seen = tuple(stat)
        if seen[0] > WIDE_EDGES:
            put = lambda d: materialize(d, name)
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    return (e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()))
