"""Spark session set-up and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job wants: AQE re-plans joins/partition counts at run time,
# skew-join splits hot partitions, UTC keeps zoned conversions stable.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Generated methods over 8000 bytes are not JIT-compiled by HotSpot; at
    # this limit Spark splits such a stage instead of running it interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Runtime SQL settings a library may apply to a caller's session: only when
# the caller left Spark's default in place.
RUNTIME_DEFAULTS = {
    "spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
    # A split of 128 MB of Parquet is gigabytes of rows: what a task sorts or
    # aggregates of its split would spill.
    "spark.sql.files.maxPartitionBytes": ("128MB", "32MB"),
    # The same for what a task reads of a shuffle: rows sorted in memory take
    # ten times their shuffled bytes.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("64MB", "24MB"),
    # A task that writes a few partitions (cities, loads) keeps a file open for
    # each, instead of sorting its rows by partition first.
    "spark.sql.maxConcurrentOutputFileWriters": ("0", "16"),
}
SHUFFLE, INITIAL = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLITS = "spark.sql.files.minPartitionNum"
INPUT_PER_PARTITION = 4 * 2**20     # compressed bytes of the input tables
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SET: dict[tuple[int, str], str] = {}


def tune(spark: SparkSession, input_bytes: int = 0) -> None:
    """Apply the settings above; with the input's size, also let shuffles start
    with a number of partitions that grows with it (AQE merges small ones) and
    cut files into at least that many splits, so that a task's sort or hash
    table does not grow with the input."""
    for k, (spark_default, ours) in RUNTIME_DEFAULTS.items():
        if spark.conf.get(k, spark_default) == spark_default:
            spark.conf.set(k, ours)
    n = -(-input_bytes // INPUT_PER_PARTITION)
    _put(spark, INITIAL, n if n > int(spark.conf.get(SHUFFLE, "200")) else 0)
    _put(spark, SPLITS, n)


def _put(spark: SparkSession, key: str, n: int) -> None:
    """Sets ``key`` to ``n`` (0: unset), unless its value is the caller's own."""
    if spark.conf.get(key, None) != _SET.get((id(spark), key)):
        return
    if n:
        spark.conf.set(key, str(n))
        _SET[id(spark), key] = str(n)
    else:
        spark.conf.unset(key)
        _SET.pop((id(spark), key), None)


def shuffle_width(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session starts with."""
    n = spark.conf.get(SHUFFLE, "200")
    merged = all(spark.conf.get(k, "true") == "true" for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled"))
    return int(spark.conf.get(INITIAL, n) if merged else n)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What the writes within shuffle leaves the disk when each is done, not
    when the driver happens to collect its garbage (a setting of the caller's
    own stays).  For writes whose frame is not used again."""
    own = spark.conf.get(FREED, None) is None
    if own:
        spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if own:
            spark.conf.unset(FREED)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tripmetrics", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only when it is unset (local tests) do we pick a scratch
    folder of our own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="tripmetrics-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster, because the checkpoint folder is the cluster's shared one)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
