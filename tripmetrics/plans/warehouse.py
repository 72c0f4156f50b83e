"""The warehouse's stored tables: Parquet folders and a commit record a load.

Tables that are merged (marts, weekly roll-up, weather) are cut by day:
``<table>/day=<d>/v=<n>`` holds the rows that commit n wrote for a day.  A
commit writes only the days it touches, next to the versions readers use, and
then one record ``_commits/<n>.json``, created exclusively, that names every
table's current versions and the loads in them.  So all tables change in one
step; a load that dies before leaves files no record names, and its repetition
overwrites them; a reader opens only the days it asks for.

Staged records are one bucketed table a kind (bucketed by their key, a partition
a load), so that a load meets the stored keys without moving them.
Of these, too, only loads that a record names are read.

The record grows by some 30 bytes a day and table and 20 a load.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge as MG
from ..session import shuffle_width

COMMITS = "_commits"
#: Buckets that a step of staging shuffles and writes at once.
STAGE_BUCKETS = 720


class Warehouse:
    def __init__(self, spark: SparkSession, base: str, buckets: int | None = None):
        self.spark, self.base = spark, base.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._buckets = buckets or shuffle_width(spark)
        self._frames: dict = {}

    # -- files -----------------------------------------------------------------
    def _names(self, folder: str) -> list[str]:
        p = self._path(f"{self.base}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def exists(self, folder: str) -> bool:
        return self._fs.exists(self._path(f"{self.base}/{folder}"))

    def drop(self, folder: str) -> None:
        self._fs.delete(self._path(f"{self.base}/{folder}"), True)

    # -- commit records --------------------------------------------------------
    def _record(self, name: str) -> dict | None:
        """A record, or None for one whose writer died in it."""
        f = self._fs.open(self._path(f"{self.base}/{COMMITS}/{name}"))
        try:
            text = bytes(f.readAllBytes()).decode()
        finally:
            f.close()
        return json.loads(text) if text.endswith("}\n") else None

    def head(self) -> dict:
        """The newest complete record."""
        for name in sorted(self._names(COMMITS), reverse=True):
            if name.endswith(".json") and (record := self._record(name)) is not None:
                return record
        return {"seq": 0, "loads": {}, "tables": {}, "schemas": {}, "buckets": self._buckets}

    def next_seq(self) -> int:
        return max([int(n[:-5]) for n in self._names(COMMITS) if n.endswith(".json")], default=0) + 1

    def applied(self, load) -> bool:
        return str(load) in self.head()["loads"]

    def commit(self, load, seq: int, changed: dict[str, tuple[list[str], T.StructType]]) -> None:
        """Makes what ``write`` wrote as ``seq`` current, and the load applied.
        Raises if another writer took the number."""
        record = self.head()
        record["loads"][str(load)] = record["seq"] = seq
        for table, (days, schema) in changed.items():
            record["tables"].setdefault(table, {}).update(dict.fromkeys(days, seq))
            record["schemas"][table] = schema.jsonValue()
        out = self._fs.create(self._path(f"{self.base}/{COMMITS}/{seq:012d}.json"), False)
        try:
            out.write(bytearray((json.dumps(record) + "\n").encode()))
        finally:
            out.close()

    # -- day tables ------------------------------------------------------------
    def days(self, table: str) -> list[str]:
        return sorted(self.head()["tables"].get(table, {}))

    def read(self, table: str, since: str | None = None, days: list[str] | None = None) -> DataFrame | None:
        """The table's current rows, of the days from ``since`` on or of the
        listed ones; None if it was never written."""
        head = self.head()
        if table not in head["schemas"]:
            return None
        want = None if days is None else set(days)
        parts = [(d, v) for d, v in sorted(head["tables"][table].items()) if (since is None or d >= since) and (want is None or d in want)]
        key = (table, tuple(parts))
        if key not in self._frames:
            schema = T.StructType.fromJson(head["schemas"][table])
            paths = [f"{self.base}/{table}/day={d}/v={v}" for d, v in parts]
            self._frames[key] = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return self._frames[key]

    def write(self, table: str, df: DataFrame, seq: int, day: str = "date") -> tuple[list[str], T.StructType]:
        """Writes rows as version ``seq`` of their days; a day is one task's
        work (marts hold a bounded number of rows a day).  Returns the days
        written and the schema, for ``commit``."""
        out = df.withColumn("day", F.coalesce(F.col(day).cast("string"), F.lit("none"))).withColumn("v", F.lit(seq))
        (out.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "v").parquet(f"{self.base}/{table}"))
        mine = f"v={seq}"
        return [d[4:] for d in self._names(table) if d.startswith("day=") and self.exists(f"{table}/{d}/{mine}")], df.schema

    def merge(self, table: str, df: DataFrame, keys: list[str], rules: dict, days: list[str], seq: int,
              day: str = "date") -> tuple[list[str], T.StructType]:
        """Merges a load's rows, all of ``days``, into those days alone."""
        old = self.read(table, days=days)
        new = df.select(*keys, *rules)
        return self.write(table, new if old is None else MG.merge_upsert(old, new, keys, rules), seq, day)

    def vacuum(self, keep: int = 2) -> int:
        """Deletes versions that none of the newest ``keep`` records names (and
        that are not newer than them); returns how many."""
        records = [r for n in sorted(self._names(COMMITS), reverse=True)[:keep] if (r := self._record(n)) is not None]
        if not records:
            return 0
        newest, gone = max(r["seq"] for r in records), 0
        for table in records[0]["tables"]:
            for d in self._names(table):
                used = {r["tables"].get(table, {}).get(d[4:]) for r in records}
                for v in self._names(f"{table}/{d}") if d.startswith("day=") else []:
                    if v.startswith("v=") and int(v[2:]) <= newest and int(v[2:]) not in used:
                        self.drop(f"{table}/{d}/{v}")
                        gone += 1
        return gone

    # -- staged records --------------------------------------------------------
    def _staging(self, table: str, schema: T.StructType, key: str) -> str:
        name = f"{table}_{hashlib.md5(self.base.encode(), usedforsecurity=False).hexdigest()[:12]}"
        if not self.spark.catalog.tableExists(name):
            there = self.exists(table)
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            n = self.head()["buckets"]
            self.spark.sql(f"CREATE TABLE {name} ({cols}, load_id STRING) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (load_id) "
                           f"CLUSTERED BY ({key}) INTO {n} BUCKETS LOCATION '{self.base}/{table}'")
            if there:
                self.spark.catalog.recoverPartitions(name)
        return name

    def staged(self, table: str, schema: T.StructType, key: str, without=None) -> DataFrame | None:
        """Staged rows of the applied loads, with ``load_id``; None if there are none."""
        loads = [x for x in self.head()["loads"] if x != str(without)]
        if not loads or not self.exists(table):
            return None
        return self.spark.table(self._staging(table, schema, key)).where(F.col("load_id").isin(loads))

    def stage(self, table: str, rows: DataFrame, key: str, load) -> DataFrame:
        """Writes a load's partition, in place of an earlier try; returns it as read back.
        The rows are those of ``merge.insert_or_ignore``, dealt by the hash of
        their key already: they are dealt again only if the session's shuffles
        are of another width than the table's buckets.  A task writes the few
        buckets it holds side by side, without sorting its rows for them.  Of
        many buckets ``STAGE_BUCKETS`` are made at a time, so that the disk
        holds no shuffle of the whole load beside its rows."""
        name = self._staging(table, rows.schema, key)
        n = self.head()["buckets"]
        bucket = F.pmod(F.hash(F.col(key)), F.lit(n))
        if self.exists(f"{table}/load_id={load}"):      # of a try that died; no reader sees it
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (load_id = '{load}')")
            self.drop(f"{table}/load_id={load}")
        for first in range(0, n, STAGE_BUCKETS):
            some = rows if n <= STAGE_BUCKETS else rows.where(bucket.between(first, first + STAGE_BUCKETS - 1))
            some = some if n == shuffle_width(self.spark) else some.repartition(n, key)
            # a frame's write, not SQL text: only of that does freed_shuffles free the shuffle
            some.withColumn("load_id", F.lit(str(load))).write.insertInto(name)
        return self.spark.table(name).where(F.col("load_id") == str(load)).drop("load_id")
