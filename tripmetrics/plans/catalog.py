"""Query registry: key -> (Spark plan builder, oracle SQL builder).

Every key reads the driver tables of ``sf_dir`` (through the fixture
adapters) and returns a lazy DataFrame.  Keys that need a different "now"
carry their own ``Params``.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from ..settings import Params
from .workspace import Workspace, fingerprint, present


@dataclass
class Entry:
    key: str
    build: Callable[[Workspace], DataFrame]
    sql: Callable[[Params], str] | None
    params: Params


REGISTRY: dict[str, Entry] = {}
TRIP_TABLES = re.compile(r"/(lineitem|orders|events)\.parquet\b")   # the tables that grow
DEFAULT = Params()
JANUARY = Params(as_of=datetime(2024, 1, 31))  # weather covers January only


def register(key: str, sql: Callable[[Params], str] | None = None, params: Params = DEFAULT):
    def deco(fn: Callable[[Workspace], DataFrame]):
        REGISTRY[key] = Entry(key, fn, sql, params)
        return fn
    return deco


_WORKSPACES: dict = {}


def workspace(spark: SparkSession, sf_dir: str, params: Params) -> Workspace:
    """One Workspace per (session, input folder and its files, parameters): its
    attributes are plans and stored tables that keys share instead of re-reading
    file footers and rebuilding the same plan for every query."""
    k = (id(spark), sf_dir, params, fingerprint(spark, sf_dir))
    ws = _WORKSPACES.get(k)
    if ws is None or ws.spark is not spark:
        ws = _WORKSPACES[k] = Workspace(spark, sf_dir, params)
    return ws


def run(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    e = REGISTRY[key]
    tune(spark, sum(size for path, size, _ in fingerprint(spark, sf_dir) if TRIP_TABLES.search(path)))
    return present(e.build(workspace(spark, sf_dir, e.params)))


def oracle(key: str) -> str | None:
    e = REGISTRY[key]
    return e.sql(e.params) if e.sql else None
