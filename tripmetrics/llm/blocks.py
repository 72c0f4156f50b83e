"""Comparing the members of hash buckets, block by block.

A bucket with more than ``BLOCK`` members is dealt into blocks by a hash of
the member's id, and each pair of blocks is a group of its own, so a hot
bucket becomes many groups of at most about two blocks and every pair of
members still meets in exactly one of them.  Groups are compared in numpy
inside the tasks; what leaves a task is up to the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions

BLOCK = 512
GROUP = ["t", "k", "i", "j"]


def shared_buckets(keys: DataFrame, block: int = BLOCK) -> DataFrame:
    """Of rows (t, k, id) those in buckets of two or more, as (t, k, i, j, id,
    own): a row for each group the member takes part in."""
    size = keys.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    rows = keys.join(size.select("t", "k", F.ceil(F.col("n") / block).cast("int").alias("nb")), ["t", "k"])
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id", F.lit(29)), F.col("nb")).cast("int"))
    rows = rows.withColumn("o", F.explode(F.expr("sequence(0, nb - 1)")))
    return rows.select("t", "k", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "id", "own")


def grouped(rows: DataFrame) -> DataFrame:
    """Rows of a group together and in order."""
    return rows.repartition(partitions(rows.sparkSession), *GROUP).sortWithinPartitions(*GROUP, "id")


def whole_groups(batches, fn: Callable[[object], Iterator]) -> Iterator:
    """Calls ``fn`` with tables of whole groups; columns t, k, i, j first."""
    import pyarrow as pa
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        n = table.num_rows
        if not n:
            continue
        edges = group_starts(table)
        last = int(edges[-1])
        if last:
            yield from fn(table.slice(0, last).combine_chunks())
        held = table.slice(last).combine_chunks()
    if held is not None and held.num_rows:
        yield from fn(held)


def group_starts(table) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for c in range(4):
        v = table.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def pairs(table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (p, q), p before q, of members that meet in a group: at
    distance 1, then 2, and so on, over all groups of the table at once."""
    n = table.num_rows
    starts = group_starts(table)
    end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    own, same = table.column(5).to_numpy(), table.column(2).to_numpy() == table.column(3).to_numpy()
    p, d = np.arange(n), 1
    while True:
        p = p[p + d < end[p]]
        if not len(p):
            return
        q = p + d
        ok = same[p] | (own[p] != own[q])
        yield p[ok], q[ok]
        d += 1


def fixed_binary(column, dtype, width: int) -> np.ndarray:
    """A binary column of equal sizes as a (rows, width) array."""
    c = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return np.frombuffer(b"".join(c.to_pylist()), dtype).reshape(len(c), width)


def clusters(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Smallest index of each member's cluster under the pairs (p, q)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[p], label[q])
        new = label.copy()
        np.minimum.at(new, p, low)
        np.minimum.at(new, q, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
