"""Embedding near-duplicates: iterative quantisation, multi-index Hamming
tables, exact rerank.

Vectors are scaled to length one, and each dimension is a table of its own.
Fit (on about ``FIT_ROWS`` rows of a dimension chosen by a hash of the id, the documented
bound): mean and principal axes, then for each of several random starts the rotation
that brings the sample closest to the corners of the cube, by alternating
sign codes and an orthogonal Procrustes step.  Every row gets one balanced
binary code of up to 64 bits per rotation.

Index: each code is cut into substrings of about log2(rows) bits; a substring
with its place is a table's bucket.  A pair of cosine 0.95 at the sample's mean
distance from its centre has a cosine c around the centre and differs in a bit
with probability of about arccos(c)/pi; the number of tables, which has no
upper limit, is the least with which such a pair misses all of them with
probability of 0.01 or less.  All rows are indexed.

Rerank: members of a bucket are compared (in blocks, see ``blocks``) with their
original vectors in double precision.  A pair counts in the first table it
shares alone.  A task gives, per member, its number of links and the smallest
id of its local cluster, so what leaves it is linear in the bucket however
many pairs link.

Edge cases: vectors that are null, zero, or hold null or non-finite components
link with nothing, nor do rows with a null id; vectors link with those of their
own dimension; equal vectors are one class with a
size and count as links of each other; a repeated row is a further copy; an
empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import clusters, fixed_binary, group_starts, grouped, shared_buckets, whole_groups
from .common import col, components, materialize, prepare
from .langid import sample_below

THRESHOLD = 0.95
FIT_ROWS, ITERATIONS, MISS = 6_000, 25, 0.01


class Codes:
    """Mean, axes and rotations of unit vectors; ``codes(x)`` gives (rows, rotations) uint64."""

    def __init__(self, x: np.ndarray, rotations: int):
        rng = np.random.default_rng(7)
        self.mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        y = x - self.mean
        _, axes = np.linalg.eigh(y.T @ y)
        self.axes = axes[:, ::-1][:, :64]
        v = y @ self.axes
        self.turns = []
        for _ in range(rotations):
            r = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))[0]
            for _ in range(ITERATIONS if len(v) else 0):
                u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
                r = (u @ w).T
            self.turns.append(r)
        self.bits = v.shape[1]

    def codes(self, x: np.ndarray) -> np.ndarray:
        v = (x - self.mean) @ self.axes
        weight = np.uint64(1) << np.arange(self.bits, dtype=np.uint64)
        return np.stack([np.where(v @ r >= 0, weight, np.uint64(0)).sum(axis=1, dtype=np.uint64) for r in self.turns], axis=1)


def plan(rows: int, bits: int, threshold: float = THRESHOLD, miss: float = MISS, spread: float = 1.0) -> tuple[int, int]:
    """(substring bits, rotations) for a table of this size; ``spread`` is the
    mean square distance of unit vectors from their mean."""
    width = max(1, min(bits, max(8, round(math.log2(max(2, rows))) - 1)))
    threshold = max(0.0, 1 - (1 - threshold) / max(spread, 1e-9))
    same = (1 - math.acos(threshold) / math.pi) ** width
    tables = math.ceil(math.log(miss) / math.log(1 - same))
    return width, max(1, math.ceil(tables / (bits // width)))


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def read_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, key, vec, dim): key and float32 bytes null where a vector cannot
    link."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            keys, vecs, dims = [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                good = i is not None and v is not None and len(v) > 0 and None not in v
                x = np.array(v, np.float32) + np.float32(0) if good else None
                if good and np.isfinite(x).all() and x.any():
                    raw = x.astype("<f4").tobytes()
                    keys.append(hashlib.blake2b(raw, digest_size=16).digest())
                    vecs.append(raw)
                    dims.append(len(v))
                else:
                    keys.append(None), vecs.append(None), dims.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary()), pa.array(dims, pa.int32())],
                                             names=["id", "key", "vec", "dim"])

    rows = df.select(col(vec_id).cast("long").alias("id"), col(vector).alias("v"))
    return materialize(rows.mapInArrow(run, "id long, key binary, vec binary, dim int"), "itq-vectors")


def compare_buckets(classes: DataFrame, coder: Codes, width: int, dim: int, threshold: float) -> DataFrame:
    """(id, n_links, root) per member and group with at least one link."""
    import pyarrow as pa
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(coder)
    per, turns = coder.bits // width, len(coder.turns)
    mask = np.uint64((1 << width) - 1)

    def encode(batches):
        for b in batches:
            if b.num_rows:
                c = shared.value.codes(_unit(fixed_binary(b.column(2), "<f4", dim).astype(np.float64)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in c], pa.binary())], names=["id", "n", "vec", "codes"])

    coded = materialize(classes.select("id", "n", "vec").mapInArrow(encode, "id long, n long, vec binary, codes binary"), "itq-codes")

    def keys(batches):
        for b in batches:
            if not b.num_rows:
                continue
            c, ids = fixed_binary(b.column(1), np.uint64, turns), b.column(0).to_numpy()
            t = np.arange(per * turns, dtype=np.int32)
            k = np.stack([(c[:, i // per] >> np.uint64(i % per * width)) & mask for i in t], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(t, len(ids))), pa.array(k.reshape(-1).astype(np.int64)), pa.array(np.repeat(ids, len(t)))],
                                             names=["t", "k", "id"])

    rows = shared_buckets(coded.select("id", "codes").mapInArrow(keys, "t int, k long, id long"))
    rows = grouped(rows.join(coded, "id").select("t", "k", "i", "j", "id", "own", "n", "vec", "codes"))

    def compare(table):
        starts = np.append(group_starts(table), table.num_rows)
        t, i, j, ids, own, n = (table.column(c).to_numpy() for c in (0, 2, 3, 4, 5, 6))
        unit, codes = _unit(fixed_binary(table.column(7), "<f4", dim).astype(np.float64)), fixed_binary(table.column(8), np.uint64, turns)
        out = []
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            p, q = np.nonzero(np.triu(unit[s:e] @ unit[s:e].T >= threshold, 1))
            if i[s] != j[s]:
                ok = own[s + p] != own[s + q]
                p, q = p[ok], q[ok]
            if len(p):
                diff, first = codes[s + p] ^ codes[s + q], np.ones(len(p), bool)
                for x in range(int(t[s])):
                    first &= (diff[:, x // per] >> np.uint64(x % per * width)) & mask != 0
                label = clusters(e - s, p, q)
                p, q = p[first], q[first]
                links = np.bincount(p, n[s + q], e - s) + np.bincount(q, n[s + p], e - s)
                at = np.flatnonzero((links > 0) | (label != np.arange(e - s)))
                out.append((ids[s + at], links[at].astype(np.int64), ids[s + label[at]]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["id", "n_links", "root"])

    return rows.mapInArrow(lambda batches: whole_groups(batches, compare), "id long, n_links long, root long")


def link(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    prepare(df.sparkSession)
    rows = read_vectors(df, vec_id, vector)
    usable = rows.where("key is not null")
    classes = materialize(usable.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.any_value("vec").alias("vec"),
                                                    F.any_value("dim").alias("dim")), "itq-classes")
    found = None
    for dim, n in classes.groupBy("dim").agg(F.sum("n"), F.count(F.lit(1)).alias("m")).where("m > 1").orderBy("dim").drop("m").collect():
        own = classes.where(F.col("dim") == dim)
        sample = sample_below(own.select("id", "vec"), F.col("id"), FIT_ROWS).toArrow()
        order = np.argsort(sample.column(0).to_numpy())
        unit = _unit(fixed_binary(sample.column(1), "<f4", dim).astype(np.float64)[order])
        spread = float(((unit - unit.mean(axis=0)) ** 2).sum(axis=1).mean()) if len(unit) else 1.0
        width, rotations = plan(n, min(64, dim), threshold, spread=spread)
        part = materialize(compare_buckets(own, Codes(unit, rotations), width, dim, threshold), "itq-links")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], "id long, n_links long, root long")
    roots = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).distinct(), "itq-components")
    linked = found.groupBy("id").agg(F.sum("n_links").alias("m"))
    of = (classes.select("key", "id", "n").join(linked, "id", "left").join(roots, "id", "left")
          .select("key", F.coalesce("root", "id").alias("root"), (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links")))
    out = rows.join(of, "key", "left")
    root = F.coalesce("root", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"),
                      F.coalesce(F.col("id") == root, F.lit(True)).alias("kept"))
