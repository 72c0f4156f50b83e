"""N-gram Jaccard join with Bayesian candidate pruning.

Documents whose sets of ``WORDS``-word shingles have a Jaccard similarity of at
least ``THRESHOLD`` are linked.

1. Words (lower-cased, between white space) become 64-bit hashes, shingles a
   mix of five; a shorter text is one shingle of all its words.  Documents with
   the same set are one class, kept by its smallest doc_id and its size, so
   exact copies are never paired.
2. Each class has ``HASHES`` MinHash values (16 bits); ``BANDS`` bands of
   ``ROWS`` values are buckets.  A pair at the threshold shares no bucket with
   probability (1 - 0.8^5)^32 < 4e-6.
3. Within buckets (in blocks, see ``blocks``) the MinHash values of a pair are
   compared ``STEP`` at a time.  With a uniform prior, m agreeing values of n
   leave Pr[similarity >= threshold] = Pr[Binomial(n + 1, threshold) <= m]; a
   pair is dropped once that falls below ``TOLERANCE``.  A pair that shares
   several buckets is handled in the first alone.
4. Members with a likely pair meet again in that bucket, now with their
   shingle sets, and likely pairs are verified exactly.  A task gives a row
   per member (links, smallest id of its cluster there), never one per pair.

Edge cases: null, empty and blank texts have no shingles and link with
nothing; rows with a null doc_id link with nothing and have a null class; a
repeated row is a further copy; equal similarities do not matter; very long
texts are hashed whole; an empty table gives an empty one; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import clusters, fixed_binary, grouped, pairs, shared_buckets, whole_groups
from .common import col, components, materialize, prepare

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
STEP, TOLERANCE = 32, 1e-6
MAX_MEMO = 500_000
_RNG = np.random.default_rng(20240331)
_A = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_C = _RNG.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    def __init__(self):
        import xxhash
        self.memo, self.digest = {}, xxhash.xxh3_64_intdigest

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes of a text."""
        memo, words = self.memo, (text or "").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(memo) > MAX_MEMO:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = self.digest(w.encode("utf-8", "surrogatepass"))
        h = np.array([memo[w] for w in words], np.uint64)
        n = max(1, len(h) - WORDS + 1)
        s = np.full(n, min(len(h), WORDS), np.uint64)
        for k in range(min(WORDS, len(h))):
            s += h[k:k + n] * _C[k]
            s ^= s >> np.uint64(29)
        s *= np.uint64(0xBF58476D1CE4E5B9)
        s ^= s >> np.uint64(32)
        return np.unique(s)


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    h = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    for i in range(0, len(h), 1024):
        x = h[i:i + 1024, None] * _A + _B
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        np.minimum(low, x.min(axis=0), out=low)
    return (low & np.uint32(0xFFFF)).astype("<u2")


def least_matches(n: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Fewest agreements of n values with which a pair stays."""
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n


_SHINGLER: list = []


def _shingler() -> Shingler:
    if not _SHINGLER:
        _SHINGLER.append(Shingler())
    return _SHINGLER[0]


def signed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, key, sig): key of the shingle set, MinHash values; null for a
    text without words."""
    import pyarrow as pa

    def run(batches):
        shingle = _shingler()
        for b in batches:
            keys, sigs = [], []
            for t in b.column(1).to_pylist():
                s = shingle(t)
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sigs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], names=["id", "key", "sig"])

    rows = docs.select(col(doc_id).cast("long").alias("id"), col(text).alias("t"))
    return materialize(rows.mapInArrow(run, "id long, key binary, sig binary"), "jaccard-signed")


_STEPS = [(n - STEP, n, least_matches(n)) for n in range(STEP, HASHES + 1, STEP)]


def likely(table, sig: np.ndarray):
    """Index pairs of a table of groups that Bayesian pruning keeps, each only
    in the first band that it shares."""
    band_of = table.column(0).to_numpy()
    for p, q in pairs(table):
        for i in range(0, len(p), 1 << 16):
            a, b = p[i:i + (1 << 16)], q[i:i + (1 << 16)]
            same = np.zeros(len(a), np.int64)
            for start, stop, least in _STEPS:
                same += (sig[a, start:stop] == sig[b, start:stop]).sum(axis=1)
                stay = same >= least
                a, b, same = a[stay], b[stay], same[stay]
                if not len(a):
                    break
            if len(a):
                first = (sig[a] == sig[b]).reshape(len(a), BANDS, ROWS).all(axis=2).argmax(axis=1)
                own = first == band_of[a]
                yield a[own], b[own]


def candidates(classes: DataFrame) -> DataFrame:
    """(t, k, i, j, id, own): the members of groups that have a likely pair
    there - a row per member, however many pairs it has."""
    import pyarrow as pa
    band = f"transform(sequence(0, {BANDS - 1}), x -> xxhash64(substring(sig, x * {2 * ROWS} + 1, {2 * ROWS})))"
    keys = classes.select("id", F.posexplode_outer(F.expr(band)).alias("t", "k")).select("t", "k", "id")
    rows = grouped(shared_buckets(keys).join(classes.select("id", "sig"), "id").select("t", "k", "i", "j", "id", "own", "sig"))

    def compare(table):
        sig, active = fixed_binary(table.column(6), "<u2", HASHES), np.zeros(table.num_rows, bool)
        for a, b in likely(table, sig):
            active[a] = active[b] = True
        if active.any():
            yield table.select([0, 1, 2, 3, 4, 5]).filter(pa.array(active)).combine_chunks().to_batches()[0]

    return rows.mapInArrow(lambda batches: whole_groups(batches, compare), "t int, k long, i int, j int, id long, own int")


def verified(docs: DataFrame, classes: DataFrame, found: DataFrame, doc_id: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, root) per member and group: the candidates' groups meet
    again with their shingle sets, likely pairs are compared exactly, and each
    member gives the documents it links with and its local cluster's smallest
    id, so no row stands for a pair."""
    import pyarrow as pa

    def read(batches):
        shingle = _shingler()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([shingle(t).tobytes() for t in b.column(2).to_pylist()], pa.binary())],
                                             names=["id", "n", "s"])

    need = found.select("id").distinct().join(classes.select("id", "n"), "id")
    texts = docs.select(col(doc_id).cast("long").alias("id"), col(text).alias("t")).join(need, "id").select("id", "n", "t")
    sets = materialize(texts.mapInArrow(read, "id long, n long, s binary").dropDuplicates(["id"]), "jaccard-sets")
    rows = grouped(found.join(sets, "id").select("t", "k", "i", "j", "id", "own", "n", "s"))

    def compare(table):
        ids, n = table.column(4).to_numpy(), table.column(6).to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column(7).to_pylist()]
        sig, size = np.stack([signature(s) for s in sets]), np.array([len(s) for s in sets])
        links, p, q = np.zeros(len(ids), np.int64), [], []
        for a, b in likely(table, sig):
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                if min(size[x], size[y]) < threshold * max(size[x], size[y]):
                    continue
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if common / (size[x] + size[y] - common) >= threshold:
                    links[x] += n[y]
                    links[y] += n[x]
                    p.append(x)
                    q.append(y)
        if p:
            label = clusters(len(ids), np.array(p), np.array(q))
            at = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(links[at]), pa.array(ids[label[at]])], names=["id", "n_links", "root"])

    return rows.mapInArrow(lambda batches: whole_groups(batches, compare), "id long, n_links long, root long")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's doc_id, class_id (smallest doc_id reachable by links),
    n_links (other documents linked directly, copies included) and kept (the
    first row of its class)."""
    prepare(docs.sparkSession)
    rows = signed(docs, doc_id, text)
    usable = rows.where("id is not null and key is not null")
    classes = materialize(usable.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.any_value("sig").alias("sig")), "jaccard-classes")
    found = materialize(candidates(classes), "jaccard-candidates")
    links = materialize(verified(docs, classes, found, doc_id, text), "jaccard-links")
    roots = components(links.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).distinct(), "jaccard-components")
    linked = links.groupBy("id").agg(F.sum("n_links").alias("m"))
    of = (classes.select("key", "id", "n").join(linked, "id", "left").join(roots, "id", "left")
          .select("key", F.coalesce("root", "id").alias("root"), (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links")))
    out = rows.where("id is not null and key is not null").select("id", "key").join(of, "key").select("id", "root", "n_links")
    rest = rows.where("id is null or key is null").select("id", F.col("id").alias("root"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(rest).select(F.col("id").alias("doc_id"), F.col("root").alias("class_id"), "n_links",
                                        F.coalesce(F.col("id") == F.col("root"), F.lit(True)).alias("kept"))
