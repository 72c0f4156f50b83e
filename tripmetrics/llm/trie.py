"""Conversation prefix trie: z-fast tries over hash chains.

A conversation is a chain: the hash of its first turn, first two turns, and so
on (128 bits each, of role and text).  Equal conversations form one class, so
however many copies there are, one chain stands for them.  The classes' chains
are range-partitioned, so a common first turn is spread over many tasks, and
each task keeps a z-fast trie of its range: compacted nodes in a hash table
under their handles (the hash at the two-fattest depth of the node's edge).
A batch of chains is located first, each by fat binary search over the
handles, which finds its exit node in log2(length) look-ups, and then
inserted from there, splitting edges and adding leaves.  At the end (or at
``HELD_TURNS`` held turns and chains, which bounds a worker's memory) the edges are
expanded: a row per prefix with what the trie has summed up below it.  Spark
adds up the rows of equal prefixes, so nodes that several ranges share, such as
the root, meet as one row from each.

Subtree sums need no walk over ancestors: a node belongs to its smallest
member, and a member owns the lower end of its chain; so each class carries the
values of the nodes it owns, and a second pass through the same tries sums
them from the leaves up.  Parents and children follow from the owned ranges,
but for the top of each range, which is looked up.

Edge cases: rows without a conversation id are left out; a null turn comes
first, turns of equal number (ties, repeated rows) are all kept, in the order
of their hashes; null roles and texts are empty; a very long text is hashed
whole and a long conversation is held as 16 bytes a turn; an empty table has
no node, not even a root; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, materialize, partitions, prepare

WIDTH = 16
ROOT = bytes(WIDTH)
HELD_TURNS = 1 << 20
CHUNK_IDS = 4096
OUT_ROWS = 1 << 15


def turn_lists(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (turn, digest
    of role and text, code points)."""
    r, t = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.unhex(F.md5(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t)))
    rows = df.select(col(conv_id).cast("long").alias("conv_id"), F.struct(col(turn).alias("turn"), digest.alias("digest"), F.length(t).cast("long").alias("chars")).alias("t"))
    return rows.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuild(df: DataFrame, group: int = 100, most: int = 6, **columns: str) -> DataFrame:
    """Turn lists in which the first h = crc32(id) % ``most`` turns are those
    of the conversation id - id % ``group`` (the remainder of SQL: towards zero)."""
    own = materialize(turn_lists(df, **columns), "trie-turns")
    heads = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("b"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    x = own.withColumn("h", h).withColumn("b", F.col("conv_id") - F.col("conv_id") % group).join(heads, "b", "left")
    nothing = F.slice("turns", 1, 0)
    return x.select("conv_id", F.concat(F.coalesce(F.expr("slice(head, 1, h)"), nothing), F.expr("slice(turns, h + 1, size(turns))")).alias("turns"))


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] that the greatest power of two divides."""
    return b & (-1 << (a ^ b).bit_length() - 1)


def prefix(chain: bytes, depth: int) -> bytes:
    return chain[WIDTH * (depth - 1):WIDTH * depth] if depth else ROOT


def common(x: bytes, y: bytes, low: int, high: int) -> int:
    """The greatest depth up to ``high`` at which the chains agree; they agree at ``low``."""
    while low < high:
        mid = (low + high + 1) // 2
        if prefix(x, mid) == prefix(y, mid):
            low = mid
        else:
            high = mid - 1
    return low


class ZFastTrie:
    """Compacted nodes: node k spans the depths (top[k], depth[k]] of
    chain[k]; ``handles`` finds it by its handle, ``firsts`` as the child that
    starts with a prefix.  Node 0 is the root."""

    def __init__(self):
        self.top, self.depth, self.chain, self.parent, self.note = [0], [0], [b""], [0], [None]
        self.handles: dict[bytes, int] = {}
        self.firsts: dict[bytes, int] = {}
        self.turns = 0

    def locate(self, chain: bytes) -> int:
        """The parent of the exit node: the last node found whose whole chain
        is a prefix of ``chain``."""
        last = len(chain) // WIDTH
        at, a, b = 0, 0, last
        while a < b:
            f = two_fattest(a, b)
            k = self.handles.get(prefix(chain, f))
            if k is None:
                b = f - 1
                continue
            e = self.depth[k]
            if e > last or prefix(chain, e) != prefix(self.chain[k], e):
                return self.parent[k]
            at, a = k, e
        return at

    def _node(self, top: int, depth: int, chain: bytes, parent: int, note) -> int:
        k = len(self.top)
        self.top.append(top), self.depth.append(depth), self.chain.append(chain), self.parent.append(parent), self.note.append(note)
        self.firsts[prefix(chain, top + 1)] = k
        self.handles[prefix(chain, two_fattest(top, depth))] = k
        return k

    def _split(self, k: int, at: int) -> int:
        """Cuts the edge of node k at a depth; returns the new upper node."""
        chain = self.chain[k]
        upper = self._node(self.top[k], at, chain, self.parent[k], self.note[k])
        self.top[k], self.parent[k] = at, upper
        self.firsts[prefix(chain, at + 1)] = k
        self.handles[prefix(chain, two_fattest(at, self.depth[k]))] = k
        return upper

    def _insert(self, chain: bytes, at: int, note) -> int:
        last, a = len(chain) // WIDTH, self.depth[at]
        self.turns += 1
        while a < last:
            k = self.firsts.get(prefix(chain, a + 1))
            if k is None:
                self.turns += last - a
                return self._node(a, last, chain, at, note)
            m = common(chain, self.chain[k], a + 1, min(last, self.depth[k]))
            at, a = (k if m == self.depth[k] else self._split(k, m)), m
        return at

    def insert(self, chains: list[bytes], notes: list) -> list[int]:
        """The nodes where the chains end; ``notes`` stay with the chains that
        new edges are made of."""
        found = [self.locate(c) for c in chains]
        return [self._insert(c, k, note) for c, k, note in zip(chains, found, notes, strict=True)]

    def bottom_up(self) -> list[int]:
        """All nodes, each after the nodes below it."""
        return np.argsort(-np.array(self.depth), kind="stable").tolist()


def _halves(hashes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)


def _batches(names: list[str], hashes: list[list[bytes]], values: list[list]):
    """Record batches of two longs for each hash, then long values."""
    import pyarrow as pa
    for i in range(0, len(values[0]), OUT_ROWS):
        cols = [pa.array(np.ascontiguousarray(_halves(h[i:i + OUT_ROWS])[:, j])) for h in hashes for j in (0, 1)]
        yield pa.RecordBatch.from_arrays([*cols, *[pa.array(v[i:i + OUT_ROWS], pa.int64()) for v in values]], names=names)


def _tries(batches, note, put, expand):
    """Feeds batches (chain first) into tries of bounded size: ``note(rows)``
    gives the chains' notes, ``put(trie, end nodes, rows)`` returns what
    ``expand(trie, held)`` needs at the end."""
    trie, held = ZFastTrie(), []
    for b in batches:
        rows = [c.to_pylist() for c in b.columns]
        held.append((trie.insert(rows[0], note(rows)), rows[1:]))
        if trie.turns >= HELD_TURNS:
            yield from expand(trie, put(trie, held))
            trie, held = ZFastTrie(), []
    if held:
        yield from expand(trie, put(trie, held))


def _dealt(rows: DataFrame) -> DataFrame:
    """Chains in ranges: the first eight prefixes, then the whole chain's hash."""
    return rows.repartitionByRange(partitions(rows.sparkSession), F.substring("chain", 1, 8 * WIDTH), "e1", "e2")


def _chains(turns: DataFrame) -> DataFrame:
    """(conv_id, chain, chars, e1, e2): e1, e2 is the whole chain's hash."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            ends, chains = [], []
            for digests in b.column(1).to_pylist():
                h, parts = ROOT, []
                for d in digests:
                    h = hashlib.md5(h + d, usedforsecurity=False).digest()
                    parts.append(h)
                ends.append(h), chains.append(b"".join(parts))
            e = _halves(ends)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(chains, pa.binary()), b.column(2), *[pa.array(np.ascontiguousarray(e[:, j])) for j in (0, 1)]],
                                             names=["conv_id", "chain", "chars", "e1", "e2"])

    rows = turns.select("conv_id", F.col("turns.digest").alias("d"), F.col("turns.chars").alias("chars"))
    return rows.mapInArrow(run, "conv_id long, chain binary, chars array<long>, e1 long, e2 long")


def _nodes(classes: DataFrame) -> DataFrame:
    """A row per prefix: its hash (h1, h2), its parent's (p1, p2), depth,
    smallest member, members, code points of its last text."""
    def put(trie, held):
        low, n = [None] * len(trie.top), [0] * len(trie.top)
        for ends, (convs, sizes, _) in held:
            for k, c, m in zip(ends, convs, sizes, strict=True):
                low[k], n[k] = (c if low[k] is None else min(low[k], c)), n[k] + m
        return low, n

    def expand(trie, sums):
        low, n = sums
        hashes, parents, values = [], [], [[], [], [], []]
        for k in trie.bottom_up():
            chain, top, depth = trie.chain[k], trie.top[k], trie.depth[k]
            if k:
                up = trie.parent[k]
                low[up], n[up] = (low[k] if low[up] is None else min(low[up], low[k])), n[up] + n[k]
            for d in range(depth, top if k else -1, -1):
                hashes.append(prefix(chain, d)), parents.append(prefix(chain, d - 1) if d else ROOT)
                for v, x in zip(values, (d, low[k], n[k], trie.note[k][d - 1] if d else 0), strict=True):
                    v.append(x)
        yield from _batches(["h1", "h2", "p1", "p2", "depth", "low", "n", "chars"], [hashes, parents], values)

    rows = _dealt(classes).select("chain", "conv_id", "n", "chars")
    out = rows.mapInArrow(lambda b: _tries(b, lambda r: r[3], put, expand), "h1 long, h2 long, p1 long, p2 long, depth long, low long, n long, chars long")
    return out.groupBy("h1", "h2").agg(*[F.max(c).alias(c) for c in ("p1", "p2", "depth", "chars")], F.min("low").alias("low"), F.sum("n").alias("n"))


def _subtrees(classes: DataFrame) -> DataFrame:
    """(h1, h2, n_leaves, saved) of each prefix, from the classes' own depths
    and values, and whether they end in a leaf."""
    def put(trie, held):
        leaves, own = [0] * len(trie.top), {}
        for ends, (depths, saved, leaf) in held:
            for k, ds, vs, one in zip(ends, depths, saved, leaf, strict=True):
                leaves[k] += one
                if ds:
                    own[k] = ds[0], vs
        return leaves, own

    def expand(trie, sums):
        leaves, own = sums
        at = {}
        for k, (first, vs) in own.items():  # an owner's values, upwards from its end
            at[k] = first, vs
            while k and first <= trie.top[k]:
                k = trie.parent[k]
                at[k] = first, vs
        total = [0] * len(trie.top)
        hashes, values = [], [[], []]
        for k in trie.bottom_up():
            chain, (first, vs) = trie.chain[k], at.get(k, (trie.depth[k] + 1, ()))
            for d in range(trie.depth[k], trie.top[k] if k else -1, -1):
                total[k] += vs[d - first] if d >= first else 0
                hashes.append(prefix(chain, d)), values[0].append(leaves[k]), values[1].append(total[k])
            if k:
                up = trie.parent[k]
                leaves[up] += leaves[k]
                total[up] += total[k]
        yield from _batches(["h1", "h2", "n_leaves", "saved"], [hashes], values)

    rows = _dealt(classes).select("chain", "depths", "saved", "leaf")
    out = rows.mapInArrow(lambda b: _tries(b, lambda r: [None] * len(r[0]), put, expand), "h1 long, h2 long, n_leaves long, saved long")
    return out.groupBy("h1", "h2").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def _ends(chains: DataFrame) -> DataFrame:
    """(h1, h2, sha): the hash of the ids that end at a prefix, ascending and
    joined by commas.  Ids are first joined in runs, in ranges of (prefix, id);
    then one task streams a prefix's runs through SHA-256, holding one."""
    import pyarrow as pa

    def join(batches):
        key, ids = None, []

        def close():
            return (*key, ids[0], ",".join(map(str, ids)).encode())

        def out(rows):
            a, b, first, text = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(first, pa.int64()), pa.array(text, pa.binary())],
                                              names=["h1", "h2", "first", "ids"])
        rows = []
        for b in batches:
            for a, e, c in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if (a, e) != key or len(ids) >= CHUNK_IDS:
                    if ids:
                        rows.append(close())
                    key, ids = (a, e), []
                ids.append(c)
            if rows:
                yield out(rows)
                rows = []
        if ids:
            yield out([close()])

    def digest(batches):
        key, sha = None, None

        def out(rows):
            a, b, s = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s)], names=["h1", "h2", "sha"])
        for batch in batches:
            rows = []
            for a, b, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if (a, b) == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        rows.append((*key, sha.hexdigest()))
                    key, sha = (a, b), hashlib.sha256()
                sha.update(ids)
            if rows:
                yield out(rows)
        if key is not None:
            yield out([(*key, sha.hexdigest())])

    n = partitions(chains.sparkSession)
    rows = chains.select("e1", "e2", "conv_id").repartitionByRange(n, "e1", "e2", "conv_id").sortWithinPartitions("e1", "e2", "conv_id")
    runs = rows.mapInArrow(join, "h1 long, h2 long, first long, ids binary").repartition(n, "h1", "h2").sortWithinPartitions("h1", "h2", "first")
    return runs.mapInArrow(digest, "h1 long, h2 long, sha string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """All nodes of the trie of turn lists (conv_id, turns): conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    prepare(turns.sparkSession)
    chains = materialize(_chains(turns), "trie-chains")
    classes = materialize(chains.groupBy("e1", "e2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), F.first("chain").alias("chain"),
                                                         F.first("chars").alias("chars")), "trie-classes")
    nodes = materialize(_nodes(classes), "trie-nodes")
    owned = materialize(nodes.groupBy(F.col("low").alias("conv_id")).agg(F.sort_array(F.collect_list(F.struct("depth", "n", "chars", "h1", "h2", "p1", "p2"))).alias("o")), "trie-owned")
    held = classes.select("conv_id", "chain", "e1", "e2", F.col("n").alias("own_n")).join(owned.withColumn("end", F.element_at("o", -1)), "conv_id", "left")
    held = held.select("chain", "e1", "e2", F.col("o.depth").alias("depths"), F.transform("o", lambda x: (x["n"] - 1) * x["chars"]).alias("saved"),
                       F.coalesce((F.col("end.h1") == F.col("e1")) & (F.col("end.h2") == F.col("e2")) & (F.col("end.n") == F.col("own_n")), F.lit(False)).cast("long").alias("leaf"))
    top = F.element_at("o", 1)
    heads = owned.select("conv_id", top["p1"].alias("h1"), top["p2"].alias("h2"), top["depth"].alias("depth")).where("depth > 0")
    parents = heads.join(nodes.select("h1", "h2", "low"), ["h1", "h2"]).select("conv_id", F.col("low").alias("parent"))
    kids = heads.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("kids"))
    rows = owned.join(parents, "conv_id", "left").select("conv_id", "parent", F.size("o").alias("size"), F.posexplode("o").alias("pos", "x"))
    rows = rows.select("conv_id", F.col("x.depth").alias("depth"), F.col("x.h1").alias("h1"), F.col("x.h2").alias("h2"), F.col("x.n").alias("n_convs"),
                       F.when(F.col("pos") == 0, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), (F.col("pos") + 1 < F.col("size")).cast("long").alias("next"))
    key = ["h1", "h2"]
    out = rows.join(_subtrees(held), key, "left").join(kids, key, "left").join(_ends(chains), key, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", (F.col("next") + F.coalesce("kids", F.lit(0))).alias("n_children"), "n_leaves",
                      F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
