"""Token-id files: adaptive context-mixing range coder in independent blocks.

File (all integers little-endian)::

    "TMIDS1"  u16 end id
    block*    "BLCK" u32 ids, u32 lanes, u32 payload bytes, u32 crc32(payload)
              payload: u32 words of each lane, then the lanes' u32 words
    directory "DIRC" u32 documents, u32 payload bytes, u32 crc32(payload)
              payload (deflate): i64 doc ids, u8 null flags, u64 id counts
    footer    u64 offset of the directory, "TMIDSEND"

A block holds up to ``BLOCK_IDS`` ids of the file's id stream, cut into lanes
that advance together, one id per lane and step, so every step is a handful
of numpy operations over all lanes.  All lanes share one model, which starts
anew with each block and learns from all ids of the earlier steps:

* order 0: adaptive counts of ids, as a cumulative table,
* order 1 and 2: for the previous id (two ids) the id predicted to follow and
  how often in a row it did,
* mixing: the two confidences choose a row of adaptive hit counts, which gives
  the weights of the three predictions.

The mixture's interval of an id drives one range coder per lane (64-bit low
and range, 32-bit words, carries resolved at the end).  Any block decodes
alone; a wrong checksum raises.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, compress, count, islice
from operator import not_

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Splitter
from .common import attempt_name, col, materialize, open_fs, partitions, prepare, shared_dir

BLOCK_IDS = 1 << 22
MAX_LANES = 16384
LEAST_STEPS = 64
REFRESH = 4                    # order 0 is rebuilt when a fourth more steps are known
BITS, BASE_BITS = 24, 22       # total of the mixture; total of order 0
HASH_BITS = 18
COARSE = 6                     # order 0 is searched from a table of every 64th position
MEMO_WORDS = 1_000_000
RUN_CHARS = 1 << 21            # characters tokenised together
JOINED = 64                    # unseen matches in one text for the library
SPACE_BYTE = "\u0120"          # how a byte-level vocabulary writes a space
MAGIC, END_MAGIC = b"TMIDS1", b"TMIDSEND"
#: A guess's confidence (0 to 15) after a miss (halved), then after a hit (one more).
AFTER = np.array([s >> 1 for s in range(16)] + [min(s + 1, 15) for s in range(16)], np.int16)
_TOTAL, _BASE = 1 << BITS, 1 << BASE_BITS


class Model:
    """The shared predictor of a block's lanes."""

    def __init__(self, vocabulary: int, lanes: int):
        self.v = vocabulary
        self.counts = np.zeros(vocabulary, np.int64)
        self.seen = 0
        # narrow where they are read at random places
        self.guess1, self.sure1 = np.zeros(vocabulary, np.int32), np.zeros(vocabulary, np.int16)
        self.guess2, self.sure2 = np.zeros(1 << HASH_BITS, np.int32), np.zeros(1 << HASH_BITS, np.int16)
        self.tot = np.full(256, 4, np.int64)
        self.hit1, self.hit2 = np.ones(256, np.int64), np.ones(256, np.int64)
        self.prev, self.prev2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.step = self.due = 0
        self.cum = np.zeros(vocabulary + 1, np.int64)

    def predict(self) -> None:
        """Sets, per lane, the two guesses and the three weights."""
        if self.step >= self.due:
            self.due = self.step + 1 + self.step // REFRESH
            room = _BASE - self.v
            np.cumsum(1 + self.counts * room // max(1, self.seen), out=self.cum[1:])
            self.cum[-1] = _BASE
            self.table = None
        self.key2 = ((self.prev2 * 0x9E3779B1 ^ self.prev * 0x85EBCA6B) >> 7) & ((1 << HASH_BITS) - 1)
        self.p1, self.p2 = self.guess1[self.prev], self.guess2[self.key2]
        self.s1, self.s2 = self.sure1[self.prev], self.sure2[self.key2]
        self.row = self.s2 * np.int16(16) + self.s1
        share = _TOTAL - _BASE
        self.q2 = (self.hit2 * share // self.tot)[self.row]
        self.q1 = (self.hit1 * share // self.tot)[self.row]
        self.q0 = _TOTAL - self.q1 - self.q2

    def order0(self, x: np.ndarray, q0: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = (self.cum[x] * q0) >> BASE_BITS
        return low, ((self.cum[x + 1] * q0) >> BASE_BITS) - low

    def interval(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, width = self.order0(x, self.q0)
        low += (self.p1 < x) * self.q1 + (self.p2 < x) * self.q2
        width += (self.p1 == x) * self.q1 + (self.p2 == x) * self.q2
        return low, width

    def find(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids whose intervals hold the positions ``at``, and the intervals."""
        if self.table is None:
            self.table = np.repeat(np.arange(self.v), np.diff((self.cum + (1 << COARSE) - 1) >> COARSE))
        (l1, w1), (l2, w2) = self.order0(self.p1, self.q0), self.order0(self.p2, self.q0)
        l1 += (self.p2 < self.p1) * self.q2
        l2 += (self.p1 < self.p2) * self.q1
        same = self.p1 == self.p2
        w1 += self.q1 + same * self.q2
        w2 += self.q2 + same * self.q1
        hit2 = (at >= l2) & (at < l2 + w2)
        miss = np.flatnonzero(~(hit2 | (at >= l1) & (at < l1 + w1)))
        x, low, width = np.where(hit2, self.p2, self.p1).astype(np.int64), np.where(hit2, l2, l1), np.where(hit2, w2, w1)
        # neither guess: order 0 decides, mostly by the coarse table alone
        a, q0, q1, q2 = (v[miss] for v in (at, self.q0, self.q1, self.q2))
        over = (a >= l1[miss]) * q1 + (a >= l2[miss]) * q2
        rest = (((a - over + 1) << BASE_BITS) - 1) // q0
        y = self.table[rest >> COARSE]
        deep = np.flatnonzero(self.cum[y + 1] <= rest)
        y[deep] = np.searchsorted(self.cum, rest[deep], side="right") - 1
        start, width[miss] = self.order0(y, q0)
        x[miss], low[miss] = y, start + over
        return x, low, width

    def learn(self, x: np.ndarray) -> None:
        ok1, ok2 = self.p1 == x, self.p2 == x
        n = len(x)
        hits = np.bincount(self.row + np.where(ok2, 256, ok1 * 512), minlength=768).reshape(3, 256)
        self.tot += hits.sum(axis=0)
        self.hit2 += hits[1]
        self.hit1 += hits[2]
        for ok, guess, sure, key, s in ((ok1, self.guess1, self.sure1, self.prev, self.s1),
                                        (ok2, self.guess2, self.sure2, self.key2, self.s2)):
            sure[key] = AFTER[s + np.int16(16) * ok]
            new = np.flatnonzero(~ok & (s < 2))
            guess[key[new]] = x[new]
        np.add.at(self.counts, x, 1)
        self.seen += n
        self.prev2, self.prev = self.prev, x
        self.step += 1


def _shape(n: int) -> tuple[int, int]:
    lanes = max(1, min(MAX_LANES, n // LEAST_STEPS))
    return lanes, -(-n // lanes)


def encode_block(ids: np.ndarray, vocabulary: int) -> bytes:
    """Payload of one block."""
    lanes, steps = _shape(len(ids))
    table = np.zeros(lanes * steps, np.int64)
    table[:len(ids)] = ids
    table = np.ascontiguousarray(table.reshape(lanes, steps).T)
    words, size = np.zeros((lanes, steps + 2), np.uint64), np.zeros(lanes, np.int64)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    model, half, every = Model(vocabulary, lanes), np.uint64(32), np.arange(lanes)
    for x in table:
        model.predict()
        start, width = model.interval(x)
        unit = span >> np.uint64(BITS)
        new = low + unit * start.astype(np.uint64)
        carry = np.flatnonzero(new < low)
        words[carry, size[carry] - 1] += np.uint64(1)
        low, span = new, unit * width.astype(np.uint64)
        out = np.flatnonzero(span < np.uint64(1 << 32))
        words[out, size[out]] = low[out] >> half
        size[out] += 1
        low[out] <<= half
        span[out] <<= half
        model.learn(x)
    for _ in range(2):
        words[every, size] = low >> half
        size += 1
        low <<= half
    for k in range(words.shape[1] - 1, 0, -1):
        words[:, k - 1] += words[:, k] >> half
    keep = np.arange(words.shape[1]) < size[:, None]
    return size.astype("<u4").tobytes() + words[keep].astype("<u4").tobytes()


def decode_block(payload: bytes, n: int, lanes: int, vocabulary: int) -> np.ndarray:
    steps = -(-n // lanes)
    size = np.frombuffer(payload, "<u4", lanes).astype(np.int64)
    words = np.append(np.frombuffer(payload, "<u4", offset=4 * lanes).astype(np.uint64), np.zeros(2, np.uint64))
    at = np.cumsum(size) - size
    half = np.uint64(32)
    code = (words[at] << half) | words[at + 1]
    at += 2
    span = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    model, out = Model(vocabulary, lanes), np.empty((steps, lanes), np.int64)
    last = np.uint64(_TOTAL - 1)
    for k in range(steps):
        model.predict()
        unit = span >> np.uint64(BITS)
        x, start, width = model.find(np.minimum(code // unit, last).astype(np.int64))
        code -= unit * start.astype(np.uint64)
        span = unit * width.astype(np.uint64)
        more = np.flatnonzero(span < np.uint64(1 << 32))
        code[more] = (code[more] << half) | words[at[more]]
        span[more] <<= half
        at[more] += 1
        model.learn(x)
        out[k] = x
    return out.T.reshape(-1)[:n]


class FileWriter:
    """Streams documents' ids into one file; holds one block and one document
    (and 17 bytes per document for the directory)."""

    def __init__(self, out, vocabulary: int, end_id: int):
        self.out, self.v, self.end = out, vocabulary, end_id
        self.parts, self.pending, self.offset, self.total = [], 0, 0, 0
        self.ids, self.nulls, self.sizes = [], [], []
        self._put(MAGIC + struct.pack("<H", end_id))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.offset += len(data)

    def _block(self, ids: np.ndarray) -> None:
        payload = encode_block(ids, self.v)
        self._put(b"BLCK" + struct.pack("<4I", len(ids), _shape(len(ids))[0], len(payload), zlib.crc32(payload)) + payload)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.sizes.append(len(ids) + 1)
        self.total += len(ids) + 1
        self.parts += [ids, np.array([self.end], ids.dtype)]
        self.pending += len(ids) + 1
        if self.pending >= BLOCK_IDS:
            stream = np.concatenate(self.parts)
            while len(stream) >= BLOCK_IDS:
                self._block(stream[:BLOCK_IDS])
                stream = stream[BLOCK_IDS:]
            self.parts, self.pending = [stream], len(stream)

    def close(self) -> None:
        if self.pending:
            self._block(np.concatenate(self.parts))
        at = self.offset
        raw = zlib.compress(np.array(self.ids, "<i8").tobytes() + np.array(self.nulls, "u1").tobytes()
                            + np.array(self.sizes, "<u8").tobytes())
        self._put(b"DIRC" + struct.pack("<3I", len(self.ids), len(raw), zlib.crc32(raw)) + raw)
        self._put(struct.pack("<Q", at) + END_MAGIC)


def read_file(f, size: int, vocabulary: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc id, ids of the file before it, ids) of each document, block by block."""
    def part(offset: int, n: int) -> bytes:
        f.seek(offset)
        data = f.read(n)
        if len(data) != n:
            raise ValueError("token file is cut short")
        return data

    def checked(offset: int, n: int, crc: int) -> bytes:
        data = part(offset, n)
        if zlib.crc32(data) != crc:
            raise ValueError("token file: checksum of a block is wrong")
        return data

    footer = part(size - 16, 16)
    if footer[8:] != END_MAGIC or part(0, 6) != MAGIC:
        raise ValueError("not a token file")
    (at,) = struct.unpack("<Q", footer[:8])
    docs, length, crc = struct.unpack("<3I", part(at, 16)[4:])
    raw = zlib.decompress(checked(at + 16, length, crc))
    ids, nulls = np.frombuffer(raw, "<i8", docs), np.frombuffer(raw, "u1", docs, 8 * docs)
    sizes = np.frombuffer(raw, "<u8", docs, 9 * docs)

    def blocks() -> Iterator[np.ndarray]:
        offset = 8
        while offset < at:
            n, lanes, length, crc = struct.unpack("<4I", part(offset, 20)[4:])
            yield decode_block(checked(offset + 20, length, crc), n, lanes, vocabulary)
            offset += 20 + length

    source, have, start = blocks(), np.empty(0, np.int64), 0
    for doc, null, n in zip(ids.tolist(), nulls.tolist(), sizes.tolist(), strict=True):
        parts = [have]
        got = len(have)
        while got < n:
            parts.append(next(source))
            got += len(parts[-1])
        have = np.concatenate(parts) if len(parts) > 1 else have
        yield (None if null else doc), start, have[:n]
        have = have[n:]
        start += n


class Memo(defaultdict):
    """Rows of words; a word that is looked up for the first time gets the next row."""

    def __init__(self):
        super().__init__(count().__next__)

    def since(self, row: int) -> list[str]:
        """The words of the rows from ``row`` on."""
        return list(islice(reversed(self), len(self) - row))[::-1]


class Tokenizer:
    """The tokenizers library behind a bounded memo of split matches: its
    byte-level vocabulary cuts text by ``pattern`` before any merge, so the
    ids of a text are those of its matches in order.

    ``memo`` gives a match's row; its ids are ``pool[start[row]:][:size[row]]``.
    Unseen matches of a space and letters go to the library many to a text:
    the space cuts them apart again, and no other token starts with it.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer as Library
        self.library = Library.from_file(path)
        self.library.encode_special_tokens = True
        self.vocabulary = self.library.get_vocab_size()
        self.splitter = Splitter(pattern)
        self.kind = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.opens = np.zeros(self.vocabulary, bool)
        self.opens[[i for t, i in self.library.get_vocab().items() if t[0] == SPACE_BYTE]] = True
        self._clear()

    def _clear(self) -> None:
        self.memo, self.used = Memo(), 0
        self.pool, self.start, self.size = np.empty(1 << 16, self.kind), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def _keep(self, words: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        rows = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        self.pool = _room(self.pool, self.used + len(ids))
        self.start, self.size = (_room(a, len(self.memo)) for a in (self.start, self.size))
        self.pool[self.used:self.used + len(ids)] = ids
        self.start[rows] = self.used + np.cumsum(size) - size
        self.size[rows] = size
        self.used += len(ids)

    def _library(self, texts: list[str]) -> list[list[int]]:
        # Spark runs a task on every core: threads of the library's own, in each worker, would only take turns with them
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        apart = [w[0] == " " and w[1:].isalpha() for w in words]
        plain, other = list(compress(words, apart)), words
        if plain:
            ids = self._library(["".join(plain[i:i + JOINED]) for i in range(0, len(plain), JOINED)])
            ids = np.fromiter(chain.from_iterable(ids), self.kind)
            at = np.flatnonzero(self.opens[ids])
            if len(at) == len(plain):
                self._keep(plain, ids, np.diff(at, append=len(ids)))
                other = list(compress(words, map(not_, apart)))
        if other:
            ids = self._library(other)
            self._keep(other, np.fromiter(chain.from_iterable(ids), self.kind), np.fromiter(map(len, ids), np.int64))

    def __call__(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text; texts are worked on in runs of bounded size."""
        some, chars = [], 0
        for t in texts:
            some.append(t)
            chars += len(t or "")
            if chars >= RUN_CHARS:
                yield from self._encode(some)
                some, chars = [], 0
        yield from self._encode(some)

    def _encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        if len(self.memo) > MEMO_WORDS:
            self._clear()
        cuts = [self.splitter.tree(t) if t else [] for t in texts]
        matches, known = np.fromiter(map(len, cuts), np.int64, len(cuts)), len(self.memo)
        rows = np.fromiter(map(self.memo.__getitem__, chain.from_iterable(cuts)), np.int64, int(matches.sum()))
        if len(self.memo) > known:
            self._learn(self.memo.since(known))
        size = self.size[rows]
        end = np.cumsum(size)
        ids = self.pool[np.repeat(self.start[rows] - end + size, size) + np.arange(size.sum())]
        ends = np.concatenate([[0], end])[np.cumsum(matches)].tolist()
        for a, b in zip([0, *ends], ends, strict=False):
            yield ids[a:b]


def _room(a: np.ndarray, n: int) -> np.ndarray:
    """``a``, or a longer copy of it that holds ``n`` values."""
    if n <= len(a):
        return a
    out = np.empty(max(n, 2 * len(a)), a.dtype)
    out[:len(a)] = a
    return out


_TOKENIZERS: dict = {}


def _tokenizer(path: str, pattern: str) -> Tokenizer:
    if (path, pattern) not in _TOKENIZERS:
        _TOKENIZERS[path, pattern] = Tokenizer(path, pattern)
    return _TOKENIZERS[path, pattern]


def write_ids(df: DataFrame, folder: str, tokenizer_path: str, pattern: str, end_id: int = 2,
              doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise whole texts and write files in ascending ``doc_id`` order;
    returns the committed manifest (part, file, ids, documents), a row a file.

    One range shuffle of (doc_id, text); a task then streams its sorted rows
    into one file.  Null ids come first, null texts hold the end id alone,
    repeated doc_ids are ordered by text, an empty table gives no file.
    """
    spark = df.sparkSession
    prepare(spark)
    rows = df.select(col(doc_id).cast("long").alias("d"), col(text).alias("t"))
    order = [F.col("d").asc_nulls_first(), F.xxhash64("t"), F.col("t").asc_nulls_first()]
    rows = (rows.repartitionByRange(partitions(spark), *order[:2]).sortWithinPartitions(*order)
            .select("d", "t", F.spark_partition_id().alias("part")))

    def run(batches):
        import pyarrow as pa
        writer = out = name = part = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tok = _tokenizer(tokenizer_path, pattern)
            if writer is None:
                name = attempt_name("ids", ".tmids")
                part = batch.column(2)[0].as_py()
                fs, base = open_fs(folder)
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{base}/{name}", compression=None)
                writer = FileWriter(out, tok.vocabulary, end_id)
            for d, ids in zip(batch.column(0).to_pylist(), tok(batch.column(1).to_pylist()), strict=True):
                writer.add(d, ids)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "n_ids": writer.total,
                                               "n_docs": len(writer.ids), "vocabulary": writer.v}])

    return materialize(rows.mapInArrow(run, "part long, file string, n_ids long, n_docs long, vocabulary long"), "ids-manifest")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, token_ids) of every document, decoded from
    the files; token_ids binary, little-endian unsigned 32-bit integers.
    The driver sees the manifest alone: a row per written file."""
    spark = manifest.sparkSession
    files, base = [], 0
    for r in manifest.orderBy("part").collect():
        files.append((r.file, base, r.vocabulary))
        base += r.n_ids

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for i in batch.column(0).to_pylist():
                name, base, vocabulary = files[i]
                fs, top = open_fs(folder)
                path = f"{top}/{name}"
                with fs.open_input_file(path) as f:
                    rows = []
                    for d, start, ids in read_file(f, fs.get_file_info(path).size, vocabulary):
                        rows.append((d, base + start, len(ids), ids.astype("<u4").tobytes()))
                        if len(rows) >= 512 or len(ids) > 1 << 18:
                            yield _batch(pa, rows)
                            rows = []
                    if rows:
                        yield _batch(pa, rows)

    schema = "doc_id long, start long, n_tokens long, token_ids binary"
    if not files:
        return spark.createDataFrame([], schema)
    return spark.range(0, len(files), 1, len(files)).mapInArrow(run, schema)


def _batch(pa, rows: list[tuple]):
    d, s, n, b = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(s, pa.int64()), pa.array(n, pa.int64()),
                                       pa.array(b, pa.binary())], names=["doc_id", "start", "n_tokens", "token_ids"])


def token_folder(spark) -> str:
    return shared_dir(spark, "token-ids")
