"""Sequence packing: vector bin packing by the dot-product heuristic.

A sequence has limits on tokens, on segments and on loss-bearing tokens.  A
task packs the examples of its own partition in cells of at most
``CELL_EXAMPLES`` examples or about ``CELL_IDS`` ids, so nothing is shuffled,
no key can be hot, and a worker holds one cell whatever the table's size.

In a cell an open sequence takes, of the parts that still fit, the one with
the greatest dot product of its demands and the sequence's free room (each as
a share of its limit, weighted by the mean demand of the examples left).  Whole
examples go first; the last free segment, or room that no whole example fits,
is filled by the front part of an example, whose rest stays in the cell.  A
sequence that closes short of its limit gives back what exceeds a power of
two, because sequences of such lengths are not padded; so cutting leaves no
padding at all.  With ``cut=False`` only examples that exceed a limit by
themselves are cut, and closed sequences stay as they are.

The loss-bearing ids of an example are its last ones (a prompt, then the
answer).  ``sequence_id`` is the task's partition and the sequence's number in
it.  A lost task packs its partition again to the same rows, because partitions
of a scan are read in the same order; materialise other inputs first.

Edge cases: a null or empty text is the end id alone; an example without ids
has no piece; null ids and repeated rows are examples of their own, and equal
examples (ties) are taken in their order in the partition; a very long text
fills sequences of its own, and only its rest is packed; an empty table gives
an empty one; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, prepare
from .tokenfile import MEMO_WORDS, Tokenizer

CELL_EXAMPLES, CELL_IDS = 1024, 1 << 21
RUN_BYTES = 1 << 23            # of text tokenised together
JOINED = 64                    # unseen words in one text for the library
WORD_END, MARKS = "</w>", (".", ",", ";", ":", "!", "?")
PIECES = "doc_id long, start long, length long, token_ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long"


class Limits(NamedTuple):
    """Of one sequence."""
    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


def fitting(rest: np.ndarray, loss: np.ndarray, tokens: int, room: int) -> np.ndarray:
    """Length of the longest front part of each rest within ``tokens`` tokens
    and ``room`` loss-bearing ones, of which the last ``loss`` ids are."""
    k = np.minimum(rest, tokens)
    plain = rest - np.minimum(rest, loss)
    return np.minimum(k, plain + room)


def pack(n: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool = True) -> Iterator[tuple[int, int, int, int, int]]:
    """(example, start, length, sequence, offset) of each piece of the
    examples of ``n`` tokens, the last ``loss`` of them loss-bearing."""
    top, most, bear = limits
    rest, sequence = n.astype(np.int64), 0
    loss = np.minimum(loss, n).astype(np.int64)
    if cut and bear >= top:         # parts that fill a sequence by themselves
        for i in np.flatnonzero(rest >= top).tolist():
            for start in range(0, int(rest[i]) - top + 1, top):
                yield i, start, top, sequence, 0
                sequence += 1
            rest[i] %= top
    alone = fitting(rest, loss, top, bear) < rest
    live = np.flatnonzero(rest)
    while len(live):
        r, own, free = rest[live], loss[live], cut | alone[live]
        weight = r.mean() / top, 1 / most, np.minimum(r, own).mean() / max(1, bear)
        used, borne, placed = 0, 0, []
        while len(placed) < most and used < top:
            k = fitting(r, own, top - used, bear - borne)
            whole = k == r
            b = np.minimum(r, own) - np.minimum(r - k, own)
            score = (weight[0] * (top - used) / top ** 2) * k + (weight[2] * (bear - borne) / max(1, bear) ** 2) * b
            score += weight[1] * (most - len(placed)) / most ** 2
            if len(placed) < most - 1 or not cut:
                score += whole * 4.0            # above any dot product of the shares
            score[(k <= 0) | ~(whole | free)] = -1
            j = int(np.argmax(score))
            if score[j] < 0:
                break
            placed.append((j, int(k[j])))
            r[j] -= k[j]
            used += int(k[j])
            borne += int(b[j])
        if cut and used < top:
            over = used - (1 << used.bit_length() - 1)
            while over:
                j, k = placed.pop()
                back = min(k, over)
                r[j] += back
                over -= back
                if back < k:
                    placed.append((j, k - back))
        at = {j: int(n[live[j]] - r[j]) - sum(k for i, k in placed if i == j) for j, _ in placed}
        offset = 0
        for j, k in placed:
            yield int(live[j]), at[j], k, sequence, offset
            at[j] += k
            offset += k
        rest[live] = r
        live = live[r > 0]
        sequence += 1


class WordTokenizer(Tokenizer):
    """The tokenizers library behind the bounded memo: its vocabulary drops
    white space, so a text's ids are those of its words in order.  Unseen words
    of letters go to the library many to a text, and the tokens that end a word
    cut them apart again; of a word and one mark behind it, the library cuts
    off the mark itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Library
        self.library = Library.from_file(path)
        self.library.encode_special_tokens = True
        self.vocabulary = self.library.get_vocab_size()
        self.kind = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.ends = np.zeros(self.vocabulary, bool)
        self.ends[[i for t, i in self.library.get_vocab().items() if t.endswith(WORD_END)]] = True
        self._clear()

    def __call__(self, texts) -> Iterator[np.ndarray]:
        """The ids of each text of an Arrow array, worked on in runs of bounded
        size; a run's words are told apart in Arrow, so that each distinct one
        is looked up once."""
        size = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
        run = (np.cumsum(size) - size) // RUN_BYTES
        for a, b in zip(*(np.flatnonzero(x) for x in (np.diff(run, prepend=-1), np.diff(run, append=-1))), strict=True):
            yield from self._run(texts.slice(a, b - a + 1))

    def _run(self, texts) -> Iterator[np.ndarray]:
        if len(self.memo) > MEMO_WORDS:
            self._clear()
        cuts = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = cuts.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        rows = np.fromiter(map(self.memo.get, words, repeat(-1)), np.int64, len(words))
        unseen = np.flatnonzero(rows < 0).tolist()
        if unseen:
            new = [words[i] for i in unseen]
            self._learn(new)
            rows[unseen] = [self.memo[w] for w in new]
        rows = rows[np.asarray(coded.indices)]
        size = self.size[rows]
        end = np.cumsum(size)
        ids = self.pool[np.repeat(self.start[rows] - end + size, size) + np.arange(size.sum())]
        ends = np.concatenate([[0], end])[np.cumsum(np.asarray(cuts.value_lengths()))].tolist()
        for a, b in zip([0, *ends], ends, strict=False):
            yield ids[a:b]

    def _learn(self, words: list[str]) -> None:
        marked = [w for w in words if w[-1:] in MARKS and w[:-1].isalpha()]
        plain = list(dict.fromkeys(w for w in chain((w for w in words if w.isalpha()), (w[:-1] for w in marked)) if w not in self.memo))
        self._joined(plain)
        marked = [w for w in marked if w[:-1] in self.memo]
        self._alone([m for m in MARKS if m not in self.memo] if marked else [])
        rows = np.array([self.memo[part] for w in marked for part in (w[:-1], w[-1])], np.int64)
        size = self.size[rows]
        end = np.cumsum(size)
        self._keep(marked, self.pool[np.repeat(self.start[rows] - end + size, size) + np.arange(size.sum())], size.reshape(-1, 2).sum(axis=1))
        self._alone([w for w in words if w not in self.memo])

    def _alone(self, words: list[str]) -> None:
        ids = self._library(words)
        self._keep(words, np.fromiter(chain.from_iterable(ids), self.kind), np.fromiter(map(len, ids), np.int64, len(ids)))

    def _joined(self, words: list[str]) -> None:
        """Learns the words of each joined text in which every word has its one end."""
        runs = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        ids = self._library([" ".join(r) for r in runs])
        right, kept = [], []
        for r, x in zip(runs, ids, strict=True):
            x = np.array(x, self.kind)
            at = np.flatnonzero(self.ends[x]) + 1
            if len(at) == len(r):
                right += r
                kept.append((x, np.diff(at, prepend=0)))
        if right:
            self._keep(right, *map(np.concatenate, zip(*kept, strict=True)))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _packed(rows: DataFrame, examples: Callable, limits: Limits, cut: bool) -> DataFrame:
    """Pieces of the examples (id, ids, loss-bearing ids) of each batch."""
    import pyarrow as pa
    if min(limits) < 1:
        raise ValueError("limits must be at least 1")
    kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches):
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 32
        cell, held = [], 0

        def close():
            nonlocal first
            n = np.array([len(ids) for _, ids, _ in cell], np.int64)
            loss = np.minimum(n, [b for _, _, b in cell])
            rows, last = [], -1
            for i, start, length, sequence, offset in pack(n, loss, limits, cut):
                d, ids, _ = cell[i]
                bear = max(0, start + length - max(start, int(n[i] - loss[i])))
                rows.append((d, start, length, ids[start:start + length].astype("<u4").tobytes(), int(n[i]), bear, first + sequence, offset))
                last = max(last, sequence)
            first += last + 1
            cell.clear()
            for i in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i:i + 4096], strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for d, ids, bear in examples(batch):
                cell.append((d, ids, bear))
                held += len(ids)
                if len(cell) >= CELL_EXAMPLES or held >= CELL_IDS:
                    yield from close()
                    held = 0
        if cell:
            yield from close()

    return rows.mapInArrow(run, PIECES)


def pack_documents(df: DataFrame, tokenizer_path: str, limits: Limits = Limits(), end_id: int = 1, cut: bool = True,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise whole texts, append the end id and pack them.  All ids of a
    document but the first bear loss.  Returns a row per piece: doc_id, start,
    length, token_ids (little-endian unsigned 32-bit integers), doc_tokens,
    loss_tokens, sequence_id, offset."""
    prepare(df.sparkSession)
    end = np.uint32(end_id)

    def examples(batch):
        for d, ids in zip(batch.column(0).to_pylist(), _tokenizer(tokenizer_path)(batch.column(1)), strict=True):
            yield d, np.append(ids, end), len(ids)

    return _packed(df.select(col(doc_id).cast("long").alias("d"), col(text).alias("t")), examples, limits, cut)


def pack_examples(df: DataFrame, limits: Limits, cut: bool = False, doc_id: str = "doc_id", ids: str = "ids", loss: str = "loss") -> DataFrame:
    """Pack examples that are ids already (arrays of ints, null: none), with
    the number of loss-bearing ids at their end (null: none of them)."""
    prepare(df.sparkSession)

    def examples(batch):
        for d, x, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            yield d, np.array(x or [], np.uint32), max(0, b or 0)

    rows = df.select(col(doc_id).cast("long").alias("d"), F.filter(col(ids), lambda x: x.isNotNull()).alias("x"), col(loss).cast("long").alias("b"))
    return _packed(rows, examples, limits, cut)


def padding(pieces: DataFrame, tokens: int) -> DataFrame:
    """One row: sequences, tokens, and the padding of those whose length is
    no power of two."""
    used = pieces.groupBy("sequence_id").agg(F.sum("length").alias("u"))
    odd = F.col("u").bitwiseAND(F.col("u") - 1) != 0
    return used.agg(F.count(F.lit(1)).alias("sequences"), F.sum("u").alias("tokens"), F.sum(F.when(odd, tokens - F.col("u")).otherwise(0)).alias("padding"))
