"""Byte-level BPE encoding and decoding by monoid tree reduction.

Encoding is a reduction over a tree of halves at two levels.

* Text: a long text is halved down to leaves, each leaf is cut by the split
  pattern, and neighbours are joined.  The pattern has no look-behind, so a
  cut position fixes all cuts after it; a match is settled once the text goes
  on beyond its end and at least three characters beyond its start (the
  longest contraction).  A join therefore re-cuts the unsettled end of the
  left part together with a growing window of the right part until a settled
  cut falls on a cut of the right part; everything outside stays.
* Match: its bytes are halved, the halves encoded, and the two token lists
  joined.  A token list is the BPE encoding of its bytes if and only if each
  adjacent pair of its tokens encodes to itself: before the first merge that
  crosses a token border the two sides evolve as they do alone, in the same
  order (lowest rank, then leftmost), so the crossing merge would also happen
  when the pair is encoded alone.  A join re-encodes a window around the
  border and doubles it until the pairs at both its ends are stable.

Decoding concatenates the bytes of halves up the tree.

Edge cases: null and empty texts give no ids and empty bytes; repeated rows
give repeated results; very long texts are handled by the same tree; an empty
table gives an empty table; only the named columns are read, so further
columns of any name are carried or dropped without clashing.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .common import col, fresh, prepare

LEAF_CHARS = 4096
LEAF_BYTES = 16
LEAF_IDS = 1 << 14
MAX_WORDS = 400_000          # bound of a worker's memo of encoded matches
MAX_LEAVES = 1 << 16         # bound of its memo of leaves: most are whole matches, which are remembered already
MAX_WORD_CHARS = 40          # longer matches are not remembered
MAX_VOCABULARY = 1 << 20

#: Unicode White_Space, which ``\s`` means to the rank files' pattern.
SPACE = "\t-\r \x85\xa0  -     　"
FAST_LIMIT = 0x250           # below it one class table replaces the property look-ups


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError("vocabulary too large to broadcast")
    return ranks


class Splitter:
    """Cuts text by a split pattern; ``cut(text)`` gives the matches, which
    together are the text."""

    def __init__(self, pattern: str):
        import regex
        parts = {"L": "", "N": ""}
        for o in range(FAST_LIMIT):
            kind = unicodedata.category(chr(o))[0]
            if kind in parts:
                parts[kind] += re.escape(chr(o))
        self._any = regex.compile(pattern.replace(r"(?!\S)", f"(?![^{SPACE}])").replace(r"[^\s", f"[^{SPACE}")
                                  .replace(r"\s", f"[{SPACE}]"))
        low = "\t-\r \x85\xa0"
        fast = (pattern.replace(r"(?!\S)", f"(?![^{low}])").replace(r"[^\s\p{L}\p{N}]", f"[^{low}{parts['L']}{parts['N']}]")
                .replace(r"\p{L}", f"[{parts['L']}]").replace(r"\p{N}", f"[{parts['N']}]").replace(r"\s", f"[{low}]"))
        self._fast = re.compile(fast) if r"\p" not in fast else None
        self._high = re.compile(f"[^\\x00-{chr(FAST_LIMIT - 1)}]")

    def cut(self, text: str) -> list[str]:
        if self._fast is not None and (text.isascii() or not self._high.search(text)):
            return self._fast.findall(text)
        return self._any.findall(text)

    def tree(self, text: str) -> list[str]:
        """The matches of a whole text, by halves."""
        if len(text) <= LEAF_CHARS:
            return self.cut(text)
        half = len(text) // 2
        return self.join(self.tree(text[:half]), self.tree(text[half:]))

    def join(self, left: list[str], right: list[str]) -> list[str]:
        if not left or not right:
            return left or right
        after, k = 0, len(left)
        while k and not (after >= 1 and len(left[k - 1]) + after >= 3):
            k -= 1
            after += len(left[k])
        tail = "".join(left[k:])
        take = 1
        while True:
            window = tail + "".join(right[:take])
            size, whole = len(window), take >= len(right)
            cuts, at = {len(tail): 0}, len(tail)
            for i, piece in enumerate(right[:take]):
                at += len(piece)
                cuts[at] = i + 1
            new, at = [], 0
            for piece in self.cut(window):
                if at in cuts and (new or not tail):
                    break
                if not whole and not (at + len(piece) < size and at + 3 <= size):
                    at = -1
                    break
                new.append(piece)
                at += len(piece)
            if at >= 0 and at in cuts:
                del left[k:]
                left.extend(new)
                left.extend(right[cuts[at]:])
                return left
            take *= 2


class TreeBpe:
    """Encodes the bytes of one match to ids, and ids back to bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self._fits: dict[tuple[int, int], bool] = {}
        self._leaf: dict[bytes, list[int]] = {}
        self._sizes = np.zeros(max(self.bytes_of) + 1, np.int64)
        for r, t in self.bytes_of.items():
            self._sizes[r] = len(t)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._flat = np.frombuffer(b"".join(self.bytes_of[r] for r in sorted(self.bytes_of)), np.uint8)

    def merge(self, data: bytes) -> list[int]:
        """Lowest rank first, leftmost first: the definition, for windows."""
        if len(data) > 64:
            return self._merge_long(data)
        ranks, parts = self.ranks, [data[i:i + 1] for i in range(len(data))]
        pairs = [ranks.get(parts[i] + parts[i + 1], 1 << 30) for i in range(len(parts) - 1)]
        while pairs:
            low = min(pairs)
            if low == 1 << 30:
                break
            i = pairs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], 1 << 30)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 30)
        return [ranks[p] for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        ranks, n = self.ranks, len(data)
        end, back = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            alive[j] = False
            end[i] = stop
            if stop < n:
                back[stop] = i
                if (r := ranks.get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (b := back[i]) >= 0 and (r := ranks.get(data[b:stop])) is not None:
                heapq.heappush(heap, (r, b, stop))
        return [ranks[data[i:end[i]]] for i in range(n) if alive[i]]

    def fits(self, a: int, b: int) -> bool:
        known = self._fits.get((a, b))
        if known is None:
            if len(self._fits) > MAX_WORDS:
                self._fits.clear()
            known = self._fits[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def join(self, a: list[int], b: list[int]) -> list[int]:
        if not a or not b or self.fits(a[-1], b[0]):
            return a + b
        i = j = 1
        while True:
            w = self.merge(b"".join(map(self.bytes_of.__getitem__, a[len(a) - i:] + b[:j])))
            left = i >= len(a) or self.fits(a[-i - 1], w[0])
            right = j >= len(b) or self.fits(w[-1], b[j])
            if left and right:
                return a[:len(a) - i] + w + b[j:]
            if not left:
                i = min(len(a), 2 * i)
            if not right:
                j = min(len(b), 2 * j)

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            ids = self._leaf.get(data)
            if ids is None:
                if len(self._leaf) >= MAX_LEAVES:
                    self._leaf.clear()
                ids = self._leaf[data] = self.merge(data)
            return ids
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def match(self, data: bytes) -> list[int]:
        """A match that is itself a token is that token, as the rank files'
        library has it; any other goes by merges."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.tree(data)

    def decode(self, ids) -> bytes:
        """Bytes of an array of ids, by halves; a leaf is one gather from the
        vocabulary's bytes laid end to end."""
        if len(ids) > LEAF_IDS:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        size = self._sizes[ids]
        ends = np.cumsum(size)
        return self._flat[np.repeat(self._starts[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


class Words(dict):
    """Match -> its ids as little-endian 32-bit integers; bounded: half of the
    bound is filled, the half before it is kept for what is met again."""

    def __init__(self, bpe: TreeBpe):
        super().__init__()
        self.bpe, self.old = bpe, {}

    def __missing__(self, word: str) -> bytes:
        packed = self.old.get(word)
        if packed is None:
            ids = self.bpe.match(word.encode("utf-8", "surrogatepass"))
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= MAX_WORD_CHARS:
            if len(self) >= MAX_WORDS // 2:
                self.old = dict(self)
                self.clear()
            self[word] = packed
        return packed


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.splitter, self.bpe = Splitter(pattern), TreeBpe(ranks)
        self.words = Words(self.bpe)

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.words.__getitem__, self.splitter.tree(text))) if text else b""

    def decode(self, ids: bytes | None) -> bytes:
        return self.bpe.decode(np.frombuffer(ids, "<u4")) if ids else b""


_CODECS: dict = {}


def _codec(ranks, pattern: str) -> Codec:
    """One codec per worker process and vocabulary (its memo lives on)."""
    key = (ranks.id if hasattr(ranks, "id") else id(ranks), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(ranks.value, pattern)
    return _CODECS[key]


def encode_decode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text",
                  ids: str = "token_ids", decoded: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``df`` (all but the text by default) with the ids of
    each whole text (binary, little-endian unsigned 32-bit integers) and the
    bytes those ids decode to.

    The text never leaves its task: no shuffle; memory is one batch plus the
    bounded memo.  The vocabulary (at most ``MAX_VOCABULARY`` entries, checked)
    is broadcast.
    """
    import pyarrow as pa
    spark = df.sparkSession
    prepare(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    keep = [c for c in df.columns if c != text] if keep is None else keep
    ids, decoded = fresh(keep, ids), fresh([*keep, ids], decoded)
    src = fresh([*keep, ids, decoded], "text_in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for batch in batches:
            at = batch.schema.get_field_index(src)
            enc = [codec.encode(t) for t in batch.column(at).to_pylist()]
            dec = [codec.decode(e) for e in enc]
            cols = [batch.column(i) for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(enc, pa.binary()), pa.array(dec, pa.binary())],
                                             names=[*keep, ids, decoded])

    from pyspark.sql.types import BinaryType, StructType
    part = df.select(*[col(c) for c in keep], col(text).alias(src))
    schema = StructType([f for f in part.schema.fields if f.name != src])
    schema = schema.add(ids, BinaryType()).add(decoded, BinaryType())
    return part.mapInArrow(run, schema)
