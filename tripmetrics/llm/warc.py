"""WARC archives with a two-level capture index.

Writing: every page becomes one record in a ``.warc.gz`` file (a gzip member
per record).  Of equal payloads of at least ``LEAST_REVISIT`` bytes the one with
the smallest page id is a ``response``; the others are ``revisit`` records, which
hold its id and the payload's digest and length but not the payload.

Index: captures are range-partitioned and sorted by reversed-host URL key and
page id; each partition becomes an index file of deflated blocks of
``BLOCK_ROWS`` captures with a sparse directory (first key of each block) at
its end.  The upper level is one row per index file.  A lookup finds the file
by the upper level, the block by binary search in the directory, the capture
by binary search in the block, then reads that byte range of the archive.

Upper level and tasks' results are rows Spark committed; files carry the
attempt in their name, so a lost task leaves at most an unread file.

Edge cases: a null html is an empty payload; a null url has the empty key;
rows with a null page id are responses of their own and are never referred
to; repeated rows with the smallest id are all responses; a payload of any
length is streamed whole; an empty table gives no files and no rows; further
columns are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import struct
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attempt_name, col, materialize, open_fs, partitions, prepare, shared_dir

LEAST_REVISIT = 100
BLOCK_ROWS = 512
FILE_BYTES = 1 << 30
END = b"CAPIDX1\n"
KEY_END = "\x00"
#: One date for all records, so that equal inputs give equal archives.
DATE = "2024-01-01T00:00:00Z"
_URL = re.compile(r"^[^:/?#]*://([^/?#]*)(.*)$", re.S)


def url_key(url: str | None) -> str:
    """Reversed host, then the rest: ``com,example,www)/path?query``; behind
    it the url itself, so that urls which differ in scheme or in the host's
    case alone are told apart."""
    m = _URL.match(url or "")
    if not m:
        return url or ""
    return ",".join(reversed(m[1].lower().split("."))) + ")" + m[2] + KEY_END + url


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers: int | None) -> bytes:
    """One record as a gzip member; a revisit has no payload."""
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if refers is None else b"revisit"),
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>".encode(),
            b"WARC-Target-URI: " + json.dumps(url).encode(), f"WARC-Date: {DATE}".encode(),
            f"WARC-Payload-Digest: sha256:{digest}".encode(), f"X-Payload-Length: {size}".encode()]
    if refers is not None:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers}>".encode()]
        payload = b""
    head += [b"Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}".encode()]
    return gzip.compress(b"\r\n".join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n", 4, mtime=0)


def parse(member: bytes) -> dict:
    """Fields of a record; checks a response's payload against its digest."""
    raw = gzip.decompress(member)
    top, _, body = raw.partition(b"\r\n\r\n")
    first, *lines = top.decode("utf-8", "surrogatepass").split("\r\n")
    h = dict(line.split(": ", 1) for line in lines)
    payload = body[:int(h["Content-Length"])]
    out = {"type": h["WARC-Type"], "id": h["WARC-Record-ID"][10:-1], "url": json.loads(h["WARC-Target-URI"]), "payload": payload,
           "digest": h["WARC-Payload-Digest"].removeprefix("sha256:"), "bytes": int(h["X-Payload-Length"]),
           "refers_to": int(h["WARC-Refers-To"][10:-1]) if "WARC-Refers-To" in h else None}
    if first != "WARC/1.1" or (out["refers_to"] is None and (len(payload) != out["bytes"] or hashlib.sha256(payload).hexdigest() != out["digest"])):
        raise ValueError(f"broken record {out['id']}")
    return out


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write all rows as records; returns the committed captures (key,
    page_id, file, at, size), a row per record.

    Equal payloads meet as (digest, smallest id) after partial aggregation;
    only ids and digests of groups with copies are joined (a hot digest is
    split by the skew join), and the pages are shuffled by page id once.
    """
    import pyarrow as pa
    spark = pages.sparkSession
    prepare(spark)
    base = pages.select(col(page_id).cast("long").alias("page_id"), col(url).alias("url"),
                        F.encode(F.coalesce(col(html), F.lit("")), "UTF-8").alias("payload"))
    base = base.select("*", F.octet_length("payload").alias("n"), F.sha2("payload", 256).alias("digest"))
    large = base.where(F.col("n") >= LEAST_REVISIT).select("page_id", "digest")
    first = (large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
             .where("copies > 1").select("digest", "refers_to"))
    again = large.join(first, "digest").where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct()
    rows = base.join(again, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "n", "refers_to")

    def run(batches):
        fs = out = name = None
        at = 0
        for b in batches:
            done = []
            for p, u, payload, digest, n, ref in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    fs, top = open_fs(folder)
                    fs.create_dir(top, recursive=True)
                    name, at = attempt_name("pages", ".warc.gz"), 0
                    out = fs.open_output_stream(f"{top}/{name}", compression=None)
                data = record(p, u, payload, digest, n, ref)
                out.write(data)
                done.append({"key": url_key(u), "page_id": p, "file": name, "at": at, "size": len(data)})
                at += len(data)
            if done:
                yield pa.RecordBatch.from_pylist(done, pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()),
                                                                  ("at", pa.int64()), ("size", pa.int64())]))
        if out is not None:
            out.close()

    return materialize(rows.mapInArrow(run, "key string, page_id long, file string, at long, size long"), "warc-captures")


def _pack(block: list[tuple]) -> bytes:
    return zlib.compress(json.dumps(block, separators=(",", ":")).encode(), 4)


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sorted index files; returns the upper level (part, first, last, file):
    first and last (key, page id) of each file."""
    import pyarrow as pa
    order = [F.col("key"), F.coalesce("page_id", F.lit(-1 << 63))]
    rows = (captures.repartitionByRange(partitions(captures.sparkSession), *order).sortWithinPartitions(*order, "file", "at")
            .select(F.spark_partition_id().alias("part"), "key", order[1].alias("page_id"), "file", "at", "size"))

    def run(batches):
        out = None
        pending, directory, at, first, last, part = [], [], 0, None, None, None

        def flush(block):
            nonlocal at
            data = _pack(block)
            directory.append((block[0][0], block[0][1], at, len(data)))
            out.write(data)
            at += len(data)

        for b in batches:
            new = list(zip(*(c.to_pylist() for c in b.columns[1:]), strict=True))
            if not new:
                continue
            if out is None:
                fs, top = open_fs(folder)
                fs.create_dir(top, recursive=True)
                name = attempt_name("index", ".cap")
                out = fs.open_output_stream(f"{top}/{name}", compression=None)
                first, part = new[0][:2], b.column(0)[0].as_py()
            pending += new
            last = new[-1][:2]
            while len(pending) >= BLOCK_ROWS:
                flush(pending[:BLOCK_ROWS])
                pending = pending[BLOCK_ROWS:]
        if out is not None:
            if pending:
                flush(pending)
            data = _pack(directory)
            out.write(data + struct.pack("<2Q", at, len(data)) + END)
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "first_key": first[0], "first_id": first[1], "last_key": last[0], "last_id": last[1], "file": name}])

    return materialize(rows.mapInArrow(run, "part long, first_key string, first_id long, last_key string, last_id long, file string"), "warc-index")


class IndexFile:
    """Random access to one index file: directory first, blocks as needed."""

    def __init__(self, fs, path: str):
        self.f = fs.open_input_file(path)
        size = fs.get_file_info(path).size
        at, n, end = struct.unpack("<2Q8s", self._part(size - 24, 24))
        if end != END:
            raise ValueError("not an index file")
        self.directory = [((k, i), o, s) for k, i, o, s in json.loads(zlib.decompress(self._part(at, n)))]
        self.firsts, self.held = [d[0] for d in self.directory], (-1, [])

    def _part(self, at: int, n: int) -> bytes:
        self.f.seek(at)
        return self.f.read(n)

    def _block(self, k: int) -> list[tuple]:
        if self.held[0] != k:
            _, at, n = self.directory[k]
            self.held = k, [((r[0], r[1]), *r[2:]) for r in json.loads(zlib.decompress(self._part(at, n)))]
        return self.held[1]

    def find(self, key: tuple) -> list[tuple]:
        """(file, at, size) of every capture with this (key, page id)."""
        out, k = [], max(0, bisect.bisect_left(self.firsts, key) - 1)
        while k < len(self.firsts) and self.firsts[k] <= key:
            block = self._block(k)
            i = bisect.bisect_left(block, (key,))
            while i < len(block) and block[i][0] == key:
                out.append(block[i][1:])
                i += 1
            k += 1
        return out


def lookup(wanted: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """Find the captures of all rows of ``wanted`` (url, page_id): distinct
    wanted rows are sent to the index file that holds them, searched there in
    order, and come back as (page_id, file, at, size).

    The upper level (a row per index file, so at most as many as tasks wrote)
    is collected for the binary search.  A key's captures differ in page id,
    so a hot url spreads over as many files as it fills.
    """
    import pyarrow as pa
    spark = wanted.sparkSession
    top_level = sorted(((r.first_key, r.first_id), (r.last_key, r.last_id), r.file) for r in index.collect())
    lasts = [t[1] for t in top_level]

    def route(batches):
        for b in batches:
            rows = []
            for u, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                key = (url_key(u), -1 << 63 if p is None else p)
                k = bisect.bisect_left(lasts, key)
                while k < len(top_level) and top_level[k][0] <= key:
                    rows.append({"k": k, "key": key[0], "page_id": key[1]})
                    k += 1
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("k", pa.int32()), ("key", pa.string()), ("page_id", pa.int64())]))

    def search(batches):
        files: dict[int, IndexFile] = {}
        for b in batches:
            rows = []
            for k, key, p in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if k not in files:
                    fs, top = open_fs(folder)
                    files.clear()
                    files[k] = IndexFile(fs, f"{top}/{top_level[k][2]}")
                rows += [{"page_id": p, "file": f, "at": at, "size": n} for f, at, n in files[k].find((key, p))]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("page_id", pa.int64()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())]))

    if not top_level:
        return spark.createDataFrame([], "page_id long, file string, at long, size long")
    sent = wanted.select("url", "page_id").distinct().mapInArrow(route, "k int, key string, page_id long")
    sent = sent.repartitionByRange(partitions(spark), "k", "key", "page_id").sortWithinPartitions("k", "key", "page_id")
    return sent.mapInArrow(search, "page_id long, file string, at long, size long")


def read_records(found: DataFrame, folder: str) -> DataFrame:
    """Range-read and parse captures (page_id, file, at, size)."""
    import pyarrow as pa
    schema = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                       ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])
    rows = found.repartition(partitions(found.sparkSession), F.col("file"), F.expr("at div 16777216")).sortWithinPartitions("file", "at")

    def run(batches):
        open_name = f = None
        for b in batches:
            done = []
            for _, name, at, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if name != open_name:
                    fs, top = open_fs(folder)
                    f, open_name = fs.open_input_file(f"{top}/{name}"), name
                f.seek(at)
                r = parse(f.read(n))
                done.append({"page_id": int(r["id"]) if r["id"] else None, "url": r["url"], "record_type": r["type"], "payload": r["payload"],
                             "payload_bytes": r["bytes"], "payload_digest": r["digest"], "refers_to": r["refers_to"]})
            if done:
                yield pa.RecordBatch.from_pylist(done, kinds)

    return rows.select("page_id", "file", "at", "size").mapInArrow(run, schema)


def folders(spark) -> tuple[str, str]:
    return shared_dir(spark, "warc"), shared_dir(spark, "warc-index")
