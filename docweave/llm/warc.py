"""WARC archives with a two-level capture index.

write_archives() writes one gzip member per record. build_index() sorts the
captures by reversed-host URL key, packs the sorted lines into compressed
blocks, and ends each index file with a sparse directory (the first key of
every block). lookup() finds a key by binary search over the files' first
keys, over the directory of one file and over the lines of one block, reading
just that directory and those blocks as byte ranges; read_records() then reads
the records themselves as byte ranges, in the order of the archives.

All files stand in a folder that driver and executors share, opened through
pyarrow's file systems. A task's files have names of their own; only those
that a finished task reports are ever used, so repeated or lost tasks leave
no wrong captures.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.common import discard, fresh_path, table, text_or_empty, written

#: Payloads under this many bytes are never stored as revisits.
LEAST_REVISIT = 100
#: An archive file is closed once it has so many bytes; lines of an index block.
ARCHIVE_BYTES, BLOCK_LINES = 256 << 20, 512
#: Date of all records, so that reruns write equal archives.
DATE = "2000-01-01T00:00:00Z"
CAPTURE = "key string, page_id long, file string, offset long, length long"
#: Captures of an index file, keys that a task looks up, bytes of records that a task reads back, and the most tasks there are of each.
INDEX_ROWS, LOOKUP_ROWS, READ_BYTES, MOST_TASKS = 200_000, 50_000, 16 << 20, 1 << 16


def surt(url: str | None) -> str:
    """The sort key of a URL: host labels reversed, then path and query. Scheme, user, default port and fragment go; host in lower case. No URL gives ')/'."""
    if not url:
        return ")/"
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return ")/" + quote(url, safe="/?&=%")
    at = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    path = parts.path or "/"
    return f"{','.join(reversed(host.split('.')))}{at}){path}{'?' + parts.query if parts.query else ''}".replace("\n", "%0A").replace("\t", "%09")


def line_key(url: str | None, page_id) -> str:
    """surt and page id; ids in the order of their numbers."""
    number = "" if page_id is None else f"{page_id + (1 << 63):020d}"
    return f"{surt(url)}\t{number}"


def _open(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One record as it stands in an archive before compression. A revisit has the response's header, with its Content-Length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    name = lambda n: f"<urn:x-page:{n}>"
    target = quote(url or "", safe=":/?#[]@!$&'()*+,;=%~")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {name('' if page_id is None else page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """What a record holds; `payload` is None for a revisit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length"))
    page = lambda k: int(v) if (v := fields.get(k, "").removeprefix("<urn:x-page:").removesuffix(">")) else None
    kind = fields["WARC-Type"]
    return {
        "page_id": page("WARC-Record-ID"),
        "record_type": kind,
        "refers_to": page("WARC-Refers-To") if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": hashlib.sha256(payload).hexdigest() if kind == "response" else fields["WARC-Payload-Digest"].removeprefix("sha256:"),
    }


def _tasks(amount: int | None, each: int) -> int:
    return min(MOST_TASKS, max(1, -(-(amount or 0) // each)))


def _rows(b: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """The values of some columns row by row; numbers stay whole and nulls None."""
    return zip(*(b[c].to_pylist() for c in columns))


def _batch(rows: list[tuple], **columns: pa.DataType) -> pa.RecordBatch:
    values = list(zip(*rows)) if rows else [()] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, columns.values())], list(columns))


def decide(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) as records: page_id, url, payload, payload_digest, record_type, refers_to.

    Of equal payloads of LEAST_REVISIT bytes or more the smallest page_id is
    the response (all rows with that id, should it repeat; if all ids are
    null, all are responses), the others revisit it. Null html is empty.
    Repeated rows all stay, further columns are ignored, and an empty table
    gives an empty one.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", text_or_empty("html").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    heavy = F.octet_length("payload") >= LEAST_REVISIT
    firsts = rows.where(heavy).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("payload_digest").alias("_d"), "first")
    # light payloads find no partner; their keys are spread
    key = F.when(heavy, F.col("payload_digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string")))
    joined = rows.withColumn("_k", key).join(firsts, F.col("_k") == F.col("_d"), "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id", "url", "payload", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to")
    )


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes records (see decide()) to WARC files in the folder; the captures (key, page_id, file, offset, length), computed once."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = _open(folder)
        out, path, at = None, "", 0
        for b in batches:
            found = []
            for page, url, payload, digest, kind, first in _rows(b, "page_id", "url", "payload", "payload_digest", "record_type", "refers_to"):
                if out is None:
                    path, at = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                    where.create_dir(root, recursive=True)
                    out = where.open_output_stream(path, compression=None)
                member = gzip.compress(record_bytes(page, url, payload.encode(), digest, kind, first), 5, mtime=0)
                out.write(member)
                found.append((line_key(url, page), page, path.rsplit("/", 1)[1], at, len(member)))
                at += len(member)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            yield _batch(found, key=pa.string(), page_id=pa.int64(), file=pa.string(), offset=pa.int64(), length=pa.int64())
        if out is not None:
            out.close()

    return written(records.mapInArrow(write, CAPTURE), "captures")


def build_index(captures: DataFrame, folder: str) -> list[tuple[str, str, str, int, int]]:
    """Writes the index of the captures to the folder; per index file (first key, last key, file, place and length of its directory), in key order.

    The returned list has one entry for each index file of about INDEX_ROWS
    captures, MOST_TASKS at most.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = _open(folder)
        out, at, lines, directory, last = None, 0, [], [], ""
        name = f"{uuid.uuid4().hex}.cdx"

        def block() -> None:
            nonlocal at
            data = zlib.compress("\n".join(lines).encode(), 6)
            directory.append((lines[0].rsplit("\t", 3)[0], at, len(data)))
            out.write(data)
            at += len(data)
            lines.clear()

        for b in batches:
            for key, file, offset, length in _rows(b, "key", "file", "offset", "length"):
                if out is None:
                    where.create_dir(root, recursive=True)
                    out = where.open_output_stream(f"{root}/{name}", compression=None)
                lines.append(f"{key}\t{file}\t{offset}\t{length}")
                last = key
                if len(lines) >= BLOCK_LINES:
                    block()
        if out is None:
            return
        if lines:
            block()
        data = zlib.compress(json.dumps(directory).encode(), 6)
        out.write(data)
        out.close()
        yield _batch([(directory[0][0], last, name, at, len(data))], first=pa.string(), last=pa.string(), file=pa.string(), at=pa.int64(), size=pa.int64())

    # the key holds the page id, so that captures of one URL can part
    ordered = captures.repartitionByRange(_tasks(captures.count(), INDEX_ROWS), "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    files = written(ordered.mapInArrow(pack, "first string, last string, file string, at long, size long"), "index")
    return [tuple(r) for r in files.orderBy("first", "last").collect()]


class Index:
    """One task's view of an index: searches by key, keeping the last directory and the last blocks it read."""

    def __init__(self, folder: str, files: list[tuple[str, str, str, int, int]]):
        self.where, self.root = _open(folder)
        self.files, self.lasts = files, [f[1] for f in files]
        self.directory: tuple[str, list] = ("", [])
        self.block: tuple[tuple[str, int], list[str], list[str]] = (("", -1), [], [])
        self.handle: tuple[str, object] = ("", None)

    def _read(self, name: str, at: int, size: int) -> bytes:
        if self.handle[0] != name:
            if self.handle[1] is not None:
                self.handle[1].close()
            self.handle = (name, self.where.open_input_file(f"{self.root}/{name}"))
        return zlib.decompress(self.handle[1].read_at(size, at))

    def find(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of the captures with this key."""
        # captures of a key may go on in the next file
        for k in range(bisect.bisect_left(self.lasts, key), len(self.files)):
            first, _, name, at, size = self.files[k]
            if first > key:
                return
            if self.directory[0] != name:
                self.directory = (name, json.loads(self._read(name, at, size)))
            blocks = self.directory[1]
            j = max(0, bisect.bisect_left(blocks, key, key=lambda b: b[0]) - 1)
            while j < len(blocks) and blocks[j][0] <= key:
                if self.block[0] != (name, j):
                    lines = self._read(name, blocks[j][1], blocks[j][2]).decode().split("\n")
                    self.block = ((name, j), [x.rsplit("\t", 3)[0] for x in lines], lines)
                _, keys, lines = self.block
                i = bisect.bisect_left(keys, key)
                while i < len(keys) and keys[i] == key:
                    file, offset, length = lines[i].rsplit("\t", 3)[1:]
                    yield file, int(offset), int(length)
                    i += 1
                j += 1


def lookup(queries: DataFrame, folder: str, files: list[tuple[str, str, str, int, int]]) -> DataFrame:
    """queries (url, page_id) -> (file, offset, length) of their captures, each once. Unknown pages give no row."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([(line_key(u, p),) for u, p in _rows(b, "url", "page_id")], key=pa.string())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder, files)
        for b in batches:
            found = []
            for (key,) in _rows(b, "key"):
                for place in index.find(key):
                    found.append(place)
                    if len(found) >= LOOKUP_ROWS:  # a key without a page id can have very many captures
                        yield _batch(found, file=pa.string(), offset=pa.int64(), length=pa.int64())
                        found = []
            yield _batch(found, file=pa.string(), offset=pa.int64(), length=pa.int64())

    asked = written(queries.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(keyed, "key string").distinct(), "asked")
    # neighbours in the index are asked for by one task
    return asked.repartitionByRange(_tasks(asked.count(), LOOKUP_ROWS), "key").sortWithinPartitions("key").mapInArrow(search, "file string, offset long, length long")


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(located: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """The records at (file, offset, length), read in the order of the archives; with `payload` also the payload (null for revisits). A task reads about READ_BYTES."""
    columns = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    if payload:
        columns["payload"] = pa.binary()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = _open(folder)
        name, handle = "", None
        for b in batches:
            found = []
            for file, offset, length in _rows(b, "file", "offset", "length"):
                if file != name:
                    if handle is not None:
                        handle.close()
                    name, handle = file, where.open_input_file(f"{root}/{file}")
                got = parse_record(gzip.decompress(handle.read_at(length, offset)))
                found.append(tuple(got[c] for c in columns))
            yield _batch(found, **columns)
        if handle is not None:
            handle.close()

    places = written(located, "located")
    tasks = _tasks(places.agg(F.sum("length")).first()[0], READ_BYTES)
    ordered = places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(read, RECORD + ", payload binary" * payload)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, then looked up in the index and read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = fresh_path(spark, "warc")
    captures = write_archives(decide(pages), folder)
    files = build_index(captures, folder)
    discard(captures)
    return read_records(lookup(pages.select("page_id", "url"), folder, files), folder)


OP2_SQL = r"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""
