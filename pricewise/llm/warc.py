"""WARC archives with a two-level capture index.

``write_archives`` writes one gzip member per record (WARC/1.1) into archive files of
the shared folder: of records with equal payloads of MIN_REVISIT bytes or more, that
with the smallest page id is the response and the others revisit it; smaller payloads
are all responses. ``write_index`` sorts the captures by reversed-host URL key into
compressed blocks of BLOCK_CAPTURES and keeps a sparse directory: one entry per block
beside each index file, and above these one first key per index file. ``lookup`` binary-
searches both levels, reads the block's byte range, then the record's byte range.
``read_back`` reads every block and every record.

Scale and failure: the repeated digests are counted first. Up to BROADCAST_DIGESTS of them
are broadcast and no payload is shuffled; beyond that the pages join by digest, payloads
with them (a digest that is on very many pages is split by adaptive execution).
Records are read back in slices of archive files: the offset in a file is the running sum
of the lengths before it, so slices of READ_BYTES hold equal amounts of bytes, and tasks
get equal numbers of slices.
Captures are sorted by (key, file, offset), so a host or URL with very many captures is
dealt over tasks. Files are named by task attempt and listed only in what the finished
attempt returned, so a rerun never rewrites what a reader was told; files of lost
attempts stay unreferenced. Tasks hold one record or one block at a time. All files go
to the folder given, through Arrow's file systems (local, HDFS, object stores).

Edge cases: null html is an empty payload; a null url has an empty key and no target
header; null page ids are written without an id and never referred to; rows repeated
under one id with the same payload are all responses; control characters in URLs are
percent-encoded in headers; empty tables write nothing and read back nothing.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage

MIN_REVISIT = 100
BLOCK_CAPTURES = 1024
MAX_ARCHIVE_BYTES = 1 << 30
#: Repeated digests that are broadcast at most (about 100 bytes each).
BROADCAST_DIGESTS = 200_000
#: Most and fewest archive bytes of a slice, and slices for a task.
READ_BYTES, MIN_READ_BYTES, SLICES = 1 << 22, 1 << 16, 8
#: Date of all records: the pages table has no capture times.
DATE = "2000-01-01T00:00:00Z"

_CAPTURE = "key string, page_id string, record_type string, refers_to string, file string, offset long, length long"
_COLUMNS = ["key", "page_id", "record_type", "refers_to", "file", "offset", "length"]


def url_key(url: str | None) -> str:
    """Host parts reversed, then path and query: ``com,example,blog)/a?b=1``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url.lower()
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "") + ")" + (parts.path or "/")
    key += f"?{parts.query}" if parts.query else ""
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in key.lower())


def _header(value: str) -> str:
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in value)


def _record_id(page_id) -> str:
    return f"<urn:page:{page_id}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record. A revisit keeps the HTTP header with the payload's length, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if page_id is not None:
        lines.append(f"WARC-Record-ID: {_record_id(page_id)}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers (lower-case names), the HTTP content length, and the payload (None for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    out = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[:int(out["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return out | {"http-length": size, "payload": None if out["warc-type"] == "revisit" else payload}


class _Writer:
    """Files of this task attempt in the shared folder."""

    def __init__(self, folder: str, kind: str):
        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.folder, recursive=True)
        ctx = TaskContext.get()
        self.prefix, self.kind, self.number, self.out, self.at = f"{ctx.partitionId():06d}-{ctx.taskAttemptId()}", kind, 0, None, 0

    def put(self, data: bytes, limit: int) -> tuple[str, int]:
        """File name and offset of the data."""
        if self.out is not None and self.at + len(data) > limit:
            self.close()
        if self.out is None:
            self.name = f"{self.prefix}-{self.number}.{self.kind}"
            self.out, self.at, self.number = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None), 0, self.number + 1
        at = self.at
        self.out.write(data)
        self.at += len(data)
        return self.name, at

    def beside(self, name: str, data: bytes) -> None:
        with self.fs.open_output_stream(f"{self.folder}/{name}", compression=None) as out:
            out.write(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


class _Reader:
    """Byte ranges of files in the shared folder; one file open at a time."""

    def __init__(self, folder: str):
        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.name, self.file = None, None

    def get(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.file = name, self.fs.open_input_file(f"{self.folder}/{name}")
        self.file.seek(offset)
        return self.file.read(length)

    def all(self, name: str) -> bytes:
        with self.fs.open_input_file(f"{self.folder}/{name}") as f:
            return f.read()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives and returns the captures (key, page_id as text, record_type,
    refers_to, file, offset, length), already materialised."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    repeated = (rows.where(F.octet_length("html") >= MIN_REVISIT).groupBy("digest")
                .agg(F.min("page_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n"))
    repeated = cut_lineage(repeated, "repeated")
    if repeated.count() <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    rows = rows.join(repeated, "digest", "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "html", "digest",
        F.when(F.coalesce(F.col("page_id") != F.col("least"), F.col("least").isNotNull()), F.col("least").cast("string")).alias("refers_to"))
    schema = T._parse_datatype_string(_CAPTURE)
    arrow = pa.schema([(n, pa.int64() if n in ("offset", "length") else pa.string()) for n in _COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(folder, "warc.gz")
        for b in batches:
            out = []
            for page_id, url, html, digest, refers_to in zip(*(iter(c) for c in b.columns)):
                page_id, url, refers_to = page_id.as_py(), url.as_py(), refers_to.as_py()
                data = gzip.compress(record(page_id, url, html.as_buffer().to_pybytes(), digest.as_py(), refers_to), 6, mtime=0)
                name, at = writer.put(data, MAX_ARCHIVE_BYTES)
                out.append((url_key(url), page_id, "response" if refers_to is None else "revisit", refers_to, name, at, len(data)))
            yield _batch(out, arrow)
        writer.close()

    return cut_lineage(rows.mapInArrow(run, schema), "captures")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sorts the captures into blocks and returns the directory (first_key, file,
    offset, length, n, record_bytes: of the records it lists), one row per block, already materialised. Each index file also
    has its part of the directory beside it (``.dir``)."""
    schema = T._parse_datatype_string("first_key string, file string, offset long, length long, n long, record_bytes long")
    arrow = pa.schema([("first_key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("n", pa.int64()), ("record_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(folder, "cdx.gz")
        held: list[list] = []
        directory: list[tuple] = []

        def block(lines):
            data = gzip.compress("".join("\t".join("" if v is None else str(v) for v in x) + "\n" for x in lines).encode(), 6, mtime=0)
            name, at = writer.put(data, MAX_ARCHIVE_BYTES << 10)
            directory.append((lines[0][0], name, at, len(data), len(lines), sum(x[6] for x in lines)))

        for b in batches:
            held += zip(*(c.to_pylist() for c in b.columns))
            while len(held) >= BLOCK_CAPTURES:
                block(held[:BLOCK_CAPTURES])
                del held[:BLOCK_CAPTURES]
        if held:
            block(held)
        writer.close()
        if directory:
            writer.beside(f"{directory[0][1]}.dir", "".join(f"{k}\t{at}\t{size}\n" for k, _, at, size, *_ in directory).encode())
        yield _batch(directory, arrow)

    order = ["key", "file", "offset"]
    dealt = captures.select(*_COLUMNS).repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(dealt.mapInArrow(run, schema), "directory")


def _captures(data: bytes) -> list[tuple]:
    return [(k, p or None, t, r or None, f, int(o), int(n)) for k, p, t, r, f, o, n in
            (x.split("\t") for x in zlib.decompress(data, 31).decode().split("\n")[:-1])]


def read_index(spark: SparkSession, directory: DataFrame, folder: str) -> DataFrame:
    """All captures, block by block (byte ranges of the index files)."""
    schema = T._parse_datatype_string(_CAPTURE)
    arrow = pa.schema([(n, pa.int64() if n in ("offset", "length") else pa.string()) for n in _COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(folder)
        for b in batches:
            for name, at, size in zip(*(b.column(i).to_pylist() for i in range(3))):
                yield _batch(_captures(reader.get(name, at, size)), arrow)
        reader.close()

    return directory.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, schema)


def read_tasks(spark: SparkSession, record_bytes: int) -> tuple[int, int]:
    """Tasks that read so many bytes of records, and the bytes of a slice: as many tasks as
    the session runs at once, more if one had over SLICES slices of READ_BYTES."""
    tasks = max(spark.sparkContext.defaultParallelism, -(-record_bytes // (READ_BYTES * SLICES)))
    return tasks, min(READ_BYTES, max(MIN_READ_BYTES, record_bytes // (tasks * SLICES)))


def read_records(captures: DataFrame, folder: str, record_bytes: int | None = None) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, html) read
    from the archives; ids as text; html is null for revisits. The digest of a response
    is computed anew from its payload and must equal the header's. ``record_bytes``: the sum of the captures' lengths, if known."""
    if record_bytes is None:
        record_bytes = captures.agg(F.sum("length")).first()[0] or 0
    tasks, slice_bytes = read_tasks(captures.sparkSession, record_bytes)
    schema = T._parse_datatype_string("page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, html string")
    arrow = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.string()), ("html", pa.string())])

    def ident(value: str | None) -> str | None:
        return value[len("<urn:page:"):-1] if value else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(folder)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part, out = b.slice(lo, 256), []
                for name, at, size in zip(*(part.column(i).to_pylist() for i in range(3))):
                    r = parse(zlib.decompress(reader.get(name, at, size), 31))
                    digest = r["warc-payload-digest"].partition(":")[2]
                    if r["payload"] is not None and (hashlib.sha256(r["payload"]).hexdigest() != digest or len(r["payload"]) != r["http-length"]):
                        raise ValueError(f"damaged record at {name}:{at}")
                    out.append((ident(r.get("warc-record-id")), r.get("warc-target-uri"), r["http-length"], digest, r["warc-type"],
                                ident(r.get("warc-refers-to")), r["payload"].decode() if r["payload"] is not None else None))
                yield _batch(out, arrow)
        reader.close()

    part = F.floor(F.col("offset") / slice_bytes)
    return captures.select("file", "offset", "length").repartition(tasks, "file", part).sortWithinPartitions("file", "offset").mapInArrow(run, schema)


def read_back(spark: SparkSession, directory: DataFrame, folder: str) -> DataFrame:
    """Every record, found through the index."""
    record_bytes = directory.agg(F.sum("record_bytes")).first()[0] or 0
    return read_records(read_index(spark, directory, folder), folder, record_bytes)


def lookup(urls: DataFrame, directory: DataFrame, folder: str, url_col: str = "url") -> DataFrame:
    """(url, key, page_id, record_type, refers_to, file, offset, length): the captures of
    each url's key, by two binary searches.

    The driver holds one first key per index file (as many as tasks wrote the index); a
    task loads the directory of the files it needs, one at a time.
    """
    top = sorted((r.first_key, r.file) for r in directory.groupBy("file").agg(F.min("first_key").alias("first_key")).collect())
    schema = T._parse_datatype_string("url string, " + _CAPTURE)
    arrow = pa.schema([("url", pa.string()), *((n, pa.int64() if n in ("offset", "length") else pa.string()) for n in _COLUMNS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(folder)
        firsts = [k for k, _ in top]
        loaded: tuple = (None, [], [])
        for b in batches:
            for url in b.column(0).to_pylist():
                key, out = url_key(url), []
                for i in range(max(0, bisect.bisect_left(firsts, key) - 1), bisect.bisect_right(firsts, key)):
                    if loaded[0] != top[i][1]:
                        entries = [x.split("\t") for x in reader.all(f"{top[i][1]}.dir").decode().split("\n")[:-1]]
                        loaded = (top[i][1], [e[0] for e in entries], [(int(e[1]), int(e[2])) for e in entries])
                    name, keys, ranges = loaded
                    for j in range(max(0, bisect.bisect_left(keys, key) - 1), bisect.bisect_right(keys, key)):
                        out += [(url, *c) for c in _captures(reader.get(name, *ranges[j])) if c[0] == key]
                yield _batch(out, arrow)
        reader.close()

    keyed = urls.select(F.col(url_col).alias("url"))
    return keyed.repartitionByRange("url").sortWithinPartitions("url").mapInArrow(run, schema)
