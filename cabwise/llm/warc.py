"""WARC archives with a two-level capture index.

Writing: pages of equal payload (SHA-256, at least ``MIN_REVISIT`` bytes) are
grouped; the least page id is written as a response and the others as revisits
of it, without the payload. Every task writes its own archive files, each
record a gzip member, and returns where its records lie. A file belongs to a
task attempt, so a repeated task writes another file and only files of
finished attempts are in the index.

Index: captures are sorted by reversed-host URL key and id over range
partitions. A partition writes one index part: compressed blocks of
``BLOCK_LINES`` sorted lines, and behind them a sparse directory with each
block's first key. The first keys of the parts (one a partition) are the level
above.

Reading: a query is sent to the part that covers its key (binary search in the
parts' first keys), finds its block there (binary search in the directory, one
range read) and its lines (binary search in the block); the records are then
fetched by range reads in file order and parsed.

Files are reached through ``pyarrow.fs``, below the shared folder that
``spark.checkpoint.dir`` names.

Defined results: a null payload is empty. A null URL has the empty key and no
target header; a null id is kept as null. Rows that repeat an id are records
of their own. Empty input: empty result. Other columns are dropped.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.llm.common import NULL_ID, arrow_map, column, id_key, slices, staged
from cabwise.plans.lineage import tracked_path

MIN_REVISIT = 100
BLOCK_LINES = 512
FILE_BYTES = 1 << 30
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"  # the pages have no time of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---------------------------------------------------------------- files

def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def url_key(url: str | None) -> str:
    """``http://m.example.org/a?b`` as ``org,example,m)/a?b``; fragments go."""
    if not url:
        return ""
    rest = url.partition("#")[0]
    rest = rest.partition("://")[2] or rest
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host, path = rest[:cut], rest[cut:]
    host, _, port = host.rpartition("@")[2].lower().partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port not in ("", "80", "443") else "") + ")" + (path or "/")


# ---------------------------------------------------------------- records

def record(page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit's block ends with the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_SAFE)}")
    if page_id != NULL_ID:
        lines.append(f"X-Page-ID: {page_id}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_SAFE = "".join(chr(c) for c in range(0x21, 0x7F) if chr(c) != "%")


def parse(data: bytes) -> dict:
    """A record read back: its headers, and the payload (none in a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    revisit = headers["WARC-Type"] == "revisit"
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if not revisit and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("a record's payload doesn't have its digest")
    url = headers.get("WARC-Target-URI")
    return {"page_id": int(headers["X-Page-ID"]) if "X-Page-ID" in headers else None,
            "url": None if url is None else unquote(url), "record_type": headers["WARC-Type"],
            "payload_bytes": length, "payload_digest": digest, "payload": None if revisit else payload,
            "refers_to": int(headers["WARC-Refers-To"][len("<urn:page:"):-1]) if revisit else None}


# ---------------------------------------------------------------- writing

CAPTURE = "key string, page_id long, file string, position long, length long"


def revisits(pages: DataFrame, least_bytes: int = MIN_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, html) with the payload's digest, and the page it revisits or null.

    Only digests and ids are grouped; payloads move once, by page id."""
    keyed = pages.withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256)})
    small = keyed.where(F.octet_length("html") >= least_bytes).select("page_id", "digest")
    groups = small.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = (small.join(groups, "digest").where("page_id != refers_to")
             .select("page_id", "digest", "refers_to").distinct())
    return keyed.join(again, ["page_id", "digest"], "left")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write records of (page_id, url, html, digest, refers_to); returns the captures."""
    def run(batches):
        store, path = open_store(folder)
        out, name, at = None, "", 0
        try:
            for batch in slices(batches, "html"):
                rows = []
                for page_id, url, html, digest, refers_to in zip(*(column(batch, c).to_pylist() for c in (
                        "page_id", "url", "html", "digest", "refers_to"))):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{path}/{name}", compression=None)
                    member = gzip_member(record(page_id, url, html.encode(), digest, refers_to))
                    out.write(member)
                    rows.append((url_key(url), page_id, name, at, len(member)))
                    at += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)],
                                                 names=["key", "page_id", "file", "position", "length"])
        finally:
            if out is not None:
                out.close()

    return arrow_map(pages.select("page_id", "url", "html", "digest", "refers_to"), run, CAPTURE)


# ---------------------------------------------------------------- the index

PART = "part string, first_key string, first_id long, blocks int"


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the index parts; returns one row for each (its name and first key)."""
    def run(batches):
        store, path = open_store(folder)
        name, first, at, held, directory, out = f"{uuid.uuid4().hex}.cdx", None, 0, [], [], None

        def block():
            nonlocal at, held
            packed = zlib.compress("\n".join(json.dumps(x) for x in held).encode(), LEVEL)
            out.write(packed)
            directory.append([held[0][0], held[0][1], at, len(packed)])
            at += len(packed)
            held = []

        for batch in batches:
            for row in zip(*(x.to_pylist() for x in batch.columns)):
                if out is None:
                    out, first = store.open_output_stream(f"{path}/{name}", compression=None), row
                held.append(row)
                if len(held) == BLOCK_LINES:
                    block()
        if out is None:
            return
        if held:
            block()
        packed = zlib.compress(json.dumps(directory).encode())
        out.write(packed + struct.pack("<Q", len(packed)))
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([first[0]]), pa.array([first[1]], pa.int64()),
                                          pa.array([len(directory)], pa.int32())],
                                         names=["part", "first_key", "first_id", "blocks"])

    ordered = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "file", "position")
    return arrow_map(ordered, run, PART)


class Part:
    """An index part opened for search: its directory is read, blocks on demand."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        end = self.file.size()
        size = struct.unpack("<Q", self.file.read_at(8, end - 8))[0]
        self.directory = json.loads(zlib.decompress(self.file.read_at(size, end - 8 - size)))
        self.firsts = [(key, page_id) for key, page_id, _, _ in self.directory]
        self.at, self.lines = -1, []

    def find(self, key: str, page_id: int | None = None) -> list[list]:
        """Captures of a key, or of a key and id: [key, id, file, position, length]."""
        low = (key, page_id if page_id is not None else -1 << 63)
        high = (key, page_id if page_id is not None else 1 << 63)
        found = []
        for k in range(max(0, bisect_left(self.firsts, low) - 1), bisect_right(self.firsts, high)):
            if k != self.at:
                _, _, position, length = self.directory[k]
                raw = zlib.decompress(self.file.read_at(length, position)).decode()
                self.at, self.lines = k, [json.loads(x) for x in raw.split("\n")]
            by = lambda line: (line[0], line[1])
            found += self.lines[bisect_left(self.lines, low, key=by):bisect_right(self.lines, high, key=by)]
        return found


class Archive:
    """Archive files and their index below one folder."""

    def __init__(self, spark: SparkSession, folder: str, parts: DataFrame):
        self.spark, self.folder = spark, folder
        # one row for each range partition of the index, whatever the number of captures
        self.parts = sorted((r.first_key, r.first_id, r.part) for r in parts.collect())

    def find(self, queries: DataFrame) -> DataFrame:
        """Captures of the distinct (key, page_id) in ``queries``; a null id asks for all of a key."""
        parts, folder = self.parts, self.folder
        firsts = [(key, page_id) for key, page_id, _ in parts]

        def route(batches):
            for batch in batches:
                rows = []
                for key, page_id in zip(*(column(batch, c).to_pylist() for c in ("key", "page_id"))):
                    low = (key, page_id if page_id is not None else -1 << 63)
                    high = (key, page_id if page_id is not None else 1 << 63)
                    for k in range(max(0, bisect_left(firsts, low) - 1), bisect_right(firsts, high)):
                        rows.append((k, key, page_id))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                    list(zip(*rows)) or ((), (), ()), (pa.int32(), pa.string(), pa.int64()))], names=["part", "key", "page_id"])

        def search(batches):
            store, path = open_store(folder)
            at, part = None, None
            for batch in batches:
                rows = []
                for k, key, page_id in zip(*(column(batch, c).to_pylist() for c in ("part", "key", "page_id"))):
                    if k != at:
                        at, part = k, Part(store, f"{path}/{parts[k][2]}")
                    rows += part.find(key, page_id)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                    list(zip(*rows)) or ((),) * 5, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                    names=["key", "page_id", "file", "position", "length"])

        routed = arrow_map(queries.select("key", "page_id").distinct(), route, "part int, key string, page_id long")
        return arrow_map(routed.repartition("part").sortWithinPartitions("part", "key", "page_id"), search, CAPTURE)

    def fetch(self, captures: DataFrame, payload: bool = True) -> DataFrame:
        """The records at ``captures``, read in file order."""
        folder = self.folder
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"][:6 + payload]
        types = dict(zip(names, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())))

        def read(batches):
            store, path = open_store(folder)
            at, file = None, None
            for batch in batches:
                for i in range(0, batch.num_rows, 500):
                    rows = []
                    for name, position, length in zip(*(column(batch.slice(i, 500), c).to_pylist()
                                                        for c in ("file", "position", "length"))):
                        if name != at:
                            at, file = name, store.open_input_file(f"{path}/{name}")
                        rows.append(parse(zlib.decompress(file.read_at(length, position), 31)))
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types[n]) for n in names], names=names)

        schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
        stretch = F.floor(F.col("position") / (16 << 20))
        ordered = captures.repartition("file", stretch).sortWithinPartitions("file", "position")
        return arrow_map(ordered, read, schema + ", payload binary" * payload)


def archive_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> Archive:
    """Write all pages and their index."""
    spark = pages.sparkSession
    folder = tracked_path(spark, "warc")
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    own = pages.select(id_key(page_id).alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                       F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"))
    captures = staged(write_archives(revisits(own), folder), "captures")
    return Archive(spark, folder, staged(write_index(captures, folder), "index-parts"))


def url_keys(pages: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(key, page_id) of every page, as queries."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(x) for x in column(batch, "url").to_pylist()], pa.string()),
                                              column(batch, "page_id")], names=["key", "page_id"])

    return arrow_map(pages.select(id_key(page_id).alias("page_id"), F.col(f"`{url}`").cast("string").alias("url")), run,
                     "key string, page_id long")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archive = archive_pages(pages)
    return archive.fetch(archive.find(url_keys(pages)), payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest,
                  CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
g AS (SELECT *, CASE WHEN payload_bytes >= {MIN_REVISIT} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id
      FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM g
"""
