"""WARC archives with a two-level capture index.

Writing: every task writes its rows as gzip members (one record each) of its
own archive files and hands on one index line per record; payloads are never
shuffled for that. Equal payloads are found by digest: all but one become
revisit records without a payload.

Index: lines are range-partitioned and sorted by reversed-host URL key
(``com,example)/path``), then written as gzip blocks of ``BLOCK_LINES`` lines.
The sparse directory has a block's first key, file, offset and length; the
first keys of the index files stand above it. A lookup searches both levels by
bisection, reads the blocks' byte ranges, bisects in the lines and reads the
records' byte ranges. A key with very many captures spans blocks and files.

Files are opened with ``pyarrow.fs`` by URI, below the shared folder. Names are
new for each task attempt; only lines of finished attempts are in the index, so
a lost executor leaves unused files at most.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm.common import written
from curbline.session import scratch_path

BLOCK_LINES = 3000
FILE_BYTES = 512 << 20          # an archive file is closed beyond that
READ_GAP = 64 << 10             # ranges this near are read at once
READ_BYTES = 8 << 20            # but so many bytes at most
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = "key string, page_id bigint, kind string, file string, start bigint, size bigint"
DIRECTORY = "first_key string, file string, start bigint, size bigint, n_lines bigint"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI as Spark writes it (``file:/x`` included)."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def url_key(url: str | None) -> str:
    """Reversed-host sort key; an absent or unreadable URL keeps its text after ``)``."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return ")" + text
    if not host:
        return ")" + text
    key = ",".join(reversed(host.split(".")))
    if port and (parts.scheme, port) not in (("http", 80), ("https", 443)):
        key += f":{port}"
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records ----------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    kind = "response" if refers_to is None else "revisit"
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url}')}>"),
            ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        head.append(("WARC-Target-URI", json.dumps(url)[1:-1]))     # no line breaks in a header
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("X-Refers-To-Page-ID", str(refers_to))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The row of a record; raises ValueError if its parts do not fit together."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if first != "WARC/1.1" or not revisit and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"damaged record of page {fields.get('X-Page-ID')}")
    number = lambda name: int(fields[name]) if name in fields else None
    url = fields.get("WARC-Target-URI")
    return {"page_id": number("X-Page-ID"), "url": None if url is None else json.loads(f'"{url}"'),
            "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-ID"),
            "payload_digest": digest, "payload_bytes": size, "payload": None if revisit else payload}


class Archive:
    """Append-only archive files of one task."""

    def __init__(self, folder: str):
        self.folder, self.out = folder, None

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.out is None:
            self.file, self.at = f"{self.folder}/{uuid.uuid4().hex}.warc.gz", 0
            system, path = opened(self.file)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            self.out = system.open_output_stream(path, compression=None)
        packed = gzip.compress(data, 5, mtime=0)
        self.out.write(packed)
        place = self.file, self.at, len(packed)
        self.at += len(packed)
        if self.at >= FILE_BYTES:
            self.close()
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


# --- writing ----------------------------------------------------------------

def write_captures(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write one record per row; the captures (key, page_id, kind, file, start, size).

    Of rows with equal payloads of at least ``least_bytes`` bytes, those with
    the largest id are responses (rows that repeat this id all are), the others
    revisits of it. A null payload is empty. A null id never is the largest;
    equal payloads with null ids alone are responses. A URL may be null.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    shared = (rows.where(F.octet_length("payload") >= least_bytes).groupBy("sha")
              .agg(F.count("*").alias("n"), F.max("page_id").alias("keep")).where("n > 1").select("sha", "keep"))
    other = F.col("keep").isNotNull() & (F.coalesce("page_id", F.lit(-(1 << 63))) < F.col("keep"))
    marked = rows.join(shared, "sha", "left").select(
        "page_id", "url", F.when(~F.coalesce(other, F.lit(False)), F.col("payload")).alias("payload"),
        F.octet_length("payload").alias("size"), F.unhex("sha").alias("sha"), F.when(other, F.col("keep")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = Archive(folder)
        for batch in batches:
            lines: list[list] = [[] for _ in range(6)]
            for page_id, url, body, size, sha, refers in zip(*(c.to_pylist() for c in batch.columns)):
                data = record(page_id, url, body or b"", size, base64.b32encode(sha).decode(), refers)
                for column, value in zip(lines, (url_key(url), page_id, "response" if refers is None else "revisit", *archive.add(data))):
                    column.append(value)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(lines, kinds)],
                                             ["key", "page_id", "kind", "file", "start", "size"])
        archive.close()

    return written(marked.mapInArrow(run, CAPTURE), "warc-captures")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the index blocks; the directory (first_key, file, start, size, n_lines)."""
    order = ["key", "page_id", "file", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, held = Archive(folder + "/index"), []
        blocks: list[tuple] = []

        def flush(n: int) -> None:
            data = "".join(held[:n]).encode()
            blocks.append((json.loads(held[0])[0], *archive.add(data), n))
            del held[:n]

        for batch in batches:
            held += [json.dumps(row) + "\n" for row in zip(*(c.to_pylist() for c in batch.columns))]
            while len(held) >= BLOCK_LINES:
                flush(BLOCK_LINES)
        if held:
            flush(len(held))
        archive.close()
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([b[i] for b in blocks], k) for i, k in enumerate(kinds)],
                                         ["first_key", "file", "start", "size", "n_lines"])

    sorted_ = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(sorted_.select("key", "page_id", "kind", "file", "start", "size").mapInArrow(run, DIRECTORY), "warc-directory")


def write_archive(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Records and index of ``pages`` below ``folder`` (new if none); the directory."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return write_index(write_captures(pages, folder, **options), folder)


# --- reading ----------------------------------------------------------------

class Ranges:
    """Byte ranges of files, through one open file at a time."""

    def __init__(self):
        self.name, self.file = None, None

    def read(self, name: str, start: int, size: int) -> bytes:
        if name != self.name:
            self.close()
            system, path = opened(name)
            self.name, self.file = name, system.open_input_file(path)
        return self.file.read_at(size, start)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.name, self.file = None, None


def block_lines(data: bytes) -> list[list]:
    """[key, page_id, kind, file, start, size] of each line of an index block."""
    return [json.loads(line) for line in gzip.decompress(data).splitlines()]


def index_lines(directory: DataFrame) -> DataFrame:
    """All captures, read from the index blocks that the directory names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges()
        for batch in batches:
            for name, start, size in zip(*(c.to_pylist() for c in batch.columns)):
                lines = block_lines(ranges.read(name, start, size))
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in lines], k) for i, k in enumerate(kinds)],
                                                 ["key", "page_id", "kind", "file", "start", "size"])
        ranges.close()

    return directory.select("file", "start", "size").mapInArrow(run, CAPTURE)


def _rows(found: list[dict]) -> pa.RecordBatch:
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], k) for n, k in zip(names, kinds)], names)


def read_records(captures: DataFrame) -> DataFrame:
    """The records of ``captures``: near ranges of a file are read at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges()
        group: list[tuple] = []

        def rows() -> pa.RecordBatch:
            name, first = group[0][:2]
            data = ranges.read(name, first, max(s + n for _, s, n in group) - first)
            found = [parse(zlib.decompress(data[s - first:s - first + n], 31)) for _, s, n in group]
            group.clear()
            return _rows(found)

        for batch in batches:
            for name, start, size in zip(*(c.to_pylist() for c in batch.columns)):
                if group and (name != group[0][0] or start - group[-1][1] - group[-1][2] > READ_GAP
                              or start + size - group[0][1] > READ_BYTES):
                    yield rows()
                group.append((name, start, size))
        if group:
            yield rows()
        ranges.close()

    # spans of a file, so that one large file is no single task's work
    span = F.floor(F.col("start") / (READ_BYTES * 2))
    return (captures.select("file", "start", "size", span.alias("span")).repartition("file", "span")
            .sortWithinPartitions("file", "start").select("file", "start", "size").mapInArrow(run, RECORD))


def lookup(directory: DataFrame, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The records of each URL in ``urls``: ``wanted`` (the URL asked) and the record's columns.

    The upper level (one key per index file, at most one file per partition of
    the index) goes to all tasks; a task keeps the directory of the index files
    it has needed. Null URLs find nothing; a URL without captures has no row.
    """
    spark: SparkSession = directory.sparkSession
    by_file = (directory.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("first_key", "start", "size"))).alias("blocks"),
                                             F.min("first_key").alias("first_key")))
    files = sorted((r.first_key, r.file) for r in by_file.select("first_key", "file").collect())
    upper = spark.sparkContext.broadcast(files)
    firsts = [f for f, _ in files]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(url, url_key(url), upper.value[i][1]) for url in batch.column(0).to_pylist() if url is not None
                   for i in _spanning(firsts, url_key(url))]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in range(3)], ["wanted", "key", "file"])

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges()
        for batch in batches:
            for wanted, key, name, blocks in zip(*(c.to_pylist() for c in batch.columns)):
                found = []
                for i in _spanning([b["first_key"] for b in blocks], key):
                    lines = block_lines(ranges.read(name, blocks[i]["start"], blocks[i]["size"]))
                    at = bisect_left(lines, key, key=lambda x: x[0])
                    while at < len(lines) and lines[at][0] == key:
                        found.append(lines[at][3:])
                        at += 1
                if found:
                    rows = _rows([parse(zlib.decompress(ranges.read(*f), 31)) for f in found])
                    yield pa.RecordBatch.from_arrays([pa.array([wanted] * len(found), pa.string()), *rows.columns],
                                                     ["wanted", *rows.schema.names])
        ranges.close()

    asked = urls.select(F.col(f"`{url_col}`").cast("string").alias("wanted")).distinct()
    placed = asked.mapInArrow(near, "wanted string, key string, file string")
    return (placed.join(by_file.select("file", "blocks"), "file").select("wanted", "key", "file", "blocks")
            .mapInArrow(hits, f"wanted string, {RECORD}"))


def _spanning(firsts: list[str], key: str) -> range:
    """Places whose part of the key order may hold ``key`` (parts start at ``firsts``)."""
    end = bisect_left(firsts, key)
    start = max(0, end - 1)
    while end < len(firsts) and firsts[end] == key:
        end += 1
    return range(start, end)
