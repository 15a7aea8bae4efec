"""Web archives of pages, and a two-level index of what they hold.

Pages are written as WARC records, each a gzip member of its own. A page whose
payload equals that of another becomes a revisit that names the record with the
payload. The index sorts all captures by url with the host's labels reversed,
so that a site's pages stand together, and keeps them as compressed blocks of
lines; behind the blocks of a file stands a directory with the first key of
each. A lookup finds a file by the first keys of all files, a block by binary
search in the file's directory, a line by binary search in the block, and
reads only that block and then the range of the record.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.files import opened, shared_folder
from paperloom.llm.rows import quoted
from paperloom.operators.joins import join_unique
from paperloom.shipping import ship_package
from paperloom.staging import stage

# Captures in a block of the index, and bytes after which a new archive file is begun.
BLOCK_LINES = 2000
FILE_BYTES = 1 << 30
# Records less than this apart are read at once, up to so many bytes.
GAP, READ = 1 << 16, 4 << 20
# Compressed bytes of records that a task reads, about.
TASK_BYTES = 64 << 20
# Pages taken out of a batch at once.
SLICE = 256
# Rows of a batch handed on, and bytes of payload in it.
ROWS, BATCH_BYTES = 2000, 8 << 20
LEVEL = 4
# The time of captures that have none of their own.
DATE = "2000-01-01T00:00:00Z"

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(:[^/?#]*)?([^#]*)", re.DOTALL)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")

CAPTURES = "key string, date string, url string, page_id bigint, type string, digest string, file string, offset bigint, length bigint"
PARTS = "part int, file string, first string, directory_offset bigint, directory_length bigint, n_blocks bigint, n_captures bigint"
RECORDS = (
    "page_id bigint, url string, date string, record_id string, record_type string, refers_to_id string, "
    "payload_digest string, payload_bytes bigint, intact boolean"
)


def _escaped(text: str) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", text)


def capture_key(url: str | None) -> str:
    """The key of a url: host labels reversed and in lower case, port, then path and query; no fragment.

    A null url has the key ``-``, one that is no absolute url stands for itself.
    """
    if url is None:
        return "-"
    parts = _URL.match(url)
    if not parts:
        return _escaped(url)
    host, port, rest = parts.groups()
    return _escaped(",".join(reversed(host.lower().split("."))) + (port or "") + ")" + (rest if rest.startswith("/") else "/" + rest))


@dataclass(frozen=True)
class Archive:
    """Archive files in ``folder`` and the files of their index, a row for each in ``parts``."""

    folder: str
    parts: DataFrame


# --- writing ---------------------------------------------------------------


def _copies(keyed: DataFrame, min_bytes: int) -> DataFrame:
    """For payloads that several rows have: which row has the record that holds it."""
    rows = keyed.filter(F.octet_length("payload") >= min_bytes).groupBy("digest", "page_id", "url", "tie").agg(F.count("*").alias("n"))
    first = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", F.col("url").isNull().alias("nowhere"), "url", "tie", "n")
    return rows.groupBy("digest").agg(F.sum("n").alias("total"), F.min(first).alias("first")).filter("total > 1")


def write_archive(
    pages: DataFrame, folder: str, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = DATE
) -> Archive:
    """Write a record for each row of ``pages`` into gzipped WARC files, and their index.

    The payload is the page in UTF-8; a null page has an empty one, and any
    length is written whole. Of rows with equal payloads of at least
    ``min_bytes`` bytes, the one of the smallest id (then url) is a response
    and all others revisit it; smaller payloads are all responses. Null ids
    come last, and records of null urls name none. Rows that repeat each other
    have a record each, of which one is the response. Control characters and
    blanks in a url are escaped. Other columns are not written, whatever their
    names. An empty table gives an archive without files.

    ``folder`` is a new folder that all tasks reach. Each task writes files of
    its own and reports them when it is done, so what a lost task leaves behind
    is in no index. Payloads are not shuffled unless there are too many
    repeated ones to be held in every task.
    """
    spark = pages.sparkSession
    ship_package(spark)
    root = shared_folder(spark, folder)
    payload = F.coalesce(F.col(quoted(html)).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(quoted(page_id)).cast("bigint").alias("page_id"), F.col(quoted(url)).cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.select("*", F.unhex(F.sha1("payload")).alias("digest"), F.lit(0).cast("bigint").alias("tie"))
    copies = stage(_copies(keyed, min_bytes), "copies")
    if not copies.filter("first.n > 1").isEmpty():
        # rows that repeat each other are told apart by a number that is written down
        keyed = stage(keyed.withColumn("tie", F.monotonically_increasing_id()), "repeated-pages")
        copies = stage(_copies(keyed, min_bytes), "copies")
    joined = join_unique(keyed, copies, ["digest"])
    elected = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url")) & (F.col("tie") == F.col("first.tie"))
    told = joined.select(
        "page_id", "url", "payload", "digest", F.col("total").isNotNull().alias("shared"), (F.col("total").isNotNull() & ~elected).alias("revisit"), F.col("first.url").alias("first_url")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(root, date)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                done = [writer.add(*row) for row in zip(*[c.to_pylist() for c in batch.slice(at, SLICE).columns])]
                yield pa.RecordBatch.from_pylist(done, schema=_arrow(CAPTURES))
        writer.close()

    told.mapInArrow(write, CAPTURES).write.parquet(f"{root}/captures")
    _write_index(spark.read.schema(CAPTURES).parquet(f"{root}/captures"), root)
    return open_archive(spark, root)


def open_archive(spark: SparkSession, folder: str) -> Archive:
    ship_package(spark)
    return Archive(folder, spark.read.schema(PARTS).parquet(f"{folder}/parts"))


class _Writer:
    """Records appended to files of one task."""

    def __init__(self, root: str, date: str):
        self.root, self.date, self.out = root, date, None

    def add(self, page_id, url, payload: bytes, digest: bytes, shared: bool, revisit: bool, first_url) -> dict:
        if self.out is None or self.at > FILE_BYTES:
            self._begin()
        kind, name = "revisit" if revisit else "response", base64.b32encode(digest).decode()
        held = uuid.UUID(bytes=digest[:16], version=5)  # the record that holds a shared payload
        fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{held if shared and not revisit else uuid.uuid4()}>"), ("WARC-Date", self.date)]
        fields += [("WARC-Target-URI", _escaped(url))] if url is not None else []
        fields += [("WARC-Page-ID", str(page_id))] if page_id is not None else []
        fields += [("WARC-Payload-Digest", f"sha1:{name}")]
        if revisit:
            fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{held}>"), ("WARC-Refers-To-Date", self.date)]
            fields += [("WARC-Refers-To-Target-URI", _escaped(first_url))] if first_url is not None else []
        block = _HTTP.format(len(payload)).encode() + (b"" if revisit else payload)
        fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
        at, length = self.at, self._record(fields, block)
        return dict(
            key=capture_key(url), date=self.date, url=None if url is None else _escaped(url), page_id=page_id,
            type=kind, digest=name, file=self.name, offset=at, length=length,
        )

    def _begin(self) -> None:
        self.close()
        self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
        system, path = opened(f"{self.root}/{self.name}")
        self.out = system.open_output_stream(path, compression=None)  # compressed record by record
        said = b"format: WARC File Format 1.1\r\n"
        self._record(
            [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", self.date), ("WARC-Filename", self.name),
             ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(said)))], said
        )

    def _record(self, fields: list[tuple[str, str]], block: bytes) -> int:
        head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
        made = _gzip(head.encode() + block + b"\r\n\r\n")
        self.out.write(made)
        self.at += len(made)
        return len(made)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _gunzip(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _write_index(captures: DataFrame, root: str) -> None:
    """Sorted blocks and directories, a file for each range of keys."""
    order = ["key", "date", "file", "offset"]
    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, directory, lines, first, n = None, 0, [], [], None, 0

        def flush():
            nonlocal at, lines
            made = _gzip("".join(lines).encode())
            out.write(made)
            directory.append(json.dumps([first, at, len(made)]))
            at, lines = at + len(made), []

        for batch in batches:
            for row in batch.to_pylist():
                part, key = row.pop("part"), row.pop("key")
                if out is None:
                    name, lowest, number = f"{part:06d}-{uuid.uuid4().hex}.cdx", key, part
                    system, path = opened(f"{root}/{name}")
                    out = system.open_output_stream(path, compression=None)
                first = first if lines else key
                lines.append(f"{key} {re.sub('[^0-9]', '', row.pop('date'))} {json.dumps(row)}\n")
                n += 1
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            packed = _gzip("\n".join(directory).encode())
            out.write(packed)
            out.close()
            row = dict(part=number, file=name, first=lowest, directory_offset=at, directory_length=len(packed), n_blocks=len(directory), n_captures=n)
            yield pa.RecordBatch.from_pylist([row], schema=_arrow(PARTS))

    ranged.mapInArrow(write, PARTS).write.parquet(f"{root}/parts")


# --- reading ---------------------------------------------------------------


def _span(firsts: list[str], key: str) -> range:
    """Which of the pieces that begin with these keys can hold ``key``."""
    return range(max(bisect_left(firsts, key) - 1, 0), bisect_right(firsts, key))


class _Blocks:
    """One file of an index: its directory, and the block looked at last."""

    def __init__(self, uri: str, offset: int, length: int):
        system, path = opened(uri)
        self.file = system.open_input_file(path)
        self.directory = [json.loads(d) for d in _gunzip(self.file.read_at(length, offset)).decode().split("\n")]
        self.firsts = [d[0] for d in self.directory]
        self.at, self.lines, self.keys = None, [], []

    def find(self, key: str) -> Iterator[str]:
        for block in _span(self.firsts, key):
            if block != self.at:
                _, offset, length = self.directory[block]
                self.at, self.lines = block, _gunzip(self.file.read_at(length, offset)).decode().split("\n")[:-1]
                self.keys = [line.split(" ", 1)[0] for line in self.lines]
            yield from self.lines[bisect_left(self.keys, key) : bisect_right(self.keys, key)]


def find_captures(archive: Archive, urls: DataFrame, url: str = "url") -> DataFrame:
    """All captures of the urls in ``urls``: their key, time, page, type, digest, and where the record is.

    Urls that differ only in what the key leaves out find each other; a null
    url finds records without one, an unknown url nothing. Repeated urls are
    looked up once. Keys are sorted before the search, so a task walks through
    its blocks in order; a key whose captures fill several files of the index
    is divided by them.
    """
    ship_package(urls.sparkSession)
    root = archive.folder
    # a row for each file of the index, as many as it had ranges
    files = [r.asDict() for r in archive.parts.orderBy("part").collect()]
    firsts = [f["first"] for f in files]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list({capture_key(u) for u in batch.column(0).to_pylist()})
            spans = [_span(firsts, k) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, s in zip(keys, spans) for _ in s], pa.string()), pa.array([p for s in spans for p in s], pa.int32())], names=["key", "part"]
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks, found = None, None, []
        for batch in batches:
            for key, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != now:
                    now, f = part, files[part]
                    blocks = _Blocks(f"{root}/{f['file']}", f["directory_offset"], f["directory_length"])
                for line in blocks.find(key):
                    _, stamp, said = line.split(" ", 2)
                    date = f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z"
                    found.append({"key": key, "date": date, **json.loads(said)})
                    if len(found) >= ROWS:
                        yield pa.RecordBatch.from_pylist(found, schema=_arrow(CAPTURES))
                        found = []
        if found:
            yield pa.RecordBatch.from_pylist(found, schema=_arrow(CAPTURES))

    asked = urls.select(F.col(quoted(url)).cast("string")).mapInArrow(place, "key string, part int").distinct()
    return asked.repartitionByRange("part", "key").sortWithinPartitions("part", "key").mapInArrow(search, CAPTURES)


def read_records(archive: Archive, captures: DataFrame, payload: bool = True) -> DataFrame:
    """The records of captures, read from their ranges in the archive files.

    Gives ids, url, time, type, the record a revisit refers to, digest and
    length of the full payload, and the payload (binary; null in a revisit).
    ``intact`` says whether a response's payload has the length and digest its
    record claims. Captures are read in order of their place, neighbours with
    one read; the table may hold a capture twice, which is then read twice.
    """
    ship_package(captures.sparkSession)
    root = archive.folder
    schema = RECORDS + (", payload binary" if payload else "")
    places = stage(captures.select("file", "offset", "length"), "captures")
    # tasks by the bytes they will read, not by those of the places
    size = places.agg(F.sum("length")).first()[0] or 0
    tasks = max(captures.sparkSession.sparkContext.defaultParallelism, size // TASK_BYTES)
    ranged = places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for data in _ranges(root, batches):
            found.append(_parsed(_gunzip(data), payload))
            size += len(found[-1].get("payload") or b"")
            if len(found) >= ROWS or size > BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(found, schema=_arrow(schema))
                found, size = [], 0
        if found:
            yield pa.RecordBatch.from_pylist(found, schema=_arrow(schema))

    return ranged.mapInArrow(read, schema)


def _ranges(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    """The bytes of each range; neighbouring ranges of a file come from one read."""
    name, file = None, None
    for batch in batches:
        waiting: list[tuple[int, int]] = []

        def served():
            start, end = waiting[0][0], max(a + n for a, n in waiting)
            data = file.read_at(end - start, start)
            return [data[a - start : a - start + n] for a, n in waiting]

        for at, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
            if waiting and (at != name or offset > sum(waiting[-1]) + GAP or offset + length - waiting[0][0] > READ):
                yield from served()
                waiting.clear()
            if at != name:
                system, path = opened(f"{root}/{at}")
                name, file = at, system.open_input_file(path)
            waiting.append((offset, length))
        if waiting:
            yield from served()


def _parsed(record: bytes, payload: bool) -> dict:
    head, rest = record.split(b"\r\n\r\n", 1)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, body = block.split(b"\r\n\r\n", 1)
    claimed = int(re.search(rb"(?i)content-length: *([0-9]+)", http)[1])
    name = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    page = fields.get("WARC-Page-ID")
    made = dict(
        page_id=None if page is None else int(page), url=fields.get("WARC-Target-URI"), date=fields["WARC-Date"], record_id=fields["WARC-Record-ID"],
        record_type=fields["WARC-Type"], refers_to_id=fields.get("WARC-Refers-To"), payload_digest=name, payload_bytes=claimed, intact=None,
    )
    if not revisit:
        actual = base64.b32encode(hashlib.sha1(body).digest()).decode()
        made.update(intact=actual == name and len(body) == claimed, payload_digest=actual, payload_bytes=len(body))
    if payload:
        made["payload"] = None if revisit else body
    return made


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with ``refers_to``, the page of the response that a revisit refers to; null in responses.

    A revisit takes digest, length and payload, where there is one, from that
    response; without it among the records it keeps its own, and the others are null.
    """
    records = stage(records, "records")
    taken = [c for c in ("payload_digest", "payload_bytes", "payload") if c in records.columns]
    # only responses that share their payload are referred to
    asked = records.filter("refers_to_id IS NOT NULL").select(F.col("refers_to_id").alias("record_id")).distinct()
    held = records.filter("record_type = 'response'").join(asked, "record_id", "left_semi")
    held = held.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), *[F.col(c).alias(f"_{c}") for c in taken])
    joined = join_unique(records, held, ["refers_to_id"])
    return joined.select(*[F.coalesce(f"_{c}", c).alias(c) if c in taken else c for c in records.columns], "refers_to")
