"""WARC archives through a chunked record table.

Writing: every page becomes one header row (chunk -1) and one row for each
``CHUNK`` bytes of its payload. Rows are dealt to archives by record id and
sorted by (record, chunk), and each task streams its rows into gzip WARC files
of up to ``ROLL`` bytes, one gzip member a record. A payload of any size
passes through a task chunk by chunk; the SHA-256 digest is carried along and
must end at the digest in the header. Files get names of their own, and only the files that a
finished task lists are read, so a lost executor leaves nothing behind that counts.

Reading: each file is streamed back as rows (record_id, chunk_no, …) that carry
the size and the digest of the payload up to that chunk; the last row of a record has those of the
whole payload.

Equal payloads of at least ``SMALL`` bytes are stored once: the row with the
smallest page_id (nulls last; among equal ids the first in table order) is the
response, the others are revisits that refer to it. They are found by an
aggregate on (digest, size), so a payload that a third of all rows share meets
as one row of each task.

Defined results: null html is the empty payload, a response; a null page_id or
url leaves its header out and is read back as null; repeated rows are records
of their own; an empty table gives an empty result; other columns are ignored.
The table must give its rows in the same order when it is read again (files
do); a payload that does not match its header stops the job.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise
from tidemark.session import scratch_path

CHUNK = 1 << 16
SMALL = 100
ROLL = 1 << 30
DATE = "1970-01-01T00:00:00Z"
WRITE_SCHEMA = "path string, records long"
READ_SCHEMA = ("record_id string, chunk_no int, is_last boolean, page_id long, "
               "record_type string, refers_to long, payload_bytes long, payload_digest string, "
               "data binary")


def file_system(uri: str):
    """The pyarrow file system of a folder that all executors share, and its path."""
    from pyarrow import fs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def chunk_rows(pages: DataFrame, chunk: int = CHUNK, small: int = SMALL) -> DataFrame:
    """(record, chunk_no, data, page_id, url, bytes, digest, first_record, refers_to)."""
    rows = pages.select(
        F.monotonically_increasing_id().alias("record"), F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("body"))
    meta = materialise(rows.select("record", "page_id", "url",
                                   F.octet_length("body").cast("long").alias("bytes"),
                                   F.sha2("body", 256).alias("digest")), "warc-records")
    firsts = (meta.where(F.col("bytes") >= small).groupBy("digest", "bytes")
              .agg(F.min(F.struct(F.col("page_id").isNull().alias("n"), "page_id", "record"))
                   .alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("digest", "bytes", "first"))
    again = (meta.select("record", "digest", "bytes").join(firsts, ["digest", "bytes"])
             .where(F.col("record") != F.col("first.record"))
             .select("record", F.col("first.record").alias("first_record"),
                     F.col("first.page_id").alias("refers_to")))
    heads = meta.join(again, "record", "left").select(
        "record", F.lit(-1).alias("chunk_no"), F.lit(None).cast("binary").alias("data"),
        "page_id", "url", "bytes", "digest", "first_record", "refers_to")
    last = F.ceil(F.octet_length("body") / chunk).cast("int") - 1
    cut = rows.where(F.octet_length("body") > 0).select(
        "record", "body", F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"))
    body = cut.select("record", "chunk_no", F.substring(
        F.col("body"), F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("data"))
    return heads.unionByName(body, allowMissingColumns=True)


def record_name(record: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=record)}>"


class Archive:
    """One task's WARC files; every record is a gzip member of its own."""

    def __init__(self, folder: str, roll: int = ROLL) -> None:
        self.fs, self.folder = file_system(folder)
        self.uri = folder.rstrip("/")
        self.fs.create_dir(self.folder, recursive=True)
        self.roll, self.out, self.done = roll, None, []

    def write(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.size += len(data)

    def open(self) -> None:
        self.name, self.size, self.records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
        self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        note = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
        self.begin([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                    ("WARC-Date", DATE), ("Content-Type", "application/warc-fields"),
                    ("Content-Length", len(note))])
        self.write(self.zip.compress(note))
        self.end()

    def begin(self, headers: list[tuple]) -> None:
        self.zip = zlib.compressobj(1, zlib.DEFLATED, 31)
        lines = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
        self.write(self.zip.compress(f"WARC/1.1\r\n{lines}\r\n".encode()))

    def end(self) -> None:
        self.write(self.zip.compress(b"\r\n\r\n"))
        self.write(self.zip.flush())

    def record(self, head: dict) -> bool:
        """Starts a page's record; true when its payload is to follow."""
        if self.out is None or self.size > self.roll:
            self.close()
            self.open()
        self.records += 1
        http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                f"Content-Length: {head['bytes']}\r\n\r\n").encode()
        again = head["first_record"] is not None
        url = head["url"]
        self.begin([
            ("WARC-Type", "revisit" if again else "response"),
            ("WARC-Record-ID", record_name(head["record"])), ("WARC-Date", DATE),
            ("WARC-Target-URI", None if url is None else
             url.replace("\r", "%0D").replace("\n", "%0A")),
            ("WARC-Payload-Digest", f"sha256:{head['digest']}"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
             if again else None),
            ("WARC-Refers-To", record_name(head["first_record"]) if again else None),
            ("X-Page-Id", head["page_id"]), ("X-Refers-To-Page", head["refers_to"]),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(http) + (0 if again else head["bytes"]))])
        self.write(self.zip.compress(http))
        return not again

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.uri}/{self.name}", self.records))
            self.out = None


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    archive, head, digest = None, None, None

    def finish() -> None:
        if head is None:
            return
        if digest is not None and digest.hexdigest() != head["digest"]:
            raise ValueError(f"record {head['record']}: payload differs from its header")
        archive.end()

    names = ("record", "page_id", "url", "bytes", "digest", "first_record", "refers_to")
    for batch in batches:
        get = lambda c: batch.column(batch.schema.get_field_index(c))
        chunk, data = get("chunk_no").to_pylist(), get("data")
        heads = {n: get(n) for n in names}
        for k, number in enumerate(chunk):
            if number < 0:
                finish()
                archive = archive or Archive(folder)
                head = {n: c[k].as_py() for n, c in heads.items()}
                digest = hashlib.sha256() if archive.record(head) else None
                continue
            if head is None or heads["record"][k].as_py() != head["record"]:
                raise ValueError("a chunk without its record")
            if digest is not None:
                part = data[k].as_py()
                digest.update(part)
                archive.write(archive.zip.compress(part))
    finish()
    if archive is not None:
        archive.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in archive.done], pa.string()),
             pa.array([n for _, n in archive.done], pa.int64())], ["path", "records"])


def write_archives(pages: DataFrame, folder: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Writes the archives; the table of (path, records) of those that are complete."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (chunk_rows(pages, chunk).repartition(parts, "record")
             .sortWithinPartitions("record", "chunk_no"))
    return materialise(dealt.mapInArrow(lambda b: _write(b, folder), WRITE_SCHEMA), "warc-files")


def _headers(stream) -> dict[str, str] | None:
    """Header lines up to an empty one; None at the end of the file."""
    out, line = {}, stream.readline()
    while line in (b"\r\n", b"\n"):          # between records
        line = stream.readline()
    if not line:
        return None
    out[""] = line.decode().strip()
    while (line := stream.readline()).strip():
        name, _, value = line.decode().partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def records(path: str, chunk: int = CHUNK, data: bool = True) -> Iterator[tuple]:
    """The chunk rows of one file, in order, as ``READ_SCHEMA`` has them."""
    fs, place = file_system(path)
    number = lambda v: None if v is None else int(v)
    with fs.open_input_stream(place, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
        while (head := _headers(stream)) is not None:
            kind, left = head["warc-type"], int(head["content-length"])
            if kind not in ("response", "revisit"):
                stream.read(left)
                continue
            http = _headers(stream)
            size = int(http["content-length"])
            fixed = (head["warc-record-id"], kind, number(head.get("x-page-id")),
                     number(head.get("x-refers-to-page")))
            stated = head["warc-payload-digest"].removeprefix("sha256:")
            if kind == "revisit":
                yield (*fixed, 0, True, size, stated, None)
                continue
            digest, seen, n = hashlib.sha256(), 0, 0
            while True:
                part = stream.read(min(chunk, size - seen))
                if not part and seen < size:
                    raise ValueError(f"{path}: a record ends early")
                digest.update(part)
                seen += len(part)
                yield (*fixed, n, seen == size, seen, digest.copy().hexdigest(),
                       part if data else None)
                n += 1
                if seen == size:
                    break
            if digest.hexdigest() != stated:
                raise ValueError(f"{path}: a payload differs from its header")


def _read(batches: Iterator[pa.RecordBatch], chunk: int, data: bool) -> Iterator[pa.RecordBatch]:
    types = (pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.int64(),
             pa.string(), pa.binary())
    names = [c.split()[0] for c in READ_SCHEMA.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        order = (0, 4, 5, 2, 1, 3, 6, 7, 8)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in zip(order, types)], names)

    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = []
            for row in records(path, chunk, data):
                rows.append(row)
                if len(rows) >= 256:
                    yield table(rows)
                    rows = []
            if rows:
                yield table(rows)


def read_archives(files: DataFrame, chunk: int = CHUNK, data: bool = True) -> DataFrame:
    """Chunk rows of the archives listed in ``files`` (path)."""
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").repartition(parts, "path").mapInArrow(
        lambda b: _read(b, chunk, data), READ_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` and reads them back: page_id, payload_bytes, payload_digest,
    record_type and refers_to of every record."""
    back = read_archives(write_archives(pages), data=False)
    return back.where("is_last").select("page_id", "payload_bytes", "payload_digest",
                                        "record_type", "refers_to")
