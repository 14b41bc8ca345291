"""WARC archives in Zstandard: one frame per record, a dictionary in a leading skippable frame.

The writer gives each page a record; a payload that several pages share is stored once, by the
page of largest id, and the others are revisits of it. The reader loads the dictionary, decodes
frame by frame in bounded memory, and checks version, headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import Work, partitions

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES = 16 << 20       # payload after which a new archive begins
SAMPLE_BYTES = 1 << 20         # payload heads the dictionary is trained on
DICTIONARY_BYTES = 16 << 10
CHUNK = 1 << 16

MANIFEST = "archive string, records bigint"
RECORDS = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
           "refers_to bigint")


class BadArchive(ValueError):
    """An archive that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, record_type: str,
           refers_to: int | None, date: str) -> bytes:
    """One WARC record. A revisit keeps the payload's digest and length, not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" \
           b"\r\n\r\n" % len(payload)
    block = http + payload if record_type == "response" else http
    headers = [("WARC-Type", record_type), ("WARC-Record-ID", _name(page_id)),
               ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", "".join(
            c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)))
    if record_type == "revisit":
        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", _name(refers_to))]
    headers += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
                ("WARC-Block-Digest", f"sha1:{digest(block)}"),
                ("Content-Type", "application/http; msgtype=response"),
                ("Content-Length", str(len(block)))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return VERSION + b"\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block \
        + b"\r\n\r\n"


def trained(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary for records like these; None if there are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return None


def archive(records: list[bytes]) -> Iterator[bytes]:
    """The bytes of an archive, piece by piece."""
    samples, size = [], 0
    for one in records:
        samples.append(one[:8192])
        size += len(samples[-1])
        if size >= SAMPLE_BYTES:
            break
    words = trained(samples)
    if words is not None:
        raw = words.as_bytes()
        yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
    compressor = zstandard.ZstdCompressor(level=3, dict_data=words, write_checksum=True)
    for one in records:
        yield compressor.compress(one)


def _exactly(stream, n: int) -> bytes:
    parts = []
    while n:
        part = stream.read(n)
        if not part:
            raise BadArchive("the archive ends inside a frame")
        parts.append(part)
        n -= len(part)
    return b"".join(parts)


def frames(stream) -> Iterator[bytes]:
    """Decode an archive frame by frame from anything with read(n); holds one record at a time.

    A leading skippable frame holds the dictionary, plain or compressed; none is fine.
    """
    head = stream.read(4)
    words = None
    if len(head) == 4 and struct.unpack("<I", head)[0] == DICTIONARY_MAGIC:
        raw = _exactly(stream, struct.unpack("<I", _exactly(stream, 4))[0])
        if raw.startswith(FRAME_MAGIC):
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        words = zstandard.ZstdCompressionDict(raw)
        head = b""
    decompressor = zstandard.ZstdDecompressor(dict_data=words)
    rest = head
    while True:
        rest = rest or stream.read(CHUNK)
        if not rest:
            return
        one, parts = decompressor.decompressobj(), []
        while not one.eof:
            try:
                parts.append(one.decompress(rest))
            except zstandard.ZstdError as error:
                raise BadArchive(f"broken frame: {error}") from error
            if not one.eof:
                rest = stream.read(CHUNK)
                if not rest:
                    raise BadArchive("the archive ends inside a frame")
        rest = one.unused_data
        yield b"".join(parts)


def parsed(raw: bytes) -> dict:
    """Check one record and return its fields. `payload` is None for a revisit."""
    head, gap, body = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise BadArchive(f"not a {VERSION.decode()} record")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "surrogatepass").partition(": ")
        if not colon or name in headers:
            raise BadArchive(f"bad header line {line[:80]!r}")
        headers[name] = value
    for name in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Payload-Digest",
                 "WARC-Block-Digest", "Content-Length"):
        if name not in headers:
            raise BadArchive(f"{name} is missing")
    length = headers["Content-Length"]
    if not length.isdigit() or len(body) != int(length) + 4 or body[-4:] != b"\r\n\r\n":
        raise BadArchive("the block's length is not its Content-Length")
    block = body[:-4]
    if headers["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise BadArchive("the block does not have its digest")
    http, gap, payload = block.partition(b"\r\n\r\n")
    sizes = [line.partition(b": ")[2] for line in http.split(b"\r\n")
             if line.startswith(b"Content-Length: ")]
    if not gap or len(sizes) != 1 or not sizes[0].isdigit():
        raise BadArchive("the block is not an HTTP response with a length")
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit"):
        raise BadArchive(f"unknown record type {kind}")
    if kind == "revisit" and (payload or "WARC-Refers-To" not in headers):
        raise BadArchive("a revisit has no payload and names another record")
    if kind == "response" and (
            len(payload) != int(sizes[0])
            or headers["WARC-Payload-Digest"] != f"sha1:{digest(payload)}"):
        raise BadArchive("the payload does not have its length and digest")

    def page(name: str) -> int | None:
        number = name.removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    return {"page_id": page(headers["WARC-Record-ID"]), "url": headers.get("WARC-Target-URI"),
            "payload_bytes": int(sizes[0]),
            "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"),
            "record_type": kind,
            "refers_to": page(headers["WARC-Refers-To"]) if kind == "revisit" else None,
            "payload": payload if kind == "response" else None}


def _writer(folder: str, date: str):
    def run(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        task = TaskContext.get()
        # Another attempt of the same task writes other files; the manifest names one attempt's.
        stem = f"{base}/pages-{task.partitionId():05d}-{task.taskAttemptId()}"
        held, size, number = [], 0, 0

        def flush():
            path = f"{stem}-{number:05d}.warc.zst"
            with system.open_output_stream(path, compression=None) as out:
                for part in archive(held):
                    out.write(part)
            return pa.RecordBatch.from_arrays(
                [pa.array([path.removeprefix(f"{base}/")]), pa.array([len(held)], pa.int64())],
                names=["archive", "records"])

        for batch in batches:
            for row in batch.to_pylist():
                payload = (row["html"] or "").encode("utf-8", "surrogatepass")
                held.append(record(row["page_id"], row["url"], payload, row["record_type"],
                                   row["refers_to"], date))
                size += len(payload)
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()
    return run


def _reader(folder: str):
    def run(batches):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for name, expected in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with system.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    rows = [tuple(parsed(raw)[n] for n in names) for raw in frames(stream)]
                if len(rows) != expected:
                    raise BadArchive(f"{name} holds {len(rows)} records, not {expected}")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in
                     zip(zip(*rows, strict=True), types, strict=True)], names=names)
    return run


def classified(pages: DataFrame, work: Work, *, least_bytes: int = 0) -> DataFrame:
    """Pages with `record_type` and `refers_to`: of equal payloads of at least `least_bytes`
    bytes the largest id is the response, rows of smaller ids revisit it."""
    rows = pages.withColumn("sha1", F.sha1(F.coalesce("html", F.lit("")).cast("binary"))) \
        .withColumn("bytes", F.octet_length(F.coalesce("html", F.lit(""))))
    shared = work.stored(
        rows.where(F.col("bytes") >= least_bytes).groupBy("sha1", "bytes")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1 and keeper is not null").drop("n"), "shared")
    again = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return (rows.join(shared, ["sha1", "bytes"], "left")
            .select("page_id", "url", "html",
                    F.when(again, "revisit").otherwise("response").alias("record_type"),
                    F.when(again, F.col("keeper")).alias("refers_to")))


def archived(pages: DataFrame, work: Work, *, least_bytes: int = 0,
             date: str = "1970-01-01T00:00:00Z") -> tuple[str, DataFrame]:
    """Write archives and return their folder and manifest (`archive`, `records`).

    Only archives in the manifest count: it is committed by Spark, so that files of a task that
    was lost or run twice stay unread. A page with a null url has no target header; control
    characters in urls are percent-encoded; a null html is an empty payload.
    """
    folder = work.path("archives")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    written = classified(rows, work, least_bytes=least_bytes).mapInArrow(
        _writer(folder, date), MANIFEST)
    return folder, work.stored(written, "manifest")


def records(folder: str, manifest: DataFrame) -> DataFrame:
    """Read archives back: one row per record. A broken archive fails the job, naming the fault."""
    spread = manifest.repartition(partitions(manifest.sparkSession))
    return spread.mapInArrow(_reader(folder), RECORDS)


def round_trip(pages: DataFrame, *, least_bytes: int = 0) -> DataFrame:
    """Write one record per page, then read all archives: `page_id`, `payload_bytes`,
    `payload_digest`, `record_type`, `refers_to`.

    Rows that repeat an id are records each; those that repeat the keeper's id and payload are
    responses like it. A row without an id revisits a keeper that has one, else it is a response.
    Extra columns are ignored. An empty table gives no archive and no rows.
    """
    work = Work(pages.sparkSession, "warc")
    return records(*archived(pages, work, least_bytes=least_bytes))
