"""WARC archives of pages, with revisits resolved.

Pages are written as archives of response records, one gzip member per record and one file per
task. Their headers are read back and shuffled by payload digest; of equal payloads one stays a
response and the others become revisits of it. New archives with fresh headers are then written
file by file, a response with its payload and a revisit without it.

Files are opened through ``pyarrow.fs`` by the URI of the shared folder. A task's file is counted
only if its manifest row comes back, so files of lost or repeated attempts are left unread.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import settle, shared_folder

DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LEVEL = 4
_CHUNK = 1 << 16
_MANIFEST = "path string, records long"
_HEADERS = (
    "path string, offset long, record_id string, record_type string, page_id long, uri string, "
    "digest string, payload_bytes long, refers_to_id string"
)


def payload_digest(payload: bytes) -> str:
    """Base 32 of the SHA-1, as archives name payloads."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_id(*parts) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '/'.join(map(str, parts)))}"


def record(headers: dict[str, str | None], block: bytes) -> bytes:
    """One record as a gzip member; headers without a value are left out."""
    lines = [f"{k}: {_clean(v)}" for k, v in headers.items() if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    parts = (head.encode("utf-8", "replace"), b"\r\n\r\n", block, b"\r\n\r\n")
    return b"".join([*map(packer.compress, parts), packer.flush()])


def _clean(value: str) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value)


def http_head(length: int) -> bytes:
    return (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}"
        "\r\n\r\n"
    ).encode("ascii")


def records(stream) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of an archive, one in memory at a time."""
    rest, at = b"", 0
    while True:
        member, parts, used = zlib.decompressobj(31), [], 0
        while not member.eof:
            data = rest or stream.read(_CHUNK)
            rest = b""
            if not data:
                if used:
                    raise ValueError(f"archive ends inside the record at {at}")
                return
            parts.append(member.decompress(data))
            rest = member.unused_data
            used += len(data) - len(rest)
        raw = b"".join(parts)
        head, _, after = raw.partition(b"\r\n\r\n")
        pairs = [x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:]]
        headers = {k: v for k, v in pairs}
        yield at, headers, after[: int(headers["Content-Length"])]
        at += used


def _writer(folder: str):
    """(filesystem, path, stream) of a new file of this task's attempt."""
    from pyspark import TaskContext

    task = TaskContext.get()
    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
    return f"{folder}/{name}", system.open_output_stream(f"{base}/{name}", compression=None)


def _open(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_stream(path, compression=None)


def write_responses(pages: DataFrame, folder: str) -> DataFrame:
    """Write a response record per page into ``folder``; the manifest (path, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, stream, count = None, None, 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html")]
            for row in zip(*columns, strict=True):
                page_id, url, page = (x.as_py() for x in row)
                if stream is None:
                    path, stream = _writer(folder)
                payload = (page or "").encode("utf-8", "surrogatepass")
                headers = {
                    "WARC-Type": "response",
                    "WARC-Record-ID": f"<{record_id(path, count)}>",
                    "WARC-Date": DATE,
                    "WARC-Target-URI": url,
                    "WARC-Page-ID": None if page_id is None else str(page_id),
                    "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
                    "Content-Type": "application/http; msgtype=response",
                }
                stream.write(record(headers, http_head(len(payload)) + payload))
                count += 1
        if stream is not None:
            stream.close()
            yield _manifest(path, count)

    return pages.select("page_id", "url", "html").mapInArrow(run, _MANIFEST)


def _manifest(path: str, count: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path]), pa.array([count], pa.int64())], names=["path", "records"]
    )


def read_headers(manifest: DataFrame) -> DataFrame:
    """The header of every record of the archives in ``manifest``, with its place.

    ``payload_bytes`` is what the record's HTTP head states; a response whose payload does not
    have this length or its digest raises an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with _open(path) as stream:
                    for offset, headers, block in records(stream):
                        rows.append(_header_row(path, offset, headers, block))
                        if len(rows) == 5000:
                            yield _header_batch(rows)
                            rows = []
                if rows:
                    yield _header_batch(rows)

    # By range, so that every archive is a task of its own; a stated count is never folded.
    return (
        manifest.select("path")
        .repartitionByRange(max(1, manifest.count()), "path")
        .mapInArrow(run, _HEADERS)
    )


def _header_row(path, offset, headers, block):
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(head.rpartition(b": ")[2])
    if headers["WARC-Type"] == "response":
        if len(payload) != length or payload_digest(payload) != digest:
            raise ValueError(f"damaged record at {offset} of {path}")
    page = headers.get("WARC-Page-ID")
    refers = headers.get("WARC-Refers-To")
    return (
        path,
        offset,
        headers["WARC-Record-ID"].strip("<>"),
        headers["WARC-Type"],
        None if page is None else int(page),
        headers.get("WARC-Target-URI"),
        digest,
        length,
        refers and refers.strip("<>"),
    )


def _header_batch(rows) -> pa.RecordBatch:
    names = [c.split()[0] for c in _HEADERS.split(", ")]
    kinds = [pa.int64() if c.endswith("long") else pa.string() for c in _HEADERS.split(", ")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def resolve(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add ``original_path`` and ``original_offset`` to records that revisit another.

    Of records with one digest and at least ``least_bytes`` of payload, that with the largest
    ``page_id`` (null ones last, then the later place) stays a response. Only headers are
    shuffled, and only digests that occur again are joined.
    """
    place = F.struct("page_id", "path", "offset", "uri")
    again = (
        headers.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max(place).alias("original"))
        .where("n > 1")
        .select("digest", "original")
    )
    revisits = (F.col("payload_bytes") >= least_bytes) & ~(
        (F.col("original.path") == F.col("path")) & (F.col("original.offset") == F.col("offset"))
    )
    joined = headers.join(again, "digest", "left")
    other = F.when(revisits, F.col("original"))
    return joined.select(
        *headers.columns,
        other["path"].alias("original_path"),
        other["offset"].alias("original_offset"),
        other["uri"].alias("original_uri"),
    )


def write_deduplicated(resolved: DataFrame, folder: str, archives: int) -> DataFrame:
    """Write the archives anew with fresh headers; the manifest of the new files.

    An old archive is read once, in order, by the task that holds its records' decisions. There
    are as many tasks as ``archives``, which adaptive execution does not fold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, count = None, None, 0
        current, old = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, out = _writer(folder)
                if row["path"] != current:
                    if old is not None:
                        old.close()
                    current, old = row["path"], _open(row["path"])
                    reading = records(old)
                offset, _, block = next(x for x in reading if x[0] == row["offset"])
                out.write(_fresh(row, block))
                count += 1
        if old is not None:
            old.close()
        if out is not None:
            out.close()
            yield _manifest(path, count)

    columns = [
        "path", "offset", "page_id", "uri", "digest", "payload_bytes", "original_path",
        "original_offset", "original_uri",
    ]
    return (
        resolved.select(*columns)
        .repartition(max(1, archives), "path")
        .sortWithinPartitions("path", "offset")
        .mapInArrow(run, _MANIFEST)
    )


def _fresh(row: dict, block: bytes) -> bytes:
    revisit = row["original_path"] is not None
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{record_id('fresh', row['path'], row['offset'])}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": row["uri"],
        "WARC-Page-ID": None if row["page_id"] is None else str(row["page_id"]),
        "WARC-Payload-Digest": f"sha1:{row['digest']}",
        "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        original = record_id("fresh", row["original_path"], row["original_offset"])
        headers |= {
            "WARC-Profile": PROFILE,
            "WARC-Refers-To": f"<{original}>",
            "WARC-Refers-To-Target-URI": row["original_uri"],
            "WARC-Refers-To-Date": DATE,
            "WARC-Truncated": "length",
        }
        block = http_head(row["payload_bytes"])
    return record(headers, block)


def deduplicated_archives(
    pages: DataFrame, folder: str | None = None, *, least_bytes: int = 0
) -> DataFrame:
    """Archive pages, resolve revisits, write deduplicated archives and read them back.

    Input: ``page_id``, ``url``, ``html`` and any other columns. Archives go below ``folder`` (a
    URI; a new one in the shared folder if not given). Result: a row per page with ``page_id``,
    ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` (the response's
    ``page_id``), ``record_id``, ``refers_to_id``, ``path`` and ``offset``, all as read from the
    new archives.

    A null or empty ``html`` is an empty payload. A null ``url`` or ``page_id`` has no header. Of
    equal rows one is the response. An empty table writes no archive and gives no rows.
    """
    folder = (folder or shared_folder(pages.sparkSession, "warc")).rstrip("/")
    first = settle(write_responses(pages, f"{folder}/responses"))
    headers = settle(read_headers(first))
    resolved = resolve(headers, least_bytes)
    second = settle(write_deduplicated(resolved, f"{folder}/deduplicated", first.count()))
    read = settle(read_headers(second))
    # Only responses that are referred to are joined.
    wanted = read.where("refers_to_id IS NOT NULL").select(F.col("refers_to_id").alias("record_id"))
    responses = (
        read.where("record_type = 'response'")
        .join(wanted.distinct(), "record_id", "left_semi")
        .select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    )
    return read.join(responses, "refers_to_id", "left").select(
        "page_id",
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        "record_id",
        "refers_to_id",
        "path",
        "offset",
    )
