"""Operator 5: WARC archives as a chunked record table.

Writing: each task writes gzip archives, one member a record, to a shared folder through Arrow's
file systems, and returns a manifest row for each archive.  Only archives in the manifest count,
so what a lost or repeated task leaves behind is never read.  Reading: each archive is streamed
and comes out as rows of (record, chunk number), ``CHUNK`` bytes at most, each with the SHA-1 of
the record so far.  Neither side ever holds a second copy of a payload.

Records with equal payloads of at least ``LEAST`` bytes are written once, as the response of the largest page_id;
the others are revisits that refer to it.

Edge cases.  A null payload is empty.  A null url has no target header; a null page_id comes before
all others, and its record refers to none if the whole group has none.  Repeated rows of the
page_id that a group's response has are responses too.  Line breaks in a url are percent-encoded.
An empty table makes no archive and an empty record table.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, fresh_path, shuffle_parts, written

LEAST = 1000
CHUNK = 1 << 16
#: An archive is closed beyond so many bytes, so that reading spreads.
ARCHIVE_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"  # records carry no time of their own; a fixed one makes reruns equal

RECORDS = ("archive string, page_id bigint, record_id string, record_type string, refers_to bigint, payload_bytes bigint, "
           "payload_digest string, chunk bigint, last boolean, n_bytes bigint, sha1 string, data binary")


def with_types(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, bytes, sha1, refers_to): refers_to is null for a response."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"),
                        F.octet_length(payload).cast("bigint").alias("bytes"), F.sha1(payload.cast("binary")).alias("sha1"))
    again = rows.where(F.col("bytes") >= least).groupBy("sha1", "bytes").agg(
        F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(again, ["sha1", "bytes"], "left").select("page_id", "url", "payload", "bytes", "sha1", refers.alias("refers_to"))


def _header(page_id, url, size: int, sha1: str, refers_to) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    block = size if refers_to is None else 0
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode())
    lines.append(f"X-Payload-Length: {size}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:x-page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {block}", "", ""]
    return "\r\n".join(lines).encode()


def _file_system(uri: str):
    """An Arrow file system and a path in it, for a URI or a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write records (as of ``with_types``) and give the manifest (archive, records, bytes)."""
    def run(batches):
        import uuid

        system, root = _file_system(folder)
        system.create_dir(root, recursive=True)
        out, name, count, done = None, "", 0, []
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, length, sha1, refers_to = (c[i] for c in batch.columns)
                if out is None:
                    name, count = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                refers_to = refers_to.as_py()
                parts = [_header(page_id.as_py(), url.as_py(), length.as_py(), sha1.as_py(), refers_to)]
                if refers_to is None:
                    body = memoryview(payload.as_buffer())  # no copy
                    parts += [body[at:at + CHUNK] for at in range(0, len(body), CHUNK)]
                parts.append(b"\r\n\r\n")
                for part in parts:
                    out.write(packer.compress(part))
                out.write(packer.flush())
                count += 1
                if out.tell() >= ARCHIVE_BYTES:
                    done.append((name, count, out.tell()))
                    out.close()
                    out = None
        if out is not None:
            done.append((name, count, out.tell()))
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{d[0]}" for d in done], pa.string()),
                                          pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
                                         names=["archive", "records", "bytes"])

    rows = bounded(records).select("page_id", "url", F.col("payload").cast("binary"), "bytes", "sha1", "refers_to")
    return written(rows.mapInArrow(run, "archive string, records bigint, bytes bigint"), "manifest")


def _pieces(stream):
    """Decompressed pieces of an archive of gzip members, ``CHUNK`` bytes at most."""
    unpacker, held, full = zlib.decompressobj(31), b"", False
    while True:
        if not held and not full:
            held = stream.read(CHUNK)
            if not held:
                return
        piece = unpacker.decompress(held, CHUNK)
        held, full = unpacker.unconsumed_tail, len(piece) == CHUNK  # a full piece may leave more inside
        if unpacker.eof:
            held, unpacker, full = unpacker.unused_data, zlib.decompressobj(31), False
        if piece:
            yield piece


def read_records(stream):
    """(headers, chunk number, data, last) of an archive's records, in order."""
    source, held = _pieces(stream), b""

    def more() -> bool:
        nonlocal held
        piece = next(source, None)
        held += piece or b""
        return piece is not None

    while True:
        while b"\r\n\r\n" not in held:
            if not more():
                if held.strip():
                    raise ValueError("an archive ends within a header")
                return
        head, _, held = held.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record where one should begin")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        left, chunk = int(headers["content-length"]), 0
        while True:
            while len(held) < min(left, CHUNK):
                if not more():
                    raise ValueError("an archive ends within a payload")
            size = min(left, CHUNK)
            data, held, left = held[:size], held[size:], left - size
            yield headers, chunk, data, not left
            chunk += 1
            if not left:
                break
        while len(held) < 4 and more():
            pass
        if held[:4] != b"\r\n\r\n":
            raise ValueError("no record end where one should be")
        held = held[4:]


def _number(uri: str | None) -> int | None:
    digits = (uri or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(digits) if digits else None


def record_table(archives: DataFrame, with_data: bool = True) -> DataFrame:
    """Chunk rows (``RECORDS``) of the manifest's archives; ``data`` is null unless asked for."""
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(),
             pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches):
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                system, path = _file_system(archive)
                rows, sha1 = [], None
                with system.open_input_stream(path, compression=None) as stream:
                    for h, chunk, data, last in read_records(stream):
                        if not chunk:
                            sha1 = hashlib.sha1()
                        sha1.update(data)
                        digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if last and h["warc-type"] == "response" and sha1.hexdigest() != digest:
                            raise ValueError(f"{archive}: {h['warc-record-id']} isn't what was written")
                        rows.append((archive, _number(h["warc-record-id"]), h["warc-record-id"], h["warc-type"],
                                     _number(h.get("warc-refers-to")), int(h["x-payload-length"]), digest, chunk, last,
                                     len(data), sha1.hexdigest(), data if with_data else None))
                        if len(rows) >= 64 and with_data or len(rows) >= 4096:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    spark = archives.sparkSession
    return archives.select("archive").repartition(4 * shuffle_parts(spark), "archive").mapInArrow(run, RECORDS)


def payloads(records: DataFrame) -> DataFrame:
    """(page_id, payload) of response records put together from their chunks, for payloads that fit in a cell."""
    return records.where("record_type = 'response'").groupBy("archive", "record_id", "page_id").agg(
        F.array_sort(F.collect_list(F.struct("chunk", "data"))).alias("c")).select(
        "page_id", F.decode(F.expr("aggregate(c.data, X'', (a, x) -> concat(a, x))"), "UTF-8").alias("payload"))


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages as archives, read them back, and give a row per record: (page_id, payload_bytes,
    payload_digest, record_type, refers_to)."""
    manifest = write_archives(with_types(pages), folder or fresh_path(pages.sparkSession, "warc"))
    return record_table(manifest, with_data=False).where("last").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
