"""WARC archives: one gzip member per page, equal payloads stored once, read back in byte ranges.

**Writing.** Among records with equal payloads of at least ``least`` bytes the one with the largest
page_id is a ``response``; the others are ``revisit`` records that name it and carry no payload.
Each task writes archives under names of its own and reports them in a manifest that Spark commits,
so a task that is run twice leaves an unlisted file behind, never a doubled record.

**Reading.** A task gets byte ranges of archives. It looks for the gzip magic, decodes each candidate
member until its WARC header stands (else the candidate is dismissed), and owns the members that
start inside its range; the last one is read past the range's end. Between two members nothing is
scanned. A candidate counts as a member only if it decodes to its end with a right checksum; its WARC
header may be of any length. The records read are stored, and counted against the manifest: an archive
that gives another number than its row says is an error.

Defined results: a null html is an empty payload; a null url has no target header; rows that repeat
a page_id each give a record, and all rows with the largest id of a payload are responses; null
page_ids rank below all others; an empty table gives no archive and no rows. File access goes
through ``pyarrow.fs``, so the folder may be on any storage that it knows (a mounted folder, HDFS,
an object store).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewarden.llm.batches import small_batches
from lanewarden.session import materialize, scratch_path

RANGE_BYTES = 8 << 20
ARCHIVE_BYTES = 1 << 30
MAGIC = b"\x1f\x8b\x08"
_STEP = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
)


def plan_records(pages: DataFrame, least: int = 0) -> DataFrame:
    """Each page with ``refers_to``: the page_id of the response it repeats, null for a response."""
    body = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", body.alias("html"), F.sha1(body).alias("_sha1"))
    large = keyed.where(F.octet_length("html") >= least)
    kept = large.groupBy("_sha1").agg(F.max("page_id").alias("_kept"), F.count(F.lit(1)).alias("_n"))
    kept = kept.where("_n > 1 and _kept is not null").select("_sha1", "_kept")
    repeats = F.col("_kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_kept"))
    return keyed.join(kept, "_sha1", "left").select(
        "page_id", "url", "html", F.when(repeats, F.col("_kept")).alias("refers_to")
    )


def _header(value: str) -> str:
    """A header value without control characters or blanks (percent-encoded)."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in value)


def record_member(page_id: int | None, url: str | None, body: bytes, refers_to: int | None, date: str) -> bytes:
    """The gzip member of one record."""
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + body
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)


def write_archives(
    records: DataFrame, folder: str, *, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write ``page_id, url, html, refers_to`` rows as ``*.warc.gz`` in ``folder``.

    Returns the stored manifest ``path, bytes, records``; only files that it lists count.
    """
    small_batches(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        out, name, size, count, done = None, "", 0, 0, []
        for batch in batches:
            for page_id, url, html, refers in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if out is None:
                    store.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, size, count = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                member = record_member(page_id, url, html.encode(), refers, date)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= archive_bytes:
                    out.close()
                    out = done.append((f"{folder}/{name}", size, count))
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size, count))
        columns = list(zip(*done)) or [[], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "bytes", "records"])

    planned = records.select("page_id", "url", "html", "refers_to")
    return materialize(planned.mapInArrow(run, "path string, bytes long, records long"), "archives")


class _Bytes:
    """Bytes of a file from ``start`` on, read on in steps as they are asked for."""

    def __init__(self, file: pa.NativeFile, start: int, size: int):
        self.file, self.start, self.data = file, start, bytearray(file.read_at(size, start))
        self.ended = len(self.data) < size

    def more(self) -> bool:
        got = b"" if self.ended else self.file.read_at(_STEP, self.start + len(self.data))
        self.data += got
        self.ended = len(got) < _STEP
        return bool(got)


def _member(source: _Bytes, at: int) -> tuple[bytes, int] | None:
    """The decoded WARC record of the member at ``at`` and where it ends; None if there is none."""
    decoder, record, known = zlib.decompressobj(31), bytearray(), False
    while not decoder.eof:
        if at >= len(source.data) and not source.more():
            return None
        piece = bytes(memoryview(source.data)[at : at + _STEP])
        looked = max(0, len(record) - 3)
        try:
            record += decoder.decompress(piece)
        except zlib.error:
            return None
        at += len(piece)
        if not known:
            if not record.startswith(b"WARC/1."[: len(record)]):
                return None
            known = record.find(b"\r\n\r\n", looked) >= 0
    return (bytes(record), at - len(decoder.unused_data)) if known else None


def scan_range(file: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    """The decoded records that start in ``[start, end)``."""
    source = _Bytes(file, start, end - start + len(MAGIC) - 1)
    at = 0
    while (at := source.data.find(MAGIC, at)) >= 0 and at < end - start:
        found = _member(source, at)
        if found is None:
            at += 1
        else:
            yield found[0]
            at = found[1]


def _fields(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    lines = (line.partition(": ") for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value for name, _, value in lines}, rest


def _page(urn: str | None) -> int | None:
    value = (urn or "null").removeprefix("<urn:page:").removesuffix(">")
    return None if value == "null" else int(value)


def parse_record(record: bytes, with_payload: bool) -> tuple:
    """A row of :data:`RECORD`; a response's digest and length are taken from its payload anew."""
    fields, rest = _fields(record)
    http, payload = _fields(rest[: int(fields["content-length"])])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    size, refers = int(http["content-length"]), _page(fields.get("warc-refers-to"))
    if fields["warc-type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (found, len(payload)) != (digest, size):
            raise ValueError(f"damaged record {fields['warc-record-id']}")
    row = (_page(fields["warc-record-id"]), fields.get("warc-target-uri"), fields["warc-type"], size, digest, refers)
    return (*row, payload if fields["warc-type"] == "response" else None) if with_payload else row


def read_archives(
    spark: SparkSession, manifest: DataFrame, *, range_bytes: int = RANGE_BYTES, with_payload: bool = False
) -> DataFrame:
    """The stored records of the manifest's archives; ``payload`` (null for revisits) on request."""
    total = manifest.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long")))
    ranges = manifest.where("bytes > 0").select("path", start.alias("start"), "bytes")
    ranges = ranges.repartition(int(total), "path", "start")
    schema = "_path string, " + RECORD + (", payload binary" if with_payload else "")
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, low, size in zip(*(batch.column(c).to_pylist() for c in range(3))):
                store, name = _open(path)
                rows, held = [], 0
                with store.open_input_file(name) as file:
                    for record in scan_range(file, low, min(low + range_bytes, size)):
                        rows.append((path, *parse_record(record, with_payload)))
                        held += len(record) if with_payload else 100 + len(rows[-1][2] or "")
                        if held > 8 * _STEP:
                            yield _rows(rows, kinds, names)
                            rows, held = [], 0
                yield _rows(rows, kinds, names)

    found = materialize(ranges.mapInArrow(run, schema), "records")
    counts = found.groupBy(F.col("_path").alias("path")).agg(F.count(F.lit(1)).alias("_found"))
    read = F.coalesce(F.col("_found"), F.lit(0).cast("long"))
    wrong = manifest.join(counts, "path", "left").where(read != F.col("records")).select("path", "records", read.alias("found")).take(3)
    if wrong:
        told = ", ".join(f"{r['path']} gave {r['found']} of {r['records']} records" for r in wrong)
        raise ValueError(f"incomplete archives: {told}")
    return found.drop("_path")


def _rows(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def round_trip(pages: DataFrame, *, least: int = 0, folder: str | None = None) -> DataFrame:
    """Write the pages as archives in ``folder`` (scratch by default) and read them back."""
    spark = pages.sparkSession
    manifest = write_archives(plan_records(pages, least), folder or scratch_path(spark, "warc"))
    return read_archives(spark, manifest)
