"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with whole WARC records, and
ends in a seek table (a skippable frame with the sizes of all frames), so a reader can
decompress one frame without those before it. The index maps a record identifier to
bundle, frame and offset inside the frame.

Rules for odd input: a NULL payload is empty; NULL in the URL leaves the header out;
records with a NULL identifier are written and read back with NULL; rows that repeat
the smallest identifier of equal payloads are all ``response``; if every identifier of
equal payloads is NULL, all are ``response``. An empty table gives no bundle.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The seekable format of Zstandard and the fields of WARC 1.1.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_URN = "urn:page:"
DATE = "2024-01-01T00:00:00Z"
#: Payloads below this many bytes are never replaced by a revisit record.
LEAST_REVISIT_BYTES = 100
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 26

RECORDS = "record_id long, target_uri string, payload binary, payload_digest string, refers_to long"
INDEX = (
    "record_id long, record_type string, bundle string, frame int, frame_offset long, "
    "frame_bytes long, record_offset long, record_bytes long"
)
READ_BACK = (
    "record_id long, target_uri string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to long, payload binary"
)


def plan_records(
    pages: DataFrame,
    id_column: str,
    uri_column: str,
    payload_column: str,
    least_bytes: int = LEAST_REVISIT_BYTES,
) -> DataFrame:
    """Payload, digest and, for repeated payloads, the record that holds them.

    The smallest identifier of each repeated payload comes from a partially aggregated
    count; the join back is on the digest, where the adaptive skew join splits a
    payload that fills a large part of the rows.
    """
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    records = pages.select(
        F.col(id_column).cast("long").alias("record_id"),
        F.col(uri_column).cast("string").alias("target_uri"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    repeated = (
        records.where(F.octet_length("payload") >= least_bytes)
        .groupBy(F.col("payload_digest").alias("repeated_digest"))
        .agg(F.min("record_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("repeated_digest", "first_id")
    )
    joined = records.join(repeated, F.col("payload_digest") == F.col("repeated_digest"), "left")
    is_revisit = F.col("first_id").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("first_id"))
    refers_to = F.when(is_revisit, F.col("first_id"))
    return joined.select(
        "record_id", "target_uri", "payload", "payload_digest", refers_to.alias("refers_to")
    )


def _id_text(value) -> str:
    return "null" if value is None or pd.isna(value) else str(int(value))


def _record(record_id, target_uri, payload: bytes, digest: str, refers_to) -> tuple[str, bytes]:
    """Kind and bytes of one record; a revisit keeps the HTTP head and drops the body."""
    kind = "response" if refers_to is None or pd.isna(refers_to) else "revisit"
    block = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{RECORD_URN}{_id_text(record_id)}>")]
    fields.append(("WARC-Date", DATE))
    if target_uri is not None:
        uri = target_uri.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
        fields.append(("WARC-Target-URI", uri))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if kind == "revisit":
        fields.append(("WARC-Refers-To", f"<{RECORD_URN}{_id_text(refers_to)}>"))
        fields.append(("WARC-Profile", REVISIT_PROFILE))
    else:
        block += payload
    fields.append(("Content-Type", "application/http;msgtype=response"))
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return kind, head.encode() + block + b"\r\n\r\n"


class BundleWriter:
    """One bundle: frames as they fill, the seek table at the end."""

    def __init__(self, folder: str, frame_bytes: int, level: int):
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        # a retried task takes another name; what an index does not list is never read
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.stream = system.open_output_stream(f"{base}/{self.name}", compression=None)
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.frame_bytes = frame_bytes
        self.sizes: list[tuple[int, int]] = []
        self.offset = self.raw = self.pending = 0
        self.records: list[tuple] = []
        self.parts: list[bytes] = []
        self.entries: list[tuple] = []

    def add(self, record_id, kind: str, record: bytes) -> None:
        self.records.append((record_id, kind, self.pending, len(record)))
        self.parts.append(record)
        self.pending += len(record)
        self.raw += len(record)
        if self.pending >= self.frame_bytes:
            self.end_frame()

    def end_frame(self) -> None:
        if not self.parts:
            return
        frame = self.compressor.compress(b"".join(self.parts))
        self.stream.write(frame)
        for record_id, kind, start, length in self.records:
            place = (len(self.sizes), self.offset, len(frame), start, length)
            self.entries.append((record_id, kind, self.name, *place))
        self.sizes.append((len(frame), self.pending))
        self.offset += len(frame)
        self.pending, self.records, self.parts = 0, [], []

    def close(self) -> list[tuple]:
        self.end_frame()
        table = b"".join(struct.pack("<II", *size) for size in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)))
        self.stream.write(table + footer)
        self.stream.close()
        return self.entries


def _index_frame(entries: list[tuple]) -> pd.DataFrame:
    names = [part.split()[0] for part in INDEX.split(", ")]
    frame = pd.DataFrame(entries, columns=names)
    return frame.astype({"record_id": "Int64"})


def write_bundles(
    records: DataFrame,
    folder: str,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    level: int = 3,
) -> DataFrame:
    """Write ``plan_records`` rows to bundles in ``folder``; return the index.

    Evaluate the index once (write it, or stage it): each evaluation writes bundles.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer = None
        for batch in batches:
            columns = (batch[c] for c in ("record_id", "target_uri", "payload"))
            rest = (batch[c] for c in ("payload_digest", "refers_to"))
            for record_id, uri, payload, digest, refers_to in zip(*columns, *rest, strict=True):
                writer = writer or BundleWriter(folder, frame_bytes, level)
                kind, record = _record(record_id, uri, payload, digest, refers_to)
                writer.add(None if pd.isna(record_id) else int(record_id), kind, record)
                if writer.raw >= bundle_bytes:
                    yield _index_frame(writer.close())
                    writer = None
        if writer:
            yield _index_frame(writer.close())

    return records.mapInPandas(write, INDEX)


def seek_table(stream) -> list[tuple[int, int]]:
    """(compressed bytes, raw bytes) of every frame, from the end of a bundle."""
    size = stream.size()
    stream.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", stream.read(9))
    if magic != SEEKABLE_MAGIC or flags & 0x7F:
        raise ValueError("the bundle has no seek table")
    width = 12 if flags & 0x80 else 8
    stream.seek(size - 9 - count * width)
    raw = stream.read(count * width)
    return [struct.unpack_from("<II", raw, i * width) for i in range(count)]


def _from_urn(text: str | None) -> int | None:
    value = text[len(RECORD_URN) + 1 : -1] if text else "null"
    return None if value == "null" else int(value)


def parse_record(data: bytes, start: int) -> tuple[dict[str, str], bytes, int]:
    """Fields and block of the record at ``start``, and where the next one begins."""
    head_end = data.index(b"\r\n\r\n", start)
    lines = data[start:head_end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    begin = head_end + 4
    end = begin + int(fields["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    return fields, data[begin:end], end + 4


def read_record(fields: dict[str, str], block: bytes) -> tuple:
    """Row of ``READ_BACK``; the digest of a stored payload is checked."""
    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    length = int(http["Content-Length"])
    if kind == "response":
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != length:
            raise ValueError(f"damaged payload: {fields['WARC-Record-ID']}")
    uri = fields.get("WARC-Target-URI")
    if uri is not None:
        uri = uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    refers_to = _from_urn(fields.get("WARC-Refers-To"))
    stored = payload if kind == "response" else None
    return (
        _from_urn(fields["WARC-Record-ID"]), uri, kind, digest, length, refers_to, stored
    )


def _read_frame(rows: list[tuple]) -> pd.DataFrame:
    names = [part.split()[0] for part in READ_BACK.split(", ")]
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"record_id": "Int64", "refers_to": "Int64"})


def read_bundles(bundles: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the bundles named in the column ``bundle``, frame by frame.

    ``payloads=False`` leaves the checked payloads out of the result.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = fs.FileSystem.from_uri(folder)
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for name in batch["bundle"]:
                with system.open_input_file(f"{base}/{name}") as stream:
                    sizes = seek_table(stream)
                    stream.seek(0)
                    for packed, _ in sizes:
                        data, at, rows = expand.decompress(stream.read(packed)), 0, []
                        while at < len(data):
                            fields, block, at = parse_record(data, at)
                            row = read_record(fields, block)
                            rows.append(row if payloads else (*row[:-1], None))
                        yield _read_frame(rows)

    return bundles.select("bundle").mapInPandas(read, READ_BACK)


def fetch_records(index: DataFrame, folder: str) -> DataFrame:
    """Only the records that ``index`` lists, each from its own frame."""

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = fs.FileSystem.from_uri(folder)
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for (name, offset, packed), part in batch.groupby(
                ["bundle", "frame_offset", "frame_bytes"]
            ):
                with system.open_input_file(f"{base}/{name}") as stream:
                    stream.seek(int(offset))
                    data = expand.decompress(stream.read(int(packed)))
                starts = (int(x) for x in part["record_offset"])
                yield _read_frame([read_record(*parse_record(data, x)[:2]) for x in starts])

    return index.mapInPandas(fetch, READ_BACK)
