"""WARC archives as seekable Zstandard bundles.

Each task writes its rows as WARC 1.1 records into one file of the shared folder.
Records are grouped into independent Zstandard frames of about ``FRAME_BYTES``
(a larger record has a frame of its own); the file ends with a seek table in a
skippable frame, as the seekable format defines it, so one record costs one seek
and the decompression of one frame. The index holds, for each record, the file,
the frame and the offset within the frame.

Of records with equal payloads of at least ``MIN_PAYLOAD`` bytes the one with the
smallest id is a response and the others revisit it: their block is empty, they
carry the payload's digest and length and the id they refer to.

Files are named by task attempt and become valid only through the index, which
Spark takes from successful attempts, so a lost executor or a repeated task
leaves at most an unread file.

Defined results: a null payload counts as empty; an empty table makes an empty
index; a repeated row is written as often as it occurs, and all rows that share
the smallest id of their group are responses; a null id is never referred to and
a row without id is a response if no id holds its payload, else a revisit; a null
url leaves out the target header.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.session import ensure_checkpoint_dir, work_path

FRAME_BYTES, MIN_PAYLOAD, LEVEL, RECORD_DATE = 256 * 1024, 100, 3, "1970-01-01T00:00:00Z"
BROADCAST_BYTES = 32 * 1024 * 1024
# Fixed values of the seekable format: skippable frame, its descriptor, footer magic.
SKIPPABLE_MAGIC, DESCRIPTOR, SEEKABLE_MAGIC = 0x184D2A5E, 0, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_SCHEMA = "page_id {0}, file string, frame int, offset long, length long"
RECORD_SCHEMA = (
    "page_id {0}, url string, payload_bytes long, payload_digest string, record_type string, refers_to {0}, payload binary"
)


def record_types(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_digest, refers_to): refers_to is null for responses.

    Only digests and ids are grouped. The join back has one row a group on its
    right side; it is broadcast while it is small, and beyond that a payload that a third
    of all pages share is split by AQE.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("payload_digest", F.sha2("payload", 256))
    first = (
        rows.filter(F.octet_length("payload") >= MIN_PAYLOAD)
        .groupBy(F.col("payload_digest").alias("shared_digest"))
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
        .select("shared_digest", "first_id")
        .checkpoint()
    )
    # one narrow row for each repeated payload: where they are few, payloads are not shuffled to meet them
    size = first.agg(F.sum(F.octet_length("shared_digest") + 64).alias("b")).first()["b"] or 0
    first = F.broadcast(first) if size <= BROADCAST_BYTES else first
    refers = F.when(~F.col("first_id").eqNullSafe(F.col("page_id")), F.col("first_id"))
    return rows.join(first, F.col("payload_digest") == F.col("shared_digest"), "left").select(
        "page_id", "url", "payload", "payload_digest", refers.alias("refers_to")
    )


def _header_value(text: str) -> str:
    """Percent-encode what would end a header line."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain_value(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record_bytes(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record; ids are given as text."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    unique = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}:{kind}")
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{unique}>", "WARC-Date": RECORD_DATE}
    if page_id is not None:
        head["WARC-Page-ID"] = _header_value(page_id)
    if url is not None:
        head["WARC-Target-URI"] = _header_value(url)
    if refers_to is not None:
        head |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To-Page-ID": _header_value(refers_to)}
    head |= {
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Payload-Length": str(len(payload)),
        "Content-Type": "text/html; charset=utf-8",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record begins here")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest[: int(headers["Content-Length"])]


class BundleWriter:
    """Appends records to one seekable Zstandard file."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.compressor = stream, zstandard.ZstdCompressor(level=LEVEL)
        self.open, self.size, self.frames = [], 0, []

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame number and offset within the frame of the record."""
        if self.size and self.size + len(record) > FRAME_BYTES:
            self.end_frame()
        at = len(self.frames), self.size
        self.open.append(record)
        self.size += len(record)
        return at

    def end_frame(self) -> None:
        if self.open:
            packed = self.compressor.compress(b"".join(self.open))
            self.stream.write(packed)
            self.frames.append((len(packed), self.size))
            self.open, self.size = [], 0

    def close(self) -> None:
        """End the last frame and append the seek table."""
        self.end_frame()
        entries = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), DESCRIPTOR, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)


class BundleReader:
    """Reads records by frame and offset, using the seek table at the end of the file."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.unpack = stream, zstandard.ZstdDecompressor()
        self.stream.seek(0, 2)
        end = self.stream.tell()
        self.stream.seek(end - 9)
        count, _, magic = struct.unpack("<IBI", self.stream.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("the file has no seek table")
        self.stream.seek(end - 9 - 8 * count)
        sizes = list(struct.iter_unpack("<II", self.stream.read(8 * count)))
        self.places, start = [], 0
        for packed, plain in sizes:
            self.places.append((start, packed, plain))
            start += packed
        self.held = (-1, b"")

    def record(self, frame: int, offset: int, length: int) -> bytes:
        if self.held[0] != frame:
            start, packed, plain = self.places[frame]
            self.stream.seek(start)
            self.held = frame, self.unpack.decompress(self.stream.read(packed), max_output_size=plain)
        return self.held[1][offset : offset + length]


def _text(value) -> str | None:
    return None if value is None or value is pd.NA or value != value else str(value)


def write_archives(typed: DataFrame, folder: str) -> DataFrame:
    """Write the rows of ``record_types`` as bundles; the index, read from a checkpoint.

    Ids travel as text, so that a null among numbers leaves the others unchanged.
    """
    ensure_checkpoint_dir(typed.sparkSession)
    kind = dict(typed.dtypes)["page_id"]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.zst"
        with system.open_output_stream(f"{base}/{name}", compression=None) as stream:
            bundle = BundleWriter(stream)
            for batch in batches:
                rows = []
                for r in batch.itertuples(index=False):
                    page, refers = _text(r.page_id), _text(r.refers_to)
                    record = record_bytes(page, _text(r.url), bytes(r.payload), r.payload_digest, refers)
                    rows.append((page, name, *bundle.add(record), len(record)))
                yield pd.DataFrame(rows, columns=["page_id", "file", "frame", "offset", "length"])
            bundle.close()

    as_text = typed.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    written = as_text.mapInPandas(write, INDEX_SCHEMA.format("string"))
    return written.withColumn("page_id", F.col("page_id").cast(kind)).checkpoint()


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Every record that the index names, with its payload (empty for a revisit).

    Rows of an index stay in the order in which they were written, so each frame
    is decompressed once. A response whose payload does not match its digest
    fails the job.
    """
    kind = dict(index.dtypes)["page_id"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, part in batch.groupby("file", sort=False):
                with system.open_input_file(f"{base}/{name}") as stream:
                    bundle, rows, held = BundleReader(stream), [], 0
                    for r in part.itertuples(index=False):
                        head, block = parse_record(bundle.record(r.frame, r.offset, r.length))
                        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                        if head["WARC-Type"] == "response" and hashlib.sha256(block).hexdigest() != digest:
                            raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
                        texts = [head.get(k) for k in ("WARC-Page-ID", "WARC-Target-URI", "WARC-Refers-To-Page-ID")]
                        page, url, refers = (None if t is None else _plain_value(t) for t in texts)
                        rows.append((page, url, int(head["WARC-Payload-Length"]), digest, head["WARC-Type"], refers, block))
                        held += len(block)
                        if held > 32 * FRAME_BYTES:
                            yield _frame(rows)
                            rows, held = [], 0
                    yield _frame(rows)

    records = index.mapInPandas(read, RECORD_SCHEMA.format("string"))
    return records.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    return pd.DataFrame(rows, columns=names).astype({"payload_bytes": "int64"})


def archive(pages: DataFrame, folder: str | None = None, **columns: str) -> tuple[DataFrame, str]:
    """Write a table of pages; the index and the folder of the bundles."""
    place = folder or work_path(pages.sparkSession, "warc")
    return write_archives(record_types(pages, **columns), place), place
