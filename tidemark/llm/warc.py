"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each of some whole records, and a seek table in a
skippable frame at its end (the public seekable format): compressed and plain size of every frame. The
index holds for every record its bundle, the frame's place in the file and the record's place in the
plain frame, so one record is read by one seek and one frame.

Payloads of at least ``least_bytes`` that are equal are stored once, in the record of the smallest id;
the others are ``revisit`` records that name it. Rows that repeat this smallest id are stored too.

A task writes each bundle under a name of its own and reports its records as rows; the index, committed
by Spark, names the bundles that count. A task that is run again writes new bundles, and those of a lost
task are named by no index. Bundles go to any file system that pyarrow opens by its address.

Null payload: empty. Null or empty target: no target header. Null id: a record without number, stored in
full and read back with id null. An empty table gives an empty index. Other columns are not stored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, stored

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "bundle string, record_id bigint, frame int, frame_at bigint, frame_bytes bigint, record_at bigint, record_bytes bigint"
RECORDS = "record_id bigint, record_type string, target string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


def with_revisits(df: DataFrame, record_id: str, target: str, payload: str, *, least_bytes: int = 100) -> DataFrame:
    """One row per row: id, target, payload in UTF-8, its size and digest, ``refers_to`` where it is a copy.

    Digests are counted before they are shuffled, so a payload of a third of all rows is one row per task.
    """
    raw = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = df.select(
        F.col(record_id).cast("long").alias("record_id"),
        F.col(target).cast("string").alias("target"),
        raw.alias("payload"),
        F.octet_length(raw).cast("long").alias("payload_bytes"),
        F.sha2(raw, 256).alias("payload_digest"),
    )
    first = (
        rows.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.min("record_id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("payload_digest", "first")
    )
    # Written before it is joined: Spark splits a hot payload only between plain shuffles.
    return rows.join(stored(first, "first-records"), "payload_digest", "left").select(
        "record_id",
        "target",
        "payload_bytes",
        "payload_digest",
        F.when(F.col("record_id") > F.col("first"), F.col("first")).alias("refers_to"),
        F.when(F.col("record_id") > F.col("first"), F.lit(None)).otherwise(F.col("payload")).alias("payload"),
    )


def _record(date: str, record_id: int | None, target: str | None, size: int, digest: str, refers_to: int | None, payload: bytes | None) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {date}"]
    head.append(f"WARC-Record-ID: <urn:row:{'' if record_id is None else record_id}>")
    if target:
        head.append("WARC-Target-URI: " + target.encode("unicode_escape").decode("ascii"))
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:row:{refers_to}>")
    body = payload if refers_to is None else b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode("utf-8") + body + b"\r\n\r\n"


def _parsed(plain: bytes, at: int = 0) -> Iterator[tuple]:
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        fields = dict(line.split(": ", 1) for line in plain[at:end].decode("utf-8").split("\r\n")[1:])
        body = plain[end + 4 : end + 4 + int(fields["Content-Length"])]
        if plain[end + 4 + len(body) : end + 8 + len(body)] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        at = end + 8 + len(body)
        number, target = fields["WARC-Record-ID"][9:-1], fields.get("WARC-Target-URI")
        revisit = fields["WARC-Type"] == "revisit"
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        if not revisit and hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"record {number}: the payload differs from its digest")
        yield (
            int(number) if number else None,
            fields["WARC-Type"],
            target and target.encode("ascii").decode("unicode_escape"),
            int(fields["X-Payload-Length"]),
            digest,
            int(fields["WARC-Refers-To"][9:-1]) if revisit else None,
            None if revisit else body,
        )


class BundleWriter:
    """Frames of a bundle, written as they fill."""

    def __init__(self, folder: str, frame_bytes: int, level: int):
        import zstandard

        self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"
        system, path = fs.FileSystem.from_uri(folder)
        self.out = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.pack = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frame_bytes, self.at, self.frames = frame_bytes, 0, []
        self.open, self.size, self.ids, self.index = [], 0, [], []

    def add(self, record_id: int | None, record: bytes) -> None:
        if self.size and self.size + len(record) > self.frame_bytes:
            self.flush()
        self.ids.append((record_id, self.size, len(record)))
        self.open.append(record)
        self.size += len(record)

    def flush(self) -> None:
        if not self.open:
            return
        packed = self.pack.compress(b"".join(self.open))
        if max(self.size, len(packed)) >= 1 << 32:
            raise ValueError("a frame of 4 GB or more has no place in a seek table")
        self.out.write(packed)
        for record_id, at, size in self.ids:
            self.index.append((self.name, record_id, len(self.frames), self.at, len(packed), at, size))
        self.frames.append((len(packed), self.size))
        self.at += len(packed)
        self.open, self.size, self.ids = [], 0, []

    def close(self) -> list[tuple]:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        return self.index


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def write(records: DataFrame, folder: str, *, frame_bytes: int = 256 << 10, bundle_bytes: int = 256 << 20, level: int = 3, date: str | None = None) -> DataFrame:
    """Write the rows of ``with_revisits`` as bundles in ``folder``; the stored index is the result.

    ``date`` is that of all records, as ``2024-05-01T12:00:00Z``; the time of the call if none is given.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    schema = pa.schema([("bundle", pa.string()), ("record_id", pa.int64()), ("frame", pa.int32()), ("frame_at", pa.int64()), ("frame_bytes", pa.int64()), ("record_at", pa.int64()), ("record_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        writer = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = [batch.column(k)[i].as_py() for k in range(6)]
                writer = writer or BundleWriter(folder, frame_bytes, level)
                writer.add(row[0], _record(date, *row))
                if writer.at >= bundle_bytes:
                    yield _rows(writer.close(), schema)
                    writer = None
        if writer:
            yield _rows(writer.close(), schema)

    columns = ("record_id", "target", "payload_bytes", "payload_digest", "refers_to", "payload")
    return stored(bounded_batches(records).select(*columns).mapInArrow(run, INDEX), "warc-index")


def seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """Place, packed size and plain size of each frame, from the end of an open bundle."""
    file.seek(size - 9)
    frames, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end")
    file.seek(size - 9 - 8 * frames)
    at, out = 0, []
    for packed, plain in struct.iter_unpack("<II", file.read(8 * frames)):
        out.append((at, packed, plain))
        at += packed
    return out


def read(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the bundles that the index names, frame by frame."""
    schema = pa.schema([("record_id", pa.int64()), ("record_type", pa.string()), ("target", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        system, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_file(f"{path}/{name}") as file:
                    for at, packed, plain in seek_table(file, file.size()):
                        file.seek(at)
                        yield _rows(list(_parsed(unpack.decompress(file.read(packed), max_output_size=plain))), schema)

    names = index.select("bundle").distinct()
    return names.repartition(index.sparkSession.sparkContext.defaultParallelism * 2).mapInArrow(run, RECORDS)


def lookup(index: DataFrame, folder: str, record_ids: list[int]) -> list[tuple]:
    """A few records by id, each by one seek and one frame: rows as ``read`` gives them."""
    import zstandard

    system, path = fs.FileSystem.from_uri(folder)
    out = []
    for row in index.filter(F.col("record_id").isin(record_ids)).collect():
        with system.open_input_file(f"{path}/{row.bundle}") as file:
            file.seek(row.frame_at)
            plain = zstandard.ZstdDecompressor().decompress(file.read(row.frame_bytes))
        out.append(next(_parsed(plain[row.record_at : row.record_at + row.record_bytes])))
    return out
