"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole WARC records, and ends
with the seek table of the seekable format (a skippable frame with the sizes of all frames), so
any Zstandard tool reads it as one stream and a reader that knows the table reads single frames.
An index maps record identifiers to bundle, frame and the place within the frame.

Pages with equal payloads of at least ``REVISIT_BYTES`` are one ``response``, of the smallest page
id, and ``revisit`` records that refer to it and carry no payload.

Defined cases: null html is an empty payload; a null url becomes ``urn:page:<id>``; line ends in a
url are percent-encoded; a null page id never is referred to, so copies that all lack an id are
all responses; rows that repeat the smallest id of their group are responses each.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import new_folder, staged

REVISIT_BYTES = 100
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 28
LEVEL = 3
#: Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"


def record_id(page_id: int | None) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}"


def build_record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str,
                 refers_to: int | None, revisit: bool, date: str = EPOCH) -> bytes:
    """One record; ``size`` and ``digest`` are those of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = (url if url is not None else f"urn:page:{page_id}").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{record_id(page_id)}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: <{record_id(refers_to)}>",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], dict[str, str], bytes, int]:
    """WARC fields, HTTP fields, payload, and where the next record starts."""
    end = data.index(b"\r\n\r\n", at)
    fields = _fields(data[at:end])
    start, size = end + 4, int(fields["content-length"])
    cut = data.index(b"\r\n\r\n", start, start + size)
    return fields, _fields(data[start:cut]), data[cut + 4 : start + size], start + size + 4


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


class BundleWriter:
    """Groups records into frames; holds one frame."""

    def __init__(self, sink):
        self.sink, self.at, self.table, self.held, self.size = sink, 0, [], [], 0
        self.squeeze = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Number of the record's frame, where the frame starts, and the place in it."""
        if self.held and self.size + len(record) > FRAME_BYTES:
            self.flush()
        place = len(self.table), self.at, self.size
        self.held.append(record)
        self.size += len(record)
        return place

    def flush(self) -> None:
        frame = self.squeeze(b"".join(self.held))
        self.sink.write(frame)
        self.table.append((len(frame), self.size))
        self.at += len(frame)
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self.flush()
        body = b"".join(struct.pack("<II", *x) for x in self.table)
        body += struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self.sink.close()


def read_seek_table(source) -> list[tuple[int, int, int]]:
    """(start, compressed size, size) of each frame of an open bundle."""
    source.seek(source.size() - 9)
    n, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    source.seek(source.size() - 9 - 8 * n)
    out, at = [], 0
    for packed, size in struct.iter_unpack("<II", source.read(8 * n)):
        out.append((at, packed, size))
        at += packed
    return out


def with_revisits(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with bytes and digest of the payload, and ``refers_to``."""
    html = F.coalesce("html", F.lit(""))
    sized = pages.select(
        "page_id", "url", html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"), F.sha2(html, 256).alias("payload_digest"),
    )
    groups = (
        sized.where(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("payload_digest").agg(F.min("page_id").alias("_least"), F.count("*").alias("_n"))
        .where("_n > 1").drop("_n")
    )
    least = F.col("_least")
    revisit = least.isNotNull() & ~F.col("page_id").eqNullSafe(least)
    return sized.join(groups, "payload_digest", "left").select(
        "page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "payload_bytes", "payload_digest",
        F.when(revisit, least).alias("refers_to"),
    )


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages' records below ``folder``; the index of all records.

    Each attempt of a task writes files of its own names, and the index names those that count.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches):
        context, writer, number, path = TaskContext.get(), None, 0, ""
        for batch in batches:
            rows = []
            for page_id, url, html, size, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is not None and writer.at > BUNDLE_BYTES:
                    writer.close()
                    writer, number = None, number + 1
                if writer is None:
                    path = f"{folder}/bundle-{context.partitionId():06d}-{context.taskAttemptId()}-{number}.warc.zst"
                    store, place = fs.FileSystem.from_uri(path)
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    writer = BundleWriter(store.open_output_stream(place, compression=None))
                payload = (html or "").encode()
                record = build_record(page_id, url, payload, size, digest, refers, html is None)
                rows.append((page_id, record_id(page_id), path, *writer.add(record), len(record)))
            if rows:
                columns = [pa.array(v) for v in zip(*rows)]
                columns[0] = columns[0].cast(batch.schema.field(0).type)
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "record_id", "bundle", "frame", "frame_start", "place", "size"])
        if writer is not None:
            writer.close()

    out = pages.select("page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to").mapInArrow(
        run,
        f"page_id {kinds['page_id']}, record_id string, bundle string, frame long, frame_start long, place long, size long",
    )
    return staged(out, "warc-index")


def read_records(index: DataFrame) -> DataFrame:
    """The records an index names, each frame read once.

    The index is small next to the bundles, so frames are dealt over a stated number of tasks.
    """
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frames = index.groupBy("bundle", "frame_start").agg(F.sort_array(F.collect_list("place")).alias("places"))
    frames = frames.repartition(tasks, "bundle", "frame_start").sortWithinPartitions("bundle", "frame_start")

    def run(batches):
        name, source, table = None, None, {}
        for batch in batches:
            for bundle, start, places in zip(*(c.to_pylist() for c in batch.columns)):
                if bundle != name:
                    store, place = fs.FileSystem.from_uri(bundle)
                    name, source = bundle, store.open_input_file(place)
                    table = {s: (packed, size) for s, packed, size in read_seek_table(source)}
                packed, size = table[start]
                source.seek(start)
                data = zstandard.ZstdDecompressor().decompressobj().decompress(source.read(packed))
                if len(data) != size:
                    raise ValueError(f"{bundle}: the frame at {start} is damaged")
                rows = []
                for at in places:
                    warc, http, payload, _ = parse_record(data, at)
                    revisit = warc["warc-type"] == "revisit"
                    digest = warc["warc-payload-digest"].removeprefix("sha256:")
                    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{bundle}: payload of {warc['warc-record-id']} is damaged")
                    rows.append((
                        int(warc["x-page-id"]) if warc["x-page-id"] else None, warc["warc-target-uri"],
                        int(http["content-length"]) if revisit else len(payload), digest, warc["warc-type"],
                        int(warc["x-refers-to-page-id"]) if revisit else None, None if revisit else payload.decode(),
                    ))
                columns = [pa.array(v, t) for v, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"])

    return frames.mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages into bundles and read every record back."""
    index = write_bundles(with_revisits(pages), new_folder(pages.sparkSession, "warc"))
    return read_records(index)
