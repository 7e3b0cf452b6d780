"""Token ids in binary files of patched frame-of-reference blocks.

A shard holds the ids of some documents, ascending by document id over all shards. Its ids are cut
into blocks of ``BLOCK``. A block keeps its minimum and packs what is left of each id into as many
bits as the 95th percentile of the block needs; ids that need more stand in the block's exception
list. An index at the end of the shard says where each block starts, and a directory which
documents it holds, so any document can be read without the rest.

Layout, little-endian: "PFR1"; blocks; block starts (u64 each); document ids (i64), null flags
(u8) and lengths (u64); a footer of six u64: blocks, ids, documents, and where the three tables
start. A block: minimum u32, width u8, ids u16, exceptions u16, packed bits, exception places u16,
exception values u32.

Defined cases: a null text is an empty one and holds the end id alone; a null document id sorts
first; rows that repeat an id are ordered by a hash of their text, and stay.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_engine.llm.common import new_folder, staged
from parcel_engine.llm.tokens import encoder, together

BLOCK = 512
PERCENTILE = 95
MAGIC = b"PFR1"
_HEAD = struct.Struct("<IBHH")
_FOOT = struct.Struct("<6Q")
_WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}
_BITS = np.arange(32, dtype=np.uint32)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of uint32 ids; the last may be shorter."""
    out: list[bytes] = [b""] * -(-len(ids) // BLOCK)
    whole = len(ids) // BLOCK
    for s in range(0, whole, 256):
        _encode(ids[s * BLOCK : min(whole, s + 256) * BLOCK].reshape(-1, BLOCK), out, s)
    if len(ids) % BLOCK:
        _encode(ids[whole * BLOCK :].reshape(1, -1), out, whole)
    return out


def _encode(blocks: np.ndarray, out: list[bytes], first: int) -> None:
    low = blocks.min(1)
    delta = blocks - low[:, None]
    at = min(blocks.shape[1] - 1, blocks.shape[1] * PERCENTILE // 100)
    cut = np.partition(delta, at, axis=1)[:, at]
    width = np.ceil(np.log2(cut.astype(np.float64) + 1)).astype(np.int64)
    over = delta.astype(np.uint64) >> width[:, None].astype(np.uint64) != 0
    for w in np.unique(width):
        which = np.flatnonzero(width == w)
        if w in _WHOLE:  # whole bytes need no packing
            packed = delta[which].astype(_WHOLE[w]).view(np.uint8).reshape(len(which), -1)
        else:
            bits = (delta[which][:, :, None] >> _BITS[:w]).astype(np.uint8) & 1
            packed = np.packbits(bits.reshape(len(which), -1), axis=1, bitorder="little")
        for i, b in zip(which, packed):
            places = np.flatnonzero(over[i])
            out[first + i] = b"".join((
                _HEAD.pack(low[i], w, blocks.shape[1], len(places)), b.tobytes(),
                places.astype("<u2").tobytes(), delta[i][places].astype("<u4").tobytes(),
            ))


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at ``starts``, in their order."""
    heads = [_HEAD.unpack_from(data, s) for s in starts.tolist()]
    if not heads:
        return np.zeros(0, np.uint32)
    low, width, count, many = (np.array(v, np.int64) for v in zip(*heads))
    first = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint32)
    raw = np.frombuffer(data, np.uint8)
    body = starts.astype(np.int64) + _HEAD.size
    for w, n in {*zip(width.tolist(), count.tolist())}:
        which = np.flatnonzero((width == w) & (count == n))
        size = (w * n + 7) // 8
        for s in range(0, len(which), 256):
            part = which[s : s + 256]
            if w in _WHOLE:
                values = raw[body[part][:, None] + np.arange(size)].view(_WHOLE[w])
            elif w:
                bits = np.unpackbits(raw[body[part][:, None] + np.arange(size)], axis=1, count=w * n, bitorder="little")
                padded = np.zeros((len(part), n, 32), np.uint8)
                padded[:, :, :w] = bits.reshape(len(part), n, w)
                values = np.packbits(padded, axis=2, bitorder="little").view("<u4")[:, :, 0]
            else:
                values = np.zeros((len(part), n), np.uint32)
            out[first[part][:, None] + np.arange(n)] = values
    for i in np.flatnonzero(many):
        at = int(body[i] + (width[i] * count[i] + 7) // 8)
        m = int(many[i])
        places = np.frombuffer(data, "<u2", m, at)
        out[first[i] + places] = np.frombuffer(data, "<u4", m, at + 2 * m)
    return out + np.repeat(low, count).astype(np.uint32)


class ShardWriter:
    """Takes documents one by one; holds no more than a few blocks of them."""

    def __init__(self, sink):
        self.sink, self.at, self.starts, self.docs, self.n_ids = sink, len(MAGIC), [], [], 0
        self.held, self.n_held = [], 0
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // 4))
        self.n_ids += len(ids) // 4
        self.held.append(ids)
        self.n_held += len(ids) // 4
        if self.n_held >= 512 * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        keep = len(ids) if last else len(ids) // BLOCK * BLOCK
        for block in encode_blocks(ids[:keep]):
            self.starts.append(self.at)
            self.at += len(block)
            self.sink.write(block)
        self.held, self.n_held = [ids[keep:].tobytes()], len(ids) - keep

    def close(self) -> None:
        self._flush(True)
        n = len(self.docs)
        names = np.array([d or 0 for d, _ in self.docs], "<i8").tobytes()
        nulls = np.array([d is None for d, _ in self.docs], np.uint8).tobytes()
        sizes = np.array([k for _, k in self.docs], "<u8").tobytes()
        places = self.at, self.at + 8 * len(self.starts), self.at + 8 * len(self.starts) + 9 * n
        self.sink.write(np.array(self.starts, "<u8").tobytes() + names + nulls + sizes)
        self.sink.write(_FOOT.pack(len(self.starts), self.n_ids, n, *places))


def read_directory(source) -> tuple[np.ndarray, list[int | None], np.ndarray, int]:
    """Block starts, document ids and lengths of an open shard, and where its blocks end."""
    source.seek(source.size() - _FOOT.size)
    blocks, _, docs, at_starts, at_ids, at_sizes = _FOOT.unpack(source.read(_FOOT.size))
    source.seek(at_starts)
    data = source.read(8 * blocks + 17 * docs)
    starts = np.frombuffer(data, "<u8", blocks).astype(np.int64)
    ids = np.frombuffer(data, "<i8", docs, at_ids - at_starts)
    nulls = np.frombuffer(data, np.uint8, docs, at_ids - at_starts + 8 * docs)
    sizes = np.frombuffer(data, "<u8", docs, at_sizes - at_starts).astype(np.int64)
    return starts, [None if z else int(i) for i, z in zip(ids, nulls)], sizes, at_starts


def read_documents(source):
    """(document id, ids as bytes) of an open shard, a stretch of blocks at a time."""
    starts, names, sizes, end = read_directory(source)
    bounds = np.append(starts, end)
    held, block, at = b"", 0, 0
    for name, size in zip(names, sizes.tolist()):
        parts, have = [held[at:]], len(held) - at
        while have < 4 * size:
            stop = min(len(starts), block + 512)
            source.seek(int(bounds[block]))
            data = source.read(int(bounds[stop] - bounds[block]))
            ids = decode_blocks(data, starts[block:stop] - bounds[block]).astype("<u4").tobytes()
            parts.append(ids)
            have, block = have + len(ids), stop
        held, at = (b"".join(parts), 0) if len(parts) > 1 else (held, at)
        yield name, held[at : at + 4 * size]
        at += 4 * size


def write_ids(docs: DataFrame, folder: str, tokenizer: str, *, id_column: str = "doc_id", text_column: str = "text",
              end: int = 2, spaced: bool = False) -> DataFrame:
    """Write shards below ``folder``; their path, number and counts of ids and documents.

    A shard has the number of its part of a range sort by document id. A second attempt of a task
    writes a file of its own name; the rows returned name the files that count.
    """
    ordered = (
        docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
        .repartitionByRange("id", F.xxhash64("text"))
        .sortWithinPartitions("id", F.xxhash64("text"))
    )
    tail = np.array([end], "<u4").tobytes()

    def run(batches):
        context, writer = TaskContext.get(), None
        path = f"{folder}/shard-{context.partitionId():06d}-{context.taskAttemptId()}.pfor"
        encode = encoder(tokenizer, spaced).encode
        for batch in batches:
            for part in together(batch, 1):
                if writer is None:
                    store, place = fs.FileSystem.from_uri(path)
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    writer = ShardWriter(store.open_output_stream(place, compression=None))
                for name, ids in zip(part.column(0).to_pylist(), encode(part.column(1))):
                    writer.add(name, ids + tail)
        if writer is not None:
            writer.close()
            writer.sink.close()
            yield pa.RecordBatch.from_pydict({
                "path": [path], "shard": pa.array([context.partitionId()], pa.int32()),
                "n_ids": [writer.n_ids], "n_docs": [len(writer.docs)],
            })

    return staged(ordered.mapInArrow(run, "path string, shard int, n_ids long, n_docs long"), "shards")


def read_ids(spark: SparkSession, shards: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Every document of the shards: id, ``start`` among all ids, ``n_tokens``, ``ids_crc32``."""
    start, rows = 0, []
    for row in shards.orderBy("shard").toLocalIterator():  # one row for each task of the writer
        rows.append((row["path"], start))
        start += row["n_ids"]
    tasks = spark.createDataFrame(rows, "path string, start long").repartition(max(1, len(rows)))

    def run(batches):
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as source:
                    names, starts, sizes, crcs = [], [], [], []
                    for name, ids in read_documents(source):
                        names.append(name)
                        starts.append(start)
                        sizes.append(len(ids) // 4)
                        crcs.append(zlib.crc32(ids))
                        start += len(ids) // 4
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (names, starts, sizes, crcs)], ["id", "start", "n_tokens", "ids_crc32"])

    out = tasks.mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")
    return out.withColumnRenamed("id", id_column)


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the ids of all texts and read the files back."""
    spark = docs.sparkSession
    return read_ids(spark, write_ids(docs, new_folder(spark, "token-ids"), tokenizer, **options))
