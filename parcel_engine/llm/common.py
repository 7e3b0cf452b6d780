"""What the operators share: staged tables, folds, and words of whole Arrow batches in numpy.

A word is a run of bytes other than space and 0x09 to 0x0D, so words can be found in UTF-8
without decoding. Texts are handled in chunks of about a megabyte; a null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcel_engine.session import session_conf, shared_root
from parcel_engine.sinks.tables import remove_folder

U64 = np.uint64
CHUNK_BYTES = 1 << 20
#: Of what a staged table of short rows follows, so many for each task that writes it.
SCALE = 10_000
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
#: Odd base of the rolling hash, its inverse modulo 2**64, and a random value for each byte.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20240115).integers(1, 1 << 63, 256, dtype=U64)

_powers: dict[int, np.ndarray] = {}


def shared_dir(spark: SparkSession) -> str:
    """A folder all executors reach: ``spark.checkpoint.dir``, else one below the warehouse."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return known or f"{shared_root(spark)}/_llm_staged"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


def staged(df: DataFrame, name: str, batch_rows: int | None = None, scale: int | None = None) -> DataFrame:
    """The rows, written once to the shared folder; lost executors cost no recomputation.

    ``batch_rows`` bounds the Arrow batches of Python steps whose rows are large. ``scale`` is a
    count that the rows follow, some short rows for each: they are written by a task for each
    ``SCALE`` of it, and by all cores at least, instead of one for each partition of a shuffle.
    """
    folder = new_folder(df.sparkSession, name)
    if scale is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, scale // SCALE))
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch_rows)} if batch_rows else {}
    with session_conf(df.sparkSession, settings):
        df.write.parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out.staged_in = folder
    return out


def discard(*tables: DataFrame) -> None:
    """Remove staged tables that no later step reads."""
    for df in tables:
        remove_folder(df.sparkSession, df.staged_in)


def lowest(df: DataFrame, order: Column, rows: int, *ties: Column | str) -> DataFrame:
    """A sample: the ``rows`` rows of ``df`` with the lowest ``order``, a 64-bit hash.

    Rows that by the count of all cannot be among them are left out before the sort, so what tasks
    send to one place is little more than the sample, however many tasks there are. Where hashes
    crowd in an unlikely way, the sample is smaller than ``rows``.
    """
    n = df.count()
    reach = 1.2 * rows + 200
    if n > reach:
        df = df.where(order <= F.lit(int(reach / n * 2**64) - 2**63))
    return df.orderBy(order, *ties).limit(rows)


def fold(id_column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; -1 for a null id."""
    crc = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(parts)), F.lit(-1)).cast("int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str], str]:
    """The columns under names that clash with no others; those names by old name; their types."""
    names = {f"_c{i}": f for i, f in enumerate(df.schema)}
    renamed = df.select(*(F.col(f"`{f.name}`").alias(k) for k, f in names.items()))
    kinds = ", ".join(f"{k} {f.dataType.simpleString()}" for k, f in names.items())
    return renamed, {f.name: k for k, f in names.items()}, kinds


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        values = np.full(size, base, U64)
        values[0] = 1
        have = _powers[base] = np.cumprod(values, dtype=U64)
        if size > 16 * CHUNK_BYTES:
            del _powers[base]
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values; a bijection."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row starts and ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column, b"" if binary else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if large else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Words of some consecutive rows of a batch."""

    first_row: int
    data: np.ndarray  #: bytes, lower-cased if asked for
    rows: np.ndarray  #: byte offsets of the rows, one more than there are rows
    start: np.ndarray  #: first byte of each word
    end: np.ndarray  #: byte after each word
    at: np.ndarray  #: index of the first word of each row, one more than there are rows
    sums: np.ndarray  #: prefix sums of the rolling hash, one more than there are bytes

    @property
    def n_rows(self) -> int:
        return len(self.rows) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), np.diff(self.at))

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans; equal bytes hash alike wherever they stand."""
        inverse = _power(INVERSE, len(self.data) + 1)
        return mix((self.sums[end] - self.sums[start]) * inverse[start])

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.start, self.end)

    def per_row(self, values: np.ndarray) -> np.ndarray:
        """Sums of per-word values over each row."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[self.at[1:]] - total[self.at[:-1]]


def words(column: pa.Array, lower: bool, trim: bool = False) -> Iterator[Words]:
    """Words of a column, chunk by chunk; ``trim`` drops ASCII punctuation at both ends."""
    data, offsets = text_buffer(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
        stop = min(n, max(stop, row + 1))
        yield _words(data[offsets[row] : offsets[stop]], offsets[row : stop + 1], row, lower, trim)
        row = stop


def _words(data, offsets, first_row, lower, trim) -> Words:
    rows = offsets - offsets[0]
    size = len(data)
    if lower:
        data = LOWER[data]
    inside = ~SPACE[data]
    edges = rows[(rows > 0) & (rows < size)]
    opens, closes = inside.copy(), inside.copy()
    if size:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    if trim and len(start):
        bare = ~PUNCTUATION[data] & inside
        before = np.concatenate([[0], np.cumsum(bare)])
        keep = before[end] > before[start]
        start, end = start[keep], end[keep]
        solid = np.flatnonzero(bare)
        if len(start):
            first = solid[before[start]]
            last = solid[before[end] - 1]
            start, end = first, last + 1
    sums = np.zeros(size + 1, U64)
    np.cumsum(BYTE_VALUES[data] * _power(BASE, size), dtype=U64, out=sums[1:])
    return Words(first_row, data, rows, start, end, np.searchsorted(start, rows), sums)


def windows(chunk: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of all runs of ``length`` words within a row, and their first words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    rolled = np.zeros(n, U64)
    for k in range(length):
        rolled = rolled * U64(BASE) + hashes[k : k + n]
    ends = np.repeat(chunk.at[1:], np.diff(chunk.at))[:n]
    first = np.flatnonzero(np.arange(n) + length <= ends)
    return mix(rolled[first]), first


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def first_of(keys: np.ndarray) -> np.ndarray:
    """Marks the first occurrence of each key."""
    out = np.zeros(len(keys), bool)
    out[np.unique(keys, return_index=True)[1]] = True
    return out


@dataclass
class Bitmap:
    """A Bloom filter of one hash; its size is given, whatever the number of values."""

    words: np.ndarray
    bits: int  #: log2 of its size

    def may_hold(self, values: np.ndarray) -> np.ndarray:
        """Whether each long may be among the values; never false for one that is."""
        return self.holds(xxhash64(values))

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """The same of hashes, by their first bits."""
        at = hashes >> U64(64 - self.bits)
        return (self.words[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1) == 1


def slices_of(values: int, bits: int) -> int:
    """log2 of the slices in which a bitmap of ``values`` is made: a slice has a million of them or so."""
    return min(bits - 6, max(6, int(values >> 20).bit_length()))


def slice_bytes(top: np.ndarray, slices: int, bits: int) -> bytes:
    """The part of a bitmap for hashes that share their first ``slices`` bits."""
    at = (top >> U64(64 - bits)) & U64((1 << (bits - slices)) - 1)
    marks = np.zeros(1 << (bits - slices), bool)
    marks[at.astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").tobytes()


def gathered(rows: DataFrame, slices: int, bits: int) -> Bitmap:
    """A bitmap from (slice, part): 2**bits bits on the driver, whatever the number of values."""
    out = np.zeros(1 << (bits - 6), U64)
    size = 1 << (bits - slices - 6)
    for row in rows.collect():
        out[row[0] * size : (row[0] + 1) * size] |= np.frombuffer(row[1], U64)
    return Bitmap(out, bits)


def bitmap(values: DataFrame, column: str, bits: int = 25, slices: int = 6) -> Bitmap:
    """The bitmap of a column of longs, few of them repeated. Tasks make its slices; a slice's values come to one of them."""
    hashes = values.select(F.xxhash64(F.col(column).cast("long")).alias("h"))
    dealt = hashes.withColumn("slice", F.expr(f"CAST(shiftrightunsigned(h, {64 - slices}) AS INT)")).repartition("slice").sortWithinPartitions("slice")

    def run(batches):
        for batch in batches:
            h, own = batch.column(0).to_numpy().view(U64), batch.column(1).to_numpy()
            cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else []
            parts = [slice_bytes(h[a:b], slices, bits) for a, b in zip(cut, [*cut[1:], len(own)])]
            yield pa.RecordBatch.from_arrays([pa.array(own[cut] if len(own) else own), pa.array(parts, pa.binary())], ["slice", "part"])

    return gathered(dealt.mapInArrow(run, "slice int, part binary"), slices, bits)


def xxhash64(values: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of non-null longs."""
    p1, p2, p3, p4, p5 = (U64(v) for v in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
    ))
    turn = lambda v, n: (v << U64(n)) | (v >> U64(64 - n))
    h = np.full(len(values), 42, U64) + p5 + U64(8)
    h = h ^ (turn(values.view(U64) * p2, 31) * p1)
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> U64(33))) * p2
    h = (h ^ (h >> U64(29))) * p3
    return h ^ (h >> U64(32))
