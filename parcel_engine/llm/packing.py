"""Best-fit packing of pieces of text into sequences of a fixed capacity, in bulk.

Pieces are range-sorted by length and numbered within each length by distributed ranks. Pieces of
one length are alike, and so are gaps of one width, so what the matching needs to know of the
whole corpus is how many pieces each length has: at most ``capacity`` numbers. Supersteps then go
from the longest pieces to the shortest. In each, all pieces of a length sweep to their successor,
the narrowest gap that holds them; where more of them want a gap than there are of its width, rank
decides, and the rest sweep on to the next wider gap or open new sequences; the gaps are updated
for the next superstep. The outcome is that of best fit with decreasing lengths, piece by piece.

A superstep's matches are ranges: pieces of one length from one rank on, to sequences from one
number on. Tasks look their pieces up in these ranges. There are at most as many ranges as pairs
of lengths, whatever the number of documents.

Defined cases: a null text is an empty one and has the end token alone; repeated rows are packed
one by one; pieces of equal length are ordered by id and piece.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import staged
from parcel_engine.llm.tokens import encoder, together

CAPACITY = 1024


def token_pieces(docs: DataFrame, tokenizer: str, *, id_column: str = "doc_id", text_column: str = "text",
                 end: int = 2, capacity: int = CAPACITY, spaced: bool = True) -> DataFrame:
    """Each text's ids and ``end``, cut into pieces of ``capacity`` ids after a first, shorter one."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    tail = np.array([end], "<u4").tobytes()

    def run(batches):
        encode = encoder(tokenizer, spaced).encode
        for batch in batches:
            for part in together(batch, 1):
                rows, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(encode(part.column(1))):
                    ids += tail
                    n = len(ids) // 4
                    cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[4 * a : 4 * b]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(v, pa.int64()) for v in (start, length, crc))],
                    ["id", "piece", "start", "length", "ids_crc32"],
                )

    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")
    return out.withColumnRenamed("id", id_column)


@dataclass
class Matches:
    """Ranges of ranks of one length, and the sequences and offsets they go to."""

    rows: list[tuple[int, int, int, int, int]]  #: length, first rank, pieces a sequence, first sequence, offset

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(sorted(self.rows), np.int64).reshape(-1, 5).T)


def supersteps(pieces_of: np.ndarray, capacity: int) -> Matches:
    """``pieces_of[n]``: how many pieces have length n."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # width: runs of sequences (first, how many)
    widths: list[int] = []  # of the gaps there are, ascending
    rows, opened = [], 0

    def put(width: int, first: int, n: int) -> None:
        if width and n:
            if width not in gaps:
                gaps[width] = []
                bisect.insort(widths, width)
            gaps[width].append((first, n))

    for length in range(capacity, 0, -1):
        rank, left = 0, int(pieces_of[length])
        while left:
            at = bisect.bisect_left(widths, length)
            if at < len(widths):
                width = widths[at]
                first, n = gaps[width].pop()
                if not gaps[width]:
                    del gaps[width], widths[at]
            else:
                width, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = width // length
            full = min(n, left // each)
            if full:
                rows.append((length, rank, each, first, capacity - width))
                put(width - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < n:
                if 0 < left < each:
                    rows.append((length, rank, left, first + full, capacity - width))
                    put(width - left * length, first + full, 1)
                    full, left = full + 1, 0
                put(width, first + full, n - full)
    return Matches(rows)


def _ranked(pieces: DataFrame, order: list[str]) -> DataFrame:
    """The pieces with the part of the range sort they are in and their rank there, by length."""
    ordered = pieces.repartitionByRange(F.desc("length"), *order).sortWithinPartitions(F.desc("length"), *order)

    def run(batches):
        part, last, seen = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            length = batch.column("length").to_numpy()
            n = len(length)
            if not n:
                continue
            new = np.ones(n, bool)
            new[1:] = length[1:] != length[:-1]
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            rank = np.arange(n) - first
            if length[0] == last:
                rank[first == 0] += seen
            last, seen = length[-1], int(rank[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(rank.astype(np.int64))],
                [*batch.schema.names, "_part", "_rank"],
            )

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ordered.mapInArrow(run, f"{names}, _part int, _rank long")


def pack_best_fit(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    ``order`` names the columns that tell pieces of one length apart.
    """
    ranked = staged(_ranked(pieces, order), "ranked-pieces")
    parts = ranked.groupBy("length", "_part").agg(F.count("*").alias("n")).toPandas().sort_values(["length", "_part"])
    pieces_of = np.zeros(capacity + 1, np.int64)
    np.add.at(pieces_of, parts["length"].to_numpy(int), parts["n"].to_numpy(int))
    before = (parts.groupby("length")["n"].cumsum() - parts["n"]).to_numpy(np.int64)
    width = int(parts["_part"].max() + 1) if len(parts) else 1
    key = parts["length"].to_numpy(np.int64) * width + parts["_part"].to_numpy(np.int64)
    given = pieces.sparkSession.sparkContext.broadcast((key, before, supersteps(pieces_of, capacity).arrays()))

    def run(batches):
        key, before, (lengths, first_rank, each, first, offset) = given.value
        bounds = lengths * (1 << 42) + first_rank
        for batch in batches:
            length, part, rank = (batch.column(k).to_numpy().astype(np.int64) for k in ("length", "_part", "_rank"))
            rank = rank + before[np.searchsorted(key, length * width + part)]
            at = np.searchsorted(bounds, length * (1 << 42) + rank, "right") - 1
            i = rank - first_rank[at]
            keep = [k for k in batch.schema.names if k not in ("_part", "_rank")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(first[at] + i // each[at]), pa.array(offset[at] + i % each[at] * length)],
                [*keep, "sequence_id", "offset"],
            )

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(run, f"{names}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, *, id_column: str = "doc_id", **options) -> DataFrame:
    """Tokenise, cut and pack: one row for each piece."""
    pieces = staged(token_pieces(docs, tokenizer, id_column=id_column, **options), "pieces")
    return pack_best_fit(pieces, [id_column, "piece", "ids_crc32"], options.get("capacity", CAPACITY))
