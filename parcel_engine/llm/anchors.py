"""SimHash near copies by anchor points: fingerprints that differ in few bits, and their components.

A fingerprint has 64 bits; a bit is set if it is set in over half of the hashes of the text's
three-word shingles, repeats included. Two fingerprints link if at most ``DISTANCE`` bits differ.

The anchors are the words of a covering code. Each half of a fingerprint gives 31 bits to a
Hamming code, whose radius is one: every half has its home anchor, at most one bit away. Of two
fingerprints with at most three differing bits one half differs in at most one, so the home anchor
of the one is within two bits, radius plus threshold, of the other's half. Each fingerprint is
sent to all anchors of its two halves within two bits (16 of 2**26, or one if a half is an anchor
itself), and at each anchor those at home there are compared with all.

* Equal fingerprints are one, so a group of exact copies of any size is a single row.
* An anchor of more than ``BLOCK`` fingerprints, as near copies make, is dealt over blocks: those
  at home against the others, block by block, each in a task of its own. No task holds more.
* A task returns links that connect what it found linked, a spanning forest, never all pairs.
* Components come from these links by alternating stars, in Spark.

Defined cases: a null or empty text, or one without words, has the fingerprint zero and links like
any other; a text of one or two words is a single shingle. Repeated rows, and rows that share an id,
stay apart and are linked by their fingerprints. A row with a null id is linked with nothing and has
a null component. Ids are integers. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import U64, Words, staged, words
from parcel_engine.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Fingerprints at an anchor that are compared in one task.
BLOCK = 4096
#: Parts of a fingerprint's documents when components are joined back, whatever their number.
SLICES = 16
CODE_BITS = 31


def _shingles(c: Words, length: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Words joined by single spaces; start, end and text of each shingle in them."""
    size = c.end - c.start + 1
    ends = np.cumsum(size)
    take = np.repeat(c.start - (ends - size), size) + np.arange(size.sum())
    data = c.data[np.minimum(take, max(len(c.data) - 1, 0))]
    if len(ends):
        data[ends - 1] = 32
    count = np.diff(c.at)
    shingles = np.where(count >= length, count - length + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(c.n_rows), shingles)
    first = np.repeat(c.at[:-1] - (np.cumsum(shingles) - shingles), shingles) + np.arange(shingles.sum())
    last = np.minimum(first + length, c.at[1:][row]) - 1
    return data.tobytes(), ends[first] - size[first], ends[last] - 1, row


def fingerprints(column: pa.Array, length: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """Of each chunk of a column: its first row, and the rows' fingerprints."""
    for c in words(column, lower=True):
        data, start, end, row = _shingles(c, length)
        h = np.fromiter((xxhash.xxh64_intdigest(data[s:e], SEED) for s, e in zip(start.tolist(), end.tolist())), U64, len(start))
        count = np.bincount(row, minlength=c.n_rows)
        some = np.flatnonzero(count)
        bits = np.zeros((c.n_rows, 64), np.int64)
        for low in range(0, 64, 8):  # a byte of all hashes at a time
            part = np.unpackbits(((h >> U64(low)) & U64(255)).astype(np.uint8)[:, None], axis=1, bitorder="little")
            if len(some):
                bits[some, low : low + 8] = np.add.reduceat(part, (np.cumsum(count) - count)[some], axis=0, dtype=np.int64)
        over = 2 * bits > count[:, None]
        yield c.first_row, np.packbits(over, axis=1, bitorder="little").view("<u8")[:, 0]


def _syndromes() -> tuple[list[np.ndarray], np.ndarray]:
    """Syndromes of the 16 low and high bits of a word; for each syndrome the 15 pairs of bits, as words to flip."""
    tables = []
    for low in (0, 16):
        value = np.arange(1 << 16)
        table = np.zeros(1 << 16, np.int64)
        for k in range(low, min(low + 16, CODE_BITS)):
            table ^= np.where((value >> (k - low)) & 1, k + 1, 0)
        tables.append(table)
    flips = np.zeros((CODE_BITS + 1, 16), U64)
    for s in range(1, CODE_BITS + 1):
        pairs = [(i, i ^ s) for i in range(1, CODE_BITS + 1) if i < i ^ s]
        flips[s] = [1 << (s - 1), *((1 << (i - 1)) | (1 << (j - 1)) for i, j in pairs)]
    return tables, flips


_TABLES, _FLIPS = _syndromes()


def anchors(fingerprint: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors near each fingerprint's halves: index of the fingerprint, anchor, and whether it is home."""
    index, anchor, home = [], [], []
    for half in (0, 1):
        word = (fingerprint >> U64(32 * half)) & U64((1 << CODE_BITS) - 1)
        s = _TABLES[0][(word & U64(0xFFFF)).astype(np.int64)] ^ _TABLES[1][(word >> U64(16)).astype(np.int64)]
        name = U64(half << CODE_BITS)
        own = np.flatnonzero(s == 0)
        index.append(own)
        anchor.append(word[own] | name)
        home.append(np.ones(len(own), bool))
        other = np.flatnonzero(s)
        index.append(np.repeat(other, 16))
        anchor.append(((word[other, None] ^ _FLIPS[s[other]]) | name).ravel())
        home.append(np.tile(np.arange(16) == 0, len(other)))
    return np.concatenate(index), np.concatenate(anchor).astype(np.int64), np.concatenate(home)


def _dealt(groups: DataFrame) -> DataFrame:
    """(anchor, fingerprint, rep, home) for all anchors near a fingerprint."""

    def run(batches):
        for batch in batches:
            at, anchor, home = anchors(batch.column(0).to_numpy().view(U64))
            both = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(anchor), *both.columns, pa.array(home)], ["anchor", "fp", "rep", "home"])

    kind = groups.schema["rep"].dataType.simpleString()
    return groups.select("fp", "rep").mapInArrow(run, f"anchor long, fp long, rep {kind}, home boolean")


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links a-b are enough to connect all that they connect."""
    keep = np.zeros(len(a), bool)
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    part = np.arange(len(nodes))
    while True:
        left, right = part[x], part[y]
        apart = np.flatnonzero(left != right)
        if not len(apart):
            return keep
        # each part takes its link to the smallest part beside it, if that is smaller than itself
        low, high = np.minimum(left, right)[apart], np.maximum(left, right)[apart]
        by = np.lexsort((low, high))
        first = by[np.r_[True, high[by][1:] != high[by][:-1]]]
        keep[apart[first]] = True
        part_of = np.arange(len(nodes))
        part_of[high[first]] = low[first]
        while (part_of != part_of[part_of]).any():
            part_of = part_of[part_of]
        part = part_of[part]


def _links_of(group: np.ndarray, fp: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of sorted groups that differ in few bits, one of each two at home: enough links to connect them."""
    n = len(group)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
    size = np.diff(np.r_[starts, n])
    own = np.repeat(np.arange(len(starts)), size)
    asking = np.flatnonzero(home & (size[own] > 1))
    a, b = [], []
    many = size[own[asking]]
    # a bounded number of comparisons at a time
    cut = np.searchsorted(np.cumsum(many), np.arange(0, many.sum(), 1 << 22))
    for low, high in zip(cut, [*cut[1:], len(asking)]):
        i, m = asking[low:high], many[low:high]
        x = np.repeat(i, m)
        y = np.repeat(starts[own[i]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        near = (np.bitwise_count(fp[x] ^ fp[y]) <= distance) & (x != y)
        x, y = x[near], y[near]
        enough = forest(x, y)
        a.append(x[enough])
        b.append(y[enough])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _links(dealt: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) of representatives, enough to connect all that link, from rows sorted by their block."""
    kind = dealt.schema["rep"].dataType.simpleString()
    ordered = dealt.repartition("anchor", "o", "m").sortWithinPartitions("anchor", "o", "m")

    def solve(batch: pa.RecordBatch):
        group = np.zeros(batch.num_rows, np.int64)
        new = np.zeros(batch.num_rows, bool)
        for name in ("anchor", "o", "m"):
            value = batch.column(name).to_numpy()
            new[1:] |= value[1:] != value[:-1]
        group = np.cumsum(new)
        a, b = _links_of(group, batch.column("fp").to_numpy().view(U64), batch.column("home").to_numpy(zero_copy_only=False), distance)
        keep = forest(a, b)
        rep = batch.column("rep")
        return pa.RecordBatch.from_arrays([rep.take(pa.array(a[keep])), rep.take(pa.array(b[keep]))], ["a", "b"])

    def run(batches):
        held = None  # rows of a block that may go on in the next batch
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            last = [batch.column(name)[batch.num_rows - 1].as_py() for name in ("anchor", "o", "m")] if batch.num_rows else None
            if last is None:
                continue
            same = np.ones(batch.num_rows, bool)
            for name, value in zip(("anchor", "o", "m"), last):
                same &= batch.column(name).to_numpy() == value
            at = int(np.argmax(same))
            held = batch.slice(at)
            if at:
                yield solve(batch.slice(0, at))
        if held is not None:
            yield solve(held)

    return ordered.select("anchor", "fp", "rep", "home", "o", "m").mapInArrow(run, f"a {kind}, b {kind}")


def _in_blocks(dealt: DataFrame, block: int) -> DataFrame:
    """The rows with the block (o, m) they are compared in; rows of an anchor of many stand in several.

    Block (o, m) compares the part ``o`` of those at home with the part ``m`` of all. Anchors with a
    single fingerprint, or none at home, have nothing to compare.
    """
    parts = lambda n: F.ceil(F.col(n) / F.lit(block)).cast("int")
    useful = (
        dealt.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.count_if("home").alias("homes"))
        .where("n > 1 and homes > 0").select("anchor", parts("n").alias("ms"), parts("homes").alias("os"))
    )
    found = dealt.join(useful, "anchor")
    spread = F.xxhash64("fp")
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    part = lambda n: F.pmod(spread, F.col(n)).cast("int")
    pair = lambda o, m, asks: F.struct(o.cast("int").alias("o"), m.cast("int").alias("m"), asks.alias("home"))
    asking = F.transform(each("ms"), lambda m: pair(part("os"), m, F.lit(True)))
    asked = F.transform(each("os"), lambda o: pair(o, part("ms"), F.lit(False)))
    single = F.array(pair(F.lit(0), F.lit(0), F.col("home")))
    places = F.when(F.col("ms") == 1, single).when(F.col("home"), F.concat(asking, asked)).otherwise(asked)
    return found.select("anchor", "fp", "rep", F.explode(places).alias("at")).select("anchor", "fp", "rep", "at.home", "at.o", "at.m")


def simhash_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, shingle: int = SHINGLE, distance: int = DISTANCE,
    block: int = BLOCK,
) -> DataFrame:
    """Each document's id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable.

    ``distance`` is at most 3: more needs anchors farther away.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"distance must be 0 to {DISTANCE}")
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, found in fingerprints(batch.column(1), shingle):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(found)), pa.array(found.view(np.int64))], ["id", "fp"])

    everything = staged(source.mapInArrow(run, f"id {kind}, fp long"), "fingerprints")
    real = everything.where("id is not null")
    groups = staged(real.groupBy("fp").agg(F.min("id").alias("rep")), "fingerprint-groups")
    links = _links(_in_blocks(_dealt(groups), block), distance)
    parts = components(links)
    found = groups.join(parts, groups["rep"] == parts["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    # documents are dealt over slices of their fingerprint, so copies in any number spread over tasks
    sliced = found.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    dealt = everything.withColumn("_slice", F.pmod(F.xxhash64("id"), F.lit(SLICES)).cast("int"))
    joined = dealt.join(sliced, ["fp", "_slice"], "left")
    return joined.select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
