"""N-gram Jaccard join: documents whose sets of word shingles are alike, and their components.

Two documents link if ``100 * |x & y| >= percent * |x | y|`` for their sets of five-word shingles.
The search is exact. A set is reduced to 64-bit shingle hashes, and equal sets to one
representative. In any order of the shingles that all sets share, two sets that link share a
shingle among the first ``p = n - ceil(percent * n / 100) + 1`` of each, and two shingles if these
prefixes are extended by one.

* The order is: rare shingles by hash, then frequent ones by hash. A first pass counts the shingles
  that are among the first ``COUNTED`` of any set by hash, up to two and by their first 40 bits; those
  of two sets or more are frequent. Prefixes are filled with rare shingles first, so passages that
  documents share leave the prefixes of all that consist mostly of other text. The frequent ones are
  kept in a bitmap of bounded size, made slice by slice in tasks; those it holds by chance count as
  frequent too, for all sets alike, which changes the work only.
* Rare shingles of the extended prefix are index keys alone. Frequent ones are in it only if most
  of a set is frequent. Sets of fewer than ``COMBINED`` shingles then use combinations of two as
  keys; larger ones, such as members of a large group of near copies, would have thousands of
  combinations each and use single ones; sets near that size use both, so that none is missed.
* Every set under a key is a follower of the first one there, its leader. Sizes that cannot link go
  at once. In the first round each set is compared with its first leader, in the second with a leader
  of each other component, as far as the first round's links show it in two steps. Compressed texts travel, not sets: a follower's once a
  round, a leader's once for each ``FOLLOWERS`` of its followers.
* Keys whose sets are still in several components are put together by their leader, and in each
  such group every set that is not in the largest component is compared with all others, block
  by block. A component needs no second link within itself, so a group of near copies costs
  comparisons in proportion to its size times those of its members that are left outside.

Defined cases: null and empty texts have no shingles and are linked with nothing; a text of fewer
words is one shingle of all its words; rows that share an id are one node; a row with a null id is
linked with nothing and has a null component. Ids are integers. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import (
    U64, Bitmap, bitmap, discard, gathered, mix, slice_bytes, slices_of, staged, windows, words,
)
from parcel_engine.llm.components import components

SHINGLE = 5
PERCENT = 80
#: Percentage of a set's shingles, by hash, that are counted; more than the prefix.
COUNTED = 50
#: Bits of the bitmap of frequent shingles (log2), at least and at most.
LEAST_BITS, MOST_BITS = 20, 28
COMBINED = 100
#: Followers that are compared with one copy of their leader, about.
FOLLOWERS = 256
#: Sets in a block of those that are compared with all others, about.
BLOCK = 1024
#: Rows of an Arrow batch that hold texts.
TEXTS_BATCH = 500


def prefix_length(n, percent: int = PERCENT):
    """Shingles of which two sets that link share one: n - ceil(percent * n / 100) + 1."""
    return n - (percent * n + 99) // 100 + 1


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each chunk of a column: its first row, offsets, and distinct hashes ascending per row."""
    for c in words(column, lower=True):
        hashes = c.hashes()
        grams, first = windows(c, hashes, shingle)
        row = c.row_of()[first]
        counts = np.diff(c.at)
        short = np.flatnonzero((counts > 0) & (counts < shingle))
        if len(short):
            whole = np.zeros(len(short), U64)
            for k in range(shingle - 1):
                there = counts[short] > k
                word = hashes[np.where(there, c.at[short] + k, 0)]
                whole = np.where(there, mix(whole + word), whole)
            grams = np.concatenate([grams, mix(whole + counts[short].astype(U64))])
            row = np.concatenate([row, short])
        order = np.lexsort((grams, row))
        grams, row = grams[order], row[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
        grams, row = grams[new], row[new]
        yield c.first_row, np.searchsorted(row, np.arange(c.n_rows + 1)), grams


def _scan(source: DataFrame, shingle: int) -> DataFrame:
    """Each set's size, and two sums that identify it."""

    def run(batches):
        for batch in batches:
            for first, at, grams in shingle_sets(batch.column(1), shingle):
                n = np.diff(at)
                a = np.concatenate([np.zeros(1, U64), np.cumsum(grams, dtype=U64)])
                b = np.concatenate([np.zeros(1, U64), np.cumsum(mix(grams), dtype=U64)])
                a, b = a[at[1:]] - a[at[:-1]], b[at[1:]] - b[at[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(n)), *(pa.array(v) for v in (n.astype(np.int64), a.view(np.int64), b.view(np.int64)))],
                    ["id", "n", "a", "b"],
                )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n long, a long, b long")


def _chosen(batch: pa.RecordBatch, bits: Bitmap) -> pa.RecordBatch:
    """The rows whose id may be in the bitmap."""
    ids = pc.cast(batch.column(0), pa.int64()).to_numpy(zero_copy_only=False)
    return batch.filter(pa.array(bits.may_hold(ids)))


def _twice(values: np.ndarray) -> np.ndarray:
    """Sorted, no value more than twice."""
    values = np.sort(values)
    return values[np.r_[np.ones(min(2, len(values)), bool), values[2:] != values[:-2]]]


def _frequent(source: DataFrame, reps: Broadcast, shingle: int, percent: int, bits: int, slices: int) -> Bitmap:
    """Shingles that two representatives or more have among the first of theirs.

    A batch sends, for each slice of the hashes, the differences of their first 40 bits, sorted,
    byte by byte and compressed: some three bytes for a shingle.
    """

    def count(batches):
        pack = zstandard.ZstdCompressor(1)
        for batch in batches:
            parts = []
            for _, at, grams in shingle_sets(_chosen(batch, reps.value).column(1), shingle):
                n = np.diff(at)
                most = np.maximum(-(-COUNTED * n // 100), prefix_length(n, percent) + 1)
                parts.append(_twice(grams[np.arange(len(grams)) - np.repeat(at[:-1], n) < np.repeat(most, n)] >> U64(24)))
            values = _twice(np.concatenate(parts) if parts else np.zeros(0, U64))
            own = (values >> U64(40 - slices)).astype(np.int64)
            cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
            blobs = []
            for x, y in zip(cut, [*cut[1:], len(own)]):
                steps = np.diff(values[x:y], prepend=U64(0))
                blobs.append(pack.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :5].T)))
            yield pa.RecordBatch.from_arrays([pa.array(own[cut].astype(np.int32)), pa.array(blobs, pa.binary())], ["slice", "part"])

    def merge(held: list[bytes]) -> bytes:
        found = []
        for blob in held:
            planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(5, -1)
            steps = np.zeros((planes.shape[1], 8), np.uint8)
            steps[:, :5] = planes.T
            found.append(np.cumsum(steps.view(U64)[:, 0], dtype=U64))
        values = np.sort(np.concatenate(found))
        return slice_bytes(values[1:][values[1:] == values[:-1]] << U64(24), slices, bits)

    def mark(batches):
        held, now = [], None
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != now and held:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([merge(held)], pa.binary())], ["slice", "part"])
                    held = []
                now = k
                held.append(blob)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([merge(held)], pa.binary())], ["slice", "part"])

    kind = "slice int, part binary"
    counted = source.mapInArrow(count, kind).repartition("slice").sortWithinPartitions("slice")
    return gathered(counted.mapInArrow(mark, kind), slices, bits)


def _keys(source: DataFrame, reps: Broadcast, given: Broadcast, shingle: int, percent: int) -> DataFrame:
    """(key, id, n) for the keys of each representative, n its size; ``given``: the frequent shingles."""

    def run(batches):
        for batch in batches:
            batch = _chosen(batch, reps.value)
            for first, at, grams in shingle_sets(batch.column(1), shingle):
                n = np.diff(at)
                often = given.value.holds(grams)
                row = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((often, row))  # stable: by hash within each class
                grams, often = grams[order], often[order]
                rank = np.arange(len(grams)) - at[row]
                inside = rank <= prefix_length(n, percent)[row]
                out = []
                for i in range(len(n)):
                    own, f = grams[at[i] : at[i + 1]], often[at[i] : at[i + 1]]
                    k = inside[at[i] : at[i + 1]]
                    own, f = own[k], f[k]
                    if f.any():
                        common = own[f]
                        keys = [own[~f]]
                        if 100 * n[i] >= COMBINED * percent:
                            keys.append(common)
                        if n[i] * percent < COMBINED * 100 and len(common) > 1:
                            x, y = np.triu_indices(len(common), 1)
                            keys.append(mix(mix(common[x]) + common[y]))
                        own = np.concatenate(keys)
                    out.append(own)
                size = [len(o) for o in out]
                ids = batch.column(0).slice(first, len(n)).take(pa.array(np.repeat(np.arange(len(n)), size)))
                keys = np.concatenate(out) if out else np.zeros(0, U64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), ids, pa.array(np.repeat(n, size).astype(np.int32))], ["key", "id", "n"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"key long, id {kind}, n int")


def _followers(rows: DataFrame, percent: int) -> DataFrame:
    """(key, leader, id, near) of all rows but the first, by id, under each key.

    ``near``: the sizes of both are such that they may link. Where rows share an id, its other sets
    may link though; what is not compared with its leader is left for the blocks. Rows come sorted
    and the leader is carried along, so memory does not depend on how many rows share a key.
    """
    ordered = rows.repartition("key").sortWithinPartitions("key", "id")

    def run(batches):
        held = None  # key, leader and its size at the end of the last batch
        for batch in batches:
            if not batch.num_rows:
                continue
            key, id_, n = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.int64)
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            leader, size = id_[first], n[first]
            if held is not None and held[0] == key[0]:
                carried = int(np.argmax(new[1:])) + 1 if new[1:].any() else len(key)
                leader[:carried], size[:carried] = held[1:]
                new[0] = False
            held = key[-1], leader[-1], size[-1]
            out = ~new & (leader != id_)
            near = (100 * size >= percent * n) & (100 * n >= percent * size)
            yield pa.RecordBatch.from_arrays([pa.array(v[out]) for v in (key, leader, id_, near)], ["key", "leader", "id", "near"])

    kind = rows.schema["id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"key long, leader {kind}, id {kind}, near boolean")


def _texts_of(source: DataFrame, given: Broadcast) -> DataFrame:
    """Compressed texts of the documents whose id may be in the bitmap."""

    def run(batches):
        pack = zstandard.ZstdCompressor(1)
        for batch in batches:
            batch = _chosen(batch, given.value)
            blobs = [pack.compress((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], ["id", "packed"])

    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, packed binary")


def _unpacked(column: pa.Array, shingle: int) -> list[np.ndarray]:
    """The set of each compressed text, ascending."""
    unpack = zstandard.ZstdDecompressor()
    texts = pa.array([unpack.decompress(b) for b in column.to_pylist()], pa.large_binary())
    return [grams[x:y] for _, at, grams in shingle_sets(texts, shingle) for x, y in zip(at[:-1], at[1:])]


def _common(x: np.ndarray, y: np.ndarray) -> int:
    if not len(x) or not len(y):
        return 0
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _links(pairs: DataFrame, source: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The staged pairs (a, b) that link, by exact intersection; ``a`` leads, ``b`` follows."""
    spark = pairs.sparkSession
    kind = pairs.schema["a"].dataType.simpleString()
    slices = pairs.groupBy("a").agg(F.ceil(F.count("*") / FOLLOWERS).cast("int").alias("k"))
    followers = pairs.join(slices, "a").select(F.col("b").alias("id"), F.col("a").alias("leader"), F.pmod(F.xxhash64("b"), "k").cast("int").alias("slice"), F.lit(1).alias("follows"))
    leaders = slices.select(F.col("a").alias("id"), F.col("a").alias("leader"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("slice"), F.lit(0).alias("follows"))
    roles = followers.union(leaders)
    given = spark.sparkContext.broadcast(bitmap(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id"))
    rows = roles.join(_texts_of(source, given), "id").select("leader", "slice", "follows", "id", "packed")
    ordered = rows.repartition("leader", "slice").sortWithinPartitions("leader", "slice", "follows")

    def run(batches):
        now, sets = None, []
        for batch in batches:
            a, b = [], []
            group = zip(*(batch.column(k).to_pylist() for k in range(4)))
            for (leader, part, follows, id_), own in zip(group, _unpacked(batch.column(4), shingle)):
                if not follows:
                    if now != (leader, part):
                        now, sets = (leader, part), []
                    sets.append(own)
                    continue
                for x in sets if now == (leader, part) else []:
                    common = _common(own, x)
                    if 100 * common >= percent * (len(own) + len(x) - common):
                        a.append(leader)
                        b.append(id_)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(a, batch.schema.field(0).type), pa.array(b, batch.schema.field(0).type)], ["a", "b"])

    found = staged(ordered.mapInArrow(run, f"a {kind}, b {kind}"), "jaccard-links", TEXTS_BATCH)
    given.destroy()
    return found


def _apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components, with these (ca, cb)."""
    of = lambda end: parts.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
    known = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    known = known.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
    return known.where("ca <> cb")


def _open(followers: DataFrame, apart: DataFrame, parts: DataFrame, scale: int) -> DataFrame:
    """(key, leader, id, component) of keys whose sets are in several components, leaders included.

    Only keys of leaders with a follower in another component can be such.
    """
    spark = followers.sparkSession
    given = spark.sparkContext.broadcast(bitmap(apart.select("a").distinct(), "a"))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(given.value.may_hold(pc.cast(batch.column(1), pa.int64()).to_numpy())))

    kind = followers.schema["id"].dataType.simpleString()
    followers = followers.select("key", "leader", "id")
    some = staged(followers.mapInArrow(run, f"key long, leader {kind}, id {kind}"), "jaccard-unsettled")
    given.destroy()
    rows = some.union(some.select("key", "leader", F.col("leader").alias("id"))).distinct()
    known = rows.join(parts.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    keys = known.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    left = staged(known.join(keys.select("key"), "key").select("leader", "id", "component").distinct(), "jaccard-open", scale=scale)
    discard(some)
    return left


def _links_in_blocks(left: DataFrame, source: DataFrame, shingle: int, percent: int, scale: int) -> DataFrame:
    """A link for each set and each component it links to, within the open keys of a leader."""
    spark = left.sparkSession
    ids = left.withColumnRenamed("leader", "g")
    sizes = ids.groupBy("g", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("g").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.max("n").alias("most"), F.sum("n").alias("n"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    known = ids.join(largest, "g").select(
        "g", "id", "component", (F.col("component") != F.col("largest")).alias("outside"),
        blocks(F.col("n") - F.col("most")).alias("outs"), blocks(F.col("n")).alias("all"), F.xxhash64("id").alias("h"),
    )
    known = staged(known, "jaccard-groups", scale=scale)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left_side = known.where("outside").select("g", "id", "component", F.pmod("h", "outs").cast("int").alias("o"), each("all").alias("m"), F.lit(True).alias("asks"))
    right_side = known.select("g", "id", "component", each("outs").alias("o"), F.pmod("h", "all").cast("int").alias("m"), F.lit(False).alias("asks"))
    given = spark.sparkContext.broadcast(bitmap(known.select("id").distinct(), "id"))
    rows = left_side.union(right_side).join(_texts_of(source, given), "id")

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        sets_of = _unpacked(table.column("packed").combine_chunks(), shingle)
        ids, parts = table.column("id").to_numpy(), table.column("component").to_numpy()
        asking, others = np.flatnonzero(asks), np.flatnonzero(~asks)
        size = np.array([len(x) for x in sets_of])
        tokens = np.concatenate([np.zeros(0, U64), *(sets_of[i] for i in others)])
        owner = np.repeat(np.arange(len(others)), size[others])
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        a, b = [], []
        for i in asking:
            low, high = np.searchsorted(tokens, sets_of[i], "left"), np.searchsorted(tokens, sets_of[i], "right")
            count = high - low
            hits = owner[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]
            common = np.bincount(hits, minlength=len(others))
            linked = np.flatnonzero((100 * common >= percent * (size[i] + size[others] - common)) & (parts[others] != parts[i]))
            for j in linked[np.unique(parts[others[linked]], return_index=True)[1]]:
                a.append(ids[i])
                b.append(ids[others[j]])
        return pa.table({"a": pa.array(a, table.schema.field("id").type), "b": pa.array(b, table.schema.field("id").type)})

    kind = left.schema["id"].dataType.simpleString()
    found = staged(rows.groupBy("g", "o", "m").applyInArrow(run, f"a {kind}, b {kind}"), "jaccard-block-links")
    given.destroy()
    discard(known)
    return found


def jaccard_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """Each document's id, ``n_shingles`` and ``component_id``. Ids are integers."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    everything = staged(_scan(source, shingle), "shingle-scan")
    real = everything.where("n > 0 and id is not null")
    groups = staged(real.groupBy("n", "a", "b").agg(F.min("id").alias("rep")), "jaccard-sets")
    copies = real.join(groups, ["n", "a", "b"]).where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    reps = groups.select(F.col("rep").alias("id"))

    context = docs.sparkSession.sparkContext
    size = groups.agg(F.count("*").alias("sets"), F.coalesce(F.sum("n"), F.lit(0)).alias("shingles")).first()
    bits = lambda n: min(MOST_BITS, max(LEAST_BITS, int(n).bit_length()))
    chosen = context.broadcast(bitmap(reps, "id", bits(8 * size["sets"])))
    live = source.where("id is not null")
    wide = bits(size["shingles"] // 4)
    frequent = context.broadcast(_frequent(live, chosen, shingle, percent, wide, slices_of(size["shingles"], wide)))
    followers = staged(_followers(_keys(live, chosen, frequent, shingle, percent), percent), "jaccard-followers")
    chosen.destroy()
    frequent.destroy()

    sets = size["sets"]
    met = staged(followers.groupBy(F.col("leader").alias("a"), F.col("id").alias("b")).agg(F.max("near").alias("near")), "jaccard-met", scale=sets)
    pairs = met.where("near").select("a", "b")
    first = staged(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "jaccard-first", scale=sets)
    one = _links(first, live, shingle, percent)
    # a set has one leader here at most: that, or the leader's, stands for its component
    up = one.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("a"))
    heads = up.join(up.select(F.col("node").alias("a"), F.col("a").alias("top")), "a", "left").select("node", F.coalesce("top", "a").alias("component"))
    heads = staged(heads, "jaccard-heads", scale=sets)
    again = _apart(pairs, heads).groupBy("ca", "b").agg(F.min("a").alias("a")).select("a", "b").distinct()
    second = staged(again.join(first, ["a", "b"], "left_anti"), "jaccard-second", scale=sets)
    discard(heads)
    two = _links(second, live, shingle, percent)
    parts = components(one.union(two), sets)
    # two followers may link that are both unlike their leader, so all that met count
    apart = staged(_apart(met.select("a", "b"), parts), "jaccard-apart", scale=sets)
    left = _open(followers, apart, parts, sets)
    discard(first, second, apart, followers, met, one, two)
    three = _links_in_blocks(left, live, shingle, percent, sets)
    discard(left)

    stars = parts.select(F.col("component").alias("a"), F.col("node").alias("b"))
    whole = components(stars.union(three).union(copies), sets)
    discard(parts, three, groups)
    parts = whole.select(F.col("node").alias("id"), "component")
    return everything.join(parts, "id", "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The documents without near copies: of each component, the one with the smallest id.

    A document without words stays, and so does one with a null id. Rows that share an id stay or
    go together.
    """
    found = jaccard_components(docs, id_column, **options)
    gone = found.where(F.col(id_column) != F.col("component_id")).select(id_column).distinct()
    return docs.join(gone, id_column, "left_anti")
