"""Benchmark decontamination by greedy string tiling.

Words are lower-cased and lose punctuation at their ends. Runs of ``SEED`` words that a document
shares with a benchmark item (an exact join of their hashes, behind a bitmap of fixed size that
spares the join most other runs) make the two a candidate pair, if they are enough: a tile of L words
holds L - 4 runs, so tiles that cover enough of the item hold a fifth as many runs at least, and a
phrase that all share makes no pairs. The pair is tiled: Karp-Rabin
hashes find matches of a search length, the longest are marked first, marked words take no part in
later matches, and the search length falls until ``SEED``. Tiles may stand in any order, so
passages that were moved around count. A pair is a leak if tiles cover enough of the item.

Defined cases: null and empty texts have no words and leak nothing; an item of fewer than ``SEED``
words cannot be told from chance and matches nothing; repeated documents or items give one row for
each pair of ids; a row with a null id is compared under that null id. ``without_leaks`` judges each
row by its text, so rows that share an id, or have none, go or stay apart; all columns return as
they were, whatever their names. ``find_leaks`` ignores other columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import BASE, U64, bitmap, mix, numbered, staged, windows, words

SEED = 5
START = 20
COVERAGE = 0.5


def _runs(values: np.ndarray, length: int) -> np.ndarray:
    n = len(values) - length + 1
    rolled = np.zeros(max(n, 0), U64)
    for k in range(length if n > 0 else 0):
        rolled = rolled * U64(BASE) + values[k : k + n]
    return mix(rolled)


def tile(doc: np.ndarray, item: np.ndarray, shortest: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in doc, length) of two arrays of word hashes, longest first."""
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    tiles: list[tuple[int, int, int]] = []
    length = max(shortest, min(START, len(item), len(doc)))
    while True:
        found = _matches(doc, item, free_doc, free_item, length)
        if found and found[0][0] > 2 * length:
            length = found[0][0]
            continue
        marked = False
        for size, i, j in found:
            if free_item[i : i + size].all() and free_doc[j : j + size].all():
                free_item[i : i + size] = free_doc[j : j + size] = False
                tiles.append((i, j, size))
                marked = True
        if marked:
            continue  # what is left of matches that lost words to a tile
        if length <= shortest:
            return tiles
        length = max(shortest, length // 2)


def _matches(doc, item, free_doc, free_item, length) -> list[tuple[int, int, int]]:
    """Maximal matches of at least ``length`` free words, longest first: size, item and doc start."""
    a, b = _open(free_doc, length), _open(free_item, length)
    if not len(a) or not len(b):
        return []
    ha, hb = _runs(doc, length)[a], _runs(item, length)[b]
    order = np.argsort(ha, kind="stable")
    low, high = np.searchsorted(ha[order], hb, "left"), np.searchsorted(ha[order], hb, "right")
    count = high - low
    i = np.repeat(b, count)
    j = a[order[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]]
    # a match that the one before it on the same diagonal continues is not maximal
    key = i.astype(np.int64) * (len(doc) + 1) + j
    first = ~np.isin(key - (len(doc) + 2), key)
    out = []
    for x, y in zip(i[first].tolist(), j[first].tolist()):
        size = length
        while (x + size < len(item) and y + size < len(doc) and free_item[x + size] and free_doc[y + size]
               and item[x + size] == doc[y + size]):
            size += 1
        out.append((size, x, y))
    return sorted(out, key=lambda m: (-m[0], m[1], m[2]))


def _open(free: np.ndarray, length: int) -> np.ndarray:
    """Starts of windows in which every word is free."""
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[length:] == taken[:-length]) if len(free) >= length else np.zeros(0, np.int64)


def _hash_rows(column: pa.Array) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for c in words(column, lower=True, trim=True):
        hashes = c.hashes()
        out += [hashes[s:e] for s, e in zip(c.at[:-1], c.at[1:])]
    return out


def _item_seeds(items: DataFrame, seed: int) -> DataFrame:
    """(item_id, seed, times, n_words): each run of an item, how often it has it, and its words."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for c in words(batch.column(1), lower=True, trim=True):
                grams, first = windows(c, c.hashes(), seed)
                rows = c.row_of()[first]
                size = np.diff(c.at)[rows]
                ids = batch.column(0).take(pa.array(rows + c.first_row))
                yield pa.RecordBatch.from_arrays([ids, pa.array(grams.view(np.int64)), pa.array(size)], ["item_id", "seed", "n_words"])

    runs = items.mapInArrow(run, f"item_id {kind}, seed long, n_words long")
    return runs.groupBy("item_id", "seed").agg(F.count("*").alias("times"), F.max("n_words").alias("n_words"))


def _key(id_column, text_column):
    """One key for rows of the same id and text, which are judged alike."""
    text = F.coalesce(text_column, F.lit(""))
    return F.xxhash64(F.coalesce(id_column.cast("string"), F.lit("")), id_column.isNull(), text)


def _leaks(source: DataFrame, items: DataFrame, seed: int, coverage: float) -> DataFrame:
    """(key, id, item_id, coverage, n_tiles, n_words) of the pairs that leak; ``source`` has id and text."""
    items = items.select("item_id", F.col("text").alias("item_text"))
    seeds = staged(_item_seeds(items, seed), "benchmark-seeds")
    given = source.sparkSession.sparkContext.broadcast(bitmap(seeds, "seed"))
    kind = source.schema["id"].dataType.simpleString()

    def candidates(batches):
        bits = given.value
        for batch in batches:
            for c in words(batch.column(1), lower=True, trim=True):
                grams, first = windows(c, c.hashes(), seed)
                hit = bits.may_hold(grams.view(np.int64))
                rows, grams = c.row_of()[first[hit]], grams[hit].view(np.int64)
                kept, start = np.unique(rows, return_index=True)
                lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(rows)).astype(np.int32)), pa.array(grams))
                at = pa.array(kept + c.first_row)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), lists], ["id", "text", "seeds"])

    held = source.mapInArrow(candidates, f"id {kind}, text string, seeds array<long>")
    held = staged(held.withColumn("key", _key(F.col("id"), F.col("text"))), "leak-candidates")
    once = held.dropDuplicates(["key"])
    pairs = (
        once.select("key", F.explode(F.array_distinct("seeds")).alias("seed"))
        .join(seeds, "seed").groupBy("key", "item_id").agg(F.sum("times").alias("shared"), F.max("n_words").alias("n_words"))
        .where(F.col("shared") * seed >= F.col("n_words") * coverage).select("key", "item_id")
    )
    texts = once.select("key", "id", "text")

    def tiles(batches):
        for batch in batches:
            covered, count, size = [], [], []
            for doc, item in zip(_hash_rows(batch.column(3)), _hash_rows(batch.column(4))):
                found = tile(doc, item, seed)
                covered.append(sum(t[2] for t in found) / max(1, len(item)))
                count.append(len(found))
                size.append(len(item))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(covered, pa.float64()), pa.array(count, pa.int64()), pa.array(size, pa.int64())],
                ["key", "id", "item_id", "coverage", "n_tiles", "n_words"],
            )

    item_kind = items.schema["item_id"].dataType.simpleString()
    joined = pairs.join(texts, "key").join(items, "item_id").select("key", "id", "item_id", "text", "item_text")
    found = joined.mapInArrow(tiles, f"key long, id {kind}, item_id {item_kind}, coverage double, n_tiles long, n_words long")
    return found.where(F.col("coverage") >= coverage)


def find_leaks(docs: DataFrame, items: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
               seed: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """Pairs (id, item_id) whose tiles cover at least ``coverage`` of the item's words.

    With ``coverage``, ``n_tiles``, and ``n_words`` of the item. ``items`` has item_id and text.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return (
        _leaks(source, items, seed, coverage)
        .groupBy("id", "item_id").agg(F.max("coverage").alias("coverage"), F.max("n_tiles").alias("n_tiles"), F.max("n_words").alias("n_words"))
        .withColumnRenamed("id", id_column)
    )


def without_leaks(docs: DataFrame, items: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
                  seed: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """The documents in which no item leaks."""
    renamed, names, _ = numbered(docs)
    ident, text = F.col(names[id_column]), F.col(names[text_column])
    leaks = _leaks(renamed.select(ident.alias("id"), text.alias("text")), items, seed, coverage)
    kept = renamed.withColumn("_key", _key(ident, text)).join(leaks.select(F.col("key").alias("_key")).distinct(), "_key", "left_anti")
    return kept.select(*(F.col(k).alias(name) for name, k in names.items()))
