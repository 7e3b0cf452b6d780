"""Periodic runs of words: stretches that repeat themselves at once, by maximal-pair enumeration.

A run is a stretch with smallest period ``q`` and at least ``max(least, 2 * q)`` words that no
neighbouring word extends. Its first word ``s`` and ``s + q`` begin a *maximal pair*: the same words
from both on, a different word before them, a different word behind. The pairs of a text are the
nodes of the tree of LCP intervals over its sorted suffixes, so

* only words whose next ``least / 2`` words are found again, after another left word, can begin
  such a pair: groups of a single left-word class are left out at once;
* the suffixes are sorted by prefix doubling in numpy, all texts of a chunk together, and each
  doubling touches only suffixes that are not told apart yet;
* the tree is built bottom-up; below a node, ``s`` and ``s + q`` are neighbours by position, as no
  primitive word occurs inside its own square. So every element outside a node's largest child
  looks at its two neighbours alone, then leaves the list: n log n looks, no list is copied.

A pair with shared words ``l`` and distance ``p`` is a run if ``l >= p`` and ``l + p >= least``;
pairs of a multiple of the period cover the same words and lose to the smallest. Nothing has to
be extended.

Words and shared stretches are compared by 64-bit hashes. A text is worked on in one task; memory
is proportional to the longest text, and time to n log n, also for a text of one repeated word.

Defined cases: a null or empty text has no words and no runs; both hashes are then that of the
empty string. Repeated rows are judged one by one. A null id never alters a text. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import BASE, U64, Words, mix, repeated, words

#: Words of the shortest run.
LEAST = 12
#: Words that are joined to text at a time.
BLOCK = 1 << 18


def suffix_order(w: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Suffixes of all texts, those of a text together, so that common beginnings are neighbours."""
    n = len(w)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    end = at[1:][row]
    order = np.lexsort((w, row))
    new = np.ones(n, bool)
    new[1:] = (w[order][1:] != w[order][:-1]) | (row[order][1:] != row[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    slots, step = np.arange(n), 1
    while True:
        # suffixes that share their rank with another
        alone = new.copy()
        alone[:-1] &= new[1:]
        slots, new = slots[~alone], new[~alone]
        if not len(slots):
            return order
        here = order[slots]
        after = here + step
        follow = np.where(after < end[here], rank[np.minimum(after, n - 1)], -1)
        old = rank[here]
        by = np.lexsort((follow, old))
        here, old, follow = here[by], old[by], follow[by]
        order[slots] = here
        new = np.ones(len(slots), bool)
        new[1:] = (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])
        rank[here] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        step *= 2


class Stretches:
    """Hashes of any stretch of words, and how many words two places share."""

    def __init__(self, w: np.ndarray, end: np.ndarray):
        self.end = end  #: of the text of each word
        self.power = np.full(len(w) + 1, BASE, U64)
        self.power[0] = 1
        np.cumprod(self.power, dtype=U64, out=self.power)
        self.sums = np.zeros(len(w) + 1, U64)
        np.cumsum(mix(w) * self.power[:-1], dtype=U64, out=self.sums[1:])

    def shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that are alike from ``i`` and ``j`` on, two places of one text."""
        i, j = np.minimum(i, j), np.maximum(i, j)
        shift = self.power[j - i]
        low, high = np.zeros(len(i), np.int64), self.end[j] - j
        while len(i) and (high > low).any():
            middle = (low + high + 1) // 2
            same = (self.sums[i + middle] - self.sums[i]) * shift == self.sums[j + middle] - self.sums[j]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _intervals(lcp: list[int], low: int, high: int) -> list[tuple[int, int, int, list[int]]]:
    """LCP intervals of suffixes low to high, children first: (words shared, from, to, children)."""
    nodes, stack = [], []
    for k in range(low + 1, high + 1):
        now, left, child = lcp[k] if k < high else -1, k - 1, None
        while stack and now < stack[-1][0]:
            depth, left, children = stack.pop()
            nodes.append((depth, left, k, children))
            child = len(nodes) - 1
            if stack and now <= stack[-1][0]:
                stack[-1][2].append(child)
                child = None
        if not stack or now > stack[-1][0]:
            stack.append((now, left, [] if child is None else [child]))
    return nodes


def _neighbours(lcp: list[int], place: list[int], left: list[int], low: int, high: int, found: list[tuple[int, int]]) -> None:
    """Pairs of different left words that are neighbours by place below a node, near enough for a run."""
    nodes = _intervals(lcp, low, high)
    before, behind = {}, {}
    roots = [len(nodes) - 1]
    while roots:
        depth, low, high, children = nodes[roots.pop()]
        by_place = sorted(range(low, high), key=place.__getitem__)
        before |= zip(by_place, [-1, *by_place])
        behind |= zip(by_place, [*by_place[1:], -1])
        while True:
            largest = max(children, key=lambda c: nodes[c][2] - nodes[c][1], default=None)
            a, b = nodes[largest][1:3] if largest is not None else (high, high)
            outside = [*range(low, a), *range(b, high)]
            for i in outside:
                for j, k in ((i, behind[i]), (before[i], i)):
                    if j >= 0 and k >= 0 and place[k] - place[j] <= depth and left[j] != left[k]:
                        found.append((place[j], place[k]))
            if largest is None:
                break
            for i in outside:
                j, k = before[i], behind[i]
                behind[j], before[k] = k, j
            roots += [c for c in children if c != largest]
            depth, low, high, children = nodes[largest]


def find_runs(w: np.ndarray, at: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Runs of texts of hashed words: text, first word within it, words, period; in this order.

    Text ``k`` has the words ``w[at[k]:at[k + 1]]``.
    """
    none = (np.zeros(0, np.int64),) * 4
    seed = (least + 1) // 2
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    first = np.flatnonzero(np.arange(len(w)) + seed <= at[1:][row]) if len(w) else np.zeros(0, np.int64)
    if not len(first):
        return none
    key = mix(row[first].astype(U64))
    for k in range(seed):
        key = key * U64(BASE) + w[first + k]
    again = repeated(key)
    first, key = first[again], key[again]
    left = np.where(first > at[row[first]], w[first - 1], U64(0))
    by = np.lexsort((first, key))
    first, key, left = first[by], key[by], left[by]
    if not len(first):
        return none
    group = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    several = np.minimum.reduceat(left, group) != np.maximum.reduceat(left, group)
    keep = np.repeat(several, np.diff(np.r_[group, len(key)]))
    first, key, left = first[keep], key[keep], left[keep]
    if not len(first):
        return none
    # words to the nearest place with the same beginning
    gap = np.where(key[1:] == key[:-1], first[1:] - first[:-1], len(w))
    near = np.minimum(np.r_[gap, len(w)], np.r_[len(w), gap])

    # only texts that have such places are sorted
    chosen = np.unique(row[first])
    size = np.diff(at)[chosen]
    own = np.concatenate([[0], np.cumsum(size)])
    take = np.repeat(at[chosen] - own[:-1], size) + np.arange(own[-1])
    local = np.searchsorted(chosen, row[first])
    place = first - at[chosen][local] + own[local]
    w = w[take]
    text = np.repeat(np.arange(len(chosen)), size)
    stretches = Stretches(w, own[1:][text])
    wanted = np.full(len(w), -1)
    wanted[place] = np.arange(len(place))
    order = wanted[suffix_order(w, own)]
    order = order[order >= 0]
    place, near, left = place[order], near[order], left[order]

    def neighbours(place):
        lcp = np.zeros(len(place), np.int64)
        same = np.flatnonzero(text[place[1:]] == text[place[:-1]])
        lcp[same + 1] = stretches.shared(place[same], place[same + 1])
        return lcp

    # a place whose next like one is farther than the words it shares with any other begins no run
    lcp = neighbours(place)
    keep = near <= np.maximum(lcp, np.r_[lcp[1:], 0])
    place, left = place[keep], left[keep]
    lcp = neighbours(place)
    cut = np.flatnonzero(np.r_[True, lcp[1:] < seed, True]) if len(place) else np.zeros(1, np.int64)
    places, lcps, lefts = place.tolist(), lcp.tolist(), np.unique(left, return_inverse=True)[1].tolist()
    found: list[tuple[int, int]] = []
    for low, high in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if high - low > 1:
            _neighbours(lcps, places, lefts, low, high, found)
    if not found:
        return none
    i, j = np.unique(np.array(found, np.int64), axis=0).T
    shared = stretches.shared(i, j)
    period, end = j - i, j + shared
    runs = (shared >= period) & (shared + period >= least)
    i, end, period = i[runs], end[runs], period[runs]
    by = np.lexsort((period, end, i))
    i, end, period = i[by], end[by], period[by]
    smallest = np.r_[True, (i[1:] != i[:-1]) | (end[1:] != end[:-1])] if len(i) else np.zeros(0, bool)
    i, end, period = i[smallest], end[smallest], period[smallest]
    out = chosen[text[i]], i - own[text[i]], end - i, period
    by = np.lexsort((out[3], out[1], out[0]))
    return tuple(o[by] for o in out)


def altered(ids: pa.Array, at: np.ndarray) -> np.ndarray:
    """For each word of the altered texts, the word that stands there: every tenth text, by the
    crc32 of its id, repeats a stretch from a chosen word to its end."""
    source = np.arange(at[-1])
    for k, doc in enumerate(ids.to_pylist()):
        n = int(at[k + 1] - at[k])
        if doc is None or not n:
            continue
        h = zlib.crc32(str(doc).encode())
        if h % 10:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        source[at[k] + a : at[k + 1]] = at[k] + a + np.arange(n - a) % p
    return source


def _join_words(c: Words, which: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The words ``which``, each with a space behind it, and where they end."""
    size = c.end[which] - c.start[which] + 1
    ends = np.cumsum(size)
    take = np.repeat(c.start[which] - (ends - size), size) + np.arange(size.sum())
    out = c.data[np.minimum(take, len(c.data) - 1)]
    out[ends - 1] = 32
    return memoryview(np.ascontiguousarray(out)), ends


def joined_digests(c: Words, which: np.ndarray, at: np.ndarray) -> list[str]:
    """SHA-256 of each text's words ``which[at[k]:at[k + 1]]``, joined by one space."""
    hashes = [hashlib.sha256() for _ in range(len(at) - 1)]
    for low in range(0, len(which), BLOCK):
        high = min(low + BLOCK, len(which))
        data, ends = _join_words(c, which[low:high])
        ends = np.concatenate([[0], ends])
        for k in range(int(np.searchsorted(at, low, "right")) - 1, int(np.searchsorted(at, high, "left"))):
            a, b = max(at[k], low), min(at[k + 1], high)
            if b > a:
                hashes[k].update(data[ends[a - low] : ends[b - low] - (b == at[k + 1])])
    return [h.hexdigest() for h in hashes]


COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, alter: bool = False, least: int = LEAST
) -> DataFrame:
    """Each document's runs: how many, the longest, a digest of all, and of the words outside repeats.

    A word is a repeat if a run holds it after the run's first ``period`` words. With ``alter``,
    every tenth text gets a periodic end first (see ``altered``). The longest run is the one with
    most words, then the first, then the one with the smallest period.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches):
        for batch in batches:
            for c in words(batch.column(1), lower=False):
                ids = batch.column(0).slice(c.first_row, c.n_rows)
                which = altered(ids, c.at) if alter else np.arange(c.at[-1])
                row, start, length, period = find_runs(c.hashes()[which], c.at, least)
                where = c.at[row] + start
                depth = np.bincount(where + period, minlength=len(which) + 1) - np.bincount(where + length, minlength=len(which) + 1)
                kept = np.cumsum(depth[: len(which)]) == 0
                kept_at = np.concatenate([[0], np.cumsum(kept)])[c.at]
                bounds = np.searchsorted(row, np.arange(c.n_rows + 1))
                best = np.full(c.n_rows, -1)
                by = np.lexsort((period, start, -length, row))
                best[row[by][::-1]] = by[::-1]
                lines = [f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), period.tolist())]
                texts = ["".join(lines[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                some = best >= 0
                longest = lambda v: pa.array(v[best] if len(v) else np.zeros(c.n_rows, np.int64), mask=~some)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(np.diff(bounds)), longest(start), longest(length), longest(period), longest(1000 * length // np.maximum(period, 1)),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                        pa.array(joined_digests(c, which[kept], kept_at), pa.string()),
                    ],
                    ["id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
                )

    found = source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, {COLUMNS}")
    return found.withColumnRenamed("id", id_column)
