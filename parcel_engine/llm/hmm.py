"""A hidden Markov language model in which every training word has emissions of its own.

Texts are encoded once: each Arrow batch of some thousand becomes a *part*, a row with the sorted hashes of its words
and the texts as numbers of these. Baum-Welch then runs over all training texts. In the first
``ITERATIONS`` rounds emissions are tied: the ``OWN`` most frequent words have their own, all others
share those of ``SHARED`` hash classes, so a round adds up a table of fixed size. In the last round no
word is tied: each part counts how often it expects each word in each state, tasks add these counts
up by slices of the hashes, and every part gets back, for each of its words, the count in all training
texts and the share of each state. An emission is

    (N * g / G + 0.5) / (N + 0.5 * (V + 1))

for a word that is expected ``g`` times in the state and the state ``G`` times in all; a word that
was never seen has the probability that the word counts alone give it, in every state. The scaled
forward recursion gives the exact likelihood of a text, however long; texts run through it side by
side, sorted by length. Nothing but the own words, class totals and state tables is on the driver.

Defined cases: a null or empty text is its end alone; repeated rows are scored (and counted) one by
one; a null id is not held out; an empty training set gives every word the same probability. A text
is worked on in one task, with memory proportional to it. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import U64, discard, staged, words
from parcel_engine.session import session_conf

STATES = 8
OWN = 8192
SHARED = 1024
END = OWN + SHARED
CLASSES = END + 1
ITERATIONS = 5
#: Tokens that run side by side.
STRIP = 500_000
#: log2 of the slices of hashes by which words are added up, at least; they grow with the parts.
LEAST_SLICES = 6
#: Texts of a part, and rows of an Arrow batch that hold parts.
PART_ROWS = 4000
PARTS_BATCH = 4
#: Hash of a text's end among the words.
END_HASH = U64(0)
#: Steps in which the share of a state is sent.
SHARES = 65_535


@dataclass
class Model:
    start: np.ndarray  #: K
    move: np.ndarray  #: K x K
    emit: np.ndarray  #: symbols x K


class Lockstep:
    """Sequences of symbols laid out by position, the longest first."""

    def __init__(self, sequences: list[np.ndarray]):
        size = np.array([len(s) for s in sequences])
        self.order = np.argsort(-size, kind="stable")
        size = size[self.order]
        self.n = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")
        self.off = np.concatenate([[0], np.cumsum(self.n)])
        steps = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        self.place = self.off[steps] + np.repeat(np.arange(len(size)), size)
        self.text = np.repeat(np.arange(len(size)), size)
        self.symbols = np.empty(len(steps), np.int64)
        self.symbols[self.place] = np.concatenate([sequences[i] for i in self.order])

    def forward(self, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        emitted = m.emit[self.symbols]
        alpha, scale = np.empty_like(emitted), np.empty(len(emitted), emitted.dtype)
        a = m.start * emitted[: self.n[0]]
        for t, n in enumerate(self.n):
            o = self.off[t]
            if t:
                a = (a[:n] @ m.move) * emitted[o : o + n]
            s = a.sum(1)
            a = a / s[:, None]
            alpha[o : o + n], scale[o : o + n] = a, s
        return emitted, alpha, scale

    def log10(self, m: Model) -> np.ndarray:
        """Likelihood of each sequence, in the order they were given."""
        scale = self.forward(m)[2]
        out = np.empty(len(self.order))
        out[self.order] = np.bincount(self.text, np.log10(scale)[self.place], len(self.order))
        return out

    def counts(self, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions of each symbol."""
        emitted, gamma, scale = self.forward(m)
        start, move = np.zeros(len(m.start)), np.zeros(m.move.shape)
        beta = np.ones((self.n[-1], len(start)), emitted.dtype)
        back = m.move.T.copy()
        for t in range(len(self.n) - 1, -1, -1):
            o, n = self.off[t], self.n[t]
            if t + 1 < len(self.n):
                p, k = self.off[t + 1], self.n[t + 1]
                v = emitted[p : p + k] * beta / scale[p : p + k, None]
                move += gamma[o : o + k].T @ v
                beta = np.ones((n, len(start)), emitted.dtype)
                beta[:k] = v @ back
            gamma[o : o + n] *= beta
        start += gamma[: self.n[0]].sum(0)
        emit = np.stack([np.bincount(self.symbols, gamma[:, k], len(m.emit)) for k in range(len(start))], 1)
        return start, move * m.move, emit


def strips(sequences: list[np.ndarray]) -> Iterator[tuple[np.ndarray, Lockstep]]:
    """Groups of sequences of like length, of about ``STRIP`` tokens; indices and layout."""
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    group, tokens = [], 0
    for i in order:
        group.append(i)
        tokens += len(sequences[i])
        if tokens >= STRIP:
            yield np.array(group), Lockstep([sequences[g] for g in group])
            group, tokens = [], 0
    if group:
        yield np.array(group), Lockstep([sequences[g] for g in group])


def reestimate(start, move, emit, prior: np.ndarray) -> Model:
    """Probabilities from expected counts; unseen classes keep a share of their prior."""
    emit = emit + 5.0 * prior[:, None]
    return Model((start + 1e-3) / (start + 1e-3).sum(), (move + 1e-3) / (move + 1e-3).sum(1, keepdims=True), emit / emit.sum(0))


def first_guess(prior: np.ndarray, states: int, seed: int = 3) -> Model:
    """States that last, and classes that each prefer some of them by chance."""
    rng = np.random.default_rng(seed)
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    m = Model(np.full(states, 1 / states), move, prior[:, None] * np.exp(rng.standard_normal((len(prior), states))))
    m.emit /= m.emit.sum(0)
    return m


@dataclass
class Vocabulary:
    own: np.ndarray  #: sorted hashes of the most frequent words; the class is the place
    totals: np.ndarray  #: smoothed count of each class
    tokens: int  #: N
    types: int  #: V

    @property
    def prior(self) -> np.ndarray:
        return self.totals / self.totals.sum()

    def classes(self, h: np.ndarray) -> np.ndarray:
        """Classes of sorted hashes of words, and of the end behind them."""
        out = OWN + (h & U64(SHARED - 1)).astype(np.int64)
        if len(self.own):
            at = np.minimum(np.searchsorted(self.own, h), len(self.own) - 1)
            out = np.where(self.own[at] == h, at, out)
        return np.append(out, END)


def _word_counts(texts: DataFrame) -> DataFrame:
    """(h, c) of all words, added up by batch before they are sent."""

    def run(batches):
        for batch in batches:
            hashes = [c.hashes() for c in words(batch.column(0), lower=True)]
            values, counts = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, U64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["h", "c"])

    return texts.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """``counts``: staged (h, c) of the words of ``texts`` training texts."""
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = counts.orderBy(F.desc("c"), "h").limit(OWN).collect()
    h = np.array([r["h"] for r in top], np.int64).view(U64)
    c = np.array([r["c"] for r in top], np.int64)
    order = np.argsort(h)
    totals = np.full(CLASSES, 0.5)
    totals[: len(h)] += c[order]
    sums = np.zeros(SHARED)
    for r in counts.groupBy(F.col("h").bitwiseAND(SHARED - 1).cast("int").alias("b")).agg(F.sum(F.col("c") + 0.5).alias("c")).collect():
        sums[r["b"]] = r["c"]
    np.subtract.at(sums, (h & U64(SHARED - 1)).astype(np.int64), c + 0.5)
    totals[OWN:END] += np.maximum(sums, 0)
    totals[END] += texts
    return Vocabulary(h[order], totals, size["n"] + texts, size["v"] + (texts > 0))


def packed(values: np.ndarray) -> bytes:
    """An array, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(planes))


def unpacked(blob: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def packed_hashes(h: np.ndarray) -> bytes:
    return packed(np.diff(h, prepend=U64(0)))


def unpacked_hashes(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, U64), dtype=U64)


def _encoded(source: DataFrame) -> DataFrame:
    """A row for each batch: its words, and its texts as numbers of words.

    Words are sorted by hash, which leaves little of each to store; the texts have their ranks by use in
    the batch, which compress well. ``uses`` leads from the one to the other.
    """
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        where = TaskContext.get().partitionId() << 32
        for k, batch in enumerate(b for b in batches if b.num_rows):
            found = [(c.hashes(), np.diff(c.at)) for c in words(batch.column(2), lower=True)]
            size = np.concatenate([n for _, n in found])
            vocab, numbers = np.unique(np.concatenate([h for h, _ in found]), return_inverse=True)
            uses = np.bincount(numbers, minlength=len(vocab))
            rank = np.empty(len(vocab), np.uint32)
            rank[np.argsort(-uses, kind="stable")] = np.arange(len(vocab))
            ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([where + k]), ids, pa.array([packed(batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8))], pa.binary()),
                    pa.array([packed(size.astype(np.uint32))], pa.binary()),
                    pa.array([packed_hashes(vocab)], pa.binary()), pa.array([packed(uses.astype(np.uint32))], pa.binary()),
                    pa.array([packed(rank[numbers])], pa.binary()),
                ],
                ["part", "ids", "held_out", "sizes", "vocab", "uses", "ranks"],
            )

    return source.mapInArrow(run, f"part long, ids array<{kind}>, held_out binary, sizes binary, vocab binary, uses binary, ranks binary")


@dataclass
class Part:
    held_out: np.ndarray
    vocab: np.ndarray
    sequences: list[np.ndarray]  #: numbers of words, the end last

    @classmethod
    def read(cls, row: dict) -> Part:
        size, vocab = unpacked(row["sizes"], np.uint32).astype(np.int64), unpacked_hashes(row["vocab"])
        by_rank = np.argsort(-unpacked(row["uses"], np.uint32).astype(np.int64), kind="stable").astype(np.int32)
        numbers = by_rank[unpacked(row["ranks"], np.uint32)]
        at = np.concatenate([[0], np.cumsum(size)])
        ends = np.insert(numbers, at[1:], len(vocab))
        at = at + np.arange(len(at))
        return cls(unpacked(row["held_out"], np.uint8).astype(bool), vocab, [ends[a:b] for a, b in zip(at[:-1], at[1:])])

    def learned(self) -> list[np.ndarray]:
        return [s for s, held in zip(self.sequences, self.held_out) if not held]


def _expected(part: Part, m: Model, emit: np.ndarray):
    """Expected starts, moves and emissions of a part's training texts; None without any."""
    local = Model(*(v.astype(np.float32) for v in (m.start, m.move, emit)))
    sums = None
    for _, strip in strips(part.learned()) if not part.held_out.all() else ():
        found = strip.counts(local)
        sums = found if sums is None else tuple(a + b for a, b in zip(sums, found))
    return sums


def _rows(batches) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


_PART = ("part", "held_out", "sizes", "vocab", "uses", "ranks")


def _iteration(encoded: DataFrame, m: Model, vocab: Vocabulary) -> Model:
    """One Baum-Welch step over all training texts, with tied emissions."""
    states = len(m.start)
    given = encoded.sparkSession.sparkContext.broadcast((m, vocab))

    def run(batches):
        total = None
        m, vocab = given.value
        for row in _rows(batches):
            part = Part.read(row)
            classes = vocab.classes(part.vocab)
            found = _expected(part, m, m.emit[classes] / vocab.prior[classes, None])
            if found is not None:
                tied = np.stack([np.bincount(classes, found[2][:, k], CLASSES) for k in range(states)], 1)
                flat = np.concatenate([found[0], found[1].ravel(), tied.ravel()])
                total = flat if total is None else total + flat
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "v"])

    sums = encoded.select(*_PART).mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
    flat = np.zeros(states + states**2 + CLASSES * states)
    with session_conf(encoded.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(PARTS_BATCH)}):
        found = sums.toArrow()
    flat[found.column(0).to_numpy()] = found.column(1).to_numpy()
    given.destroy()
    start, move, emit = np.split(flat, [states, states + states**2])
    return reestimate(start, move.reshape(states, states), emit.reshape(CLASSES, states), vocab.prior)


def _word_states(encoded: DataFrame, m: Model, vocab: Vocabulary, slices: int) -> DataFrame:
    """(slice, part, vocab, n, shares): each part's words, how often its training texts have them, and in what
    shares they expect them in each state. The end is a word, the one with the hash ``END_HASH``."""
    given = encoded.sparkSession.sparkContext.broadcast((m, vocab))

    def run(batches):
        m, vocab = given.value
        for row in _rows(batches):
            part = Part.read(row)
            classes = vocab.classes(part.vocab)
            found = _expected(part, m, m.emit[classes] / vocab.prior[classes, None])
            emit = found[2] if found is not None else np.zeros((len(classes), len(m.start)))
            learned = part.learned()
            n = np.bincount(np.concatenate(learned), minlength=len(classes)) if learned else np.zeros(len(classes), np.int64)
            h = np.r_[END_HASH, part.vocab]
            n, emit = np.r_[n[-1:], n[:-1]], np.r_[emit[-1:], emit[:-1]]
            own = (h >> U64(64 - slices)).astype(np.int64)
            cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            bounds = list(zip(cut, [*cut[1:], len(h)]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own[cut].astype(np.int32)), pa.array([row["part"]] * len(cut)),
                    pa.array([packed_hashes(h[a:b]) for a, b in bounds], pa.binary()),
                    pa.array([packed(n[a:b].astype(np.uint32)) for a, b in bounds], pa.binary()),
                    pa.array([packed(in_steps(emit[a:b]).T) for a, b in bounds], pa.binary()),
                ],
                ["slice", "part", "vocab", "n", "shares"],
            )

    return encoded.select(*_PART).mapInArrow(run, "slice int, part long, vocab binary, n binary, shares binary")


def _merged(sent: DataFrame, states: int) -> DataFrame:
    """What each part is told of its words: (part, slice, n, shares); with the first row of a slice, what
    the slice's words count in each state (``totals``)."""

    def merge(slice_: int, rows: list[dict]):
        hashes = [unpacked_hashes(r["vocab"]) for r in rows]
        at = np.cumsum([0, *map(len, hashes)])
        values, back = np.unique(np.concatenate(hashes), return_inverse=True)
        each = np.concatenate([unpacked(r["n"], np.uint32) for r in rows])
        n = np.bincount(back, each)
        g = expected(each, np.concatenate([unpacked(r["shares"], np.uint16).reshape(states, -1) for r in rows], 1).T)
        shares = in_steps(np.stack([np.bincount(back, g[:, k], len(values)) for k in range(states)], 1))
        totals = expected(n, shares).sum(0).tolist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r["part"] for r in rows]), pa.array([slice_] * len(rows), pa.int32()),
                pa.array([packed(n[back[a:b]].astype(np.int64)) for a, b in zip(at[:-1], at[1:])], pa.binary()),
                pa.array([packed(shares[back[a:b]].T) for a, b in zip(at[:-1], at[1:])], pa.binary()),
                pa.array([totals, *[None] * (len(rows) - 1)], pa.list_(pa.float64())),
            ],
            ["part", "slice", "n", "shares", "totals"],
        )

    def run(batches):
        now, held = None, []
        for row in _rows(batches):
            if row["slice"] != now and held:
                yield from merge(now, held)
                held = []
            now = row["slice"]
            held.append(row)
        if held:
            yield from merge(now, held)

    ordered = sent.repartition("slice").sortWithinPartitions("slice", "part")
    return ordered.mapInArrow(run, "part long, slice int, n binary, shares binary, totals array<double>")


def in_steps(g: np.ndarray) -> np.ndarray:
    """The share of each state in expected counts, in steps of 1 / ``SHARES``."""
    return np.rint(SHARES * g / np.maximum(g.sum(1, keepdims=True), 1e-30)).astype(np.uint16)


def expected(n: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """How often words of the count ``n`` are expected in each state."""
    return n[:, None] * shares / np.maximum(shares.sum(1, keepdims=True, dtype=np.int64), 1)


def emissions(n: np.ndarray, shares: np.ndarray, totals: np.ndarray, tokens: int, types: int) -> np.ndarray:
    """The probability of each word in each state."""
    return (tokens * expected(n, shares) / np.maximum(totals, 1e-30) + 0.5) / (tokens + 0.5 * (types + 1))


def hmm_scores(docs: DataFrame, held_out, *, id_column: str = "doc_id", text_column: str = "text",
               states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """Scores of all texts by a model of those for which the column ``held_out`` is false."""
    source = docs.select(F.col(id_column).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_column).alias("text"))
    training = source.where(~F.col("held_out"))
    counts = staged(_word_counts(training.select("text")), "word-counts")
    vocab = vocabulary(counts, training.count())
    discard(counts)
    encoded = staged(_encoded(source), "word-numbers", PART_ROWS)
    model = first_guess(vocab.prior, states)
    for _ in range(iterations):
        model = _iteration(encoded, model, vocab)

    slices = max(LEAST_SLICES, encoded.count().bit_length() - 1)
    told = staged(_merged(_word_states(encoded, model, vocab, slices), states), "word-states", PARTS_BATCH)
    totals = np.zeros(states)
    for row in told.where("totals is not null").selectExpr("posexplode(totals) AS (k, v)").groupBy("k").agg(F.sum("v").alias("v")).collect():
        totals[row["k"]] = row["v"]
    of_part = told.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("slice", "n", "shares"))).alias("told"))
    kind = source.schema["id"].dataType.simpleString()
    denominator = float(np.log10(vocab.tokens + 0.5 * (vocab.types + 1)))

    def run(batches):
        for batch in batches:
            for i, row in enumerate(_rows([batch.select([*_PART, "told"])])):
                part = Part.read(row)
                n = np.concatenate([unpacked(t["n"], np.int64) for t in row["told"]])
                shares = np.concatenate([unpacked(t["shares"], np.uint16).reshape(states, -1) for t in row["told"]], 1).T
                emit = emissions(n, shares, totals, vocab.tokens, vocab.types)
                n, emit = np.r_[n[1:], n[:1]], np.r_[emit[1:], emit[:1]]
                m = Model(model.start, model.move, emit)
                scores = np.empty(len(part.sequences))
                for which, strip in strips(part.sequences):
                    scores[which] = strip.log10(m)
                size = np.array([len(s) for s in part.sequences])
                first = np.cumsum(size) - size
                every = np.concatenate(part.sequences)
                logs = np.add.reduceat(np.log10(n + 0.5)[every], first)
                known = np.add.reduceat((n > 0)[every].astype(np.int64), first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values, pa.array(part.held_out), pa.array(size), pa.array(known),
                        pa.array(np.full(len(size), vocab.tokens)), pa.array(logs - size * denominator), pa.array(scores),
                    ],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    scored = encoded.join(of_part, "part").mapInArrow(
        run, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return staged(scored, "word-scores", PARTS_BATCH).withColumnRenamed("id", id_column)
