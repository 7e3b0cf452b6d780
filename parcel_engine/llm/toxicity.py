"""Toxicity: a factorization machine over hashed terms.

Terms are lower-cased words without punctuation at their ends, and their first 4 to 8
bytes, hashed to 2**30 buckets; a document has a term or not. Features are the terms that tell the
two labels of a bounded sample apart best (chi-squared), and the terms of pairs that do so together
better than either alone, be their own part in it nothing: every pair of the ``CANDIDATES`` most
frequent terms and the best single ones is counted. The machine learns for each feature a weight and
a vector whose inner products are pair weights, so that two terms can mean together what neither
means alone. Scores are probabilities.

Defined cases: a null text is an empty one and scores as the intercept says; repeated rows score
alike; without labels of both kinds every score is the share of toxic labels (0 without labels).
Ties between terms go to the smaller hash. ``without_toxic`` returns the documents' columns as they
were, whatever their names; ``toxicity`` replaces columns that have the names of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import U64, discard, lowest, numbered, staged, words

#: Labelled rows that train the model, at most; chosen by a hash of the id.
TRAIN_ROWS = 12_000
FEATURES = 2048
#: Chi-squared that a feature needs at least; chance gives it to one term in 500,000.
LEAST_WORTH = 25.0
#: Terms whose pairs are counted, as many by frequency as by worth.
CANDIDATES = 1024
#: Chi-squared by which a pair must surpass its better term; half a million pairs pass less by chance.
LEAST_GAIN = 40.0
#: Documents, and rows of the table of pairs, that the driver holds apart at a time.
BLOCK, ROWS = 1000, 128
FACTORS = 4
THRESHOLD = 0.7
BUCKETS_BITS = 30
PREFIXES = (4, 5, 6, 7, 8)


def _terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Of each chunk: first row, number of rows, and the rows and buckets of its terms."""
    for c in words(column, lower=True, trim=True):
        row = c.row_of()
        hashes, rows = [c.hashes()], [row]
        for size in PREFIXES:
            long = c.end - c.start > size
            hashes.append(c.span_hash(c.start[long], c.start[long] + size) + U64(size))
            rows.append(row[long])
        bucket = (np.concatenate(hashes) >> U64(64 - BUCKETS_BITS)).astype(np.int64)
        yield c.first_row, c.n_rows, np.concatenate(rows), bucket


@dataclass
class Machine:
    terms: np.ndarray  #: sorted buckets that are features
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, n_rows: int, rows: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Of rows given by (row, feature) pairs without repetition, in order of rows."""
        z = self.bias + np.bincount(rows, self.weights[features], n_rows)
        for f in range(self.factors.shape[1]):
            v = self.factors[features, f]
            z += 0.5 * (np.bincount(rows, v, n_rows) ** 2 - np.bincount(rows, v * v, n_rows))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def pairs(self, rows: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) of the buckets that are features."""
        if not len(self.terms):
            return rows[:0], rows[:0]
        at = np.minimum(np.searchsorted(self.terms, buckets), len(self.terms) - 1)
        hit = self.terms[at] == buckets
        both = np.unique(rows[hit] * len(self.terms) + at[hit])
        return both // len(self.terms), both % len(self.terms)


def fit(terms: np.ndarray, docs: list[np.ndarray], label: np.ndarray, *, factors: int = FACTORS,
        epochs: int = 60, rate: float = 0.05, decay: float = 5e-4, seed: int = 11) -> Machine:
    """Logistic loss by Adam on mini-batches; ``docs`` holds feature numbers."""
    rng = np.random.default_rng(seed)
    share = label.mean() if len(label) else 0.0
    clipped = np.clip(share, 1e-6, 1 - 1e-6)
    params = [np.zeros(len(terms)), rng.normal(0, 0.02, (len(terms), factors)), np.array([np.log(clipped / (1 - clipped))])]
    if not 0 < share < 1:
        return Machine(terms, -40.0 if share == 0 else 40.0, params[0], np.zeros_like(params[1]))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step, size = 0, 512
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for s in range(0, len(order), size):
            part = order[s : s + size]
            count = np.array([len(docs[i]) for i in part])
            rows, feats = np.repeat(np.arange(len(part)), count), np.concatenate([docs[i] for i in part])
            w, v, b = params
            vf = v[feats]
            sums = np.stack([np.bincount(rows, vf[:, f], len(part)) for f in range(factors)], 1)
            squares = np.bincount(rows, (vf * vf).sum(1), len(part))
            z = b[0] + np.bincount(rows, w[feats], len(part)) + 0.5 * ((sums**2).sum(1) - squares)
            error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label[part]) / len(part)
            each = error[rows]
            pull = each[:, None] * (sums[rows] - vf)
            grads = [
                np.bincount(feats, each, len(terms)) + decay * w,
                np.stack([np.bincount(feats, pull[:, f], len(terms)) for f in range(factors)], 1) + decay * v,
                np.array([error.sum()]),
            ]
            step += 1
            for p, g, (m, q) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                q += 0.001 * (g * g - q)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.999**step)) + 1e-8)
    return Machine(terms, float(params[2][0]), params[0], params[1])


def worth(both, toxic, n: float, p: float):
    """Chi-squared of a mark that ``both`` of ``n`` documents have, ``toxic`` of the ``p`` toxic ones."""
    gap = toxic * n - both * p  # the determinant of the two-by-two table
    return gap * gap * n / (both * (n - both) * max(p * (n - p), 1) + 1)


def pair_terms(docs: list[np.ndarray], label: np.ndarray, terms: int, features: int = FEATURES) -> np.ndarray:
    """Terms, by number, of the pairs that gain most over their better term."""
    if not terms:
        return np.zeros(0, np.int64)
    both, bad = np.zeros((terms, terms), np.float32), np.zeros((terms, terms), np.float32)
    for s in range(0, len(docs), BLOCK):
        part = docs[s : s + BLOCK]
        held = np.zeros((len(part), terms), np.float32)
        held[np.repeat(np.arange(len(part)), [len(d) for d in part]), np.concatenate(part)] = 1
        toxic = held[label[s : s + BLOCK] > 0]
        both += held.T @ held
        bad += toxic.T @ toxic
    n, p = len(docs), float(label.sum())
    alone = worth(np.diag(both).astype(np.float64), np.diag(bad).astype(np.float64), n, p)
    best, most = np.zeros(0, np.int64), np.zeros(0)
    for x in range(0, terms, ROWS):
        count = both[x : x + ROWS]
        chi = worth(count.astype(np.float64), bad[x : x + ROWS].astype(np.float64), n, p)
        gain = np.triu(chi - np.maximum(alone[x : x + ROWS, None], alone), x + 1)
        # a mark of four documents at least, as for single terms
        gain[count < 4] = 0
        found = np.flatnonzero(gain.ravel() >= LEAST_GAIN)
        best, most = np.concatenate([best, found + x * terms]), np.concatenate([most, gain.ravel()[found]])
        order = np.argsort(-most, kind="stable")[: features // 2]
        best, most = best[order], most[order]
    return np.unique(np.concatenate(np.unravel_index(best, both.shape)))


def _numbers(held: DataFrame, terms: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The sample's documents as numbers of the sorted ``terms``, and their labels, in a fixed order."""
    given = held.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            at, flat = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
            where = np.searchsorted(given.value, flat)
            hit = np.zeros(len(flat), bool)
            if len(given.value):
                hit = given.value[np.minimum(where, len(given.value) - 1)] == flat
            before = np.concatenate([[0], np.cumsum(hit)])
            out = pa.ListArray.from_arrays(pa.array(before[at].astype(np.int32)), pa.array(where[hit].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), out], ["label", "terms"])

    rows = held.mapInArrow(run, "label int, terms array<int>").toArrow().combine_chunks()
    given.destroy()
    label, lists = rows.column("label").to_numpy(), rows.column("terms").combine_chunks()
    at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    docs = [flat[x:y] for x, y in zip(at[:-1], at[1:])]
    order = sorted(range(len(docs)), key=lambda i: (docs[i].tobytes(), label[i]))
    return [docs[i] for i in order], label.astype(float)[order]


def train(docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
          rows: int = TRAIN_ROWS, features: int = FEATURES, candidates: int = CANDIDATES) -> Machine:
    """Learn from at most ``rows`` labelled documents; ``labels`` has the id and ``toxic`` 0 or 1."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col(id_column).isNotNull())
        .groupBy(id_column).agg(F.max("toxic").alias("_toxic"))
    )
    # ids alone are ordered and limited; at most `rows` of them are sent to the tasks
    chosen = lowest(docs.select(id_column).join(known, id_column), F.xxhash64(id_column), rows)
    sample = docs.select(id_column, F.col(text_column).alias("text")).join(F.broadcast(chosen), id_column)

    def terms_of(batches):
        for batch in batches:
            for first, n, row, bucket in _terms(batch.column(0)):
                both = np.unique((row << BUCKETS_BITS) + bucket)
                row, bucket = both >> BUCKETS_BITS, both & ((1 << BUCKETS_BITS) - 1)
                at = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(bucket.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, n), lists], ["label", "terms"])

    held = staged(
        sample.select("text", F.col("_toxic").cast("int")).mapInArrow(terms_of, "label int, terms array<int>"), "toxic-terms"
    )
    total = held.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("p")).first()
    n, p = total["n"], total["p"]
    value = worth(F.col("with").cast("double"), F.col("toxic").cast("double"), n, p)
    counted = (
        held.select("label", F.explode("terms").alias("term"))
        .groupBy("term").agg(F.count("*").alias("with"), F.sum("label").alias("toxic"))
        .where("with >= 4").select("term", "with", value.alias("worth"))
    )
    counted = staged(counted, "toxic-counts")
    array = lambda df: np.array([r["term"] for r in df.select("term").collect()], np.int64)
    best = array(counted.where(F.col("worth") >= LEAST_WORTH).orderBy(F.desc("worth"), "term").limit(features))
    common = array(counted.orderBy(F.desc("with"), "term").limit(candidates))
    paired = np.unique(np.concatenate([common, best[:candidates]]))
    numbers, label = _numbers(held, paired)
    terms = np.union1d(best, paired[pair_terms(numbers, label, len(paired), features)])
    learned = fit(terms, *_numbers(held, terms))
    discard(held, counted)
    return learned


def _scored(docs: DataFrame, model: Machine, text_column: str) -> tuple[DataFrame, dict[str, str]]:
    """The documents under names that clash with none, with ``score``; those names by old name."""
    given = docs.sparkSession.sparkContext.broadcast(model)
    renamed, names, kinds = numbered(docs)
    text = names[text_column]

    def run(batches):
        for batch in batches:
            scores = []
            for _, n, rows, buckets in _terms(batch.column(text)):
                scores.append(given.value.score(n, *given.value.pairs(rows, buckets)))
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, "score"])

    return renamed.mapInArrow(run, f"{kinds}, score double"), names


def toxicity(docs: DataFrame, model: Machine, *, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with ``score`` and ``predicted``, over whole texts.

    Columns of these names that the documents already have are replaced.
    """
    out, names = _scored(docs, model, text_column)
    kept = [F.col(k).alias(name) for name, k in names.items() if name not in ("score", "predicted")]
    return out.select(*kept, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Machine, *, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with the columns they have."""
    out, names = _scored(docs, model, text_column)
    return out.where(F.col("score") < threshold).select(*(F.col(k).alias(name) for name, k in names.items()))
