"""Quality rules: a decision list learned by sequential covering.

Text statistics of labelled documents train an ordered list of conjunctions of thresholds. Each
rule is grown condition by condition on two thirds of the sample by information gain, pruned from
its end on the other third, and kept if it is precise there; the rows it covers are then taken
away and the next rule is learned. The list becomes one ordered Spark ``CASE`` expression.

Defined cases: a null text is an empty one; an empty text has zero in every statistic; repeated
rows are judged one by one; without labels of both kinds the list is empty and accepts all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import SPACE, U64, first_of, lowest, mix, numbered, repeated, staged, windows, words

#: Labelled rows that train the list, at most; chosen by a hash of the id.
TRAIN_ROWS = 20_000
MIN_WORDS = 50
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_distinct_words", "n_upper", "n_digits", "n_marks", "n_stops",
]


def _member(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_SYMBOL, _MARK, _STOP = _member(b"#*$%&|<>"), _member(b"!?"), _member(b".,;:")


def _stats(column: pa.Array) -> Iterator[dict[str, np.ndarray]]:
    for c in words(column, lower=False):
        rows = c.row_of()
        salt = mix(np.arange(c.n_rows, dtype=U64) + U64(1))
        hashes = c.hashes()
        distinct = first_of(hashes ^ salt[rows])
        grams, first = windows(c, hashes, 3)
        again = np.flatnonzero(repeated(grams ^ salt[rows[first]]))
        covered = np.zeros(len(rows) + 2, bool)
        for k in range(3):
            covered[first[again] + k] = True
        per_byte = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[c.rows])
        inside = ~SPACE[c.data]
        # lines end at a newline or at the end of their row
        newline = np.flatnonzero(c.data == 10)
        line_start = np.sort(np.concatenate([c.rows[:-1], newline + 1]))
        line_row = np.searchsorted(c.rows, line_start, "right") - 1
        line_row = np.minimum(line_row, c.n_rows - 1)
        line_end = np.minimum(np.append(line_start[1:], len(c.data)), c.rows[line_row + 1])
        ends_here = (line_end > line_start) & (c.data[np.maximum(line_end - 1, 0)] == 10)
        line_end = line_end - ends_here
        with_word = np.searchsorted(c.start, line_end) > np.searchsorted(c.start, line_start)
        with_word &= line_end > line_start
        s, e, r = line_start[with_word], line_end[with_word], line_row[with_word]
        new_line = first_of(c.span_hash(s, e) ^ salt[r])
        lines = np.bincount(r, minlength=c.n_rows)
        yield {
            "n_words": np.diff(c.at),
            "word_chars": per_byte(inside & ((c.data & 0xC0) != 0x80)),
            "n_symbols": per_byte(_SYMBOL[c.data]),
            "n_dup_lines": lines - np.bincount(r[new_line], minlength=c.n_rows),
            "n_repeat_words": c.per_row(covered[: len(rows)]),
            "n_lines": lines,
            "n_distinct_words": c.per_row(distinct),
            "n_upper": per_byte((c.data >= 65) & (c.data <= 90)),
            "n_digits": per_byte((c.data >= 48) & (c.data <= 57)),
            "n_marks": per_byte(_MARK[c.data]),
            "n_stops": per_byte(_STOP[c.data]),
        }


def text_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of counts for each document, in one pass over the whole texts."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches):
        for batch in batches:
            parts = list(_stats(batch.column(1)))
            if parts:
                columns = [pa.array(np.concatenate([p[k] for p in parts]).astype(np.int64)) for k in COUNTS]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *COUNTS])

    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, " + ", ".join(f"{k} long" for k in COUNTS))
    return out.withColumnRenamed("id", id_column)


def features() -> dict[str, Column]:
    """Ratios of the counts; none depends on the length of the text alone."""
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "word_length": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "distinct_share": per("n_distinct_words", "n_words"),
        "upper_share": per("n_upper", "word_chars"),
        "digit_share": per("n_digits", "word_chars"),
        "marks_per_word": per("n_marks", "n_words"),
        "stops_per_word": per("n_stops", "n_words"),
        "words_per_line": per("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction: (feature, +1 for >= or -1 for <=, threshold) each."""

    conditions: tuple[tuple[str, int, float], ...]

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        hit = np.ones(len(next(iter(x.values()))), bool)
        for name, sign, cut in self.conditions:
            hit &= x[name] >= cut if sign > 0 else x[name] <= cut
        return hit

    def column(self, x: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, sign, cut in self.conditions:
            out = out & (x[name] >= cut if sign > 0 else x[name] <= cut)
        return out


def _cuts(values: np.ndarray) -> np.ndarray:
    """Midpoints between neighbouring quantiles, so that a threshold is not a training value."""
    marks = np.unique(np.quantile(values, np.linspace(0, 1, 101)))
    return (marks[1:] + marks[:-1]) / 2


def _grow(x, bad, most) -> Rule:
    conditions, inside = (), np.ones(len(bad), bool)
    while len(conditions) < most and (~bad[inside]).any():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        best = (0.0, None)
        for name, values in x.items():
            v, b = values[inside], bad[inside]
            for cut in _cuts(v):
                above = v >= cut
                for sign, hit in ((1, above), (-1, ~above)):
                    pp = (b & hit).sum()
                    nn = hit.sum() - pp
                    if pp:
                        gain = pp * (np.log2(pp / (pp + nn)) - np.log2(p / (p + n)))
                        best = max(best, (gain, (name, sign, float(cut))), key=lambda z: z[0])
        if best[1] is None or best[0] <= 1e-9:
            break
        conditions += (best[1],)
        inside &= Rule((best[1],)).covers(x)
    return Rule(conditions)


def learn_rules(
    x: dict[str, np.ndarray], bad: np.ndarray, *, most_rules: int = 24, most_conditions: int = 4,
    precision: float = 0.9, seed: int = 7,
) -> list[Rule]:
    """Sequential covering of the bad rows of a sample."""
    part = np.random.default_rng(seed).permutation(len(bad)) % 3 == 0
    left, rules = np.ones(len(bad), bool), []
    while len(rules) < most_rules:
        grow, prune = left & ~part, left & part
        if bad[grow].sum() < 5 or not (~bad[grow]).any():
            break
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow], most_conditions)
        if not rule.conditions:
            break

        def worth(candidate: Rule) -> tuple[float, int]:
            hit = candidate.covers(x) & prune
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            return ((p - n) / (p + n) if p + n else -1.0, -len(candidate.conditions))

        rule = max((Rule(rule.conditions[:k]) for k in range(1, len(rule.conditions) + 1)), key=worth)
        hit = rule.covers(x) & left
        p, n = (hit & prune & bad).sum(), (hit & prune & ~bad).sum()
        if p < 2 or p < precision * (p + n):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def train(statistics: DataFrame, labels: DataFrame, id_column: str = "doc_id", rows: int = TRAIN_ROWS) -> list[Rule]:
    """Learn from at most ``rows`` labelled documents; ``labels`` has the id and ``quality`` 0 or 1."""
    known = labels.where(F.col("quality").isNotNull() & F.col(id_column).isNotNull())
    known = known.groupBy(id_column).agg(F.min("quality").alias("_quality"))
    x = features()
    labelled = (
        statistics.where(~base_failed())
        .join(known, id_column)
        .select("_quality", F.xxhash64(id_column).alias("_order"), *(x[k].alias(k) for k in x))
    )
    sample = lowest(labelled, F.col("_order"), rows, *x).toPandas()
    bad = sample["_quality"].to_numpy() == 0
    return learn_rules({k: sample[k].to_numpy(float) for k in x}, bad) if len(bad) else []


def decision(rules: list[Rule]) -> Column:
    """False by the first rule that covers a row, else true."""
    x, out = features(), F.lit(True)
    for rule in reversed(rules):
        out = F.when(rule.column(x), F.lit(False)).otherwise(out)
    return out


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated three-word windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_rules(docs: DataFrame, labels: DataFrame, *, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` of every document."""
    statistics = staged(text_statistics(docs), "text-statistics")
    rules = train(statistics, labels, rows=train_rows)
    failed = base_failed()
    return statistics.withColumns(
        {"base_failed": failed, "kept": F.when(failed, F.lit(False)).otherwise(decision(rules))}
    )


def keep_good(docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
              train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns; each is judged by its own text.

    The list is learned from the labelled rows alone and then applied in one pass over all rows.
    """
    chosen = docs.select(id_column).join(labels.select(id_column), id_column, "left_semi").distinct()
    chosen = lowest(chosen, F.xxhash64(id_column), train_rows)
    sample = docs.select(id_column, text_column).join(F.broadcast(chosen), id_column)
    rules = train(staged(text_statistics(sample, id_column, text_column), "sample-statistics"), labels, id_column, train_rows)
    renamed, names, kinds = numbered(docs)
    text = names[text_column]

    def run(batches):
        for batch in batches:
            parts = list(_stats(batch.column(text)))
            if parts:
                columns = [pa.array(np.concatenate([p[k] for p in parts]).astype(np.int64)) for k in COUNTS]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *COUNTS])

    judged = renamed.mapInArrow(run, kinds + ", " + ", ".join(f"{k} long" for k in COUNTS))
    kept = judged.where(~base_failed() & decision(rules))
    return kept.select(*(F.col(k).alias(name) for name, k in names.items()))
