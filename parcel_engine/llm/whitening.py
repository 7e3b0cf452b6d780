"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

``X`` holds the centred vectors as rows and stays distributed; so do the left Lanczos vectors.
Each of them is ``u = X z`` for a short vector ``z`` that the driver knows, so a step is one pass in
which a task forms ``X y`` for its rows and adds up ``X'(X y)`` and ``|X y|^2``. These sums also hold
the products with all earlier left vectors (``u_j'(X y) = z_j'(X'X y)``), so both sides are
reorthogonalised in full without a second pass; where much had to be taken away, the product is
formed again. The driver holds as many short vectors as there are steps, at most one for each
dimension, and the singular values and vectors of a small bidiagonal matrix.

Steps end when the wanted triples have residuals near rounding, or with the last dimension.
Where the space is used up early (copies of an eigenvalue, fewer vectors than dimensions) a new
direction is started, and then steps go on to the last dimension.

Entries ``c`` become whole numbers ``floor(64 * c) + 1000000``. Their sums are exact, and rows are
centred by the whole part of the mean before the rest of it, so the offset costs no digits.

Defined cases: a null vector, or one with a null or non-finite entry, is left out; one shorter than
the longest that remains lacks entries, so it is left out too. Repeated rows and ids count and
return each. A null id stays null. A component of no deviation (no more than rounding) is not
returned, so a table of no vectors, or of copies of a single one, returns no rows. A vector with an
entry whose whole number does not fit a long is left out. A deviation that does not fit a long, as
of tens of millions of vectors, is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import staged, text_buffer

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Residuals and deviations below this share of the largest singular value are none.
NEAR = 1e-14
NOTHING = 1e-11
LONGEST = float(1 << 62)


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, d, x) of the vectors without null or non-finite entries; ``x`` holds d longs."""
    source = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
            flat = pc.list_flatten(column)
            values = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False).astype(np.float64)
            at = np.concatenate([[0], np.cumsum(size)])
            bad = np.concatenate([[0], np.cumsum(~(np.abs(values) < LONGEST / SCALE))])
            keep = (bad[at[1:]] == bad[at[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
            x = np.floor(SCALE * values[np.repeat(keep, size)]).astype(np.int64) + OFFSET
            size = size[keep]
            offsets = np.concatenate([[0], np.cumsum(8 * size)]).astype(np.int64)
            blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x))])
            ids = batch.column(0).filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([ids, pa.array(size.astype(np.int32)), blobs.cast(pa.binary())], ["id", "d", "x"])

    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, d int, x binary")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    data, _ = text_buffer(column)
    return data.view("<i8").reshape(-1, d)


@dataclass
class Centre:
    n: int
    base: np.ndarray  #: whole part of the mean
    rest: np.ndarray  #: what the sum has beyond n times that; below n

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over the dimensions of (n * x - sum)^2, exact; null if it does not fit a long."""
        x = x - self.base
        if not len(x) or x.shape[1] * (self.n * (float(np.abs(x).max()) + 1)) ** 2 < LONGEST:
            return pa.array(((self.n * x - self.rest) ** 2).sum(1))
        exact = ((x.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(1)
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def _summed(rows: DataFrame, kind: str, width: int, add: Callable[[np.ndarray], np.ndarray], d: int) -> np.ndarray:
    """The sum of ``add`` over all rows: one row from each task, added up by Spark."""
    names = [f"s{k}" for k in range(width)]

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = add(_matrix(batch.column(0), d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], names)

    parts = rows.select("x").mapInArrow(run, ", ".join(f"{name} {kind}" for name in names))
    return np.array(list(parts.selectExpr(*(f"sum({name})" for name in names)).collect()[0]))


@dataclass
class Whitening:
    centre: Centre
    components: np.ndarray  #: dimensions x components, unit columns
    values: np.ndarray  #: eigenvalues of the covariance
    trace: float  #: of the covariance

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (self.centre.rows(x) @ self.components) / np.sqrt(self.values)


class Bidiagonalisation:
    """Lanczos vectors and the bidiagonal matrix so far; ``product(y)`` gives X'(X y) and |X y|^2."""

    def __init__(self, product: Callable[[np.ndarray], tuple[np.ndarray, float]], d: int, scale: float, seed: int = 7):
        self.product, self.d, self.nothing = product, d, NOTHING * scale
        self.random = np.random.default_rng(seed)
        self.right = np.zeros((0, d))  #: v
        self.short = np.zeros((0, d))  #: z, of u = X z
        self.back = np.zeros((0, d))  #: X'u
        self.diagonal: list[float] = []
        self.above: list[float] = []
        self.restarted = False
        self.following = self._fresh()

    def _without(self, r: np.ndarray) -> np.ndarray:
        for _ in range(2):
            r = r - self.right.T @ (self.right @ r)
        return r

    def _fresh(self) -> np.ndarray:
        r = self._without(self.random.standard_normal(self.d))
        r = self._without(r / np.linalg.norm(r))
        return r / np.linalg.norm(r)

    def step(self) -> None:
        v = self.following
        beta = self.above[-1] if self.above else 0.0
        y = v - beta * self.short[-1] if beta else v
        for _ in range(3):
            back, square = self.product(y)
            overlap = self.short @ back
            y, back = y - self.short.T @ overlap, back - self.back.T @ overlap
            if np.linalg.norm(overlap) <= 1e-8 * np.sqrt(square):
                break
        alpha = float(np.sqrt(square))
        if alpha <= self.nothing:
            alpha, y, back = 0.0, np.zeros(self.d), np.zeros(self.d)
        else:
            y, back = y / alpha, back / alpha
        self.right = np.vstack([self.right, v])
        self.short = np.vstack([self.short, y])
        self.back = np.vstack([self.back, back])
        r = self._without(back - alpha * v)
        beta = float(np.linalg.norm(r))
        if beta <= self.nothing:
            beta, self.restarted = 0.0, True
        if len(self.right) < self.d:
            self.following = r / beta if beta else self._fresh()
        self.diagonal.append(alpha)
        self.above.append(beta)

    def triples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values, falling; right vectors as columns; residuals."""
        k = len(self.diagonal)
        left, values, right = np.linalg.svd(np.diag(self.diagonal) + np.diag(self.above[: k - 1], 1))
        return values, self.right.T @ right.T, np.abs(self.above[-1] * left[-1])

    def run(self, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.right) < self.d:
            self.step()
            if len(self.right) >= wanted and not self.restarted:
                values, _, residuals = self.triples()
                if residuals[:wanted].max() <= NEAR * values[0]:
                    break
        values, vectors, _ = self.triples()
        return values[:wanted], vectors[:, :wanted]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of staged rows (x of d longs); None without any deviation."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d")).first()
    n, d = size["n"], size["d"]
    if not n or not d:
        return None
    total = [int(s) for s in _summed(rows, "long", d, lambda x: x.sum(0), d)]
    centre = Centre(n, np.array([s // n for s in total]), np.array([s % n for s in total]))

    def product(y):
        def add(x):
            c = centre.rows(x)
            u = c @ y
            return np.append(c.T @ u, u @ u)

        found = _summed(rows, "double", d + 1, add, d)
        return found[:-1], float(found[-1])

    trace = float(_summed(rows, "double", 1, lambda x: np.array([(centre.rows(x) ** 2).sum()]), d)[0])
    if not trace:
        return None
    values, vectors = Bidiagonalisation(product, d, np.sqrt(trace)).run(min(components, d))
    some = values > NOTHING * np.sqrt(trace)
    return Whitening(centre, vectors[:, some], values[some] ** 2 / n, trace / n)


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """The largest entry of the whitened rows' covariance less the identity."""
    k, d, n = len(fitted.values), len(fitted.components), fitted.centre.n

    def run(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            if batch.num_rows:
                w = fitted.apply(_matrix(batch.column(0), d))
                total += w.T @ np.column_stack([w, np.ones(len(w))])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), *map(pa.array, total.T.copy())], ["i", *(f"s{j}" for j in range(k + 1))])

    names = [f"s{j}" for j in range(k + 1)]
    parts = rows.select("x").mapInArrow(run, ", ".join(["i int", *(f"{name} double" for name in names)]))
    found = parts.groupBy("i").agg(*map(F.expr, (f"sum({name})" for name in names))).collect()
    sums = np.array([list(r)[1:] for r in sorted(found)]) / n
    mean = sums[:, -1]
    return float(np.abs(sums[:, :-1] - np.outer(mean, mean) - np.eye(k)).max())


def whitened_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", *, components: int = COMPONENTS
) -> DataFrame:
    """A row for each remaining vector and component, numbered from 1 by falling eigenvalue.

    ``n`` vectors were fitted; ``deviation`` is the vector's squared distance from the mean, times
    n squared; ``whitened`` its coordinate; ``explained`` the component's share of the variance.
    """
    rows = staged(whole_vectors(vectors, id_column, vector_column), "vectors")
    d = rows.agg(F.max("d")).first()[0] or 0
    rows = rows.where(F.col("d") == d)
    fitted = fit(rows, components)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_column)
    k, error = len(fitted.values), identity_error(rows, fitted)
    share = fitted.values / fitted.trace

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), d)
            m = len(x)
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, fitted.centre.n)), fitted.centre.deviations(x).take(pa.array(each)),
                    pa.array(fitted.apply(x).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select("id", "x").mapInArrow(run, schema).withColumnRenamed("id", id_column)
