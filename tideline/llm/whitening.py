"""Whitening of embeddings: principal components by repeated shifted Cholesky orthogonalisation of the centred rows."""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.shared import written

# Fixed values of the query's contract: an entry c becomes floor(64 * c) + 1000000.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
# Orthogonalisation rounds, at most, and the distance from orthonormal columns at which they end.
ROUNDS, ORTHONORMAL = 5, 1e-12
# Singular values below this share of the largest are rounding of directions in which the rows do not vary.
RANK = 1e-12


@dataclass
class Whitening:
    """Mean and principal components of n distinct vectors; `sums` / n is the mean, components are rows."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if self.trace else self.eigenvalues

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T


def points(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """`rows` whose vector has only finite entries, at least one, with the column `x`: its entries in fixed point."""
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    usable = F.when(F.size(vector) > 0, finite)
    entries = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))
    return rows.filter(usable).select(*(c for c in rows.columns if c.lower() != "x"), entries.alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x minus the mean, in double precision: the difference is formed in whole numbers before it is divided."""
    return (n * x - sums) / float(n)


def solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a times the inverse of the upper triangular r, by forward substitution over the columns."""
    out = np.empty_like(a)
    for j in range(a.shape[1]):
        out[:, j] = (a[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _sums(fit_list: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and sum of each dimension, in whole numbers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            if len(batch):
                x = matrix(batch.column(0))
                total, n = x.sum(axis=0) + (0 if total is None else total), n + len(x)
        if n:
            place = np.arange(-1, len(total), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.append(n, total))], ["place", "total"])

    parts = fit_list.mapInArrow(add, "place long, total long").groupBy("place").agg(F.sum("total").alias("total"))
    found = {r["place"]: r["total"] for r in parts.collect()}
    return found.pop(-1, 0), np.array([found[k] for k in sorted(found)], np.int64)


def _gram(fit_list: DataFrame, n: int, sums: np.ndarray, factors: list[np.ndarray], project: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrix and column sums of the centred rows after the triangular solves and the projection.

    A task sends one matrix; its entries are added in the shuffle before and after it moves."""
    mean = float(n)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = first = None
        for batch in batches:
            if not len(batch):
                continue
            q = centred(matrix(batch.column(0)), int(mean), sums)
            for r in factors:
                q = solve(q, r)
            q = q if project is None else q @ project
            total = q.T @ q + (0 if total is None else total)
            first = q.sum(axis=0) + (0 if first is None else first)
        if total is not None:
            flat = np.concatenate([first, total[np.triu_indices(len(total))]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["cell", "value"])

    parts = fit_list.mapInArrow(multiply, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    cells = parts.toPandas().sort_values("cell")["value"].to_numpy()
    size = len(sums) if project is None else project.shape[1]
    upper = np.zeros((size, size))
    upper[np.triu_indices(size)] = cells[size:]
    return upper + np.triu(upper, 1).T, cells[:size]


def orthogonalise(fit_list: DataFrame, n: int, sums: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """A matrix R with R'R = A'A for the centred rows A, and the trace of A'A.

    Each round is one pass: the rows go through the triangular solves so far, and the Cholesky factor of their
    Gram matrix is the next one. The first Gram matrix is shifted by the bound on its rounding, which keeps the
    factor safe however ill-conditioned the rows are; later ones are near the identity and only shifted where
    the factorisation breaks down. The last Gram matrix enters as its square root, so directions in which the
    rows do not vary come out as zero.
    """
    size, factors, trace, spread = len(sums), [], 0.0, None
    for k in range(rounds + 1):
        gram, _ = _gram(fit_list, n, sums, factors)
        if not k:
            trace = float(np.trace(gram))
            if trace <= 0:
                return np.zeros((size, size)), 0.0
        if k == rounds or np.abs(gram - np.eye(size)).max() <= ORTHONORMAL * np.sqrt(n):
            values, vectors = np.linalg.eigh(gram)
            spread = (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T
            break
        shift = 11 * (n * size + size * (size + 1)) * np.finfo(float).eps / 2 * float(np.linalg.norm(gram, 2))
        factors.append(_factor(gram, shift, always=not k))
    composed = np.eye(size)
    for r in factors:
        composed = r @ composed
    return spread @ composed, trace


def _factor(gram: np.ndarray, shift: float, always: bool) -> np.ndarray:
    if not always:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Whitening of the distinct usable vectors of `rows`, at most `components` components by falling eigenvalue.

    Copies of a vector are dropped before the shuffle and after it, so a vector that a third of all rows share
    moves once per task. Vectors of different lengths are an error. Components in which the vectors do not vary
    have no whitened value and are left out: a single distinct vector, or no usable row, has none.
    """
    fit_list = written(points(rows, vector).select("x").distinct(), "vectors")
    lengths = fit_list.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if lengths[0] != lengths[1]:
        raise ValueError(f"vectors have {lengths[0]} to {lengths[1]} entries")
    n, sums = _sums(fit_list)
    if not n:
        return Whitening(0, sums, np.zeros((0, 0)), np.zeros(0), 0.0)
    r, trace = orthogonalise(fit_list, n, sums)
    _, sigma, vectors = np.linalg.svd(r)
    kept = np.flatnonzero(sigma > RANK * max(float(sigma[0]), 1e-300))[:components]
    vectors = vectors[kept]
    signs = np.sign(vectors[np.arange(len(kept)), np.abs(vectors).argmax(axis=1)]) if len(kept) else np.ones(0)
    model = Whitening(n, sums, vectors * signs[:, None], sigma[kept] ** 2 / n, trace / n)
    if len(kept):
        gram, first = _gram(fit_list, n, sums, [], (model.components / np.sqrt(model.eigenvalues)[:, None]).T)
        model.identity_error = float(np.abs(gram / n - np.outer(first, first) / n**2 - np.eye(len(kept))).max())
    return model


def squared_deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[Decimal]:
    """Sum over the dimensions of (n * x - sums) ** 2 for each row, exact."""
    apart = n * x - sums
    if apart.size and float(np.abs(apart).max()) ** 2 * apart.shape[1] >= 2.0**62:
        apart = apart.astype(object)
    return [Decimal(int(v)) for v in (apart**2).sum(axis=1)]


def whiten(rows: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, deviation, whitened) per row of `rows` with a usable vector.

    `whitened` holds the projections on the model's components over their standard deviations, `deviation` the
    exact sum of (n * x - sums) ** 2. Rows whose vector is null or empty or holds null or non-finite entries are
    left out; repeated rows and null ids are whitened each. Other columns are not read. An empty table gives
    no rows.
    """
    schema = T.StructType(
        [
            T.StructField("vec_id", rows.schema[vec_id].dataType),
            T.StructField("deviation", T.DecimalType(38, 0)),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = matrix(batch.column(1))
                flat = model.project(x)
                ends = np.arange(len(x) + 1, dtype=np.int32) * flat.shape[1]
                values = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))
                apart = pa.array(squared_deviations(x, model.n, model.sums), pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([batch.column(0), apart, values], schema.names)

    own = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    return points(own, "vector").select("vec_id", "x").mapInArrow(project, schema)


def components_of(rows: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    A deviation that no long holds is null; `whiten` has it in full."""
    shares: Column = F.array(*(F.lit(float(v)) for v in model.explained)) if len(model.explained) else F.array().cast("array<double>")
    one = whiten(rows, model, vec_id, vector).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return one.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
