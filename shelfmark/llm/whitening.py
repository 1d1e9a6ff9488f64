"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

Counts and sums per dimension are exact integers; the scatter is summed per task from centred entries. What reaches the
driver is one row per pair of dimensions, never rows of the table. There the scatter is factored by Cholesky
with diagonal pivots, and plane rotations make the columns of the triangular factor orthogonal. As factor x rotation has
the same product with its transpose, the rotated columns are the eigenvectors, their squared norms the eigenvalues; the
covariance is never diagonalised itself, so small eigenvalues keep their relative accuracy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Components a vector is projected on.
COMPONENTS = 32
# Fixed values of the contract: entries become whole numbers by this scale and offset.
SCALE, OFFSET = 64, 1_000_000
# Scaled entries beyond this size count as this size, so that sums of two halves of an entry stay exact.
LARGEST = 2.0**52
# What is left of a dimension's variance below this share of it is a rounding error: the other pivots explain it.
RANK_SHARE = 1e-13
SWEEPS = 60


def whole_numbers(vector: Column | str) -> Column:
    """Entries as whole numbers ``floor(64 c) + 1000000``; null for vectors that are null or hold null or non-finite entries."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    entries = F.transform(vector, lambda c: c.cast("double"))
    # In the order of doubles NaN is larger than infinity.
    sound = F.forall(entries, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    bounded = lambda c: F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
    return F.when(sound, F.transform(entries, lambda c: F.floor(bounded(c)) + OFFSET))


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """A factor L of ``scatter = L L^T`` with one column for each unit of rank, largest remaining diagonal first.

    Rows are in the order of the dimensions: after the pivots' permutation the factor is lower triangular.
    """
    size = len(scatter)
    rest, factor = scatter.astype(np.float64).copy(), np.zeros((size, size))
    least = rest.diagonal() * RANK_SHARE
    for step in range(size):
        left = np.where(rest.diagonal() > least, rest.diagonal(), 0.0)
        pivot = int(np.argmax(left))
        value = left[pivot]
        if value <= 0:
            return factor[:, :step]
        column = rest[:, pivot] / np.sqrt(value)
        rest -= np.outer(column, column)
        # What a pivot explains is explained to the last bit.
        rest[pivot, :] = rest[:, pivot] = 0.0
        factor[:, step] = column
    return factor


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The factor times a rotation, with orthogonal columns.

    Each round rotates disjoint pairs of columns at once; as many rounds as columns, less one, meet all pairs.
    """
    turned = factor.copy()
    rank = turned.shape[1]
    seats = list(range(rank)) + [-1] * (rank % 2)
    close = np.finfo(np.float64).eps * max(len(factor), 1) ** 0.5
    for _ in range(SWEEPS):
        quiet = True
        for _ in range(max(len(seats) - 1, 0)):
            half = len(seats) // 2
            pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:])) if a >= 0 and b >= 0]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            left, right = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.empty(0, np.int64),) * 2
            a, b = turned[:, left], turned[:, right]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            open_ = np.abs(ab) > close * np.sqrt(aa * bb)
            if not open_.any():
                continue
            quiet = False
            left, right, a, b = left[open_], right[open_], a[:, open_], b[:, open_]
            zeta = (bb[open_] - aa[open_]) / (2 * ab[open_])
            tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cosine = 1 / np.hypot(1.0, tangent)
            sine = cosine * tangent
            turned[:, left], turned[:, right] = cosine * a - sine * b, sine * a + cosine * b
        if quiet:
            break
    return turned


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, as many as the rank; the largest entry of each is positive."""
    turned = one_sided_jacobi(pivoted_cholesky(covariance))
    norms = np.sqrt((turned * turned).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    vectors = turned[:, order] / norms[order]
    if vectors.size:
        heads = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
        vectors = vectors * np.where(heads < 0, -1.0, 1.0)
    return norms[order] ** 2, vectors


@dataclass(frozen=True)
class Whitener:
    """A fitted transform: ``n`` vectors with the given sums, and what whitens them."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S/n``: an exact difference with the whole part of the mean, less the rest of it."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of ``(n x - S)^2`` of each row, exact; None where it does not fit 64 bits."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        apart = x - whole
        reach = (int(np.abs(apart).max(initial=0)) + 1) * self.n
        if reach * reach * max(len(self.sums), 1) < 1 << 63:
            return ((apart * self.n - rest) ** 2).sum(axis=1).tolist()
        exact = [sum((int(v) * self.n - int(r)) ** 2 for v, r in zip(row, rest)) for row in apart]
        return [d if d < 1 << 63 else None for d in exact]


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.int64) if len(vectors) else np.empty((0, 0), np.int64)


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per length and dimension: vectors and sums of the high and the low 32 bits of the entries, exact."""
    totals: dict[int, list] = {}
    for frame in batches:
        for size, rows in frame.groupby(frame["x"].map(len))["x"]:
            x = _matrix(rows)
            own = totals.setdefault(size, [0, np.zeros(size, np.int64), np.zeros(size, np.int64)])
            own[0] += len(x)
            own[1] += (x >> 32).sum(axis=0)
            own[2] += (x & 0xFFFFFFFF).sum(axis=0)
    for size, (n, high, low) in totals.items():
        yield pd.DataFrame({"size": size, "dim": np.arange(max(size, 1)), "n": n,
                            "high": high if size else [0], "low": low if size else [0]})


def _scatter_of(rows_of):
    """Sum of products of each pair of dimensions of what ``rows_of`` makes of the entries."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in batches:
            if len(frame):
                rows = rows_of(_matrix(frame["x"]))
                total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None and len(total):
            i, j = np.indices(total.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "part": total.ravel()})

    return run


def _gathered(rows: DataFrame, rows_of, size: int, n: int) -> np.ndarray:
    """The covariance of what ``rows_of`` makes of all rows, which must be centred: a row per pair of dimensions."""
    parts = rows.select("x").mapInPandas(_scatter_of(rows_of), "i int, j int, part double")
    out = np.zeros((size, size))
    for row in parts.groupBy("i", "j").agg(F.sum("part").alias("part")).collect():
        out[row.i, row.j] = row.part
    return out / n


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows with ``x``, the vector as whole numbers; rows without such a vector are left out."""
    return vectors.withColumn("x", whole_numbers(vector)).where("x is not null")


def fit(rows: DataFrame) -> Whitener | None:
    """Fit over all rows ``x``; None where there is nothing to fit.

    The dimension is the length most vectors have, the larger of equally frequent ones.
    """
    # The rows that come back are one per length and dimension.
    found: dict[int, dict[int, tuple[int, int]]] = {}
    wide = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")]
    for r in rows.select("x").mapInPandas(_sums, "size int, dim int, n long, high long, low long").groupBy("size", "dim").agg(
        F.sum("n").alias("n"), *wide
    ).collect():
        found.setdefault(r["size"], {})[r["dim"]] = (r["n"], (int(r["high"]) << 32) + int(r["low"]))
    if not found:
        return None
    size = max(found, key=lambda s: (found[s][0][0], s))
    n = found[size][0][0]
    sums = tuple(found[size][d][1] for d in range(size))
    plain = Whitener(n, sums, np.ones(0), np.ones((size, 0)), 0.0)
    covariance = _gathered(rows.where(F.size("x") == size), plain.centred, size, n)
    values, vectors = eigen(covariance)
    return Whitener(n, sums, values, vectors, float(covariance.trace()))


def whiten(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component, components numbered from 1 by falling eigenvalue.

    Columns: ``(ident, component, n, deviation, whitened, explained, identity_error)``. Vectors that are null or hold null or
    non-finite entries are left out, as are those of another length than most have. Repeated rows and ids stay and
    count as often as they come. Scaled entries beyond 2^52 count as 2^52. ``deviation`` is null where it does not fit 64
    bits. Components without any variance are left out, so equal vectors alone, or a single one, give no
    row; an empty table neither. Other columns are ignored. ``identity_error`` is measured over all rows.
    """
    rows = usable(vectors.select(F.col(ident), F.col(vector).alias("_v")), "_v").select(ident, "x")
    model = fit(rows)
    if model is None:
        rows, kept, error = rows.limit(0), np.ones(0), 0.0
    else:
        rows = rows.where(F.size("x") == len(model.sums))
        model = Whitener(
            model.n, model.sums, model.values[:components], model.vectors[:, :components], model.trace
        )
        kept = model.values / model.trace if len(model.values) else model.values
        # Whitened rows are a linear image of centred ones, so they are centred themselves.
        error = 0.0
        if len(kept):
            covariance = _gathered(rows, model.whitened, len(kept), model.n)
            error = float(np.abs(covariance - np.eye(len(kept))).max())

    @F.pandas_udf("deviation long, whitened array<double>")
    def project(x: pd.Series) -> pd.DataFrame:
        entries = _matrix(x)
        return pd.DataFrame({"deviation": pd.array(model.deviations(entries), "Int64"), "whitened": list(model.whitened(entries))})

    projected = rows.select(ident, project("x").alias("p")).select(ident, "p.deviation", "p.whitened")
    explained = F.array(*[F.lit(float(e)) for e in kept]).cast("array<double>")
    each = projected.select(ident, "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return each.select(
        ident, (F.col("_at") + 1).cast("int").alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation", "whitened", F.get(explained, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
