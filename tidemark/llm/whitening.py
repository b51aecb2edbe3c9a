"""Whitening of embeddings by principal components, found by spectral divide and conquer.

Entries are counted in steps of 1/1024, so sums and the sums of products around the rounded mean are whole
numbers, exact in any order of tasks. From them comes the covariance, a matrix as large as a vector is
long. The polar factor of the covariance less a shift is the sign of what lies above and below the shift:
it gives the projectors on two invariant subspaces, each of which is split again until components stand
alone. The polar factor is found by QDWH, a rational iteration with weights that follow the least
singular value. The components then go to the tasks, which whiten the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps of an entry, and what is added to their number.
STEPS, OFFSET = 1024, 100_000
#: Vectors with an entry of this size or more, which whole numbers of double precision don't hold, are dropped.
LIMIT = float(1 << 42)

EPS = float(np.finfo(float).eps)


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of the polar decomposition of symmetric ``a``, by QDWH with QR steps."""
    n = len(a)
    size = np.linalg.norm(a)
    if size == 0:
        return np.eye(n)
    x, low = a / size, EPS
    for _ in range(30):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        p = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        both = np.linalg.qr(np.vstack([np.sqrt(r) * x, np.eye(n)]))[0]
        new = q / r * x + (p - q / r) / np.sqrt(r) * both[:n] @ both[n:].T
        new = (new + new.T) / 2
        change = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (p + q * square) / (1 + r * square))
        if 1 - low < 10 * EPS and change < np.cbrt(EPS):
            break
    return x


def _halves(a: np.ndarray, shift: float) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis, the first columns of which span what lies above ``shift``, and their number."""
    n = len(a)
    projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
    above = round(float(np.trace(projector)))
    if not 0 < above < n:
        return None
    start = np.random.default_rng(n).standard_normal((n, above))
    for _ in range(3):
        basis = np.linalg.qr(projector @ start, mode="complete")[0]
        start = basis[:, :above]
    left = np.linalg.norm(basis[:, above:].T @ a @ start)
    return (basis, above) if left <= 100 * n * EPS * np.linalg.norm(a) else None


def principal_components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of symmetric ``a`` in falling order, and unit eigenvectors as columns."""
    n = len(a)
    whole = np.linalg.norm(a)
    vectors, values = np.eye(n), np.zeros(n)
    todo = [(0, n, a)]
    while todo:
        at, size, part = todo.pop()
        diagonal = np.diag(part)
        # Apart from rounding the block is diagonal: each of its directions is a component.
        if size == 1 or np.linalg.norm(part - np.diag(diagonal)) <= EPS * whole:
            values[at : at + size] = diagonal
            continue
        # The mean of the eigenvalues always lies between the least and the greatest of them.
        shifts = (float(np.median(diagonal)), float(np.mean(diagonal)), float((diagonal.max() + diagonal.min()) / 2))
        split = next((s for s in (_halves(part, shift) for shift in shifts) if s), None)
        if split is None:
            # No gap that rounding leaves: the block is one value, up to what Jacobi rotations still set right.
            turned, diagonal = _rotated(part)
            vectors[:, at : at + size] = vectors[:, at : at + size] @ turned
            values[at : at + size] = diagonal
            continue
        basis, above = split
        vectors[:, at : at + size] = vectors[:, at : at + size] @ basis
        turned = basis.T @ part @ basis
        turned = (turned + turned.T) / 2
        todo += [(at, above, turned[:above, :above]), (at + above, size - above, turned[above:, above:])]
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _rotated(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, n = a.copy(), len(a)
    turned = np.eye(n)
    for _ in range(30):
        if np.linalg.norm(a - np.diag(np.diag(a))) <= EPS * np.linalg.norm(a):
            break
        for i in range(n):
            for j in range(i + 1, n):
                angle = np.arctan2(2 * a[i, j], a[j, j] - a[i, i]) / 2
                c, s = np.cos(angle), np.sin(angle)
                g = np.array([[c, s], [-s, c]])
                a[:, [i, j]] = a[:, [i, j]] @ g
                a[[i, j]] = g.T @ a[[i, j]]
                turned[:, [i, j]] = turned[:, [i, j]] @ g
    return turned, np.diag(a)


@dataclass(frozen=True)
class Whitening:
    """What the tasks need: as many numbers as some vectors have."""

    n: int
    middle: np.ndarray  # the mean in steps, rounded to whole numbers
    rest: list[int]  # n times what the rounding took
    values: np.ndarray
    components: np.ndarray  # a column each
    trace: float

    def directions(self) -> np.ndarray:
        """Components over the roots of their values; none where the rows do not vary."""
        varied = self.values > len(self.middle) * EPS * self.values.max(initial=0.0)
        return np.where(varied, self.components / np.sqrt(np.where(varied, self.values, 1.0)), 0.0)

    def whitened(self, steps: np.ndarray) -> np.ndarray:
        centred = (steps - self.middle) - np.array([r / self.n for r in self.rest])
        return centred @ self.directions()

    def deviations(self, steps: np.ndarray) -> list[int | None]:
        """The exact squared length of n times the centred row; None beyond 64 bits."""
        y = (steps - self.middle).astype(np.int64)
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.rest))
        if most * most * y.shape[1] < 1 << 63:
            return ((self.n * y - np.array(self.rest)) ** 2).sum(axis=1).tolist()
        roughly = ((y - np.array([r / self.n for r in self.rest])) ** 2).sum(axis=1) * float(self.n) ** 2
        exact = [sum((self.n * v - r) ** 2 for v, r in zip(row, self.rest)) if near < 1e19 else 1 << 63 for row, near in zip(y.tolist(), roughly)]
        return [v if v < 1 << 63 else None for v in exact]


def _complete(vector: str) -> Column:
    # NaN is greater than any number, so it fails this too.
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < LIMIT))


def _steps(batch: pa.RecordBatch, at: int, length: int) -> np.ndarray:
    values = batch.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values.reshape(-1, length) * STEPS) + OFFSET


def _sums(rows: DataFrame, vector: str, length: int, middle: np.ndarray | None) -> DataFrame:
    """``i, j, s``: exact sums of entries (``j`` null), or of products of centred entries for ``i <= j``."""
    columns = np.triu_indices(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _steps(batch, 0, length)
            if middle is None:
                whole = x.astype(np.int64)
                small = np.abs(x).max(initial=0.0) * len(x) < 2.0**62
                part = (whole if small else whole.astype(object)).sum(axis=0).astype(object)
            else:
                y = x - middle
                most = float(np.abs(y).max(initial=0.0))
                # Products of doubles are exact as long as their sums stay below 2^53; else whole numbers of any size.
                part = (y.T @ y).astype(np.int64).astype(object) if most * most * len(y) < 2.0**53 else None
                if part is None:
                    whole = y.astype(np.int64).astype(object)
                    part = whole.T @ whole
            total = part if total is None else total + part
        if total is None:
            return
        if middle is None:
            i, j, s = np.arange(length), None, total
        else:
            i, j, s = columns[0], pa.array(columns[1], pa.int32()), total[columns]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(i, pa.int32()),
                pa.nulls(length, pa.int32()) if j is None else j,
                pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0)),
            ],
            ["i", "j", "s"],
        )

    return rows.select(vector).mapInArrow(run, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s"))


def whitening_rows(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """The rows that are whitened, and the length of their vectors.

    Rows without a vector, with an empty one or with null, non-finite or huge entries (see ``LIMIT``) go, and
    those whose length is not the commonest one (of equally common ones the greatest). Without rows
    the length is 0.
    """
    size = F.size(vector)
    rows = vectors.filter(_complete(vector) & (size > 0))
    top = rows.groupBy(size.alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    length = top["size"] if top else 0
    return rows.filter(size == length), length


def fit_whitening(rows: DataFrame, length: int, components: int = 8, vector: str = "embedding") -> Whitening:
    """Mean and first components of ``rows``; two passes, of which only sums reach the driver: as many as a
    vector has entries, and as its covariance has."""
    n = rows.count()
    found = {r["i"]: int(r["s"]) for r in _sums(rows, vector, length, None).collect()}
    total = [found[i] for i in range(length)]
    middle = [(2 * t + n) // (2 * n) for t in total]
    rest = [t - n * m for t, m in zip(total, middle)]
    covariance = np.zeros((length, length))
    for r in _sums(rows, vector, length, np.array(middle, dtype=np.float64)).collect():
        i, j = r["i"], r["j"]
        # Whole numbers divided once: correctly rounded.
        covariance[i, j] = covariance[j, i] = (n * int(r["s"]) - rest[i] * rest[j]) / (n * n)
    values, directions = principal_components(covariance)
    k = min(components, length)
    return Whitening(n, np.array(middle, dtype=np.float64), rest, np.maximum(values[:k], 0.0), directions[:, :k], float(np.trace(covariance)))


def identity_error(rows: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """The largest entry of the covariance of the whitened rows less the identity, measured on the rows.
    Components in which the rows do not vary are left out."""
    length, k = len(model.middle), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = model.whitened(_steps(batch, 0, length))
            total += z.sum(axis=0)
            products += z.T @ z
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, np.arange(k)), pa.int32()), pa.array(np.append(j, np.full(k, -1)), pa.int32()), pa.array(np.append(products.ravel(), total))],
            ["i", "j", "s"],
        )

    mean, second = np.zeros(k), np.zeros((k, k))
    for r in rows.select(vector).mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        if r["j"] < 0:
            mean[r["i"]] = r["s"] / model.n
        else:
            second[r["i"], r["j"]] = r["s"] / model.n
    varied = model.directions().any(axis=0)
    # The whitened rows are centred already; what rounding leaves of their mean is taken off.
    wrong = (second - np.outer(mean, mean) - np.eye(k))[varied][:, varied]
    return float(np.abs(wrong).max(initial=0.0))


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row and component.

    Rows that ``whitening_rows`` leaves out give none; rows with one key, or without, are rows of their
    own; other columns are ignored; an empty table gives no rows. Components are counted from 1 by
    falling variance, as many as asked for or as a vector has entries. Where rows do not vary in a
    component, ``whitened`` is 0. ``deviation`` is null where it needs more than 64 bits.
    """
    kind = vectors.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, length = whitening_rows(vectors, vector)
    if not length:
        return vectors.sparkSession.createDataFrame([], schema)
    model = fit_whitening(rows, length, components, vector)
    error = identity_error(rows, model, vector)
    k = len(model.values)
    explained = model.values / model.trace if model.trace > 0 else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _steps(batch, 1, length)
            m = len(x)
            owner = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(owner),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(owner),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select(vec_id, vector).mapInArrow(run, schema)
