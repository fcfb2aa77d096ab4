"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor.

Vectors become integers first, so every sum over them is exact and the same
whatever the number of tasks. Each different vector counts once. Two passes
over these make the sums and then, centred before multiplying, the scatter; a
task hands on one row per pair of dimensions. Only what grows with the
dimension, never with the rows, reaches the driver: the sums and the scatter.
There ``scatter = P' L L' P`` by Cholesky with the largest pivot first, and
Jacobi rotations make the columns of L orthogonal: their squared norms are the
eigenvalues, the normalised columns the components. Small eigenvalues keep
their relative accuracy, as L is rotated and never squared again.

Defined results: a vector that is null or empty, or has a null or non-finite
entry, or one whose scaled value does not fit a 64-bit integer, gives no rows;
a row without an id is a row like others, and so are repeated ones; vectors of
different lengths are whitened apart, each length by its own different
vectors; dimensions without variance, and what is below ``least_share`` of the
largest eigenvalue, are no components, so one different vector alone has none;
``deviation`` is null where it does not fit a long. Equal eigenvalues may
share their plane in any way. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlens.llm.common import written

WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_PARTIAL = "dim int, i int, j int, digit int, value long"


@dataclass(frozen=True)
class WhitenParams:
    """``least_share`` is the least eigenvalue of a component, relative to the largest.

    ``model_bytes`` bounds the statistics that are held at once where vectors
    come in many lengths; every length is done whatever it is.
    """

    components: int = 16
    scale: int = 64
    shift: int = 1_000_000
    least_share: float = 1e-12
    model_bytes: int = 1 << 28


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists of one length, none of them null, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def by_length(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, pa.ListArray]]:
    """The lists of a column by their length: the length, the places, the lists."""
    lengths = np.diff(column.offsets.to_numpy())
    for width in np.unique(lengths):
        places = np.nonzero(lengths == width)[0]
        yield int(width), places, column.take(pa.array(places))


def _integers(scale: int, shift: int) -> Callable:
    """Rows (vec_id, x): the scaled integers of vectors that have a value in every entry."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.columns
            for width, places, lists in by_length(vectors):
                flat = lists.flatten()
                if not width:
                    continue
                values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(places), width)
                missing = np.asarray(flat.is_null()).reshape(values.shape)
                with np.errstate(invalid="ignore", over="ignore"):
                    x = np.floor(scale * values)
                    good = (np.isfinite(values) & ~missing & (np.abs(x) < 2.0**62)).all(axis=1)
                kept = x[good].astype(np.int64) + shift
                lists = pa.ListArray.from_arrays(np.arange(0, kept.size + 1, width, dtype=np.int32), pa.array(kept.ravel()))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(places[good])), lists], names=["vec_id", "x"])

    return convert


def integer_vectors(embeddings: DataFrame, p: WhitenParams = WhitenParams()) -> DataFrame:
    rows = embeddings.filter("embedding is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    return rows.mapInArrow(_integers(p.scale, p.shift), "vec_id long, x array<long>")


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y in integers: in double precision where no sum can exceed 2^53, else in Python's integers."""
    most = int(np.abs(y).max(initial=0))
    if most >= 1 << 24:
        big = y.astype(object)
        return big.T @ big
    rows = max(1, (1 << 53) // max(1, most * most))
    total = np.zeros((y.shape[1],) * 2, object)
    for start in range(0, len(y), rows):
        part = y[start : start + rows].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64)
    return total


def _rows_of(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Exact integers by length and place, in digits of 32 bits whose sums fit a long; the last digit has the sign."""
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    for dim, values in sums.items():
        for i, row in enumerate(values):
            # a scatter is symmetric: its upper half is enough
            first = i if values.shape[0] == values.shape[1] else 0
            left, digit = [int(v) for v in row[first:]], 0
            while digit == 0 or any(left):
                last = all(-(1 << 31) <= v < 1 << 31 for v in left)
                part = left if last else [v & 0xFFFFFFFF for v in left]
                columns = [[dim] * len(part), [i] * len(part), range(first, len(row)), [digit] * len(part), part]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["dim", "i", "j", "digit", "value"])
                left, digit = [] if last else [v >> 32 for v in left], digit + 1


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length one row of sums with the number of vectors behind them."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for width, places, lists in by_length(batch.column(0)):
            x = matrix(lists, width)
            small = np.abs(x).max() < 1 << 40
            total = np.append((x if small else x.astype(object)).sum(axis=0).astype(object), len(places))
            sums[width] = sums.get(width, 0) + total
    yield from _rows_of({dim: total.reshape(1, -1) for dim, total in sums.items()})


def _scatter(centres: dict[int, np.ndarray]) -> Callable:
    """Per length the products of the vectors less their whole-number centre, with a last row and column of ones."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, places, lists in by_length(batch.column(0)):
                y = matrix(lists, width) - centres[width]
                sums[width] = sums.get(width, 0) + exact_products(np.hstack([y, np.ones((len(places), 1), np.int64)]))
        yield from _rows_of(sums)

    return scatter


def totals(partials: DataFrame) -> dict[int, dict[tuple[int, int], int]]:
    """Exact sums of partial rows by length and place; as many as a scatter has entries, whatever the table's size."""
    summed = partials.groupBy("dim", "i", "j", "digit").agg(F.sum("value").alias("value"))
    out: dict[int, dict[tuple[int, int], int]] = {}
    for dim, i, j, digit, value in summed.collect():
        places = out.setdefault(dim, {})
        places[i, j] = places.get((i, j), 0) + (value << (32 * digit))
    return out


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pivots and L with ``v[order][:, order] = L L'``; as many columns as there are pivots above rounding."""
    v = v.copy()
    d = len(v)
    order, factor = np.arange(d), np.zeros((d, d))
    most = np.diag(v).max(initial=0.0)
    for k in range(d):
        at = k + int(np.argmax(np.diag(v)[k:]))
        if v[at, at] <= d * np.finfo(float).eps * most:
            return order, factor[:, :k]
        for a in (v, factor):
            a[[k, at]] = a[[at, k]]
        v[:, [k, at]] = v[:, [at, k]]
        order[[k, at]] = order[[at, k]]
        factor[k, k] = np.sqrt(v[k, k])
        factor[k + 1 :, k] = v[k + 1 :, k] / factor[k, k]
        v[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return order, factor


def jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Rotate the columns pairwise until they are orthogonal; a round turns disjoint pairs at once."""
    a = factor.copy()
    n = a.shape[1]
    ring = list(range(n + n % 2))  # the last one is a pause where n is odd
    done = np.finfo(float).eps * np.sqrt(max(1, len(a)))
    for _ in range(sweeps):
        largest = 0.0
        for _ in range(len(ring) - 1):
            pairs = [(p, q) for p, q in zip(ring[: len(ring) // 2], reversed(ring[len(ring) // 2 :])) if max(p, q) < n]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            p, q = np.array(pairs, int).reshape(-1, 2).T
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            norm = np.sqrt(xx * yy)
            cosine = np.divide(np.abs(xy), norm, out=np.zeros_like(xy), where=norm > 0)
            largest = max(largest, float(cosine.max(initial=0.0)))
            turn = cosine > done
            tau = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
            t = np.where(turn, np.where(tau >= 0, 1.0, -1.0) / (np.abs(tau) + np.hypot(1.0, tau)), 0.0)
            c = 1 / np.hypot(1.0, t)
            a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
        if largest <= done:
            break
    return a


def components(v: np.ndarray, p: WhitenParams = WhitenParams()) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a covariance, falling, and their unit eigenvectors as columns; the largest entry is positive."""
    order, factor = pivoted_cholesky(v)
    if not factor.shape[1]:
        return np.zeros(0), np.zeros((len(v), 0))
    turned = jacobi(factor)
    norms = np.sqrt((turned * turned).sum(axis=0))
    by_size = np.argsort(-norms, kind="stable")[: p.components]
    by_size = by_size[norms[by_size] ** 2 > p.least_share * norms.max() ** 2]
    vectors = np.zeros((len(v), len(by_size)))
    vectors[order] = turned[:, by_size] / norms[by_size]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(by_size))])
    return norms[by_size] ** 2, vectors * signs


@dataclass
class Model:
    """What one length of vectors is whitened by."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, in whole numbers as long as they fit."""
        if self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums)) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        most = int(np.abs(centred).max(initial=0))
        if most * most * centred.shape[1] < 1 << 63:
            return (centred * centred).sum(axis=1).tolist()
        squares = (centred.astype(object) ** 2).sum(axis=1)
        return [int(s) if s < 1 << 63 else None for s in squares]


def model_of(n: int, sums: list[int], centre: np.ndarray, entries: dict[tuple[int, int], int], p: WhitenParams) -> Model:
    """Eigenvalues and vectors of the exact covariance, which is rounded once."""
    d = len(sums)
    off = [entries[i, d] for i in range(d)]  # sums less n times the centre
    v = np.empty((d, d))
    for i in range(d):
        for j in range(i, d):
            v[i, j] = v[j, i] = (n * entries[i, j] - off[i] * off[j]) / (n * n)
    values, vectors = components(v, p)
    return Model(n, sums, values, vectors, float(np.trace(v)))


def _whitened_products(models: dict[int, Model]) -> Callable:
    """Per length and task the sums and products of the whitened vectors, as one row of bytes."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, places, lists in by_length(batch.column(0)):
                w = models[width].whiten(models[width].centred(matrix(lists, width)))
                w = np.hstack([w, np.ones((len(places), 1))])
                sums[width] = sums.get(width, 0) + w.T @ w
        for width, total in sums.items():
            k = len(total)
            columns = [np.full(k * k, width, np.int32), np.repeat(np.arange(k), k).astype(np.int32)]
            columns += [np.tile(np.arange(k), k).astype(np.int32), total.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["dim", "i", "j", "total"])

    return products


def fit(vectors: DataFrame, dims: list[int], ns: dict[int, int], sums: dict[int, list[int]], p: WhitenParams) -> dict[int, Model]:
    """Models of some lengths from the different vectors ``vectors`` (x)."""
    some = vectors.filter(F.size("x").isin(dims))
    centres = {d: np.array([round(s / ns[d]) for s in sums[d]], np.int64) for d in dims}
    entries = totals(some.mapInArrow(_scatter(centres), _PARTIAL))
    models = {d: model_of(ns[d], sums[d], centres[d], entries[d], p) for d in dims}
    added = some.mapInArrow(_whitened_products(models), "dim int, i int, j int, total double").groupBy("dim", "i", "j")
    grams: dict[int, dict[tuple[int, int], float]] = {}
    for dim, i, j, total in added.agg(F.sum("total").alias("total")).collect():
        grams.setdefault(dim, {})[i, j] = total
    for dim, model in models.items():
        k = len(model.values)
        means = [grams[dim][i, k] / model.n for i in range(k)]
        model.identity_error = max(
            (abs(grams[dim][i, j] / model.n - means[i] * means[j] - (i == j)) for i in range(k) for j in range(k)), default=0.0
        )
    return models


def _project(models: dict[int, Model]) -> Callable:
    schema = pa.schema(
        [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64())]
        + [(name, pa.float64()) for name in ("whitened", "explained", "identity_error")]
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.columns
            for width, places, lists in by_length(vectors):
                model = models[width]
                k, m = len(model.values), len(places)
                if not k:
                    continue
                centred = model.centred(matrix(lists, width))
                columns = [
                    ids.take(pa.array(np.repeat(places, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    pa.array([v for v in model.deviations(centred) for _ in range(k)], pa.int64()),
                    pa.array(model.whiten(centred).ravel()),
                    pa.array(np.tile(model.values / model.trace, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return project


def in_lots(dims: list[int], most_bytes: int) -> Iterator[list[int]]:
    """Lengths whose scatters fit into ``most_bytes`` together; one that alone does not is a lot of its own."""
    lot: list[int] = []
    for dim in dims:
        if lot and 8 * sum((d + 1) ** 2 for d in [*lot, dim]) > most_bytes:
            yield lot
            lot = []
        lot.append(dim)
    if lot:
        yield lot


def whitened(embeddings: DataFrame, p: WhitenParams = WhitenParams()) -> DataFrame:
    """The registered query: rows (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    rows = integer_vectors(embeddings, p)
    # copies go before the shuffle too
    distinct = written(rows.select("x").distinct(), "whiten-vectors")
    summed = totals(distinct.mapInArrow(_sums, _PARTIAL))
    ns = {dim: places[0, dim] for dim, places in summed.items()}
    sums = {dim: [places[0, i] for i in range(dim)] for dim, places in summed.items()}
    out = embeddings.sparkSession.createDataFrame([], WHITENED)
    for dims in in_lots(sorted(ns), p.model_bytes):
        models = fit(distinct, dims, ns, sums, p)
        out = out.unionByName(rows.filter(F.size("x").isin(dims)).mapInArrow(_project(models), WHITENED))
    return out
