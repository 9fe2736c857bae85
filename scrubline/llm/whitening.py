"""Whitening of embeddings by an incremental eigendecomposition.

Every partition keeps the eigenvalues and eigenvectors of the scatter of the rows it has read and applies centred rank-one
updates to them: the new eigenvalues are the roots of a secular equation, and directions that an update does not turn are
deflated (Bunch, Nielsen and Sorensen, 1978; Gu and Eisenstat, 1994, for eigenvectors that stay orthogonal). A block of more
rows than dimensions is first reduced to its triangular factor, whose rows have the same scatter, so a block costs as
many updates as there are dimensions. Spectra of partitions are combined by more updates: one per eigenvector, and one for
the difference of the means. They meet in groups of bounded size, round by round, never all in one task.

What rounding left is removed by a Rayleigh-Ritz step over all rows: the covariance in the basis found is summed by
partitions, centred before multiplying, and its small eigenproblem turns the basis. Only sums leave the tasks: one square
matrix of the dimension per partition.
"""

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.common import arrow_map, cut

# An entry c counts as floor(1024 c) + 100000.
SCALE, OFFSET = 1024, 100_000
# Larger entries fit no long once scaled.
_LARGEST = float(1 << 52)
_EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Whitening:
    """Components returned, rows of a block, the most bytes of spectra that one combining task holds, and the share of the
    trace under which a component counts as empty."""

    components: int = 8
    block_rows: int = 4096
    group_bytes: int = 64 << 20
    empty: float = 1e-12


def rank_one(values: np.ndarray, vectors: np.ndarray, update: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of ``vectors diag(values) vectors' + update update'``."""
    z = vectors.T @ update
    norm = float(np.sqrt(z @ z))
    if norm == 0:
        return values, vectors
    tiny = 8 * _EPS * max(float(values[-1]), norm * norm)
    live = np.flatnonzero(np.abs(z) * norm > tiny)
    merged = _deflated(values, vectors, z, live, tiny)
    if merged is not None:
        vectors, z, live = merged
    if not len(live):
        return values, vectors
    roots, turn = _secular(values[live], z[live])
    values, vectors = values.copy(), vectors.copy()
    values[live], vectors[:, live] = roots, vectors[:, live] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _deflated(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, live: np.ndarray, tiny: float):
    """Rotates pairs of (nearly) equal eigenvalues so that one of the two is left out; None if there is no such pair."""
    d, w = values[live], z[live]
    length = np.hypot(w[1:], w[:-1])
    if not (np.abs((d[1:] - d[:-1]) * w[1:] * w[:-1]) <= tiny * length * length).any():
        return None
    vectors, z, kept = vectors.copy(), z.copy(), [int(live[0])]
    for j in map(int, live[1:]):
        i = kept[-1]
        r = float(np.hypot(z[i], z[j]))
        c, s = z[j] / r, z[i] / r
        if abs((values[j] - values[i]) * c * s) <= tiny:
            vectors[:, i], vectors[:, j] = c * vectors[:, i] - s * vectors[:, j], s * vectors[:, i] + c * vectors[:, j]
            z[i], z[j] = 0.0, r
            kept[-1] = j
        else:
            kept.append(j)
    return vectors, z, np.array(kept)


def _secular(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum z^2 / (d - x) = 0 for ascending, distinct d, and the eigenvectors of diag(d) + zz'.

    Each root is found as its distance from the nearer pole, so that differences to the poles keep all their digits.
    """
    k, squares = len(d), z * z
    right = np.append(d[1:], d[-1] + squares.sum())
    gap = right - d
    middle = 1 + (squares / (d - (d + gap / 2)[:, None])).sum(axis=1)
    from_right = middle < 0
    from_right[-1] = False
    origin = np.where(from_right, np.arange(k) + 1, np.arange(k))
    poles = d - d[origin][:, None]  # row: root, column: pole
    left_pole, right_pole = d - d[origin], right - d[origin]
    low = np.where(from_right, -gap / 2, 0.0)
    high = np.where(from_right, 0.0, gap / 2)
    high[-1] = gap[-1]
    if middle[-1] < 0:
        low[-1] = gap[-1] / 2
    x = (low + high) / 2
    below = np.tril(np.ones((k, k), dtype=bool))  # poles at or under the root
    with np.errstate(all="ignore"):
        for _ in range(100):
            away = poles - x[:, None]
            terms = squares / away
            value = 1 + terms.sum(axis=1)
            slopes = terms / away
            low, high = np.where(value < 0, x, low), np.where(value >= 0, x, high)
            # The poles left and right of the root as two poles with the same slopes.
            slope_left = np.where(below, slopes, 0.0).sum(axis=1)
            slope_right = slopes.sum(axis=1) - slope_left
            p, q = left_pole - x, right_pole - x
            a, b = slope_left * p * p, slope_right * q * q
            c = value - slope_left * p - slope_right * q
            half = (c * (p + q) + a + b) / 2
            rest = c * p * q + a * q + b * p
            root = np.sqrt(np.maximum(half * half - c * rest, 0))
            step = np.where(half >= 0, rest / (half + root), (half - root) / c)
            step[-1] = p[-1] + a[-1] / c[-1]
            new = x + step
            outside = ~((new > low) & (new < high))
            new = np.where(outside, (low + high) / 2, new)
            # Nothing is left but the rounding of the sum itself.
            settled = (np.abs(value) <= 2 * _EPS * (1 + np.abs(terms).sum(axis=1))) | (np.abs(new - x) <= 2 * _EPS * np.abs(new))
            x = np.where(settled, x, new)
            if settled.all():
                break
        away = poles - x[:, None]
        away = np.where(away == 0, np.finfo(float).tiny, away)
        # The update whose exact eigenvalues these roots are, product by product.
        rows = np.arange(k)
        others = np.where(rows[:, None] < rows, d[:, None] - d, right[:, None] - d)
        others[-1] = 1.0
        ratio = -away / np.where(others == 0, 1.0, others)
        fitted = np.copysign(np.sqrt(np.abs(np.prod(ratio, axis=0))), z)
        turn = (fitted / away).T
    return d[origin] + x, turn / np.sqrt((turn * turn).sum(axis=0))


@dataclass
class Spectrum:
    """Rows, exact sums per dimension, and the eigenvalues (ascending) and eigenvectors of the rows' centred scatter."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> "Spectrum":
        return cls(0, [0] * dims, np.zeros(dims), np.eye(dims))

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def add(self, update: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, update)

    def _joined(self, n: int, sums: list[int]) -> None:
        """Counts rows with these sums, and adds the scatter that the difference of the two means makes."""
        if self.n and n:
            # (mean - mean) of exact sums: the difference is rounded once.
            apart = np.array([(b * self.n - a * n) / (self.n * n) for a, b in zip(self.sums, sums)])
            self.add(apart * np.sqrt(self.n * n / (self.n + n)))
        self.n, self.sums = self.n + n, [a + b for a, b in zip(self.sums, sums)]

    def add_rows(self, rows: np.ndarray) -> None:
        """``rows`` holds whole numbers."""
        if not len(rows):
            return
        sums = exact_sums(rows)
        centred = rows - np.array([s / len(rows) for s in sums])
        if len(rows) > rows.shape[1]:
            centred = np.linalg.qr(centred, mode="r")
        for row in centred:
            self.add(row)
        self._joined(len(rows), sums)

    def add_spectrum(self, other: "Spectrum") -> None:
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.add(np.sqrt(value) * vector)
        self._joined(other.n, other.sums)


def exact_sums(rows: np.ndarray) -> list[int]:
    if np.abs(rows).max(initial=0) * len(rows) < 1 << 62:
        return [int(s) for s in rows.astype(np.int64).sum(axis=0)]
    return [sum(int(x) for x in column) for column in rows.T]


def _whole(column: pa.Array, dims: int) -> np.ndarray:
    """floor(1024 c) of arrays of ``dims`` finite numbers, as doubles."""
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))


def _blocks(batches: Iterator[pa.RecordBatch], column: int, dims: int, rows: int) -> Iterator[np.ndarray]:
    held: list[np.ndarray] = []
    for batch in batches:
        made = _whole(batch.column(column), dims)
        for at in range(0, len(made), rows):
            held.append(made[at : at + rows])
            if sum(map(len, held)) >= rows:
                yield np.concatenate(held)
                held = []
    if held:
        yield np.concatenate(held)


def fit_list(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, embedding) of the vectors that remain, and their dimension, 0 if there are none.

    Vectors go that are null or empty or hold a null or non-finite entry or one that no long holds once scaled; where lengths
    differ, those of the most frequent length remain (the greater of two as frequent).
    """
    fits = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(_LARGEST), F.lit(False)))
    typed = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    good = typed.filter(F.size("embedding") > 0).filter(fits)
    most = good.groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = most["dims"] if most else 0
    return good.filter(F.size("embedding") == dims), dims


_SPECTRUM = "part int, n bigint, sums array<decimal(38,0)>, vals array<double>, vectors array<double>"
_SUMS = "part int, vals array<double>"


def _spectrum_row(part: int, s: Spectrum) -> pa.RecordBatch:
    columns = [
        pa.array([part], pa.int32()),
        pa.array([s.n], pa.int64()),
        pa.array([[Decimal(x) for x in s.sums]], pa.list_(pa.decimal128(38, 0))),
        pa.array([s.values.tolist()], pa.list_(pa.float64())),
        pa.array([s.vectors.ravel()], pa.list_(pa.float64())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "n", "sums", "vals", "vectors"])


def _sums_row(part: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([values.ravel()], pa.list_(pa.float64()))], ["part", "vals"])


def _read_spectra(table: pa.Table) -> list[Spectrum]:
    rows = table.sort_by("rank").select(["n", "sums", "vals", "vectors"]).to_pylist()
    return [Spectrum(r["n"], [int(x) for x in r["sums"]], np.array(r["vals"]), np.array(r["vectors"]).reshape(len(r["vals"]), -1)) for r in rows]


def _combined_spectra(table: pa.Table) -> pa.Table:
    first, *others = _read_spectra(table)
    for other in others:
        first.add_spectrum(other)
    return pa.Table.from_batches([_spectrum_row(table["part"][0].as_py(), first)])


def _combined_sums(table: pa.Table) -> pa.Table:
    rows = np.array(table.sort_by("rank")["vals"].to_pylist())
    return pa.Table.from_batches([_sums_row(table["part"][0].as_py(), rows.sum(axis=0))])


def _together(parts: DataFrame, combine: Callable[[pa.Table], pa.Table], schema: str, row_bytes: int, rule: Whitening):
    """The one row that all rows of ``parts`` combine to, or None: groups of neighbours first, then groups of groups."""
    width = max(2, min(64, rule.group_bytes // row_bytes))
    parts = cut(parts)
    while (count := parts.count()) > 1:
        group = F.lit(0) if count <= width else F.floor(F.col("part") / width).cast("int")
        grouped = parts.withColumn("rank", F.col("part")).withColumn("part", group)
        parts = cut(grouped.groupBy("part").applyInArrow(combine, schema))
    return parts.first()


def spectrum(fitted: DataFrame, dims: int, rule: Whitening = Whitening()) -> Spectrum | None:
    """The combined spectrum of all rows of ``fit_list``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum.empty(dims)
        for block in _blocks(batches, 0, dims, rule.block_rows):
            own.add_rows(block)
        if own.n:
            yield _spectrum_row(TaskContext.get().partitionId(), own)

    parts = fitted.select("embedding").transform(arrow_map, run, _SPECTRUM)
    row = _together(parts, _combined_spectra, _SPECTRUM, 8 * dims * dims, rule)
    if row is None:
        return None
    return Spectrum(row["n"], [int(x) for x in row["sums"]], np.array(row["vals"]), np.array(row["vectors"]).reshape(dims, dims))


def _summed(fitted: DataFrame, dims: int, made: Callable[[np.ndarray], np.ndarray], size: int, rule: Whitening) -> np.ndarray:
    """The sum over all blocks of an array of ``size`` numbers made from each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size)
        for block in _blocks(batches, 0, dims, rule.block_rows):
            own += made(block).ravel()
        yield _sums_row(TaskContext.get().partitionId(), own)

    row = _together(fitted.select("embedding").transform(arrow_map, run, _SUMS), _combined_sums, _SUMS, 8 * size, rule)
    return np.array(row["vals"])


@dataclass(frozen=True)
class Model:
    """Rows and exact sums of the fit list (of scaled entries, without the offset), eigenvalues of the covariance, falling,
    unit eigenvectors as columns, and the trace."""

    n: int
    sums: Sequence[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def white(self, rows: np.ndarray, components: int, empty: float) -> np.ndarray:
        """Whitened coordinates; NaN for a component without variance."""
        values = self.values[:components]
        scale = np.sqrt(np.where(values > empty * self.trace, values, np.nan))
        return (rows - self.mean()) @ self.vectors[:, :components] / scale


def fit(fitted: DataFrame, dims: int, rule: Whitening = Whitening()) -> Model | None:
    """The refined model of all rows of ``fit_list``; None without rows."""
    found = spectrum(fitted, dims, rule) if dims else None
    if found is None:
        return None
    basis, mean = np.linalg.qr(found.vectors[:, ::-1])[0], found.mean()

    def turned(block: np.ndarray) -> np.ndarray:
        y = (block - mean) @ basis
        return y.T @ y

    small = _summed(fitted, dims, turned, dims * dims, rule).reshape(dims, dims) / found.n
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values, kind="stable")[::-1]
    return Model(found.n, found.sums, np.maximum(values[order], 0), basis @ turn[:, order], float(np.trace(small)))


def identity_error(fitted: DataFrame, dims: int, model: Model, rule: Whitening = Whitening()) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over components that have variance."""
    k = min(rule.components, dims)

    def products(block: np.ndarray) -> np.ndarray:
        w = np.nan_to_num(model.white(block, k, rule.empty))
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    sums = _summed(fitted, dims, products, k + k * k, rule)
    mean, cross = sums[:k] / model.n, sums[k:].reshape(k, k) / model.n
    there = model.values[:k] > rule.empty * model.trace
    apart = np.abs(cross - np.outer(mean, mean) - np.eye(k))[np.ix_(there, there)]
    return float(apart.max()) if apart.size else None


def deviations(rows: np.ndarray, n: int, sums: Sequence[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2 over the dimensions; null where no long holds it."""
    most = max(float(np.abs(rows).max(initial=0)) * n, float(max(map(abs, sums), default=0)))
    if (2 * most) ** 2 * rows.shape[1] < 2.0**62:
        apart = n * rows.astype(np.int64) - np.array(sums, dtype=np.int64)
        return (apart * apart).sum(axis=1).tolist()
    if most < 2.0**61:
        apart = n * rows.astype(np.int64) - np.array(sums, dtype=np.int64)
        near = np.abs(apart).max(axis=1).astype(float) ** 2 * rows.shape[1] < 2.0**62
        out: list[int | None] = np.where(near, (np.where(near[:, None], apart, 0) ** 2).sum(axis=1), -1).tolist()
    else:
        out = [-1] * len(rows)
    for i, known in enumerate(out):
        if known < 0:
            exact = sum((n * int(x) - s) ** 2 for x, s in zip(rows[i], sums))
            out[i] = exact if exact < 1 << 63 else None
    return out


_WHITE = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, rule: Whitening = Whitening()) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per remaining vector and component.

    Which vectors remain is stated at ``fit_list``; each remaining row counts, repeated rows and repeated or null ids too. There
    are as many components as dimensions if these are fewer than ``components``. A component without variance has
    null ``whitened``, and ``explained`` 0 (null where no component has variance). Components of equal variance are any basis of
    their space. ``deviation`` is null where it is over a long. Columns other than vec_id and embedding are ignored; an
    empty table, or one without a remaining vector, gives no rows. The model is fitted when this is called.
    """
    fitted, dims = fit_list(vectors)
    model = fit(fitted, dims, rule)
    if model is None:
        return vectors.sparkSession.createDataFrame([], _WHITE)
    error, k = identity_error(fitted, dims, model, rule), min(rule.components, dims)
    explained = (model.values[:k] / model.trace).tolist() if model.trace > 0 else [None] * k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _whole(batch.column(1), dims)
            white, each = model.white(rows, k, rule.empty).ravel(), np.repeat(np.arange(len(rows)), k)
            columns = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(each), model.n, dtype=np.int64)),
                pa.array(deviations(rows, model.n, model.sums), pa.int64()).take(pa.array(each)),
                pa.array(white, mask=np.isnan(white)),
                pa.array(explained * len(rows), pa.float64()),
                pa.array([error] * len(each), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return fitted.select("vec_id", "embedding").transform(arrow_map, run, _WHITE)

