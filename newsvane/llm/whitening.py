"""Whitening of embeddings on their leading principal components.

1. Components become whole numbers, floor(64 c). A constant offset of all of them cancels in
   everything that follows, so none is carried. Every distinct vector enters the fit once: vectors
   are packed into short keys and made distinct, copies being combined before the shuffle. The fit
   list is written as blocks of rows.
2. Sums per dimension are exact, so centring is: a whole number near the mean is subtracted from
   whole numbers, and the fraction that is left from the small difference. Nothing is multiplied
   before it is centred.
3. Chebyshev-filtered subspace iteration. A pass over the blocks gives V Q for a narrow matrix Q:
   tasks add up X'(X Q) of their centred blocks, a few slots add up the tasks, and as many small
   matrices reach the driver. The three-term recurrence of Chebyshev polynomials, scaled to the
   interval from the spectrum's lower edge to the smallest Ritz value, needs one pass a degree; it
   keeps directions within the interval small and lets those above it grow. Then QR and
   Rayleigh-Ritz. The degree of a round is bounded so that the largest direction outgrows the
   smallest by 1e8 at most.
4. The round is repeated until certified: the residual of every wanted pair is down to rounding.
   More directions are iterated than are wanted, which separates the last wanted one. When a space
   of few dimensions is iterated whole, the first Rayleigh-Ritz step is exact.
5. A last pass over the fit list measures how far the whitened covariance is from the identity, and
   one over the vectors projects them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from newsvane.llm.common import bounded_batches, staged

SCALE, COMPONENTS = 64, 16
# Directions iterated beyond the wanted ones.
GUARD = 32
# The lower edge of the spectrum is estimated from so many Lanczos steps with blocks so narrow.
EDGE_WIDTH, EDGE_STEPS = 4, 5
# Tasks add their matrices up in so many places before the driver does.
SLOTS = 8
# Whole numbers beyond this are held at it, so that differences stay within 64 bits.
LARGEST = 1 << 61
ROWS_PER_BLOCK, ROWS_PER_SLICE = 2048, 512
# The growth a round may give the largest direction over the smallest, and its highest degree.
GROWTH, MOST_DEGREE = 1e8, 16
# A pair is certified at this residual, relative to its eigenvalue, or at the rounding of a product.
RESIDUAL = 1e-14
ROUNDING = 8 * float(np.finfo(float).eps)
# Where rounding stops progress, residuals must be this small.
ACCEPTED = 1e-9
# Directions of less than this part of the largest variance are constant but for rounding.
CONSTANT = 1e-13

BLOCKS = "n int, dim int, width int, parts binary"


def whole_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """floor(64 c) of all components in a row, the offsets of the vectors, and which vectors count."""
    offsets = np.asarray(column.offsets, dtype=np.int64)
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    values, offsets = values.to_numpy(zero_copy_only=False).astype(np.float64), offsets - offsets[0]
    bad = ~np.isfinite(values)
    whole = np.clip(np.floor(np.where(bad, 0, values) * SCALE), -LARGEST, LARGEST).astype(np.int64)
    wrong = np.concatenate([[0], np.cumsum(bad)])
    counts = (wrong[offsets[1:]] == wrong[offsets[:-1]]) & ~np.asarray(column.is_null())
    return whole, offsets, counts


def as_matrix(whole: np.ndarray, offsets: np.ndarray, rows: np.ndarray, dim: int) -> np.ndarray:
    """The given vectors as rows of ``dim`` numbers; missing ones are zero."""
    sizes = offsets[rows + 1] - offsets[rows]
    out = np.zeros((len(rows), dim), dtype=np.int64)
    for size in np.unique(sizes):
        of_size = np.flatnonzero(sizes == size)
        out[of_size, :size] = whole[offsets[rows[of_size]][:, None] + np.arange(size)]
    return out


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes, equal for equal vectors: the width of a number, then the numbers up to the last
    that is not zero."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS_PER_SLICE):
            whole, offsets, counts = whole_numbers(batch.column(0).slice(begin, ROWS_PER_SLICE))
            rows = np.flatnonzero(counts)
            dim = int((offsets[rows + 1] - offsets[rows]).max(initial=0))
            matrix = as_matrix(whole, offsets, rows, dim)
            sizes = dim - np.argmax(np.pad(matrix[:, ::-1] != 0, ((0, 0), (0, 1)), constant_values=True), axis=1)
            top = np.abs(matrix).max(axis=1, initial=0)
            widths = np.where(top < 1 << 15, 2, np.where(top < 1 << 31, 4, 8))
            keys = [
                bytes([w]) + row[:size].astype(f"<i{w}").tobytes()
                for row, size, w in zip(matrix, sizes.tolist(), widths.tolist())
            ]
            yield pa.RecordBatch.from_arrays([pa.array(keys, type=pa.binary())], names=["key"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("n", pa.int32()), ("dim", pa.int32()), ("width", pa.int32()), ("parts", pa.binary())])
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS_PER_BLOCK):
            keys = batch.column(0).slice(begin, ROWS_PER_BLOCK).to_pylist()
            rows = [np.frombuffer(k[1:], f"<i{k[0]}") for k in keys]
            width, dim = max(k[0] for k in keys), max(map(len, rows))
            matrix = np.zeros((len(rows), dim), dtype=f"<i{width}")
            for at, row in enumerate(rows):
                matrix[at, : len(row)] = row
            block = {"n": len(rows), "dim": dim, "width": width, "parts": matrix.tobytes()}
            yield pa.RecordBatch.from_pylist([block], schema=schema)


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for row in batch.to_pylist():
            matrix = np.frombuffer(row["parts"], f"<i{row['width']}").reshape(row["n"], row["dim"])
            yield np.pad(matrix.astype(np.int64), ((0, 0), (0, dim - row["dim"])))


@dataclass(frozen=True)
class Centre:
    """Exact means: ``whole`` + ``rest`` / ``n`` per dimension, 0 <= rest < n."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def deviations(self, matrix: np.ndarray) -> np.ndarray:
        """n x - S, exact: in 64 bits where they suffice, else as Python's whole numbers."""
        difference = matrix - self.whole
        largest = max(int(difference.max(initial=0)), -int(difference.min(initial=0))) + 1
        if largest * self.n >= 1 << 62:
            return difference.astype(object) * self.n - self.rest.astype(object)
        return difference * self.n - self.rest

    def centred(self, matrix: np.ndarray) -> np.ndarray:
        """x - S/n; only the difference from a whole number near the mean is rounded."""
        return (matrix - self.whole).astype(np.float64) - self.rest / self.n


def _summed(blocks: DataFrame, dim: int, centre: Centre, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of ``part`` of the centred block, a small matrix.

    Tasks send one matrix each to a few slots, which add them in the order of the tasks.
    """
    shape = part(np.zeros((1, dim))).shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, total = TaskContext.get().partitionId(), np.zeros(shape)
        for matrix in _matrices(batches, dim):
            total += part(centre.centred(matrix))
        yield pa.RecordBatch.from_pylist([{"slot": task % SLOTS, "task": task, "y": total.tobytes()}], schema=sent)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros(shape), False
        for batch in batches:
            for row in batch.to_pylist():
                total += np.frombuffer(row["y"]).reshape(shape)
                any_row = True
        if any_row:
            yield pa.RecordBatch.from_pylist([{"slot": row["slot"], "y": total.tobytes()}], schema=added)

    sent = pa.schema([("slot", pa.int32()), ("task", pa.int32()), ("y", pa.binary())])
    added = pa.schema([("slot", pa.int32()), ("y", pa.binary())])
    tasks = blocks.mapInArrow(run, "slot int, task int, y binary")
    slots = tasks.repartition(SLOTS, "slot").sortWithinPartitions("task").mapInArrow(add, "slot int, y binary")
    # A partition may hold several slots: it sends one matrix all the same.
    return sum((np.frombuffer(y).reshape(shape) for _, y in sorted(slots.collect())), np.zeros(shape))


def _orthonormal(block: np.ndarray) -> np.ndarray:
    # Twice, since the columns may be far from orthogonal.
    return np.linalg.qr(np.linalg.qr(block)[0])[0]


def lower_edge(product: Callable[[np.ndarray], np.ndarray], dim: int, seed: int = 3) -> float:
    """About the smallest eigenvalue, rather too small: a few Lanczos steps with a narrow block.

    The estimate only shapes the filter; what is certified does not depend on it.
    """
    rng = np.random.default_rng(seed)
    basis = _orthonormal(rng.normal(size=(dim, min(EDGE_WIDTH, dim))))
    images = product(basis)
    while basis.shape[1] < min(dim, EDGE_WIDTH * EDGE_STEPS):
        # The newest directions, less what the basis has already; twice, for rounding.
        new = images[:, -EDGE_WIDTH:]
        for _ in range(2):
            new = new - basis @ (basis.T @ new)
        new = _orthonormal(new)[:, : dim - basis.shape[1]]
        basis, images = np.hstack([basis, new]), np.hstack([images, product(new)])
    small = basis.T @ images
    values, rotation = np.linalg.eigh((small + small.T) / 2)
    residual = np.linalg.norm(images @ rotation[:, 0] - values[0] * (basis @ rotation[:, 0]))
    return max(0.0, float(values[0] - residual))


def leading_pairs(
    product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int = COMPONENTS, guard: int = GUARD, seed: int = 7
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and unit eigenvectors of a symmetric positive matrix.

    ``product`` gives the matrix times a narrow block; nothing else is known of it.
    """
    width = min(dim, wanted + guard)
    wanted = min(wanted, dim)
    least = lower_edge(product, dim) if width < dim else 0.0
    block = _orthonormal(np.random.default_rng(seed).normal(size=(dim, width)))
    image = product(block)
    worst_before, stalled = np.inf, 0
    while True:
        small = block.T @ image
        values, rotation = np.linalg.eigh((small + small.T) / 2)
        values, rotation = values[::-1], rotation[:, ::-1]
        block, image = block @ rotation, image @ rotation
        residuals = np.linalg.norm(image - block * values, axis=0)[:wanted]
        of_note = values[:wanted] > CONSTANT * values[0]
        limit = np.maximum(RESIDUAL * values[:wanted], ROUNDING * values[0])
        if width == dim or values[0] <= 0 or (residuals <= limit)[of_note].all():
            break
        worst = (residuals / limit)[of_note].max()
        stalled = stalled + 1 if worst > worst_before / 2 else 0
        worst_before = min(worst, worst_before)
        if stalled >= 3 and (residuals <= ACCEPTED * values[:wanted])[of_note].all():
            break
        # The unwanted spectrum: from the lower edge to the smallest Ritz value.
        low = min(least, 0.9 * values[-1])
        middle, half = (values[-1] + low) / 2, (values[-1] - low) / 2
        if half <= CONSTANT * values[0]:
            # Nothing to damp: the block spans all directions that vary, or nearly.
            filtered = image
        else:
            reach = np.arccosh(max((values[0] - middle) / half, 1 + 1e-6))
            degree = int(np.clip(np.arccosh(GROWTH) / reach, 1, MOST_DEGREE))
            before, filtered = block, (image - middle * block) / half
            for _ in range(degree - 1):
                before, filtered = filtered, 2 * (product(filtered) - middle * filtered) / half - before
        block = _orthonormal(filtered)
        image = product(block)
    for j in range(width):
        if block[np.argmax(np.abs(block[:, j])), j] < 0:
            block[:, j] *= -1
    return values[:wanted], block[:, :wanted]


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: means, eigenvalues, eigenvectors as columns, and what they were measured at."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS, guard: int = GUARD) -> Whitening | None:
    """Fit on every distinct vector once; None if no two vectors differ.

    Null vectors and vectors with null, NaN or infinite entries take no part. Of vectors of unequal
    length the missing entries count as zero. What reaches the driver are a few matrices of as many
    rows as there are dimensions, never rows of the table.
    """
    rows = bounded_batches(vectors.select(F.col(f"`{vector}`").cast("array<double>").alias("v")))
    distinct = rows.mapInArrow(_keys, "key binary").distinct()
    blocks = staged(distinct.mapInArrow(_blocks, BLOCKS), "whitening-fit")
    n, dim = blocks.agg(F.sum("n"), F.max("dim")).first()
    if not n or not dim:
        return None

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim, dtype=object)
        for matrix in _matrices(batches, dim):
            fits = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0))) < 1 << 51
            total += (matrix if fits else matrix.astype(object)).sum(axis=0)
        numbers = pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), numbers], names=["j", "s"])

    total = np.zeros(dim, dtype=object)
    for j, s in blocks.mapInArrow(sums, "j int, s decimal(38,0)").groupBy("j").agg(F.sum("s")).collect():
        total[j] = int(s)
    whole = total // n
    centre = Centre(n, whole.astype(np.int64), (total - whole * n).astype(np.int64))

    trace = float(_summed(blocks, dim, centre, lambda z: (z * z).sum(axis=0)[:, None]).sum()) / n
    if trace <= 0:
        return None
    values, directions = leading_pairs(
        lambda q: _summed(blocks, dim, centre, lambda z: z.T @ (z @ q)) / n, dim, components, guard
    )
    vary = values > CONSTANT * values[0]
    values, directions = values[vary], directions[:, vary]
    project = directions / np.sqrt(values)

    def moments(z: np.ndarray) -> np.ndarray:
        w = z @ project
        return w.T @ w

    error = float(np.abs(_summed(blocks, dim, centre, moments) / n - np.eye(len(values))).max())
    return Whitening(centre, values, directions, trace, error)


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
    model: Whitening | None = None,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component.

    The model is fitted on these vectors unless one is given. Vectors left out by `fit` are left out
    here; repeated rows and rows without an id stay, each for itself. ``deviation`` is exact, and
    null where it is beyond a long. Entries beyond 2**61 / 64 are held there. Directions that do not
    vary have no component, so equal vectors, a single vector or an empty table give an empty result.
    Entries beyond the fitted length are not looked at. Other columns are not read.
    """
    model = model or fit(vectors, vector, components)
    id_type = vectors.schema[id_column].dataType
    schema = StructType(
        [
            StructField(id_column, id_type), StructField("component", IntegerType()), StructField("n", LongType()),
            StructField("deviation", LongType()), StructField("whitened", DoubleType()),
            StructField("explained", DoubleType()), StructField("identity_error", DoubleType()),
        ]
    )
    rows = bounded_batches(
        vectors.select(F.col(f"`{id_column}`"), F.col(f"`{vector}`").cast("array<double>").alias("__vector"))
    )
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    arrow = to_arrow_schema(schema)
    count, dim = len(model.values), len(model.centre.whole)
    project = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_PER_SLICE):
                part = batch.slice(begin, ROWS_PER_SLICE)
                whole, offsets, counts = whole_numbers(part.column(1))
                rows = np.flatnonzero(counts)
                if not len(rows):
                    continue
                longest = int((offsets[rows + 1] - offsets[rows]).max())
                matrix = as_matrix(whole, offsets, rows, max(dim, longest))[:, :dim]
                deviations = model.centre.deviations(matrix)
                largest = max(int(deviations.max(initial=0)), -int(deviations.min(initial=0)))
                if largest * largest * dim >= 1 << 63:
                    deviations = deviations.astype(object)
                exact = (deviations * deviations).sum(axis=1).tolist()
                whitened = (deviations.astype(np.float64) / model.centre.n) @ project
                again = np.repeat(np.arange(len(rows)), count)
                ids = part.column(0).take(pa.array(rows)).take(pa.array(again))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.cast(arrow.field(0).type),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(again), model.centre.n)),
                        pa.array([x if x < 1 << 63 else None for x in exact], pa.int64()).take(pa.array(again)),
                        pa.array(whitened.ravel()),
                        pa.array(np.tile(model.values / model.trace, len(rows))),
                        pa.array(np.full(len(again), model.identity_error)),
                    ],
                    schema=arrow,
                )

    return rows.mapInArrow(run, schema)
