"""Products of a sparse matrix with a narrow block, inside one task. Whole numbers throughout.

Word ``id`` stands in group ``id % groups`` at place ``id // groups``. A cell is the part of the
matrix with its rows in some neighbouring groups and its columns in one group.

Only numpy and Arrow are used, and the functions are pickled by value, so executors need no copy of
this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from newsvane.operators import pair_counts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAIRS_AT_ONCE, ENTRIES_AT_ONCE, EXACT_ROWS = 1 << 18, 1 << 10, 1 << 12
COLUMN_BITS, ROW_BITS = 16, 28
# Words of a group, and of the rows of one task, at most: with 64 numbers a word, 4 MB of the block and 64 MB of sums.
GROUP_WORDS, ROW_WORDS = 1 << 14, 1 << 17
# Every task of rows gets the whole block, so more tasks than memory asks for are made only up to so many rows moved.
MOVED_WORDS = 1 << 23
# Rows of a cell are held in pieces of these lengths, filled up with zeros, four to an octave.
LENGTHS = np.array(sorted({*range(1, 9), *(m << k for k in range(1, 9) for m in (4, 5, 6, 7))}))


@dataclass(frozen=True)
class Grid:
    """``groups`` of at most ``places`` words; the rows of a cell are those of ``span`` groups."""

    groups: int
    places: int
    span: int

    @property
    def rows(self) -> int:
        return -(-self.groups // self.span)

    @staticmethod
    def of(words: int, tasks: int) -> Grid:
        """Rows of ROW_WORDS words at most lie together and are the work of one task, for ``tasks`` if that moves little."""
        rows = max(1, -(-words // ROW_WORDS), min(tasks, words // 1024, MOVED_WORDS // max(1, words)))
        span = max(1, -(-words // (rows * GROUP_WORDS)))
        return Grid(rows * span, max(1, -(-words // (rows * span))), span)


def spark_hash(numbers: np.ndarray) -> np.ndarray:
    """What Spark's hash partitioning takes of a bigint."""
    u = np.uint32

    def mixed(h: np.ndarray, k: np.ndarray) -> np.ndarray:
        k = k * u(0xCC9E2D51)
        h = h ^ ((k << u(15) | k >> u(17)) * u(0x1B873593))
        return (h << u(13) | h >> u(19)) * u(5) + u(0xE6546B64)

    numbers = np.asarray(numbers, np.uint64)
    h = mixed(mixed(np.full(numbers.shape, 42, u), numbers.astype(u)), (numbers >> np.uint64(32)).astype(u)) ^ u(8)
    h = (h ^ h >> u(16)) * u(0x85EBCA6B)
    h = (h ^ h >> u(13)) * u(0xC2B2AE35)
    return (h ^ h >> u(16)).view(np.int32)


def cell_numbers(rows: int, groups: int) -> np.ndarray:
    """A number for every cell, rising by rows and then columns, which Spark deals to a partition of its rows' own.

    Cells dealt otherwise are no mistake: their sums are added up from several tasks.
    """
    wide = 2 * rows * groups + 64 * rows
    made = np.arange(rows, dtype=np.int64)[:, None] * wide + np.arange(groups)
    for r in range(rows if rows <= 256 else 0):
        numbers = r * wide + np.arange(wide)
        own = numbers[spark_hash(numbers) % rows == r]
        if len(own) >= groups:
            made[r] = own[:groups]
    return made


def squeezed(numbers: np.ndarray) -> bytes:
    """Whole numbers, most of them small, signs last and equal bytes side by side, compressed."""
    bits = 8 * numbers.itemsize
    folded = (numbers << 1 ^ numbers >> bits - 1).reshape(-1).view(np.uint8).reshape(-1, numbers.itemsize)
    raw = np.ascontiguousarray(folded.T)
    return raw.nbytes.to_bytes(8, "little") + pa.compress(raw, "lz4", asbytes=True)


def loosened(data, kind: str) -> np.ndarray:
    data = memoryview(data)
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "lz4")
    size = np.dtype(kind).itemsize
    folded = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(f"<u{size}").ravel()
    return (folded >> 1).view(kind) ^ -(folded & 1).view(kind)


def _cell(numbers: list, rows: np.ndarray, columns: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    """One cell's entries, in the order of rows, as pieces of rows: the pieces of one length side by side, each with
    another row; how many there are of which length; their columns and weights."""
    starts, most = np.flatnonzero(np.diff(rows, prepend=-1)), int(LENGTHS[-1])
    lengths = np.diff(starts, append=len(rows))
    pieces = -(-lengths // most)
    of, turn = np.repeat(np.arange(len(starts)), pieces), np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin, size = starts[of] + turn * most, np.minimum(lengths[of] - turn * most, most)
    length = LENGTHS[np.searchsorted(LENGTHS, size)]
    kind = np.where(length == most, turn, 0) << 16 | length
    order = np.argsort(kind, kind="stable")
    held: list[list] = [[], [], [], []]
    for part in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1):
        step = np.arange(length[part[0]])
        known, at = step < size[part, None], np.minimum(begin[part, None] + step, len(rows) - 1)
        for into, x in zip(held, (rows[begin[part]], [len(part), len(step)], columns[at] * known, weights[at] * known)):
            into.append(np.ravel(x))
    packed = (np.concatenate(x).astype(t).tobytes() for x, t in zip(held, ("<i4", "<i4", "<u2", "<i4")))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([numbers[0]], pa.int64()), *(pa.array([n], pa.int32()) for n in numbers[1:]),
            *(pa.array([x], pa.binary()) for x in packed),
        ],
        names=["cell", "r", "c", "rows", "shapes", "columns", "weights"],
    )


CELL_SCHEMA = "cell bigint, r int, c int, rows binary, shapes binary, columns binary, weights binary"
PIECE_SCHEMA = "cell bigint, r int, c int, keys binary, weights binary"


def pieces_of(numbers: np.ndarray, rows: np.ndarray, columns: np.ndarray, places: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    """Entries (task of rows, column group, place of row and column, weight) as one piece per cell."""
    cell = rows * numbers.shape[1] + columns
    order = np.lexsort((places, cell))
    cell, places, weights = cell[order], places[order], weights[order]
    cuts = np.flatnonzero(np.diff(cell)) + 1
    packed = [pair_counts.pack(k, x) for k, x in zip(np.split(places, cuts), np.split(weights, cuts))]
    cell = cell[np.concatenate([[0], cuts])]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(numbers.ravel()[cell]), *(pa.array(x.astype(np.int32)) for x in divmod(cell, numbers.shape[1])),
            *(pa.array(x, pa.binary()) for x in zip(*packed)),
        ],
        names=["cell", "r", "c", "keys", "weights"],
    )


def cut_into_cells(grid: Grid, numbers: np.ndarray):
    """Entries (first, second, w) of one half of the matrix to pieces of the cells of both."""

    def flushed(parts: list) -> pa.RecordBatch:
        first, second, w = (np.concatenate(x) for x in zip(*parts))
        other = first != second
        rows, columns = np.concatenate([first, second[other]]), np.concatenate([second, first[other]])
        weights, group = np.concatenate([w, w[other]]), rows % grid.groups
        place = group % grid.span * grid.places + rows // grid.groups
        return pieces_of(numbers, group // grid.span, columns % grid.groups, place << COLUMN_BITS | columns // grid.groups, weights)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, PAIRS_AT_ONCE):
                some = batch.slice(first, PAIRS_AT_ONCE)
                parts.append([some.column(i).to_numpy().astype(np.int64) for i in range(3)])
                held += some.num_rows
                if held >= PAIRS_AT_ONCE:
                    yield flushed(parts)
                    parts, held = [], 0
        if held:
            yield flushed(parts)

    return pair_counts.tidied(cut)


@pair_counts.tidied
def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in the order of their cells, to one row per cell."""

    def made() -> pa.RecordBatch:
        keys, weights = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(keys, kind="stable")
        keys = keys[order].astype(np.int64)
        return _cell(cell, keys >> COLUMN_BITS, keys & ((1 << COLUMN_BITS) - 1), weights[order])

    cell, parts = None, []
    for batch in batches:
        for *of, keys, weights in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if of != cell and parts:
                yield made()
                parts = []
            cell = of
            parts.append(pair_counts.unpack(keys, weights))
    if parts:
        yield made()


def rows_of_cells(grid: Grid):
    """(id) of the words that have a row in a cell, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for r, rows in zip(batch.column(0), batch.column(1)):
                seen.setdefault(r.as_py(), np.zeros(grid.span * grid.places, bool))[np.frombuffer(rows.as_buffer(), "<i4")] = True
        for r, there in seen.items():
            place = np.flatnonzero(there)
            ids = place % grid.places * grid.groups + r * grid.span + place // grid.places
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32))], names=["id"])

    return run


def started(grid: Grid, width: int, bits: int, numbers: np.ndarray):
    """Rows (p, id, seed) of a group to its first block (c, x, cells)."""

    def run(rows: pa.Table) -> pa.Table:
        block, c = np.zeros((grid.places, width), "<i4"), rows["p"][0].as_py()
        for i, s in zip(rows["id"].to_pylist(), rows["seed"].to_pylist()):
            block[i // grid.groups] = np.random.default_rng(s % (1 << 63)).integers(-(1 << bits), 1 << bits, width)
        return pa.Table.from_batches([block_row(c, block, numbers)])

    return run


BLOCK_SCHEMA = "c int, x binary, cells array<bigint>"


def block_row(c: int, block: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
    """A group's part of the block, and the cells that it meets."""
    columns = [pa.array([c], pa.int32()), pa.array([squeezed(block)], pa.binary()), pa.array([numbers[:, c]], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=["c", "x", "cells"])


def add_product(sums: np.ndarray, rows: np.ndarray, shapes: np.ndarray, columns: np.ndarray, weights: np.ndarray, block: np.ndarray) -> None:
    """Add a cell times the block of its columns to the sums of its rows."""
    # Products of pieces of rows stay whole in doubles below 2**53, where stacked products are fast.
    largest = max(map(int, (weights.max(initial=0), -weights.min(initial=0)))) * max(map(int, (block.max(initial=0), -block.min(initial=0))))
    kind = np.float64 if largest * int(LENGTHS[-1]) < 1 << 53 else np.int64
    block, row, entry = block.astype(kind), 0, 0
    for many, length in shapes.reshape(-1, 2).tolist():
        at_once = max(1, ENTRIES_AT_ONCE // length)
        for first in range(0, many, at_once):
            n = min(at_once, many - first)
            here = slice(entry, entry + n * length)
            found = block[columns[here].astype(np.intp)].reshape(n, length, -1)
            # No product of whole numbers may be taken for one of doubles.
            product = np.matmul(weights[here].astype(kind).reshape(n, 1, length), found)[:, 0]
            sums[rows[row : row + n]] += product.astype(np.int64)
            row, entry = row + n, here.stop


def times(grid: Grid, width: int, kind: str = "<i4"):
    """Cells with the block of their columns, in the order of r, to sums per group of rows (p, y), some per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None

        def made() -> Iterator[pa.RecordBatch]:
            for s, part in enumerate(total):
                if current * grid.span + s < grid.groups:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([current * grid.span + s], pa.int32()), pa.array([squeezed(part)], pa.binary())], names=["p", "y"]
                    )

        for batch in batches:
            for i in range(batch.num_rows):
                r = batch["r"][i].as_py()
                if r != current:
                    if current is not None:
                        yield from made()
                    current, total = r, np.zeros((grid.span, grid.places, width), np.int64)
                held = [
                    np.frombuffer(batch[c][i].as_buffer(), t)
                    for c, t in (("rows", "<i4"), ("shapes", "<i4"), ("columns", "<u2"), ("weights", "<i4"))
                ]
                add_product(total.reshape(-1, width), *held, loosened(batch["x"][i].as_buffer(), kind).reshape(-1, width))
        if current is not None:
            yield from made()

    return pair_counts.tidied(run)


def added(rows: pa.Table) -> pa.Table:
    """Sums of one group, from all tasks."""
    parts = rows["y"]
    if len(parts) == 1:
        return rows.select(["p", "y"])
    total = sum(loosened(y.as_buffer(), "<i8") for y in parts)
    return pa.table([pa.array([rows["p"][0].as_py()], pa.int32()), pa.array([squeezed(total)], pa.binary())], names=["p", "y"])


def sums_in(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    for y in batch["y"]:
        yield loosened(y.as_buffer(), "<i8").reshape(-1, width)


def reduced(start: np.ndarray, part, join):
    """One small whole-number matrix per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = start
        for batch in batches:
            for rows in sums_in(batch, start.shape[-1]):
                total = join(total, part(rows))
        yield pa.RecordBatch.from_arrays([pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["m"])

    return pair_counts.tidied(run)


def scaled(rows: np.ndarray, top: np.ndarray, bits: int) -> np.ndarray:
    """Columns brought to so many bits by their largest entries, whole numbers."""
    return np.rint(rows / np.maximum(top, 1) * (1 << bits))


def products(rows: np.ndarray, top: np.ndarray, bits: int) -> np.ndarray:
    """Exact sums of products of scaled columns: few enough rows at a time for whole numbers in doubles."""
    total = np.zeros((rows.shape[1],) * 2, np.int64)
    for first in range(0, len(rows), EXACT_ROWS):
        part = scaled(rows[first : first + EXACT_ROWS], top, bits)
        total += (part.T @ part).astype(np.int64)
    return total


def turned(width: int, top: np.ndarray, turn: np.ndarray, bits: int, numbers: np.ndarray):
    """Sums (p, y) to the next block (c, x, cells)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, y in zip(batch["p"], sums_in(batch, width)):
                rows = scaled(y, top, bits) / float(1 << bits) @ turn
                held = np.clip(np.rint(rows * (1 << bits)), -(1 << bits + 2), 1 << bits + 2).astype("<i4")
                yield block_row(p.as_py(), held, numbers)

    return pair_counts.tidied(run)


def finished(grid: Grid, width: int, size: int, unit: np.ndarray):
    """Sums (p, y) to (id, vector), columns divided by ``unit``, padded to ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, y in zip(batch["p"], sums_in(batch, width)):
                ids = np.arange(len(y), dtype=np.int32) * grid.groups + p.as_py()
                padded = np.pad(y / unit[0] / unit[1:], ((0, 0), (0, size - width)))
                ends = pa.array(np.arange(0, padded.size + 1, size), pa.int32())
                vectors = pa.ListArray.from_arrays(ends, padded.ravel())
                yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), vectors], names=["id", "vector"])

    return pair_counts.tidied(run)
