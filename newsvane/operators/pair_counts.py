"""Counting pairs of neighbouring words inside one task: words as numbers, pairs as one number each.

Only numpy and Arrow are used, and the functions are pickled by value, so executors need no copy of
this package.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A block holds about so many tokens of whole documents, a task combines so many pairs at once.
BLOCK_TOKENS, PAIRS_AT_ONCE = 1 << 18, 1 << 20
# A pair is (second << PLACE_BITS | first), its weight stands in the bits that are left while it is counted.
PLACE_BITS, WEIGHT_BITS = 28, 8
# What is handed to Spark at once, in bytes and in rows of pairs.
BYTES_AT_ONCE, ROWS_AT_ONCE = 2 << 20, 1 << 16
BLOCK_SCHEMA = "words array<string>, counts array<bigint>, codes binary, lengths binary"


def tidied(step: Callable) -> Callable:
    """A step over batches that hands on small ones and gives memory back at its end: an idle worker would keep it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in step(batches):
                rows = max(1, batch.num_rows * BYTES_AT_ONCE // max(1, batch.nbytes))
                for first in range(0, batch.num_rows, rows):
                    yield batch.slice(first, rows)
                del batch
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return run


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token lists as blocks of whole documents: a block's words once each, and every token's place among them."""
    for batch in batches:
        lists = batch.column(0)
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        tokens, first = lists.flatten(), 0
        while first < len(lengths):
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + BLOCK_TOKENS, side="right")) - 1)
            coded = tokens.slice(ends[first], ends[last] - ends[first]).dictionary_encode()
            codes = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int32)
            counts = np.bincount(codes[codes >= 0], minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([coded.dictionary.to_pylist()], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())),
                    pa.array([codes.tobytes()], pa.binary()), pa.array([lengths[first:last].tobytes()], pa.binary()),
                ],
                names=["words", "counts", "codes", "lengths"],
            )
            first = last


def _near(batch: pa.RecordBatch, i: int, window: int):
    """The known words' numbers of block ``i``, and (distance, firsts, seconds) as places among them, those so far behind each."""
    codes, lengths = (np.frombuffer(batch[c][i].as_buffer(), "<i4") for c in ("codes", "lengths"))
    known = batch["ids"][i].values.to_numpy(zero_copy_only=False)
    places = np.full(int(codes.max(initial=-1)) + 2, -1, np.int32)
    places[batch["ats"][i].values.to_numpy(zero_copy_only=False)] = np.arange(len(known))
    places, documents = places[codes], np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)

    def met():
        for d in range(1, min(window, len(places) - 1) + 1):
            here = (documents[:-d] == documents[d:]) & (places[:-d] >= 0) & (places[d:] >= 0)
            yield d, places[:-d][here], places[d:][here]

    return known, met()


def sides_of(window: int):
    """(id, n) per block: what the pairs of a word count, from either side."""

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                known, near = _near(batch, i, window)
                sums = np.zeros(len(known), np.int64)
                for d, *both in near:
                    for places in both:
                        sums += (window + 1 - d) * np.bincount(places, minlength=len(known))
                found = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array(known[found].astype(np.int32)), pa.array(sums[found])], names=["id", "n"])

    return tidied(sides)


def pack(keys: np.ndarray, values: np.ndarray) -> tuple[bytes, bytes]:
    """Rising whole numbers as their differences and values of 64 bits, equal bytes side by side, which compress well."""
    steps = np.diff(keys.astype("<u8"), prepend=np.uint64(0))
    return tuple(x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for x in (steps, values))


def unpack(keys: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, held = (np.frombuffer(x, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel() for x in (keys, values))
    return np.cumsum(steps, dtype=np.uint64), held.astype(np.int64)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of values over equal neighbours among sorted keys."""
    starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1))) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(values, starts) if len(starts) else np.zeros(0, np.int64)


def pairs_of(window: int, buckets: int):
    """(bucket, keys, counts): pairs combined over many blocks, cut by their rarer word."""

    def combined(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        weighted = np.sort(np.concatenate(parts))
        keys, n = _summed(weighted >> np.uint64(WEIGHT_BITS), (weighted & np.uint64((1 << WEIGHT_BITS) - 1)).astype(np.int64))
        bucket = ((keys >> np.uint64(PLACE_BITS)) * np.uint64(2_654_435_761) >> np.uint64(11)) % np.uint64(buckets)
        order = np.argsort(bucket.astype(np.int32), kind="stable")
        bucket, keys, n = bucket[order], keys[order], n[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        packed = [pack(k, c) for k, c in zip(np.split(keys, cuts), np.split(n, cuts))]
        numbers = bucket[np.concatenate([[0], cuts])].astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers), *(pa.array(c, pa.binary()) for c in zip(*packed))], names=["bucket", "keys", "counts"]
        )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                known, near = _near(batch, i, window)
                for d, *both in near:
                    first, second = (known[places].astype(np.int64) for places in both)
                    key = np.maximum(first, second) << PLACE_BITS | np.minimum(first, second)
                    parts.append(key.astype(np.uint64) << np.uint64(WEIGHT_BITS) | np.uint64(window + 1 - d))
                    held += len(key)
                if held >= PAIRS_AT_ONCE:
                    yield from combined(parts)
                    parts, held = [], 0
        if held:
            yield from combined(parts)

    return tidied(pairs)


def counted(rows: pa.Table) -> pa.Table:
    """All pairs of one bucket: (first, second, n), second the rarer word."""
    parts = [unpack(k.as_py(), c.as_py()) for k, c in zip(rows["keys"], rows["counts"])]
    keys, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, n = _summed(keys[order], n[order])
    places = (keys & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int32), (keys >> np.uint64(PLACE_BITS)).astype(np.int32)
    table = pa.table([pa.array(x) for x in (*places, n)], names=["first", "second", "n"])
    return pa.Table.from_batches(table.to_batches(max_chunksize=ROWS_AT_ONCE), table.schema)


SIDES_AT_ONCE = 1 << 16


def listed_sides(rows: pa.Table) -> pa.Table:
    """Rows (part, id, n) of neighbouring words as one list, a word's n at its place in the part."""
    made = np.zeros(SIDES_AT_ONCE, np.int64)
    made[rows["id"].to_numpy() % SIDES_AT_ONCE] = rows["n"].to_numpy()
    return pa.table([pa.array([rows["part"][0].as_py()], pa.int32()), pa.array([made], pa.list_(pa.int64()))], names=["part", "ns"])
