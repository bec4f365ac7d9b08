"""Articles as rows of a sparse matrix of word counts, inside one task: token lists to cells, sums back to articles.

Only numpy and Arrow are used, and the functions are pickled by value, so executors need no copy of
this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from newsvane.operators import pair_counts, vector_blocks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A block holds about so many tokens of whole articles, and so many articles at most.
BLOCK_TOKENS, BLOCK_ARTICLES = 1 << 18, 1 << 14


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tokens, key) as blocks: their words once each, every token's place among them, lengths and keys."""
    for batch in batches:
        lists, keys = batch.column(0), batch.column(1)
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        tokens, first = lists.flatten(), 0
        while first < len(lengths):
            last = int(np.searchsorted(ends, ends[first] + BLOCK_TOKENS, side="right")) - 1
            last = max(first + 1, min(last, first + BLOCK_ARTICLES))
            coded = tokens.slice(ends[first], ends[last] - ends[first]).dictionary_encode()
            codes = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([coded.dictionary.to_pylist()], pa.list_(pa.string())), pa.array([codes.tobytes()], pa.binary()),
                    pa.array([lengths[first:last].astype("<i4").tobytes()], pa.binary()),
                    pa.array([int(lengths[first:last].max())], pa.int32()),
                    pa.ListArray.from_arrays([0, last - first], keys.slice(first, last - first)),
                ],
                names=["words", "codes", "lengths", "longest", "keys"],
            )
            first = last


def word_group(numbers: np.ndarray, size: int, kind: str):
    """Rows (c, term, vector) of a group to its terms and its part of the block; a last column counts."""

    def run(rows: pa.Table) -> pa.Table:
        c = rows["c"][0].as_py()
        vectors = rows["vector"].combine_chunks().flatten().to_numpy().reshape(-1, size)
        block = np.column_stack([vectors, np.ones(len(vectors), np.int64)]).astype(kind)
        made = vector_blocks.block_row(c, block, numbers)
        terms = pa.array([rows["term"].to_pylist()], pa.list_(pa.string()))
        return pa.Table.from_batches([made]).append_column("terms", terms)

    return run


def counted_words(numbers: np.ndarray):
    """Blocks with the groups and places of their words, to pieces of the matrix of articles and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes, lengths = (np.frombuffer(batch[c][i].as_buffer(), "<i4") for c in ("codes", "lengths"))
                ats, groups, places = (batch[c][i].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ats", "groups", "places"))
                known = np.full(int(codes.max(initial=-1)) + 2, -1, np.int64)
                known[ats] = np.arange(len(ats))
                known = known[codes]
                article = np.repeat(np.arange(len(lengths)), lengths)[known >= 0] + batch["first"][i].as_py()
                met, n = np.unique(article << 32 | known[known >= 0], return_counts=True)
                article, word = met >> 32, met & (1 << 32) - 1
                rows = np.full(len(met), batch["r"][i].as_py())
                yield vector_blocks.pieces_of(numbers, rows, groups[word], article << vector_blocks.COLUMN_BITS | places[word], n)

    return pair_counts.tidied(run)


def sums_of_articles(grid: vector_blocks.Grid, size: int):
    """Sums (p, y) to (r, at, known_words, sums) of the articles that have known words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, y in zip(batch["p"].to_pylist(), vector_blocks.sums_in(batch, size + 1)):
                there = np.flatnonzero(y[:, size])
                ends = pa.array(np.arange(0, len(there) * size + 1, size), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(there), p // grid.span, np.int32)),
                        pa.array((there + p % grid.span * grid.places).astype(np.int32)), pa.array(y[there, size]),
                        pa.ListArray.from_arrays(ends, np.ascontiguousarray(y[there, :size]).ravel()),
                    ],
                    names=["r", "at", "known_words", "sums"],
                )

    return pair_counts.tidied(run)
