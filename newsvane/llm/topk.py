"""Exact top-k search by histograms of all scores.

Every query row is scored against every row, block by block. Nothing is sorted over all rows:
each round counts, per query, the scores in equal bins of the range that still holds the k-th
score, sums the counts over all tasks, and keeps the one bin that holds the k-th. When a bin is one
score wide, the k-th score is known, and one more pass returns the scores above it and as many ties
as are wanted, smallest ids first.

A task leaves out bins below those of its own best ``k`` scores: at least k scores lie at or above
them, so the k-th score of all rows cannot lie lower. Counts in the bins it sends are complete.

Scores are exact at every size. A vector is plain if its squares sum up to less than 2**62: the score
of two plain vectors fits 64 bits, whatever their length. Any other vector is scored in whole numbers
without a bound, beside the histograms; the best of both are put in one order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsvane.llm.common import bounded_batches, staged
from newsvane.session import broadcast_if_small

SCALE = 256
BINS = 4096
ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 2048, 512
# A plain vector's components are less than this, and their squares sum up to less than the other.
LARGEST, LARGEST_SQUARES = 1 << 31, float((1 << 62) - (1 << 40))
# Digits of a score as text: more than the product of two of the largest numbers has.
DIGITS = 640

# A block's parts are scaled components; those of a block of vectors that are not plain, marked by a
# negative ``top``, are the components as they came.
BLOCKS = "ids binary, parts binary, n int, dim int, top long"


def _vectors_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Components in a row, the offsets of the vectors, which vectors take part, and which are plain."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.asarray(column.offsets, dtype=np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = ~np.isfinite(values)
    values = np.where(bad, 0, values)
    wrong = np.concatenate([[0], np.cumsum(bad)])
    takes_part = (wrong[offsets[1:]] == wrong[offsets[:-1]]) & ~np.asarray(column.is_null())
    with np.errstate(over="ignore"):
        scaled = np.abs(np.floor(values * SCALE))
        squares = np.minimum(scaled, 1e30) ** 2
    # Summed vector by vector: a vector's kind must not depend on its neighbours.
    sums = np.array([squares[a:b].sum() for a, b in zip(offsets[:-1], offsets[1:])])
    tops = np.array([scaled[a:b].max(initial=0) for a, b in zip(offsets[:-1], offsets[1:])])
    return values, offsets, takes_part, (sums < LARGEST_SQUARES) & (tops < LARGEST)


def _whole(component: float) -> int:
    """floor(256 x), exact; large numbers have no fraction that scaling could bring up."""
    return math.floor(component * SCALE) if abs(component) < 1 << 60 else int(component) * SCALE


def _matrix(parts: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The given vectors as rows, shorter ones filled with zeros."""
    sizes = offsets[rows + 1] - offsets[rows]
    out = np.zeros((len(rows), int(sizes.max(initial=0))), dtype=parts.dtype)
    for size in np.unique(sizes):
        of_size = np.flatnonzero(sizes == size)
        out[of_size, :size] = parts[offsets[rows[of_size]][:, None] + np.arange(size)]
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("ids", pa.binary()), ("parts", pa.binary()), ("n", pa.int32()), ("dim", pa.int32()), ("top", pa.int64())]
    )
    for batch in batches:
        values, offsets, takes_part, plain = _vectors_of(batch.column(1))
        takes_part &= ~np.asarray(batch.column(0).is_null())
        for kind in (plain, ~plain):
            every = np.flatnonzero(takes_part & kind)
            for begin in range(0, len(every), ROWS_PER_BLOCK):
                rows = every[begin : begin + ROWS_PER_BLOCK]
                ids = batch.column(0).take(pa.array(rows)).to_numpy().astype("<i8")
                matrix = _matrix(values, offsets, rows)
                top = -1
                if kind is plain:
                    matrix = np.floor(matrix * SCALE).astype("<i4")
                    top = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)))
                block = {"ids": ids.tobytes(), "parts": matrix.tobytes(), "n": len(ids), "dim": matrix.shape[1], "top": top}
                yield pa.RecordBatch.from_pylist([block], schema=schema)


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["parts"], "<i4").reshape(row["n"], row["dim"])


def _unbounded(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """A block of either kind as whole numbers without a bound."""
    ids = np.frombuffer(row["ids"], "<i8")
    if row["top"] >= 0:
        return ids, _unpack(row)[1].astype(object)
    parts = [_whole(x) for x in np.frombuffer(row["parts"], "<f8").tolist()]
    matrix = np.empty(len(parts), dtype=object)
    matrix[:] = parts
    return ids, matrix.reshape(row["n"], row["dim"])


def _as_text(score: int) -> str:
    """Text in the order of the scores."""
    return f"1{score:0{DIGITS}d}" if score >= 0 else f"0{10**DIGITS + score:0{DIGITS}d}"


def _best_unbounded(k: int):
    """(query_id, vec_id, ordered, score): the best of one block of rows for one block of queries, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, rows = _unbounded(row)
                query_ids, queries = _unbounded({c: row[f"q_{c}"] for c in ("ids", "parts", "n", "dim", "top")})
                dim = min(rows.shape[1], queries.shape[1])
                out = []
                for q, query in zip(query_ids.tolist(), queries[:, :dim]):
                    scores = (rows[:, :dim] * query).sum(axis=1).tolist() if dim else [0] * len(ids)
                    found = sorted((-s, i) for s, i in zip(scores, ids.tolist()) if i != q)[:k]
                    out += [(q, i, _as_text(-s), min(max(-s, -(1 << 63)), (1 << 63) - 1)) for s, i in found]
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["query_id", "vec_id", "ordered", "score"]
                    )

    return run


def _ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = pa.array([_as_text(s) for s in batch.column(2).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), text, batch.column(2)], names=["query_id", "vec_id", "ordered", "score"]
        )


def _scores(queries: np.ndarray, rows: np.ndarray, query_ids, ids) -> tuple[np.ndarray, np.ndarray]:
    """Inner products, and which of them count (not a query with itself)."""
    dim = min(queries.shape[1], rows.shape[1])
    a, b = queries[:, :dim], rows[:, :dim]
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * dim
    # Sums below 2**53 are exact in floating point, which multiplies much faster.
    exact = np.float64 if largest < 1 << 53 else np.int64
    product = a.astype(exact) @ b.astype(exact).T
    return product.astype(np.int64), query_ids[:, None] != ids[None, :]


def _counts(k: int):
    """Rows of (query_id, bin, found): complete counts of the bins that can hold the k-th score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, rows = _unpack({c: batch.column(c)[at].as_py() for c in ("ids", "parts", "n", "dim")})
                query_ids, queries, low, span = _queries(batch.column("queries"), at)
                scores, counts = _scores(queries, rows, query_ids, ids)
                width = -(-span // BINS)
                above_low = scores - low[:, None]
                bins = np.where(counts & (above_low >= 0) & (above_low < span), above_low // width, -1)
                best = min(k, bins.shape[1])
                # A task with fewer scores than wanted in the range sends all its bins.
                floor = np.partition(bins, bins.shape[1] - best, axis=1)[:, bins.shape[1] - best]
                floor = np.maximum(floor, 0) if best == k else np.zeros(len(bins), dtype=np.int64)
                which, where = np.nonzero(bins >= floor[:, None])
                keys, found = np.unique(which * BINS + bins[which, where], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[keys // BINS]), pa.array(keys % BINS), pa.array(found)],
                    names=["query_id", "bin", "found"],
                )

    return run


def _best(k: int):
    """Rows of (query_id, vec_id, score): at or above the k-th score, at most k per block, ties by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, rows = _unpack({c: batch.column(c)[at].as_py() for c in ("ids", "parts", "n", "dim")})
                query_ids, queries, low, _ = _queries(batch.column("queries"), at)
                by_id = np.argsort(ids, kind="stable")
                ids, rows = ids[by_id], rows[by_id]
                scores, counts = _scores(queries, rows, query_ids, ids)
                which, where = np.nonzero(counts & (scores >= low[:, None]))
                found = scores[which, where]
                order = np.lexsort((where, -found, which))
                which, where, found = which[order], where[order], found[order]
                first = np.searchsorted(which, which, side="left")
                kept = np.arange(len(which)) - first < k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[which[kept]]), pa.array(ids[where[kept]]), pa.array(found[kept])],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def _queries(column: pa.Array, at: int):
    entries = column.slice(at, 1).flatten()
    parts = entries.field("parts")
    flat = np.frombuffer(b"".join(parts.to_pylist()), "<i4")
    ids = entries.field("query_id").to_numpy()
    low, span = entries.field("low").to_numpy(), entries.field("span").to_numpy()
    return ids, flat.reshape(len(ids), -1), low, int(span[0])


def _one_per_query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unpack blocks of query vectors into rows of (query_id, parts)."""
    for batch in batches:
        for row in batch.select(["ids", "parts", "n", "dim", "most"]).to_pylist():
            ids, matrix = _unpack(row)
            wide = np.zeros((row["n"], row["most"]), "<i4")
            wide[:, : row["dim"]] = matrix
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array([v.tobytes() for v in wide], type=pa.binary())],
                names=["query_id", "parts"],
            )


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of ``vectors`` for each query.

    The score is the inner product of floor(256 x) of the components; equal scores go by smaller
    id. A query is not compared with rows that carry its own id. Vectors that are null or hold
    null, NaN or infinite components take no part, nor do null ids. Of vectors of unequal length the
    missing components count as zero, so an empty vector scores 0. Scores are put in order exactly; one
    beyond a long is given as the long next to it. A query id that repeats is answered once, for the
    smallest of its vectors that take part; repeated rows among ``vectors`` are candidates each.
    Without rows or queries the result is empty. Other columns are not read.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    numbers = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    asked = queries.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    asked = asked.where(numbers).groupBy("id").agg(F.min("v").alias("v"))
    every_block = staged(bounded_batches(rows).mapInArrow(_pack, BLOCKS), "topk-rows")
    every_asked = staged(asked.mapInArrow(_pack, BLOCKS), "topk-queries")
    blocks, asked = every_block.where("top >= 0"), every_asked.where("top >= 0")

    most = every_block.agg(F.max("top"), F.max("dim"), F.min("top")).first()
    also = every_asked.agg(F.max("top"), F.max("dim"), F.sum(F.when(F.col("top") >= 0, F.col("n"))), F.min("top")).first()
    dim, count = also[1] or 0, also[2] or 0
    some_unbounded = min(most[2] or 0, also[3] or 0) < 0
    # Any score of plain vectors lies within this of zero.
    reach = min(max(most[0] or 0, 0) * max(also[0] or 0, 0) * min(most[1] or 0, dim), (1 << 62) - 1)
    vectors_asked = staged(
        asked.withColumn("most", F.lit(dim)).mapInArrow(_one_per_query, "query_id long, parts binary"), "topk-asked"
    )
    n_blocks = -(-count // QUERIES_PER_BLOCK) or 1
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    against = blocks.select("ids", "parts", "n", "dim", everywhere.alias("q"))

    def pairs(state: DataFrame, span: int) -> DataFrame:
        """Every block of rows beside every block of queries; the k-th scores lie in low .. low + span - 1."""
        entry = F.struct("query_id", "parts", "low", F.lit(span).cast("long").alias("span"))
        packed = (
            vectors_asked.join(state, "query_id")
            .groupBy(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int").alias("q"))
            .agg(F.collect_list(entry).alias("queries"))
        )
        return against.join(broadcast_if_small(packed, count, 4 * dim + 64), "q").drop("q")

    span = 2 * reach + 1
    state = vectors_asked.select(
        "query_id", F.lit(-reach).cast("long").alias("low"), F.lit(k).cast("long").alias("need")
    )
    while span > 1 and count:
        width = -(-span // BINS)
        found = (
            pairs(state, span)
            .mapInArrow(_counts(k), "query_id long, bin long, found long")
            .groupBy("query_id", "bin")
            .agg(F.sum("found").alias("found"))
        )
        above = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        located = (
            found.withColumn("upto", F.sum("found").over(above))
            .join(state, "query_id")
            .where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("found") < F.col("need")))
            .select(
                "query_id",
                (F.col("low") + F.col("bin") * width).alias("at"),
                (F.col("need") - F.col("upto") + F.col("found")).alias("still"),
            )
        )
        # Queries with fewer than k rows to choose from keep the lowest bin and return them all.
        state = staged(
            state.join(located, "query_id", "left").select(
                "query_id", F.coalesce("at", "low").alias("low"), F.coalesce("still", "need").alias("need")
            ),
            "topk-state",
        )
        span = width
    best = pairs(state, 1).mapInArrow(_best(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    if some_unbounded:
        against_all = every_asked.select(*[F.col(c).alias(f"q_{c}") for c in every_asked.columns])
        # A row or query that is not plain makes a pair of blocks one for whole numbers. Every block of
        # queries meets every block of rows once, as in the histograms.
        paired = every_block.join(
            broadcast_if_small(against_all, (also[2] or 0) + 1, 8 * dim + 64), (F.col("top") < 0) | (F.col("q_top") < 0)
        )
        exact = paired.mapInArrow(_best_unbounded(k), "query_id long, vec_id long, ordered string, score long")
        plain = best.mapInArrow(_ordered, exact.schema)
        best = exact.unionByName(plain)
        order = Window.partitionBy("query_id").orderBy(F.desc("ordered"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
