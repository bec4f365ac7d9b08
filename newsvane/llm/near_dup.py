"""Near-duplicate documents by HyperMinHash.

1. A document's set of word shingles is hashed. A sketch has 256 buckets; a bucket keeps, for
   the smallest hash that falls into it, the number of leading zeros and ten bits behind them.
   Sets of few shingles would leave buckets empty, so each shingle enters a sketch under as many
   salts as bring the entries to 2048 at least; that leaves the similarity of two sets unchanged.
2. Documents with equal sets are one class, represented by the smallest id.
3. The registers are cut into bands, of 7 for a similarity of 0.85 and of 6 for 0.8: as long as two
   sets at the threshold miss each other in all bands less than once in 300 000 times. Representatives that agree in a band share a bucket;
   buckets with the same members are kept once.
4. In a bucket, similarity is estimated from the share of equal registers, corrected for registers
   that agree by accident. Estimates far below the threshold are dropped; the rest connects
   representatives to candidate groups.
5. Full sets are compared in every candidate group, exactly, and only confirmed links count.

Buckets and groups of any size are cut into blocks that meet pairwise, each pair of blocks in a
task of its own. A block sends its links as a star around the smallest id, never all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField

from newsvane.llm.common import map_texts, staged
from newsvane.llm.components import components
from newsvane.session import broadcast_if_small

# Words of a shingle; linked if 100 * intersection >= percent * union.
SHINGLE, PERCENT = 5, 80
BUCKETS = 256
MANTISSA = 10
# Entries a sketch has at least; sets of at least so many shingles enter under one salt.
ENTRIES_LOG2 = 11
# Registers of different minima agree if zeros and mantissa do: the sum over z of 4**-z, times 2**-10.
ACCIDENT = 2.0**-MANTISSA / 3
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1 << 20
# Cells of a matrix of sets by shingles at once.
MATRIX_CELLS = 2_000_000
CACHED_WORDS = 200_000
EMPTY = 0xFFFF

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_BOUNDS = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(56)


def fewest(percent: int) -> int:
    """Below this many shingles only equal sets reach the threshold."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 30


def band_length(percent: int) -> int:
    """The longest band with which pairs at the threshold are hardly ever missed."""
    alike = percent / 100
    return max(r for r in range(1, 9) if r == 1 or (1 - alike**r) ** (BUCKETS // r) <= 3.3e-6)


def least_estimate(percent: int) -> float:
    """The threshold less five standard deviations of an estimate from all registers."""
    alike = percent / 100
    return alike - 5 * (alike * (1 - alike) / BUCKETS) ** 0.5


def _mixed(z: np.ndarray) -> np.ndarray:
    """A well-mixed permutation of 64-bit numbers."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Shingler:
    """Texts to sorted distinct shingle hashes. Keeps the hashes of words it has seen."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.words: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        # Bytes are lowered and split in ASCII only, which is what the operator's words ask for.
        words = (text or "").encode("utf-8", "replace").lower().split()
        known = self.words
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.array([known[w] for w in words], dtype=np.uint64)
        if not len(hashes):
            return hashes
        size = min(self.size, len(hashes))
        total = np.full(len(hashes) - size + 1, size, dtype=np.uint64)
        for k in range(size):
            # Odd multipliers, one per place, so that the order of the words counts.
            total += hashes[k : len(hashes) - size + 1 + k] * (_MULTIPLIERS[k % 3] + np.uint64(2 * k))
        return np.unique(_mixed(total))


def level_of(n: int) -> int:
    """The power of two of salts under which a set of ``n`` shingles enters its sketch."""
    return max(0, ENTRIES_LOG2 - (n.bit_length() - 1))


def sketch(shingles: np.ndarray, level: int) -> np.ndarray:
    """256 registers of leading zeros and mantissa."""
    salts = _mixed(np.arange(1, (1 << level) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    entries = np.sort(_mixed((shingles[None, :] + salts[:, None]).ravel()))
    first = np.searchsorted(entries, _BOUNDS)
    inside = first < len(entries)
    least = entries[np.minimum(first, len(entries) - 1)]
    inside &= (least >> np.uint64(56)) == np.arange(BUCKETS, dtype=np.uint64)
    rest = (least << np.uint64(8)) | np.uint64(1 << 7)
    # The exponent of the number; rounding up to a power of two is undone by the comparison.
    bits = np.frexp(rest.astype(np.float64))[1].astype(np.uint64)
    bits -= (rest < (np.uint64(1) << (bits - np.uint64(1)))).astype(np.uint64)
    zeros = np.uint64(64) - bits
    mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return np.where(inside, zeros << np.uint64(MANTISSA) | mantissa, EMPTY).astype(np.uint16)


def estimate(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated similarity of one sketch with each row of others, corrected for accidents."""
    used = (others != EMPTY) | (one != EMPTY)
    share = ((others == one) & used).sum(1) / np.maximum(1, used.sum(1))
    return (share - ACCIDENT) / (1 - ACCIDENT)


def band_keys(registers: np.ndarray, level: int, length: int) -> np.ndarray:
    bands = BUCKETS // length
    padded = np.zeros((bands, 8), dtype=np.uint16)
    padded[:, :length] = registers[: bands * length].reshape(bands, length)
    parts = padded.view(np.uint64)
    number = np.arange(len(parts), dtype=np.uint64) + np.uint64(level << 16)
    return _mixed(_mixed(parts[:, 0] + number * _MULTIPLIERS[0]) + parts[:, 1] * _MULTIPLIERS[1]).view(np.int64)


def _described(docs: DataFrame, doc_id: str, text: str, shingle: int, percent: int) -> DataFrame:
    """(id, n, d1, d2, level, sketch): size, digest and sketches of every document's set.

    A set whose partners may enter under fewer salts has the sketch for those as well.
    """
    fields = [
        StructField("n", LongType()), StructField("d1", LongType()), StructField("d2", LongType()),
        StructField("level", IntegerType()), StructField("sketch", BinaryType()),
    ]

    def factory():
        shingler = Shingler(shingle)
        least = fewest(percent)

        def work(texts):
            out = [[] for _ in fields]
            for t in texts:
                shingles = shingler(t)
                n = len(shingles)
                digest = np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), "<i8")
                level = level_of(max(1, n))
                sketches = b""
                if n >= least:
                    levels = {level, level_of(n * 100 // percent)}
                    sketches = b"".join(sketch(shingles, k).tobytes() for k in sorted(levels, reverse=True))
                for column, value in zip(out, (n, int(digest[0]), int(digest[1]), level, sketches)):
                    column.append(value)
            return out

        return work

    return map_texts(docs, text, [doc_id], fields, factory).withColumnRenamed(doc_id, "id")


def _bands(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    size = BUCKETS * 2
    for batch in batches:
        ids, keys, slots = [], [], []
        for i, level, data in zip(*(batch.column(c).to_pylist() for c in ("id", "level", "sketch"))):
            for k in range(len(data) // size):
                made = band_keys(np.frombuffer(data, np.uint16, BUCKETS, k * size), level - k, length)
                keys.append(made)
                ids.append(np.full(len(made), i))
                slots.append(np.full(len(made), k, dtype=np.int32))
        if ids:
            columns = [pa.array(np.concatenate(c)) for c in (keys, ids, slots)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "id", "slot"])


def _cut_into_blocks(rows: DataFrame, key: str, blocks: str) -> DataFrame:
    """Give every row to each pair of blocks that holds its own block; one block meets itself only."""
    own = F.pmod(F.xxhash64("id"), F.col(blocks)).cast("long")
    return (
        rows.withColumn("__own", own)
        .withColumn("__other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
        .where((F.col("__own") != F.col("__other")) | (F.col(blocks) == 1))
        .withColumn("part", F.least("__own", "__other") * F.col(blocks) + F.greatest("__own", "__other"))
        .drop("__own", "__other", blocks)
        .repartition(key, "part")
        .sortWithinPartitions(key, "part")
    )


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal values in the first ``keys`` columns, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in range(keys)]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, stop in zip(edges[:-1], edges[1:]):
            now = tuple(c[start] for c in columns)
            if now != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _stars(ids: np.ndarray, similar: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links of all rows to the smallest id of their component, which ``similar`` spans.

    Rows are visited from one to the next, and only rows not reached yet are compared.
    """
    order = np.argsort(ids, kind="stable")
    left = order
    u, v = [], []
    while len(left):
        root, left = left[0], left[1:]
        front = np.array([root])
        while len(front) and len(left):
            reached = similar(front, left)
            front, left = left[reached], left[~reached]
            u.append(ids[front])
            v.append(np.full(len(front), ids[root]))
    return (np.concatenate(u), np.concatenate(v)) if u else (ids[:0], ids[:0])


def _links(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _likely(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Links of likely partners within each bucket, by the sketches of the bucket's level."""
    for group in _groups(batches, 2):
        ids = group.column("id").to_numpy()
        registers = np.stack([np.frombuffer(b.as_py(), np.uint16) for b in group.column("sketch")])

        def similar(front: np.ndarray, left: np.ndarray) -> np.ndarray:
            reached = np.zeros(len(left), dtype=bool)
            others = registers[left]
            for one in front:
                rest = np.flatnonzero(~reached)
                if not len(rest):
                    break
                reached[rest] = estimate(registers[one], others[rest]) >= least
            return reached

        yield _links(*_stars(ids, similar))


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links within each candidate group, by full sets."""
    for group in _groups(batches, 2):
        ids = group.column("id").to_numpy()
        sets = [np.frombuffer(b.as_py(), np.uint64) for b in group.column("shingles")]
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        names, place, copies = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # Shingles of one set only add to no intersection.
        shared = copies > 1
        column = np.cumsum(shared) - 1
        held = shared[place]
        owner, place = owner[held], column[place[held]]
        starts = np.searchsorted(owner, np.arange(len(sets) + 1))
        width = int(shared.sum())

        def similar(front: np.ndarray, left: np.ndarray) -> np.ndarray:
            reached = np.zeros(len(left), dtype=bool)
            step = max(1, MATRIX_CELLS // max(1, width))
            for begin in range(0, len(front), min(64, step)):
                some = front[begin : begin + min(64, step)]
                rest = np.flatnonzero(~reached)
                if not len(rest):
                    break
                flags = np.zeros((len(some), width), dtype=np.float32)
                for row, one in enumerate(some):
                    flags[row, place[starts[one] : starts[one + 1]]] = 1
                for chunk in range(0, len(rest), step):
                    part = rest[chunk : chunk + step]
                    rows = left[part]
                    matrix = np.zeros((len(rows), width), dtype=np.float32)
                    for row, one in enumerate(rows):
                        matrix[row, place[starts[one] : starts[one + 1]]] = 1
                    both = np.rint(flags @ matrix.T).astype(np.int64)
                    union = sizes[some][:, None] + sizes[rows][None, :] - both
                    reached[part] = (100 * both >= percent * union).any(0)
            return reached

        yield _links(*_stars(ids, similar))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Words are what lies between ASCII blanks, A-Z in lower case; a document of fewer than
    ``shingle`` is one shingle. Documents are linked if 100 * intersection >= ``percent`` * union; ``component_id`` is the
    smallest id a document reaches over links, ``kept`` says that it is its own. Null, empty and
    blank texts have no shingles and are linked with nothing. Rows without an id are linked with
    nothing, have no component and are kept. Rows that share an id are one document to links: what
    is linked with one is linked with the other. Texts are read whole. Other columns are not read.
    """
    length, least = band_length(percent), least_estimate(percent)
    described = staged(_described(docs, doc_id, text, shingle, percent), "near-sketches")
    linkable = described.where((F.col("n") > 0) & F.col("id").isNotNull())
    classes = staged(linkable.groupBy("d1", "d2").agg(F.min("id").alias("class")), "near-classes")
    representatives = staged(
        linkable.where(F.col("n") >= fewest(percent))
        .join(classes.withColumnRenamed("class", "id"), ["d1", "d2", "id"])
        .dropDuplicates(["d1", "d2", "id"])
        .select("id", "n", "level", "sketch"),
        "near-representatives",
    )
    bands = staged(
        representatives.select("id", "level", "sketch").mapInArrow(lambda b: _bands(b, length), "key long, id long, slot int"), "near-bands"
    )
    buckets = (
        bands.groupBy("key")
        .agg(F.count("*").alias("size"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("members"))
        .where("size > 1")
        .groupBy("size", "members")
        .agg(F.min("key").alias("key"))
        .select("key", F.ceil(F.col("size") / BLOCK_ROWS).alias("blocks"))
    )
    # A bucket is of one level of salts, and so is the sketch its rows are compared by.
    own = F.expr(f"substring(sketch, slot * {2 * BUCKETS} + 1, {2 * BUCKETS})")
    in_buckets = (
        bands.join(buckets, "key")
        .join(representatives.select("id", "sketch"), "id")
        .select("key", "id", "blocks", own.alias("sketch"))
    )
    likely = staged(
        _cut_into_blocks(in_buckets, "key", "blocks").select("key", "part", "id", "sketch").mapInArrow(lambda b: _likely(b, least), "u long, v long"),
        "near-likely",
    )
    candidates = staged(components(likely), "near-candidates")
    count = candidates.count()
    ids = broadcast_if_small(candidates.select(F.col("id").alias(doc_id)), count, 16)
    sets = map_texts(
        docs.select(doc_id, text).join(ids, doc_id, "left_semi"), text, [doc_id],
        [StructField("shingles", BinaryType())], lambda: _sets(shingle),
    ).withColumnRenamed(doc_id, "id")
    sizes = (
        candidates.join(representatives.select("id", "n"), "id")
        .groupBy("component")
        .agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    )
    grouped = sets.join(broadcast_if_small(candidates.join(sizes, "component"), count, 32), "id")
    confirmed = staged(
        _cut_into_blocks(grouped, "component", "blocks")
        .select("component", "part", "id", "shingles")
        .mapInArrow(lambda b: _confirmed(b, percent), "u long, v long"),
        "near-confirmed",
    )
    reached = components(confirmed).withColumnRenamed("id", "class")
    labelled = classes.join(reached, "class", "left").select(
        "d1", "d2", F.coalesce("component", "class").alias("component")
    )
    every = described.select("id", "n", "d1", "d2")
    linked = (F.col("n") > 0) & F.col("id").isNotNull()
    component = F.when(linked, F.col("component")).otherwise(F.col("id"))
    return every.join(labelled, ["d1", "d2"], "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _sets(shingle: int):
    shingler = Shingler(shingle)
    return lambda texts: [[shingler(t).tobytes() for t in texts]]


def drop_ids(docs: DataFrame, ids: DataFrame, doc_id: str) -> DataFrame:
    """The documents, all columns, without those of the distinct ids; rows without an id stay.

    The ids to drop are fewer than those to keep, and a copy's text is not wanted any more.
    """
    dropped = staged(ids.select(F.col(doc_id).alias("__dropped")), "near-dropped")
    known = broadcast_if_small(dropped, dropped.count(), 16)
    return docs.join(known, F.col(f"`{doc_id}`") == F.col("__dropped"), "left_anti")
