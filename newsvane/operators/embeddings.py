"""Word vectors that are the same in every run: windowed counts, association, leading eigenvectors.

1. Words within a window of each other are counted, nearer ones for more. The counts are whole numbers.
2. A pair's positive pointwise mutual information says how much oftener than by chance it occurs.
3. The leading eigenvectors of that symmetric matrix come from block power iteration: every round
   multiplies the matrix with a narrow block and makes its columns orthonormal. Matrix, block and
   sums are whole numbers (fixed point), so a sum is the same in any order and on any number of
   cores. Matrix and block lie in tables by groups of words (`newsvane.operators.products`); the
   block is shuffled to the matrix and never passes through the driver.

There is no bound on the vocabulary: rare words are left out by their count alone, a parameter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsvane.functions.numeric import round_to
from newsvane.operators import pair_counts, vector_blocks
from newsvane.operators.products import BATCH_BYTES, Cells
from newsvane.operators.ranking import global_rank
from newsvane.session import broadcast_if_small, discard, frugal, hashed, stage

WINDOW, MIN_COUNT, SIZE, ROUNDS = 5, 3, 64, 8
# Fixed point: entries of the matrix have 16 bits behind the point, those of the block 20. A row of a
# million entries then sums up to less than 2**62.
MATRIX_BITS, BLOCK_BITS = 16, 20
SEED = 42
# What a word and its number take in a broadcast table, about, and an entry of a list of numbers.
WORD_BYTES, NUMBER_BYTES = 64, 8
BLOCKS_PER_FILE = 32
# A broadcast is made on the driver, in several copies; a table of words grows with the corpus.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024


class PairCounts:
    """The counted pairs of a corpus, words as numbers: 0 the most frequent.

    Documents are staged as blocks: a block's words once each, and the places of its tokens among
    them. So a word meets the vocabulary once per block, not once per token. Pairs of numbers are
    combined over many blocks before the shuffle, where each takes some bytes, and are cut by their rarer
    word: a word of rank r has at most r of those, and a rare one few, so no bucket is much larger
    than others. Words that occur less than ``min_count`` times are left out, but keep their place.
    """

    def __init__(self, df: DataFrame, tokens: str, window: int, min_count: int):
        if not 0 < window < 1 << pair_counts.WEIGHT_BITS:
            raise ValueError("the window is too wide")
        self._spark, self._window, self.paths = df.sparkSession, window, []
        made = df.select(tokens).mapInArrow(pair_counts.blocks, pair_counts.BLOCK_SCHEMA)
        blocks = self._stage(made.withColumn("block", F.monotonically_increasing_id()), "blocks", BLOCKS_PER_FILE)
        words = blocks.selectExpr("block", "posexplode(arrays_zip(words, counts)) AS (at, w)").selectExpr(
            "block", "at", "w.words AS term", "w.counts AS n"
        )
        counts = words.groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
        ranked = global_rank(counts, [F.desc("n"), F.asc("term")], "rank")
        self.words = self._stage(ranked.select((F.col("rank") - 1).cast("int").alias("id"), "term", "n"), "words")
        size = self.words.agg(F.count("*"), F.sum("n")).first()
        self.size, pairs = size[0], (size[1] or 0) * window
        if self.size >= 1 << pair_counts.PLACE_BITS:
            raise ValueError("too many words for the numbers of a pair")
        self._buckets = max(1, -(-pairs // pair_counts.PAIRS_AT_ONCE))
        numbered = hashed(self.words.select("id", "term"), self.size, WORD_BYTES, BROADCAST_LIMIT_BYTES)
        known = words.select("block", "at", "term").join(numbered, "term")
        listed = known.groupBy("block").agg(F.collect_list(F.struct("at", "id")).alias("e"))
        listed = listed.selectExpr("block", "transform(e, e -> e.at) AS ats", "transform(e, e -> e.id) AS ids")
        self._blocks = self._stage(blocks.select("block", "codes", "lengths").join(listed, "block").drop("block"), "coded", BLOCKS_PER_FILE)
        discard(self._spark, self.paths[:1])
        del self.paths[0]

    def _stage(self, df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
        made, path = stage(df, f"pair-{name}", rows_per_file)
        self.paths.append(path)
        return made

    def pairs(self) -> DataFrame:
        """(first, second, n) of every pair, first the more frequent word."""
        parts = self._blocks.mapInArrow(pair_counts.pairs_of(self._window, self._buckets), "bucket int, keys binary, counts binary")
        return parts.groupBy("bucket").applyInArrow(pair_counts.counted, "first int, second int, n bigint")

    def sides(self) -> DataFrame:
        """(id, n): what all pairs of a word count, a pair of a word with itself on both sides."""
        parts = self._blocks.mapInArrow(pair_counts.sides_of(self._window), "id int, n bigint")
        return self._stage(parts.groupBy("id").agg(F.sum("n").alias("n")), "sides")

    def named(self, pairs: DataFrame) -> DataFrame:
        """The pairs with their words, a <= b, for first and second."""
        words = broadcast_if_small(self.words.select("id", "term"), self.size, WORD_BYTES, BROADCAST_LIMIT_BYTES)
        left, right = (words.select(F.col("id").alias(i), F.col("term").alias(t)) for i, t in (("first", "t1"), ("second", "t2")))
        both = pairs.join(left, "first").join(right, "second")
        return both.select(F.least("t1", "t2").alias("a"), F.greatest("t1", "t2").alias("b"), *[c for c in pairs.columns if c not in ("first", "second")])


def cooccurrence(df: DataFrame, tokens: str, window: int = WINDOW, min_count: int = MIN_COUNT) -> DataFrame:
    """(a, b, n), a <= b: how often two words stand within ``window`` words of each other.

    Neighbours count ``window`` times, words at the window's end once: what a window of random width
    would count on average, times ``window``. Words that occur less than ``min_count`` times are left
    out, but keep their place between others. See `PairCounts`.
    """
    counts = PairCounts(df, tokens, window, min_count)
    return counts.named(counts.pairs())


def _associated(pairs: DataFrame, sides: DataFrame, a: str, b: str, key: str, words: int) -> DataFrame:
    """Pairs with ``ppmi``, from what each word's pairs count (``key``, n), ``words`` of them or ids below that."""
    total = sides.agg(F.sum("n")).scalar()
    if key == "id" and words * NUMBER_BYTES <= BROADCAST_LIMIT_BYTES:
        # Words that are numbers find their counts by place, in lists that take 8 bytes a word.
        cut = sides.select(F.expr(f"CAST(id div {pair_counts.SIDES_AT_ONCE} AS int)").alias("part"), "id", "n")
        lists = F.broadcast(cut.groupBy("part").applyInArrow(pair_counts.listed_sides, "part int, ns array<bigint>"))
        for column, n in ((a, "n_a"), (b, "n_b")):
            place = F.col(column) % pair_counts.SIDES_AT_ONCE
            here = F.expr(f"CAST({column} div {pair_counts.SIDES_AT_ONCE} AS int)") == F.col("part")
            pairs = pairs.join(lists, here).withColumn(n, F.get("ns", place)).drop("part", "ns")
    else:
        held = broadcast_if_small(sides, words, WORD_BYTES, BROADCAST_LIMIT_BYTES)
        pairs = pairs.join(held.select(F.col(key).alias(a), F.col("n").alias("n_a")), a)
        pairs = pairs.join(held.select(F.col(key).alias(b), F.col("n").alias("n_b")), b)
    # A pair of a word with itself fills one cell of the matrix with both its sides.
    cell = F.when(F.col(a) == F.col(b), 2 * F.col("n")).otherwise(F.col("n")).cast("double")
    share = cell * F.col("every").cast("double") / (F.col("n_a").cast("double") * F.col("n_b").cast("double"))
    scored = pairs.withColumn("every", total).withColumn("share", share)
    return scored.where("share > 1").select(a, b, "n", round_to(F.ln("share"), 6).alias("ppmi")).where("ppmi > 0")


def ppmi(pairs: DataFrame) -> DataFrame:
    """(a, b, n, ppmi) of the pairs (a, b, n) that occur oftener than by chance: ln(n x all / (n of a x n of b)).

    A word's count is that of all its pairs, from either side; a pair of a word with itself counts
    on both. ``pairs`` is read twice: a table, or a corpus by `corpus_ppmi`.
    """
    sides, _ = stage(pairs.select(F.explode(F.array("a", "b")).alias("term"), "n").groupBy("term").agg(F.sum("n").alias("n")), "pair-sides")
    return _associated(pairs, sides, "a", "b", "term", sides.count())


def corpus_ppmi(df: DataFrame, tokens: str, window: int = WINDOW, min_count: int = MIN_COUNT) -> DataFrame:
    """`ppmi` of `cooccurrence`, scored while words are numbers."""
    counts = PairCounts(df, tokens, window, min_count)
    return counts.named(_associated(counts.pairs(), counts.sides(), "first", "second", "id", counts.size))


class _Matrix:
    """One half of a symmetric matrix, entries (first, second, ppmi) of words below ``ids``, staged once, in cells."""

    def __init__(self, entries: DataFrame, ids: int):
        spark = entries.sparkSession
        self.grid = vector_blocks.Grid.of(ids, spark.sparkContext.defaultParallelism)
        numbers = vector_blocks.cell_numbers(self.grid.rows, self.grid.groups)
        weight = F.rint(F.col("ppmi") * (1 << MATRIX_BITS)).cast("bigint").alias("w")
        pieces = entries.select("first", "second", weight).mapInArrow(
            vector_blocks.cut_into_cells(self.grid, numbers), vector_blocks.PIECE_SCHEMA
        )
        self.cells = Cells(pieces, self.grid, numbers)


def _vectors(matrix: _Matrix, words: DataFrame, size: int, rounds: int, seed: int) -> DataFrame:
    """(term, vector) from the matrix and the words (id, term). The matrix is deleted.

    In a round the block is shuffled in parts to the tasks that hold the rows of the matrix, a few large
    rows and never a row per entry, and sums are staged. What reaches the driver is as wide as a vector.
    """
    cells, grid = matrix.cells, matrix.grid
    spark, numbers, paths = words.sparkSession, cells.numbers, []

    def held(df: DataFrame) -> DataFrame:
        made, path = stage(df, "vector-sums", 1)
        paths.append(path)
        return made

    met = cells.table.select("r", "rows").mapInArrow(vector_blocks.rows_of_cells(grid), "id int").distinct()
    terms, terms_path = stage(words.select("id", "term").join(met, "id"), "vector-terms")
    known = terms.count()
    width = max(1, min(size, known))

    def summed(sums: DataFrame, start: np.ndarray, part, join) -> np.ndarray:
        total = start
        for (m,) in sums.mapInArrow(vector_blocks.reduced(start, part, join), "m binary").collect():
            total = join(total, np.frombuffer(m, "<i8").reshape(start.shape))
        return total

    seeds = terms.select((F.col("id") % grid.groups).alias("p"), "id", F.pmod(F.xxhash64("term", F.lit(seed)), F.lit((1 << 63) - 1)).alias("seed"))
    block = seeds.groupBy("p").applyInArrow(vector_blocks.started(grid, width, BLOCK_BITS, numbers), vector_blocks.BLOCK_SCHEMA)
    sums, scale = None, np.ones(width)
    for _ in range(rounds):
        before, sums = paths[:], held(cells.times(block, width))
        discard(spark, before)
        del paths[: len(before)]
        top = summed(sums, np.zeros(width, np.int64), lambda y: np.abs(y).max(axis=0, initial=0), np.maximum)
        gram = summed(
            sums, np.zeros((width, width), np.int64), lambda y, top=top: vector_blocks.products(y, top, BLOCK_BITS), np.add
        )
        unit = gram.astype(np.float64) / float(1 << 2 * BLOCK_BITS)
        # A column that depends on those before it gets nothing but rounding: held up by a small ridge.
        factor = np.linalg.cholesky(unit + np.eye(width) * 1e-12 * max(1.0, np.trace(unit)))
        turn = np.linalg.inv(factor).T
        scale = np.sqrt(np.diag(unit)) * top / float(1 << MATRIX_BITS + BLOCK_BITS)
        block = sums.mapInArrow(vector_blocks.turned(width, top, turn, BLOCK_BITS, numbers), vector_blocks.BLOCK_SCHEMA)
    unit = np.concatenate([[float(1 << MATRIX_BITS + BLOCK_BITS)], np.sqrt(np.maximum(scale, 1e-300))])
    cells.discard()
    rows = sums.mapInArrow(vector_blocks.finished(grid, width, size, unit), "id int, vector array<double>")
    named = hashed(terms, known, WORD_BYTES, BROADCAST_LIMIT_BYTES)
    made, _ = stage(rows.join(named, "id").select("term", "vector"), "vectors")
    discard(spark, [*paths, terms_path])
    return made


def word_vectors(pairs: DataFrame, size: int = SIZE, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(term, vector): ``size`` numbers per word of the pairs (a, b, ppmi), a <= b, as `ppmi` gives them.

    Column j is about the j-th eigenvector times the root of its eigenvalue. The number of rounds is
    fixed, so the result depends on nothing but the pairs and the seed. Fewer words than ``size``
    leave the last numbers zero. The result is a staged table in the shared folder. ``pairs`` is read twice.
    """
    counts = pairs.select(F.explode(F.array("a", "b")).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    ranked = global_rank(counts, [F.desc("n"), F.asc("term")])
    words, path = stage(ranked.select((F.col("rank") - 1).cast("int").alias("id"), "term"), "vector-words")
    ids = words.count()
    known = broadcast_if_small(words, ids, WORD_BYTES, BROADCAST_LIMIT_BYTES)
    left, right = known.toDF("first", "a"), known.toDF("second", "b")
    with frugal(pairs.sparkSession, BATCH_BYTES):
        made = _vectors(_Matrix(pairs.join(left, "a").join(right, "b"), ids), words, size, rounds, seed)
    discard(pairs.sparkSession, [path])
    return made


def fit(
    df: DataFrame, tokens: str, size: int = SIZE, window: int = WINDOW, min_count: int = MIN_COUNT, rounds: int = ROUNDS
) -> DataFrame:
    """(term, vector) of a corpus, from its token lists: counted once, staged, the same in every run."""
    with frugal(df.sparkSession, BATCH_BYTES):
        counts = PairCounts(df, tokens, window, min_count)
        matrix = _Matrix(_associated(counts.pairs(), counts.sides(), "first", "second", "id", counts.size), counts.size)
        words_path, *others = counts.paths
        discard(df.sparkSession, others)
        made = _vectors(matrix, counts.words, size, rounds, SEED)
        discard(df.sparkSession, [words_path])
    return made
