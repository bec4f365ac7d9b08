"""Array-of-double vectors: dominant entry, nearest neighbours, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructType

from newsvane.functions.numeric import MICROS, round_to, to_micros
from newsvane.operators import article_blocks, vector_blocks
from newsvane.operators.products import BATCH_BYTES, Cells
from newsvane.operators.ranking import top_n
from newsvane.operators.terms import explode_terms
from newsvane.session import discard, frugal, hashed, stage

# What a word takes in a broadcast table beside its vector, about.
WORD_BYTES = 100
# A broadcast is made on the driver, in several copies; a table of words grows with the corpus.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
BLOCKS_PER_FILE = 32


def dominant_index(vector: Column) -> Column:
    """Position of the largest entry, from 0; the first one on a tie."""
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("bigint")


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0).cast("bigint"), lambda total, x: total + x)


def nearest_vectors(df: DataFrame, key: str, vector: str, query_key: int | str, n: int) -> DataFrame:
    """The ``n`` vectors most similar to one of them by cosine, itself left out.

    Entries are taken as fixed-point integers, so the dot products are exact. With six decimals and
    a thousand entries, entries up to 90 fit into 64 bits; larger vectors are to be scaled first,
    which no cosine notices. A larger sum fails, it does not wrap.
    """
    fixed = df.select(key, F.transform(F.col(vector).cast("array<double>"), to_micros).alias("v"))
    # The query is one vector, looked up once by its key.
    query = fixed.where(F.col(key) == query_key).select("v").limit(1).scalar()
    paired = fixed.where(F.col(key) != query_key).withColumn("q", query)
    norms = _dot(F.col("v"), F.col("v")).cast("double") * _dot(F.col("q"), F.col("q")).cast("double")
    cosine = F.try_divide(_dot(F.col("v"), F.col("q")).cast("double"), F.sqrt(norms))
    scored = paired.select(key, round_to(cosine, 6).alias("cosine"))
    return top_n(scored, [F.desc("cosine"), F.asc(key)], n)


def document_vectors(df: DataFrame, keys: Sequence[str], tokens: str, words: DataFrame, size: int) -> DataFrame:
    """(keys, known_words, vector): the mean vector of an article's known words, from a stored table
    (term, vector of ``size`` entries).

    Entries are summed as fixed-point integers, in any order the same. Words meet their vectors where
    they are read, and a task adds up whole articles, so one row per article is moved. A table of words
    beyond the limit of a broadcast is shuffled, see `_sums_by_shuffle`. Articles without a known word have no vector.
    """
    entries = [to_micros(F.get("vector", F.lit(i)).cast("double")) for i in range(size)]
    if words.count() * (8 * size + WORD_BYTES) <= BROADCAST_LIMIT_BYTES:
        here = words.select("term", *[entry.alias(f"v{i}") for i, entry in enumerate(entries)])
        found = explode_terms(df, F.col(tokens), *keys).join(F.broadcast(here), "term")
        sums = found.groupBy(*keys).agg(F.count("*").alias("known_words"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(size)])
    else:
        whole = F.array(*[F.coalesce(entry, F.lit(0).cast("bigint")) for entry in entries])
        sums = _sums_by_shuffle(df, keys, tokens, words.select("term", whole.alias("vector")), size)
    mean = F.array(*[F.col(f"v{i}") / F.col("known_words") / float(MICROS) for i in range(size)])
    found = sums.select(*keys, "known_words", mean.alias("vector"))
    return df.select(*keys).join(found, list(keys), "left").withColumn("known_words", F.coalesce("known_words", F.lit(0)))


def _sums_by_shuffle(df: DataFrame, keys: Sequence[str], tokens: str, words: DataFrame, size: int) -> DataFrame:
    """(keys, known_words, v0, ...): sums of whole vectors (term, vector), a staged table; a term occurs once.

    The counts of words by articles are a sparse matrix in cells, and its product with the vectors is that of
    `embeddings`: vectors are shuffled in large parts, once for the articles of each task, not to every token.
    """
    spark, paths = df.sparkSession, []

    def held(frame: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
        made, path = stage(frame, f"article-{name}", rows_per_file)
        paths.append(path)
        return made

    with frugal(spark, BATCH_BYTES):
        lists = df.select(F.col(tokens).alias("tokens"), F.struct(*keys).alias("key"))
        kinds = [("words", ArrayType(StringType())), ("codes", BinaryType()), ("lengths", BinaryType()), ("longest", IntegerType())]
        schema = StructType()
        for name, kind in [*kinds, ("keys", ArrayType(lists.schema["key"].dataType))]:
            schema.add(name, kind)
        made = lists.mapInArrow(article_blocks.blocks, schema).withColumn("block", F.monotonically_increasing_id())
        blocks = held(made, "blocks", BLOCKS_PER_FILE)
        largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
        known, largest = words.agg(F.count("*"), F.max(largest)).first()
        # A row of some numbers for each block of many articles.
        listed = sorted(blocks.select("block", F.size("keys"), "longest").collect())
        if (largest or 0) * max((n for *_, n in listed), default=0) >= 1 << 63:
            raise ArithmeticError("the vectors are too large to be summed in 64 bits")
        places, grid = _places_of_blocks([(block, n) for block, n, _ in listed], known, spark.sparkContext.defaultParallelism)
        places = F.broadcast(spark.createDataFrame(places, "block bigint, r int, first int"))
        groups = max(1, -(-known // vector_blocks.GROUP_WORDS))
        numbers = vector_blocks.cell_numbers(grid.rows, groups)
        kind = "<i4" if (largest or 0) < 1 << 31 else "<i8"
        dealt = words.select(F.pmod(F.xxhash64("term"), F.lit(groups)).cast("int").alias("c"), "term", "vector").where("term IS NOT NULL")
        grouped = dealt.groupBy("c").applyInArrow(
            article_blocks.word_group(numbers, size, kind), f"{vector_blocks.BLOCK_SCHEMA}, terms array<string>"
        )
        grouped = held(grouped, "words", 1)
        numbered = grouped.selectExpr("c", "posexplode(terms) AS (place, term)")
        met = blocks.selectExpr("block", "posexplode(words) AS (at, term)")
        met = met.join(hashed(numbered, known, WORD_BYTES, BROADCAST_LIMIT_BYTES), "term")
        met = met.groupBy("block").agg(F.collect_list(F.struct("at", "c", "place")).alias("e"))
        met = met.selectExpr("block", *[f"transform(e, e -> e.{x}) AS {name}" for x, name in (("at", "ats"), ("c", "groups"), ("place", "places"))])
        coded = blocks.select("block", "codes", "lengths").join(met, "block").join(places, "block").drop("block")
        cells = Cells(coded.mapInArrow(article_blocks.counted_words(numbers), vector_blocks.PIECE_SCHEMA), grid, numbers)
        product = cells.times(grouped.select("c", "x", "cells"), size + 1, kind)
        sums = product.mapInArrow(article_blocks.sums_of_articles(grid, size), "r int, at int, known_words bigint, sums array<bigint>")
        keyed = blocks.select("block", "keys").join(places, "block").selectExpr("r", "first", "posexplode(keys) AS (at, key)")
        keyed = keyed.select("r", (F.col("first") + F.col("at")).alias("at"), "key.*")
        # Rows that share a key are one article.
        parts = sums.join(keyed, ["r", "at"]).select(*keys, "known_words", *[F.get("sums", F.lit(i)).alias(f"v{i}") for i in range(size)])
        whole = parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in parts.columns[len(keys) :]])
        staged, _ = stage(whole, "article-sums")
        cells.discard()
        discard(spark, paths)
    return staged


def _places_of_blocks(sizes: list[tuple[int, int]], words: int, tasks: int) -> tuple[list[tuple[int, int, int]], vector_blocks.Grid]:
    """(block, r, first) of blocks with so many rows: whose task they are and where they stand there; and the grid of rows."""
    every = sum(n for _, n in sizes)
    rows = max(1, -(-every // vector_blocks.ROW_WORDS), min(tasks, len(sizes), vector_blocks.MOVED_WORDS // max(1, words)))
    made, held, before = [], [0] * rows, 0
    for block, n in sizes:
        r = before * rows // max(1, every)
        made.append((block, r, held[r]))
        held[r] += n
        before += n
    places = max(1, min(vector_blocks.GROUP_WORDS, max(held)))
    span = max(1, -(-max(held) // places))
    return made, vector_blocks.Grid(rows * span, places, span)


def nearest_terms(words: DataFrame, term: str, n: int) -> DataFrame:
    """The ``n`` terms of a stored table (term, vector) whose vectors are nearest to one term's."""
    return nearest_vectors(words, "term", "vector", term, n)


# Fixed values of the split: a multiplicative hash over 32 bits, safe from overflow.
SPLIT_PRIME, SPLIT_MULTIPLIER, SPLIT_RANGE = 1_000_000_007, 2_654_435_761, 4_294_967_296


def is_train(key: Column, share: float = 0.8) -> Column:
    """Split by a hash of the key: the same rows whatever the layout or the run."""
    hashed = F.pmod(F.pmod(key, F.lit(SPLIT_PRIME)) * F.lit(SPLIT_MULTIPLIER), F.lit(SPLIT_RANGE))
    return hashed < int(share * SPLIT_RANGE)
