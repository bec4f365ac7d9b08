"""Ranking, capping and de-duplication that hold up when one group has a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsvane.session import broadcast_if_small, cut_lineage

DEFAULT_SALTS = 256


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    n: int,
    salt_on: Sequence[str],
    rank_name: str = "rank",
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """The first ``n`` rows of every group, ranked from 1. ``order`` must be a total order.

    For a small ``n`` Spark itself cuts every group to ``n`` rows in each task before it shuffles.
    For a large one the group is first cut into ``salts`` slices ranked separately; only the first
    ``n`` rows of a slice can be among the first ``n`` of the group, so the final ranking sees at
    most ``salts * n`` rows per group whatever the group's size.
    """
    in_group = Window.partitionBy(*group).orderBy(*order)
    kept = df
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        slice_of = F.pmod(F.xxhash64(*[F.col(c) for c in salt_on]), F.lit(salts))
        in_slice = Window.partitionBy(*group, "__slice").orderBy(*order)
        kept = (
            df.withColumn("__slice", slice_of)
            .withColumn("__pre", F.row_number().over(in_slice))
            .where(F.col("__pre") <= n)
            .drop("__pre", "__slice")
        )
    return kept.withColumn(rank_name, F.row_number().over(in_group)).where(F.col(rank_name) <= n)


def top_n(df: DataFrame, order: Sequence[Column], n: int, rank_name: str = "rank") -> DataFrame:
    """The first ``n`` rows overall, ranked. Every task keeps its own first ``n`` before the merge."""
    first = df.orderBy(*order).limit(n)
    return first.withColumn(rank_name, F.row_number().over(Window.orderBy(*order)))


def at_least_nth(counts: DataFrame, count: str, n: int) -> DataFrame:
    """The rows whose count is no smaller than the ``n``-th largest: at least ``n`` of them, and its ties.

    Found from how many rows have each count, of which there are few, so that a large top-n merges
    about n rows and not n rows of every task.
    """
    sizes = counts.groupBy(F.col(count).alias("__n")).agg(F.count("*").alias("__rows"))
    # One row per distinct count.
    upto = F.sum("__rows").over(Window.orderBy(F.desc("__n")))
    cut = sizes.withColumn("__upto", upto).agg(F.max(F.when(F.col("__upto") >= n, F.col("__n")))).scalar()
    return counts.withColumn("__cut", cut).where(F.col("__cut").isNull() | (F.col(count) >= F.col("__cut"))).drop("__cut")


def global_rank(df: DataFrame, order: Sequence[Column], rank_name: str = "rank") -> DataFrame:
    """Rank all rows from 1 without passing them through one task.

    The rows are range-sorted and written once; a row's rank is its place within its partition
    plus the sizes of the partitions before it.
    """
    placed = cut_lineage(df.orderBy(*order)).withColumn("__at", F.monotonically_increasing_id())
    partition, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(partition.alias("__part")).agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    # One row per partition of the sort: a few thousand at most.
    partitions = placed.rdd.getNumPartitions()
    return (
        placed.withColumn("__part", partition)
        .join(broadcast_if_small(offsets, partitions, 32), "__part")
        .withColumn(rank_name, F.col("__offset") + place + 1)
        .drop("__at", "__part", "__offset")
    )


def _moment(first: Column, rest: Sequence[Column]) -> Column:
    """One sortable number: ``first`` (a 64-bit integer), then a hash of ``rest``."""
    wide = F.lit("10000000000000000000").cast("decimal(38,0)")
    digest = F.pmod(F.xxhash64(*rest), F.lit((1 << 63) - 1)) if rest else F.lit(0)
    return first.cast("decimal(38,0)") * wide + digest.cast("decimal(38,0)")


def _rows_at(df: DataFrame, keys: Sequence[str], moment: Column, best: DataFrame) -> DataFrame:
    """The rows that stand at their key's best moment, as they are; equal rows are one.

    ``best`` holds one narrow row per key and is the side that is hashed, so the wide rows are
    moved once and never sorted.
    """
    found = df.withColumn("__moment", moment).join(
        best.hint("shuffle_hash"), [*keys, "__moment"], "left_semi"
    )
    return found.distinct().drop("__moment")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Column, ties: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key, the last by ``order``, a number or date; rows without a whole key stay.

    Rows of a key that share the last ``order`` are told apart by ``ties``, at most two numbers with
    up to six decimals, or else by a hash of the row, which is the same in every run. The keys'
    latest moments are a hash aggregate over narrow rows with a map-side combine, so copies of a
    hot key collapse before the shuffle.
    """
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    kind = df.select(order.alias("o")).schema["o"].dataType.simpleString()
    number = F.unix_date(order) if kind == "date" else F.unix_micros(order) if kind.startswith("timestamp") else order
    number = F.coalesce(number.cast("bigint"), F.lit(-(1 << 62)))
    rest = [F.col(c) for c in df.columns if c not in keys]
    if ties is None:
        moment = _moment(number, rest)
    else:
        # Days have six digits, a first tie fifteen with its decimals, a second sixteen.
        parts = [F.floor(t.cast("decimal(30,6)") * 1_000_000).cast("decimal(38,0)") for t in ties[:1]]
        parts += [t.cast("decimal(38,0)") for t in ties[1:]]
        parts = [F.coalesce(part, F.lit(-(10**15)).cast("decimal(38,0)")) for part in parts]
        moment = number.cast("decimal(38,0)")
        for part in parts:
            moment = moment * F.lit(10**16).cast("decimal(17,0)").cast("decimal(38,0)") + part
    keyed = df.where(whole)
    best = keyed.select(*keys, moment.alias("__moment")).groupBy(*keys).agg(F.max("__moment").alias("__moment"))
    return _rows_at(keyed, keys, moment, best).unionByName(df.where(~whole))


def first_per_text(df: DataFrame, text: str, id_column: str) -> DataFrame:
    """One row per distinct text, the one with the smallest id, and the number of its copies.

    Rows without a text are no copies of each other and stay, with one copy each. Texts are compared
    by a 256-bit digest; the text itself is moved once, with the row that stays. Rows that share
    text and id are told apart by a hash of the row.
    """
    rest = [F.col(c) for c in df.columns if c not in (text, id_column)]
    known = df.where(F.col(text).isNotNull()).withColumn("__digest", F.sha2(F.col(text), 256))
    moment = _moment(F.coalesce(F.col(id_column).cast("bigint"), F.lit((1 << 62))), rest)
    best = (
        known.select("__digest", moment.alias("__moment"))
        .groupBy("__digest")
        .agg(F.min("__moment").alias("__moment"), F.count("*").alias("copies"))
    )
    kept = known.withColumn("__moment", moment).join(best.hint("shuffle_hash"), ["__digest", "__moment"])
    missing = df.where(F.col(text).isNull()).withColumn("copies", F.lit(1).cast("bigint"))
    columns = [*df.columns, "copies"]
    return kept.distinct().select(*columns).unionByName(missing.select(*columns))


def groups_of_at_least(df: DataFrame, group: str, minimum: int) -> DataFrame:
    """Rows of the groups that have at least ``minimum`` rows."""
    large = df.groupBy(group).count().where(F.col("count") >= minimum).select(group)
    return df.join(large, group, "left_semi")
