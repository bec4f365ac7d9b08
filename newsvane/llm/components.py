"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsvane.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(id, component): for every id in ``links`` (u, v) the smallest id it is connected to.

    Alternating star operations: every id hands its larger neighbours to its smallest one, then its
    smaller ones, until every component is a star around its smallest id. Each step is a minimum
    per id and a join, and is written out, so no component meets in one task. The number of rounds
    grows with the logarithm of the components' size. Links of an id with itself give a component
    of one.
    """
    ids = links.select(F.col("u").alias("id")).union(links.select("v")).distinct()
    state = staged(_downwards(links), "links")
    before = _mark(state)
    while before[0]:
        both = state.union(state.select("v", "u")).toDF("u", "v")
        # Written out, the minima are a side of their own in the join, and Spark can split the rows
        # of an id with very many neighbours.
        least = staged(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least")), "least")
        # Larger neighbours move to the smallest neighbour, or to the id itself.
        large = staged(
            _downwards(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))),
            "links",
        )
        least = staged(large.groupBy("u").agg(F.min("v").alias("least")), "least")
        joined = large.join(least, "u")
        state = staged(
            _downwards(joined.select(F.col("v").alias("u"), F.col("least").alias("v")).union(least.select("u", "least"))),
            "links",
        )
        after = _mark(state)
        if after == before:
            break
        before = after
    found = state.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    return ids.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _downwards(links: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller id, without links of an id with itself."""
    return (
        links.toDF("u", "v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _mark(state: DataFrame) -> tuple:
    """Count and checksum: equal for equal tables."""
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(state.agg(F.count("*"), total).first())
