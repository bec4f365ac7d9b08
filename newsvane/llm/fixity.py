"""Fixity audit of archived records by comparing hash trees of two replicas.

A record is hashed with its header. Records stand in the archive in the order of their ids; node n
of level k covers the ids from n * 64**k on, 64**k of them, so a tree needs no ranking and nodes of
two replicas cover the same ids whatever is missing. A node holds the hash of its children's
hashes in order, the number of its records and the number of its bytes, and so stands for a range
of offsets.

An audit compares the roots. Only where two nodes differ are their children compared, level by
level; the offset of a child is its parent's offset and the bytes of the children before it. Equal
branches are never read below their top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsvane.llm.common import staged

FAN_OUT = 64


def warc_record(key: Column, url: Column, body: Column) -> Column:
    """The bytes of a response record; a null url or body counts as empty."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), key.cast("string"),
        F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def leaves(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(node, hash, records, bytes): one leaf per id.

    Records that share an id share a leaf, hashed from their number and the sums of their hashes'
    halves, which do not depend on order and are added up before the shuffle. Rows without an id
    have no place in the order and are left out.
    """
    record = warc_record(F.col(key), F.col(url), F.col(body))
    digest = F.sha2(record.cast("binary"), 256)
    # Four numbers of 60 bits; their sums are exact.
    parts = [F.conv(F.substring("digest", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]
    hashed = pages.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("node"), digest.alias("digest"),
        F.octet_length(record).cast("long").alias("size"),
    )
    summed = hashed.groupBy("node").agg(
        F.count("*").alias("records"), F.sum("size").alias("bytes"),
        *[F.sum(p.cast("decimal(38,0)")).alias(f"p{i}") for i, p in enumerate(parts)],
    )
    text = F.concat_ws(":", "records", "p0", "p1", "p2", "p3")
    return summed.select("node", F.sha2(text.cast("binary"), 256).alias("hash"), "records", "bytes")


def parents(nodes: DataFrame, last: bool, fan_out: int = FAN_OUT) -> DataFrame:
    """The level above: at most ``fan_out`` children, or the few nodes left, under each node."""
    above = F.lit(0).cast("long") if last else F.floor(F.col("node") / fan_out)
    child = F.struct("node", "hash", "records", "bytes")
    return (
        nodes.groupBy(above.alias("above"))
        .agg(F.sort_array(F.collect_list(child)).alias("children"), F.sum("records").alias("records"), F.sum("bytes").alias("bytes"))
        .select(
            F.col("above").alias("node"),
            F.sha2(
                F.concat_ws(
                    ",", F.transform("children", lambda c: F.concat_ws(":", c["node"].cast("string"), c["hash"], c["bytes"].cast("string")))
                ).cast("binary"), 256,
            ).alias("hash"),
            "records", "bytes",
        )
    )


def build_tree(pages: DataFrame, levels: int, name: str, **columns: str) -> list[DataFrame]:
    """All levels from the leaves to the root, each written out."""
    tree = [staged(leaves(pages, **columns), f"{name}-0")]
    for level in range(1, levels + 1):
        tree.append(staged(parents(tree[-1], level == levels), f"{name}-{level}"))
    return tree


def audit(one: DataFrame, other: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(page_id, status, start, stop, other_bytes): records at which ``other`` departs from ``one``.

    ``status`` is changed, missing (from ``other``) or extra (only there). ``start`` and ``stop`` are
    offsets in ``one``; an extra record has the offset at which it would stand and no length, a
    missing one no ``other_bytes``. Equal replicas, empty ones too, give no rows. Null urls and
    bodies count as empty, rows without an id are left out, repeated ids are compared together.
    Other columns are not read.
    """
    columns = {"key": key, "url": url, "body": body}
    reach = one.select(key).union(other.select(key)).agg(F.max(F.abs(F.col(key).cast("long")))).first()[0] or 0
    levels = 1
    while FAN_OUT**levels <= reach:
        levels += 1
    # One level more joins the nodes below and above zero.
    left, right = build_tree(one, levels + 1, "fixity-one", **columns), build_tree(other, levels + 1, "fixity-other", **columns)

    # The root stands at offset zero. A branch is a node whose two hashes differ.
    branches = None
    for level in range(levels + 1, -1, -1):
        a = left[level].select("node", F.col("hash").alias("a"), F.col("bytes").alias("a_bytes"))
        b = right[level].select("node", F.col("hash").alias("b"), F.col("bytes").alias("b_bytes"))
        if branches is not None:
            above = F.lit(0).cast("long") if level == levels else F.floor(F.col("node") / FAN_OUT)
            only = branches.select(F.col("node").alias("above"), F.col("start").alias("base"))
            a = a.withColumn("above", above).join(only.select("above"), "above", "left_semi")
            b = b.withColumn("above", above).join(only.select("above"), "above", "left_semi")
            both = a.join(b, ["above", "node"], "full").join(only, "above")
        else:
            both = a.join(b, "node", "full").withColumn("above", F.lit(0).cast("long")).withColumn("base", F.lit(0).cast("long"))
        before = Window.partitionBy("above").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        placed = both.withColumn("start", F.col("base") + F.coalesce(F.sum("a_bytes").over(before), F.lit(0)))
        branches = staged(placed.where(~F.col("a").eqNullSafe(F.col("b"))), f"fixity-branches-{level}")
    status = F.when(F.col("a").isNull(), "extra").when(F.col("b").isNull(), "missing").otherwise("changed")
    return branches.select(
        F.col("node").alias("page_id"), status.alias("status"), "start",
        (F.col("start") + F.coalesce("a_bytes", F.lit(0))).alias("stop"), F.col("b_bytes").alias("other_bytes"),
    )
