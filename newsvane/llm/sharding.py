"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size. The shards
take turns, each claiming the first slot on its list that is still free, until the table is full.
A key goes to the shard that holds slot hash(key) mod size: one lookup, shards within one slot of
each other, and few keys move when a shard is added or removed.

The table has a fixed size, a parameter that does not grow with the rows placed. It travels as one
constant array inside the expression, so placing rows needs no join and no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(text: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{text}".encode()).hexdigest()[:15], 16)


def fill_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The shard number of every slot. Shard i prefers the slots offset + j * step, j = 0, 1, ..."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be given and distinct")
    if not is_prime(slots) or slots < len(shards):
        raise ValueError("the number of slots must be prime and not below the number of shards")
    at = [_number(s, "offset") % slots for s in shards]
    step = [_number(s, "step") % (slots - 1) + 1 for s in shards]
    owner = [-1] * slots
    free = slots
    while free:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; a null key counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots))


def place(
    df: DataFrame, key: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS,
    slot_name: str = "slot", shard_name: str = "shard",
) -> DataFrame:
    """All columns of ``df``, the slot of its key and the name of the shard that holds the slot.

    One row per row: repeated keys go to one shard, null keys share the slot of the empty text, an
    empty table gives an empty result. Columns that already have one of the two names are
    replaced.
    """
    owners = fill_table(shards, slots)
    # Splitting a constant is done once, when the plan is made; a row costs one array access.
    owner = F.get(F.split(F.lit(",".join(map(str, owners))), ","), F.col("__slot").cast("int"))
    names = F.split(F.lit("\n".join(shards)), "\n")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (slot_name, shard_name)]
    placed = df.select(*kept, slot_of(F.col(f"`{key}`"), slots).alias("__slot"))
    return placed.select(
        *kept,
        F.col("__slot").alias(slot_name),
        F.get(names, owner.cast("int")).alias(shard_name),
    )
