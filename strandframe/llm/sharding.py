"""Sharding by a lookup table in which shards take turns claiming slots."""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, named

#: Slots of the table: a prime, about 100 times the usual number of shards. It bounds what is broadcast.
SLOTS = 4099
#: Slots that a caller may ask for; the broadcast table has at most so many rows of a few bytes.
MAX_SLOTS = 655_373


def _number(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:8], 16)


def fill_table(shards: list[str], slots: int = SLOTS) -> list[str]:
    """Who owns each slot. Each shard prefers slots in the order offset, offset + skip, ... modulo the prime `slots`; shards take
    turns, each claiming its first free slot, until none is free. The work depends on the number of slots only, never on the data."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct and at least one")
    if slots > MAX_SLOTS or slots < len(shards) or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime, at least the number of shards and at most MAX_SLOTS")
    place = [_number(f"{s}#offset") % slots for s in shards]
    skip = [_number(f"{s}#skip") % (slots - 1) + 1 for s in shards]
    owner: list[str | None] = [None] * slots
    free = slots
    while free:
        for i, shard in enumerate(shards):
            while owner[place[i]] is not None:
                place[i] = (place[i] + skip[i]) % slots
            owner[place[i]] = shard
            free -= 1
            if not free:
                break
    return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """The table as rows (slot, shard)."""
    names = F.split(F.lit("\n".join(fill_table(shards, slots))), "\n")
    return spark.range(1).select(F.posexplode(names).alias("slot", "shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; a null key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int")


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """Adds slot and shard to each row: the key's hash gives a slot, the broadcast table (at most MAX_SLOTS rows) its owner.

    No shuffle: rows stay where they are, so a key that holds many rows costs nothing more. Null keys go to the slot of the empty
    text. Columns slot and shard of the input are replaced (after the key is read, if it is one of them); repeated rows and other columns
    stay whatever their names, and an empty table stays so.
    """
    if "\n" in "".join(shards):
        raise ValueError("a shard's name must not hold a line break")
    table = lookup_table(df.sparkSession, shards, slots)
    own = [c for c in df.columns if c.lower() not in ("slot", "shard")]
    at, owner = free_name("slot_of_row", df.columns), free_name("shard_of_row", df.columns)
    rows = df.withColumn(at, slot_of(named(key), slots)).select(*map(named, own), at)
    placed = rows.join(F.broadcast(table.toDF("slot", owner)), F.col(at) == F.col("slot"))
    return placed.select(*map(named, own), F.col(at).alias("slot"), F.col(owner).alias("shard"))
