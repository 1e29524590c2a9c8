"""Sharding by a permutation-filled lookup table.

Each shard walks the slots of a prime-sized table in an order of its own (offset and skip from a
hash of its name); the shards take turns claiming the next free slot until the table is full. A row
hashes to a slot and the slot names the shard, so that placement is one lookup and a changed set of
shards moves few rows. The table has `SLOTS` rows whatever the data, and is broadcast: that is the
proven bound of the broadcast. Rows are placed in the scan, without a shuffle; a hot source or key
spreads over all shards because the placement key is the row's id.

The table itself is filled once per job, in plain Python over its fixed number of slots; the rows
only pass DataFrame functions. Null ids hash like an empty text and all go to one shard unless
`key` has more columns. Empty tables give no rows; the other columns are carried on unless they
clash with `slot` or `shard`, which are then replaced. Repeated rows go to the same shard.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime, at least 100 times the usual number of shards, so that shards differ by about 1 % of slots.
SLOTS = 12_809


def _number(text: str) -> int:
    """The number behind the first 15 hexadecimal digits of the MD5 of a text."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(number: int) -> bool:
    return number > 1 and all(number % d for d in range(2, int(number**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Index of the shard that holds each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be named, each once")
    if not is_prime(slots) or slots < len(shards):
        raise ValueError("the number of slots must be a prime, not below the number of shards")
    at = [_number(f"offset:{name}") % slots for name in shards]
    skip = [_number(f"skip:{name}") % (slots - 1) + 1 for name in shards]
    table = [-1] * slots
    for turn in range(slots):
        shard = turn % len(shards)
        while table[at[shard]] >= 0:
            at[shard] = (at[shard] + skip[shard]) % slots
        table[at[shard]] = shard
    return table


def slot_of(key: list[str], slots: int = SLOTS) -> Column:
    """Slot of a row by its key columns; nulls count as empty texts."""
    text = F.concat_ws("\u001f", *(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in key))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint") % slots).cast("int")


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """The lookup table as rows (slot, shard)."""
    numbers = F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",")
    names = F.split(F.lit("\u001f".join(shards)), "\u001f")
    return spark.range(1).select(F.posexplode(numbers).alias("slot", "number")).select("slot", F.get(names, F.col("number").cast("int")).alias("shard"))


def place(rows: DataFrame, shards: list[str], key: list[str], slots: int = SLOTS) -> DataFrame:
    """The rows with `slot` and `shard`."""
    keyed = rows.drop("shard").withColumn("slot", slot_of(key, slots))
    table = table_frame(rows.sparkSession, shards, slots)
    return keyed.join(F.broadcast(table), "slot", "left")


def write(rows: DataFrame, path: str, shards: list[str], key: list[str], slots: int = SLOTS, files_per_shard: int = 1) -> None:
    """Writes one folder per shard, its rows in `files_per_shard` files dealt out by slot."""
    placed = place(rows, shards, key, slots)
    dealt = placed.repartition(len(shards) * files_per_shard, "shard", F.col("slot") % files_per_shard)
    dealt.write.mode("errorifexists").partitionBy("shard").parquet(path)


def report(rows: DataFrame, before: list[str], after: list[str], key: list[str], slots: int = SLOTS) -> DataFrame:
    """Rows that a change of shards moves, by old and new shard."""
    spark = rows.sparkSession
    tables = table_frame(spark, before, slots).withColumnRenamed("shard", "old").join(
        table_frame(spark, after, slots).withColumnRenamed("shard", "new"), "slot"
    )
    by_slot = rows.select(slot_of(key, slots).alias("slot")).groupBy("slot").agg(F.count("*").alias("n_rows"))
    return by_slot.join(F.broadcast(tables), "slot").groupBy("old", "new").agg(F.sum("n_rows").alias("n_rows"))
