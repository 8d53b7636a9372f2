"""Sharding by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import hash60, session, table

# Production parameters: a prime over a thousand times the number of shards keeps shares within
# about a tenth of a per cent of each other.
SHARDS = 64
SLOTS = 65537


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard number of every slot.

    Each shard prefers the slots in the order offset, offset + skip, ... modulo the prime ``slots``;
    offset and skip come from the md5 of its name. Shards take turns and each claims the first slot
    of its order that is still free, until none is. A shard that joins or leaves moves few slots
    besides its own. The work and the result depend on ``slots`` alone, never on the data.
    """
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the number of slots must be a prime, not {slots}")
    if not 0 < len(shards) <= slots:
        raise ValueError("there must be between one shard and as many as slots")
    turns = []
    for name in shards:
        digest = hashlib.md5(name.encode()).digest()
        offset = int.from_bytes(digest[:8], "big") % slots
        skip = int.from_bytes(digest[8:], "big") % (slots - 1) + 1
        turns.append([offset, skip])
    owner, free = [-1] * slots, slots
    while free:
        for shard, turn in enumerate(turns):
            while owner[turn[0]] >= 0:
                turn[0] = (turn[0] + turn[1]) % slots
            owner[turn[0]] = shard
            free -= 1
            if not free:
                break
    return owner


def shard_names(count: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(count)]


def place(
    docs: DataFrame, shards: list[str], slots: int = SLOTS, key: str = "doc_id", seed: str = "shard"
) -> DataFrame:
    """Input rows with ``slot`` and ``shard`` (its number).

    The slot is a 60-bit hash of the key modulo ``slots``; the shard comes from the broadcast
    lookup table, which has ``slots`` rows whatever the data. No row is shuffled. Null keys count
    as the empty key; equal keys share a shard. Columns named like the added ones are replaced.
    """
    owners = ",".join(map(str, lookup_table(shards, slots)))
    lookup = docs.sparkSession.range(1).select(F.posexplode(F.split(F.lit(owners), ",")))
    lookup = lookup.select(F.col("pos").alias("slot"), F.col("col").cast("int").alias("shard"))
    slot = (hash60(F.col(key), seed) % slots).cast("int")
    base = docs.drop("slot", "shard")
    return (
        base.withColumn("slot", slot)
        .join(F.broadcast(lookup), "slot")
        .select(*base.columns, "slot", "shard")
    )


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """Write one folder per shard, each from ``files_per_shard`` tasks.

    A shard that holds most rows is dealt over that many tasks at least; adaptive execution splits
    further what is still too large.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns]), F.lit(files_per_shard))
    salted = placed.withColumn("_salt", salt)
    salted.hint("rebalance", "shard", "_salt").drop("_salt").write.partitionBy("shard").parquet(path)


def op4_sharding(spark, sf_dir):
    """All documents over 64 shards by a table of 65,537 slots."""
    docs = table(session(spark), sf_dir, "documents")
    return place(docs.select("doc_id"), shard_names(SHARDS)).select("doc_id", "slot", "shard")


def op4_sql() -> str:
    owners = ",".join(map(str, lookup_table(shard_names(SHARDS))))
    return f"""
WITH lookup AS (SELECT CAST(string_split('{owners}', ',') AS INTEGER[]) AS owners),
placed AS (
  SELECT doc_id, CAST(('0x' || substr(md5('shard:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT
         % {SLOTS} AS INTEGER) AS slot FROM documents)
SELECT doc_id, slot, owners[slot + 1] AS shard FROM placed CROSS JOIN lookup
"""
