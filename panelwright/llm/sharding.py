"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size: it starts at an offset and goes on
by a step, both hashed from its name, which visits each slot once. The shards take turns, and each claims the next slot
in its order that is still free, until the table is full. So shards hold equal numbers of slots, to within one, and when
a shard comes or goes few slots change hands. The table is small and of a given size, and broadcast: a row is placed by
one hash and one lookup, without a shuffle.

Cases: a row is placed by its key; rows with the same key go to the same shard. A row without a key is placed by its text,
and one without either by the empty text. Ties can't occur, as turns are in the order of the shards. An empty table gives
an empty result. Extra columns are carried in ``doc``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F

from .common import column, text_or_empty, unpack, whole_row

#: A prime; with 64 shards, a shard's share of the slots is even to 0.1 %. At most MOST_SLOTS, so that a broadcast table
#: stays within a few megabytes.
SLOTS, MOST_SLOTS = 65_537, 1_000_003


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def _hash(name: str, what: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{what}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The number of the shard that holds each slot."""
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shards need different names, and at least one")
    if not is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"the number of slots is a prime from the number of shards to {MOST_SLOTS}")
    at = [_hash(s, "offset") % slots for s in shards]
    steps = [_hash(s, "step") % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while True:
        for k, step in enumerate(steps):
            slot = at[k]
            while table[slot] >= 0:
                slot = (slot + step) % slots
            table[slot] = k
            at[k] = (slot + step) % slots
            free -= 1
            if not free:
                return table


def placed(docs: DataFrame, shards: list[str], key_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS,
           carry: bool = True) -> DataFrame:
    """``doc`` (the whole row, or with ``carry`` off the key alone), ``slot`` and ``shard``."""
    spark = docs.sparkSession
    table = spark.createDataFrame(list(enumerate(shards[k] for k in lookup_table(shards, slots))), "slot int, shard string")
    row = whole_row(docs) if carry else F.struct(column(key_col).alias(key_col)).alias("doc")
    # sixty bits of a digest that any engine has
    digest = F.md5(F.coalesce(column(key_col).cast("string"), text_or_empty(text_col)))
    slot = F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")
    return docs.select(row, slot.alias("slot")).join(F.broadcast(table), "slot").select("doc", "slot", "shard")


def write(docs: DataFrame, path: str, shards: list[str], key_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> None:
    """Parquet files in a directory per shard, with the columns the documents came with. A shard too large for one task
    is split at run time."""
    rows = placed(docs, shards, key_col, text_col, slots).select(F.col("shard").alias("_shard"), *unpack("doc", docs.columns))
    rows.hint("rebalance", "_shard").write.partitionBy("_shard").parquet(path)
