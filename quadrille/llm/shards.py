"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has an order of preference over the slots of a table whose size is prime.
The shards take turns, each claiming the free slot it likes best, until all slots are
claimed.  A row's key is hashed to a slot, whose owner gets the row.  Shards own equal
numbers of slots (they differ by one at most), and when a shard comes or goes few slots
change owner.  The table has a fixed size, so it is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Slots; a prime, and more than a hundred times the number of shards in use.
TABLE_SIZE = 65_537


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """Owner of each slot, as an index into ``shards``."""
    if not 0 < len(set(shards)) == len(shards) <= size:
        raise ValueError("Shard names must be distinct, and no more than slots.")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("The size of the table must be prime.")
    place, step = [], []
    for name in shards:
        digest = hashlib.sha256(name.encode()).digest()
        place.append(int.from_bytes(digest[:8], "big") % size)
        step.append(int.from_bytes(digest[8:16], "big") % (size - 1) + 1)
    owner, free = [-1] * size, size
    while True:
        for shard in range(len(shards)):
            while owner[place[shard]] >= 0:
                place[shard] = (place[shard] + step[shard]) % size
            owner[place[shard]] = shard
            free -= 1
            if not free:
                return owner


def lookup_table(
    spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE
) -> DataFrame:
    """``slot, shard``: one row per slot."""
    rows = [(slot, shards[shard]) for slot, shard in enumerate(fill_table(shards, size))]
    schema = T.StructType(
        [
            T.StructField("slot", T.LongType(), False),
            T.StructField("shard", T.StringType(), False),
        ]
    )
    return spark.createDataFrame(rows, schema)


def place_on_shards(
    rows: DataFrame,
    shards: Sequence[str],
    key_columns: Sequence[str] = ("doc_id",),
    fallback: str | None = "text",
    size: int = TABLE_SIZE,
) -> DataFrame:
    """``rows`` with ``slot`` and ``shard`` for the values of the key columns.

    Equal keys share a shard, so a key should tell rows apart: one that a third of the
    rows have would fill a third of a shard.  Rows whose key is null in all columns are
    spread by ``fallback``.  Columns of the input called ``slot`` or ``shard`` are
    replaced; repeated rows share a shard; an empty table gives no rows.
    """
    key = F.xxhash64(*[F.col(f"`{c}`") for c in key_columns])
    if fallback is not None:
        absent = F.lit(True)
        for column in key_columns:
            absent = absent & F.col(f"`{column}`").isNull()
        key = F.when(absent, F.xxhash64(F.col(f"`{fallback}`"))).otherwise(key)
    slot = F.pmod(key, F.lit(size))
    table = lookup_table(rows.sparkSession, shards, size)
    placed = rows.drop("slot", "shard").withColumn("slot", slot)
    # bounded by the table size, whatever the number of rows
    return placed.join(F.broadcast(table), "slot").select(
        *[F.col(f"`{c}`") for c in placed.columns], "shard"
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard; adaptive execution divides large ones over several files."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
