"""Shard placement by a permutation-filled lookup table.

Each shard walks the slots of a prime-sized table in an order of its own
(offset and skip from a hash of its name) and the shards take turns claiming
the next free slot of their order. All shards get the same number of slots to
within one turn, and a change of the shard list moves few slots. A row's slot
is a hash of its key, so placement is one lookup in a broadcast table whose
size is the prime, whatever the data.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import column

#: Slots of the table: a prime well over 100 times the number of shards.
TABLE_SIZE = 65537


def preference(shard: str, size: int) -> tuple[int, int]:
    """(offset, skip) of the shard's walk over the slots."""
    h = hashlib.md5(shard.encode()).hexdigest()
    return int(h[:16], 16) % size, int(h[16:], 16) % (size - 1) + 1


def lookup_table(shards: list[str], size: int = TABLE_SIZE, weights: list[int] | None = None) -> list[int]:
    """The index in ``shards`` of each slot's owner. ``weights``: claims per turn (1 if not given).

    Raises ValueError for no shards, repeated names, or a table that isn't prime or is too small.
    """
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shard names must be given and distinct")
    if size < len(shards) or size < 3 or any(size % p == 0 for p in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be a prime of at least the number of shards")
    weights = weights or [1] * len(shards)
    if len(weights) != len(shards) or min(weights) < 0 or not any(weights):
        raise ValueError("one weight of 0 or more for each shard, not all 0")
    walks = [preference(s, size) for s in shards]
    at, owner, left = [0] * len(shards), [-1] * size, size
    while left:
        for i, (offset, skip) in enumerate(walks):
            for _ in range(min(weights[i], left)):
                while owner[slot := (offset + at[i] * skip) % size] >= 0:
                    at[i] += 1
                owner[slot] = i
                left -= 1
    return owner


def place(df: DataFrame, key_col: str, shards: list[str], size: int = TABLE_SIZE, weights: list[int] | None = None,
          slot_name: str = "slot", shard_name: str = "shard") -> DataFrame:
    """``df`` with the slot and the shard of each row. Rows with equal keys share a shard.

    A null key is placed like the text ``\\\\N``; an empty key like any other. All rows and
    columns stay; if ``df`` has a column of one of the new names, choose other names
    (ValueError). No shuffle: the table (``size`` rows) is broadcast.
    """
    if {slot_name, shard_name} & set(df.columns):
        raise ValueError("a new column's name is taken")
    owner = lookup_table(shards, size, weights)
    spark = df.sparkSession
    claims = (spark.range(1).select(F.posexplode(F.split(F.lit(",".join(map(str, owner))), ",")).alias(slot_name, "i"))
              .select(F.col(slot_name).cast("long").alias(slot_name),
                      F.element_at(F.array(*map(F.lit, shards)), F.col("i").cast("int") + 1).alias(shard_name)))
    key = F.coalesce(column(df, key_col).cast("string"), F.lit("\\N"))
    slot = F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long") % size
    return df.withColumn(slot_name, slot).join(F.broadcast(claims), slot_name).select(*[column(df, c) for c in df.columns], slot_name, shard_name)


def write_shards(placed: DataFrame, path: str, shard_name: str = "shard") -> None:
    """One folder for each shard; a shard's rows may come from many tasks and files."""
    placed.write.mode("overwrite").partitionBy(shard_name).parquet(path)


def placement_sql(key: str, table: str, shards: list[str], size: int = TABLE_SIZE, columns: str = "*") -> str:
    """The same placement as DuckDB SQL."""
    owner = lookup_table(shards, size)
    names = ", ".join("'" + s.replace("'", "''") + "'" for s in shards)
    return f"""
        WITH owner AS (SELECT string_split('{",".join(map(str, owner))}', ',') AS o, [{names}] AS names),
        placed AS (SELECT {columns}, ('0x' || substr(md5(coalesce(CAST({key} AS VARCHAR), '\\N')), 1, 12))::BIGINT % {size} AS slot FROM {table})
        SELECT placed.*, names[CAST(o[slot + 1] AS BIGINT) + 1] AS shard FROM placed, owner"""
