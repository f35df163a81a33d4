"""Two stored tables compared by checksums of key ranges; rows are read only where the checksums differ.

``keep`` stores a table in ``ranges`` folders by key hash, with one checksum row for each beside it. ``differences`` joins
the two small checksum tables and reads the folders that differ, so equal tables cost two reads of at most ``ranges``
rows, and a few changes cost their folders. A checksum is the row count, the sum and the exclusive or of 64-bit
row hashes: it doesn't depend on the order of rows and counts repeated ones. Hashes stand for rows; two different rows
with one hash would pass as equal (2^-64 a pair).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.hashing import key_bucket
from strata.operators.sinks import write_partitioned

RANGE, DIGEST = "__range", "__digest"


def row_digest(df: DataFrame, columns: list[str] | None = None) -> Column:
    """64-bit hash of a row by column name; a null differs from every value and from a null elsewhere."""
    parts = [c for name in sorted(columns or df.columns) for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    return F.xxhash64(*parts)


def checksums(rows: DataFrame) -> DataFrame:
    """range -> rows, total and exclusive or of the digests; map-side combined, at most one row a range."""
    return rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(DIGEST).cast("decimal(38,0)")).alias("total"),
                                   F.expr(f"bit_xor({DIGEST})").alias("mixed"))


def keep(df: DataFrame, path: str, keys: list[str], ranges: int = 256) -> None:
    """Store ``df`` for comparison under ``path``: its rows by key range, and their checksums."""
    spark = df.sparkSession
    rows = df.withColumns({RANGE: key_bucket(keys, ranges), DIGEST: row_digest(df)})
    write_partitioned(rows, f"{path}/rows", [RANGE], compression="snappy")
    types = [dict(df.dtypes)[k] for k in keys]
    meta = spark.createDataFrame([(keys, types, ranges, sorted(map(":".join, df.dtypes)))],
                                 "keys array<string>, types array<string>, ranges int, columns array<string>")
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    # From the stored rows, so that the checksums vouch for what is on disk.
    checksums(spark.read.schema(rows.schema).parquet(f"{path}/rows")).write.mode("overwrite").parquet(f"{path}/sums")


def differing_ranges(spark: SparkSession, left: str, right: str) -> list[int]:
    """Ranges whose checksums differ: at most the number of ranges, and the only thing that comes to the driver."""
    a, b = (spark.read.parquet(f"{p}/sums").select(RANGE, F.struct("rows", "total", "mixed").alias(side)) for p, side in ((left, "l"), (right, "r")))
    rows = a.join(b, RANGE, "full_outer").where(~F.col("l").eqNullSafe(F.col("r"))).select(RANGE).collect()
    return sorted(r[0] for r in rows)


def differences(spark: SparkSession, left: str, right: str) -> DataFrame:
    """(kind, key columns, left_rows, right_rows) of two tables written by ``keep``.

    ``kind``: only_left, only_right or changed, one row for each such key (null keys are keys; repeated rows count). Equal
    tables give a single row of kind equal, with null keys and the tables' row counts. Raises ValueError if the tables
    were kept with other keys, key types, ranges or columns.
    """
    made = [spark.read.parquet(f"{p}/meta").first() for p in (left, right)]
    if made[0] != made[1]:
        raise ValueError("the tables were kept with different keys, ranges or columns")
    keys, types = list(made[0]["keys"]), list(made[0]["types"])
    wrong = differing_ranges(spark, left, right)
    if not wrong:
        counts = [spark.read.parquet(f"{p}/sums").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias(n)) for p, n in ((left, "left_rows"), (right, "right_rows"))]
        none = [F.lit(None).cast(t).alias(k) for k, t in zip(keys, types)]
        # Two one-row sums side by side, by stacking rather than by a join.
        both = counts[0].select("left_rows", F.lit(0).cast("long").alias("right_rows")).unionByName(
            counts[1].select(F.lit(0).cast("long").alias("left_rows"), "right_rows"))
        return both.agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows")).select(
            F.lit("equal").alias("kind"), *none, "left_rows", "right_rows")
    stacked = None
    for path, side in ((left, 1), (right, 0)):
        rows = spark.read.parquet(f"{path}/rows").where(F.col(RANGE).isin(wrong))  # prunes the folders
        rows = rows.select(*[F.col(f"`{k}`").cast(t).alias(k) for k, t in zip(keys, types)], F.col(DIGEST).alias(DIGEST), F.lit(side).alias("__left"))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    # One aggregate by key instead of a join: null keys group, and a hot key is combined in each task.
    on_left, digest = F.col("__left") == 1, F.col(DIGEST).cast("decimal(38,0)")
    per_key = stacked.groupBy(*keys).agg(
        F.count_if(on_left).alias("left_rows"), F.count_if(~on_left).alias("right_rows"),
        F.sum(F.when(on_left, digest).otherwise(-digest)).alias("d"), F.expr(f"bit_xor({DIGEST})").alias("x"))
    kind = (F.when(F.col("right_rows") == 0, "only_left").when(F.col("left_rows") == 0, "only_right")
            .when((F.col("d") != 0) | (F.col("x") != 0) | (F.col("left_rows") != F.col("right_rows")), "changed"))
    return per_key.select(kind.alias("kind"), *keys, "left_rows", "right_rows").where("kind IS NOT NULL")
