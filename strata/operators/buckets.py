"""Key-bucketed parquet tables: read and rewrite only the buckets a change touches.

A table is partitioned by ``bucket = pmod(xxhash64(keys), N)`` (N fixed at
creation). Bucket ids touched by a change are at most N small integers, so they
go to the driver and come back as a literal partition filter: only those
folders are listed and read. Rewrites go through a staging folder and then a
dynamic partition overwrite, so a live bucket is never read and overwritten by
the same job; a retried rewrite of the same change id is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.hashing import key_bucket

BUCKET = "bucket"


def with_bucket(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    return df.withColumn(BUCKET, key_bucket(keys, n))


def touched_buckets(df: DataFrame) -> list[int]:
    return sorted(r[BUCKET] for r in df.select(BUCKET).distinct().collect())


def read_buckets(spark: SparkSession, path: str, buckets: list[int] | None) -> DataFrame | None:
    """Rows of the given buckets (all when ``buckets`` is None); None if the table is empty."""
    from strata.session import path_exists
    if not path_exists(spark, path):
        return None
    t = spark.read.parquet(path)
    return t if buckets is None else t.filter(F.col(BUCKET).isin(buckets))


def bucketing(spark: SparkSession, path: str) -> dict | None:
    """Bucket count and key types that the table was made with; None without a table."""
    from strata.session import path_exists
    meta = path.rstrip("/") + "_bucketing"
    if not path_exists(spark, meta):
        return None
    r = spark.read.parquet(meta).first()
    return {"n": r["n"], "types": dict(zip(r["keys"], r["types"]))}


def record_bucketing(spark: SparkSession, path: str, df: DataFrame, keys: list[str], n: int) -> None:
    types = dict(df.dtypes)
    (spark.range(1).select(F.lit(n).alias("n"), F.array(*map(F.lit, keys)).alias("keys"), F.array(*[F.lit(types[k]) for k in keys]).alias("types"))
          .write.mode("overwrite").parquet(path.rstrip("/") + "_bucketing"))


def with_stored_keys(spark: SparkSession, path: str, df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``df`` with its keys cast to the table's key types (a hash depends on the type). Raises
    ValueError for another bucket count or other keys than the table was made with."""
    made = bucketing(spark, path)
    if made is None:
        return df
    if made["n"] != n or list(made["types"]) != list(keys):
        raise ValueError(f"the table has {made['n']} buckets by {list(made['types'])}, not {n} by {list(keys)}")
    return df.withColumns({k: F.col(k).cast(t) for k, t in made["types"].items()})


def write_buckets(spark: SparkSession, df: DataFrame, path: str, change_id, read: list[int] | None = None) -> None:
    """Replace the buckets of ``df``. ``read``: the buckets that the change has read; those that ``df``
    leaves empty lose their folder (a dynamic overwrite doesn't touch them)."""
    staging = f"{path.rstrip('/')}_staging/change={change_id}"
    df.write.mode("overwrite").partitionBy(BUCKET).parquet(staging)
    (spark.read.parquet(staging).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(BUCKET).parquet(path))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if read:
        filled = set(touched_buckets(spark.read.parquet(staging)))
        for b in set(read) - filled:
            p = path_of(f"{path.rstrip('/')}/{BUCKET}={b}")
            p.getFileSystem(conf).delete(p, True)
    p = path_of(staging)
    p.getFileSystem(conf).delete(p, True)


def create_bucketed(df: DataFrame, path: str, keys: list[str], n: int) -> None:
    with_bucket(df, keys, n).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
    record_bucketing(df.sparkSession, path, df, keys, n)
