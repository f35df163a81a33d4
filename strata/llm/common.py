"""Helpers shared by the text operators: Arrow mapping over texts, scratch tables."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.session import work_path

#: Bytes of text that one call of a text function sees at most (one longer text is seen alone).
TEXT_BUDGET = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(df: DataFrame, name: str):
    """The column called exactly ``name`` (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read again: lineage is cut, a lost
    executor costs nothing that was written."""
    spark = df.sparkSession
    path = work_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def runs(sizes: Iterable[int], budget: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to ``budget`` at most (or hold one item)."""
    start = total = n = 0
    for n, size in enumerate(sizes, 1):
        if total and total + size > budget:
            yield start, n - 1
            start, total = n - 1, 0
        total += size
    if n > start:
        yield start, n


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by rows and bytes, so that Python memory doesn't follow the text length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def map_text(df: DataFrame, text_col: str, keep: list[str], fields: list[T.StructField],
             make: Callable[[], Callable[[list[bytes]], list]], budget: int = TEXT_BUDGET) -> DataFrame:
    """``keep`` columns plus what ``make()`` computes from the texts (UTF-8 bytes; null is empty).

    ``make()`` runs once in each task and returns a function from a list of
    texts to one sequence of values for each of ``fields``. No shuffle.
    """
    small_batches(df.sparkSession)
    inner = df.select(*[column(df, c).alias(f"k{i}") for i, c in enumerate(keep)], column(df, text_col).cast("string").alias("t"))
    kept = [T.StructField(f"k{i}", inner.schema[f"k{i}"].dataType) for i in range(len(keep))]
    schema = T.StructType(kept + fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            texts = [t or b"" for t in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]
            for i, j in runs(map(len, texts), budget):
                out = score(texts[i:j])
                made = [pa.array(c, type=f.type, from_pandas=False) for c, f in zip(out, list(arrow)[len(kept):])]
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(i, j - i).cast(arrow.field(k).type) for k in range(len(kept))] + made, schema=arrow)
        del score, batches
        trim()

    out = inner.mapInArrow(run, schema)
    return out.toDF(*keep, *[f.name for f in fields])


def worker_cache(key: tuple, make: Callable):
    """``make()`` once for each Python worker process and ``key``; later tasks of the worker get the same object.

    The operators' own module doesn't live on in a worker (functions come by value), so the
    objects hang on a module entry of their own.
    """
    held = sys.modules.setdefault("_text_operators_worker_cache", types.ModuleType("_text_operators_worker_cache")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def first_rows(df: DataFrame, group: str, order: list[Column], limit: int, rank: str = "rank", places: int = 64) -> DataFrame:
    """The first ``limit`` rows of each group with their ``rank`` (from 1). A large group is first ranked in
    ``places`` parts, so that one task sees at most ``places`` times ``limit`` rows of it."""
    part = rank + "_part"
    parts = df.withColumn(part, F.pmod(F.xxhash64(*[column(df, c) for c in df.columns]), F.lit(places)))
    within = F.row_number().over(Window.partitionBy(group, part).orderBy(*order))
    some = parts.withColumn(rank, within).where(F.col(rank) <= limit).drop(part, rank)
    return some.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long")).where(F.col(rank) <= limit)


def keep_freed() -> None:
    """Let this worker use freed memory again instead of giving it back after each array (where the C library can); ``trim`` gives it back.

    Loops over arrays of a megabyte otherwise spend about as long on fresh pages as on their values."""
    with contextlib.suppress(OSError, AttributeError):
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD: smaller arrays lie on the heap
        libc.mallopt(-1, 32 << 20)  # M_TRIM_THRESHOLD: as much at the heap's end stays


def trim() -> None:
    """Give freed memory of this worker back to the system (where the C library can)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def longs(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]
