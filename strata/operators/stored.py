"""UPDATE, DELETE and erasure on stored, partitioned parquet tables.

Only files that hold a hit are rewritten. A first pass reads the columns that decide (predicate or
subject key, with partition pruning and pushdown) and gives the files with hits by
``_metadata.file_path``; a second reads just these files, changes the rows and writes the result
beside the table. Then the new files are moved in and the old ones deleted.

Plain folders have no transaction log, so the exchange of files is made repeatable instead: the
names of the old files are written as a plan before anything of the table is touched. A driver lost
before that leaves the table as it was (the leftovers are dropped); one lost later leaves the plan,
and ``finish_rewrites`` carries it out again to the same end. Every function here calls it first;
other readers do so through ``read_stored``. One writer at a time.

Only names of files come to the driver, which lists them for every scan anyway.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.cdc import _pred, delete_where, update_where
from strata.session import path_exists, remove_path

#: Moves and deletions of files that are under way at once.
FILE_CALLS = 16


@dataclass
class Rewrite:
    """What a change did: files rewritten and left alone, rows hit."""
    files_rewritten: int
    files_untouched: int
    rows_hit: int


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Full names of the data files under a folder (hidden files and folders left out)."""
    if not path_exists(spark, path):
        return []
    fs = _fs(spark, path)
    root = fs.makeQualified(_path(spark, path)).toString()
    found, it = [], fs.listFiles(_path(spark, path), True)
    while it.hasNext():
        name = it.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in name[len(root):].split("/")):
            found.append(name)
    return found


def _each(names: list[str], call: Callable[[str], None]) -> None:
    with ThreadPoolExecutor(FILE_CALLS) as pool:
        list(pool.map(call, names))


def _work_of(path: str) -> str:
    return path.rstrip("/") + "_rewrites"


def finish_rewrites(spark: SparkSession, path: str) -> int:
    """Carry out every planned exchange of files that a lost driver left, and drop unplanned leftovers; how many were finished."""
    work, done = _work_of(path), 0
    if not path_exists(spark, work):
        return 0
    fs = _fs(spark, work)
    for status in fs.listStatus(_path(spark, work)):
        one = status.getPath().toString()
        if path_exists(spark, f"{one}/plan/_SUCCESS"):
            _exchange(spark, path, one)
            done += 1
        else:
            remove_path(spark, one)
    return done


def _exchange(spark: SparkSession, path: str, one: str) -> None:
    """Move the new files of a planned rewrite into the table and delete the old ones; may be repeated at any point."""
    fs = _fs(spark, path)
    new = f"{one}/new"
    root = fs.makeQualified(_path(spark, new)).toString()
    target = fs.makeQualified(_path(spark, path)).toString()

    def move(name: str) -> None:
        to = _path(spark, target + name[len(root):])
        fs.mkdirs(to.getParent())
        if not fs.rename(_path(spark, name), to) and not fs.exists(to):
            raise OSError(f"could not move {name}")

    old = [r.file for r in spark.read.parquet(f"{one}/plan").collect()]
    _each(data_files(spark, new), move)
    _each(old, lambda name: fs.delete(_path(spark, name), False))
    for folder in {_path(spark, name).getParent().toString() for name in old} - {target}:
        here = _path(spark, folder)
        if fs.exists(here) and not fs.listStatus(here):
            fs.delete(here, False)  # a partition without rows has no folder
    remove_path(spark, one)


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The table, after any exchange that was cut off is finished."""
    finish_rewrites(spark, path)
    return spark.read.parquet(path)


def rewrite_files(spark: SparkSession, path: str, partition_by: list[str], hits: Callable[[DataFrame], DataFrame],
                  change: Callable[[DataFrame], DataFrame]) -> Rewrite:
    """Replace each file that holds a row of ``hits(table)`` by ``change`` of its rows.

    Both functions keep the columns they are given. New files are clustered by the partition columns.
    """
    from strata.operators.sinks import cluster_for_write
    table = read_stored(spark, path)
    per_file = hits(table.withColumn("__file", F.col("_metadata.file_path"))).groupBy("__file").agg(F.count(F.lit(1)).alias("n")).collect()
    uri = spark.sparkContext._jvm.java.net.URI
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old = [path_of(uri(r["__file"])).toString() for r in per_file]
    files = len(data_files(spark, path))
    if not old:
        return Rewrite(0, files, 0)
    rows = spark.read.schema(table.schema).option("basePath", path).parquet(*old)
    one = f"{_work_of(path)}/{uuid.uuid4().hex}"
    changed = change(rows).select(*table.columns)
    if partition_by:
        cluster_for_write(changed, partition_by, min(len(old), 10_000)).write.partitionBy(*partition_by).parquet(f"{one}/new")
    else:
        changed.write.parquet(f"{one}/new")
    spark.createDataFrame([(f,) for f in old], "file string").coalesce(1).write.parquet(f"{one}/plan")
    _exchange(spark, path, one)
    return Rewrite(len(old), files - len(old), sum(r.n for r in per_file))


def update_table(spark: SparkSession, path: str, predicate, assignments: dict, partition_by: list[str] = ()) -> Rewrite:
    """UPDATE path SET c = expression, ... WHERE predicate. Assigned partition columns move the rows."""
    hit = F.coalesce(_pred(predicate), F.lit(False))
    return rewrite_files(spark, path, list(partition_by), lambda t: t.filter(hit), lambda t: update_where(t, predicate, assignments))


def delete_from(spark: SparkSession, path: str, predicate, partition_by: list[str] = ()) -> Rewrite:
    """DELETE FROM path WHERE predicate (rows where it is NULL stay)."""
    hit = F.coalesce(_pred(predicate), F.lit(False))
    return rewrite_files(spark, path, list(partition_by), lambda t: t.filter(hit), lambda t: delete_where(t, predicate))


def erase_from(spark: SparkSession, path: str, subjects: DataFrame, key: str, subject_key: str | None = None, partition_by: list[str] = ()) -> Rewrite:
    """Right to erasure on the stored table: every file with a row of a listed subject is rewritten without these rows.

    The list is joined, never collected. Afterwards no file under ``path`` holds a row of a subject.
    """
    s = subjects.select(F.col(subject_key or key).alias(key)).distinct()
    return rewrite_files(spark, path, list(partition_by), lambda t: t.join(s, on=key, how="left_semi"), lambda t: t.join(s, on=key, how="left_anti"))
