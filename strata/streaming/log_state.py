"""Log-structured state for change streams: deltas appended, merged on read, compacted by size.

A batch writes only its own rows (its winners per key), so the bytes written follow the batch and
not the state. A read merges the base with the deltas by the order of the events. When the deltas
reach a share of the base, they are merged into a new base; each row is rewritten a number of times
that grows with the logarithm of the table.

    <path>/meta                 key names and types, partition column and count, order columns
    <path>/delta/<batch>-<id>   one folder a batch, partitioned like the base
    <path>/base/<generation>    the merged rows, partitioned
    <path>/commits/<generation> one row: the deltas that this base holds (written after the base is complete)

Nothing is overwritten in place. A delta that is written twice (a replayed batch) merges to the same
rows; a base without its commit, and deltas that a committed base holds, are ignored and removed by
the next compaction. The partition column is a hash of the keys (``buckets``) or one derived from
them (``partition``), so all versions of a key are in one partition.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.hashing import key_bucket
from strata.operators.dedup import dedup_latest
from strata.operators.sinks import cluster_for_write
from strata.operators.stored import data_files
from strata.session import input_bytes, path_exists, remove_path

#: Deltas are merged into a new base once they hold this share of its bytes.
COMPACT_AT = 1.0
#: Bytes a task of a compaction reads, and so about what its files hold.
FILE_BYTES = 128 << 20


@dataclass
class LogState:
    """State of one table under ``path``.

    A row wins over others with equal ``keys`` by the highest ``seq`` (null loses), then the smallest
    ``tiebreak``; without ``seq`` by the tiebreak alone. Rows are kept in ``buckets`` partitions by key
    hash, or, given ``partition`` = (name, expression of key columns), in one for each of its values.
    """
    path: str
    keys: list[str]
    seq: str | None = None
    tiebreak: list[str] = field(default_factory=list)
    buckets: int = 16
    partition: tuple[str, str] | None = None
    compact_at: float = COMPACT_AT

    @property
    def part(self) -> str:
        return self.partition[0] if self.partition else "bucket"

    # -- metadata ------------------------------------------------------------------------------

    def _settings(self) -> dict:
        expression = self.partition[1] if self.partition else f"hash of the keys in {self.buckets}"
        return {"keys": self.keys, "seq": self.seq or "", "tiebreak": self.tiebreak, "part": self.part, "expression": expression}

    @classmethod
    def stored(cls, spark: SparkSession, path: str) -> LogState:
        """The state as it was made."""
        m = spark.read.parquet(f"{path}/meta").first()
        hashed = m["expression"].startswith("hash of the keys in ")
        return cls(path, list(m["keys"]), m["seq"] or None, list(m["tiebreak"]), int(m["expression"].rsplit(" ", 1)[1]) if hashed else 0,
                   None if hashed else (m["part"], m["expression"]))

    def _made(self, spark: SparkSession):
        return spark.read.parquet(f"{self.path}/meta").first() if path_exists(spark, f"{self.path}/meta/_SUCCESS") else None

    def conform(self, df: DataFrame) -> DataFrame:
        """``df`` with the stored key types (a hash depends on the type). Raises ValueError if the state was made
        with other keys, another order or another layout."""
        spark, asked = df.sparkSession, self._settings()
        made = self._made(spark)
        if made is None:
            types = dict(self._partitioned(df).dtypes)
            row = (*asked.values(), [types[k] for k in self.keys], types[self.part])
            schema = "keys array<string>, seq string, tiebreak array<string>, part string, expression string, types array<string>, part_type string"
            spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/meta")
            return df
        wrong = [f"{k} is {made[k]}, not {v}" for k, v in asked.items() if made[k] != v]
        if wrong:
            raise ValueError(f"the state at {self.path} was made with other settings: {'; '.join(wrong)}")
        return df.withColumns({k: F.col(k).cast(t) for k, t in zip(made["keys"], made["types"])})

    def _winners(self, df: DataFrame) -> DataFrame:
        return dedup_latest(df, self.keys, self.seq or F.lit(0), self.tiebreak)

    def _partitioned(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.part, F.expr(self.partition[1]) if self.partition else key_bucket(self.keys, self.buckets))

    # -- batches -------------------------------------------------------------------------------

    def append(self, batch: DataFrame, batch_id: int) -> str:
        """Write the batch's winners as a delta; its folder. May be repeated with the same batch."""
        rows = self._partitioned(self._winners(self.conform(batch)))
        folder = f"{self.path}/delta/{batch_id}-{uuid.uuid4().hex[:12]}"
        n = min(self.buckets or 16, int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        cluster_for_write(rows, [self.part], n).write.partitionBy(self.part).parquet(folder)
        if not data_files(batch.sparkSession, folder):  # an empty batch leaves nothing to read
            remove_path(batch.sparkSession, folder)
        return folder

    def fold(self):
        """A ``foreachBatch`` function: append, and compact when the deltas have grown to a share of the base."""
        def run(batch: DataFrame, batch_id: int) -> None:
            rows = batch.persist()  # range partitioning reads it twice
            try:
                self.append(rows, batch_id)
                self.compact_if_due(batch.sparkSession)
            finally:
                rows.unpersist()
        return run

    # -- what is there -------------------------------------------------------------------------

    def _folders(self, spark: SparkSession, sub: str) -> list[str]:
        path = f"{self.path}/{sub}"
        if not path_exists(spark, path):
            return []
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        listed = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
        return sorted(f"{path}/{s.getPath().getName()}" for s in listed if path_exists(spark, f"{path}/{s.getPath().getName()}/_SUCCESS"))

    def _current(self, spark: SparkSession) -> tuple[str | None, list[str]]:
        """(base folder or None, folders of the deltas that it doesn't hold); folder names only."""
        commits = self._folders(spark, "commits")
        base, held = None, set()
        if commits:
            last = max(commits, key=lambda c: int(c.rsplit("/", 1)[1]))
            base = f"{self.path}/base/{last.rsplit('/', 1)[1]}"
            held = set(spark.read.parquet(last).first()["deltas"])
        return base, [d for d in self._folders(spark, "delta") if d.rsplit("/", 1)[1] not in held]

    def exists(self, spark: SparkSession) -> bool:
        base, deltas = self._current(spark)
        return bool(base or deltas)

    def read(self, spark: SparkSession, where: Column | None = None) -> DataFrame:
        """The winning row of each key (of the partitions that ``where`` asks for), with the partition column."""
        base, deltas = self._current(spark)
        parts = [spark.read.parquet(f) for f in [base, *deltas] if f]
        if not parts:
            raise ValueError(f"no state at {self.path}")
        if where is not None:
            parts = [p.filter(where) for p in parts]
        kind = self._made(spark)["part_type"]  # a folder of nulls alone reads as another type
        parts = [p.withColumn(self.part, F.col(self.part).cast(kind)) for p in parts]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p, allowMissingColumns=True)
        return rows if len(parts) == 1 else self._winners(rows)

    # -- compaction ----------------------------------------------------------------------------

    def compact_if_due(self, spark: SparkSession) -> bool:
        base, deltas = self._current(spark)
        sizes = sorted(input_bytes(spark, [d]) for d in deltas)
        merged = input_bytes(spark, [base]) if base else sizes.pop() if sizes else 0  # without a base the largest delta is one
        if not sizes or sum(sizes) < self.compact_at * merged:
            return False
        self.compact(spark)
        return True

    def compact(self, spark: SparkSession) -> None:
        """Merge base and deltas into a new base, then drop what it replaces."""
        base, deltas = self._current(spark)
        if not deltas:
            return
        generation = int(base.rsplit("/", 1)[1]) + 1 if base else 0
        new = f"{self.path}/base/{generation}"
        n = -(-input_bytes(spark, [f for f in [base, *deltas] if f]) // FILE_BYTES)
        cluster_for_write(self.read(spark), [self.part], n).write.mode("overwrite").partitionBy(self.part).parquet(new)
        names = [d.rsplit("/", 1)[1] for d in deltas]
        spark.createDataFrame([(names,)], "deltas array<string>").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/{generation}")
        for old in [*deltas, *([base, f"{self.path}/commits/{generation - 1}"] if base else [])]:
            remove_path(spark, old)
