"""Mergeable aggregate state: gold kept as partial sums, counts, extremes, latest values and sketches, merged batch by batch.

A batch is reduced to one row per group that it touches and written as a delta; no row of earlier batches is
read again. A read merges base and deltas, which is again one ``groupBy``; the merge doesn't depend on the
order or the cut of the batches, so late rows need nothing special.

    <path>/meta                 keys, partition key, measures (checked by each batch)
    <path>/delta/<batch id>     the batch's partials, partitioned
    <path>/base/<generation>    merged partials
    <path>/commits/<generation> one row: the highest batch id that the base holds

Sums aren't idempotent, so a batch is known by its id: a replayed id replaces its delta, and one that a base
holds is left out. Ids have to rise, as those of ``foreachBatch`` do. A base without its commit, and a
delta without its ``_SUCCESS``, don't count. Rows that replace or withdraw earlier ones belong into a CDC state first
(``streaming/log_state.py``): minima and maxima can't be taken back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.sinks import cluster_for_write, write_partitioned
from strata.operators.stored import data_files
from strata.session import input_bytes, path_exists, remove_path

#: Deltas are merged into a new base once they hold this share of its bytes.
COMPACT_AT = 1.0
#: Bytes a task of a compaction reads.
FILE_BYTES = 128 << 20


#: An HLL sketch's standard error is 1.04 / sqrt(2 ** HLL_LG_K), a KLL sketch's rank error about 2.3 / KLL_K ** 0.9.
HLL_LG_K, KLL_K = 12, 400


@dataclass(frozen=True)
class Measure:
    """``kind``: sum, count, min, max, latest, distinct or quantiles. ``value`` is an SQL expression; nulls don't count (count without a value counts rows).

    ``latest`` takes the value of the highest ``order``, one scalar expression that no two rows of a group should share
    (the choice among equal ones isn't defined). Sums should be integers or decimals: those merge exactly in any order.

    ``distinct`` keeps an HLL sketch (2 ** ``HLL_LG_K`` registers) and ``quantiles`` a KLL sketch of the value as a double: a few KB
    a group whatever its rows, merged like the others; ``distinct_of`` and ``quantile_of`` read them. Their errors don't grow
    with the number of merges. KLL draws at random, so a repeated task may give another sketch within the same error.
    """
    name: str
    kind: str
    value: str = "1"
    order: str = ""

    def __post_init__(self):
        if self.kind not in ("sum", "count", "min", "max", "latest", "distinct", "quantiles"):
            raise ValueError(f"unknown kind of measure {self.kind}")
        if (self.kind == "latest") != bool(self.order):
            raise ValueError(f"{self.name}: latest, and only latest, takes an order")

    def first(self) -> list[Column]:
        """Aggregates of rows."""
        v = F.expr(self.value)
        if self.kind == "latest":
            # A null value isn't one; max_by over two scalars is a hash aggregate, a maximum of structs would sort.
            o = F.when(v.isNotNull(), F.expr(self.order))
            return [F.max_by(v, o).alias(self.name), F.max(o).alias(f"{self.name}__order")]
        if self.kind == "distinct":
            return [F.hll_sketch_agg(v, HLL_LG_K).alias(self.name)]
        if self.kind == "quantiles":
            return [F.kll_sketch_agg_double(v.cast("double"), KLL_K).alias(self.name)]
        return [{"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[self.kind](v).alias(self.name)]

    def merge(self) -> list[Column]:
        """Aggregates of partials."""
        if self.kind == "latest":
            return [F.max_by(self.name, f"{self.name}__order").alias(self.name), F.max(f"{self.name}__order").alias(f"{self.name}__order")]
        how = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "distinct": F.hll_union_agg, "quantiles": F.kll_merge_agg_double}
        return [how[self.kind](self.name).alias(self.name)]


def distinct_of(sketch: str) -> Column:
    """Estimated number of distinct values in a ``distinct`` measure."""
    return F.hll_sketch_estimate(sketch)


def quantile_of(sketch: str, share: float) -> Column:
    """A value near the given share of a ``quantiles`` measure; null for a group without values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))


def roll_up(partials: DataFrame, keys: list, measures: list[Measure]) -> DataFrame:
    """Partials of coarser groups, for instance of months from those of days; no row is read again."""
    return partials.groupBy(*keys).agg(*[c for m in measures for c in m.merge()])


@dataclass
class Partials:
    """Partial aggregates of the groups ``keys`` under ``path``; ``part``, one of the keys, is the folder column."""
    path: str
    keys: list[str]
    part: str
    measures: list[Measure]

    def _check(self, spark: SparkSession) -> None:
        asked = (self.keys, self.part, [f"{m.name}={m.kind}({m.value};{m.order})" for m in self.measures])
        if not path_exists(spark, f"{self.path}/meta/_SUCCESS"):
            schema = "keys array<string>, part string, measures array<string>"
            spark.createDataFrame([asked], schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/meta")
            return
        made = spark.read.parquet(f"{self.path}/meta").first()
        if (list(made["keys"]), made["part"], list(made["measures"])) != asked:
            raise ValueError(f"the aggregates at {self.path} were made with other keys or measures")

    def _numbers(self, spark: SparkSession, sub: str) -> list[int]:
        """Complete folders under ``sub``; names only."""
        if not path_exists(spark, f"{self.path}/{sub}"):
            return []
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{sub}")
        listed = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
        return sorted(int(n) for n in (s.getPath().getName() for s in listed) if path_exists(spark, f"{self.path}/{sub}/{n}/_SUCCESS"))

    def _current(self, spark: SparkSession) -> tuple[int, int, list[int]]:
        """(generation of the base or -1, highest batch in it or -1, later batches)."""
        made = self._numbers(spark, "commits")
        generation = made[-1] if made else -1
        through = spark.read.parquet(f"{self.path}/commits/{generation}").first()["through"] if made else -1
        return generation, through, [b for b in self._numbers(spark, "delta") if b > through]

    def _merged(self, rows: DataFrame) -> DataFrame:
        return roll_up(rows, self.keys, self.measures)

    def add(self, rows: DataFrame, batch_id: int) -> DataFrame | None:
        """Count a batch; its partials as written (the groups it touched), or None if it has none or was counted in a base."""
        spark = rows.sparkSession
        self._check(spark)
        if batch_id <= self._current(spark)[1]:
            return None
        folder = f"{self.path}/delta/{batch_id}"
        # One partial aggregation and a shuffle of at most one row per task and group. The small result is gathered by
        # folder, so that a folder has few files; AQE splits a folder with very many groups.
        made = rows.groupBy(*self.keys).agg(*[c for m in self.measures for c in m.first()])
        made.hint("rebalance", F.col(self.part)).write.mode("overwrite").partitionBy(self.part).parquet(folder)
        if not data_files(spark, folder):
            remove_path(spark, folder)
            return None
        return self._typed(spark, spark.read.parquet(folder), rows)

    def _typed(self, spark: SparkSession, stored: DataFrame, like: DataFrame) -> DataFrame:
        # A folder column comes back with a guessed type.
        return stored.withColumn(self.part, F.col(self.part).cast(like.schema[self.part].dataType))

    def read(self, spark: SparkSession, touched: DataFrame | None = None) -> DataFrame:
        """Merged partials, of the folders that ``touched`` has (column ``part``) or of all."""
        generation, _, batches = self._current(spark)
        folders = ([f"{self.path}/base/{generation}"] if generation >= 0 else []) + [f"{self.path}/delta/{b}" for b in batches]
        if not folders:
            raise ValueError(f"no aggregates at {self.path}")
        rows = None
        for f in folders:
            one = spark.read.parquet(f)
            rows = one if rows is None else rows.unionByName(one)
        if touched is not None:  # the folders are pruned by the values at run time
            rows = rows.join(touched.select(F.col(self.part)).distinct(), self.part, "left_semi")
        return self._merged(rows)

    def compact_if_due(self, spark: SparkSession) -> bool:
        """Merge into a new base when the deltas have grown to the size of the base (without one: of the largest delta)."""
        generation, _, batches = self._current(spark)
        sizes = sorted(input_bytes(spark, [f"{self.path}/delta/{b}"]) for b in batches)
        base = input_bytes(spark, [f"{self.path}/base/{generation}"]) if generation >= 0 else sizes.pop() if sizes else 0
        if not sizes or sum(sizes) < COMPACT_AT * base:
            return False
        self.compact(spark)
        return True

    def compact(self, spark: SparkSession) -> None:
        generation, _, batches = self._current(spark)
        if not batches:
            return
        old = ([f"{self.path}/base/{generation}"] if generation >= 0 else []) + [f"{self.path}/delta/{b}" for b in batches]
        n = -(-input_bytes(spark, old) // FILE_BYTES)
        new = generation + 1
        cluster_for_write(self.read(spark), [self.part], n).write.mode("overwrite").partitionBy(self.part).parquet(f"{self.path}/base/{new}")
        (spark.createDataFrame([(max(batches),)], "through long").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/commits/{new}"))
        for f in old:
            remove_path(spark, f)

    def refresh(self, spark: SparkSession, delta: DataFrame, gold: str, finish) -> None:
        """Rewrite the folders of ``gold`` that a batch touched, from the merged partials alone; ``finish`` turns these into gold rows."""
        write_partitioned(finish(self.read(spark, delta)), gold, [self.part], mode="overwrite", dynamic=True)
