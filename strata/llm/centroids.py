"""Centroid clustering of vectors with the threshold algorithm as nearest-centroid search.

Vectors become integers (floor of a multiple), so that every result is exact. For each dimension
the centroids are sorted by their component. A vector walks these lists outward from its own value,
one entry a dimension and step: each centroid it meets gets its exact distance, and the squares of
the gaps at the frontiers add up to a bound that no centroid yet unmet can fall below. The walk
stops when that bound strictly exceeds the best exact distance, so that a centroid at the same
distance with a smaller number is never missed.

Spark deals the vectors; a round is one pass that gives each task's sums per cluster, added by an
aggregate. Only the centroids (clusters x dimensions numbers) come to the driver and go to the tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import column, scratch, small_batches, trim

CLUSTERS, DIMENSIONS, ROUNDS, SCALE, SEED = 8, 64, 10, 1024, 3
#: Components up to this size keep every squared distance over up to 4096 dimensions within 64 bits.
SMALL = 1 << 24


def exact_type(*arrays: np.ndarray):
    """int64 where no squared distance can overflow, else Python integers."""
    return np.int64 if all(not a.size or max(int(a.max()), -int(a.min())) <= SMALL for a in arrays) else object


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance) of each row of ``x``, ties to the smaller
    number, and how many exact distances were taken."""
    kind = exact_type(x, centroids)
    x, c = x.astype(kind), centroids.astype(kind)
    (rows, dims), k = x.shape, len(c)
    order = np.argsort(c, axis=0, kind="stable")
    lists = np.take_along_axis(c, order, 0)
    high = np.empty((rows, dims), np.int64)  # next entry upward of each list; the one below is next downward
    for j in range(dims):
        high[:, j] = np.searchsorted(lists[:, j], x[:, j])
    low, dim = high - 1, np.arange(dims)[None, :]
    far = np.iinfo(np.int64).max if kind is np.int64 else 1 << 4000
    distance = np.full((rows, k), far, kind)
    met = np.zeros((rows, k), bool)
    taken, active = 0, np.arange(rows)
    for _ in range(k):
        if not len(active):
            break
        v, lo, hi = x[active], low[active], high[active]
        below = np.where(lo >= 0, v - lists[np.maximum(lo, 0), dim], far)
        above = np.where(hi < k, lists[np.minimum(hi, k - 1), dim] - v, far)
        down = below <= above
        gap = np.where(down, below, above)
        entry = order[np.where(down, lo, hi), dim]
        low[active], high[active] = lo - down, hi + ~down
        seen = np.zeros((len(active), k), bool)
        seen[np.arange(len(active))[:, None], entry] = True
        i, j = np.nonzero(seen & ~met[active])
        met[active] |= seen
        diff = v[i] - c[j]
        distance[active[i], j] = (diff * diff).sum(1)
        taken += len(i)
        active = active[(gap * gap).sum(1) <= distance[active].min(1)]
    best = distance.argmin(1)
    return best, distance[np.arange(rows), best], taken


def vectors_of(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def quantised(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(id, q): rows with exactly ``dims`` components, none null or non-finite, as integers."""
    v = column(df, vector_col)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    limit = F.lit(float(1 << 62))

    def number(x):
        y = x.cast("double") * scale
        return F.when(F.abs(y) < limit, F.floor(y)).otherwise(F.raise_error(F.lit("a vector component is too large for exact clustering")).cast("long"))

    kept = df.where(F.coalesce((F.size(v) == dims) & whole, F.lit(False)))
    return kept.select(column(df, id_col).alias("id"), F.transform(v, number).alias("q"))


def cluster_sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """For each cluster with vectors, (sum, count) of each dimension; a task sends one row a cluster."""
    k, dims = centroids.shape
    schema = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("sums", T.ArrayType(T.StringType()))])

    def run(batches):
        sums, n = [[0] * dims for _ in range(k)], [0] * k
        for b in batches:
            x = vectors_of(b, dims)
            if not len(x):
                continue
            x = x.astype(exact_type(x))
            number, _, _ = nearest(x, centroids)
            for c in np.unique(number):
                mine = x[number == c]
                n[c] += len(mine)
                sums[c] = [a + int(s) for a, s in zip(sums[c], mine.sum(0))]
        at = [c for c in range(k) if n[c]]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([n[c] for c in at], pa.int64()),
                                          pa.array([list(map(str, sums[c])) for c in at], pa.list_(pa.string()))], names=schema.names)
        trim()

    parts = vectors.mapInArrow(run, schema).select("cluster", "n", F.posexplode("sums").alias("dim", "s"))
    total = parts.groupBy("cluster", "dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    out: dict[int, list[tuple[int, int]]] = {}
    for r in total.orderBy("cluster", "dim").collect():  # clusters x dimensions rows
        out.setdefault(r.cluster, []).append((int(r.s), r.n))
    return out


def centroid_clusters(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, dims: int = DIMENSIONS,
                      rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """Per kept row: ``id_col``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Kept are rows whose vector has exactly ``dims`` components, none null or non-finite; the others have
    no result row. The first centroids are the rows with the smallest sha256 of ``<seed>:<id>`` (rows
    with equal ids: the smaller vector first; null ids last); with fewer rows than ``clusters`` each row
    is a centroid, and an empty table gives no rows. Repeated rows count as often as they occur. A distance or
    a sum of them beyond 64 bits fails the job.
    """
    spark = df.sparkSession
    small_batches(spark)
    vectors = scratch(quantised(df, id_col, vector_col, dims, scale), "vectors")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.orderBy(key.asc_nulls_last(), "q").limit(clusters).collect()
    centroids = np.array([r.q for r in first], object).reshape(len(first), dims)
    for _ in range(rounds if len(first) else 0):
        for c, total in cluster_sums(vectors, centroids).items():
            centroids[c] = [s // n for s, n in total]
    schema = T.StructType([vectors.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def assign(batches):
        for b in batches:
            x = vectors_of(b, dims)
            if len(x):
                number, distance, _ = nearest(x, centroids)
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(number, pa.int32()), pa.array(distance.tolist(), pa.int64())], names=schema.names)
        trim()

    assigned = scratch(vectors.mapInArrow(assign, schema), "assigned")
    inertia = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    number = lambda x: F.lit(str(x)).cast("decimal(38,0)").cast("long")
    of_cluster, digest = number(0), F.lit("")
    for c in inertia:
        mine = F.col("cluster") == c
        of_cluster = F.when(mine, number(inertia[c])).otherwise(of_cluster)
        digest = F.when(mine, F.lit(hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())).otherwise(digest)
    return assigned.select(F.col("id").alias(id_col), "cluster", "distance", of_cluster.alias("cluster_inertia"),
                           number(sum(inertia.values())).alias("inertia"), digest.alias("centroid_sha256"))


def centroid_sql(vectors: str = "embeddings", clusters: int = CLUSTERS, dims: int = DIMENSIONS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> str:
    """DuckDB SQL for the same rows, by brute force over all centroids."""
    parts = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, embedding FROM {vectors}
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"comp AS MATERIALIZED (SELECT rid, d, CAST(floor({scale} * CAST(embedding[d] AS DOUBLE)) AS BIGINT) AS v FROM kept, range(1, {dims + 1}) AS r(d))",
             f"""c0 AS MATERIALIZED (SELECT f.c, d, v FROM comp JOIN (SELECT rid, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), rid) - 1 AS c FROM kept
  QUALIFY c < {clusters}) f USING (rid))"""]
    assign = """a{i} AS MATERIALIZED (SELECT rid, arg_min(c, (dist, c)) AS c, min(dist) AS dist FROM (SELECT rid, c, sum((comp.v - c{i}.v) * (comp.v - c{i}.v)) AS dist
  FROM comp JOIN c{i} USING (d) GROUP BY rid, c) GROUP BY rid)"""
    for i in range(rounds):
        parts += [assign.format(i=i), f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.c, c{i}.d, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN
  (SELECT c, d, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS v FROM (SELECT c, d, sum(v) AS s, CAST(count(*) AS HUGEINT) AS n FROM a{i} JOIN comp USING (rid) GROUP BY c, d)) m
  ON m.c = c{i}.c AND m.d = c{i}.d)"""]
    parts += [assign.format(i=rounds), f"h AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS digest FROM c{rounds} GROUP BY c)"]
    return f"""WITH {', '.join(parts)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance, CAST(sum(dist) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(dist) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256 FROM a{rounds} a JOIN kept USING (rid) JOIN h ON h.c = a.c"""
