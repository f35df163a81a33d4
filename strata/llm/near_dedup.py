"""Near-duplicate documents by SetSketch registers.

A document's set of word shingles is sketched in registers that hold
truncated, exponentially spaced minima: register = floor(1 - log_b(minimum)).
Registers of a union are the larger ones of the parts, and two sets agree in a
register with about their Jaccard similarity. Bands of registers are hashed;
in each bucket every member is paired with the smallest one (no pairs within a
group). A pair's similarity is first estimated jointly by likelihood from the
numbers of larger, smaller and equal registers; pairs that aren't clearly below
the threshold are then verified on the full shingle sets.

With the default 60 bands of 6 registers a pair at similarity 0.75 shares no
band with a probability of 8e-6, and the estimate cuts 6 standard errors below
the threshold.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import column, map_text, scratch, small_batches, trim
from strata.llm.components import components, roots

BANDS, ROWS = 60, 6
BASE, RATE, TOP = 1.001, 20.0, 65535
WORDS = 5
#: Slots of the table that counts shingles by hash; one byte each goes to the tasks, at any size of the input.
SLOTS, SLOT_BLOCKS = 1 << 20, 64
#: Tasks whose counts are summed in one group.
TASKS = 256
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
MIX = np.uint64(0x9E3779B97F4A7C15)


def draws(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_words(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def shingle_hashes(text: bytes, odd: np.ndarray) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles (fewer words than a shingle: of the whole sequence)."""
    from xxhash import xxh64_intdigest
    words = shingle_words(text)
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, words), np.uint64, n)
    k = min(n, len(odd))
    g = h[:n - k + 1] * odd[0]
    for i in range(1, k):
        g = g + h[i:n - k + 1 + i] * odd[i]
    return np.unique(mixed(g + np.uint64(k)))


def shingle_set(text: bytes, size: int = WORDS) -> set:
    words = shingle_words(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size))))


def registers(x: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Registers of a set of 32-bit hashes: one multiplicative hash each, minimum, exponential variate, truncated logarithm."""
    low = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(low, np.multiply.outer(factors, x[i:i + 2048]).min(1), out=low)
    minimum = -np.log1p(-(low + 0.5) / 2.0 ** 32) / RATE
    return np.clip(np.floor(1 - np.log(minimum) / np.log(BASE)), 0, TOP).astype("<u2")


def sketcher(bands: int, rows: int, words: int):
    odd, factors = draws(words, 1), (draws(bands * rows, 2) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

    def sketch(texts: list[bytes]):
        size, key, regs = [], [], []
        for text in texts:
            g = shingle_hashes(text, odd)
            size.append(len(g))
            if not len(g):
                key.append(None)
                regs.append(None)
                continue
            key.append(np.array([g.sum(), mixed(g * MIX).sum()], np.uint64).tobytes() + len(g).to_bytes(8, "little"))
            regs.append(registers((g >> np.uint64(32)).astype(np.uint32), factors).tobytes())
        return [size, key, regs]

    return sketch


def band_keys(df: DataFrame, bands: int, rows: int) -> DataFrame:
    """(id, n, band): a row for each band of each sketch in ``df(id, n, regs)``."""
    odd = draws(rows + 1, 3)
    schema = T.StructType([df.schema["id"], T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        for b in batches:
            r = np.frombuffer(b"".join(b.column("regs").to_pylist()), "<u2").reshape(-1, bands, rows).astype(np.uint64)
            h = np.arange(bands, dtype=np.uint64)[None, :] * odd[rows]
            for i in range(rows):
                h = mixed(h + r[:, :, i] * odd[i])
            flat = pa.array(h.reshape(-1).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(r) + 1) * bands, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([b.column("id"), lists], names=["id", "bands"])
        trim()

    return df.select("id", "regs").mapInArrow(run, schema).select("id", F.explode("bands").alias("band"))


def likeliest(n_a, n_b, larger, smaller, equal) -> np.ndarray:
    """Jaccard similarities of largest likelihood, given set sizes and the numbers of registers that are larger, smaller and equal."""
    n_a, n_b, larger, smaller, equal = (np.asarray(x, float)[:, None] for x in (n_a, n_b, larger, smaller, equal))
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    j = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)
    p = lambda x: -np.log(1 - np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)
    more, less = p(u - v * j), p(v - u * j)
    ll = larger * np.log(more) + smaller * np.log(less) + equal * np.log(np.maximum(1 - more - less, 1e-12))
    return j[np.arange(len(j)), ll.argmax(1)]


def estimated(pairs: DataFrame, sketches: DataFrame, bands: int, rows: int, least: float) -> DataFrame:
    """``(a, b, estimate)`` of the pairs whose likeliest similarity is at least ``least``."""
    m, kind = bands * rows, pairs.schema["a"].dataType
    one = lambda c: sketches.select(F.col("id").alias(c), F.col("n").alias("n_" + c), F.col("regs").alias("r_" + c))
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("estimate", T.DoubleType())])

    def run(batches):
        for t in batches:
            if not t.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(t.column(c).to_pylist()), "<u2").reshape(-1, m) for c in ("r_a", "r_b"))
            larger, smaller = (ra > rb).sum(1), (ra < rb).sum(1)
            j = likeliest(t.column("n_a").to_numpy(), t.column("n_b").to_numpy(), larger, smaller, m - larger - smaller)
            ok = np.flatnonzero(j >= least)
            yield pa.RecordBatch.from_arrays([t.column("a").take(pa.array(ok)), t.column("b").take(pa.array(ok)), pa.array(j[ok])], names=["a", "b", "estimate"])
        trim()

    return pairs.join(one("a"), "a").join(one("b"), "b").mapInArrow(run, schema)


def verified(pairs: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets in ``texts(id, t)`` reach the threshold."""
    kind = pairs.schema["a"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    one = lambda c: texts.select(F.col("id").alias(c), F.col("t").alias("t_" + c))

    def run(batches):
        sets = lru_cache(16)(lambda text: shingle_set(text, words))
        for t in batches:
            ok = []
            for i, (x, y) in enumerate(zip(t.column("t_a").cast(pa.binary()).to_pylist(), t.column("t_b").cast(pa.binary()).to_pylist())):
                p, q = sets(x or b""), sets(y or b"")
                both = len(p & q)
                if p and q and 100 * both >= percent * (len(p) + len(q) - both):
                    ok.append(i)
            yield pa.RecordBatch.from_arrays([t.column(c).take(pa.array(ok, pa.int64())) for c in ("a", "b")], names=["a", "b"])
        sets.cache_clear()
        trim()

    return pairs.select("a", "b").join(one("a"), "a").join(one("b"), "b").mapInArrow(run, schema)


def slot_levels(hashed: DataFrame) -> np.ndarray:
    """For each slot of the hashes, the bit length of the number of shingles in it.

    Counts of each task are summed by blocks of slots over ``TASKS`` neighbouring tasks, then over as many
    of these, and so on, so that no group grows with the input; the result has one byte for each slot.
    """
    from pyspark import TaskContext
    width = SLOTS // SLOT_BLOCKS
    count = T.StructType([T.StructField("part", T.LongType()), T.StructField("block", T.LongType()), T.StructField("counts", T.BinaryType())])

    def run(batches):
        total = np.zeros(SLOTS, np.int64)
        for b in batches:
            for g in b.column(0).to_pylist():
                np.add.at(total, slots(np.frombuffer(g, np.uint64)), 1)
        if total.any():
            part = TaskContext.get().partitionId()
            body = [x.tobytes() for x in total.reshape(SLOT_BLOCKS, width)]
            yield pa.RecordBatch.from_arrays([pa.array([part] * SLOT_BLOCKS, pa.int64()), pa.array(range(SLOT_BLOCKS), pa.int64()), pa.array(body, pa.binary())], names=count.names)
        del total
        trim()

    def add(pdf):
        total = sum(np.frombuffer(x, np.int64) for x in pdf["counts"])
        return pdf.iloc[:1].assign(counts=[total.tobytes()])

    summed, parts = hashed.select("hashes").mapInArrow(run, count), hashed.rdd.getNumPartitions()
    while parts:
        parts = (parts - 1) // TASKS
        summed = summed.withColumn("part", F.floor(F.col("part") / TASKS)).groupBy("part", "block").applyInPandas(add, count)
    level = np.zeros((SLOT_BLOCKS, width), np.uint8)
    for _, block, body in summed.toLocalIterator():
        level[block] = np.ceil(np.log2(np.frombuffer(body, np.int64) + 1))
    return level.ravel()


def slots(g: np.ndarray) -> np.ndarray:
    return (g >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)


def prefix_pairs(base: DataFrame, left: DataFrame, percent: int, words: int) -> DataFrame:
    """Pairs ``(a, b)`` of ``left(id, component)`` of different components that may be linked: every pair
    at the threshold is among them (up to equal 64-bit hashes).

    The shingles of a text are ordered from rare to frequent. At the threshold t, two sets of n <= m
    shingles share at least 2t/(1+t) n and at least t m, so they share one of the first
    n - 2t/(1+t) n + 1 of the smaller and the first m - t m + 1 of the larger. All they share comes
    at or after their first shared shingle, so a pair is formed only at a shingle that leaves
    t/(1+t) (n + m) shingles in both sets; a shingle that all copies in a crowd have is seldom such.
    """
    kind = left.schema["id"].dataType
    odd = draws(words, 1)
    base_fields = [T.StructField("id", kind), T.StructField("component", kind)]
    hash_schema = T.StructType([*base_fields, T.StructField("hashes", T.BinaryType())])
    schema = T.StructType([*base_fields, T.StructField("n", T.LongType()), T.StructField("near", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType()))])

    def hashes(batches):
        for b in batches:
            made = [shingle_hashes(t or b"", odd).tobytes() for t in b.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.binary())], names=hash_schema.names)
        trim()

    hashed = scratch(base.join(left, "id").select("id", "component", "t").mapInArrow(hashes, hash_schema), "hashes")
    level = slot_levels(hashed)

    def prefixes(batches):
        for b in batches:
            n, near, tokens = [], [], []
            for x in b.column(2).to_pylist():
                g = np.frombuffer(x, np.uint64)
                size = len(g)
                order = np.lexsort((g, level[slots(g)]))
                n.append(size)
                near.append(size + (-2 * percent * size // (100 + percent)) + 1)
                tokens.append(g[order[:size + (-percent * size // 100) + 1]].view(np.int64) if size else np.zeros(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(t) for t in tokens])]), pa.int32()), pa.array(np.concatenate([*tokens, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(near, pa.int64()), lists], names=schema.names)
        trim()

    made = hashed.mapInArrow(prefixes, schema).select("id", "component", "n", "near", F.posexplode("tokens").alias("place", "token"))
    made = scratch(made.select("id", "component", "n", "token", (F.col("n") - F.col("place")).alias("after"), (F.col("place") < F.col("near")).alias("first")), "prefixes")
    several = made.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where(F.col("lo") < F.col("hi"))
    made = made.join(several.select("token"), "token")
    small = made.where("first").select("token", *[F.col(c).alias("s_" + c) for c in ("id", "component", "n", "after")])
    pairs = made.join(small, "token").where((F.col("component") != F.col("s_component")) & (100 * F.col("s_n") >= percent * F.col("n"))
                                            & ((100 + percent) * F.least("after", "s_after") >= percent * (F.col("n") + F.col("s_n")))
                                            & ((F.col("s_n") < F.col("n")) | ((F.col("s_n") == F.col("n")) & (F.col("s_id") < F.col("id")))))
    return pairs.select(F.greatest("id", "s_id").alias("a"), F.least("id", "s_id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
                    bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """Per row: ``id_col``, ``n_shingles``, ``component_id`` (the smallest id reachable over links), ``kept``.

    Equal sets are one class before anything is paired, so a crowd of exact copies costs one
    aggregate. In each band bucket the classes are paired with the smallest one, and each class
    verifies its likeliest pair; that gives first components. The members of buckets that still hold
    several of them meet by their rarest shingles (``prefix_pairs``): no link among these members is
    missed. Pairs are formed only across components, at shingles that can be a linked pair's first shared one.
    Null and empty texts are linked with nothing. Rows with the same id are one document (each
    row is returned). A null id joins its class but is never its smallest id.
    """
    small_batches(docs.sparkSession)
    fields = [T.StructField("n", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("regs", T.BinaryType())]
    base = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).alias("t"))
    sketches = scratch(map_text(base, "t", ["id"], fields, lambda: sketcher(bands, rows, words)), "sketches")
    classes = scratch(sketches.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep")), "classes")
    reps = sketches.join(classes, "key").where(F.col("id") == F.col("rep")).select("id", "n", "regs").dropDuplicates(["id", "regs"])
    reps = scratch(reps, "reps")
    banded = band_keys(reps, bands, rows)
    hubs = banded.groupBy("band").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where(F.col("hub") < F.col("last"))
    members = scratch(banded.join(hubs.select("band", "hub"), "band"), "members")
    least = percent / 100 - 6 * np.sqrt(percent / 100 * (1 - percent / 100) / (bands * rows))

    pairs = members.where(F.col("id") != F.col("hub")).select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    likely = scratch(estimated(pairs, reps, bands, rows, least), "likely")
    first = likely.groupBy("a").agg(F.max_by("b", F.struct("estimate", -F.col("b"))).alias("b"))
    same = scratch(roots(verified(first, base, percent, words)), "same")
    named = members.select("band", "id").join(same, "id", "left").select("band", "id", F.coalesce("component", "id").alias("component"))
    mixed_up = named.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where(F.col("lo") < F.col("hi"))
    left = named.join(mixed_up.select("band"), "band").select("id", "component").distinct()
    pairs = prefix_pairs(base, left, percent, words)
    found = verified(estimated(pairs, reps, bands, rows, least), base, percent, words)
    ends = found.join(same.toDF("a", "c_a"), "a", "left").join(same.toDF("b", "c_b"), "b", "left")
    links = scratch(ends.select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b")).distinct(), "links")
    if links.head(1):
        # Components of the first components; ids that had none yet are components of their own.
        joined = components(links).toDF("component", "whole")
        more = joined.join(same.select("component").distinct(), "component", "left_anti").select(F.col("component").alias("id"), F.col("whole").alias("component"))
        same = same.join(joined, "component", "left").select("id", F.coalesce("whole", "component").alias("component")).unionAll(more)
    out = (sketches.select("id", "n", "key").join(classes, "key", "left")
           .join(same.select(F.col("id").alias("rep"), "component"), "rep", "left"))
    component = F.coalesce("component", "rep", "id")
    out = out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", column(out, id_col).eqNullSafe(F.col("component_id")))
