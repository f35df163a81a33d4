"""Masked pseudo-likelihood from a bidirectional window network in numpy.

Every token of a text is predicted from ``WINDOW`` tokens on each side; a
document's score is the sum of the conditional log-probabilities. Words become
symbols through a table of hashed word counts over the whole corpus (frequent
buckets have a symbol each, the others share some), so the network's size
doesn't follow the corpus. The words themselves do: a table of all words and
their counts, made and joined by Spark, gives every word its share of its
symbol's probability. Texts are split once, into a scratch table of symbol
sequences. The network is trained on these by rounds of local steps in every
partition, every token being a target in one of the rounds; the partitions'
weights are averaged by a Spark aggregate. The sequences are put in an order of
their own, in files of about ``TASK_TOKENS``, so scores don't depend on the order or the
partitions of the input (a session with other file splits may read several small
files in one task, which changes them a little). Steps begin small and grow with the
tokens seen.
"""

from __future__ import annotations

import zlib
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.llm.common import TEXT_BUDGET, column, keep_freed, longs, map_text, runs, scratch, small_batches, trim

WINDOW, DIM, HIDDEN, SIDE = 2, 16, 32, 32
SYMBOLS = SIDE * SIDE  # a symbol is a pair (class, member) of SIDE classes with SIDE members each
SHARED = 256  # symbols that rare words share
BUCKETS = 1 << 16
BATCH, ROUNDS, RATE = 4096, 4, 2e-2  # the rate of a full batch; smaller ones go by its square root
FIRST, GROWTH = 256, 64  # a step takes a GROWTH-th of the targets seen before, from FIRST to BATCH
GRID = np.float32(256)
TASK_TOKENS = 1 << 21  # a training task has so many tokens where the corpus has them: averages of many short runs learn little
OFFSETS = [k for k in range(-WINDOW, WINDOW + 1) if k]
SCALE = 1 << 24  # weights are averaged, and log counts summed, as integers, which add up alike in any order
FREQUENT = 1 << 18  # words of at least one in so many tokens (so no more words than that) are looked up in the tasks


def bucket(word: bytes) -> int:
    return zlib.crc32(word) % BUCKETS


def symbol_table(counts: np.ndarray) -> np.ndarray:
    """The symbol of each bucket: by falling count (ties: the lower bucket), then shared ones."""
    order = np.argsort(-counts, kind="stable")
    table = (SYMBOLS - SHARED + np.arange(BUCKETS) % SHARED).astype(np.int64)
    own = order[:SYMBOLS - SHARED]
    table[own] = np.arange(len(own))
    return table


def reader(table: np.ndarray, cache_words: int = 300_000):
    """A function from a text to its symbols."""
    class Known(dict):
        def __missing__(self, word):
            self[word] = symbol = int(table[bucket(word)])
            return symbol

    known = Known()

    def symbols(text: bytes) -> np.ndarray:
        words = text.split()
        if len(known) > cache_words:
            known.clear()
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    return symbols


def contexts(texts: list[np.ndarray], r: int = 0, rounds: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(targets, contexts, text of each target) of the tokens whose place in their own text is ``r`` modulo ``rounds``: over all ``r``,
    every token once. Places outside a text have the symbol ``SYMBOLS``."""
    pad = np.full(WINDOW, SYMBOLS, np.int64)
    line = np.concatenate([x for t in texts for x in (pad, t)] + [pad])
    sizes = np.array([len(t) for t in texts])
    of = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(of)) + WINDOW * (of + 1)
    if rounds > 1:
        mine = (np.arange(len(of)) - (np.cumsum(sizes) - sizes)[of]) % rounds == r
        of, at = of[mine], at[mine]
    return line[at], np.stack([line[at + k] for k in OFFSETS], 1), of


def initial(counts: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Small random weights; the biases are the log frequencies, so training starts from the unigram model."""
    rng = np.random.default_rng(seed)
    mass = np.bincount(symbol_table(counts), weights=counts, minlength=SYMBOLS).reshape(SIDE, SIDE) + 1.0
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    return {"embed": rng.standard_normal((SYMBOLS + 1, DIM)).astype(np.float32) * 0.3,
            "hidden": draw(DIM * len(OFFSETS), HIDDEN), "hidden_bias": np.zeros(HIDDEN, np.float32),
            "class": draw(HIDDEN, SIDE) * 0.1, "class_bias": np.log(mass.sum(1) / mass.sum()).astype(np.float32),
            "member": draw(HIDDEN, SIDE) * 0.1, "member_bias": np.log(mass / mass.sum(1, keepdims=True)).astype(np.float32)}


def log_softmax(z: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log-probability of row ``at`` in each column, weights, their sums); columns are targets, so sums run along contiguous rows."""
    z -= z.max(0)
    own = z[at, rows]
    e = np.exp(z, out=z)
    total = e.sum(0)
    return own - np.log(total), e, total


def softmax(z: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log-probability of row ``at`` in each column, probabilities)."""
    own, e, total = log_softmax(z, at, rows)
    e /= total
    return own, e


def on_grid(net):
    """The network with weights on the grid 1 / ``GRID``: with hidden values on it too, products and sums below 256 are exact in
    32 bits, in whatever order a library adds them, so that equal texts get equal scores."""
    return {k: (np.round(v * GRID) / GRID).astype(np.float32) for k, v in net.items()}


def forward(net, context, target):
    x = net["embed"].take(context, 0).reshape(len(context), -1)
    h = x @ net["hidden"]
    h += net["hidden_bias"]
    np.maximum(h, 0, out=h)
    c, m = target // SIDE, target % SIDE
    rows = np.arange(len(target))
    log_c, p_c = softmax(np.add((h @ net["class"]).T, net["class_bias"][:, None], order="C"), c, rows)
    log_m, p_m = softmax(np.add((h @ net["member"]).T, net["member_bias"].take(c, 0).T, order="C"), m, rows)
    return log_c + log_m, (x, h, c, m, p_c, p_m, rows)


def gradient(net, context, target):
    """Gradient of the mean negative log-probability of the targets."""
    _, (x, h, c, m, dc, dm, rows) = forward(net, context, target)
    dc[c, rows] -= 1
    dm[m, rows] -= 1
    dc /= len(target)
    dm /= len(target)
    dh = dc.T @ net["class"].T
    dh += dm.T @ net["member"].T
    dh *= h > 0
    dx = (dh @ net["hidden"].T).reshape(-1, DIM)
    # The rows of each context symbol are brought together and summed.
    flat = context.reshape(-1).astype(np.uint16)
    order = np.argsort(flat, kind="stable")
    line = flat[order]
    starts = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    embed = np.zeros((SYMBOLS + 1, DIM), dx.dtype)
    embed[line[starts]] = np.add.reduceat(dx.take(order, 0), starts, axis=0)
    of_class = np.zeros((len(target), SIDE), dm.dtype)
    of_class[rows, c] = 1
    return {"embed": embed, "hidden": x.T @ dh, "hidden_bias": dh.sum(0), "class": h.T @ dc.T, "class_bias": dc.sum(1),
            "member": h.T @ dm.T, "member_bias": (dm @ of_class).T}


class Trainer:
    """Adam steps on batches of targets; the weights lie in one vector, of which ``net`` has views."""

    def __init__(self, net):
        self.flat = pack_net(net)
        self.net = unpack_net(self.flat, net)
        self.m, self.v = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.steps = self.seen = 0

    def learn(self, context, target):
        i = 0
        while i < len(target):
            n = min(max(self.seen // GROWTH, FIRST), BATCH)
            self.steps += 1
            rate = RATE * np.sqrt(n / BATCH)
            g = pack_net(gradient(self.net, context[i:i + n], target[i:i + n]))
            fix = np.sqrt(1 - 0.99 ** self.steps) / (1 - 0.9 ** self.steps)
            self.m *= 0.9
            self.m += 0.1 * g
            self.v *= 0.99
            self.v += 0.01 * g * g
            self.flat -= rate * fix * self.m / (np.sqrt(self.v) + 1e-8)
            self.seen += len(target[i:i + n])
            i += n


def pack_net(net) -> np.ndarray:
    return np.concatenate([net[k].reshape(-1) for k in sorted(net)]).astype(np.float32, copy=False)


def unpack_net(flat: np.ndarray, like) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32, copy=False)
        at += like[k].size
    return out


def rows_of(df: DataFrame, of, fields: list[T.StructField], per_partition) -> DataFrame:
    """Rows of ``fields`` from what ``per_partition`` (an iterator of lists of bytes -> iterator of lists of arrays) yields in each
    partition; ``of`` is a text or binary column."""
    small_batches(df.sparkSession)
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        keep_freed()
        for made in per_partition([t or b"" for t in b.column(0).cast(pa.binary()).to_pylist()] for b in batches):
            for i in range(0, len(made[0]), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(a[i:i + 10_000], f.type) for a, f in zip(made, arrow)], schema=arrow)
        trim()

    return df.select(of.alias("t")).mapInArrow(run, schema)


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(number of words of each text, number of each word, the words by number): what ``bytes.split`` finds, split and numbered by Arrow."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    found = lists.flatten()
    real = np.asarray(pc.not_equal(pc.binary_length(found), 0))  # white space at an end of a text splits off an empty word
    ends = np.cumsum(np.r_[0, real])[np.cumsum(np.r_[0, np.asarray(lists.value_lengths())])]
    numbered = found.filter(pa.array(real)).dictionary_encode()
    return np.diff(ends), np.asarray(numbered.indices), numbered.dictionary.cast(pa.binary())


def as_bytes(words: pa.Array) -> list[bytes]:
    """The values of a binary column without nulls."""
    _, ends, data = words.buffers()
    line = data.to_pybytes() if data else b""
    ends = np.frombuffer(ends, np.int32)[words.offset:words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
    return [line[i:j] for i, j in pairwise(ends.tolist())]


def slices(texts: pa.Array, budget: int):
    """(start, length) of consecutive texts of about ``budget`` bytes."""
    for i, j in runs(pc.binary_length(texts).fill_null(0).to_pylist(), budget):
        yield i, j - i


def word_counts(docs: DataFrame, text_col: str = "text", cache_words: int = 300_000) -> DataFrame:
    """word, n: all words of the corpus, in a scratch table that grows with it."""
    small_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        keep_freed()
        held = []

        def summed():
            rows = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            held.clear()
            yield from rows.rename_columns(["word", "n"]).cast(arrow).to_batches(10_000)

        for batch in batches:
            for i, n in slices(batch.column(0), TEXT_BUDGET):
                _, at, words = split_words(batch.column(0).slice(i, n))
                held.append(pa.table({"word": words, "n": np.bincount(at, minlength=len(words)).astype(np.int64)}))
                if sum(map(len, held)) > cache_words:
                    yield from summed()
        if held:
            yield from summed()
        trim()

    found = docs.select(column(docs, text_col).cast("string").alias("t")).mapInArrow(run, schema)
    return scratch(found.groupBy("word").agg(F.sum("n").alias("n")), "words")


def bucket_counts(words: DataFrame) -> np.ndarray:
    """Words of the whole corpus by hashed bucket (a table of fixed size)."""
    out = np.zeros(BUCKETS, np.int64)
    for r in words.groupBy((F.crc32("word") % BUCKETS).alias("bucket")).agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def unpack_sequence(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint16).astype(np.int64)


def in_order(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """A table of the column ``seq`` in an order of its own (by a hash of sequence and ``id``), about ``TASK_TOKENS`` a file: what is
    learned depends neither on the order of the input nor on its partitions."""
    place = rows.select("seq", F.xxhash64("seq", "id").alias("place")).repartition(int(counts.sum()) // TASK_TOKENS + 1, "place")
    return scratch(place.sortWithinPartitions("place", "seq").select("seq"), "sequences")


def fit(seqs: DataFrame, counts: np.ndarray, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """A network learned from a stored table's column ``seq`` (packed symbols). In each round every partition starts from the common network and learns
    from all its texts, from every ``rounds``-th token of each (others in each round, so that all tokens are met); the results are averaged by the targets met."""
    net = initial(counts)
    sc = seqs.sparkSession.sparkContext
    for r in range(rounds):
        shared = sc.broadcast(net)  # of fixed size

        def local(batches, r=r, shared=shared):
            trainer = Trainer(shared.value)
            for raw in batches:
                for i, j in runs(map(len, raw), TEXT_BUDGET // 4):
                    target, context, _ = contexts([unpack_sequence(t) for t in raw[i:j]], r, rounds)
                    trainer.learn(context, target)
            if not trainer.seen:
                return
            flat = np.round(pack_net(trainer.net).astype(np.float64) * SCALE).astype(np.int64)
            # a partition counts in units of full batches, which keeps sums far from overflow
            n = np.full(len(flat), -(-trainer.seen // BATCH), np.int64)
            yield [np.arange(len(flat)), flat * n, n]

        parts = rows_of(seqs, F.col("seq"), longs("i", "v", "n"), local).groupBy("i").agg((F.sum(F.col("v").cast("decimal(38,0)")) / F.sum("n")).cast("double").alias("v")).collect()
        if parts:
            flat = np.zeros(len(parts))
            for p in parts:
                flat[p.i] = p.v / SCALE
            net = unpack_net(flat, net)
        shared.unpersist()
    return on_grid(net)


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, counts: np.ndarray | None = None, id_col: str = "doc_id"):
    """(symbol table, network) of a corpus."""
    counts = bucket_counts(word_counts(docs, text_col)) if counts is None else counts
    table = symbol_table(counts)
    shared = docs.sparkSession.sparkContext.broadcast(table)  # of fixed size

    def make():
        symbols = reader(shared.value)
        return lambda texts: [[symbols(t).astype(np.uint16).tobytes() for t in texts]]

    seqs = map_text(docs, text_col, [id_col], [T.StructField("seq", T.BinaryType())], make).toDF("id", "seq")
    return table, fit(in_order(seqs, counts), counts, rounds)


def score_symbols(seqs: list[np.ndarray], net) -> np.ndarray:
    """The sum of the symbols' conditional log-probabilities in each text.

    What each symbol at each offset adds to the hidden layer is worked out once, not for each token: on the grid these sums are exact."""
    target, context, of = contexts(seqs)
    adds = [net["embed"] @ w for w in net["hidden"].reshape(len(OFFSETS), DIM, HIDDEN)]
    out = np.zeros(len(seqs), np.int64)  # in units that add up alike wherever a batch is cut
    for i in range(0, len(target), BATCH):
        t, at = target[i:i + BATCH], context[i:i + BATCH]
        h = adds[0].take(at[:, 0], 0)
        for k in range(1, len(adds)):
            h += adds[k].take(at[:, k], 0)
        h += net["hidden_bias"]
        np.maximum(h, 0, out=h)
        h *= GRID
        np.round(h, out=h)
        h /= GRID
        c, rows = t // SIDE, np.arange(len(t))
        of_class, of_member = net["class"].T @ h.T, net["member"].T @ h.T
        of_class += net["class_bias"][:, None]
        of_member += net["member_bias"].T.take(c, 1)
        logp = log_softmax(of_class, c, rows)[0] + log_softmax(of_member, t % SIDE, rows)[0]
        out += np.bincount(of[i:i + BATCH], weights=np.round(logp * np.float64(SCALE)), minlength=len(seqs)).astype(np.int64)
    return out / SCALE


def score_texts(texts: list[bytes], symbols, net):
    seqs = [symbols(t) for t in texts]
    out, n = score_symbols(seqs, net), np.array([len(s) for s in seqs])
    return [n, out, [float(x / k) if k else None for x, k in zip(out, n)]]


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Per row: ``id_col``, ``n_tokens``, ``pll`` (sum of the *symbols'* log-probabilities, natural), ``mean_logp`` (null without tokens).

    The network's part alone: words that share a symbol count alike; ``word_pseudo_likelihood`` has the words' own
    probabilities. Null and empty texts have no tokens and ``pll`` 0; repeated rows get equal scores; an empty table gives an
    empty result. Word counts stay in a Spark table, weights of each partition are summed on the executors; the driver sees
    tables of fixed size.
    """
    table, net = train(docs, text_col, rounds, id_col=id_col)
    shared = docs.sparkSession.sparkContext.broadcast((table, net))
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("pll", T.DoubleType()), T.StructField("mean_logp", T.DoubleType())]

    def make():
        table, net = shared.value
        symbols = reader(table)
        return lambda texts: score_texts(texts, symbols, net)

    return map_text(docs, text_col, [id_col], fields, make)


def word_pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
                           frequent: int = FREQUENT) -> DataFrame:
    """As ``pseudo_likelihood``, with every word's own probability: that of its symbol, times the word's count in the
    corpus over the count of its symbol. The probabilities of all words of the corpus add up to 1 at every place.

    Words of at least one in ``frequent`` tokens are at most ``frequent`` many: these go to all tasks. Each row's other words
    are kept beside its symbols as (word, times) and join the table of word counts, so that no word has more than its share of the join and
    nothing that follows the corpus reaches the driver or a broadcast. All scored words were counted; should a word be missing,
    it counts as seen once.
    """
    spark = docs.sparkSession
    words = word_counts(docs, text_col)
    counts = bucket_counts(words)
    table, total = symbol_table(counts), int(counts.sum())
    mass = np.log(np.maximum(np.bincount(table, weights=counts, minlength=SYMBOLS), 1))
    least = -(-total // frequent)
    often = {bytes(r.word): float(np.log(r.n) - mass[table[bucket(bytes(r.word))]]) for r in words.where(F.col("n") >= least).collect()}
    shared = spark.sparkContext.broadcast((table, mass, often))  # of fixed size
    encoded = encode_words(docs, id_col, text_col, shared)
    net = spark.sparkContext.broadcast(fit(in_order(encoded, counts), counts, rounds))

    small_batches(spark)
    inner = encoded.select("id", "row", "n_tokens", "share", "seq")
    schema = T.StructType([inner.schema["id"], *longs("row", "n_tokens"), T.StructField("part", T.DoubleType()), *longs("log_n")])
    arrow = to_arrow_schema(schema)

    def run(batches):
        keep_freed()
        weights = net.value
        for b in batches:
            raw = b.column(4).to_pylist()
            parts = [score_symbols([unpack_sequence(t) for t in raw[i:j]], weights) for i, j in runs(map(len, raw), TEXT_BUDGET // 4)]
            part = np.concatenate(parts) + b.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([b.column(0).cast(arrow.field("id").type), b.column(1), b.column(2), pa.array(part),
                                              pa.nulls(len(part), pa.int64())], schema=arrow)
        trim()

    # No word has more than its share of this join: frequent ones aren't in it. A word that the table lacks adds log(1).
    # A partition's words (each once in the table) are held as a hash table, which saves sorting all rows of texts.
    logs = words.where(F.col("n") < least).select("word", F.round(F.log("n") * SCALE).cast("long").alias("log_n"))
    rare = encoded.select("row", F.inline("rare")).join(logs.hint("shuffle_hash"), "word").select("row", (F.col("times") * F.col("log_n")).alias("log_n"))
    whole = inner.mapInArrow(run, schema).unionByName(rare, allowMissingColumns=True).groupBy("row").agg(
        F.first("id", ignorenulls=True).alias("id"), F.sum("n_tokens").alias("n_tokens"),
        (F.sum("part") + F.coalesce(F.sum("log_n"), F.lit(0)) / SCALE).alias("pll"))
    return whole.select(F.col("id").alias(id_col), "n_tokens", "pll", F.when(F.col("n_tokens") > 0, F.col("pll") / F.col("n_tokens")).alias("mean_logp"))


def encode_words(docs: DataFrame, id_col: str, text_col: str, shared) -> DataFrame:
    """A scratch table of the texts as symbols: ``id``, ``row``, ``n_tokens``, ``seq`` (packed), ``share`` (the words' log shares of their
    symbols, for words outside the broadcast without their counts) and ``rare`` (those words and how often each occurs)."""
    spark = docs.sparkSession
    small_batches(spark)
    inner = docs.select(column(docs, id_col).alias("id"), F.monotonically_increasing_id().alias("row"), column(docs, text_col).cast("string").alias("t"))
    words_type = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), *longs("times")]))
    schema = T.StructType([inner.schema["id"], *longs("row", "n_tokens"), T.StructField("share", T.DoubleType()),
                           T.StructField("seq", T.BinaryType()), T.StructField("rare", words_type)])
    arrow = to_arrow_schema(schema)

    def run(batches):
        keep_freed()
        table, mass, often = shared.value
        for batch in batches:
            for i, n in slices(batch.column(2), TEXT_BUDGET):
                sizes, at, words = split_words(batch.column(2).slice(i, n))
                named = as_bytes(words)
                symbols = table[np.fromiter(map(bucket, named), np.int64, len(named))]
                shares = np.fromiter(map(often.get, named, repeat(np.nan)), np.float64, len(named))
                is_rare = np.isnan(shares)
                shares[is_rare] = -mass[symbols[is_rare]]
                # (text, word) of each rare word of each text, and how often it is there
                of = np.repeat(np.arange(n), sizes)
                mine = is_rare[at]
                pairs, times = np.unique(of[mine] * len(named) + at[mine], return_counts=True)
                ends = np.searchsorted(pairs, np.arange(n + 1) * len(named))
                rare = pa.StructArray.from_arrays([words.take(pa.array(pairs % max(len(named), 1))), pa.array(times, pa.int64())],
                                                  fields=list(arrow.field("rare").type.value_type))
                packed = symbols.astype(np.uint16)[at]
                cuts = list(pairwise(np.r_[0, np.cumsum(sizes)].tolist()))
                own = shares[at]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, n).cast(arrow.field("id").type), batch.column(1).slice(i, n),
                    pa.array(sizes, pa.int64()), pa.array([float(own[a:b].sum()) for a, b in cuts], pa.float64()),
                    pa.array([packed[a:b].tobytes() for a, b in cuts], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare).cast(arrow.field("rare").type)], schema=arrow)
        trim()

    return scratch(inner.mapInArrow(run, schema), "encoded")
