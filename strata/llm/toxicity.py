"""Toxicity classifier with counterfactual regularisation.

A logistic model over the presence of words and word beginnings. Labelled
texts that name a group of people are also read with the group swapped for
another; the loss adds the squared change of the score between the two, so the
model can't lean on the mention of a group itself.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import column, longs, map_text

#: Most labelled rows that the model is fitted on (those with the smallest hashes of their ids).
SAMPLE_ROWS = 12_000
#: Most features of the model, and the least evidence (G statistic) that a feature needs.
MAX_FEATURES, LEAST_G = 4096, 30.0
#: Lengths of the word beginnings that are features beside whole words.
PREFIXES = (3, 4, 5)
#: Groups whose neutral mention must not move the score; a term is swapped for the next one of its row.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("immigrant", "native"), ("immigrants", "natives"), ("disabled", "able"), ("old", "young"),
)
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> set[bytes]:
    """The distinct words of a text, in lower case; all ASCII but letters separates."""
    low = text if text.isascii() else text.decode("utf-8", "replace").lower().encode()
    return set(low.translate(LETTERS).split())


def features_of(word: bytes) -> list[str]:
    w = word.decode("utf-8", "replace")
    return ["=" + w, *(w[:n] for n in PREFIXES if len(w) >= n)]


def swaps(terms=IDENTITY_TERMS) -> dict[bytes, bytes]:
    return {a.encode(): b.encode() for row in terms for a, b in zip(row, row[1:] + row[:1])}


@dataclass
class Model:
    features: dict[str, int]
    weights: np.ndarray
    bias: float

    def scorer(self, cache_words: int = 300_000):
        known: dict[bytes, tuple] = {}
        get, weights, bias = self.features.get, self.weights, self.bias

        def score(texts: list[bytes]) -> list[float]:
            out = []
            if len(known) > cache_words:
                known.clear()
            for text in texts:
                words = words_of(text)
                for w in words.difference(known):
                    known[w] = tuple(i for i in map(get, features_of(w)) if i is not None)
                ids = sorted(set().union(*filter(None, map(known.__getitem__, words))))
                out.append(float(1 / (1 + np.exp(-min(50, max(-50, bias + weights[ids].sum()))))))
            return out

        return score


def fit(rows: list[tuple[int, list[int], list[int]]], n_features: int, penalty: float = 1.0, ridge: float = 1e-3, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias from (label, features, features of the swapped text) by gradient steps (Adam).

    Loss: mean log loss + ``penalty`` * mean squared change of the logit under the swap + ``ridge`` * |w|^2.
    """
    n = len(rows)
    if not n:
        return np.zeros(n_features), 0.0
    y = np.array([r[0] for r in rows], float)
    of = np.repeat(np.arange(n), [len(r[1]) for r in rows])
    at = np.fromiter((i for r in rows for i in r[1]), np.int64)
    pairs = [(k, {*r[1]}, {*r[2]}) for k, r in enumerate(rows) if {*r[1]} != {*r[2]}]
    c_of = np.array([k for k, (_, a, b) in enumerate(pairs) for _ in a ^ b], np.int64)
    c_at = np.array([i for _, a, b in pairs for i in sorted(a ^ b)], np.int64)
    c_sign = np.array([1.0 if i in a else -1.0 for _, a, b in pairs for i in sorted(a ^ b)])
    rate = min(max(y.mean(), 1 / (n + 2)), 1 - 1 / (n + 2))
    p = np.zeros(n_features + 1)  # the last is the bias
    p[-1] = np.log(rate / (1 - rate))
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        z = np.bincount(of, weights=p[at], minlength=n) + p[-1]
        miss = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / n
        g = np.bincount(at, weights=miss[of], minlength=n_features + 1) + 2 * ridge * p
        g[-1] = miss.sum()
        if pairs:
            change = np.bincount(c_of, weights=c_sign * p[c_at], minlength=len(pairs))
            g += np.bincount(c_at, weights=2 * penalty / len(pairs) * c_sign * change[c_of], minlength=n_features + 1)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        p -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return p[:-1], float(p[-1])


def held_out(id_col):
    """Whether a row is kept out of training: crc32 of its id as text is a multiple of 5."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_rows: int = SAMPLE_ROWS, max_features: int = MAX_FEATURES, least_g: float = LEAST_G, terms=IDENTITY_TERMS) -> Model:
    """The model fitted on at most ``sample_rows`` labelled rows, none of them held out.

    Null labels and ids are left out; an id labelled twice counts once, as toxic if any row says so. Words are
    counted on the executors and only what passes the feature limits, and the sample's feature
    numbers, come to the driver. Without both labels the model scores every text with the share of label 1.
    """
    spark = docs.sparkSession
    label = (labels.select(column(labels, id_col).alias("id"), column(labels, label_col).cast("int").alias("y"))
             .where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    texts = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).alias("t"))
    sample = texts.join(F.broadcast(label), "id")  # at most sample_rows rows are broadcast
    counted = T.ArrayType(T.StructType([T.StructField("f", T.StringType()), T.StructField("n", T.LongType())]))

    def count():
        def of(batch: list[bytes]):
            c: Counter = Counter()
            for text in batch:
                c.update({f for w in words_of(text) for f in features_of(w)})
            return [[[{"f": f, "n": n} for f, n in c.items()]] + [[]] * (len(batch) - 1)]
        return of

    per_label = [map_text(sample.where(cond), "t", [], [T.StructField("c", counted)], count).select(F.inline("c")).select("f", F.lit(k).alias("y"), "n")
                 for k, cond in ((0, F.col("y") == 0), (1, F.col("y") != 0))]
    sizes = {bool(r.y): r.n for r in sample.groupBy((F.col("y") != 0).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(False, 0), sizes.get(True, 0)
    if not n0 or not n1:
        return Model({}, np.zeros(0), 0.0 if n0 + n1 == 0 else 20.0 if n1 else -20.0)
    table = (per_label[0].unionAll(per_label[1]).groupBy("f")
             .agg(F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).cast("double").alias("a"), F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).cast("double").alias("b"))
             .where(F.col("a") + F.col("b") >= 5))
    a, b, n = F.col("a"), F.col("b"), float(n0 + n1)
    term = lambda x, row, col: F.when(x > 0, x * F.log(x * n / (row * col))).otherwise(0.0)
    g = 2 * (term(a, a + b, F.lit(float(n0))) + term(b, a + b, F.lit(float(n1)))
             + term(n0 - a, n - a - b, F.lit(float(n0))) + term(n1 - b, n - a - b, F.lit(float(n1))))
    chosen = table.withColumn("g", g).where(F.col("g") >= least_g).orderBy(F.desc("g"), "f").limit(max_features).select("f").collect()
    features = {r.f: i for i, r in enumerate(chosen)}
    if not features:
        return Model({}, np.zeros(0), float(np.log(n1 / n0)))
    swap = swaps(terms)
    numbers = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("x", "swapped")]

    def number():
        def ids(words):
            return sorted({i for w in words for i in map(features.get, features_of(w)) if i is not None})

        def of(batch: list[bytes]):
            sets = [words_of(t) for t in batch]
            return [[ids(s) for s in sets], [ids({swap.get(w, w) for w in s}) for s in sets]]
        return of

    rows = sorted((int(r.y != 0), list(r.x), list(r.swapped)) for r in map_text(sample, "t", ["y"], numbers, number).collect())
    return Model(features, *fit(rows, len(features)))


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", score_name: str = "score") -> DataFrame:
    """``keep`` columns and the score (0 to 1) of each whole text; null and empty texts get the score of no words."""
    # Plain values: a broadcast is pickled by reference, and the executors may have no copy of this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.bias))  # at most MAX_FEATURES features

    def make():
        of = Model(*shared.value).scorer()
        return lambda texts: [of(texts)]

    return map_text(docs, text_col, keep, [T.StructField(score_name, T.DoubleType())], make)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: ``id_col``, ``held_out``, ``score``, ``predicted`` (1 if the score is at least 0.5)."""
    model = train(docs, labels, id_col, text_col, **options)
    out = score(docs, model, [id_col], text_col)
    return out.select(id_col, held_out(column(out, id_col)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
