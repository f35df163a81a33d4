"""Language identification by character language models with interpolated Kneser-Ney smoothing.

Each language has a model of its letters and word ends: the counts of the longest character
n-grams, and for shorter ones the number of distinct characters seen before them, each discounted
and interpolated with the next shorter order. Every order is a sorted array of 64-bit n-gram hashes
with probabilities and one of context hashes with the weights of the shorter order. For scoring the
arrays of all languages are merged by order, so one binary search gives an n-gram's probability in
every language. A text gets the language with the lowest cross-entropy (bits a character), and a
score from the cross-entropies by a temperature fitted on texts that were not counted; it is
rejected if that cross-entropy is higher, or the score lower, than such texts in all but a small share have.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import TEXT_BUDGET, column, first_rows, map_text, worker_cache

ORDER = 4
#: The models are fitted on at most so many rows with texts of at most so many characters, shared evenly by at most so
#: many languages (the most frequent ones), and hold at most so many different longest n-grams.
SAMPLE_ROWS, LONGEST, MAX_LANGUAGES, MAX_GRAMS = 6000, 20_000, 64, 1 << 20
#: One of so many sample rows isn't counted but calibrates score and rejection, and so large a share of these is rejected at most by each limit.
CALIBRATION, REJECTED = 5, 0.005
UNKNOWN = "und"
SPACE = 32


def held_out(id_col):
    """Whether a row is kept out of training: crc32 of its id as text leaves 1 when divided by 3."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def factors(order: int) -> np.ndarray:
    return np.random.default_rng(11).integers(0, 1 << 63, order, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def hashes(grams: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of character codes; the last character comes first in the sum, so a suffix's hash takes fewer terms."""
    n = grams.shape[1]
    odd = factors(max(n, 1))
    h = np.full(len(grams), n, np.uint64)
    for j in range(n):
        h += grams[:, n - 1 - j].astype(np.uint64) * odd[j]
    return mixed(h)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def characters(texts: list[bytes], letters: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram rows, text numbers): a row for each letter and each first sign after a word, in lower case, with the
    ``order`` - 1 characters before it. All signs but letters are blanks; before a text are blanks."""
    low = [str(t, "utf-8", "replace").lower() for t in texts]
    x = np.frombuffer(" ".join([*low, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    of = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])
    is_letter = letters[x]
    after = np.concatenate([[False], is_letter[:-1]])  # the blank behind each text keeps texts apart
    at = np.flatnonzero(is_letter | after)
    x, of = np.where(is_letter, x, SPACE)[at], of[at]
    place = np.arange(len(of)) - np.searchsorted(of, of)
    grams = np.empty((len(x), order), np.uint32)
    for j in range(order):
        shifted = np.concatenate([np.full(min(j, len(x)), SPACE, x.dtype), x[:len(x) - j]])
        grams[:, order - 1 - j] = np.where(place >= j, shifted, SPACE)
    # Texts without a letter have no rows: their signs follow no letter.
    return grams, of


def lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, found) of hashes in a sorted array."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return i, keys[i] == wanted


def grouped(rows: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their weights (their numbers, without)."""
    h = hashes(rows)
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    return rows[first], np.bincount(inverse, weights, len(first)).astype(np.int64)


class KneserNey:
    """One language: for each order, sorted hashes with discounted probabilities, and of contexts with the next order's weight."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: int):
        self.order = grams.shape[1]
        self.floor = 1 / alphabet
        self.seen: list[tuple] = [()] * (self.order + 1)
        self.contexts: list[tuple] = [()] * self.order
        while True:
            n = grams.shape[1]
            ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
            discount = min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones else 0.1
            context = hashes(grams[:, :-1])
            keys, inverse = np.unique(context, return_inverse=True)
            total = np.bincount(inverse, counts, len(keys))
            kinds = np.bincount(inverse, minlength=len(keys))
            h = hashes(grams)
            by = np.argsort(h)
            self.seen[n] = (h[by], ((counts - discount) / total[inverse])[by])
            self.contexts[n - 1] = (keys, discount * kinds / total)
            if n == 1:
                return
            grams, counts = grouped(grams[:, 1:])  # how many characters were seen before

    def weight(self, contexts: np.ndarray) -> np.ndarray:
        """Weight of the shorter order after each context; one after a context never seen."""
        keys, gamma = self.contexts[contexts.shape[1]]
        i, found = lookup(keys, hashes(contexts))
        return np.where(found, gamma[i], 1.0) if len(keys) else np.ones(len(contexts))

    def probability(self, grams: np.ndarray) -> np.ndarray:
        """Probability of each row's last character after the others."""
        n = grams.shape[1]
        if not n:
            return np.full(len(grams), self.floor)
        keys, p = self.seen[n]
        i, found = lookup(keys, hashes(grams))
        return np.where(found, p[i], 0.0) + self.weight(grams[:, :-1]) * self.probability(grams[:, 1:])


def merged(models: list[KneserNey], grams: list[np.ndarray], order: int) -> list[tuple]:
    """For each order from the longest: n-gram hashes and context hashes of all languages, sorted, with the logarithms
    (base 2) of every language's full probability and of its weight of the shorter order."""
    out = []
    rows, _ = grouped(np.concatenate(grams))
    for n in range(order, 0, -1):
        h = hashes(rows)
        by = np.argsort(h)
        contexts, _ = grouped(rows[:, :-1])
        c = hashes(contexts)
        to = np.argsort(c)
        out.append((h[by], np.log2(np.stack([m.probability(rows) for m in models], 1))[by].astype(np.float32),
                    c[to], np.log2(np.stack([m.weight(contexts) for m in models], 1))[to].astype(np.float32)))
        rows, _ = grouped(rows[:, 1:])
    return out


def cross_entropies(texts: list[bytes], letters: np.ndarray, tables: list[tuple], floor: float, languages: int) -> tuple[np.ndarray, np.ndarray]:
    """(characters of each text, bits a character of each text in each language)."""
    order = len(tables)
    grams, of = characters(texts, letters, order)
    odd = factors(order)
    sums = [np.full(len(grams), n, np.uint64) for n in range(order + 1)]  # of the last n characters
    before = [np.full(len(grams), n, np.uint64) for n in range(order)]  # of the n characters before the last
    for n in range(1, order + 1):
        for j in range(n):
            sums[n] += grams[:, order - 1 - j].astype(np.uint64) * odd[j]
    for n in range(1, order):
        for j in range(n):
            before[n] += grams[:, order - 2 - j].astype(np.uint64) * odd[j]
    size = np.bincount(of, minlength=len(texts))
    bits = np.zeros((len(texts), languages))
    left = np.arange(len(grams))
    for k, (keys, logp, context_keys, weights) in enumerate(tables):
        n = order - k
        i, found = lookup(keys, mixed(sums[n][left]))
        hit, i = left[found], i[found]
        for lang in range(languages):
            bits[:, lang] -= np.bincount(of[hit], logp[i, lang], len(texts))
        left = left[~found]
        i, found = lookup(context_keys, mixed(before[n - 1][left]))
        hit, i = left[found], i[found]
        for lang in range(languages):
            bits[:, lang] -= np.bincount(of[hit], weights[i, lang], len(texts))
    bits -= np.bincount(of[left], minlength=len(texts))[:, None] * np.log2(floor)
    return size, bits / np.maximum(size, 1)[:, None]


class LanguageModel:
    """Languages, merged tables, and calibration (temperature, least score, highest cross-entropy of each language)."""

    def __init__(self, languages, tables, floor, temperature=1.0, least=0.0, highest=None):
        self.languages, self.tables, self.floor = languages, tables, floor
        self.temperature, self.least = temperature, least
        self.highest = highest or [float("inf")] * len(languages)

    def plain(self) -> tuple:
        return self.languages, self.tables, self.floor, self.temperature, self.least, self.highest


def fitted(languages: list[str], grams: list[np.ndarray], counts: list[np.ndarray], order: int) -> LanguageModel:
    """The languages' models from their longest n-grams and counts."""
    alphabet = 1 + len(np.unique(np.concatenate([g[:, -1] for g in grams])))  # one more for all other signs
    models = [KneserNey(g, c, alphabet) for g, c in zip(grams, counts)]
    return LanguageModel(languages, merged(models, grams, order), 1 / alphabet)


def confidence(entropies: np.ndarray, temperature: float) -> np.ndarray:
    """Share of each language, from the differences of cross-entropy."""
    z = -temperature * (entropies - entropies.min(1, keepdims=True))
    e = np.exp(z)
    return e / e.sum(1, keepdims=True)


def calibrate(model: LanguageModel, truth: np.ndarray, entropies: np.ndarray, rejected: float = REJECTED) -> None:
    """Temperature of least log loss on texts that were not counted, and limits that at most a share of ``rejected`` of the right ones miss."""
    if not len(truth):
        return
    grid = 2.0 ** np.arange(-3, 8.5, 0.5)
    loss = [-np.log(np.maximum(confidence(entropies, t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    best = entropies.argmin(1)
    right = best == truth
    if right.any():
        model.least = float(np.quantile(confidence(entropies, model.temperature).max(1)[right], rejected, method="lower"))
    for k in range(len(model.languages)):
        mine = entropies[right & (best == k), k]
        if len(mine):
            model.highest[k] = float(np.quantile(mine, 1 - rejected, method="higher"))


def map_entropies(df: DataFrame, model: LanguageModel, keep: list[str], names: tuple[str, str], text_col: str) -> DataFrame:
    """``keep`` columns, the number of characters and the cross-entropies of each whole text."""
    # Plain arrays of bounded size: MAX_GRAMS longest n-grams of at most MAX_LANGUAGES languages.
    shared = df.sparkSession.sparkContext.broadcast((model.tables, model.floor, len(model.languages)))

    def make():
        letters = worker_cache(("letters",), letter_table)
        tables, floor, languages = shared.value

        def of(texts: list[bytes]):
            size, bits = cross_entropies(texts, letters, tables, floor, languages)
            return [size.tolist(), bits.tolist()]

        return of

    fields = [T.StructField(names[0], T.LongType()), T.StructField(names[1], T.ArrayType(T.DoubleType()))]
    return map_text(df, text_col, keep, fields, make, budget=max(1 << 16, TEXT_BUDGET // max(1, len(model.languages) // 8)))


def gram_counts(sample: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n): the longest n-grams (as strings) of ``sample(lang, t)``, counted by tasks and then by Spark."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.BinaryType()), T.StructField("n", T.LongType())])

    def run(batches):
        letters = worker_cache(("letters",), letter_table)
        for b in batches:
            texts = b.column("t").cast(pa.binary()).to_pylist()
            langs = b.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                grams, _ = characters([t for t, x in zip(texts, langs) if x == lang], letters, order)
                rows, n = grouped(grams)
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(rows)), pa.array([r.tobytes() for r in rows.astype("<u4")], pa.binary()), pa.array(n)],
                                                 names=schema.names)

    return sample.select("lang", "t").mapInArrow(run, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER, sample_rows: int = SAMPLE_ROWS,
          longest: int = LONGEST, max_languages: int = MAX_LANGUAGES, max_grams: int = MAX_GRAMS) -> LanguageModel:
    """Models of the languages in ``lang_col``, from rows that are not held out and have an id, a language and a text.

    The sample takes, for each of the ``max_languages`` most frequent languages, as many rows with the smallest hashes
    of their ids as each can have; rows of one id and language count once. A language without a letter in its sample isn't learned.
    """
    spark = docs.sparkSession
    rows = docs.select(column(docs, id_col).alias("id"), column(docs, lang_col).cast("string").alias("lang"), column(docs, text_col).cast("string").alias("t"))
    able = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    common = able.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    languages = sorted(r.lang for r in common)
    if not languages:
        return LanguageModel([], [], 1.0)
    each = max(1, sample_rows // len(languages))
    hash_ = F.xxhash64("id", F.lit(7))
    fit_for = able.where(F.col("lang").isin(languages) & F.length("t").between(1, longest)).select("id", "lang", hash_.alias("h"))
    ids = first_rows(fit_for, "lang", [F.col("h"), F.col("id")], each).select("id", "lang").distinct()
    chosen = rows.join(F.broadcast(ids), ["id", "lang"]).where(F.length("t").between(1, longest))  # at most sample_rows ids are broadcast
    sample = chosen.groupBy("id", "lang").agg(F.min("t").alias("t"))
    for_limits = F.pmod(F.xxhash64("id", F.lit(8)), F.lit(CALIBRATION)) == 0
    top = gram_counts(sample.where(~for_limits), order).orderBy(F.desc("n"), "lang", "gram").limit(max_grams).toArrow()
    names_, grams, n = top.column("lang").to_pylist(), top.column("gram").to_pylist(), top.column("n").to_numpy()
    per_lang, counts, learned = [], [], []
    number = np.array([languages.index(x) for x in names_], np.int64)
    table = np.frombuffer(b"".join(grams), "<u4").reshape(-1, order)
    for k, lang in enumerate(languages):
        mine = np.flatnonzero(number == k)
        if len(mine):
            per_lang.append(table[mine])
            counts.append(n[mine])
            learned.append(lang)
    if not learned:
        return LanguageModel([], [], 1.0)
    model = fitted(learned, per_lang, counts, order)
    checked = map_entropies(sample.where(for_limits & F.col("lang").isin(learned)), model, ["lang"], ("n", "bits"), "t").where("n > 0").collect()
    if checked:
        calibrate(model, np.array([learned.index(r.lang) for r in checked]), np.array([r.bits for r in checked]))
    return model


def identify(docs: DataFrame, model: LanguageModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``lang_pred``, ``score``, ``rejected``, ``bits`` (the lowest cross-entropy).

    A null text, one without a letter, and every text under a model without languages, is ``und`` with score 0, rejected,
    null bits. Equal cross-entropies go to the language first by name.
    """
    n, bits = "n" + "_" * (1 + max(map(len, keep), default=0)), "bits" + "_" * (1 + max(map(len, keep), default=0))
    if not model.languages:
        found = docs.select(*[column(docs, c) for c in keep])
        return found.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("bits"))
    found = map_entropies(docs, model, keep, (n, bits), text_col)
    some, low = F.col(n) > 0, F.array_min(bits)
    best = F.array_position(bits, low).cast("int")
    share = 1 / F.aggregate(bits, F.lit(0.0), lambda a, x: a + F.exp(-model.temperature * (x - low)))
    limits = F.array(*[F.lit(x) for x in model.highest])
    return found.select(*[column(found, c) for c in keep],
                        F.when(some, F.element_at(F.array(*[F.lit(x) for x in model.languages]), best)).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
                        F.when(some, share).otherwise(F.lit(0.0)).alias("score"),
                        F.when(some, (share < model.least) | (low > F.element_at(limits, best))).otherwise(F.lit(True)).alias("rejected"),
                        F.when(some, low).alias("bits"))


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """Per row: ``id_col``, ``held_out``, ``lang_pred``, ``score``, ``rejected``, ``bits``.

    The models are trained on the rows that are not held out (a null id isn't held out, nor trained on); repeated rows each get
    their result, an empty table gives no rows, and texts are scored whole, whatever their length.
    """
    model = train(docs, id_col, text_col, lang_col, **options)
    out = identify(docs, model, [id_col], text_col)
    return out.select(column(out, id_col), held_out(column(out, id_col)).alias("held_out"), "lang_pred", "score", "rejected", "bits")
