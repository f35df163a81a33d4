"""Benchmark decontamination with an FM-index over each training shard.

Words outside the benchmark's vocabulary can't be part of a match, so a shard
(some MB of texts) is reduced to its stretches of benchmark words that are long
enough for a window, without loss. The FM-index of what remains is a
Burrows-Wheeler transform in a wavelet tree (one bit vector for each bit of a
word's number) with suffix positions sampled every few places. All benchmark
windows are searched backwards at once; their occurrences are located by
stepping to the next sample, and overlapping spans are merged.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.llm.common import TEXT_BUDGET, column, runs, scratch, small_batches, trim

#: Bytes other than these separate words; applied after A-Z are lower-cased.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Everything that separates words to a space, A-Z to a-z.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Bytes of benchmark windows that come to the driver and are searched at a time.
PART_BYTES = 16 << 20
SAMPLE = 8


def fold_words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class FmIndex:
    """Counts and positions of patterns in a sequence of symbols 1..top (0 ends it)."""

    def __init__(self, symbols: np.ndarray, top: int):
        text = np.append(symbols, 0).astype(np.int64)
        n = len(text)
        rank = text.copy()
        order, step = np.argsort(rank, kind="stable"), 1
        while True:  # prefix doubling; the end symbol makes suffixes distinct in the end
            key = rank * (n + top + 2)
            key[:n - step] += rank[step:] + 1 if step < n else 0
            order = np.argsort(key, kind="stable")
            new = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
            rank[order] = new
            step *= 2
            if new[-1] == n - 1 or step >= n:
                break
        self.n, bwt = n, text[order - 1]
        self.first = np.searchsorted(np.sort(text), np.arange(top + 2))  # rows that start with a smaller symbol
        self.bits = max(1, int(top).bit_length())
        self.planes, seq = [], bwt
        for b in reversed(range(self.bits)):  # wavelet tree, level by level: stable split by the bit
            bit = (seq >> b) & 1
            ones = np.concatenate([[0], np.cumsum(bit)])
            self.planes.append((ones, n - int(ones[-1])))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        self.bwt_at = bwt
        self.marked = np.concatenate([[0], np.cumsum(order % SAMPLE == 0)])
        self.samples = order[order % SAMPLE == 0]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in the transform before ``row``."""
        lo, hi = np.zeros_like(row), row
        for (ones, zeros), b in zip(self.planes, reversed(range(self.bits))):
            one = ((symbol >> b) & 1).astype(bool)
            lo = np.where(one, zeros + ones[lo], lo - ones[lo])
            hi = np.where(one, zeros + ones[hi], hi - ones[hi])
        return hi - lo

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals [lo, hi) of the suffixes that start with each pattern (rows of ``patterns``, left-aligned)."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for back in range(patterns.shape[1]):
            on = np.flatnonzero((back < lengths) & (lo < hi))
            if not len(on):
                break
            c = patterns[on, lengths[on] - 1 - back]
            lo[on], hi[on] = self.first[c] + self.rank(c, lo[on]), self.first[c] + self.rank(c, hi[on])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of suffix rows, stepping left to the next sampled one."""
        rows, out, steps = rows.copy(), np.full(len(rows), -1, np.int64), 0
        todo = np.arange(len(rows))
        while len(todo):
            r = rows[todo]
            hit = self.marked[r + 1] > self.marked[r]
            out[todo[hit]] = self.samples[self.marked[r[hit]]] + steps
            todo, r = todo[~hit], r[~hit]
            c = self.bwt_at[r]
            rows[todo] = self.first[c] + self.rank(c, r)
            steps += 1
        return out


def window_rows(benchmark: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """(item, window): the distinct windows of each item, words joined by blanks; built where the items are."""
    schema = T.StructType([T.StructField("item", T.StringType()), T.StructField("window", T.BinaryType())])

    def run(batches):
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                words = fold_words(text or b"")
                starts = range(max(1, len(words) - width + 1)) if words else ()
                for some, until in runs([1] * len(starts), 10_000):
                    rows = {b" ".join(words[i:i + width]) for i in starts[some:until]}
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(rows), pa.string()), pa.array(list(rows), pa.binary())], names=schema.names)

    items = benchmark.select(column(benchmark, item_col).cast("string").alias("item"), column(benchmark, text_col).cast("string").alias("text"))
    return items.mapInArrow(run, schema).distinct()


def windows_of(found: list[tuple], width: int):
    """(vocabulary, patterns, lengths, item of each pattern, item ids, shortest) of window rows."""
    vocabulary: dict[bytes, int] = {}
    names = sorted({item or "" for item, _ in found})
    number = {name: i for i, name in enumerate(names)}
    patterns, lengths = np.zeros((len(found), width), np.int64), np.zeros(len(found), np.int64)
    for i, (_, window) in enumerate(found):
        words = bytes(window).split(b" ")
        lengths[i] = len(words)
        patterns[i, :len(words)] = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
    of = np.array([number[item or ""] for item, _ in found], np.int64)
    return vocabulary, patterns, lengths, of, names, int(lengths.min()) if found else width


def searcher(prepared):
    """A function from texts to (words, spans, items): the words' number, merged [start, end) word spans that
    match, and the names of the items with a window there."""
    vocabulary, patterns, lengths, of, names, shortest = prepared

    def find(texts: list[bytes]):
        n_words, parts, doc, start = [], [], [], []
        spans: list[list] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        get = vocabulary.get
        for d, text in enumerate(texts):
            words = fold_words(text)
            n_words.append(len(words))
            if len(words) < shortest or not names:
                continue
            ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
            edge = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]])))
            for a, b in zip(edge[::2], edge[1::2]):  # stretches of benchmark words
                if b - a >= shortest:
                    parts += [ids[a:b], [len(vocabulary) + 1]]  # a symbol that no pattern has
                    doc.append(d)
                    start.append(a)
        if parts:
            text = np.concatenate(parts)
            here = np.zeros(len(vocabulary) + 2, bool)
            here[text] = here[0] = True  # 0 fills windows up
            may = np.flatnonzero(here[patterns].all(1))  # windows whose words all occur in this shard
            if not len(may):
                return n_words, spans, [[] for _ in texts]
            index = FmIndex(text, len(vocabulary) + 1)
            at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])[:-1:2]
            lo, hi = np.zeros(len(patterns), np.int64), np.zeros(len(patterns), np.int64)
            lo[may], hi[may] = index.search(patterns[may], lengths[may])
            hits = np.flatnonzero(hi > lo)
            for some, until in runs((hi - lo)[hits].tolist(), 1 << 20):
                h = hits[some:until]
                which = np.repeat(h, (hi - lo)[h])
                rows = np.concatenate([np.arange(lo[k], hi[k]) for k in h])
                pos = index.locate(rows)
                part = np.searchsorted(at, pos, side="right") - 1
                for k, p, s in zip(which.tolist(), pos.tolist(), part.tolist()):
                    first = int(start[s]) + p - int(at[s])
                    spans[doc[s]].append((first, first + int(lengths[k])))
                    items[doc[s]].add(of[k])
        return n_words, [merge(s) for s in spans], [[names[i] for i in sorted(x)] for x in items]

    return find


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps or gaps of 0 between them."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` with a space in place of the bytes from the first to the last word of each span."""
    if not spans:
        return text
    folded = text.translate(FOLD)
    at = [m.span() for m in WORD.finditer(folded)]
    out, end = [], 0
    for a, b in spans:
        out += [text[end:at[a][0]], b" "]
        end = at[b - 1][1]
    return b"".join([*out, text[end:]])


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))


def benchmark_parts(benchmark: DataFrame, item_col: str, text_col: str, width: int, part_bytes: int) -> list[DataFrame]:
    """The benchmark's windows in parts of about ``part_bytes`` (dealt by the windows' hashes), written once by Spark."""
    rows = scratch(window_rows(benchmark, item_col, text_col, width), "windows")
    total = rows.agg(F.sum(F.length("window") + F.lit(32))).first()[0] or 0
    n = -(-total // part_bytes) or 1
    return [rows if n == 1 else rows.where(F.pmod(F.xxhash64("window", "item"), F.lit(n)) == i) for i in range(n)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", part_bytes: int = PART_BYTES, cut: bool = False,
                       keep: list[str] | None = None, names: tuple[str, ...] = ("n_words", "spans", "items", "cleaned")) -> DataFrame:
    """Per row: ``keep`` columns (``id_col`` if not given), ``n_words``, ``spans`` (merged [start, stop) word spans that match) and ``items`` (sorted
    ids, as strings, of the items with a window in the text); with ``cut`` also ``cleaned``, the text without the spans (``names`` renames these).

    A window is ``width`` consecutive words of an item (all its words, if fewer). Null texts have no
    words; items without words match nothing, an item with a null id counts as the id ""; repeated rows each get a row; items with
    the same id are one. Documents aren't shuffled. Spark builds the windows; they come to the driver and
    go to the tasks one part of ``part_bytes`` at a time. With several parts the documents are read once for each, the
    spans so far are written beside them, and a part's copies are dropped before the next one comes.
    """
    spark, keep = docs.sparkSession, keep or [id_col]
    small_batches(spark)
    state = docs.select(*[column(docs, c).alias(f"k{i}") for i, c in enumerate(keep)], column(docs, text_col).cast("string").alias("t"),
                        F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    parts = benchmark_parts(benchmark, item_col, item_text_col, width, part_bytes)
    for i, part in enumerate(parts):
        last = i == len(parts) - 1
        shared = spark.sparkContext.broadcast(windows_of([tuple(r) for r in part.collect()], width))
        state = search_part(state, shared, cut and last, keep_text=not last)
        if not last:
            state = scratch(state.drop("n_words"), "spans")
            shared.destroy()
    made = ["n_words", "spans", "items", "cleaned"][:4 if cut else 3]
    return state.select(*[f"k{i}" for i in range(len(keep))], *made).toDF(*keep, *names[:len(made)])


def search_part(state: DataFrame, shared: Broadcast, cut: bool, keep_text: bool) -> DataFrame:
    """One part of the benchmark over the texts ``t`` of ``state``: what it finds joins ``spans`` and ``items``."""
    kept = [f for f in state.schema.fields if f.name.startswith("k")] + [state.schema["t"]] * keep_text
    made = [T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS), T.StructField("items", T.ArrayType(T.StringType()))]
    schema = T.StructType([*kept, *made, *[T.StructField("cleaned", T.StringType())] * cut])
    arrow = to_arrow_schema(schema)

    def run(batches):
        find = searcher(shared.value)
        for batch in batches:
            texts = [t or b"" for t in batch.column("t").cast(pa.binary()).to_pylist()]
            before, named = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for a, b in runs(map(len, texts), TEXT_BUDGET):
                n_words, spans, items = find(texts[a:b])
                spans = [merge(s + [(x["start"], x["stop"]) for x in old]) for s, old in zip(spans, before[a:b])]
                columns = [n_words, [[{"start": x, "stop": y} for x, y in s] for s in spans], [sorted({*i, *old}) for i, old in zip(items, named[a:b])]]
                if cut:
                    columns.append([cut_words(t, s).decode("utf-8", "replace") for t, s in zip(texts[a:b], spans)])
                new = [pa.array(c, type=f.type, from_pandas=False) for c, f in zip(columns, list(arrow)[len(kept):])]
                yield pa.RecordBatch.from_arrays([batch.column(f.name).slice(a, b - a).cast(arrow.field(f.name).type) for f in kept] + new, schema=arrow)
        del find
        trim()

    return state.mapInArrow(run, schema)
