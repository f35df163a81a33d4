"""Phrase collocations by marginalising the longest windows.

Every word starts one window: itself and the words that follow it in its piece, as lead columns,
padded at the piece's end. Only these longest windows are counted. The counts of all shorter
phrases are sums over the columns cut off, which a Spark ROLLUP over the window's leading columns
gives; no shorter phrase is exploded or counted by itself.

Tasks count windows in bounded blocks before the shuffle and send them by first word, the other
words packed. So the count of a window's prefix is known in one place, and prefixes below the least
count are merged before the ROLLUP. First words with a great share of the text are dealt by their
second word too, and such pairs by all words (which these are is found in every 64th document; it
decides on the balance only, never on a count).
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import TEXT_BUDGET, column, first_rows, runs, scratch, small_batches, trim

WORDS, LEAST, SHARE, TOP = 3, 10, 50, 2000
#: Words whose windows are counted in one block of a task: with one more part of a text, the numbers of its distinct words stay below 2^21.
BLOCK = 1_400_000
#: A word or pair with one of so many words of its language's sample is hot; its windows go to this many places.
HOT, SPREAD, SAMPLE = 2000, 64, 64
#: Copies of a phrase's count, over which the lookups of its phrases are dealt.
SALTS = 4
CUT = 0xFF  # no byte of UTF-8 text
PIECES = bytes(c + 32 if 65 <= c <= 90 else CUT if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
BLANK = re.compile(b"[\xff\x20\x09]")


def parts_of(text: bytes, budget: int):
    """The bytes of a translated text in parts of about ``budget``, cut between words."""
    start = 0
    while len(text) - start > budget:
        blank = BLANK.search(text, start + budget)
        stop = blank.start() if blank else len(text)
        yield text[start:stop]
        start = stop
    yield text[start:]


BLOCK_COLUMNS = ["lang", "place", "w1", "others", "n"]


class WindowCounter:
    """Counts windows of texts block by block: ``add`` words, and take the ``counts`` when it is ``full``."""

    def __init__(self, width: int, hot: dict[str, list], block: int = BLOCK):
        self.width, self.block, self.hot = width, block, hot
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {bytes([CUT]): 0}
        self.seen: dict[str, list[np.ndarray]] = {}
        self.size = 0

    @property
    def full(self) -> bool:
        return self.size >= self.block

    def add(self, lang: str, words: list[bytes]) -> None:
        ids = self.ids
        found = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
        self.seen.setdefault(lang, []).append(found)
        self.size += len(found)

    def counts(self, unfinished: str | None = None) -> list[pa.RecordBatch]:
        """The windows so far, each once, a row for each first word and place (``window_blocks``). Of the language in the
        middle of a text the last words are kept for the next block: their windows aren't complete."""
        words, out, tail = list(self.ids), [], []
        vocabulary = pa.array([b"", *words[1:]], pa.binary()).cast(pa.string(), safe=False)
        spread = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
        for lang, arrays in self.seen.items():
            a = np.concatenate(arrays)
            if lang == unfinished:
                tail = [words[i] for i in a[max(0, len(a) - self.width + 1):]]
                starts = max(0, len(a) - self.width + 1)
            else:
                starts = len(a)
            out += self.blocks(lang, np.concatenate([a, np.zeros(self.width, np.int64)]), starts, vocabulary, spread)
        self.clear()
        if tail:
            self.add(unfinished, tail)
        return out

    def blocks(self, lang: str, a: np.ndarray, starts: int, vocabulary: pa.Array, spread: np.ndarray) -> list[pa.RecordBatch]:
        cols = [a[:starts]]
        for j in range(1, self.width):
            cols.append(np.where(cols[-1] == 0, 0, a[j:starts + j]))
        at = np.flatnonzero(cols[0])
        if not len(at):
            return []
        code, used = np.zeros(len(at), np.int64), 0
        for col in cols:
            if used == 3:  # 63 bits are full: the windows so far get numbers of their own
                code, used = np.unique(code, return_inverse=True)[1], 1
            code, used = (code << 21) | col[at], used + 1
        _, first, n = np.unique(code, return_index=True, return_counts=True)
        w = [col[at[first]] for col in cols]
        place = np.full(len(n), -1, np.int64)
        for size in range(1, min(2, self.width - 1) + 1):
            wanted = [[self.ids.get(x) for x in prefix] for prefix in self.hot.get(lang, ()) if len(prefix) == size]
            wanted = np.array([i[0] if size == 1 else i[0] << 21 | i[1] for i in wanted if None not in i], np.int64)
            hot = np.isin(w[0] if size == 1 else w[0] << 21 | w[1], wanted)
            mix = spread[w[1]][hot] if size == 1 else sum((spread[x] * (j + 1) for j, x in enumerate(w[1:])), np.zeros(len(n), np.int64))[hot]
            place[hot] = mix % SPREAD + SPREAD * (size - 1)
        order = np.lexsort((place, w[0]))
        w, place, n = [x[order] for x in w], place[order], n[order]
        start = np.flatnonzero(np.concatenate([[True], (w[0][1:] != w[0][:-1]) | (place[1:] != place[:-1])]))
        offsets = pa.array(np.concatenate([start, [len(n)]]), pa.int32())
        packed = [pc.binary_join(pa.ListArray.from_arrays(offsets, vocabulary.take(pa.array(x))), " ") for x in w[1:]]
        whole = pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(start)), pa.array(place[start]), vocabulary.take(pa.array(w[0][start])),
                                            pc.binary_join_element_wise(*packed, "\n"), pa.ListArray.from_arrays(offsets, pa.array(n, pa.int64()))], names=BLOCK_COLUMNS)
        return [whole.slice(i, 20_000) for i in range(0, whole.num_rows, 20_000)]


def names(width: int) -> list[str]:
    return [f"w{i}" for i in range(1, width + 1)]


def window_blocks(docs: DataFrame, width: int, hot: dict[str, list], block: int = BLOCK) -> DataFrame:
    """(lang, place, w1, others, n) of ``docs(lang, t)``: for each first word and place in a block of a task's texts
    a line with the second words of its windows, one with the third words (a blank behind each but the last; empty:
    there is none), and so on, and the windows' numbers. The lines stay one column, so that all readers share a shuffle."""
    small_batches(docs.sparkSession)
    kinds = [T.StringType(), T.LongType(), T.StringType(), T.StringType(), T.ArrayType(T.LongType())]
    schema = T.StructType([T.StructField(c, k) for c, k in zip(BLOCK_COLUMNS, kinds)])

    def run(batches):
        counter, cut = WindowCounter(width, hot, block), bytes([CUT])
        for batch in batches:
            of: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("t").cast(pa.binary()).to_pylist()):
                if text:
                    of.setdefault(lang, []).append(text)
            for lang, texts in of.items():
                for i, j in runs(map(len, texts), TEXT_BUDGET):
                    joined = cut.join([*texts[i:j], b""]).translate(PIECES)
                    for part in parts_of(joined, TEXT_BUDGET):
                        if counter.full:
                            yield from counter.counts(lang)
                        counter.add(lang, part.replace(cut, b" \xff ").split())
        yield from counter.counts()
        del counter
        trim()

    return docs.select("lang", "t").mapInArrow(run, schema)


def unpacked(blocks: DataFrame, columns: list[str]) -> DataFrame:
    """(lang, place, w1.., n): a row for each window of each block with its leading ``columns``; it stays in its partition."""
    lines = blocks.withColumn("others", F.split("others", "\n"))
    lines = lines.withColumns({c: F.split(F.get("others", F.lit(i)), " ") for i, c in enumerate(columns[1:])})
    return lines.select("lang", "place", "w1", F.inline(F.arrays_zip(*columns[1:], "n")))


def hot_prefixes(docs: DataFrame) -> dict[str, list]:
    """First words and pairs with at least one of ``HOT`` words of their language in every ``SAMPLE``-th document (so at most ``HOT`` of each a language)."""
    some = docs.where(F.pmod(F.xxhash64("t"), F.lit(SAMPLE)) == 0)
    counted = unpacked(window_blocks(some, 2, {}), names(2)).rollup("lang", "w1", "w2").agg(F.sum("n").alias("n"), F.grouping_id().alias("g"))
    counted = scratch(counted, "prefixes")
    total = counted.where("g = 3").select("lang", F.col("n").alias("all"))
    rows = counted.where("g < 3").join(total, "lang").where((F.col("n") * HOT >= F.col("all")) & (F.col("n") >= HOT)).collect()
    out: dict[str, list] = {}
    for r in rows:
        if r.w2 != "":
            out.setdefault(r.lang, []).append(tuple(x.encode() for x in (r.w1, r.w2) if x is not None))
    return out


def phrase_counts(docs: DataFrame, width: int = WORDS, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """(lang, m, phrase, f) of all phrases of up to ``width`` words that occur at least ``least`` times in ``docs(lang, t)``;
    the row with m = 0 is the number of words of its language."""
    if width < 2:
        raise ValueError("a phrase has two words at least")
    cols = names(width)
    keys, last = cols[:-1], cols[-1]
    dealt = window_blocks(docs, width, hot_prefixes(docs), block).repartition("lang", "w1", "place")
    windows = unpacked(dealt, cols).where(F.col(last) != "").groupBy("lang", "place", *cols).agg(F.sum("n").alias("n"))
    top = windows.where(F.col("n") >= least).select("lang", F.lit(width).alias("m"), F.concat_ws(" ", *cols).alias("phrase"), F.col("n").alias("f"))
    # A prefix that is in one place has its whole count there: below the least count it is cut to a shorter one at once.
    prefixes = unpacked(dealt, keys).groupBy("lang", "place", *keys).agg(F.sum("n").alias("n"))
    if width > 2:
        prefixes = prefixes.withColumn(keys[-1], F.when((F.col("place") < SPREAD) & (F.col("n") < least), "").otherwise(F.col(keys[-1])))
    rolled = prefixes.rollup("lang", *keys).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    # grouping_id of the rows summed over all but the language and the first m words: a one for each other key
    lengths = F.coalesce(*[F.when(F.col("g") == (1 << (width - 1 - m)) - 1, F.lit(m)) for m in range(width)])
    shorter = rolled.where(F.col("lang").isNotNull()).withColumn("m", lengths).where(F.col("m").isNotNull())
    ends = F.coalesce(*[F.when(F.col("m") == m, F.col(keys[m - 1]) != "") for m in range(1, width)], F.lit(True))
    shorter = shorter.where(ends & ((F.col("m") == 0) | (F.col("f") >= least)))
    return top.unionAll(shorter.select("lang", "m", F.concat_ws(" ", *keys).alias("phrase"), "f"))


def looked_up(rows: DataFrame, counts: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the count of the phrase in ``key``; a phrase that many rows ask for is asked in ``SALTS`` places."""
    salted = counts.select("lang", F.col("phrase").alias(key), F.col("f").alias(name), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    asked = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    return asked.join(salted, ["lang", key, "salt"]).drop("salt")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", width: int = WORDS, least: int = LEAST,
                 share: int = SHARE, top: int = TOP) -> DataFrame:
    """Per language the first ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z) and cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces, these at blanks and tabs into words.
    A candidate has 2 to ``width`` words and a >= ``least`` occurrences. Cut after its first words it has l
    occurrences of the first part and r of the rest, and floor(10^6 a a / (l r)) as score; the cut with the lowest
    score counts (ties: the earliest). Candidates inside a longer one that occurs at least ``share`` percent as often are
    dropped. Order: score, a (both descending), phrase by its bytes. A null language is ``und``; null and empty
    texts have no words; repeated rows count each; a table without words gives no rows.
    """
    spark = docs.sparkSession
    inner = docs.select(F.coalesce(column(docs, lang_col).cast("string"), F.lit("und")).alias("lang"), column(docs, text_col).cast("string").alias("t"))
    counts = scratch(phrase_counts(inner, width, least), "phrases")
    known = counts.where("m > 0")
    found = known.where("m > 1").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))
    cuts = found.select("lang", "phrase", "a", "m", "w", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.col("m") - F.col("k")), " ").alias("rest"))
    cuts = looked_up(looked_up(cuts, known, "first", "l"), known, "rest", "r")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("square", wide("a") * wide("a")).withColumn("product", wide("l") * wide("r"))
    cuts = cuts.withColumn("score", F.expr("(square * 1000000BD) div product"))
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("c")).select("lang", "phrase", "c.a", "c.l", "c.r", "c.score")
    inside = found.where("m > 2").select("lang", F.col("a").alias("longer"), "w", "m", F.explode(F.sequence(F.lit(2), F.col("m") - 1)).alias("size"))
    inside = inside.select("lang", "longer", F.explode(F.transform(F.sequence(F.lit(1), F.col("m") - F.col("size") + 1), lambda i: F.array_join(F.slice("w", i, F.col("size")), " "))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = lowest.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    ranked = first_rows(left.drop("longer"), "lang", [F.desc("score"), F.desc("a"), F.col("phrase")], top)
    size = counts.where("m = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(size, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def collocation_sql(docs: str = "documents", least: int = LEAST, share: int = SHARE, top: int = TOP) -> str:
    """DuckDB SQL for phrases of 2 and 3 words."""
    capital, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, '{capital}', '{small}'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM {docs} WHERE text IS NOT NULL),
ws AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
win AS MATERIALIZED (SELECT lang, unnest(range(1, len(w) + 1)) AS i, w FROM ws WHERE len(w) > 0),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM (
  SELECT lang, 1 AS m, w[i] AS phrase FROM win UNION ALL
  SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM win WHERE i + 1 <= len(w) UNION ALL
  SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM win WHERE i + 2 <= len(w)) GROUP BY ALL),
n AS (SELECT lang, count(*) AS n FROM win GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= {least}),
cuts AS (SELECT lang, phrase, a, 1 AS k, w[1] AS first, array_to_string(w[2:], ' ') AS rest FROM cand UNION ALL
  SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM cand WHERE m = 3),
scored AS (SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, CAST(a AS HUGEINT) * a * 1000000 // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, w[1] || ' ' || w[2] AS phrase FROM cand WHERE m = 3 UNION ALL
  SELECT lang, a, w[2] || ' ' || w[3] FROM cand WHERE m = 3) GROUP BY ALL),
kept AS (SELECT o.* FROM lowest o LEFT JOIN inside i ON i.lang = o.lang AND i.phrase = o.phrase WHERE i.longer IS NULL OR 100 * i.longer < {share} * o.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept QUALIFY rank <= {top})
SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked r JOIN n ON n.lang = r.lang"""
