"""Quality rules on repetition: how much of a text stands inside repeated n-grams and lines.

Words are hashed once; the hashes of n-grams roll on from length to length
(``g_n[i] = g_(n-1)[i] * B + h[i+n-1]``), in numpy over many texts at a time.
Equal n-grams are neighbours after one sort and are confirmed word by word.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.llm.common import longs, map_text

#: Share of the characters that may stand inside n-grams found twice or more, by n (fixed values: the published
#: limits of the Gopher corpus rules; the base rule counts words, so texts whose repeats are long words fail here alone).
NGRAM_LIMITS = {5: 0.15, 7: 0.13, 10: 0.10}
#: Share of the characters that may stand in lines equal to an earlier line (fixed value, same source).
LINE_LIMIT = 0.20
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
BASE = np.uint64(0x9E3779B97F4A7C15)


def code_points(text: bytes) -> int:
    return len(text) - (len(text) - len(text.translate(None, CONTINUATION)))


def covered_words(h: np.ndarray, doc: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """For each n: which words stand in an n-gram that its text has twice or more.

    ``h``: word hashes of several texts in a row, ``doc``: the text of each word (ascending).
    """
    out, n = {}, 1
    g = h ^ (doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for want in sorted(lengths):
        while n < want and len(g):
            g = g[:-1] * BASE + h[n:]
            n += 1
        covered = np.zeros(len(h), bool)
        if len(h) >= want:
            at = np.flatnonzero(doc[:len(g)] == doc[want - 1:])
            at = at[np.argsort(g[at], kind="stable")]
            a, b = at[:-1], at[1:]
            same = np.flatnonzero((g[a] == g[b]) & (doc[a] == doc[b]))
            for k in range(want):
                same = same[h[a[same] + k] == h[b[same] + k]]
            edge = np.zeros(len(h) + 1, np.int64)
            starts = np.unique(np.concatenate([a[same], b[same]]))
            np.add.at(edge, starts, 1)
            np.subtract.at(edge, starts + want, 1)
            covered = np.cumsum(edge[:-1]) > 0
        out[want] = covered
    return out


def measure(texts: list[bytes], limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT):
    n_words, word_chars, symbols, dup_lines, line_chars = [], [], [], [], []
    hashes, sizes = [], []
    for text in texts:
        words = text.split()
        n_words.append(len(words))
        joined = b"".join(words)
        word_chars.append(code_points(joined))
        symbols.append(len(text) - len(text.translate(None, SYMBOLS)))
        lines = [x for x in text.split(b"\n") if x.strip()]
        again = len(lines) - len(set(lines))
        dup_lines.append(again)
        repeated = 0
        if again:
            seen: set[bytes] = set()
            for x in lines:
                if x in seen:
                    repeated += code_points(b"".join(x.split()))
                seen.add(x)
        line_chars.append(repeated)
        hashes.append(np.fromiter(map(hash, words), np.int64, len(words)))
        sizes.append(np.fromiter(map(len, words), np.int64, len(words)))
        if len(joined) != word_chars[-1]:
            sizes[-1] = np.fromiter((code_points(w) for w in words), np.int64, len(words))
    doc = np.repeat(np.arange(len(texts)), n_words)
    h, size = np.concatenate(hashes).view(np.uint64), np.concatenate(sizes)
    covered = covered_words(h, doc, [5, *limits])
    count = lambda w: np.bincount(doc, weights=w, minlength=len(texts)).astype(np.int64)
    repeat_words = count(covered[5])
    n, chars = np.array(n_words), np.array(word_chars)
    failed = (n < 10) | (100 * repeat_words > 20 * n)
    ngram_chars = {k: count(covered[k] * size) for k in limits}
    good = np.array(line_chars) <= line_limit * chars
    for k, most in limits.items():
        good &= ngram_chars[k] <= most * chars
    return [n_words, word_chars, symbols, dup_lines, repeat_words, failed, good & ~failed, line_chars, *(ngram_chars[k] for k in limits)]


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT) -> DataFrame:
    """Per row: counts, ``base_failed``, ``kept`` and the characters found inside repeats.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` (words inside
    five-word windows found twice or more) feed the base rule: under 10 words, or over 20 % repeated
    words, fails. A text is kept if it passes and no share of characters in repeated n-grams
    (``limits``) or repeated lines (``line_limit``) is over its limit. Null and empty texts have no
    words and fail; every row of the input gives one row. No shuffle.
    """
    limits = dict(sorted(limits.items()))
    fields = longs("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    fields += longs("dup_line_chars", *(f"dup_{k}gram_chars" for k in limits))
    return map_text(docs, text_col, [id_col], fields, lambda: lambda texts: measure(texts, limits, line_limit))
