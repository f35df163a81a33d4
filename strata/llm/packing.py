"""Packing token sequences with Karmarkar-Karp multiway differencing.

Every text becomes token ids plus an end id. Whole windows are cut off first;
what is left (in pieces of ``max_piece`` at most) goes to blocks of about
``block`` pieces. Within a block, multiway differencing merges partial
partitions so that the largest sums of the one meet the smallest of the other,
which gives windows of nearly equal fill; if a window is over capacity, the
number of windows rises and the block is dealt again.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import column, map_text, scratch, worker_cache

END_ID = 2


def id_encoder(path: str, cache_words: int = 250_000):
    """A function from texts to their token ids as little-endian 32-bit bytes.

    The tokenizer never joins over white space, lower-cases, and cuts signs off a word that ends in
    a letter, so words are encoded once (without case and those signs) and remembered. Words of
    plain lower-case letters need no normalising or cutting: they go to the model many at a time,
    and its word-end tokens tell them apart.
    """
    import os
    import re
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers
    full, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
    plain.normalizer = None
    plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    letters = re.compile(b"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch  # a-z and the small letters of Latin-1
    ends = np.zeros(full.get_vocab_size(), bool)
    ends[[i for piece, i in full.get_vocab().items() if piece.endswith("</w>")]] = True
    known: dict[bytes, bytes] = {}
    older: dict[bytes, bytes] = {}

    def learn(words: set[bytes]) -> None:
        nonlocal known, older
        if len(known) > cache_words:
            known, older = {}, known
        new = words.difference(known)
        if older:
            known.update((w, older[w]) for w in new.intersection(older))
            new.difference_update(known)
        easy = [*filter(letters, new)]
        hard = [*new.difference(easy)]
        for i in range(0, len(easy), 1000):
            some = easy[i:i + 1000]
            ids = np.array(plain.encode(b" ".join(some).decode(), add_special_tokens=False).ids, "<u4")
            at = [0, *(4 * (np.flatnonzero(ends[ids]) + 1)).tolist()]
            if len(at) != len(some) + 1:
                raise ValueError("the vocabulary doesn't mark the ends of words")
            flat = ids.tobytes()
            known.update(zip(some, map(flat.__getitem__, map(slice, at, at[1:]))))
        for w, e in zip(hard, full.encode_batch_fast([w.decode("utf-8", "replace") for w in hard], add_special_tokens=False)):
            known[w] = np.array(e.ids, "<u4").tobytes()

    def encode(texts: list[bytes]) -> list[bytes]:
        # "<|" may start a special token, whose case counts
        joined = b"".join(x for t in texts for x in (t if b"<|" in t else t.lower(), b"\n"))
        first, stop = word_places(np.frombuffer(joined, np.uint8))
        seen, of = distinct_words(np.frombuffer(joined, np.uint8), first, stop)
        words = [joined[i:j] for i, j in zip(first[seen].tolist(), stop[seen].tolist())]
        learn({*words})
        held = [known[w] for w in words]
        size = np.fromiter(map(len, held), np.int64, len(held)) // 4
        start = np.cumsum(size) - size
        ids, count = np.frombuffer(b"".join(held), "<u4"), size[of]
        until = np.cumsum(count)
        ids = ids[np.repeat(start[of] - (until - count), count) + np.arange(until[-1] if len(until) else 0)]
        ends_at = np.searchsorted(first, np.cumsum([len(t) + 1 for t in texts]))
        cuts = np.concatenate([[0], until])[np.concatenate([[0], ends_at])].tolist()
        return [ids[i:j].tobytes() for i, j in zip(cuts, cuts[1:])]

    return encode


SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
SMALL = (np.arange(256) >= 97) & (np.arange(256) <= 122)
#: Signs that the tokenizer cuts off a letter before them: ASCII punctuation but for ' (contractions) and < | > (special tokens).
SIGN = np.isin(np.arange(256), list(b'!"#$%&()*+,-./:;=?@[\\]^_`{}~'))
BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD = 0x9E3779B97F4A7C15


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text that ends in white space; signs after a last letter a-z are a word of their own."""
    space = SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate([[0], edge])
    first, stop = edge[::2], edge[1::2]
    plain = np.maximum.accumulate(np.where(SIGN[data], 0, np.arange(len(data))))[stop - 1]  # the last place without a sign
    signed = np.flatnonzero((plain >= first) & (plain < stop - 1) & SMALL[data[plain]])
    ends = stop.copy()
    ends[signed] = plain[signed] + 1
    return np.insert(first, signed + 1, ends[signed]), np.insert(ends, signed + 1, stop[signed])


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def distinct_words(data: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one occurrence of each distinct word, the distinct word of each occurrence), by 64-bit hashes."""
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = max(len(data), 5 << 18)  # the usual size is kept by the worker
    power, back = (worker_cache(("powers", base), lambda: powers(base, size)) if size == 5 << 18 else powers(base, size) for base in (ODD, pow(ODD, -1, 1 << 64)))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * power[:len(data)], out=total[1:])
    h = (total[stop] - total[first]) * back[first]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + (stop - first).astype(np.uint64)
    _, seen, of = np.unique(h, return_index=True, return_inverse=True)
    return seen, of


def pieces_of(path: str, window: int, max_piece: int):
    encode = worker_cache(("ids", path), lambda: id_encoder(path))
    end = np.array([END_ID], "<u4").tobytes()

    def cut(texts: list[bytes]):
        out = []
        for ids in encode(texts):
            ids += end
            n = len(ids) // 4
            rest = n % window
            parts = -(-rest // max_piece)  # of nearly equal length
            cuts = [*range(0, n - rest, window), *(n - rest + rest * i // parts for i in range(parts)), n]
            out.append([{"start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[4 * a:4 * b]), "doc_tokens": n} for a, b in zip(cuts, cuts[1:])])
        return [out]

    return cut


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window (0 to k-1) of each item, by Karmarkar-Karp differencing of k-tuples of sums."""
    n = len(sizes)
    sums, merges, heap = {}, [], []
    for i, s in enumerate(sizes):
        sums[i] = np.zeros(k, np.int64)
        sums[i][0] = s
        heap.append((-int(s), i))
    heapq.heapify(heap)
    for node in range(n, 2 * n - 1):
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        s = sums.pop(a) + sums.pop(b)[::-1]  # largest with smallest
        order = np.argsort(-s, kind="stable")
        sums[node] = s = s[order]
        merges.append((node, a, b, order))
        heapq.heappush(heap, (int(s[-1] - s[0]), node))
    labels = {2 * n - 2: np.arange(k)}
    for node, a, b, order in reversed(merges):
        own = labels.pop(node)
        labels[a] = np.empty(k, np.int64)
        labels[a][order] = own
        labels[b] = labels[a][::-1]
    return np.array([labels[i][0] for i in range(n)], np.int64)


def pack_block(sizes: np.ndarray, window: int) -> np.ndarray:
    """A window for each piece; whole windows get one each, the rest are dealt by differencing."""
    out = np.full(len(sizes), -1, np.int64)
    whole = np.flatnonzero(sizes == window)
    out[whole] = np.arange(len(whole))
    rest = np.flatnonzero(sizes < window)
    if len(rest):
        k = -(-int(sizes[rest].sum()) // window)
        while True:
            label = differencing(sizes[rest], k)
            if np.bincount(label, weights=sizes[rest], minlength=k).max() <= window:
                break
            k += 1  # at k = len(rest) every piece has its own window
        out[rest] = label + len(whole)
    return out


PIECE = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]))


def pack(docs: DataFrame, tokenizer_path: str, window: int = 4096, max_piece: int = 512, block: int = 3000,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: ``id_col``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Null and empty texts are one end id. Each id of a text is in one piece;
    rows that repeat are packed each. Pieces of a text that fills many windows
    go to different blocks, so no block grows with one text or one id. Blocks
    are dealt by a hash and their number follows the number of pieces; only
    piece rows (no texts) are shuffled.
    """
    made = map_text(docs, text_col, [id_col], [T.StructField("pieces", PIECE)], lambda: pieces_of(tokenizer_path, window, max_piece), budget=1 << 20)
    pieces = scratch(made.select(column(made, id_col).alias("id"), F.inline("pieces")), "pieces")
    blocks = max(1, -(-pieces.count() // block))
    id_type = pieces.schema["id"].dataType
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("id", "start", "ids_crc32", "doc_tokens"), F.lit(blocks)))
    # Rows that are equal in all columns share a hash; a random salt would not survive a retry,
    # so a crowd of equal rows only makes its block larger than the others.
    schema = T.StructType([T.StructField("id", id_type)] + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        base = int(pdf["block"].iloc[0]) << 32
        pdf = pdf.sort_values(["length", "ids_crc32", "doc_tokens", "start", "id"], kind="stable").reset_index(drop=True)
        parts = []
        for i in range(0, len(pdf), 2 * block):  # a block that equal rows made large is dealt in parts
            part = pdf.iloc[i:i + 2 * block].copy()
            part["sequence_id"] = pack_block(part["length"].to_numpy(), window) + base + i
            part["offset"] = part.groupby("sequence_id")["length"].cumsum() - part["length"]
            parts.append(part)
        return pd.concat(parts)[[f.name for f in schema]]

    packed = dealt.groupBy("block").applyInPandas(deal, schema)
    return packed.withColumnRenamed("id", id_col) if id_col != "id" else packed
