"""Exact removal of long byte strings that an earlier document has already.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id. Every such string holds one *anchor*: its smallest
hashed substring of ``GRAM`` bytes (the leftmost, if equal). Which one that is
follows from the string alone, so equal strings have equal anchors, and a
document's strings fall into stretches of neighbours with the same anchor.

1. Each task hashes its texts' stretches (numpy, a few MB of text at a time).
   Of equal stretches only the first document's entry is sent on; the others
   are known to be repeats.
2. Shards by anchor hash gather the entries. A stretch that a smaller document has too
   is a repeat; if an anchor has different stretches, the first
   document of each is asked for its bytes. Anchors are minima of hashes, so small
   hashes are far more frequent; the shards' limits follow that, and each shard gets about as much.
3. Those bytes are gathered by anchor again. The suffixes of a shard's
   stretches that are a full string long are sorted (a suffix array cut at ``LENGTH``),
   and neighbours that agree in ``LENGTH`` bytes show which strings start in a smaller document.
   Where an anchor has very many stretches, hashes of their strings are sent instead,
   each to a shard of its own, and of equal strings in a few texts only the first document's.
4. The answers meet the texts, and the covered bytes are cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import column, runs, scratch, small_batches, trim

LENGTH, GRAM = 50, 16
#: Bytes of text that are hashed at a time, entries that a task gathers before it sends them, and text bytes that a shard's entries stand for.
FLUSH, GATHER, SHARD_BYTES = 1 << 20, 300_000, 8 << 20
#: Entries of a shard that are sorted at a time, strings that are sorted at a time (or those of one anchor) and stretches from which an anchor's strings are dealt out.
ENTRIES, STRINGS, HOT_STRETCHES = 1 << 20, 1 << 18, 20_000
#: Documents without an id come after all others.
LAST_ID = (1 << 63) - 1

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))
BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOW32 = np.uint64(0xFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Stretches:
    """The stretches of several texts: ``doc``, ``first`` and ``last`` string start (within the text), ``anchor`` hash and ``key`` hash."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        data = np.frombuffer(b"".join(texts), np.uint8)
        n, window = len(data), LENGTH - GRAM + 1
        if n < LENGTH:
            self.doc = self.first = self.last = np.zeros(0, np.int64)
            self.anchor = self.key = np.zeros(0, np.uint64)
            return
        value = BYTE[data]
        h, span, base = value, 1, int(ODD)
        while span < GRAM:  # hashes of 2, 4, 8, ... bytes
            h = h[:-span] * np.uint64(base) + h[span:]
            span, base = span * 2, base * base % (1 << 64)
        h = mixed(h)
        low = (h & ~LOW32) | np.arange(len(h), dtype=np.uint64)  # the hash, then the place: ties go left
        span = 1
        while span * 2 <= window:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[:len(low) - (window - span)], low[window - span:])
        place = (low & LOW32).astype(np.int64)  # of the anchor of the string that starts here
        ends = np.repeat(begin[1:], sizes)[:len(place)]
        start = np.flatnonzero(np.arange(len(place)) + LENGTH <= ends)  # strings within one text
        if not len(start):
            self.__init__([])
            return
        new = np.flatnonzero(np.concatenate([[True], (place[start][1:] != place[start][:-1]) | (np.diff(start) > 1)]))
        first, last = start[new], start[np.concatenate([new[1:] - 1, [len(start) - 1]])]
        at = place[first]
        up, down = powers(ODD, n), powers(INVERSE, n)
        total = np.concatenate([[np.uint64(0)], np.cumsum(value * up)])
        body = (total[last + LENGTH] - total[first]) * down[first]
        self.anchor = h[at]
        shape = (last - first).astype(np.uint64) * np.uint64(64) + (at - first).astype(np.uint64)
        self.key = mixed(body + mixed(shape + ODD))
        self.doc = np.searchsorted(begin, first, side="right") - 1
        self.first, self.last = first - begin[self.doc], last - begin[self.doc]
        self.offset = at - first


def groups(*keys: np.ndarray) -> np.ndarray:
    """Where a new group starts in sorted ``keys``."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def limits(shards: int) -> np.ndarray:
    """The anchor hashes where a new shard begins, so that random texts give each as much.

    A hash ``x`` (of 0 to 1) is an anchor if ``w`` neighbours with it in their midst are larger; a share of
    ``1 - q ** w * (w + 1 - (w - 1) * q) / 2`` of the anchors is below ``x = 1 - q``.
    """
    w = LENGTH - GRAM + 1
    x = np.linspace(0, 1, 1 << 18) ** 2
    below = 1 - (1 - x) ** w * (w + 1 - (w - 1) * (1 - x)) / 2
    return (np.interp(np.arange(1, shards) / shards, below, x) * 2.0 ** 63).astype(np.uint64) << np.uint64(1)


def texts_of(batches, n_text: int):
    """Ids and texts of about ``FLUSH`` bytes at a time."""
    ids, texts, total = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(n_text).cast(pa.binary()).to_pylist()):
            ids.append(LAST_ID if i is None else i)
            texts.append(t or b"")
            total += len(texts[-1])
            if total >= FLUSH:
                yield ids, texts
                ids, texts, total = [], [], 0
    if ids:
        yield ids, texts


def by_doc(doc: np.ndarray, *values: np.ndarray):
    """(ids, [values as bytes per id]) of entries, grouped by id."""
    order = np.argsort(doc, kind="stable")
    doc = doc[order]
    cut = np.flatnonzero(groups(doc))
    out = []
    for v in values:
        v = v[order]
        out.append([x.tobytes() for x in np.split(v, cut[1:])] if len(cut) else [])
    return doc[cut], out


ENTRY = T.StructType([T.StructField("shard", T.LongType()), T.StructField("id", T.LongType()), T.StructField("entries", T.BinaryType())])
#: A stretch (by key) of a document: the strings of it (bits) that a smaller document has; WHOLE: all of them; ASK: its bytes are needed.
#: HOT: no stretch, but an anchor (as key) and how many stretches of it are asked for (as id).
MARK = T.StructType([T.StructField(n, T.LongType()) for n in ("id", "key", "mask")])
WHOLE, ASK, HOT = -1, 0, -2
#: Asked stretches; with DONE as offset, a mark (its mask as anchor); with DEALT, packed strings of hot anchors.
DONE, DEALT = -1, -2
BYTES = T.StructType([T.StructField("shard", T.LongType()), T.StructField("id", T.LongType()), T.StructField("key", T.LongType()),
                      T.StructField("anchor", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("bytes", T.BinaryType())])


def entries(docs: DataFrame, shards: int) -> DataFrame:
    """Rows for the shards (0 and up: packed ids, anchors, keys) and, with negative shards, repeats that the task has found itself (``id``, keys)."""
    begins = limits(shards)

    def send(doc, anchor, key):
        order = np.lexsort((doc, key, anchor))
        doc, anchor, key = doc[order], anchor[order], key[order]
        new = groups(anchor, key)
        head = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        own = np.flatnonzero(doc > head)
        names, (keys,) = by_doc(doc[own], key[own])
        rows = [(-1 - names % shards).tolist(), names.tolist(), keys]
        doc, anchor, key = doc[new], anchor[new], key[new]
        shard = np.searchsorted(begins, anchor, side="right")
        order = np.lexsort((doc, shard))
        doc, anchor, key, shard = doc[order], anchor[order], key[order], shard[order]
        cut = np.flatnonzero(groups(shard))
        for a, z in zip(cut, [*cut[1:], len(shard)]):
            rows[0].append(int(shard[a]))
            rows[1].append(None)
            rows[2].append(packed(doc[a:z], anchor[a:z], key[a:z]))
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())], names=["shard", "id", "entries"])

    def run(batches):
        held, n = [], 0
        for ids, texts in texts_of(batches, 1):
            s = Stretches(texts)
            held.append((np.array(ids, np.int64)[s.doc], s.anchor, s.key & HIGH48))
            n += len(s.doc)
            if n >= GATHER:
                yield send(*map(np.concatenate, zip(*held)))
                held, n = [], 0
                trim()
        if n:
            yield send(*map(np.concatenate, zip(*held)))
        del held
        trim()

    return docs.select("id", "t").mapInArrow(run, ENTRY)


def planes(x: np.ndarray, *cuts: int) -> list[bytes]:
    """The bytes of numbers, those before, between and after ``cuts`` apart: high ones that hardly vary compress well."""
    b = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1)
    return [b[:, a:z].tobytes() for a, z in zip((0, *cuts), (*cuts, b.shape[1]))]


class Reader:
    """Reads what ``planes`` has written, and plain numbers."""

    def __init__(self, payload):
        self.payload, self.at = payload, 0

    def plain(self, kind, n: int) -> np.ndarray:
        self.at += n * np.dtype(kind).itemsize
        return np.frombuffer(self.payload, kind, n, self.at - n * np.dtype(kind).itemsize)

    def numbers(self, kind, n: int, *cuts: int, low: int = 0) -> np.ndarray:
        """Numbers in parts; the ``low`` lowest bytes, which aren't there, are 0."""
        width = np.dtype(kind).itemsize
        out = np.zeros((n, width), np.uint8)
        for a, z in zip((low, *cuts), (*cuts, width)):
            out[:, a:z] = self.plain(np.uint8, n * (z - a)).reshape(n, z - a)
        return out.view(kind).ravel()


def packed(doc: np.ndarray, anchor: np.ndarray, key: np.ndarray) -> bytes:
    """Entries, sorted by document, as bytes: ids less the first, how many entries each has, anchors and 48 bits of the keys."""
    cut = np.flatnonzero(groups(doc))
    count = np.diff(cut, append=len(doc)).astype(np.uint32)
    return b"".join([np.array([len(doc), len(cut), doc[0]], np.int64).tobytes(), *planes(doc[cut] - doc[0], 2), *planes(count, 1), *planes(anchor, 6, 7), *planes(key, 2)[1:]])


def unpacked(payload) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r = Reader(payload)
    n, m, first = r.plain(np.int64, 3)
    heads = r.numbers(np.int64, m, 2) + first
    doc = np.repeat(heads, r.numbers(np.uint32, m, 1))
    return doc, r.numbers(np.uint64, n, 6, 7), r.numbers(np.uint64, n, low=2)


HIGH48 = ~np.uint64(0xFFFF)


def repeats_in_shard(doc, anchor, key, large=None):
    """(repeats, asked, hot): entry arrays (doc, key) that a smaller document has whole, and those whose bytes are needed; (stretches asked, anchor) of hot anchors.

    All stretches of the anchors ``large`` are asked for, and these are hot.
    """
    order = np.lexsort((doc, key, anchor))
    doc, anchor, key = doc[order], anchor[order], key[order]
    new = groups(anchor, key)
    at = np.flatnonzero(new)
    head = doc[at]
    again = np.flatnonzero(doc > head[np.cumsum(new) - 1])
    one = groups(anchor[at])  # of the first entries: where another anchor begins
    if not len(at):
        return (doc, key), (doc, key), (doc, anchor)
    cut, none = np.flatnonzero(one), np.zeros(0, np.uint64)
    always = np.isin(anchor[at[cut]], none if large is None else large)
    wanted = (np.minimum.reduceat(head, cut) < np.maximum.reduceat(head, cut)) | always
    ask = at[wanted[np.cumsum(one) - 1]]
    asked = np.where(wanted, np.diff(cut, append=len(at)), 0)
    hot = np.flatnonzero((asked > HOT_STRETCHES) | always)
    return (doc[again], key[again]), (doc[ask], key[ask]), (asked[hot], anchor[at[cut[hot]]])


def some_entries(payloads: list):
    """The entries of a shard in parts (of about ``ENTRIES``, if there are more), and the anchors that are in several parts.

    An anchor is in one part, but those with a large share of a part are dealt out by key.
    """
    n = sum(int(np.frombuffer(x, np.int64, 1)[0]) for x in payloads)
    parts = -(-n // ENTRIES)
    if parts <= 1:
        yield *(np.concatenate(x) for x in zip(*map(unpacked, payloads))), None
        return
    anchor = np.sort(np.concatenate([unpacked(x)[1] for x in payloads]))
    cut = np.flatnonzero(groups(anchor))
    large = anchor[cut[np.diff(cut, append=n) > ENTRIES // 4]]
    del anchor, cut
    for p in range(parts):
        found = []
        for x in payloads:
            doc, anchor, key = unpacked(x)
            here = np.flatnonzero(mixed(np.where(np.isin(anchor, large), key + ODD, anchor)) % np.uint64(parts) == p)
            found.append((doc[here], anchor[here], key[here]))
        yield *(np.concatenate(x) for x in zip(*found)), large


def mark_table(rows: list[tuple]) -> pa.Table:
    """MARK rows of (ids, keys, mask or masks)."""
    some = [(i, k, np.broadcast_to(np.int64(m) if np.isscalar(m) else m, len(i))) for i, k, m in rows]
    return pa.table([pa.array(np.concatenate([np.zeros(0, np.int64), *(np.asarray(x).astype(np.int64, copy=False) for x in c)])) for c in (zip(*some) if some else [[]] * 3)], names=MARK.names)


def buffers(column: pa.ChunkedArray) -> list[memoryview]:
    """The binary values of a column without copies."""
    return [memoryview(x.as_buffer()) for chunk in column.chunks for x in chunk]


def shard_marks(sent: DataFrame) -> DataFrame:
    """MARK rows: the stretches that are repeats, those whose bytes are needed, and hot anchors."""
    def run(t):
        payloads = buffers(t.column("entries"))
        if t.column("shard")[0].as_py() < 0:
            found = [np.frombuffer(x, np.uint64) for x in payloads]
            return mark_table([(np.repeat(t.column("id").to_numpy(), [len(x) for x in found]), np.concatenate(found).view(np.int64), WHOLE)])
        rows = []
        for doc, anchor, key, large in some_entries(payloads):
            (d, k), (d2, k2), (n, a) = repeats_in_shard(doc, anchor, key, large)
            rows += [(d, k.view(np.int64), WHOLE), (d2, k2.view(np.int64), ASK), (n, a.view(np.int64), HOT)]
        del doc, anchor, key
        out = mark_table(rows)
        del rows, payloads
        trim()
        return out

    return sent.groupBy("shard").applyInArrow(run, MARK)


def member(keys: np.ndarray, doc: np.ndarray, wanted: list[np.ndarray]) -> np.ndarray:
    """Which (doc, key) entries are in the sorted key lists of their documents."""
    out = np.zeros(len(keys), bool)
    cut = np.searchsorted(doc, np.arange(len(wanted) + 1))
    for d, w in enumerate(wanted):
        if len(w) and cut[d] < cut[d + 1]:
            out[cut[d]:cut[d + 1]] = np.isin(keys[cut[d]:cut[d + 1]], w)
    return out


def lists(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of longs of an Arrow column as unsigned arrays; null is empty."""
    none = np.zeros(0, np.uint64)
    return [none if not x.is_valid else x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in column]


def asked_bytes(marked: DataFrame, shards: int, hot: np.ndarray, dealt: int) -> DataFrame:
    """The bytes of the stretches that documents were asked for (one of equal ones); the strings of ``hot`` anchors (sorted), dealt to ``dealt`` shards after the others."""
    begins = limits(shards)

    def send(shard, doc, key, anchor, offset, body):
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (shard, doc, key, anchor, offset)] + [pa.array(body, pa.binary())], names=BYTES.names)

    def deal(doc, key, anchor, offset, body):
        """Strings of hot anchors: those that a smaller document of these has are marked, the others are packed for their shards."""
        of, number, sketch = strings(anchor, offset, np.array([len(b) for b in body], np.int64), b"".join(body))
        late, order = later(doc[of], sketch)
        mask = np.zeros(len(doc), np.uint64)
        np.bitwise_or.at(mask, of[late], np.uint64(1) << number[late].astype(np.uint64))
        at = np.flatnonzero(mask)
        yield send(-1 - doc[at] % shards, doc[at], key[at].view(np.int64), mask[at].view(np.int64), np.full(len(at), DONE), [b""] * len(at))
        shard = (sketch[order] >> np.uint64(40)).astype(np.int64) * dealt >> 24
        begin = np.flatnonzero(groups(shard))  # as the strings are by hash, so are their shards
        payloads = [packed_strings(doc[of[x]], key[of[x]], number[x], sketch[x]) for x in np.split(order, begin[1:])]
        none = np.zeros(len(begin), np.int64)
        yield send(shards + shard[begin], none, none, none, none + DEALT, payloads)

    def run(batches):
        for b in batches:
            ids, asks = b.column(0).to_pylist(), lists(b.column(2))
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            for i, j in runs(map(len, texts), FLUSH):
                s = Stretches(texts[i:j])
                if not len(s.doc):
                    continue
                key = s.key & HIGH48
                at = np.flatnonzero(member(key, s.doc, asks[i:j]))
                at = at[np.unique(np.stack([s.doc[at].astype(np.uint64), key[at]]), axis=1, return_index=True)[1]]
                many = np.isin(s.anchor[at], hot)
                for x, of_hot in ((at[~many], False), (at[many], True)):
                    if not len(x):
                        continue
                    doc = np.array([LAST_ID if x is None else x for x in ids[i:j]], np.int64)[s.doc[x]]
                    body = [texts[i + d][a:z + LENGTH] for d, a, z in zip(s.doc[x].tolist(), s.first[x].tolist(), s.last[x].tolist())]
                    if of_hot:
                        yield from deal(doc, key[x], s.anchor[x], s.offset[x], body)
                    else:
                        yield send(np.searchsorted(begins, s.anchor[x], side="right"), doc, key[x].view(np.int64), s.anchor[x].view(np.int64), s.offset[x], body)
        trim()

    return marked.select("id", "t", "ask").mapInArrow(run, BYTES)


def strings(anchor: np.ndarray, offset: np.ndarray, sizes: np.ndarray, data, begin: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, string, hash) of all strings of the stretches, whose bytes begin at ``begin`` in ``data`` (or follow one another).

    The hash is of the anchor, its place in the string and the string's bytes as seven words.
    """
    count = sizes - LENGTH + 1
    of = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(np.cumsum(sizes) - sizes if begin is None else begin, count) + number
    word = np.ndarray(max(0, len(data) - 7), "<u8", data, strides=(1,))  # the eight bytes from each place on
    sketch = mixed(anchor[of] + (offset[of] - number).astype(np.uint64) * ODD)
    for k in (*range(0, LENGTH - 7, 8), LENGTH - 8):
        sketch = mixed(sketch * ODD + word[at + k])
    return of, number, sketch


def later(doc: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings that a smaller document of these has too, and the others; both by hash."""
    order = np.lexsort((doc, sketch))
    doc, new = doc[order], groups(sketch[order])
    late = doc > doc[new][np.cumsum(new) - 1]
    return order[late], order[~late]


def packed_strings(doc: np.ndarray, key: np.ndarray, number: np.ndarray, sketch: np.ndarray) -> bytes:
    """Strings as bytes: ids, 48 bits of the keys, numbers in the stretch, hashes."""
    return b"".join([np.array([len(doc)], np.int64).tobytes(), *planes(doc, 3), *planes(key, 2)[1:], number.astype(np.uint8).tobytes(), sketch.tobytes()])


def unpacked_strings(payload) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    r = Reader(payload)
    n = int(r.plain(np.int64, 1)[0])
    return r.numbers(np.int64, n, 3), r.numbers(np.uint64, n, low=2), r.plain(np.uint8, n), r.plain(np.uint64, n)


def dealt_marks(payloads: list):
    """(id, key, mask) of the dealt strings that start in a smaller document too, some hashes at a time."""
    parts = -(-sum(int(np.frombuffer(x, np.int64, 1)[0]) for x in payloads) // ENTRIES)
    for p in range(parts):
        found = []
        for x in payloads:
            values = unpacked_strings(x)
            here = np.flatnonzero(values[3] % np.uint64(parts) == p)
            found.append([v[here] for v in values])
        doc, key, number, sketch = (np.concatenate(x) for x in zip(*found))
        late, _ = later(doc, sketch)
        if len(late):
            late = late[np.lexsort((key[late], doc[late]))]
            begin = np.flatnonzero(groups(doc[late], key[late]))
            yield doc[late[begin]], key[late[begin]].view(np.int64), np.bitwise_or.reduceat(np.uint64(1) << number[late].astype(np.uint64), begin).view(np.int64)


def stretch_masks(doc: np.ndarray, anchor: np.ndarray, offset: np.ndarray, sizes: np.ndarray, data) -> np.ndarray:
    """For each stretch (bytes one after another in ``data``) the strings, as bits, that start in a stretch of a smaller document too.

    The strings of some anchors at a time are sorted by hash; neighbours that agree are one string.
    """
    mask, begin = np.zeros(len(doc), np.uint64), np.cumsum(sizes) - sizes
    order = np.argsort(anchor, kind="stable")
    count = (sizes - LENGTH + 1)[order]
    cut = np.flatnonzero(groups(anchor[order]))  # all stretches of an anchor stay together
    part = ((np.cumsum(count) - count) // STRINGS)[cut]
    for rows in np.split(order, cut[1:][part[1:] != part[:-1]]) if len(order) else []:
        of, number, sketch = strings(anchor[rows], offset[rows], sizes[rows], data, begin[rows])
        late, _ = later(doc[rows][of], sketch)
        np.bitwise_or.at(mask, rows[of[late]], np.uint64(1) << number[late].astype(np.uint64))
    return mask


def string_marks(asked: DataFrame) -> DataFrame:
    """MARK rows of the asked stretches that have strings which start in a smaller document."""
    def run(t):
        doc, key, anchor, offset = (t.column(c).to_numpy() for c in ("id", "key", "anchor", "offset"))
        if offset[0] == DONE:
            return mark_table([(doc, key, anchor)])
        if offset[0] == DEALT:
            out = mark_table([*dealt_marks(buffers(t.column("bytes")))])
        else:
            bodies = t.column("bytes").cast(pa.large_binary()).combine_chunks()
            ends = np.frombuffer(bodies.buffers()[1], np.int64, len(bodies) + 1, 8 * bodies.offset)
            mask = stretch_masks(doc, anchor.view(np.uint64), offset, np.diff(ends), np.frombuffer(bodies.buffers()[2], np.uint8)[ends[0]:ends[-1]])
            at = np.flatnonzero(mask)
            out = mark_table([(doc[at], key[at], mask[at].view(np.int64))])
        trim()
        return out

    return asked.groupBy("shard").applyInArrow(run, MARK)


RESULT = [T.StructField(n, t) for n, t in (("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept", T.BinaryType()))]


def cut_texts(texts: list[bytes], marks: list[tuple[np.ndarray, np.ndarray]]):
    """(removed bytes, spans, remaining bytes) of each text, given the keys and masks of its marked stretches."""
    whole = [k[m == ~np.uint64(0)] for k, m in marks]
    s = Stretches(texts)
    key = s.key & HIGH48
    full = member(key, s.doc, whole)
    cut = np.searchsorted(s.doc, np.arange(len(texts) + 1))
    out = []
    for d, text in enumerate(texts):
        a, z = cut[d], cut[d + 1]
        edge = np.zeros(len(text) + 1, np.int64)
        rows = np.flatnonzero(full[a:z]) + a
        np.add.at(edge, s.first[rows], 1)
        np.subtract.at(edge, s.last[rows] + LENGTH, 1)
        if len(whole[d]) < len(marks[d][0]) and z > a:
            table = np.stack(marks[d], 1)[marks[d][1] != ~np.uint64(0)]
            table = table[np.argsort(table[:, 0], kind="stable")]
            begin = np.flatnonzero(groups(table[:, 0]))  # a stretch's strings may be marked in several rows
            table = np.stack([table[begin, 0], np.bitwise_or.reduceat(table[:, 1], begin)], 1)
            i = np.minimum(np.searchsorted(table[:, 0], key[a:z]), len(table) - 1)
            for r in np.flatnonzero(table[i, 0] == key[a:z]):
                mask = int(table[i[r], 1])
                for k in range(int(s.last[a + r] - s.first[a + r]) + 1):
                    if mask >> k & 1:
                        edge[s.first[a + r] + k] += 1
                        edge[s.first[a + r] + k + LENGTH] -= 1
        covered = np.cumsum(edge[:-1]) > 0
        n = int(covered.sum())
        spans = int((covered & ~np.concatenate([[False], covered[:-1]])).sum()) if n else 0
        out.append((n, spans, np.frombuffer(text, np.uint8)[~covered].tobytes() if n else text))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
                   names: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept")) -> DataFrame:
    """Per row: ``keep`` columns (``id_col`` if not given), ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the
    remaining bytes), or as ``names`` call these four.

    ``id_col`` is an integer; a null id comes after all others. Null texts are empty; texts under
    ``LENGTH`` bytes stay whole; rows with the same id never cut one another. Kept bytes may be broken
    UTF-8 where a string began or ended inside a character.
    """
    spark = docs.sparkSession
    small_batches(spark)
    keep = keep or [id_col]
    base = docs.select(F.coalesce(column(docs, id_col).cast("long"), F.lit(LAST_ID)).alias("id"), column(docs, text_col).cast("string").alias("t"),
                       *[column(docs, c).alias(f"k{i}") for i, c in enumerate(keep)])
    total = base.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    marks = scratch(shard_marks(entries(base, shards)), "marks")
    # The lists are a document's own marks, at most one for each of its stretches.
    asks = marks.where(F.col("mask") == ASK).groupBy("id").agg(F.collect_list("key").alias("ask"))
    # An anchor is hot by thousands of stretches, so these are few.
    hot = marks.where(F.col("mask") == HOT).groupBy("key").agg(F.sum("id")).collect()
    dealt = -(-sum(r[1] for r in hot) * (LENGTH - GRAM + 1) // ENTRIES)
    anchors = np.sort(np.array([r[0] for r in hot], np.int64).view(np.uint64))
    parts = string_marks(asked_bytes(base.select("id", "t").join(asks, "id"), shards, anchors, dealt))
    found = marks.where(~F.col("mask").isin(ASK, HOT)).unionAll(parts).groupBy("id").agg(F.collect_list(F.struct("key", "mask")).alias("m"))
    joined = base.join(found, "id", "left").select(*[f"k{i}" for i in range(len(keep))], F.col("m.key").alias("key"), F.col("m.mask").alias("mask"), "t")
    schema = T.StructType([joined.schema[f"k{i}"] for i in range(len(keep))] + RESULT)

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column("t").cast(pa.binary()).to_pylist()]
            marks = list(zip(lists(b.column("key")), lists(b.column("mask"))))
            for i, j in runs(map(len, texts), FLUSH):
                n, spans, kept = [0] * (j - i), [0] * (j - i), texts[i:j]
                some = [d for d in range(j - i) if len(marks[i + d][0])]
                for d, (a, c, left) in zip(some, cut_texts([texts[i + d] for d in some], [marks[i + d] for d in some])):
                    n[d], spans[d], kept[d] = a, c, left
                made = [pa.array([len(t) for t in texts[i:j]], pa.int64()), pa.array(n, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays([b.column(k).slice(i, j - i) for k in range(len(keep))] + made, names=schema.names)
        trim()

    return joined.mapInArrow(run, schema).toDF(*keep, *names)
