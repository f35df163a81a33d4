"""No shard of the repeats operator gets much more than the others, and dealt strings give the same cuts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import repeats

LINE = b"\nouwhea the of rend and threlyes"


def word(rng) -> bytes:
    return bytes(rng.integers(97, 123, int(rng.integers(2, 9)), dtype=np.uint8))


def rows(n: int) -> list[tuple]:
    """Random words around a line that is shorter than a string, some long passages, copies, repeated ids and ids that are null."""
    rng = np.random.default_rng(3)
    passage = b" ".join(word(rng) for _ in range(20))
    out = []
    for i in range(n):
        left, right = (b" ".join(word(rng) for _ in range(12)) for _ in range(2))
        text = left + (LINE + b" " + right) * (1 + i % 2) + (passage[i % 7:] if i % 5 == 0 else b"")
        out.append((None if i % 11 == 10 else i % (n - 4), text.decode()))
        if i % 17 == 0:
            out.append((n + i, text.decode()))
    return [*out, (3, None), (None, ""), (5, "short")]


def cuts(rows: list[tuple]) -> list[tuple]:
    """By the definition: bytes under a string that starts in a document with a smaller id."""
    texts = [(1 << 62 if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in sorted(texts):
        for k in range(len(b) - 49):
            first.setdefault(b[k:k + 50], i)
    out = []
    for i, b in texts:
        cover = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < i:
                cover[k:k + 50] = b"\1" * 50
        out.append((i, len(b), sum(cover), bytes(c for c, x in zip(b, cover) if not x)))
    return sorted(out)


def test_shards_get_about_as_much(spark):
    rng = np.random.default_rng(5)
    docs = spark.createDataFrame([(i, b" ".join(word(rng) for _ in range(600)).decode()) for i in range(400)], "id long, t string")
    sent = repeats.entries(docs.repartition(2), 25).where("shard >= 0").groupBy("shard").agg(F.sum(F.length("entries")).alias("n")).collect()
    sizes = [r.n for r in sent]
    assert len(sizes) == 25 and max(sizes) < 1.5 * sum(sizes) / 25


def test_parts_and_dealt_strings_cut_the_same(spark, monkeypatch):
    made = rows(150)
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    for entries, strings, hot in ((1 << 20, 1 << 18, 20_000), (300, 100, 10), (40, 10, 1)):
        for name, value in (("ENTRIES", entries), ("STRINGS", strings), ("HOT_STRETCHES", hot)):
            monkeypatch.setattr(repeats, name, value)
        got = repeats.remove_repeats(docs).select(F.coalesce("doc_id", F.lit(1 << 62)), "n_bytes", "n_removed", F.col("kept")).collect()
        assert sorted((i, n, m, bytes(k)) for i, n, m, k in got) == cuts(made), (entries, strings, hot)


def test_a_common_line_is_dealt_out(spark, monkeypatch):
    """Its stretches are all of one anchor, with other words before or after; above ``HOT_STRETCHES`` no task gets them all."""
    monkeypatch.setattr(repeats, "HOT_STRETCHES", 20)
    docs = spark.createDataFrame(rows(150), "doc_id long, text string").select(F.coalesce("doc_id", F.lit(repeats.LAST_ID)).alias("id"), F.col("text").alias("t"))
    marks = repeats.shard_marks(repeats.entries(docs, 1)).toPandas()
    asked, hot = marks[marks["mask"] == repeats.ASK], marks[marks["mask"] == repeats.HOT]
    assert len(hot) and hot["id"].max() > 50
    asks = spark.createDataFrame(asked[["id", "key"]]).groupBy("id").agg(F.collect_list("key").alias("ask"))
    anchors = np.sort(hot["key"].to_numpy().view(np.uint64))
    sent = repeats.asked_bytes(docs.join(asks, "id"), 1, anchors, 8).toPandas()
    whole = sent[sent["offset"] >= 0]
    assert whole.groupby("anchor").size().max() <= 20
    dealt = sent[sent["offset"] == repeats.DEALT]
    strings = {s: sum(len(repeats.unpacked_strings(bytes(x))[0]) for x in rows["bytes"]) for s, rows in dealt.groupby("shard")}
    assert len(strings) == 8 and max(strings.values()) < 3 * sum(strings.values()) / 8


@pytest.mark.parametrize("n", [1, 2, 300])
def test_packed_entries_and_strings(n):
    rng = np.random.default_rng(n)
    doc = np.sort(rng.integers(-5, 1 << 62, n) // 3 * 3)
    doc[n // 2:] = repeats.LAST_ID
    anchor, key, sketch = (rng.integers(0, 1 << 64, n, dtype=np.uint64) for _ in range(3))
    key, number = key & repeats.HIGH48, rng.integers(0, 35, n)
    for x, y in zip(repeats.unpacked(repeats.packed(doc, anchor, key)), (doc, anchor, key)):
        assert len(x) == n and (x == y).all()
    for x, y in zip(repeats.unpacked_strings(repeats.packed_strings(doc, key, number, sketch)), (doc, key, number, sketch)):
        assert len(x) == n and (x == y).all()
