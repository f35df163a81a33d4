"""Language identification, collocations and centroid clustering against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import centroids, collocations, language_id, queries

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
EXTRA = "text string, doc_id long, lang string, n long, w1 string, score string, m int, f int, source string"


@pytest.fixture(scope="module")
def rows(spark):
    given = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    long = " ".join(f"w{i % 91}x" + ("." if i % 17 == 0 else "") for i in range(30_000))
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, " \t\n\x0b", None), (1003, "Word", "en"), (1004, "ab" * 3000, "de"), (1005, long, "en"), (1006, long, None),
           (1006, long, None), (1007, "é" * 80, "fr"), (1008, "a b " * 40, "x y"), (1009, "A\x1cB a\x1cb a b, A\x1cB a\x1cb! " * 12, "und"), (1010, "1234 5678 ###", "es"),
           (1011, "la la la la la la la la la la la la la", "fr"), (1012, "nul \x00 and \U0001f600 emoji � it's", "en"), (None, given[5][1], "en"), (1013, "İİ ǅ ß", "")]
    return given + odd


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(t, i, lang, 1, "x", "y", 2, None, "s") for i, t, lang in rows], EXTRA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], EXTRA)


# -- collocations ------------------------------------------------------------------------------

def plain_collocations(rows, width=3, least=10, share=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, width + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        dropped = {p[i:i + m] for p, longer in cand.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * longer >= share * c[p[i:i + m]]}
        scored = []
        for p, a in cand.items():
            if p not in dropped:
                score, k = min((10 ** 6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, lf, r, n[lang], -s) for i, (s, a, p, lf, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def test_collocations(docs, empty, rows):
    got = sorted(tuple(r) for r in collocations.collocations(docs).collect())
    assert got == plain_collocations(rows) and len(got) > 50
    assert collocations.collocations(docs, top=3).count() == sum(min(3, n) for n in Counter(r[0] for r in got).values())
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(docs, least=10 ** 9).count() == 0


@pytest.mark.parametrize("width,block", [(2, 50), (3, 37), (5, 1000)])
def test_collocations_in_small_blocks(docs, rows, width, block, monkeypatch):
    """Blocks that end inside texts, windows of other widths, and hot words and pairs."""
    monkeypatch.setattr(collocations, "TEXT_BUDGET", 64)
    some = [r for r in rows if r[0] is None or r[0] >= 1000 or r[0] < 40]
    hot = {"en": [(b"w1x",), (b"w2x", b"w3x"), (b"absent",)], "und": [(b"w5x",), (b"w5x", b"w6x")]}
    monkeypatch.setattr(collocations, "hot_prefixes", lambda *a: hot)
    part = docs.where("doc_id is null or doc_id >= 1000 or doc_id < 40")
    inner = part.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").alias("t"))
    got = {(r.lang, r.m, r.phrase): r.f for r in collocations.phrase_counts(inner, width, 10, block).collect()}
    want = Counter()
    for _, text, lang in some:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            want.update((lang, m, " ".join(w[i:i + m])) for m in range(1, width + 1) for i in range(len(w) - m + 1))
            want.update({(lang, 0, ""): len(w)} if w else {})
    assert got == {k: v for k, v in want.items() if v >= 10 or k[1] == 0}


def test_hot_prefixes_are_found(spark):
    text = " ".join(f"of the w{i}" for i in range(3000))
    docs = spark.createDataFrame([("en", f"{text} {i}") for i in range(200)], "lang string, t string")
    assert {(b"of",), (b"the",), (b"of", b"the")} <= set(collocations.hot_prefixes(docs)["en"])


def test_collocation_and_centroid_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name in ("op12_collocations", "op13_centroids"):
        df, rel = queries.QUERIES[name](spark, SF), con.execute(queries.SQL[name])
        assert df.columns == [x[0] for x in rel.description]
        assert sorted(tuple(r) for r in df.collect()) == sorted(rel.fetchall())


# -- centroids ---------------------------------------------------------------------------------

def plain_clusters(vectors, k, rounds, scale, seed, dims):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "~"
    cents = [v for i, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min((d2(v, c), n) for n, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        to = assign()
        cents = [[sum(col) // len(m) for col in zip(*m)] if (m := [v for (_, v), (_, c) in zip(kept, to) if c == n]) else old for n, old in enumerate(cents)]
    to = assign()
    per = Counter()
    for dist, c in to:
        per[c] += dist
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, dist, per[c], sum(per.values()), sha[c]) for (i, _), (dist, c) in zip(kept, to)), key=repr)


def test_centroids(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in rng.normal(i % 5, 0.3, 4)]) for i in range(300)]
    vectors += [(300, [0.0] * 4), (301, [0.0] * 4), (301, [0.0] * 4), (302, None), (303, []), (304, [1.0, None, 0.0, 0.0]), (305, [float("nan")] * 4), (306, [float("inf")] + [0.0] * 3),
                (307, [1.0] * 5), (None, [2.0, 2.0, -3.0, 0.5]), (308, [-0.001, 0.001, -4.7, 100.0]), (309, [90000.0, -90000.0, 0.0, 1.0])]
    schema = "cluster string, vec_id long, embedding array<double>, id int, q string"
    df = spark.createDataFrame([("x", i, v, 1, "y") for i, v in vectors], schema)
    for k, rounds in ((8, 10), (3, 2), (1, 1)):
        got = centroids.centroid_clusters(df, dims=4, clusters=k, rounds=rounds)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_clusters(vectors, k, rounds, 1024, 3, 4)
    few = df.where("vec_id in (300, 301, 5)")
    assert sorted((tuple(r) for r in centroids.centroid_clusters(few, dims=4).collect()), key=repr) == plain_clusters([v for v in vectors if v[0] in (300, 301, 5)], 8, 10, 1024, 3, 4)
    assert centroids.centroid_clusters(df.limit(0), dims=4).collect() == []
    with pytest.raises(Exception, match="too large"):
        centroids.centroid_clusters(spark.createDataFrame([("x", 1, [1e30] * 4, 1, "y")], schema), dims=4)


def test_threshold_walk_is_exact_and_stops_early():
    rng = np.random.default_rng(4)
    x, c = rng.integers(-3, 4, (500, 3)), rng.integers(-3, 4, (40, 3))  # many ties
    best, dist, _ = centroids.nearest(x, c)
    all_ = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (best == all_.argmin(1)).all() and (dist == all_.min(1)).all()
    big = x.astype(object) * 10 ** 25
    assert (centroids.nearest(big, c.astype(object) * 10 ** 25)[0] == best).all()
    line = np.sort(rng.integers(0, 10 ** 6, (1000, 1)), 0)
    _, _, taken = centroids.nearest(rng.integers(0, 10 ** 6, (200, 1)), line)
    assert taken < 200 * 10  # of 200 x 1000


# -- languages ---------------------------------------------------------------------------------

def plain_grams(text, order):
    x = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in (text or "").lower() + " ")).lstrip(" ")
    return [(" " * order + x)[i + 1:i + 1 + order] for i in range(len(x))] if x else []


class PlainModel:
    def __init__(self, counts, order, alphabet):
        self.order, self.alphabet, self.c, self.d = order, alphabet, {order: counts}, {}
        for n in range(order - 1, 0, -1):
            self.c[n] = Counter(g[1:] for g in self.c[n + 1])
        for n, c in self.c.items():
            one, two = (sum(v == k for v in c.values()) for k in (1, 2))
            self.d[n] = min(max(one / (one + 2 * two), 0.1), 0.9) if one else 0.1

    def p(self, gram):
        n = len(gram)
        if not n:
            return 1 / self.alphabet
        after = [v for g, v in self.c[n].items() if g[:-1] == gram[:-1]]
        if not after:
            return self.p(gram[1:])
        return max(self.c[n].get(gram, 0) - self.d[n], 0) / sum(after) + self.d[n] * len(after) / sum(after) * self.p(gram[1:])


def test_kneser_ney_equals_plain_models_and_sums_to_one():
    texts = {"a": ["The cat. the CAT sat", "on the mat", "x"], "b": ["le chat 1 était là", "le tapis", "été"]}
    letters, order = language_id.letter_table(), 3
    counts = {k: Counter(g for t in v for g in plain_grams(t, order)) for k, v in texts.items()}
    codes = {k: (np.array([[ord(x) for x in g] for g in c], np.uint32), np.array(list(c.values()))) for k, c in counts.items()}
    for k, v in texts.items():
        got, _ = language_id.characters([t.encode() for t in v], letters, order)
        assert Counter("".join(map(chr, r)) for r in got) == counts[k]
    model = language_id.fitted(list(texts), [codes[k][0] for k in texts], [codes[k][1] for k in texts], order)
    alphabet = 1 + len({g[-1] for c in counts.values() for g in c})
    plain = [PlainModel(counts[k], order, alphabet) for k in texts]
    seen = sorted({g[-1] for c in counts.values() for g in c})
    for m in plain:
        for context in ("th", "zz", " c", "é"):
            assert abs(sum(m.p(context + c) for c in [*seen, "\0"]) - 1) < 1e-9
    probes = ["the chat", "zzz qqq", "été là-bas", "", "12", "é", "The cat sat on the mat"]
    n, bits = language_id.cross_entropies([t.encode() for t in probes], letters, model.tables, model.floor, 2)
    for i, t in enumerate(probes):
        grams = plain_grams(t, order)
        assert n[i] == len(grams)
        for k, m in enumerate(plain):
            assert not grams or abs(bits[i, k] + sum(math.log2(m.p(g)) for g in grams) / len(grams)) < 1e-4


def test_languages(spark, docs, empty, rows):
    got = language_id.languages(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text, _ in rows:
        r = by_id[i]
        assert r.held_out == (zlib.crc32(("" if i is None else str(i)).encode()) % 3 == 1)
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or "")) or "und" in {x for _, _, x in rows}
        assert 0 <= r.score <= 1 and (any(c.isalpha() for c in text or "") or (r.lang_pred, r.score, r.rejected, r.bits) == ("und", 0.0, True, None))
    again = {r.doc_id: r for r in language_id.languages(docs.select(*docs.columns[::-1]).repartition(5)).collect()}
    assert {i: r.lang_pred for i, r in again.items()} == {i: r.lang_pred for i, r in by_id.items()}
    assert language_id.languages(empty).count() == 0
    unlabelled = language_id.languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in unlabelled.collect()} == {("und", 0.0)}


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = queries.op11_language_id(spark, SF01).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 300 and sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got)
    model = language_id.train(docs)
    strange = spark.createDataFrame([(1, "Κύριε ελέησον " * 20), (2, "xqzj wvkq zzxq " * 20)], "doc_id long, text string")
    assert all(r.rejected for r in language_id.identify(strange, model, ["doc_id"]).collect())
    right = [r for r in got if r.lang_pred == r.lang]
    assert sum(r.rejected for r in right) <= 0.05 * len(right)
