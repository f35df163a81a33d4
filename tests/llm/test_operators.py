"""The text operators against brute force, on small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import components, decontamination, lm_scoring, near_dedup, packing, quality_rules, queries, repeats, sharding, token_counts, toxicity
from strata.llm.common import runs

SF = "/root/testdata/sf0.001"
EXTRA = "text string, doc_id long, n_words long, score string, kept string, component_id long, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows(spark):
    """Texts of the given table among odd ones: null, empty, blanks, one word, no spaces, long, equal rows, cut characters."""
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(150).collect()]
    long = " ".join(f"w{i % 977}x" for i in range(30_000))
    odd = [(1000, None), (1001, ""), (1002, " \t\n\x0b"), (1003, "Word"), (1004, "ab" * 3000), (1005, long), (1006, long), (1006, long),
           (1007, "é" * 80), (1008, "xé" + "é" * 79), (1009, "a b c d e f g h i j k l m n o p"), (1010, "A B C D E F G H I J K L M N O P"),
           (1011, given[3][1] + " tail"), (1012, "the \x00 nul� and \U0001f600 emoji <|endoftext|> it's x'S. a### b!! (c) d.,e"), (None, given[5][1])]
    return given + odd


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(t, i, 7, "x", None, 5, "en", "src0", None) for i, t in rows], EXTRA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], EXTRA)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def lower(b):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in b)


def by_row(df, *cols):
    return sorted(((r.doc_id if r.doc_id is not None else -1, *(r[c] for c in cols)) for r in df.collect()), key=repr)


def expected(rows, of):
    return sorted(((i if i is not None else -1, *of(i, t)) for i, t in rows), key=repr)


def test_runs_keep_order_and_budget():
    assert list(runs([3, 3, 3, 9, 1], 6)) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert list(runs([], 6)) == []


def test_repeats(spark, docs, empty, rows):
    texts = sorted(((1 << 62 if i is None else i), (t or "").encode()) for i, t in rows)
    first = {}
    for i, b in texts:
        for k in range(len(b) - 49):
            first.setdefault(b[k:k + 50], i)

    def of(i, t):
        b, i = (t or "").encode(), 1 << 62 if i is None else i
        cover = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < i:
                cover[k:k + 50] = b"\1" * 50
        return len(b), sum(cover), len([x for x in bytes(cover).split(b"\0") if x]), bytes(c for c, x in zip(b, cover) if not x)

    got = repeats.remove_repeats(docs).withColumn("kept", F.col("kept"))
    assert by_row(got, "n_bytes", "n_removed", "n_spans", "kept") == expected(rows, of)
    assert repeats.remove_repeats(empty).count() == 0


def test_stretches_depend_on_strings_alone():
    rng = np.random.default_rng(0)
    common = bytes(rng.integers(97, 101, 300, dtype=np.uint8))
    for left, right in ((b"", b""), (b"zz" * 40, b"q"), (b"a" * 7, b"b" * 90)):
        s = repeats.Stretches([left + common + right])
        text = left + common + right
        assert sum(z - a + 1 for a, z in zip(s.first, s.last)) == len(text) - 49
        at = {text[k:k + 50]: int(h) for a, z, h in zip(s.first, s.last, s.anchor) for k in range(a, z + 1)}
        plain = repeats.Stretches([common])
        for a, z, h in zip(plain.first, plain.last, plain.anchor):
            for k in range(a, z + 1):
                assert at[common[k:k + 50]] == int(h)


def test_sharding(spark, docs, empty):
    shards = [f"s{i}" for i in range(7)]
    owner = sharding.lookup_table(shards, 1009)
    size = Counter(owner)
    assert max(size.values()) - min(size.values()) <= 1
    walks = [sharding.preference(s, 1009) for s in shards]  # by the definition, one claim at a time
    table, nxt, turn = {}, [0] * 7, 0
    while len(table) < 1009:
        i = turn % 7
        while (slot := (walks[i][0] + nxt[i] * walks[i][1]) % 1009) in table:
            nxt[i] += 1
        table[slot] = i
        turn += 1
    assert [table[s] for s in range(1009)] == owner
    fewer = sharding.lookup_table(shards[:-1], 1009)
    assert sum(a != b for a, b in zip(owner, fewer)) < 0.35 * 1009
    assert Counter(sharding.lookup_table(["a", "b"], 1009, [3, 1]))[0] > 700
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, 1000)
    got = sharding.place(docs, "doc_id", shards, 1009)
    for r in got.select("doc_id", "slot", "shard").collect():
        key = "\\N" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:12], 16) % 1009
        assert (r.slot, r.shard) == (slot, shards[owner[slot]])
    assert got.count() == docs.count() and sharding.place(empty, "doc_id", shards, 1009).count() == 0
    with pytest.raises(ValueError):
        sharding.place(docs, "doc_id", shards, 1009, slot_name="lang")


def test_token_counts(spark, docs, empty, rows):
    path = queries.vocabulary_file("piece_bpe_32k.model")
    pieces = set(token_counts.vocabulary(path))
    longest = max(map(len, pieces))

    def greedy(word):
        n = b = at = 0
        while at < len(word):
            for k in range(min(longest, len(word) - at), 0, -1):
                if word[at:at + k] in pieces:
                    n, at = n + 1, at + k
                    break
            else:
                n, b, at = n + len(word[at].encode()), b + len(word[at].encode()), at + 1
        return n, b

    def of(i, t):
        found = [greedy("▁" + w.decode()) for w in words(t)]
        return len(found), sum(x for x, _ in found), sum(x for _, x in found)

    assert by_row(token_counts.token_counts(docs, path), "n_words", "n_tokens", "n_fallback") == expected(rows, of)
    assert token_counts.token_counts(empty, path).count() == 0


def test_automaton_on_nested_pieces():
    trie = token_counts.automaton(["a", "ab", "abcd", "bc", "cde", "▁", "▁a"])
    assert token_counts.count_word("▁abcdx", trie) == (1 + 1 + 1 + 1, 1 + 1)  # ▁a bc d(byte) x(byte)
    assert token_counts.count_word("abc", trie) == (2, 1)


def test_quality_rules(spark, docs, empty, rows):
    def of(i, t):
        ws, text = words(t), (t or "").encode()
        windows = Counter(tuple(ws[k:k + 5]) for k in range(len(ws) - 4))
        again = {k + j for k in range(len(ws) - 4) if windows[tuple(ws[k:k + 5])] > 1 for j in range(5)}
        lines = [x for x in text.split(b"\n") if words(x.decode())]
        failed = len(ws) < 10 or 100 * len(again) > 20 * len(ws)
        return len(ws), sum(len(w.decode()) for w in ws), sum(text.count(bytes([c])) for c in b"#*$%&|<>"), len(lines) - len(set(lines)), len(again), failed

    got = quality_rules.quality_rules(docs)
    assert by_row(got, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == expected(rows, of)
    assert got.where("base_failed and kept").count() == 0 and quality_rules.quality_rules(empty).count() == 0
    for n in (7, 10):
        share = {(r.doc_id, r[f"dup_{n}gram_chars"]) for r in got.collect()}
        for i, t in rows:
            ws = words(t)
            c = Counter(tuple(ws[k:k + n]) for k in range(len(ws) - n + 1))
            covered = {k + j for k in range(len(ws) - n + 1) if c[tuple(ws[k:k + n])] > 1 for j in range(n)}
            assert (i, sum(len(ws[k].decode()) for k in covered)) in share


def test_decontamination(spark, docs, empty, rows):
    item = [(1, rows[0][1][:200]), (2, rows[7][1][300:600]), (3, "Word"), (4, None), (5, "..."), (6, "a b c d e f g h i j k"), (6, "a b c d e f g h i j k"), (7, "nowhere to be seen at all in any of the texts here")]
    bench = spark.createDataFrame([(t, i, "x") for i, t in item], "text string, item_id long, spans string")
    pattern = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: pattern.findall(lower((t or "").encode()))
    windows = defaultdict(set)
    for i, t in item:
        w = split(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k:k + 10])].add(str(i))

    def of(i, t):
        w, hit, names = split(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit.update(range(k, k + size))
                    names |= windows[tuple(w[k:k + size])]
        return len(w), len(hit), sorted(names)

    for chars in (decontamination.PART_BYTES, 2500):  # one part, and several
        got = decontamination.find_contamination(docs, bench, part_bytes=chars).withColumn("hit", F.expr("aggregate(spans, 0L, (a, s) -> a + s.stop - s.start)"))
        assert by_row(got, "n_words", "hit", "items") == expected(rows, of)
    assert decontamination.find_contamination(empty, bench).count() == 0
    assert decontamination.find_contamination(docs, bench.limit(0)).where("size(spans) > 0").count() == 0
    cut = decontamination.find_contamination(docs, bench, cut=True).select("doc_id", F.col("cleaned").alias("text"))
    assert decontamination.find_contamination(cut, bench).where("size(spans) > 0").count() == 0


def test_fm_index_locates_every_occurrence():
    rng = np.random.default_rng(3)
    for top, n in ((1, 40), (3, 300), (200, 500)):
        text = rng.integers(1, top + 1, n)
        index = decontamination.FmIndex(text, top)
        for size in (1, 2, 5):
            pattern = text[7:7 + size]
            lo, hi = index.search(pattern[None, :], np.array([size]))
            at = sorted(index.locate(np.arange(lo[0], hi[0])).tolist())
            assert at == [k for k in range(n - size + 1) if (text[k:k + size] == pattern).all()]


def test_near_duplicates(spark, docs, empty, rows):
    def shingles(t):
        w = lower((t or "").encode()).split()
        return frozenset(zip(w, w[1:], w[2:], w[3:], w[4:])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    ids = [(i, shingles(t)) for i, t in rows]
    parent = {k: k for k in range(len(ids))}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(ids)):
        for b in range(a):
            x, y = ids[a][1], ids[b][1]
            if (x and y and 100 * len(x & y) >= 75 * len(x | y)) or (ids[a][0] == ids[b][0]):
                parent[find(a)] = find(b)
    low = defaultdict(list)
    for k, (i, _) in enumerate(ids):
        if i is not None:
            low[find(k)].append(i)
    want = sorted(((-1 if i is None else i, len(s), min(low[find(k)])) for k, (i, s) in enumerate(ids)), key=repr)
    got = near_dedup.near_duplicates(docs)
    assert by_row(got, "n_shingles", "component_id") == want
    assert got.where("kept <> (doc_id <=> component_id)").count() == 0 and near_dedup.near_duplicates(empty).count() == 0


def test_a_chain_of_links_is_one_component(spark):
    word = [f"w{i}" for i in range(400)]
    chain = [(i, " ".join(word[8 * i:8 * i + 100])) for i in range(30)]  # neighbours over 0.75, others under
    got = near_dedup.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string"))
    assert {r.component_id for r in got.collect()} == {0}


def test_register_collisions_follow_the_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 32, 3000, dtype=np.uint64).astype(np.uint32)
    factors = (near_dedup.draws(2048, 2) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    a, b = near_dedup.registers(x[:2000], factors), near_dedup.registers(x[500:2500], factors)  # Jaccard 0.6
    assert abs((a == b).mean() - 0.6) < 0.04
    assert (np.maximum(a, b) == near_dedup.registers(x[:2500], factors)).all()  # mergeable
    j = near_dedup.likeliest([2000], [2000], [(a > b).sum()], [(a < b).sum()], [(a == b).sum()])
    assert abs(j[0] - 0.6) < 0.04


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (5, 5), (20, 21), (21, 22), (22, 23), (23, 20), (None, 4)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 20: 20, 21: 20, 22: 20, 23: 20}
    tree = spark.createDataFrame([(9, 8), (8, 7), (7, 1), (6, 1), (3, 2)], "a long, b long")
    assert {r.id: r.component for r in components.roots(tree).collect()} == {9: 1, 8: 1, 7: 1, 6: 1, 1: 1, 3: 2, 2: 2}


def test_packing(spark, docs, empty, rows):
    from tokenizers import Tokenizer
    path = queries.vocabulary_file("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    ids = [(i, tok.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows]
    want = Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids)
    pieces = [r.asDict() for r in packing.pack(docs, path).collect()]
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
    sizes = Counter((i, len(x)) for i, x in ids)
    tokens = {(i, len(x)): np.array(x, "<u4") for i, x in ids}
    assert set(by_doc) == set(sizes) and len(want) == len(sizes)
    for key, parts in by_doc.items():
        starts = Counter((p["start"], p["length"]) for p in parts)
        assert set(starts.values()) == {sizes[key]}
        at = 0
        for start, length in sorted(starts):
            assert start == at
            at += length
        assert at == key[1]
        for p in parts:
            assert zlib.crc32(tokens[key][p["start"]:p["start"] + p["length"]].tobytes()) == p["ids_crc32"]
    fill = defaultdict(list)
    for p in pieces:
        fill[p["sequence_id"]].append((p["offset"], p["length"]))
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    assert sum(p["length"] for p in pieces) / (4096 * len(fill)) > 0.9
    assert packing.pack(empty, path).count() == 0


def test_differencing_balances_and_raises_the_window_count():
    assert sorted(np.bincount(packing.differencing(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])) == [14, 16]
    sizes = np.array([3000] * 4 + [100])
    label = packing.pack_block(sizes, 4096)  # 12,100 tokens fit 3 windows by sum, but not as pieces
    assert len(set(label)) == 4 and np.bincount(label, weights=sizes).max() <= 4096


def test_toxicity(spark):
    rng = np.random.default_rng(5)
    texts, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        body = [f"word{k}" for k in rng.integers(0, 60, 30)]
        if bad:
            body[3] = ["nasty", "vile"][i // 4 % 2]
        if rng.random() < (0.9 if bad else 0.1):  # the group is named in most toxic texts
            body[7] = "Muslim"
        texts.append((i, " ".join(body)))
        labels.append((i, int(bad)))
    texts += [(9000, None), (9001, ""), (9002, "A Muslim walked home."), (9003, "a muslim, vile"), (9003, "a muslim, vile")]
    docs = spark.createDataFrame([(t, i, 3) for i, t in texts], "text string, doc_id long, score long")
    lab = spark.createDataFrame([*labels, (9001, None), (None, 1), (0, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, lab)
    at = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in at.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in at.items())
    assert np.mean([at[i].predicted == y for i, y in labels if at[i].held_out]) > 0.97
    assert at[9002].predicted == 0 and at[9003].predicted == 1 and at[9000].predicted == 0
    free, bound = (toxicity.fit([(1, [0, 1], [0]), (0, [], []), (1, [0, 1], [0]), (0, [2], [2])], 3, p) for p in (0.0, 50.0))
    assert abs(bound[0][1]) < 0.5 * abs(free[0][1])  # the group's weight shrinks
    assert toxicity.toxicity(docs, lab.limit(0)).count() == len(texts) and toxicity.toxicity(docs.limit(0), lab).count() == 0


def test_toxicity_on_given_labels(spark):
    d = "/root/testdata/sf0.01"
    got = queries.op10_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out")
    right = got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double"))).first()[0]
    assert right > 0.95


def test_pseudo_likelihood(spark, docs, empty, rows):
    table, net = lm_scoring.train(docs)
    symbols = lm_scoring.reader(table)
    got = {r.doc_id: r for r in lm_scoring.pseudo_likelihood(docs).collect()}
    for i, t in rows[:20] + rows[-15:-5]:
        s = [int(x) for x in symbols((t or "").encode())]
        total = 0.0
        padded = [lm_scoring.SYMBOLS] * 2 + s + [lm_scoring.SYMBOLS] * 2
        for k, target in enumerate(s):
            x = np.concatenate([net["embed"][padded[k + 2 + o]] for o in (-2, -1, 1, 2)])
            h = np.maximum(x @ net["hidden"] + net["hidden_bias"], 0)
            c = h @ net["class"] + net["class_bias"]
            m = h @ net["member"] + net["member_bias"][target // 32]
            total += c[target // 32] - np.log(np.exp(c).sum()) + m[target % 32] - np.log(np.exp(m).sum())
        assert got[i].n_tokens == len(s) and got[i].pll == pytest.approx(total, rel=1e-3, abs=1e-2)
        assert (got[i].mean_logp is None) == (not s)
    assert lm_scoring.pseudo_likelihood(empty).count() == 0


def test_gradient_and_learning():
    rng = np.random.default_rng(2)
    counts = np.ones(lm_scoring.BUCKETS)
    net = {k: v.astype(float) for k, v in lm_scoring.initial(counts).items()}
    target, context, _ = lm_scoring.contexts([np.tile(rng.permutation(50), 40)])
    g = lm_scoring.gradient(net, context[:200], target[:200])
    for k, at in (("hidden", (3, 4)), ("class", (1, 2)), ("member_bias", (0, 7)), ("embed", (int(target[0]), 2))):
        up, down = ({**net, k: net[k].copy()} for _ in range(2))
        up[k][at] += 1e-4
        down[k][at] -= 1e-4
        loss = lambda n: -lm_scoring.forward(n, context[:200], target[:200])[0].mean()
        assert g[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-4, rel=1e-3, abs=1e-7)
    trainer = lm_scoring.Trainer({k: v.astype(np.float32) for k, v in net.items()})
    before = lm_scoring.forward(trainer.net, context, target)[0].mean()
    for _ in range(60):
        trainer.learn(context, target)
    assert lm_scoring.forward(trainer.net, context, target)[0].mean() > before + 1


def test_every_token_is_a_training_target(spark):
    """Eight words in turn: the next word is certain, but only for a network that had each of them as a target."""
    seqs = [np.arange(n) + 100 * n for n in (0, 1, 2, 7)]
    met = np.concatenate([lm_scoring.contexts(seqs, r, 3)[0] for r in range(3)])
    assert sorted(met) == sorted(np.concatenate(seqs))
    base = spark.createDataFrame([(i, " ".join(f"x{k % 8}" for k in range(8_000))) for i in range(100)], "doc_id long, text string").coalesce(1)
    got = [r.mean_logp for r in lm_scoring.pseudo_likelihood(base).collect()]
    assert min(got) > np.log(1 / 8) + 0.5


def test_context_predicts_held_out_texts_and_partitions_agree(spark):
    """0.05 nats a token better than word frequencies on texts that weren't learned from, with 1 or 16 partitions alike."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    learned = rows.where("doc_id % 5 <> 0")
    held = [(r.text or "").encode() for r in rows.where("doc_id % 5 = 0").collect()]
    means = []
    for n in (1, 16):
        parts = learned.repartition(n)
        counts = lm_scoring.bucket_counts(lm_scoring.word_counts(parts))
        table, net = lm_scoring.train(parts, counts=counts)
        seqs = [lm_scoring.reader(table)(t) for t in held]
        tokens = sum(map(len, seqs))
        plain = lm_scoring.score_symbols(seqs, lm_scoring.initial(counts)).sum() / tokens
        scores = lm_scoring.score_symbols(seqs, net)
        assert scores.sum() / tokens > plain + 0.05
        means.append(np.array([x / len(s) for x, s in zip(scores, seqs) if len(s)]))
    assert np.abs(means[0] - means[1]).max() < 1e-9


def test_every_word_has_its_own_probability(spark, docs, empty, rows, tmp_path):
    """The score is that of the symbols plus, for each token, the log of the word's share of its symbol."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    table, _ = lm_scoring.train(given)
    symbol = lm_scoring.reader(table)
    count = Counter(w for _, t in rows for w in (t or "").encode().split())
    mass = Counter()
    for w, n in count.items():
        mass[int(symbol(w)[0])] += n
    share = {w: np.log(n / mass[int(symbol(w)[0])]) for w, n in count.items()}
    by_symbol = {r.doc_id: r.pll for r in lm_scoring.pseudo_likelihood(given).collect()}
    text = dict(rows)
    for got in (queries.op1_pseudo_likelihood(spark, str(tmp_path)).collect(), lm_scoring.word_pseudo_likelihood(given, frequent=50).collect()):
        assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
        for r in got:
            own = (text[r.doc_id] or "").encode().split()
            assert r.n_tokens == len(own) and r.pll == pytest.approx(by_symbol[r.doc_id] + sum(share[w] for w in own), rel=1e-6, abs=1e-3)
            assert (r.mean_logp is None) == (not own)
        assert len({r.pll for r in got if r.doc_id in (1005, 1006)}) == 1
    assert lm_scoring.word_pseudo_likelihood(empty).count() == 0


def test_words_are_split_and_numbered_as_bytes_split_does():
    texts = [b"", b" ", b"  a b\tc\x0bd\x0ce\r\nf \x1cg\x1dh\x85i\xc2\xa0j  ", b"\xff\xfe x\x80y z", "é ü  w\u3000q a".encode(), b"a", None, b"\x00 \x00b a ", b"\x1f"]
    raw = pa.array(texts, pa.binary())
    given = pa.Array.from_buffers(pa.string(), len(raw), raw.buffers())
    for i in range(len(texts)):
        for n in range(len(texts) - i + 1):
            sizes, at, words = lm_scoring.split_words(given.slice(i, n))
            named = lm_scoring.as_bytes(words)
            want = [(t or b"").split() for t in texts[i:i + n]]
            assert sizes.tolist() == [len(w) for w in want] and [named[k] for k in at] == [w for own in want for w in own]
            assert len(set(named)) == len(named)


def test_word_counts_in_parts(spark, docs, rows):
    want = Counter(w for _, t in rows for w in (t or "").encode().split())
    for cache in (1, 300_000):
        assert {bytes(r.word): r.n for r in lm_scoring.word_counts(docs, cache_words=cache).collect()} == want


def test_scores_from_sums_of_each_symbol_are_those_of_the_whole_product():
    """On the grid both ways add up exactly; steps over one vector of weights are those over each array."""
    rng = np.random.default_rng(4)
    seqs = [rng.integers(0, lm_scoring.SYMBOLS, n) for n in (0, 1, 3, 5000)]
    net = lm_scoring.on_grid(lm_scoring.initial(rng.integers(1, 1000, lm_scoring.BUCKETS)))
    target, context, of = lm_scoring.contexts(seqs)
    h = np.maximum(net["embed"][context].reshape(len(context), -1) @ net["hidden"] + net["hidden_bias"], 0)
    h = np.round(h * lm_scoring.GRID) / lm_scoring.GRID
    c, m, at = target // lm_scoring.SIDE, target % lm_scoring.SIDE, np.arange(len(target))
    logp = sum(lm_scoring.softmax(np.ascontiguousarray(z.T), k, at)[0]
               for z, k in ((h @ net["class"] + net["class_bias"], c), (h @ net["member"] + net["member_bias"][c], m)))
    want = np.bincount(of, np.round(logp * np.float64(lm_scoring.SCALE)), len(seqs)) / lm_scoring.SCALE
    assert (lm_scoring.score_symbols(seqs, net) == want).all()
    trainer = lm_scoring.Trainer(net)
    trainer.learn(context, target)
    assert (lm_scoring.pack_net(trainer.net) == trainer.flat).all() and (trainer.flat != lm_scoring.pack_net(net)).any()


def test_rare_words_are_joined_without_a_sort(spark, docs):
    """The rows of all texts and rare words meet a table of words that are there once: these are hashed, nothing is sorted."""
    plan = lm_scoring.word_pseudo_likelihood(docs, frequent=50)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_prefix_pairs_lose_no_link(spark):
    """Members of one crowded bucket: a long common passage, endings of their own, some of them nearly equal."""
    rng = np.random.default_rng(5)
    common = " ".join(f"c{i}" for i in range(80))
    rows = [(i, f"{common} " + " ".join(f"w{rng.integers(0, 30) if i % 3 else i}x{k}" for k in range(rng.integers(5, 60)))) for i in range(120)]
    rows += [(900, None), (901, ""), (902, "one two")]
    base = spark.createDataFrame(rows, "id long, t string")
    left = base.select("id", F.col("id").alias("component"))
    got = {tuple(r) for r in near_dedup.prefix_pairs(base, left, 75, 5).collect()}
    sets = {i: near_dedup.shingle_set((t or "").encode()) for i, t in rows}
    links = {(a, b) for a, x in sets.items() for b, y in sets.items() if b < a and x and y and 100 * len(x & y) >= 75 * len(x | y)}
    assert links and links <= got
    assert near_dedup.prefix_pairs(base.limit(0), left.limit(0), 75, 5).count() == 0


def test_prefix_pairs_of_a_crowd_stay_few(spark):
    """300 near copies in one component and 40 texts that share half of it: no pair is formed at what all have in common."""
    base = [f"c{i}" for i in range(120)]
    rows = [(i, " ".join([*base[:60], f"own{i}", *base[61:]])) for i in range(300)]
    rows += [(1000 + i, " ".join(base[:64] + [f"x{i}y{k}" for k in range(56)])) for i in range(40)]
    docs = spark.createDataFrame(rows, "id long, t string")
    left = docs.select("id", F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id")).alias("component"))
    assert near_dedup.prefix_pairs(docs, left, 75, 5).count() < 340
    got = near_dedup.near_duplicates(docs, id_col="id", text_col="t")
    assert {r.component_id for r in got.collect()} == {0, *range(1000, 1040)}


def test_toxicity_scores_where_the_package_is_not_importable(spark):
    """What the scoring function carries to the workers unpickles without this library."""
    import subprocess
    import sys
    from pyspark import cloudpickle
    from pyspark.serializers import CPickleSerializer
    model = toxicity.Model({"=bad": 0, "bad": 1}, np.array([2.0, 1.0]), -1.0)
    plain = CPickleSerializer().dumps((model.features, model.weights, model.bias))
    made = cloudpickle.dumps(lambda: toxicity.Model({"=bad": 0, "bad": 1}, np.array([2.0, 1.0]), -1.0).scorer()([b"bad", b"good"]))
    code = f"import pickle\npickle.loads({plain!r})\nprint(pickle.loads({made!r})())"
    out = subprocess.run([sys.executable, "-c", code], cwd="/", env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    a, b = eval(out.stdout)
    assert abs(a - 1 / (1 + np.exp(-2.0))) < 1e-12 and abs(b - 1 / (1 + np.exp(1.0))) < 1e-12


def test_quality_verdict_rejects_what_the_base_rule_passes(spark):
    """Repeats of long words: few words, many characters. Each limit is met by one text alone."""
    short = " ".join(f"w{i}" for i in range(300))
    five = " ".join(f"extraordinarily{i}long{k}" for i in range(1) for k in range(5))
    seven, ten = (" ".join(f"immeasurable{k}word" for k in range(n)) for n in (7, 10))
    line = "unquestionably incomprehensible internationalisation"
    texts = {"clean": short, "five": " ".join([five, short, five]), "seven": " ".join([seven, short, seven]), "ten": " ".join([ten, short, ten]),
             "line": "\n".join([line, short, line, line, line, line, line, line, line])}
    df = spark.createDataFrame([(k, v) for k, v in texts.items()], "doc_id string, text string")
    got = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {k for k, r in got.items() if not r.kept} == {"five", "seven", "ten", "line"}
    for k, r in got.items():
        chars = r.word_chars
        over = [r.dup_5gram_chars > 0.15 * chars, r.dup_7gram_chars > 0.13 * chars, r.dup_10gram_chars > 0.10 * chars, r.dup_line_chars > 0.20 * chars]
        assert any(over) == (not r.kept), k
    loose = quality_rules.quality_rules(df, limits={5: 1.0}, line_limit=1.0)
    assert all(r.kept for r in loose.collect())
