"""Dedup and CDC semantics, order independence, replays, skew fixtures vs brute force."""

import hashlib
import random
from strata.session import work_path
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import cdc as C
from strata.operators.dedup import dedup_latest
from strata.operators.ordered import next_in_key, time_chunk
from strata.streaming import cdc_stream as CS
from tests.conftest import SF001


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_dedup_highest_sequence_wins(spark):
    df = spark.createDataFrame([(1, "velho", 1, 1), (1, "novo", 2, 2), (2, "unico", 1, 3)], "k int, v string, seq int, tb int")
    assert rows(dedup_latest(df, ["k"], "seq", "tb"), "k", "v") == [(1, "novo"), (2, "unico")]


def test_dedup_null_sequence_loses_and_tiebreak(spark):
    df = spark.createDataFrame([(1, "valido", 5, 1), (1, "sem_seq", None, 2), (9, "a", None, 1), (9, "b", None, 2)],
                               "k int, v string, seq int, tb int")
    assert rows(dedup_latest(df, ["k"], "seq", "tb"), "k", "v") == [(1, "valido"), (9, "a")]


def _feed(spark):
    t = datetime(2024, 1, 1)
    data = [  # key, op, minute, uf, event id
        (1, "INSERT", 0, "SP", 1), (1, "UPDATE", 10, "RJ", 2), (1, "DELETE", 20, "RJ", 3), (1, "INSERT", 30, "MG", 4),
        (2, "UPDATE", 5, "BA", 5),  # update of an unknown key inserts
        (3, "DELETE", 1, "SP", 6), (3, "INSERT", 2, "PR", 7),  # delete first
        (4, "INSERT", 3, "SP", 8), (4, "UPDATE", 50, "RS", 9), (4, "UPDATE", 40, "MG", 10),  # late event
        (4, "UPDATE", 50, "RS", 11),  # replayed event (same key and sequence)
    ]
    return spark.createDataFrame([(k, op, t + timedelta(minutes=m), uf, i) for k, op, m, uf, i in data],
                                 "k int, op string, ts timestamp_ntz, uf string, eid int")


def test_scd1_with_deletes_and_late_events(spark):
    out = C.scd1(_feed(spark), ["k"], "ts", "eid", delete_when="op = 'DELETE'", except_cols=("op",))
    assert rows(out, "k", "uf") == [(1, "MG"), (2, "BA"), (3, "PR"), (4, "RS")]


def test_scd2_versions_and_intervals(spark):
    h = C.scd2(_feed(spark), ["k"], "ts", "eid", delete_when="op = 'DELETE'", except_cols=("op",))
    got = rows(h, "k", "uf", C.START, C.END)
    t = datetime(2024, 1, 1)
    m = lambda x: t + timedelta(minutes=x)
    assert got == sorted([
        (1, "SP", m(0), m(10)), (1, "RJ", m(10), m(20)), (1, "MG", m(30), None),
        (2, "BA", m(5), None), (3, "PR", m(2), None),
        (4, "SP", m(3), m(40)), (4, "MG", m(40), m(50)), (4, "RS", m(50), None),
    ])
    # intervals never overlap within a key; exactly one open version for live keys
    cur = C.current_rows(h)
    assert cur.count() == 4 and cur.select("k").distinct().count() == 4


def test_scd2_track_collapses_repeats(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, "SP", t, 1), (1, "SP", t + timedelta(hours=1), 2), (1, "RJ", t + timedelta(hours=2), 3)],
                               "k int, uf string, ts timestamp_ntz, eid int")
    h = C.scd2(df, ["k"], "ts", "eid", track=["uf"])
    assert rows(h, "uf", C.END) == [("RJ", None), ("SP", t + timedelta(hours=2))]


def _split_batches(df, n, seed):
    rnd = random.Random(seed)
    tags = {r["event_id"]: rnd.randrange(n) for r in df.select("event_id").collect()}
    spark = df.sparkSession
    tag = spark.createDataFrame(list(tags.items()), "event_id bigint, batch int")
    tagged = df.join(F.broadcast(tag), "event_id")
    return [tagged.filter(F.col("batch") == i).drop("batch") for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_incremental_cdc_is_order_and_replay_independent(spark, seed):
    """Random micro-batches (each applied twice, in random order) give the batch answer."""
    from strata.plans import views as V
    feed = V.clientes_cdc(spark, SF001)
    batches = _split_batches(feed, 4, seed)
    random.Random(seed).shuffle(batches)
    s1, s2 = work_path(spark, "t-scd1"), work_path(spark, "t-scd2")
    f1 = CS.scd1_fold(["cliente_id"], "ts_evento", "event_id", s1, 4)
    f2 = CS.scd2_fold(["cliente_id"], "ts_evento", "event_id", s2, 4)
    bid = 0
    for b in batches:
        for _ in range(2):  # replay after a "crash"
            f1(b, bid)
            f2(b, bid)
            bid += 1
    cols = ["cliente_id", "uf", "email", "ts_evento"]
    inc1 = CS.scd1_current(spark, s1, "operacao = 'DELETE'")
    ref1 = C.scd1(feed, ["cliente_id"], "ts_evento", "event_id", delete_when="operacao = 'DELETE'")
    assert rows(inc1, *cols) == rows(ref1, *cols)
    inc2 = CS.scd2_history(spark, s2, ["cliente_id"], "ts_evento", "operacao = 'DELETE'")
    ref2 = C.scd2(feed, ["cliente_id"], "ts_evento", "event_id", delete_when="operacao = 'DELETE'")
    assert rows(inc2, *cols, C.END) == rows(ref2, *cols, C.END)


def _skewed_events(spark):
    """events with a third of all rows moved onto one user (a hot key)."""
    from strata.plans import views as V
    e = V.table(spark, SF001, "events")
    return e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


@pytest.mark.parametrize("width", ["1 hour", "1 day", "7 days"])
def test_chunked_lead_equals_plain_lead_on_hot_key(spark, width):
    e = _skewed_events(spark)
    ours = next_in_key(e, ["user_id"], ["ts"], "ts", "nxt", time_chunk(F.col("ts"), width))
    brute = e.withColumn("nxt", F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts")))
    assert rows(ours, "event_id", "nxt") == rows(brute, "event_id", "nxt")


def test_point_in_time_equals_interval_join_on_hot_key(spark):
    e = _skewed_events(spark)
    hist = (e.filter(F.col("event_type") != "purchase")
             .select("user_id", F.col("ts").alias(C.START), F.col("event_type").alias("kind")))
    hist = hist.withColumn(C.END, F.lead(C.START).over(Window.partitionBy("user_id").orderBy(C.START)))
    facts = e.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    ours = C.point_in_time(facts, hist, ["user_id"], "ts", chunk_width="1 hour")
    h = hist.alias("h")
    cond = ((F.col("f.user_id") == F.col("h.user_id")) & (F.col(f"h.{C.START}") <= F.col("f.ts")) &
            (F.col(f"h.{C.END}").isNull() | (F.col("f.ts") < F.col(f"h.{C.END}"))))
    brute = facts.alias("f").join(h, cond, "left").select("f.event_id", "h.kind")
    assert rows(ours, "event_id", "kind") == rows(brute, "event_id", "kind")


def test_upsert_second_run_is_noop(spark):
    from strata.plans import views as V
    t = V.snapshot_1(spark, SF001).withColumn("_at", F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"))
    s = V.snapshot_2(spark, SF001)
    first = C.upsert(t, s, ["c_custkey"], stamp_col="_at", stamp=datetime(2024, 1, 2))
    m1 = first.metrics().collect()[0]
    assert m1["num_inserted_rows"] > 0 and m1["num_updated_rows"] > 0
    m2 = C.upsert(first.table, s, ["c_custkey"], stamp_col="_at", stamp=datetime(2024, 1, 3)).metrics().collect()[0]
    assert (m2["num_inserted_rows"], m2["num_updated_rows"]) == (0, 0)


def test_merge_into_rewrites_only_touched_buckets(spark):
    from strata.operators import buckets as B
    from strata.plans import views as V
    path = work_path(spark, "t-merge")
    target = V.snapshot_1(spark, SF001).withColumn("_at", F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"))
    B.create_bucketed(target, path, ["c_custkey"], 8)

    def files():
        df = spark.read.parquet(path).select(B.BUCKET, F.col("_metadata.file_path").alias("f")).distinct()
        return {(r[B.BUCKET], r["f"]) for r in df.collect()}
    before = files()
    src = V.snapshot_2(spark, SF001).filter(F.col("c_custkey") == 5).withColumn("c_acctbal", F.lit(1.0))
    m = C.merge_into(spark, path, src, ["c_custkey"], 8, "one-key", stamp_col="_at", stamp=datetime(2024, 1, 2))
    assert m["num_updated_rows"] == 1 and m["num_inserted_rows"] == 0
    after = files()
    changed = {b for b, _ in before ^ after}
    assert len(changed) == 1  # one bucket folder rewritten, the other 7 untouched
    row = spark.read.parquet(path).filter("c_custkey = 5").collect()[0]
    assert row["c_acctbal"] == 1.0 and spark.read.parquet(path).count() == target.count()


def test_scd2_acceptance_on_customer_feed(spark):
    """Intervals never overlap per key, keys have several versions, staging > final."""
    from strata.plans import views as V
    from strata.plans.q_cdc import clientes_scd2, clientes_stg
    h = clientes_scd2(spark, SF001)
    w = Window.partitionBy("cliente_id").orderBy(C.START)
    bad = (h.withColumn("next_start", F.lead(C.START).over(w))
            .filter(F.col("next_start").isNotNull() & (F.col(C.END).isNull() | (F.col(C.END) > F.col("next_start")))))
    assert bad.count() == 0
    assert h.filter(F.col(C.END) <= F.col(C.START)).count() == 0
    per_key = h.groupBy("cliente_id").count()
    assert per_key.agg(F.max("count")).collect()[0][0] >= 2
    assert clientes_stg(spark, SF001).count() > C.current_rows(h).count()
    assert V.clientes_cdc(spark, SF001).count() > clientes_stg(spark, SF001).count()  # DROP removed rows


def test_auto_chunk_width_bounds_hot_keys(spark):
    from strata.operators.ordered import auto_chunk_width
    e = _skewed_events(spark)  # user 0 holds a third of the rows
    assert auto_chunk_width(e, ["user_id"], "ts", target_rows=10_000) == "1 day"
    w = auto_chunk_width(e, ["user_id"], "ts", target_rows=5)
    assert w.endswith("seconds") or w == "1 hour"
    ours = next_in_key(e, ["user_id"], ["ts"], "ts", "nxt", time_chunk(F.col("ts"), w))
    brute = e.withColumn("nxt", F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts")))
    assert rows(ours, "event_id", "nxt") == rows(brute, "event_id", "nxt")


def test_upsert_rejects_duplicate_source_keys(spark):
    from strata.plans import views as V
    t = V.snapshot_1(spark, SF001)
    s = V.snapshot_2(spark, SF001)
    dup = s.unionByName(s.filter("c_custkey = 5"))
    with pytest.raises(Exception, match="several source rows"):
        C.upsert(t, dup, ["c_custkey"]).table.count()
    assert C.upsert(t, s, ["c_custkey"]).table.count() > 0


def test_merge_into_casts_keys_clears_emptied_buckets_and_refuses_another_count(spark):
    from strata.operators.buckets import create_bucketed
    from strata.operators.cdc import merge_into
    from strata.session import work_path
    path = work_path(spark, "merge-types")
    create_bucketed(spark.range(100).selectExpr("id AS k", "id AS v"), path, ["k"], 16)
    few = spark.range(98, 103).selectExpr("CAST(id AS INT) AS k", "-id AS v")
    got = merge_into(spark, path, few, ["k"], 16, "a")
    assert (got["num_inserted_rows"], got["num_updated_rows"]) == (3, 2)
    assert spark.read.parquet(path).select("k").distinct().count() == spark.read.parquet(path).count() == 103
    with pytest.raises(ValueError):
        merge_into(spark, path, few, ["k"], 8, "b")
    got = merge_into(spark, path, few.where("k = 100"), ["k"], 16, "c", delete_missing=True)
    assert got["num_deleted_rows"] == 102 and [r.k for r in spark.read.parquet(path).collect()] == [100]


def test_row_filter_sees_values_before_the_mask(spark):
    from strata.operators.privacy import Principal, apply_policy
    df = spark.createDataFrame([("SP", 1), ("RJ", 2)], "uf string, v int")
    policy = {"columns": {"uf": {"method": "hash", "salt": "s"}}, "row_filters": [{"predicate": "uf = 'SP'"}]}
    assert [r.v for r in apply_policy(df, policy, Principal("ana", frozenset())).collect()] == [1]


def test_mean_of_sums_past_2_to_the_53_is_exact(spark):
    from strata.functions.money import _half_up_div
    from pyspark.sql import functions as F
    nums = [(2 ** 53 + 2 * k + 1, 7 + k) for k in range(2000)] + [(-(2 ** 60 + 5), 2), (9, 2), (0, 3)]
    for r in spark.createDataFrame(nums, "a long, b long").select("a", "b", _half_up_div(F.col("a"), F.col("b")).alias("q")).collect():
        q, rest = divmod(abs(r.a), r.b)
        q += 2 * rest >= r.b
        assert r.q == (q if r.a >= 0 else -q)


def _files_of(spark, path):
    from strata.operators.stored import data_files
    return {f for f in data_files(spark, path)}


def test_log_state_writes_what_the_batch_holds_and_merges_on_read(spark):
    """Deltas follow the batch, late and replayed rows merge, compaction keeps the rows and drops what it merged."""
    from strata.session import input_bytes
    from strata.streaming.log_state import LogState
    st = LogState(work_path(spark, "t-log"), ["k"], "seq", ["tie"], 4)
    mk = lambda rows: spark.createDataFrame(rows, "k long, seq long, tie int, v string")
    text = lambda i: hashlib.sha256(str(i).encode()).hexdigest()
    first = mk([(i, 10, 0, text(i)) for i in range(5000)])
    st.fold()(first, 0)
    assert not st.compact_if_due(spark)  # one delta alone is as good as a base
    st.compact(spark)
    base = input_bytes(spark, [f"{st.path}/base/0"])
    small = [mk([(7, 11, 0, "new"), (9, 5, 0, "late"), (10 ** 6, 1, 0, "more")]), mk([(7, 11, 1, "tie loses"), (8, None, 0, "null loses")])]
    for n, b in enumerate(small, 1):
        for _ in range(2):  # replayed
            st.fold()(b, n)
    deltas = [f for f in _files_of(spark, st.path) if "/delta/" in f]
    assert deltas and input_bytes(spark, deltas) < base / 4 and input_bytes(spark, [f"{st.path}/base/0"]) == base
    want = {i: text(i) for i in range(5000)} | {7: "new", 10 ** 6: "more"}
    assert {r.k: r.v for r in st.read(spark).collect()} == want and st.read(spark).count() == len(want)
    st.compact(spark)
    assert {r.k: r.v for r in st.read(spark).collect()} == want
    assert not [f for f in _files_of(spark, st.path) if "/delta/" in f or "/base/0/" in f]
    st.append(small[0], 9)  # a delta that the commit doesn't name is read, whatever its number
    st.append(mk([]), 10)
    assert {r.k: r.v for r in st.read(spark).collect()} == want
    one = st.read(spark, F.col("bucket") == 2)
    assert set(r.k for r in one.collect()) < set(want)


def test_log_state_survives_a_lost_driver_in_compaction(spark, monkeypatch):
    from strata.streaming import log_state as LS
    st = LS.LogState(work_path(spark, "t-log2"), ["k"], "seq", [], 2)
    for n in range(3):
        st.append(spark.createDataFrame([(i, n, f"v{n}") for i in range(n, 6)], "k long, seq long, v string"), n)
    want = {r.k: r.v for r in st.read(spark).collect()}
    monkeypatch.setattr(LS, "remove_path", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):  # base and commit are written, the merged deltas still there
        st.compact(spark)
    monkeypatch.undo()
    assert {r.k: r.v for r in st.read(spark).collect()} == want and st.read(spark).count() == 6
    spark.createDataFrame([(1, 9, "unfinished")], "k long, seq long, v string").withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{st.path}/base/1")
    st.append(spark.createDataFrame([(0, 9, "z")], "k long, seq long, v string"), 3)
    st.compact(spark)
    assert {r.k: r.v for r in st.read(spark).collect()} == want | {0: "z"}


def test_folds_keep_bucket_count_and_key_type(spark):
    path = work_path(spark, "t-types")
    rows16 = spark.createDataFrame([(i, i) for i in range(100)], "cliente_id long, ts long")
    CS.scd1_fold(["cliente_id"], "ts", None, path, 16)(rows16, 0)
    with pytest.raises(ValueError, match="other settings"):
        CS.scd1_fold(["cliente_id"], "ts", None, path, 8)(rows16, 1)
    ints = rows16.select(F.col("cliente_id").cast("int"), (F.col("ts") + 1).alias("ts"))
    CS.scd1_fold(["cliente_id"], "ts", None, path, 16)(ints, 1)
    got = CS.scd1_current(spark, path, "false")
    assert got.count() == 100 and got.agg(F.min(F.col("ts") - F.col("cliente_id"))).first()[0] == 1
    assert dict(got.dtypes)["cliente_id"] == "bigint"
    with pytest.raises(ValueError, match="keys"):
        CS.scd1_fold(["ts"], "ts", None, path, 16)(rows16, 2)
    hist = work_path(spark, "t-types2")
    CS.scd2_fold(["cliente_id"], "ts", None, hist, 4)(rows16, 0)
    with pytest.raises(ValueError):
        CS.scd2_fold(["cliente_id"], "ts", None, hist, 5)(rows16, 1)
