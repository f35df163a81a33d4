"""Mergeable aggregates, joins salted by measured keys, interleaved clustering, reconciliation by range checksums."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import joins as J
from strata.operators import layout as L
from strata.operators import reconcile as R
from strata.operators.partials import Measure, Partials
from strata.operators.stored import data_files
from strata.session import work_path

MEASURES = [Measure("s", "sum", "v"), Measure("n", "count"), Measure("nv", "count", "v"), Measure("lo", "min", "v"),
            Measure("hi", "max", "v"), Measure("last", "latest", "v", "t")]


def fact_rows(n, seed):
    r = random.Random(seed)
    order = r.sample(range(10 * n), n)
    return [(r.choice("abc"), r.randint(1, 5), None if r.random() < 0.1 else r.randint(-50, 50), t) for t in order]


def plain(rows):
    out = {}
    for g, p, v, t in rows:
        out.setdefault((g, p), []).append((t, v))
    done = {}
    for k, tv in out.items():
        vs = [v for _, v in tv if v is not None]
        last = max(((t, v) for t, v in tv if v is not None), default=(None, None))[1]
        done[k] = (sum(vs) if vs else None, len(tv), len(vs), min(vs, default=None), max(vs, default=None), last)
    return done


def merged(spark, state):
    return {(r.g, r.p): (r.s, r.n, r.nv, r.lo, r.hi, r.last) for r in state.read(spark).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_partials_equal_a_recompute_after_random_splits_and_replays(spark, seed):
    rows, r = fact_rows(120, seed), random.Random(seed)
    cut = [r.randrange(4) for _ in rows]
    state = Partials(work_path(spark, "p"), ["g", "p"], "p", MEASURES)
    for b in range(4):
        batch = spark.createDataFrame([x for x, c in zip(rows, cut) if c == b], "g string, p int, v long, t long")
        state.add(batch, b)
        state.add(batch, b)  # a replay before the next batch
        if b == seed:
            state.compact(spark)
            assert state.add(batch, b) is None  # and one of a batch that the base holds
        else:
            state.compact_if_due(spark)
        assert merged(spark, state) == plain([x for x, c in zip(rows, cut) if c <= b])


def test_partials_leave_untouched_folders_alone(spark):
    state, gold = Partials(work_path(spark, "p"), ["g", "p"], "p", MEASURES), work_path(spark, "gold")
    schema = "g string, p int, v long, t long"
    for b, rows in enumerate([[("a", 1, 1, 1), ("a", 2, 5, 1)], [("a", 2, 7, 2), ("b", 2, 1, 3)]]):
        before = set(data_files(spark, gold)) if b else set()
        state.refresh(spark, state.add(spark.createDataFrame(rows, schema), b), gold, lambda d: d.drop("last__order"))
    kept = before & set(data_files(spark, gold))
    assert kept and all("p=1" in f for f in kept)
    assert sorted((x.g, x.p, x.s, x.last) for x in spark.read.parquet(gold).collect()) == [("a", 1, 1, 1), ("a", 2, 12, 7), ("b", 2, 1, 1)]
    # An empty batch adds nothing; other measures are refused; an incomplete delta doesn't count.
    assert state.add(spark.createDataFrame([], schema), 2) is None
    with pytest.raises(ValueError, match="other keys or measures"):
        Partials(state.path, ["g", "p"], "p", MEASURES[:2]).add(spark.createDataFrame([("a", 1, 1, 1)], schema), 3)
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        spark.createDataFrame([("a", 9, 9, 1)], schema).write.partitionBy("p").parquet(f"{state.path}/delta/7")
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert (("a", 9) not in merged(spark, state))


def test_partials_aggregate_by_hash(spark):
    rows = spark.createDataFrame(fact_rows(10, 3), "g string, p int, v long, t long")
    plan = rows.groupBy("g", "p").agg(*[c for m in MEASURES for c in m.first()])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_measure_rejects_what_it_cannot_do():
    with pytest.raises(ValueError):
        Measure("x", "median", "v")
    with pytest.raises(ValueError):
        Measure("x", "latest", "v")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_the_plain_join(spark, how):
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 500 + 100).alias("k"))
    small = spark.createDataFrame([(7, "x"), (7, "y"), (8, "z"), (None, "n"), *[(k, "c") for k in range(100, 400)]], "k long, w string")
    hot = J.hot_keys(big, "k", 0.05)
    expected = [r[0] for r in spark.createDataFrame([(7,)], "k long").select(F.xxhash64("k")).collect()]
    assert expected[0] in hot and len(hot) <= 2  # nulls hold a share, too
    got = J.skew_join(big, small, "k", "id", n=4, share=0.05, how=how)
    assert sorted(got.collect(), key=str) == sorted(big.join(small, "k", how).collect(), key=str)


def test_skew_join_replicates_hot_keys_only(spark):
    big = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"))
    small = spark.range(2000).select(F.col("id").alias("k"))
    hot = J.hot_keys(big, "k", 0.1)
    assert len(hot) == 1
    s = small.withColumn("n", F.when(F.xxhash64("k").isin(hot), 5).otherwise(1))
    assert s.agg(F.sum("n")).first()[0] == 2000 + 4  # one hot row, five times
    assert J.skew_join(big, small, "k", "id", n=5, hot=hot).count() == 2000
    assert J.hot_keys(spark.range(0).select(F.col("id").alias("k")), "k") == []
    with pytest.raises(ValueError):
        J.skew_join(big, small, "k", "id", how="full")


def spans(spark, path, column):
    """Files, and how many of them a range filter on ``column`` can't skip (by their minimum and maximum)."""
    per = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
    return per


def test_a_filter_on_either_column_skips_most_files(spark):
    df = spark.range(20000).select(F.col("id"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
                                   F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.xxhash64(F.col("id") + 7), F.lit(900)).cast("int")).alias("b"))
    path = work_path(spark, "z")
    L.cluster_interleaved(df, ["a", "b"], 16).write.parquet(path)
    out = spark.read.parquet(path)
    assert out.columns == df.columns and out.exceptAll(df).count() == 0 and out.count() == 20000
    day = spark.range(1).select(F.lit("2021-01-15").cast("date")).first()[0]
    for column, value in (("a", 333), ("b", day)):
        per = spans(spark, path, column)
        hit = sum(p.lo <= value <= p.hi for p in per)
        assert len(per) >= 12 and hit <= len(per) // 2, (column, hit, len(per))


def test_interleaving_takes_nulls_strings_and_constant_columns(spark):
    df = spark.createDataFrame([(None, "a", 1.5), (2, None, None), (2, "é", float("nan"))] * 3, "i int, s string, x double")
    out = L.cluster_interleaved(df, ["i", "s", "x"], 2)
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert L.cluster_interleaved(df.limit(0), ["i", "s"], 2).count() == 0
    with pytest.raises(ValueError):
        L.interleaved_rank(df.withColumn("m", F.create_map(F.lit(1), F.lit(2))), ["m"])


def test_string_places_follow_byte_order(spark):
    words = ["", "a", "a\0", "ab", "b", "z", "é", "日本"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r[0] for r in df.select(L._ordinal(df, "s")).collect()]
    assert got == sorted(got) and got[0] == 0


def kept(spark, df, keys=("k",), ranges=8):
    path = work_path(spark, "kept")
    R.keep(df, path, list(keys), ranges)
    return path


def test_reconciliation_locates_planted_differences(spark):
    rows = [(i, f"v{i}", i / 2) for i in range(300)] + [(None, "n", 1.0), (5, "v5", 2.5)]  # a null key and a repeated row
    schema = "k long, s string, x double"
    left = kept(spark, spark.createDataFrame(rows, schema))
    assert [tuple(r) for r in R.differences(spark, left, kept(spark, spark.createDataFrame(rows[::-1], schema))).collect()] == [("equal", None, 302, 302)]
    other = [(k, s, x) for k, s, x in rows if k != 17]
    other = [(k, None if k == 40 else s, x) for k, s, x in other] + [(1000, "new", 0.0)]
    other.remove((5, "v5", 2.5))  # one of two equal rows
    other[other.index((None, "n", 1.0))] = (None, "n", 2.0)
    right = kept(spark, spark.createDataFrame(other, schema))
    got = {tuple(r) for r in R.differences(spark, left, right).collect()}
    assert got == {("only_left", 17, 1, 0), ("changed", 40, 1, 1), ("only_right", 1000, 0, 1), ("changed", 5, 2, 1), ("changed", None, 1, 1)}
    with pytest.raises(ValueError):
        R.differences(spark, left, kept(spark, spark.createDataFrame(rows, schema), ranges=4))


def test_reconciliation_reads_differing_ranges_only(spark):
    a = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    left, right = kept(spark, a, ranges=32), kept(spark, a.withColumn("v", F.when(F.col("k") == 77, 0).otherwise(F.col("v"))), ranges=32)
    assert len(R.differing_ranges(spark, left, right)) == 1
    assert [tuple(r) for r in R.differences(spark, left, right).collect()] == [("changed", 77, 1, 1)]
    # A changed null place is seen: (null, 1) against (1, null).
    p = spark.createDataFrame([(1, None, 1)], "k long, a int, b int")
    q = spark.createDataFrame([(1, 1, None)], "k long, a int, b int")
    assert [r.kind for r in R.differences(spark, kept(spark, p), kept(spark, q)).collect()] == ["changed"]
    none = spark.createDataFrame([], "k long, a int")
    assert [tuple(r) for r in R.differences(spark, kept(spark, none), kept(spark, none)).collect()] == [("equal", None, 0, 0)]


def test_quantiles_by_refinement_equal_a_sort(spark):
    from strata.operators.quantiles import exact_quantiles
    rng = np.random.default_rng(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    columns = {"spread": np.exp(rng.normal(0, 60, 3000)), "hot": np.where(rng.random(3000) < 0.6, 7.0, rng.normal(0, 1, 3000)),
               "edges": np.concatenate([[-1.7e308, 1.7e308, 5e-324, 0.0, -5e-324], rng.normal(0, 1e-310, 500)]), "one": np.array([3.5]),
               "close": 1.0 + np.arange(5000) * 2.0 ** -52}
    for name, values in columns.items():
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(5)
        got, ordered = exact_quantiles(df, "v", probs), np.sort(values)
        for p, g in zip(probs, got):
            h = (len(ordered) - 1) * p
            lo, hi = ordered[int(np.floor(h))], ordered[int(np.ceil(h))]
            assert g == (lo if lo == hi else lo + (h - np.floor(h)) * (hi - lo)), (name, p)
    odd = spark.createDataFrame([(float(v),) for v in ("-inf", "-inf", "1", "2", "inf", "nan")], "v double")
    got = exact_quantiles(odd, "v", [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])
    assert got[:5] == [-np.inf, -np.inf, 1.0, 2.0, np.inf] and np.isnan(got[5])
    assert exact_quantiles(odd.where("false"), "v", [0.5]) == [None]


def test_quantiles_of_a_column_with_many_repeats(spark):
    from strata.operators.quantiles import exact_quantiles
    df = spark.range(100_000).selectExpr("id % 977 * 1.0 AS v")
    assert exact_quantiles(df, "v", [0.5]) == [float(np.median(np.arange(100_000) % 977))]


def test_sketches_of_days_merge_to_those_of_months(spark):
    from strata.operators.partials import HLL_LG_K, KLL_K, distinct_of, quantile_of, roll_up
    rows = spark.range(60_000).selectExpr("id % 3 AS g", "id % 40 AS day", "CAST(id % 40 >= 20 AS INT) AS p", "id * 7919 % 20011 AS u", "sqrt(id * 104729 % 60000) AS v")
    measures = [Measure("n", "count"), Measure("u", "distinct", "u"), Measure("q", "quantiles", "v")]
    state = Partials(work_path(spark, "sk"), ["g", "day", "p"], "p", measures)
    for b in (0, 1, 1, 2):  # a replayed batch isn't counted twice
        state.add(rows.where(F.pmod(F.xxhash64("u", "v"), F.lit(3)) == b), b)
    state.compact(spark)
    month = roll_up(state.read(spark), ["g", "p"], measures)
    direct = rows.groupBy("g", "p").agg(*[c for m in measures for c in m.first()])
    exact = {(r.g, r.p): r for r in rows.groupBy("g", "p").agg(F.count("*").alias("n"), F.count_distinct("u").alias("u"), F.sort_array(F.collect_list("v")).alias("v")).collect()}
    eps, rse = 4 * 2.3 / KLL_K ** 0.9, 1.04 / 2 ** (HLL_LG_K / 2)
    for made in (month, direct):
        got = made.select("g", "p", "n", distinct_of("u").alias("u"), *[quantile_of("q", s).alias(f"q{i}") for i, s in enumerate((0.1, 0.5, 0.9))]).collect()
        assert len(got) == 6
        for r in got:
            e = exact[r.g, r.p]
            assert r.n == e.n and abs(r.u - e.u) <= 5 * rse * e.u
            for s, q in zip((0.1, 0.5, 0.9), (r.q0, r.q1, r.q2)):
                lo, hi = np.searchsorted(e.v, q, "left") / e.n, np.searchsorted(e.v, q, "right") / e.n
                assert lo - eps <= s <= hi + eps


def test_sketches_of_groups_without_values(spark):
    from strata.operators.partials import distinct_of, quantile_of
    measures = [Measure("u", "distinct", "u"), Measure("q", "quantiles", "v")]
    state = Partials(work_path(spark, "sk0"), ["p"], "p", measures)
    state.add(spark.createDataFrame([(1, None, None), (2, 5, 1.5), (2, None, None)], "p int, u long, v double"), 0)
    got = {r.p: (r.u, r.q) for r in state.read(spark).select("p", distinct_of("u").alias("u"), quantile_of("q", 0.5).alias("q")).collect()}
    assert got == {1: (0, None), 2: (1, 1.5)}


def test_unified_sources_break_ties_by_value(spark):
    from strata.operators.gold import unify_sources
    a = spark.createDataFrame([(1, "b", 2.0), (1, "a", 3.0), (1, None, 1.0), (2, "x", 1.0)], "k int, n string, v double")
    b = spark.createDataFrame([(2, "y", 9.0)], "k int, n string, v double")
    for n in (1, 3, 7):
        got = {tuple(r) for r in unify_sources({"a": (a.repartition(n), 1), "b": (b, 2)}, ["k"], ["k", "n", "v"]).collect()}
        assert got == {(1, "a", 3.0, "a"), (2, "y", 9.0, "b")}


def test_a_hash_mask_needs_a_salt(spark):
    from strata.operators.privacy import Principal, apply_policy, tag_columns
    df = tag_columns(spark.createDataFrame([("123",)], "cpf string"), {"cpf": "hash"})
    with pytest.raises(ValueError):
        apply_policy(df, {"tagged": {"tag": "pii"}}, Principal("ana"))
    first, second = (apply_policy(df, {"tagged": {"tag": "pii", "salt": s}}, Principal("ana")).first()[0] for s in ("x", "y"))
    assert first != second and len(first) == 64


def test_quarterly_rollup_scans_once(spark):
    from strata.operators.aggregates import rollup_old_detail
    from strata.plans import views as V
    from tests.conftest import SF001
    o = V.table(spark, SF001, "orders")
    plan = rollup_old_detail(o, "o_orderdate", "2001-01-01", 365, ["o_orderpriority"], {"t": "o_totalprice"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
