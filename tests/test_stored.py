"""UPDATE, DELETE and erasure on stored tables: right rows, untouched files by name, and repeatable file exchange."""

import pytest
from pyspark.sql import functions as F

from strata.operators import stored as ST
from strata.session import work_path


def make(spark, n=400):
    """Partitions p=a..d, several files each; column part 'a b' has a blank and a colon in its folder's name."""
    path = work_path(spark, "stored")
    p = F.element_at(F.array(*[F.lit(x) for x in ("a b", "c:d", "7", "e")]), (F.col("id") % 4 + 1).cast("int"))
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.when(F.col("id") % 50 != 0, F.col("id") % 10).alias("s"), p.alias("p"))
    df.repartition(3).write.partitionBy("p").parquet(path)
    return path


def rows(spark, path):
    return sorted((r.k, r.v, r.s, r.p) for r in spark.read.parquet(path).collect())


def plain(n=400):
    names = ("a b", "c:d", "7", "e")
    return [(i, 2 * i, i % 10 if i % 50 else None, names[i % 4]) for i in range(n)]


def test_delete_rewrites_only_files_with_hits(spark):
    path = make(spark)
    before = set(ST.data_files(spark, path))
    done = ST.delete_from(spark, path, "p = 'c:d' AND k < 100", ["p"])
    after = set(ST.data_files(spark, path))
    gone = before - after
    assert gone and all("p=c%3Ad" in f for f in gone) and done.files_rewritten == len(gone)
    assert done.files_untouched == len(before & after) == len(before) - len(gone) and done.rows_hit == 25
    assert rows(spark, path) == [r for r in plain() if not (r[3] == "c:d" and r[0] < 100)]
    again = ST.delete_from(spark, path, "p = 'c:d' AND k < 100", ["p"])
    assert (again.files_rewritten, again.rows_hit) == (0, 0) and set(ST.data_files(spark, path)) == after
    # A null predicate keeps the row; a partition that loses all rows loses its folder.
    ST.delete_from(spark, path, "s <> 3 AND p = 'e'", ["p"])
    assert [r for r in rows(spark, path) if r[3] == "e"] == [r for r in plain() if r[3] == "e" and (r[2] is None or r[2] == 3)]
    ST.delete_from(spark, path, "p = 'e'", ["p"])
    assert not any("p=e" in f for f in ST.data_files(spark, path)) and spark.read.parquet(path).where("p = 'e'").count() == 0


def test_update_moves_rows_between_partitions(spark):
    path = make(spark)
    ST.update_table(spark, path, "k < 10", {"v": "v + 1", "p": "'new'"}, ["p"])
    assert rows(spark, path) == sorted((k, v + 1, s, "new") if k < 10 else (k, v, s, p) for k, v, s, p in plain())


def test_erase_leaves_no_row_in_any_file(spark):
    path = make(spark)
    before = set(ST.data_files(spark, path))
    subjects = spark.createDataFrame([(4,), (8,), (8,), (None,), (10 ** 6,)], "who long")
    done = ST.erase_from(spark, path, subjects, "k", "who", ["p"])
    assert rows(spark, path) == [r for r in plain() if r[0] not in (4, 8)]
    assert done.rows_hit == 2 and done.files_untouched >= len(before) - 2
    for f in ST.data_files(spark, path):
        assert spark.read.parquet(f).where("k in (4, 8)").count() == 0


@pytest.mark.parametrize("at", ["before the plan", "before the moves", "after one move", "after the moves", "after one deletion"])
def test_a_lost_driver_changes_nothing_or_all(spark, at, monkeypatch):
    path = make(spark, 120)
    real, calls = ST._each, []

    def lost(names, call):
        calls.append(1)
        if at == "before the moves":
            raise KeyboardInterrupt
        if at == "after one move" and len(calls) == 1:
            real(names[:1], call)
            raise KeyboardInterrupt
        if at == "after the moves" and len(calls) == 2:
            raise KeyboardInterrupt
        if at == "after one deletion" and len(calls) == 2:
            real(names[:1], call)
            raise KeyboardInterrupt
        real(names, call)

    monkeypatch.setattr(ST, "_each", lost)
    if at == "before the plan":
        monkeypatch.setattr(ST, "_exchange", None)
        monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        ST.delete_from(spark, path, "k % 3 = 0", ["p"])
    monkeypatch.undo()
    left = sorted((r.k, r.v, r.s, r.p) for r in ST.read_stored(spark, path).collect())
    want = plain(120) if at == "before the plan" else [r for r in plain(120) if r[0] % 3]
    assert left == want == rows(spark, path)
    assert ST.finish_rewrites(spark, path) == 0


def test_table_without_partitions_and_without_rows(spark):
    path = work_path(spark, "stored-flat")
    spark.range(10).withColumn("v", F.lit(1)).repartition(2).write.parquet(path)
    ST.update_table(spark, path, "id >= 5", {"v": "2"})
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [(i, 1 + (i >= 5)) for i in range(10)]
    ST.delete_from(spark, path, "true")
    assert spark.read.schema("id long, v int").parquet(path).count() == 0
