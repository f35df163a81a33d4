"""Incremental schema inference: every record counts, old files stay closed, any cut of the records gives one schema."""

import os
import random

import pytest
from pyspark.sql import types as T

from strata.session import work_path
from strata.sources import rescue as R
from strata.sources import schema_state as SS

RECORDS = ['{"a":1}', '{"a":2.5,"b":{"x":null}}', '{"b":{"x":true,"y":[1,2]}}', '{"b":{"y":[null,0.5]},"c":"s"}', '{"c":3}',
           '{"d":[{"p":1},{"q":"s"}]}', '{"d":[]}', '{"d":[{"p":"x"}],"e f":{}}', 'no json', '[1]', '{}', '{"a":12345678901234567890}', '{"OBJECT<":7}']
WHOLE = ("struct<OBJECT<:bigint,a:double,b:struct<x:boolean,y:array<double>>,c:variant,d:array<struct<p:variant,q:string>>,e f:struct<>>")


def drop(folder, n, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{n}.json", "w") as f:
        f.write("\n".join(lines) + "\n")


def local(spark, name):
    return work_path(spark, name).removeprefix("file:")


def test_any_cut_of_the_records_gives_one_schema(spark):
    for seed in range(4):
        rng = random.Random(seed)
        lines = rng.sample(RECORDS, len(RECORDS))
        cuts = sorted(rng.sample(range(1, len(lines)), seed))
        landing, state = local(spark, "t-cut"), work_path(spark, "t-cut-state")
        for n, (a, b) in enumerate(zip([0] + cuts, cuts + [len(lines)])):
            drop(landing, n, lines[a:b])
            seen = SS.observe(spark, landing, state)
        assert seen.simpleString() == WHOLE
        assert SS.readable(seen).simpleString() == WHOLE.replace("variant", "string").replace("struct<>", "string")


def test_join_is_a_lattice():
    kinds = [T.NullType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.VariantType(), T.ArrayType(T.LongType()),
             T.ArrayType(T.NullType()), T.StructType([T.StructField("a", T.LongType())]), T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.StringType())])]
    for a in kinds:
        assert SS.join_types(a, a) == a
        for b in kinds:
            assert SS.join_types(a, b) == SS.join_types(b, a)
            for c in kinds:
                assert SS.join_types(SS.join_types(a, b), c) == SS.join_types(a, SS.join_types(b, c))


def test_one_record_of_the_newest_file_is_found_and_old_files_stay_closed(spark):
    landing, state = local(spark, "t-new"), work_path(spark, "t-new-state")
    drop(landing, 0, ['{"a":1}'] * 500)
    assert SS.observe(spark, landing, state).fieldNames() == ["a"]
    drop(landing, 0, ['{"old":1}'])  # seen by name: not opened again
    drop(landing, 1, ['{"a":1}'] * 499 + ['{"a":1,"late":{"z":2}}'])
    assert SS.observe(spark, landing, state).simpleString() == "struct<a:bigint,late:struct<z:bigint>>"
    assert SS.observe(spark, landing, state).simpleString() == "struct<a:bigint,late:struct<z:bigint>>"


def test_a_run_cut_off_before_its_commit_is_repeated(spark):
    landing, state = local(spark, "t-off"), local(spark, "t-off-state")
    drop(landing, 0, ['{"a":1}'])
    SS.observe(spark, landing, state)
    drop(landing, 1, ['{"b":1}'])
    SS.observe(spark, landing, state)
    os.remove(f"{state}/1/_SUCCESS")
    assert SS.observe(spark, landing, state).fieldNames() == ["a", "b"]


def test_empty_files_and_names_that_differ_in_case(spark):
    landing, state = local(spark, "t-none"), work_path(spark, "t-none-state")
    drop(landing, 0, [])
    assert SS.observe(spark, landing, state) == T.StructType([])
    assert SS.observed_schema(spark, landing, state) == T.StructType([])
    drop(landing, 1, ['{"A":1,"a":"x"}'])
    assert SS.observed_schema(spark, landing, state).simpleString() == "struct<A:bigint>"


def test_evolution_finds_nested_fields(spark):
    landing, sp = local(spark, "t-nested"), work_path(spark, "t-nested-schema")
    drop(f"{landing}/g=1", 0, ['{"a":1,"s":{"x":1},"l":[{"p":1}]}'])
    assert R.evolve_schema(spark, landing, sp).simpleString() == "struct<a:bigint,l:array<struct<p:bigint>>,s:struct<x:bigint>,g:int>"
    drop(f"{landing}/g=2", 0, ['{"a":"text","s":{"x":1,"y":{"z":1}},"l":[{"q":1}]}'])
    with pytest.raises(R.SchemaEvolved, match=r"l\[\]\.q, s\.y"):
        R.evolve_schema(spark, landing, sp)
    # The type that a field had stays; the text of another kind is for the rescue column.
    wide = R.evolve_schema(spark, landing, sp)
    assert wide.simpleString() == "struct<a:bigint,l:array<struct<p:bigint,q:bigint>>,s:struct<x:bigint,y:struct<z:bigint>>,g:int>"
    assert spark.read.schema(wide).json(landing).where("s.y.z = 1").count() == 1
