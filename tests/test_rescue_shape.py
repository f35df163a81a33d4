"""The walk for surplus values is left out only where it would find nothing."""

import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import rescue as R

OBS = T.StructType([T.StructField("d", T.StringType()), T.StructField("v", T.StringType())])
POINT = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("y", T.DoubleType())])
SCHEMA = T.StructType([T.StructField("code", T.IntegerType()), T.StructField("at", T.TimestampNTZType()), T.StructField("obs", T.ArrayType(OBS)),
                       T.StructField("p", T.StructType([T.StructField("x", T.ArrayType(POINT))]))])


def value(r, kind):
    """A value that mostly fits ``kind``; now and then another one, none, or a field more."""
    odd = [None, 3_000_000_000, "text", 1.5, True, [], {}, [1], {"q": {"z": 1}}, [None], "2024-02-30T00:00:00"]
    if r.random() < 0.04:
        return r.choice(odd)
    if isinstance(kind, T.StructType):
        out = {f.name: value(r, f.dataType) for f in kind.fields if r.random() > 0.02}
        if r.random() < 0.04:
            out[r.choice(["extra", "D", "a b", "x"])] = r.choice(odd)
        return out
    if isinstance(kind, T.ArrayType):
        return [value(r, kind.elementType) for _ in range(r.randint(0, 3))]
    return {"int": 7, "double": r.choice([1, 1.25, 1e300]), "string": "s", "timestamp_ntz": "2024-01-31T00:00:00.000000"}[kind.simpleString()]


def test_rows_are_rescued_as_by_the_whole_walk(spark, monkeypatch):
    r = random.Random(5)
    texts = [json.dumps(value(r, SCHEMA)) for _ in range(1500)] + [None, "", "{", "[1]", "{}", '{"code":1,"code":2}', '{"obs":[{"d":"a","v":"b"},{"d":"a","v":"b","w":1}]}']
    df = spark.createDataFrame(list(enumerate(texts)), "i long, value string")
    fast = {x.i: x for x in R.read_rescued(df, "value", SCHEMA, keep_map=True).collect()}
    shape = R._shape
    monkeypatch.setattr(R, "_shape", lambda kind: None)
    assert fast == {x.i: x for x in R.read_rescued(df, "value", SCHEMA, keep_map=True).collect()}
    held = [x for x in fast.values() if x[R.RESCUED]]
    assert 100 < len(held) < 1400 and shape(T.MapType(T.StringType(), T.StringType())) is None


def test_no_walk_for_rows_that_fit(spark, monkeypatch):
    """A walk that fails when it is entered isn't entered for texts that fit."""
    monkeypatch.setattr(R, "_surplus", lambda *a: F.array(F.struct(F.raise_error(F.lit("walked")).cast("string").alias("key"), F.lit("").alias("value"))).cast(R.ENTRIES))
    text = json.dumps({"code": 1, "at": "2024-01-31T00:00:00", "obs": [{"d": "a", "v": "b"}] * 3, "p": {"x": [{"n": 1, "y": 1.5}, {"n": 2, "y": 10.25}]}})
    row = R.read_rescued(spark.createDataFrame([(text,)], "value string"), "value", SCHEMA).first()
    assert row[R.RESCUED] is None and not row[R.CORRUPT] and len(row.obs) == 3
