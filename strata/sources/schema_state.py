"""Incremental schema inference for landed JSON lines: the schema of all files seen so far is kept, and only new files are read.

A run lists names, leaves out those it has seen, and reduces the new files' records to one schema by Spark's mergeable
aggregate ``schema_of_variant_agg``: every record counts, none is sampled. That schema is joined with the stored one in a
lattice of types, so the outcome doesn't depend on the order or cut of the runs:

    nothing known < whole number < number        one field, values of other kinds together -> text
    structs and arrays are joined member by member

    <state>/<run>     rows (path, null) of the files that the run read, and one row (null, schema of all runs so far)

A run counts once its folder is complete; a run cut off before reads its files again, which changes nothing.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import path_exists
from strata.sources.files import list_files

UNKNOWN, MIXED = T.NullType(), T.VariantType()


def lattice_type(kind: T.DataType) -> T.DataType:
    """A type that Spark found, as a member of the lattice: all numbers that aren't whole are DOUBLE."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, lattice_type(f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(lattice_type(kind.elementType))
    return T.DoubleType() if isinstance(kind, (T.DecimalType, T.FloatType)) else kind


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the lattice that holds both; commutative, associative and idempotent."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        left, right = ({f.name: f.dataType for f in s.fields} for s in (a, b))
        return T.StructType([T.StructField(n, join_types(left.get(n, UNKNOWN), right.get(n, UNKNOWN))) for n in sorted({**left, **right})])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join_types(a.elementType, b.elementType))
    if {type(a), type(b)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    return MIXED


def readable(kind: T.DataType) -> T.DataType:
    """The schema to read with: text where nothing is known or kinds are mixed. Of names that differ in case only, the first stays."""
    if isinstance(kind, T.StructType) and kind.fields:
        kept = {}
        for f in kind.fields:
            kept.setdefault(f.name.lower(), T.StructField(f.name, readable(f.dataType)))
        return T.StructType(list(kept.values()))
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(readable(kind.elementType))
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType, T.StructType)) else kind


def records_schema(texts: DataFrame, col: str = "value") -> T.StructType:
    """Lattice type of all JSON objects in a text column: one aggregate, one row to the driver. Other texts don't count."""
    v = F.try_parse_json(F.col(col))
    # A text that isn't an object can't be told from a mixed column afterwards, so it is left out before.
    whole = F.when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), v)
    found = texts.agg(F.schema_of_variant_agg(whole).alias("s")).first()["s"]
    if found is None or found == "VOID":
        return T.StructType([])
    # OBJECT<..> is STRUCT<..> in a schema string; a quoted field name stays as it is.
    ddl = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: "STRUCT<" if m.group() == "OBJECT<" else m.group(), found)
    return lattice_type(T.DataType.fromDDL(ddl))


def _runs(spark: SparkSession, state: str) -> list[int]:
    """Complete runs, by name."""
    if not path_exists(spark, state):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state)
    names = [s.getPath().getName() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit() and path_exists(spark, f"{state}/{n}/_SUCCESS"))


def observe(spark: SparkSession, landing: str, state: str, **options) -> T.StructType:
    """Bring the state up to date with the files under ``landing`` and return the lattice type of all records ever seen.

    Opens only files whose names no earlier run had. Folder columns (``key=value``) aren't part of it, see ``partition_fields``.
    """
    runs = _runs(spark, state)
    names = list_files(spark, landing, **options).select("path")
    known = T.StructType([])
    if runs:
        stored = spark.read.schema("path string, schema string").parquet(*[f"{state}/{n}" for n in runs])
        names = names.join(stored.where("path IS NOT NULL").select("path"), "path", "left_anti")
        last = spark.read.schema("path string, schema string").parquet(f"{state}/{runs[-1]}").where("path IS NULL").first()
        known = T.StructType.fromJson(json.loads(last["schema"]))
    new = sorted(r.path for r in names.collect())  # names of the files that this run reads
    if not new:
        return known
    known = join_types(known, records_schema(spark.read.text(new)))
    rows = [(n, None) for n in new] + [(None, known.json())]
    (spark.createDataFrame(rows, "path string, schema string").coalesce(1)
     .write.mode("overwrite").parquet(f"{state}/{runs[-1] + 1 if runs else 0}"))
    return known


def partition_fields(spark: SparkSession, landing: str) -> list[T.StructField]:
    """Folder columns of a landing area, from its listing."""
    return [f for f in spark.read.text(landing).schema.fields if f.name != "value"]


def observed_schema(spark: SparkSession, landing: str, state: str) -> T.StructType:
    """Schema to read all files under ``landing`` with, folder columns last."""
    fields = readable(observe(spark, landing, state))
    own = fields.fields if isinstance(fields, T.StructType) else []
    folders = partition_fields(spark, landing)
    taken = {f.name.lower() for f in folders}
    return T.StructType([f for f in own if f.name.lower() not in taken] + folders)


def widen(stored: T.DataType, seen: T.DataType, at: str = "") -> tuple[T.DataType, list[str]]:
    """``stored`` with the fields of ``seen`` that it lacks, at any depth, and their paths. Types that are there stay."""
    if isinstance(stored, T.ArrayType) and isinstance(seen, T.ArrayType):
        element, added = widen(stored.elementType, seen.elementType, at + "[]")
        return T.ArrayType(element, stored.containsNull), added
    if not (isinstance(stored, T.StructType) and isinstance(seen, T.StructType)):
        return stored, []
    there, fields, added = {f.name.lower(): f for f in seen.fields}, [], []
    for f in stored.fields:
        other = there.pop(f.name.lower(), None)
        kind, more = widen(f.dataType, other.dataType, f"{at}.{f.name}") if other else (f.dataType, [])
        fields.append(T.StructField(f.name, kind, f.nullable, f.metadata))
        added += more
    return T.StructType(fields + list(there.values())), added + [f"{at}.{f.name}".lstrip(".") for f in there.values()]
