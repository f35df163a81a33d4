"""Frozen-schema JSON with rescued data, and schema evolution for file streams.

*Rescue*: the schema is fixed; fields outside it and fields whose value does
not fit its type go to ``_rescued_data`` (JSON object of raw text values) and
the row is kept. Text that is not a JSON object at all is flagged
``_corrupt`` so a quality rule can quarantine it.

*Evolution* (``addNewColumns``): before a stream starts, the landing files that no
earlier start has seen are read; if they hold columns the stored schema lacks, the widened schema is
persisted next to the checkpoint and ``SchemaEvolved`` is raised. The next run
starts with the widened schema. ``failOnNewColumns`` raises without
persisting; ``none`` ignores new columns; ``rescue`` keeps the stored schema
and routes surplus fields to ``_rescued_data``.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
CORRUPT = "_corrupt"
MODES = ("addNewColumns", "failOnNewColumns", "none", "rescue")


class SchemaEvolved(Exception):
    """New columns were found; the widened schema was stored. Rerun to continue."""


class NewColumnsRejected(Exception):
    pass


ENTRIES = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))


def _text(v: Column) -> Column:
    """A JSON value as text: strings as they are, objects and arrays as JSON."""
    return F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))


def _surplus(v: Column, typed: Column, kind: T.DataType, path: Column | None) -> Column:
    """Entries (path, raw text) of what the value ``v`` holds and ``typed``, its reading as ``kind``, does not.

    Structs, arrays and maps are entered; a path reads ``ctx.items[2].field``.
    """
    none = F.array().cast(ENTRIES)

    def below(name) -> Column:
        name = F.lit(name) if isinstance(name, str) else name
        return name if path is None else F.concat(path, F.lit("."), name)

    def one(x: Column, read: Column, of: T.DataType, at: Column) -> Column:
        there = x.isNotNull() & ~F.coalesce(F.is_variant_null(x), F.lit(True))
        whole = F.array(F.struct(at.alias("key"), _text(x).alias("value"))).cast(ENTRIES)
        inner = _surplus(x, read, of, at) if isinstance(of, (T.StructType, T.ArrayType, T.MapType)) else none
        return F.when(there & read.isNull(), whole).when(there, inner).otherwise(none)

    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(v, "$", "array<variant>")
        found = F.flatten(F.transform(items, lambda x, i: one(x, F.get(typed, i), kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
        return F.coalesce(found, none)
    fields = F.try_variant_get(v, "$", "map<string,variant>")
    if isinstance(kind, T.MapType):
        found = F.flatten(F.transform(F.map_entries(fields), lambda e: one(e["value"], typed[e["key"]], kind.valueType, below(e["key"]))))
        return F.coalesce(found, none)
    names = [f.name for f in kind.fields]
    other = F.map_entries(F.map_filter(fields, lambda k, _: ~k.isin(names)))
    found = F.transform(other, lambda e: F.struct(below(e["key"]).alias("key"), _text(e["value"]).alias("value"))).cast(ENTRIES)
    return F.concat(F.coalesce(found, none), *[one(fields[f.name], typed[f.name], f.dataType, below(f.name)) for f in kind.fields])


def _shape(kind: T.DataType) -> str | None:
    """A pattern of ``schema_of_variant`` for values that have no name outside ``kind``; None if ``kind`` has maps or names to quote."""
    if isinstance(kind, T.ArrayType):
        item = _shape(kind.elementType)
        return item and f"ARRAY<{item}>"
    if isinstance(kind, T.StructType):
        fields = {f.name: _shape(f.dataType) for f in kind.fields}
        if not all(fields.values()) or not all(re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", n) for n in fields):
            return None
        return "OBJECT<" + "".join(f"({n}: {fields[n]}(, |(?=>)))?" for n in sorted(fields)) + ">"
    return None if isinstance(kind, (T.MapType, T.VariantType)) else r"[A-Z]+(\([0-9]+,[0-9]+\))?"


def _complete(typed: Column, kind: T.DataType) -> Column:
    """Whether ``typed`` and all that it holds is there."""
    inner = F.lit(True)
    if isinstance(kind, T.ArrayType):
        inner = F.forall(typed, lambda x: _complete(x, kind.elementType))
    elif isinstance(kind, T.StructType):
        for f in kind.fields:
            inner = inner & _complete(typed[f.name], f.dataType)
    return typed.isNotNull() & inner


def read_rescued(df: DataFrame, text_col: str, schema: T.StructType, keep_map: bool = False) -> DataFrame:
    """Parse ``text_col`` with a frozen schema, keeping what does not fit in ``_rescued_data``.

    The text is parsed twice: as the typed struct and as a VARIANT, which is walked through structs, arrays and
    maps (keys like ``ctx.items[0].field``). A text that is no JSON object (or has a field twice) is ``_corrupt``.
    The walk is left out where nothing can be found: all names are the schema's, and every value was read.
    Works on streams too. ``keep_map`` also returns the rescued map as ``_rescued_map`` so callers can
    inspect it without re-parsing the JSON.
    """
    parsed = df.select("*", F.from_json(F.col(text_col), schema, {"mode": "PERMISSIVE"}).alias("__t"), F.try_parse_json(F.col(text_col)).alias("__v"))
    is_object = F.try_variant_get("__v", "$", "map<string,variant>").isNotNull()
    rescued = F.when(is_object, F.map_from_entries(_surplus(F.col("__v"), F.col("__t"), schema, None)))
    shape = _shape(schema)
    if shape:
        fits = F.schema_of_variant("__v").rlike(f"^{shape}$") & _complete(F.col("__t"), schema)
        rescued = F.when(fits, F.map_from_entries(F.array().cast(ENTRIES))).otherwise(rescued)
    out = parsed.withColumn("__r", rescued)
    extra = [F.col("__r").alias("_rescued_map")] if keep_map else []
    return out.select(*[c for c in df.columns if c != text_col], "__t.*",
                      F.when(F.size("__r") > 0, F.to_json("__r")).alias(RESCUED),
                      F.col("__r").isNull().alias(CORRUPT), *extra)


def rescued_keys(col: str = RESCUED) -> Column:
    """Sorted comma list of the rescued field names (for reports and tests)."""
    m = F.from_json(F.col(col), T.MapType(T.StringType(), T.StringType()))
    return F.array_join(F.array_sort(F.map_keys(m)), ",")


def load_schema(spark: SparkSession, path: str) -> T.StructType | None:
    from strata.session import path_exists
    if not path_exists(spark, path):
        return None
    text = "\n".join(r.value for r in spark.read.text(path).collect())
    return T.StructType.fromJson(json.loads(text))


def store_schema(spark: SparkSession, schema: T.StructType, path: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def evolve_schema(spark: SparkSession, landing: str, schema_path: str, fmt: str = "json",
                  mode: str = "addNewColumns") -> T.StructType:
    """Schema to start a file stream with (see module doc for the modes).

    JSON lines are inferred incrementally (``schema_state``): every record counts, and a start reads only files that
    no earlier start has seen. New fields inside structs and arrays of structs count as new columns, named by their path.
    """
    from strata.sources.schema_state import observed_schema, widen
    if mode not in MODES:
        raise ValueError(mode)
    if fmt == "json":
        observed = observed_schema(spark, landing, f"{schema_path.rstrip('/')}_seen")
    else:
        observed = spark.read.format(fmt).load(landing).schema
    stored = load_schema(spark, schema_path)
    if stored is None:
        store_schema(spark, observed, schema_path)
        return observed
    widened, added = widen(stored, observed)
    if not added or mode in ("none", "rescue"):
        return stored
    if mode == "failOnNewColumns":
        raise NewColumnsRejected(", ".join(added))
    store_schema(spark, widened, schema_path)
    raise SchemaEvolved("new columns: " + ", ".join(added))
