"""Messages whose fields change: what is unknown is kept and counted, and so are fields of another type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.rows import without_tombstones
from clickloom.schemas import BEHAVIOR

# What JSON can say for each declared type; text that holds a time stays text.
_FITTING = {"string": ("STRING",), "timestamp": ("STRING",), "integer": ("BIGINT",), "long": ("BIGINT",), "double": ("DOUBLE", "DECIMAL", "BIGINT")}


def _object(value: str) -> Column:
    """A message as a variant; null where it is no JSON object."""
    parsed = F.try_parse_json(F.col(value).cast("string"))
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed)


def _fields(value: str) -> Column:
    """The fields of a message as a map to variants; null where it is no JSON object."""
    return _object(value).cast("map<string, variant>")


def with_unknown(records: DataFrame, schema: T.StructType = BEHAVIOR, value: str = "value") -> DataFrame:
    """The declared fields of each message, and ``unknown``: the others as JSON text, null if there are none.

    A declared field that does not fit its type is null, and its text is kept under ``misfits``. Messages that are no
    JSON object have only nulls and the flag ``broken``. Records without a value are left out.
    """
    # Exploded so that the text is parsed once.
    fields = F.explode(F.array(_fields(value))).alias("_fields")
    parsed = without_tombstones(records, value).select(fields)
    names = F.array(*[F.lit(name) for name in schema.fieldNames()])
    rest = F.map_filter("_fields", lambda key, _: ~F.array_contains(names, key))
    columns, misfits = [], []
    for field in schema.fields:
        own = F.col("_fields")[field.name]
        kind = field.dataType.simpleString()
        got = F.try_variant_get(own, "$", "string" if kind == "timestamp" else kind)
        got = F.try_to_timestamp(got) if kind == "timestamp" else got
        columns.append(got.alias(field.name))
        lost = own.isNotNull() & ~F.is_variant_null(own) & got.isNull()
        misfits.append(F.when(lost, F.struct(F.lit(field.name).alias("field"), F.to_json(own).alias("text"))))
    kept = F.array_compact(F.array(*misfits))
    return parsed.select(
        *columns,
        F.when(F.size(rest) > 0, F.to_json(rest)).alias("unknown"),
        F.when(F.size(kept) > 0, F.to_json(F.map_from_entries(kept))).alias("misfits"),
        F.col("_fields").isNull().alias("broken"),
    )


def drift(records: DataFrame, schema: T.StructType = BEHAVIOR, value: str = "value") -> DataFrame:
    """``field, type, known, fits, n``: how often each field came as which type.

    ``known`` is whether the schema has the field, ``fits`` whether a value of that type can be the declared one;
    null values fit. Map-side combine leaves one row of each field and type per task.
    """
    alive = without_tombstones(records, value).select(F.explode(F.array(_fields(value))).alias("_fields"))
    each = alive.select(F.explode("_fields").alias("field", "found"))
    kind = F.regexp_extract(F.schema_of_variant("found"), "^[A-Z]+", 0)
    counted = each.groupBy("field", kind.alias("type")).agg(F.count(F.lit(1)).alias("n"))
    declared = {field.name: _FITTING.get(field.dataType.typeName(), ("STRING",)) for field in schema.fields}
    known = F.col("field").isin(list(declared))
    fits = F.col("type") == "VOID"
    for name, kinds in declared.items():
        fits = fits | ((F.col("field") == name) & F.col("type").isin(list(kinds)))
    return counted.select("field", "type", known.alias("known"), (known & fits).alias("fits"), "n")


def schema_seen(records: DataFrame, value: str = "value") -> DataFrame:
    """One row: the schema that all messages together have, as far as they are JSON objects."""
    alive = without_tombstones(records, value).select(_object(value).alias("found"))
    return alive.filter("found IS NOT NULL").agg(F.schema_of_variant_agg("found").alias("schema"))
