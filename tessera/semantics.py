"""Tables that say how types and modes behave, for people and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .types import INTEGERS, SCALARS, LType, normalize

_CLASS = {
    "bool": "bool", "f32": "float", "f64": "float", "varchar": "str", "blob": "bytes", "geometry": "bytes", "variant": "VariantVal", "date": "datetime.date", "time": "datetime.time",
    "timestamp": "datetime.datetime", "uuid": "uuid.UUID", "interval": "Interval", "bit": "Bits", "decimal": "decimal.Decimal", "enum": "str", "list": "list", "array": "list", "map": "dict",
    "struct": "dict", "union": "Union",
}


def _rule(x: LType) -> str:
    if x.name in INTEGERS:
        low, high = INTEGERS[x.name]
        return f"a whole number from {low} to {high}; fractions and NaN are errors"
    return {
        "f32": "any number; NaN and infinities are values, not NULL", "f64": "any number; NaN and infinities are values, not NULL", "decimal": "digits that do not fit are errors; nothing is rounded",
        "uuid": "8-4-4-4-12 hexadecimal digits", "interval": "three parts, each in range; NULL if one is", "bit": "0 and 1, one at least", "enum": "one of the labels", "array": "exactly its size of items",
        "map": "no NULL key, each key once", "struct": "exactly its fields", "union": "a known tag; an active member may be NULL",
    }.get(x.name or x.kind, "a value of the class")


def argument_types(spark: SparkSession, types: list[LType | str] | None = None) -> DataFrame:
    """Of each type: its names, the class user code sees, how Spark stores it."""
    chosen = [normalize(x) for x in types] if types else list(SCALARS.values())
    rows = [(x.token, x.sql, x.kind, "int" if x.name in INTEGERS else _CLASS[x.name or x.kind], x.spark.simpleString(), "None") for x in chosen]
    return spark.createDataFrame(rows, "token string, sql string, kind string, value_class string, spark_type string, null_value string")


def value_rules(spark: SparkSession, types: list[LType | str] | None = None) -> DataFrame:
    """Of each type: what becomes of NULL, and which results are errors."""
    chosen = [normalize(x) for x in types] if types else list(SCALARS.values())
    rows = [(x.token, "no call, NULL result", "call with None", "NULL", _rule(x)) for x in chosen]
    return spark.createDataFrame(rows, "token string, default_null string, special_null string, none_result string, accepts string")


def modes(spark: SparkSession) -> DataFrame:
    rows = [
        ("scalar", "a call for each row", "a value for each argument", "one value", "that row is NULL"),
        ("vectorized", "a call for each batch", "an Arrow array for each argument, without rows that have a NULL", "as many values as rows", "all evaluated rows of the batch are NULL"),
    ]
    return spark.createDataFrame(rows, "mode string, calls string, input string, result string, return_null string")
