"""Payloads of changing shape: nothing is lost when fields are new, missing or of another type.

Each line holds an object or an array of objects and is parsed once, as VARIANT. Declared
fields are read from it with their types; every other field, and every declared one whose
value does not fit, stays in ``rest`` as JSON text by field name. A line that is no JSON, or an
element that is no object, is one row with ``rest`` under the empty name. A pull written as one
array over many lines must be read whole; written as lines it splits like any text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stallmetrics.functions.markup import let

REST = "rest"


def parsed_lines(spark: SparkSession, path: str, wholetext: bool = False) -> DataFrame:
    """One row per object of the files: its variant, or the raw text of what is none."""
    lines = spark.read.text(path, wholetext=wholetext).filter(F.trim("value") != "")
    # The first character tells an array; a variant's schema is a text of all that it holds, which takes far longer.
    is_array = F.col("value").rlike(r"^\s*\[")
    parsed = lines.select("value", is_array.alias("__array"), F.try_parse_json("value").alias("__v"))
    several = F.when(F.col("__v").isNotNull(), F.try_variant_get("__v", "$", "array<variant>"))
    rows = parsed.select("value", "__array", F.col("__v").isNotNull().alias("__parsed"), F.explode_outer(
        F.when(F.col("__array") & F.col("__v").isNotNull(), several).otherwise(F.array("__v"))).alias("v"))
    # An empty array is no row.
    empty = F.col("v").isNull() & F.col("__array") & F.col("__parsed")
    is_object = F.try_variant_get("v", "$", "struct<_:variant>").isNotNull()  # only an object is a struct
    return rows.filter(~empty).select(
        F.when(is_object, F.col("v")).alias("v"),
        F.when(~is_object, F.coalesce(F.to_json("v"), F.col("value"))).alias("raw"))


def typed_rows(objects: DataFrame, schema: StructType) -> DataFrame:
    """Declared fields with their types, and ``rest``: a map of field name to JSON text."""
    names = [f.name for f in schema.fields]
    typed = [F.try_variant_get("v", f'$["{f.name}"]', f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    rows = objects.select("raw", F.try_variant_get("v", "$", "map<string,variant>").alias("__all"), *typed)
    read = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(f"`{n}`").isNotNull() for n in names]))
    given = lambda value: ~F.coalesce(F.is_variant_null(value), F.lit(True))
    # Bound by ``let``: inside the lambda the map of what was read would be built again for every field.
    kept = let(read, lambda known: F.map_filter("__all", lambda name, value: given(value) & ~F.coalesce(
        F.try_element_at(known, name), F.lit(False))))
    texts = F.transform_values(kept, lambda name, value: F.to_json(value))
    broken = F.create_map(F.lit(""), F.col("raw"))
    return rows.select(*[F.col(f"`{n}`") for n in names], F.when(F.col("raw").isNotNull(), broken).otherwise(texts).alias(REST))


def read_changing_payload(spark: SparkSession, path: str, schema: StructType, wholetext: bool = False) -> DataFrame:
    """Rows of payload files with the declared fields and everything else in ``rest``."""
    return typed_rows(parsed_lines(spark, path, wholetext), schema)


def found_schema(objects: DataFrame) -> DataFrame:
    """One row: the merged schema of all objects, as text; fields that differ in type are VARIANT."""
    return objects.filter(F.col("v").isNotNull()).agg(F.schema_of_variant_agg("v").alias("schema"))


def unknown_fields(rows: DataFrame) -> DataFrame:
    """How many rows keep something under each name in ``rest``."""
    return rows.select(F.explode(F.map_keys(REST)).alias("field")).groupBy("field").agg(F.count("*").alias("rows"))
