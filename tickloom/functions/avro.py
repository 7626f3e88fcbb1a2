"""Avro bodies to columns and back, by Spark's own from_avro and to_avro.

They come with the spark-avro package, which must be on the session's class path. There is no
stand-in: without it, decoding and encoding fail at once.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, SparkSession
from pyspark.sql import types as T

# Avro primitives and their columns.
PRIMITIVES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def column_type(avro: Any) -> T.DataType:
    """The column type of an Avro declaration; ValueError where messages may not use it.

    Every field is nullable. Of a union, one branch besides null is allowed.
    """
    if isinstance(avro, list):
        branches = [branch for branch in avro if branch != "null"]
        if len(branches) == 1:
            return column_type(branches[0])
    elif isinstance(avro, str):
        if avro in PRIMITIVES:
            return PRIMITIVES[avro]
    elif avro.get("type") == "array":
        return T.ArrayType(column_type(avro["items"]))
    elif avro.get("type") == "record":
        fields = [T.StructField(f["name"], column_type(f["type"])) for f in avro["fields"]]
        return T.StructType(fields)
    raise ValueError(f"Avro type without a column type: {avro}")


def spark_schema(schema_json: str) -> T.StructType:
    """The columns of a record declared as Avro JSON text."""
    return column_type(json.loads(schema_json))


def require_avro(spark: SparkSession) -> None:
    """Fail plainly where spark-avro is missing."""
    try:
        spark.range(0).selectExpr("from_avro(cast(null as binary), '\"string\"', map())").schema
    except PySparkException as error:
        raise RuntimeError("Avro messages need Spark's spark-avro package on the class path") from error


def decoded(body: Column, schema_json: str, reader_json: str, permissive: bool) -> Column:
    """An Avro body as a struct. Undecodable input fails the job, or gives a struct of NULLs."""
    from pyspark.sql.avro.functions import from_avro

    mode = "PERMISSIVE" if permissive else "FAILFAST"
    return from_avro(body, schema_json, {"mode": mode, "avroSchema": reader_json})


def encoded(record: Column, schema_json: str) -> Column:
    """A struct as an Avro body."""
    from pyspark.sql.avro.functions import to_avro

    return to_avro(record, schema_json)
