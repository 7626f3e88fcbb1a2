"""Messages to envelope columns and back: framed Avro, and JSON text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import wire_body, wire_header
from tickloom.functions.avro import decoded, encoded, require_avro, spark_schema
from tickloom.schema import ENVELOPE

_PAYLOAD = "_payload"


def _once(messages: DataFrame, payload: Column) -> DataFrame:
    """Add a computed struct so that it is computed once per message.

    Unpacked from a one-element array it stays where it is. As a plain column it would be copied
    into every filter and projection that Spark moves below it.
    """
    return messages.select("*", F.inline(F.array(F.struct(payload.alias(_PAYLOAD)))))


def _any_set(names: list[str]) -> Column:
    return reduce(or_, [F.col(_PAYLOAD)[name].isNotNull() for name in names])


def decode_messages(
    messages: DataFrame,
    schema_json: str,
    on_error: str = "fail",
    reader_json: str | None = None,
    value: str = "value",
) -> DataFrame:
    """The fields of framed Avro messages as columns, on a table or on a stream.

    The 5-byte frame is dropped unread. A message that cannot be decoded, NULL included, fails the
    query, or is left out with on_error='skip'; decode_or_reject() gives those as well.
    `reader_json` declares the subset of fields to produce. Needs spark-avro.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError(f"on_error must be 'fail' or 'skip', not {on_error!r}")
    names = spark_schema(reader_json or schema_json).names
    spark_schema(schema_json)  # unsupported declarations fail here, on the driver
    require_avro(messages.sparkSession)
    payload = decoded(wire_body(F.col(value)), schema_json, reader_json or schema_json, on_error == "skip")
    if on_error == "fail":
        missing = F.raise_error(F.lit("NULL message")).cast(spark_schema(reader_json or schema_json))
        payload = F.when(F.col(value).isNotNull(), payload).otherwise(missing)
        return _once(messages, payload).select(f"{_PAYLOAD}.*")
    return _once(messages, payload).where(_any_set(names)).select(f"{_PAYLOAD}.*")


def decode_or_reject(
    messages: DataFrame, schema_json: str, reader_json: str | None = None, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """(decoded columns, rejected messages with `problems`). Needs spark-avro.

    Spark marks an undecodable message by a record of NULLs, so a valid record all of whose
    fields are NULL is rejected as well.
    """
    names = spark_schema(reader_json or schema_json).names
    require_avro(messages.sparkSession)
    rows = _once(messages, decoded(wire_body(F.col(value)), schema_json, reader_json or schema_json, True))
    problem = F.when(F.col(value).isNull(), "message missing").otherwise("message undecodable")
    rejects = rows.where(~_any_set(names)).withColumn("problems", problem).drop(_PAYLOAD)
    return rows.where(_any_set(names)).select(f"{_PAYLOAD}.*"), rejects


def encode_messages(envelopes: DataFrame, schema_json: str, schema_id: int) -> DataFrame:
    """One framed Avro `value` per row, ready for a Kafka sink. Needs spark-avro."""
    names = spark_schema(schema_json).names
    require_avro(envelopes.sparkSession)
    body = encoded(F.struct(*names), schema_json)
    return envelopes.select(F.concat(wire_header(schema_id), body).alias("value"))


def parse_json_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Envelope columns from JSON text; text that is not a JSON object, NULL included, fails the
    query."""
    text = F.coalesce(F.nullif(F.trim(F.col(value)), F.lit("")), F.lit("not an object"))
    return _once(messages, F.from_json(text, ENVELOPE, {"mode": "FAILFAST"})).select(f"{_PAYLOAD}.*")


def parse_json_or_reject(
    messages: DataFrame, value: str = "value", observe: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(envelope columns, rejected messages with `problems`), on a table or on a stream.

    NULL, blank and malformed texts are rejected. `observe` names an observation of the columns
    `messages` and `rejected`, which a streaming query reports with its progress. The two frames
    are two reads of the messages: in a batch function, pass a cached batch.
    """
    kept = T.StructType([*ENVELOPE.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json(F.col(value), kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = _once(messages, parsed)
    blank = F.coalesce(F.trim(F.col(value)) == "", F.lit(True))
    problem = (
        F.when(F.col(value).isNull(), "message missing")
        .when(blank, "message blank")
        .when(F.col(_PAYLOAD).isNull() | F.col(_PAYLOAD)["_bad"].isNotNull(), "message malformed")
    )
    rows = rows.select("*", F.inline(F.array(F.struct(problem.alias("problems")))))
    if observe is not None:
        rows = rows.observe(
            observe, F.count("*").alias("messages"), F.count_if(F.col("problems").isNotNull()).alias("rejected")
        )
    good = rows.where(F.col("problems").isNull()).select(*[f"{_PAYLOAD}.{name}" for name in ENVELOPE.names])
    return good, rows.where(F.col("problems").isNotNull()).drop(_PAYLOAD)
