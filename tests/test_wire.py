import json

import pytest
from pyspark.sql import types as T

from helpers import at, envelopes, millis, plan_of
from tickloom.functions import wire_body, wire_header
from tickloom.functions.avro import require_avro, spark_schema
from tickloom.operators import flatten_trades
from tickloom.operators.wire import (
    decode_messages,
    decode_or_reject,
    encode_messages,
    parse_json_messages,
    parse_json_or_reject,
)
from tickloom.schema import ENVELOPE, ENVELOPE_AVRO, SLIM_ENVELOPE, SLIM_ENVELOPE_AVRO


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


# Avro: the package is not installed here, so only declarations, the frame and the plain failure
# are checked.


def test_declarations_give_the_envelope():
    assert spark_schema(ENVELOPE_AVRO) == ENVELOPE
    assert spark_schema(SLIM_ENVELOPE_AVRO) == SLIM_ENVELOPE


def test_frame(spark):
    rows = spark.createDataFrame([(b"\x00\x00\x01\x11\x70body",), (b"\x00\x01",), (None,)], "value binary")
    found = rows.select(wire_body(rows["value"]), wire_header(70000)).collect()
    assert [None if r[0] is None else bytes(r[0]) for r in found] == [b"body", b"", None]
    assert bytes(found[0][1]) == b"\x00\x00\x01\x11\x70"


def test_without_the_package_everything_fails_plainly(spark):
    messages = spark.createDataFrame([(b"\x00" * 8,)], "value binary")
    for call in (
        lambda: decode_messages(messages, ENVELOPE_AVRO),
        lambda: decode_messages(messages, ENVELOPE_AVRO, on_error="skip"),
        lambda: decode_or_reject(messages, ENVELOPE_AVRO),
        lambda: encode_messages(envelopes(spark, ("trade", [])), ENVELOPE_AVRO, 1),
        lambda: require_avro(spark),
    ):
        with pytest.raises(RuntimeError, match="spark-avro"):
            call()


def test_unknown_error_policy(spark):
    with pytest.raises(ValueError, match="on_error"):
        decode_messages(texts(spark, "x"), ENVELOPE_AVRO, on_error="ignore")


def record(kind):
    return json.dumps({"type": "record", "name": "r", "fields": [{"name": "x", "type": kind}]})


@pytest.mark.parametrize(
    "kind, expected",
    [
        ("string", T.StringType()),
        ("int", T.IntegerType()),
        ("long", T.LongType()),
        ("float", T.FloatType()),
        ("double", T.DoubleType()),
        ("boolean", T.BooleanType()),
        (["null", "double"], T.DoubleType()),
        (["string", "null"], T.StringType()),
        ({"type": "array", "items": ["null", "int"]}, T.ArrayType(T.IntegerType())),
    ],
)
def test_types(kind, expected):
    assert spark_schema(record(kind)) == T.StructType([T.StructField("x", expected)])


@pytest.mark.parametrize(
    "kind",
    ["bytes", "null", ["null"], ["null", "long", "string"], {"type": "map", "values": "int"}, "other.Record"],
)
def test_unsupported_types(kind):
    with pytest.raises(ValueError, match="Avro type"):
        spark_schema(record(kind))


# JSON

GOOD = json.dumps({"type": "trade", "data": [{"p": 2, "s": "A", "t": millis(at(1)), "v": 3.5}]})


def test_json_text_becomes_an_envelope(spark):
    parsed = parse_json_messages(texts(spark, GOOD))
    assert parsed.schema == ENVELOPE
    [row] = flatten_trades(parsed).collect()
    assert (row.symbol, row.price, row.volume) == ("A", 2.0, 3.5)


@pytest.mark.parametrize("bad", ["{not json", "", "  ", None, "[1"])
def test_text_that_is_no_object_fails(spark, bad):
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        parse_json_messages(texts(spark, GOOD, bad)).collect()


def test_bad_texts_are_rejected_and_good_ones_kept(spark):
    good, rejected = parse_json_or_reject(texts(spark, GOOD, None, " ", "{cut", GOOD))
    assert good.schema == ENVELOPE and good.count() == 2
    assert sorted(map(tuple, rejected.collect()), key=repr) == [
        (" ", "message blank"),
        ("{cut", "message malformed"),
        (None, "message missing"),
    ]


def test_a_stream_reports_how_many_it_rejected(spark):
    from tickloom.session import shared_path
    from tickloom.streaming import start_query, wait_for_all

    path = shared_path(spark, "texts")
    texts(spark, GOOD, "{cut", GOOD).write.parquet(path)
    stream = spark.readStream.schema("value string").parquet(path)
    good, _ = parse_json_or_reject(stream, observe="messages")
    seen = []
    query = start_query(
        good, lambda batch, _: seen.extend(batch.collect()), shared_path(spark, "progress"), trigger={"availableNow": True}
    )
    wait_for_all([query])
    assert len(seen) == 2
    observed = query.recentProgress[0].observedMetrics["messages"]
    assert (observed.messages, observed.rejected) == (3, 1)


def test_text_is_parsed_once(spark):
    good, rejected = parse_json_or_reject(texts(spark, GOOD))
    for rows in (flatten_trades(parse_json_messages(texts(spark, GOOD))), flatten_trades(good), rejected):
        optimised = rows._jdf.queryExecution().optimizedPlan().toString()
        assert optimised.count("from_json") == 1
