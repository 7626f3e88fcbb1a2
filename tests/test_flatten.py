import math

import pytest
from pyspark.sql import functions as F

from helpers import at, clock, envelopes, item, plan_of, trades
from tickloom.operators import allow_symbols, first_messages, flatten_trades
from tickloom.schema import SLIM_ENVELOPE, TRADE
from tickloom.session import shared_path
from tickloom.sources import read_envelopes


def test_only_trade_envelopes_become_rows(spark):
    rows = envelopes(spark, ("trade", [item("KLM", 41.75, 30.0, at(0))]), ("ping", []))
    [row] = clock(flatten_trades(rows), "event_time").collect()
    assert row.asDict() == {
        "symbol": "KLM",
        "price": 41.75,
        "volume": 30.0,
        "event_time": "14:30:00",
    }


def test_columns_and_types(spark):
    flat = flatten_trades(envelopes(spark, ("trade", [])))
    assert [(f.name, f.dataType) for f in flat.schema] == [(f.name, f.dataType) for f in TRADE]


def test_null_type_null_list_and_empty_list_yield_nothing(spark):
    one = [item("A", 1.0, 1.0, at(0))]
    rows = envelopes(spark, (None, one), ("trade", None), ("trade", []), ("ping", one))
    assert flatten_trades(rows).count() == 0


def test_every_item_becomes_a_row_with_its_milliseconds(spark):
    data = [item("A", float(i), 1.0, at(i / 1000)) for i in range(5)]
    flat = flatten_trades(envelopes(spark, ("trade", data), ("trade", data[:2])))
    assert flat.count() == 7
    times = flat.select(F.date_format("event_time", "HH:mm:ss.SSS").alias("t")).distinct()
    assert sorted(row.t for row in times.collect()) == [f"14:30:00.00{i}" for i in range(5)]


def test_missing_time_stays_null(spark):
    [row] = flatten_trades(envelopes(spark, ("trade", [item("A", 1.0, 1.0, None)]))).collect()
    assert row.event_time is None


def test_allow_symbols(spark):
    rows = trades(spark, *[(s, 1.0, 1.0, at(0)) for s in ("A", "B", "C", None)])
    kept = allow_symbols(rows, ["A", "C"])
    assert sorted(row.symbol for row in kept.collect()) == ["A", "C"]


def test_allow_symbols_reaches_the_scan(spark):
    path = shared_path(spark, "trades")
    trades(spark, ("A", 1.0, 1.0, at(0))).write.parquet(path)
    plan = plan_of(allow_symbols(spark.read.parquet(path), ["A", "B"]))
    assert "In(symbol, [A,B])" in plan


@pytest.mark.parametrize("n, expected", [(2, ["m0", "m1"]), (-1, ["m0", "m1", "m2"]), (0, ["m0", "m1", "m2"])])
def test_first_messages(spark, n, expected):
    rows = spark.createDataFrame([(2, "m2"), (0, "m0"), (1, "m1")], "number int, message string")
    first = first_messages(rows, n, "number")
    assert sorted(row.message for row in first.collect()) == expected


def test_first_messages_is_a_top_k(spark):
    rows = spark.range(100).withColumnRenamed("id", "number")
    assert "TakeOrderedAndProject(limit=3" in plan_of(first_messages(rows, 3, "number"))


def test_scan_takes_the_type_filter_and_leaves_conditions_alone(spark):
    path = shared_path(spark, "envelopes")
    envelopes(spark, ("trade", [item("A", 1.0, 2.0, at(0))]), ("ping", [])).write.parquet(path)
    flat = flatten_trades(read_envelopes(spark, path))
    assert flat.count() == 1
    plan = plan_of(flat)
    assert "EqualTo(type,trade)" in plan
    assert "p:double,s:string,t:bigint,v:double>" in plan
    assert "c:array" not in plan
    assert read_envelopes(spark, path).schema == SLIM_ENVELOPE
    assert "c" in str(read_envelopes(spark, path, conditions=True).schema["data"].dataType)


def test_flatten_stays_in_the_jvm(spark):
    plan = plan_of(flatten_trades(envelopes(spark, ("trade", []))))
    assert "Python" not in plan and "Exchange" not in plan


def test_nan_and_infinity_pass_through(spark):
    data = [item("A", math.nan, math.inf, at(0))]
    [row] = flatten_trades(envelopes(spark, ("trade", data))).collect()
    assert math.isnan(row.price) and row.volume == math.inf
