import random
import statistics
from collections import defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import BASE, at, clock, envelopes, item, plan_of, trades
from tickloom.operators import bars, bars_1min, bars_5min
from tickloom.operators.bars import FIVE_MINUTES, MINUTE
from tickloom.plans import bars_of_messages
from tickloom.schema import FULL_BAR, SHORT_BAR
from tickloom.session import settings


def both_plans(spark, rows, width=FIVE_MINUTES, slide=MINUTE):
    return [bars(rows, width, slide, panes=panes) for panes in (True, False)]


def test_minute_bar_values(spark):
    data = [item("KLM", 40.0, 3.0, at(12)), item("KLM", 46.0, 9.0, at(31))]
    found = bars_of_messages(envelopes(spark, ("trade", data)))
    [row] = clock(found, "window_start", "window_end").collect()
    assert (row.window_start, row.window_end, row.symbol) == ("14:30:00", "14:31:00", "KLM")
    assert (row.total_volume, row.min_price, row.max_price, row.trade_count) == (12, 40, 46, 2)
    assert row.avg_price == pytest.approx(43)
    assert row.vwap == pytest.approx((3 * 40 + 9 * 46) / 12)
    assert row.volatility == pytest.approx(statistics.stdev([40, 46]))


def test_schemas(spark):
    rows = trades(spark, ("X", 1.0, 1.0, at(0)))
    for found, expected in ((bars_1min(rows), FULL_BAR), (bars_5min(rows), SHORT_BAR)):
        assert [(f.name, f.dataType) for f in found.schema] == [
            (f.name, f.dataType) for f in expected
        ]


def test_one_trade_falls_into_five_sliding_windows(spark):
    rows = trades(spark, ("Q", 7.5, 4.0, BASE + timedelta(hours=2, minutes=10, seconds=17)))
    for found in both_plans(spark, rows):
        shown = clock(found, "window_start", "window_end").orderBy("window_start").collect()
        assert [row.window_start for row in shown] == [
            "16:36:00", "16:37:00", "16:38:00", "16:39:00", "16:40:00",
        ]
        assert [row.window_end for row in shown] == [
            "16:41:00", "16:42:00", "16:43:00", "16:44:00", "16:45:00",
        ]
        assert {(row.total_volume, row.avg_price, row.vwap, row.volatility) for row in shown} == {
            (4.0, 7.5, 7.5, None)
        }


def test_window_edges_are_half_open(spark):
    rows = trades(spark, ("A", 1.0, 1.0, at(59.999)), ("A", 1.0, 1.0, at(60)))
    starts = clock(bars_1min(rows), "window_start").select("window_start").collect()
    assert sorted(row.window_start for row in starts) == ["14:30:00", "14:31:00"]


def test_zero_volume_gives_null_vwap(spark):
    rows = trades(spark, ("A", 7.0, 0.0, at(0)))
    for found in (bars_1min(rows), bars_5min(rows), *both_plans(spark, rows)):
        assert {(row.total_volume, row.vwap) for row in found.collect()} == {(0.0, None)}


def test_single_trade_has_no_volatility(spark):
    [row] = bars_1min(trades(spark, ("A", 7.0, 1.0, at(0)))).collect()
    assert row.volatility is None and row.vwap == 7.0


def test_null_symbol_is_a_group_and_null_time_is_dropped(spark):
    rows = trades(
        spark, (None, 1.0, 1.0, at(0)), (None, 3.0, 1.0, at(1)), ("A", 1.0, 1.0, None)
    )
    [row] = bars_1min(rows).collect()
    assert (row.symbol, row.trade_count, row.avg_price) == (None, 2, 2.0)
    for found in both_plans(spark, rows):
        assert {(row.symbol, row.trade_count) for row in found.collect()} == {(None, 2)}


def test_null_prices_and_volumes_are_left_out_of_measures_but_counted(spark):
    rows = trades(
        spark,
        ("A", None, 4.0, at(0)),
        ("A", 10.0, None, at(1)),
        ("A", 20.0, 2.0, at(2)),
        ("B", None, None, at(3)),
    )
    expected = {
        "A": (6.0, 15.0, 10.0, 20.0, 3, pytest.approx(statistics.stdev([10, 20])), 40 / 6),
        "B": (None, None, None, None, 1, None, None),
    }
    for found in (bars_1min(rows), *both_plans(spark, rows)):
        for row in found.collect():
            assert tuple(row)[3:] == expected[row.symbol]


def brute_force(rows, width, slide):
    """(start second, symbol) -> prices and volumes of its trades."""
    groups = defaultdict(list)
    for symbol, price, volume, moment in rows:
        second = moment.timestamp()
        start = second // slide * slide
        while start > second - width:
            groups[int(start), symbol].append((price, volume))
            start -= slide
    return groups


@pytest.mark.parametrize(
    "width, slide",
    [(60, 60), (300, 60), (300, 100), (300, 70), (120, 120), (3600, 60), (200, 1)],
    ids=[
        "tumbling", "sliding", "three panes", "no whole panes", "same slide", "sixty panes",
        "more panes than a block holds",
    ],
)
def test_against_brute_force(spark, width, slide):
    draw = random.Random(width + slide)
    rows = [
        (
            draw.choice(["HOT", "HOT", "A", "B", "C"]),
            round(draw.uniform(90, 110), 2),
            float(draw.randrange(0, 50)),
            at(round(draw.uniform(0, 2400), 3)),
        )
        for _ in range(600)
    ]
    expected = brute_force(rows, width, slide)
    table = trades(spark, *rows)
    for panes in (True, False):
        found = bars(table, timedelta(seconds=width), timedelta(seconds=slide), panes=panes)
        shown = found.selectExpr("unix_seconds(window_start) start", "unix_seconds(window_end) end", "*")
        got = {(row.start, row.symbol): row for row in shown.collect()}
        assert got.keys() == expected.keys()
        for key, pairs in expected.items():
            row, prices = got[key], [price for price, _ in pairs]
            volume = sum(v for _, v in pairs)
            assert row.end - row.start == width
            assert row.trade_count == len(pairs)
            assert row.total_volume == pytest.approx(volume)
            assert row.avg_price == pytest.approx(statistics.fmean(prices))
            assert (row.min_price, row.max_price) == (min(prices), max(prices))
            spread = statistics.stdev(prices) if len(prices) > 1 else None
            assert row.volatility == (spread if spread is None else pytest.approx(spread, abs=1e-9))
            weighted = sum(p * v for p, v in pairs) / volume if volume else None
            assert row.vwap == (weighted if weighted is None else pytest.approx(weighted))


def test_pane_merge_is_stable_for_large_prices_with_small_spread(spark):
    prices = [1e9 + step / 8 for step in (0, 1, 2, 3, 4, 5)]
    rows = trades(spark, *[("A", p, 1.0, at(20 * i)) for i, p in enumerate(prices)])
    full = bars(rows, FIVE_MINUTES, MINUTE).where("trade_count = 6").collect()
    assert full
    for row in full:
        assert row.volatility == pytest.approx(statistics.stdev(prices), rel=1e-6)


def test_trades_are_aggregated_before_they_are_copied_into_sliding_windows(spark):
    rows = trades(spark, ("A", 1.0, 1.0, at(0)))
    # Plans are printed from the result down to the source.
    plan = plan_of(bars_5min(rows))
    copied = plan.index("Generate explode(sequence")
    assert "HashAggregate" in plan[copied:] and "Expand" not in plan
    # Two shuffles, none of them of the copies.
    assert plan.count("Exchange hashpartitioning") == 2 and "Exchange" not in plan[:copied]
    direct = plan_of(bars(rows, FIVE_MINUTES, MINUTE, panes=False))
    assert "HashAggregate" not in direct[direct.index("Expand") :]


def test_a_busy_symbol_is_merged_by_many_tasks(spark):
    rows = trades(spark, *[("HOT", 1.0, 1.0, at(60 * i)) for i in range(2000)])
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        parts = bars_5min(rows).select(F.spark_partition_id()).distinct().count()
    assert parts == 4


def test_tumbling_bars_take_one_shuffle_with_partial_aggregation(spark):
    plan = plan_of(bars_1min(trades(spark, ("A", 1.0, 1.0, at(0)))))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan and "Python" not in plan and "Expand" not in plan


def test_panes_are_a_choice_of_the_caller(spark):
    rows = trades(spark, ("A", 1.0, 1.0, at(0)))
    assert "Expand" in plan_of(bars_5min(rows, panes=False))
