"""A stream that goes on where a batch run ended."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import at, trades
from tickloom.operators import bars, go_on, hand_over
from tickloom.schema import TRADE
from tickloom.session import shared_path
from tickloom.streaming import start_query

MINUTE = timedelta(minutes=1)
TUMBLING, SLIDING = (MINUTE, None), (5 * MINUTE, MINUTE)
DELAY = timedelta(seconds=30)


def in_order(seed, n=240):
    """Trades in the order of their times, which come in clusters, gaps and ties."""
    draw = random.Random(seed)
    rows, moment = [], 0.0
    for _ in range(n):
        moment += draw.choice([0, 0, 1, 5, 20, 100])
        price, volume = draw.choice([None, 10.5, 11.0, 1e6]), draw.choice([None, 0.0, 3.0, 7.5])
        rows.append((draw.choice(["A", "B", None]), price, volume, at(moment)))
    return rows


def rounded(df):
    shown = [F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    return sorted(map(tuple, df.select(*shown).collect()), key=repr)


def run(spark, shape, first, batches, extremes=True):
    """(bars of the batch run, bars of the stream, which is started anew for each batch)"""
    seeds, source, out, progress = (shared_path(spark, n) for n in ("seeds", "in", "out", "progress"))
    done = hand_over(trades(spark, *first), seeds, *shape, DELAY, extremes)
    for rows in batches:
        trades(spark, *rows).coalesce(1).write.mode("append").parquet(source)
        stream = go_on(spark.readStream.schema(TRADE).parquet(source), seeds, *shape, DELAY, extremes)
        query = start_query(stream, "parquet", progress, trigger={"availableNow": True}, state_partitions=2, path=out)
        query.awaitTermination()
    return done, spark.read.schema(stream.schema).parquet(out)


@pytest.mark.parametrize(("shape", "extremes"), [(TUMBLING, True), (SLIDING, True), (SLIDING, False)])
@pytest.mark.parametrize("cut", [0, 1, 117])
def test_batch_and_stream_together_are_one_run(spark, shape, extremes, cut):
    rows = in_order(cut)
    done, went_on = run(spark, shape, rows[:cut], [rows[cut : cut + 40], rows[cut + 40 :]], extremes)
    last = max(r[3] for r in rows) - DELAY
    whole = bars(trades(spark, *rows), *shape, extremes=extremes)
    expected = rounded(whole.where(F.col("window_end") <= F.lit(last.isoformat()).cast("timestamp")))
    assert sorted(rounded(done) + rounded(went_on), key=repr) == expected
    assert cut < 100 or (done.count() > 10 and went_on.count() > 10)


def test_a_symbol_that_does_not_trade_again_gets_its_open_bars(spark):
    first = [("A", 1.0, 1.0, at(50)), ("B", 2.0, 2.0, at(70))]
    done, went_on = run(spark, TUMBLING, first, [[("B", 4.0, 2.0, at(80)), ("B", 1.0, 1.0, at(600))]])
    assert done.count() == 0
    found = {(r.symbol, r.window_start): r for r in went_on.collect()}
    assert len(found) == 2
    [b] = [r for (s, _), r in found.items() if s == "B"]
    assert (b.total_volume, b.avg_price, b.min_price, b.max_price, b.trade_count) == (4.0, 3.0, 2.0, 4.0, 2)
    assert b.volatility == pytest.approx(2**0.5) and b.vwap == 3.0


@pytest.mark.parametrize(("shape", "windows"), [(TUMBLING, 1), (SLIDING, 5)])
def test_trades_late_at_the_hand_over_change_nothing(spark, shape, windows):
    first = [("A", 1.0, 1.0, at(0)), ("A", 1.0, 1.0, at(400))]  # ended up to 370 s
    late = [("A", 9.0, 100.0, at(10)), ("A", 9.0, 100.0, at(299)), ("A", 1.0, 1.0, at(1200)), ("A", 1.0, 1.0, None)]
    done, went_on = run(spark, shape, first, [late])
    assert all(r.total_volume < 100 for r in [*done.collect(), *went_on.collect()])
    starts = [r.window_start for r in [*done.collect(), *went_on.collect()]]
    assert len(starts) == len(set(starts)) == 2 * windows  # each bar once


def test_an_empty_table_hands_over_nothing(spark):
    rows = in_order(9, 50)
    done, went_on = run(spark, SLIDING, [], [rows])
    assert done.count() == 0
    last = max(r[3] for r in rows) - DELAY
    whole = bars(trades(spark, *rows), *SLIDING)
    assert rounded(went_on) == rounded(whole.where(F.col("window_end") <= F.lit(last.isoformat()).cast("timestamp")))


def test_the_width_must_be_a_multiple_of_the_slide(spark):
    with pytest.raises(ValueError, match="multiple"):
        hand_over(trades(spark), shared_path(spark, "seeds"), timedelta(seconds=150), MINUTE)
