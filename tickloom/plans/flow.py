"""The trade flow: envelopes to the lake, to bars and to anomalies."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators import bars_1min, bars_5min, flatten_trades, running_spikes, volume_spikes
from tickloom.operators.spikes import FACTOR, SALTS
from tickloom.session import store
from tickloom.sinks import BatchLake, JdbcTable, ParquetTable, lake_stream
from tickloom.streaming import Marks, append_batches, lake_batches, start_query, write_bars_and_spikes
from tickloom.streaming.batches import Report

Table = JdbcTable | ParquetTable


def start_flow(
    envelopes: DataFrame,
    checkpoints: str,
    minute_bars: Table,
    five_minute_bars: Table,
    anomalies: Table,
    lake: str | BatchLake | None = None,
    trigger: dict[str, Any] | None = None,
    state_partitions: int | None = None,
    stamped: bool = False,
    factor: float = FACTOR,
    salts: int = SALTS,
    minute_rejects: Table | None = None,
    five_minute_rejects: Table | None = None,
    report: Report | None = None,
    running_anomalies: Table | None = None,
    late: BatchLake | None = None,
) -> list[StreamingQuery]:
    """Start the flow on a stream of envelopes, from Kafka or from files.

    Bars without a symbol, and bars that contradict stored ones, go to the rejects tables (see
    append_new); without such a table they end the flow. Three queries: raw trades to the lake (if a folder is given), 1-minute bars together
    with their anomalies, and 5-minute bars. Each has its own checkpoint below
    `checkpoints`, so a restarted flow goes on where it stopped, with its window state.

    The anomalies are those within a micro-batch. With `running_anomalies` a fourth query also looks for
    bars above the mean of all their symbol's bars so far, which can fire when a batch closes one bar.

    A lake given as a path is written by Spark's file sink, a BatchLake batch by batch. With the latter, `late`
    takes the trades that come after the end of their minute, see lake_batches().
    """
    if late is not None and not isinstance(lake, BatchLake):
        raise ValueError("late trades are put aside on the way to a BatchLake")
    trades = flatten_trades(envelopes)
    shared = {"trigger": trigger, "state_partitions": state_partitions}
    queries = []
    if isinstance(lake, BatchLake):
        marks = None if late is None else Marks(f"{checkpoints}/marks")
        write = lake_batches(lake, late, marks)
        queries.append(start_query(trades, write, checkpoint=f"{checkpoints}/lake", trigger=trigger))
    elif lake is not None:
        queries.append(
            start_query(lake_stream(trades, lake), checkpoint=f"{checkpoints}/lake", trigger=trigger)
        )
    queries.append(
        start_query(
            bars_1min(trades),
            write_bars_and_spikes(
                minute_bars, anomalies, factor, stamped, salts, minute_rejects, report
            ),
            checkpoint=f"{checkpoints}/bars_1min",
            **shared,
        )
    )
    queries.append(
        start_query(
            bars_5min(trades),
            append_batches(
                five_minute_bars,
                "ingested_at" if stamped else None,
                five_minute_rejects,
                report,
                "five_minute_bars",
            ),
            checkpoint=f"{checkpoints}/bars_5min",
            **shared,
        )
    )
    if running_anomalies is not None:
        found = running_spikes(bars_1min(trades), factor)
        write = append_batches(
            running_anomalies, "detected_at" if stamped else None, report=report, name="running_anomalies"
        )
        queries.append(start_query(found, write, checkpoint=f"{checkpoints}/running_anomalies", **shared))
    return queries


def bars_of_messages(
    envelopes: DataFrame, make_bars: Callable[[DataFrame], DataFrame] = bars_1min
) -> DataFrame:
    """Flatten and aggregate in one plan, on a table or on a stream."""
    return envelopes.transform(flatten_trades).transform(make_bars)


def spikes_of_trades(
    trades: DataFrame,
    make_bars: Callable[[DataFrame], DataFrame] = bars_1min,
    factor: float = FACTOR,
    salts: int = SALTS,
) -> DataFrame:
    """Volume spikes straight from a table of trades, all bars counting as one batch.

    The columns of the bars that matter are stored in the shared folder first, so the
    trades are scanned and aggregated once; remove_stored() deletes the copy.
    """
    bars = make_bars(trades).select(
        "symbol", "window_start", "window_end", "total_volume", "avg_price", "vwap"
    )
    return volume_spikes(store(bars, "bars"), factor, salts)
