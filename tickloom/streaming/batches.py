"""Batch functions for foreachBatch. They close over table descriptions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

from tickloom.operators import volume_spikes
from tickloom.operators.spikes import FACTOR, SALTS
from tickloom.sinks import Appended, BatchTable, JdbcTable, Ledger, ParquetTable, append_batch, append_new

Table = JdbcTable | ParquetTable
# Called with the number of the batch, the name of the output, and what was appended.
Report = Callable[[int, str, Appended], None]


def append_batches(
    table: Table,
    stamped: str | None = None,
    rejects: Table | None = None,
    report: Report | None = None,
    name: str = "rows",
) -> Callable[[DataFrame, int], None]:
    """Append each micro-batch to a table, replay-safe; empty batches write nothing.

    `stamped` names a column to add with the time of the write. `report` hears what each batch
    came to.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        done = append_new(batch, table, rejects=rejects, stamped=stamped)
        if report is not None:
            report(batch_id, name, done)

    return write


def append_batches_once(
    table: BatchTable,
    ledger: Ledger,
    stamped: str | None = None,
    rejects: Table | None = None,
    report: Report | None = None,
    name: str = "rows",
) -> Callable[[DataFrame, int], None]:
    """As append_batches(), but a ledger finds repeated batches, and no stored key is read.

    `report` hears nothing of a batch that the ledger has as done.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        done = append_batch(batch, batch_id, table, ledger, rejects=rejects, stamped=stamped)
        if report is not None and done is not None:
            report(batch_id, name, done)

    return write


def write_bars_and_spikes(
    bars: Table | None,
    anomalies: Table,
    factor: float = FACTOR,
    stamped: bool = False,
    salts: int = SALTS,
    rejects: Table | None = None,
    report: Report | None = None,
) -> Callable[[DataFrame, int], None]:
    """Append each micro-batch of closed bars, then the spikes within that micro-batch.

    One query feeds both tables: the window state exists once and the batch is computed
    once. An empty batch ends before the spikes are looked for. `stamped` adds ingested_at and
    detected_at where the tables do not fill them. Bars without a symbol go to `rejects`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if bars is not None:
                done = append_new(batch, bars, rejects=rejects, stamped="ingested_at" if stamped else None)
                if report is not None:
                    report(batch_id, "bars", done)
                empty = not done.rows
            else:
                empty = batch.isEmpty()
            if empty:
                return
            spikes = volume_spikes(batch, factor, salts)
            append_batches(anomalies, "detected_at" if stamped else None, report=report, name="anomalies")(
                spikes, batch_id
            )
        finally:
            batch.unpersist()

    return write
