from tickloom.streaming.batches import append_batches, append_batches_once, write_bars_and_spikes
from tickloom.streaming.late import DroppedRows, Marks, came_late, lake_batches
from tickloom.streaming.open import open_bars, with_open_bars
from tickloom.streaming.queries import start_query, wait_for_all, wait_for_any

__all__ = [
    "DroppedRows",
    "Marks",
    "append_batches",
    "append_batches_once",
    "came_late",
    "lake_batches",
    "open_bars",
    "start_query",
    "wait_for_all",
    "wait_for_any",
    "with_open_bars",
    "write_bars_and_spikes",
]
