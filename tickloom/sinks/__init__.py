from tickloom.sinks.batch_lake import BatchLake
from tickloom.sinks.kafka import publish
from tickloom.sinks.keyed import REJECT_KEY, Appended, append_new, reject_schema
from tickloom.sinks.ledger import BatchTable, Ledger, append_batch
from tickloom.sinks.lake import append_to_lake, compact_lake, lake_stream
from tickloom.sinks.tables import JdbcTable, ParquetTable

__all__ = [
    "REJECT_KEY",
    "Appended",
    "BatchLake",
    "BatchTable",
    "JdbcTable",
    "Ledger",
    "ParquetTable",
    "append_batch",
    "append_new",
    "append_to_lake",
    "compact_lake",
    "lake_stream",
    "publish",
    "reject_schema",
]
