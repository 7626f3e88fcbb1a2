"""Appends with a ledger: replays, batches broken off, odd times; and bounded listings of days."""

import time
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import BASE, at, trades, volume_bars
from tickloom.operators import bars_1min
from tickloom.schema import FULL_BAR, TRADE
from tickloom.session import shared_path
from tickloom.sinks import REJECT_KEY, BatchTable, Ledger, ParquetTable, append_batch, append_new, reject_schema
from tickloom.sinks.tables import day_number
from tickloom.sources import read_lake
from tickloom.streaming import append_batches_once, start_query


@pytest.fixture
def table(spark):
    return BatchTable(shared_path(spark, "bars"), FULL_BAR)


@pytest.fixture
def ledger(spark):
    return Ledger(shared_path(spark, "ledger"))


def rows(table, spark):
    return sorted((r.symbol, r.total_volume) for r in table.read(spark).collect())


def test_a_repeated_batch_is_skipped(spark, table, ledger):
    batch = volume_bars(spark, "A", [1, 2])
    assert append_batch(batch, 0, table, ledger, "q").written == 2
    assert append_batch(batch, 0, table, ledger, "q") is None
    assert append_batch(volume_bars(spark, "B", [3]), 1, table, ledger, "q").written == 1
    assert append_batch(batch, 0, table, ledger, "q") is None  # an older one, too
    assert rows(table, spark) == [("A", 1.0), ("A", 2.0), ("B", 3.0)]
    assert sorted(p.name for p in Path(ledger.path, "q").iterdir() if p.suffix != ".crc") == ["1.done"]
    # Another query, or the same one with a new checkpoint, has batches of its own.
    assert append_batch(volume_bars(spark, "C", [4]), 0, table, ledger, "r").written == 1


@pytest.mark.parametrize("where", ["before the files", "after the files"])
def test_a_batch_broken_off_is_taken_back(spark, table, ledger, monkeypatch, where):
    append_batch(volume_bars(spark, "A", [1]), 0, table, ledger, "q")
    batch = volume_bars(spark, "B", [2, 3], BASE + timedelta(hours=9, minutes=29))  # over two days
    write = BatchTable.append

    def broken(self, df, rows=None):
        if where == "after the files":
            write(self, df.where("total_volume < 3"), rows)
        raise OSError("lost")

    monkeypatch.setattr(BatchTable, "append", broken)
    with pytest.raises(OSError):
        append_batch(batch, 1, table, ledger, "q")
    assert ledger.last(spark, "q") == (1, "open")
    assert ledger.days(spark, "q", 1) == ["2024-06-01"] or len(ledger.days(spark, "q", 1)) == 2
    monkeypatch.setattr(BatchTable, "append", write)
    assert append_batch(batch, 1, table, ledger, "q").written == 2
    assert rows(table, spark) == [("A", 1.0), ("B", 2.0), ("B", 3.0)]


def test_a_note_broken_off_names_no_days(spark, table, ledger):
    ledger.note(spark, "q", 0, "open", ["2024-06-01"])
    Path(ledger.path, "q", "0.open").write_text('["2024-')
    Path(ledger.path, "q", ".0.open.crc").unlink()
    assert ledger.days(spark, "q", 0) == []
    assert append_batch(volume_bars(spark, "A", [1]), 0, table, ledger, "q").written == 1


def test_flaws_conflicts_and_empty_batches(spark, table, ledger):
    rejects = ParquetTable(shared_path(spark, "rejects"), reject_schema(FULL_BAR), REJECT_KEY)
    batch = volume_bars(spark, "A", [1]).unionByName(volume_bars(spark, "A", [5])).unionByName(volume_bars(spark, None, [2]))
    done = append_batch(batch, 0, table, ledger, "q", rejects=rejects)
    assert (done.written, done.conflicts, done.flawed) == (1, 1, 1) and rejects.read(spark).count() == 2
    assert append_batch(batch.limit(0), 1, table, ledger, "q").rows == 0
    assert append_batch(batch, 1, table, ledger, "q") is None
    with pytest.raises(ValueError, match="taken back"):
        table.compact(spark, date(2024, 1, 1), date(2025, 1, 1))
    with pytest.raises(ValueError, match="name the query"):
        append_batch(batch, 0, table, ledger)


def test_a_stream_goes_on_after_a_crash_and_with_lost_progress(spark, table, ledger, tmp_path, monkeypatch):
    source, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    spent = []

    def run():
        stream = bars_1min(spark.readStream.schema(TRADE).parquet(source))
        query = start_query(
            stream, append_batches_once(table, ledger, report=lambda *done: spent.append(done)),
            checkpoint=progress, trigger={"availableNow": True}, state_partitions=2,
        )
        query.awaitTermination()

    trades(spark, ("A", 1.0, 5.0, at(0)), ("A", 1.0, 7.0, at(60)), ("A", 1.0, 1.0, at(300))).write.parquet(source)
    note = Ledger.note

    def broken(self, session, query, batch, state, days=()):
        if state == "done" and table.read(session).count():
            raise OSError("lost")
        note(self, session, query, batch, state, days)

    monkeypatch.setattr(Ledger, "note", broken)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(Ledger, "note", note)
    assert rows(table, spark) == [("A", 5.0), ("A", 7.0)]  # written, but not noted as done
    run()
    assert rows(table, spark) == [("A", 5.0), ("A", 7.0)]
    # The checkpoint forgets that the last batch was committed: it comes again, and is skipped.
    heard = len(spent)
    newest = max((p for p in Path(progress, "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    newest.unlink()
    (newest.parent / f".{newest.name}.crc").unlink(missing_ok=True)
    run()
    assert rows(table, spark) == [("A", 5.0), ("A", 7.0)] and len(spent) <= heard + 1


@pytest.mark.parametrize("kind", [ParquetTable, BatchTable])
def test_odd_times_cost_a_folder_each(spark, ledger, kind):
    table = kind(shared_path(spark, "bars"), FULL_BAR)
    bars = volume_bars(spark, "A", [1, 2]).unionByName(volume_bars(spark, "Z", [3], datetime(1970, 1, 1, tzinfo=timezone.utc)))
    far = volume_bars(spark, "Y", [4]).withColumns({c: F.timestamp_seconds(F.lit(300_000_000_000) + i * 60) for i, c in enumerate(("window_start", "window_end"))})
    batch = bars.unionByName(far).persist()
    batch.count()
    append_new(volume_bars(spark, "A", [1]), table)
    began = time.time()
    done = append_new(batch, table)
    assert (done.written, done.repeated) == (3, 1)
    assert append_new(batch, table).repeated == 4
    assert time.time() - began < 60
    assert table.between(spark, 0, 10**18).count() == 4
    assert table.latest(spark, "window_start DESC, symbol", 2).select("symbol").first().symbol == "Y"
    batch.unpersist()


def test_latest_ends_with_rows_without_a_time(spark):
    table = ParquetTable(shared_path(spark, "bars"), FULL_BAR)
    table.append(volume_bars(spark, "A", [1, 2]).unionByName(volume_bars(spark, "N", [3]).withColumn("window_start", F.lit(None).cast("timestamp"))))
    assert [r.symbol for r in table.latest(spark, "window_start DESC, symbol", 9).collect()] == ["A", "A", "N"]
    assert [r.symbol for r in table.latest(spark, "window_start DESC, symbol", 2).collect()] == ["A", "A"]


def test_day_numbers():
    for text, number in (("1970-01-01", 0), ("2024-02-29", 19782), ("0001-01-01", -719162), ("9999-12-31", 2932896), ("+10000-01-01", 2932897), ("0000-12-31", -719163)):
        assert day_number(text) == number
    assert day_number("__HIVE_DEFAULT_PARTITION__") is None and day_number("2024") is None


def test_long_ranges_of_a_lake_list_what_exists(spark, tmp_path):
    from tickloom.sinks import append_to_lake

    path = str(tmp_path / "lake")
    append_to_lake(trades(spark, ("A", 1.0, 5.0, at(0)), ("B", 1.0, 7.0, at(86400 * 40)), ("C", 1.0, 7.0, at(86400 * 400))), path)
    began = time.time()
    found = read_lake(spark, path, datetime(1000, 1, 1), datetime(9000, 1, 1)).select("symbol").collect()
    assert sorted(r.symbol for r in found) == ["A", "B", "C"] and time.time() - began < 30
    assert [r.symbol for r in read_lake(spark, path, datetime(2024, 6, 2), datetime(2025, 1, 1)).collect()] == ["B"]
    assert read_lake(spark, path, datetime(2025, 1, 1), datetime(2024, 1, 1)).count() == 0
