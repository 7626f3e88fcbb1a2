from datetime import datetime, timedelta, timezone
from pathlib import Path
from unittest.mock import MagicMock

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import BASE, at, plan_of, trades, volume_bars
from tickloom.schema import FULL_BAR
from tickloom.session import remove_stored, settings, shared_path, store
from tickloom.sinks import (
    REJECT_KEY,
    Appended,
    JdbcTable,
    ParquetTable,
    append_new,
    append_to_lake,
    compact_lake,
    publish,
    reject_schema,
)
from tickloom.sources import read_lake


@pytest.fixture
def bar_table(spark):
    return ParquetTable(shared_path(spark, "bars"), FULL_BAR)


def local(path: str) -> Path:
    return Path(path.removeprefix("file:"))


def volumes(spark, table):
    return sorted(row.total_volume for row in table.read(spark).collect())


# Keyed appends


def test_a_replayed_batch_is_written_once(spark, bar_table):
    batch = volume_bars(spark, "A", [1, 2, 3])
    assert append_new(batch, bar_table) == Appended(3, written=3)
    assert append_new(batch, bar_table) == Appended(3, repeated=3)
    assert volumes(spark, bar_table) == [1.0, 2.0, 3.0]


def test_only_the_missing_part_of_a_batch_is_written(spark, bar_table):
    append_new(volume_bars(spark, "A", [1, 2]), bar_table)
    append_new(volume_bars(spark, "A", [1, 2, 3]), bar_table)
    append_new(volume_bars(spark, "B", [7]), bar_table)
    assert volumes(spark, bar_table) == [1.0, 2.0, 3.0, 7.0]


def test_duplicates_within_a_batch_are_written_once(spark, bar_table):
    batch = volume_bars(spark, "A", [1, 2])
    append_new(batch.unionByName(batch), bar_table)
    assert volumes(spark, bar_table) == [1.0, 2.0]


def test_an_empty_batch_touches_no_table(spark):
    table = MagicMock(time="window_start", key=("window_start", "symbol"))
    assert append_new(volume_bars(spark, "A", []), table) == Appended()
    table.append.assert_not_called()
    table.between.assert_not_called()


def test_missing_key_columns_fail_the_write(spark, bar_table):
    batch = volume_bars(spark, None, [1]).unionByName(volume_bars(spark, "A", [2]))
    with pytest.raises(ValueError, match="1 rows lack one of"):
        append_new(batch, bar_table)
    assert volumes(spark, bar_table) == []


@pytest.fixture
def reject_table(spark):
    return ParquetTable(shared_path(spark, "rejects"), reject_schema(FULL_BAR), REJECT_KEY)


def test_missing_key_columns_go_to_the_rejects_once(spark, bar_table, reject_table):
    batch = volume_bars(spark, None, [1]).unionByName(volume_bars(spark, "A", [2]))
    timeless = volume_bars(spark, "B", [3]).withColumn("window_start", F.lit(None).cast("timestamp"))
    for batches, done in ((batch, Appended(2, 1, flawed=1)), (batch, Appended(2, repeated=1, flawed=1))):
        assert append_new(batches, bar_table, rejects=reject_table) == done
    for _ in range(2):
        assert append_new(timeless, bar_table, rejects=reject_table) == Appended(1, flawed=1)
    assert volumes(spark, bar_table) == [2.0]
    assert sorted(row.problems for row in reject_table.read(spark).collect()) == [
        "symbol missing",
        "window_start missing",
    ]


def test_other_values_under_a_stored_key_are_a_conflict(spark, bar_table, reject_table):
    append_new(volume_bars(spark, "A", [1, 2]), bar_table)
    changed = volume_bars(spark, "A", [1, 9, 3])
    with pytest.raises(ValueError, match="1 rows have a key stored with other values"):
        append_new(changed, bar_table)
    assert volumes(spark, bar_table) == [1.0, 2.0]
    for written, repeated in ((1, 1), (0, 2)):
        done = append_new(changed, bar_table, rejects=reject_table)
        assert done == Appended(3, written, repeated, conflicts=1)
    assert volumes(spark, bar_table) == [1.0, 2.0, 3.0]
    [lost] = reject_table.read(spark).collect()
    assert (lost.total_volume, lost.problems) == (9.0, "key stored with other values")


def test_rows_of_a_batch_that_share_a_key_and_differ(spark, bar_table, reject_table):
    batch = volume_bars(spark, "A", [5]).unionByName(volume_bars(spark, "A", [4]))
    assert append_new(batch, bar_table, rejects=reject_table) == Appended(2, 1, conflicts=1)
    assert volumes(spark, bar_table) == [4.0]


def test_a_repeat_that_differs_in_the_last_bits_is_no_conflict(spark, bar_table):
    append_new(volume_bars(spark, "A", [0.1 + 0.2]), bar_table)
    assert append_new(volume_bars(spark, "A", [0.3]), bar_table) == Appended(1, repeated=1)


def test_write_time_is_stamped_on_request(spark):
    schema = T.StructType([*FULL_BAR.fields, T.StructField("ingested_at", T.TimestampType())])
    table = ParquetTable(shared_path(spark, "bars"), schema)
    append_new(volume_bars(spark, "A", [1]), table, stamped="ingested_at")
    age = table.read(spark).select(F.unix_seconds(F.current_timestamp()) - F.unix_seconds("ingested_at"))
    assert 0 <= age.first()[0] < 120


def test_the_batch_is_cached_only_during_the_write(spark, bar_table):
    batch = volume_bars(spark, "A", [1])
    append_new(batch, bar_table)
    assert not batch.is_cached


# Parquet tables


def test_only_the_days_of_the_batch_are_read_back(spark, bar_table):
    for day in range(4):
        append_new(volume_bars(spark, "A", [day], BASE + timedelta(days=day)), bar_table)
    found = bar_table.between(spark, micros(at(-14.5 * 3600 + 86400)), micros(at(8.5 * 3600 + 86400 * 2)))
    assert sorted(row.total_volume for row in found.collect()) == [1.0, 2.0]
    # Only the folders of these days are listed.
    assert {Path(f).parent.name for f in found.inputFiles()} == {"on_day=2024-06-02", "on_day=2024-06-03"}
    assert bar_table.between(spark, micros(at(86400 * 50)), micros(at(86400 * 60))).collect() == []


def micros(moment):
    return round(moment.timestamp() * 1_000_000)


def test_range_bounds_are_inclusive(spark, bar_table):
    append_new(volume_bars(spark, "A", [1, 2, 3]), bar_table)
    found = bar_table.between(spark, micros(at(0)), micros(at(60)))
    assert sorted(row.total_volume for row in found.collect()) == [1.0, 2.0]


def test_a_big_batch_of_one_day_is_written_by_many_tasks(spark):
    table = ParquetTable(shared_path(spark, "bars"), FULL_BAR, rows_per_file=100)
    append_new(volume_bars(spark, "A", range(500)), table)
    files = list(local(table.path).rglob("*.parquet"))
    assert 4 <= len(files) <= 6
    assert volumes(spark, table) == [float(v) for v in range(500)]


def test_compaction_keeps_the_rows_and_leaves_few_files(spark, bar_table):
    for day in range(3):
        for minute in range(4):
            first = BASE + timedelta(days=day, minutes=minute)
            append_new(volume_bars(spark, "A", [10 * day + minute], first), bar_table)
    before = volumes(spark, bar_table)
    days = bar_table.days(spark)
    assert [str(d) for d in days] == ["2024-06-01", "2024-06-02", "2024-06-03"]
    bar_table.compact(spark, days[0], days[1])
    assert volumes(spark, bar_table) == before
    files = [len(list((local(bar_table.path) / f"on_day={d}").glob("*.parquet"))) for d in days]
    assert files == [1, 1, 4]
    bar_table.compact(spark, days[2] + timedelta(days=1), days[2] + timedelta(days=9))


def test_latest_rows_come_from_the_newest_days(spark, bar_table):
    for day in range(5):
        append_new(volume_bars(spark, "A", [10 * day, 10 * day + 1], BASE + timedelta(days=day)), bar_table)
    found = bar_table.latest(spark, "window_start DESC, symbol", 3)
    assert [row.total_volume for row in found.collect()] == [41.0, 40.0, 31.0]
    assert {Path(f).parent.name for f in found.inputFiles()} == {"on_day=2024-06-05", "on_day=2024-06-04"}
    other = bar_table.latest(spark, "total_volume", 2)
    assert [row.total_volume for row in other.collect()] == [0.0, 1.0]
    assert bar_table.latest(spark, "window_start DESC", 99).count() == 10


def test_days_are_utc_in_any_session(spark):
    with settings(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"}):
        table = ParquetTable(shared_path(spark, "bars"), FULL_BAR)
        hours = [volume_bars(spark, "A", [h], BASE + timedelta(hours=h)) for h in range(0, 48, 6)]
        for bars in hours:
            append_new(bars, table)
            assert append_new(bars, table).repeated == 1
        assert [str(d) for d in table.days(spark)] == ["2024-06-01", "2024-06-02", "2024-06-03"]
        low, high = micros(at(9.5 * 3600)), micros(at(33.5 * 3600 - 1))
        assert table.between(spark, low, high).count() == 4


def test_stored_tables_are_removed_on_request(spark):
    remove_stored(spark)
    table = store(volume_bars(spark, "A", [1]), "bars")
    file = table.inputFiles()[0]
    assert local(file.replace("file://", "")).exists()
    assert remove_stored(spark) == 1 and remove_stored(spark) == 0
    assert not local(file.replace("file://", "")).exists()


def test_a_shared_folder_must_be_named():
    session = MagicMock()
    session.conf.get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_path(session, "x")


def test_append_without_a_known_size(spark, bar_table):
    bar_table.append(volume_bars(spark, "A", [1, 2]))
    assert volumes(spark, bar_table) == [1.0, 2.0]
    assert bar_table.read(spark).schema == FULL_BAR


# JDBC tables: there is no database here, so only what Spark is asked for is checked.

JDBC = JdbcTable(
    "jdbc:postgresql://db/market",
    "trades_aggregated_1min",
    {"user": "u", "password": "p", "driver": "org.postgresql.Driver"},
)


@pytest.mark.parametrize("rows, tasks", [(None, 16), (10, 1), (25_000, 3), (10**9, 16)])
def test_jdbc_append(rows, tasks):
    df = MagicMock()
    JDBC.append(df, rows)
    df.repartition.assert_called_once_with(tasks)
    writer = df.repartition.return_value.write
    writer.format.assert_called_once_with("jdbc")
    writer.format.return_value.options.assert_called_once_with(
        url="jdbc:postgresql://db/market",
        dbtable="trades_aggregated_1min",
        batchsize="10000",
        user="u",
        password="p",
        driver="org.postgresql.Driver",
    )
    final = writer.format.return_value.options.return_value.mode
    final.assert_called_once_with("append")
    final.return_value.save.assert_called_once_with()


def test_jdbc_range_is_read_in_slices(spark):
    session = MagicMock()
    JDBC.between(session, micros(at(0)), micros(at(3600)))
    options = session.read.format.return_value.options
    assert options.call_args.kwargs["dbtable"] == "trades_aggregated_1min"
    options.return_value.options.assert_called_once_with(
        partitionColumn="window_start",
        lowerBound="2024-06-01T14:30:00+00:00",
        upperBound="2024-06-01T15:30:00+00:00",
        numPartitions=16,
    )


def test_the_database_cuts_the_latest_rows():
    session = MagicMock()
    JDBC.latest(session, "window_start DESC, symbol", 20)
    options = session.read.format.return_value.options.call_args.kwargs
    assert options["query"] == (
        "SELECT * FROM trades_aggregated_1min ORDER BY window_start DESC, symbol "
        "FETCH FIRST 20 ROWS ONLY"
    )


def test_keyed_append_to_a_database_reads_keys_then_appends(spark):
    stored = volume_bars(spark, "A", [1])
    table = MagicMock(time="window_start", key=("window_start", "symbol"))
    table.between.return_value = stored
    written = []
    table.append.side_effect = lambda df, rows: written.extend(df.collect())
    append_new(volume_bars(spark, "A", [1, 2]), table)
    _, low, high = table.between.call_args.args
    assert (low, high) == (micros(at(0)), micros(at(60)))
    assert [row.total_volume for row in written] == [2.0]


def test_publish_asks_for_a_kafka_write():
    df = MagicMock()
    publish(df, "host:9092", "ticks", **{"kafka.acks": "all"})
    df.select.assert_called_once_with("value")
    writer = df.select.return_value.write
    writer.format.assert_called_once_with("kafka")
    first = writer.format.return_value.options
    first.assert_called_once_with(**{"kafka.bootstrap.servers": "host:9092", "topic": "ticks"})
    first.return_value.options.assert_called_once_with(**{"kafka.acks": "all"})


# Lake


def test_lake_layout_and_compression(spark):
    path = shared_path(spark, "lake")
    moments = [at(0), at(1800), at(86400)]
    append_to_lake(trades(spark, *[("A", 1.0, 2.0, m) for m in moments]), path)
    files = sorted(local(path).rglob("*.parquet"))
    folders = [str(f.parent.relative_to(local(path))) for f in files]
    assert folders == [
        "year=2024/month=6/day=1/hour=14",
        "year=2024/month=6/day=1/hour=15",
        "year=2024/month=6/day=2/hour=14",
    ]
    columns = pq.ParquetFile(files[0]).metadata.row_group(0)
    assert {columns.column(i).compression for i in range(columns.num_columns)} == {"SNAPPY"}
    assert pq.read_schema(files[0]).names == ["symbol", "price", "volume", "event_time"]


def test_lake_rows_come_back_and_append_adds(spark):
    path = shared_path(spark, "lake")
    rows = trades(spark, ("A", 1.0, 2.0, at(0)), ("B", 3.0, 4.0, at(5000)))
    append_to_lake(rows, path)
    append_to_lake(rows, path)
    back = read_lake(spark, path)
    assert back.schema == rows.schema
    assert sorted(back.collect()) == sorted(rows.collect() * 2)


def test_rows_within_a_file_are_sorted_by_symbol_and_time(spark):
    path = shared_path(spark, "lake")
    rows = [(s, 1.0, 1.0, at(t)) for t in (9, 3, 7) for s in ("C", "A", "B")]
    append_to_lake(trades(spark, *rows), path)
    [file] = local(path).rglob("*.parquet")
    stored = [(r["symbol"], r["event_time"]) for r in pq.ParquetFile(file).read().to_pylist()]
    assert stored == sorted(stored)


def test_lake_range_reads_only_its_hours(spark):
    path = shared_path(spark, "lake")
    append_to_lake(trades(spark, *[("A", float(i), 1.0, at(1800 * i)) for i in range(20)]), path)
    # Trades at 14:30, 15:00, ..., 00:00; the start is kept and the end is not.
    start = datetime(2024, 6, 1, 15, 30)
    end = datetime(2024, 6, 1, 17, 0, tzinfo=timezone.utc)
    found = read_lake(spark, path, start, end)
    plan = plan_of(found)
    assert sorted(row.price for row in found.collect()) == [2.0, 3.0, 4.0]
    filters = plan[plan.index("PartitionFilters") :].splitlines()[0]
    assert "year" in filters and "hour" in filters
    assert {Path(f).parent.name for f in found.inputFiles()} == {"hour=15", "hour=16"}
    assert sorted(row.price for row in read_lake(spark, path, start).collect())[0] == 2.0
    assert read_lake(spark, path, start, datetime(2024, 8, 1)).count() == 18
    assert read_lake(spark, path, datetime(2025, 1, 1), datetime(2025, 1, 2)).count() == 0


def test_lake_hours_are_utc_in_any_session(spark):
    rows = [("A", float(i), 1.0, at(3600 * i - 1800)) for i in range(48)]
    with settings(spark, {"spark.sql.session.timeZone": "Asia/Tokyo"}):
        path = shared_path(spark, "lake")
        append_to_lake(trades(spark, *rows), path)
        day = datetime(2024, 6, 2)
        for start, end, count in ((day, day + timedelta(days=1), 24), (None, day, 10), (day, None, 38)):
            assert read_lake(spark, path, start, end).count() == count
        assert read_lake(spark, path, day - timedelta(days=3), day + timedelta(days=3)).count() == 48


def test_lake_compaction(spark):
    path = shared_path(spark, "lake")
    rows = trades(spark, ("A", 1.0, 2.0, at(0)), ("B", 3.0, 4.0, at(3600)))
    for _ in range(3):
        append_to_lake(rows, path)
    compact_lake(spark, path, datetime(2024, 6, 1, 14), datetime(2024, 6, 1, 15))
    hours = [len(list((local(path) / f"year=2024/month=6/day=1/hour={h}").glob("*.parquet"))) for h in (14, 15)]
    assert hours == [1, 3]
    assert sorted(read_lake(spark, path).collect()) == sorted(rows.collect() * 3)
    with pytest.raises(ValueError, match="full hours"):
        compact_lake(spark, path, datetime(2024, 6, 1, 14, 1), datetime(2024, 6, 1, 15))


def test_lake_range_in_another_zone(spark):
    path = shared_path(spark, "lake")
    append_to_lake(trades(spark, *[("A", float(i), 1.0, at(1800 * i)) for i in range(4)]), path)
    zone = timezone(timedelta(hours=2))
    found = read_lake(spark, path, datetime(2024, 6, 1, 17, 0, tzinfo=zone))
    assert sorted(row.price for row in found.collect()) == [1.0, 2.0, 3.0]
    assert read_lake(spark, path, end=datetime(2024, 6, 1, 15, 0)).count() == 1
