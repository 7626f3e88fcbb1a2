"""One query per operator over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import hour_parts, utc_day
from tickloom.operators import (
    allow_symbols,
    bars,
    bars_1min,
    bars_5min,
    check_envelopes,
    check_messages,
    check_trades,
    first_messages,
    flatten_trades,
    go_on,
    hand_over,
    mean_volumes,
    recent_anomalies,
    recent_bars,
    require_columns,
    running_spikes,
    split_checked,
    volume_spikes,
)
from tickloom.operators.bars import DELAY_1MIN, DELAY_5MIN, FIVE_MINUTES, MINUTE
from tickloom.operators.quality import SYMBOL_PATTERN
from tickloom.operators.wire import parse_json_messages, parse_json_or_reject
from tickloom.plans import bars_of_messages, spikes_of_trades, start_flow
from tickloom.schema import ANOMALY, ENVELOPE, FULL_BAR, SHORT_BAR, TRADE
from tickloom.session import shared_path, store
from tickloom.sinks import (
    REJECT_KEY,
    BatchLake,
    BatchTable,
    Ledger,
    ParquetTable,
    append_batch,
    append_new,
    append_to_lake,
    compact_lake,
    lake_stream,
    reject_schema,
)
from tickloom.sources import envelope_files, read_lake
from tickloom.streaming import Marks, lake_batches, open_bars, start_query, wait_for_all, with_open_bars
from workload.inputs import (
    comparable,
    event_envelopes,
    event_trade_stream,
    event_trades,
    line_trades,
    table,
)

HOUR = timedelta(hours=1)
DAY = timedelta(days=1)

hourly = partial(bars, width=HOUR)
daily = partial(bars, width=DAY)


# Flattening


def flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(flatten_trades(event_envelopes(spark, sf_dir)))


def allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(allow_symbols(event_trades(spark, sf_dir), ["click", "purchase"]))


def capture_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = first_messages(event_envelopes(spark, sf_dir), 100, "number", "type")
    return first.select("number", "type", F.size("data").cast("long").alias("trades"))


# Bars


def minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(bars_1min(event_trades(spark, sf_dir)))


def five_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(bars_5min(event_trades(spark, sf_dir)))


def five_minute_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(bars_5min(event_trades(spark, sf_dir), panes=False))


def sixty_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-hour bars, one starting every minute."""
    return comparable(bars(event_trades(spark, sf_dir), HOUR, MINUTE))


def hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(hourly(event_trades(spark, sf_dir)))


def daily_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(daily(line_trades(spark, sf_dir)))


def five_day_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(bars(line_trades(spark, sf_dir), 5 * DAY, DAY))


def message_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(bars_of_messages(event_envelopes(spark, sf_dir)))


# Spikes and reports


def minute_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(mean_volumes(bars_1min(event_trades(spark, sf_dir))))


def minute_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(spikes_of_trades(event_trades(spark, sf_dir)))


def hour_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(spikes_of_trades(event_trades(spark, sf_dir), hourly))


def unsalted_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = store(hourly(event_trades(spark, sf_dir)), "bars")
    return comparable(volume_spikes(stored, salts=1))


def daily_brand_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(spikes_of_trades(line_trades(spark, sf_dir), daily))


def minute_running_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(running_spikes(bars_1min(event_trades(spark, sf_dir))))


def daily_brand_running_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(running_spikes(daily(line_trades(spark, sf_dir)), factor=2.0))


def top_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(recent_bars(bars_1min(event_trades(spark, sf_dir))))


def top_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spikes_of_trades(event_trades(spark, sf_dir))
    return comparable(recent_anomalies(found.withColumn("detected_at", F.col("window_end"))))


# Checks


def flawed_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades with missing symbols and prices, odd symbols and negative volumes."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.when(kind == "click", "click")
        .when(kind == "view", F.lit(None))
        .otherwise(F.concat(F.lit("EX:"), F.upper(kind)))
        .alias("symbol"),
        F.when(F.col("value") < 60, F.col("value")).alias("price"),
        (F.get_json_object("props", "$.k").cast("double") - 10).alias("volume"),
        F.col("ts").cast("timestamp").alias("event_time"),
        "event_id",
        kind,
    )


def good_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = flawed_trades(spark, sf_dir).drop("event_type")
    return comparable(split_checked(check_trades(trades, SYMBOL_PATTERN))[0])


def rejected_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = flawed_trades(spark, sf_dir).drop("event_type")
    rejects = split_checked(check_trades(trades, SYMBOL_PATTERN))[1]
    return comparable(rejects.withColumn("problems", F.concat_ws(", ", "problems")))


def rejected_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(
        F.col("price").alias("p"),
        F.col("symbol").alias("s"),
        F.unix_millis("event_time").alias("t"),
        F.col("volume").alias("v"),
    )
    kind = F.when(F.col("event_type") == "error", "ping").otherwise("trade")
    envelopes = (
        flawed_trades(spark, sf_dir)
        .groupBy(F.floor(F.col("event_id") / 16).alias("number"), kind.alias("type"))
        .agg(F.collect_list(item).alias("data"))
    )
    rejects = split_checked(check_envelopes(envelopes, SYMBOL_PATTERN))[1]
    return rejects.select("number", "type", F.concat_ws(", ", "problems").alias("problems"))


def rejected_for_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = require_columns(flawed_trades(spark, sf_dir), ["symbol", "price", "event_time"])
    rejects = split_checked(checked)[1]
    return comparable(
        rejects.select("event_id", "event_time", F.concat_ws(", ", "problems").alias("problems"))
    )


# Lake and keyed tables


def lake_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = event_trades(spark, sf_dir).withColumns(hour_parts("event_time"))
    return trades.groupBy(*hour_parts("event_time")).agg(F.count("*").alias("trades"))


def _written_lake(spark: SparkSession, sf_dir: str) -> str:
    path = shared_path(spark, "lake")
    append_to_lake(event_trades(spark, sf_dir), path)
    return path


def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(read_lake(spark, _written_lake(spark, sf_dir)))


def lake_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written_lake(spark, sf_dir)
    start, end = datetime(2024, 1, 10, 6, 30), datetime(2024, 1, 22, 18, 15)
    return comparable(read_lake(spark, path, start, end))


def lake_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written_lake(spark, sf_dir)
    start, end = datetime(2024, 1, 10, 6, 30), datetime(2024, 1, 22, 18, 15)
    return comparable(read_lake(spark, path, start, end, symbols=["click", "error"]))


def streamed_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "lake")
    writer = lake_stream(event_trade_stream(spark, sf_dir), path)
    _run(writer, shared_path(spark, "progress"))
    return comparable(read_lake(spark, path))


def keyed_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars up to mid-month first, then all bars, then all of them once more."""
    target = ParquetTable(shared_path(spark, "keyed"), FULL_BAR)
    all_bars = store(bars_1min(event_trades(spark, sf_dir)), "bars")
    append_new(all_bars.where("window_start < '2024-01-15'"), target)
    append_new(all_bars, target)
    append_new(all_bars, target)
    return comparable(target.read(spark))


def ledger_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars in three batches, of which the first comes twice and the second is broken off when half
    of it is written, and repeated."""
    target, ledger = BatchTable(shared_path(spark, "batches"), FULL_BAR), Ledger(shared_path(spark, "ledger"))
    stored = store(bars_1min(event_trades(spark, sf_dir)), "bars")
    third = F.pmod(F.hour("window_start"), F.lit(3))
    append_batch(stored.where(third == 0), 0, target, ledger, "bars")
    append_batch(stored.where(third == 0), 0, target, ledger, "bars")
    second = stored.where(third == 1)
    ledger.note(spark, "bars", 1, "open", [r[0] for r in second.select(utc_day("window_start").cast("string")).distinct().collect()])
    replace(target, batch="bars-1").append(second.where("symbol < 'e'"))
    append_batch(second, 1, target, ledger, "bars")
    append_batch(stored.where(third == 2), 2, target, ledger, "bars")
    return comparable(target.read(spark))


def keyed_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bars, then the bars of one symbol with twice their volume, twice: each contradicts a
    stored bar and is rejected once."""
    target, rejects = ParquetTable(shared_path(spark, "keyed"), FULL_BAR), _rejects_table(spark, FULL_BAR)
    stored = store(bars_1min(event_trades(spark, sf_dir)), "bars")
    changed = stored.where("symbol = 'click'").withColumn("total_volume", F.col("total_volume") * 2 + 1)
    append_new(stored, target, rejects=rejects)
    for _ in range(2):
        append_new(changed, target, rejects=rejects)
    kept = target.read(spark).withColumn("problems", F.lit(None).cast("string"))
    return comparable(kept.unionByName(rejects.read(spark).drop("reject_key")))


def _rejects_table(spark: SparkSession, schema: T.StructType) -> ParquetTable:
    return ParquetTable(shared_path(spark, "rejects"), reject_schema(schema), REJECT_KEY)


def stamped_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with the time of the write, of which only its being set can be compared."""
    schema = T.StructType([*FULL_BAR.fields, T.StructField("ingested_at", T.TimestampType())])
    target = ParquetTable(shared_path(spark, "stamped"), schema)
    append_new(store(bars_1min(event_trades(spark, sf_dir)), "bars"), target, stamped="ingested_at")
    rows = target.read(spark).withColumn("stamped", F.col("ingested_at").isNotNull())
    return comparable(rows.drop("ingested_at"))


def _appended_bars(spark: SparkSession, sf_dir: str) -> ParquetTable:
    """Bars that arrived in three appends per day."""
    target = ParquetTable(shared_path(spark, "keyed"), FULL_BAR)
    stored = store(bars_1min(event_trades(spark, sf_dir)), "bars")
    for part in range(3):
        append_new(stored.where(F.pmod(F.hour("window_start"), F.lit(3)) == part), target)
    return target


def compacted_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _appended_bars(spark, sf_dir)
    days = target.days(spark)
    target.compact(spark, days[0], days[len(days) // 2])
    return comparable(target.read(spark))


def compacted_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, trades = shared_path(spark, "lake"), event_trades(spark, sf_dir)
    for cheap in (True, False):
        append_to_lake(trades.where((F.col("price") < 50) == cheap), path)
    compact_lake(spark, path, datetime(2024, 1, 5), datetime(2024, 1, 7, 12))
    return comparable(read_lake(spark, path))


def stored_top_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = _appended_bars(spark, sf_dir).latest(spark, "window_start DESC, symbol", 20)
    return comparable(recent_bars(latest))


# Messages


def json_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_envelopes(spark, sf_dir).select(
        F.to_json(F.struct("type", "data")).alias("value"), "number", "type"
    )


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(flatten_trades(parse_json_messages(json_texts(spark, sf_dir).select("value"))))


def json_good_and_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the 'ping' messages, one in three is missing, one blank and one cut short."""
    cut = F.expr("substring(value, 1, length(value) - 3)")
    kind = F.pmod("number", F.lit(3))
    spoilt = F.when(kind == 1, "  ").when(kind == 2, cut)
    texts = json_texts(spark, sf_dir).withColumn(
        "value", F.when(F.col("type") == "trade", F.col("value")).otherwise(spoilt)
    )
    good, rejected = parse_json_or_reject(texts.select("value"))
    counts = rejected.groupBy("problems").agg(F.count("*").alias("messages"))
    kept = good.groupBy().agg(F.count("*").alias("messages"), F.sum(F.size("data")).alias("trades"))
    return (
        counts.withColumn("trades", F.lit(None).cast("long"))
        .unionByName(kept.withColumn("problems", F.lit("none")))
        .select("problems", "messages", "trades")
    )


def extra_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth message has a key of its own, and every seventh a key in its trades; every eleventh
    has its prices as texts."""
    number = F.col("number").cast("long")

    def each(divisor: int, value: Column) -> Column:
        return F.when(F.pmod(number, F.lit(divisor)) == 0, value)

    noted = F.transform("data", lambda d: d.withField("note", each(7, F.lit("x"))))
    text = F.to_json(F.struct("type", noted.alias("data"), each(5, number).alias("seq")))
    quoted = F.regexp_replace(text, '"p":([^,]*)', '"p":"$1"')
    texts = event_envelopes(spark, sf_dir).select(
        number.alias("number"), F.coalesce(each(11, quoted), text).alias("value")
    )
    checked = check_messages(texts)
    return checked.select("number", F.concat_ws(", ", "problems").alias("problems"), F.size("data").alias("trades"))


# Streams


def _run(stream, checkpoint: str, **sink) -> None:
    """Run a query over everything there is, then stop."""
    spark = stream._spark if hasattr(stream, "_spark") else stream.sparkSession
    query = start_query(
        stream,
        checkpoint=checkpoint,
        trigger={"availableNow": True},
        state_partitions=spark.sparkContext.defaultParallelism,
        **sink,
    )
    wait_for_all([query])


def _streamed(df: DataFrame) -> DataFrame:
    """What a stream appends to a file sink."""
    spark = df.sparkSession
    path = shared_path(spark, "stream")
    _run(df, shared_path(spark, "progress"), sink="parquet", path=path)
    return comparable(spark.read.schema(df.schema).parquet(path))


def streamed_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(bars_1min(event_trade_stream(spark, sf_dir)))


def streamed_five_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(bars_5min(event_trade_stream(spark, sf_dir)))


def streamed_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(bars_5min(event_trade_stream(spark, sf_dir), lateness="pane"))


def streamed_running_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(running_spikes(bars_1min(event_trade_stream(spark, sf_dir))))


def streamed_and_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars that a stream has emitted, and those that it holds open at the end of its input."""
    path, progress = shared_path(spark, "stream"), shared_path(spark, "progress")
    _run(bars_1min(event_trade_stream(spark, sf_dir)), progress, sink="parquet", path=path)
    emitted = spark.read.schema(FULL_BAR).parquet(path)
    return comparable(with_open_bars(emitted, open_bars(spark, progress)))


def streamed_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors arrive after everything else, in a second run from the same checkpoint.

    They are dropped, but for those whose window the first run left open.
    """
    trades = event_trades(spark, sf_dir)
    arrivals, out, checkpoint = (
        shared_path(spark, name) for name in ("arrivals", "stream", "progress")
    )
    for arrived in (trades.where("symbol <> 'error'"), trades.where("symbol = 'error'")):
        arrived.write.mode("append").parquet(arrivals)
        stream = bars_1min(spark.readStream.schema(TRADE).parquet(arrivals))
        _run(stream, checkpoint, sink="parquet", path=out)
    return comparable(spark.read.schema(FULL_BAR).parquet(out))


def _arrivals_in_lakes(spark: SparkSession, sf_dir: str) -> tuple[BatchLake, BatchLake]:
    """All trades, and those that came late; errors arrive after everything else, in a second run."""
    trades = event_trades(spark, sf_dir)
    arrivals, progress = (shared_path(spark, name) for name in ("arrivals", "progress"))
    lake, late = (BatchLake(shared_path(spark, name)) for name in ("lake", "late"))
    write = lake_batches(lake, late, Marks(shared_path(spark, "marks")))
    for arrived in (trades.where("symbol <> 'error'"), trades.where("symbol = 'error'")):
        arrived.write.mode("append").parquet(arrivals)
        _run(spark.readStream.schema(TRADE).parquet(arrivals), progress, sink=write)
    return lake, late


def late_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many late trades there are, and of what volume, by symbol and window."""
    late = _arrivals_in_lakes(spark, sf_dir)[1].read(spark)
    window = F.window("event_time", "1 minute").start.alias("window_start")
    counted = late.groupBy("symbol", window).agg(F.count("*").alias("late"), F.sum("volume").alias("volume"))
    return comparable(counted)


def batch_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake of two batches, of which half a month is compacted."""
    lake = _arrivals_in_lakes(spark, sf_dir)[0]
    lake.compact(spark, datetime(2024, 1, 5), datetime(2024, 1, 20, 12))
    return comparable(lake.read(spark))


def _handed_over(spark: SparkSession, sf_dir: str, *shape) -> DataFrame:
    """Bars of a batch run over the trades up to mid-month, and of a stream of those that follow."""
    trades = event_trades(spark, sf_dir)
    before = F.col("event_time") < F.lit("2024-01-15 12:00:30").cast("timestamp")
    arrivals, seeds, out = (shared_path(spark, name) for name in ("arrivals", "seeds", "stream"))
    trades.where(~before).write.parquet(arrivals)
    done = hand_over(trades.where(before), seeds, *shape)
    stream = go_on(spark.readStream.schema(TRADE).parquet(arrivals), seeds, *shape)
    _run(stream, shared_path(spark, "progress"), sink="parquet", path=out)
    return comparable(done.unionByName(spark.read.schema(stream.schema).parquet(out)))


def handed_over_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _handed_over(spark, sf_dir, MINUTE, None, DELAY_1MIN)


def handed_over_five_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _handed_over(spark, sf_dir, FIVE_MINUTES, MINUTE, DELAY_5MIN, False)


def _flow(
    spark: SparkSession, sf_dir: str, nameless: bool = False
) -> tuple[str, dict[str, ParquetTable]]:
    """The flow over all envelopes; with `nameless`, trades of one symbol arrive without it."""
    source = shared_path(spark, "envelopes")
    # In order of arrival, as in a topic, so that a file spans few hours.
    arrived = event_envelopes(spark, sf_dir).repartitionByRange("number")
    if nameless:
        named = F.transform(
            "data", lambda d: d.withField("s", F.when(d["s"] != "view", d["s"]))
        )
        arrived = arrived.withColumn("data", named)
    arrived.select(*ENVELOPE.names).write.parquet(source)
    lake = shared_path(spark, "lake")
    tables = {
        name: ParquetTable(shared_path(spark, name), schema)
        for name, schema in (
            ("bars_1min", FULL_BAR),
            ("bars_5min", SHORT_BAR),
            ("anomalies", ANOMALY),
        )
    }
    for name in ("bars_1min", "bars_5min"):
        tables[f"{name}_rejects"] = _rejects_table(spark, tables[name].schema)
    queries = start_flow(
        envelope_files(spark, source),
        shared_path(spark, "progress"),
        minute_bars=tables["bars_1min"],
        five_minute_bars=tables["bars_5min"],
        anomalies=tables["anomalies"],
        minute_rejects=tables["bars_1min_rejects"],
        five_minute_rejects=tables["bars_5min_rejects"],
        lake=lake,
        trigger={"availableNow": True},
        state_partitions=spark.sparkContext.defaultParallelism,
    )
    wait_for_all(queries)
    return lake, tables


def flow_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_flow(spark, sf_dir)[1]["anomalies"].read(spark))


def flow_minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_flow(spark, sf_dir)[1]["bars_1min"].read(spark))


def flow_five_minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_flow(spark, sf_dir)[1]["bars_5min"].read(spark))


def flow_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-minute bars and rejects of a flow in which one symbol's trades lack it."""
    tables = _flow(spark, sf_dir, nameless=True)[1]
    kept = tables["bars_1min"].read(spark).withColumn("problems", F.lit(None).cast("string"))
    return comparable(kept.unionByName(tables["bars_1min_rejects"].read(spark).drop("reject_key")))


def flow_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, tables = _flow(spark, sf_dir)
    volumes = {"lake": read_lake(spark, lake).select("volume")}
    for name, stored in tables.items():
        if name.endswith("rejects"):
            continue
        volumes[name] = stored.read(spark).select(F.col("total_volume").alias("volume"))
    totals = [
        rows.agg(F.count("*").alias("rows"), F.sum("volume").alias("volume")).select(
            F.lit(name).alias("output"), "rows", "volume"
        )
        for name, rows in volumes.items()
    ]
    result = totals[0]
    for other in totals[1:]:
        result = result.unionByName(other)
    return comparable(result)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "flatten_trades": flatten,
        "allow_symbols": allowed,
        "capture_first_messages": capture_first,
        "bars_1min": minute,
        "bars_5min_sliding": five_minute,
        "bars_5min_sliding_direct": five_minute_direct,
        "bars_1hour": hour,
        "bars_1hour_60_panes": sixty_panes,
        "bars_daily_brand": daily_brand,
        "bars_5day_sliding_brand": five_day_brand,
        "bars_of_messages": message_bars,
        "mean_volumes_1min": minute_means,
        "volume_spikes_1min": minute_spikes,
        "volume_spikes_1hour": hour_spikes,
        "volume_spikes_unsalted": unsalted_spikes,
        "volume_spikes_daily_brand": daily_brand_spikes,
        "running_spikes_1min": minute_running_spikes,
        "running_spikes_daily_brand": daily_brand_running_spikes,
        "recent_bars_top20": top_bars,
        "recent_anomalies_top50": top_anomalies,
        "validate_trades_good": good_trades,
        "validate_trades_rejects": rejected_trades,
        "validate_envelopes_rejects": rejected_envelopes,
        "required_columns_rejects": rejected_for_missing,
        "lake_partition_columns": lake_parts,
        "lake_roundtrip": lake_roundtrip,
        "lake_range_read": lake_range,
        "lake_symbol_read": lake_symbols,
        "lake_stream": streamed_lake,
        "keyed_write_replay": keyed_replay,
        "ledger_write_replay": ledger_replay,
        "keyed_write_conflicts": keyed_conflicts,
        "stamped": stamped_bars,
        "compacted_bars": compacted_bars,
        "compacted_lake": compacted_lake,
        "stored_bars_top20": stored_top_bars,
        "encode_json_roundtrip": json_roundtrip,
        "parse_json_rejects": json_good_and_rejected,
        "validate_extra_keys": extra_keys,
        "stream_bars_1min_append": streamed_minute,
        "stream_bars_5min_append": streamed_five_minute,
        "stream_bars_5min_panes": streamed_panes,
        "stream_running_spikes": streamed_running_spikes,
        "stream_open_bars": streamed_and_open,
        "stream_late_drop": streamed_late,
        "stream_late_account": late_account,
        "stream_batch_lake": batch_lake,
        "stream_handed_over_1min": handed_over_minute,
        "stream_handed_over_5min": handed_over_five_minute,
        "stream_flow_anomalies": flow_anomalies,
        "stream_flow_totals": flow_totals,
        "stream_flow_bars_1min": flow_minute_bars,
        "stream_flow_bars_5min": flow_five_minute_bars,
        "stream_flow_rejects": flow_rejects,
    }
