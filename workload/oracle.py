"""The expected result of each query, as DuckDB SQL over the same tables."""

from __future__ import annotations

VOLUME = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"

EVENT_TRADES = f"""
    SELECT event_type AS symbol, value AS price, {VOLUME} AS volume, ts AS event_time
    FROM events
"""

# Envelope times are milliseconds.
MILLI_TRADES = f"""
    SELECT event_type AS symbol, value AS price, {VOLUME} AS volume,
           date_trunc('milliseconds', ts) AS event_time
    FROM events
"""

ENVELOPE_TRADES = f"SELECT * FROM ({MILLI_TRADES}) WHERE symbol <> 'error'"

LINE_TRADES = """
    SELECT p_brand AS symbol, l_extendedprice / nullif(l_quantity, 0) AS price,
           l_quantity AS volume, l_shipdate AS event_time
    FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def _measures(extremes: bool) -> str:
    middle = "min(price) AS min_price, max(price) AS max_price, count(*) AS trade_count,"
    return f"""
        sum(volume) AS total_volume,
        avg(price) AS avg_price,
        {middle if extremes else ""}
        stddev_samp(price) AS volatility,
        sum(price * volume) / nullif(sum(volume), 0) AS vwap
    """


def tumbling(trades: str, unit: str, extremes: bool = True) -> str:
    return f"""
        SELECT date_trunc('{unit}', event_time) AS window_start,
               date_trunc('{unit}', event_time) + INTERVAL 1 {unit} AS window_end,
               symbol, {_measures(extremes)}
        FROM ({trades}) AS t
        GROUP BY 1, 2, 3
    """


def sliding(trades: str, count: int, unit: str, extremes: bool = False) -> str:
    return f"""
        SELECT date_trunc('{unit}', event_time) - back * INTERVAL 1 {unit} AS window_start,
               date_trunc('{unit}', event_time) + ({count} - back) * INTERVAL 1 {unit} AS window_end,
               symbol, {_measures(extremes)}
        FROM ({trades}) AS t, generate_series(0, {count - 1}) AS g(back)
        GROUP BY 1, 2, 3
    """


def spikes(bars: str) -> str:
    return f"""
        WITH b AS ({bars}), m AS (SELECT symbol, avg(total_volume) AS avg_volume FROM b GROUP BY 1)
        SELECT symbol, window_start, window_end, total_volume, avg_volume,
               total_volume / avg_volume AS ratio, avg_price, vwap
        FROM b JOIN m USING (symbol)
        WHERE total_volume > avg_volume * 3.0
    """


def running_spikes(bars: str, factor: float = 3.0) -> str:
    return f"""
        WITH b AS ({bars}),
        m AS (SELECT *, avg(total_volume) OVER (PARTITION BY symbol ORDER BY window_start) AS avg_volume FROM b)
        SELECT symbol, window_start, window_end, total_volume, avg_volume,
               total_volume / avg_volume AS ratio, avg_price, vwap
        FROM m
        WHERE total_volume > avg_volume * {factor}
    """


FULL_BAR = [
    "total_volume", "avg_price", "min_price", "max_price", "trade_count", "volatility", "vwap",
]
SHORT_BAR = ["total_volume", "avg_price", "volatility", "vwap"]
SPIKE = ["total_volume", "avg_volume", "ratio", "avg_price", "vwap"]
TRADE = ["price", "volume"]


def near(value: str) -> str:
    """Rounding as in comparable(), with its offset against exact halves."""
    return f"round({value} + 1e-7, 4)"


def rounded(sql: str, key: str, values: list[str]) -> str:
    """Round the measured columns as the queries do; counts stay as they are."""
    shown = [v if v == "trade_count" else f"{near(v)} AS {v}" for v in values]
    return f"SELECT {key}, {', '.join(shown)} FROM ({sql}) AS r"


def full_bars(sql: str) -> str:
    return rounded(sql, "window_start, window_end, symbol", FULL_BAR)


def short_bars(sql: str) -> str:
    return rounded(sql, "window_start, window_end, symbol", SHORT_BAR)


def with_problems(sql: str) -> str:
    return rounded(sql, "window_start, window_end, symbol, problems", FULL_BAR)


def spike_rows(sql: str) -> str:
    return rounded(sql, "symbol, window_start, window_end", SPIKE)


def trade_rows(sql: str) -> str:
    return rounded(sql, "symbol, event_time", TRADE)


def closed(bars: str, trades: str, delay: str) -> str:
    """The windows that an append stream over one batch emits."""
    return f"""
        SELECT * FROM ({bars}) AS w
        WHERE window_end <= (SELECT max(event_time) FROM ({trades}) AS t) - INTERVAL {delay}
    """


MINUTE_BARS = tumbling(EVENT_TRADES, "minute")
FLOW_MINUTE_BARS = closed(tumbling(ENVELOPE_TRADES, "minute"), ENVELOPE_TRADES, "10 seconds")
FLOW_FIVE_MINUTE_BARS = closed(
    sliding(ENVELOPE_TRADES, 5, "minute"), ENVELOPE_TRADES, "30 seconds"
)

NAMELESS_TRADES = f"SELECT * REPLACE (nullif(symbol, 'view') AS symbol) FROM ({ENVELOPE_TRADES}) AS e"

# Trades with flaws: see flawed_trades().
FLAWED_TRADES = f"""
    SELECT CASE WHEN event_type = 'click' THEN 'click'
                WHEN event_type = 'view' THEN NULL
                ELSE 'EX:' || upper(event_type) END AS symbol,
           CASE WHEN value < 60 THEN value END AS price,
           {VOLUME} - 10 AS volume,
           ts AS event_time, event_id
    FROM events
"""

TRADE_PROBLEMS = """
    concat_ws(', ',
        CASE WHEN price IS NULL THEN 'price missing' END,
        CASE WHEN symbol IS NULL THEN 'symbol missing' END,
        CASE WHEN volume < 0 THEN 'volume negative' END,
        CASE WHEN NOT regexp_matches(symbol, '^[A-Z]+:[A-Z]+$') THEN 'symbol malformed' END)
"""

LATE_DROP = f"""
    WITH t AS ({EVENT_TRADES}),
    first_run AS (SELECT max(event_time) - INTERVAL 10 seconds AS mark FROM t WHERE symbol <> 'error'),
    kept AS (
        SELECT t.* FROM t, first_run
        WHERE symbol <> 'error'
           OR date_trunc('minute', event_time) + INTERVAL 1 minute > mark)
    SELECT * FROM ({tumbling("SELECT * FROM kept", "minute")}) AS w
    WHERE window_end <= (SELECT max(event_time) FROM t) - INTERVAL 10 seconds
"""

LATE_TRADES = f"""
    WITH t AS ({EVENT_TRADES}),
    first_run AS (SELECT max(event_time) - INTERVAL 10 seconds AS mark FROM t WHERE symbol <> 'error')
    SELECT t.*, date_trunc('minute', event_time) AS window_start FROM t, first_run
    WHERE symbol = 'error' AND date_trunc('minute', event_time) + INTERVAL 1 minute <= mark
"""


def oracle_sql() -> dict[str, str]:
    return {
        "flatten_trades": trade_rows(ENVELOPE_TRADES),
        "allow_symbols": trade_rows(
            f"SELECT * FROM ({EVENT_TRADES}) WHERE symbol IN ('click', 'purchase')"
        ),
        "capture_first_messages": """
            SELECT CAST(floor(event_id / 16) AS BIGINT) AS number,
                   CASE WHEN event_type = 'error' THEN 'ping' ELSE 'trade' END AS type,
                   count(*) AS trades
            FROM events GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 100
        """,
        "bars_1min": full_bars(MINUTE_BARS),
        "bars_5min_sliding": short_bars(sliding(EVENT_TRADES, 5, "minute")),
        "bars_5min_sliding_direct": short_bars(sliding(EVENT_TRADES, 5, "minute")),
        "bars_1hour": full_bars(tumbling(EVENT_TRADES, "hour")),
        "bars_1hour_60_panes": full_bars(sliding(EVENT_TRADES, 60, "minute", extremes=True)),
        "bars_daily_brand": full_bars(tumbling(LINE_TRADES, "day")),
        "bars_5day_sliding_brand": full_bars(sliding(LINE_TRADES, 5, "day", extremes=True)),
        "bars_of_messages": full_bars(tumbling(ENVELOPE_TRADES, "minute")),
        "mean_volumes_1min": f"""
            SELECT symbol, {near('avg(total_volume)')} AS avg_volume
            FROM ({MINUTE_BARS}) AS b GROUP BY 1
        """,
        "volume_spikes_1min": spike_rows(spikes(MINUTE_BARS)),
        "volume_spikes_1hour": spike_rows(spikes(tumbling(EVENT_TRADES, "hour"))),
        "volume_spikes_unsalted": spike_rows(spikes(tumbling(EVENT_TRADES, "hour"))),
        "volume_spikes_daily_brand": spike_rows(spikes(tumbling(LINE_TRADES, "day"))),
        "recent_bars_top20": rounded(
            f"SELECT * FROM ({MINUTE_BARS}) AS b ORDER BY window_start DESC, symbol LIMIT 20",
            "window_start, symbol",
            ["avg_price", "vwap", "trade_count"],
        ),
        "recent_anomalies_top50": rounded(
            f"""
            SELECT *, window_end AS detected_at FROM ({spikes(MINUTE_BARS)}) AS s
            ORDER BY detected_at DESC, symbol, window_start LIMIT 50
            """,
            "symbol, window_start, window_end, detected_at",
            SPIKE,
        ),
        "validate_trades_good": f"""
            SELECT event_id, symbol, {near('price')} AS price, {near('volume')} AS volume, event_time
            FROM ({FLAWED_TRADES}) AS t WHERE {TRADE_PROBLEMS} = ''
        """,
        "validate_trades_rejects": f"""
            SELECT event_id, symbol, {near('price')} AS price, {near('volume')} AS volume,
                   event_time, {TRADE_PROBLEMS} AS problems
            FROM ({FLAWED_TRADES}) AS t WHERE {TRADE_PROBLEMS} <> ''
        """,
        "validate_envelopes_rejects": f"""
            SELECT CAST(floor(event_id / 16) AS BIGINT) AS number,
                   CASE WHEN event_type = 'error' THEN 'ping' ELSE 'trade' END AS type,
                   concat_ws(', ',
                       CASE WHEN max(event_type) = 'error' THEN 'type unknown' END,
                       CASE WHEN bool_or(price IS NULL) THEN 'price missing' END,
                       CASE WHEN bool_or(symbol IS NULL) THEN 'symbol missing' END,
                       CASE WHEN bool_or(volume < 0) THEN 'volume negative' END,
                       CASE WHEN bool_or(NOT regexp_matches(symbol, '^[A-Z]+:[A-Z]+$'))
                            THEN 'symbol malformed' END) AS problems
            FROM (SELECT f.*, event_type FROM ({FLAWED_TRADES}) AS f JOIN events USING (event_id)) AS t
            GROUP BY 1, 2
            HAVING problems <> ''
        """,
        "required_columns_rejects": f"""
            SELECT event_id, event_time,
                   concat_ws(', ', CASE WHEN symbol IS NULL THEN 'symbol missing' END,
                                   CASE WHEN price IS NULL THEN 'price missing' END) AS problems
            FROM ({FLAWED_TRADES}) AS t WHERE symbol IS NULL OR price IS NULL
        """,
        "lake_partition_columns": f"""
            SELECT CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month,
                   CAST(day(event_time) AS INTEGER) AS day, CAST(hour(event_time) AS INTEGER) AS hour,
                   count(*) AS trades
            FROM ({EVENT_TRADES}) AS t GROUP BY ALL
        """,
        "lake_roundtrip": trade_rows(EVENT_TRADES),
        "lake_range_read": trade_rows(
            f"""
            SELECT * FROM ({EVENT_TRADES}) AS t
            WHERE event_time >= TIMESTAMP '2024-01-10 06:30:00'
              AND event_time < TIMESTAMP '2024-01-22 18:15:00'
            """
        ),
        "lake_stream": trade_rows(EVENT_TRADES),
        "keyed_write_replay": full_bars(MINUTE_BARS),
        "ledger_write_replay": full_bars(MINUTE_BARS),
        "keyed_write_conflicts": with_problems(
            f"""
            SELECT *, CAST(NULL AS VARCHAR) AS problems FROM ({MINUTE_BARS}) AS b
            UNION ALL
            SELECT * REPLACE (total_volume * 2 + 1 AS total_volume), 'key stored with other values'
            FROM ({MINUTE_BARS}) AS b WHERE symbol = 'click'
            """
        ),
        "stamped": f"SELECT *, true AS stamped FROM ({full_bars(MINUTE_BARS)}) AS b",
        "compacted_bars": full_bars(MINUTE_BARS),
        "compacted_lake": trade_rows(EVENT_TRADES),
        "stored_bars_top20": rounded(
            f"SELECT * FROM ({MINUTE_BARS}) AS b ORDER BY window_start DESC, symbol LIMIT 20",
            "window_start, symbol",
            ["avg_price", "vwap", "trade_count"],
        ),
        "parse_json_rejects": """
            SELECT CASE WHEN event_type <> 'error' THEN 'none'
                        WHEN number % 3 = 0 THEN 'message missing'
                        WHEN number % 3 = 1 THEN 'message blank'
                        ELSE 'message malformed' END AS problems,
                   count(DISTINCT number) AS messages,
                   CASE WHEN problems = 'none' THEN count(*) END AS trades
            FROM (SELECT *, CAST(floor(event_id / 16) AS BIGINT) AS number FROM events) AS e
            GROUP BY 1
        """,
        "validate_extra_keys": """
            SELECT number, concat_ws(', ',
                       CASE WHEN kind = 'ping' THEN 'type unknown' END,
                       CASE WHEN number % 11 = 0 THEN 'price malformed' END,
                       CASE WHEN number % 5 = 0 THEN 'envelope key seq unknown' END,
                       CASE WHEN number % 7 = 0 THEN 'trade key note unknown' END) AS problems,
                   CASE WHEN problems = '' THEN count(*)::INTEGER END AS trades
            FROM (SELECT CAST(floor(event_id / 16) AS BIGINT) AS number,
                         CASE WHEN event_type = 'error' THEN 'ping' ELSE 'trade' END AS kind FROM events) AS e
            GROUP BY number, kind
        """,
        "encode_json_roundtrip": trade_rows(ENVELOPE_TRADES),
        "stream_bars_1min_append": full_bars(closed(MINUTE_BARS, EVENT_TRADES, "10 seconds")),
        "stream_bars_5min_append": short_bars(
            closed(sliding(EVENT_TRADES, 5, "minute"), EVENT_TRADES, "30 seconds")
        ),
        "stream_bars_5min_panes": short_bars(
            closed(sliding(EVENT_TRADES, 5, "minute"), EVENT_TRADES, "30 seconds")
        ),
        "stream_handed_over_1min": full_bars(closed(MINUTE_BARS, EVENT_TRADES, "10 seconds")),
        "stream_handed_over_5min": short_bars(
            closed(sliding(EVENT_TRADES, 5, "minute"), EVENT_TRADES, "30 seconds")
        ),
        "stream_open_bars": f"""
            SELECT *, window_end > (SELECT max(event_time) FROM ({EVENT_TRADES}) AS t) - INTERVAL 10 seconds AS provisional
            FROM ({full_bars(MINUTE_BARS)}) AS b
        """,
        "stream_late_drop": full_bars(LATE_DROP),
        "stream_late_account": f"""
            SELECT symbol, window_start, count(*) AS late, {near('sum(volume)')} AS volume
            FROM ({LATE_TRADES}) AS t GROUP BY symbol, window_start
        """,
        "stream_batch_lake": trade_rows(EVENT_TRADES),
        "running_spikes_1min": spike_rows(running_spikes(MINUTE_BARS)),
        "running_spikes_daily_brand": spike_rows(running_spikes(tumbling(LINE_TRADES, "day"), 2.0)),
        "stream_running_spikes": spike_rows(
            running_spikes(closed(MINUTE_BARS, EVENT_TRADES, "10 seconds"))
        ),
        "lake_symbol_read": trade_rows(
            f"""
            SELECT * FROM ({EVENT_TRADES}) AS e
            WHERE symbol IN ('click', 'error')
              AND event_time >= TIMESTAMP '2024-01-10 06:30:00' AND event_time < TIMESTAMP '2024-01-22 18:15:00'
            """
        ),
        "stream_flow_anomalies": spike_rows(spikes(FLOW_MINUTE_BARS)),
        "stream_flow_bars_1min": full_bars(FLOW_MINUTE_BARS),
        "stream_flow_bars_5min": short_bars(FLOW_FIVE_MINUTE_BARS),
        "stream_flow_rejects": with_problems(
            f"""
            SELECT *, CASE WHEN symbol IS NULL THEN 'symbol missing' END AS problems
            FROM ({closed(tumbling(NAMELESS_TRADES, "minute"), ENVELOPE_TRADES, "10 seconds")}) AS b
            """
        ),
        "stream_flow_totals": f"""
            SELECT 'lake' AS output, count(*) AS rows, {near('sum(volume)')} AS volume
            FROM ({ENVELOPE_TRADES}) AS a
            UNION ALL
            SELECT 'bars_1min', count(*), {near('sum(total_volume)')} FROM ({FLOW_MINUTE_BARS}) AS b
            UNION ALL
            SELECT 'bars_5min', count(*), {near('sum(total_volume)')} FROM ({FLOW_FIVE_MINUTE_BARS}) AS c
            UNION ALL
            SELECT 'anomalies', count(*), {near('sum(total_volume)')} FROM ({spikes(FLOW_MINUTE_BARS)}) AS d
        """,
    }
