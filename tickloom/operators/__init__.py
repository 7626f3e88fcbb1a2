from tickloom.operators.bars import bars, bars_1min, bars_5min
from tickloom.operators.flatten import allow_symbols, first_messages, flatten_trades
from tickloom.operators.handover import go_on, hand_over
from tickloom.operators.quality import check_envelopes, check_trades, require_columns, split_checked
from tickloom.operators.recent import recent_anomalies, recent_bars
from tickloom.operators.running import running_spikes
from tickloom.operators.spikes import mean_volumes, volume_spikes
from tickloom.operators.strict import accept_messages, check_messages

__all__ = [
    "accept_messages",
    "allow_symbols",
    "bars",
    "bars_1min",
    "bars_5min",
    "check_envelopes",
    "check_messages",
    "check_trades",
    "first_messages",
    "flatten_trades",
    "go_on",
    "hand_over",
    "mean_volumes",
    "recent_anomalies",
    "recent_bars",
    "require_columns",
    "running_spikes",
    "split_checked",
    "volume_spikes",
]
