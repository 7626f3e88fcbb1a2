from tickloom.plans.flow import bars_of_messages, spikes_of_trades, start_flow

__all__ = ["bars_of_messages", "spikes_of_trades", "start_flow"]
