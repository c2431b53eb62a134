"""Sources and sinks with declared schemas."""

from cardsight.sources.transactions import load_order_transactions, load_transactions, read_table

__all__ = ["load_order_transactions", "load_transactions", "read_table"]
