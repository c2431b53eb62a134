"""cardsight: card-transaction analytics on Spark DataFrames.

Trailing event-time windows per customer and terminal, label-delayed
terminal fraud risk, prequential splits, class rebalancing, relational
model evaluation, Spark ML training and run/model tables.
"""

from cardsight.session import checkpoint_root, get_spark, scratch_path

__all__ = ["get_spark", "checkpoint_root", "scratch_path"]
