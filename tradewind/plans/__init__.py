"""The jobs: raw drops -> bronze -> silver -> gold -> features."""

from tradewind.plans.bronze import bronze_table, channel_rows, ingest_batch, ingest_stream
from tradewind.plans.features import materialize_features
from tradewind.plans.gold import refresh_gold
from tradewind.plans.silver import refresh_silver

__all__ = [
    "bronze_table",
    "channel_rows",
    "ingest_batch",
    "ingest_stream",
    "materialize_features",
    "refresh_gold",
    "refresh_silver",
]
