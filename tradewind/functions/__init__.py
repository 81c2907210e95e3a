"""Column expressions shared by the operators. All are built-in functions, no UDF."""

from tradewind.functions.columns import (
    cents,
    day_text,
    from_cents,
    item_key,
    money_avg,
    money_sum,
    number,
    timestamp,
    whole,
)
from tradewind.functions.payload import decode_json, route_decoded, split_decoded

__all__ = [
    "cents",
    "day_text",
    "decode_json",
    "from_cents",
    "item_key",
    "money_avg",
    "money_sum",
    "number",
    "route_decoded",
    "split_decoded",
    "timestamp",
    "whole",
]
