"""Orders and items of all channels from whole feeds, on little disk.

The shuffles of a run over all channels take several times the disk of its result, and Spark keeps them until the
last task. Large feeds are therefore taken in parts by the hash of their keys: a part's rows are written and
its shuffle files removed before the next begins. Each part reads the feeds again, which is less than it
shuffles. Small feeds are one lazy frame.
"""

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators import conform
from tradewind.sinks.shared import written

# Bytes of the columns needed, as Spark plans them, that one part may hold.
PART_BYTES = 6 << 30


def part_count(feeds: "dict[str, DataFrame]", columns: str) -> int:
    """Parts for feeds of this size, by Spark's own estimate."""
    needed = (conform.part_columns(rows, c, columns) for c, rows in feeds.items())
    plans = (rows._jdf.queryExecution().optimizedPlan() for rows in needed)
    return max(1, ceil(sum(int(str(p.stats().sizeInBytes())) for p in plans) / PART_BYTES))


def _in_part(key: str, part: int, parts: int) -> Column:
    """Rows with one key are in one part; null is a key like any other."""
    return F.pmod(F.xxhash64(key), F.lit(parts)) == part


def _latest(feeds: "dict[str, DataFrame]", columns: str, part: int = 0, parts: int = 1) -> dict:
    def mine(channel: str, rows: DataFrame) -> DataFrame:
        return rows.filter(_in_part(conform.BRONZE_KEYS[channel], part, parts)) if parts > 1 else rows

    return {c: conform.latest_part(mine(c, rows), c, columns) for c, rows in feeds.items()}


def all_orders(feeds: "dict[str, DataFrame]", parts: "int | None" = None) -> DataFrame:
    """Orders of all channels from their feeds; in parts this runs jobs.

    An invoice is spread over rows that may have moved between invoices, so the latest rows are found first,
    by their own key, and then taken by invoice.
    """
    parts = parts or part_count(feeds, conform.ORDERS)
    if parts == 1:
        return conform.conform_orders(_latest(feeds, conform.ORDERS))
    lines = {c: rows for c, rows in feeds.items() if c == "distributor"}
    whole = {c: rows for c, rows in feeds.items() if c not in lines}
    for c in lines:
        lines[c] = written(
            lambda i, c=c: _latest({c: feeds[c]}, conform.ORDERS, i, parts)[c], parts, "lines"
        )

    def part(i: int) -> DataFrame:
        invoices = {c: rows.filter(_in_part("InvoiceNumber", i, parts)) for c, rows in lines.items()}
        return conform.conform_orders(_latest(whole, conform.ORDERS, i, parts) | invoices)

    return written(part, parts, "orders")


def all_items(feeds: "dict[str, DataFrame]", parts: "int | None" = None) -> DataFrame:
    """Items of all channels from their feeds, with ``channel_rank``; in parts this runs jobs."""
    parts = parts or part_count(feeds, conform.ITEMS)
    if parts == 1:
        return conform.conform_items(_latest(feeds, conform.ITEMS))
    unkeyed = written(
        lambda i: conform.unkeyed_items(_latest(feeds, conform.ITEMS, i, parts)), parts, "items"
    )
    return conform.meet_items(unkeyed, lambda rows: written(lambda _: rows, 1, "repeated"))
