"""Orders and items of all channels in parts: the rows of one frame, with little on disk."""

import time

import pytest
from pyspark.sql import functions as F

from tests.test_buckets import shuffle_files
from tests.test_slim import plain
from tradewind.checks import frames
from tradewind.checks.queries import QUERIES
from tradewind.operators import conform
from tradewind.plans import channels

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feeds(spark):
    """Feeds in which records come again, and some without a key or without anything else."""
    out = {}
    for channel, feed in frames.FEEDS.items():
        once = feed(spark, SF_DIR).limit(600)
        key = conform.BRONZE_KEYS[channel]
        again = once.limit(60).withColumn("_ingest_time", F.lit("2030-01-01").cast("timestamp"))
        odd = once.limit(30)
        no_key, no_rest = (
            odd.select(*(F.lit(None).cast(f.dataType).alias(f.name) if empty(f.name) else f.name for f in odd.schema))
            for empty in (lambda c: c == key, lambda c: c not in (key, "lineItems", "items", "OrderItems"))
        )
        rows = once.unionByName(again).unionByName(again.limit(20)).unionByName(no_key).unionByName(no_rest)
        if channel == "distributor":  # its latest version moved to another invoice
            rows = rows.withColumn(
                "InvoiceNumber", F.when(F.year("_ingest_time") == 2030, "INV-0").otherwise(F.col("InvoiceNumber"))
            )
        out[channel] = rows.localCheckpoint()
    return out


@pytest.mark.parametrize("made", [channels.all_orders, channels.all_items])
def test_parts_give_the_rows_of_one_frame_and_free_their_shuffles(spark, feeds, made):
    expected = plain(made(feeds, 1))
    assert expected
    files = shuffle_files(spark)
    found = made(feeds, 3)
    until = time.time() + 20
    while shuffle_files(spark) - files and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - files
    assert plain(found) == expected
    assert plain(made({c: feeds[c] for c in ("distributor", "shopify")}, 2)) == plain(
        made({c: feeds[c] for c in ("distributor", "shopify")}, 1)
    )


def test_items_keyed_after_they_were_written_are_the_same(feeds):
    latest = {c: conform.latest_part(rows, c, conform.ITEMS) for c, rows in feeds.items()}
    for some in ((), ("pos",), ("shopify", "amazon")):
        bronze = {c: rows for c, rows in latest.items() if not some or c in some}
        whole = conform.conform_items(bronze)
        found = conform.meet_items(conform.unkeyed_items(bronze))
        assert found.columns == whole.columns and plain(found) == plain(whole)


@pytest.mark.parametrize("name", ["union_channels", "union_items", "union_products"])
def test_large_feeds_are_taken_in_parts(spark, monkeypatch, name):
    expected = plain(QUERIES[name](spark, SF_DIR))
    seen, written = [], channels.written
    monkeypatch.setattr(channels, "written", lambda make, n, to: (seen.append((to, n)), written(make, n, to))[1])
    assert channels.part_count(frames_of(spark), conform.ITEMS) == 1
    monkeypatch.setattr(channels, "PART_BYTES", 1)
    size = channels.part_count(frames_of(spark), conform.ORDERS if name == "union_channels" else conform.ITEMS)
    monkeypatch.setattr(channels, "PART_BYTES", size // 2 + 1)
    assert plain(QUERIES[name](spark, SF_DIR)) == expected
    assert seen == ([("lines", 2), ("orders", 2)] if name == "union_channels" else [("items", 2), ("repeated", 1)])


def frames_of(spark):
    return {c: feed(spark, SF_DIR) for c, feed in frames.FEEDS.items()}
