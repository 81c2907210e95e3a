"""Latest versions by part: the same rows as over whole records, with less shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from tests import drops as D
from tests.test_conform import AT, latest
from tradewind.checks import frames
from tradewind.checks.queries import QUERIES
from tradewind.operators import conform
from tradewind.operators.dedupe import dedupe_few, dedupe_latest, latest_slim
from tradewind.sources import read_pos, with_ingest_meta

SF_DIR = "/root/testdata/sf0.001"


def plain(df):
    return sorted(map(str, df.collect()))


def exchanges(df) -> list:
    """Columns by which rows are shuffled, each shuffle that runs once."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text[: text.index("== Initial Plan ==")]
    return [re.sub(r"#\d+L?", "", k) for k in re.findall(r"- Exchange hashpartitioning\((.*?), \d+\)", final)]


def test_ties_are_decided_by_whole_rows(spark):
    rows = [
        ("a", 1, "f", "x", 9), ("a", 2, "f", "x", 1), ("a", 2, "f", "y", 0),  # a later column decides
        ("b", 2, "f", "z", 5), ("b", 2, "g", "a", 1),  # the file decides
        ("c", 1, "f", "x", 3), ("c", 1, "f", "x", 3),  # the same row twice
        ("d", None, "f", "x", 1), ("d", 1, "a", "x", 2),
        ("e", None, "f", "x", 1), ("e", None, "f", "y", 0),
        (None, 1, "f", "x", 1), (None, 3, "f", "x", 2), (None, 3, "f", "w", 7),
        ("f", 1, None, None, None), ("g", 4, "f", "x", 6), ("g", 4, "f", None, 8),
    ]
    df = spark.createDataFrame(rows, "k string, at int, file string, c string, v int").repartition(5)
    slim = ["v", F.upper("c").alias("u")]
    expected = dedupe_latest(df, ["k"], ["at", "file"]).select("k", *slim)
    assert plain(latest_slim(df, ["k"], ["at", "file"], slim)) == plain(expected)


def test_a_part_is_that_of_the_latest_record(spark):
    for channel, feed in frames.FEEDS.items():
        once = feed(spark, SF_DIR)
        key = conform.BRONZE_KEYS[channel]
        used = [c for c in once.columns if c not in (key, "lineItems", "items", "OrderItems")]
        empty = once.limit(40).select(*(F.lit(None).cast(once.schema[c].dataType).alias(c) if c in used else c for c in once.columns))
        df = once.unionByName(once.limit(50)).unionByName(empty)
        whole = conform.latest_bronze(df, channel)
        for part, make in zip((conform.ORDERS, conform.ITEMS), conform.CONFORM[channel]):
            assert plain(make(conform.latest_part(df, channel, part))) == plain(make(whole)), (channel, part)


@pytest.mark.parametrize("repeats", [0, 3])
def test_few_keys_meet_again(spark, repeats):
    rows = [(None if i % 10 == 0 else f"k{i}", i % 4, i) for i in range(400)]
    rows += [(f"k{i % 7}", i % 3, -i) for i in range(repeats)] + [(None, 1, 0)] * repeats
    df = spark.createDataFrame(rows, "k string, r int, v int").repartition(5)
    keyed = dedupe_latest(df.filter("k is not null"), ["k"], ["r"])
    assert plain(dedupe_few(df, "k", ["r"])) == plain(keyed.unionByName(df.filter("k is null")))


ITEM = "order_item_id string, order_id string, sku string, title string, quantity int, unit_price double, total_amount double"


def test_items_meet_across_orders_and_channels(spark):
    def items(*rows):
        return spark.createDataFrame([(*r, "t", 1, float(i), 1.0) for i, r in enumerate(rows)], ITEM)

    frame = {
        "shopify": items(("S", "o9", "c"), ("S", "o8", "c"), (None, "o8", "c"), ("P", "o", "c")),
        "pos": items(("P", "a-b", "c"), ("Q", "a", "b"), (None, "a", "b"), (None, "a", "b")),
        "distributor": items(("D", "i", "c"), ("S", "i", "c")),
        "amazon": items(("P", "a", "b-c"), ("Q", "a", "b"), (None, "a", "b"), ("D", "x", "y")),
    }
    got = conform.union_items(frame).collect()
    found = sorted((r["order_item_id"] or "", r["order_id"], r["channel_rank"]) for r in got)
    null = [("", "a", 2), ("", "a", 2), ("", "a", 4), ("", "o8", 1)]
    assert found == [*null, ("D", "x", 4), ("P", "a", 4), ("Q", "a", 4), ("S", "i", 3)]


def test_records_are_shuffled_once_and_orders_lie_by_id(spark):
    keys = ["id", "transaction_id", "TransactionID", "AmazonOrderId"]
    orders = exchanges(QUERIES["union_channels"](spark, SF_DIR))
    assert "order_id" not in orders and orders.count("InvoiceNumber") == 1
    for name in ("union_channels", "union_items", "item_totals", "union_products"):
        by = exchanges(QUERIES[name](spark, SF_DIR))
        # once for the rows of each channel, and once for its ties of ingest time
        assert all(1 <= by.count(k) <= 2 for k in keys), (name, by)


def test_an_order_whose_versions_tie_keeps_its_items(spark, tmp_path):
    first = read_pos(spark, D.write(tmp_path / "1", "p.json", [D.pos_transaction("t1")]))
    second = read_pos(spark, D.write(tmp_path / "2", "p.json", [D.pos_transaction("t1", store_name="A", items=[])]))
    whole = latest(first.unionByName(second), "pos")
    both = with_ingest_meta(first.unionByName(second), ingest_time=AT)
    got = conform.latest_part(both, "pos", conform.ITEMS)
    assert plain(conform.pos_items(got)) == plain(conform.pos_items(whole))
