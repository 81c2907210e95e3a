from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests import drops as D
from tradewind import schemas as S
from tradewind.operators import conform
from tradewind.operators.dedupe import duplicate_keys
from tradewind.plans.silver import latest_rows
from tradewind.sources import (
    read_amazon,
    read_distributor,
    read_pos,
    read_shopify,
    with_ingest_meta,
)

AT = datetime(2026, 7, 21)


def latest(df, channel, at=AT):
    return conform.latest_bronze(with_ingest_meta(df, ingest_time=at), channel)


def test_shopify(spark, tmp_path):
    path = D.write(
        tmp_path,
        "s.json",
        D.envelope(
            D.node("s1"),
            D.node("s2", tags=[], createdAt="soon", totalPriceSet=D.money("abc")),
            D.node("s3", lineItems={"edges": []}, customer=None),
        ),
    )
    rows = latest(read_shopify(spark, path), "shopify")
    orders = {r["order_id"]: r for r in conform.shopify_orders(rows).collect()}
    assert orders["s1"]["created_at"] == datetime(2026, 7, 20, 10)
    assert (orders["s1"]["subtotal_amount"], orders["s1"]["tax_amount"]) == (200.0, 36.0)
    assert orders["s1"]["payment_method"] == "UPI" and orders["s2"]["payment_method"] == "ONLINE"
    # text that does not parse is null and left to the rules
    assert orders["s2"]["created_at"] is None and orders["s2"]["total_amount"] is None
    assert orders["s3"]["customer_id"] is None
    items = {r["order_item_id"]: r for r in conform.shopify_items(rows).collect()}
    assert set(items) == {"s1/1", "s2/1"}
    assert (items["s1/1"]["unit_price"], items["s1/1"]["total_amount"]) == (100.0, 200.0)


def test_pos_items_and_key_collision(spark, tmp_path):
    twice = (("SKU-1", "Socks", 1, 100.0, 100.0), ("SKU-1", "Socks", 2, 100.0, 200.0))
    path = D.write(
        tmp_path,
        "p.json",
        [
            D.pos_transaction("t1", twice),
            D.pos_transaction("t2", []),
            D.pos_transaction("t3", None),
            D.pos_transaction("t4", ((None, "No SKU", 1, 1.0, 1.0),)),
        ],
    )
    rows = latest(read_pos(spark, path), "pos")
    assert conform.pos_orders(rows).count() == 4
    items = conform.pos_items(rows)
    assert items.groupBy("order_id").count().orderBy("order_id").collect() == [("t1", 2), ("t4", 1)]
    assert items.filter("order_id = 't4'").first()["order_item_id"] is None
    # a SKU listed twice gets two keys, so no line is lost
    assert duplicate_keys(items, ["order_item_id"]).isEmpty()
    merged = conform.union_items({"pos": items})
    assert sorted(r["quantity"] for r in merged.filter("order_id = 't1'").collect()) == [1, 2]


def test_distributor_rollup(spark, tmp_path):
    path = D.write(
        tmp_path,
        "d.csv",
        "\n".join([D.CSV_HEADER, D.csv_row("d1"), D.csv_row("d2"), D.csv_row("d3", "INV-2")]),
    )
    rows = latest(read_distributor(spark, path), "distributor")
    orders = {r["order_id"]: r for r in conform.distributor_orders(rows).collect()}
    first = orders["INV-1"]
    assert (first["total_amount"], first["tax_amount"], first["subtotal_amount"]) == (236.0, 36.0, 200.0)
    assert first["created_at"] == datetime(2026, 7, 20)
    assert (first["payment_method"], first["region"], first["customer_id"]) == (
        "BANK_TRANSFER",
        "North",
        "D1",
    )
    item = conform.distributor_items(rows).filter("order_item_id = 'd1'").first()
    # the distributor's item amount includes tax
    assert (item["title"], item["total_amount"]) == ("SKU-1", 118.0)


def test_csv_with_another_header_ends_the_read(spark, tmp_path):
    path = D.write(tmp_path, "d.csv", "A,B\n1,2")
    with pytest.raises(Exception):
        read_distributor(spark, path).collect()


def test_amazon_sums_and_zero_quantity(spark, tmp_path):
    two = (("SKU-1", "Socks", 2, "200.00", "36.00"), ("SKU-2", "Free", 0, "0.10", "0.20"))
    path = D.write(
        tmp_path,
        "a.json",
        {
            "Orders": [
                D.amazon_order("a1", two),
                D.amazon_order("a2", []),
                D.amazon_order("a3", None),
                D.amazon_order("a4", (("SKU-1", "Socks", 1, "x", "1.00"),)),
            ]
        },
    )
    rows = latest(read_amazon(spark, path), "amazon")
    orders = {r["order_id"]: r for r in conform.amazon_orders(rows).collect()}
    assert (orders["a1"]["subtotal_amount"], orders["a1"]["tax_amount"]) == (200.1, 36.2)
    for empty in ("a2", "a3"):
        assert orders[empty]["subtotal_amount"] is None and orders[empty]["tax_amount"] is None
    assert orders["a4"]["subtotal_amount"] is None and orders["a4"]["tax_amount"] == 1.0
    free = conform.amazon_items(rows).filter("sku = 'SKU-2'").first()
    assert free["unit_price"] is None and free["quantity"] == 0


def test_folded_sums_equal_the_join(spark, tmp_path):
    items = tuple((f"SKU-{i}", "T", 1, f"{i}.10", f"0.{i}0") for i in range(1, 9))
    path = D.write(tmp_path, "a.json", {"Orders": [D.amazon_order("a1", items), D.amazon_order("a2", [])]})
    rows = latest(read_amazon(spark, path), "amazon")
    folded = conform.amazon_orders(rows).select("order_id", "subtotal_amount", "tax_amount")
    lines = rows.select("AmazonOrderId", F.explode("OrderItems").alias("i")).select(
        F.col("AmazonOrderId").alias("order_id"),
        F.col("i.ItemPrice.Amount").cast("double").alias("total_amount"),
        F.col("i.ItemTax.Amount").cast("double").alias("tax_amount"),
    )
    joined = conform.with_item_sums(folded.select("order_id"), lines).select(*folded.columns)
    assert sorted(folded.collect()) == sorted(joined.collect())


def test_later_ingest_wins(spark, tmp_path):
    first = read_pos(spark, D.write(tmp_path / "1", "p.json", [D.pos_transaction("t1")]))
    second = read_pos(
        spark, D.write(tmp_path / "2", "p.json", [D.pos_transaction("t1", total_amount=1.0)])
    )
    both = with_ingest_meta(first, ingest_time=datetime(2026, 7, 22)).unionByName(
        with_ingest_meta(second, ingest_time=datetime(2026, 7, 21))
    )
    assert conform.latest_bronze(both, "pos").first()["total_amount"] == 236.0


def _order(spark, channel, total, currency="INR"):
    schema = S.SILVER_ORDERS.fieldNames()
    row = dict.fromkeys(schema[:-1])
    row.update(order_id="1", channel=channel, total_amount=total, currency=currency)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.SILVER_ORDERS.fields[:-1])
    return spark.createDataFrame([tuple(row.values())], types)


def test_an_id_in_two_channels_equals_loading_them_in_turn(spark):
    from tradewind.operators.upsert import upsert_table

    frames = {
        "shopify": _order(spark, "shopify", 1.0, "USD"),
        "amazon": _order(spark, "amazon", 3.0),
        "pos": _order(spark, "pos", 2.0),
    }
    got = conform.union_orders(frames).collect()
    in_turn = frames["shopify"]
    for channel in ("pos", "amazon"):
        in_turn = upsert_table("silver.orders", in_turn, frames[channel])
    assert got == in_turn.select(*conform.union_orders(frames).columns).collect()
    assert (got[0]["channel"], got[0]["currency"], got[0]["total_amount"]) == ("shopify", "USD", 3.0)


ITEM = "sku string, title string, unit_price double, channel_rank int"


def test_products_prefer_the_last_channel_with_a_real_title(spark):
    items = spark.createDataFrame(
        [
            ("A", "Socks", 10.0, 1),
            ("A", "Long socks", 11.0, 2),
            ("A", "A", 12.0, 3),
            ("B", "B", 5.0, 3),
            (None, "No SKU", 1.0, 1),
        ],
        ITEM,
    )
    got = {r["sku"]: (r["title"], r["retail_price"]) for r in conform.extract_products(items).collect()}
    assert got == {"A": ("Long socks", 11.0), "B": ("B", 5.0), None: ("No SKU", 1.0)}
    plain = conform.extract_products(items, sku_as_title=True)
    assert {r["sku"]: r["title"] for r in plain.collect()}["A"] == "A"


def test_an_increment_knows_rows_that_moved_between_invoices(spark):
    def row(tid, invoice, day):
        values = dict.fromkeys(S.BRONZE["distributor_sales"].fieldNames())
        values.update(
            TransactionID=tid,
            InvoiceNumber=invoice,
            ingest_date=f"2026-07-{day:02d}",
            _ingest_time=datetime(2026, 7, day),
        )
        return tuple(values.values())

    bronze = spark.createDataFrame(
        [
            row("x", "INV-1", 1),
            row("x", "INV-9", 2),
            row("y", "INV-1", 1),
            row("z", "INV-9", 1),
            row("n", "INV-1", 3),
        ],
        S.BRONZE["distributor_sales"],
    )
    got = latest_rows("distributor", bronze, "2026-07-03")
    # x left INV-1 before the increment; its old version must not come back
    assert sorted(r["TransactionID"] for r in got.collect()) == ["n", "y"]
    moved = latest_rows("distributor", bronze, "2026-07-02").collect()
    # x's move touches both invoices
    assert sorted((r["TransactionID"], r["InvoiceNumber"]) for r in moved) == [
        ("n", "INV-1"), ("x", "INV-9"), ("y", "INV-1"), ("z", "INV-9"),
    ]


def test_no_line_of_an_order_is_lost(spark):
    line = '{"sku": "%s", "quantity": "%s", "amount": %s}'
    lines = [line % ("A", "2", 1.5), line % ("A", "2.0", 1.5), line % ("B", "x", '"NaN"')]
    text = '{"transaction_id": "t", "items": [%s, {"quantity": "1"}, {"quantity": "3"}]}'
    rows = spark.createDataFrame([(text % ", ".join(lines),)], "t string").select(
        F.from_json("t", S.POS_TRANSACTION).alias("r")
    )
    items = conform.union_items({"pos": conform.pos_items(rows.select("r.*"))}).collect()
    assert sorted((r["sku"] or "", r["quantity"] or 0, r["total_amount"] or 0) for r in items) == [
        ("", 1, 0),
        ("", 3, 0),
        ("A", 2, 1.5),
        ("A", 2, 1.5),
        ("B", 0, 0),
    ]
    keys = [r["order_item_id"] for r in items if r["sku"]]
    assert len(set(keys)) == 3


def lines_of(spark, tmp_path, *orders):
    D.write(tmp_path, "p.json", [D.pos_transaction(f"t{i}", items) for i, items in enumerate(orders)])
    return conform.pos_items(latest(read_pos(spark, str(tmp_path)), "pos")).collect()


def test_a_real_sku_never_has_the_key_of_a_repeated_one(spark, tmp_path):
    skus = ["A", "A", "A#2", "A#2", None, "B", None, "A"]
    rows = lines_of(spark, tmp_path, [(s, "x", n, 1.0, 1.0) for n, s in enumerate(skus)], [], None)
    keys = {int(r["quantity"]): r["order_item_id"] for r in rows}
    assert len(rows) == len(skus) and [n for n, k in sorted(keys.items()) if k is None] == [4, 6]
    assert len({k for k in keys.values() if k}) == 6
    # all lines survive the union, those without a key too
    items = conform.pos_items(latest(read_pos(spark, str(tmp_path)), "pos"))
    assert conform.union_items({"pos": items}).count() == len(skus)


def test_an_order_of_many_lines_takes_no_longer_than_their_number(spark, tmp_path):
    n = 30_000
    rows = lines_of(
        spark,
        tmp_path,
        [(f"S{i % 1000}", "x", i, 1.0, 1.0) for i in range(n)],
        [("S", "x", i, 1.0, 1.0) for i in range(n)],
    )
    assert len(rows) == 2 * n == len({r["order_item_id"] for r in rows})
