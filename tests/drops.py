"""Small raw drops, written as the channels would deliver them."""

import json
import pathlib


def money(amount, currency="INR"):
    return {"presentmentMoney": {"amount": amount, "currencyCode": currency}}


def node(oid="s1", **over):
    base = {
        "id": oid,
        "name": f"#{oid}",
        "createdAt": "2026-07-20T10:00:00Z",
        "totalPriceSet": money("236.00"),
        "subtotalPriceSet": money("200.00"),
        "totalTaxSet": money("36.00"),
        "email": "a.b@example.com",
        "customer": {"id": "c1", "firstName": "A", "lastName": "B", "phone": None},
        "lineItems": {
            "edges": [
                {
                    "node": {
                        "id": f"{oid}/1",
                        "title": "Socks",
                        "quantity": 2,
                        "sku": "SKU-1",
                        "variant": {"price": "100.00", "sku": "SKU-1"},
                    }
                }
            ]
        },
        "sourceName": "web",
        "tags": ["UPI"],
    }
    base.update(over)
    return base


def envelope(*nodes):
    return {"data": {"orders": {"edges": [{"node": n} for n in nodes]}}}


def amazon_order(oid="a1", items=(("SKU-1", "Socks", 2, "200.00", "36.00"),), **over):
    base = {
        "AmazonOrderId": oid,
        "SellerOrderId": f"S-{oid}",
        "PurchaseDate": "2026-07-20T09:00:00Z",
        "LastUpdateDate": "2026-07-20T09:30:00Z",
        "OrderStatus": "Shipped",
        "FulfillmentChannel": "MFN",
        "SalesChannel": "Amazon.in",
        "OrderTotal": {"CurrencyCode": "INR", "Amount": "236.00"},
        "NumberOfItemsShipped": 1,
        "NumberOfItemsUnshipped": 0,
        "PaymentMethod": "COD",
        "BuyerEmail": "x@example.com",
        "BuyerInfo": {"BuyerName": "X", "BuyerCounty": "IN"},
        "OrderItems": None
        if items is None
        else [
            {
                "ASIN": "B0",
                "SellerSKU": sku,
                "Title": title,
                "QuantityOrdered": quantity,
                "QuantityShipped": quantity,
                "ItemPrice": {"CurrencyCode": "INR", "Amount": price},
                "ItemTax": {"CurrencyCode": "INR", "Amount": tax},
            }
            for sku, title, quantity, price, tax in items
        ],
    }
    base.update(over)
    return base


def pos_transaction(tid="t1", items=(("SKU-1", "Socks", 2, 100.0, 200.0),), **over):
    base = {
        "transaction_id": tid,
        "store_id": "st1",
        "store_name": "Delhi",
        "timestamp": "2026-07-20T11:00:00Z",
        "cashier_id": "k1",
        "items": None
        if items is None
        else [
            {"sku": s, "title": t, "quantity": q, "unit_price": p, "amount": a}
            for s, t, q, p, a in items
        ],
        "subtotal_amount": 200.0,
        "tax_amount": 36.0,
        "total_amount": 236.0,
        "payment_method": "CASH",
        "customer_loyalty_id": None,
    }
    base.update(over)
    return base


CSV_HEADER = (
    "TransactionID,DistributorID,DistributorName,Region,InvoiceNumber,InvoiceDate,SKU,Quantity,"
    "UnitPrice,DiscountPercent,TaxAmount,TotalAmount,PaymentStatus"
)


def csv_row(tid="d1", invoice="INV-1", sku="SKU-1", quantity=2, total="118.00", tax="18.00"):
    return (
        f"{tid},D1,Dist One,North,{invoice},2026-07-20,{sku},{quantity},50.00,0,{tax},{total},PAID"
    )


def write(folder, name, content):
    folder = pathlib.Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content)
    (folder / name).write_text(text)
    return str(folder)


def all_channels(root):
    """One landing folder per channel with a first delivery."""
    root = pathlib.Path(root)
    return {
        "shopify": write(root / "shopify", "s.json", envelope(node("s1"), node("s2"))),
        "pos": write(
            root / "pos",
            "p.json",
            [pos_transaction("t1"), pos_transaction("t2", customer_loyalty_id="L9")],
        ),
        "distributor": write(
            root / "distributor",
            "d.csv",
            "\n".join([CSV_HEADER, csv_row("d1"), csv_row("d2", sku="SKU-2"), csv_row("d3", "INV-2")]),
        ),
        "amazon": write(
            root / "amazon", "a.json", {"Orders": [amazon_order("a1"), amazon_order("a2")]}
        ),
    }
