"""Raw channel rows -> the silver orders / order items / products model.

Every ``*_orders`` and ``*_items`` function takes rows that hold one version per key (see
``dedupe_latest``) and returns the silver columns without the processing stamp.

Item amounts keep the meaning their channel gives them: without tax for shopify, pos and
amazon, with tax for the distributor. Customer ids are whatever identity the channel has.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind import schemas as S
from tradewind.functions import cents, from_cents, item_key, money_sum, number, timestamp, whole
from tradewind.operators.dedupe import dedupe_few, dedupe_latest, latest_slim

BRONZE_KEYS = {
    "shopify": "id",
    "pos": "transaction_id",
    "distributor": "TransactionID",
    "amazon": "AmazonOrderId",
}

LATEST = ("_ingest_time", "_ingest_file_name")

# The raw columns silver is made of, besides the key.
_USED = {
    "shopify": (
        "name",
        "createdAt",
        "totalPriceSet",
        "subtotalPriceSet",
        "totalTaxSet",
        "email",
        "customer",
        "lineItems",
        "tags",
    ),
    "pos": (
        "store_name",
        "timestamp",
        "items",
        "subtotal_amount",
        "tax_amount",
        "total_amount",
        "payment_method",
        "customer_loyalty_id",
    ),
    "distributor": (
        "DistributorID",
        "Region",
        "InvoiceNumber",
        "InvoiceDate",
        "SKU",
        "Quantity",
        "UnitPrice",
        "TaxAmount",
        "TotalAmount",
        "PaymentStatus",
    ),
    "amazon": (
        "SellerOrderId",
        "PurchaseDate",
        "SalesChannel",
        "OrderTotal",
        "PaymentMethod",
        "BuyerEmail",
        "OrderItems",
    ),
}


ORDERS, ITEMS = "orders", "items"


def _only(items: str, **fields) -> Column:
    """The array with these fields of its items only, each made from the item."""
    return F.transform(items, lambda x: F.struct(*(make(x).alias(f) for f, make in fields.items()))).alias(items)


def _amount(part: str):
    return lambda x: F.struct(number(x[part]["Amount"]).alias("Amount"))


def _money(c: str, **fields) -> Column:
    return F.struct(F.struct(*(v.alias(f) for f, v in fields.items())).alias("presentmentMoney")).alias(c)


def _slim(channel: str, part: str) -> list:
    """The columns of a record that its orders or its items are made of, cast as these cast them."""
    return {
        ("shopify", ORDERS): lambda: [
            "name",
            timestamp("createdAt").alias("createdAt"),
            F.struct("customer.id").alias("customer"),
            "email",
            _money(
                "totalPriceSet",
                amount=number("totalPriceSet.presentmentMoney.amount"),
                currencyCode=F.col("totalPriceSet.presentmentMoney.currencyCode"),
            ),
            *(
                _money(c, amount=number(f"{c}.presentmentMoney.amount"))
                for c in ("subtotalPriceSet", "totalTaxSet")
            ),
            F.slice("tags", 1, 1).alias("tags"),
        ],
        ("shopify", ITEMS): lambda: [
            F.struct(
                F.transform(
                    "lineItems.edges.node",
                    lambda x: F.struct(
                        F.struct(
                            x["id"].alias("id"),
                            x["sku"].alias("sku"),
                            x["title"].alias("title"),
                            whole(x["quantity"]).alias("quantity"),
                            F.struct(number(x["variant"]["price"]).alias("price")).alias("variant"),
                        ).alias("node")
                    ),
                ).alias("edges")
            ).alias("lineItems")
        ],
        ("pos", ORDERS): lambda: [
            "store_name",
            timestamp("timestamp").alias("timestamp"),
            *(number(c).alias(c) for c in ("subtotal_amount", "tax_amount", "total_amount")),
            "payment_method",
            "customer_loyalty_id",
        ],
        ("pos", ITEMS): lambda: [
            _only(
                "items",
                sku=lambda x: x["sku"],
                title=lambda x: x["title"],
                quantity=lambda x: whole(x["quantity"]),
                unit_price=lambda x: number(x["unit_price"]),
                amount=lambda x: number(x["amount"]),
            )
        ],
        ("distributor", ORDERS): lambda: [
            "DistributorID",
            "Region",
            "InvoiceNumber",
            "InvoiceDate",
            "TaxAmount",
            "TotalAmount",
            "PaymentStatus",
        ],
        ("distributor", ITEMS): lambda: [
            "InvoiceNumber",
            "SKU",
            whole("Quantity").alias("Quantity"),
            number("UnitPrice").alias("UnitPrice"),
            number("TotalAmount").alias("TotalAmount"),
        ],
        ("amazon", ORDERS): lambda: [
            "SellerOrderId",
            timestamp("PurchaseDate").alias("PurchaseDate"),
            "SalesChannel",
            F.struct(
                F.col("OrderTotal.CurrencyCode").alias("CurrencyCode"),
                number("OrderTotal.Amount").alias("Amount"),
            ).alias("OrderTotal"),
            "PaymentMethod",
            "BuyerEmail",
            _only("OrderItems", ItemPrice=_amount("ItemPrice"), ItemTax=_amount("ItemTax")),
        ],
        ("amazon", ITEMS): lambda: [
            _only(
                "OrderItems",
                SellerSKU=lambda x: x["SellerSKU"],
                Title=lambda x: x["Title"],
                QuantityOrdered=lambda x: whole(x["QuantityOrdered"]),
                ItemPrice=_amount("ItemPrice"),
            )
        ],
    }[channel, part]()


def part_columns(df: DataFrame, channel: str, part: str) -> DataFrame:
    """What ``latest_part`` shuffles of every record."""
    return df.select(BRONZE_KEYS[channel], LATEST[0], *_slim(channel, part))


def latest_part(df: DataFrame, channel: str, part: str) -> DataFrame:
    """``latest_bronze`` with only the columns that the channel's orders, or its items, are made of.

    The versions are those ``latest_bronze`` takes; its whole records are shuffled only where versions
    have the same ingest time. For jobs that make one of the two.
    """
    key = BRONZE_KEYS[channel]
    records = df.select(key, *_USED[channel], *LATEST)
    return latest_slim(records, [key], LATEST, _slim(channel, part))


def latest_bronze(df: DataFrame, channel: str) -> DataFrame:
    """Latest version of every raw record of a channel, by ingest time, then file name.

    Columns silver does not use are left out first: they need not be read or shuffled, and
    rows that differ in them only are interchangeable. Records are wide and have few versions, so they
    are not sorted before the shuffle.
    """
    key = BRONZE_KEYS[channel]
    return dedupe_latest(df.select(key, *_USED[channel], *LATEST), [key], LATEST, trim_first=False)


def shopify_orders(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").alias("order_id"),
        F.col("name").alias("order_number"),
        F.lit("shopify").alias("channel"),
        timestamp("createdAt").alias("created_at"),
        F.col("customer.id").alias("customer_id"),
        F.col("email").alias("customer_email"),
        F.col("totalPriceSet.presentmentMoney.currencyCode").alias("currency"),
        number("subtotalPriceSet.presentmentMoney.amount").alias("subtotal_amount"),
        number("totalTaxSet.presentmentMoney.amount").alias("tax_amount"),
        number("totalPriceSet.presentmentMoney.amount").alias("total_amount"),
        F.coalesce(F.get("tags", F.lit(0)), F.lit(S.DEFAULT_PAYMENT)).alias("payment_method"),
        F.lit(S.PAID).alias("payment_status"),
        F.lit(S.ONLINE_REGION).alias("region"),
    )


def shopify_items(df: DataFrame) -> DataFrame:
    lines = df.select(
        F.col("id").alias("order_id"), F.explode("lineItems.edges.node").alias("line")
    )
    price = number("line.variant.price")
    return lines.select(
        F.col("line.id").alias("order_item_id"),
        "order_id",
        F.col("line.sku").alias("sku"),
        F.col("line.title").alias("title"),
        whole("line.quantity").alias("quantity"),
        price.alias("unit_price"),
        (whole("line.quantity") * price).alias("total_amount"),
    )


def pos_orders(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("transaction_id").alias("order_id"),
        F.col("transaction_id").alias("order_number"),
        F.lit("pos").alias("channel"),
        timestamp("timestamp").alias("created_at"),
        F.col("customer_loyalty_id").alias("customer_id"),
        F.lit(None).cast("string").alias("customer_email"),
        F.lit(S.HOME_CURRENCY).alias("currency"),
        *[number(c).alias(c) for c in ("subtotal_amount", "tax_amount", "total_amount")],
        "payment_method",
        F.lit(S.PAID).alias("payment_status"),
        F.col("store_name").alias("region"),
    )


def _runs(items: Column, sku: str) -> Column:
    """The items by SKU: for each, an array of (sku, at, line) in the order's own order.

    The array is sorted by SKU and place and cut where the SKU changes, which takes no longer than
    the sort. The lambdas bind what they are given, so nothing is evaluated again for each item.
    """
    placed = F.transform(
        items, lambda x, i: F.struct(x[sku].alias("sku"), i.alias("at"), x.alias("line"))
    )

    def cut(by_sku: Column) -> Column:
        def begins(j: Column) -> Column:
            same = F.get(by_sku, j)["sku"].eqNullSafe(F.get(by_sku, j - 1)["sku"])
            return (j == 0) | ~same

        def slices(starts: Column) -> Column:
            return F.transform(
                starts,
                lambda start, n: F.slice(
                    by_sku, start + 1, F.coalesce(F.get(starts, n + 1), F.size(by_sku)) - start
                ),
            )

        starts = F.filter(F.sequence(F.lit(0), F.size(by_sku) - 1), begins)
        return F.when(F.size(by_sku) > 0, F.transform(F.array(starts), slices)[0])

    return F.transform(F.array(F.array_sort(placed)), cut)[0]


def _lines(df: DataFrame, order_id: str, items: str, sku: str) -> DataFrame:
    """``order_id, line, _nth`` of every item: its number among the order's lines of its SKU, from 0."""
    return (
        df.select(F.col(order_id).alias("order_id"), F.explode(_runs(F.col(items), sku)).alias("_run"))
        .select("order_id", F.posexplode("_run").alias("_nth", "_item"))
        .select("order_id", F.col("_item.line").alias("line"), "_nth")
    )


def _made_key() -> Column:
    """The key of a line: that of order and SKU.

    A SKU that an order lists again gets a key of its own, made from that key and its number among
    the order's lines of the SKU: an upsert takes one row per key, and no line may be lost. No SKU
    can have such a key, as an order's id and SKU are joined by a hyphen and a key holds none.
    """
    key = item_key("order_id", "sku")
    again = F.sha2(F.concat(key, F.lit("#"), (F.col("_nth") + 1).cast("string")), 256)
    return F.when(F.col("_nth") == 0, key).otherwise(again)


def _keyed(lines: DataFrame) -> DataFrame:
    return lines.select(_made_key().alias("order_item_id"), *(c for c in lines.columns if c != "_nth"))


def pos_lines(df: DataFrame) -> DataFrame:
    """``pos_items`` whose keys are still to be made, from ``order_id``, ``sku`` and ``_nth``."""
    return _lines(df, "transaction_id", "items", "sku").select(
        "order_id",
        "line.sku",
        "line.title",
        whole("line.quantity").alias("quantity"),
        number("line.unit_price").alias("unit_price"),
        number("line.amount").alias("total_amount"),
        "_nth",
    )


def pos_items(df: DataFrame) -> DataFrame:
    return _keyed(pos_lines(df))


def distributor_orders(df: DataFrame) -> DataFrame:
    """Invoice roll-up. Id, region and status come from the row with the least TransactionID."""

    def first_of(c: str):
        return F.min_by(c, "TransactionID")

    invoices = df.groupBy(F.col("InvoiceNumber").alias("order_id")).agg(
        F.min("InvoiceDate").cast("timestamp").alias("created_at"),
        first_of("DistributorID").alias("customer_id"),
        first_of("Region").alias("region"),
        first_of("PaymentStatus").alias("payment_status"),
        money_sum("TaxAmount").alias("tax_amount"),
        money_sum("TotalAmount").alias("total_amount"),
        from_cents(F.sum(cents("TotalAmount")) - F.sum(cents("TaxAmount"))).alias(
            "subtotal_amount"
        ),
    )
    return invoices.select(
        "order_id",
        F.col("order_id").alias("order_number"),
        F.lit("distributor").alias("channel"),
        "created_at",
        "customer_id",
        F.lit(None).cast("string").alias("customer_email"),
        F.lit(S.HOME_CURRENCY).alias("currency"),
        "subtotal_amount",
        "tax_amount",
        "total_amount",
        F.lit(S.DISTRIBUTOR_PAYMENT).alias("payment_method"),
        "payment_status",
        "region",
    )


def distributor_items(df: DataFrame) -> DataFrame:
    """Item grain as delivered. The report has no title, so the SKU stands in for it."""
    return df.select(
        F.col("TransactionID").alias("order_item_id"),
        F.col("InvoiceNumber").alias("order_id"),
        F.col("SKU").alias("sku"),
        F.col("SKU").alias("title"),
        whole("Quantity").alias("quantity"),
        number("UnitPrice").alias("unit_price"),
        number("TotalAmount").alias("total_amount"),
    )


def amazon_lines(df: DataFrame) -> DataFrame:
    """``amazon_items`` whose keys are still to be made, from ``order_id``, ``sku`` and ``_nth``."""
    amount = number("line.ItemPrice.Amount")
    return _lines(df, "AmazonOrderId", "OrderItems", "SellerSKU").select(
        "order_id",
        F.col("line.SellerSKU").alias("sku"),
        F.col("line.Title").alias("title"),
        whole("line.QuantityOrdered").alias("quantity"),
        F.try_divide(amount, whole("line.QuantityOrdered")).alias("unit_price"),
        amount.alias("total_amount"),
        "_nth",
    )


def amazon_items(df: DataFrame) -> DataFrame:
    return _keyed(amazon_lines(df))


def order_item_sums(lines: DataFrame) -> DataFrame:
    """Tax and subtotal per order from rows of ``order_id``, ``tax_amount``, ``total_amount``."""
    return lines.groupBy("order_id").agg(
        money_sum("tax_amount").alias("tax_amount"),
        money_sum("total_amount").alias("subtotal_amount"),
    )


def with_item_sums(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders with the sums of their items; an order without items keeps null sums."""
    return orders.join(order_item_sums(lines), "order_id", "left")


def amazon_orders(df: DataFrame) -> DataFrame:
    """One row per order; tax and subtotal are summed over the order's items.

    The items are an array inside the order row, so the sums are folded there: the same result
    as ``with_item_sums`` on the exploded items, without its two shuffles.
    """

    def folded(part: str):
        amounts = F.filter(
            F.transform("OrderItems", lambda line: number(line[part]["Amount"])),
            lambda amount: amount.isNotNull(),
        )
        total = F.aggregate(
            amounts,
            F.lit(0).cast("bigint"),
            lambda acc, amount: acc + cents(amount),
            from_cents,
        )
        return F.when(F.size(amounts) > 0, total)

    return df.select(
        F.col("AmazonOrderId").alias("order_id"),
        F.col("SellerOrderId").alias("order_number"),
        F.lit("amazon").alias("channel"),
        timestamp("PurchaseDate").alias("created_at"),
        F.col("BuyerEmail").alias("customer_id"),
        F.col("BuyerEmail").alias("customer_email"),
        F.col("OrderTotal.CurrencyCode").alias("currency"),
        folded("ItemPrice").alias("subtotal_amount"),
        folded("ItemTax").alias("tax_amount"),
        number("OrderTotal.Amount").alias("total_amount"),
        F.col("PaymentMethod").alias("payment_method"),
        F.lit(S.PAID).alias("payment_status"),
        F.col("SalesChannel").alias("region"),
    )


CONFORM = {
    "shopify": (shopify_orders, shopify_items),
    "pos": (pos_orders, pos_items),
    "distributor": (distributor_orders, distributor_items),
    "amazon": (amazon_orders, amazon_items),
}

# Channels whose item keys are made from order and SKU.
_LINES = {"pos": pos_lines, "amazon": amazon_lines}
_MADE_KEYS = tuple(_LINES)


def _union(frames: list) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _ranked(by_channel: "dict[str, DataFrame]") -> list:
    return [
        by_channel[c].withColumn("channel_rank", F.lit(S.CHANNEL_PRIORITY[c]))
        for c in S.CHANNELS
        if c in by_channel
    ]


def union_orders(by_channel: "dict[str, DataFrame]") -> DataFrame:
    """Conformed orders of all channels, one row per order id.

    An id met in several channels gives what loading them in turn gives: the values of the
    channel that loads last, with channel and currency of the one that loaded first. Every
    channel brings an id once, so a window here holds four rows at most.

    Channels that were ranked or grouped by their id lie by it already, so they are not shuffled again.
    Spark sees that only if no second column holds the id, which is why the number is made anew.
    """
    number_of = F.concat("order_number", F.lit(""))
    ranked = _union([rows.withColumn("order_number", number_of) for rows in _ranked(by_channel)])
    by_id = Window.partitionBy("order_id").orderBy("channel_rank")
    return (
        ranked.withColumns(
            {
                "channel": F.first("channel").over(by_id),
                "currency": F.first("currency").over(by_id),
                "_later": F.lead(F.lit(1)).over(by_id),
            }
        )
        .filter("_later is null")
        .drop("_later", "channel_rank")
    )


def union_items(by_channel: "dict[str, DataFrame]") -> DataFrame:
    """Conformed items of all channels, one row per item key; the later channel wins.

    Items without a key all stay, for the gate to count. ``channel_rank`` stays on the result for
    ``extract_products``.

    Two channels whose keys are made from order and SKU have them in common, mostly in the same order:
    these rows lie by order already and meet there, without a shuffle. Few keys are then met again.
    """
    made = [c for c in _MADE_KEYS if c in by_channel]
    rest = {c: rows for c, rows in by_channel.items() if c not in made}
    frames = _ranked(rest)
    if made:
        rows = _union(_ranked({c: by_channel[c] for c in made}))
        if len(made) > 1:
            in_order = Window.partitionBy("order_id", "order_item_id").orderBy(F.desc("channel_rank"))
            last = F.max("channel_rank").over(in_order)
            rows = rows.withColumn("_last", last).filter(
                "order_item_id is null or channel_rank = _last"
            ).drop("_last")
        frames.append(rows)
    return dedupe_few(_union(frames), "order_item_id", ["channel_rank"])


def conform_orders(bronze: "dict[str, DataFrame]") -> DataFrame:
    """Latest bronze rows by channel, or the parts of orders -> orders of all given channels."""
    return union_orders({c: CONFORM[c][0](rows) for c, rows in bronze.items()})


def conform_items(bronze: "dict[str, DataFrame]") -> DataFrame:
    """Latest bronze rows by channel, or the parts of items -> items of all given channels."""
    return union_items({c: CONFORM[c][1](rows) for c, rows in bronze.items()})


def unkeyed_items(bronze: "dict[str, DataFrame]") -> DataFrame:
    """``conform_items`` up to its last step, with the keys still to be made; ``meet_items`` takes it from here.

    For items that are written in between: a key is longer than the columns it is made of. Given keys are
    in ``order_item_id`` and have no ``_nth``. Rows with the same made key and order have met.
    """
    made = {c: make(bronze[c]) for c, make in _LINES.items() if c in bronze}
    given = {c: CONFORM[c][1](rows).withColumn("_nth", F.lit(None).cast("int")) for c, rows in bronze.items() if c not in made}
    frames = _ranked(given)
    if made:
        rows = _union(_ranked(made)).withColumn("order_item_id", F.lit(None).cast("string"))
        if len(made) > 1:
            in_order = Window.partitionBy("order_id", "sku", "_nth").orderBy(F.desc("channel_rank"))
            last = F.max("channel_rank").over(in_order)
            rows = rows.withColumn("_last", last).filter(
                "order_id is null or sku is null or channel_rank = _last"
            ).drop("_last")
        frames.append(rows)
    return _union(frames)


def meet_items(unkeyed: DataFrame, keep=lambda rows: rows) -> DataFrame:
    """Items of all channels from ``unkeyed_items``: the rows ``conform_items`` gives.

    ``keep`` may write the list of keys that repeat, so that finding them is a step of its own.
    """
    given = F.col("_nth").isNull()
    items = unkeyed.withColumn(
        "order_item_id", F.when(given, F.col("order_item_id")).otherwise(_made_key())
    ).select(*(f for f in S.SILVER_ORDER_ITEMS.fieldNames() if f != "_processed_at"), "channel_rank")
    return dedupe_few(items, "order_item_id", ["channel_rank"], keep)


def conform_all(bronze: "dict[str, DataFrame]") -> "tuple[DataFrame, DataFrame]":
    """Latest bronze rows by channel -> (orders, items) of all given channels."""
    return conform_orders(bronze), conform_items(bronze)


def extract_products(items: DataFrame, sku_as_title: bool = False) -> DataFrame:
    """One title and list price per SKU.

    ``items`` may carry ``channel_rank``: the channel that loads last decides. Within a channel
    the least (title, price) is taken. A title that only repeats the SKU is used if there is no
    other, unless ``sku_as_title`` asks for the plain last channel.

    The distinct pass first folds the items to their few title / price pairs per SKU in the
    hash aggregate; the string-valued choice then runs on that small remainder.
    """
    rank = F.col("channel_rank") if "channel_rank" in items.columns else F.lit(0)
    variants = items.select(
        "sku", "title", F.col("unit_price").alias("retail_price"), rank.alias("channel_rank")
    ).distinct()
    placeholder = F.lit(False) if sku_as_title else F.col("title").eqNullSafe(F.col("sku"))
    order = F.struct(placeholder, -F.col("channel_rank"), "title", "retail_price")
    chosen = F.min_by(F.struct("title", "retail_price"), order)
    return (
        variants.groupBy("sku").agg(chosen.alias("p")).select("sku", "p.title", "p.retail_price")
    )
