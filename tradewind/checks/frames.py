"""Channel and silver frames made from the star-schema tables, over all of their rows.

The mapping only exists to run the operators on given data:

* ``orders`` -> silver orders and the shopify feed; the channel follows the order priority.
* ``lineitem`` -> silver items and the distributor, pos and amazon feeds. (order, line) repeats
  in it, so those feeds hold several versions of a record; the ship date is the ingest time.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions import cents, day_text
from tradewind.sources import load_table

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the SQL side has them."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def _text(c: str):
    return F.col(c).cast("string")


def _amount_text(c):
    """Whole cents, not negative, as text with two decimals, the way the drops write money."""
    units = F.floor(c / F.lit(100.0)).cast("string")
    return F.concat(units, F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders. Tax is the 18 percent contained in the total, to the cent."""
    src = table(spark, sf_dir, "orders").select(
        "*", cents("o_totalprice").alias("total_cents")
    ).withColumn("tax_cents", F.expr("total_cents * 18 div 118"))
    channel = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "pos")
        .when(F.col("o_orderpriority").isin("2-HIGH", "5-LOW"), "shopify")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "distributor")
        .otherwise("amazon")
    )
    return src.withColumn("channel", channel).select(
        _text("o_orderkey").alias("order_id"),
        F.concat(F.lit("#"), _text("o_orderkey")).alias("order_number"),
        "channel",
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        _text("o_custkey").alias("customer_id"),
        F.when(
            F.col("channel").isin("shopify", "amazon"),
            F.concat(F.lit("c"), _text("o_custkey"), F.lit("."), F.col("channel"), F.lit("@example.com")),
        ).alias("customer_email"),
        F.lit("INR").alias("currency"),
        ((F.col("total_cents") - F.col("tax_cents")) / F.lit(100.0)).alias("subtotal_amount"),
        (F.col("tax_cents") / F.lit(100.0)).alias("tax_amount"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderstatus").alias("payment_status"),
        F.lit("Online").alias("region"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .withColumns(
            {
                "line_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
                "price_cents": cents("l_extendedprice"),
                "tax_pct": cents("l_tax"),
                "shipped": F.col("l_shipdate").cast("timestamp"),
                "unit_price": F.col("l_extendedprice") / F.col("l_quantity"),
            }
        )
        .withColumn("tax_cents", F.expr("(price_cents * tax_pct + 50) div 100"))
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver items with titles, plus tax and the ship time. The item id repeats."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("title"))
    lines = _lines(spark, sf_dir)
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("line_id").alias("order_item_id"),
        _text("l_orderkey").alias("order_id"),
        _text("l_partkey").alias("sku"),
        "title",
        F.col("l_quantity").cast("int").alias("quantity"),
        "unit_price",
        F.col("l_extendedprice").alias("total_amount"),
        (F.col("tax_cents") / F.lit(100.0)).alias("tax_amount"),
        F.col("shipped"),
    )


ITEM_COLUMNS = (
    "order_item_id", "order_id", "sku", "title", "quantity", "unit_price", "total_amount"
)


def _feed_meta(channel: str) -> dict:
    return {
        "_ingest_file_name": F.concat(
            F.lit(f"{channel}-"), _text("l_suppkey"), F.lit("-"), _text("l_partkey")
        ),
        "_ingest_time": F.col("shipped"),
        "ingest_date": day_text("shipped"),
    }


def distributor_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item-grain report rows; an invoice is an order key."""
    lines = _lines(spark, sf_dir).withColumns(_feed_meta("distributor"))
    return lines.select(
        F.col("line_id").alias("TransactionID"),
        _text("l_suppkey").alias("DistributorID"),
        F.concat(F.lit("Distributor "), _text("l_suppkey")).alias("DistributorName"),
        F.col("l_returnflag").alias("Region"),
        F.concat(F.lit("INV-"), _text("l_orderkey")).alias("InvoiceNumber"),
        F.to_date("shipped").alias("InvoiceDate"),
        _text("l_partkey").alias("SKU"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("unit_price").alias("UnitPrice"),
        cents("l_discount").cast("int").alias("DiscountPercent"),
        (F.col("tax_cents") / F.lit(100.0)).alias("TaxAmount"),
        ((F.col("price_cents") + F.col("tax_cents")) / F.lit(100.0)).alias("TotalAmount"),
        F.col("l_linestatus").alias("PaymentStatus"),
        "_ingest_file_name",
        "_ingest_time",
        "ingest_date",
    )


def _extra_sku():
    """SKU of the second line of a record: on line 7 it repeats the first line's SKU."""
    return F.when(F.col("l_linenumber") == 7, _text("l_partkey")).otherwise(
        F.concat(F.lit("S"), _text("l_suppkey"))
    )


def _line_array(first, second):
    """No line for return flag N, one for A, two for R."""
    return (
        F.when(F.col("l_returnflag") == "A", F.array(first))
        .when(F.col("l_returnflag") == "R", F.array(first, second))
        .otherwise(F.slice(F.array(first), 1, 0))
    )


def pos_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order line, of zero, one or two items."""
    lines = _lines(spark, sf_dir).withColumns(_feed_meta("pos"))
    first = F.struct(
        _text("l_partkey").alias("sku"),
        F.concat(F.lit("Part "), _text("l_partkey")).alias("title"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("unit_price"),
        F.col("l_extendedprice").alias("amount"),
    )
    second = F.struct(
        _extra_sku().alias("sku"),
        F.lit("Service").alias("title"),
        F.lit(1).alias("quantity"),
        (F.col("tax_cents") / F.lit(100.0)).alias("unit_price"),
        (F.col("tax_cents") / F.lit(100.0)).alias("amount"),
    )
    return lines.select(
        F.concat(F.lit("T"), F.col("line_id")).alias("transaction_id"),
        _text("l_suppkey").alias("store_id"),
        F.concat(F.lit("Store "), _text("l_suppkey")).alias("store_name"),
        F.date_format("shipped", ISO).alias("timestamp"),
        F.lit("till").alias("cashier_id"),
        _line_array(first, second).alias("items"),
        F.col("l_extendedprice").alias("subtotal_amount"),
        (F.col("tax_cents") / F.lit(100.0)).alias("tax_amount"),
        ((F.col("price_cents") + F.col("tax_cents")) / F.lit(100.0)).alias("total_amount"),
        F.col("l_linestatus").alias("payment_method"),
        F.when(F.col("l_quantity") > 25, F.concat(F.lit("L"), _text("l_suppkey"))).alias(
            "customer_loyalty_id"
        ),
        "_ingest_file_name",
        "_ingest_time",
        "ingest_date",
    )


def amazon_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order per order line. Ids of line status F are also transaction ids of ``pos_feed``."""
    lines = _lines(spark, sf_dir).withColumns(_feed_meta("amazon"))

    def line(sku, title, quantity, price, tax):
        return F.struct(
            F.lit("B0").alias("ASIN"),
            sku.alias("SellerSKU"),
            title.alias("Title"),
            quantity.alias("QuantityOrdered"),
            quantity.alias("QuantityShipped"),
            F.struct(
                F.lit("INR").alias("CurrencyCode"), _amount_text(price).alias("Amount")
            ).alias("ItemPrice"),
            F.struct(
                F.lit("INR").alias("CurrencyCode"), _amount_text(tax).alias("Amount")
            ).alias("ItemTax"),
        )

    first = line(
        _text("l_partkey"),
        F.concat(F.lit("Part "), _text("l_partkey")),
        F.col("l_quantity").cast("int"),
        F.col("price_cents"),
        F.col("tax_cents"),
    )
    second = line(
        _extra_sku(), F.lit("Service"), F.lit(0), F.col("tax_cents"), F.lit(0).cast("bigint")
    )
    prefix = F.when(F.col("l_linestatus") == "F", "T").otherwise("A")
    shipped = F.date_format("shipped", ISO)
    total = F.col("price_cents") + F.col("tax_cents")
    email = F.concat(F.lit("s"), _text("l_suppkey"), F.lit("@example.com"))
    return lines.select(
        F.concat(prefix, F.col("line_id")).alias("AmazonOrderId"),
        F.concat(F.lit("AMZ-"), F.col("line_id")).alias("SellerOrderId"),
        shipped.alias("PurchaseDate"),
        shipped.alias("LastUpdateDate"),
        F.lit("Shipped").alias("OrderStatus"),
        F.lit("MFN").alias("FulfillmentChannel"),
        F.lit("Amazon.in").alias("SalesChannel"),
        F.struct(
            F.when(F.col("l_tax") > 0.04, "USD").otherwise("INR").alias("CurrencyCode"),
            _amount_text(total).alias("Amount"),
        ).alias("OrderTotal"),
        F.lit(1).alias("NumberOfItemsShipped"),
        F.lit(0).alias("NumberOfItemsUnshipped"),
        F.lit("COD").alias("PaymentMethod"),
        email.alias("BuyerEmail"),
        F.struct(F.lit("Buyer").alias("BuyerName"), F.lit("IN").alias("BuyerCounty")).alias(
            "BuyerInfo"
        ),
        _line_array(first, second).alias("OrderItems"),
        "_ingest_file_name",
        "_ingest_time",
        "ingest_date",
    )


def shopify_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One web order per row of ``orders``, of two lines; pending orders have no tags."""
    src = table(spark, sf_dir, "orders").withColumn("total_cents", cents("o_totalprice"))
    src = src.withColumn("tax_cents", F.expr("total_cents * 18 div 118"))

    def money(c):
        return F.struct(
            F.struct(
                _amount_text(c).alias("amount"), F.lit("INR").alias("currencyCode")
            ).alias("presentmentMoney")
        )

    def edge(n, quantity, price):
        sku = F.concat(F.lit("C"), _text("o_custkey"))
        return F.struct(
            F.struct(
                F.concat(F.lit("S"), _text("o_orderkey"), F.lit(f"/{n}")).alias("id"),
                F.concat(F.lit("Pack "), _text("o_custkey")).alias("title"),
                F.lit(quantity).alias("quantity"),
                sku.alias("sku"),
                F.struct(_amount_text(price).alias("price"), sku.alias("sku")).alias("variant"),
            ).alias("node")
        )

    created = F.col("o_orderdate").cast("timestamp")
    return src.select(
        F.concat(F.lit("S"), _text("o_orderkey")).alias("id"),
        F.concat(F.lit("#"), _text("o_orderkey")).alias("name"),
        F.date_format(created, ISO).alias("createdAt"),
        money(F.col("total_cents")).alias("totalPriceSet"),
        money(F.col("total_cents") - F.col("tax_cents")).alias("subtotalPriceSet"),
        money(F.col("tax_cents")).alias("totalTaxSet"),
        F.concat(F.lit("c"), _text("o_custkey"), F.lit("@example.com")).alias("email"),
        F.struct(
            F.concat(F.lit("C"), _text("o_custkey")).alias("id"),
            F.lit("First").alias("firstName"),
            F.lit("Last").alias("lastName"),
            F.lit(None).cast("string").alias("phone"),
        ).alias("customer"),
        F.struct(
            F.array(edge(1, 1, F.col("total_cents")), edge(2, 3, F.col("tax_cents"))).alias("edges")
        ).alias("lineItems"),
        F.lit("web").alias("sourceName"),
        F.when(F.col("o_orderstatus") == "P", F.slice(F.array("o_orderpriority"), 1, 0))
        .otherwise(F.array("o_orderpriority"))
        .alias("tags"),
        F.lit("shop.json").alias("_ingest_file_name"),
        created.alias("_ingest_time"),
        day_text(created).alias("ingest_date"),
    )


FEEDS = {
    "shopify": shopify_feed,
    "pos": pos_feed,
    "distributor": distributor_feed,
    "amazon": amazon_feed,
}


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One web-shop document per order, as text; a file is an order day.

    The order total decides which documents are broken, and how.
    """
    src = table(spark, sf_dir, "orders")
    total = F.col("o_totalprice")
    key = _text("o_orderkey")
    money = '{"presentmentMoney":{"amount":"1.00","currencyCode":"INR"}}'
    email = F.when(total < 6000, "nobody").otherwise("a.b@example.com")
    created = F.when(total.between(11000, 15999.99), "null").otherwise('"2024-01-01T00:00:00Z"')
    tax = F.when(total.between(16000, 20999.99), '"1.00"').otherwise(money)
    customer = F.when(total.between(6000, 10999.99), "").otherwise('"customer":{"id":"c"},')
    node = F.concat(
        F.lit('{"id":"'), key, F.lit('","name":"#'), key,
        F.lit('","createdAt":'), created,
        F.lit(',"email":"'), email,
        F.lit(f'","totalPriceSet":{money},"subtotalPriceSet":{money},"totalTaxSet":'), tax,
        F.lit(","), customer,
        F.lit('"lineItems":{"edges":[]},"sourceName":"web"}'),
    )
    text = (
        F.when(total.between(21000, 23499.99), F.concat(F.lit("{broken "), key))
        .when(total.between(23500, 25999.99), F.lit('{"data":{}}'))
        .when(total.between(26000, 28499.99), F.lit('{"data":{"orders":{"edges":[]}}}'))
        .when(total.between(28500, 30999.99), F.lit('{"data":{"orders":{"edges":[{}]}}}'))
        .otherwise(
            F.concat(F.lit('{"data":{"orders":{"edges":[{"node":'), node, F.lit("}]}}}"))
        )
    )
    return src.select(
        F.concat(F.lit("drop_"), day_text("o_orderdate")).alias("file"),
        key.alias("doc"),
        text.alias("text"),
    )


def event_messages(events: DataFrame) -> DataFrame:
    """POS messages from events: a binary JSON payload, cut short for error events."""
    body = F.to_json(
        F.struct(
            _text("event_id").alias("transaction_id"),
            _text("user_id").alias("store_id"),
            F.col("event_type").alias("store_name"),
            F.col("value").alias("total_amount"),
            F.col("props").alias("payment_method"),
        )
    )
    cut = F.concat(F.lit('{"transaction_id":"'), _text("event_id"))
    return events.select(
        F.when(F.col("event_type") == "error", cut).otherwise(body).cast("binary").alias("value")
    )
