"""Schemas of the raw drops and of the silver and gold tables, and the fixed value sets."""

from pyspark.sql import types as T

# Sales channels in load order. On a key met in two channels the later one wins.
CHANNELS = ["shopify", "pos", "distributor", "amazon"]
CHANNEL_PRIORITY = {channel: rank for rank, channel in enumerate(CHANNELS, start=1)}

# Constants the conform step writes.
HOME_CURRENCY = "INR"
PAID = "PAID"
ONLINE_REGION = "Online"
DEFAULT_PAYMENT = "ONLINE"
DISTRIBUTOR_PAYMENT = "BANK_TRANSFER"
STREAM_FILE_NAME = "kafka-stream"


STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()


def record(**fields: T.DataType) -> T.StructType:
    """A struct of nullable fields."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def listing(element: T.DataType) -> T.ArrayType:
    return T.ArrayType(element)


_SHOP_MONEY = record(presentmentMoney=record(amount=STRING, currencyCode=STRING))

SHOPIFY_NODE = record(
    id=STRING,
    name=STRING,
    createdAt=STRING,
    totalPriceSet=_SHOP_MONEY,
    subtotalPriceSet=_SHOP_MONEY,
    totalTaxSet=_SHOP_MONEY,
    email=STRING,
    customer=record(id=STRING, firstName=STRING, lastName=STRING, phone=STRING),
    lineItems=record(
        edges=listing(
            record(
                node=record(
                    id=STRING,
                    title=STRING,
                    quantity=STRING,
                    sku=STRING,
                    variant=record(price=STRING, sku=STRING),
                )
            )
        )
    ),
    sourceName=STRING,
    tags=listing(STRING),
)

SHOPIFY_DROP = record(data=record(orders=record(edges=listing(record(node=SHOPIFY_NODE)))))

_AMAZON_MONEY = record(CurrencyCode=STRING, Amount=STRING)

AMAZON_ORDER = record(
    AmazonOrderId=STRING,
    SellerOrderId=STRING,
    PurchaseDate=STRING,
    LastUpdateDate=STRING,
    OrderStatus=STRING,
    FulfillmentChannel=STRING,
    SalesChannel=STRING,
    OrderTotal=_AMAZON_MONEY,
    NumberOfItemsShipped=INT,
    NumberOfItemsUnshipped=INT,
    PaymentMethod=STRING,
    BuyerEmail=STRING,
    BuyerInfo=record(BuyerName=STRING, BuyerCounty=STRING),
    OrderItems=listing(
        record(
            ASIN=STRING,
            SellerSKU=STRING,
            Title=STRING,
            QuantityOrdered=STRING,
            QuantityShipped=STRING,
            ItemPrice=_AMAZON_MONEY,
            ItemTax=_AMAZON_MONEY,
        )
    ),
)

AMAZON_DROP = record(Orders=listing(AMAZON_ORDER))

POS_TRANSACTION = record(
    transaction_id=STRING,
    store_id=STRING,
    store_name=STRING,
    timestamp=STRING,
    cashier_id=STRING,
    items=listing(
        record(sku=STRING, title=STRING, quantity=STRING, unit_price=DOUBLE, amount=DOUBLE)
    ),
    subtotal_amount=DOUBLE,
    tax_amount=DOUBLE,
    total_amount=DOUBLE,
    payment_method=STRING,
    customer_loyalty_id=STRING,
)

DISTRIBUTOR_ROW = record(
    TransactionID=STRING,
    DistributorID=STRING,
    DistributorName=STRING,
    Region=STRING,
    InvoiceNumber=STRING,
    InvoiceDate=DATE,
    SKU=STRING,
    Quantity=INT,
    UnitPrice=DOUBLE,
    DiscountPercent=INT,
    TaxAmount=DOUBLE,
    TotalAmount=DOUBLE,
    PaymentStatus=STRING,
)

INGEST_META = record(_ingest_file_name=STRING, _ingest_time=TIMESTAMP, ingest_date=STRING)


def with_meta(schema: T.StructType) -> T.StructType:
    """A raw schema plus the lineage columns every bronze table carries."""
    return T.StructType(schema.fields + INGEST_META.fields)


BRONZE = {
    "shopify_orders": with_meta(SHOPIFY_NODE),
    "pos_transactions": with_meta(POS_TRANSACTION),
    "distributor_sales": with_meta(DISTRIBUTOR_ROW),
    "amazon_sales": with_meta(AMAZON_ORDER),
}

SILVER_ORDERS = record(
    order_id=STRING,
    order_number=STRING,
    channel=STRING,
    created_at=TIMESTAMP,
    customer_id=STRING,
    customer_email=STRING,
    currency=STRING,
    subtotal_amount=DOUBLE,
    tax_amount=DOUBLE,
    total_amount=DOUBLE,
    payment_method=STRING,
    payment_status=STRING,
    region=STRING,
    _processed_at=TIMESTAMP,
)
SILVER_ORDER_ITEMS = record(
    order_item_id=STRING,
    order_id=STRING,
    sku=STRING,
    title=STRING,
    quantity=INT,
    unit_price=DOUBLE,
    total_amount=DOUBLE,
    _processed_at=TIMESTAMP,
)
SILVER_PRODUCTS = record(sku=STRING, title=STRING, retail_price=DOUBLE, _processed_at=TIMESTAMP)

GOLD_DAILY_REVENUE = record(
    sales_date=STRING,
    channel=STRING,
    order_count=LONG,
    gross_revenue=DOUBLE,
    tax_collected=DOUBLE,
    average_order_value=DOUBLE,
    _processed_at=TIMESTAMP,
)
GOLD_INVENTORY = record(
    sales_date=STRING,
    sku=STRING,
    product_title=STRING,
    units_sold=LONG,
    total_sales_amount=DOUBLE,
    _processed_at=TIMESTAMP,
)
GOLD_CUSTOMER_360 = record(
    customer_id=STRING,
    customer_email=STRING,
    first_purchase_date=TIMESTAMP,
    last_purchase_date=TIMESTAMP,
    total_orders=LONG,
    total_spend=DOUBLE,
    preferred_channel=STRING,
    _processed_at=TIMESTAMP,
)
