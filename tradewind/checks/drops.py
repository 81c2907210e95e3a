"""Registered queries that go through the files: tables written as drops, read by the plans."""

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import schemas as S
from tradewind.checks import frames as C
from tradewind.operators import conform, contract, quality
from tradewind.plans.bronze import bronze_table, ingest_batch, ingest_stream
from tradewind.sinks import ensure_namespace, ensure_table, publish, shared_dir
from tradewind.sources import feature_source, is_available, load_table, register_view, stamp

AT = datetime(2024, 1, 1)
PARTS = 4


def _routed(spark: SparkSession, place: str, *columns) -> DataFrame:
    rows = spark.read.parquet(place)
    reasons = F.array_join("dead_errors.error", ",")
    return rows.select(*columns, reasons.alias("reasons"), F.col("route").cast("string").alias("route"))


def ingest_web_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web orders as line drops through contract and bronze, conformed to silver orders."""
    root = shared_dir(spark, "web-drops")
    nodes = C.shopify_feed(spark, sf_dir).drop("_ingest_file_name", "_ingest_time", "ingest_date")
    edges = F.array(F.struct(F.struct(*nodes.columns).alias("node")))
    envelope = F.struct(F.struct(edges.alias("edges")).alias("orders")).alias("data")
    nodes.select(envelope).write.json(f"{root}/in")
    ingest_batch(spark, "shopify", f"{root}/in", f"{root}/table", AT, whole_files=False)
    rows = bronze_table(spark, "shopify", [f"{root}/table"])
    return C.plain(conform.shopify_orders(conform.latest_bronze(rows, "shopify")))


def ingest_market_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market-place envelopes, one a customer; pending orders have no id, and odd customers' drops
    lack the list."""
    root = shared_dir(spark, "market-drops")
    order = F.struct(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("AmazonOrderId"),
        F.col("o_orderstatus").alias("OrderStatus"),
        F.struct(F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("Amount")).alias(
            "OrderTotal"
        ),
    )
    envelopes = (
        C.table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.collect_list(order).alias("Listed"))
        .select(
            F.when(F.col("o_custkey") % 5 != 0, F.col("Listed")).alias("Orders"),
            F.when(F.col("o_custkey") % 5 == 0, F.col("o_custkey")).alias("customer"),
        )
    )
    envelopes.write.json(f"{root}/in")
    ingest_batch(spark, "amazon", f"{root}/in", f"{root}/table", AT, whole_files=False)
    total = F.col("OrderTotal.Amount").alias("total")
    day = F.col("ingest_date").cast("string").alias("ingest_date")
    return _routed(spark, f"{root}/table", "AmazonOrderId", "OrderStatus", total, day)


def _pos_drops(spark: SparkSession, sf_dir: str, place: str) -> None:
    """Orders as transactions, one a line; pending ones have no id."""
    (
        C.table(spark, sf_dir, "orders")
        .select(
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("transaction_id"),
            F.concat(F.lit("st"), F.col("o_custkey").cast("string")).alias("store_id"),
            F.col("o_orderpriority").alias("payment_method"),
            F.col("o_totalprice").alias("total_amount"),
        )
        .repartition(PARTS, "store_id")
        .write.json(place)
    )


POS_COLUMNS = ("transaction_id", "store_id", "payment_method", "total_amount")


def ingest_pos_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "pos-drops")
    _pos_drops(spark, sf_dir, f"{root}/in")
    ingest_batch(spark, "pos", f"{root}/in", f"{root}/table", AT, whole_files=False)
    return _routed(spark, f"{root}/table", *POS_COLUMNS)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same drops by a stream that is stopped between micro-batches and started again.

    Files go one by one and are archived; the checkpoint decides what is left to do.
    """
    root = shared_dir(spark, "pos-restart")
    _pos_drops(spark, sf_dir, f"{root}/in")

    def start(trigger: dict):
        return ingest_stream(
            spark,
            "pos",
            f"{root}/in",
            f"{root}/table",
            f"{root}/checkpoint",
            archive=f"{root}/archive",
            trigger=trigger,
            files_per_trigger=1,
            whole_files=False,
        )

    query = start({"processingTime": "1 second"})
    until = time.monotonic() + 120
    while query.isActive and time.monotonic() < until:
        if query.lastProgress and query.lastProgress["batchId"] >= 1:
            break
        time.sleep(0.2)
    query.stop()
    start({"availableNow": True}).awaitTermination()
    return _routed(spark, f"{root}/table", *POS_COLUMNS)


def ingest_csv_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines as CSV with the columns in another order, read by header from split files.

    Returned lines have a quantity that is no number; names hold commas and quotes.
    """
    root = shared_dir(spark, "csv-drops")
    lines = C.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("TransactionID"),
        F.concat(F.lit("D"), F.col("l_suppkey").cast("string")).alias("DistributorID"),
        F.concat(F.lit('North, "'), F.col("l_suppkey").cast("string"), F.lit('" Co')).alias("DistributorName"),
        F.col("l_linestatus").alias("Region"),
        F.concat(F.lit("I"), F.col("l_orderkey").cast("string")).alias("InvoiceNumber"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("InvoiceDate"),
        F.col("l_partkey").cast("string").alias("SKU"),
        F.when(F.col("l_returnflag") == "R", "two")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("Quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("UnitPrice"),
        F.lit("0").alias("DiscountPercent"),
        F.lit("0.0").alias("TaxAmount"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("TotalAmount"),
        F.lit("PAID").alias("PaymentStatus"),
    )
    written = lines.select(*reversed(lines.columns))
    written.write.option("header", True).option("escape", '"').csv(f"{root}/in")
    ingest_batch(spark, "distributor", f"{root}/in", f"{root}/table", AT, whole_files=False)
    return _routed(
        spark,
        f"{root}/table",
        "TransactionID",
        "DistributorName",
        "Region",
        F.col("InvoiceDate").cast("string").alias("invoice_date"),
        "SKU",
        "Quantity",
        "UnitPrice",
    )


def contract_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract read from its definition, with numbers, lists and optional fields, over parts."""
    definition = {
        "fields": [
            {"name": "size", "type": "number", "required": True},
            {"name": "tags", "type": "array"},
            {"name": "brand", "type": "string", "required": True, "pattern": "Brand#[1-3]"},
        ]
    }
    part = C.table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    text = F.concat(
        F.lit('{"data":{"orders":{"edges":[{"node":{"size":'),
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit('"'), size, F.lit('"')))
        .when(F.col("p_size") % 3 == 1, F.lit("true"))
        .otherwise(size),
        F.when(F.col("p_size") % 4 == 0, F.lit(',"tags":{}'))
        .when(F.col("p_size") % 4 == 1, F.lit(',"tags":null'))
        .when(F.col("p_size") % 4 == 2, F.lit(',"tags":[1]'))
        .otherwise(F.lit("")),
        F.lit(',"brand":"'),
        F.col("p_brand"),
        F.lit('"}}]}}}'),
    )
    documents = part.select(F.col("p_partkey").cast("string").alias("file"), text.alias("text"))
    return contract.contract_report(documents, contract.contract_from(definition)).select("file", "error")


def lake_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that are there, empty and missing; a view, a feature source, rules on an empty table."""
    root = shared_dir(spark, "guards")
    space = "guards_" + root.rsplit("-", 1)[1]
    ensure_namespace(spark, space)
    orders = stamp(C.orders(spark, sf_dir), AT)
    ensure_table(spark, f"{space}.empty", S.SILVER_ORDERS, ("channel",), root)
    publish(orders, f"{space}.orders", "1", S.SILVER_ORDERS, partition_by=("channel",), root=root)
    view = register_view(load_table(spark, f"{space}.orders"), f"v_{space}")
    counted = spark.sql(f"SELECT count(*) AS n, max(_processed_at) AS at FROM {view}").first()
    source = feature_source(load_table(spark, f"{space}.orders"), "created_at", "_processed_at")
    latest = source.agg(F.max("event_timestamp").alias("at")).first()["at"]
    rules = quality.expectations(load_table(spark, f"{space}.empty"), quality.ORDER_RULES, "empty")
    skipped = rules.filter("status = 'skipped'").count()
    found = [
        ("available", str(is_available(spark, f"{space}.orders")).lower()),
        ("empty", str(is_available(spark, f"{space}.empty")).lower()),
        ("missing", str(is_available(spark, f"{space}.nothing")).lower()),
        ("rows", str(counted["n"])),
        ("stamped", counted["at"].strftime("%Y-%m-%d")),
        ("latest", latest.strftime("%Y-%m-%d")),
        ("skipped rules", str(skipped)),
    ]
    kind = T.StructType([T.StructField("what", T.StringType()), T.StructField("value", T.StringType())])
    return spark.createDataFrame(found, kind)


DROP_QUERIES = {
    "ingest_web_drops": ingest_web_drops,
    "ingest_market_drops": ingest_market_drops,
    "ingest_pos_drops": ingest_pos_drops,
    "ingest_csv_drops": ingest_csv_drops,
    "stream_restart": stream_restart,
    "contract_types": contract_types,
    "lake_guards": lake_guards,
}
