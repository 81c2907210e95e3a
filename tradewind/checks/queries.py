"""Registered queries. Each reads whole tables and returns one frame."""

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind import schemas as S
from tradewind.checks import frames as T
from tradewind.checks.drops import DROP_QUERIES
from tradewind.functions import decode_json, item_key, money_sum
from tradewind.operators import conform, contract, features, marts, quality, reports
from tradewind.operators.dedupe import dedupe_latest, duplicate_keys
from tradewind.operators.upsert import upsert_table
from tradewind.plans.bronze import channel_rows
from tradewind.plans.channels import all_items, all_orders
from tradewind.plans.gold import refresh_gold
from tradewind.plans.silver import SILVER_TABLES
from tradewind.sinks import commit, ensure_buckets, ensure_table, publish, shared_dir, stage_merge
from tradewind.sources import split_recognised, stamp
from tradewind.streaming import stream_append, stream_pos

TOP = 20

# An incremental load: the target holds orders up to the end of 1998, the batch holds those
# from 1998 on, so 1998 is met by both.
LOADED_BEFORE = "1999-01-01"
BATCH_FROM = "1998-01-01"


def _loaded(df: DataFrame, c: str) -> DataFrame:
    return df.filter(F.col(c) < F.lit(LOADED_BEFORE).cast("timestamp"))


def _batch(df: DataFrame, c: str) -> DataFrame:
    return df.filter(F.col(c) >= F.lit(BATCH_FROM).cast("timestamp"))


def _first_load(orders: DataFrame) -> DataFrame:
    """The early load has all its orders; those then pending had no amount yet."""
    pending = F.col("payment_status") == "P"
    return _loaded(orders, "created_at").withColumns(
        {c: F.when(~pending, F.col(c)).otherwise(F.lit(0.0)) for c in ("total_amount", "tax_amount")}
    )


# marts


def daily_revenue_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_revenue_channel(T.orders(spark, sf_dir))


def inventory_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.inventory_turnover(T.items(spark, sf_dir), T.orders(spark, sf_dir))


def customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.plain(marts.customer_360(T.orders(spark, sf_dir)))


# reports


def kpi_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.kpi_totals(daily_revenue_channel(spark, sf_dir))


def revenue_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_pivot(daily_revenue_channel(spark, sf_dir))


def days_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.recent_days(daily_revenue_channel(spark, sf_dir))


def recent_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.recent_days(daily_revenue_channel(spark, sf_dir), TOP)


def _skus_by_units(n):
    return lambda spark, sf_dir: reports.top_skus_by_units(inventory_turnover(spark, sf_dir), n)


def _products_by_revenue(n):
    return lambda spark, sf_dir: reports.top_products_by_revenue(
        inventory_turnover(spark, sf_dir), n
    )


def _customers_by_spend(n):
    return lambda spark, sf_dir: T.plain(
        reports.top_customers(marts.customer_360(T.orders(spark, sf_dir)), n)
    )


# latest version, keys


def dedupe_latest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = T.table(spark, sf_dir, "lineitem")
    return T.plain(dedupe_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))


def item_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = T.table(spark, sf_dir, "lineitem")
    order_id, sku = F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")
    return lines.select("l_linenumber", item_key(order_id, sku).alias("order_item_id"))


def item_key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(item_surrogate_key(spark, sf_dir), ["order_item_id"])


# conform


def _latest(spark: SparkSession, sf_dir: str, channel: str) -> DataFrame:
    return conform.latest_bronze(T.FEEDS[channel](spark, sf_dir), channel)


def _conform(channel: str, part: int):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return T.plain(conform.CONFORM[channel][part](_latest(spark, sf_dir, channel)))

    return query


def _parts(spark: SparkSession, sf_dir: str, part: str) -> dict:
    return {c: conform.latest_part(T.FEEDS[c](spark, sf_dir), c, part) for c in S.CHANNELS}


def _feeds(spark: SparkSession, sf_dir: str) -> dict:
    return {c: T.FEEDS[c](spark, sf_dir) for c in S.CHANNELS}


def union_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.plain(all_orders(_feeds(spark, sf_dir)))


def union_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.plain(all_items(_feeds(spark, sf_dir)))


def item_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, units and amount by channel after its keys are made unique: those of all its lines."""
    by_channel = [
        conform.conform_items({c: rows})
        for c, rows in _parts(spark, sf_dir, conform.ITEMS).items()
    ]
    return (
        reduce(DataFrame.unionByName, by_channel)
        .groupBy("channel_rank")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("quantity").alias("units"),
            money_sum("total_amount").alias("amount"),
        )
    )


def union_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.extract_products(all_items(_feeds(spark, sf_dir)))


def order_item_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = T.orders(spark, sf_dir).select("order_id", "total_amount")
    return conform.with_item_sums(
        orders.withColumnRenamed("total_amount", "order_total"), T.items(spark, sf_dir)
    )


def extract_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.extract_products(T.items(spark, sf_dir))


# upserts


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = T.orders(spark, sf_dir)
    refunded = _batch(orders, "created_at").withColumns(
        {
            "channel": F.lit("shopify"),
            "currency": F.lit("USD"),
            "payment_status": F.lit("REFUNDED"),
            "total_amount": F.lit(0.0),
        }
    )
    return T.plain(upsert_table("silver.orders", _loaded(orders, "created_at"), refunded))


def _unique_items(items: DataFrame) -> DataFrame:
    return dedupe_latest(items, ["order_item_id"], ["shipped"])


def upsert_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = T.items(spark, sf_dir).drop("tax_amount")
    target = _unique_items(_loaded(items, "shipped"))
    source = _unique_items(_batch(items, "shipped"))
    return T.plain(upsert_table("silver.order_items", target, source))


def upsert_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = T.items(spark, sf_dir)
    target = conform.extract_products(_loaded(items, "shipped"))
    source = conform.extract_products(_batch(items, "shipped"))
    return upsert_table("silver.products", target, source)


def _upsert_mart(name: str, mart):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = T.orders(spark, sf_dir)
        target = mart(spark, sf_dir, _first_load(orders))
        source = mart(spark, sf_dir, _batch(orders, "created_at"))
        return T.plain(upsert_table(name, target, source, unique_source=True))

    return query


upsert_daily_revenue = _upsert_mart(
    "gold.daily_revenue_channel", lambda spark, sf_dir, o: marts.daily_revenue_channel(o)
)
upsert_inventory = _upsert_mart(
    "gold.inventory_turnover",
    lambda spark, sf_dir, o: marts.inventory_turnover(T.items(spark, sf_dir), o),
)
upsert_customer_360 = _upsert_mart(
    "gold.customer_360", lambda spark, sf_dir, o: marts.customer_360(o)
)


# quality


def dq_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expectations(T.orders(spark, sf_dir), quality.ORDER_RULES, "silver.orders")


def dq_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expectations(
        T.items(spark, sf_dir), quality.ORDER_ITEM_RULES, "silver.order_items"
    )


def dq_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = quality.violations(T.items(spark, sf_dir), quality.ORDER_ITEM_RULES)
    return broken.select(
        "order_item_id", "sku", "total_amount", F.concat_ws(",", "broken_rules").alias("broken")
    )


def dq_order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = quality.violations(T.orders(spark, sf_dir), quality.ORDER_RULES)
    return broken.select("order_id", F.concat_ws(",", "broken_rules").alias("broken"))


# payloads, contract


def decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = T.table(spark, sf_dir, "events").withColumn("raw", F.col("props").cast("binary"))
    return decode_json(events, "raw", S.record(k=S.INT), keep=("event_id",))


def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = T.order_documents(spark, sf_dir)
    by_document = documents.select(F.col("doc").alias("file"), "text")
    return contract.contract_report(by_document)


def contract_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.file_verdicts(T.order_documents(spark, sf_dir))


def _routes(judged: DataFrame) -> DataFrame:
    route = F.when(F.col("passed"), "clean").otherwise("quarantined")
    return judged.select("doc", route.alias("route"))


def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = T.order_documents(spark, sf_dir)
    return _routes(contract.with_verdict(documents, one_document_per_file=False))


def route_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, quarantined = contract.route_files(T.order_documents(spark, sf_dir))
    return _routes(
        clean.withColumn("passed", F.lit(True)).unionByName(
            quarantined.withColumn("passed", F.lit(False))
        )
    )


def recognised_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, unknown = split_recognised(T.order_documents(spark, sf_dir), "data")
    return known.select("doc", F.lit(True).alias("recognised")).unionByName(
        unknown.select("doc", F.lit(False).alias("recognised"))
    )


def ingest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through the bronze step: typed orders, or dead letters."""
    rows = channel_rows("shopify", T.order_documents(spark, sf_dir))
    return rows.select(
        "id", "name", "createdAt", "email", "sourceName",
        F.col("totalPriceSet.presentmentMoney.amount").alias("total"),
        F.size("lineItems.edges").alias("lines"),
        F.col("dead_payload").isNotNull().alias("is_dead"),
        F.array_join("dead_errors.error", ",").alias("reasons"),
        "_ingest_file_name",
        "route",
    )


# streaming


def stream_append_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as POS messages through the streaming ingest, read back from its table."""
    schema = T.table(spark, sf_dir, "events").schema
    # a pattern, as a stream reads directories; it fits one file and a directory of files
    events = stream_pos(spark, "parquet", schema=schema, path=f"{sf_dir}/events.parquet*")
    rows = channel_rows("pos", T.event_messages(events))
    root = shared_dir(spark, "stream_append_events")
    query = stream_append(
        rows, f"{root}/table", f"{root}/checkpoint", {"availableNow": True}, ("route",)
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/table").select(
        "transaction_id",
        "store_id",
        "store_name",
        "total_amount",
        "payment_method",
        "dead_payload",
        "_ingest_file_name",
        F.col("route").cast("string").alias("route"),
    )


# publishing


def publish_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of silver orders through write, audit, swap; the second is an upsert."""
    root = shared_dir(spark, "publish")
    name = "orders_" + root.rsplit("-", 1)[1]
    rules = quality.ORDER_RULES
    schema = S.SILVER_ORDERS
    orders = stamp(T.orders(spark, sf_dir), datetime(2024, 1, 1))
    ensure_table(spark, name, schema, ("channel",), root)
    publish(_loaded(orders, "created_at"), name, "1", schema, rules, ("channel",), root)
    refunded = _batch(orders, "created_at").withColumns(
        {"channel": F.lit("shopify"), "payment_status": F.lit("REFUNDED")}
    )
    merged = upsert_table("silver.orders", spark.table(name), refunded, unique_source=True)
    publish(merged, name, "2", schema, rules, ("channel",), root)
    return T.plain(spark.table(name).drop("_processed_at"))


LAKE_BUCKETS = 8


def _lake_loads(spark: SparkSession, sf_dir: str, after_first=lambda silver: None) -> str:
    """Two loads of silver orders and items into buckets; returns the namespace.

    The second load moves the pending orders to the next day and to another customer.
    """
    silver = "lake_" + shared_dir(spark, "lake").rsplit("-", 1)[1]
    tables = [t for t in SILVER_TABLES if t.name != "products"]
    orders, items = T.orders(spark, sf_dir), T.items(spark, sf_dir).drop("tax_amount")
    pending = F.col("payment_status") == "P"
    moved = _batch(orders, "created_at").withColumns(
        {
            "created_at": F.when(
                pending, F.col("created_at") + F.expr("INTERVAL 1 DAY")
            ).otherwise(F.col("created_at")),
            "customer_id": F.when(pending, F.concat(F.lit("moved-"), "customer_id")).otherwise(
                F.col("customer_id")
            ),
        }
    )
    loads = (
        {"orders": _first_load(orders), "order_items": _unique_items(_loaded(items, "shipped"))},
        {"orders": moved, "order_items": _unique_items(_batch(items, "shipped"))},
    )
    for version, load in enumerate(loads, 1):
        base = ensure_buckets(spark, silver, tables, LAKE_BUCKETS)
        staged = {}
        for t in tables:
            rows = stamp(load[t.name], datetime(2024, 1, version))
            staged[t.name], _ = stage_merge(base, t, rows, str(version))
        commit(base, staged, str(version))
        if version == 1:
            after_first(silver)
    return silver


def bucketed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders after two loads, each of which rewrites the buckets its keys are in."""
    silver = _lake_loads(spark, sf_dir)
    return T.plain(spark.table(f"{silver}.orders").drop("_processed_at"))


def gold_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marts made after the first load and brought up to date after the second."""

    def refresh(silver: str, version: str = "1") -> None:
        refresh_gold(
            spark, version, silver=silver, gold=f"{silver}_gold", buckets=LAKE_BUCKETS
        )

    silver = _lake_loads(spark, sf_dir, refresh)
    refresh(silver, "2")
    none = F.lit(None).cast("string")

    def listed(mart: str, keys: list, n: str, amount: str, label) -> DataFrame:
        return spark.table(f"{silver}_gold.{mart}").select(
            F.lit(mart).alias("mart"),
            F.col(keys[0]).alias("key_a"),
            (F.col(keys[1]) if len(keys) > 1 else none).alias("key_b"),
            F.col(n).cast("long").alias("n"),
            F.col(amount).alias("amount"),
            label.alias("label"),
        )

    return reduce(
        DataFrame.unionByName,
        [
            listed("daily_revenue_channel", ["sales_date", "channel"], "order_count", "gross_revenue",
                   F.round(F.col("tax_collected") * 100).cast("long").cast("string")),
            listed("inventory_turnover", ["sales_date", "sku"], "units_sold", "total_sales_amount",
                   F.col("product_title")),
            listed("customer_360", ["customer_id"], "total_orders", "total_spend",
                   F.concat_ws(",", "preferred_channel", "customer_email")),
        ],
    )


# features

EVENT_VIEW = features.FeatureView("event_features", ("customer_id",), ("event_type", "value"))
FEATURES_UNTIL = datetime(2024, 1, 25)


def _event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = T.table(spark, sf_dir, "events")
    source = events.select(
        F.col("user_id").cast("string").alias("customer_id"),
        "event_type",
        "value",
        # hourly event times, so that several rows share one and the created time decides
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("event_timestamp"),
        F.col("ts").cast("timestamp").alias("created_timestamp"),
    )
    return features.materialize(source, EVENT_VIEW, FEATURES_UNTIL)


def latest_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.plain(_event_features(spark, sf_dir))


def lookup_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = T.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id")
    )
    online = _event_features(spark, sf_dir)
    return features.lookup_features(requests, online, EVENT_VIEW.keys, EVENT_VIEW.features)


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer view over a snapshot of the customer mart: every customer is there."""
    mart = marts.customer_360(T.orders(spark, sf_dir))
    end = datetime(2001, 7, 1)
    snapshot = features.customer_snapshot(mart, end)
    return T.plain(features.materialize(snapshot, features.CUSTOMER_FEATURES, end))


def product_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product view over each SKU's last sale: those in the 90 days to the end date."""
    end = datetime(2001, 7, 1)
    snapshot = features.product_snapshot(inventory_turnover(spark, sf_dir), end)
    return T.plain(features.materialize(snapshot, features.PRODUCT_FEATURES, end))


QUERIES = {
    "daily_revenue_channel": daily_revenue_channel,
    "inventory_turnover": inventory_turnover,
    "customer_360": customer_360,
    "kpi_totals": kpi_totals,
    "revenue_pivot": revenue_pivot,
    "days_in_order": days_in_order,
    "recent_days": recent_days,
    "skus_by_units": _skus_by_units(None),
    "top_skus_by_units": _skus_by_units(TOP),
    "products_by_revenue": _products_by_revenue(None),
    "top_products_by_revenue": _products_by_revenue(TOP),
    "customers_by_spend": _customers_by_spend(None),
    "top_customers": _customers_by_spend(TOP),
    "dedupe_latest_items": dedupe_latest_items,
    "item_surrogate_key": item_surrogate_key,
    "item_key_collisions": item_key_collisions,
    "conform_shopify_orders": _conform("shopify", 0),
    "conform_shopify_items": _conform("shopify", 1),
    "conform_pos_orders": _conform("pos", 0),
    "conform_pos_items": _conform("pos", 1),
    "invoice_rollup": _conform("distributor", 0),
    "conform_distributor_items": _conform("distributor", 1),
    "conform_amazon_orders": _conform("amazon", 0),
    "conform_amazon_items": _conform("amazon", 1),
    "order_item_sums": order_item_sums,
    "extract_products": extract_products,
    "union_channels": union_channels,
    "union_items": union_items,
    "item_totals": item_totals,
    "union_products": union_products,
    "upsert_orders": upsert_orders,
    "upsert_items": upsert_items,
    "upsert_products": upsert_products,
    "upsert_daily_revenue": upsert_daily_revenue,
    "upsert_inventory": upsert_inventory,
    "upsert_customer_360": upsert_customer_360,
    "publish_orders": publish_orders,
    "bucketed_orders": bucketed_orders,
    "gold_increment": gold_increment,
    "dq_orders": dq_orders,
    "dq_order_items": dq_order_items,
    "dq_violations": dq_violations,
    "dq_order_violations": dq_order_violations,
    "decode_payload": decode_payload,
    "contract_report": contract_report,
    "contract_verdicts": contract_verdicts,
    "route_files": route_files,
    "route_documents": route_documents,
    "recognised_documents": recognised_documents,
    "ingest_documents": ingest_documents,
    "stream_append_events": stream_append_events,
    "latest_features": latest_features,
    "lookup_features": lookup_features,
    "customer_features": customer_features,
    "product_features": product_features,
    **DROP_QUERIES,
}
