"""Dashboard queries over the gold marts.

A list is the whole mart in the report's order; with ``n`` it is that order's first n.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import money_sum
from tradewind.schemas import CHANNELS


def kpi_totals(daily_revenue: DataFrame) -> DataFrame:
    """Revenue, orders and tax over everything, one row."""
    return daily_revenue.agg(
        money_sum("gross_revenue").alias("total_revenue"),
        F.sum("order_count").alias("total_orders"),
        money_sum("tax_collected").alias("total_tax"),
    )


def revenue_pivot(daily_revenue: DataFrame) -> DataFrame:
    """Revenue by day, one column per channel, 0 where a channel sold nothing.

    The channel list is fixed, so no extra job looks for pivot values.
    """
    return (
        daily_revenue.groupBy("sales_date")
        .pivot("channel", CHANNELS)
        .agg(money_sum("gross_revenue"))
        .na.fill(0.0, subset=CHANNELS)
    )


def _first(ordered: DataFrame, n: "int | None") -> DataFrame:
    return ordered if n is None else ordered.limit(n)


def recent_days(daily_revenue: DataFrame, n: "int | None" = None) -> DataFrame:
    """The daily matrix, newest day first, channels of one day in name order; with ``n`` the
    newest n days, each with all its channels."""
    rows = daily_revenue
    if n is not None:
        days = rows.select("sales_date").distinct().orderBy(F.desc("sales_date")).limit(n)
        rows = rows.join(days.withColumnRenamed("sales_date", "_day"), F.col("sales_date") == F.col("_day"), "left_semi")
    return rows.orderBy(F.desc("sales_date"), "channel")


def top_skus_by_units(inventory: DataFrame, n: "int | None" = None) -> DataFrame:
    """Mart rows with the most units; ties by amount, then day and SKU."""
    return _first(
        inventory.orderBy(F.desc("units_sold"), F.desc("total_sales_amount"), "sales_date", "sku"),
        n,
    )


def top_products_by_revenue(inventory: DataFrame, n: "int | None" = None) -> DataFrame:
    """Product titles by revenue over all days."""
    revenue = inventory.groupBy("product_title").agg(
        money_sum("total_sales_amount").alias("total_sales_amount")
    )
    return _first(revenue.orderBy(F.desc("total_sales_amount"), "product_title"), n)


def top_customers(customers: DataFrame, n: "int | None" = None) -> DataFrame:
    """Customers by spend."""
    return _first(customers.orderBy(F.desc_nulls_last("total_spend"), "customer_id"), n)
