"""Gold marts. Results come without the processing stamp.

Group keys are dates, not formatted text; the text is made once per group afterwards.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import cents, day_text, from_cents, money_avg, money_sum


def daily_revenue_channel(orders: DataFrame) -> DataFrame:
    """Orders, revenue, tax and average order value by day and channel."""
    return (
        orders.groupBy(F.to_date("created_at").alias("day"), "channel")
        .agg(
            F.count("order_id").alias("order_count"),
            money_sum("total_amount").alias("gross_revenue"),
            money_sum("tax_amount").alias("tax_collected"),
            money_avg("total_amount").alias("average_order_value"),
        )
        .select(
            day_text("day").alias("sales_date"),
            "channel",
            "order_count",
            "gross_revenue",
            "tax_collected",
            "average_order_value",
        )
    )


def inventory_turnover(
    items: DataFrame, orders: DataFrame, asked: "DataFrame | None" = None
) -> DataFrame:
    """Units and item sales by day and SKU; the title is the least one the group shows.

    Revenue is the item amount, not the order total the join also brings into reach.

    Grouping by the title first keeps the heavy pass in the hash aggregate, which cannot hold a
    minimum over text. The second pass only sees the few titles of each day and SKU.

    ``asked`` (``sales_date, sku``) limits the mart to these groups. They go through the second pass as
    marked rows, which tells the others without a join of the mart.
    """
    dated = items.select("order_id", "sku", "title", "quantity", "total_amount").join(
        orders.select("order_id", F.to_date("created_at").alias("day")), "order_id"
    )
    titles = dated.groupBy("day", "sku", "title").agg(
        F.sum("quantity").alias("units"), F.sum(cents("total_amount")).alias("cents")
    )
    figures = [
        F.min("title").alias("product_title"),
        F.sum("units").alias("units_sold"),
        from_cents(F.sum("cents")).alias("total_sales_amount"),
    ]
    columns = ["sku", "product_title", "units_sold", "total_sales_amount"]
    if asked is None:
        mart = titles.groupBy("day", "sku").agg(*figures)
        return mart.select(day_text("day").alias("sales_date"), *columns)
    marked = (
        titles.withColumn("sales_date", day_text("day"))
        .drop("day")
        .withColumn("_sold", F.lit(True))
        .unionByName(asked.select("sales_date", "sku"), allowMissingColumns=True)
    )
    mart = marked.groupBy("sales_date", "sku").agg(
        *figures,
        F.bool_or("_sold").alias("_sold"),
        F.bool_or(F.col("_sold").isNull()).alias("_asked"),
    )
    return mart.filter("_sold and _asked").select("sales_date", *columns)


def customer_360(orders: DataFrame) -> DataFrame:
    """Profile per customer id.

    E-mail and channel are those of the first order, by time then order id; for the e-mail, the
    first order that has one.
    """
    first_order = F.struct("created_at", "order_id")
    with_email = F.when(F.col("customer_email").isNotNull(), first_order)
    return (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.min_by("customer_email", with_email).alias("customer_email"),
            F.min("created_at").alias("first_purchase_date"),
            F.max("created_at").alias("last_purchase_date"),
            F.count("order_id").alias("total_orders"),
            money_sum("total_amount").alias("total_spend"),
            F.min_by("channel", first_order).alias("preferred_channel"),
        )
    )
