"""Gold -> feature snapshots -> the online feature tables."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators.features import (
    CUSTOMER_FEATURES,
    PRODUCT_FEATURES,
    FeatureView,
    customer_snapshot,
    materialize,
    product_snapshot,
)
from tradewind.sinks.lake import publish, write_snapshot
from tradewind.sources.lake import load_table


def snapshots(spark: SparkSession, root: str, view: FeatureView, end: datetime) -> DataFrame:
    """The snapshots a view can use at ``end``: by the folder's day, later and outlived ones are not
    read."""
    day = F.col("day").cast("date")
    begin = end - view.ttl
    return spark.read.parquet(root).filter(day.between(F.lit(begin.date()), F.lit(end.date())))


def materialize_features(
    spark: SparkSession, snapshot_root: str, version: str, end: datetime
) -> None:
    """Export the marts as feature sources, then publish the latest row per entity at ``end``.

    A run adds the state of the marts at ``end`` as a snapshot: every customer and SKU has a row. The
    views read the snapshots of their time to live, newest row first; a run for an earlier ``end``
    sees none of a later day.
    """
    sources = {
        CUSTOMER_FEATURES: customer_snapshot(load_table(spark, "gold.customer_360"), end),
        PRODUCT_FEATURES: product_snapshot(load_table(spark, "gold.inventory_turnover"), end, end),
    }
    spark.sql("CREATE SCHEMA IF NOT EXISTS online")
    for view, snapshot in sources.items():
        root = f"{snapshot_root}/{view.name}"
        write_snapshot(snapshot, f"{root}/day={end:%Y-%m-%d}/snapshot={version}")
        online = materialize(snapshots(spark, root, view, end), view, end)
        publish(online, f"online.{view.name}", version)
